"""Breaks of numeric profiles: places after which a series jumps by more than it mostly does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def breaks(
    rows: DataFrame, series: str, place: str, level: str, percentile: float | None = None, deviations: float | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """(series, place, jump, n) and the columns to `keep`: places whose level differs from the next by more than the series' threshold.

    The threshold is a percentile (interpolated) of the series' jumps, or so many
    of their population's standard deviations. n is the number of places. Rows
    without a level are no places. A series is a window's group, which Spark
    spills; its threshold is one aggregate, joined back.
    """
    if (percentile is None) == (deviations is None):
        raise ValueError("give a percentile or deviations")
    in_order = Window.partitionBy(series).orderBy(place)
    jumps = rows.where(F.col(level).isNotNull()).select(
        series, place, *keep, F.abs(F.lead(level).over(in_order) - F.col(level)).alias("jump"), F.count("*").over(Window.partitionBy(series)).alias("n")
    )
    jump = F.col("jump").cast("double")
    most = F.percentile("jump", percentile) if percentile is not None else F.stddev_pop(jump) * deviations
    limits = jumps.where("jump is not null").groupBy(F.col(series).alias("_series")).agg(most.alias("_most"))
    return jumps.join(limits, F.col(series).eqNullSafe(F.col("_series"))).where(jump > F.col("_most")).select(series, place, "jump", "n", *keep)


def nearest_break(found: DataFrame, series: str, place: str, expected: float, tolerance: float) -> DataFrame:
    """Of each series the break nearest to a share `expected` of its length, the lesser of two, if within `tolerance` of the length."""
    off = F.abs(F.col(place) - F.floor(F.col("n") * expected))
    near = found.where(off <= F.floor(F.col("n") * tolerance))
    first = near.groupBy(series).agg(F.min(F.struct(off.alias("off"), place, "jump", "n")).alias("b"))
    return first.select(series, f"b.{place}", "b.jump", "b.n")


def outermost_break(found: DataFrame, series: str, place: str, within: str, first: bool = True) -> DataFrame:
    """Of each series the first, or else the last, of the breaks that meet an SQL condition, with all their columns."""
    pick = F.min if first else F.max
    rest = [c for c in found.columns if c not in (series, place)]
    end = found.where(within).groupBy(series).agg(pick(F.struct(place, *rest)).alias("b"))
    return end.select(series, f"b.{place}", *[f"b.{c}" for c in rest])
