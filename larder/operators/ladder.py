"""Sources asked in turn, each only for what the ones before did not have."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.keeping import kept


def first_hits(items: DataFrame, key: str, rungs: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Hits of each item's first rung that has any, with `rung`, its place from 0 on.

    A rung gets the items that are left and returns rows with their key. What it
    has found is kept and joined away before the next is asked, and none is asked
    when nothing is left; so costly sources come last and see few items.
    """
    left, found = items, []
    for place, rung in enumerate(rungs):
        hits = kept(rung(left).withColumn("rung", F.lit(place)))
        found.append(hits)
        if place + 1 < len(rungs):
            left = kept(left.join(hits.select(key).distinct(), key, "left_anti"))
            if left.isEmpty():
                break
    out = found[0]
    for hits in found[1:]:
        out = out.union(hits)
    return out


def lookup(source: DataFrame, phrase: str, order: str, most: int) -> Callable[[str], Callable[[DataFrame], DataFrame]]:
    """A source by phrase: for a column of search terms, a rung with each item's `most` first hits, numbered by `hit`.

    The source's hits of a phrase are cut to `most` before they meet items, so a
    phrase with many is no burden. Null terms and phrases hit nothing.
    """
    place = F.row_number().over(Window.partitionBy(phrase).orderBy(order))
    few = source.where(F.col(phrase).isNotNull()).withColumn("hit", place).where(F.col("hit") <= most).withColumnRenamed(phrase, "_phrase")
    return lambda term: lambda items: items.withColumn("_phrase", F.col(term)).join(few, "_phrase").drop("_phrase")
