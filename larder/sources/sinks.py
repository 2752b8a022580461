"""Writing tables: ordered columns, fixed columns, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Named columns first, in their order, then the others."""
    return df.select(*[c for c in first if c in df.columns], *[c for c in df.columns if c not in first])


def reindexed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns; one that is missing is null."""
    return df.select([F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header; nulls are empty fields. Files are as many as partitions, so size follows the data."""
    out = reindexed(df, columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def insert_or_ignore(existing: DataFrame, new: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Rows of `new` to append: keys that are not there, the first of each by `order`."""
    fresh = new.join(existing.select(*key), list(key), "left_anti")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    return fresh.withColumn("_place", place).where("_place = 1").drop("_place")


def latest(rows: DataFrame, key: Sequence[str], *order: str) -> DataFrame:
    """The last write of each key; struct comparison, so a hot key is reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in key and c not in order]
    last = rows.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return last.select(*key, "_r.*").select(*rows.columns)


def upsert(existing: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table with changed rows replaced and new ones added; `changes` has one row a key."""
    return existing.join(changes.select(*key), list(key), "left_anti").unionByName(changes, allowMissingColumns=True)


def update_columns(existing: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Named columns overwritten by key where the change is not null; other rows stay."""
    changed = [c for c in changes.columns if c not in key]
    renamed = changes.select(*key, *[F.col(c).alias(f"_new_{c}") for c in changed])
    joined = existing.join(renamed, list(key), "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in changed else F.col(c) for c in existing.columns])
