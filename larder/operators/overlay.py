"""Nested documents laid over each other, whatever their depth and fields.

Later documents win: maps are merged key by key, and anything else replaces what
was there. Documents are taken apart into paths and values; which of them last is
settled by joins on paths, so neither the number of layers nor a layer's fields
are bounded by a task; only the merged document of a key is put together in one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.keeping import kept


def _leaves(document: str | None) -> Iterator[tuple[list[str], str]]:
    """Paths and values of a JSON object; a map without fields is a value."""
    try:
        found = json.loads(document or "")
    except ValueError:
        return
    todo = [([], found)] if isinstance(found, dict) else []
    while todo:
        path, value = todo.pop()
        if isinstance(value, dict) and value:
            todo += [([*path, k], v) for k, v in value.items()]
        else:
            yield path, json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def paths(documents: DataFrame, key: str, order: str, document: str) -> DataFrame:
    """(key, layer, path, value): a row for each value in a document; layers are in the order of `order`, then of the text."""
    # the digest as bytes: the order of its digits in half the room
    layer = F.struct(F.col(order).alias("order"), F.unhex(F.md5(F.coalesce(document, F.lit("")))).alias("text"))
    df = documents.select(F.col(key).alias("key"), layer.alias("layer"), F.col(document).alias("document"))
    out = T.StructType([df.schema["key"], df.schema["layer"], T.StructField("path", T.ArrayType(T.StringType())), T.StructField("value", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column("document").to_pylist()):
                for x in _leaves(text):
                    rows.append(i)
                    found.append(x)
            at = pa.array(rows, pa.int64())
            columns = [batch.column("key").take(at), batch.column("layer").take(at), pa.array([p for p, _ in found], pa.list_(pa.string())), pa.array([v for _, v in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return df.mapInArrow(run, out)


def overlaid(documents: DataFrame, key: str, order: str, document: str) -> DataFrame:
    """(key, path, value): what the layers of each key come to, by path. Texts that are no JSON object are no layers.

    A value stays if no later layer has one at its path, nothing under its path
    (a map came instead), and none but maps above it.
    """
    # in a struct a null key equals another, so it is a key like others
    found = paths(documents, key, order, document).withColumn("key", F.struct("key"))
    solid = F.max(F.when(F.col("value") != "{}", F.col("layer")))
    last = kept(found.groupBy("key", "path").agg(F.max("layer").alias("layer"), F.max_by("value", "layer").alias("value"), solid.alias("solid")))
    above = F.explode(F.expr("transform(sequence(1, size(path)), n -> slice(path, 1, n - 1))"))
    up = last.where(F.size("path") > 0).select("key", above.alias("path"), "layer", F.col("path").alias("of"))
    # what has come under each path, and, for each path, the last value that was no map above it
    under = up.groupBy("key", "path").agg(F.max("layer").alias("under"))
    over = up.join(last.where("solid is not null").select("key", "path", "solid"), ["key", "path"]).groupBy("key", F.col("of").alias("path")).agg(F.max("solid").alias("over"))
    both = last.join(under, ["key", "path"], "left").join(over, ["key", "path"], "left")
    stays = both.where("(over is null or over < layer) and (value = '{}' or under is null or under < layer)")
    stays = stays.select("key", "path", "value")
    # an empty map is said by what is in it
    full = stays.where(F.size("path") > 0).select("key", above.alias("path"), F.lit("{}").alias("value")).distinct()
    return stays.join(full, ["key", "path", "value"], "left_anti").select("key.key", "path", "value")


def documents(values: DataFrame) -> DataFrame:
    """(key, document): the JSON object of each key's (path, value) rows, its fields in order of their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for values in batch.column("values").to_pylist():
                root: dict = {}
                for x in values:
                    at = root
                    for name in x["path"][:-1]:
                        at = at.setdefault(name, {})
                    if x["path"]:
                        at[x["path"][-1]] = json.loads(x["value"])
                out.append(json.dumps(root, ensure_ascii=False, sort_keys=True, separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.string())], names=["key", "document"])

    listed = values.groupBy("key").agg(F.collect_list(F.struct("path", "value")).alias("values"))
    return listed.mapInArrow(run, T.StructType([listed.schema["key"], T.StructField("document", T.StringType())]))
