"""Order-dependent grouping: greedy overlap filters and fuzzy groups.

A screen's boxes are few by nature, and are folded; a key's texts may be many, and
meet by an index.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.keeping import kept
from larder.operators.similar import candidates


def keep_first_boxes(boxes: DataFrame, screen: str = "screen", order: str = "ord", most: float = 0.5, of: str = "union") -> DataFrame:
    """Boxes of each screen, in order, without those that overlap a kept one by more than `most` of their union.

    of: "union", or "own" for the later box's own area. A fold over the screen's
    sorted boxes; stays on the JVM.
    """
    if of not in ("union", "own"):
        raise ValueError(f"of is union or own, not {of}")
    box = F.struct(order, "x", "y", "w", "h")

    def overlaps(kept, b):
        def covers(k):
            w = F.greatest(F.least(k["x"] + k["w"], b["x"] + b["w"]) - F.greatest(k["x"], b["x"]), F.lit(0))
            h = F.greatest(F.least(k["y"] + k["h"], b["y"] + b["h"]) - F.greatest(k["y"], b["y"]), F.lit(0))
            own = b["w"] * b["h"]
            return w * h > most * (own if of == "own" else k["w"] * k["h"] + own - w * h)

        return F.exists(kept, covers)

    listed = boxes.groupBy(screen).agg(F.array_sort(F.collect_list(box)).alias("all"))
    none = F.filter("all", lambda _: F.lit(False))
    kept = F.aggregate("all", none, lambda acc, b: F.when(overlaps(acc, b), acc).otherwise(F.concat(acc, F.array(b))))
    return listed.select(screen, F.explode(kept).alias("b")).select(screen, "b.*")


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (later, earlier) whose ratio, as difflib has it, is above `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = SequenceMatcher(None)
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("later").to_pylist(), batch.column("earlier").to_pylist()):
                if b != matcher.b:
                    matcher.set_seq2(b)
                matcher.set_seq1(a)
                keep.append(matcher.ratio() > least)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, pairs.schema)


def _not_heads(edges: DataFrame) -> DataFrame:
    """Of (k, later, earlier): texts with an earlier similar text that opens a group.

    A text opens a group if no earlier similar one does. Each round settles the
    texts before which nothing is open, and those similar to them; at least the
    first of all open texts is settled, and few rounds do for all but chains.
    """
    node = lambda c: F.col(c).alias("_node")
    settled = []
    while not edges.isEmpty():
        later = edges.select("k", node("later")).distinct()
        heads = edges.select("k", node("earlier")).distinct().join(later, ["k", "_node"], "left_anti")
        found = kept(edges.join(heads.withColumnRenamed("_node", "earlier"), ["k", "earlier"], "left_semi").select("k", node("later")).distinct())
        settled.append(found)
        for c in ("later", "earlier"):
            edges = edges.join(found.withColumnRenamed("_node", c), ["k", c], "left_anti")
        edges = kept(edges)
    return reduce(DataFrame.union, settled) if settled else edges.select("k", node("later"))


def fuzzy_groups(rows: DataFrame, key: str, text: str, order: str, least: float = 0.9) -> DataFrame:
    """(key, order, text, group): each text joins the first group of its key whose first text is similar, else opens one.

    The similarity is difflib's ratio of lower-cased texts, which Spark lacks. Its
    bounds on lengths and on shared segments choose the pairs to compare, over all
    tasks, also within one key; which texts open groups is then settled by joins.
    Equal texts are compared once. Groups are numbered from 0 in order; texts of
    one place go by themselves, null (as '') before others.
    """
    tagged = rows.select(key, order, text).withColumns({"_k": F.to_json(F.struct(key)), "_low": F.lower(F.coalesce(F.col(text), F.lit("")))})
    first = kept(tagged.groupBy("_k", "_low").agg(F.min(F.struct(order, text)).alias("_at")))
    found = candidates(first, "_k", "_low", least, "ratio").where("levenshtein(a, b, edits) >= 0").select(F.col("_k").alias("k"), "a", "b")
    place = lambda c: first.select(F.col("_k").alias("k"), F.col("_low").alias(c), F.col("_at").alias(f"_{c}"))
    found = found.join(place("a"), ["k", "a"]).join(place("b"), ["k", "b"])
    ahead = F.col("_a") < F.col("_b")
    pairs = found.select("k", F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("later"), F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("earlier"), F.least("_a", "_b").alias("at"))
    edges = kept(_alike(pairs, least))
    members = _not_heads(edges.select("k", "later", "earlier"))
    heads = first.join(members.select(F.col("k").alias("_k"), F.col("_node").alias("_low")), ["_k", "_low"], "left_anti")
    number = F.row_number().over(Window.partitionBy("_k").orderBy("_at")) - 1
    heads = heads.select("_k", "_low", number.cast("long").alias("group"))
    joined = edges.join(heads.select(F.col("_k").alias("k"), F.col("_low").alias("earlier"), "group"), ["k", "earlier"])
    joined = joined.groupBy(F.col("k").alias("_k"), F.col("later").alias("_low")).agg(F.min("group").alias("group"))
    return tagged.join(heads.union(joined), ["_k", "_low"]).select(key, order, text, "group")
