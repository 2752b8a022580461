"""Tiered matching of new products, and conflicts with what the catalogue says."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import text as t
from larder.operators.keeping import kept


def tiered(new: DataFrame, old: DataFrame, most: int = 5, earlier: bool = False) -> DataFrame:
    """(new_id, old_id, tier, confidence): the first tier that has a match, its `most` first by id.

    Tier 1: equal name, brand and weight. Tier 2: the brand's names that contain
    the name. Tier 3: the brand. Each tier looks only at products that the tier
    before left over; candidates are cut to the first `most` before they meet
    products. With `earlier`,
    only smaller ids than the product's own match; the first `most` are still
    the smallest of those.
    """
    before = F.col("old_id") < F.col("new_id") if earlier else F.lit(True)
    n = new.select(F.col("product_id").alias("new_id"), "product_name", "brand", "weight")
    o = old.select(F.col("product_id").alias("old_id"), "product_name", "brand", "weight")
    alike = Window.partitionBy("product_name", "brand", "weight").orderBy("old_id")
    same = o.withColumn("_r", F.row_number().over(alike)).where(F.col("_r") <= most)
    first = n.join(same, ["product_name", "brand", "weight"]).where(before).select("new_id", "old_id")
    left = n.join(first.select("new_id").distinct(), "new_id", "left_anti")
    names = o.select(F.col("brand").alias("key"), F.col("product_name").alias("text"), "old_id")
    found = containing(left.select(F.col("brand").alias("key"), F.col("product_name").alias("needle")), names, most)
    second = left.join(found, (F.col("brand") == F.col("key")) & (F.col("product_name") == F.col("needle"))).where(before).select("new_id", "old_id")
    left = left.join(second.select("new_id").distinct(), "new_id", "left_anti")
    by_brand = Window.partitionBy("brand").orderBy("old_id")
    any_ = o.withColumn("_r", F.row_number().over(by_brand)).where(F.col("_r") <= most)
    third = left.join(any_.select("brand", "old_id"), "brand").where(before).select("new_id", "old_id")
    tagged = [x.withColumns({"tier": F.lit(k), "confidence": F.lit(c)}) for x, k, c in ((first, 1, 100), (second, 2, 80), (third, 3, 60))]
    all_ = tagged[0].union(tagged[1]).union(tagged[2])
    place = F.row_number().over(Window.partitionBy("new_id").orderBy("old_id"))
    return all_.withColumn("_p", place).where(F.col("_p") <= most).drop("_p")


def _first_holders(needles: list[tuple], most: int):
    """A mapInArrow function: (key, needle, old_id) with the `most` first ids of the texts, (key, text, ids), that hold each needle.

    An automaton of all needles reads each text once. What a task keeps, and hands
    on when it has read all, is bounded by the needles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        places: dict[str, dict] = {}
        for i, (key, needle) in enumerate(needles):
            places.setdefault(needle, {})[key] = i
        for needle, of in places.items():
            automaton.add_word(needle, of)
        automaton.make_automaton()
        first: dict[int, list] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for key, text, ids in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), batch.column("ids").to_pylist()):
                for i in {of[key] for _, of in automaton.iter(text) if key in of}:
                    first[i] = sorted({*first.get(i, ()), *ids})[:most]
        held = list(first.items())
        for k in range(0, len(held), 10_000):
            rows = [(*needles[i], x) for i, ids in held[k : k + 10_000] for x in ids]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), kind))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "needle", "old_id"])

    return run


def containing(needles: DataFrame, texts: DataFrame, most: int, shard: int = 1 << 20) -> DataFrame:
    """(key, needle, old_id): for each (key, needle) the `most` first ids of (key, text, old_id) of that key whose text contains it.

    Distinct needles go in shards of about `shard` characters, by which the
    driver's list and each task's automaton are bounded; each distinct text passes
    once through each shard's automaton. However many texts hold a needle, a task
    hands on `most` ids of it. An empty needle is in every text; nulls are nowhere.
    """
    text = texts.select("key", "text", "old_id").where("key is not null and text is not null").distinct()
    by_text = Window.partitionBy("key", "text").orderBy("old_id")
    few = text.withColumn("_r", F.row_number().over(by_text)).where(F.col("_r") <= most)
    listed = few.groupBy("key", "text").agg(F.sort_array(F.collect_list("old_id")).alias("ids"))
    needles = kept(needles.select("key", "needle").where("key is not null and needle is not null").distinct())
    size = needles.agg(F.sum(F.char_length("needle"))).first()[0] or 0
    shards = -(-size // shard)
    if shards > 1:
        listed = kept(listed)
    asked = needles.where("needle <> ''").withColumn("_shard", F.pmod(F.xxhash64("needle"), F.lit(max(1, shards))))
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("needle", T.StringType()), texts.schema["old_id"]])
    # of an empty needle, the first ids of its key
    by_key = Window.partitionBy("key").orderBy("old_id")
    found = text.select("key", "old_id").distinct().withColumn("_r", F.row_number().over(by_key)).where(F.col("_r") <= most).join(needles.where("needle = ''"), "key").select("key", "needle", "old_id")
    for k in range(shards):
        some = [tuple(r) for r in asked.where(F.col("_shard") == k).select("key", "needle").collect()]
        if some:
            found = found.union(listed.mapInArrow(_first_holders(some, most), schema))
    place = F.row_number().over(Window.partitionBy("key", "needle").orderBy("old_id"))
    return found.distinct().withColumn("_p", place).where(F.col("_p") <= most).drop("_p")


def tiered_wide(new: DataFrame, old: DataFrame, most: int = 5, earlier: bool = False) -> DataFrame:
    """(new_id, old_id, tier, confidence) as tiered, by normalised names and across brands.

    Tier 1: equal signature. Tier 2: the normalised name is in any product's name
    or canonical name, in any case. Tier 3: the brand is in the product's brand.
    """
    before = F.col("old_id") < F.col("new_id") if earlier else F.lit(True)
    low = lambda c: t.strip(F.lower(F.coalesce(F.col(c), F.lit(""))))
    plain = t.name_matched(F.coalesce(F.col("product_name"), F.lit("")))
    signature = F.concat_ws("_", low("brand"), plain, low("weight"))
    n = new.select(F.col("product_id").alias("new_id"), plain.alias("name"), F.lower("brand").alias("brand"), signature.alias("signature"))
    o = old.select(F.col("product_id").alias("old_id"), "product_name", F.lower("brand").alias("brand"), signature.alias("signature"))
    alike = Window.partitionBy("signature").orderBy("old_id")
    same = o.withColumn("_r", F.row_number().over(alike)).where(F.col("_r") <= most).select("signature", "old_id")
    first = n.join(same, "signature").where(before).select("new_id", "old_id")
    left = n.join(first.select("new_id").distinct(), "new_id", "left_anti")
    all_ = F.lit("").alias("key")
    names = o.select(all_, "old_id", F.explode(F.array(F.lower("product_name"), t.name_builder(F.col("product_name")))).alias("text"))
    second = left.join(containing(left.select(all_, F.col("name").alias("needle")), names, most), F.col("name") == F.col("needle")).where(before).select("new_id", "old_id")
    left = left.join(second.select("new_id").distinct(), "new_id", "left_anti").where("brand <> ''")
    brands = o.select(all_, "old_id", F.col("brand").alias("text"))
    third = left.join(containing(left.select(all_, F.col("brand").alias("needle")), brands, most), F.col("brand") == F.col("needle")).where(before).select("new_id", "old_id")
    tagged = [x.withColumns({"tier": F.lit(k), "confidence": F.lit(c)}) for x, k, c in ((first, 1, 100), (second, 2, 80), (third, 3, 60))]
    return tagged[0].union(tagged[1]).union(tagged[2])


def conflicts(offers: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per offer: how many fields conflict, which, whether a person must decide, and the action.

    Prices conflict from more than 10 cents on, and ask from more than 100 cents on.
    """
    old = catalogue.select("product_id", F.col("cents").alias("old_cents"), F.col("brand").alias("old_brand"), F.col("weight").alias("old_weight"))
    diff = F.abs(F.col("cents") - F.col("old_cents"))
    kinds = F.filter(
        F.array(
            F.when(diff > 10, F.lit("price")),
            F.when((F.col("brand") != F.col("old_brand")) & (F.col("brand") != ""), F.lit("brand")),
            F.when(F.col("weight") != F.col("old_weight"), F.lit("weight")),
        ),
        lambda x: x.isNotNull(),
    )
    found = offers.join(old, "product_id").withColumns({"kinds": kinds, "asks": diff > 100})
    action = F.when(F.size("kinds") == 0, "none").when(F.col("asks"), "ask").otherwise("update")
    return found.select("offer_id", "product_id", F.size("kinds").alias("conflicts"), "asks", action.alias("action"), F.array_join("kinds", ",").alias("kinds"))
