"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash and repeated at most `most` times
over. A copy's virtual finish time is the number of its source's tokens up to
and with it, divided by the source's weight. All copies stand in the order of
these times, and the order is cut at the time at which all sources together,
each served by its weight until it runs out, have used up the total budget. So
a source that runs out ends early, and the others go on in the ratio of their
weights. A copy that the cut goes through is taken if at least half of it lies
before; so each source comes within half a document of its target. (A cut at
the running sum of whole documents would hand a long document that does not fit
to the other sources.) mixed_documents() range-sorts the mix by finish time.

Null sources are a source of their own, the last. Null texts have no tokens.
Rows that are alike in all that orders them are alike in the result. An empty
table, or one without tokens, gives every row zero copies. No group is gathered:
cumulative sums come from ranges of the order, whose totals are carried over, so
a source, or one id, may have any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.prefix import prefix_sums
from larder.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"


def targets(totals: DataFrame, weights: list[float], share: float, most: float, scratch: Scratch) -> tuple[DataFrame, float]:
    """(source, source_size) -> with weight and target; and the virtual time at which the budget is used up.

    Weights go to the sources by code point (null last), repeating. Targets
    share `share` times all tokens by weight; one that would pass `most` times
    its source's size stops there, and the rest is shared anew until none is
    above: one small aggregate a round, at most as many rounds as sources.
    """
    placed = prefix_sums(totals.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], {"1": "_place"}, scratch)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    placed = scratch.keep(placed.select("source", "source_size", pick.alias("weight")))
    budget = share * (placed.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * float(most)
    level = None
    while True:
        full = F.lit(False) if level is None else cap < F.col("weight") * level
        r = placed.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        new = (budget - (r[0] or 0.0)) / r[1] if r[1] else float("inf")
        if new == level or level == float("inf"):
            break
        level = new
    if budget == 0:
        level = 0.0
    return placed.withColumn("target", F.least(cap, F.col("weight") * F.lit(level))), level


def mix(
    documents: DataFrame,
    *,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 0,
    tokens: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, weight, target, finish, copies): copies is how often the mix takes the document.

    finish is the first copy's virtual finish time; each further one comes source_size / weight later.

    tokens: a column with each document's tokens; by default its words are counted.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    size = F.col(tokens) if tokens else F.regexp_count("text", F.lit(WORD))
    keyed = documents.withColumns(
        {
            "size": F.coalesce(size.cast("long"), F.lit(0).cast("long")),
            "_h": F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))),
        }
    )
    # what decides is narrow; texts are not carried through the sorts
    narrow = scratch.keep(keyed.select("source", "doc_id", "size", "_h"))
    totals = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims, level = targets(totals, list(weights), share, most, scratch)
    # ranges of the order, so that neither a source nor the rows of one id meet in one task; rows alike in all else go by their number
    before = prefix_sums(narrow.withColumn("_row", F.monotonically_increasing_id()), ["source"], ["_h", "doc_id", "size", "_row"], {"size": "_before"}, scratch)
    queued = (
        before.join(aims.select(F.col("source").alias("_a"), "source_size", "weight", "target"), F.col("source").eqNullSafe(F.col("_a")))
        .withColumn("_upto", F.col("_before") + F.col("size"))
        .select("source", "doc_id", "size", "source_size", "weight", "target", "_upto")
    )
    middle = F.col("_upto") - F.col("size") / 2
    taken = [((middle + k * F.col("source_size")) / F.col("weight") <= F.lit(level)).cast("int") for k in range(most)]
    return queued.select(
        "doc_id", "source", "size", "source_size", "weight", "target", (F.col("_upto") / F.col("weight")).alias("finish"),
        F.when(F.col("size") > 0, sum(taken)).otherwise(0).alias("copies"),
    )


def mixed_documents(documents: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns, in the order of the mix.

    Rows of one id, source and size take the decisions of such rows in the order of a hash of the row.
    """
    got = mix(documents, **how).where("copies > 0")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    id_, source = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    # a list for each id, source and size: its rows meet by these alone, which the texts are dealt by anyway
    decided = (
        got.groupBy(id_.alias("_d"), source.alias("_s"), F.col("size").alias("_z"))
        .agg(
            F.sort_array(F.collect_list(F.struct("copies", "finish")), asc=False).alias("each"),
            F.first(F.col("source_size") / F.col("weight")).alias("_lap"),
        )
    )
    # by a hash of the whole row, so that reruns agree
    nth = F.row_number().over(Window.partitionBy("_d", "_s", "_z").orderBy(F.xxhash64("doc")))
    numbered = documents.select(
        F.struct(*documents.columns).alias("doc"), id_.alias("_d"), source.alias("_s"), words.alias("_z")
    ).withColumn("_n", nth)
    return (
        numbered.join(decided, ["_d", "_s", "_z"])
        .where(F.col("_n") <= F.size("each"))
        .withColumn("way", F.element_at("each", F.col("_n")))
        .select("doc", "_d", "_lap", "way.finish", F.explode(F.sequence(F.lit(0), F.col("way.copies") - 1)).alias("_k"))
        .withColumn("finish", F.col("finish") + F.col("_k") * F.col("_lap"))
        .repartitionByRange("finish", "_d")
        .sortWithinPartitions("finish", "_d")
        .select("doc.*")
    )
