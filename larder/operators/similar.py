"""Joins of texts that are nearly alike, by segments.

If at most k edits make one text of another, and the shorter one is cut into m
segments, at least m - k of them are untouched: they stand in the other text,
moved by no more than the edits allow. So of any k + 1 segments one is found
there, and each text sends its k + 1 rarest: words that many texts have in common
bring none together. Texts meet by equal segments, in an equi join, and only those
that meet are compared. Nothing is lost, whatever the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: How far texts of lengths l <= L may be apart, as SQL: the greatest number of edits, the greatest L of an l, the least l of an L.
KINDS = {
    # 1 - levenshtein / L >= least
    "distance": ("cast(floor((1 - {s}) * {L} + 1e-9) as int)", "cast(floor({l} / {s} + 1e-9) as int)", "cast(ceil({L} * {s} - 1e-9) as int)"),
    # 2 * matched / (l + L) > least, where matched characters are a common subsequence: insertions and deletions
    "ratio": ("cast(ceil((1 - {s}) * ({l} + {L}) - 1e-9) - 1 as int)", "cast(floor({l} * (2 - {s}) / {s} + 1e-9) as int)", "cast(ceil({L} * {s} / (2 - {s}) - 1e-9) as int)"),
}


def candidates(texts: DataFrame, key: str, text: str, least: float, kind: str = "distance") -> DataFrame:
    """(key, a, b, edits): distinct pairs of one key's texts that share a segment; a is the shorter, or the lesser of equal length.

    texts: distinct (key, text), without nulls. least: above 1/2, or 2/3 for
    "ratio", as segments would be empty below. Empty texts are in no pair.
    """
    if least <= {"distance": 1 / 2, "ratio": 2 / 3}[kind]:
        raise ValueError(f"{kind} {least} leaves nothing that both texts must share")
    most, longest, shortest = (x.replace("{s}", repr(float(least))) for x in KINDS[kind])
    k = most.replace("{l}", "_l").replace("{L}", "_L2")
    if kind == "ratio":  # insertions less deletions are the difference of lengths
        k = f"({k}) - pmod(({k}) - _L2 + _l, 2)"
    rows = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text <> ''").withColumn("_size", F.char_length("_text"))

    def cut(df: DataFrame) -> DataFrame:
        """One row for each segment of a shorter text of length _l that is to meet texts of length _L2."""
        df = df.withColumn("_k", F.expr(k)).where("_k > 0 and _k >= _L2 - _l")
        df = df.withColumn("_m", F.expr("greatest(_k + 1, least(2 * _k + 1, _l div 3))")).withColumn("_i", F.explode(F.expr("sequence(0, _m - 1)")))
        # segment _i begins at _i * _l div _m and ends before (_i + 1) * _l div _m
        return df.withColumns({"_at": F.expr("_i * _l div _m"), "_n": F.expr("(_i + 1) * _l div _m - _i * _l div _m")})

    lengths = F.explode(F.expr(f"sequence(_size, {longest.replace('{l}', '_size')})"))
    short = cut(rows.withColumn("_l", F.col("_size")).withColumn("_L2", lengths))
    short = short.withColumn("_segment", F.expr("substring(_text, cast(_at + 1 as int), cast(_n as int))"))
    often = F.count("*").over(Window.partitionBy("_key", "_l", "_L2", "_i", "_segment"))
    rare = F.row_number().over(Window.partitionBy("_key", "_text", "_L2").orderBy("_often", "_i"))
    short = short.withColumn("_often", often).withColumn("_r", rare).where("_r <= _k + 1")
    short = short.select("_key", "_l", "_L2", "_i", "_segment", F.col("_text").alias("_a"))
    long = cut(rows.withColumn("_L2", F.col("_size")).withColumn("_l", F.explode(F.expr(f"sequence(greatest(1, {shortest.replace('{L}', '_size')}), _size)"))))
    first, last = "greatest(0, _at - (_k - _L2 + _l) div 2)", "least(_L2 - _n, _at + (_k + _L2 - _l) div 2)"
    # a window may be empty, and equal pieces of one window need not be sent twice
    pieces = f"if({first} > {last}, array(), array_distinct(transform(sequence({first}, greatest({first}, {last})), q -> substring(_text, cast(q + 1 as int), cast(_n as int)))))"
    long = long.select("_key", "_l", "_L2", "_i", F.explode(F.expr(pieces)).alias("_segment"), F.col("_text").alias("_b"), "_k")
    # Spark does not count what explode adds, and might broadcast either side
    met = short.hint("merge").join(long, ["_key", "_l", "_L2", "_i", "_segment"]).where("_L2 > _l or _a < _b")
    return met.select(F.col("_key").alias(key), F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_k").cast("int").alias("edits")).distinct()


def near_names(texts: DataFrame, key: str, text: str, least: float) -> DataFrame:
    """(key, a, b, similarity): pairs of a key's texts whose edit distance is at most 1 - least of the longer's length."""
    far = F.expr("levenshtein(a, b, edits)")
    found = candidates(texts, key, text, least).withColumn("_d", far).where("_d >= 0")
    share = 1 - F.col("_d") / F.greatest(F.char_length("a"), F.char_length("b"))
    return found.select(key, "a", "b", share.alias("similarity"))
