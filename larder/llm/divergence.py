"""Source divergence audit: how the word use of sources differs within a language.

audit() counts the terms of every whole text in one pass, keeps those of enough
documents, and compares smoothed shares, as integers. Sums over all kept terms
for all pairs of sources are split into heavy and light terms: heavy terms, those
of many sources, go in dense numpy tiles of some hundred terms by two blocks of
sources; a light term only corrects, for the pairs of its few sources, what the
sources' sums against each other's empty share already say. Both parts are exact
integers and are added up.

Work goes by the pairs of sources, which are the result, and by the terms; no
group's rows meet in one task: counts are combined within each task before they
are shuffled, tiles and posting lists are bounded, and ranks cut within tasks.

Null text, language and source read as ''. A row is a document: repeated rows
count as often as they occur. Empty tables give no rows; a language without kept
terms has pairs of value 0. Extra columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch
from larder.llm.text import lean, portions, texts

#: Terms are runs of ASCII letters, lower-cased, and of all other characters from 0x80 on.
_TERMS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Entries that a task gathers before it hands them on.
MOST_ENTRIES = 300_000


def count_terms(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, count, docs; a group's row with the null term counts its documents."""
    plain = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    names = ["lang", "source", "term", "count", "docs"]

    def rows(counts: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for (lang_, source_), found in docs.items():
            terms, k, total = list(found), len(found), counts[lang_, source_]
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.DictionaryArray.from_arrays(pa.array(np.zeros(k, np.int32)), pa.array([x])).cast(pa.string()) for x in (lang_, source_)],
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([total[t] for t in terms], pa.int64()),
                    pa.array(found.values(), pa.int64()),
                ],
                names=names,
            )

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}
        for batch in portions(batches, "text"):
            for group in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts(batch, "text")):
                words = group[2].translate(_TERMS).split()
                counts.setdefault(group[:2], Counter()).update(words)
                docs.setdefault(group[:2], Counter()).update({None, *words})
            if sum(map(len, docs.values())) > MOST_ENTRIES:
                yield from rows(counts, docs)
                counts, docs = {}, {}
        yield from rows(counts, docs)

    found = plain.mapInArrow(run, "lang string, source string, term string, count long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, alpha: int, scale: int) -> str:
    """1 + floor(scale * (count + alpha) / (total + alpha * V)), in decimals, as the product may pass 64 bits."""
    big = lambda e: f"cast({e} as decimal(19, 0))"
    return f"1 + ({big(scale)} * {big(f'{count} + {alpha}')}) div {big(f'{total} + {alpha} * V')}"


def _tile(key: tuple, rows: pd.DataFrame, block: int) -> pd.DataFrame:
    """Each pair of groups' sum over a tile's terms: the difference, less that of two absent terms."""
    absent = rows[rows["term"].isna()].sort_values("g")
    groups = absent["g"].to_numpy()
    place = {g: k for k, g in enumerate(groups)}
    there = rows[rows["term"].notna()]
    codes, terms = pd.factorize(there["term"])
    none = absent["p"].to_numpy(np.int64)
    dense = np.repeat(none[:, None], len(terms), axis=1)
    dense[[place[g] for g in there["g"]], codes] = there["p"].to_numpy(np.int64)
    _, _, bi, bj = key
    first, second = np.flatnonzero(groups // block == bi), np.flatnonzero(groups // block == bj)
    out = []
    for a in first:
        others = second[second > a]
        part = np.abs(dense[others] - dense[a]).sum(axis=1) - len(terms) * np.abs(none[others] - none[a])
        out.append(pd.DataFrame({"lang": key[0], "g": groups[a], "h": groups[others], "part": part}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "g": [], "h": [], "part": []})


def _against_absent(key: tuple, shares: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """Sum over a group's light terms of the distance to each other group's share of an absent term."""
    shares = shares.sort_values("p")
    p, n = shares["p"].to_numpy(np.int64), shares["n"].to_numpy(np.int64)
    upto_n, upto = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * p)])
    x = others["p0"].to_numpy(np.int64)
    at = np.searchsorted(p, x, "right")
    part = x * upto_n[at] - upto[at] + (upto[-1] - upto[at]) - x * (upto_n[-1] - upto_n[at])
    g, h = np.full(len(x), key[1]), others["h"].to_numpy()
    return pd.DataFrame({"lang": key[0], "g": np.minimum(g, h), "h": np.maximum(g, h), "part": part})


def audit(
    df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least: int = 30, alpha: int = 5, scale: int = 10**9, top: int = 50,
    light_share: int = 8, light_most: int = 64, tile_terms: int = 512, block: int = 128,
) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part `pair`: each other source of the language and the sum over kept terms of
    the difference of shares. Part `term`: the `top` terms whose share in the
    source is most above the language's. Ranks go by value downwards, then item.

    A term of more than two and more than a light_share-th of a language's
    sources, or of more than light_most, is heavy; tiles hold about tile_terms
    heavy terms and two blocks of sources. None of these changes the result.
    """
    scratch = Scratch(df.sparkSession)
    counted = scratch.keep(count_terms(df, lang, source, text))
    by_lang = counted.where("term is not null").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("lang_count"), F.count("*").alias("sources")
    )
    kept = scratch.keep(counted.drop("docs").join(by_lang.where(F.col("docs") >= least).drop("docs"), ["lang", "term"]))

    # one row for each group: its number within the language, its size, and the share of a term that it lacks
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    of_lang = kept.groupBy("lang", "term").agg(F.first("lang_count").alias("c")).groupBy("lang").agg(F.count("*").alias("V"), F.sum("c").alias("lang_total"))
    groups = counted.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(of_lang, "lang", "left")
    in_order = Window.partitionBy("lang").orderBy("source")
    groups = groups.fillna(0, ["total", "V", "lang_total"]).select(
        "*", F.count("*").over(Window.partitionBy("lang")).alias("S"), (F.row_number().over(in_order) - 1).alias("g"),
        F.expr(f"if(V = 0, 0, {_share('0', 'total', alpha, scale)})").alias("p0"),
    )
    groups = scratch.keep(groups)

    heavy = (F.col("sources") > F.greatest(F.lit(2), F.col("S") / light_share)) | (F.col("sources") > light_most)
    postings = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "g", "term", "p0", "S", heavy.alias("heavy"),
        F.expr(_share("count", "total", alpha, scale)).alias("p"), F.expr(_share("lang_count", "lang_total", alpha, scale)).alias("q"),
    )
    postings = scratch.keep(postings)
    pairs = _pair_sums(scratch, groups, postings, tile_terms, block)
    names = groups.select("lang", "g", "source")
    pairs = pairs.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    both = pairs.select("lang", "source", "item", "value").union(pairs.select("lang", "item", "source", "value"))
    both = both.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(ranked)}).select(columns)
    over = postings.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).select(columns)
    return both.union(over)


def _pair_sums(scratch: Scratch, groups: DataFrame, postings: DataFrame, tile_terms: int, block: int) -> DataFrame:
    """lang, g < h, value: sums of differences over all kept terms."""
    light = postings.where("not heavy")
    n_light = light.groupBy("lang", "g").agg(F.count("*").alias("n"))
    n_heavy = postings.where("heavy").groupBy("lang", "term").count().groupBy("lang").agg(F.count("*").alias("heavy_terms"))
    sides = groups.join(n_light, ["lang", "g"], "left").join(n_heavy, "lang", "left").fillna(0, ["n", "heavy_terms"])
    sides = scratch.keep(sides.select("lang", "g", "p0", "n", "V", "heavy_terms"))
    left = sides.select("lang", "g", "p0", "n", "V")
    right = sides.select("lang", F.col("g").alias("h"), F.col("p0").alias("p0h"), F.col("n").alias("nh"))
    pairs = left.join(right, "lang")  # every pair of a language's sources is a row of the result
    # as if each light term were in at most one of the two, and each heavy one in neither
    empty = pairs.where("g < h").select("lang", "g", "h", F.expr("(V - n - nh) * abs(p0 - p0h)").alias("part"))
    shares = light.groupBy("lang", "g", "p").agg(F.count("*").alias("n"))
    out = "lang string, g int, h int, part long"
    others = pairs.where("g <> h").select("lang", "g", "h", F.col("p0h").alias("p0"))
    single = shares.groupBy("lang", "g").cogroup(others.groupBy("lang", "g")).applyInPandas(_against_absent, out)

    # at most light_most postings a term, so its pairs are few
    lists = light.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("g", "p", "p0"))).alias("ps"))
    met = lists.where(F.size("ps") > 1).select(
        "lang", F.explode(F.expr("flatten(transform(ps, (a, i) -> transform(slice(ps, i + 2, size(ps)), b -> struct(a, b))))")).alias("x")
    )
    a, b = "x.a", "x.b"
    correction = f"abs({a}.p - {b}.p) - abs({a}.p - {b}.p0) - abs({a}.p0 - {b}.p) + abs({a}.p0 - {b}.p0)"
    met = met.select("lang", F.expr(f"{a}.g").alias("g"), F.expr(f"{b}.g").alias("h"), F.expr(correction).alias("part"))

    # tiles: a posting goes to each pair of blocks that its group is in, with the shares of absent terms
    spread = sides.where("heavy_terms > 0").withColumns({"tiles": F.expr(f"cast(ceil(heavy_terms / {tile_terms}) as int)"), "b": F.expr(f"g div {block}")})
    spread = spread.join(groups.select("lang", "g", F.expr(f"(S - 1) div {block}").alias("last")), ["lang", "g"])
    spread = spread.withColumn("x", F.explode(F.expr("sequence(0, last)")))
    spread = spread.select("lang", "g", "p0", "tiles", F.least("b", "x").alias("bi"), F.greatest("b", "x").alias("bj"))
    absent = spread.select("lang", F.explode(F.expr("sequence(0, tiles - 1)")).alias("tile"), "bi", "bj", "g", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    there = postings.where("heavy").drop("p0").join(spread, ["lang", "g"]).select(
        "lang", F.expr("cast(pmod(xxhash64(term), tiles) as int)").alias("tile"), "bi", "bj", "g", "term", "p"
    )
    dense = absent.union(there).groupBy("lang", "tile", "bi", "bj").applyInPandas(lambda key, rows: _tile(key, rows, block), out)
    parts = empty.union(single).union(met).union(dense)
    return parts.groupBy("lang", "g", "h").agg(F.sum("part").alias("value"))
