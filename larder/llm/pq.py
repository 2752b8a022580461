"""Embedding near-dedup by product quantisation.

Equal vectors of a label are one class first. Class vectors, scaled to length 1,
go to the inverted list of their nearest coarse centroid; the residual is coded
in subspaces. Centroids and codebooks are fitted on a bounded sample (at most
`sample` vectors); every row is indexed. A vector probes all lists that can hold
a vector within the distance that the cosine threshold allows, by the triangle
inequality over the list's radius. In a list, asymmetric table-lookup distances
give a lower bound for each code (the distance to the code less the code's own
error), and only what may be near enough is reranked by exact cosine in double
precision. Both bounds are safe, so recall is 1 but for rounding.

A task meets one block of a list (at most BLOCK codes) with one block of the
vectors that probe it, and returns link counts and a spanning forest of the links
found, never all pairs. Vectors that are null, zero or hold null or non-finite
components, and rows without a label, link with nothing. Vectors of different
dimension never link. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import Forest, connected
from larder.llm.scratch import Scratch

BLOCK = 2048


class Index:
    """Coarse centroids and residual codebooks of one dimension."""

    def __init__(self, x: np.ndarray, lists: int, parts: int, words: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.centroids = _k_means(x, lists, r)
        own = _nearest(x, self.centroids)
        rest = x - self.centroids[own]
        cuts = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
        self.cuts = list(zip(cuts[:-1], cuts[1:]))
        self.books = [_k_means(rest[:, a:b], words, r) for a, b in self.cuts]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and each code's distance from what it stands for."""
        rest = x - self.centroids[own]
        codes = np.stack([_nearest(rest[:, a:b], w) for (a, b), w in zip(self.cuts, self.books)], axis=1)
        off = sum(((rest[:, a:b] - w[codes[:, j]]) ** 2).sum(axis=1) for j, ((a, b), w) in enumerate(zip(self.cuts, self.books)))
        return codes.astype(np.uint8), np.sqrt(off)

    def tables(self, q: np.ndarray, list_: int) -> list[np.ndarray]:
        """Squared distances from each query's residual to each codeword, by subspace."""
        rest = q - self.centroids[list_]
        return [_squared(rest[:, a:b], w) for (a, b), w in zip(self.cuts, self.books)]


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None], 0)


def _nearest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.concatenate([_squared(x[i : i + 4096], y).argmin(axis=1) for i in range(0, len(x), 4096)] or [np.empty(0, int)])


def _k_means(x: np.ndarray, k: int, r: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[r.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        own = _nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = 0.93,
    sample: int = 8192,
    lists: int = 64,
    parts: int = 8,
    words: int = 64,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(id, n_links, component_id) of every row: rows of its label linked directly, and the smallest id it reaches."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    kind = dict(vectors.dtypes)[label]

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Unit vectors, and a digest of the vector; both null where the row links with nothing."""
        for batch in batches:
            us, keys = [], []
            for labelled, x in zip(batch.column("label").is_valid().to_pylist(), batch.column("x").to_pylist()):
                x = np.array([np.nan if c is None else c for c in x], np.float64) if labelled and x else np.zeros(1)
                if not np.isfinite(x).all() or not x.any():
                    us.append(None)
                    keys.append(None)
                    continue
                # by the largest component first, so that squares neither overflow nor vanish
                u = x / np.abs(x).max()
                us.append(u / np.sqrt((u * u).sum()))
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(us, pa.list_(pa.float64())), pa.array(keys, pa.binary())],
                names=["vec_id", "label", "u", "key"],
            )

    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x"))
    rows = scratch.keep(rows.mapInArrow(scale, f"vec_id long, label {kind}, u array<double>, key binary"))
    classes = scratch.keep(
        rows.where("u is not null")
        .groupBy("key", "label")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("u").alias("u"))
        .select("key", "rep", "n", "label", "u", F.size("u").alias("dim"), F.monotonically_increasing_id().alias("c"))
    )
    books = {}
    for dim in [r["dim"] for r in classes.select("dim").distinct().collect()]:
        some = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("u")).limit(sample).select("u").collect()
        books[dim] = Index(np.array([r["u"] for r in some]), lists, parts, words)
    shared = spark.sparkContext.broadcast(books)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, g in f.groupby("dim"):
                book, u = shared.value[int(dim)], np.array(g["u"].tolist())
                own = _nearest(u, book.centroids)
                codes, error = book.encode(u, own)
                away = np.sqrt(((u - book.centroids[own]) ** 2).sum(axis=1))
                yield g[["c", "n", "label", "dim", "u"]].assign(list=own, code=[c.tobytes() for c in codes], error=error, away=away)

    indexed = scratch.keep(
        classes.mapInPandas(index, f"c long, n long, label {kind}, dim int, u array<double>, list int, code binary, error double, away double")
    )
    # blocks of a list: salted by a hash, so a list of any size is met in parts
    sizes = indexed.groupBy("label", "dim", "list").agg(F.max("away").alias("radius"), F.count("*").alias("size"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    sizes = scratch.keep(sizes)
    at = ["label", "dim", "list"]
    members = indexed.join(sizes.select(*at, "blocks"), at).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    # every list of the label with its radius: lists * labels rows of a few numbers, grouped by label
    known = sizes.groupBy("label", "dim").agg(F.collect_list(F.struct("list", "radius", "blocks")).alias("lists"))

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for (_, dim), g in f.groupby(["label", "dim"]):
                centroids = shared.value[int(dim)].centroids
                lists_ = g["lists"].iloc[0]
                nos = np.array([x["list"] for x in lists_])
                radius = np.array([x["radius"] for x in lists_])
                blocks = [x["blocks"] for x in lists_]
                u = np.array(g["u"].tolist())
                far = np.sqrt(_squared(u, centroids[nos]))
                i, j = np.nonzero(far <= radius[None] + reach)
                for row, to in zip(i, j):
                    out += [(row_, int(nos[to]), b) for row_ in (g.index[row],) for b in range(blocks[to])]
            if out:
                which = pd.DataFrame(out, columns=["_i", "list", "block"])
                got = f[["label", "dim", "c", "n", "u"]].loc[which["_i"]].reset_index(drop=True)
                yield got.assign(list=which["list"].astype("int32"), block=which["block"].astype("int32"))

    probes = indexed.select("label", "dim", "c", "n", "u").join(known, ["label", "dim"]).mapInPandas(
        probe, f"label {kind}, dim int, c long, n long, u array<double>, list int, block int"
    )
    # the probing side of a block is cut too
    cut = F.pmod(F.xxhash64("c", F.lit(3)), F.lit(1 << 20))
    probes = scratch.keep(probes)
    counts = scratch.keep(probes.groupBy("label", "dim", "list", "block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")))
    on = ["label", "dim", "list", "block"]
    left = members.join(counts, on).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = probes.join(counts, on).withColumn("part", (cut % F.col("parts")).cast("int"))

    def meet(key, members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["c", "other", "n"]
        if not len(members) or not len(asked):
            return pd.DataFrame({k: pd.Series(dtype="int64") for k in columns})
        book, list_ = shared.value[int(key[1])], int(key[2])
        m, q = np.array(members["u"].tolist()), np.array(asked["u"].tolist())
        codes = np.array([np.frombuffer(c, np.uint8) for c in members["code"]])
        error, mult = members["error"].to_numpy(), members["n"].to_numpy()
        mc, qc = members["c"].to_numpy(), asked["c"].to_numpy()
        found = np.zeros(len(q), np.int64)
        forest, edges = Forest(), []
        for start in range(0, len(q), 256):
            part = q[start : start + 256]
            adc = sum(t[:, codes[:, j]] for j, t in enumerate(book.tables(part, list_)))
            i, j = np.nonzero(np.sqrt(adc) <= reach + error[None])
            for k in range(0, len(i), 1 << 16):
                a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                same = ((part[a] * m[b]).sum(axis=1) >= threshold) & (qc[start + a] != mc[b])
                a, b = start + a[same], b[same]
                np.add.at(found, a, mult[b])
                edges += [(int(s), int(t)) for s, t in zip(qc[a], mc[b]) if forest.join(int(s), int(t))]
        rows = [(int(c), int(c), int(n)) for c, n in zip(qc, found) if n] + [(s, t, 0) for s, t in edges]
        return pd.DataFrame(rows, columns=columns).astype("int64")

    by = [*on, "part"]
    links = scratch.keep(
        left.select(*by, "c", "n", "u", "code", "error")
        .groupBy(*by)
        .cogroup(right.select(*by, "c", "u").groupBy(*by))
        .applyInPandas(meet, "c long, other long, n long")
    )
    shared.destroy()
    direct = links.where("c = other").groupBy("c").agg(F.sum("n").alias("links"))
    parts_ = connected(links.where("c <> other").select(F.col("c").alias("a"), F.col("other").alias("b")), scratch)
    placed = classes.join(direct, "c", "left").join(parts_, classes["c"] == parts_["node"], "left")
    placed = placed.withColumn("component", F.coalesce("component", "c"))
    smallest = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    got = (
        placed.join(smallest, "component")
        .select("key", F.col("label").alias("_l"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"), "component_id")
    )
    return rows.select("vec_id", "key", F.col("label").alias("_l")).join(got, ["key", "_l"], "left").select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
    )
