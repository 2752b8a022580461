"""Exact top-k search by inner product with norm-bucketed retrieval.

Vectors are sorted by length and cut into buckets of near-equal length, which
are packed as matrices. Queries go in blocks, and every block meets the buckets
whose vectors are long enough (a stated query set against all rows; no cross join:
blocks are dealt to the groups of buckets). The longest vectors come first: they
give each query a k-th score to start from. From a query's k-th best score so far
follows the cosine that a bucket's vectors would need (its local threshold, after
Teflioudi and others, LEMP, 2015). Above 1 the bucket is passed over; where it is
low, vectors are pruned by their own length; else by the ranges that the query's
largest coordinates leave to a unit vector. What is left is verified by exact integer
products. Ties go to the smaller id.

Vectors that are null or hold a null or non-finite component take no part.
Vectors meet only vectors of the same dimension. A query's own row, and others
with its id, are no candidates. Of repeated query rows (same id, same vector)
one is answered. Scores beyond 64 bits are held at the bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.prefix import prefix_sums
from larder.llm.scratch import Scratch

BUCKET, BLOCK = 2048, 256
FOCUS = 4


def integers(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, v array<double>): floor(scale * x) of every component; unusable vectors are left out."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.rint(c * scale) + F.when(F.rint(c * scale) > c * scale, -1.0).otherwise(0.0))
    return vectors.where(x.isNotNull() & ~bad).select(F.col(id).cast("long").alias("id"), whole.alias("v"))


def _matrix(rows) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in rows])


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows of one bucket after another -> one row a bucket."""
    held: list = []

    def packed() -> pd.DataFrame:
        m = _matrix([r.v for r in held])
        r = held[0]
        return pd.DataFrame(
            [(r.dim, r.bucket, np.array([x.id for x in held], np.int64).tobytes(), m.tobytes())],
            columns=["dim", "bucket", "ids", "matrix"],
        )

    for frame in frames:
        for r in frame.itertuples(index=False):
            if held and (held[0].dim, held[0].bucket) != (r.dim, r.bucket):
                yield packed()
                held = []
            held.append(r)
    if held:
        yield packed()


def _packed(rows: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """Rows (dim, id, v, length) in buckets of `size`, the longest first, as matrices."""
    placed = prefix_sums(rows.withColumn("_down", -F.col("length")), ["dim"], ["_down", "id"], {"1": "_place"}, scratch)
    placed = placed.withColumn("bucket", F.floor(F.col("_place") / size))
    return (
        placed.select("dim", "bucket", "id", "v", "length")
        .repartition("dim", "bucket")
        .sortWithinPartitions("dim", "bucket", F.col("length").desc(), "id")
        .mapInPandas(_pack, "dim int, bucket long, ids binary, matrix binary")
    )


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products as int64; floats where they hold them, else Python's integers."""
    if not q.size or not m.size:
        return np.zeros((len(q), len(m)), np.int64)
    if np.abs(q).max() * np.abs(m).max() * q.shape[1] < 2.0**53:
        return (q @ m.T).astype(np.int64)
    to_int = np.vectorize(int, otypes=[object])
    exact = to_int(q) @ to_int(m).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _longest(matrix: str, dim: str) -> Column:
    """The greatest length of a packed matrix's rows."""

    @F.pandas_udf("double")
    def longest(m: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([float(np.sqrt((np.frombuffer(x, np.float64).reshape(-1, max(1, n)) ** 2).sum(axis=1)).max(initial=0.0)) for x, n in zip(m, d)], dtype="float64")

    return longest(matrix, dim)


class _Best:
    """The k best of a query block so far. floor: scores that each query's k-th best reaches anyway."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.floor = np.full(n, -np.inf) if floor is None else floor
        self.scores = [np.empty(0, np.int64) for _ in range(n)]
        self.ids = [np.empty(0, np.int64) for _ in range(n)]

    def least(self, i: int) -> float:
        return max(float(self.scores[i][-1]) if len(self.scores[i]) == self.k else -np.inf, float(self.floor[i]))

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, d = np.concatenate([self.scores[i], scores]), np.concatenate([self.ids[i], ids])
        order = np.lexsort((d, -s))[: self.k] if s.size and s.min() > -(1 << 63) else np.array(sorted(range(len(s)), key=lambda j: (-int(s[j]), d[j]))[: self.k], int)
        self.scores[i], self.ids[i] = s[order], d[order]


def _search(best: _Best, q: np.ndarray, q_ids: np.ndarray, m: np.ndarray, ids: np.ndarray) -> None:
    """One bucket for one block of queries."""
    lengths = np.sqrt((m * m).sum(axis=1))
    longest, shortest = lengths.max(initial=0), lengths.min(initial=0)
    unit = m / np.maximum(lengths, 1e-300)[:, None]
    rest = np.arange(len(q))
    q_lengths = np.sqrt((q * q).sum(axis=1))
    slack = 1e-9
    open_, pruned = [], []
    for i in rest:
        least = best.least(i)
        top = q_lengths[i] * longest
        if least > top * (1 + slack) + slack:
            continue
        local = (least / top if top > 0 else -np.inf) - slack  # the cosine a vector of full length needs
        if local <= 0.3 or not np.isfinite(top):
            # hardly any angle is excluded: only lengths can prune
            if local > 0 and least > q_lengths[i] * shortest:
                pruned.append((i, np.flatnonzero(lengths * q_lengths[i] >= least * (1 - slack) - slack)))
            else:
                open_.append(i)
            continue
        keep = np.ones(len(m), bool)
        direction = q[i] / q_lengths[i]
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            a = direction[f]
            wide = np.sqrt(max(0.0, (1 - local * local) * (1 - a * a)))
            low = -1.0 if a < 0 and -a >= local else a * local - wide
            high = 1.0 if a > 0 and a >= local else a * local + wide
            if a <= -local:
                low = -1.0
            keep &= (unit[:, f] >= low - 1e-7) & (unit[:, f] <= high + 1e-7)
        keep &= lengths * q_lengths[i] >= least * (1 - slack) - slack
        pruned.append((i, np.flatnonzero(keep)))
    if open_:
        scores = _products(q[open_], m)
        for i, s in zip(open_, scores):
            _take(best, i, s, ids, q_ids[i])
    for i, at in pruned:
        if len(at):
            _take(best, i, _products(q[i : i + 1], m[at])[0], ids[at], q_ids[i])


def _take(best: _Best, i: int, scores: np.ndarray, ids: np.ndarray, own: int) -> None:
    other = ids != own
    if best.least(i) > -np.inf:
        other &= scores >= best.least(i)
    scores, ids = scores[other], ids[other]
    if len(scores) > 64:
        kth = np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
        near = scores >= kth
        scores, ids = scores[near], ids[near]
    if len(scores):
        best.add(i, scores, ids)


def top_k(candidates: DataFrame, queries: DataFrame, *, k: int = 5, buckets: int = 8, blocks: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score) of integers() tables.

    A task meets `buckets` buckets with `blocks` blocks of queries, so what it
    holds is bounded however many vectors and queries there are.
    """
    spark = candidates.sparkSession
    scratch = Scratch(spark)
    sized = lambda df: df.select(
        F.size("v").alias("dim"), "id", "v", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("length")
    )
    rows = scratch.keep(_packed(sized(candidates), BUCKET, scratch))
    asked = scratch.keep(_packed(sized(queries.dropDuplicates(["id", "v"])), BLOCK, scratch))
    columns = ["dim", "bucket", "ids", "matrix"]

    def unpacked(row, dim: int) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(row.ids, np.int64), np.frombuffer(row.matrix, np.float64).reshape(len(row.ids) // 8, dim)

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Buckets and blocks of queries -> each query's best; a query starts at the score that its k-th best is known to reach."""
        dim, out = int(key[0]), []
        packs = [unpacked(b, dim) for b in left.sort_values("bucket").itertuples(index=False)]
        for block in right.itertuples(index=False):
            q_ids, q = unpacked(block, dim)
            floor = np.frombuffer(block.least, np.float64) if block.least else None
            best = _Best(len(q_ids), k, floor)
            for ids, m in packs:
                _search(best, q, q_ids, m, ids)
            for i, own in enumerate(q_ids):
                name = int(np.frombuffer(_digest(q[i].tobytes()), np.int64)[0])
                out += [(dim, int(block.bucket), i, int(own), name, int(d), int(s)) for s, d in zip(best.scores[i], best.ids[i])]
        return pd.DataFrame(out, columns=["dim", "block", "place", "query_id", "vector", "vec_id", "score"]).astype("int64")

    found = "dim long, block long, place long, query_id long, vector long, vec_id long, score long"
    # first the longest vectors, which bound most queries' k-th best from below
    ahead = F.col("bucket") < buckets
    left = rows.where(ahead).select(*columns, F.lit(0).alias("g"))
    h = -(-max(1, asked.count()) // blocks)
    left = left.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(h - 1))))
    right = asked.select(*columns, F.lit(None).cast("binary").alias("least"), F.lit(0).alias("g"), (F.col("bucket") % h).alias("h"))
    key = ["dim", F.col("g").cast("long").alias("g"), F.col("h").cast("long").alias("h")]
    first = scratch.keep(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, found))

    def bounds(key, best: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        """A block with its queries' k-th scores so far, and the length that a vector needs to reach any of them."""
        out = []
        for row in block.itertuples(index=False):
            _, q = unpacked(row, int(key[0]))
            least = np.full(len(q), -np.inf)
            for place, scores in best.groupby("place")["score"]:
                if len(scores) >= k:
                    least[int(place)] = float(np.sort(scores.to_numpy())[-k])
            size = np.sqrt((q * q).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                needs = np.where(least > 0, least / size, 0.0)
            out.append((row.dim, row.bucket, row.ids, row.matrix, least.tobytes(), float(np.nan_to_num(needs, nan=0.0).min(initial=np.inf))))
        return pd.DataFrame(out, columns=[*columns, "least", "needs"])

    so_far = first.select(F.col("dim").cast("int").alias("dim"), F.col("block").alias("bucket"), "place", "score")
    blocks_ = asked.groupBy("dim", "bucket").cogroup(so_far.groupBy("dim", "bucket"))
    blocks_ = scratch.keep(blocks_.applyInPandas(lambda key, block, best: bounds(key, best, block), "dim int, bucket long, ids binary, matrix binary, least binary, needs double"))
    # the others by length: blocks meet no group whose longest vector is too short for all their queries
    others = scratch.keep(rows.where(~ahead).withColumn("g", F.floor(F.col("bucket") / buckets).cast("long")).withColumn("longest", _longest("matrix", "dim")))
    groups = others.groupBy("dim", "g").agg(F.max("longest").alias("longest"))
    pairs = blocks_.select("dim", "bucket", "needs").join(groups, "dim").where(F.col("needs") <= F.col("longest") * (1 + 1e-9) + 1e-9)
    pairs = scratch.keep(pairs.select("dim", "g", "bucket", F.floor(F.col("bucket") / blocks).alias("h")))
    left = others.join(pairs.select("dim", "g", "h").distinct(), ["dim", "g"]).select(*columns, "g", "h")
    right = blocks_.join(pairs, ["dim", "bucket"])
    # named anew, as both sides have them from the same table
    right = right.select(*[F.col(c).alias(c) for c in (*columns, "least", "g", "h")])
    rest = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, found)
    met = first.union(rest)
    order = Window.partitionBy("query_id", "vector").orderBy(F.col("score").desc(), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def _digest(raw: bytes) -> bytes:
    from xxhash import xxh3_64_digest

    return xxh3_64_digest(raw)
