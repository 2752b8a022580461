"""Quality classification by nearest-neighbour voting in a latent-semantic space.

A document becomes a bag of hashed terms in three blocks: lower-cased words,
word shapes ("###", "Aa.", "a$"), and coarse bands of whole-text measures such as
the share of repeated lines. Log counts times inverse document frequency, each
block scaled to a unit vector, are projected onto the leading right singular
vectors of a bounded sample of labelled documents. The sample's projected
vectors are broadcast (at most `sample` rows of `rank` floats, whatever the
input), and every document takes exact blocked cosine products with all of them;
its `neighbours` nearest vote with a power of their cosine, weighed so that a
stratified sample speaks for the labels' real shares.

Document frequencies are counted over all documents. Null or empty texts have
no terms but measures, and are scored like any other. Labels that are null or
belong to no document are left out; of several labels of a document the mean
counts, 0.5 and more as 1. With no usable label every score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from larder.llm.text import lean, portions, small_batches, texts

WORDS, SHAPES, MEASURES = 3072, 896, 128
TERMS = WORDS + SHAPES + MEASURES
STARTS = (0, WORDS, WORDS + SHAPES, TERMS)
#: words that a task remembers, and of how many bytes
MOST_WORDS, LONGEST_WORD = 250_000, 64

_SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


class _Shapes(dict):
    """Translated word -> shape bucket, after runs of a sign are made one."""

    def __missing__(self, signs: bytes) -> int:
        if len(self) > 50_000:
            self.clear()
        got = WORDS + xxh3_64_intdigest(_RUN.sub(rb"\1", signs)[:24]) % SHAPES
        if len(signs) <= LONGEST_WORD:
            self[signs] = got
        return got


class _Buckets(dict):
    """Word -> its word bucket and its shape bucket in one number."""

    def __init__(self) -> None:
        super().__init__()
        self.shapes = _Shapes()

    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_WORDS:
            self.clear()
        got = (xxh3_64_intdigest(word.lower()) % WORDS) * TERMS + self.shapes[word.translate(_SHAPE)]
        if len(word) <= LONGEST_WORD:
            self[word] = got
        return got


def _band(name: int, value: float) -> int:
    """Term of a measure between 0 and 1, in eight bands."""
    return WORDS + SHAPES + name * 8 + min(7, int(value * 8))


def _measures(text: bytes, words: list[bytes], buckets: np.ndarray) -> list[int]:
    """Terms of the whole text's measures; buckets: of its words."""
    n, lines = max(1, len(words)), [x for x in text.split(b"\n") if x.strip()]
    # words that differ by their bucket are not alike in lower case either
    alike = np.flatnonzero(buckets[1:] == buckets[:-1]).tolist()
    size = max(1, len(text))
    signs = text.translate(_SHAPE)
    upper, digits = signs.count(b"A"), signs.count(b"0")
    letters = signs.count(b"a") + upper
    return [
        _band(0, len(set(words)) / n),
        _band(1, 1 - len(set(lines)) / max(1, len(lines))),
        _band(2, letters / size),
        _band(3, upper / max(1, letters)),
        _band(4, min(1.0, sum(map(len, words)) / n / 16)),
        _band(5, min(1.0, len(lines) / n)),
        _band(6, min(1.0, np.log2(n) / 16)),
        _band(8, sum(words[k].lower() == words[k + 1].lower() for k in alike) / n),
        _band(7, min(1.0, 4 * digits / size)),
    ]


def term_counts(some: list[bytes], buckets: _Buckets) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct terms of each text and their counts."""
    for text in some:
        words = text.split()
        both = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
        of_words, of_shapes = np.divmod(both, TERMS)
        counts = np.bincount(np.concatenate([of_words, of_shapes]), minlength=TERMS)
        counts[_measures(text, words, of_words)] += 1
        terms = np.flatnonzero(counts)
        yield terms, counts[terms]


@dataclass
class Model:
    """What is broadcast: sizes are set by TERMS, rank and sample."""

    weights: np.ndarray  # of a term, TERMS
    axes: np.ndarray  # TERMS x rank
    vectors: np.ndarray  # sampled rows x rank, unit length
    labels: np.ndarray  # sampled rows
    votes: np.ndarray  # of a sampled row, by its label's share
    neighbours: int
    power: float

    def project(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.empty((len(bags), self.axes.shape[1]), np.float32)
        for i, (terms, counts) in enumerate(bags):
            out[i] = weighed(terms, counts, self.weights) @ self.axes[terms]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def score(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(bags), 0.5)
        k = min(self.neighbours, len(self.labels))
        out = np.empty(len(bags))
        for start in range(0, len(bags), 128):
            near = self.project(bags[start : start + 128]) @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(near, top, axis=1), 1e-6).astype(np.float64) ** self.power * self.votes[top]
            out[start : start + len(near)] = (w * self.labels[top]).sum(axis=1) / w.sum(axis=1)
        return np.clip(out, 0, 1)


def weighed(terms: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log counts times weights; each block has length 1."""
    v = (np.log1p(counts) * weights[terms]).astype(np.float32)
    cut = np.searchsorted(terms, STARTS)
    for a, b in zip(cut[:-1], cut[1:]):
        v[a:b] /= max(1e-12, np.linalg.norm(v[a:b]))
    return v


def _leading_axes(x: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors scaled as they come, by subspace iteration from a fixed start."""
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)
    for _ in range(5):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :rank])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    sample: int = 4000,
    rank: int = 64,
    neighbours: int = 25,
    power: float = 8.0,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Fit on at most `sample` labelled rows, half of each label where there are enough.

    Rows are taken in the order of a hash of their id, so that reruns agree.
    """
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("_y"))
        .join(documents.select(F.col(doc_id).alias("_id")).distinct(), "_id")
    )
    shares = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    half = sample // 2
    room = {y: max(half, sample - min(half, shares.get(1 - y, 0))) for y in (0, 1)}
    taken = [
        r
        for y in (0, 1)
        for r in known.where(F.col("_y") == y).orderBy(F.xxhash64("_id", F.lit(17)), "_id").limit(room[y]).collect()
    ]
    spark = documents.sparkSession
    chosen = spark.createDataFrame([(r["_id"], r["_y"]) for r in taken], T.StructType(known.schema.fields))

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, df, n = _Buckets(), np.zeros(TERMS, np.int64), 0
        for batch in portions(batches, "text"):
            ys = batch.column("_y").to_pylist()
            ids = batch.column("_id").to_pylist()
            kept = []
            for i, y, (terms, counts) in zip(ids, ys, term_counts(texts(batch, "text"), buckets)):
                df[terms] += 1
                n += 1
                if y is not None:
                    kept.append((i, y, terms, counts))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in kept], pa.int64()),
                        pa.array([k[1] for k in kept], pa.int32()),
                        pa.array([k[2] for k in kept], pa.list_(pa.int64())),
                        pa.array([k[3] for k in kept], pa.list_(pa.int64())),
                    ],
                    names=["id", "y", "terms", "counts"],
                )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n], pa.int64()),
                pa.array([None], pa.int32()),
                pa.array([np.arange(TERMS)], pa.list_(pa.int64())),
                pa.array([df], pa.list_(pa.int64())),
            ],
            names=["id", "y", "terms", "counts"],
        )

    # One pass: the sampled rows' bags, and each task's document frequencies summed by term.
    rows = documents.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen.select(F.col("_id").cast("long").alias("_id"), "_y")), "_id", "left"
    )
    counted = rows.mapInArrow(count, "id long, y int, terms array<long>, counts array<long>")
    return _model(counted, shares, rank, neighbours, power)


def _model(counted: DataFrame, shares: dict, rank: int, neighbours: int, power: float) -> Model:
    from larder.llm.scratch import Scratch

    scratch = Scratch(counted.sparkSession)
    counted = scratch.keep(counted)
    sums = (
        counted.where("y is null")
        .select(F.posexplode("counts").alias("term", "n"))
        .where("n > 0")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    total = counted.where("y is null").agg(F.sum("id")).first()[0] or 0
    first = counted.where("y is not null").groupBy("id").agg(F.min(F.struct("terms", "counts", "y")).alias("bag"))
    bags = [r["bag"] for r in sorted(first.collect(), key=lambda r: r["id"])]
    scratch.drop(counted)
    df = np.zeros(TERMS)
    for r in sums:
        df[r["term"]] = r["n"]
    weights = np.log((total + 1) / (df + 1)) + 0.1
    y = np.array([r["y"] for r in bags], np.float64)
    x = np.zeros((len(bags), TERMS), np.float32)
    for i, r in enumerate(bags):
        terms = np.array(r["terms"], np.int64)
        x[i, terms] = weighed(terms, np.array(r["counts"]), weights)
    axes = _leading_axes(x, rank) if len(bags) else np.zeros((TERMS, 1), np.float32)
    got = x @ axes
    got /= np.maximum(np.linalg.norm(got, axis=1, keepdims=True), 1e-12)
    votes = np.array([shares.get(int(k), 1) / max(1, (y == k).sum()) for k in y])
    return Model(weights, axes, got, y, votes, neighbours, power)


def classify(documents: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score between 0 and 1, higher where label 1 is likelier. Only maps."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop(out)
    schema = T.StructType([*documents.schema.fields, T.StructField(out, T.DoubleType())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, m = _Buckets(), shared.value
        for batch in portions(batches, text):
            scores = m.score(list(term_counts(texts(batch, text), buckets)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, out])

    return documents.mapInArrow(run, schema)
