"""Scoring documents by a subword lattice likelihood.

The pieces are those of an existing vocabulary file. A word's lattice holds all
its segmentations; the forward recursion in log space adds them up, each weighed
by the product of its pieces' unigram scores, so a document's score is its
marginal probability and not that of one segmentation. The file has ranks and no
probabilities, so the scores start from the ranks (1 / (rank + 100)) and are
re-estimated on the training documents by expectation maximisation over
all distinct words. The words of the training documents are vocabulary entries
too: a whole word is one more arc, worth its discounted count; the discount's
mass goes to the pieces (each word gives up the same, so each counts once there):

    p(word) = max(0, c - d) / N + d V / N * lattice(word),   p(end) = ends / N

d = n1 / (n1 + 2 n2), from the numbers of words seen once and twice. A word's
pieces end with a stop, so probabilities sum to at most 1.

Words are runs of [^\x20\x09-\x0D] with A-Z in lower case; every document has
one end. Null texts are empty. Rows whose id is null take part, and never train.
The counts of the `head` most frequent words (up to 64 bytes each) are broadcast;
documents meet the other words by a join. With nothing to train on, pieces keep
their first scores. Repeated rows are scored each; extra columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.bpe import read_ranks
from larder.llm.scratch import Scratch
from larder.llm.text import lean, mixed, portions, texts

#: Bytes of the longest blank piece in use; a word holds no longer run of spaces.
BLANK = 16
_P = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces that can stand in a word, with a hash table from their bytes to their number."""

    def __init__(self, ranks: dict[bytes, int]):
        ok = [
            (rank, t)
            for t, rank in ranks.items()
            if (t.strip() or len(t) <= BLANK) and t == t.lower() and t.removeprefix(b" ").split() in ([], [t.removeprefix(b" ")])
        ]
        self.tokens = [t for _, t in sorted(ok)]
        self.lengths = {1, *map(len, self.tokens)}
        self.start = np.array([-math.log(r + 100) for r, _ in sorted(ok)])
        keys = np.array([_hash(np.frombuffer(t, np.uint8)[None])[0] for t in self.tokens], np.uint64)
        bits = (4 * len(keys)).bit_length()
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)
        self.probes = 0
        for k, key in enumerate(keys):
            slot, n = int(key >> self.shift), 1
            while self.values[slot] >= 0:
                slot, n = (slot + 1) & self.mask, n + 1
            self.keys[slot], self.values[slot] = key, k
            self.probes = max(self.probes, n)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes; -1 where there is none."""
        out = np.full(len(keys), -1, np.int64)
        slot = (keys >> self.shift).astype(np.int64)
        left = np.arange(len(keys))
        for _ in range(self.probes):
            there = self.values[slot] >= 0
            hit = there & (self.keys[slot] == keys[left])
            out[left[hit]] = self.values[slot[hit]]
            on = there & ~hit
            left, slot = left[on], (slot[on] + 1) & self.mask
            if not len(left):
                break
        return out

    def arcs(self, m: np.ndarray) -> dict[int, np.ndarray]:
        """By length, the piece that starts at each place of each row (-1: none)."""
        rows, width = m.shape
        wide = m.astype(np.uint64)
        h, out = np.zeros_like(wide), {}
        for n in range(1, min(max(self.lengths), width) + 1):
            h = h[:, : width - n + 1] * _P + (wide[:, n - 1 :] + np.uint64(1))
            if n in self.lengths:
                out[n] = self.find(mixed(h).ravel()).reshape(h.shape)
        return out


def _hash(m: np.ndarray) -> np.ndarray:
    h = np.zeros(len(m), np.uint64)
    for j in range(m.shape[1]):
        h = h * _P + (m[:, j].astype(np.uint64) + np.uint64(1))
    return mixed(h)


def _forward(arcs: dict[int, np.ndarray], scores: np.ndarray, width: int, rows: int) -> np.ndarray:
    """Log of the summed weight of all ways to each place."""
    a = np.full((rows, width + 1), -np.inf)
    a[:, 0] = 0
    for j in range(1, width + 1):
        ways = [a[:, j - n] + scores[arcs[n][:, j - n]] for n in arcs if n <= j]
        a[:, j] = np.logaddexp.reduce(ways, axis=0)
    return a


def _backward(arcs: dict[int, np.ndarray], scores: np.ndarray, width: int, rows: int) -> np.ndarray:
    b = np.full((rows, width + 1), -np.inf)
    b[:, width] = 0
    for i in range(width - 1, -1, -1):
        ways = [scores[arcs[n][:, i]] + b[:, i + n] for n in arcs if i + n <= width]
        b[:, i] = np.logaddexp.reduce(ways, axis=0)
    return b


def _by_length(words: list[bytes], cells: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in `words`, and matrices of their bytes with a space before each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order], prepend=-1))
    for start, stop in zip(cuts, np.append(cuts[1:], len(order))):
        width = int(sizes[order[start]]) + 1
        step = max(1, cells // width)
        for k in range(start, stop, step):
            at = order[k : min(stop, k + step)]
            raw = b"".join(b" " + words[i] for i in at)
            yield at, np.frombuffer(raw, np.uint8).reshape(len(at), width)


def log_likelihoods(words: list[bytes], pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Natural logs of the lattices' marginal probabilities. scores: of each piece, then of the stop."""
    out = np.empty(len(words))
    own = np.append(scores[:-1], -np.inf)
    for at, m in _by_length(words):
        out[at] = _forward(pieces.arcs(m), own, m.shape[1], len(m))[:, -1] + scores[-1]
    return out


def expected_counts(words: list[bytes], weights: np.ndarray, pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, then of the stop."""
    out = np.zeros(len(scores))
    own = np.append(scores[:-1], -np.inf)
    for at, m in _by_length(words):
        rows, width = m.shape
        arcs = pieces.arcs(m)
        a, b = _forward(arcs, own, width, rows), _backward(arcs, own, width, rows)
        whole = a[:, -1]
        for n, ids in arcs.items():
            i, j = np.nonzero(ids >= 0)
            p = np.exp(a[i, j] + own[ids[i, j]] + b[i, j + n] - whole[i]) * weights[at[i]]
            out[:-1] += np.bincount(ids[i, j], p, len(scores) - 1)
        out[-1] += weights[at].sum()
    return out


def _normal(counts: np.ndarray) -> np.ndarray:
    return np.log(counts / counts.sum())


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Larger batches of words: matrices of one length each need many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def score(
    documents: DataFrame,
    train,
    vocabulary: str,
    *,
    rounds: int = 3,
    head: int = 200_000,
    text: str = "text",
) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score) of every row; logs are to base 10.

    train: a condition on the documents that may be learned from.
    base_score is that of a word unigram model with one added to each count.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    rows = documents.select("doc_id", F.coalesce(train, F.lit(False)).alias("trained"), F.col(text).alias("text"))
    pieces = Pieces(read_ranks(vocabulary))
    shared = spark.sparkContext.broadcast(pieces)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        ends = 0

        def rest():
            yield pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        for batch in portions(batches, "text"):
            for t, trained in zip(texts(batch, "text"), batch.column("trained").to_pylist()):
                words = t.lower().split()
                if trained:
                    ends += 1
                    held.update(words)
                else:
                    for w in words:
                        if w not in held:
                            held[w] = 0
            if len(held) > 250_000:
                yield from rest()
        if ends:
            held[b""] = ends  # the end; no word is empty
        yield from rest()

    table = scratch.keep(rows.select("trained", "text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    totals = table.agg(
        F.sum("n"), F.count_if(F.col("n") > 0), F.sum(F.when(F.length("word") == 0, F.col("n"))),
        F.count_if((F.col("n") == 1) & (F.length("word") > 0)), F.count_if((F.col("n") == 2) & (F.length("word") > 0)),
    ).first()
    n_all, v_all, ends, ones, twos = (x or 0 for x in totals)
    v_words = v_all - (ends > 0)
    discount = ones / (ones + 2 * twos) if ones else 0.5
    own_mass = discount * v_words / n_all if n_all else 1.0
    log_end = math.log10(max(ends, 1) / max(n_all, 1))

    scores = np.append(pieces.start, math.log(0.3 / 0.7) + np.logaddexp.reduce(pieces.start))
    scores = scores - np.logaddexp.reduce(scores)
    seen = table.where("n > 0 and length(word) > 0")
    for _ in range(rounds if v_words else 0):
        now = spark.sparkContext.broadcast(scores)

        @lean
        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(now.value))
            for batch in _gathered(batches):
                total += expected_counts(batch.column("word").to_pylist(), np.ones(batch.num_rows), shared.value, now.value)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

        sums = seen.mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(len(scores), 1e-2)
        for r in sums:
            counts[r["piece"]] += r["n"]
        scores = _normal(counts)
        now.destroy()
    final = spark.sparkContext.broadcast(scores)

    @lean
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float)
            inner = log_likelihoods(words, shared.value, final.value)
            whole = np.maximum(0, n - discount) / max(n_all, 1)
            # in logs, as a very long word's lattice is below what a double holds
            with np.errstate(divide="ignore"):
                log_p = np.logaddexp(np.log(whole), inner + math.log(own_mass)) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(log_p)], names=["word", "n", "log_p"])

    valued = scratch.keep(table.where("length(word) > 0").mapInArrow(values, "word binary, n long, log_p double"))
    top = valued.where("length(word) <= 64").orderBy(F.col("n").desc(), "word").limit(head).toArrow()
    top = spark.sparkContext.broadcast(
        (top["word"].to_pylist(), top["n"].to_numpy().astype(np.int64), top["log_p"].to_numpy().astype(float))
    )

    @lean
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, n, log_p = top.value
        number = dict(zip(words_, range(len(words_))))
        seen, plus = n > 0, np.log10(n + 1.0)
        kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))
        for batch in portions(batches, "text"):
            out: list[list] = [[], [], [], [], []]
            for t in texts(batch, "text"):
                words = t.lower().split()
                at = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                here = at[at >= 0]
                rest = Counter(words[i] for i in np.flatnonzero(at < 0))
                for column, x in zip(out, (len(words) + 1, int(seen[here].sum()), float(plus[here].sum()), float(log_p[here].sum()), [{"word": w, "times": k} for w, k in rest.items()])):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("trained"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64()), pa.array(out[4], kind)],
                names=["doc_id", "trained", "n_tokens", "known", "plus", "log_p", "rest"],
            )

    kinds = dict(rows.dtypes)
    partial = rows.mapInArrow(
        known,
        f"doc_id {kinds['doc_id']}, trained boolean, n_tokens long, known long, plus double, log_p double, rest array<struct<word:binary,times:int>>",
    )
    partial = scratch.keep(partial.withColumn("row", F.monotonically_increasing_id()))
    for sent in (shared, final, top):
        sent.destroy()
    tails = (
        partial.select("row", F.explode("rest").alias("x"))
        .select("row", F.col("x.word").alias("word"), F.col("x.times").alias("times"))
        .join(valued.select("word", F.col("n"), F.col("log_p").alias("word_p")), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("tail_plus"),
            F.sum(F.col("times") * F.col("word_p")).alias("tail_p"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    end_plus, denominator = math.log10(ends + 1), math.log10(n_all + v_all + 1)
    return partial.drop("rest").join(tails, "row", "left").select(
        "doc_id",
        "trained",
        "n_tokens",
        (F.col("known") + zero("tail_known") + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("plus") + zero("tail_plus") + end_plus - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("log_p") + zero("tail_p") + log_end).alias("score"),
    )
