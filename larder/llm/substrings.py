"""Removal of passages that occur earlier in the corpus, by suffix automata of reference shards.

A passage is any window of `window` words. Shards are small: every window has an
anchor, the least hash among its runs of `gram` words (the leftmost of equals),
so equal windows share their anchor, and an anchor's shard is the stretches
around its occurrences. Anchors that occur once are dropped. In a shard, the
stretches stream in order of document and place through the suffix automaton of
the stretches before them; where the matching statistics reach `window` words,
the maximal span is removed. Then the stretch itself joins the automaton.

Automata of the whole corpus cannot be broadcast: they grow with it. So instead
of sending every shard to every document, stretches are sent to the one shard
that can hold their match (see the README). An anchor with more than `most`
occurrences has no automaton: equal stretches, and then the windows of the
different ones, are grouped by their words, and all but the first go, which gives
the same result and splits over tasks.

Words are runs of [^\x20\x09-\x0D], unchanged; equality is of words, not of
hashes. Rows with equal texts are one document for the search: the later ones
lose all words that windows cover, the first keeps them. Documents go by id (null
first), rows of one id as the table has them. Null, empty and short texts keep
everything. An empty table gives an empty result. Extra columns pass through; one
called as a result's column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.scratch import Scratch
from larder.llm.text import WordHashes, gram_hashes, hashed, lean, portions, texts


def anchors(h: np.ndarray, starts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of some documents, from the hashes of their words' runs.

    For each anchor: its document, its place there, and its first and last window.
    """
    span = window - gram + 1
    n = int(starts[-1]) - window + 1
    empty = np.empty(0, np.int64)
    if n <= 0:
        return empty, empty, empty, empty
    low, at = h[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, span):
        less = h[j : j + n] < low
        np.copyto(low, h[j : j + n], where=less)
        at[less] = j
    at += np.arange(n)
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
    # windows that lie in one document
    first = np.repeat(starts[:-1] - np.concatenate(([0], np.cumsum(np.maximum(sizes - window + 1, 0))[:-1])), np.maximum(sizes - window + 1, 0))
    begin = np.arange(len(doc)) + first
    at = at[begin]
    new = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(new[1:], len(at)) - 1
    base = starts[doc[new]]
    return doc[new], at[new] - base, begin[new] - base, begin[last] - base


class Automaton:
    """Suffix automaton over words, built online."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.last = 0

    def add(self, word) -> None:
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        p = self.last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            if self.length[p] + 1 == self.length[q]:
                self.link[cur] = q
            else:
                clone = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(word) == q:
                    self.next[p][word] = clone
                    p = self.link[p]
                self.link[q] = self.link[cur] = clone
        self.last = cur

    def statistics(self, words: list) -> Iterator[int]:
        """For each word, the length of the longest run that ends there and is in the text so far."""
        state = size = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state, size = self.next[state][w], size + 1
            else:
                size = 0
            yield size


def spans(statistics: Iterator[int], window: int) -> list[tuple[int, int]]:
    """Maximal runs of words that matches of at least `window` words cover."""
    out: list[tuple[int, int]] = []
    for i, size in enumerate(statistics):
        if size >= window:
            start = i + 1 - size
            if out and start <= out[-1][1]:
                out[-1] = (min(start, out[-1][0]), i + 1)
            else:
                out.append((start, i + 1))
    return out


def _shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by anchor, document and place -> spans to remove."""
    anchor, seen, automaton, parts = None, set(), None, 0
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for a, row, begin, stretch in zip(*(batch.column(c).to_pylist() for c in ("anchor", "row", "begin", "stretch"))):
            if a != anchor:
                anchor, seen, automaton, parts = a, {stretch}, [stretch], 0
                continue
            if stretch in seen:
                found = [(0, stretch.count(b" ") + 1)]
            else:
                seen.add(stretch)
                if isinstance(automaton, list):
                    first = automaton[0].split(b" ")
                    automaton = Automaton()
                    for w in first:
                        automaton.add(w)
                words = stretch.split(b" ")
                found = spans(automaton.statistics(words), window)
                parts += 1
                automaton.add(parts)
                for w in words:
                    automaton.add(w)
            for s, e in found:
                out[0].append(row)
                out[1].append(begin + s)
                out[2].append(begin + e)
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
                names=["row", "start", "end"],
            )


def remove_repeats(
    documents: DataFrame, *, window: int = 20, gram: int = 6, most: int = 2000, text: str = "text"
) -> DataFrame:
    """Every row with n_words, n_removed and kept: the words left, joined by one space."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    source = F.col(f"doc.`{text}`")
    # each row gets a number that stays, so rows alike in all their columns are told apart
    numbered = scratch.keep(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc")).withColumn("row", F.monotonically_increasing_id()), compression="zstd")
    rows = numbered.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), source.alias("text"), F.md5(F.coalesce(source, F.lit(""))).alias("text_key"))

    @lean
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in portions(batches, "text"):
            words, starts = hashed(texts(batch, "text"), hashes)
            h = gram_hashes(words, gram)
            doc, place, _, _ = anchors(h, starts, window, gram)
            # each anchor once a document, with its number there
            hashed_ = h[starts[doc] + place]
            order = np.lexsort((hashed_, doc))
            doc, hashed_ = doc[order], hashed_[order]
            new = np.flatnonzero(np.concatenate((np.ones(min(1, len(doc)), bool), (np.diff(doc) != 0) | (hashed_[1:] != hashed_[:-1]))))
            times = np.diff(np.append(new, len(doc)))
            offsets = pa.array(np.searchsorted(doc[new], np.arange(batch.num_rows + 1)), pa.int32())
            keys = pa.ListArray.from_arrays(offsets, pa.array(hashed_[new].view(np.int64)))
            at = pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc_id"), batch.column("text_key"), keys, at,
                ],
                names=["row", "doc_id", "text_key", "anchors", "times"],
            )

    found = scratch.keep(rows.mapInArrow(find, "row long, doc_id long, text_key string, anchors array<long>, times array<int>"))
    # the first row of each text stands for it
    firsts = scratch.keep(
        found.groupBy("text_key").agg(F.min(F.struct("doc_id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    )
    occurrences = (
        found.where(F.size("anchors") > 0)
        .join(firsts, "row", "left_semi")
        .select("row", F.explode(F.arrays_zip("anchors", "times")).alias("x"))
        .select("row", F.col("x.anchors").alias("anchor"), F.col("x.times").alias("times"))
    )
    # counted first and joined back: AQE can split the join where one anchor is everywhere
    often = occurrences.groupBy("anchor").agg(F.sum("times").alias("often")).where("often > 1")
    repeated = scratch.keep(
        occurrences.join(often, "anchor")
        .groupBy("row")
        .agg(F.collect_list("anchor").alias("at"), F.collect_list(F.col("often") > most).alias("hot"))
    )
    scratch.drop(found)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches to look up (cold, hot), and spans that repeat within the document and need no look (again)."""
        hashes = WordHashes()
        schema = pa.schema(
            [("row", pa.int64()), ("doc_id", pa.int64()), ("anchor", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("stretch", pa.binary()), ("kind", pa.string())]
        )
        for batch in portions(batches, "text", 1 << 20):
            out: list[list] = [[] for _ in schema]

            def put(*values):
                for column, value in zip(out, values):
                    column.append(value)

            for row, doc, t, known, hot in zip(
                batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch, "text"),
                batch.column("at").to_pylist(), batch.column("hot").to_pylist(),
            ):
                words = t.split()
                h = gram_hashes(hashes.of(words), gram)
                _, pos, first, last = anchors(h, np.array([0, len(words)]), window, gram)
                is_hot, here, again = dict(zip(known, hot)), set(), []
                names = h.view(np.int64)[pos].tolist()
                for anchor, begin, end in zip(names, first.tolist(), (last + window).tolist()):
                    if anchor not in is_hot:
                        continue
                    stretch = b" ".join(words[begin:end])
                    if stretch not in here:
                        here.add(stretch)
                        put(row, doc, anchor, begin, end, stretch, "hot" if is_hot[anchor] else "cold")
                    elif again and begin <= again[-1][1]:
                        again[-1][1] = end
                    else:
                        again.append([begin, end])
                for begin, end in again:
                    put(row, doc, 0, begin, end, None, "again")
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    stretches = scratch.keep(
        rows.join(repeated, "row")
        .select("row", "doc_id", "text", "at", "hot")
        .mapInArrow(cut, "row long, doc_id long, anchor long, begin int, end int, stretch binary, kind string")
    )
    cold = (
        stretches.where("kind = 'cold'")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id", "row", "begin")
        .select("anchor", "row", "begin", "stretch")
        .mapInArrow(lean(lambda batches: _shards(batches, window)), "row long, start int, end int")
    )
    # hot anchors: equal stretches first, then the windows of what is left, the first of each kept
    hot = stretches.where("kind = 'hot'").withColumn("me", F.struct("doc_id", "row", "begin"))
    heads = scratch.keep(hot.groupBy("stretch").agg(F.min("me").alias("first")))
    later = hot.join(heads, "stretch").where("me <> first").select("row", F.col("begin").alias("start"), "end")
    words = F.split(F.col("stretch").cast("string"), " ")
    windows = heads.select("first.*", words.alias("w")).select(
        "doc_id", "row", "begin", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - window + 1), lambda i: F.array_join(F.slice("w", i, window), " "))).alias("k", "g")
    )
    windows = windows.select("g", F.struct("doc_id", "row", (F.col("begin") + F.col("k")).alias("begin")).alias("me"))
    earliest = windows.groupBy("g").agg(F.min("me").alias("first"))
    inner = windows.join(earliest, "g").where("me <> first").select("me.row", F.col("me.begin").alias("start"), (F.col("me.begin") + window).alias("end"))
    again = stretches.where("kind = 'again'").select("row", F.col("begin").alias("start"), "end")
    gone = cold.union(again).union(later).union(inner)
    gone = scratch.keep(gone.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")))
    scratch.keep_only(numbered, firsts, gone)
    whole = (
        numbered.join(firsts.withColumn("is_first", F.lit(True)), "row", "left")
        .join(gone, "row", "left")
        .select("doc", F.col("is_first").isNull().alias("copy"), "spans")
    )

    @lean
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [x or b"" for x in batch.column("doc").field(text).cast(pa.binary()).to_pylist()]
            sizes, removed, kept = [], [], []
            for t, copy, cuts in zip(some, batch.column("copy").to_pylist(), batch.column("spans").to_pylist()):
                words = t.split()
                sizes.append(len(words))
                left = words
                if copy and len(words) >= window:
                    left = []
                elif cuts:
                    left, at = [], 0
                    for c in cuts:
                        left += words[at : max(at, c["start"])]
                        at = max(at, c["end"])
                    left += words[at:]
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc", "n_words", "n_removed", "kept"],
            )

    schema = T.StructType([whole.schema["doc"], *T.StructType.fromDDL("n_words long, n_removed long, kept string").fields])
    added = ("n_words", "n_removed", "kept")
    own = [F.col(f"doc.{c}") for c in documents.columns if c not in added]
    return whole.mapInArrow(keep, schema).select(*own, *added)
