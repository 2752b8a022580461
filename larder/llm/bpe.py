"""Byte-level BPE encoding and decoding.

encode() cuts every whole text by the tokenizer's pattern, and merges each piece
within itself. New pieces of a task are gathered, bucketed by length and padded
into numpy matrices of token ids. In each round every row merges its leftmost
pair of minimum rank, found by a hashed pair lookup; rows are then compacted,
and rows without a pair leave. Further pairs of the same rank are merged in the
same round when nothing beside them would come before them, which gives the
same tokens in fewer rounds for very long pieces. Spark only maps: no shuffle,
one pass over the texts, and a bounded piece cache in each task.

Null and empty texts give no tokens. Repeated rows and extra columns pass
through. A column called as the output is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.text import lean, portions, small_batches

#: Cached pieces of a task; a full cache is emptied.
MOST_PIECES = 150_000
#: Cells of one padded matrix, unless one piece is longer.
MOST_CELLS = 1 << 20

NONE = np.int64(1) << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in f if x.strip())}


class PairTable:
    """Open-addressing hash table from a pair of token ids to the rank of their joined bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        bits = max(4, (4 * len(found)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int64)
        keys = np.fromiter(found.keys(), np.int64, len(found))
        values = np.fromiter(found.values(), np.int64, len(found))
        slot, self.probes = self._home(keys), 0
        while len(keys):
            self.probes += 1
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            at = np.flatnonzero(free)[first]
            self.keys[slot[at]], self.values[slot[at]] = keys[at], values[at]
            rest = np.ones(len(keys), bool)
            rest[at] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is none or an id is negative."""
        keys = np.where((left >= 0) & (right >= 0), left * self.size + right, -2)
        out = np.full(keys.shape, NONE, np.int64)
        open_ = np.flatnonzero(keys.ravel() >= 0)
        flat, got = keys.ravel(), out.ravel()
        slot = self._home(flat[open_])
        for _ in range(self.probes):
            here = self.keys[slot]
            hit = here == flat[open_]
            got[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (here != -1)
            open_, slot = open_[on], (slot[on] + 1) & self.mask
            if not len(open_):
                break
        return got.reshape(keys.shape)


class Codec:
    """Encodes pieces and decodes ids by a rank file and a pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.tokens = [b""] * self.pairs.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.cache: dict[str, bytes] = {}

    def _merge(self, m: np.ndarray) -> list[np.ndarray]:
        """Token ids of each row of a padded (-1) matrix."""
        done: list[np.ndarray] = [m[0]] * len(m)
        rows = np.arange(len(m))
        while len(m):
            ranks = self.pairs.rank(m[:, :-1], m[:, 1:]) if m.shape[1] > 1 else np.empty((len(m), 0), np.int64)
            low = ranks.min(axis=1, initial=NONE)
            for i in np.flatnonzero(low == NONE):
                done[rows[i]] = m[i][m[i] >= 0]
            on = low < NONE
            m, rows, ranks, low = m[on], rows[on], ranks[on], low[on]
            if not len(m):
                break
            at = self._places(m, ranks, low)
            r, c = np.nonzero(at)
            m[r, c] = low[r]
            m[r, c + 1] = -1
            # compaction: the kept ids move left
            order = np.argsort(m < 0, axis=1, kind="stable")
            m = np.take_along_axis(m, order, axis=1)
            m = m[:, : max(1, int((m >= 0).sum(axis=1).max()))]
        return done

    def _places(self, m: np.ndarray, ranks: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Where to merge: the leftmost pair of minimum rank, and more of that rank where that is the same."""
        same = ranks == low[:, None]
        first = same.argmax(axis=1)
        at = np.zeros_like(same)
        at[np.arange(len(m)), first] = True
        many = np.flatnonzero(same.sum(axis=1) > 1)
        for i in many if m.shape[1] > 64 else ():
            spots = np.flatnonzero(same[i])
            # from the left, no two that share an id
            run = np.flatnonzero(np.diff(spots, prepend=-2) != 1)
            begin = np.repeat(spots[run], np.diff(np.append(run, len(spots))))
            spots = spots[(spots - begin) % 2 == 0]
            row, new = m[i], low[i]
            left = np.where(spots > 0, row[spots - 1], -1)
            follows = np.isin(spots - 2, spots)
            left = np.where(follows, new, left)
            right = np.append(row, -1)[spots + 2]
            merged = np.full(len(spots), new)
            if min(self.pairs.rank(left, merged).min(), self.pairs.rank(merged, right).min()) > new:
                at[i, spots] = True
        return at

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into the cache, as little-endian 32-bit integers."""
        if len(self.cache) + len(pieces) > MOST_PIECES:
            self.cache.clear()
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.cache[piece] = whole.to_bytes(4, "little")
            else:
                by_length.setdefault(len(raw) if len(raw) <= 24 else 1 << len(raw).bit_length(), []).append((piece, raw))
        for width, some in by_length.items():
            step = max(1, MOST_CELLS // width)
            for k in range(0, len(some), step):
                chunk = some[k : k + step]
                width = max(len(raw) for _, raw in chunk)
                m = np.full((len(chunk), width), -1, np.int64)
                for i, (_, raw) in enumerate(chunk):
                    m[i, : len(raw)] = self.byte[np.frombuffer(raw, np.uint8)]
                if (m[:, 0] < 0).any():
                    raise ValueError("the vocabulary lacks single bytes that the texts hold")
                for (piece, _), ids in zip(chunk, self._merge(m)):
                    self.cache[piece] = ids.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(t) for t in texts]
        new = set().union(*cut) - self.cache.keys() if cut else set()
        if len(self.cache) + len(new) > MOST_PIECES:
            self.cache.clear()
            new = set().union(*cut)
        self.learn(new)
        return [b"".join(map(self.cache.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple, Codec] = {}


class Vocabulary:
    """A broadcast rank file: its size is fixed by the file (50,256 tokens, under 1 MB)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.shared = spark.sparkContext.broadcast(read_ranks(path))

    def codec(self, pattern: str) -> Codec:
        """One codec for each Python worker, vocabulary and pattern."""
        key = (self.path, pattern)
        if key not in _codecs:
            _codecs[key] = Codec(self.shared.value, pattern)
        return _codecs[key]


def _added(df: DataFrame, names: list[str], f) -> DataFrame:
    """df with binary columns computed from batches; what f needs comes first."""
    small_batches(df.sparkSession)
    df = df.drop(*names)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.BinaryType()) for n in names]])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, *columns in f(batches):
            columns = [pa.array(c, pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return df.mapInArrow(run, schema)


def encode(
    df: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add `ids`, the text's token ids as little-endian unsigned 32-bit integers in one binary.

    decoded: a column for the bytes that these ids stand for, from the same pass.
    """

    def run(batches):
        codec = vocabulary.codec(pattern)
        for batch in portions(batches, text):
            got = codec.encode([x or "" for x in batch.column(text).to_pylist()])
            yield (batch, got, map(codec.decode, got)) if decoded else (batch, got)
        codec.cache.clear()

    return _added(df, [ids, decoded] if decoded else [ids], run)


def decode(df: DataFrame, vocabulary: Vocabulary, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`, the bytes that the ids stand for. Null ids give empty bytes."""

    def run(batches):
        codec = vocabulary.codec(pattern)
        for batch in portions(batches, ids):
            yield batch, [codec.decode(x or b"") for x in batch.column(ids).to_pylist()]

    return _added(df, [out], run)


def n_tokens(ids: str = "ids") -> F.Column:
    return (F.octet_length(ids) / 4).cast("long")
