"""SentencePiece encoding and decoding of merge-type (BPE) models.

A merge-type encoding has one last token for every prefix of a text. encode()
stores it for each prefix: an automaton finds the pieces that end there, and the
one whose pair with the last token of the prefix before it is compatible is the
prefix's own; ids are then recovered backwards. Two tokens are compatible if,
while both were merged, no pair across their border would have been merged
first. So a text costs its length times the pieces that end at a place, however
long it is.

Spark only maps: no shuffle, one pass over the texts. Texts are cut where no
piece reaches across (before white space, and before signs behind letters), and a
worker remembers the ids of parts in a cache that is emptied when full.

Null and empty texts give no ids. Repeated rows and extra columns pass through. A
column called as an output is replaced.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from larder.llm.text import lean, portions, small_batches

SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Remembered parts of texts and pairs of tokens of a worker.
MOST_PARTS = 300_000
MOST_PAIRS = 300_000
#: Longer parts are encoded anew each time.
LONGEST_PART = 64
#: Rank of a leaf, before every merge, and of a border that no merge closes.
FIRST, NEVER = -1.0, float("inf")


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    got = shift = 0
    while True:
        got |= (raw[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if raw[at - 1] < 128:
            return got, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0
    while at < len(raw):
        tag, at = _varint(raw, at)
        if tag & 7 == 0:
            value, at = _varint(raw, at)
        else:
            n, at = (8, at) if tag & 7 == 1 else (4, at) if tag & 7 == 5 else _varint(raw, at)
            value, at = raw[at : at + n], at + n
        yield tag >> 3, value


def read_model(path: str) -> list[tuple[str, float, int]]:
    """Pieces, scores and kinds of a model file, by id.

    Only what the encoder does is accepted: merges, identity normalisation with a
    dummy prefix, white space kept and escaped, bytes for unknown characters.
    """
    pieces, trainer, normalizer = [], {}, {}
    with open(path, "rb") as f:
        raw = f.read()
    for number, value in _fields(raw):
        if number == 1:
            x = dict(_fields(value))
            pieces.append((x[1].decode(), struct.unpack("<f", x[2])[0] if 2 in x else 0.0, x.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    asked = {
        "merge-type model": trainer.get(3) == 2,
        "byte fallback": trainer.get(35, 0) == 1,
        "white space before words": not trainer.get(24, 0),
        "identity normalisation": not normalizer.get(2) and not normalizer.get(6),
        "dummy prefix": normalizer.get(3, 1) == 1,
        "kept white space": normalizer.get(4, 1) == 0,
        "escaped white space": normalizer.get(5, 1) == 1,
        "no other kinds of pieces": {k for _, _, k in pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE},
    }
    if not all(asked.values()):
        raise ValueError(f"the model lacks: {', '.join(k for k, ok in asked.items() if not ok)}")
    return pieces


def merged(symbols: list[str], ranks: dict[str, float]) -> list[tuple]:
    """Trees of plain merging: the pair of least rank first, of equal ones the leftmost. For short pieces."""
    trees = [(s,) for s in symbols]
    while len(trees) > 1:
        pairs = [(ranks.get(a[0] + b[0], NEVER), k) for k, (a, b) in enumerate(zip(trees, trees[1:]))]
        rank, k = min(pairs)
        if rank == NEVER:
            break
        trees[k : k + 2] = [(trees[k][0] + trees[k + 1][0], trees[k], trees[k + 1])]
    return trees


def _parts_pattern(pieces: Iterable[str]) -> str:
    """A pattern for parts of a text between which no piece reaches.

    Parts begin with white space, with an unknown line break or tab, or with a
    sign behind another character, where no piece holds such a sign there.
    """
    pieces = list(pieces)
    pairs = {x for p in pieces for x in zip(p, p[1:])}
    known = {c for p in pieces for c in p}
    group = lambda chars: re.escape("".join(sorted(chars)))
    alone = group({"\n", "\r", "\t"} - known)
    ways = [f"[{alone}]+"] if alone else []
    if any(b == SPACE != a for a, b in pairs):
        return "|".join([*ways, f"[^{alone}]+" if alone else r"(?s:.)+"])
    letters = {c for c in known if c.isalpha()}
    signs = {c for c in known if not c.isalnum() and c != SPACE} - {b for a, b in pairs if a in letters}
    word, other = f"[{group(letters)}]", f"[^{group(letters)}{SPACE}{alone}]"
    # on from a letter through letters and what may stand behind one, and no further than a sign
    on = rf"(?:{word}++(?:[^{group(letters | signs)}{SPACE}{alone}]{other}*+)?+)*+"
    return "|".join([*ways, rf"(?!\Z){SPACE}*+{other}*+{on}"])


class _Parts(dict):
    """Part -> its ids as 32-bit integers, filled on demand."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        got = array("i", self.encode(part)).tobytes()
        if len(part) <= LONGEST_PART:
            self[part] = got
        return got


class Codec:
    """Encodes texts and decodes ids by a model's pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        import ahocorasick

        self.byte = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.ids = {p: k for k, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        ranks = {p: -pieces[k][1] for p, k in self.ids.items()}
        self.n = len(pieces)
        self.rank = [ranks.get(p, NEVER) if len(p) > 1 else FIRST for p, _, _ in pieces]
        self.left, self.right = [-1] * self.n, [-1] * self.n
        self.sizes = [len(p) for p, _, _ in pieces]
        self.joined: dict[int, float] = {}
        self.pairs: dict[int, bool] = {}
        self.parts = _Parts(self.part)
        self.automaton = ahocorasick.Automaton()
        for piece, k in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    self.joined[a * self.n + b] = ranks[piece]
            trees = merged(list(piece), ranks)
            if len(trees) > 1:
                continue  # merging never makes this piece
            if len(piece) > 1:
                self.left[k], self.right[k] = (self.ids[t[0]] for t in trees[0][1:])
                if max(self.rank[self.left[k]], self.rank[self.right[k]]) > self.rank[k]:
                    raise ValueError(f"{piece!r} is made of pieces that merge after it")
            self.automaton.add_word(piece, k)
        self.automaton.make_automaton()
        self.cut = re.compile(_parts_pattern(self.ids))
        self.raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(SPACE, " ").encode() for p, _, kind in pieces]
        self.control = {k for k, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.spaced = {k for p, k in self.ids.items() if p.startswith(SPACE)}

    def compatible(self, a: int, b: int) -> bool:
        """Whether b may follow a: no merge across their border comes before both are whole."""
        key = a * self.n + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            # an unknown character (-1) or the start is compatible with everything
            known = self.pairs[key] = a < 0 or self._apart(a, b)
        return known

    def _apart(self, a: int, b: int) -> bool:
        # walks back in time: what stood left and right of the border, and when that was merged into more
        until_a = until_b = NEVER
        while True:
            at = self.joined.get(a * self.n + b)
            # of equal ranks the leftmost merges first: a's own merge, then the border's, then b's
            if at is not None and at < until_a and at <= until_b:
                return False
            if self.rank[a] == self.rank[b] == FIRST:
                return True
            if self.rank[a] > self.rank[b]:
                until_a, a = self.rank[a], self.right[a]
            else:
                until_b, b = self.rank[b], self.left[b]

    def part(self, text: str) -> list[int]:
        """Ids of a part, by the last token of each of its prefixes."""
        whole = self.ids.get(text)
        if whole is not None and (len(text) == 1 or self.left[whole] >= 0):
            return [whole]
        # last[k]: the last token of the prefix that ends with character k; last[-1] is the start's
        last = [-1] * (len(text) + 1)
        sizes, pairs, n = self.sizes, self.pairs, self.n
        for end, piece in self.automaton.iter(text):
            if last[end] < 0:
                before = last[end - sizes[piece]]
                fits = pairs.get(before * n + piece)
                if self.compatible(before, piece) if fits is None else fits:
                    last[end] = piece
        ids, end = [], len(text) - 1
        while end >= 0:
            piece = last[end]
            if piece < 0:
                ids.extend(self.byte[x] for x in reversed(text[end].encode()))
                end -= 1
            else:
                ids.append(piece)
                end -= sizes[piece]
        ids.reverse()
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        if not text:
            return b""
        if len(self.parts) > MOST_PARTS:
            self.parts.clear()
        return b"".join(map(self.parts.__getitem__, self.cut.findall(SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: np.ndarray) -> str:
        some = ids.tolist()
        raw = b"".join([self.raw[k] for k in some])
        first = next((k for k in some if k not in self.control), None)
        if first in self.spaced:
            raw = raw[1:]
        return raw.decode("utf-8", "each_byte")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_byte", _each_byte)
_codecs: dict[str, Codec] = {}


class Model:
    """A broadcast model: its size is fixed by the file (32,000 pieces, under 1 MB)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.shared = spark.sparkContext.broadcast(read_model(path))

    def codec(self) -> Codec:
        """One codec for each Python worker and model."""
        if self.path not in _codecs:
            _codecs[self.path] = Codec(self.shared.value)
        codecs.register_error("each_byte", _each_byte)
        return _codecs[self.path]


def _added(df: DataFrame, fields: list[T.StructField], f) -> DataFrame:
    small_batches(df.sparkSession)
    df = df.drop(*[x.name for x in fields])
    schema = T.StructType([*df.schema.fields, *fields])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, *columns in f(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, model: Model, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add `ids`, an array of ids without begin and end.

    decoded: a column for the text that these ids stand for, from the same pass.
    """

    def run(batches):
        codec = model.codec()
        for batch in portions(batches, text):
            got = [np.frombuffer(codec.encode(x or ""), np.int32) for x in batch.column(text).to_pylist()]
            offsets = np.zeros(len(got) + 1, np.int32)
            np.cumsum([len(x) for x in got], out=offsets[1:])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got)))
            yield (batch, lists, pa.array(map(codec.decode, got), pa.string())) if decoded else (batch, lists)

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    return _added(df, fields + [T.StructField(decoded, T.StringType())] if decoded else fields, run)


def decode(df: DataFrame, model: Model, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`, the text that the ids stand for; null ids and ids that are null give nothing."""

    def run(batches):
        codec = model.codec()
        for batch in batches:
            lists = [np.array([k for k in x or () if k is not None], np.int64) for x in batch.column(ids).to_pylist()]
            yield batch, pa.array(map(codec.decode, lists), pa.string())

    return _added(df, [T.StructField(out, T.StringType())], run)
