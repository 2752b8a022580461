"""Fill-in-middle transformation: texts cut into prefix, middle and suffix, and put together in another order.

transform() cuts every whole text into units by a Split pre-tokenizer of the
tokenizers library, whose isolated matches supply code-point offsets (nothing is
trained). The offset array's length gives n, and offsets ranked by hashes of the
key give the slices. restore() is the way back, from output and form alone, as a
Spark expression. Spark only maps: one pass over the texts, no shuffle.

Null and empty texts have no units and stay plain, as do texts that contain a
mark. A null key hashes like the seed with nothing behind it. Repeated rows, ties
and extra columns pass through; columns called as the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.text import lean, portions, small_batches

#: A line with its end, or what is left without one.
LINES = r"[^\n]*\n|[^\n]+"
#: Code points that the pre-tokenizer gets at once, as it holds some hundred bytes for each.
BLOCK = 1 << 16
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output")


def unit_ends(splitter, text: str, breaks: str | None = "\n") -> np.ndarray:
    """Code-point offsets at which the units of a text end.

    breaks: a character that ends every unit it is in, at which long texts may be
    cut beforehand; None where the pattern has no such character.
    """
    found, start = [], 0
    while start < len(text):
        stop = len(text)
        if breaks and stop - start > BLOCK:
            cut = text.rfind(breaks, start, start + BLOCK)
            cut = text.find(breaks, start + BLOCK) if cut < 0 else cut
            stop = stop if cut < 0 else cut + 1
        got = splitter.pre_tokenize_str(text[start:stop])
        found.append(np.fromiter((end for _, (_, end) in got), np.int64, len(got)) + start)
        start = stop
    return np.concatenate(found) if found else np.empty(0, np.int64)


def transform(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    pattern: str = LINES,
    breaks: str | None = "\n",
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars (null if plain) and output.

    Of the hash of seed and key, the first two numbers choose the cuts among the
    n + 1 borders of units, the third whether a text is transformed (rate in a
    hundred), the fourth its form (spm in a hundred, else psm). The cuts need the
    pattern to match everywhere; what lies between matches counts as a unit.
    """
    if any(a != b and a in b for a in marks for b in marks) or any(a[k:] and b.startswith(a[k:]) for a in marks for b in marks for k in range(1, len(a))):
        raise ValueError("marks must not overlap, or the way back would not be unique")
    small_batches(df.sparkSession)
    df = df.drop(*OUTPUTS)
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*df.schema.fields, *map(T.StructField, OUTPUTS, kinds)])
    arrow = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    p, s, m = marks

    def cut(splitter, doc, whole: str) -> tuple:
        ends = unit_ends(splitter, whole, breaks)
        n = len(ends)
        h = np.frombuffer(sha256(f"{seed}:{'' if doc is None else doc}".encode()).digest()[:16], ">u4").tolist()
        if not whole or any(x in whole for x in marks) or h[2] % 100 >= rate:
            return n, "plain", None, None, whole
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (int(ends[k - 1]) if k else 0 for k in (a, b))
        prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
        if h[3] % 100 < spm:
            return n, "spm", a, b - a, "".join((s, suffix, p, prefix, m, middle))
        return n, "psm", a, b - a, "".join((p, prefix, s, suffix, m, middle))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        splitter = Split(Regex(pattern), behavior="isolated")
        for batch in portions(batches, text):
            got = [cut(splitter, d, t or "") for d, t in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist())]
            added = [pa.array(c, kind) for c, kind in zip(zip(*got), arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *OUTPUTS])

    return df.mapInArrow(run, schema)


def restore(output: str = "output", form: str = "form", marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that an output was made of; each mark is at its first place, as the text holds none."""
    out, place = F.col(output), [F.instr(F.col(output), x) for x in marks]
    size = [len(x) for x in marks]

    def between(a: int, b: int | None) -> Column:
        start = place[a] + size[a]
        return F.substring(out, start, (F.char_length(out) + 1 if b is None else place[b]) - start)

    psm = F.concat(between(0, 1), between(2, None), between(1, 2))
    spm = F.concat(between(0, 2), between(2, None), between(1, 0))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)
