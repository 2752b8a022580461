r"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Each
window has the conversation's system turn (its first turn, if a system's), then
as many turns before the span as fit in `history` tokens, then the span, as long
as the whole stays within `budget` tokens or the span is one turn. Only
assistant turns of the span are targets; what a window repeats is masked.

Template: `<turn ROLE>TEXT</turn>` and a newline. In roles and texts a backslash
stands before each backslash, after `<` where `turn` or `/turn` follows, and
before `>` in a role; taking away one backslash before each character restores
the text, and no text can hold a control string.

A long conversation is dealt out: its prefix sums come from range partitions and
their totals, stretches of `stretch` tokens are windowed apart from each other, and the turns
that the next stretch may repeat go along to it. So no task gathers a whole
conversation, and a window never spans two stretches.

Null texts and roles are empty. Turns go by number (null first), then role and
text. Rows with a null conversation id form one conversation. An empty table
gives no windows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.prefix import prefix_sums

OPEN, CLOSE = "<turn", "</turn>"
_CONTROL = re.compile(r"<(?=/?turn)")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^>\\]|\\.)*)>(.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its escaped text begins and ends."""
    head = f"{OPEN} {escape(role).replace('>', chr(92) + '>')}>"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted window; start and end bound the escaped text."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(formatted)]


WINDOW = (
    "conv_id long, stretch long, window long, first_turn long, n_new int, n_repeated int, n_tokens long, "
    "formatted string, loss array<struct<start:int,end:int>>"
)


def windows(
    conversations: DataFrame, *, budget: int = 2048, history: int = 256, stretch: int = 65536
) -> DataFrame:
    """Formatted windows of (conv_id, turn, role, text) rows.

    `loss` lists the code point ranges of `formatted` that are targets; `n_repeated`
    leading turns are context. (conv_id, stretch, window) orders a conversation's windows.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tokens", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 4)
    turns = turns.withColumn("tie", F.md5("text"))
    # stretches: a turn belongs where it starts
    at = prefix_sums(turns, ["conv_id"], ["turn", "role", "tie"], {"tokens": "before", "1": "place"})
    at = at.withColumn("stretch", F.floor(F.col("before") / stretch))
    system = (
        at.where((F.col("place") == 0) & (F.col("role") == "system"))
        .select("conv_id", F.col("text").alias("system_text"), F.col("tokens").alias("system_tokens"))
    )
    goes_on = F.col("before") >= (F.col("stretch") + 1) * stretch - history
    dealt = at.withColumn(
        "to", F.explode(F.when(goes_on, F.array("stretch", F.col("stretch") + 1)).otherwise(F.array("stretch")))
    ).withColumn("ahead", F.col("to") > F.col("stretch"))
    # stretches past the first repeat the system turn: one row for each of them, not one for each turn
    later = (
        dealt.where("to > 0 and not ahead")
        .select("conv_id", "to")
        .distinct()
        .join(system, "conv_id")
        .select(
            "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("system").alias("role"),
            F.col("system_text").alias("text"), F.col("system_tokens").alias("tokens"),
            F.lit(-1).cast("long").alias("place"), "to", F.lit(True).alias("ahead"),
        )
    )
    rows = dealt.select("conv_id", "turn", "role", "text", "tokens", "place", "to", "ahead").union(later)

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, made = [], 0
        key = None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if (r.known, r.conv_id, r.to) != key:
                    if key is not None:
                        out += open_.close()
                    key, open_ = (r.known, r.conv_id, r.to), _Stretch(r.known and r.conv_id, r.to, budget, history)
                out += open_.add(r)
                made += len(r.text)
                if made > 4 << 20:
                    yield _frame(out)
                    out, made = [], 0
        if key is not None:
            out += open_.close()
        if out:
            yield _frame(out)

    return (
        rows.withColumns({"known": F.col("conv_id").isNotNull(), "turn": F.coalesce("turn", F.lit(-1))})
        .withColumn("conv_id", F.coalesce("conv_id", F.lit(0).cast("long")))
        .repartition("known", "conv_id", "to")
        .sortWithinPartitions("known", "conv_id", "to", "place")
        .mapInPandas(build, WINDOW)
    )


class _Stretch:
    """Windows of one stretch, made as its turns come in."""

    def __init__(self, conv_id, number: int, budget: int, history: int):
        self.conv_id = None if conv_id is False else int(conv_id)
        self.number, self.budget, self.history = int(number), budget, history
        self.system = None
        self.recent: list = []  # turns that may be repeated
        self.span: list = []
        self.context: list = []
        self.made = 0

    def add(self, r) -> list:
        turn = (int(r.turn), r.role, r.text, int(r.tokens))
        if r.ahead:
            if r.place == -1:
                self.system = turn
            elif not (r.place == 0 and r.role == "system"):
                self.recent.append(turn)
            return []
        out = []
        if self.span and self._size(self.context) + sum(t[3] for t in self.span) + turn[3] > self.budget:
            out = self._window()
        if not self.span:
            self.context = self._history(turn[3])
        self.span.append(turn)
        if r.place == 0 and r.role == "system":
            self.first_system = turn
        return out

    first_system = None

    def _size(self, some: list) -> int:
        return sum(t[3] for t in some)

    def _history(self, coming: int) -> list:
        head = [self.system] if self.system else []
        room = min(self.history, self.budget - coming - self._size(head))
        tail: list = []
        for t in reversed(self.recent):
            room -= t[3]
            if room < 0:
                break
            tail.insert(0, t)
        return head + tail

    def _window(self) -> list:
        text, loss, at = [], [], 0
        for k, (_, role, body, _) in enumerate(self.context + self.span):
            piece, a, b = render(role, body)
            if role == "assistant" and k >= len(self.context):
                loss.append({"start": at + a, "end": at + b})
            text.append(piece)
            at += len(piece)
        row = (
            self.conv_id, self.number, self.made, self.span[0][0], len(self.span), len(self.context),
            self._size(self.context) + self._size(self.span), "".join(text), loss,
        )
        self.made += 1
        if self.first_system and not self.system:
            self.system = self.first_system
        kept, room = [], self.history
        for t in reversed(self.recent + [t for t in self.span if t is not self.system]):
            room -= t[3]
            if room < 0:
                break
            kept.insert(0, t)
        self.recent, self.span, self.context = kept, [], []
        return [row]

    def close(self) -> list:
        return self._window() if self.span else []


def _frame(rows: list) -> pd.DataFrame:
    names = [x.split()[0] for x in WINDOW.split(", loss")[0].split(", ")] + ["loss"]
    frame = pd.DataFrame(rows, columns=names)
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
)


def digests(formatted: DataFrame) -> DataFrame:
    """Read windows back: turns and targets of each conversation, hashed in order.

    A hash over a conversation needs its windows one after another, so they are
    sorted and streamed; a task keeps only the running hashes.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, out = None, []
        state = None

        def end():
            out.append(
                (key[1] if key[0] else None, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])
            )

        for frame in frames:
            for r in frame.itertuples(index=False):
                now = (bool(r.known), int(r.conv_id))
                if now != key:
                    if key is not None:
                        end()
                    key, state = now, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                turns = parse(r.formatted)[r.n_repeated :]
                for role, text, _, _ in turns:
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in r.loss:
                    got = unescape(r.formatted[span["start"] : span["end"]])
                    state[2] += len(got)
                    state[3].update(got.encode())
                state[0] += len(turns)
                state[4] += len(r.formatted)
                state[5] += 1
            if out:
                yield _digest_frame(out)
                out = []
        if key is not None:
            end()
            yield _digest_frame(out)

    return (
        formatted.select("conv_id", "stretch", "window", "formatted", "loss", "n_repeated")
        .withColumn("known", F.col("conv_id").isNotNull())
        .withColumn("conv_id", F.coalesce("conv_id", F.lit(0).cast("long")))
        .repartition("known", "conv_id")
        .sortWithinPartitions("known", "conv_id", "stretch", "window")
        .mapInPandas(read, DIGEST)
    )


def _digest_frame(rows: list) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[x.split()[0] for x in DIGEST.split(", ")])
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame
