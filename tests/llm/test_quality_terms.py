"""Terms of texts for the quality classifier against a plain reading of their definition."""

import random
import re

import numpy as np
from xxhash import xxh3_64_intdigest as h

from larder.llm import quality

SIGNS = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def plain(text: bytes) -> dict[int, int]:
    words, found = text.split(), {}
    for w in words:
        for term in (h(w.lower()) % 3072, 3072 + h(re.sub(rb"(?s)(.)\1+", rb"\1", w.translate(SIGNS))[:24]) % 896):
            found[term] = found.get(term, 0) + 1
    n, size, lower = max(1, len(words)), max(1, len(text)), text.lower().split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = sum(text.translate(SIGNS).count(x) for x in (b"a", b"A"))
    shares = [
        len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)), letters / size, text.translate(SIGNS).count(b"A") / max(1, letters),
        sum(map(len, words)) / n / 16, len(lines) / n, np.log2(n) / 16, 4 * sum(48 <= b <= 57 for b in text) / size, sum(a == b for a, b in zip(lower, lower[1:])) / n,
    ]
    for k, x in enumerate(shares):
        found[3968 + k * 8 + min(7, int(min(1.0, x) * 8))] = 1
    return found


def test_terms_as_defined():
    r = random.Random(5)
    words = ["a", "A", "Bb", "bB", "x1", "22", "é", "É", "--", "w" * 100, "W" * 100, "1" * 70] + [f"{r.choice('aAz')}{k}" for k in range(300)]
    some = ["", " ", "\n\n", "a A a A", "a\nA\na\na", "22 22 22"] + ["".join(r.choice(words) + r.choice([" ", "\n", "  ", "\t"]) for _ in range(r.choice([1, 5, 200]))) for _ in range(60)]
    buckets = quality._Buckets()
    for text, (terms, counts) in zip(some, quality.term_counts([t.encode() for t in some], buckets), strict=True):
        assert dict(zip(terms.tolist(), counts.tolist())) == plain(text.encode()), text
    assert max(map(len, buckets)) <= 64


def test_a_shape_is_made_once(monkeypatch):
    calls = []

    class Run:
        def sub(self, by, signs):
            calls.append(signs)
            return re.sub(rb"(?s)(.)\1+", by, signs)

    monkeypatch.setattr(quality, "_RUN", Run())
    list(quality.term_counts([" ".join(f"wort{k:05}" for k in range(20_000)).encode()], quality._Buckets()))
    assert len(calls) == 1
