import random

import pytest

#: names that the operators use inside
CLASHING = ("row", "c", "n", "gram", "anchor", "size", "copies", "doc", "word", "prefix", "_h", "_n", "_d", "key", "ids", "score", "kept", "text_key")


def make_documents(seed=3, n=60):
    r = random.Random(seed)
    words = ["The", "of", "étude", "naïve", "x1", "Ünder", "!!", "日本", "a", "b"] + [f"w{k}" for k in range(200)]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    passage = text(60)
    rows = []
    base = text(120)
    for k in range(n):
        t = text(r.choice([1, 3, 19, 20, 21, 40, 90]))
        if k % 6 == 0:
            t = text(5) + " " + passage + "\n" + text(7)
        if k % 7 == 0:
            w = base.split()
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = r.choice(words)
            t = "  ".join(w) if k % 2 else " ".join(w)
        rows.append((k, t, f"s{k % 3}"))
    rows += [(n, None, "s0"), (n + 1, "", None), (n + 2, " \n\t ", "s1"), (n + 3, passage, None), (n + 4, base, "s1"), (n + 4, base, "s1")]
    rows += [(n + 5, "la la " * 60, "s2"), (n + 6, "x" * 20000, "s2"), (n + 7, ("lorem ipsum " + passage + " ") * 30, "s0"), (n + 8, "one two three", "s0"), (n + 9, "ONE two\u00a0three", "s0")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def documents(spark, rows):
    """Documents with nulls, blanks, copies, repeated rows and long texts, and columns whose names clash."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({c: F.lit(7) for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="session")
def none(documents):
    return documents.where("false")
