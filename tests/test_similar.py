"""Near texts by segments against all pairs, and fuzzy groups against the plain loop."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from larder.operators import grouping
from larder.operators.similar import candidates, near_names


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def texts(r, n, letters="abcß日 "):
    """Random texts and edited copies of them."""
    out = {"", "a", "ab", "ba"}
    while len(out) < n:
        t = "".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 8, 13, 21])))
        out.add(t)
        for _ in range(r.randrange(4)):
            c = list(t)
            for _ in range(r.randrange(1, 4)):
                at = r.randrange(len(c) + 1)
                c[at : at + r.randrange(2)] = r.choice(["", r.choice(letters)])
            out.add("".join(c))
    return sorted(out)


@pytest.mark.parametrize("least", [0.51, 0.6, 0.75, 0.8, 0.9])
def test_near_names_as_all_pairs(spark, least):
    r = random.Random(4)
    rows = [(k, t) for k in "xy" for t in texts(r, 60)]
    got = {(x["k"], *sorted((x["a"], x["b"]))): x["similarity"] for x in near_names(spark.createDataFrame(rows, "k string, t string"), "k", "t", least).collect()}
    want = {}
    for k, a in rows:
        for j, b in rows:
            if k == j and a < b and a and b:
                share = 1 - levenshtein(a, b) / max(len(a), len(b))
                if share >= least - 1e-12:
                    want[k, a, b] = share
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in got)


def test_too_low_a_share_is_refused(spark):
    df = spark.createDataFrame([("x", "a")], "k string, t string")
    for kind, least in (("distance", 0.5), ("ratio", 0.66)):
        with pytest.raises(ValueError, match="share"):
            candidates(df, "k", "t", least, kind)


def plain_groups(rows, least):
    heads, out = {}, []
    for k, ord_, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1], x[2] is not None, x[2] or "")):
        low = (t or "").lower()
        mine = heads.setdefault(k, [])
        at = next((i for i, h in enumerate(mine) if SequenceMatcher(None, low, h).ratio() > least), None)
        if at is None:
            at = len(mine)
            mine.append(low)
        out.append((k, ord_, t, at))
    return out


@pytest.mark.parametrize("least", [0.7, 0.9])
def test_fuzzy_groups_as_plain_loop(spark, least):
    r = random.Random(8)
    some = texts(r, 150, "abA ß")
    rows = [(r.choice(["p", "q", None]), r.randrange(60), r.choice(some)) for _ in range(300)]
    rows += [("p", 5, None), ("p", 5, ""), (None, 1, "Alpha beta"), (None, 1, "alpha beta"), ("p", 70, "abcabcabc" * 40), ("p", 71, "abcabcabc" * 40 + "d")]
    df = spark.createDataFrame(rows, "k string, o int, t string").withColumns({c: F.lit(1) for c in ("a", "b", "later", "group_")})
    got = grouping.fuzzy_groups(df, "k", "t", "o", least).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_groups(rows, least)))


def test_a_chain_of_similar_texts(spark):
    """Each text is similar to the one before alone, so every other one opens a group."""
    word = "abcdefghijklmnopqrst"
    rows = [("p", k, word[k:] + word[:k].upper() * 0 + "0123456789ABCDEFGHIJ"[:k]) for k in range(12)]
    got = grouping.fuzzy_groups(spark.createDataFrame(rows, "k string, o int, t string"), "k", "t", "o").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_groups(rows, 0.9)))


@pytest.mark.parametrize(("words", "share"), [("'Bio'", 0.002), ("if(id % 3 = 0, 'Bio Milch', 'Joghurt mild')", 0.25)])
def test_one_key_of_many_names(spark, words, share):
    """Compared pairs are few beside all pairs, and a large key is no single task."""
    name = F.concat_ws(" ", F.expr(words), F.substring(F.md5(F.expr("cast(id div 2 as string)")), 1, 14))
    df = spark.range(10_000).select(F.lit("p").alias("k"), "id", F.concat(name, F.expr("if(id % 2 = 0, '', '!')")).alias("t")).repartition(8)
    assert candidates(df.select("k", F.lower("t").alias("t")), "k", "t", 0.9, "ratio").count() < share * 5 * 10**7
    if words == "'Bio'":
        got = grouping.fuzzy_groups(df, "k", "t", "id").groupBy("group").count()
        assert got.agg(F.count("*"), F.sum("count")).first() == (5_000, 10_000)
