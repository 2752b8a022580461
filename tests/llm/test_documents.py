"""Operators over documents against plain Python on a small fixture."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from larder.llm import bpe, jaccard, lattice, mixing, quality, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


# mixing


def test_mix_targets_and_copies(documents, rows):
    got = mixing.mix(documents).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    target, full = {}, set()
    while True:
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and 2 * sizes[s] < weight[s] * level}
        if not over:
            break
        full |= over
    target = {s: 2 * sizes[s] if s in full else weight[s] * level for s in order}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["copies"] in (0, 1, 2) and (r["size"] or not r["copies"])
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _, _ in rows)
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(documents.repartition(7)).collect()
    key = lambda r: (r["doc_id"] or 0, r["size"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_repeat_rows(documents, rows):
    plain = documents.select("doc_id", "text", "source", "row")
    got = Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(plain).collect())
    want = Counter()
    text = {(d, len(words(t)), s): t for d, t, s in rows}
    for r in mixing.mix(plain).collect():
        want[(r["doc_id"], text[(r["doc_id"], r["size"], r["source"])])] += r["copies"]
    assert got == +want


def test_mix_empty(none):
    assert mixing.mix(none).collect() == []


# byte-level BPE


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_bpe_as_library(documents, rows, vocabulary):
    ranks = bpe.read_ranks(vocabulary.path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = bpe.encode(documents, vocabulary, public_tokenizers.PATTERN)
    got = bpe.decode(ids, vocabulary, public_tokenizers.PATTERN).select("text", "ids", "decoded", bpe.n_tokens().alias("k"), "row").collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode_ordinary(r["text"] or "")
        assert list(memoryview(bytes(r["ids"])).cast("I")) == want and r["k"] == len(want)
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["row"] == 7


@pytest.mark.parametrize("text", ["a" * 4000, "ab" * 2000 + "é" * 300, " " * 900, "\n\n \t x", "١٢٣ ½ Ⅷ", "日本語" * 300, "aab" * 700, "\x1c\x85\u2003x"])
def test_bpe_long_and_odd_pieces(text):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    assert list(memoryview(codec.encode([text])[0]).cast("I")) == library.encode_ordinary(text)


def test_bpe_empty(none, vocabulary):
    assert bpe.decode(bpe.encode(none, vocabulary, public_tokenizers.PATTERN), vocabulary, public_tokenizers.PATTERN).collect() == []


# lattice


def _segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in _segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def test_lattice_sums_all_segmentations():
    import numpy as np

    pieces = lattice.Pieces(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    scores = np.append(pieces.start, 0.0)
    scores = scores - np.logaddexp.reduce(scores)
    number = {t: k for k, t in enumerate(pieces.tokens)}
    some = [b"then", b"a", "été".encode(), b"ingly", b"xq"]
    got = lattice.log_likelihoods(some, pieces, scores)
    for w, x in zip(some, got):
        ways = list(_segmentations(b" " + w, number))
        want = math.log(sum(math.exp(sum(scores[number[p]] for p in way)) for way in ways)) + scores[-1]
        assert x == pytest.approx(want)
    counts = lattice.expected_counts(some, np.ones(len(some)), pieces, scores)
    assert counts[-1] == len(some)
    covered = sum(counts[k] * len(t) for t, k in number.items())
    assert covered == pytest.approx(sum(len(w) + 1 for w in some))


@pytest.mark.parametrize("head", [5, 200_000])
def test_scores_against_brute_force(documents, rows, head):
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = lattice.score(documents, train, vocabulary, head=head).collect()
    trained = lambda d: zlib.crc32(str(d).encode()) % 7 != 2
    counts = Counter()
    for d, t, _ in rows:
        if trained(d):
            counts.update(w.translate(AZ) for w in words(t))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    want = defaultdict(list)
    for d, t, _ in rows:
        tokens = [w.translate(AZ) for w in words(t)] + [None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want[d].append((len(tokens), sum(counts[w] > 0 for w in tokens), base))
    for r in got:
        k, known, base = want[r["doc_id"]][0]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["trained"]) == (k, known, n, trained(r["doc_id"]))
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0 and math.isfinite(r["score"])
    assert len(got) == len(rows)


def test_scores_do_not_depend_on_the_head(documents):
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    one, two = (
        {(r["doc_id"], r["n_tokens"]): r["score"] for r in lattice.score(documents, F.col("doc_id") > 5, vocabulary, head=h).collect()} for h in (3, 1000)
    )
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)


def test_scores_without_training(documents, none):
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert all(math.isfinite(r["score"]) for r in lattice.score(documents, F.lit(False), vocabulary).collect())
    assert lattice.score(none, F.lit(True), vocabulary).collect() == []


# n-gram Jaccard join


def _components(rows):
    sets = []
    for _, t, _ in rows:
        w = [x.translate(AZ) for x in words(t)]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = defaultdict(list)
    for k, r in enumerate(rows):
        least[root(k)].append(r[0])
    return sorted((rows[k][0], len(sets[k]), min(least[root(k)])) for k in range(len(rows)))


@pytest.mark.parametrize("hot, rounds, hubs, fragments", [(1, 0, 1, 1), (40, 1, 1, 5), (500_000, 4, 8, 4)])
def test_jaccard_components(documents, rows, hot, rounds, hubs, fragments):
    got = jaccard.near_duplicates(documents, hot=hot, rounds=rounds, hubs=hubs, fragments=fragments)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == _components(rows)


def test_jaccard_chain_of_near_copies(spark):
    """Neighbours link, ends do not: one component, and no pair of the group is needed twice."""
    base = [f"t{k}" for k in range(100)]
    rows = []
    for k in range(40):
        w = list(base)
        for j in range(k):
            w[j * 2] = f"u{j}"
        rows.append((1000 - k, " ".join(w), "s"))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == _components(rows)


def test_jaccard_group_of_near_copies(spark):
    """Copies with edits of their own, some too far from most others, and a text that all contain."""
    import random

    r = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(300):
        w = list(base)
        for _ in range(r.randrange(7)):
            at = r.randrange(len(w))
            w[at : at + 1] = r.choice([[f"e{k}"], [], [f"e{k}", f"f{k}"]])
        rows.append((k, " ".join(w + [f"g{k}_{j}" for j in range(r.choice([0, 0, 30]))]), "s"))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    want = _components(rows)
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got.collect()) == want
    assert len({c for _, _, c in want}) > 10


def test_jaccard_order_cuts_every_set_alike():
    import numpy as np

    r = np.random.default_rng(2)
    grams = np.unique(r.integers(0, 1 << 63, 50, np.int64).astype(np.uint64))
    for fragments in (1, 2, 3, 4, 7):
        order = jaccard.Order(grams, r.integers(2, 9, len(grams)), fragments)
        s = np.unique(np.concatenate([grams[::2], r.integers(0, 1 << 63, 40, np.int64).astype(np.uint64)]))
        parts = order.split(s)
        assert len(parts) <= fragments and sorted(np.concatenate(parts)) == sorted(s)
        whole = order.sort(s).tolist()
        # a fragment is a stretch of the global order
        places = [[whole.index(g) for g in part.tolist()] for part in parts]
        assert all(max(a) < min(b) for a, b in zip([x for x in places if x], [x for x in places if x][1:]))
        assert len(order.split(s[:0])) == len(parts)


def test_jaccard_empty(none):
    assert jaccard.near_duplicates(none).collect() == []


# substrings


def _without_repeats(rows, window=20):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0], k))
    seen, out = set(), []
    for k in order:
        w = words(rows[k][1])
        gone = [False] * len(w)
        fresh = []
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if g in seen:
                gone[i : i + window] = [True] * window
            seen.add(g)
            fresh.append(g)
        out.append((rows[k][0], len(w), sum(gone), " ".join(x for x, d in zip(w, gone) if not d)))
    return sorted(out)


@pytest.mark.parametrize("most", [1, 2, 2000])
def test_substrings_against_brute_force(documents, rows, most):
    got = substrings.remove_repeats(documents, most=most)
    assert "row" in got.columns and "anchor" in got.columns
    found = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect())
    assert found == _without_repeats(rows)


@pytest.mark.parametrize("most", [1, 2000])
def test_a_repeated_row_keeps_its_first_copy(spark, most):
    """A passage of repeated rows stays in the first of them; null ids come first."""
    w = " ".join(f"r{k}" for k in range(40))
    v = " ".join(f"v{k}" for k in range(30))
    rows = [(1, w, "a"), (1, w, "a"), (2, f"{w} more {v}", "b"), (None, v, "c"), (None, v, "c"), (-(1 << 63), v, None), (3, None, None), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = substrings.remove_repeats(df.coalesce(1), most=most).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    found = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=key)
    ordered = [(-(1 << 64) if d is None else d, t, s) for d, t, s in rows]
    want = sorted(((None if d == -(1 << 64) else d, n, gone, kept) for d, n, gone, kept in _without_repeats(ordered)), key=key)
    assert found == want


def test_automaton_matching_statistics():
    import random

    r = random.Random(1)
    for _ in range(50):
        ref, text = ([r.choice("abc") for _ in range(r.randrange(1, 40))] for _ in range(2))
        a = substrings.Automaton()
        for w in ref:
            a.add(w)
        joined = "".join(ref)
        for i, size in enumerate(a.statistics(text)):
            assert size == max(n for n in range(i + 2) if "".join(text[i + 1 - n : i + 1]) in joined)


def test_substrings_empty(none):
    assert substrings.remove_repeats(none).collect() == []


# quality


def test_quality_held_out(spark, small):
    documents = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality.fit(documents, labels.where(~held))
    got = quality.classify(documents, model).join(labels, "doc_id").where(held).select("score", "quality").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == q] for q in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.97
    assert sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in got) / len(got) > 0.95


def test_quality_edges(spark, documents, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (9999, 0), (5, 0)], "doc_id long, quality int")
    model = quality.fit(documents, labels)
    got = quality.classify(documents, model).collect()
    assert len(got) == documents.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(none, model).collect() == []
    empty = quality.fit(documents, labels.where("false"))
    assert {r["score"] for r in quality.classify(documents, empty).collect()} == {0.5}
    assert hashlib is not None


def test_mix_of_a_hundred_thousand_rows_without_id(spark):
    """Rows of one id in a source are dealt to many tasks, and come near their targets like others."""
    df = spark.range(100_000, numPartitions=8).selectExpr("CAST(if(id % 10 = 0, id, NULL) AS bigint) AS doc_id", "repeat('w ', cast(id % 7 AS int)) AS text", "if(id % 3 = 0, 's', NULL) AS source")
    got = mixing.mix(df).persist()
    assert got.count() == 100_000
    for r in got.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) <= 3
    mixed = mixing.mixed_documents(df)
    assert mixed.count() == got.agg(F.sum("copies")).first()[0]
    sizes = lambda d, n: {tuple(r) for r in d.groupBy("source", "_z").agg(n).collect()}
    words = F.regexp_count("text", F.lit(mixing.WORD)).cast("long")
    assert sizes(mixed.withColumn("_z", words), F.count("*")) == sizes(got.where("copies > 0").withColumn("_z", F.col("size")), F.sum("copies"))
