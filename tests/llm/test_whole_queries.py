"""The learning and encoding queries against plain Python, and tables with null ids, repeats and clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import CLASHING
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import bpe, jaccard, lattice, mixing, quality, queries
from larder.llm.quality import _Buckets, term_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def documents_of(spark, small):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


# quality: voting of nearest neighbours


def votes(model, text):
    """The score by a loop over the sampled rows, in double precision."""
    (terms, counts), = term_counts([text.encode()], _Buckets())
    at = model.project([(terms, counts)])[0].astype(float)
    near = sorted(((float(at @ x.astype(float)), k) for k, x in enumerate(model.vectors)), key=lambda p: -p[0])[: model.neighbours]
    weights = [max(c, 1e-6) ** model.power * model.votes[k] for c, k in near]
    return sum(w * model.labels[k] for w, (_, k) in zip(weights, near)) / sum(weights)


def test_quality_as_a_plain_loop(spark, small, documents_of):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    learned = spark.read.parquet(f"{small}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    model = quality.fit(docs, learned)
    assert len(model.labels) == learned.select("doc_id").distinct().count()
    got = {r["doc_id"]: r for r in queries.op9_quality(spark, small).collect()}
    assert got.keys() == documents_of.keys()
    for d, r in got.items():
        assert r["score"] == pytest.approx(votes(model, documents_of[d]["text"] or ""), abs=2e-3)
        assert r["held_out"] == (remainder(d, 3) == 1) and r["predicted"] == int(r["score"] >= 0.5)


# lattice: documents' scores by plain recursion


def plain_inner(word, pieces, stop):
    """Summed weight of all ways to cut a word with the space before it."""
    raw = b" " + word
    ways = [1.0] + [0.0] * len(raw)
    for j in range(1, len(raw) + 1):
        ways[j] = sum(ways[i] * pieces[raw[i:j]] for i in range(max(0, j - 40), j) if raw[i:j] in pieces)
    return ways[-1] * stop


@pytest.mark.parametrize("rounds", [0, 1])
def test_document_scores_by_plain_recursion(spark, rounds):
    rows = [(1, "The cat sat on the mat"), (2, "the dog and the cat"), (3, "étude zzz The"), (4, None), (5, "a cat"), (6, "on and on"), (7, "xq the 日本")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = {r["doc_id"]: r["score"] for r in lattice.score(df, F.col("doc_id") < 6, path, rounds=rounds).collect()}
    split = lambda t: [w.translate(AZ).encode() for w in WORD.findall(t or "")]
    counts = Counter(w for d, t in rows if d < 6 for w in split(t))
    ends = 5
    total = sum(counts.values()) + ends
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    discount = once / (once + 2 * twice)
    own = discount * len(counts) / total
    table = lattice.Pieces(bpe.read_ranks(path))
    scores = np.append(table.start, math.log(0.3 / 0.7) + np.logaddexp.reduce(table.start))
    weight = np.exp(scores - np.logaddexp.reduce(scores))
    if rounds:
        uses = np.full(len(weight), 1e-2)
        number = {t: k for k, t in enumerate(table.tokens)}
        for w in counts:  # each distinct word once: its ways, weighed by their shares
            raw = b" " + w
            n = len(raw)
            a, b = [1.0] + [0.0] * n, [0.0] * n + [1.0]
            arcs = [(i, j, number[raw[i:j]]) for i in range(n) for j in range(i + 1, n + 1) if raw[i:j] in number]
            for i, j, k in sorted(arcs, key=lambda x: x[1]):
                a[j] += a[i] * weight[k]
            for i, j, k in sorted(arcs, key=lambda x: -x[0]):
                b[i] += weight[k] * b[j]
            for i, j, k in arcs:
                uses[k] += a[i] * weight[k] * b[j] / a[n]
            uses[-1] += 1
        weight = uses / uses.sum()
    pieces = {t: float(weight[k]) for k, t in enumerate(table.tokens)}
    for d, t in rows:
        want = math.log10(ends / total)
        for w in split(t):
            want += math.log10(max(0.0, counts[w] - discount) / total + own * plain_inner(w, pieces, float(weight[-1])))
        assert got[d] == pytest.approx(want, rel=1e-9)


# the queries


def test_op2_query_as_the_library(spark, small, documents_of):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = queries.op2_byte_bpe(spark, small).collect()
    assert len(got) == len(documents_of)
    for r in got:
        text = documents_of[r["doc_id"]]["text"] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op4_query_counts_and_splits(spark, small, documents_of):
    counts = Counter()
    for d, r in documents_of.items():
        if remainder(d, 7) != 2:
            counts.update([w.translate(AZ) for w in WORD.findall(r["text"] or "")] + [None])
    n, v = sum(counts.values()), len(counts)
    got = queries.op4_lattice_score(spark, small).collect()
    assert len(got) == len(documents_of)
    for r in got:
        tokens = [w.translate(AZ) for w in WORD.findall(documents_of[r["doc_id"]]["text"] or "")] + [None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r["held_out"] == (remainder(r["doc_id"], 7) == 2) and r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_op5_query_reads_back(spark, small):
    talks = defaultdict(list)
    for r in spark.read.parquet(f"{small}/conversations.parquet").collect():
        talks[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    says = r"\### Assistant: </turn> ok"
    talks[-7] = [(0, "user", says), (1, "assistant", says)]
    got = {r["conv_id"]: r for r in queries.op5_chat_windows(spark, small).collect()}
    assert got.keys() == talks.keys()
    for c, turns in talks.items():
        turns.sort(key=lambda t: t[0])
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] > len(whole)


# null ids, repeated rows, empty tables, clashing names


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Rows without ids among the others, ids shared by different texts, repeats, and columns called like the operators' own."""
    more = [(None, None, None), (None, "one two three four five six", "s0"), (None, "one two three four five six", "s0"), (None, "", "s1"), (3, "another text of the same id", "s2")]
    df = spark.createDataFrame([*rows, *more], "doc_id long, text string, source string").repartition(4)
    return df.withColumns({c: F.lit(7) for c in CLASHING if c not in df.columns})


def test_operators_take_rows_without_ids(spark, odd):
    n = odd.count()
    assert mixing.mix(odd).count() == n
    assert lattice.score(odd, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, public_tokenizers.path(queries.PIECE_RANKS)).count() == n
    found = jaccard.near_duplicates(odd)
    assert found.count() == n and found.where("n_shingles > 0 and component_id is null and doc_id is not null").count() == 0
    labels = spark.createDataFrame([(None, 1), (1, 1), (2, 0), (2, 0), (3, None)], "doc_id long, quality int")
    scored = quality.classify(odd, quality.fit(odd.select("doc_id", "text"), labels))
    assert scored.count() == n and scored.where("score between 0 and 1").count() == n


def tables(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    extra = [c for c in odd.columns if c not in ("doc_id", "text", "source")]
    docs = odd.withColumns({"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long"), "_row": F.lit(1), "_score": F.lit(0.1)}).drop("n")
    labels = spark.createDataFrame([(k, 1) for k in range(40)] + [(None, 0)], "doc_id long, quality int")
    folder = tables(spark, tmp_path, docs, labels)
    got = corpus_pipeline.run(spark, folder).collect()
    assert extra and got and all(r["decodes"] for r in got)
    # a group of copies leaves one row, which the mix takes once or twice
    known = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in got} <= known and max(Counter(r["doc_id"] for r in got if r["doc_id"] is not None).values()) <= 4


def test_pipeline_of_an_empty_table(spark, odd, tmp_path):
    docs = odd.withColumns({"lang": F.lit("en"), "n_chars": F.lit(1).cast("long")}).drop("n").where("false")
    folder = tables(spark, tmp_path, docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert corpus_pipeline.run(spark, folder).collect() == []
