"""Vector operators against numpy on a small fixture."""

import math
import random

import numpy as np
import pytest

from larder.llm import pq, topk


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(4)
    rows = []
    centres = r.standard_normal((5, 16))
    for k in range(300):
        v = centres[k % 5] + r.standard_normal(16) * r.choice([0.02, 0.15, 1.0])
        rows.append([k, [float(x) for x in np.float32(v)], k % 4])
    for k in range(300, 330):
        rows.append([k, rows[7][1], 3])  # copies
    rows += [[330, None, 1], [331, [0.0] * 16, 1], [332, [float("nan")] + [1.0] * 15, 1], [333, [None] + [1.0] * 15, 1], [334, [float("inf")] + [1.0] * 15, 1]]
    rows += [[335, [1.0, 2.0], 1], [350, [2.0, 4.0], 1], [336, rows[0][1], None], [337, [], 1], [338, [3e-30] * 16, 2], [400, [1e-3] * 16, 2]]
    random.Random(2).shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def table(spark, vectors):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([tuple(x) for x in vectors], "vec_id long, embedding array<float>, label int").repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("n", "c", "u", "id", "v", "list", "block", "key")})


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_top_k(table, vectors):
    v = topk.integers(table.drop("id", "v"))
    got = [tuple(r) for r in topk.top_k(v, v.where("id % 50 = 0"), k=5).select("query_id", "rank", "vec_id", "score").collect()]
    ints = {i: [math.floor(256 * np.float64(np.float32(x))) for x in e] for i, e, _ in vectors if usable(e)}
    want = []
    for q in (i for i in ints if i % 50 == 0):
        near = sorted((-sum(a * b for a, b in zip(ints[q], e)), i) for i, e in ints.items() if i != q and len(e) == len(ints[q]))
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(near[:5])]
    assert sorted(got) == sorted(want)


def test_top_k_many_blocks(spark, monkeypatch):
    """Small buckets and blocks, very different lengths: pruning is at work and results are whole."""
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "BLOCK", 8)
    r = np.random.default_rng(0)
    rows = [(k, [float(x) for x in np.float32(r.standard_normal(8) * 10 ** r.uniform(-2, 1))]) for k in range(400)]
    v = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = topk.top_k(v, v.where("id % 10 = 0"), k=3, buckets=3, blocks=2).collect()
    ints = np.array([[math.floor(256 * np.float64(np.float32(x))) for x in e] for _, e in rows])
    for q in range(0, 400, 10):
        s = ints @ ints[q]
        want = sorted((-s[i], i) for i in range(400) if i != q)[:3]
        assert [(-x["score"], x["vec_id"]) for x in sorted((x for x in got if x["query_id"] == q), key=lambda x: x["rank"])] == want


def test_top_k_empty(table):
    v = topk.integers(table.drop("id", "v"))
    assert topk.top_k(v.where("false"), v.where("false")).collect() == []
    assert topk.top_k(v, v.where("false")).collect() == []


@pytest.mark.parametrize("block", [2048, 32])
def test_embedding_dedup(table, vectors, monkeypatch, block):
    monkeypatch.setattr(pq, "BLOCK", block)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pq.near_duplicates(table, threshold=0.93, lists=8).collect()}
    ok = [(i, np.float64(np.float32(e)), g) for i, e, g in vectors if usable(e) and g is not None and any(e)]
    up = {i: i for i, _, _ in vectors}
    links = dict.fromkeys(up, 0)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(ok)):
        for b in range(a):
            (i, x, g), (j, y, h) = ok[a], ok[b]
            if g == h and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((root(i), root(j)))
                up[hi] = lo
    assert got == {i: (links[i], root(i)) for i in up}
    assert any(n > 20 for n, _ in got.values())


def test_embedding_dedup_empty(table):
    assert pq.near_duplicates(table.where("false")).collect() == []


@pytest.mark.parametrize("local", [200_000, 7])
def test_components(spark, monkeypatch, local):
    from larder.llm import components
    from larder.llm.scratch import Scratch

    monkeypatch.setattr(components, "LOCAL", local)
    r = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(7, k) for k in range(200, 260)] + [(3, 3)]
    got = dict(map(tuple, components.connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()))
    forest = components.Forest()
    for a, b in edges:
        forest.join(a, b)
    assert got == {x: forest.root(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_top_k_of_many_lengths(spark, monkeypatch, spread):
    """Queries start from what the longest vectors gave them, and pass over groups that are too short; nothing is lost."""
    monkeypatch.setattr(topk, "BUCKET", 32)
    monkeypatch.setattr(topk, "BLOCK", 8)
    r = np.random.default_rng(3)
    x = r.standard_normal((1500, 12)) * r.lognormal(0, spread, (1500, 1)) if spread else np.sign(r.standard_normal((1500, 12)))
    df = spark.createDataFrame([(k, list(map(float, v))) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    v = topk.integers(df)
    got = topk.top_k(v, v.where("id % 30 = 0"), k=4, buckets=2, blocks=1).collect()
    e = np.floor(x * 256).astype(np.int64)
    want = []
    for q in range(0, 1500, 30):
        s = e @ e[q]
        order = [d for d in np.lexsort((np.arange(1500), -s)) if d != q][:4]
        want += [(q, k + 1, int(d), int(s[d])) for k, d in enumerate(order)]
    assert sorted((a["query_id"], a["rank"], a["vec_id"], a["score"]) for a in got) == want
