"""The pipeline's stages on the smallest tables, each against plain Python on its own input."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from test_documents import _components, _without_repeats

import corpus_pipeline
from larder.llm import bpe, mixing, queries


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, small).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((before, docs))
    return out


def test_columns(stages, spark, small):
    want = spark.read.parquet(f"{small}/documents.parquet").columns
    assert len(corpus_pipeline.STAGES) == 5 and all(after.columns == want for _, after in stages[:-1])


def test_quality_keeps_good_and_drops_bad(stages, spark, small):
    before, after = stages[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    right = sum((d in kept) == (q == 1) for d, q in labels.items())
    assert right / len(labels) > 0.95
    assert kept <= {r["doc_id"] for r in before.collect()}


def test_one_of_each_component_stays(stages):
    before, after = stages[1]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in before.collect()]
    want = sorted({c for _, n, c in _components(rows) if n} | {d for d, n, _ in _components(rows) if not n})
    assert sorted(r["doc_id"] for r in after.collect()) == want


def test_repeats_are_cut(stages):
    before, after = stages[2]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in before.collect()]
    want = {d: (n, gone, kept) for d, n, gone, kept in _without_repeats(rows) if gone < n or not gone}
    text = {d: t for d, t, _ in rows}
    got = {r["doc_id"]: r for r in after.collect()}
    assert got.keys() == want.keys()
    for d, r in got.items():
        n, gone, kept = want[d]
        assert r["text"] == (kept if gone else text[d])
        assert not gone or r["n_chars"] == len(kept)


def test_mix_repeats_documents(stages):
    before, after = stages[3]
    want = Counter()
    for r in mixing.mix(before).collect():
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in after.collect()) == +want
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in mixing.mix(before).collect():
        sizes[r["source"]] = max(sizes[r["source"]], r["size"])
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= sizes[s] / 2 + 1e-6 for s in target)


def test_ids_decode(stages):
    before, after = stages[4]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert r["decodes"] and list(memoryview(bytes(r["ids"])).cast("I")) == library.encode_ordinary(text[r["doc_id"]] or "")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_as_sql(name, spark, small, oracle, same):
    same(queries.queries()[name](spark, small), oracle.execute(queries.oracle_sql()[name]))


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).where("not decodes").count() == 0
