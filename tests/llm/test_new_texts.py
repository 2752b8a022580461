"""Fill-in-middle, SentencePiece and source divergence against plain Python and the library."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from larder.llm import divergence, infill, queries, subwords

MARKS = ("<P>", "<S>", "<M>")
LINES = ["a\nb\n\nc", "\n\n\n", "x", "été\n日本\n𝔘x", "no mark <P > here\n", "has <S> inside\n", "\r\n\x00tail", "<\nP>\n<"]


# fill in the middle


def fim(key, text, rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return n, form, len(p), len(m), out


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 0), (100, 100)])
def test_infill_as_plain(spark, documents, rows, rate, spm):
    extra = spark.createDataFrame([(1000 + k, t, None) for k, t in enumerate(LINES)] + [(None, "a\nb", None)], "doc_id long, text string, source string")
    df = documents.unionByName(extra, allowMissingColumns=True).withColumns({c: F.lit(1) for c in ("output", "form", "h", "key")})
    got = infill.transform(df, rate=rate, spm=spm).withColumn("back", infill.restore()).collect()
    want = Counter((d, fim(d, t or "", rate, spm)) for d, t, _ in [*rows, *[(1000 + k, t, None) for k, t in enumerate(LINES)], (None, "a\nb", None)])
    assert Counter((r["doc_id"], (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])) for r in got) == want
    assert all(r["back"] == (r["text"] or "") for r in got)


def test_infill_long_texts_in_blocks():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    splitter = Split(Regex(infill.LINES), behavior="isolated")
    for text in ("é\n" * 150_000, "x" * 300_000 + "\n" + "y" * 70_000, "\n" * 200_000 + "z"):
        want = [m.end() for m in re.finditer(infill.LINES, text)]
        assert infill.unit_ends(splitter, text).tolist() == want


def test_infill_marks_must_not_overlap(documents):
    with pytest.raises(ValueError, match="overlap"):
        infill.transform(documents, marks=("<P>", ">S<", "<M>"))


def test_infill_empty(none):
    assert infill.transform(none).collect() == []


# SentencePiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))


@pytest.fixture(scope="module")
def model(spark):
    return subwords.Model(spark, public_tokenizers.path(queries.PIECE_MODEL))


def test_subwords_as_library(documents, rows, model, library):
    got = subwords.encode(documents, model, decoded="decoded")
    got = subwords.decode(got, model, out="again").select("text", "ids", "decoded", "again", "row").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == library.encode(r["text"] or "") and r["row"] == 7
        assert r["decoded"] == r["again"] == library.decode(r["ids"])


def test_subwords_random_texts_and_ids(library):
    codec = subwords.Codec(subwords.read_model(public_tokenizers.path(queries.PIECE_MODEL)))
    r = random.Random(5)
    some = ["a", "b", "the", "▁", " ", "  ", "\n", "\t", "é", "ß", "日本", "語", "𝔘", "\x00", "ing", "<0x0A>", "<s>", "aaaa", " " * 17, "Ü", "0", "...", "def ", " "]
    import numpy as np

    for _ in range(4000):
        text = "".join(r.choice(some) for _ in range(r.choice([0, 1, 2, 3, 8, 30, 100])))
        ids = np.frombuffer(codec.encode(text), "<i4")
        assert ids.tolist() == library.encode(text), text
        assert codec.decode(ids) == library.decode(ids.tolist())
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(300)]) for _ in range(r.randrange(12))]
        assert codec.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_subwords_long_part_is_linear(library):
    codec = subwords.Codec(subwords.read_model(public_tokenizers.path(queries.PIECE_MODEL)))
    import numpy as np

    for text in ("x" * 100_000, " " * 50_000, "ab" * 40_000, "日本語" * 20_000, "ababcabab" * 5_000):
        assert np.frombuffer(codec.encode(text), "<i4").tolist() == library.encode(text)


def test_subwords_empty_and_null_ids(spark, none, model):
    assert subwords.decode(subwords.encode(none, model), model).collect() == []
    got = subwords.decode(spark.createDataFrame([(None,), ([],), ([None, 450],)], "ids array<int>"), model).collect()
    assert [x["decoded"] for x in got] == ["", "", model.codec().decode(__import__("numpy").array([450]))]


def test_subwords_pairs_as_merging():
    """Every pair's compatibility, for a small model with ties, against merging both pieces' text."""
    pieces = [(p, -float(k // 2 + 1), subwords.NORMAL) for k, p in enumerate(["ab", "bb", "abb", "ba", "bab", "aa", "aaa", "abba"])]
    pieces += [(c, -100.0, subwords.NORMAL) for c in "ab"]
    try:
        codec = subwords.Codec(pieces)
    except ValueError:
        pytest.skip("pieces of a later rank")
    ranks = {p: -s for p, s, _ in pieces}
    made = [k for k, (p, _, _) in enumerate(pieces) if len(subwords.merged(list(p), ranks)) == 1]
    for a in made:
        for b in made:
            x, y = pieces[a][0], pieces[b][0]
            plain = [t[0] for t in subwords.merged(list(x + y), ranks)]
            assert codec.compatible(a, b) == (plain == [x, y]), (x, y)


# source divergence


def audit(rows, least, top=50):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    az = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = term.findall((text or "").translate(az))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in docs.items()}
    every = dict(counts)
    for lang in kept:
        every[lang, None] = sum((c for (l, _), c in counts.items() if l == lang), Counter())
    share = {}
    for (lang, source), c in every.items():
        v, n = len(kept[lang]), sum(c[t] for t in kept[lang])
        share[lang, source] = {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept[lang]}
    out = []
    for lang, source in counts:
        p = share[lang, source]
        pair = [(s, sum(abs(p[t] - share[l, s][t]) for t in p)) for l, s in counts if l == lang and s != source]
        over = [(t, p[t] - share[lang, None][t]) for t in p if counts[lang, source][t] and p[t] > share[lang, None][t]]
        for part, items, most in (("pair", pair, None), ("term", over, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


@pytest.fixture(scope="module")
def talk():
    r = random.Random(2)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)] + ["Été", "日本", "x y", "ÜBER"]
    out = []
    for k in range(500):
        s = r.randrange(14)
        some = words[: 20 + 8 * s] if s % 2 else words[s * 5 :]
        out.append((" ".join(r.choice(some) for _ in range(r.choice([0, 3, 20]))) + r.choice(["", "1a2b", "  A_b"]), r.choice(["en", "de", None]), f"s{s}" if s else None))
    return [*out, *[("only here", "xx", "s1"), (None, "xx", "s2"), ("", None, ""), ("hi", "yy", "s9")], *[out[5]] * 3]


@pytest.mark.parametrize("how", [{}, {"light_share": 1, "light_most": 5, "tile_terms": 7, "block": 3}, {"light_share": 1}, {"light_most": 0}])
def test_divergence_as_plain(spark, talk, how):
    df = spark.createDataFrame(talk, "text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "count", "p", "g", "N", "V", "docs")})
    got = divergence.audit(df, least=6, top=5, **how).collect()
    assert sorted(map(tuple, got)) == audit(talk, 6, 5)


def test_divergence_no_kept_terms_and_empty(spark, talk):
    df = spark.createDataFrame(talk, "text string, lang string, source string")
    got = divergence.audit(df, least=10**6).collect()
    assert sorted(map(tuple, got)) == audit(talk, 10**6)
    assert divergence.audit(df.where("false")).collect() == []


def test_divergence_counts(spark, talk):
    df = spark.createDataFrame(talk, "text string, lang string, source string")
    got = {tuple(x[:3]): tuple(x[3:]) for x in divergence.count_terms(df.repartition(5)).collect()}
    term, az = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = Counter(), Counter()
    for text, lang, source in talk:
        found = term.findall((text or "").translate(az))
        counts.update((lang or "", source or "", t) for t in found)
        docs.update((lang or "", source or "", t) for t in {None, *found})
    assert got == {k: (counts[k], n) for k, n in docs.items()}


# the queries


def test_new_queries_as_sql(spark, small, oracle, same):
    sql = queries.oracle_sql()
    for name in ("op11_fill_in_middle", "op13_source_divergence"):
        same(queries.queries()[name](spark, small), oracle.execute(sql[name]))


def test_op12_query_as_library(spark, small, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op12_sentencepiece(spark, small).collect():
        ids = library.encode(docs[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
