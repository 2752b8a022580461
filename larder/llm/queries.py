"""One query for each operator of this subpackage, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import bpe, chat, divergence, html, infill, jaccard, lattice, mixing, pq, quality, substrings, subwords, topk

#: Vocabularies; a parameter of the operators.
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.Vocabulary(spark, public_tokenizers.path(BPE_RANKS))
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, ranks, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integers(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5)


def op4_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lattice.score(_read(spark, sf_dir, "documents"), _remainder(7) != 2, public_tokenizers.path(PIECE_RANKS))
    return got.select(
        "doc_id", (F.coalesce(_remainder(7) == 2, F.lit(False))).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digests(chat.windows(rows))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substrings.remove_repeats(_read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pq.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.93)
    return got.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(documents, _read(spark, sf_dir, "labels").where(_remainder(3) != 1))
    return quality.classify(documents, model).select(
        "doc_id",
        F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.transform(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restore(), 256).alias("restored_sha256"),
    )


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = subwords.Model(spark, public_tokenizers.path(PIECE_MODEL))
    got = subwords.encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded="decoded")
    return got.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_mix_sources, op2_byte_bpe, op3_top_k, op4_lattice_score, op5_chat_windows, op6_jaccard_join,
            op7_substring_dedup, op8_embedding_dedup, op9_quality, op10_main_text,
            op11_fill_in_middle, op12_sentencepiece, op13_source_divergence,
        )
    }


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0)::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '') || ':0') AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source),
t AS (SELECT sum(source_size) * 1.5 AS total FROM s),
p AS (SELECT *, (t.total - coalesce(sum(2.0 * source_size) OVER w, 0)) / sum(weight) OVER v AS level
      FROM s, t WINDOW w AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                       v AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT coalesce(max(level) FILTER (WHERE level * weight <= 2.0 * source_size), 0) AS level FROM p),
q AS (SELECT d.*, s.source_size, least(2.0 * s.source_size, s.weight * l.level)::DOUBLE AS target, weight, l.level,
             (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS upto
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source, l)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size = 0 THEN 0 ELSE size * (((upto - size / 2.0::DOUBLE) / weight <= level)::INT + ((upto - size / 2.0::DOUBLE + source_size) / weight <= level)::INT) END)::BIGINT AS taken FROM q
"""

OP3 = """
WITH v AS (SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS g FROM d, unnest(generate_series(1, len(w) - 19)) AS t(i)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hit, unnest(generate_series(0, 19)) AS t(k)),
cut AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE [w[j] FOR j IN generate_series(1, len(w)) IF NOT list_contains(places, j)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""

OP8 = """
WITH RECURSIVE v AS (SELECT vec_id::BIGINT AS vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.node WHERE r.c < l.b),
m AS (SELECT node, min(c) AS component_id FROM r GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id)::BIGINT AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN m ON m.node = v.vec_id
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN generate_series(1, len(w) - 4)]) END AS g FROM d),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l0 AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
l AS (SELECT a, b FROM l0 UNION ALL SELECT b, a FROM l0),
r AS (SELECT doc_id AS node, doc_id AS c FROM s UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.node WHERE r.c < l.b),
m AS (SELECT node, min(c) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, m.component_id FROM s JOIN m ON m.node = s.doc_id
"""


OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, len(u)::BIGINT AS n, [('0x' || x[8 * k + 1 : 8 * k + 8])::BIGINT FOR k IN range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
                  WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN len(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM s
"""

OP13 = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT lang, source FROM d GROUP BY ALL),
t AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30),
k AS (SELECT x.lang, x.source, x.term, count(*) AS c FROM (SELECT lang, source, unnest(w) AS term FROM d) x JOIN t ON x.lang = t.lang AND x.term = t.term GROUP BY ALL),
f AS (SELECT g.lang, g.source, t.term, coalesce(k.c, 0)::HUGEINT AS c FROM g JOIN t ON g.lang = t.lang
      LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.term = t.term),
n AS (SELECT *, sum(c) OVER w AS n, count(*) OVER w AS v FROM f WINDOW w AS (PARTITION BY lang, source)),
p AS (SELECT *, 1 + (1000000000 * (c + 5)) // (n + 5 * v) AS p FROM n),
l AS (SELECT lang, term, 1 + (1000000000 * (sum(c) + 5)) // (sum(sum(c)) OVER w + 5 * count(*) OVER w) AS q FROM f GROUP BY lang, term WINDOW w AS (PARTITION BY lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT p.lang, source, 'term', p.term, (p - q)::BIGINT FROM p JOIN l ON p.lang = l.lang AND p.term = l.term WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    """The other operators learn, encode or parse, which SQL cannot say; tests/llm has them against brute force."""
    return {"op1_mix_sources": OP1, "op3_top_k": OP3, "op6_jaccard_join": OP6, "op7_substring_dedup": OP7, "op8_embedding_dedup": OP8, "op11_fill_in_middle": OP11, "op13_source_divergence": OP13}
