"""One query for each operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, digests, divergence, language, minhash, mixing, ngram_join, pages, passages, phrases, sentencepieces, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = digests.rarity_ranks(digests.histogram(docs), digests.Settings().least)
    found = digests.neighbours(docs.withColumn("text", F.coalesce("text", F.lit(""))), ranks)
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents")).documents
    return found.select("doc_id", "size", "source_size", "target", "taken", F.try_element_at("slots", F.lit(1)).alias("slot"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    chain = toxicity.learn(docs, labels, {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")})
    return toxicity.score(docs, chain).select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= 0.4).cast("int").alias("toxic"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepieces.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_table(spark, sf_dir, "conversations"))


OP10_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(role || chr(1) || text ORDER BY turn, role, text) AS turns, count(*) AS n,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS chat
  FROM t GROUP BY conv_id
), p AS (
  SELECT DISTINCT turns[1:i] AS turns FROM (SELECT turns, unnest(range(1, n)) AS i FROM c)
), w AS (
  SELECT turns, n, min(conv_id) AS conv_id, count(*) AS n_copies, min(chat) AS chat FROM c GROUP BY turns, n
), kept AS (
  SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = w.turns)
)
SELECT k.conv_id AS conv_id, CAST(k.n AS BIGINT) AS n_turns, CAST(k.n_copies AS BIGINT) AS n_copies,
       CAST(coalesce(sum(s.n_copies), 0) AS BIGINT) AS n_prefixes, k.chat AS chat
FROM kept k LEFT JOIN w s ON s.n < k.n AND s.turns = k.turns[1:s.n]
GROUP BY k.conv_id, k.n, k.n_copies, k.chat
"""


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest([array_to_string(w[i:i + 1], ' ') FOR i IN range(1, len(w))]) FROM w
  UNION ALL SELECT lang, 3, unnest([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) FROM w
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 10
), cut AS (
  SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS j FROM c
), s AS (
  SELECT cut.*, x.a AS l, y.a AS r, 1000000 * cut.a * cut.a // (x.a * y.a) AS score FROM cut
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:j], ' ') AND x.k = j
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[j + 1:], ' ') AND y.k = cut.k - j
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
  SELECT * FROM low WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE low.k = 2 AND c.k = 3 AND c.lang = low.lang AND 100 * c.a >= 50 * low.a
      AND (array_to_string(c.ws[1:2], ' ') = low.phrase OR array_to_string(c.ws[2:3], ' ') = low.phrase))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT d, lang, source, unnest(w) AS term FROM d
), v AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), ls AS (
  SELECT lang, CAST(sum(c) AS HUGEINT) AS n, CAST(count(*) AS HUGEINT) AS v FROM v GROUP BY lang
), c AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), gs AS (
  SELECT g.lang, g.source, CAST(coalesce(sum(c.c), 0) AS HUGEINT) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT gs.lang, gs.source, v.term, coalesce(c.c, 0) AS c, 1 + 1000000000 * (coalesce(c.c, 0) + 1) // (gs.n + ls.v) AS p,
         1 + 1000000000 * (v.c + 1) // (ls.n + ls.v) AS q
  FROM gs JOIN ls USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gs.lang AND c.source = gs.source AND c.term = v.term
), pf AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pf.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pf ON pf.lang = a.lang AND pf.source = a.source AND pf.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE c > 0 AND p > q
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(_table(spark, sf_dir, "documents"))


def _linked_sql(words: int, percent: int) -> str:
    """Shingle sets, pairs by counted overlap, and the smallest id that links reach."""
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + {words - 1}], ' ') FOR i IN range(1, len(w) - {words - 2})] END)) AS s
  FROM d
), k AS MATERIALIZED (
  SELECT doc_id, s, len(s) AS n, CASE WHEN len(s) > 0 THEN sha256(array_to_string(s, chr(10))) END AS name FROM s
), c AS MATERIALIZED (
  SELECT row_number() OVER () AS node, name, any_value(s) AS s, any_value(n) AS n FROM k WHERE name IS NOT NULL GROUP BY name
), u AS MATERIALIZED (
  SELECT node, n, unnest(s) AS shingle FROM c
), x AS (
  SELECT shingle, row_number() OVER () AS id FROM u GROUP BY shingle HAVING count(*) > 1
), i AS MATERIALIZED (
  SELECT u.node, u.n, x.id FROM u JOIN x USING (shingle)
), e AS MATERIALIZED (
  SELECT a.node AS a, b.node AS b FROM i a JOIN i b ON a.id = b.id AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), reach AS (
  SELECT node AS a, node AS b FROM c UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b
), m AS (
  SELECT k.doc_id, c.node, k.n FROM k LEFT JOIN c ON c.name = k.name
), least AS (
  SELECT reach.a AS node, min(m.doc_id) AS least FROM reach JOIN m ON m.node = reach.b GROUP BY reach.a
), r AS (
  SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_shingles, coalesce(least.least, m.doc_id) AS component_id FROM m LEFT JOIN least USING (node)
)
"""


OP8_SQL = _linked_sql(5, 75) + "SELECT doc_id, n_shingles, component_id FROM r"
OP13_SQL = _linked_sql(4, 80) + "SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM r"

QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_exact_topk,
        op3_language_id,
        op4_html_extraction,
        op5_source_mixing,
        op6_suffix_dedup,
        op7_toxicity,
        op8_ngram_jaccard_join,
        op9_sentencepiece,
        op10_chat_formatting,
        op11_phrase_collocations,
        op12_source_divergence,
        op13_minhash_dedup,
    )
}
ORACLES = {
    "op2_exact_topk": OP2_SQL,
    "op8_ngram_jaccard_join": OP8_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_minhash_dedup": OP13_SQL,
}
