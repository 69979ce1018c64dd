"""One registered query per operator, with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, backoff, decontaminate, divergence, fingerprints, licences, minhash, packing, quotes, sharding, simhash, suffix_dedup, toxicity

#: Vocabulary file of the packing query; the alignment query compares both.
TOKENIZER, OTHER_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op7_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op8_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(OTHER_TOKENIZER))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_stupid_backoff,
        op3_decontamination,
        op4_fingerprints,
        op5_suffix_dedup,
        op6_toxicity,
        op7_quotations,
        op8_rendezvous,
        op9_licences,
        op10_best_fit,
        op11_odd_sketches,
        op12_divergence,
        op13_alignment,
    )
}

_WORDS_SQL = (
    "[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> '']"
)

_DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark),
spots AS (SELECT item_id, ws, unnest(range(0, greatest(1, len(ws) - 9))) AS k FROM i WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, list_slice(ws, k + 1, k + 10) AS g FROM spots),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
tok AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS k FROM d),
grams AS (SELECT doc_id, k, list(word) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g FROM tok),
cut AS (SELECT doc_id, k, n, list_slice(g, 1, n) AS g FROM grams, lens WHERE len(g) >= n),
hit AS (SELECT cut.doc_id, cut.k, cut.n, win.item_id FROM cut JOIN win ON cut.g = win.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_DIVERGENCE_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
tok AS (SELECT r, lang, source, term FROM (SELECT r, lang, source, unnest(ws) AS term FROM d) WHERE term <> ''),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
lv AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS n, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
seen AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM tok JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN seen USING (lang, source) GROUP BY lang, source),
freq AS (SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n, 1 + (1000000000 * (coalesce(s.n, 0) + 5)) // (g.n + 5 * lv.v) AS p,
  1 + (1000000000 * (k.n + 5)) // (lv.n + 5 * lv.v) AS q
  FROM grp g JOIN lv USING (lang) JOIN kept k USING (lang) LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM freq a JOIN freq b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM freq WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR place <= 50
"""

#: DuckDB SQL of the queries that SQL can express at whole size.  The others
#: need hashes, tokenizers, learned weights or look-ahead that it lacks.
ORACLE: dict[str, str] = {"op3_decontamination": _DECONTAMINATION_SQL.strip(), "op12_divergence": _DIVERGENCE_SQL.strip()}
