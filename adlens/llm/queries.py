"""The operators as queries over the whole given tables, with equal DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    license_scan,
    packing,
    quality,
    secret_scan,
    simhash,
    source_audit,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from adlens.llm.sampling import held_out

QUALITY_LEAST = 0.3
TOXIC_LEAST = 0.7
URL_RULES = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rules_of(URL_RULES))
    return rows.withColumnRenamed("id", "page_id")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_extract.extract(_table(spark, sf_dir, "pages"))
    return rows.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def _predicted(rows: DataFrame, out: Callable, least: float) -> DataFrame:
    doc_id = F.col("_row.doc_id")
    return rows.select(
        doc_id.alias("doc_id"),
        out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Trees:
    return quality.fit_quality(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 3, 1))
    return _predicted(toxicity.score_toxicity(docs, model), lambda c: held_out(c, 3, 1), TOXIC_LEAST)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.scan(_table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_passages",
        F.array_join("licenses", ",").alias("licenses"),
        "best_license",
        F.round("best_dice", 6).alias("best_dice"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = exact_dedup.exact_groups(docs, digest_all=True)
    return rows.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(spark, docs, sf_dir)
    return _predicted(quality.score_quality(docs, model), lambda c: held_out(c, 5, 0), QUALITY_LEAST)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(_table(spark, sf_dir, "pages"))
    rows = warc.capture_index(warc.read_archives(spark, folder))
    return rows.select(
        F.col("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    rows, fit = whitening.whiten(table)
    n, explained, error = 0, [], None
    if fit:
        n, explained = fit.n, [float(v) for v in fit.explained]
        error = whitening.identity_error(table.select(F.col("embedding").cast("array<double>")), fit)
    each = rows.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit(explained).cast("array<double>"), F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(_table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    return secret_scan.summary(rows).withColumnRenamed("id", "doc_id")


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_extract": op2_html_extract,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_license_scan": op6_license_scan,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_source_audit": op12_source_audit,
    "op13_secret_scan": op13_secret_scan,
    "pipeline": _pipeline,
}

OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
hits AS (
  SELECT doc_id, p, d.n, item_id FROM (
    SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS key FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM words CROSS JOIN lengths WHERE len(w) >= n)) d
  JOIN item_windows i ON d.key = i.key AND d.n = i.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP7_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP9_SQL = """
WITH bodies AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
  FROM bodies),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM firsts
"""

OP12_SQL = r"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT lang, source, id, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(lang_n) AS HUGEINT) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.lang_n + 5)) // (l.total + 5 * l.v) AS q
  FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(sum(abs(a.p - b.p)), 0) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN shares a ON a.lang = x.lang AND a.source = x.source
  LEFT JOIN shares b ON b.lang = y.lang AND b.source = y.source AND b.term = a.term
  GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 50)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked
"""

SQL = {
    "op5_decontamination": OP5_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op12_source_audit": OP12_SQL,
}
