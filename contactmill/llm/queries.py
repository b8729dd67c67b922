"""The registered queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill.llm import decontaminate, fingerprints, html_extract, ngram_join, packing, pii, shards, toxicity, url_filter, warc
from contactmill.session import scratch_path

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and the least id of its component."""
    return ngram_join.similarity_components(_read(spark, sf_dir, "documents", "doc_id", "text"))


OP3_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.c + b.c - i)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
)
SELECT d.doc_id, coalesce(max(n.c), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    found = html_extract.extract(_read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words, those in benchmark windows, and the items they come from."""
    return decontaminate.contamination(
        _read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "benchmark", "item_id", "text")
    )


_ALNUM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP5_SQL = f"""
WITH b AS (SELECT item_id, {_ALNUM_WORDS} AS ws FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2),
    lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) AS g FROM b WHERE len(ws) > 0
), d AS (SELECT doc_id, {_ALNUM_WORDS} AS ws FROM documents
), m AS (SELECT DISTINCT m FROM p
), w AS (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, m WHERE len(ws) >= m
), h AS (
  SELECT w.doc_id, p.item_id, w.i, w.m FROM (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS g FROM w) w
  JOIN p ON p.g = w.g AND p.m = w.m
), n AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM h) GROUP BY 1
), t AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives that it was written to."""
    pages = _read(spark, sf_dir, "pages", "page_id", "url", "html")
    archives = warc.write_archives(pages, scratch_path(spark, "warc"))
    records = warc.read_archives(spark, archives)
    revisit = F.col("kind") == "revisit"
    return records.select(
        _page_of("record_id").alias("page_id"),
        F.when(revisit, F.col("length")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.substring_index("digest", ":", -1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        _page_of("refers_to").alias("refers_to"),
    )


def _page_of(record_id: str):
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha256(b) AS h FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint, that of its edited text, and both likenesses."""
    return fingerprints.compare_neighbours(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the rule that fits its url best, and the verdict."""
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge(_read(spark, sf_dir, "pages", "page_id", "url"), rules).drop("url")


_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)

OP6_SQL = f"""
WITH u AS (
  SELECT page_id, regexp_extract(coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, ''),
    '^[^?#]*') AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), {_AZ}) AS host,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM u
), r(rh, rp, verdict) AS (VALUES {_RULE_VALUES}
), f AS (
  SELECT h.*, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST,
    length(rh) DESC, verdict DESC) AS k
  FROM h LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in batches; only ids and lengths leave the first pass."""
    sized = packing.with_lengths(_read(spark, sf_dir, "documents", "doc_id", "text"))
    packed = packing.pack_lengths(sized.select("doc_id", "n_tokens"))
    return packed.select("doc_id", "n_tokens", "bucket", "boundary", "batch", "slot")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled and written as shards; the result is read from the written shards."""
    shuffled = shards.external_shuffle(_read(spark, sf_dir, "documents", "doc_id", "text"))
    path = scratch_path(spark, "shards")
    shards.write_shards(shuffled, path)
    text = F.coalesce("text", F.lit(""))
    return spark.read.schema(shuffled.schema).parquet(path).select(
        "doc_id",
        (F.octet_length(text) + shards.ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit(shards.LAW).alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the probabilities of the chain, and whether it is toxic."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    chain = toxicity.train(docs, _read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return toxicity.predict(docs, chain).drop("text")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in its text, and how many entities of which types it had."""
    return pii.pseudonymise(_read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_url_filters": op6_url_filters,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
}
SQL = {
    "op1_warc": OP1_SQL,
    "op3_ngram_jaccard_join": OP3_SQL,
    "op5_benchmark_decontamination": OP5_SQL,
    "op6_url_filters": OP6_SQL,
}
