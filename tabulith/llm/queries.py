"""The opN_ queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm.common import table

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.url_filter import judge_urls, rule_table

    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.media import store_media

    kept = store_media(table(spark, sf_dir, "documents"), F.col("text"), "doc_id").withColumnRenamed("key", "doc_id")
    return kept.withColumns({"pcm_bytes": F.octet_length("pcm").cast("long"), "pcm_crc32": F.crc32("pcm")}).drop("pcm")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.dart_minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "kept")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.decontamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken")
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.html_extraction import extract

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.license_scan import scan

    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("licenses").cast("long").alias("n_licenses"), F.array_min(F.col("matches.first_word")).cast("long").alias("first_word"), F.size("occurrences").cast("long").alias("n_occurrences"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.token_output import SLOTS, read_shards, write_shards

    shards = read_shards(spark, write_shards(table(spark, sf_dir, "documents")))
    return shards.select(
        F.col("key").alias("doc_id"),
        "seq",
        "slot",
        "shard",
        (F.col("slot") % SLOTS).alias("place"),
        "n_tokens",
        F.octet_length("tokens").cast("long").alias("stride"),
        F.crc32("tokens").alias("tokens_crc32"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.language_id import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulith.llm.resharding import reshard

    return reshard(table(spark, sf_dir, "documents")).select(
        F.col("_key").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_old").alias("old_shard"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filter, op2_media, op3_minhash_near_dedup, op4_decontamination, op5_mixing, op6_html_extraction, op7_license_scan, op8_token_output, op9_language_id, op10_sharding, pipeline)
}

SQL: dict[str, str] = {
    "op1_url_filter": r"""
WITH cut AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT host, path, arg_max({'rule': h || p, 'v': v}, length(h || p)) AS won
  FROM (SELECT DISTINCT host, path FROM cut), rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, cut.host, cut.path, won.rule AS rule, coalesce(won.v, 'allow') AS verdict
FROM cut LEFT JOIN best ON cut.host = best.host AND cut.path = best.path
""",
    "op4_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT item_id, n, ws[s : s + n - 1] AS w
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, ws[s : s + n - 1] AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT DISTINCT dw.doc_id, dw.n, dw.s, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.w = bw.w),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
