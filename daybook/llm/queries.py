"""One query per operator, with production parameters over whole tables, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    bpe,
    collision_ann,
    golay_simhash,
    html_extract,
    jaccard_join,
    katz,
    mixing,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    warc,
    whitening,
)
from daybook.llm.common import table


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The text itself is not staged: only its statistics are needed later.
    stats = docs.select("doc_id", quality_rules.statistics(F.col("text")).alias("s"))
    return quality_rules.judged_statistics(stats, table(spark, sf_dir, "labels"), "s").select(
        "doc_id",
        *(F.col("s")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("s")["base_failed"].alias("base_failed"),
        F.col("s")["kept"].alias("kept"),
        F.col("s")["rule"].alias("rule"),
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, spans = substring_dedup.without_repeats(docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")))
    removed = F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["size"]), F.lit(0).cast("long"))
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.coalesce(F.size(spans), F.lit(0)).cast("long").alias("n_spans"), "text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").alias("payload"))
    folder, archives = warc.archive(pages)
    # Of the chunk table, the last chunk of each record holds what is asked.
    return warc.read(spark, folder, archives).filter("last").select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    plan = mixing.copies(docs.select(F.col("doc_id").alias("id"), "source", mixing.n_words(F.col("text")).alias("size")))
    return plan.select(
        F.col("id").alias("doc_id"), "source", "size", F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"), (F.col("copies") * F.col("size")).alias("taken"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, "text", public_tokenizers.path("byte_bpe_50k.json"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    scores, total, _, _ = katz.scored(docs, F.crc32(F.col("id").cast("string")) % 7 == 2)
    return scores.select(
        F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["size"]), F.lit(0).cast("long"))
    return suffix_dedup.without_repeats(docs, length=50).select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256",
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    found = jaccard_join.classes(docs, shingle=3, num=90, den=100)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op8_jaccard_join": op8_jaccard_join,
}
_LETTERS = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * {i} + 1, 5))::INT >> {s}) & 31) + 1, 1)"
ORACLE: dict[str, str] = {
    "op3_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
        s AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, first FROM p)
        SELECT page_id, payload_bytes, {" || ".join(_LETTERS.format(i=i, s=s) for i in range(8) for s in (15, 10, 5, 0))} AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM s
    """,
}


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = collision_ann.nearest(vectors, F.coalesce(F.col("id") % 20 == 0, F.lit(False)), k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pipeline imports operators of this subpackage and is registered among its queries.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["op6_katz"] = op6_katz
QUERIES["op7_suffix_dedup"] = op7_suffix_dedup
QUERIES["op9_html_extraction"] = op9_html_extraction
QUERIES["op10_collision_ann"] = op10_collision_ann
QUERIES["pipeline"] = pipeline


def op11_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return golay_simhash.classes(docs, size=4).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.aligned(docs, *paths).withColumnRenamed("id", "doc_id")


def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return whitening.whitened(vectors, components=16).withColumnRenamed("id", "vec_id")


QUERIES["op11_golay_simhash"] = op11_golay_simhash
QUERIES["op12_token_alignment"] = op12_token_alignment
QUERIES["op13_chebyshev_whitening"] = op13_chebyshev_whitening
