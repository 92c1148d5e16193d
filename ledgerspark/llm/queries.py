"""The operators' queries over the whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.byte_bpe import round_trip_digests
from ledgerspark.llm.divergence import source_divergence
from ledgerspark.llm.exact_dedup import exact_dedup
from ledgerspark.llm.license_scan import license_scan
from ledgerspark.llm.lm_score import lm_scores
from ledgerspark.llm.ngram_join import ngram_jaccard_join
from ledgerspark.llm.packing import pack_documents
from ledgerspark.llm.periodic_runs import periodic_runs
from ledgerspark.llm.quality_rules import quality_rules
from ledgerspark.llm.text import read_table, whole_text, words_of
from ledgerspark.llm.token_counts import token_counts
from ledgerspark.llm.token_store import token_id_round_trip
from ledgerspark.llm.url_filter import url_verdicts
from ledgerspark.llm.warc_zip import archive_round_trip
from ledgerspark.session import scratch_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every distinct text is encoded."""
    return token_counts(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_path(spark, "token-counts"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        vocabulary=50_257,
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        keep_ids=False,
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(read_table(spark, sf_dir, "documents"))
    return judged.drop("document", "clean_text")


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(read_table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_id_round_trip(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        scratch_path(spark, "token-ids"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which a tenth of the texts go on in a period of their own.

    With h the crc32 of the id as text, g = h div 10 and n words: if 10 divides h, the words
    from a = g % n on repeat the first 1 + (n - a) div (3 + g % 8) of them. A document
    without words or without an id stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    numbered = docs.select("doc_id", whole_text("text").alias("text"), h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words_of(F.col("text")))
    )
    placed = numbered.selectExpr("*", "size(words) AS n", "h div 10 AS g").selectExpr(
        "*", "if(n > 0, CAST(g % n AS int), 0) AS a"
    )
    period = placed.selectExpr("*", "CAST(1 + (n - a) div (3 + g % 8) AS int) AS p")
    repeated = (
        "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat("
        "slice(words, a + 1, p), CAST(ceil((n - a) / p) AS int))), 1, n - a)), ' ')"
    )
    return period.selectExpr("doc_id", f"CASE WHEN n > 0 THEN {repeated} ELSE text END AS text")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    first = F.array_min(F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period)))

    def hashed(value: Column) -> Column:
        return F.sha2(value.cast("binary"), 256)

    return found.withColumn("best", first).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best")["col1"]).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.col1 div best.period").alias("exponent_milli"),
        hashed(F.array_join(lines, "")).alias("runs_sha256"),
        hashed(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_lm_score": op2_lm_score,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_url_filter": op4_url_filter,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_warc_zip": op7_warc_zip,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_ids": op12_token_ids,
    "op13_periodic_runs": op13_periodic_runs,
}
