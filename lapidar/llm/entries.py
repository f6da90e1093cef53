"""Queries of the operators, as the driver runs them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm import classifier, decontamination, html_extract, license_scan, oracles, packing, pii, quality_rules, secret_scan, simhash, substring_dedup
from lapidar.sources.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest(kinds: list[str], spans: str = "spans") -> Column:
    """kind:start:end of the spans of these kinds, comma-joined in their order."""
    own = F.filter(spans, lambda x: x["kind"].isin(kinds))
    return F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def counted(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = list(pii.KINDS[:4])
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *map(counted, base), F.sha2(digest(base), 256).alias("base_sha256"), digest(list(pii.KINDS)).alias("spans"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "first_word", F.round("share", 6).alias("share"), F.round("answer_share", 6).alias("answer_share"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = list(secret_scan.KINDS[:3])
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *map(counted, base), F.sha2(digest(base), 256).alias("base_sha256"), digest(list(secret_scan.KINDS)).alias("spans"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(table(spark, sf_dir, "documents"))
    alike = F.concat("similar", "wrapped")
    base, own = (F.transform(c, lambda x: x["label"]) for c in (F.col("places"), alike))
    starts = F.transform("places", lambda x: x["start"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform(alike, lambda x: x["share"])), F.lit(0.0)).alias("score"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = classifier.train(docs, labels.where(~held_out))
    found = classifier.scored(docs, net)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.repetition_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_decontamination, op3_simhash, op4_secret_scan, op5_license_scan, op6_quality_classifier, op7_substring_dedup, op8_html_extraction, op9_quality_rules, op10_packing)
}
SQL: dict[str, str] = oracles.SQL
