"""Five stages from raw documents to packed training sequences.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a
DataFrame that the next one gets as docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm import decontamination, packing, quality_rules, secret_scan, simhash
from lapidar.llm.common import written
from lapidar.llm.entries import table, tokenizer_path
from lapidar.sources.shipping import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    ship(spark)
    return quality_rules.repetition_rules(docs, carry=True).where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    ship(spark)
    lost = simhash.surplus(simhash.near_copies(docs)).withColumnsRenamed({"doc_id": "lost_id", "text_hash": "lost_hash"})
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("lost_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("lost_hash"))
    return docs.join(lost, same, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    found = decontamination.marked(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return found.where(F.size("leaks") == 0).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; all documents stay, with n_chars counted anew."""
    found = secret_scan.find_secrets(docs, carry=True).select("row", secret_scan.masked("text", "spans").alias("masked"))
    text = F.when(F.col("row.text").isNotNull(), F.col("masked"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens: the pieces of documents in them."""
    ship(spark)
    found = packing.pack_documents(docs, tokenizer_path())
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_copies), ("decontamination", decontaminate),
          ("secret_scan", mask_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages need fingerprints, a matrix decomposition and a tokenizer, which SQL can't express.
ORACLE_SQL = None
