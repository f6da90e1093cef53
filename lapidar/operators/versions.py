"""Capture, guards, quarantine and versions of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOO_SHORT = 20
"""Fewest characters of an extracted text. The corpus states the message, not the limit."""


def archive_url(page_url: Column, pdf_url: Column) -> Column:
    """The address to read from: the direct one, else a snapshot. An empty string is no address."""
    blank = F.lit("")
    return F.coalesce(F.nullif(pdf_url, blank), F.nullif(page_url, blank))


def snapshot_time(url: Column) -> Column:
    """Fourteen digits of a snapshot's address, as text; empty where there are none."""
    return F.regexp_extract(url, r"/wayback/(\d{14})", 1)


def best_candidate(candidates: DataFrame, key_cols: list[str], rank_cols: list[Column]) -> DataFrame:
    """The first candidate of each key."""
    place = F.row_number().over(Window.partitionBy(*key_cols).orderBy(*rank_cols))
    return candidates.withColumn("place", place).where("place = 1").drop("place")


def text_error(text: Column, least: int = TOO_SHORT) -> Column:
    """Message for a text that is too short; null for one that is not."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.when(n < least, F.concat(F.lit("extracted text too short ("), n.cast("string"), F.lit(" chars)")))


def with_status(docs: DataFrame, text_col: str, foreign: Column, least: int = TOO_SHORT) -> DataFrame:
    """Adds error and status (accepted or quarantined). Rows in error stay."""
    error = F.coalesce(text_error(F.col(text_col), least), F.when(foreign, F.lit("foreign annex")))
    return docs.withColumn("error", error).withColumn("status", F.when(F.col("error").isNull(), "accepted").otherwise("quarantined"))


def latest(rows: DataFrame, key_cols: list[str], version_cols: list[Column]) -> DataFrame:
    """The newest version of each key."""
    return best_candidate(rows, key_cols, [c.desc() for c in version_cols])


def reconcile(batch: DataFrame, live: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, status) of a batch against what is live: same, changed or missing."""
    other = live.select(F.col(id_col).alias("live_id"), F.col(text_col).alias("live_text"))
    met = batch.join(other, F.col(id_col) == F.col("live_id"), "left")
    status = F.when(F.col("live_id").isNull(), "missing").when(F.col(text_col).eqNullSafe(F.col("live_text")), "same").otherwise("changed")
    return met.select(id_col, status.alias("status"))
