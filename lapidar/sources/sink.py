"""Writers: compact tables by kind, append-only logs, and files for export."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir of the session.

    Only in local mode (tests) a temporary folder is set where the session names none; on
    a cluster that is an error, for no other machine could read it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lapidar-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_fragments(fragments: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by kind, sorted by document and id, so that row groups can be skipped."""
    fragments.repartition("kind", "document").sortWithinPartitions("kind", "document", "id").write.mode(mode).partitionBy("kind").parquet(path)


def write_postings(found: DataFrame, path: str) -> None:
    """Postings in ranges of tokens."""
    found.repartitionByRange("token").sortWithinPartitions("token").write.mode("overwrite").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Adds rows; what is there stays."""
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def export_lines(rows: DataFrame, path: str, text: str = "text") -> None:
    """One line of JSON for each row, in folders by kind and document."""
    kept = [c for c in rows.columns if c not in ("kind", "document")]
    rows.select("kind", "document", F.to_json(F.struct(*kept)).alias("value")).write.mode("overwrite").partitionBy("kind", "document").text(path)
