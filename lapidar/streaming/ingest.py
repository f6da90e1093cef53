"""Capture as a stream: new files are judged as they come. An extension; the corpus shows batches only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapidar.operators.versions import TOO_SHORT, with_status


def start(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, foreign: Column, text_col: str = "text", least: int = TOO_SHORT) -> StreamingQuery:
    """Reads what is new in source, splits it by status and ends.

    Each batch is written to a folder of its own, which a repeated batch overwrites: a
    batch that failed halfway leaves no row twice.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("status").parquet(f"{out}/batch={number}")

    rows = with_status(spark.readStream.schema(schema).parquet(source), text_col, foreign, least)
    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(spark: SparkSession, source: str, out: str, checkpoint: str, time_col: str, key_col: str, width: int, delay: int) -> DataFrame:
    """key, began, n: rows of source by key and window of width seconds, as a stream that takes what is there and ends.

    Rows later than delay seconds behind the latest so far are late and don't count; a
    window is written once, when no row can come for it any more.
    """
    table = spark.read.parquet(source)
    # a stream reads folders: of a table that is one file, the folder with that file alone
    one = table.inputFiles()[0] if table.inputFiles() and table.inputFiles()[0].endswith("/" + source.rstrip("/").rpartition("/")[2]) else None
    folder, _, name = one.rpartition("/") if one else (source, "", "*")
    rows = spark.readStream.schema(table.schema).option("pathGlobFilter", name).parquet(folder).withColumn(time_col, F.col(time_col).cast("timestamp"))
    found = rows.withWatermark(time_col, f"{delay} seconds").groupBy(F.window(time_col, f"{width} seconds").alias("window"), key_col).agg(F.count("*").alias("n"))
    stream = found.select(key_col, F.col("window.start").alias("began"), "n").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    stream.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"{key_col} string, began timestamp, n long").parquet(out)
