"""Helpers shared by the operators: shared-folder tables and connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.sources.sink import shared_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back.

    It cuts lineage: lost executors don't cause the work above to run again, and
    results that depend on the order of rows are fixed once.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that written() gave and nobody will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if path is not None:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array of integers, step (associative) over all values up to it.

    A scan by doubling: log2(n) passes over the array, each linear, where an aggregate
    that appends would copy what it has for each value.
    """
    widths = F.filter(F.array(*(F.lit(1 << k) for k in range(31))), lambda w: w < F.size(values))
    none = F.lit(None).cast("int")
    return F.aggregate(widths, values, lambda done, w: F.zip_with(
        done, F.concat(F.array_repeat(none, w), F.slice(done, 1, F.size(done) - w)), lambda a, b: F.coalesce(step(b, a), a)))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(src long, dst long) undirected edges -> (node, component): the smallest node reachable.

    Alternating large-star / small-star rounds. Each is an aggregate (combined before
    the shuffle) plus an equi-join that adaptive execution may split, so a node with
    very many neighbours is never gathered in one task. Edges that touch null are
    ignored; an empty input gives an empty result. Every round is written to the
    shared folder; it stops when a round changes nothing.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))

    def star(e: DataFrame, larger: bool) -> DataFrame:
        # hub: the smallest of a node and its neighbours (small star: smaller neighbours only)
        near = both(e) if larger else e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        hub = near.groupBy("src").agg(F.min("dst").alias("hub")).withColumn("hub", F.least("src", "hub"))
        met = near.join(hub, "src")
        if larger:
            out = met.where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("hub").alias("dst"))
        else:
            out = met.select(F.col("dst").alias("src"), F.col("hub").alias("dst")).unionByName(
                hub.select("src", F.col("hub").alias("dst")))
        return out.where("src <> dst").distinct()

    now = written(
        edges.where("src is not null and dst is not null and src <> dst")
        .select(F.greatest("src", "dst").cast("long").alias("src"), F.least("src", "dst").cast("long").alias("dst"))
        .distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        last, now = now, written(star(star(now, True), False), "edges")
        discard(last)
        found = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
