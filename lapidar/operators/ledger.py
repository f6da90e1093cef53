"""Receipts, pairs, lineage, states and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def incomplete(receipts: DataFrame, needed: list[str]) -> DataFrame:
    """Receipts with a missing or empty field, and the names of those fields."""
    gaps = F.array_compact(F.array(*(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in needed)))
    return receipts.withColumn("missing", gaps).where(F.size("missing") > 0)


def unpaired(one: DataFrame, two: DataFrame, stem_col: str) -> DataFrame:
    """(stem, side) of stems that stand on one side only."""
    a = one.select(stem_col).distinct().withColumn("in_one", F.lit(True))
    b = two.select(stem_col).distinct().withColumn("in_two", F.lit(True))
    met = a.join(b, stem_col, "full_outer").where("in_one is null or in_two is null")
    return met.select(stem_col, F.when(F.col("in_one").isNull(), "two").otherwise("one").alias("side"))


def graph_edges(edges: DataFrame, path_col: str) -> DataFrame:
    """Edges without those of support files, which graph checks leave out."""
    return edges.where(~F.col(path_col).rlike("(^|/)support/"))


def broken_lineage(outputs: DataFrame, producers: DataFrame, producer_col: str) -> DataFrame:
    """Outputs whose producer isn't there."""
    return outputs.join(producers.select(producer_col).distinct(), producer_col, "left_anti")


def latest_state(events: DataFrame, key_col: str, state_col: str, order: list[Column]) -> DataFrame:
    """(key, state, n_states): the last state of each key."""
    return events.groupBy(key_col).agg(F.max_by(state_col, F.struct(*order)).alias("state"), F.count("*").alias("n_states"))


def routed(sources: DataFrame, destinations: DataFrame, route_col: str) -> DataFrame:
    """Sources with the destination of their route, and status: routed, or unrouted where there is none."""
    known = destinations.withColumn("status", F.lit("routed"))
    return sources.join(known, route_col, "left").withColumn("status", F.coalesce("status", F.lit("unrouted")))
