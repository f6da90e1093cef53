"""Manifests, indexes, catalogs and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.functions.text import counted, keyword_tokens, unaccented


def manifest(fragments: DataFrame, document_col: str, section_col: str, position_cols: list[str], id_col: str) -> DataFrame:
    """One row per document: sections (a sorted set), fragment_count, fragment_ids (in document order)."""
    ordered = F.array_sort(F.collect_list(F.struct(*position_cols, id_col)))
    return fragments.groupBy(document_col).agg(
        F.sort_array(F.collect_set(section_col)).alias("sections"), F.count("*").alias("fragment_count"),
        F.transform(ordered, lambda x: x[id_col]).alias("fragment_ids"))


def postings(docs: DataFrame, id_col: str, text_col: str, terms: list[str] | None = None) -> DataFrame:
    """(token, id, n) of each keyword: the long form of the keyword index, which no list bounds.

    They are counted inside the row. terms: of these alone, looked for as such, so that no
    other word is made a row.
    """
    text = F.col(text_col)
    found = keyword_tokens(text) if terms is None else F.regexp_extract_all(unaccented(text), F.lit(rf"(?<![a-z0-9])(?:{'|'.join(sorted(terms))})(?![a-z0-9])"), F.lit(0))
    return docs.select(id_col, F.inline(counted(found))).select("token", id_col, "n")


def keyword_index(found: DataFrame, id_col: str) -> DataFrame:
    """By token, the number of texts and of places. The postings stay rows, sorted by token when they are written."""
    return found.groupBy("token").agg(F.count("*").alias("n_texts"), F.sum("n").alias("n_places"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"))


def retrieve(found: DataFrame, fragments: DataFrame, id_col: str, terms: list[str], top: int = 20) -> DataFrame:
    """The top fragments for some terms: index first, fragments second.

    More different terms come first, then more places, then the smaller id.
    """
    hits = found.where(F.col("token").isin(terms)).groupBy(id_col).agg(F.count("*").alias("n_terms"), F.sum("n").alias("n_places"))
    best = hits.orderBy(F.desc("n_terms"), F.desc("n_places"), id_col).limit(top)
    return fragments.join(F.broadcast(best), id_col)  # top rows at most


def duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text_hash, n_copies, first_id) of texts that stand more than once. Nothing is dropped."""
    return (docs.groupBy(F.sha2(F.col(text_col), 256).alias("text_hash")).agg(F.count("*").alias("n_copies"), F.min(id_col).alias("first_id"))
            .where("n_copies > 1"))


def catalog(docs: DataFrame, kind_col: str, status_col: str) -> DataFrame:
    """Counts by kind and status, by kind, and of all (null: all)."""
    return docs.rollup(kind_col, status_col).agg(F.count("*").alias("n"))


def coverage_gaps(expected: DataFrame, present: DataFrame, id_col: str) -> DataFrame:
    """Rows of expected without one in present."""
    return expected.join(present.select(id_col).distinct(), id_col, "left_anti")
