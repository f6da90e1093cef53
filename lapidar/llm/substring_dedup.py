"""Substring dedup: repeated windows of a fixed number of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.llm.common import written
from lapidar.llm.textkernel import OTHER_BASE, WORD_BASE, Texts, covered, spans_hash, texts_of

WIDTH = 50
"""Words in a window."""
GRAM = 8
"""Words in a gram of the filter that goes before the count."""


def lowest(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of keys[i:i+span] for every i that has span keys."""
    width = 1
    while width * 2 <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    rest = span - width
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def marks(t: Texts, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows; for each the smallest hash of the grams in it.

    Equal windows have equal marks, and neighbours mostly share theirs.
    """
    n = len(t.starts)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, keys = t.windows(gram)
    full = np.zeros(n - gram + 1, np.uint64)
    full[at] = keys
    first = np.flatnonzero(t.doc[: n - width + 1] == t.doc[width - 1 :])
    return first, lowest(full, width - gram + 1)[first]


def later_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, text) -> (copy_id, copy_hash): rows whose whole text a document with a smaller id has."""
    hashed = rows.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("one"), F.hash("text").alias("two"), F.length("text").alias("size"))
    low = hashed.groupBy("one", "two", "size").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    found = hashed.join(written(low, "copied"), ["one", "two", "size"]).where("low < doc_id")
    return written(found.select(F.col("doc_id").alias("copy_id"), F.col("one").alias("copy_hash")).distinct(), "copies")


def repeated_windows(rows: DataFrame, by_doc: DataFrame, copies: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text) -> (doc_id, first array<int>): starts of the windows of width words
    whose word sequence also starts in a document with a smaller doc_id.

    Rabin-Karp hashes (80 bits) of the windows are counted in Spark. A lossless filter
    goes before: a window is counted only if its mark, the smallest hash among its
    grams, occurs in two documents or more, which every repeated window meets; this
    leaves one shuffled row for some 20 words instead of one a word. Counts are combined
    before the shuffle; a mark or window that a third of all documents hold meets its
    documents in a join that adaptive execution splits. by_doc: rows, dealt by doc_id;
    copies: whole texts that came before, which have no window to add.
    """
    def mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for lo, hi, t in texts_of(b.column(1)):
                first, key = marks(t, width, gram)
                doc = t.doc[first]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                doc = doc[new]
                yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(ids[lo:hi][doc]), pa.array(texts[lo:hi][doc])], ["mark", "doc_id", "text_hash"])

    found = rows.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("text")).mapInArrow(mark_rows, "mark long, doc_id long, text_hash long")
    shared = (found.groupBy("mark").agg(F.min("doc_id").alias("low"), F.min("text_hash").alias("one"), F.max("text_hash").alias("two"))
              .where("one < two").select("mark", "low"))
    # a document that is the first to hold a mark is counted for the others, but has no earlier one to ask for
    wanted = found.join(shared, "mark").groupBy("doc_id", "text_hash").agg(
        F.collect_set("mark").alias("marks"), F.collect_set(F.when(F.col("low") < F.col("doc_id"), F.col("mark"))).alias("late"))
    wanted = wanted.join(copies, (F.col("doc_id") == F.col("copy_id")) & (F.col("text_hash") == F.col("copy_hash")), "left_anti")
    wanted = written(wanted.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("marks"))).alias("marks"), F.array_distinct(F.flatten(F.collect_list("late"))).alias("late")), "marks")

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sets = b.column(0).to_numpy(zero_copy_only=False), b.column(2)
            for lo, hi, t in texts_of(b.column(1)):
                first, key = marks(t, width, gram)
                keep = np.zeros(len(first), bool)
                cut = np.searchsorted(t.doc[first], np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    if (one := sets[lo + i]).is_valid:
                        s = slice(cut[i], cut[i + 1])
                        keep[s] = np.isin(key[s], one.values.to_numpy().view(np.uint64))
                first = first[keep]
                one, two = (spans_hash(t.codes, first, first + width, base).view(np.int64) for base in (WORD_BASE, OTHER_BASE))
                begin = np.searchsorted(t.starts, t.offsets[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two.astype(np.int16)), pa.array(ids[lo:hi][t.doc[first]].astype(np.int64)), pa.array((first - begin[t.doc[first]]).astype(np.int32))],
                    ["one", "two", "doc_id", "first"])

    def windows(which: str) -> DataFrame:
        # a left join: an inner one would filter the texts below their exchange, which is to be used again
        return (by_doc.join(wanted.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", which)
                .mapInArrow(window_rows, "one long, two short, doc_id long, first int"))

    # dealt out again, for only then does adaptive execution see both sides of the join as shuffles that it can split
    lowest_doc = (windows("marks").groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high").hint("rebalance"))
    return (windows("late").join(lowest_doc, ["one", "two"]).where("low < doc_id")
            .groupBy("doc_id").agg(F.collect_set("first").alias("first")))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, intervals, kept_text.

    Words that a window covers whose sequence also starts in a document with a smaller
    id are removed; windows are judged on the input. intervals holds the maximal
    removal intervals (first word, end exclusive) in order; kept_text the other words,
    joined by one space. Null text has no words. A null id is no document with a
    smaller id and loses nothing. Rows that repeat an id keep their rows: they don't
    remove words from each other, yet share what is found for that id, and meet in one
    task; rows without id don't. Of equal windows the smallest id's stays. Empty tables
    give empty ones; other columns are ignored. A text of n bytes takes about 25 n.
    """
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = every.where("doc_id is not null")
    # texts are shuffled once; both joins with what was found use that exchange
    by_doc = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    copies = later_copies(rows)
    whole = copies.groupBy("copy_id").agg(F.collect_set("copy_hash").alias("hashes")).withColumnRenamed("copy_id", "doc_id")
    met = by_doc.join(repeated_windows(rows, by_doc, copies, width, gram).hint("shuffle_hash"), "doc_id", "left").join(whole.hint("shuffle_hash"), "doc_id", "left")
    met = met.select("doc_id", "text", "first", F.coalesce(F.array_contains("hashes", F.xxhash64("text")), F.lit(False)).alias("copy"))
    # rows without id, however many, lose nothing and aren't dealt out
    none = every.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<int>").alias("first"), F.lit(False).alias("copy"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            sets, whole = b.column(2), b.column(3)
            for lo, hi, t in texts_of(b.column(1)):
                begin = np.searchsorted(t.starts, t.offsets)
                n_words = np.diff(begin)
                removed, spans, texts = [], [], []
                for i in range(hi - lo):
                    n, first = int(n_words[i]), sets[lo + i]
                    gone = np.full(n, whole[lo + i].as_py() and n >= width)
                    if first.is_valid:
                        at = np.unique(first.values.to_numpy())
                        gone |= covered(at[at + width <= n], width, n)
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    spans.append([{"start": int(a), "end": int(e)} for a, e in zip(edge[::2], edge[1::2])])
                    removed.append(int(gone.sum()))
                    words = bytes(t.data[t.offsets[i] : t.offsets[i + 1]]).split()
                    texts.append(b" ".join(words if not spans[-1] else [words[k] for k in np.flatnonzero(~gone)]).decode())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n_words.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(spans, kinds), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "n_removed", "intervals", "kept_text"])

    # second, for the optimizer keeps names apart in the first part of a union, and then the exchange of texts would not be used again
    return none.unionByName(met).mapInArrow(
        keep, "doc_id long, n_words long, n_removed long, intervals array<struct<start: int, end: int>>, kept_text string")

