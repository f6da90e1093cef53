"""Quality rules by repetition coverage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lapidar.llm.textkernel import BYTE_BASE, LETTERS, Texts, counts_before, covered, mix, repeated, spans_hash, texts_of

LIMITS = {3: 0.50, 5: 0.40, 7: 0.35, 10: 0.30}
"""By n: the largest share of a text's word characters that duplicated n-grams may cover."""
LINE_LIMIT = 0.50
"""The largest share that lines equal to an earlier line may hold."""
SYMBOL_LIMIT = 0.3
"""The most symbols a word."""

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]


def measure(t: Texts, widths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts for each text of a slice."""
    n_words = len(t.starts)
    chars = t.points_before(t.ends) - t.points_before(t.starts)
    out = {"n_words": t.per_text(t.doc), "word_chars": t.per_text(t.doc, chars)}
    out["n_symbols"] = np.diff(counts_before(t.data, _SYMBOL, t.offsets))
    starts, ends, doc = t.lines()
    salt = mix(np.arange(1, t.n + 1, dtype=np.uint64))
    _, again = repeated(spans_hash(t.data, starts, ends, BYTE_BASE, LETTERS) ^ salt[doc])
    out["n_dup_lines"] = t.per_text(doc[again])
    in_words = np.zeros(n_words + 1, np.int64)
    np.cumsum(chars, out=in_words[1:])
    of_line = in_words[np.searchsorted(t.starts, ends)] - in_words[np.searchsorted(t.starts, starts)]
    out["dup_line_chars"] = t.per_text(doc[again], of_line[again])
    for n in widths:
        at, keys = t.windows(n)
        twice, _ = repeated(keys ^ salt[t.doc[at]])
        inside = covered(at[twice], n, n_words)
        out[f"dup_chars_{n}"] = t.per_text(t.doc[inside], chars[inside])
        if n == 3:
            out["n_repeat_words"] = t.per_text(t.doc[inside])
    return out


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: dict[int, float] | None = None,
                     line_limit: float = LINE_LIMIT, symbol_limit: float = SYMBOL_LIMIT, carry: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, kept.

    dup_chars_n: characters of words inside n-grams of words that occur twice or more
    in the text; dup_line_chars: of words in lines equal to an earlier line. kept:
    base_failed is false and no share exceeds its limit. Null text counts as empty,
    and an empty text fails. A null id stays null; equal rows give equal rows; an
    empty table gives an empty one; other columns of docs don't matter. A share equal to
    its limit is kept. No shuffle: one pass; texts are held in slices of a megabyte, a
    longer one by itself, at about 20 bytes for each of its own. carry: add the row of docs as a struct, row.
    """
    limits = LIMITS if limits is None else limits
    widths = tuple(sorted({3, *limits}))
    names = COLUMNS + [f"dup_chars_{n}" for n in widths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, t in texts_of(b.column(1)):
                found = measure(t, widths)
                own = b.slice(lo, hi - lo)
                passed = own.columns if carry else own.columns[:1]
                yield pa.RecordBatch.from_arrays([*passed, *(pa.array(found[n]) for n in names)], [*schema.names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *([F.struct(*(F.col(c) for c in docs.columns if c != text_col)).alias("rest")] if carry else []))
    passed = rows.schema.fields if carry else rows.schema.fields[:1]
    schema = StructType([*passed, *(StructField(n, LongType()) for n in names)])
    out = rows.mapInArrow(run, schema)
    if carry:
        whole = [F.col("text").alias(c) if c == text_col else F.col("rest").getField(c) for c in docs.columns]
        out = out.select("doc_id", F.struct(*(w.alias(c) for w, c in zip(whole, docs.columns))).alias("row"), *names)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    bad = F.col("n_symbols") > symbol_limit * F.col("n_words")
    for n, most in limits.items():
        bad |= F.col(f"dup_chars_{n}") > most * F.col("word_chars")
    bad |= F.col("dup_line_chars") > line_limit * F.col("word_chars")
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~bad)
