"""Packing of token sequences with a bounded number of open windows."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.llm.common import written

WINDOW = 4096
OPEN = 16
"""Open windows a partition keeps."""
END_ID = 2
MERGED = 256
"""Partitions whose leftovers one task merges: at most MERGED * WINDOW tokens."""
READY = 128
"""Closed windows that are handed on together."""
CACHED = 1_000_000
"""Entries of a worker's cache of tokenized pieces."""

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, leftover boolean, part long"
SLICE = 1 << 20
"""Bytes of a text that are tokenized at once; cut at white space."""
_PIECE = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]|[\x00-\x08\x0e-\x1f!-/:-@\[-`{-\x7f]+")
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_NAMES = [x.split()[0] for x in PIECE.split(", ")]


class Pieces(dict):
    """ids by piece, made when first asked for; emptied when full."""

    def __init__(self, make: Callable[[bytes], bytes | None], most: int):
        self.make, self.most = make, most

    def __missing__(self, piece: bytes) -> bytes | None:
        if len(self) >= self.most:
            self.clear()
        found = self[piece] = self.make(piece)
        return found


class WordTokenizer:
    """ids (little-endian unsigned 32-bit) of a whole text, by way of its pieces.

    The tokenizer lowers letters, drops white space, takes letters, single digits and runs
    of other signs apart, and never joins across these, so a text's ids are its pieces'
    ids in order. Pieces come back often, so they are kept in a bounded cache. Where that
    may not hold (apostrophes, names of special tokens, signs beyond ASCII), the text is
    cut at white space only.
    """

    def __init__(self, model: str, cached: int = CACHED):
        """model: what the tokenizer's file holds."""
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # for ASCII letters in lower case the steps before the model change nothing, where this holds
        direct, sample = self.tokenizer.model.tokenize, ("a", "the", "tokenizer", "qzxv")
        self.direct = direct if all([t.id for t in direct(s)] == self.tokenizer.encode(s, add_special_tokens=False).ids for s in sample) else None
        self.pieces = Pieces(self._piece, cached)
        self.words = Pieces(lambda word: self._plain(word.decode()), cached // 8)

    def _plain(self, text: str) -> bytes:
        return array(self.kind.char, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: bytes) -> bytes | None:
        """None for a piece that the normalizer may take apart."""
        text = piece.decode()
        if text.isascii():
            return array(self.kind.char, [t.id for t in self.direct(text.lower())]).tobytes() if self.direct and text.isalpha() else self._plain(text)
        # in its own case: a capital and the mark after it may not compose where the small letter does
        return self._plain(text) if self.tokenizer.normalizer.normalize_str(text).isalpha() else None

    def _slice(self, text: bytes) -> bytes:
        if b"'" not in text and b"<|" not in text:
            try:
                return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))
            except TypeError:  # None among the pieces
                pass
        return b"".join(map(self.words.__getitem__, text.split()))

    def encode(self, text: bytes, size: int = SLICE) -> bytes:
        """Slice by slice, so that the pieces of a long text are never listed at once."""
        out, at = [], 0
        while at < len(text):
            cut = _BLANK.search(text, at + size) if len(text) - at > size else None
            to = cut.start() if cut else len(text)
            out.append(np.frombuffer(self._slice(text[at:to]), self.kind).astype("<u4").tobytes())
            at = to
        return b"".join(out)


_kept: dict[str, WordTokenizer] = {}


def word_tokenizer(model: str) -> WordTokenizer:
    """One for each worker process."""
    if model not in _kept:
        _kept.clear()
        _kept[model] = WordTokenizer(model)
    return _kept[model]


class Packer:
    """Bounded-space online best fit: add() places an item, ready holds closed windows.

    An item is cut where it fills a window exactly, so only what finish() leaves is padded.
    """

    def __init__(self, window: int, n_open: int):
        self.window, self.n_open = window, n_open
        self.open: list[tuple[int, list]] = []
        self.ready: list[list] = []

    def add(self, key: tuple, start: int, ids: bytes) -> None:
        """key: (doc_id, doc_tokens); ids: 4 bytes a token."""
        at, n = 0, len(ids) // 4
        while n - at >= self.window:
            self.ready.append([(key, start + at, ids[4 * at : 4 * (at + self.window)])])
            at += self.window
        if at == n:
            return
        best = max((i for i, (fill, _) in enumerate(self.open) if fill + n - at <= self.window), key=lambda i: self.open[i][0], default=None)
        if best is None and len(self.open) >= self.n_open:
            fullest = max(range(len(self.open)), key=lambda i: self.open[i][0])
            fill, pieces = self.open.pop(fullest)
            if room := self.window - fill:
                pieces.append((key, start + at, ids[4 * at : 4 * (at + room)]))
                at += room
            self.ready.append(pieces)
            return self.add(key, start + at, ids[4 * at :])
        fill, pieces = self.open.pop(best) if best is not None else (0, [])
        pieces.append((key, start + at, ids[4 * at :]))
        if fill + n - at == self.window:
            self.ready.append(pieces)
        else:
            self.open.append((fill + n - at, pieces))

    def finish(self) -> list:
        """Merge the open windows; return the pieces of the last, not full one."""
        left = sorted(self.open, key=lambda x: -x[0])
        self.open, self.n_open = [], 1
        for _, pieces in left:
            for key, start, ids in pieces:
                self.add(key, start, ids)
        return self.open[0][1] if self.open else []


def _rows(windows: list[list], first: int, leftover: bool, part: int) -> pa.RecordBatch:
    out: list[list] = [[] for _ in _NAMES]
    for number, pieces in enumerate(windows, first):
        offset = 0
        for (doc_id, total), start, ids in pieces:
            for column, value in zip(out, (doc_id, start, len(ids) // 4, ids, total, None if leftover else number, offset, leftover, part)):
                column.append(value)
            offset += len(ids) // 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], _NAMES)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   open_windows: int = OPEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids, then end_id; null or empty text is end_id alone. Each
    partition packs its rows as they come, holding at most open_windows windows: best
    fit, else the fullest is filled up by a cut and closed. At its end it merges what is
    open, and one task for MERGED partitions merges the rest, so at most one sequence for
    MERGED partitions isn't full. Null ids stay null; rows that repeat an id are packed
    each, equal fills are taken in the order in which they were opened; an empty table
    gives no sequence; other columns are ignored. A long text is tokenized in slices, so
    next to the text and its ids a task holds a fixed amount; a run of SLICE bytes
    without white space is one slice. What the partitions pack is written to the
    shared folder once, so a lost executor doesn't deal it anew. Only leftovers are
    shuffled.
    """
    model = Path(tokenizer_path).read_text(encoding="utf-8")  # of a fixed size; executors needn't have the file

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tokens, end = TaskContext.get().partitionId(), word_tokenizer(model), np.array([end_id], "<u4").tobytes()
        packer, count = Packer(window, open_windows), part << 36
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).cast(pa.binary())
            for doc_id, text in zip(ids, texts):
                found = tokens.encode(text.as_py() or b"") + end
                packer.add((doc_id, len(found) // 4), 0, found)
                if len(packer.ready) >= READY:
                    yield _rows(packer.ready, count, False, part)
                    count += len(packer.ready)
                    packer.ready = []
        left = packer.finish()
        yield _rows(packer.ready, count, False, part)
        yield _rows([left], 0, True, part)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        packer, group = Packer(window, 1), key[0].as_py()
        for x in rows.sort_by([("part", "ascending"), ("offset", "ascending")]).to_pylist():
            packer.add((x["doc_id"], x["doc_tokens"]), x["start"], x["ids"])
        last = packer.finish()
        return pa.Table.from_batches([_rows(packer.ready + [last] * bool(last), (1 << 62) + (group << 20), False, group)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = written(rows.mapInArrow(pack, PIECE), "packed")
    rest = packed.where("leftover").groupBy(F.floor(F.col("part") / MERGED).alias("group")).applyInArrow(merge, PIECE)
    return packed.where("not leftover").unionByName(rest).drop("leftover", "part")
