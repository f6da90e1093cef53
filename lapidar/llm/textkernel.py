"""Words, lines and rolling hashes of whole Arrow batches in numpy.

The separators of a word are ASCII, so all of it works on UTF-8 bytes: no Python
object is made per word. Hashes are polynomials modulo 2**64 over random letters,
taken from prefix sums, as Rabin and Karp roll them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
"""Bytes of text handled at once; a longer text is handled alone."""

PIECE = 1 << 18
"""Words of a long text that pieces() gives at once."""
_MASK = (1 << 64) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.ones(256, np.uint8)
_WORD[[0x20, *range(0x09, 0x0E)]] = 0
LOWER = np.arange(256, dtype=np.uint8)
"""By byte, A-Z in lower case."""
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n, at most CHUNK + 1."""
    if base not in _powers:
        row = np.full(CHUNK + 1, base, np.uint64)
        row[0] = 1
        _powers[base] = np.cumprod(row, dtype=np.uint64)
    return _powers[base][:n]


def sums_before(letters: np.ndarray, at: np.ndarray, base: int, table: np.ndarray | None = None) -> np.ndarray:
    """Sum of letters[i] * base**i over i below each of at (sorted); table: letters are places in it.

    CHUNK letters at a time, so that a long text takes no more than its bytes and words.
    """
    out = np.empty(len(at), np.uint64)
    total, scale, n = 0, 1, len(letters)
    for lo in range(0, max(n, 1), CHUNK):
        hi = min(n, lo + CHUNK)
        part = letters[lo:hi] if table is None else table[letters[lo:hi]]
        local = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(part * powers(base, hi - lo), out=local[1:])
        i, j = np.searchsorted(at, lo), np.searchsorted(at, hi, "right" if hi == n else "left")
        out[i:j] = np.uint64(total) + np.uint64(scale) * local[at[i:j] - lo]
        total = (total + scale * int(local[-1])) & _MASK
        scale = scale * pow(base, CHUNK, 1 << 64) & _MASK
    return out


def spans_hash(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, table: np.ndarray | None = None) -> np.ndarray:
    """Hash of letters[start:end] for each span, independent of where it stands; starts and ends are sorted."""
    total = sums_before(letters, ends, base, table) - sums_before(letters, starts, base, table)
    back = pow(base, -1, 1 << 64)
    far = np.full(len(letters) // CHUNK + 1, pow(back, CHUNK, 1 << 64), np.uint64)
    far[0] = 1
    total *= powers(back, CHUNK + 1)[starts % CHUNK]
    if len(far) > 1:
        total *= np.cumprod(far, dtype=np.uint64)[starts // CHUNK]
    return mix(total + (ends - starts).astype(np.uint64) * _BASE)


def counts_before(data: np.ndarray, mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the bytes before each of at (sorted) mask holds, CHUNK bytes at a time."""
    out = np.empty(len(at), np.int64)
    total, n = 0, len(data)
    for lo in range(0, max(n, 1), CHUNK):
        hi = min(n, lo + CHUNK)
        local = np.zeros(hi - lo + 1, np.int64)
        np.cumsum(mask[data[lo:hi]], out=local[1:])
        i, j = np.searchsorted(at, lo), np.searchsorted(at, hi, "right" if hi == n else "left")
        out[i:j] = total + local[at[i:j] - lo]
        total += int(local[-1])
    return out


_POINT = (np.arange(256) & 0xC0) != 0x80
BYTE_BASE, WORD_BASE, OTHER_BASE = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xF1357AEA2E62A9C5


class Texts:
    """Some texts of a batch: bytes, offsets, and their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray | None = None):
        """kinds: by byte, 0 for separators; a word is a run of bytes of one kind."""
        self.data, self.offsets, self.n, self.kinds = data, offsets, len(offsets) - 1, kinds
        kind = (_WORD if kinds is None else kinds)[data]
        edge = np.ones(len(data) + 1, bool)  # bytes of two kinds or of two texts meet here
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[offsets] = True
        self.solid = kind != 0
        self.starts = np.flatnonzero(self.solid & edge[:-1])
        self.ends = np.flatnonzero(self.solid & edge[1:]) + 1
        #: By text, the number of its first word; the text of each word.
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        self._codes: np.ndarray | None = None

    @property
    def codes(self) -> np.ndarray:
        """64-bit code of each word."""
        if self._codes is None:
            self._codes = spans_hash(self.data, self.starts, self.ends, BYTE_BASE, LETTERS)
        return self._codes

    def points_before(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte of at (sorted)."""
        return counts_before(self.data, _POINT, at)

    def per_text(self, where: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """Count, or sum of weights, of word (or line) rows by text index."""
        return np.bincount(where, weights, minlength=self.n).astype(np.int64)

    def windows(self, width: int, base: int = WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of width words inside one text; their hashes."""
        n = len(self.starts)
        if n < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: n - width + 1] == self.doc[width - 1 :])
        return at, spans_hash(self.codes, at, at + width, base)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text index of the \\n-split lines that have a word."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.unique(np.concatenate([self.offsets[:-1], breaks + 1]))
        starts = starts[starts < len(self.data)]
        cuts = np.unique(np.concatenate([breaks, self.offsets[1:]]))
        ends = np.where(self.data[starts] == 10, starts, cuts[np.searchsorted(cuts, starts, "right")])
        words = np.searchsorted(self.starts, ends, "left") - np.searchsorted(self.starts, starts, "left")
        keep = words > 0
        starts, ends = starts[keep], ends[keep]
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def pieces(self, words: int = PIECE, overlap: int = 0) -> Iterator[tuple[int, Texts]]:
        """(first word, Texts) of parts with that many words, and overlap of the next part's, where this is
        one longer text; else all of it."""
        n = len(self.starts)
        if self.n > 1 or n <= words + overlap:
            yield 0, self
            return
        for lo in range(0, n, words):
            part = self.data[self.starts[lo] : self.ends[min(n, lo + words + overlap) - 1]]
            yield lo, Texts(part, np.array([0, len(part)]), self.kinds)
            if lo + words + overlap >= n:
                return

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: key occurs twice or more; key equals an earlier one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice = again.copy()
    twice[order[:-1]] |= same
    return twice, again


def covered(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the n words that windows of width words at first cover."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, first, 1)
    np.subtract.at(edge, first + width, 1)
    return np.cumsum(edge[:-1]) > 0


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case; they keep their number of bytes."""
    out = LOWER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = data[latin]
    out[latin[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]] += 32
    return out


def texts_of(column: pa.Array, limit: int = CHUNK, kinds: np.ndarray | None = None, lower: bool = False) -> Iterator[tuple[int, int, Texts]]:
    """Slices (from, to, Texts) of a string column, null as empty, of about limit bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, places, bytes_ = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        part = data[offsets[at] : offsets[to]]
        yield at, to, Texts(lowered(part) if lower else part, offsets[at : to + 1] - offsets[at], kinds)
        at = to
