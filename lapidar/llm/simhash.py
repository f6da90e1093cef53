"""SimHash near-dedup with a Gray-order hierarchical index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.llm.common import connected_components, written
from lapidar.llm.textkernel import LOWER, Texts, texts_of

SHINGLE = 3
DISTANCE = 3
SEED = 42
GROUP = 4096
"""Fingerprints a group of the search is meant to hold."""
SPLIT = 32768
"""A group with more is dealt out in cells of at most about twice as many."""
FAN = 8
"""Children of an index node."""
BITS = 64
HASHED = 1 << 16
"""Shingles whose hashes are held at once."""


def fingerprints(t: Texts, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text of a slice, unsigned."""
    import xxhash

    n, digest = len(t.starts), xxhash.xxh64_intdigest
    first_of = np.searchsorted(t.doc, np.arange(t.n + 1))
    many, to = np.diff(first_of), first_of[t.doc + 1]
    place = np.arange(n)
    begins = np.flatnonzero((place + shingle <= to) | ((place == first_of[t.doc]) & (many[t.doc] < shingle)))
    last = np.minimum(begins + shingle, to[begins]) - 1
    votes, size = np.zeros((t.n, BITS), np.int64), np.bincount(t.doc[begins], minlength=t.n)
    for at in range(0, len(begins), HASHED):
        begin, end = begins[at : at + HASHED], last[at : at + HASHED]
        a, z = t.starts[begin[0]], t.ends[end[-1]]
        solid = t.solid[a:z]
        keep = solid.copy()  # words and one separator after each
        after = t.ends[begin[0] : end[-1]] - a
        keep[after[after < z - a]] = True
        to = np.zeros(z - a + 1, np.int64)
        np.cumsum(keep, out=to[1:])
        text = np.where(solid, LOWER[t.data[a:z]], np.uint8(32))[keep].tobytes()
        hashes = np.fromiter((digest(text[i:j], SEED) for i, j in zip(to[t.starts[begin] - a].tolist(), to[t.ends[end] - a].tolist())), np.uint64, len(begin))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        doc = t.doc[begin]
        cut = np.flatnonzero(np.diff(doc, prepend=-1))
        for d, i, j in zip(doc[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(doc)]):
            votes[d] += bits[i:j].sum(0, dtype=np.int32)
    return np.packbits(2 * votes > size[:, None], axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of x in Gray order."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(k))
    return x


class GrayIndex:
    """Fingerprints sorted by Gray rank under levels of FAN children to a node.

    A node holds the bits that all fingerprints below it share and its parent's don't:
    a search adds up the differences in them on its way down and leaves a group as a
    whole once they exceed the distance. A group whose other bits can't exceed it is
    taken as a whole.
    """

    def __init__(self, values: np.ndarray, distance: int, fan: int = FAN):
        self.order = np.argsort(gray_rank(values), kind="stable")
        self.values, self.distance, self.fan = values[self.order], distance, fan
        ones, zeros = self.values, self.values
        levels = [(ones, zeros)]
        while len(ones) > fan:
            cut = np.arange(0, len(ones), fan)
            ones, zeros = np.bitwise_and.reduceat(ones, cut), np.bitwise_or.reduceat(zeros, cut)
            levels.append((ones, zeros))
        #: From the top: shared pattern, shared bits that the parent doesn't hold, bits not shared.
        self.levels, above = [], None
        for ones, zeros in reversed(levels):
            shared = ~(ones ^ zeros)
            new = shared if above is None else shared & ~np.repeat(above, fan)[: len(ones)]
            self.levels.append((ones, new, np.bitwise_count(~shared).astype(np.int64)))
            above = shared
        self.label = np.arange(len(values))

    def components(self, block: int = 256) -> np.ndarray:
        """Smallest position (in the order given) that each fingerprint reaches within this group."""
        n = len(self.values)
        for at in range(0, n, block):
            self._unite(*self._search(np.arange(at, min(n, at + block))))
        out = np.empty(n, np.int64)
        least = np.full(n, n, np.int64)
        np.minimum.at(least, self.label, self.order)
        out[self.order] = least[self.label]
        return out

    def _settled(self) -> list[np.ndarray]:
        """By level, the label that all fingerprints below a node carry, else -1."""
        out = [self.label]
        while len(out) < len(self.levels):
            below = out[-1]
            cut = np.arange(0, len(below), self.fan)
            low, high = np.minimum.reduceat(below, cut), np.maximum.reduceat(below, cut)
            out.append(np.where(low == high, low, -1))
        return out[::-1]

    def _search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links (query, fingerprint) that unite components; a group that is one already counts once."""
        settled = self._settled()
        top = len(self.levels[0][0])
        q, node, seen = np.repeat(queries, top), np.tile(np.arange(top), len(queries)), np.zeros(len(queries) * top, np.int64)
        left, right = [], []
        for depth, (pattern, new, free) in enumerate(self.levels):
            seen = seen + np.bitwise_count((self.values[q] ^ pattern[node]) & new[node])
            own = settled[depth][node]
            live = (seen <= self.distance) & (own != self.label[q])
            q, node, seen, own = q[live], node[live], seen[live], own[live]
            width = self.fan ** (len(self.levels) - 1 - depth)
            if width == 1:
                left.append(q)
                right.append(node)
                break
            whole = (seen + free[node] <= self.distance) & (own >= 0)
            left.append(q[whole])
            right.append(node[whole] * width)
            q, node, seen = q[~whole], node[~whole], seen[~whole]
            below = len(self.levels[depth + 1][0])
            many = np.minimum(self.fan, below - node * self.fan)
            child = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(node * self.fan, many)
            q, node, seen = np.repeat(q, many), child, np.repeat(seen, many)
        return np.concatenate(left), np.concatenate(right)

    def _unite(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            a, b = self.label[left], self.label[right]
            open_ = a != b
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            if not len(left):
                return
            to = np.arange(len(self.label))
            np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
            while True:
                further = to[to]
                if np.array_equal(further, to):
                    break
                to = further
            self.label = to[self.label]


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, bits long): the fingerprint of each row; null text and text without words have zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, t in texts_of(b.column(1)):
                own = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), pa.array(fingerprints(t, shingle).view(np.int64))], ["doc_id", "text_hash", "bits"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text)).mapInArrow(run, "doc_id long, text_hash long, bits long")


def links(classes: DataFrame, distance: int = DISTANCE, group: int = GROUP, split: int = SPLIT) -> DataFrame:
    """(bits, node) with distinct bits -> (src, dst): links of nodes that span, group by group,
    what lies within distance differing bits.

    The bits are cut in distance + 1 blocks; two fingerprints that close agree in one of
    them. A group holds those that agree in (some bits of) one block; in each a
    Gray-order index is searched for all. A group gives at most one link per member. One
    above split is cut again in the same way by the bits outside its block, and what is
    still above it is dealt out by pairs of its parts, so no task holds more than
    2 * split or so, however near to each other they are.
    """
    n = classes.count()
    blocks = distance + 1
    width = BITS // blocks
    use = int(min(width, 16, max(0, math.ceil(math.log2(max(n, 1) / group)))))
    part = (1 << use) - 1
    inner = (BITS - width) // blocks

    def at(bits: Column, place: int, size: int) -> Column:
        return F.shiftrightunsigned(bits, place).bitwiseAND(F.lit((1 << size) - 1).cast("long"))

    def turned(i: int, j: int) -> Column:
        """Bits of the j-th part of what lies outside of block i, taken in a circle from its end."""
        place, bits = (width * (i + 1) + inner * j) % BITS, F.col("bits")
        over = max(0, place + inner - BITS)
        return at(bits, place, inner) if not over else at(bits, place, inner - over) + F.shiftleft(at(bits, 0, over), inner - over)

    keyed = classes.select("bits", "node", F.explode(F.array(*(
        F.struct(F.lit(i).alias("block"), (at(F.col("bits"), width * i, width).bitwiseAND(F.lit(part).cast("long")) + (i << 16)).alias("key")) for i in range(blocks)))).alias("of"))
    keyed = keyed.select("bits", "node", "of.*")
    # at most blocks * 2**16 rows, whatever the input: safe to broadcast
    sizes = keyed.groupBy("key").agg((F.count("*") > split).alias("hot"))
    keyed = keyed.join(F.broadcast(sizes), "key")
    parts = F.lit(None)
    for i in range(blocks):
        parts = F.when(F.col("block") == i, F.array(*(turned(i, j) + (j << inner) for j in range(blocks)))).otherwise(parts)
    keyed = keyed.withColumn("sub", F.explode(F.when(F.col("hot"), parts).otherwise(F.array(F.lit(-1).cast("long")))))
    large = keyed.where("hot").groupBy("key", "sub").agg(F.ceil(F.count("*") / split).cast("int").alias("cells")).where("cells > 1")
    dealt = (keyed.join(large, ["key", "sub"], "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("bits"), F.col("cells")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
             .select("key", "sub", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "bits", "node"))

    def search(rows: pa.Table) -> pa.Table:
        bits, node = rows["bits"].to_numpy().view(np.uint64), rows["node"].to_numpy()
        root = GrayIndex(bits, distance).components()
        linked = root != np.arange(len(root))
        return pa.table({"src": node[linked], "dst": node[root[linked]]})

    return dealt.groupBy("key", "sub", "one", "two").applyInArrow(search, "src long, dst long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE,
                group: int = GROUP, split: int = SPLIT) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, bits (the fingerprint), component_id.

    component_id is the smallest id that links of at most distance differing bits reach.
    Rows of one fingerprint are one class before any search, so copies are never paired.
    Null and wordless texts have fingerprint zero and are linked like any other. A row
    without id is in its class but lends it no id (a class of such rows alone has a null
    component and links to nothing). A bit that half the shingles set, no more, is zero.
    Repeated rows give repeated rows, an empty table an empty one; other columns are
    ignored. A text of n bytes, however long, takes about 13 n.
    """
    marked = written(simhash(docs, id_col, text_col, shingle), "fingerprints")
    classes = written(marked.groupBy("bits").agg(F.min("doc_id").alias("node")), "classes")
    found = connected_components(links(classes.where("node is not null"), distance, group, split))
    placed = classes.join(found, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    return marked.join(placed, "bits").select("doc_id", "text_hash", "bits", "component_id")


def surplus(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash) of the rows of near_copies() that go where one document of each component stays.

    The smallest id stays; of several texts under it the one whose hash is least; of
    texts that have no id, nor a component with one, likewise within a fingerprint.
    Repeated rows are one document: they stay or go together.
    """
    group = F.when(F.col("doc_id").isNull(), F.col("bits"))
    first = found.where("doc_id <=> component_id").withColumn("group", group)
    several = first.groupBy("doc_id", "group").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low < high")
    several = several.withColumnsRenamed({"doc_id": "own_id", "group": "own_group"}).drop("high")
    met = F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("group").eqNullSafe(F.col("own_group")) & (F.col("text_hash") > F.col("low"))
    more = first.join(several, met).select("doc_id", "text_hash")
    return found.where("not (doc_id <=> component_id)").select("doc_id", "text_hash").unionByName(more).distinct()
