"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapidar.llm.matrix_sum import matrix_sum
from lapidar.llm.textkernel import Texts, texts_of

SLOTS = 1 << 15
"""Terms share this many rows by their hash, so every matrix has one size for any corpus."""
RANK, SHARED = 56, 8
"""Dimensions of the decomposition; the first of them, which tell languages apart, are left out."""
PASSAGE = 32
"""Words in a passage of the corpus; windows of the search have as many, or half or a fourth, by the item's length."""
LEAST = 5
"""Words in a run that leads to an item; an item with fewer is looked up as a whole, and matches nothing but itself."""
COMMON = 0.05
"""Terms in a larger share of the passages have no part in the decomposition."""
FEW = 0.25
"""Windows of items with fewer other terms (share of the width) are searched for by their common terms too."""
FLOOR = 0.05
"""Least weight of a term that the passages hold."""
SHARERS = 8
"""Runs of LEAST words that more items share are looked up only for items that have no rarer one."""
NEAR = 0.68
"""Least cosine of a candidate."""
LONG = 15
"""Items with so many words are told from chance by a smaller share of them."""
SURE, LIKELY, ANSWER = (0.8, 0.7), (0.65, 0.58), (0.75, 0.5)
"""Shares of a short and of a LONG item's words in common order with the text: enough alone; enough with the answer; of the answer's words."""
ITEMS, ITEM_BYTES = 20_000, 1 << 24
"""Items, and about their bytes, that are searched for at once; more are taken in blocks, each with a scan of its own."""
COMPARED = 1 << 22
"""Cosines held at once."""
SEED = 11

#: Words are runs of letters and digits, in lower case: signs and spacing don't matter.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1


def terms(t: Texts) -> np.ndarray:
    return (t.codes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def passages(t: Texts, width: int) -> np.ndarray:
    """Number of the passage of each word: width words of one text, the last of a text shorter."""
    many = -(-np.diff(t.first) // width)
    base = np.concatenate([[0], np.cumsum(many)])
    sizes = np.full(base[-1], width)
    some = many > 0
    sizes[base[1:][some] - 1] = np.diff(t.first)[some] - width * (many[some] - 1)
    return np.repeat(np.arange(base[-1]), sizes)


def laid_out(t: Texts, own: np.ndarray, width: int, apart: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """own (a number a word), width words to a row, SLOTS where a text has no more; apart empty
    rows after each text. And the first row of each text, with the number of rows at the end."""
    rows = -(-np.diff(t.first) // width) + apart
    base = np.concatenate([[0], np.cumsum(rows)])
    out = np.full(base[-1] * width, SLOTS)
    out[np.arange(len(own)) + np.repeat(base[:-1] * width - t.first[:-1], np.diff(t.first))] = own
    return out.reshape(-1, width), base


def added(table: np.ndarray, which: np.ndarray) -> np.ndarray:
    """By row of which, the sum of the rows of table that it names."""
    out = table[which[:, 0]]
    other = np.empty_like(out)
    for k in range(1, which.shape[1]):
        out += np.take(table, which[:, k], axis=0, out=other)
    return out


def parts_of(column: pa.Array) -> Iterator[Texts]:
    """Texts of a column, long ones in parts; PIECE is a multiple of PASSAGE, so passages are the same."""
    for _, _, t in texts_of(column, kinds=_KINDS, lower=True):
        for _, part in t.pieces():
            yield part


def frequencies(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> None:
    """Passages that hold each term; a last row counts passages."""
    for b in batches:
        for t in parts_of(b.column(0)):
            if len(t.starts):
                p = passages(t, PASSAGE)
                pairs = np.sort(p * SLOTS + terms(t))
                new = np.ones(len(pairs), bool)
                new[1:] = pairs[1:] != pairs[:-1]
                matrix[:SLOTS, 0] += np.bincount(pairs[new] % SLOTS, minlength=SLOTS)
                matrix[SLOTS, 0] += p[-1] + 1


def weights(counts: np.ndarray) -> np.ndarray:
    """Inverse document frequency for the decomposition; zero for terms that are common or not there."""
    n = max(float(counts[SLOTS, 0]), 1.0)
    share = counts[:SLOTS, 0] / n
    return np.where((share > 0) & (share <= COMMON), np.log(1 / np.maximum(share, 1e-12)) + 1e-3, 0).astype(np.float32)


def common_weights(counts: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of the terms that weights() leaves out as common; zero for all others."""
    n, found = max(float(counts[SLOTS, 0]), 1.0), counts[:SLOTS, 0]
    return np.where(found > COMMON * n, np.maximum(np.log((n + 1) / (found + 0.5)), FLOOR), 0).astype(np.float32)


def sketch(idf: np.ndarray, omega: np.ndarray):
    """fill() of A'(A omega), A the unit TF-IDF rows of all passages."""
    test = np.vstack([idf[:, None] * omega, np.zeros((1, omega.shape[1]), np.float32)])
    squares = np.append(idf, 0) ** 2

    def fill(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> None:
        sums = np.zeros((matrix.shape[1], SLOTS))
        for b in batches:
            for t in parts_of(b.column(0)):
                term = terms(t)
                if not len(term):
                    continue
                row = passages(t, PASSAGE)
                which, _ = laid_out(t, np.where(idf[term] > 0, term, SLOTS), PASSAGE)
                y = np.ascontiguousarray((added(test, which) / np.maximum(squares[which].sum(1), 1e-9)[:, None]).T)
                keep = np.flatnonzero(idf[term] > 0)
                term, row = term[keep], row[keep]
                for own, values in zip(sums, y):
                    own += np.bincount(term, values[row], minlength=SLOTS)
        matrix += (sums * idf).T.astype(np.float32)

    return fill


def term_vectors(z: np.ndarray, omega: np.ndarray, idf: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors of A from its sketch, as unit vectors of the terms at even scale, weighted by idf.

    A'A is at least z (omega' z)^-1 z', whose eigenvectors come from one decomposition of
    a matrix of SLOTS by RANK. Terms that small tables leave without a direction point
    where omega does; so do common terms, which only the second table has.
    """
    z, core = z.astype(float), omega.T.astype(float) @ z
    value, vector = np.linalg.eigh((core + core.T) / 2)
    value = np.maximum(value, max(value.max(), 1e-12) * 1e-6)
    u = np.linalg.svd(z @ (vector / np.sqrt(value)), full_matrices=False)[0][:, SHARED:]
    size = np.linalg.norm(u, axis=1, keepdims=True)
    own = omega[:, SHARED:].astype(float)
    unit = np.where((size > 1e-9) & (idf[:, None] > 0), u / np.maximum(size, 1e-12), own / np.linalg.norm(own, axis=1, keepdims=True))
    return tuple((unit * w[:, None]).astype(np.float32) for w in (idf, idf + common))


@dataclass
class Queries:
    """Windows of the items: latent unit vectors, by width the rows that are of it, and by whole
    those of the table with common terms; the items' words; seeds, sorted hashes of runs of LEAST words, with their items and places in them."""

    ids: np.ndarray
    words: list[list[bytes]]
    terms: list[set[int]]
    vectors: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    width: np.ndarray
    whole: np.ndarray
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    #: By number of words, items of fewer than LEAST words: their hashes, sorted, and the items.
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def rare_runs(run: np.ndarray, item: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of all items those that SHARERS items have at most, and the rarest of each item; sorted, the first place of each."""
    order = np.lexsort((at, item, run))
    run, item, at = run[order], item[order], at[order]
    first = np.ones(len(run), bool)
    first[1:] = (run[1:] != run[:-1]) | (item[1:] != item[:-1])
    run, item, at = run[first], item[first], at[first]
    _, which, many = np.unique(run, return_inverse=True, return_counts=True)
    sharers = many[which]
    least = np.full(item.max(initial=-1) + 1, len(run) + 1)
    np.minimum.at(least, item, sharers)
    keep = (sharers <= SHARERS) | (sharers == least[item])
    return run[keep], item[keep], at[keep]


def queries(items: list[tuple[int, str]], tables: tuple[np.ndarray, np.ndarray]) -> Queries:
    rare = tables[0].any(1)
    texts = pa.array([text for _, text in items], pa.string())
    words, sets, rows, runs, short = [], [], [], [], {}
    for lo, _, t in texts_of(texts, kinds=_KINDS, lower=True):
        term = terms(t)
        first = t.first
        at, run = t.windows(LEAST)
        runs.append((run, lo + t.doc[at], at - first[t.doc[at]]))
        for n in range(1, LEAST):
            at, run = t.windows(n)
            whole = np.diff(first)[t.doc[at]] == n
            short.setdefault(n, []).append((run[whole], lo + t.doc[at][whole]))
        for i in range(t.n):
            n = int(first[i + 1] - first[i])
            words.append([t.word(k) for k in range(first[i], first[i + 1])])
            sets.append(set(term[first[i] : first[i + 1]].tolist()))
            width = PASSAGE if n >= 0.75 * PASSAGE else PASSAGE // 2 if n >= 0.375 * PASSAGE else PASSAGE // 4
            for at in sorted({*range(0, max(n - width, 0) + 1, width), max(n - width, 0)}) if n >= LEAST else ():
                own = term[first[i] + at : first[i] + min(at + width, n)]
                for whole in (0, 1) if rare[own].sum() < FEW * width else (0,):
                    v = tables[whole][own].sum(0)
                    size = np.linalg.norm(v)
                    if size:
                        rows.append((v / size, lo + i, at, width, whole))
    cols = list(zip(*rows)) or [[], [], [], [], []]
    seeds = rare_runs(*(np.concatenate(x) for x in zip(*runs))) if runs else (np.zeros(0, np.uint64), *np.zeros((2, 0), np.int64))
    few = {}
    for n, some in short.items():
        run, item = (np.concatenate(x) for x in zip(*some))
        if len(run):
            few[n] = run[np.argsort(run, kind="stable")], item[np.argsort(run, kind="stable")]
    return Queries(np.array([k for k, _ in items]), words, sets, np.array(cols[0], np.float32).reshape(len(rows), RANK - SHARED), *(np.array(c, np.int64) for c in cols[1:]), *seeds, few)


def looked_up(keys: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in run, place in keys, which are sorted) of equal hashes."""
    known = np.zeros(1 << 20, bool)
    known[keys >> np.uint64(44)] = True
    some = np.flatnonzero(known[run >> np.uint64(44)])
    low, high = (np.searchsorted(keys, run[some], side) for side in ("left", "right"))
    many = high - low
    return np.repeat(some, many), np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())


def seeded(t: Texts, q: Queries) -> set[tuple[int, int, int]]:
    """(text, item, word where the item would begin) of the runs of LEAST words that a text shares with an
    item, and of the first place of each shorter item.

    Every exact copy has them, whatever its words weigh and wherever it stands.
    """
    out: set[tuple[int, int, int]] = set()
    if len(q.seeds):
        at, run = t.windows(LEAST)
        some, row = looked_up(q.seeds, run)
        doc = t.doc[at[some]]
        out |= set(zip(doc.tolist(), q.seed_item[row].tolist(), (at[some] - t.first[doc] - q.seed_at[row]).tolist()))
    for n, (keys, items) in q.short.items():
        at, run = t.windows(n)
        some, row = looked_up(keys, run)
        doc, item = t.doc[at[some]], items[row]
        _, first = np.unique(doc * (len(q.ids) + 1) + item, return_index=True)
        out |= set(zip(doc[first].tolist(), item[first].tolist(), (at[some][first] - t.first[doc[first]]).tolist()))
    return out


def candidates(t: Texts, vectors: np.ndarray, q: Queries, whole: int) -> set[tuple[int, int, int]]:
    """(text, item, word where the item would begin) of the windows whose cosine with one of an item reaches NEAR."""
    out: set[tuple[int, int, int]] = set()
    if not len(t.starts) or not (q.whole == whole).any():
        return out
    term = terms(t)
    step = PASSAGE // 8
    which, base = laid_out(t, term, step, apart=PASSAGE // step)
    table = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
    sums, size = added(table, which), 1
    doc = np.repeat(np.arange(t.n), np.diff(base))
    place = np.arange(len(doc)) - base[doc]  # of a row in its text
    inside = np.flatnonzero(place < (np.diff(base) - PASSAGE // step)[doc])
    for width in (PASSAGE // 4, PASSAGE // 2, PASSAGE):
        while size * step < width:  # the empty rows keep texts apart
            sums = sums[:-size] + sums[size:]
            size *= 2
        own = np.flatnonzero((q.width == width) & (q.whole == whole))
        at = inside[place[inside] % max(1, size // 4) == 0]
        many = max(64, COMPARED // max(len(own), 1))
        for lo in range(0, len(at) if len(own) else 0, many):
            some = at[lo : lo + many]
            window = sums[some]
            norm = np.sqrt(np.einsum("ij,ij->i", window, window))
            near = q.vectors[own] @ window.T
            hit = np.flatnonzero(near >= NEAR * np.maximum(norm, 1e-9))
            for a, w in zip(some[hit % len(some)].tolist(), own[hit // len(some)].tolist()):
                out.add((int(doc[a]), int(q.item[w]), int(place[a] * step - q.offset[w])))
    return out


def common_order(one: list[bytes], two: list[bytes]) -> int:
    """Length of the longest common subsequence, all columns of a row at once as bits of one number."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(one):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(one)) - 1
    row = full
    for w in two:
        if hit := places.get(w):
            met = row & hit
            row = ((row + met) | (row - met)) & full
    return len(one) - row.bit_count()


def verdict(item: list[bytes], region: list[bytes]) -> tuple[float, float]:
    """Shares of the item's words, and of its answer's (the last fifth, three words or more), that the region has in order."""
    answer = item[-max(3, len(item) // 5) :]
    return common_order(item, region) / len(item), common_order(answer, region) / len(answer)


LEAKS = "array<struct<item_id: bigint, first_word: bigint, share: double, answer_share: double>>"


def marked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, leaks (item_id, first_word, share, answer_share of each item it holds, by item).

    All texts are cut in passages of PASSAGE words. Their TF-IDF matrix is decomposed by a
    randomised method in one scan (and one for the frequencies); in the latent space
    windows of every text are compared with windows of every item in blocks, and what
    is near is checked by the longest common subsequence of words: SURE of the item's
    words, or LIKELY of them with the answer. So is what shares a run of LEAST words with
    an item, hence every exact copy, also of frequent words. Items with fewer words match
    where they stand as they are. Of several places the best is told, of equals the first.

    Null and wordless texts and items match nothing; null ids stay null; equal rows give
    equal rows; empty tables give empty ones; other columns of docs don't matter. carry:
    add the row of docs as a struct, row. Texts aren't shuffled. What the tasks and the
    driver hold has a fixed size, but for ITEMS items and ITEM_BYTES of them at a time, and
    the longest text: it is searched in parts of PIECE words that overlap by the longest item.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id is not null and text is not null")
    counts = matrix_sum(texts, frequencies, (SLOTS + 1, 1), "<f8")
    idf = weights(counts)
    omega = np.random.default_rng(SEED).standard_normal((SLOTS, RANK)).astype(np.float32)
    tables = term_vectors(matrix_sum(texts, sketch(idf, omega), (SLOTS, RANK)), omega, idf, common_weights(counts))
    rest = [F.struct(*(F.col(c) for c in docs.columns if c != text_col)).alias("rest")] if carry else []
    found = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"), F.lit(None).cast(LEAKS).alias("leaks"), *rest)
    schema = found.schema
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // ITEMS), -(-size["bytes"] // ITEM_BYTES))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        q = queries(sorted((x["item_id"], x["text"]) for x in some.collect()), tables)
        last = not carry and block == blocks - 1  # then nobody needs the texts again
        found = found.mapInArrow(_search(q, tables, not last), StructType(schema.fields[1:]) if last else schema)
    leaks = F.array_sort(F.coalesce("leaks", F.array().cast(LEAKS)))
    if not carry:
        return found.select("doc_id", leaks.alias("leaks"))
    whole = [(F.col("text") if c == text_col else F.col("rest").getField(c)).alias(c) for c in docs.columns]
    return found.select("doc_id", leaks.alias("leaks"), F.struct(*whole).alias("row"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, first_word, share, answer_share.

    As marked() finds them; rows that repeat an id and item give one row.
    """
    rows = marked(docs, benchmark, **columns).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
    best = F.max(F.struct("share", "answer_share", (-F.col("first_word")).alias("first"))).alias("best")
    return rows.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("best.first")).alias("first_word"), "best.share", "best.answer_share")


def _search(q: Queries, tables: tuple[np.ndarray, np.ndarray], with_text: bool):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("share", pa.float64()), ("answer_share", pa.float64())]))

    longest = max(map(len, q.words), default=0)
    overlap = PASSAGE + 2 * longest + 64

    def search(t: Texts, begin: int, best: dict[tuple[int, int], tuple[float, float, int]]) -> None:
        first, term, done = t.first, terms(t), set()
        for doc, item, at in sorted(candidates(t, tables[0], q, 0) | candidates(t, tables[1], q, 1) | seeded(t, q)):
            words = q.words[item]
            slack = max(8, len(words) // 4)
            if (doc, item, at // slack) in done:
                continue
            done.add((doc, item, at // slack))
            n = int(first[doc + 1] - first[doc])
            a, e = max(0, at - slack), min(n, at + len(words) + 2 * slack)
            kind = int(len(words) >= LONG)
            # each different term that isn't there costs a word of the common order
            if len(q.terms[item].difference(term[first[doc] + a : first[doc] + e].tolist())) > (1 - LIKELY[kind]) * len(words):
                continue
            share, answer = verdict(words, [t.word(k) for k in range(first[doc] + a, first[doc] + e)])
            if share >= (SURE[kind] if len(words) >= LEAST else 1) or share >= LIKELY[kind] and answer >= ANSWER[kind] and len(words) >= LEAST:
                found = (share, answer, -begin - max(0, at))
                best[doc, item] = max(best.get((doc, item), found), found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column(2).to_pylist()
            for lo, _, t in texts_of(b.column(0), kinds=_KINDS, lower=True):
                best: dict[tuple[int, int], tuple[float, float, int]] = {}
                for begin, part in t.pieces(overlap=overlap):
                    search(part, begin, best)
                for (doc, item), (share, answer, at) in best.items():
                    held[lo + doc] = [*(held[lo + doc] or []), {"item_id": int(q.ids[item]), "first_word": -at, "share": share, "answer_share": answer}]
            columns = [b.column(0), b.column(1), pa.array(held, kind), *b.columns[3:]][not with_text :]
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[not with_text :])

    return run
