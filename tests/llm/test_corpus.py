"""Operators that compare texts with each other, against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from lapidar.llm import classifier, decontamination, packing, simhash, substring_dedup
from lapidar.llm.common import connected_components
from lapidar.llm.entries import QUERIES, tokenizer_path
from lapidar.llm.matrix_sum import matrix_sum

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def roots(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_fingerprint(text):
    import xxhash

    words = [low(w) for w in WORD.findall(text or "")]
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    votes = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for i in range(64):
            votes[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(parts)) if parts else 0


def low(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def brute_components(rows):
    """rows: (doc_id, text); by row, (fingerprint, smallest id reachable)."""
    prints = [brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    group = roots(len(rows), pairs)
    least = defaultdict(lambda: None)
    for g, (i, _) in zip(group, rows):
        if i is not None and (least[g] is None or i < least[g]):
            least[g] = i
    return sorted(((i, p, least[g]) for (i, _), p, g in zip(rows, prints, group)), key=repr)


def test_gray_index_equals_all_pairs():
    rng = np.random.default_rng(1)
    for n, k in ((1, 1), (9, 2), (300, 20), (600, 3)):
        v = rng.integers(0, 2**63, k, dtype=np.uint64)[rng.integers(0, k, n)]
        for _ in range(4):
            v = v ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
        v = np.unique(v)
        rng.shuffle(v)
        near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 3
        want = roots(len(v), [(i, j) for i, j in zip(*np.nonzero(near)) if i > j])
        assert simhash.GrayIndex(v, 3).components().tolist() == want


def test_near_copies(spark, odd, odd_rows, empty, corpus, corpus_df):
    for df, rows in ((odd, [r[:2] for r in odd_rows]), (corpus_df, corpus)):
        got = sorted(((r["doc_id"], r["bits"] % 2**64, r["component_id"]) for r in simhash.near_copies(df).collect()), key=repr)
        assert got == brute_components(rows)
    assert simhash.near_copies(empty).count() == 0


def test_one_document_of_each_component_stays(spark):
    """Rows that share an id are judged by their texts; rows without id too."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    texts = ["one text of some words here", "quite another text stands there", "and a third one that is alone", "x y z"]
    rows = [(1, texts[0]), (2, texts[0]), (3, texts[1]), (2, texts[1]), (5, texts[2]), (5, texts[2]), (None, texts[0]), (None, texts[3]), (None, texts[3]), (7, None), (8, ""), (9, texts[1])]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, place int")
    kept = sorted(r["place"] for r in corpus_pipeline.near_copies(spark, df, SF).collect())
    assert kept == [0, 3, 4, 5, 7, 8, 9]
    # one id, several texts in one component: one of them stays
    near = spark.createDataFrame([(1, "", 0), (1, None, 1), (1, " ", 2), (4, "  ", 3)], "doc_id long, text string, place int")
    assert len(corpus_pipeline.near_copies(spark, near, SF).collect()) == 1


def test_hot_groups_are_dealt_out(spark):
    """One ball of fingerprints, in many small cells, is still one component."""
    rng = np.random.default_rng(2)
    v = np.full(500, 12345, np.uint64)
    for _ in range(3):
        v ^= np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)
    v = np.unique(np.append(v, np.uint64(12345)))
    rows = spark.createDataFrame([(int(x), i) for i, x in enumerate(v.view(np.int64))], "bits long, node long")
    found = connected_components(simhash.links(rows, group=64, split=40))
    assert {r["component"] for r in found.collect()} == {0} and found.count() == len(v) - 1


def test_hot_groups_by_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(0, 2**63, 12, dtype=np.uint64)[rng.integers(0, 12, 500)]
    for _ in range(4):
        v = v ^ np.where(rng.random(500) < 0.7, np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64), np.uint64(0))
    v = np.unique(v)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 3
    want = roots(len(v), [(i, j) for i, j in zip(*np.nonzero(near)) if i > j])
    rows = spark.createDataFrame([(int(x), i) for i, x in enumerate(v.view(np.int64))], "bits long, node long")
    for split in (10, 60):
        found = {r["node"]: r["component"] for r in connected_components(simhash.links(rows, group=100, split=split)).collect()}
        assert [found.get(i, i) for i in range(len(v))] == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(200, 300), (300, 250), (7, 7), (None, 3)] + [(400, 400 + i) for i in range(1, 90)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {i: 0 for i in range(1, 51)} | {300: 200, 250: 200} | {400 + i: 400 for i in range(1, 90)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_simhash_query(spark):
    rows = sorted(texts(spark).items())
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in QUERIES["op3_simhash"](spark, SF).collect()), key=repr)
    assert got == brute_components(rows)


def brute_dedup(rows, width=50):
    first, out = {}, {}
    for i, t in sorted(rows):
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for p in range(len(words) - width + 1):
            if first.setdefault(tuple(words[p : p + width]), i) < i:
                gone[p : p + width] = [True] * width
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def test_substring_dedup(spark, odd, odd_rows, empty, corpus, corpus_df):
    got = {r["doc_id"]: r for r in substring_dedup.drop_repeats(corpus_df).collect()}
    want = brute_dedup(corpus)
    assert {i: (r["n_words"], r["n_removed"], r["kept_text"]) for i, r in got.items()} == want
    assert any(w[1] for w in want.values())
    for i, r in got.items():
        assert sum(x["end"] - x["start"] for x in r["intervals"]) == r["n_removed"]
    some = substring_dedup.drop_repeats(odd).collect()
    assert len(some) == len(odd_rows) and substring_dedup.drop_repeats(empty).count() == 0
    want = brute_dedup([r[:2] for r in odd_rows if r[0] is not None])
    assert all((r["n_words"], r["n_removed"]) == want[r["doc_id"]][:2] for r in some if r["doc_id"] is not None)


def test_substring_dedup_with_short_windows(spark):
    rows = [(1, "a b c d e"), (2, "x a b c y"), (3, "a b c d e"), (4, "c d e a b c"), (5, "a b a b a b"), (6, "a b a b"), (0, "q")]
    got = substring_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), width=3, gram=2).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == brute_dedup(rows, 3)


def test_substring_dedup_query(spark):
    want = {i: (n, m, hashlib.sha256(t.encode()).hexdigest()) for i, (n, m, t) in brute_dedup(texts(spark).items()).items()}
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_substring_dedup"](spark, SF).collect()} == want


def plain_ids(some):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in some], add_special_tokens=False)]


def test_tokenizer_by_pieces():
    some = ["İstanbul Ünï a\x1cb c\xa0d x's <|endoftext|>foo 12.5 ... don't", "Xİ! don’t “q” ½ é, a\x1c!b it's x’s", "<|ENDOFTEXT|> A<|endoftext|>B", "", "  ", "a,b. c..",
            "ΑΣ ΟΔΟΣ, ǅ", "日本語 テキスト。 한국어", "ﬁ ſ Ω", "ab-cd_ef #$% 007", "á b"]
    t = packing.WordTokenizer(Path(tokenizer_path()).read_text(), cached=20)
    for _ in range(2):
        found = [t.encode(x.encode()) for x in some]
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x[:-1] for x in plain_ids(some)]


def test_tokenizer_on_marks_after_capitals():
    """Random texts of letters in both cases, marks that compose with some, digits, signs and white space; in slices too."""
    rnd = random.Random(1)
    letters = [*"aAyYTtJjHhIi ieE1=<\n'.,", *"\u030a\u0308\u030c\u0331\u0307\u0301\u0338\u0130ßéÉ日Σ\xa0\u200d\u212a\u212bǅ", "<|endoftext|>"]
    some = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14))) for _ in range(4000)] + ["Y\u030a", "T\u0308", "J\u030c", "H\u0331"]
    t = packing.WordTokenizer(Path(tokenizer_path()).read_text())
    for text, want in zip(some, plain_ids(some)):
        assert np.frombuffer(t.encode(text.encode()), "<u4").tolist() == np.frombuffer(t.encode(text.encode(), 5), "<u4").tolist() == want[:-1], ascii(text)


def check_packed(rows, want, window):
    """want: by document, the ids of each row that has it."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert docs.keys() == want.keys()
    for i, pieces in docs.items():
        if len(want[i]) == 1:
            pieces.sort(key=lambda r: r["start"])
            assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
            assert np.frombuffer(b"".join(bytes(r["ids"]) for r in pieces), "<u4").tolist() == want[i][0]
            assert all(r["doc_tokens"] == len(want[i][0]) and 4 * r["length"] == len(r["ids"]) for r in pieces)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
    fills = sorted(sum(r["length"] for r in p) for p in sequences.values())
    assert fills[-1] <= window and all(f == window for f in fills[1:])


def test_packing(spark, odd, odd_rows, empty, corpus, corpus_df):
    for df, rows in ((corpus_df, corpus), (odd, odd_rows)):
        want = defaultdict(list)
        for r, ids in zip(rows, plain_ids([r[1] for r in rows])):
            want[r[0]].append(ids)
        for window, n_open in ((4096, 16), (64, 3)):
            check_packed(packing.pack_documents(df, tokenizer_path(), window=window, open_windows=n_open).collect(), want, window)
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_packing_query(spark):
    docs = texts(spark)
    ids = dict(zip(docs, plain_ids(docs.values())))
    for r in QUERIES["op10_packing"](spark, SF).collect():
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]


def test_long_texts_in_blocks(monkeypatch):
    """Hashes, counts, fingerprints and pooled vectors don't depend on the size of the blocks they are worked out in."""
    import pyarrow as pa

    from lapidar.llm import quality_rules, textkernel

    rnd = random.Random(4)
    some = [" ".join(rnd.choice(["aé", "b", "cc", "日本", "\n", "#x"]) for _ in range(rnd.randint(0, 900))) for _ in range(9)]
    vectors = np.random.default_rng(0).standard_normal((classifier.SIZE, classifier.SLOTS)).astype(np.float32)

    def run():
        out = []
        for _, _, t in textkernel.texts_of(pa.array(some), 1 << 20):
            out += [*quality_rules.measure(t, (3, 5)).values(), simhash.fingerprints(t), *textkernel.Texts(t.data, t.offsets).windows(4)]
            out.append(np.round(classifier.pooled(t, vectors), 3))
        return out

    whole = run()
    monkeypatch.setattr(simhash, "HASHED", 50)
    monkeypatch.setattr(classifier, "PIECE", 64)
    for a, b in zip(run(), whole):
        assert np.allclose(a, b, atol=2e-3) if a.dtype == np.float32 else np.array_equal(a, b)
    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    at = np.sort(np.random.default_rng(2).integers(0, 5001, 400))
    a, z = at[:-1], at[1:]
    want = [sum((int(textkernel.LETTERS[x]) * pow(11, i, 1 << 64) for i, x in enumerate(data[s:e].tolist())), 0) % (1 << 64) for s, e in zip(a, z)]
    monkeypatch.setattr(textkernel, "CHUNK", 128)
    monkeypatch.setattr(textkernel, "_powers", {})
    got = textkernel.spans_hash(data, a, z, 11, textkernel.LETTERS)
    assert got.tolist() == textkernel.mix(np.array(want, np.uint64) + (z - a).astype(np.uint64) * textkernel._BASE).tolist()
    assert textkernel.counts_before(data, np.arange(256) > 99, at).tolist() == [int((data[:k] > 99).sum()) for k in at]
    monkeypatch.setattr(textkernel, "_powers", {})


def test_matrix_sum(spark):
    def fill(batches, matrix):
        for b in batches:
            np.add.at(matrix, b.column(0).to_numpy(), 1)

    rows = spark.range(0, 3000).selectExpr("id % 1200 as i").repartition(7)
    assert matrix_sum(rows, fill, (1200, 2)).tolist() == [[3.0 if i < 600 else 2.0] * 2 for i in range(1200)]


def test_classifier_on_held_out_rows(spark, odd, odd_rows, empty):
    """At the middle size: ranks the rows that it wasn't fitted on, and repeats itself."""
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op6_quality_classifier"](spark, sf).collect()
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels and r["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net = classifier.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    found = classifier.scored(odd, net).collect()
    assert len(found) == len(odd_rows) and len({r["score"] for r in found if r["doc_id"] in (0, 1, 2)}) == 1
    assert classifier.scored(empty, net).count() == 0
    none = classifier.train(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in classifier.scored(odd, none).collect()} == {0.5}


def test_labels_of_held_out_rows_are_not_read(spark, tmp_path):
    """Scores are the same whatever the labels of held-out rows say, and whatever other columns hold."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality", "1 - toxic as toxic")
    docs.selectExpr("doc_id", "text", "'xx' as lang", "'s' as source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    changed.write.parquet(f"{tmp_path}/labels.parquet")
    one, two = ({r["doc_id"]: round(r["score"], 6) for r in QUERIES["op6_quality_classifier"](spark, d).collect()} for d in (sf, str(tmp_path)))
    assert one == two


def test_temperature_calibrates():
    """Of labels drawn at known odds, scores come close to the share of positives; the best temperature is chosen on rows put aside."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2 * classifier.SIZE + 3))
    odds = 1 / (1 + np.exp(-1.5 * x[:, 0]))
    net = classifier.fit(np.zeros((classifier.SIZE, classifier.SLOTS), np.float32), x[:2000], (rng.random(2000) < odds[:2000]).astype(float))
    score = net.score(x[2000:])
    y = (rng.random(2000) < odds[2000:]).astype(float)
    for lo, hi in ((0, 0.3), (0.3, 0.7), (0.7, 1)):
        some = (score >= lo) & (score < hi)
        assert some.sum() > 100 and abs(score[some].mean() - y[some].mean()) < 0.1
    logit, t = net.logit(x[2000:]), net.temperature
    assert classifier._loss(logit / t, y) <= classifier._loss(logit, y) + 0.01


def test_common_order():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randint(1, 20))] for _ in range(2))
        assert decontamination.common_order(a, b) == plain(a, b)


def latent(texts):
    """Tables of decontamination for texts, as marked() builds them from its two scans."""
    import pyarrow as pa

    batch = [pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]
    counts, z = np.zeros((decontamination.SLOTS + 1, 1)), np.zeros((decontamination.SLOTS, decontamination.RANK), np.float32)
    decontamination.frequencies(iter(batch), counts)
    idf = decontamination.weights(counts)
    omega = np.random.default_rng(decontamination.SEED).standard_normal(z.shape).astype(np.float32)
    decontamination.sketch(idf, omega)(iter(batch), z)
    return decontamination.term_vectors(z, omega, idf, decontamination.common_weights(counts))


def held(texts, items, tables):
    """By text, {item: share} of what the search finds in it."""
    import pyarrow as pa

    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("share", pa.float64()), ("answer_share", pa.float64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(len(texts)), pa.int64()), pa.nulls(len(texts), kind)], ["text", "doc_id", "leaks"])
    out = next(decontamination._search(decontamination.queries(items, tables), tables, True)(iter([batch])))
    return [{x["item_id"]: x["share"] for x in found or []} for found in out.column(2).to_pylist()]


@pytest.mark.parametrize("size", [1, 3, 30, 1000])
def test_no_exact_copy_is_missed(size):
    """Items of 1 to 60 words, of rare and of frequent words, in 1 to 90 % of a corpus."""
    rnd = random.Random(size)
    common = ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as"]
    rare = lambda: "".join(rnd.choice("bcdfghjklm") for _ in range(7))
    word = lambda: rnd.choice(common) if rnd.random() < 0.5 else rare()
    lengths = [*range(1, 13), 15, 20, 31, 32, 33, 45, 60]
    items = [(k, " ".join([rare(), *(word() for _ in range(n - 1))])) for k, n in enumerate(lengths)]
    for share in (0.01, 0.3, 0.9):
        texts, want = [], []
        for i in range(size):
            own = [word() for _ in range(rnd.randint(0, 80))]
            some = rnd.sample(items, 2) if i < max(1, share * size) else []
            for _, t in some:
                at = rnd.randint(0, len(own))
                own[at:at] = [t.upper() if i % 2 else t]  # an item is one entry, so the next one doesn't cut it
            texts.append(" ".join(own))
            want.append({k for k, _ in some})
        for found, some in zip(held(texts, items, latent(texts)), want):
            assert found.keys() == some and all(found[k] == 1 for k in some)


def test_paraphrases():
    """Words replaced at random by words of other documents, at every place of a host; other items aren't named."""
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    texts = [t or "" for t in pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    tables, rnd = latent(texts), random.Random(5)
    free = [t for t, found in zip(texts, held(texts, items, tables)) if not found]
    vocabulary = [w for t in free[:300] for w in t.split()]
    for every, least in ((10, 0.98), (7, 0.97), (5, 0.95)):
        made, want = [], []
        for k, t in items * 4:
            host = rnd.choice(free).split()
            at = rnd.randint(0, len(host))
            host[at:at] = [rnd.choice(vocabulary) if rnd.random() < 1 / every else w for w in t.split()]
            made.append(" ".join(host))
            want.append(k)
        found = held(made, items, tables)
        assert sum(k in f for k, f in zip(want, found)) >= least * len(want), every
        assert all(f.keys() <= {k} for k, f in zip(want, found))


def test_latent_search_alone_leads_to_paraphrases(monkeypatch):
    """Without the lookup of shared runs, the cosine search must find most paraphrases by itself."""
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    texts = [t or "" for t in pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    tables, rnd = latent(texts), random.Random(8)
    vocabulary = [w for t in texts[:300] for w in t.split()]
    monkeypatch.setattr(decontamination, "seeded", lambda t, q: set())
    made = []
    for _, t in items * 4:
        host = rnd.choice(texts).split()
        at = rnd.randint(0, len(host))
        host[at:at] = [rnd.choice(vocabulary) if rnd.random() < 1 / 7 else w for w in t.split()]
        made.append(" ".join(host))
    assert np.mean([k in f for (k, _), f in zip(items * 4, held(made, items, tables))]) >= 0.9


def test_long_texts_are_searched_in_parts(monkeypatch):
    """The same leaks, at the same words, as in one piece; items at the cuts too."""
    from lapidar.llm.textkernel import Texts

    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("bcdfgh") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((3, 8, 30, 60))]
    own = [word() for _ in range(6000)]
    for at in range(0, 6000, 200):
        own[at] += " " + rnd.choice(items)[1]
    text = " ".join(own)
    tables = latent([text])
    whole = held([text, "x"], items, tables)
    pieces = Texts.pieces
    monkeypatch.setattr(Texts, "pieces", lambda t, words=512, overlap=0: pieces(t, words, overlap))
    assert held([text], items, tables) == whole[:1] and len(whole[0]) == 4 and np.array_equal(latent([text])[0], tables[0])


def test_leaks(spark, odd, empty):
    """Every benchmark text that stands in a document is found, and paraphrases are; clean documents aren't named."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    text, items = ({r[0]: r["text"] for r in df.collect()} for df in (docs.select("doc_id", "text"), bench))
    rnd = random.Random(2)
    hosts = list(text.values())
    vocabulary = [w for t in hosts[:100] for w in t.split()]
    made = []
    for i, t in items.items():
        w = [rnd.choice(vocabulary) if rnd.random() < 0.06 else x for x in t.upper().split() if rnd.random() > 0.05]
        host = rnd.choice(hosts).split()
        at = rnd.randrange(len(host) + 1)
        made.append((100_000 + i, " ".join(host[:at] + w + host[at:])))
    more = docs.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string")).union(odd.select("doc_id", "text").where("doc_id is null or doc_id < 3"))
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(more, bench).collect()}
    squeezed = {k: " ".join(re.findall(r"\w+", t.lower())) for k, t in text.items()}
    exact = {(d, i) for i, t in items.items() for d, x in squeezed.items() if " ".join(re.findall(r"\w+", t.lower())) in x}
    assert exact <= found
    assert sum((100_000 + i, i) in found for i in items) >= 0.95 * len(items)
    assert {f for f in found if f[0] < 100_000} - exact == set()
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.find_leaks(docs.limit(20), bench.limit(0)).count() == 0


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r["doc_id"] for r in QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.01").where("kept").collect()}
    state, ids = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = corpus_pipeline.written(stage(spark, state, "/root/testdata/sf0.01"), name)
        assert state.columns == docs.columns
        ids.append({r["doc_id"] for r in state.select("doc_id").collect()})
    assert ids[0] == kept and ids[0] > ids[1] > ids[2] == ids[3]
    first = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs.where(docs.doc_id.isin(list(ids[0])))).collect()}
    assert ids[1] == {i for i, c in first.items() if i == c}
    assert not {r["doc_id"] for r in state.where("text rlike '[0-9a-f]{16,}'").collect()}
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids[3]


def test_short_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = "quartz jumble fixing wizard sphinx vow plumage".split()
    rows = spark.createDataFrame([(9000 + i, "start " * i + " ".join(words) + " end of it and more") for i in range(12)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "start end")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs.union(rows), bench).collect()}
    assert found == {(9000 + i, 1) for i in range(12)}


def test_exact_copies_in_a_table_of_three_rows(spark):
    item = "what is the boiling point of water at the height of the sea in degrees the answer is one hundred"
    rows = spark.createDataFrame([(1, f"before it {item} after it"), (2, "nothing of that kind here at all"), (3, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "quite another text that stands nowhere in them")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"], r["share"]) for r in decontamination.find_leaks(rows, bench).collect()} == {(1, 1, 1.0), (3, 1, 1.0)}


def test_copies_of_items_that_many_rows_hold(spark):
    """Items in a third of the rows and more, among rare words, at every place; with a word changed too."""
    rnd = random.Random(6)
    rare = lambda n: ["".join(rnd.choice("bcdfghjklm") for _ in range(7)) for _ in range(n)]
    items = {1: rare(18), 2: rare(7), 3: rare(40)}
    rows = []
    for i in range(240):
        own = items[1 + i // 2 % 3] if i % 2 else []
        if i % 8 == 7:
            own = [*own[:-1], "changed"]
        rows.append((i, " ".join([*rare(i % 13), *own, *rare(i % 7)])))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert found == {(i, 1 + i // 2 % 3) for i in range(240) if i % 2}


def test_marked_carries_the_row(spark, odd, monkeypatch):
    """Items searched for in several blocks, rows kept as they are."""
    bench = spark.createDataFrame([(1, "same text here but longer than that"), (2, None), (3, ""), (4, "é word " * 9)], "item_id long, text string")
    monkeypatch.setattr(decontamination, "ITEMS", 1)
    got = decontamination.marked(odd, bench, carry=True)
    assert sorted(got.select("row.*").collect(), key=repr) == sorted(odd.collect(), key=repr)
