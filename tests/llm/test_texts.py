"""Operators that judge each text alone, against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from lapidar.llm import html_extract, license_scan, pii, quality_rules, secret_scan
from lapidar.llm.entries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def brute_rules(text):
    text = text or ""
    words, seen, dup, inside = WORD.findall(text), set(), 0, set()
    three = Counter(zip(words, words[1:], words[2:]))
    for i in range(len(words) - 2):
        if three[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def test_rules_base(odd, odd_rows, corpus_df, corpus):
    for df, rows in ((odd, odd_rows), (corpus_df, corpus)):
        found, want = by_id(quality_rules.repetition_rules(df)), {r[0]: brute_rules(r[1]) for r in rows if r[0] is not None}
        for i, w in want.items():
            r = found[i]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == w, i
            assert not (r["kept"] and r["base_failed"])


def test_rules_coverage_counts_characters_of_duplicated_ngrams(spark):
    text = " ".join(["alpha beta gamma delta epsilon"] * 2 + [f"w{i}" for i in range(60)])
    r = quality_rules.repetition_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["dup_chars_5"] == 2 * len("alphabetagammadeltaepsilon") and r["dup_chars_7"] == 0 and r["kept"]


def test_rules_carry_the_row(odd, empty):
    got = quality_rules.repetition_rules(odd, carry=True).select("row.*")
    assert got.columns == odd.columns and sorted(got.collect(), key=repr) == sorted(odd.collect(), key=repr)
    assert quality_rules.repetition_rules(empty).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_equals_the_plain_patterns():
    import random

    rnd = random.Random(7)
    for alphabet in ("a@.-_ ", "12.5 -", "+1 ()-4", "1234567890 -", "a1@.+ é"):
        for _ in range(1500):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
            assert [s[:3] for s in pii.spans_of(text) if s[1] < 4] == brute_pii(text), text


def test_pii_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE88 3704 0044 0532 0130 00")
    kinds = lambda t: [pii.KINDS[s[1]] for s in pii.spans_of(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00") == ["iban"]
    assert kinds("call 212-555-1234 now") == ["local_phone"] and kinds("part 212-555-1234 now") == []
    assert kinds("my ssn 123-45-6789") == ["national_id"] and kinds("code 123-45-6789") == []


def brute_added(text):
    """Account numbers, national ids and local phone numbers by a plain reading of the rules, with their scores."""
    out = []
    for a in range(len(text)):
        if a and text[a - 1] in "-0123456789":
            continue
        if m := re.match(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", text[a:]):
            if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
                out.append((a, 5, a + m.end()))
    for m in re.finditer(r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", text):
        out.append((m.start(), 6, m.end()))
    scored = []
    for a, k, e in out:
        hit = lambda words: any(max(0, a - 40) <= m.start() and m.end() <= a or e <= m.start() and m.end() <= e + 40
                                for w in words for m in re.finditer(rf"(?<![^\W_]){w}", text, re.I))
        score = 0.4 + 0.3 * hit(pii._CONTEXT[pii.KINDS[k]]) - 0.3 * hit(pii._AGAINST[pii.KINDS[k]])
        if score > 0.59 and not any(b < e and a < f for b, _, f in brute_pii(text)):
            scored.append((a, k, e))
    return sorted(scored)


def test_pii_added_spans_by_brute_force():
    import random

    rnd = random.Random(11)
    some = ["ssn", "tax id", "call", "fax", "part", "order", "model", "and", "é", ",", "\n", "123-45-6789", "000-12-3456", "912-34-5678", "123-00-6789", "212-555-1234", "(212) 555.1234", "212 555 1234", "1212-555-1234",
            "+1 212-555-1234", "a@b.co", "10.0.0.1", "x" * 30]
    seen = set()
    for _ in range(3000):
        text = rnd.choice([" ", "  ", ""]).join(rnd.choice(some) for _ in range(rnd.randint(1, 7)))
        want = brute_added(text)
        assert [s[:3] for s in pii.spans_of(text) if s[1] > 4] == want, text
        seen |= {k for _, k, _ in want}
    assert seen == {5, 6}


def test_pii_context_may_speak_against():
    kinds = lambda t: [pii.KINDS[s[1]] for s in pii.spans_of(t)]
    assert kinds("call us, order 212-555-1234") == [] and kinds("ssn 123-45-6789") == ["national_id"] and kinds("ssn or part 123-45-6789") == []
    score = lambda t: pii.spans_of(t)[0][3]
    assert score("server 10.1.2.3") > score("see 10.1.2.3") > score("version 10.1.2.3")


def test_pii_ibans_of_all_countries():
    """A number with right check digits is found by itself, in groups of four, and before words in capitals."""
    import random

    rnd = random.Random(2)
    for country, size in pii._LENGTHS.items():
        body = "".join(rnd.choice("0123456789") for _ in range(size - 4))
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        number = f"{country}{check:02}{body}"
        spaced = " ".join(number[i : i + 4] for i in range(0, size, 4))
        for own in (number, spaced):
            for text in (own, f"IBAN {own} BIC ABCDEF", f"{own} EUR 100"):
                assert [text[a:b] for a, b in pii.ibans(text)] == [own], text


def test_pii_ibans_among_other_words():
    one, two = "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"
    for text, want in ((f"{one} BIC COBADEFF", [one]), (f"{one} EUR 500", [one]), (f"XY12 {one} OK", [one]), (f"{one} {two} NOK 20", [one, two]), ("DE88 3704 0044 0532 0130 00 BIC", [])):
        assert [text[a:b] for a, b in pii.ibans(text)] == want


def test_pii_query(spark, odd, empty):
    assert pii.find_pii(empty).count() == 0
    assert pii.find_pii(odd).count() == odd.count()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op1_pii"](spark, SF).collect():
        want = brute_pii(docs[r["doc_id"]])
        text = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[1] == k for x in want) for k in range(4)]


ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)


def brute_secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secrets_base_and_mask(spark, odd, empty):
    import random

    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["token", "secret", " ", "=", ":", '"', "abc", "0123456789ab", "AKIA", "ABCDEFGHIJKLMN", "é", "\n"]) for _ in range(rnd.randint(1, 30))) for _ in range(150)]
    df = spark.createDataFrame([*enumerate(texts), (1000, "é token = 'abcdefabcdefabcdef' end")], "doc_id long, text string")
    found = secret_scan.find_secrets(df)
    for r in found.collect():
        assert [tuple(s) for s in r["spans"] if s["kind"] != "random"] == brute_secrets(r["text"])
    masked = {r["doc_id"]: r["m"] for r in found.select("doc_id", secret_scan.masked().alias("m")).collect()}
    assert masked[1000] == "é [SECRET]' end"
    assert secret_scan.find_secrets(empty).count() == 0
    same = secret_scan.find_secrets(odd, carry=True)
    assert sorted(same.select("row.*").collect(), key=repr) == sorted(odd.collect(), key=repr)


def test_secrets_battery(spark):
    """Random strings pass as random, patterned ones don't."""
    import random

    rnd = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    fair = ["".join(rnd.choice(alphabet) for _ in range(40)) for _ in range(60)]
    plain = [("ab1" * 20)[:40], "a" * 39 + "1", "abcdefghijklmnopqrstuvwxyz01234567890abc", "x1" * 20]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(fair + plain)], "doc_id long, token string")
    from pyspark.sql import functions as F

    p = {r["doc_id"]: r["p"] for r in df.select("doc_id", secret_scan.randomness(F.col("token")).alias("p")).collect()}
    assert np.mean([p[i] > 0.01 for i in range(60)]) > 0.9
    assert all(p[60 + i] < 1e-3 for i in range(len(plain)))


def brute_p(token):
    """p-value of the battery by the standard library."""
    import math

    tail = lambda z: math.erfc(z / 2**0.5) / 2
    letters = next(a for pattern, a in secret_scan.ENCODINGS if re.search(pattern, token))
    n, m = len(token), len(letters)
    values = [letters.index(c) + 1 for c in token]
    chi = (m / n * sum(token.count(c) ** 2 for c in letters) - n - (m - 1)) / math.sqrt(2 * (m - 1) * (n - 1) / n)
    above = [v > m / 2 for v in values]
    twice, runs = 2 * sum(above) * (n - sum(above)), 1 + sum(a != b for a, b in zip(above, above[1:]))
    var = twice * (twice - n) / (n * n * (n - 1))
    run_z = (runs - 1 - twice / n) / math.sqrt(var) if var > 0 else math.sqrt(n)
    mean = sum(values) / n
    own = sum((v - mean) ** 2 for v in values)
    serial = (sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / own + 1 / n) * math.sqrt(n) if own else math.sqrt(n)
    e = sum(-math.log(min(max(p, 1e-30), 1.0)) for p in (tail(chi), 2 * tail(abs(run_z)), 2 * tail(abs(serial))))
    return math.exp(-e) * (1 + e + e * e / 2)


def brute_cutoffs(tokens, rate):
    """By class of length, the largest binned p-value that the step-up rule of Benjamini and Hochberg puts aside."""
    import math

    groups = {}
    for t in set(tokens):
        groups.setdefault(min(int(math.log2(len(t))), secret_scan.CLASSES - 1), []).append(min(int(-math.log10(max(brute_p(t), 1e-300)) * 10), secret_scan.LAST_BIN))
    out = {}
    for size, bins in groups.items():
        ordered = sorted(bins, reverse=True)  # the least p-value first
        fits = [b for b in set(ordered) if 10 ** (-b / 10) <= rate * sum(x >= b for x in ordered) / len(ordered)]
        out[size] = min(fits, default=secret_scan.LAST_BIN + 1)
    return out


def test_random_spans_by_brute_force(spark):
    """Cutoffs, verdicts and places; and how much of what is random is told from names that aren't."""
    import math
    import random

    rnd = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    fair = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(20, 70))) for _ in range(300)]
    parts = ["get", "User", "Name", "value", "Table", "index", "2020", "of", "v2", "List", "Item", "count", "Order", "max", "10", "Http", "server", "test"]
    names = ["_".join(rnd.choice(parts) for _ in range(rnd.randint(5, 12))) + "1a" for _ in range(300)]
    plain = ["ab1" * 9, "1a" * 14, "x" * 25 + "9z", "0123456789abcdefghijk", "just words here", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    rows = []
    for i in range(150):
        some = [rnd.choice([fair, names, plain])[0:][rnd.randrange(6)] if rnd.random() < 0.2 else rnd.choice(rnd.choice([fair, names, plain])) for _ in range(rnd.randint(0, 6))]
        if i % 9 == 0:
            some.insert(0, "token = " + rnd.choice(fair))
        rows.append((i, rnd.choice([" ", "\n", " é, "]).join(some)))
    rows += [(1000 + i, t) for i, t in enumerate(fair + names)]
    mixed = lambda t: bool(re.search("[0-9]", t) and re.search("[A-Za-z]", t) and not re.search("^[A-Za-z]*[0-9]{1,4}$", t))
    found = {i: [(m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", t) if mixed(m[0])] for i, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = brute_cutoffs([t for some in found.values() for _, _, t in some], secret_scan.FALSE_DISCOVERY)
    got = secret_scan.cutoffs(df.select("text"))
    assert got.keys() == cut.keys() and all(abs(got[k] - cut[k]) <= 1 for k in cut)
    spans = {r["doc_id"]: {(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "random"} for r in secret_scan.find_secrets(df).collect()}
    for i, text in rows:
        base = brute_secrets(text)
        for a, e, token in found[i]:
            k = min(int(math.log2(len(token))), secret_scan.CLASSES - 1)
            b = min(int(-math.log10(max(brute_p(token), 1e-300)) * 10), secret_scan.LAST_BIN)
            if abs(b - cut[k]) > 1:  # at the border rounding may decide
                assert ((a, e) in spans[i]) == (b < cut[k] and not any(s < e and a < z for s, _, z, _ in base)), token
        assert spans[i] <= {(a, e) for a, e, _ in found[i]}
    random_found = np.mean([bool(spans[1000 + i]) for i, t in enumerate(fair) if mixed(t) and not brute_secrets(t)])
    names_found = np.mean([bool(spans[1300 + i]) for i in range(len(names))])
    print("random", random_found, "names", names_found)
    assert random_found >= 0.85 and names_found <= 0.1


def test_secrets_query_counts(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_secret_scan"](spark, SF).collect():
        want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in brute_secrets(docs[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def brute_mask(text, spans):
    out, at = "", 0
    for a, b in spans:
        if b > at:
            out += "" if a < at else text[at:a] + secret_scan.MASK
            at = b
    return out + text[at:]


def test_masked_by_brute_force(spark):
    import random

    rnd = random.Random(9)
    rows = []
    for i in range(200):
        text = "".join(rnd.choice("ab é日\ufeff\U0001f600") for _ in range(rnd.randint(0, 30)))
        spans = sorted((a, rnd.randint(a + 1, len(text))) for a in (rnd.randrange(len(text)) for _ in range(rnd.randint(0, 5) if text else 0)))
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start: int, end: int>>")
    got = {r["doc_id"]: r["m"] for r in df.select("doc_id", secret_scan.masked().alias("m")).collect()}
    for i, text, spans in rows:
        assert got[i] == brute_mask(text, spans)


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_licenses(text):
    words, places, similar = ALNUM.findall(low(text)), [], {}
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        places += [(label, i) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    for block, line in enumerate((text or "").split("\n")):
        own, met = set(ALNUM.findall(low(line))), []
        for label, notices in license_scan.TEMPLATES.items():
            names = set(license_scan.NAMES.get(label, "").split())
            for notice in notices:
                t = set(ALNUM.findall(low(notice)))
                if len(own & t) >= license_scan.need(len(t), license_scan.CONTAINMENT) and names & t <= own:
                    met.append((len(own & t) / len(t), len(own & t), label, t))
        for share, n, label, t in met:
            if not any(other != label and (s, m) > (share, n) and len(t & u) >= license_scan.need(len(t), license_scan.CONTAINMENT) for s, m, other, u in met):
                similar[label, block] = max(similar.get((label, block), 0), share)
    return len(words), sorted(places), sorted((a, b, s) for (a, b), s in similar.items())


def test_licenses(spark, odd, odd_rows, empty):
    import random

    rnd = random.Random(4)
    some = ["cc", "by", "nc", "sa", "all", "rights", "reserved", "the", "mit", "license", "released", "under", "licensed", "apache", "version", "2", "0", "4", "é", "General", "PUBLIC", "gnu", "affero", "3"]
    texts = [rnd.choice([" ", "\n", ", "]).join(rnd.choice(some) for _ in range(rnd.randint(1, 45))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.find_licenses(df).collect():
        assert (r["n_words"], sorted(map(tuple, r["places"])), [tuple(s) for s in r["similar"]]) == brute_licenses(texts[r["doc_id"]])
    found = license_scan.find_licenses(odd).collect()
    assert len(found) == len(odd_rows)
    want = {i: len(ALNUM.findall(low(t))) for i, t, *_ in odd_rows if i is not None}
    assert all(r["n_words"] == want[r["doc_id"]] for r in found if r["doc_id"] is not None)
    assert license_scan.find_licenses(empty).count() == 0


#: Labels as a reader would give them; the table doesn't come from the templates.
LABELS = [
    ("Licensed under CC BY 4.0.", {"cc-by"}), ("This text is licensed under CC-BY-NC 4.0, see there", {"cc-by-nc"}), ("licensed under cc by-sa 4.0", {"cc-by-sa"}),
    ("Licensed under CC BY-NC-SA 4.0.", {"cc-by-nc-sa"}), ("This work is licensed under the GNU General Public License, version 3.", {"gpl"}),
    ("This program is licensed under the GNU Affero General Public License, version 3.", {"agpl"}), ("This work is licensed under the GNU Lesser General Public License, version 3.", {"lgpl"}),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"cc-by"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"cc-by-nc"}),
    ("Released under the Apache License", set()), ("Released under the MIT license", {"mit"}), ("Under the new license he was released", set()),
    ("Licensed under the Apache License, Version 2.0", {"apache-2.0"}), ("all the rights are reserved for the members", {"reserved"}), ("All rights of the others", set()),
    ("/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
     " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */", {"gpl"}),
    ("/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU Affero General Public License as published\n * by the Free Software Foundation\n */", {"agpl"}),
    ("Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\n"
     "this license (the \"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works", {"boost"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software", {"mit"}),
]


def test_licenses_by_hand(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(LABELS)], "doc_id long, text string")
    for r in license_scan.find_licenses(rows).collect():
        assert {x["label"] for x in [*r["similar"], *r["wrapped"]]} == LABELS[r["doc_id"]][1], LABELS[r["doc_id"]][0]


def test_many_matches_in_one_text(spark):
    """Work in the matches of a text is linear: 200,000 of them take seconds."""
    import time

    n = 200_000
    rows = spark.createDataFrame([(1, "x ".join(f"{i:016x}" for i in range(n))), (2, " cc by " * n)], "doc_id long, text string").cache()
    rows.count()
    began = time.time()
    some = secret_scan.find_secrets(rows).select("doc_id", "spans", secret_scan.masked().alias("m")).where("doc_id = 1").first()
    assert len(some["spans"]) == n and some["m"] == "x ".join(["[SECRET]"] * n)
    found = {r["doc_id"]: r["places"] for r in license_scan.find_licenses(rows).collect()}
    assert [x["start"] for x in found[2]] == list(range(0, 2 * n, 2)) and not found[1]
    assert time.time() - began < 120


def test_licenses_over_several_lines(spark, tmp_path):
    """Notices wrapped as license files and headers do; words that stand far apart, or in two paragraphs, are none."""
    import textwrap

    rows, want = [], {}
    for mark in ("", " * ", "# ", "// "):
        for label, notices in license_scan.TEMPLATES.items():
            for notice in notices:
                for width in (24, 72) if len(notice) > 72 else (24,):
                    text = "\n".join(mark + line for line in textwrap.wrap("Copyright 2020 of someone. " + notice + " And more of the same, as far as it goes.", width))
                    rows.append((len(rows), f"{mark}Name\n{mark.rstrip()}\n{text}\n{mark}\n{mark}end"))
                    want[rows[-1][0]] = label
    rows += [(1000, "der Mann mit\n" + "und so weiter\n" * 9 + "under the license"), (1001, "Released under\n#\nthe MIT License"), (1002, "Released under\nthe MIT License")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: {(x["label"], x["share"]) for x in r["wrapped"]} for r in license_scan.find_licenses(df).collect()}
    assert all((label, 1.0) in found[i] for i, label in want.items())
    assert found[1000] == found[1001] == set() and found[1002] == {("mit", 1.0)}
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op5_license_scan"](spark, str(tmp_path)).collect()}
    assert all(label in rows[i]["labels"].split(",") and rows[i]["score"] == 1 for i, label in want.items())
    assert rows[1000]["labels"] == rows[1001]["labels"] == "" and rows[1000]["score"] == 0


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>", ""), ("just words", "just words"),
    ("<html><body><nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p>One\n two<br>three.</p><p>Short</p></article><footer>&copy; us</footer></body>", "T & U\n\nOne two three.\n\nShort"),
    ("<body><script>var a='<p>no</p>'</script><style>p{}</style><article><p>Text<!-- no --> here</p><div class='comments'><p>Nice one</p></div></article></body>", "Text here"),
    ("<article><p>First</p><div class=\"ad\">Buy</div><p>Last <b>bold</b> word</article>", "First\n\nLast bold word"),
    ("<body><div class=cookie-notice>We use them</div><article><ul><li>a<li>b</ul></article>", "a\n\nb"),
    ("<p><b>Open<br><p>Next</p>", "Open\n\nNext"),
    ("<div class='site-header'>Site</div><article><div class='article-header'><h1>T</h1></div><p>x</p></article>", "T\n\nx"),
    ("<main><p>x</p><section id=replies><p>y</p></section><form><label>Name</label></form></main>", "x"),
])
def test_html(page, want):
    assert html_extract.main_text(page) == want


_TOLD = "The council said on Monday that it would rebuild the old bridge over the river before the winter, and that the cost would be shared with the region."


@pytest.mark.parametrize("page, want", [
    (f"<div>Home | News</div><h1>Bridge to be rebuilt</h1><p>{_TOLD}</p><p>It is late.</p><p>{_TOLD} {_TOLD}</p><div>Copyright 2020 Town. All rights reserved.</div>",
     ["Bridge to be rebuilt", _TOLD, "It is late.", f"{_TOLD} {_TOLD}"]),
    (f"<div><div>Site name</div><div><a href=a>Home</a> <a href=b>About us</a></div></div><div><div>{_TOLD}</div><div>{_TOLD} {_TOLD}</div></div><div>Made by us</div>", [_TOLD, f"{_TOLD} {_TOLD}"]),
    (f"<h1>Words of the head</h1><p>{_TOLD}</p><p><a href=x>{_TOLD}</a></p><p>{_TOLD}</p><ul><li><a href=q>One more</a></li><li><a href=q>Two more of it</a></li></ul>", ["Words of the head", *[_TOLD] * 3]),
    (f"<div class='layout has-sidebar'><article><h1>T</h1><p>{_TOLD}</p></article></div>", ["T", _TOLD]),
    (f"<div class=no-sidebar><h1>T</h1><p>{_TOLD}</p><p>{_TOLD}</p></div>", ["T", _TOLD, _TOLD]),
    (f"<form id=aspnetForm><h1>T</h1><p>{_TOLD}</p><p>{_TOLD}</p><div class=menu>Files</div></form>", ["T", _TOLD, _TOLD]),
    (f"<nav><a href=x>a</a></nav><article><div class=legal-text><p>{_TOLD}</p><p>{_TOLD}</p></div><div class=legal>Ours</div></article><footer>f</footer>", [_TOLD, _TOLD]),
    (f"<article><div>{_TOLD}</div><div class=ad>Buy it</div><div>Short</div><div><a href=x>Link</a></div></article><div>{_TOLD}</div>", [_TOLD, "Short", "Link"]),
    (f"<div>{_TOLD}</div><div>{_TOLD}</div>", [_TOLD, _TOLD]),
])
def test_html_of_other_layouts(page, want):
    """Pages that are not in the labelled table, most of them without names that tell."""
    assert html_extract.main_text(page).split("\n\n") == want


def test_html_tree_decides_on_words_links_and_neighbours():
    used = set()

    def walk(t):
        if t.feature >= 0:
            used.add(html_extract.FEATURES[t.feature])
            walk(t.low)
            walk(t.high)

    tree = html_extract.classifier()
    walk(tree)
    assert used >= {"words", "link_density"} and used & {"words_before", "words_after", "words_near"}
    x, _ = html_extract.labelled()
    x = np.random.default_rng(1).permuted(np.tile(x, (20, 1)), axis=0)  # any mixture of values
    x[:, [html_extract.FEATURES.index(c) for c in ("marked", "inside", "outside")]] = 0, 1, 0
    assert (tree(x) > 0.5).all()  # nothing of an article goes but what a mark names
    x[:, html_extract.FEATURES.index("marked")] = 1
    assert (tree(x) <= 0.5).all()


def test_html_in_linear_time():
    import time

    n = 50_000
    for page in ("<div>" * n + "</span>" * n, "<span class=x>" * n + "<p>t</p>" * n, "<li><b id=q>" * n, "<article>" * n + "x", '<a href="' * n, "<p><table>" * n + "<div>a</div>" * n, "a < b " * n):
        began = time.time()
        html_extract.main_text(page)
        assert time.time() - began < 20


def test_html_tables(spark, empty):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<article><p>a</p></article>", "x"), (2, "u", "<p>" * 3000 + "deep", "x")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert got == {1: "", None: "a", 2: "deep"}
    assert html_extract.extract(pages.limit(0)).count() == 0
    import html as h

    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op8_html_extraction"](spark, SF).collect():
        inner = re.search(r"(?s)<article>(.*)</article>", rows[r["page_id"]])[1]
        parts = (" ".join(h.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])
