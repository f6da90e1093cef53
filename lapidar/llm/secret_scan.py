"""Secret scan: fixed patterns, and a battery of randomness tests. DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.llm.common import let, running

#: By kind: the pattern, and the group whose length must reach the least. A run of hex
#: digits, or of AKIA and what follows, is one match whatever its length, so the least
#: can stand in those patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_ASSIGN = 12
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
"""What the battery judges: whole runs of 20 or more characters of the encodings."""
FALSE_DISCOVERY = 0.05
"""Largest share of random strings among those put aside as not random, in each class of length."""
BIN, LAST_BIN, CLASSES = 10.0, 300, 12
"""p-values are counted in bins of 1/BIN decades, up to LAST_BIN; lengths in CLASSES powers of two."""
MASK = "[SECRET]"

_DIGITS, _LOWER, _UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
#: Encodings in order of trial: pattern, alphabet.
ENCODINGS = [
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"), (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"), (r"^[A-Z2-7]+$", _UPPER + "234567"),
    (r"^[a-z0-9]+$", _DIGITS + _LOWER), (r"^[A-Z0-9]+$", _DIGITS + _UPPER), (r"^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    (r"^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"), (r"", _UPPER + _LOWER + _DIGITS + "-_+/"),
]


def _places(text: Column, pattern: str, group: Column | None = None, least: int = 0) -> Column:
    """array<struct<start, end>> of the matches; group: text of a group of each, least its least length."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.struct(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(found, F.length).alias("own"))

    def walked(x: Column) -> Column:
        steps = F.zip_with(F.slice(x["gap"], 1, F.size(x["own"])), x["own"], lambda gap, own: gap + own)
        ends = let(steps, lambda s: running(s, lambda a, b: a + b))
        return F.zip_with(ends, x["own"], lambda end, own: F.struct((end - own).alias("start"), end.alias("end")))

    places = let(sizes, walked)
    if group is None:
        return places
    return F.filter(F.zip_with(places, group, lambda w, g: F.struct(w["start"].alias("start"), w["end"].alias("end"), F.length(g).alias("size"))), lambda x: x["size"] >= least)


def _tail(z: Column) -> Column:
    """Share of the normal law above z (error below 1e-7)."""
    # fixed values: the rational approximation 7.1.26 of Abramowitz and Stegun
    c = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

    def above(x: Column) -> Column:
        poly = let(1 / (1 + 0.3275911 * x), lambda t: t * (c[0] + t * (c[1] + t * (c[2] + t * (c[3] + t * c[4])))))
        return 0.5 * poly * F.exp(-x * x)

    return F.when(z >= 0, let(F.abs(z) / 2**0.5, above)).otherwise(1 - let(F.abs(z) / 2**0.5, above))


def _sum(values: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + term(x))


def _encoding(token: Column) -> Column:
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(token.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    return alphabet


def randomness(token: Column) -> Column:
    """p-value of a string under the law that its symbols are drawn evenly and alone.

    Chi-squared over the alphabet of the inferred encoding, runs above and below its
    middle, and correlation of neighbours, combined as Fisher does. Work grows with the
    string's length, not its square.
    """
    def symbols(x: Column) -> Column:
        text, letters = x["text"], x["letters"]
        return F.struct(
            F.length(letters).cast("double").alias("m"), F.length(text).cast("double").alias("n"),
            _sum(F.filter(F.split(letters, ""), lambda c: c != ""), lambda c: F.pow(F.length(text) - F.length(F.replace(text, c, F.lit(""))), F.lit(2.0))).alias("squares"),
            F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.position(c, letters).cast("double")).alias("values"))

    def pairs(x: Column) -> Column:
        return F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def sums(x: Column) -> Column:
        n, m = x["n"], x["m"]
        return F.struct(
            n.alias("n"), ((m / n * x["squares"] - n - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n)).alias("chi"),
            _sum(x["values"], lambda v: F.when(v > m / 2, 1.0).otherwise(0.0)).alias("high"),
            (1 + _sum(pairs(x["values"]), lambda p: F.when((p["a"] > m / 2) != (p["b"] > m / 2), 1.0).otherwise(0.0))).alias("runs"),
            let(_sum(x["values"], lambda v: v) / n, lambda mean: F.struct(
                _sum(x["values"], lambda v: (v - mean) * (v - mean)).alias("own"), _sum(pairs(x["values"]), lambda p: (p["a"] - mean) * (p["b"] - mean)).alias("next"))).alias("spread"))

    def tests(x: Column) -> Column:
        n, twice = x["n"], 2 * x["high"] * (x["n"] - x["high"])
        run_z = let(F.struct(twice.alias("twice"), (twice * (twice - n) / (n * n * (n - 1))).alias("var")),
                     lambda y: F.when(y["var"] > 0, (x["runs"] - 1 - y["twice"] / n) / F.sqrt(y["var"])).otherwise(F.sqrt(n)))
        serial_z = F.when(x["spread"]["own"] > 0, (x["spread"]["next"] / x["spread"]["own"] + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        return F.array(_tail(x["chi"]), 2 * let(F.abs(run_z), _tail), 2 * let(F.abs(serial_z), _tail))

    start = F.struct(token.alias("text"), _encoding(token).alias("letters"))
    both = let(let(let(start, symbols), sums), tests)
    evidence = _sum(both, lambda p: -F.log(F.least(F.greatest(p, F.lit(1e-30)), F.lit(1.0))))
    return let(evidence, lambda e: F.exp(-e) * (1 + e + e * e / 2))  # chi-squared of six degrees above 2 * e


def _mixed(token: Column) -> Column:
    """A digit, and a letter that is not the first of a word in capitals: prose and names lack one."""
    return token.rlike("[0-9]") & token.rlike("[A-Za-z]") & ~token.rlike("^[A-Za-z]*[0-9]{1,4}$")


def _class(token: Column) -> Column:
    return F.least(F.floor(F.log2(F.length(token).cast("double"))).cast("int"), F.lit(CLASSES - 1))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BIN).cast("int"), F.lit(LAST_BIN))


def cutoffs(rows: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[int, int]:
    """By class of length, the least bin whose strings are put aside as not random.

    Benjamini and Hochberg's step-up rule over the distinct candidates of all rows, from
    counts in bins: at most CLASSES * (LAST_BIN + 1) counts reach the driver, whatever the input.
    """
    token = F.explode(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).alias("token")
    tokens = rows.where(F.col("text").rlike(CANDIDATE)).select(token).where(_mixed(F.col("token"))).distinct()
    counts = tokens.select(_class(F.col("token")).alias("size"), _bin(randomness(F.col("token"))).alias("bin")).groupBy("size", "bin").count().collect()
    out = {}
    for size in {x["size"] for x in counts}:
        own = sorted(((x["bin"], x["count"]) for x in counts if x["size"] == size), reverse=True)
        total, below, cut = sum(n for _, n in own), 0, LAST_BIN + 1
        for b, n in own:
            below += n
            if 10 ** (-b / BIN) <= rate * below / total:
                cut = b
        out[size] = cut
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY,
                 carry: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, text, spans array<struct<start, rank, end, kind>> in order of start, then kind.

    Kinds assign, access and hex hold all leftmost non-overlapping matches that are long
    enough; random holds runs of 20 or more characters with letters and digits that the
    battery doesn't put aside and that no other span overlaps. Null text counts as
    empty; null ids stay null; equal rows give equal rows; an empty table gives an empty
    one; other columns don't matter. Two scans, no shuffle of texts, no Python. carry: add
    the row of docs as a struct, row.
    """
    whole = [F.struct(*docs.columns).alias("row")] if carry else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *whole)
    names = ["row"] * carry
    cut = cutoffs(rows.select("text"), rate)
    text = F.col("text")
    none = F.expr("cast(array() as array<struct<start: int, rank: int, end: int, kind: string>>)")

    def spans(places: Column, rank: int) -> Column:
        return F.transform(places, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(KINDS[rank]).alias("kind")))

    assign = F.when(text.rlike("[:=]") & text.rlike(ASSIGN), spans(_places(text, ASSIGN, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), LEAST_ASSIGN), 0)).otherwise(none)
    access = F.when(text.contains("AKIA") & text.rlike(ACCESS), spans(_places(text, ACCESS), 1)).otherwise(none)
    hexes = F.when(text.rlike(HEX), spans(_places(text, HEX), 2)).otherwise(none)
    runs = F.filter(
        F.zip_with(_places(text, CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda w, g: F.struct(w["start"].alias("start"), w["end"].alias("end"), g.alias("token"))),
        lambda x: _mixed(x["token"]))

    def random(x: Column) -> Column:
        size, most = _class(x["token"]), F.lit(LAST_BIN + 1)
        for k, b in sorted(cut.items()):
            most = F.when(size == k, F.lit(b)).otherwise(most)
        return _bin(randomness(x["token"])) < most  # put aside from the cut on

    found = rows.select("doc_id", "text", *names, F.array_sort(F.concat(assign, access, hexes)).alias("base"), F.when(text.rlike(CANDIDATE), runs).alias("runs"))
    free = F.filter(_apart("runs", "base"), random)
    added = F.when(F.size("runs") > 0, spans(free, 3)).otherwise(none)
    return found.select("doc_id", "text", *names, F.array_sort(F.concat("base", added)).alias("spans"))


def _apart(runs: str, base: str) -> Column:
    """Those of runs, which don't overlap each other, that no span of base overlaps."""
    every = F.array_sort(F.concat(
        F.transform(base, lambda x: F.struct(x["start"].alias("start"), F.lit(0).alias("run"), x["end"].alias("end"), F.lit("").alias("token"))),
        F.transform(runs, lambda x: F.struct(x["start"].alias("start"), F.lit(1).alias("run"), x["end"].alias("end"), x["token"].alias("token")))))
    most = F.lit((1 << 31) - 1)

    def scans(x: Column) -> Column:
        ends = F.transform(x, lambda s: F.when(s["run"] == 0, s["end"]).otherwise(0))
        starts = F.transform(F.reverse(x), lambda s: F.when(s["run"] == 0, s["start"]).otherwise(most))
        return F.struct(x.alias("spans"), let(ends, lambda e: running(e, F.greatest)).alias("reached"), F.reverse(let(starts, lambda s: running(s, F.least))).alias("next"))

    def chosen(x: Column) -> Column:
        placed = F.zip_with(F.zip_with(x["spans"], x["reached"], lambda s, e: F.struct(s.alias("span"), e.alias("reached"))), x["next"],
                            lambda s, n: F.struct(s["span"].alias("span"), s["reached"].alias("reached"), n.alias("next")))
        kept = F.filter(placed, lambda s: (s["span"]["run"] == 1) & (s["reached"] <= s["span"]["start"]) & (s["next"] >= s["span"]["end"]))
        return F.transform(kept, lambda s: s["span"])

    return F.when(F.size(base) == 0, F.transform(runs, lambda x: F.struct(x["start"].alias("start"), F.lit(1).alias("run"), x["end"].alias("end"), x["token"].alias("token")))).otherwise(let(let(every, scans), chosen))


def masked(text_col: str = "text", spans_col: str = "spans") -> Column:
    """Text of find_secrets() with each stretch of spans replaced by MASK.

    The text is cut as UTF-32, where a place is found without walking there, so work
    grows with the text and its spans, not their product.
    """
    text, spans = F.col(text_col), F.col(spans_col)
    mark = F.lit(bytearray(b"\x00\x00\xfe\xff"))  # else a piece's own first U+FEFF would be taken for it

    def pieces(x: Column) -> Column:
        """(from, to) of what stands before each span; nothing where an earlier span reaches over its start."""
        before = F.concat(F.array(F.lit(0)), x["reached"])
        return F.zip_with(F.slice(before, 1, F.size(x["starts"])), x["starts"], lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def cut(x: Column) -> Column:
        part = lambda a, b: F.decode(F.concat(mark, F.substring(x["code"], 4 * a + 1, 4 * (b - a))), "UTF-32")
        some = F.transform(F.filter(pieces(x), lambda p: p["b"] >= p["a"]), lambda p: F.concat(part(p["a"], p["b"]), F.lit(MASK)))
        last = F.element_at(x["reached"], -1)
        return F.concat(F.array_join(some, ""), part(last, F.octet_length(x["code"]) / 4))

    ends = let(F.transform(spans, lambda x: x["end"]), lambda e: running(e, F.greatest))
    done = let(F.struct(F.encode(text, "UTF-32").alias("code"), F.transform(spans, lambda x: x["start"]).alias("starts"), ends.alias("reached")), cut)
    return F.when(F.size(spans) == 0, text).otherwise(done)
