"""Text kernel of the corpus: folding, slugs, tokens."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that never became keywords in the corpus.
STOPWORDS = """para deve anac rbac pela devem pelo como conforme esta quando sobre qualquer serao item mais podera apos entre sera este itens
suas antes previsto previstos prevista previstas seus nesta emenda rbha neste onde tambem sido apenas sendo esse poderao essa ainda muito""".split()


def _fold_table() -> tuple[str, str, dict[str, str], str]:
    """Signs that decompose to one ASCII sign, with it; those that decompose to several; a class of signs that holds the latter."""
    one, to, several, spans = [], [], {}, []
    for c in map(chr, [*range(0xA0, 0xD800), *range(0xF900, 0x20000)]):
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one.append(c)
            to.append(plain)
        elif plain:
            several[c] = plain
            if spans and ord(c) - spans[-1][1] <= 6:
                spans[-1][1] = ord(c)
            else:
                spans.append([ord(c), ord(c)])
    return "".join(one), "".join(to), several, "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


_FROM, _TO, _SEVERAL, _RARE = _fold_table()
#: A quick test that texts of Western letters alone fail: only what passes is held against the many ranges of _RARE.
_BEYOND = "[" + "".join(c for c in _SEVERAL if c < "\u0100") + r"\x{100}-\x{1FFFF}]"


def _decomposed(text: Column, drop: str) -> Column:
    """Compatibility forms and accents off (NFKD), what matches drop then removed, in lower case."""
    table = F.create_map(*(F.lit(x) for pair in _SEVERAL.items() for x in pair))
    rare = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(F.octet_length(c) > 1, F.coalesce(F.try_element_at(table, c), c)).otherwise(c)), "")
    wide = F.when(text.rlike(_BEYOND) & text.rlike(_RARE), rare).otherwise(text)
    plain = F.regexp_replace(F.translate(wide, _FROM, _TO), drop, "")
    return F.lower(F.when(F.octet_length(text) == F.length(text), text).otherwise(plain))  # ASCII has as many bytes as letters


def fold(text: Column) -> Column:
    """As slugs have it: what has no ASCII form is dropped."""
    return _decomposed(text, r"[^\x00-\x7F]")


def unaccented(text: Column) -> Column:
    """As words are taken from it: marks are dropped, other signs stay and part what is on their two sides."""
    return _decomposed(text, r"\p{Mn}+")


def strip(text: Column) -> Column:
    """White space off both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def slug(text: Column) -> Column:
    """Folded, with a dash for each run of other signs and none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def tokens(text: Column) -> Column:
    """Runs of letters and digits of the unaccented text, in order, repeats included."""
    return F.regexp_extract_all(unaccented(text), F.lit("[a-z0-9]+"), F.lit(0))


def keyword_tokens(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """Those tokens that may be keywords: four signs or more, not a number, not a stopword; in order, repeats included."""
    long = F.regexp_extract_all(unaccented(text), F.lit("(?<![a-z0-9])(?=[0-9]*+[a-z])[a-z0-9]{4,}"), F.lit(0))
    return F.filter(long, lambda t: ~t.isin(stopwords))


def counted(tokens: Column) -> Column:
    """array<struct<token, n>> of the different tokens, in their order: sorted, and cut where a run of equal ones ends."""
    def let(value: Column, body: Callable[[Column], Column]) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def runs(x: Column) -> Column:
        first = F.filter(F.transform(x, lambda t, i: F.when((i == 0) | (F.get(x, i - 1) != t), i)), lambda i: i.isNotNull())
        return let(first, lambda at: F.zip_with(at, F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(x))), lambda a, b: F.struct(F.get(x, a).alias("token"), (b - a).cast("long").alias("n"))))

    none = F.expr("cast(array() as array<struct<token: string, n: bigint>>)")
    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), runs)).otherwise(none)


def dehyphenated(text: Column) -> Column:
    """Words that a line end has split, joined again."""
    return F.regexp_replace(text, r"(\p{L})-[ \t]*\n[ \t]*(\p{Ll})", "$1$2")


# The months as long dates write them, in order.
MONTHS = "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split()


def parse_date(text: Column) -> Column:
    """A date written as dd/MM/yyyy or as '8 de fevereiro de 2022'; null for anything else, and for days that don't exist."""
    plain = strip(fold(text))
    long = r"^(\d{1,2})o? de ([a-z]+) de (\d{4})$"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(plain, long, 2))
    day = F.when(plain.rlike(long) & (month > 0), F.concat_ws("/", F.lpad(F.regexp_extract(plain, long, 1), 2, "0"), F.lpad(month.cast("string"), 2, "0"), F.regexp_extract(plain, long, 3)))
    return F.try_to_timestamp(F.when(plain.rlike(r"^\d{2}/\d{2}/\d{4}$"), plain).otherwise(day), F.lit("dd/MM/yyyy")).cast("date")
