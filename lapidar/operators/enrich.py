"""Keywords and the language of fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.functions.identity import DEFAULT
from lapidar.functions.text import STOPWORDS, counted, keyword_tokens, tokens

TOP = 12
# Words that tell the languages of the corpus apart.
FUNCTION_WORDS = {"pt": ["de", "que", "para", "com", "uma", "nao", "os", "por", "do", "da"], "en": ["the", "of", "and", "to", "in", "that", "is", "for", "with", "shall"]}
CLEAR, SOME = 0.8, 0.2


def term_frequencies(docs: DataFrame, id_col: str, text_col: str, stopwords: list[str] = STOPWORDS) -> DataFrame:
    """(id, token, n) of the keywords of each text. A text is one row, so they are counted inside it: nothing is shuffled."""
    return docs.select(F.col(id_col), F.inline(counted(keyword_tokens(F.col(text_col), stopwords))))


def top_terms(text: Column, top: int = TOP, stopwords: list[str] = STOPWORDS) -> Column:
    """The most frequent keywords of a text, equal counts by the alphabet."""
    ranked = F.sort_array(F.transform(counted(keyword_tokens(text, stopwords)), lambda x: F.struct((-x["n"]).alias("n"), x["token"].alias("token"))))
    return F.transform(F.slice(ranked, 1, top), lambda x: x["token"])


def keywords(docs: DataFrame, id_col: str, title_col: str, section_title_col: str, text_col: str, categories_col: str, top: int = TOP) -> DataFrame:
    """(id, keywords): categories, unless they are the default, then the top terms among which they aren't."""
    seeds = F.when(F.col(categories_col) == F.array(*map(F.lit, DEFAULT)), F.array().cast("array<string>")).otherwise(F.col(categories_col))
    found = docs.select(id_col, seeds.alias("seeds"), top_terms(F.concat_ws(" ", title_col, section_title_col, text_col), top).alias("terms"))
    return found.select(id_col, F.concat("seeds", F.filter("terms", lambda t: ~F.array_contains("seeds", t))).alias("keywords"))


def language(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, language): pt or en where one has a clear share of the function words, mixed where both have some, else null."""
    rows = docs.select(id_col, tokens(F.col(text_col)).alias("tokens"))
    rows = rows.select(id_col, *(F.size(F.filter("tokens", _among(v))).alias(k) for k, v in FUNCTION_WORDS.items()))
    share = F.col("en") / F.nullif(F.col("pt") + F.col("en"), F.lit(0))
    label = F.when(share.isNull(), None).when(share >= CLEAR, "en").when(share <= SOME, "pt").otherwise("mixed")
    return rows.select(id_col, "pt", "en", label.alias("language"))


def _among(words: list[str]) -> Callable[[Column], Column]:
    return lambda t: t.isin(words)
