"""Fields and text of captured pages, without the tree of the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.functions.text import strip

# Labels of the listing pages.
LABELS = ["Publicação", "Ementa", "Em vigor", "Anexo(s)", "Relacionados"]


def url_parts(url: Column) -> dict[str, Column]:
    """scheme, host, path and extension of an address."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    return {"scheme": F.regexp_extract(url, r"^([a-z]+)://", 1), "host": F.lower(F.regexp_extract(url, r"^[a-z]+://([^/?#:]*)", 1)), "path": path,
            "extension": F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))}


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1))


def header_field(text: Column, name: str) -> Column:
    """Value of a '- name: value' line of an extracted document; null where there is none."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^- {name}:[ \t]*(.*)$", 1)), F.lit(""))


def labelled(text: Column, label: str) -> Column:
    """What follows a label on its line, or else on the next; null where there is none."""
    name = "".join("\\" + c if c in "()" else c for c in label)
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^{name}[ \t]*:?[ \t]*\n?[ \t]*(\S.*)$", 1)), F.lit(""))


def extracted(docs: DataFrame, text_col: str) -> DataFrame:
    """title, body and header fields of extracted Markdown documents, with the labelled fields."""
    text = F.col(text_col)
    names = ["kind", "code", "source", "page_url", "pdf_url", "archive_url", "ementa", "note"]
    return docs.select("*", F.regexp_extract(text, r"(?m)\A# (.*)$", 1).alias("title"), *(header_field(text, n).alias(n) for n in names),
                       strip(F.regexp_extract(text, r"(?s)\n## Texto extraido\n(.*)", 1)).alias("body"),
                       F.create_map(*(x for label in LABELS for x in (F.lit(label), labelled(text, label)))).alias("fields"))
