"""Reader of fragment and manifest files, and of their batch."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAGMENT = """id string, kind string, document string, family string, section_id string, section_title string, subsection_id string, cite string,
title string, text string, keywords array<string>, categories array<string>, language string, source_path string"""
MANIFEST = """document string, kind string, title string, ementa string, family string, categories array<string>, page_url string, pdf_url string,
archive_url string, language string, foreign_annex boolean, sections array<string>, fragment_count int, fragment_ids array<string>, parser_version int, error string"""

_KEY = re.compile(r"^([A-Za-z_][A-Za-z0-9_]*):(?:[ \t]+(.*))?$")
_ESCAPES = {"n": "\n", "t": "\t", '"': '"', "\\": "\\", "/": "/", "0": "\0", "a": "\a", "b": "\b", "e": "\x1b", "f": "\f", "r": "\r", "v": "\v",
            "N": "\x85", "_": "\xa0", "L": "\u2028", "P": "\u2029", " ": " "}


def _folded(lines: list[str]) -> str:
    """Lines of a flow scalar: one break is a space, each further one a line end."""
    out, blank = lines[0].rstrip(" \t"), 0
    for line in lines[1:]:
        line = line.strip(" \t")
        if not line:
            blank += 1
            continue
        out += "\n" * blank if blank else "" if out.endswith("\x00") else " "
        out, blank = out + line, 0
    return out + "\n" * blank


def _scalar(lines: list[str]) -> str:
    first = lines[0].lstrip(" \t")
    if first[:1] == "'":
        return _folded([first[1:], *lines[1:]]).rstrip(" \n")[:-1].replace("''", "'")
    if first[:1] == '"':
        # a backslash at the end of a line joins it with the next
        held = [re.sub(r"(?<!\\)((?:\\\\)*)\\$", "\\1\x00", line) for line in [first[1:], *lines[1:]]]
        body = _folded(held).replace("\x00", "").rstrip(" \n")[:-1]

        def escape(m: re.Match) -> str:
            return chr(int(m[1][1:], 16)) if len(m[1]) > 1 else _ESCAPES.get(m[1], m[1])

        return re.sub(r"\\(x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", escape, body)
    if first[:1] in ("|", ">"):
        rest = lines[1:]
        depth = min((len(x) - len(x.lstrip(" ")) for x in rest if x.strip()), default=0)
        body = [x[depth:] for x in rest]
        text = "\n".join(body) if first[0] == "|" else re.sub(r"(?<!\n)\n(?!\n)", " ", "\n".join(body)).replace("\n\n", "\n")
        return text.rstrip("\n") + ("" if "-" in first[:3] else "\n")
    return _folded([first, *lines[1:]]).strip()


def parse(text: str) -> dict:
    """A mapping of scalars and of lists of scalars, the part of YAML that these files use."""
    out: dict = {}
    groups: list[tuple[str, list[str]]] = []
    for line in text.splitlines():
        if m := _KEY.match(line):
            groups.append((m[1], [m[2] or ""]))
        elif groups and not (line.startswith("#") or line in ("---", "...")):
            groups[-1][1].append(line)
    for key, lines in groups:
        rest = [x for x in lines[1:] if x.strip()]
        if lines[0].strip() in ("[]", "{}"):
            out[key] = []
        elif not lines[0].strip() and rest and rest[0].lstrip().startswith("- "):
            items: list[list[str]] = []
            for x in rest:
                if x.lstrip().startswith("- "):
                    items.append([x.lstrip()[2:]])
                else:
                    items[-1].append(x)
            out[key] = [_scalar(i) for i in items]
        else:
            found = _scalar(lines)
            out[key] = None if found in ("", "null", "~") and lines[0].strip()[:1] not in ("'", '"') else found
    return out


def parsed(files: DataFrame, schema: str) -> DataFrame:
    """(path, value) -> path, the fields of schema, and batch: the date of a quarantine folder, else live."""
    kinds = dict(re.split(r"\s+", f.strip(), maxsplit=1) for f in re.split(r",\s*", schema))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, text in zip(b["path"], b["value"]):
                found = parse(text)
                row = {"path": path}
                for name, kind in kinds.items():
                    v = found.get(name)
                    row[name] = None if v is None else int(v) if kind == "int" else v == "true" if kind == "boolean" else v
                rows.append(row)
            yield pd.DataFrame(rows, columns=["path", *kinds]).astype(object).where(lambda x: x.notna(), None) if rows else pd.DataFrame(columns=["path", *kinds])

    found = files.mapInPandas(run, f"path string, {schema}")
    batch = F.regexp_extract("path", r"/quarantine/(\d{4}-\d{2}-\d{2})/", 1)
    return found.withColumn("batch", F.when(batch == "", "live").otherwise(batch))


def files(spark: SparkSession, root: str) -> DataFrame:
    """(path, value) of the .yml files below a folder. Many small files: read once, then write with sink.write_fragments()."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yml").select(
        F.col("_metadata.file_path").alias("path"), "value")


def manifest_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, value) of the manifests below a folder, one for each document.

    Spark's readers leave out names with an underscore in front, so these few small
    files are listed and read by way of the folder's file system.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listing, rows = system.listFiles(folder, True), []
    while listing.hasNext():
        path = listing.next().getPath()
        if path.getName() == "_index.yml":
            stream = system.open(path)
            rows.append((path.toString(), jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            stream.close()
    return spark.createDataFrame(rows, "path string, value string")


def read_fragments(spark: SparkSession, root: str) -> DataFrame:
    """Fragments with their path and batch ('live' outside of quarantine); an explicit schema, for files drift."""
    return parsed(files(spark, root), FRAGMENT)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifests (_index.yml) with their path and batch; failed ones keep their error."""
    return parsed(manifest_files(spark, root), MANIFEST)
