"""Every query of the catalog against its SQL in DuckDB, at the smallest size."""

import math

import duckdb
import pytest

from lapidar.plans import catalog, extensions

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


QUERIES, SQL = catalog.QUERIES | extensions.QUERIES, catalog.SQL | extensions.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(SQL[name])
    expected = canonical(rel.columns, rel.fetchall())
    assert found[0] == expected[0]
    assert len(found[1]) == len(expected[1])
    assert found[1] == expected[1]


#: First lines that look like a heading or a letter, and lines with other line separators and spaces, or nothing after the mark.
FIRSTS = ["56.187.231.175 Keit in", "8294846167456848 Inly", "1. eins", "12 zwei", "A1.2-IV x", "26.05.2023 data", "Anexo I", "  3. drei", "a) x", "(b) y", "(d)-I z", "c)", "", " ", "x\r7 sieben"]
LINES = ["", " ", "\ttab\t", " \t both ", "\u00a0nb\u3000", "\u3000", "q\r8 acht", "q\rb) bee", "q\u20288 acht", "q\u0085c) cee", "q \u2028", "v \x0b", "cr\r"]
ODD = [None, "", "\n\n\n"] + ["\n".join([f] + ["t"] * n + [""] * k) for f in FIRSTS for n in (0, 4) for k in (0, 1)] + ["\n".join(["t"] + [x] * n) for x in LINES for n in range(1, 9)]


@pytest.mark.parametrize("name", ["section_split", "subsection_split", "section_forms"])
def test_splitting_of_odd_texts_equals_sql(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT CAST(i AS BIGINT) AS doc_id, t AS text, 'en' AS lang, 'src1' AS source FROM (SELECT unnest($t) AS t, unnest(range(len($t))) AS i)", {"t": ODD})
    con.execute(f"COPY documents TO '{tmp_path}/documents.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    rel = con.sql(SQL[name])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(rel.columns, rel.fetchall())


def test_entry_imports_without_the_subpackage(tmp_path):
    """With the folder taken away, the entry still imports and lists the rest."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "lapidar", tmp_path / "lapidar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'retrieve_top_fragments' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); print(len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
