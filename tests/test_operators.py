"""Operators of the corpus on small cases."""

from pyspark.sql import functions as F

from lapidar.functions import identity, text
from lapidar.operators import enrich, extract, index, ledger, split, versions
from lapidar.sources import fragments, sink
from lapidar.streaming import ingest


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


def test_fold_and_slug(spark):
    assert one(spark, text.fold(F.col("t")), t="Ação Nº 5ª m² ﬁm ß ñ É½") == "acao no 5a m2 fim  n e12"
    assert one(spark, text.slug(F.col("t")), t="  Apêndice A, do RBAC nº 161 ") == "apendice-a-do-rbac-no-161"
    assert one(spark, text.tokens(F.col("t")), t="Às 15h42, 2022") == ["as", "15h42", "2022"]
    assert one(spark, text.tokens(F.col("t")), t="d\u2019\u00e1gua pilot\u2019s aero\u00adagr\u00edcolas se\u0301 n\u00ba") == ["d", "agua", "pilot", "s", "aero", "agricolas", "se", "no"]
    assert one(spark, text.dehyphenated(F.col("t")), t="experi-\n ência e RBAC-\n21") == "experiência e RBAC-\n21"


def test_fold_is_nfkd(spark):
    """All signs up to U+1FFFF that have an ASCII form, and some that have none, alone and within words."""
    import unicodedata

    plain = lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
    signs = [chr(c) for c in [*range(0xA0, 0xD800), *range(0xF900, 0x20000)] if plain(chr(c))]
    rows = [(i, t) for i, t in enumerate([*signs, "№ Ⅳ ℃ Ａ", "x½y…“z”", "日本", *("a" + "".join(signs[i : i + 7]) + "b" for i in range(0, len(signs), 7))])]
    for r in spark.createDataFrame(rows, "i int, t string").select("i", text.fold(F.col("t")).alias("f")).collect():
        assert r["f"] == plain(rows[r["i"]][1]), ascii(rows[r["i"]][1])


def test_tokens_are_counted_inside_the_row(spark, tmp_path):
    import random
    from collections import Counter

    rnd = random.Random(3)
    some = ["Para", "ação", "abcd", "ABCD", "12345", "15h42", "abc", "nova", "x1y2z", "Nova"]
    rows = [(i, rnd.choice([" ", "-", "\n"]).join(rnd.choice(some) for _ in range(rnd.randint(0, 40)))) for i in range(60)] + [(100, None), (101, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    want = {}
    for i, t in rows:
        words = [w for w in __import__("re").findall("[a-z0-9]+", (t or "").lower().replace("ç", "c").replace("ã", "a")) if len(w) >= 4 and not w.isdigit() and w not in text.STOPWORDS]
        want |= {(i, w): n for w, n in Counter(words).items()}
    found = enrich.term_frequencies(df, "id", "text")
    assert {(r["id"], r["token"]): r["n"] for r in found.collect()} == want
    some = index.postings(df, "id", "text", ["nova", "acao"])
    assert {(r["id"], r["token"]): r["n"] for r in some.collect()} == {k: n for k, n in want.items() if k[1] in ("nova", "acao")}
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(found) and "Exchange" not in plan(df.select("id", enrich.top_terms(F.col("text"))))
    sink.write_postings(index.postings(df, "id", "text"), str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index")).where(F.col("token").isin(["nova", "acao"]))
    assert "In(token" in plan(stored) and sorted(map(tuple, stored.collect())) == sorted(map(tuple, some.collect()))


def test_dates(spark):
    rows = [("08/02/2022", "2022-02-08"), ("8 de fevereiro de 2022", "2022-02-08"), ("1º de Março de 1999", "1999-03-01"), ("31/02/2022", None), ("31 de abril de 2020", None), ("8 fevereiro 2022", None), (None, None)]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string").select("i", text.parse_date(F.col("t")).cast("string").alias("d")).collect()
    assert {r["i"]: r["d"] for r in got} == {i: d for i, (_, d) in enumerate(rows)}


def test_routes(spark):
    sources = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, route int")
    routes = spark.createDataFrame([(10, "a")], "route int, name string")
    assert {r["id"]: (r["name"], r["status"]) for r in ledger.routed(sources, routes, "route").collect()} == {1: ("a", "routed"), 2: (None, "unrouted"), 3: (None, "unrouted")}


def test_identity(spark):
    c = {k: F.col(k) for k in ("kind", "doc", "s", "b", "t")}
    row = {"kind": "rbac", "doc": "rbac-145", "s": "145.3", "b": "d-i", "t": "Titulo"}
    assert one(spark, identity.fragment_id(c["kind"], c["doc"], c["s"], c["b"]), **row) == "rbac-rbac-145-145-3-d-i"
    assert one(spark, identity.cite(c["s"], c["b"]), **row) == "145.3(d-I)"
    assert one(spark, identity.title(c["s"], c["t"], c["b"]), **row) == "145.3(d-I)"
    assert one(spark, identity.title(c["s"], c["t"], c["b"]), **row | {"b": "body"}) == "Titulo"
    assert one(spark, identity.cite(c["s"], c["b"]), **row | {"b": "a"}) == "145.3(a)"
    for title, family in (("IAC 3206", "320"), ("IS E94-003A", "94"), ("RBAC 045", "45"), ("none", None)):
        assert one(spark, identity.family(F.col("t")), t=title) == family
    assert one(spark, identity.categories(F.col("f")), f="121") == ["transporte-aereo", "operacoes"]
    assert one(spark, identity.categories(F.col("f")), f="94") == ["legislacao"]
    assert one(spark, identity.looks_like_date(F.col("s")), s="26.05.2023") and not one(spark, identity.looks_like_date(F.col("s")), s="4.2.3")


def test_split(spark):
    body = "Emenda 01\ntexto inicial\n1. OBJETIVO\nPrimeiro.\n5.2.2 Regras\nGeral\na) uma\nb) outra (1) dentro\n(d)-I inserida\n26.05.2023 data\nAPÊNDICE A DO RBAC\nfim"
    found = split.subsections(split.sections(spark.createDataFrame([("d", body), ("e", None), ("f", "")], "document string, text string")))
    rows = [(r["section_id"], r["section_title"], r["subsection_id"], r["text"]) for r in found.orderBy("position", "subposition").collect()]
    assert rows == [
        ("preambulo", "Preambulo e sumario", "body", "Emenda 01\ntexto inicial"), ("1", "OBJETIVO", "body", "1. OBJETIVO\nPrimeiro."),
        ("5.2.2", "Regras", "body", "5.2.2 Regras\nGeral"), ("5.2.2", "Regras", "a", "a) uma"), ("5.2.2", "Regras", "b", "b) outra (1) dentro"),
        ("5.2.2", "Regras", "d-i", "(d)-I inserida\n26.05.2023 data"), ("apendice-a-do-rbac", "APÊNDICE A DO RBAC", "body", "APÊNDICE A DO RBAC\nfim")]


def test_split_with_a_title(spark):
    docs = spark.createDataFrame([("d", "56.187.231.175 Keit\n1. OBJETIVO\n7 dias")], "document string, text string")
    ids = lambda found: [r["section_id"] for r in found.orderBy("position").collect()]
    assert ids(split.sections(docs)) == ["56.187.231.175", "1", "7"]
    assert ids(split.sections(docs, titled=True)) == ["preambulo", "1", "7"]


def test_split_of_letters_at_the_ends(spark):
    docs = spark.createDataFrame([("d", "c) Titulo\nd) mais\n1. OBJETIVO\na) uma\nb) \n")], "document string, text string")
    ids = lambda found: [(r["section_id"], r["subsection_id"]) for r in found.orderBy("position", "subposition").collect()]
    rest = [("preambulo", "d"), ("1", "body"), ("1", "a"), ("1", "b")]
    assert ids(split.subsections(split.sections(docs))) == [("preambulo", "c"), *rest]
    assert ids(split.subsections(split.sections(docs, titled=True), titled=True)) == [("preambulo", "body"), *rest]


def test_keywords(spark):
    rows = [(1, "Helice", "Helice", "helice nova helice velha para 1234 velha", ["helices", "aeronavegabilidade"]), (2, "", "", "abcd", ["legislacao"]), (3, "", "", None, ["legislacao"])]
    df = spark.createDataFrame(rows, "id int, title string, section string, text string, categories array<string>")
    got = {r["id"]: r["keywords"] for r in enrich.keywords(df, "id", "title", "section", "text", "categories").collect()}
    assert got == {1: ["helices", "aeronavegabilidade", "helice", "velha", "nova"], 2: ["abcd"], 3: []}


def test_language(spark):
    df = spark.createDataFrame([(1, "the law of the air"), (2, "a lei que é do ar"), (3, "the lei of que"), (4, "xyz"), (5, None)], "id int, text string")
    assert {r["id"]: r["language"] for r in enrich.language(df, "id", "text").collect()} == {1: "en", 2: "pt", 3: "mixed", 4: None, 5: None}


def test_manifest_keeps_the_order_of_the_document(spark):
    df = spark.createDataFrame([("d", "preambulo", 0, "z"), ("d", "18.06.90", 1, "a"), ("d", "18.06.90", 2, "b")], "document string, section string, position int, id string")
    r = index.manifest(df, "document", "section", ["position"], "id").first()
    assert (r["sections"], r["fragment_count"], r["fragment_ids"]) == (["18.06.90", "preambulo"], 3, ["z", "a", "b"])


def test_versions(spark):
    assert one(spark, versions.text_error(F.col("t")), t="") == "extracted text too short (0 chars)"
    assert one(spark, versions.archive_url(F.col("a"), F.col("b")), a="page", b="") == "page"
    assert one(spark, versions.snapshot_time(F.col("a")), a="https://x/wayback/20220102030405/http://y") == "20220102030405"
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "id int, text string")
    live = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, text string")
    assert {r["id"]: r["status"] for r in versions.reconcile(batch, live, "id", "text").collect()} == {1: "same", 2: "changed", 3: "same", 4: "missing"}


def test_ledger(spark):
    rows = spark.createDataFrame([(1, "a", "b"), (2, " ", None), (3, "c", "")], "id int, link string, destination string")
    assert {r["id"]: r["missing"] for r in ledger.incomplete(rows, ["link", "destination"]).collect()} == {2: ["link", "destination"], 3: ["destination"]}
    a, b = (spark.createDataFrame([(x,) for x in s], "stem string") for s in ("ab", "bc"))
    assert {(r["stem"], r["side"]) for r in ledger.unpaired(a, b, "stem").collect()} == {("a", "one"), ("c", "two")}


def test_extracted_document(spark):
    body = "# RBAC 38\n\n- kind: rbac\n- pdf_url: \n- page_url: http://x\n\n## Texto extraido\n\nPublicação\n08/02/2022\nEmenta: Regra nova\n"
    r = extract.extracted(spark.createDataFrame([(body,)], "t string"), "t").first()
    assert (r["title"], r["kind"], r["pdf_url"], r["page_url"]) == ("RBAC 38", "rbac", None, "http://x")
    assert r["fields"]["Publicação"] == "08/02/2022" and r["fields"]["Ementa"] == "Regra nova" and r["fields"]["Relacionados"] is None
    assert r["body"].startswith("Publicação")


FRAGMENT = """id: is-is-1-4-2-3-body
kind: is
document: is-1
family: '1'
section_id: 4.2.3
section_title: 'Regra: d''agua'
subsection_id: body
cite: 4.2.3
title: "Regra \\
  \\xE9 \\"boa\\""
text: 'Primeira linha

  segunda linha que
  continua

  '
keywords:
- alpha
- '1234'
categories:
- legislacao
source_path: x/y.md
"""
MANIFEST = "document: is-1\nkind: is\ntitle: IS 1\npdf_url: ''\nforeign_annex: false\nsections: []\nfragment_count: 2\nfragment_ids:\n- a\n- b\nparser_version: 7\n"


def test_files(spark, tmp_path):
    (tmp_path / "quarantine/2026-09-14/is/is-1").mkdir(parents=True)
    (tmp_path / "live/is/is-1").mkdir(parents=True)
    (tmp_path / "live/is/is-1/f.yml").write_text(FRAGMENT)
    (tmp_path / "quarantine/2026-09-14/is/is-1/f.yml").write_text(FRAGMENT)
    (tmp_path / "live/is/is-1/_index.yml").write_text(MANIFEST)
    got = {r["batch"]: r for r in fragments.read_fragments(spark, str(tmp_path)).collect()}
    assert got.keys() == {"live", "2026-09-14"}
    r = got["live"]
    assert (r["family"], r["section_title"], r["title"], r["section_id"]) == ("1", "Regra: d'agua", 'Regra é "boa"', "4.2.3")
    assert r["text"] == "Primeira linha\nsegunda linha que continua\n" and r["keywords"] == ["alpha", "1234"] and r["language"] is None
    m = fragments.read_manifests(spark, str(tmp_path)).first()
    assert (m["pdf_url"], m["sections"], m["fragment_count"], m["foreign_annex"], m["fragment_ids"], m["error"]) == ("", [], 2, False, ["a", "b"], None)
    sink.write_fragments(fragments.read_fragments(spark, str(tmp_path)), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("kind = 'is'").count() == 2
    for _ in range(2):
        sink.append_log(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    sink.export_lines(fragments.read_fragments(spark, str(tmp_path)), str(tmp_path / "lines"))
    assert (tmp_path / "lines/kind=is/document=is-1").is_dir()


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    def session(master, folder):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert sink.shared_dir(session("spark://host:7077", "hdfs://x/y")) == "hdfs://x/y" and sink.shared_dir(session("local[4]", None)).startswith("file://")
    with pytest.raises(RuntimeError):
        sink.shared_dir(session("spark://host:7077", None))


def test_stream(spark, tmp_path):
    schema = "doc_id long, text string, lang string"
    for batch in range(2):
        spark.createDataFrame([(batch, "long enough a text, as it seems", "pt"), (10 + batch, "short", "pt"), (20 + batch, "long enough a text, as it seems", "en")], schema).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.start(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "state"), F.col("lang") == "en").awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["doc_id"], r["status"]) for r in out.collect()} == {(0, "accepted"), (1, "accepted"), *((i, "quarantined") for i in (10, 11, 20, 21))}
