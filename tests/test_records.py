"""Agreement with recorded fragments and manifests; runs where LAPIDAR_RECORDS names their folder."""

import os

import pytest
from pyspark.sql import functions as F

from lapidar.functions import identity
from lapidar.operators import enrich
from lapidar.sources import fragments

ROOT = os.environ.get("LAPIDAR_RECORDS")
pytestmark = pytest.mark.skipif(not ROOT, reason="LAPIDAR_RECORDS isn't set")


def test_fragments(spark):
    rows = fragments.read_fragments(spark, ROOT).where("id is not null").cache()
    n = rows.count()
    section, sub = F.col("section_id"), F.col("subsection_id")
    # a fragment's title stands for what its section's title adds to a body
    whole = rows.select("path", "categories", "title", "section_title", "text").distinct()
    made = enrich.keywords(whole, "path", "title", "section_title", "text", "categories").withColumnRenamed("keywords", "made")
    met = rows.join(made, "path")
    equal = met.select(
        (identity.fragment_id(F.col("kind"), F.col("document"), section, sub) == F.col("id")).alias("id"), (identity.cite(section, sub) == F.col("cite")).alias("cite"),
        (identity.title(section, F.col("section_title"), sub) == F.col("title")).alias("title"), (identity.categories(F.col("family")) == F.col("categories")).alias("categories"),
        (F.col("made") == F.col("keywords")).alias("keywords"))
    found = equal.select(*(F.count_if(c).alias(c) for c in equal.columns)).first().asDict()
    print(n, found)
    assert n and set(found.values()) == {n}


def test_manifests(spark):
    rows = fragments.read_manifests(spark, ROOT).cache()
    n = rows.count()
    found = rows.select(F.count_if(identity.family(F.col("title")) == F.col("family")).alias("family"), F.count_if(F.size("fragment_ids") == F.col("fragment_count")).alias("count")).first()
    print(n, found)
    assert found["family"] == found["count"] == n
