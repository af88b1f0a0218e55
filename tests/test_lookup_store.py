"""Stored layouts: what a lookup reads, and joins without a shuffle."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from grantlens.operators import analytics, search, views
from grantlens.sources import lookup_store


def rows_scanned(frame):
    """How many rows the scan gave, after Parquet skipped what the filters rule out."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def names(spark):
    letters = F.concat(*[F.char(97 + F.pmod(F.floor(F.col("id") / 26**n), F.lit(26))) for n in range(4)])
    return spark.range(60_000).select(F.reverse(letters).alias("name"), F.col("id"), F.xxhash64("id").alias("other"))


def test_prefix_lookup_reads_few_pages(spark, rows, names, tmp_path):
    lookup_store.write_sorted(names.orderBy("other"), str(tmp_path), ["name"], page_rows=500)
    stored = lookup_store.read_sorted(spark, str(tmp_path))
    found = search.name_lookup(stored, prefix="abc")
    assert rows(found) == rows(search.name_lookup(names, prefix="abc")) != []
    assert rows_scanned(found) <= 4_000 and rows_scanned(stored.select("name")) == 60_000
    one = search.name_lookup(stored, name="acab")
    assert one.count() == names.filter("name = 'acab'").count() and rows_scanned(one) <= 2_000


def test_date_lookup_reads_few_pages(spark, rows, tables, tmp_path):
    patents = tables.patents("grant").select("patent_id", "filing_date", "patent_type", "year")
    lookup_store.write_sorted(patents, str(tmp_path), ["filing_date", "patent_type"], page_rows=100)
    stored = lookup_store.read_sorted(spark, str(tmp_path))
    span = (date(1996, 3, 1), date(1996, 4, 30), "F")
    found = search.date_type_filter(stored, *span)
    assert rows(found) == rows(search.date_type_filter(patents, *span)) != []
    assert rows_scanned(found) < 0.5 * patents.count()


def test_bloom_filters_skip_files(spark, names, tmp_path):
    lookup_store.write_sorted(names, str(tmp_path), ["name"], blooms={"other": 60_000})
    stored = lookup_store.read_sorted(spark, str(tmp_path))
    known = names.first()
    assert stored.filter(F.col("other") == known.other).collect() == [known]
    assert rows_scanned(stored.filter("other = 12345")) == 0


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_link_tables_join_without_a_shuffle(spark, rows, tables, tmp_path):
    linked = {}
    for name in ("patent_inventor", "patent_company", "patent_cpc"):
        frame = getattr(tables, name)
        lookup_store.write_linked(frame, f"{tmp_path}/{name}", "patent_id", 8)
        linked[name] = lookup_store.read_linked(spark, f"{tmp_path}/{name}", frame.schema, "patent_id", 8)
        assert rows(linked[name]) == rows(frame)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = views.patent_relationships(linked["patent_inventor"], linked["patent_company"])
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        leaders = analytics.top_companies_by_section(linked["patent_cpc"], linked["patent_company"], tables.companies)
        links = plan_of(linked["patent_company"].join(linked["patent_cpc"], "patent_id").groupBy("patent_id").count())
        assert "Exchange" not in links
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(joined) == rows(views.patent_relationships(tables.patent_inventor, tables.patent_company))
    plain = analytics.top_companies_by_section(tables.patent_cpc, tables.patent_company, tables.companies)
    assert rows(leaders) == rows(plain)
