"""Relations that hold on any data, and the shape of the plans."""

import re

import pytest
from pyspark.sql import functions as F

from grantlens.operators import analytics as Q
from grantlens.operators import derived
from grantlens.plans import registry as R


def total(frame, column="patent_count"):
    return frame.agg(F.sum(column)).first()[0]


@pytest.fixture(scope="module")
def pairs(tables):
    return Q.country_patents(tables.inventor_links, tables.inventors)


def test_totals(tables, pairs):
    patents = tables.patents("grant")
    per_year = total(Q.patents_per_year(patents))
    assert per_year == Q.summary(patents, tables.inventors, tables.companies).first().total_patents
    distribution = Q.section_distribution(tables.patent_cpc)
    assert total(distribution) == tables.patent_cpc.count()
    assert abs(distribution.agg(F.sum("percentage")).first()[0] - 100) < 0.1
    e1 = {r.cpc_section: r.patent_count for r in distribution.collect()}
    for frame in (
        Q.section_trends(tables.patent_cpc, patents).groupBy("cpc_section").agg(
            F.sum("patent_count").alias("patent_count")
        ),
        Q.lag_by_section(patents, tables.patent_cpc),
        Q.claims_by_section(patents, tables.patent_cpc),
    ):
        assert all(r.patent_count <= e1[r.cpc_section] for r in frame.collect())
    countries = {r.country: r.patent_count for r in Q.top_countries(pairs, 1000).collect()}
    for row in Q.lag_by_country(pairs, patents, min_patents=1).collect():
        assert row.patent_count <= countries[row.country]
    for row in Q.country_share(pairs, patents).collect():
        assert row.share == round(countries[row.country] / patents.count(), 4)


def test_repeated_links_do_not_matter(tables, rows, pairs):
    assert rows(pairs) == rows(Q.country_patents(tables.patent_inventor, tables.inventors))


def test_ranking_without_orphans_equals_top_list(tables, rows):
    ranked = Q.rank_inventors(tables.patent_inventor, tables.inventors)
    top = Q.rank_top_list(Q.top_inventors(tables.patent_inventor, tables.inventors))
    assert rows(ranked) == rows(top)


def test_orphans_shorten_the_top_list_but_not_the_ranking(tables):
    some = tables.inventors.filter(F.col("inventor_id") != "3")
    assert Q.top_inventors(tables.patent_inventor, some, 5).count() <= 5
    assert Q.rank_inventors(tables.patent_inventor, some, 5).count() == 5
    assert Q.top_inventors(tables.patent_inventor, some, 1000).count() == some.count()


def test_results_do_not_depend_on_partitions(tables, rows, pairs):
    patents = tables.patents("grant")
    moved = {n: f.repartition(n + 1) for n, f in enumerate([pairs, patents, tables.patent_cpc], 2)}
    assert rows(Q.countries_by_decade(moved[2], moved[3])) == rows(Q.countries_by_decade(pairs, patents))
    assert rows(Q.lag_by_section(moved[3], moved[4])) == rows(
        Q.lag_by_section(patents, tables.patent_cpc)
    )
    assert rows(Q.recent_by_section(moved[4], moved[3])) == rows(
        Q.recent_by_section(tables.patent_cpc, patents)
    )


def test_weighted_and_plain_mean(spark):
    trend = spark.createDataFrame(
        [(2000, 3, 365.25), (2001, 1, 730.5)], "year int, patent_count bigint, avg_grant_lag_days double"
    )
    assert derived.average_grant_years(trend).first()[0] == 1.5
    assert derived.average_grant_years(trend, weighted=True).first()[0] == 1.25


def test_claims_delta_needs_two_years(spark):
    one = spark.createDataFrame([(2000, 5, 3.0)], "year int, patent_count bigint, avg_claims double")
    assert derived.claims_delta(one).count() == 0


def test_empty_choices(spark):
    frame = spark.createDataFrame([("FR", 2000, 1), ("DE", None, 1)], "country string, year int, patents int")
    assert derived.filter_countries(frame, []).count() == 2
    assert derived.country_trend_selection(frame, []).count() == 0
    assert derived.filter_years(frame).count() == 1


def test_gap_is_signed_and_safe(spark):
    compared = spark.createDataFrame([(2000, 0, 5), (2001, 8, 4)], "yr int, filed bigint, granted bigint")
    rows = {r.yr: (r.gap, r.granted_pct) for r in derived.filing_grant_gap(compared).collect()}
    assert rows == {2000: (-5, None), 2001: (4, 50.0)}


NO_DATA_TWICE = [n for n in R.REGISTRY if not n.startswith(("src_", "snk_", "s_export", "s_index_feed"))]


@pytest.mark.parametrize("name", NO_DATA_TWICE)
def test_plans(spark, folder, name):
    """No pair-wise joins and no Python in any plan."""
    plan = R.REGISTRY[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|InPandas", plan)


def test_pushdown(spark, tables):
    from grantlens.operators import search

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    prefix = plan(search.name_lookup(tables.inventors, prefix="Supplier#0"))
    assert "StringStartsWith(s_name,Supplier#0)" in prefix
    yearly = plan(Q.patents_per_year(tables.patents("grant")))
    assert "lineitem" not in yearly  # the grant side is pruned with its join
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in yearly
    assert "WindowGroupLimit" in plan(
        Q.recent_by_section(tables.patent_cpc, tables.patents())
    )


def test_joins_read_the_links_once(spark, tmp_path, tables):
    """Without any broadcast, as with large dimensions, a lookup is one join that reads its links once."""
    stored = {}
    for name in ("patent_inventor", "inventors", "patent_company", "companies", "patent_cpc"):
        getattr(tables, name).write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = Q.country_patents(stored["patent_inventor"], stored["inventors"])
        by_section = Q.top_companies_by_section(stored["patent_cpc"], stored["patent_company"], stored["companies"])
        plans = {2: pairs._jdf.queryExecution().executedPlan().toString(), 3: by_section._jdf.queryExecution().executedPlan().toString()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for tables_read, plan in plans.items():
        assert "SortMergeJoin" in plan
        assert plan.count("FileScan parquet") == tables_read


def test_one_join_for_all_section_reports(tables):
    """Given the stored facts, the section reports do not join patents with sections again."""
    facts = Q.section_facts(tables.patent_cpc, tables.patents("grant")).limit(10).cache()
    for frame in (
        Q.section_trends(None, None, facts=facts),
        Q.lag_by_section(None, None, facts=facts),
        Q.claims_by_section(None, None, facts=facts),
    ):
        assert "Join" not in frame._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
