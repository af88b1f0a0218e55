"""The library of analytic questions over the clean model.

Two rules hold throughout: link tables are aggregated before a dimension is joined, and a result is cut
to its top rows before anything wide is looked up. A result of at most k rows is put in order with a
second top-k, which needs no range shuffle. Ties are broken by id, country or patent_id.

Where a question counts distinct (country, patent) pairs, repeated inventor links do not matter, so
``links`` may be given without removing duplicates; that saves a shuffle.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.functions import values as V
from grantlens.functions.ranking import number_rows, ordering, top_k, top_n_per_group
from grantlens.schema import MAX_YEAR, MIN_YEAR


def rows() -> Column:
    return F.count(F.lit(1))


def country_patents(links: DataFrame, inventors: DataFrame) -> DataFrame:
    """Distinct (country, patent) pairs with a known country.

    The distinct runs on the pair, so the country that holds half of all rows is spread over the
    cluster, and a patent with very many links is reduced to its countries before the shuffle.
    """
    places = inventors.filter(V.known_country(F.col("country"))).select("inventor_id", "country")
    return (
        links.select("patent_id", "inventor_id")
        .join(places, "inventor_id")
        .select("country", "patent_id")
        .distinct()
    )


def pair_facts(pairs: DataFrame, patents: DataFrame) -> DataFrame:
    """(country, patent) pairs with what reports ask of the patents; stored, one join serves them all."""
    columns = [c for c in ("patent_id", "year", "grant_lag_days") if c in patents.columns]
    return pairs.join(patents.select(columns), "patent_id")


def _dated(patents: DataFrame, *columns: str, low: int = MIN_YEAR, high: int = MAX_YEAR):
    return patents.filter(V.in_years(F.col("year"), low, high)).select(
        "patent_id", "year", *columns
    )


# ---- rankings ---------------------------------------------------------------------------------


def _top_linked(links: DataFrame, dimension: DataFrame, key: str, k: int) -> DataFrame:
    counts = links.groupBy(key).agg(rows().alias("patent_count"))
    leaders = top_k(counts, ["-patent_count", key], k)  # k rows, so the broadcast is bounded
    return dimension.join(F.broadcast(leaders), key)


def top_inventors(patent_inventor: DataFrame, inventors: DataFrame, k: int = 20) -> DataFrame:
    named = _top_linked(patent_inventor, inventors, "inventor_id", k)
    return top_k(
        named.select("inventor_id", "name", "country", "patent_count"),
        ["-patent_count", "inventor_id"],
        k,
    )


def top_companies(patent_company: DataFrame, companies: DataFrame, k: int = 20) -> DataFrame:
    named = _top_linked(patent_company, companies, "company_id", k)
    return top_k(
        named.select("company_id", "name", "assignee_type", "patent_count"),
        ["-patent_count", "company_id"],
        k,
    )


def rank_inventors(patent_inventor: DataFrame, inventors: DataFrame, k: int = 20) -> DataFrame:
    """Unlike ``top_inventors``, only inventors that exist are ranked.

    Counting comes first, so the join sees one row per inventor; the numbering sees k rows.
    """
    counts = patent_inventor.groupBy("inventor_id").agg(
        F.countDistinct("patent_id").alias("patent_count")
    )
    leaders = top_k(counts.join(inventors, "inventor_id"), ["-patent_count", "inventor_id"], k)
    return number_rows(leaders, ["-patent_count", "inventor_id"]).select(
        "rank", "inventor_id", "name", "country", "patent_count"
    )


def rank_top_list(top_list: DataFrame) -> DataFrame:
    return number_rows(top_list, ["-patent_count", "inventor_id"]).select(
        "rank", "inventor_id", "name", "country", "patent_count"
    )


def top_countries(pairs: DataFrame, k: int = 30) -> DataFrame:
    counts = pairs.groupBy("country").agg(rows().alias("patent_count"))
    return top_k(counts, ["-patent_count", "country"], k)


def country_share(pairs: DataFrame, patents: DataFrame, k: int = 10) -> DataFrame:
    """Share of all patents, dated or not; shares can add to more than one."""
    total = patents.agg(rows().alias("n")).scalar()
    counts = pairs.groupBy("country").agg(rows().alias("patents"))
    return top_k(counts, ["-patents", "country"], k).withColumn(
        "share", F.round(F.col("patents").cast("double") / total, 4)
    )


# ---- trends -----------------------------------------------------------------------------------


def patents_per_year(
    patents: DataFrame, low: int = MIN_YEAR, high: int = MAX_YEAR
) -> DataFrame:
    dated = patents.filter(V.in_years(F.col("year"), low, high))
    return dated.groupBy("year").agg(rows().alias("patent_count")).orderBy("year")


def patents_by_grant_year(
    patents: DataFrame, low: int = MIN_YEAR, high: int = MAX_YEAR
) -> DataFrame:
    dated = patents.filter(V.in_years(F.col("patent_year"), low, high))
    return (
        dated.groupBy(F.col("patent_year").alias("yr")).agg(rows().alias("patent_count")).orderBy("yr")
    )


def countries_by_decade(
    pairs: DataFrame,
    patents: DataFrame,
    n: int = 5,
    low: int = MIN_YEAR,
    high: int = MAX_YEAR,
    facts: DataFrame | None = None,
) -> DataFrame:
    """A patent has one filing year, so joining the distinct pairs keeps them distinct."""
    facts = pair_facts(pairs, patents) if facts is None else facts
    counts = (
        facts.filter(V.in_years(F.col("year"), low, high))
        .select("country", F.expr("CAST(year DIV 10 * 10 AS INT)").alias("decade"))
        .groupBy("decade", "country")
        .agg(rows().alias("patents_per_decade"))
    )
    return top_n_per_group(counts, ["decade"], ["-patents_per_decade", "country"], n).orderBy(
        *ordering("-decade", "-patents_per_decade", "country")
    )


def country_trends(
    pairs: DataFrame,
    patents: DataFrame,
    low: int = MIN_YEAR,
    high: int = MAX_YEAR,
    facts: DataFrame | None = None,
) -> DataFrame:
    facts = pair_facts(pairs, patents) if facts is None else facts
    return (
        facts.filter(V.in_years(F.col("year"), low, high))
        .groupBy("year", "country")
        .agg(rows().alias("patents"))
        .orderBy(*ordering("-year", "-patents", "country"))
    )


def summary(patents: DataFrame, inventors: DataFrame, companies: DataFrame) -> DataFrame:
    """One row: dated patents, first and last year, inventors, companies."""
    dated = patents.filter(F.col("year").isNotNull())
    return dated.agg(
        rows().alias("total_patents"), F.min("year").alias("year_from"), F.max("year").alias("year_to")
    ).select(
        "*",
        inventors.agg(rows()).scalar().alias("total_inventors"),
        companies.agg(rows()).scalar().alias("total_companies"),
    )


# ---- preview ----------------------------------------------------------------------------------


def _comma_list(column: str):
    values = F.array_sort(F.collect_set(column))
    return F.when(F.size(values) > 0, F.array_join(values, ","))


def join_preview(
    patents: DataFrame,
    links: DataFrame,
    inventors: DataFrame,
    patent_company: DataFrame,
    companies: DataFrame,
    k: int = 100,
) -> DataFrame:
    """The latest k patents with their people, countries and owners.

    The k patents are taken first; inventors and companies are then aggregated apart, so their
    product is never built.
    """
    latest = top_k(
        patents.filter(F.col("year").isNotNull()).select(
            "patent_id", "title", "year", "patent_type", "num_claims", "grant_lag_days"
        ),
        ["-year", "patent_id"],
        k,
    )
    ids = F.broadcast(latest.select("patent_id"))  # k rows
    people = (
        links.join(ids, "patent_id", "left_semi")
        .join(inventors.select("inventor_id", "name", "country"), "inventor_id")
        .groupBy("patent_id")
        .agg(
            _comma_list("name").alias("inventor_names"),
            _comma_list("country").alias("inventor_countries"),
        )
    )
    owners = (
        patent_company.join(ids, "patent_id", "left_semi")
        .join(companies.select("company_id", "name"), "company_id")
        .groupBy("patent_id")
        .agg(_comma_list("name").alias("company_names"))
    )
    whole = latest.join(people, "patent_id", "left").join(owners, "patent_id", "left")
    return top_k(whole, ["-year", "patent_id"], k)


# ---- technology sections ----------------------------------------------------------------------


def section_distribution(patent_cpc: DataFrame) -> DataFrame:
    """Rows per section and their percentage of all rows, from one pass.

    The total is summed over the handful of section counts, not over the table a second time.
    """
    counts = patent_cpc.groupBy("cpc_section").agg(rows().alias("patent_count"))
    total = F.sum("patent_count").over(Window.partitionBy(F.lit(0)))
    share = F.col("patent_count").cast("double") * 100 / total
    return (
        counts.withColumn("percentage", F.round(share, 2))
        .filter(F.col("cpc_section").isNotNull())
        .orderBy(*ordering("-patent_count", "cpc_section"))
    )


def _sections(patent_cpc: DataFrame) -> DataFrame:
    return patent_cpc.filter(F.col("cpc_section").isNotNull()).select("patent_id", "cpc_section")


def section_facts(patent_cpc: DataFrame, patents: DataFrame) -> DataFrame:
    """Sections with what reports ask of their patents. Given stored, one join serves them all."""
    columns = ["patent_id", "year", "filing_date", "grant_lag_days", "num_claims"]
    return _sections(patent_cpc).join(patents.select([c for c in columns if c in patents.columns]), "patent_id")


def section_trends(
    patent_cpc: DataFrame,
    patents: DataFrame,
    low: int = MIN_YEAR,
    high: int = MAX_YEAR,
    facts: DataFrame | None = None,
) -> DataFrame:
    facts = section_facts(patent_cpc, patents) if facts is None else facts
    return (
        facts.filter(V.in_years(F.col("year"), low, high))
        .groupBy("year", "cpc_section")
        .agg(rows().alias("patent_count"))
        .orderBy(*ordering("-year", "-patent_count", "cpc_section"))
    )


def top_companies_by_section(
    patent_cpc: DataFrame, patent_company: DataFrame, companies: DataFrame, n: int = 5
) -> DataFrame:
    """Ranked by id first; an id without a name then shortens its section's list.

    The two link tables are joined as they are: a join of two shuffled tables is one whose hot keys Spark
    splits at run time.
    """
    counts = (
        patent_company.select("patent_id", "company_id")
        .join(_sections(patent_cpc), "patent_id")
        .groupBy("cpc_section", "company_id")
        .agg(rows().alias("patent_count"))
    )
    # at most n rows for each of the fixed sections
    leaders = top_n_per_group(counts, ["cpc_section"], ["-patent_count", "company_id"], n)
    named = companies.select("company_id", F.col("name").alias("company_name"))
    return (
        named.join(F.broadcast(leaders), "company_id")
        .orderBy(*ordering("cpc_section", "-patent_count", "company_id"))
        .select("cpc_section", "company_name", "patent_count")
    )


def top_countries_by_section(pairs: DataFrame, patent_cpc: DataFrame, n: int = 5) -> DataFrame:
    """Distinct pairs joined with distinct sections are distinct triples, so counting is enough."""
    counts = (
        _sections(patent_cpc)
        .join(pairs, "patent_id")
        .groupBy("cpc_section", "country")
        .agg(rows().alias("patent_count"))
    )
    return top_n_per_group(counts, ["cpc_section"], ["-patent_count", "country"], n).orderBy(
        *ordering("cpc_section", "-patent_count", "country")
    )


def recent_by_section(
    patent_cpc: DataFrame,
    patents: DataFrame,
    n: int = 5,
    low: int = MIN_YEAR,
    high: int = MAX_YEAR,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Titles are looked up only for the patents that make the list."""
    order = ["-year", "-filing_date", "patent_id"]
    facts = section_facts(patent_cpc, patents) if facts is None else facts
    keys = facts.filter(V.in_years(F.col("year"), low, high)).select(
        "patent_id", "cpc_section", "year", "filing_date"
    )
    # at most n rows for each of the fixed sections
    listed = top_n_per_group(keys, ["cpc_section"], order, n)
    return (
        patents.select("patent_id", "title")
        .join(F.broadcast(listed), "patent_id")
        .select("cpc_section", "patent_id", "title", "year", "filing_date")
        .orderBy(*ordering("cpc_section", *order))
    )


# ---- grant lag and claims ---------------------------------------------------------------------


def lag_measures() -> list[Column]:
    days = F.col("grant_lag_days")
    return [
        rows().alias("patent_count"),
        V.average(days).alias("avg_grant_lag_days"),
        V.average_years(days).alias("avg_grant_lag_years"),
        F.min(days).alias("min_lag_days"),
        F.max(days).alias("max_lag_days"),
    ]


def lag_by_section(
    patents: DataFrame, patent_cpc: DataFrame, facts: DataFrame | None = None
) -> DataFrame:
    facts = section_facts(patent_cpc, patents) if facts is None else facts
    return (
        facts.filter(F.col("grant_lag_days") > 0)
        .groupBy("cpc_section")
        .agg(*lag_measures())
        .orderBy(*ordering("-avg_grant_lag_days", "cpc_section"))
    )


def lag_by_country(
    pairs: DataFrame,
    patents: DataFrame,
    min_patents: int = 500,
    k: int = 40,
    facts: DataFrame | None = None,
) -> DataFrame:
    facts = pair_facts(pairs, patents) if facts is None else facts
    counts = facts.filter(F.col("grant_lag_days") > 0).groupBy("country").agg(*lag_measures())
    return top_k(
        counts.filter(F.col("patent_count") >= min_patents), ["-patent_count", "country"], k
    )


def lag_trend(patents: DataFrame, low: int = MIN_YEAR, high: int = MAX_YEAR) -> DataFrame:
    dated = patents.filter(V.in_years(F.col("year"), low, high) & (F.col("grant_lag_days") > 0))
    return dated.groupBy("year").agg(*lag_measures()[:3]).orderBy("year")


def claims_per_year(patents: DataFrame, low: int = MIN_YEAR, high: int = MAX_YEAR) -> DataFrame:
    dated = patents.filter(V.in_years(F.col("year"), low, high) & (F.col("num_claims") > 0))
    return (
        dated.groupBy("year")
        .agg(
            rows().alias("patent_count"),
            V.average(F.col("num_claims"), 2).alias("avg_claims"),
            F.min("num_claims").alias("min_claims"),
            F.max("num_claims").alias("max_claims"),
        )
        .orderBy("year")
    )


def claims_by_section(
    patents: DataFrame, patent_cpc: DataFrame, facts: DataFrame | None = None
) -> DataFrame:
    facts = section_facts(patent_cpc, patents) if facts is None else facts
    return (
        facts.filter(F.col("num_claims") > 0)
        .groupBy("cpc_section")
        .agg(
            rows().alias("patent_count"),
            V.average(F.col("num_claims"), 2).alias("avg_claims"),
            F.max("num_claims").alias("max_claims"),
        )
        .orderBy(*ordering("-avg_claims", "cpc_section"))
    )
