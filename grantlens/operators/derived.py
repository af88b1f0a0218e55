"""Comparison tables built on top of the analytic results; all inputs here are short."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.functions.ranking import ordering, top_k
from grantlens.operators.clean import label_sections
from grantlens.schema import DAYS_PER_YEAR

# ---- filters ----------------------------------------------------------------------------------


def filter_years(
    df: DataFrame, low: int | None = None, high: int | None = None, year: str = "year"
) -> DataFrame:
    """Both ends included; an open end stands for the first or last year present."""
    kept = F.col(year).isNotNull()
    if low is not None:
        kept &= F.col(year) >= low
    if high is not None:
        kept &= F.col(year) <= high
    return df.filter(kept)


def filter_countries(df: DataFrame, countries: list[str]) -> DataFrame:
    """No countries chosen means all."""
    return df.filter(F.col("country").isin(countries)) if countries else df


def filter_sections(df: DataFrame, sections: list[str]) -> DataFrame:
    return df.filter(F.col("cpc_section").isin(sections))


def filter_options(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


# ---- totals and key figures -------------------------------------------------------------------


def total_patents(per_year: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """From the summary, or the sum of the yearly counts if there is none."""
    if summary is not None:
        return summary.select("total_patents")
    return per_year.agg(F.sum("patent_count").alias("total_patents"))


def average_grant_years(lag_trend: DataFrame, weighted: bool = False) -> DataFrame:
    """By default the plain mean of the yearly means; ``weighted`` counts patents."""
    days = F.avg("avg_grant_lag_days")
    if weighted:
        product = F.sum(F.col("avg_grant_lag_days") * F.col("patent_count"))
        days = product / F.sum("patent_count")
    return lag_trend.agg((days / DAYS_PER_YEAR).alias("avg_grant_years"))


def overview(summary: DataFrame, lag_trend: DataFrame) -> DataFrame:
    grant_time = average_grant_years(lag_trend).scalar()
    return summary.withColumn("avg_grant_years", F.round(grant_time, 6))


def lag_figures(lag_trend: DataFrame, years: int = 5) -> DataFrame:
    """Unweighted mean lag overall, over the last and over the first years, in days and years."""
    days = F.col("avg_grant_lag_days")
    late = F.row_number().over(Window.orderBy(F.col("year").desc()))
    early = F.row_number().over(Window.orderBy(F.col("year").asc()))
    numbered = lag_trend.select("year", days, late.alias("late"), early.alias("early"))
    means = {
        "overall": F.avg(days),
        "recent": F.avg(F.when(F.col("late") <= years, days)),
        "earliest": F.avg(F.when(F.col("early") <= years, days)),
    }
    return numbered.agg(
        *[
            F.round(mean / unit, 6).alias(f"{name}_{label}")
            for name, mean in means.items()
            for label, unit in (("days", 1.0), ("years", DAYS_PER_YEAR))
        ]
    )


def claims_delta(
    claims_per_year: DataFrame, low: int | None = None, high: int | None = None
) -> DataFrame:
    """First against last year of the range; empty with fewer than two years."""
    picked = filter_years(claims_per_year, low, high)
    first, last = F.min_by("avg_claims", "year"), F.max_by("avg_claims", "year")
    row = picked.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        first.alias("first_avg_claims"),
        last.alias("last_avg_claims"),
        F.round(last - first, 2).alias("change"),
        F.max_by("patent_count", "year").alias("latest_patents"),
    )
    return row.filter(F.col("first_year") < F.col("last_year"))


# ---- filing against grant ---------------------------------------------------------------------


def filing_vs_grant(
    per_year: DataFrame,
    by_grant_year: DataFrame,
    low: int | None = None,
    high: int | None = None,
) -> DataFrame:
    filed = filter_years(per_year, low, high).select(
        F.col("year").alias("yr"), F.col("patent_count").alias("filed")
    )
    granted = filter_years(by_grant_year, low, high, "yr").select(
        "yr", F.col("patent_count").alias("granted")
    )
    return filed.join(granted, "yr", "full").fillna(0, ["filed", "granted"]).orderBy("yr")


def filing_grant_gap(compared: DataFrame) -> DataFrame:
    """A signed gap, because in the last years more is granted than filed."""
    ratio = F.col("granted") * 100.0 / F.nullif(F.col("filed"), F.lit(0))
    return compared.withColumns(
        {"gap": F.col("filed") - F.col("granted"), "granted_pct": F.round(ratio, 1)}
    )


def divergence_years(compared: DataFrame) -> DataFrame:
    """Years in which something, but less than 90 % of the filings, was granted; first one marked."""
    low = compared.filter((F.col("granted") > 0) & (F.col("granted") < F.col("filed") * 0.9))
    first = low.agg(F.min("yr")).scalar()
    return low.withColumn("is_first", F.col("yr") == first)


# ---- boards -----------------------------------------------------------------------------------


def top_for_display(ranked: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows in ranking order, smallest first."""
    flipped = [s[1:] if s.startswith("-") else f"-{s}" for s in order]
    return top_k(ranked, order, n).orderBy(*ordering(*flipped))


def country_trend_selection(
    trends: DataFrame, countries: list[str], low: int | None = None, high: int | None = None
) -> DataFrame:
    """Nothing chosen gives nothing here, unlike the page-wide country filter."""
    chosen = filter_years(trends, low, high).filter(F.col("country").isin(countries))
    return chosen.orderBy(*ordering("country", "year"))


def decade_slice(by_decade: DataFrame, decade: int) -> DataFrame:
    rows = by_decade.filter(F.col("decade") == decade)
    return rows.orderBy(*ordering("-patents_per_decade", "country"))


def leaderboard(rankings: DataFrame, countries: list[str], n: int = 20) -> DataFrame:
    """The rank stays that of the unfiltered list."""
    return top_k(filter_countries(rankings, countries), ["rank"], n).select(
        "rank", "name", "country", "patent_count"
    )


def company_board(top_companies: DataFrame, n: int = 20) -> DataFrame:
    return top_k(top_companies, ["-patent_count", "company_id"], n)


def country_totals(top_countries: DataFrame, countries: list[str], n: int = 20) -> DataFrame:
    return top_k(filter_countries(top_countries, countries), ["-patent_count", "country"], n)


def country_lag_board(lag_by_country: DataFrame, countries: list[str], n: int = 20) -> DataFrame:
    """The n largest countries, fastest first."""
    largest = top_k(filter_countries(lag_by_country, countries), ["-patent_count", "country"], n)
    return largest.orderBy(*ordering("avg_grant_lag_days", "country"))


def section_slice(by_section: DataFrame, section: str, order: list[str]) -> DataFrame:
    return filter_sections(label_sections(by_section), [section]).orderBy(*ordering(*order))


def section_trend_selection(
    trends: DataFrame, sections: list[str], low: int | None = None, high: int | None = None
) -> DataFrame:
    chosen = filter_sections(filter_years(trends, low, high), sections)
    return label_sections(chosen).orderBy(*ordering("cpc_section", "year"))


def section_volume(distribution: DataFrame) -> DataFrame:
    return label_sections(distribution).orderBy(*ordering("-patent_count", "cpc_section"))


def lag_table_sections(lag_by_section: DataFrame) -> DataFrame:
    return label_sections(lag_by_section).orderBy(*ordering("-avg_grant_lag_days", "cpc_section"))


def claims_table_sections(claims_by_section: DataFrame) -> DataFrame:
    return label_sections(claims_by_section).orderBy(*ordering("-avg_claims", "cpc_section"))


def lag_against_claims(lag_by_section: DataFrame, claims_by_section: DataFrame) -> DataFrame:
    """``patent_count`` is the number of patents with a positive lag."""
    claims = claims_by_section.select("cpc_section", "avg_claims")
    return label_sections(lag_by_section.join(claims, "cpc_section"))
