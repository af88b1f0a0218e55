"""Reports kept current by partial aggregates, one small table for each append.

An append's rows are aggregated once, by (report, key), and stored as ``part=<number>``; a report adds up the parts and
reads no row of the model. What is added must be new to the model, as ``append_new`` makes sure, so that counts of patents,
of section rows and of distinct (country, patent) pairs add up. The same part written again replaces itself.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions import values as V
from grantlens.functions.ranking import ordering, top_k
from grantlens.schema import MAX_YEAR, MIN_YEAR

SCHEMA = "report string, key string, n bigint, total bigint, low bigint, high bigint"


def _partial(frame: DataFrame, report: str, key: str, value: str | None = None) -> DataFrame:
    number = F.col(value).cast("bigint") if value else F.lit(None).cast("bigint")
    measures = [F.count(F.lit(1)).alias("n"), F.sum(number).alias("total"), F.min(number).alias("low"), F.max(number).alias("high")]
    return frame.groupBy(F.col(key).cast("string").alias("key")).agg(*measures).select(F.lit(report).alias("report"), "key", "n", "total", "low", "high")


def aggregate(
    patents: DataFrame | None = None, patent_cpc: DataFrame | None = None, country_pairs: DataFrame | None = None
) -> DataFrame:
    """The partial aggregates of new rows of any of the three tables."""
    parts = []
    if patents is not None:
        parts += [_partial(patents, "patents_per_year", "year")]
        parts += [_partial(patents.filter("num_claims > 0"), "claims_per_year", "year", "num_claims")]
    if patent_cpc is not None:
        parts += [_partial(patent_cpc, "section_distribution", "cpc_section")]
    if country_pairs is not None:
        parts += [_partial(country_pairs, "top_countries", "country")]
    return reduce(DataFrame.unionByName, parts)


def add(folder: str, part: int, **tables: DataFrame) -> None:
    """Stores the partial aggregates of one append: ``patents``, ``patent_cpc``, ``country_pairs`` or some of them, by
    the rows that are new in each."""
    for name, frame in tables.items():
        aggregate(**{name: frame}).write.mode("overwrite").parquet(f"{folder}/source={name}/part={part}")


def _added(spark: SparkSession, folder: str, report: str) -> DataFrame:
    rows = spark.read.schema(SCHEMA + ", source string, part int").parquet(folder).filter(F.col("report") == report)
    sums = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]
    return rows.groupBy("key").agg(*sums)


def _year() -> Column:
    return F.col("key").cast("int").alias("year")


def patents_per_year(spark: SparkSession, folder: str, low: int = MIN_YEAR, high: int = MAX_YEAR) -> DataFrame:
    found = _added(spark, folder, "patents_per_year").select(_year(), F.col("n").alias("patent_count"))
    return found.filter(V.in_years(F.col("year"), low, high)).orderBy("year")


def claims_per_year(spark: SparkSession, folder: str, low: int = MIN_YEAR, high: int = MAX_YEAR) -> DataFrame:
    found = _added(spark, folder, "claims_per_year").select(
        _year(),
        F.col("n").alias("patent_count"),
        F.round(F.col("total").cast("double") / F.col("n"), 2).alias("avg_claims"),
        F.col("low").alias("min_claims"),
        F.col("high").alias("max_claims"),
    )
    return found.filter(V.in_years(F.col("year"), low, high)).orderBy("year")


def section_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """The total is that of the handful of section rows."""
    counts = _added(spark, folder, "section_distribution")
    share = F.col("n").cast("double") * 100 / counts.agg(F.sum("n").alias("n")).scalar()
    found = counts.select(F.col("key").alias("cpc_section"), F.col("n").alias("patent_count"), F.round(share, 2).alias("percentage"))
    return found.filter("cpc_section IS NOT NULL").orderBy(*ordering("-patent_count", "cpc_section"))


def top_countries(spark: SparkSession, folder: str, k: int = 30) -> DataFrame:
    found = _added(spark, folder, "top_countries").select(F.col("key").alias("country"), F.col("n").alias("patent_count"))
    return top_k(found, ["-patent_count", "country"], k)
