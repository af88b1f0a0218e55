"""Data-quality checks, each returned as a DataFrame."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.schema import FOREIGN_KEYS, KEYS
from grantlens.sources.storage import path_exists


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def inputs_present(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Each expected Parquet input: is it there, and does it hold rows."""
    checks = []
    for name, path in paths.items():
        if path_exists(spark, path):
            found = spark.read.parquet(path).limit(1).agg(F.count(F.lit(1)).alias("n"))
            row = found.select(F.lit(True).alias("present"), (F.col("n") > 0).alias("has_rows"))
        else:
            row = spark.range(1).select(
                F.lit(False).alias("present"), F.lit(False).alias("has_rows")
            )
        checks.append(row.select(F.lit(name).alias("input"), "present", "has_rows"))
    return _stack(checks)


def valid_dates(patents: DataFrame) -> DataFrame:
    return patents.agg(
        F.count(F.lit(1)).alias("patents"),
        F.count("filing_date").alias("valid_filing_dates"),
        F.count("patent_date").alias("valid_grant_dates"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            frame.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows"
            )
            for name, frame in tables.items()
        ]
    )


def year_range(patents: DataFrame) -> DataFrame:
    return patents.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year")).withColumn(
        "year_type", F.when(F.typeof("min_year") == "int", "integer").otherwise(F.typeof("min_year"))
    )


def orphans(model: dict[str, DataFrame], foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """Links whose parent is missing, per declared foreign key.

    Links are counted per key before the join: one row per key is shuffled, however many links it has.
    """
    checks = []
    for child, column, parent in foreign_keys:
        if child not in model or parent not in model:
            continue
        keys = model[child].groupBy(column).agg(F.count(F.lit(1)).alias("links"))
        lost = keys.join(model[parent].select(column), column, "left_anti")
        checks.append(
            lost.agg(
                F.coalesce(F.sum("links"), F.lit(0)).alias("orphan_links"),
                F.count(F.lit(1)).alias("missing_keys"),
            ).select(
                F.lit(child).alias("child"),
                F.lit(column).alias("key_column"),
                F.lit(parent).alias("parent"),
                "orphan_links",
                "missing_keys",
            )
        )
    return _stack(checks)


def key_violations(
    tables: dict[str, DataFrame], keys: dict[str, list[str]] = KEYS
) -> DataFrame:
    """Per table: keys that repeat, rows beyond the first of each, and rows with a NULL in the key."""
    checks = []
    for name, columns in keys.items():
        if name not in tables:
            continue
        has_null = F.lit(False)
        for column in columns:
            has_null |= F.col(column).isNull()
        groups = tables[name].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        repeated = ~has_null & (F.col("n") > 1)
        checks.append(
            groups.agg(
                F.count_if(repeated).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
                F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_keys"),
            ).select(F.lit(name).alias("table_name"), "repeated_keys", "extra_rows", "null_keys")
        )
    return _stack(checks)
