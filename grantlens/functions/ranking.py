"""First row per key, top-k and top-n per group, always with an explicit order."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordering(*specs: str) -> list[Column]:
    """Turn ``"name"`` / ``"-name"`` into ascending / descending columns, NULLs last both ways."""
    return [
        F.col(s[1:]).desc_nulls_last() if s.startswith("-") else F.col(s).asc_nulls_last()
        for s in specs
    ]


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of each key in the given order.

    Catalyst turns ``row_number() <= 1`` into a window group limit on both sides of the shuffle, so
    a key that holds a large part of the rows sends one row per map task, not all of them.
    """
    return top_n_per_group(df, keys, order, 1)


def top_n_per_group(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*ordering(*order))
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def top_k(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """Planned as TakeOrderedAndProject: each task keeps k rows."""
    return df.orderBy(*ordering(*order)).limit(k)


def number_rows(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """1, 2, 3, ... over a result already cut to a few rows; never call it on a full table."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*ordering(*order))))
