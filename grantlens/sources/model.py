"""Storing and loading the clean model."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grantlens.operators.clean import iso_dates, new_rows, section_lists
from grantlens.schema import CLEAN_SCHEMAS, KEYS, WITH_PROSE
from grantlens.sources.storage import path_exists, written_while

# Year folders make year filters prune whole files.
PARTITIONED_BY = {"patents": "year"}


def load_model(
    spark: SparkSession, folder: str, fmt: str = "parquet", views: bool = False
) -> dict[str, DataFrame]:
    """The clean tables that are present, with declared types; ``views`` also registers them for SQL.

    CSV files must hold the columns in declared order, as ``write_model`` leaves them.
    """
    model = {}
    for name, schema in CLEAN_SCHEMAS.items():
        path = f"{folder}/{name}"
        if not path_exists(spark, path):
            continue
        reader = spark.read.schema(schema)
        if fmt == "csv":
            prose = name in WITH_PROSE  # only there can a line break stand inside quotes
            reader = reader.option("header", True).option("escape", '"').option("multiLine", prose)
        model[name] = reader.format(fmt).load(path).select(schema.names)
        if views:
            model[name].createOrReplaceTempView(name)
    return model


def write_model(model: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, dict[str, int]]:
    """Overwrites every given table. CSV is unpartitioned and carries ISO dates as text.

    If the section pairs are given without the lists per patent, the lists are made from the written
    pairs, so that the raw section file is worked through once.

    Returns what was counted while writing: for each table its ``n_rows`` and how many rows have each date. Counting is
    part of the tasks that write, so no table is read for it.
    """
    counts = {}
    for name, frame in model.items():
        schema = CLEAN_SCHEMAS[name]
        frame = frame.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        dates = [f.name for f in schema if f.dataType.typeName() == "date"]
        key = PARTITIONED_BY.get(name) if fmt != "csv" else None
        if key:
            # Few files per year, while Spark splits a year too big for one task at run time.
            frame = frame.hint("rebalance", F.col(key))
        seen = Observation()
        frame = frame.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.count(d).alias(d) for d in dates])
        if fmt == "csv":
            writer = iso_dates(frame, dates).write.option("header", True).option("escape", '"')
        else:
            writer = frame.write.partitionBy(key) if key else frame.write
        writer.mode("overwrite").format(fmt).save(f"{folder}/{name}")
        counts[name] = dict(seen.get)
    if "patent_cpc" in model and "cpc_section_agg" not in model:
        written = load_model(model["patent_cpc"].sparkSession, folder, fmt)["patent_cpc"]
        counts |= write_model({"cpc_section_agg": section_lists(written)}, folder, fmt)
    return counts


def append_new(
    spark: SparkSession, folder: str, name: str, batch: DataFrame, order: list[str], fmt: str = "parquet",
    also: Callable[[DataFrame], None] | None = None,
) -> None:
    """Appends to a stored table the rows of ``batch`` whose key is not there; nothing stored is rewritten.

    Of equal new keys the first in order is taken. Of the stored table only the key is read. ``also`` is given the rows
    that are appended, before they are, such as ``partials.add`` to keep reports current.
    """
    schema = CLEAN_SCHEMAS[name]
    stored = load_model(spark, folder, fmt)[name]
    fresh = new_rows(stored, batch, KEYS[name], order).select(*[F.col(f.name).cast(f.dataType) for f in schema])
    if also is not None:
        with written_while(fresh, "fresh") as fresh:
            also(fresh)
            _append(fresh, folder, name, fmt)
    else:
        _append(fresh, folder, name, fmt)


def _append(fresh: DataFrame, folder: str, name: str, fmt: str) -> None:
    schema = CLEAN_SCHEMAS[name]
    if fmt == "csv":
        dates = [f.name for f in schema if f.dataType.typeName() == "date"]
        writer = iso_dates(fresh, dates).write.option("header", True).option("escape", '"')
    else:
        key = PARTITIONED_BY.get(name)
        writer = fresh.hint("rebalance", F.col(key)).write.partitionBy(key) if key else fresh.write
    writer.mode("append").format(fmt).save(f"{folder}/{name}")
