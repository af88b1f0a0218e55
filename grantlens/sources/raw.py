"""Raw tab-separated files (plain or gzip), header row first.

A path may be one file or a folder of many. Files whose texts have line breaks inside quotes are split too, see
``grantlens.sources.prose``.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grantlens.functions.ranking import top_k
from grantlens.schema import RAW_COLUMNS, RAW_WITH_PROSE
from grantlens.sources.prose import read_delimited

BAD_RECORD = "_bad_record"


def _reader(spark: SparkSession):
    return spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')


def read_raw(
    spark: SparkSession,
    folder: str,
    name: str,
    suffix: str = ".tsv",
    na_values: list[str] | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """The needed columns of one raw file, as text, and the numbers in its ``order`` columns.

    Columns are found by header name, in any order, and only they are parsed. ``na_values`` are cell
    texts to read as missing besides the empty cell (none by default, so ``NA`` stays a country). ``order`` names
    columns that say which row comes first, such as a sequence number.
    """
    columns = RAW_COLUMNS[name]
    path = f"{folder}/{name}{suffix}"
    frame = read_delimited(spark, path) if name in RAW_WITH_PROSE else _reader(spark).csv(path)
    numbers = [F.expr(f"try_cast(`{c}` AS BIGINT)").alias(c) for c in order]
    texts = [F.when(~F.col(c).isin(na_values), F.col(c)).alias(c) if na_values else F.col(c) for c in columns]
    return frame.select(*texts, *numbers)


def read_all_raw(
    spark: SparkSession,
    folder: str,
    orders: dict[str, tuple[str, ...]],
    suffix: str = ".tsv",
    na_values: list[str] | None = None,
) -> dict[str, DataFrame]:
    """All raw files of a folder by name, with the order columns of each; of sections the well-formed lines."""
    found = {
        name: read_raw(spark, folder, name, suffix, na_values, orders.get(name, ()))
        for name in RAW_COLUMNS
        if name != "g_cpc_current"
    }
    return found | {"g_cpc_current": read_sections(spark, folder, suffix=suffix)}


def _with_bad_records(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    header = _reader(spark).csv(path).schema
    schema = header.add(BAD_RECORD, "string")
    frame = (
        _reader(spark)
        .schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("columnPruning", False)  # a pruned parse does not see surplus fields
        .csv(path)
    )
    return frame, len(header) - 1


def _too_long(fields: int):
    """More separators outside quotes than the header allows."""
    bare = F.regexp_replace(BAD_RECORD, r'"(?:[^"]|"")*"', "")
    return F.coalesce(F.size(F.split(bare, "\t")) > fields, F.lit(False))


def read_sections(
    spark: SparkSession, folder: str, name: str = "g_cpc_current", suffix: str = ".tsv",
    strict: bool = False,
) -> DataFrame:
    """Section rows without malformed lines.

    Lines with too many fields are dropped and short lines are filled with NULL; ``strict`` drops both.
    """
    frame, fields = _with_bad_records(spark, f"{folder}/{name}{suffix}")
    bad = F.col(BAD_RECORD).isNotNull() if strict else _too_long(fields)
    return frame.filter(~bad).select(RAW_COLUMNS[name])


def write_sections(
    spark: SparkSession, folder: str, target: str, name: str = "g_cpc_current", suffix: str = ".tsv"
) -> dict[str, int]:
    """Stores section rows and rejected lines in one pass over the file, and counts them meanwhile.

    Below ``target`` the folder ``status=kept`` has the rows that ``read_sections`` gives and ``status=rejected`` the lines
    with too many fields, as they are written. Returns lines, too_long and short, as ``bad_line_counts`` has them.
    """
    frame, fields = _with_bad_records(spark, f"{folder}/{name}{suffix}")
    columns, too_long = RAW_COLUMNS[name], _too_long(fields)
    rows = frame.select(
        *[F.when(~too_long, F.col(c)).alias(c) for c in columns],
        F.when(too_long, F.col(BAD_RECORD)).alias("line"),
        F.when(too_long, "rejected").otherwise("kept").alias("status"),
        F.col(BAD_RECORD).isNotNull().alias("_bad"),
    )
    seen, rejected = Observation(), F.col("status") == "rejected"
    short = F.count_if(F.col("_bad") & ~rejected).alias("short")
    rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(rejected).alias("too_long"), short)
    rows.drop("_bad").write.mode("overwrite").partitionBy("status").parquet(target)
    return dict(seen.get)


def stored_sections(spark: SparkSession, target: str, status: str = "kept") -> DataFrame:
    """The rows, or with ``rejected`` the lines, that ``write_sections`` stored."""
    columns = ["line"] if status == "rejected" else RAW_COLUMNS["g_cpc_current"]
    schema = ", ".join(f"{c} string" for c in [*RAW_COLUMNS["g_cpc_current"], "line", "status"])
    return spark.read.schema(schema).parquet(target).filter(F.col("status") == status).select(columns)


def bad_line_counts(
    spark: SparkSession, folder: str, name: str = "g_cpc_current", suffix: str = ".tsv"
) -> DataFrame:
    """How many lines were read, too long (dropped) and short (kept)."""
    frame, fields = _with_bad_records(spark, f"{folder}/{name}{suffix}")
    bad = F.col(BAD_RECORD).isNotNull()
    key = RAW_COLUMNS[name][0]
    return frame.agg(
        # names a data column, as Spark does not read bad records alone
        (F.count(key) + F.count_if(F.col(key).isNull())).alias("lines"),
        F.count_if(_too_long(fields)).alias("too_long"),
        F.count_if(bad & ~_too_long(fields)).alias("short"),
    )


def sample_raw(tables: dict[str, DataFrame], n: int) -> dict[str, DataFrame]:
    """A small run that still joins: n patents, and of the other files the rows about those patents."""
    ids = top_k(tables["g_patent"].select("patent_id").distinct(), ["patent_id"], n)
    return {
        name: frame.join(ids, "patent_id", "left_semi") if "patent_id" in frame.columns else frame
        for name, frame in tables.items()
    }
