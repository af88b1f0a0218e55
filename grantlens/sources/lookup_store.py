"""Tables laid out for what they are asked for.

``write_sorted`` clusters a table by range, so that files, row groups and pages cover narrow stretches of the leading
column and a filter on it reads those that can hold an answer: Parquet keeps the least and greatest value of each. For
equal values of other columns it can keep Bloom filters.

``write_linked`` buckets a table by key and sorts each bucket, so that two such tables are joined bucket by bucket
without a shuffle, and counts by the key need none either.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PAGE_ROWS = 2_000
GROUP_BYTES = 32 << 20
BUCKETS = 256


def write_sorted(
    frame: DataFrame, folder: str, by: list[str], blooms: dict[str, int] | None = None,
    page_rows: int = PAGE_ROWS, group_bytes: int = GROUP_BYTES,
) -> None:
    """``blooms``: columns to look up by equal values, with about how many different ones a file has."""
    writer = frame.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite")
    writer = writer.option("parquet.page.row.count.limit", page_rows).option("parquet.block.size", group_bytes)
    for column, different in (blooms or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", different)
    writer.parquet(folder)


def read_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def _name() -> str:
    return f"linked_{uuid.uuid4().hex}"


def write_linked(frame: DataFrame, folder: str, key: str, buckets: int = BUCKETS) -> None:
    """Tables to be joined need the same number of buckets. A bucket is one file: the key is spread first."""
    spark, name = frame.sparkSession, _name()
    spread = frame.repartition(buckets, key).sortWithinPartitions(key)
    writer = spread.write.mode("overwrite").option("path", folder).format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay


def read_linked(spark: SparkSession, folder: str, schema: StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The table as it was written; its layout is told to the session under a name of its own."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    clustered = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {clustered} LOCATION '{folder}'")
    return spark.table(name)
