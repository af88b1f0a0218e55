"""Where intermediate tables may be written."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one every executor can reach, which spark.checkpoint.dir names.

    Only in local mode, where the driver is the one executor, is a temporary folder made if it is unset.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="grantlens-")
        base = _local_base
    return f"{base.rstrip('/')}/grantlens/{purpose}-{uuid.uuid4().hex}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, for results that several jobs read."""
    return _stored(frame, shared_folder(frame.sparkSession, purpose))


def _stored(frame: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def written_while(frame: DataFrame, purpose: str, compression: str | None = None):
    """As ``written``, and the table is deleted at the end of the block."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    try:
        yield _stored(frame, path, compression)
    finally:
        delete_path(spark, path)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


@contextmanager
def _with_conf(spark: SparkSession, values: dict[str, int]):
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def small_splits(spark: SparkSession, most_bytes: int = 16_000_000):
    """Within the block a task reads at most so many bytes of files, for steps whose rows take far more room in memory."""
    name = "spark.sql.files.maxPartitionBytes"
    with _with_conf(spark, {name: min(most_bytes, _bytes(spark.conf.get(name)))}):
        yield


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int = 2_000_000):
    """Within the block Python workers get at most so many bytes of rows at once, or one longer row: a batch is held by Spark and
    by the worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    with _with_conf(spark, {name: min(most_bytes, _bytes(spark.conf.get(name)))}):
        yield


@contextmanager
def small_tasks(spark: SparkSession, n_rows: int, most_rows: int = 500_000, most_bytes: int = 8_000_000):
    """As ``small_splits``, and shuffles of ``n_rows`` rows are cut into tasks of about ``most_rows`` or ``most_bytes``, for steps
    that hold the rows of a task in memory. What runs in the block has these bounds, not what is only planned in it."""
    parts, advised = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    values = {
        parts: max(1 + n_rows // most_rows, int(spark.conf.get(parts))),
        advised: min(most_bytes, _bytes(spark.conf.get(advised))),
    }
    with small_splits(spark), _with_conf(spark, values):
        yield


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = _file_system(spark, path)
    return system.exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    system, jvm_path = _file_system(spark, path)
    system.delete(jvm_path, True)
