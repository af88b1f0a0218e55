"""The grams of titles in a folder: lists of patents by gram bucket, the grams' counts, and the patents to look up."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.operators.search import TitleIndex, bucket_of, title_grams
from grantlens.sources.storage import written_while

GRAM_BUCKETS = 256


def write_titles(patents: DataFrame, folder: str, buckets: int = GRAM_BUCKETS) -> None:
    """Patents are unique. Of a frequent gram the list spreads over many files.

    Ranges are chosen by a first pass over the rows, so patents, which may come from joins, are stored before.
    """
    with written_while(patents, "titles") as stored:
        _write(stored, folder, buckets)


def _write(patents: DataFrame, folder: str, buckets: int) -> None:
    by_gram = ["bucket", "gram", "patent_id"]
    grams = title_grams(patents).withColumn("bucket", bucket_of(buckets, "gram"))
    ordered = grams.repartitionByRange(*by_gram).sortWithinPartitions(*by_gram)
    ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/grams")
    spark = patents.sparkSession
    counts = spark.read.parquet(f"{folder}/grams").groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/counts")
    patents.repartitionByRange("patent_id").sortWithinPartitions("patent_id").write.mode("overwrite").parquet(f"{folder}/patents")
    row = spark.range(1, numPartitions=1).select(F.lit(buckets).alias("buckets"))
    row.write.mode("overwrite").parquet(f"{folder}/settings")


def read_titles(spark: SparkSession, folder: str) -> TitleIndex:
    buckets = spark.read.parquet(f"{folder}/settings").first()["buckets"]
    schema = "gram string, {} bucket int"
    grams = spark.read.schema(schema.format("patent_id string,")).parquet(f"{folder}/grams")
    counts = spark.read.schema(schema.format("n bigint,")).parquet(f"{folder}/counts")
    return TitleIndex(grams, counts, spark.read.parquet(f"{folder}/patents"), buckets)
