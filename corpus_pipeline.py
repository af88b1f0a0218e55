"""From raw documents to packed training sequences: language, near-duplicates, mixing, packing.

Each stage takes (spark, docs, folder of the tables) and works on all rows that the stage before it kept.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm import language, minhash, mixing, packing
from grantlens.llm.queries import WORD_BPE
from grantlens.sources.storage import shared_folder

LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those for which the best language is not likelier than all others and none.

    Rows keep their columns as they are. Where nothing is labelled, nothing is learned and only texts without a letter go.
    """
    trees = language.learn_trees(docs.filter(~language.is_held_out(F.col("doc_id"))))
    found = language.predict_language(docs, trees)
    if not trees.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("lang_score") >= LEAST_SCORE)
    return found.filter(sure).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest doc_id."""
    return minhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; each copy of a document is packed on its own."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language models and tokenizers have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as a table before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        place = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
