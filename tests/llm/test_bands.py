"""Rotation codes where bands are hot, and how many bands there are; sizes given to the mix."""

from pyspark.sql import functions as F

from grantlens.llm import mixing, rotation_codes

FOLDER = "/root/testdata/sf0.01"


def test_hot_bands_in_blocks_change_nothing(spark, monkeypatch):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    whole = sorted(map(tuple, rotation_codes.near_vectors(frame).collect()))
    monkeypatch.setattr(rotation_codes, "BLOCK", 8)
    assert sorted(map(tuple, rotation_codes.near_vectors(frame).collect())) == whole


def test_more_bands_than_ten_bits_hold(spark, monkeypatch):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet").limit(40)
    whole = sorted(map(tuple, rotation_codes.near_vectors(frame).collect()))
    monkeypatch.setattr(rotation_codes, "bands_for", lambda count, threshold: (8, 1100))
    assert sorted(map(tuple, rotation_codes.near_vectors(frame).collect())) == whole


def test_a_pair_at_the_threshold_misses_all_bands_once_in_a_million():
    for count in (1_000, 1_000_000, 10**9):
        bits, bands = rotation_codes.bands_for(count, 0.9)
        together = (1 - 0.143567) ** bits  # the angle of cosine 0.9 is 0.143567 of half a turn
        assert (1 - together) ** bands <= 1.01e-6


def test_given_sizes_mix_alike(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "text")
    sized = docs.withColumn("n", mixing.word_count(F.col("text")))
    columns = ["doc_id", "_mix_size", "_mix_source_size", "_mix_target", "_mix_copies"]
    one, other = mixing.mix(docs), mixing.mix(sized.drop("text"), size="n")
    assert sorted(map(tuple, one.select(columns).collect())) == sorted(map(tuple, other.select(columns).collect()))
