"""Steps that must grow no faster than their input: no gathering of words, no walk up to every character, no single task."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from grantlens.operators import search as S
from grantlens.plans import registry as R
from grantlens.plans.driver_tables import DriverTables
from grantlens.sources import index_store, storage

DOCS = "patent_id string, title string, abstract string"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_row_by_row(spark):
    docs = spark.createDataFrame([("1", "A b, a", "b É c_c"), ("2", None, ""), ("3", "x", None), (None, "y", "y")], DOCS)
    index = S.build_index(docs)
    plan = plan_of(index.postings)
    assert "Aggregate" not in plan and "Sort" not in plan
    got = {(r.patent_id, r.term): (r.tf, r.doc_len, r.positions) for r in index.postings.collect()}
    assert got == {
        ("1", "a"): (2, 7, [0, 2]), ("1", "b"): (2, 7, [1, 4]), ("1", "É"): (1, 7, [5]), ("1", "c"): (2, 7, [6, 7]),
        ("3", "x"): (1, 1, [0]), (None, "y"): (2, 2, [0, 2]),
    }


def test_rows_that_share_an_id_are_put_together(spark):
    docs = spark.createDataFrame([("1", "a b", "c"), ("1", "b", "c d"), ("2", "a", "a"), (None, "z", ""), (None, "z", "")], DOCS)
    index, plain = S.build_index(docs), S.make_postings(docs)
    rows = lambda frame: sorted(map(repr, frame.select("term", "patent_id", "tf", "doc_len", "positions").collect()))
    assert rows(index.postings) == rows(plain) == rows(S.flat_postings(index.by_patent))


def test_grams_walk_a_title_once(spark):
    docs = spark.createDataFrame([("1", "Abcab"), ("2", "é\U0001f600x"), ("3", "ab"), ("4", "q"), ("5", ""), ("6", None)], "patent_id string, title string")
    grams = S.title_grams(docs)
    assert "substring" not in plan_of(grams)
    found = {}
    for r in grams.collect():
        found.setdefault(r.patent_id, []).append(r.gram)
    assert {k: sorted(v) for k, v in found.items()} == {
        "1": ["", "ab", "abc", "bc", "bca", "ca", "cab"], "2": ["", "é\U0001f600", "é\U0001f600x", "\U0001f600x"],
        "3": ["", "ab"], "4": [""], "5": [""],
    }


def test_raw_files_are_written_by_many_tasks(spark, monkeypatch):
    plans, write = [], R._write_tsv
    monkeypatch.setattr(R, "_write_tsv", lambda frame, path: (plans.append(plan_of(frame)), write(frame, path)))
    assert R.src_raw_tsv(DriverTables(spark, "/root/testdata/sf0.001")).count() == 1500
    assert "Coalesce" not in plans[0]


def test_the_second_format_comes_from_the_first(spark, monkeypatch):
    plans, write = [], R.store.write_model
    monkeypatch.setattr(R.store, "write_model", lambda model, *a: write(model, *a) if plans.extend(plan_of(model[n]) for n in model if n == "patents") is None else None)
    R.src_clean_tables(DriverTables(spark, "/root/testdata/sf0.001"))
    assert "Join" in plans[0] and "Join" not in plans[1]


def test_tasks_of_an_index_follow_its_texts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "TEXT_PER_TASK", 50, raising=False)
    monkeypatch.setattr(index_store, "WORDS_PER_TASK", 10, raising=False)
    docs = spark.createDataFrame([(str(n), "a b", f"c d e w{n}") for n in range(40)] + [("none", None, " ")], DOCS)
    index = S.build_index(docs)
    assert index.postings.rdd.getNumPartitions() >= 8
    index_store.write_index(index, str(tmp_path), buckets=1, slots=4)
    assert len(list(tmp_path.glob("postings/segment=0/bucket=0/*.parquet"))) >= 20
    rows = lambda found: sorted(map(repr, S.index_rows(found).collect()))
    stored = index_store.read_index(spark, str(tmp_path))
    assert rows(stored) == rows(index) and stored.documents.count() == 41
    assert stored.blocks.groupBy("bucket", "term", "band").count().filter("count > 1").isEmpty()


def test_splits_are_small_only_within_the_block(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with storage.small_splits(spark, 1000):
        assert spark.conf.get(name) == "1000"
        with storage.small_splits(spark, 5000):
            assert spark.conf.get(name) == "1000"
    assert spark.conf.get(name) == before


def test_tokens_are_counted_within_their_row(spark):
    docs = spark.createDataFrame([("1", "A b, a", "b É c_c"), ("2", None, ""), ("3", "x", None), (None, "y", "y")], DOCS)
    got = S.tokenize(docs)
    assert "Aggregate" not in plan_of(got)
    rows = lambda frame: sorted(map(repr, frame.select("patent_id", "term", "tf").collect()))
    plain = lambda d: S._words(d, "ascii").groupBy("patent_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    assert rows(got) == rows(plain(docs))
    twice = docs.union(docs.filter("patent_id = '1' OR patent_id IS NULL"))
    assert rows(S.tokenize(twice)) == rows(plain(twice))


def test_an_index_is_written_without_shuffles_that_its_order_spares(spark, tmp_path, monkeypatch):
    """Only postings, terms' counts and states are dealt again: blocks are counted file by file, forward rows lie by slot."""
    rows = [(str(i), f"w{i % 7} the", f"the a{i % 50} " * (i % 9)) for i in range(300)] + [(None, "the", None)]
    docs = spark.createDataFrame(rows, DOCS)
    plans, write = {}, DataFrameWriter.parquet
    frames = lambda writer, path: plans.update({path.split("/segment")[0].split("/")[-1]: plan_of(writer._df)})
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (frames(self, path), write(self, path, *a, **k))[1])
    index = S.build_index(docs)
    index_store.write_index(index, str(tmp_path), buckets=4, slots=8)
    assert "Exchange" in plans["postings"]
    assert "Exchange" not in plans["forward"] and "Exchange" not in plans["blocks"] and "FileScan" in plans["terms"]
    assert "blocks" in plans["terms"]
    stored = index_store.read_index(spark, str(tmp_path))
    keep = lambda frame: sorted(map(repr, frame.collect()))
    assert keep(S.index_rows(stored)) == keep(S.index_rows(index))
    flat = S.flat_postings(index.by_patent).groupBy("term", S.band_of())
    counts = [F.count("*").alias("n"), F.max("tf").alias("max_tf"), F.min("doc_len").alias("min_len")]
    assert keep(stored.blocks.drop("bucket")) == keep(flat.agg(*counts))
    slots = spark.read.parquet(f"{tmp_path}/forward/segment=0")
    assert keep(slots.select("slot")) == keep(slots.select(index_store.slot_of(8)))


def test_documents_are_spread_in_the_order_of_their_hash(spark):
    docs = spark.range(5000).select(F.col("id").cast("string").alias("patent_id"), F.lit("a").alias("title"), F.lit("b").alias("abstract"))
    spread = S._spread_in_order(docs, 40 * S.TEXT_PER_TASK).withColumn("task", F.spark_partition_id())
    tasks = spread.groupBy("task").agg(F.countDistinct(F.pmod(S.hash_of(), F.lit(64))).alias("n"), F.count("*").alias("rows")).collect()
    assert len(tasks) == 41 and sum(r.rows for r in tasks) == 5000
    assert max(r.n for r in tasks) <= 3 and max(r.rows for r in tasks) < 250


def test_keys_are_counted_in_small_tasks(spark, folder, monkeypatch):
    parts, advised = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, seen, write = (spark.conf.get(parts), spark.conf.get(advised)), [], R.written
    monkeypatch.setattr(R, "written", lambda *a: (seen.append((spark.conf.get(parts), spark.conf.get(advised))), write(*a))[1])
    assert R.REGISTRY["v_key_unique"](spark, folder).count() == 11
    assert seen == [(before[0], "8000000")] and (spark.conf.get(parts), spark.conf.get(advised)) == before
    with storage.small_tasks(spark, 36_000_000):
        assert spark.conf.get(parts) == "73"
    assert spark.conf.get(parts) == before[0]
