import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from grantlens.sources import model as store
from grantlens.operators import analytics, checks, clean
from grantlens.sources import partials, raw, reports, storage


def test_raw_file_with_prose(spark, rows, tmp_path):
    (tmp_path / "g_patent.tsv").write_text(
        'unused\tnum_claims\tpatent_id\tpatent_title\tpatent_date\tpatent_type\n'
        'x\t3\tPP1\t"Two\nlines ""quoted""\tand tab"\t2000-01-01\tplant\n'
        "x\t\tRE2\tNA\t\treissue\n"
    )
    assert rows(raw.read_raw(spark, str(tmp_path), "g_patent")) == [
        ("PP1", 'Two\nlines "quoted"\tand tab', "2000-01-01", "plant", "3"),
        ("RE2", "NA", None, "reissue", None),
    ]
    parity = raw.read_raw(spark, str(tmp_path), "g_patent", na_values=["NA", "null"])
    assert parity.filter("patent_title IS NULL").count() == 1


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "g_application.tsv").write_text("patent_id\n1\n")
    with pytest.raises(Exception, match="filing_date"):
        raw.read_raw(spark, str(tmp_path), "g_application")


def test_bad_section_lines(spark, rows, tmp_path):
    (tmp_path / "g_cpc_current.tsv").write_text(
        "patent_id\tseq\tcpc_section\n1\t0\tA\n2\t0\tB\textra\n3\n4\t0\t\"C\tD\"\n5\t0\n6\t0\tE\t\n"
    )
    folder = str(tmp_path)
    assert rows(raw.read_sections(spark, folder)) == [
        ("1", "A"), ("3", None), ("4", "C\tD"), ("5", None),
    ]
    assert rows(raw.read_sections(spark, folder, strict=True)) == [("1", "A"), ("4", "C\tD")]
    assert rows(raw.bad_line_counts(spark, folder)) == [(6, 2, 2)]


def test_sample_joins(tables):
    sample = raw.sample_raw(
        {"g_patent": tables.raw_patent, "g_inventor_disambiguated": tables.raw_inventor,
         "g_location_disambiguated": tables.raw_location},
        50,
    )
    patents = sample["g_patent"]
    assert patents.count() == 50
    people = sample["g_inventor_disambiguated"]
    assert people.count() > 0
    assert people.join(patents, "patent_id", "left_anti").count() == 0
    assert sample["g_location_disambiguated"].count() == tables.raw_location.count()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_model_round_trip(spark, tables, rows, tmp_path, fmt):
    model = tables.model()
    model["patents"] = model["patents"].withColumn("filing_year", F.col("year"))
    del model["patent_cpc"]
    store.write_model(model, str(tmp_path), fmt)
    loaded = store.load_model(spark, str(tmp_path), fmt, views=fmt == "parquet")
    assert set(loaded) == set(model)
    for name, frame in loaded.items():
        wanted = model[name].select(*[F.col(f.name).cast(f.dataType) for f in frame.schema])
        assert rows(frame) == rows(wanted), name
    if fmt == "parquet":
        assert spark.sql("SELECT count(*) FROM patents").first()[0] == model["patents"].count()
        pruned = loaded["patents"].filter("year = 1996")._jdf.queryExecution().executedPlan()
        assert "PartitionFilters: [isnotnull(year" in pruned.toString()


def test_dates_are_iso_text_in_csv(spark, tables, tmp_path):
    patents = tables.patents("grant", "abstract").withColumn("filing_year", F.col("year"))
    store.write_model({"patents": patents}, str(tmp_path), "csv")
    text = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    row = text.csv(f"{tmp_path}/patents").first()
    assert date.fromisoformat(row.filing_date)


def test_document(spark, tables):
    document = json.loads(reports.report_document(tables.model()).first().report)
    assert len(document) == 14
    assert document["total_patents"] == sum(x["patent_count"] for x in document["patents_per_year"])
    assert document["year_range"].keys() == {"from", "to"}
    assert len(document["top_inventors"]) == 10
    counts = [x["patents"] for x in document["top_inventor_rankings"]]
    assert counts == sorted(counts, reverse=True)
    assert [x["rank"] for x in document["top_inventor_rankings"]] == list(range(1, len(counts) + 1))
    years = [x["year"] for x in document["claims_per_year"]]
    assert years == sorted(years)
    assert document["cpc_section_distribution"][0].keys() == {
        "cpc_section", "cpc_name", "patents", "percentage",
    }


def test_reports_without_sections(spark, tables):
    model = tables.model()
    del model["patent_cpc"]
    names = set(reports.results(model))
    assert "top_inventors" in names and "claims_by_cpc" not in names
    document = json.loads(reports.report_document(model).first().report)
    assert document["claims_by_cpc"] == [] and len(document) == 14


def test_report_csv_has_header(spark, tables, tmp_path):
    reports.write_csv(reports.results(tables.model())["patents_per_year"], f"{tmp_path}/r")
    (part,) = (tmp_path / "r").glob("part-*.csv")
    assert part.read_text().splitlines()[0] == "year,patent_count"


def test_inputs_present(spark, folder):
    found = checks.inputs_present(spark, {"orders": f"{folder}/orders.parquet", "no": f"{folder}/no"})
    assert sorted(tuple(r) for r in found.collect()) == [("no", False, False), ("orders", True, True)]


class Unset:
    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "local[4]"


def test_shared_folder_follows_the_session(spark):
    named = storage.shared_folder(spark, "x")
    assert named.startswith(spark.conf.get("spark.checkpoint.dir") + "/grantlens/x-")
    first, second = storage.shared_folder(Unset, "x"), storage.shared_folder(Unset, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_clusters_must_name_a_shared_folder(monkeypatch, master):
    monkeypatch.setattr(Unset.sparkContext, "master", master)
    with pytest.raises(ValueError):
        storage.shared_folder(Unset, "x")


def test_written_while_leaves_nothing(spark, tables, rows):
    with storage.written_while(tables.companies, "companies") as kept:
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert rows(kept) == rows(tables.companies)
        assert storage.path_exists(spark, path)
    assert not storage.path_exists(spark, path)


def test_written_table_is_the_frame(spark, tables, rows):
    assert rows(storage.written(tables.companies, "companies")) == rows(tables.companies)


def test_sections_are_stored_and_counted_in_one_pass(spark, rows, tmp_path):
    (tmp_path / "g_cpc_current.tsv").write_text(
        "patent_id\tseq\tcpc_section\n1\t0\tA\n2\t0\tB\textra\n3\n4\t0\t\"C\tD\"\n5\t0\n6\t0\tE\t\n"
    )
    folder, target = str(tmp_path), f"{tmp_path}/stored"
    counts = raw.write_sections(spark, folder, target)
    assert rows(raw.bad_line_counts(spark, folder)) == [(counts["lines"], counts["too_long"], counts["short"])] == [(6, 2, 2)]
    assert rows(raw.stored_sections(spark, target)) == rows(raw.read_sections(spark, folder))
    assert rows(raw.stored_sections(spark, target, "rejected")) == [("2\t0\tB\textra",), ("6\t0\tE\t",)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_writing_counts_rows_and_dates(spark, tables, rows, tmp_path, fmt):
    model = tables.model()
    model["patents"] = model["patents"].withColumn("filing_year", F.col("year"))
    model["patent_cpc"] = clean.label_sections(model["patent_cpc"])
    counts = store.write_model(model, str(tmp_path), fmt)
    loaded = store.load_model(spark, str(tmp_path), fmt)
    assert {r.table_name: r.n_rows for r in checks.row_counts(loaded).collect()} == {n: c["n_rows"] for n, c in counts.items()}
    patents = counts["patents"]
    assert rows(checks.valid_dates(loaded["patents"])) == [(patents["n_rows"], patents["filing_date"], patents["patent_date"])]


def test_reports_from_partial_aggregates(spark, tables, rows, tmp_path):
    """Three appends with overlaps and repeats: equal to recomputing over the stored model."""
    patents = tables.patents("grant", "abstract").withColumns({"filing_year": F.col("year"), "seq": F.lit(1)})
    model, parts = f"{tmp_path}/model", f"{tmp_path}/parts"
    store.write_model({"patents": patents.limit(0), "patent_cpc": clean.label_sections(tables.patent_cpc).limit(0)}, model)
    for number, some in enumerate(["id % 3 = 0", "id % 3 < 2", "id >= 0"]):
        mine = patents.withColumn("id", F.col("patent_id").cast("bigint")).filter(some)
        cpc = clean.label_sections(tables.patent_cpc).join(mine.select("patent_id"), "patent_id", "left_semi")
        store.append_new(
            spark, model, "patents", mine.unionByName(mine.limit(50)), ["seq"],
            also=lambda fresh, n=number: partials.add(parts, n, patents=fresh, country_pairs=fresh.select(F.col("patent_type").alias("country"), "patent_id")),
        )
        store.append_new(
            spark, model, "patent_cpc", cpc, ["cpc_section_name"], also=lambda fresh, n=number: partials.add(parts, n, patent_cpc=fresh)
        )
    stored = store.load_model(spark, model)
    assert stored["patents"].count() == patents.count()
    assert rows(partials.patents_per_year(spark, parts)) == rows(analytics.patents_per_year(stored["patents"])) != []
    assert rows(partials.claims_per_year(spark, parts)) == rows(analytics.claims_per_year(stored["patents"])) != []
    assert rows(partials.section_distribution(spark, parts)) == rows(analytics.section_distribution(stored["patent_cpc"])) != []
    pairs = stored["patents"].select(F.col("patent_type").alias("country"), "patent_id")
    assert rows(partials.top_countries(spark, parts)) == rows(analytics.top_countries(pairs)) != []
    before = rows(partials.claims_per_year(spark, parts))
    store.append_new(spark, model, "patents", patents, ["seq"], also=lambda fresh: partials.add(parts, 3, patents=fresh))
    assert rows(partials.claims_per_year(spark, parts)) == before
