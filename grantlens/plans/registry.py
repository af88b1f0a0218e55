"""Every operator as a named query over the test tables: ``name -> f(spark, folder)``."""

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions.stem import stem
from grantlens.functions.text import normalize_query
from grantlens.operators import analytics as Q
from grantlens.operators import checks, clean, derived, search, views
from grantlens.plans.driver_tables import DriverTables
from grantlens.sources import model as store
from grantlens.sources import index_store, raw, reports, title_store
from grantlens.sources.storage import shared_folder, small_tasks, written
from grantlens.streaming.index_feed import CHANGE_SCHEMA, IndexFeed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters that fit the test tables.
LOW, HIGH = date(1995, 1, 1), date(2001, 6, 30)
YEARS = (1996, 1999)
COUNTRIES = ["NATION_3", "NATION_7", "NATION_11", "NATION_19"]
SECTION = "C"
SECTION_CHOICE = ["A", "G", "Y"]
DECADE = 1990
SAMPLE = 1000
SLOTS = 8  # of stored indexes
SEARCHES = ["worthless then", "the and", "que la", "Then, the!", "e", "zzzunknownword the"]
# Two of them have the same file name: the last is a phrase.
EXPORTS = [*SEARCHES, "que_la"]
OPERATOR_SEARCHES = [
    "then AND the",
    "worthless OR que",
    "the NOT then",
    "the and NOT que la OR est",
    "then NOT the NOT que AND est",
    "que_la",
    "of_the OR que_la NOT est",
    "the_of the NOT of_the_of",
    "the_and_the",
]
TITLE_SEARCHES = ["OR", "worthless then", "AND", "OR", "NOT", "que OR", "worthless then"]
PATENT_ORDER = ["seq", "title"]
APPLICATION_ORDER = ["seq"]
ABSTRACT_ORDER = ["seq"]
INVENTOR_ORDER = ["patent_id", "seq"]
ASSIGNEE_ORDER = ["patent_id"]


def register(fn):
    """Registers ``f(tables)`` under its own name."""
    REGISTRY[fn.__name__] = lambda spark, folder: fn(DriverTables(spark, folder))
    return fn


# ---- sources and sinks ------------------------------------------------------------------------


def _write_tsv(frame: DataFrame, path: str) -> None:
    writer = frame.write.mode("overwrite").option("sep", "\t").option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("quote", '"').option("escape", '"').csv(path)


@register
def src_raw_tsv(t):
    """Patents from a raw file in parts, each read by as many tasks as its size gives."""
    folder = shared_folder(t.spark, "raw")
    with_extra = t.raw_patent.select(F.lit("x").alias("unused"), "*")
    _write_tsv(with_extra, f"{folder}/g_patent.tsv")
    return raw.read_raw(t.spark, folder, "g_patent")


@register
def src_skip_bad_rows(t):
    """Returned lines get a surplus field and must vanish; accepted ones are short and must stay."""
    folder = shared_folder(t.spark, "sections")
    key, flag = F.col("l_orderkey").cast("string"), F.col("l_returnflag")
    line = (
        F.when(flag == "R", F.concat_ws("\t", key, "letter", F.lit("surplus")))
        .when(flag == "A", key)
        .otherwise(F.concat_ws("\t", key, "letter"))
    )
    lines = t.section_rows.select(line.alias("patent_id\tcpc_section"))
    whole = lines.write.mode("overwrite").option("header", True).option("sep", "\u0001")
    whole.option("quote", "").csv(f"{folder}/g_cpc_current.tsv")
    sections = raw.read_sections(t.spark, folder)
    return sections.groupBy("patent_id", "cpc_section").agg(F.count(F.lit(1)).alias("n"))


@register
def src_sample(t):
    """The sampled assignees, which all belong to sampled patents."""
    tables = {"g_patent": t.raw_patent, "g_assignee_disambiguated": t.raw_assignee}
    sample = raw.sample_raw(tables, SAMPLE)
    return sample["g_patent"].join(sample["g_assignee_disambiguated"], "patent_id").select(
        "patent_id", "patent_title", "assignee_id"
    )


PATENT_COLUMNS = [
    "patent_id",
    "title",
    "filing_date",
    "patent_date",
    "year",
    "patent_year",
    "patent_type",
    "num_claims",
    "grant_lag_days",
]


# The columns of each clean table that the content check reads; of abstracts it takes a digest and the length.
MODEL_TEXT = {name: list(schema.names) for name, schema in store.CLEAN_SCHEMAS.items()}


ORDERS = {
    "g_patent": ["seq"],
    "g_application": APPLICATION_ORDER,
    "g_patent_abstract": ABSTRACT_ORDER,
    "g_inventor_disambiguated": INVENTOR_ORDER,
    "g_assignee_disambiguated": ASSIGNEE_ORDER,
}


def raw_tables(t) -> dict[str, DataFrame]:
    return {
        "g_patent": t.raw_patent.withColumn("seq", F.lit(1)),
        "g_application": t.raw_application,
        "g_patent_abstract": t.raw_abstract,
        "g_inventor_disambiguated": t.raw_inventor,
        "g_assignee_disambiguated": t.raw_assignee,
        "g_location_disambiguated": t.raw_location,
        "g_cpc_current": t.raw_cpc,
    }


def clean_model(t) -> dict[str, DataFrame]:
    return clean.clean_model(raw_tables(t), ORDERS, LOW, HIGH)


def cells(tables: dict[str, DataFrame]) -> DataFrame:
    """Every cell of short tables as text: (report, row_key of the first two columns, column, value)."""
    parts = []
    for name, frame in tables.items():
        texts = [F.col(c).cast("string") for c in frame.columns]
        pairs = [F.struct(F.lit(c).alias("column"), t.alias("value")) for c, t in zip(frame.columns, texts)]
        row_key = F.concat_ws("|", *texts[:2]).alias("row_key")
        parts.append(frame.select(F.lit(name).alias("report"), row_key, F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def contents(model: dict[str, DataFrame]) -> DataFrame:
    """Every row of the clean tables as one text: (table_name, content)."""
    parts = []
    digest = F.concat(F.md5("abstract"), F.lit(":"), F.octet_length("abstract").cast("string"))
    for name, frame in model.items():
        shown = [digest if c == "abstract" else F.col(c).cast("string") for c in MODEL_TEXT[name]]
        texts = [F.coalesce(c, F.lit("~")) for c in shown]
        parts.append(frame.select(F.lit(name).alias("table_name"), F.concat_ws("|", *texts).alias("content")))
    return reduce(DataFrame.unionByName, parts)


@register
def src_clean_tables(t):
    """The whole model loaded back from both formats: the contents of every table. Its joins run once: the second
    format is written from the first."""
    model = t.model()
    model["patents"] = model["patents"].withColumn("filing_year", F.col("year"))
    model["patent_cpc"] = clean.label_sections(model["patent_cpc"])
    parts = []
    for fmt in ("parquet", "csv"):
        folder = shared_folder(t.spark, f"model-{fmt}")
        store.write_model(model, folder, fmt)
        model = store.load_model(t.spark, folder, fmt)
        parts.append(contents(model).withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


@register
def snk_clean_tables(t):
    """The whole run from raw files to the stored model: the contents of every table as one text per row."""
    folder, raw_folder = shared_folder(t.spark, "model"), shared_folder(t.spark, "raw")
    for name, frame in raw_tables(t).items():
        _write_tsv(frame, f"{raw_folder}/{name}.tsv")
    sequences = {n: ("seq",) for n, order in ORDERS.items() if "seq" in order}
    raw_files = raw.read_all_raw(t.spark, raw_folder, sequences)
    store.write_model(clean.clean_model(raw_files, ORDERS, LOW, HIGH), folder)
    return contents(store.load_model(t.spark, folder))


@register
def snk_report_csv(t):
    """Every report written, read back and compared cell by cell."""
    folder = shared_folder(t.spark, "reports")
    names = reports.write_reports(t.model(), folder)
    return cells({n: t.spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{n}") for n in names})


@register
def snk_report_json(t):
    """The written document: one row for each entry of each list and for each plain value."""
    path = f"{shared_folder(t.spark, 'document')}/report"
    reports.write_document(t.model(), path)
    document = reports.read_document(t.spark, path)
    keyed = document.select(
        "value", F.explode(F.json_object_keys("value")).alias("key")
    ).withColumn("part", F.expr("get_json_object(value, '$.' || key)"))
    is_list = F.substring("part", 1, 1) == "["
    entries = F.from_json("part", "array<map<string,string>>")
    listed = keyed.filter(is_list).select("key", F.posexplode(entries).alias("place", "entry"))
    listed = listed.select("key", "place", F.explode("entry").alias("field", "content"))
    plain = keyed.filter(~is_list).select(
        "key", F.lit(0).alias("place"), F.lit("").alias("field"), F.col("part").alias("content")
    )
    return listed.unionByName(plain)


# ---- cleaning ---------------------------------------------------------------------------------

DATES = ["filing_date", "patent_date"]


def _core(t):
    return clean.join_core(
        t.raw_patent, t.raw_application, t.raw_abstract, APPLICATION_ORDER, ABSTRACT_ORDER
    )


def _dated(t):
    return clean.clamp_dates(clean.parse_dates(_core(t), DATES), DATES, LOW, HIGH)


@register
def cl_parse_date(t):
    return clean.parse_dates(t.raw_patent.select("patent_id", "patent_date"), ["patent_date"])


@register
def cl_clamp_date(t):
    return clean.clamp_dates(cl_parse_date(t), ["patent_date"], LOW, HIGH)


@register
def cl_year_cols(t):
    return clean.add_years(_dated(t)).select("patent_id", "year", "filing_year", "patent_year")


@register
def cl_grant_lag(t):
    return clean.add_grant_lag(_dated(t)).select("patent_id", "grant_lag_days")


@register
def cl_iso_dates(t):
    return clean.iso_dates(_dated(t), DATES).select("patent_id", *DATES)


@register
def cl_num_claims(t):
    return clean.clean_claims(t.raw_patent).select("patent_id", "num_claims")


@register
def cl_join_core(t):
    return _core(t).select("patent_id", "title", "abstract", "filing_date", "patent_date")


@register
def cl_drop_untitled(t):
    return clean.drop_untitled(t.raw_patent, "patent_title").select("patent_id", "patent_title")


@register
def cl_dedup_patents(t):
    return clean.dedup_patents(clean.drop_untitled(t.raw_repeats), PATENT_ORDER)


@register
def cl_inventor_name(t):
    return (
        clean.inventor_names(t.raw_inventor)
        .groupBy("inventor_id", "name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@register
def cl_inventor_country(t):
    located = clean.inventor_countries(t.raw_inventor, t.raw_location)
    return located.groupBy("inventor_id", "country").agg(F.count(F.lit(1)).alias("n"))


@register
def cl_inventors(t):
    return clean.clean_inventors(t.raw_inventor, t.raw_location, INVENTOR_ORDER)


@register
def cl_assignee_name(t):
    return clean.assignee_names(t.raw_assignee).select("patent_id", "assignee_id", "name")


@register
def cl_assignee_type(t):
    return clean.assignee_types(t.raw_assignee).select("patent_id", "assignee_id", "assignee_type")


@register
def cl_companies(t):
    return clean.clean_companies(t.raw_assignee, ASSIGNEE_ORDER)


@register
def cl_patent_inventor(t):
    return clean.patent_inventor_links(t.raw_inventor)


@register
def cl_patent_company(t):
    return clean.patent_company_links(t.raw_assignee)


@register
def cl_cpc_normalize(t):
    return clean.normalize_sections(t.raw_cpc)


@register
def cl_cpc_label(t):
    return clean.label_sections(t.patent_cpc)


@register
def cl_cpc_sections(t):
    return clean.section_lists(t.patent_cpc)


@register
def cl_patent_cpc_wide(t):
    return clean.widen_sections(t.patent_cpc)


@register
def cl_insert_or_ignore(t):
    """Open orders are in the table; all orders arrive, twice, with another title. In memory, and into a stored table."""
    patents = t.patents().select("patent_id", "title", "patent_type")
    loaded = patents.filter(F.col("patent_type") == "O")
    again = patents.withColumn("title", F.concat(F.lit("again "), "title"))
    batch = patents.withColumn("seq", F.lit(2)).unionByName(again.withColumn("seq", F.lit(1)))
    in_memory = clean.insert_or_ignore(loaded, batch, ["patent_id"], ["seq"])
    folder = shared_folder(t.spark, "append")
    names = store.CLEAN_SCHEMAS["patents"].names
    dated = t.patents("grant", "abstract").withColumn("filing_year", F.col("year"))
    store.write_model({"patents": dated.filter("patent_type = 'O'")}, folder)
    again = dated.withColumn("title", F.concat(F.lit("again "), "title")).withColumn("seq", F.lit(1))
    store.append_new(t.spark, folder, "patents", dated.withColumn("seq", F.lit(2)).unionByName(again), ["seq"])
    stored = store.load_model(t.spark, folder)["patents"].select(names)
    kept = ["patent_id", "title", "patent_type"]
    return in_memory.select(F.lit("memory").alias("target"), *kept).unionByName(
        stored.select(F.lit("stored").alias("target"), *kept)
    )


# ---- views ------------------------------------------------------------------------------------


@register
def vw_patent_full(t):
    full = views.patent_full(t.patents("grant", "abstract"), clean.section_lists(t.patent_cpc))
    return full.select(*PATENT_COLUMNS, "abstract", "cpc_sections")


@register
def vw_patent_relationships(t):
    return views.patent_relationships(t.patent_inventor, t.patent_company)


# ---- analytic queries -------------------------------------------------------------------------


def _pairs(t):
    return Q.country_patents(t.inventor_links, t.inventors)


@register
def q1_top_inventors(t):
    return Q.top_inventors(t.patent_inventor, t.inventors)


@register
def q2_top_companies(t):
    return Q.top_companies(t.patent_company, t.companies)


@register
def q3_top_countries(t):
    return Q.top_countries(_pairs(t))


@register
def q4_patents_per_year(t):
    return Q.patents_per_year(t.patents())


@register
def q5_join_preview(t):
    return Q.join_preview(
        t.patents("grant"), t.inventor_links, t.inventors, t.patent_company, t.companies
    )


@register
def q6_countries_by_decade(t):
    return Q.countries_by_decade(_pairs(t), t.patents())


@register
def q7_inventor_rankings(t):
    return Q.rank_inventors(t.inventor_links, t.inventors)


@register
def e1_cpc_distribution(t):
    return Q.section_distribution(t.patent_cpc)


@register
def e2_cpc_trends(t):
    return Q.section_trends(t.patent_cpc, t.patents())


@register
def e3_top_companies_by_cpc(t):
    return Q.top_companies_by_section(t.patent_cpc, t.patent_company, t.companies)


@register
def e4_top_countries_by_cpc(t):
    return Q.top_countries_by_section(_pairs(t), t.patent_cpc)


@register
def e5_recent_by_cpc(t):
    return Q.recent_by_section(t.patent_cpc, t.patents())


@register
def a1_lag_by_cpc(t):
    return Q.lag_by_section(t.patents("grant"), t.patent_cpc)


@register
def a2_lag_by_country(t):
    return Q.lag_by_country(_pairs(t), t.patents("grant"))


@register
def a3_claims_per_year(t):
    return Q.claims_per_year(t.patents("grant"))


@register
def a4_lag_trend(t):
    return Q.lag_trend(t.patents("grant"))


@register
def a5_claims_by_cpc(t):
    return Q.claims_by_section(t.patents("grant"), t.patent_cpc)


@register
def a6_patents_by_grant_year(t):
    return Q.patents_by_grant_year(t.patents("grant"))


@register
def x1_country_share(t):
    return Q.country_share(_pairs(t), t.patents())


@register
def x2_country_trends(t):
    return Q.country_trends(_pairs(t), t.patents())


@register
def x3_summary(t):
    return Q.summary(t.patents(), t.inventors, t.companies)


@register
def x4_rankings_from_top(t):
    return Q.rank_top_list(q1_top_inventors(t))


# ---- derived tables ---------------------------------------------------------------------------


@register
def d_total_fallback(t):
    return derived.total_patents(q4_patents_per_year(t))


@register
def d_avg_grant_years(t):
    return derived.average_grant_years(a4_lag_trend(t)).select(
        F.round("avg_grant_years", 6).alias("avg_grant_years")
    )


@register
def d_filter_years(t):
    return derived.filter_years(x2_country_trends(t), *YEARS)


@register
def d_filter_countries(t):
    return derived.filter_countries(x2_country_trends(t), COUNTRIES)


@register
def d_filter_options(t):
    return derived.filter_options(x2_country_trends(t), "country")


@register
def d_top10(t):
    return derived.top_for_display(q1_top_inventors(t), ["-patent_count", "inventor_id"])


def _compared(t):
    return derived.filing_vs_grant(q4_patents_per_year(t), a6_patents_by_grant_year(t))


@register
def d_filing_vs_grant(t):
    return _compared(t)


@register
def d_filing_grant_gap(t):
    return derived.filing_grant_gap(_compared(t))


@register
def d_divergence_years(t):
    return derived.divergence_years(_compared(t))


@register
def d_country_trend_selection(t):
    return derived.country_trend_selection(x2_country_trends(t), COUNTRIES, *YEARS)


@register
def d_decade_slice(t):
    return derived.decade_slice(q6_countries_by_decade(t), DECADE)


@register
def d_leaderboard(t):
    return derived.leaderboard(x4_rankings_from_top(t), COUNTRIES)


@register
def d_company_board(t):
    return derived.company_board(q2_top_companies(t))


@register
def d_country_lag_board(t):
    return derived.country_lag_board(a2_lag_by_country(t), [])


@register
def d_section_countries(t):
    return derived.section_slice(
        e4_top_countries_by_cpc(t), SECTION, ["-patent_count", "country"]
    )


@register
def d_section_companies(t):
    return derived.section_slice(
        e3_top_companies_by_cpc(t), SECTION, ["patent_count", "company_name"]
    )


@register
def d_section_recent(t):
    return derived.section_slice(
        e5_recent_by_cpc(t), SECTION, ["-year", "-filing_date", "patent_id"]
    ).select("patent_id", "title", "year", "filing_date")


@register
def d_section_trend_selection(t):
    return derived.section_trend_selection(e2_cpc_trends(t), SECTION_CHOICE, *YEARS)


@register
def d_lag_kpis(t):
    return derived.lag_figures(a4_lag_trend(t))


@register
def d_lag_table_cpc(t):
    return derived.lag_table_sections(a1_lag_by_cpc(t))


@register
def d_claims_band(t):
    banded = derived.filter_years(a3_claims_per_year(t), *YEARS)
    return banded.select("year", "avg_claims", "min_claims", "max_claims")


@register
def d_claims_delta(t):
    return derived.claims_delta(a3_claims_per_year(t), *YEARS)


@register
def d_overview_kpis(t):
    return derived.overview(x3_summary(t), a4_lag_trend(t))


@register
def d_annual_volume(t):
    return derived.filter_years(q4_patents_per_year(t), *YEARS)


@register
def d_country_totals(t):
    return derived.country_totals(q3_top_countries(t), COUNTRIES)


@register
def d_cpc_volume(t):
    return derived.section_volume(e1_cpc_distribution(t))


@register
def d_lag_table_country(t):
    return a2_lag_by_country(t)


@register
def d_claims_table_cpc(t):
    return derived.claims_table_sections(a5_claims_by_cpc(t))


@register
def d_lag_vs_claims(t):
    return derived.lag_against_claims(a1_lag_by_cpc(t), a5_claims_by_cpc(t))


# ---- search -----------------------------------------------------------------------------------


_INDEX_FOLDERS: dict[tuple[str, str], str] = {}


def _stored_index(t) -> search.SearchIndex:
    """The documents' index, built and written once per session and read back for every search."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _INDEX_FOLDERS:
        folder = shared_folder(t.spark, "index")
        index_store.write_index(search.build_index(t.search_docs), folder, buckets=16, slots=SLOTS)
        _INDEX_FOLDERS[key] = folder
    return index_store.read_index(t.spark, _INDEX_FOLDERS[key])


def _stored_titles(t) -> search.TitleIndex:
    folder = shared_folder(t.spark, "titles")
    title_store.write_titles(t.search_patents, folder, buckets=16)
    return title_store.read_titles(t.spark, folder)


def _hits(t, texts, k=200):
    return search.search(_stored_index(t), search.as_queries(t.spark, texts), k)


def _results(t):
    return search.with_facts(_hits(t, SEARCHES), t.search_patents, most=200 * len(SEARCHES))


@register
def s_normalize_query(t):
    """Every conversation turn taken as a query."""
    turns = t.table("conversations")
    clean_text = normalize_query(F.col("text"))
    return turns.select("conv_id", "turn", clean_text.alias("clean")).filter("clean IS NOT NULL")


@register
def s_tokenize(t):
    return search.tokenize(t.search_docs)


@register
def s_stem(t):
    """The stem of every word of the documents."""
    return search.vocabulary(t.search_docs).select("term", stem(F.col("term")).alias("stem"))


@register
def s_index_build(t):
    return search.index_rows(search.build_index(t.search_docs))


@register
def s_index_stored(t):
    """The index as it is read back from its folder."""
    return search.index_rows(_stored_index(t))


@register
def s_match_rank(t):
    return _hits(t, SEARCHES)


@register
def s_match_pruned(t):
    """The same hits, by the bounds of bands."""
    return search.search(_stored_index(t), search.as_queries(t.spark, SEARCHES), prune=True)


@register
def s_boolean(t):
    return _hits(t, OPERATOR_SEARCHES)


@register
def s_fallback_title(t):
    """Searches that can be read, that cannot, and that come twice, in one call."""
    queries = search.as_queries(t.spark, TITLE_SEARCHES)
    return search.search_or_title(_stored_index(t), _stored_titles(t), queries)


@register
def s_title_prefix(t):
    return search.title_prefix(t.patents(), "1-URGENT").select("patent_id", "title")


@register
def s_name_lookup(t):
    """Inventors of one country and companies of one type, both by name prefix."""
    people = search.name_lookup(
        t.inventors, prefix="Supplier#0000", where={"country": COUNTRIES[0]}
    )
    owners = search.name_lookup(
        t.companies, prefix="Customer#00000", where={"assignee_type": "individual"}
    )
    return people.select(F.col("inventor_id").alias("id"), "name").unionByName(
        owners.select(F.col("company_id").alias("id"), "name")
    )


@register
def s_date_type_filter(t):
    found = search.date_type_filter(t.patents(), date(1997, 3, 1), date(1998, 10, 31), "F")
    return found.select("patent_id", "filing_date", "patent_type")


@register
def s_result_kpis(t):
    return search.result_figures(_results(t))


@register
def s_year_histogram(t):
    return search.year_histogram(_results(t))


@register
def s_result_table(t):
    return search.result_table(_results(t))


@register
def s_export(t):
    folder = shared_folder(t.spark, "export")
    queries = search.as_queries(t.spark, EXPORTS)
    results = search.with_facts(_hits(t, EXPORTS), t.search_patents, most=200 * len(EXPORTS))
    search.export_results(results, queries, folder)
    exported = t.spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    year = F.col("year").cast("int").alias("year")
    return exported.csv(folder).select(F.col("query_id").cast("int").alias("query_id"), "file", "patent_id", year)


def index_changes(t) -> DataFrame:
    """Toxic documents go, documents of low quality are revised, conversation turns come in new."""
    docs = t.table("documents")
    labels = t.table("labels")
    as_id = F.col("doc_id").cast("string").alias("patent_id")
    none = F.lit(None).cast("string")
    title = F.substring_index("text", "\n", 1)

    def rows(frame, key, is_delete, title, abstract):
        return frame.select(
            key,
            F.lit(1).cast("bigint").alias("seq"),
            F.lit(is_delete).alias("is_delete"),
            title.alias("title"),
            abstract.alias("abstract"),
        )

    deleted = rows(labels.filter("toxic = 1"), as_id, True, none, none)
    low = labels.filter("quality = 0 AND toxic = 0").select("doc_id")
    revised_text = F.concat(F.lit("Revised text. "), "text")
    revised = rows(docs.join(low, "doc_id", "left_semi"), as_id, False, title, revised_text)
    new_id = F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("patent_id")
    fresh = rows(t.table("conversations"), new_id, False, title, F.col("text"))
    return deleted.unionByName(revised).unionByName(fresh)


def _written_index(t) -> str:
    folder = shared_folder(t.spark, "index")
    index_store.write_index(search.build_index(t.search_docs), folder, buckets=16, slots=SLOTS)
    return folder


@register
def s_index_maintain(t):
    """A stored index after a set of changes."""
    folder = _written_index(t)
    index_store.apply_changes(index_changes(t), folder, 1)
    return search.index_rows(index_store.read_index(t.spark, folder))


@register
def s_index_feed(t):
    """The same changes as a stream, followed by late ones (older seq) and by the same ones again; then merged."""
    folder = shared_folder(t.spark, "feed")
    feed = IndexFeed(_written_index(t))
    now = index_changes(t)
    late = now.withColumns(
        {"seq": F.lit(-1).cast("bigint"), "is_delete": F.lit(False), "title": F.lit("late"), "abstract": F.lit("late")}
    )
    for changes in (now, late, now):
        changes.write.mode("append").parquet(f"{folder}/changes")
        stream = t.spark.readStream.schema(CHANGE_SCHEMA).parquet(f"{folder}/changes")
        feed.start(stream, f"{folder}/checkpoint").awaitTermination()
    merged = feed.compact(t.spark, f"{folder}/merged")
    return search.index_rows(merged.current(t.spark))


# ---- checks -----------------------------------------------------------------------------------


@register
def v_inputs_present(t):
    names = ["orders", "lineitem", "supplier", "customer", "documents", "citations"]
    return checks.inputs_present(t.spark, {n: f"{t.folder}/{n}.parquet" for n in names})


@register
def v_valid_dates(t):
    return checks.valid_dates(clean_model(t)["patents"])


@register
def v_row_counts(t):
    model = t.model()
    return checks.row_counts(model | {"cpc_section_agg": clean.section_lists(model["patent_cpc"])})


@register
def v_year_range(t):
    return checks.year_range(clean_model(t)["patents"])


@register
def v_orphans(t):
    model = clean_model(t)
    return checks.orphans(model | {"cpc_section_agg": clean.section_lists(model["patent_cpc"])})


@register
def v_key_unique(t):
    """The declared keys of the clean model, and the same asked of the raw files. Keys are held in memory, so they are counted
    in tasks of bounded size and the counts stored."""
    model = clean_model(t)
    clean_tables = checks.key_violations(model | {"cpc_section_agg": clean.section_lists(model["patent_cpc"])})
    tables = {
        "raw patents": t.raw_repeats,
        "raw applications": t.raw_application,
        "raw patent_inventor": t.raw_inventor,
        "raw patent_cpc": t.raw_cpc,
    }
    keys = {
        "raw patents": ["patent_id"],
        "raw applications": ["patent_id"],
        "raw patent_inventor": ["patent_id", "inventor_id"],
        "raw patent_cpc": ["patent_id", "cpc_section"],
    }
    n_rows = sum(t.table(name).count() for name in ("lineitem", "orders", "customer", "supplier"))
    with small_tasks(t.spark, n_rows):
        return written(clean_tables.unionByName(checks.key_violations(tables, keys)), "keys")
