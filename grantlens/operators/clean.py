"""From raw files to the clean model.

Text columns come in, typed columns go out. Rows of a file have no order on Spark, so every "first row
wins" rule names the columns that give the order.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.functions import values as V
from grantlens.functions.ranking import first_per_key
from grantlens.schema import MAX_DATE, MIN_DATE, OTHER_SECTION, SECTION_NAMES, UNKNOWN_COUNTRY

# ---- patents ----------------------------------------------------------------------------------


def parse_dates(df: DataFrame, columns: list[str], formats: list[str] = V.DATE_FORMATS) -> DataFrame:
    return df.withColumns({c: V.parse_date(F.col(c), formats) for c in columns})


def clamp_dates(
    df: DataFrame, columns: list[str], low: date = MIN_DATE, high: date = MAX_DATE
) -> DataFrame:
    return df.withColumns({c: V.clamp_date(F.col(c), low, high) for c in columns})


def add_years(df: DataFrame) -> DataFrame:
    """Filing and grant year; ``year`` is the filing year."""
    filed = F.year("filing_date")
    return df.withColumns(
        {"year": filed, "filing_year": filed, "patent_year": F.year("patent_date")}
    )


def add_grant_lag(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "grant_lag_days", V.grant_lag(F.col("filing_date"), F.col("patent_date"))
    )


def iso_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: V.iso_text(F.col(c)) for c in columns})


def clean_claims(df: DataFrame) -> DataFrame:
    return df.withColumn("num_claims", V.claim_count(F.col("num_claims")))


def join_core(
    raw_patent: DataFrame,
    raw_application: DataFrame,
    raw_abstract: DataFrame,
    application_order: list[str],
    abstract_order: list[str],
) -> DataFrame:
    """Patents with filing date and abstract.

    Both right sides are cut to one row per patent first, so nothing fans out and a patent that is
    repeated without end on the right costs one row per task.
    """
    filed = first_per_key(raw_application, ["patent_id"], application_order)
    prose = first_per_key(raw_abstract, ["patent_id"], abstract_order)
    return (
        raw_patent.withColumnRenamed("patent_title", "title")
        .join(filed.select("patent_id", "filing_date"), "patent_id", "left")
        .join(
            prose.select("patent_id", F.col("patent_abstract").alias("abstract")),
            "patent_id",
            "left",
        )
    )


def drop_untitled(patents: DataFrame, title: str = "title") -> DataFrame:
    return patents.dropna(subset=[title])


def dedup_patents(patents: DataFrame, order: list[str]) -> DataFrame:
    return first_per_key(patents, ["patent_id"], order)


def clean_patents(
    raw_patent: DataFrame,
    raw_application: DataFrame,
    raw_abstract: DataFrame,
    patent_order: list[str],
    application_order: list[str],
    abstract_order: list[str],
    low: date = MIN_DATE,
    high: date = MAX_DATE,
) -> DataFrame:
    """The whole patents table. Patents are cut to one titled row each before any join."""
    titled = drop_untitled(raw_patent, "patent_title")
    one_each = dedup_patents(titled, patent_order)
    joined = join_core(one_each, raw_application, raw_abstract, application_order, abstract_order)
    dates = ["filing_date", "patent_date"]
    dated = clamp_dates(parse_dates(joined, dates), dates, low, high)
    return clean_claims(add_grant_lag(add_years(dated))).select(
        "patent_id",
        "title",
        "abstract",
        "filing_date",
        "patent_date",
        "year",
        "filing_year",
        "patent_year",
        "patent_type",
        "num_claims",
        "grant_lag_days",
    )


# ---- inventors and companies ------------------------------------------------------------------


def inventor_names(raw_inventor: DataFrame) -> DataFrame:
    return raw_inventor.withColumn(
        "name",
        V.full_name(
            F.col("disambig_inventor_name_first"), F.col("disambig_inventor_name_last")
        ),
    )


def inventor_countries(inventors: DataFrame, raw_location: DataFrame) -> DataFrame:
    places = raw_location.select("location_id", F.col("disambig_country").alias("country"))
    located = inventors.join(places, "location_id", "left")
    return located.withColumn("country", F.coalesce("country", F.lit(UNKNOWN_COUNTRY)))


def clean_inventors(
    raw_inventor: DataFrame, raw_location: DataFrame, order: list[str]
) -> DataFrame:
    """One row per inventor, the first; an inventor whose first row has no name is dropped.

    Locations are looked up after the cut, for one row per inventor and not for every link.
    """
    firsts = first_per_key(inventor_names(raw_inventor), ["inventor_id"], order)
    named = firsts.filter(F.col("name") != "")
    return inventor_countries(named, raw_location).select("inventor_id", "name", "country")


def assignee_names(raw_assignee: DataFrame) -> DataFrame:
    return raw_assignee.withColumn(
        "name",
        V.assignee_name(
            F.col("disambig_assignee_organization"),
            F.col("disambig_assignee_individual_name_first"),
            F.col("disambig_assignee_individual_name_last"),
        ),
    )


def assignee_types(raw_assignee: DataFrame) -> DataFrame:
    return raw_assignee.withColumn(
        "assignee_type", V.assignee_type(F.col("disambig_assignee_organization"))
    )


def clean_companies(raw_assignee: DataFrame, order: list[str]) -> DataFrame:
    named = assignee_types(assignee_names(raw_assignee))
    return (
        first_per_key(named, ["assignee_id"], order)
        .filter(F.col("name") != "")
        .select(F.col("assignee_id").alias("company_id"), "name", "assignee_type")
    )


# ---- links ------------------------------------------------------------------------------------


def patent_inventor_links(raw_inventor: DataFrame) -> DataFrame:
    return raw_inventor.select("patent_id", "inventor_id").distinct()


def patent_company_links(raw_assignee: DataFrame) -> DataFrame:
    return raw_assignee.select("patent_id", F.col("assignee_id").alias("company_id")).distinct()


def normalize_sections(raw_cpc: DataFrame) -> DataFrame:
    """Distinct (patent, section) pairs.

    The sections of a patent are OR-ed into one number: a fixed-width hash aggregate that combines
    before the shuffle, however often a patent is repeated. The result is left partitioned by
    patent_id, so a join on patent_id needs no further shuffle of this side.
    """
    return (
        raw_cpc.select(
            F.trim("patent_id").alias("patent_id"),
            V.section_bit(V.section_letter(F.col("cpc_section"))).alias("bit"),
        )
        .filter(F.col("patent_id").isNotNull() & F.col("bit").isNotNull())
        .groupBy("patent_id")
        .agg(F.bit_or("bit").alias("bits"))
        .select("patent_id", "bits", F.inline(V.each_section()))
        .filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        .select("patent_id", "cpc_section")
    )


def label_sections(df: DataFrame) -> DataFrame:
    """Readable section names from the nine fixed labels, as an expression and not a join."""
    names = F.create_map(*[F.lit(x) for pair in SECTION_NAMES.items() for x in pair])
    return df.withColumn(
        "cpc_section_name",
        F.coalesce(F.element_at(names, F.col("cpc_section")), F.lit(OTHER_SECTION)),
    )


def section_lists(patent_cpc: DataFrame) -> DataFrame:
    """Per patent, the sorted sections as JSON array text."""
    return (
        patent_cpc.groupBy("patent_id")
        .agg(F.bit_or(V.section_bit(F.col("cpc_section"))).alias("bits"))
        .select("patent_id", V.section_json(F.col("bits")).alias("cpc_sections"))
    )


def widen_sections(patent_cpc: DataFrame) -> DataFrame:
    """Adds the four reserved columns, which are always NULL."""
    reserved = ["cpc_class", "cpc_subclass", "cpc_group", "cpc_type"]
    return patent_cpc.select(
        "patent_id", "cpc_section", *[F.lit(None).cast("string").alias(c) for c in reserved]
    )


# ---- the whole run ----------------------------------------------------------------------------


def clean_model(
    raw: dict[str, DataFrame],
    orders: dict[str, list[str]],
    low: date = MIN_DATE,
    high: date = MAX_DATE,
) -> dict[str, DataFrame]:
    """The clean tables from the raw ones, both by name.

    Rows of a file have no order on Spark, so ``orders`` names for each raw file with one row per key kept
    (patents, applications, abstracts, inventors, assignees) the columns that say which row comes first.
    """
    def order(name):
        return orders.get(name, ["patent_id"])

    inventors, assignees = raw["g_inventor_disambiguated"], raw["g_assignee_disambiguated"]
    model = {
        "patents": clean_patents(
            raw["g_patent"],
            raw["g_application"],
            raw["g_patent_abstract"],
            order("g_patent"),
            order("g_application"),
            order("g_patent_abstract"),
            low,
            high,
        ),
        "inventors": clean_inventors(
            inventors, raw["g_location_disambiguated"], order("g_inventor_disambiguated")
        ),
        "companies": clean_companies(assignees, order("g_assignee_disambiguated")),
        "patent_inventor": patent_inventor_links(inventors),
        "patent_company": patent_company_links(assignees),
    }
    if "g_cpc_current" in raw:
        model["patent_cpc"] = label_sections(normalize_sections(raw["g_cpc_current"]))
    return model


# ---- loading ----------------------------------------------------------------------------------


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The batch rows whose key is not in the target; of equal keys the first in order."""
    return first_per_key(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def insert_or_ignore(
    target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Target plus the batch rows with a new key; of equal new keys the first in order is taken."""
    fresh = new_rows(target, batch, keys, order)
    return target.unionByName(fresh.select(*target.columns))
