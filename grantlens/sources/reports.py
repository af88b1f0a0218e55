"""Report sinks: one CSV per result and one nested JSON document."""

from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlens.functions.ranking import ordering
from grantlens.operators import analytics as Q
from grantlens.operators.clean import label_sections
from grantlens.sources.storage import written_while

Model = dict[str, DataFrame]


@contextmanager
def shared_facts(model: Model):
    """The joins that several reports read, each as a stored table, deleted at the end of the block."""
    with ExitStack() as tables:
        store = lambda frame, name: tables.enter_context(written_while(frame, name))
        found = {"pairs": store(Q.country_patents(model["patent_inventor"], model["inventors"]), "pairs")}
        found["pair_facts"] = store(Q.pair_facts(found["pairs"], model["patents"]), "pair-facts")
        if "patent_cpc" in model:
            found["section_facts"] = store(Q.section_facts(model["patent_cpc"], model["patents"]), "section-facts")
        yield found


def results(
    model: Model, min_lag_patents: int = 500, facts: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Every report by file name; section reports only if the section table is there.

    ``facts`` are those of ``shared_facts``, for a job that runs many of them.
    """
    patents, inventors, companies = model["patents"], model["inventors"], model["companies"]
    people, owners = model["patent_inventor"], model["patent_company"]
    facts = facts or {}
    pairs = facts["pairs"] if facts else Q.country_patents(people, inventors)
    of_pair, of_section = facts.get("pair_facts"), facts.get("section_facts")
    leaders = Q.top_inventors(people, inventors)
    found = {
        "top_inventors": leaders,
        "top_companies": Q.top_companies(owners, companies),
        "top_countries": Q.top_countries(pairs),
        "patents_per_year": Q.patents_per_year(patents),
        "patents_by_grant_year": Q.patents_by_grant_year(patents),
        "patents_join_preview": Q.join_preview(patents, people, inventors, owners, companies),
        "countries_by_decade": Q.countries_by_decade(pairs, patents, facts=of_pair),
        "top_inventor_rankings": Q.rank_top_list(leaders),
        "grant_lag_by_country": Q.lag_by_country(pairs, patents, min_lag_patents, facts=of_pair),
        "claims_per_year": Q.claims_per_year(patents),
        "grant_lag_trend": Q.lag_trend(patents),
        "country_trends": Q.country_trends(pairs, patents, facts=of_pair),
    }
    if "patent_cpc" in model:
        sections = model["patent_cpc"]
        found |= {
            "cpc_section_distribution": Q.section_distribution(sections),
            "cpc_section_trends": Q.section_trends(sections, patents, facts=of_section),
            "top_companies_by_cpc": Q.top_companies_by_section(sections, owners, companies),
            "top_countries_by_cpc": Q.top_countries_by_section(pairs, sections),
            "recent_patents_by_cpc": Q.recent_by_section(sections, patents, facts=of_section),
            "grant_lag_by_cpc": Q.lag_by_section(patents, sections, facts=of_section),
            "claims_by_cpc": Q.claims_by_section(patents, sections, facts=of_section),
        }
    return found


def write_csv(frame: DataFrame, path: str, one_file: bool = True) -> None:
    """With header; ``one_file`` is for results of a bounded size, larger ones stay partitioned."""
    frame = frame.coalesce(1) if one_file else frame
    frame.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_reports(model: Model, folder: str, at_once: int = 4) -> list[str]:
    """Writes every report, a few jobs at a time, so that the short end of one leaves no core idle.

    If one fails the others are still written, and then its error is raised.
    """
    with shared_facts(model) as facts:
        found = results(model, facts=facts)
        with ThreadPoolExecutor(at_once) as pool:
            jobs = [pool.submit(write_csv, f, f"{folder}/{name}") for name, f in found.items()]
        for job in jobs:
            job.result()
    return list(found)


def _entries(frame: DataFrame, order: list[str], columns: dict, limit: int | None = None):
    """The rows of a short result as one ordered array of structs, NULL array never."""
    numbered = frame.withColumn(
        "_at", F.row_number().over(Window.orderBy(*ordering(*order)))
    )
    if limit:
        numbered = numbered.filter(F.col("_at") <= limit)
    entry = F.struct(*[F.col(old).alias(new) for old, new in columns.items()])
    listed = F.array_sort(F.collect_list(F.struct("_at", entry.alias("entry"))))
    return numbered.agg(F.transform(listed, lambda x: x["entry"])).scalar()


def report_document(
    model: Model,
    facts: dict[str, DataFrame] | None = None,
    leaders_listed: int = 10,
    lags_listed: int = 20,
    min_lag_patents: int = 500,
) -> DataFrame:
    """One row, one column ``report``: the summary as JSON text.

    Each list comes from a short result and enters as a one-row subquery. ``leaders_listed`` inventors and companies
    and ``lags_listed`` countries with ``min_lag_patents`` patents are listed.
    """
    patents, inventors, companies = model["patents"], model["inventors"], model["companies"]
    facts = facts or {}
    pairs = facts["pairs"] if facts else Q.country_patents(model["patent_inventor"], inventors)
    of_pair, of_section = facts.get("pair_facts"), facts.get("section_facts")
    leaders = Q.top_inventors(model["patent_inventor"], inventors)
    owners = Q.top_companies(model["patent_company"], companies)
    ranked = ["-patent_count", "inventor_id"]

    def whole(name):  # averages of days are whole numbers in the document
        return F.col(name).cast("bigint")

    lists = {
        "top_inventors": _entries(
            leaders,
            ranked,
            {"name": "name", "patent_count": "patents", "country": "country"},
            limit=leaders_listed,
        ),
        "top_companies": _entries(
            owners,
            ["-patent_count", "company_id"],
            {"name": "name", "patent_count": "patents", "assignee_type": "assignee_type"},
            limit=leaders_listed,
        ),
        "top_countries": _entries(
            Q.country_share(pairs, patents),
            ["-patents", "country"],
            {"country": "country", "patents": "patents", "share": "share"},
        ),
        "patents_per_year": _entries(
            Q.patents_per_year(patents), ["year"], {"year": "year", "patent_count": "patent_count"}
        ),
        "top_inventor_rankings": _entries(
            Q.rank_top_list(leaders),
            ["rank"],
            {"rank": "rank", "name": "name", "country": "country", "patent_count": "patents"},
        ),
        "grant_lag_by_country": _entries(
            Q.lag_by_country(pairs, patents, min_lag_patents, facts=of_pair).withColumn(
                "avg_grant_lag_days", whole("avg_grant_lag_days")
            ),
            ["-patent_count", "country"],
            {c: c for c in ["country", "patent_count", "avg_grant_lag_days", "avg_grant_lag_years"]},
            limit=lags_listed,
        ),
        "claims_per_year": _entries(
            Q.claims_per_year(patents),
            ["year"],
            {c: c for c in ["year", "patent_count", "avg_claims"]},
        ),
    }
    section_keys = ["cpc_section_distribution", "grant_lag_by_cpc", "claims_by_cpc"]
    if "patent_cpc" in model:
        sections = model["patent_cpc"]
        named = {"cpc_section": "cpc_section", "cpc_section_name": "cpc_name"}
        lists["cpc_section_distribution"] = _entries(
            label_sections(Q.section_distribution(sections)),
            ["-patent_count", "cpc_section"],
            named | {"patent_count": "patents", "percentage": "percentage"},
        )
        lists["grant_lag_by_cpc"] = _entries(
            label_sections(Q.lag_by_section(patents, sections, facts=of_section)).withColumn(
                "avg_grant_lag_days", whole("avg_grant_lag_days")
            ),
            ["-avg_grant_lag_days", "cpc_section"],
            named | {c: c for c in ["patent_count", "avg_grant_lag_days", "avg_grant_lag_years"]},
        )
        lists["claims_by_cpc"] = _entries(
            label_sections(Q.claims_by_section(patents, sections, facts=of_section)),
            ["-avg_claims", "cpc_section"],
            named | {c: c for c in ["patent_count", "avg_claims"]},
        )
    else:
        lists |= {key: F.array() for key in section_keys}
    head = Q.summary(patents, inventors, companies).select(
        "total_patents",
        "total_inventors",
        "total_companies",
        F.struct(F.col("year_from").alias("from"), F.col("year_to").alias("to")).alias("year_range"),
        *[column.alias(name) for name, column in lists.items()],
    )
    return head.select(F.to_json(F.struct("*")).alias("report"))


def write_document(model: Model, path: str, **options) -> None:
    with shared_facts(model) as facts:
        report_document(model, facts, **options).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)
