"""The star-schema test tables seen as raw files and as the clean model.

Roles: an order is a patent, a supplier an inventor, a customer a company, a nation a country; a section
letter comes from the part size. Keys are text, as in the real data.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grantlens.operators.clean import normalize_sections
from grantlens.schema import UNKNOWN_COUNTRY

SECTION_LETTERS = "ABCDEFGHYZ"  # Z is not a section


class DriverTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._schemas: dict[str, StructType] = {}  # so that a query looks into each file once

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    # ---- clean model --------------------------------------------------------------------------

    def patents(self, *parts: str) -> DataFrame:
        """Patents with the wanted ``parts``: "grant" (grant date, claims, lag) and "abstract".

        Both come from left joins on a unique key, which neither drop nor repeat a patent, so a query
        that does not read their columns can do without them.
        """
        orders = self.table("orders")
        filed = F.col("o_orderdate").cast("date")
        frame = orders.select(
            F.col("o_orderkey").cast("string").alias("patent_id"),
            F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"),
            filed.alias("filing_date"),
            F.year(filed).alias("year"),
            F.col("o_orderstatus").alias("patent_type"),
        )
        if "abstract" in parts:
            frame = frame.join(
                self.table("documents").select(
                    F.col("doc_id").cast("string").alias("patent_id"), F.col("text").alias("abstract")
                ),
                "patent_id",
                "left",
            )
        if "grant" in parts:
            frame = frame.join(self._grants(), "patent_id", "left").withColumns(
                {
                    "patent_year": F.year("patent_date"),
                    "grant_lag_days": F.datediff("patent_date", "filing_date"),
                }
            )
        return frame

    def _grants(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").cast("string").alias("patent_id"))
            .agg(
                F.max("l_shipdate").cast("date").alias("patent_date"),
                F.count(F.lit(1)).alias("num_claims"),
            )
        )

    @cached_property
    def inventors(self) -> DataFrame:
        nations = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        country = F.when(F.col("s_nationkey") == 0, UNKNOWN_COUNTRY).otherwise(F.col("n_name"))
        return self.table("supplier").join(nations, "s_nationkey", "left").select(
            F.col("s_suppkey").cast("string").alias("inventor_id"),
            F.col("s_name").alias("name"),
            country.alias("country"),
        )

    @cached_property
    def companies(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("company_id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "individual")
            .otherwise("organisation")
            .alias("assignee_type"),
        )

    @cached_property
    def inventor_links(self) -> DataFrame:
        """With repeats; enough for questions that count distinct pairs themselves."""
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("patent_id"),
            F.col("l_suppkey").cast("string").alias("inventor_id"),
        )

    @cached_property
    def patent_inventor(self) -> DataFrame:
        """Made distinct as numbers, which hash faster than text."""
        pairs = self.table("lineitem").select("l_orderkey", "l_suppkey").distinct()
        return pairs.select(
            F.col("l_orderkey").cast("string").alias("patent_id"),
            F.col("l_suppkey").cast("string").alias("inventor_id"),
        )

    @cached_property
    def patent_company(self) -> DataFrame:
        """The order key is unique, so the pairs are distinct as they are."""
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("patent_id"),
            F.col("o_custkey").cast("string").alias("company_id"),
        )

    @cached_property
    def section_rows(self) -> DataFrame:
        parts = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.substring(
                F.lit(SECTION_LETTERS), F.lit(1) + F.col("p_size") % 10, F.lit(1)
            ).alias("letter"),
        )
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"
        )
        return lines.join(parts, "l_partkey")

    @cached_property
    def patent_cpc(self) -> DataFrame:
        rows = self.section_rows.select(
            F.col("l_orderkey").cast("string").alias("patent_id"), F.col("letter").alias("cpc_section")
        )
        return normalize_sections(rows)

    def model(self) -> dict[str, DataFrame]:
        return {
            "patents": self.patents("grant", "abstract"),
            "inventors": self.inventors,
            "companies": self.companies,
            "patent_inventor": self.patent_inventor,
            "patent_company": self.patent_company,
            "patent_cpc": self.patent_cpc,
        }

    # ---- raw files, dirty on purpose ----------------------------------------------------------

    @staticmethod
    def _month_first(iso):
        return F.concat_ws(
            "/", F.substring(iso, 6, 2), F.substring(iso, 9, 2), F.substring(iso, 1, 4)
        )

    @cached_property
    def raw_patent(self) -> DataFrame:
        grants = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.max("l_shipdate").cast("date").cast("string").alias("d"),
                F.count(F.lit(1)).alias("n"),
            )
        )
        key, day = F.col("o_orderkey"), F.col("d")
        # concat_ws skips NULLs, and an order without lines has no date to rewrite
        month_first = F.when(day.isNotNull(), self._month_first(day))
        return (
            self.table("orders")
            .join(grants, "o_orderkey", "left")
            .select(
                key.cast("string").alias("patent_id"),
                F.when(key % 97 != 0, F.concat_ws(" ", "o_orderpriority", "o_orderstatus")).alias(
                    "patent_title"
                ),
                F.when(key % 11 == 0, "not-a-date")
                .when(key % 7 == 0, month_first)
                .otherwise(day)
                .alias("patent_date"),
                F.col("o_orderstatus").alias("patent_type"),
                F.when(key % 13 == 0, "abc")
                .when(key % 17 == 0, "-1")
                .otherwise(F.col("n").cast("string"))
                .alias("num_claims"),
            )
        )

    @cached_property
    def raw_application(self) -> DataFrame:
        """Urgent orders appear a second time with another date."""
        key = F.col("o_orderkey")
        iso = F.col("o_orderdate").cast("date").cast("string")
        orders = self.table("orders")
        first = orders.select(
            key.cast("string").alias("patent_id"),
            F.lit(1).alias("seq"),
            F.when(key % 10 == 0, self._month_first(iso))
            .when(key % 10 == 1, "")
            .otherwise(iso)
            .alias("filing_date"),
        )
        again = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
            key.cast("string").alias("patent_id"),
            F.lit(2).alias("seq"),
            F.lit("1900-01-01").alias("filing_date"),
        )
        return first.unionByName(again)

    @cached_property
    def raw_abstract(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("patent_id"),
            F.lit(1).alias("seq"),
            F.col("text").alias("patent_abstract"),
        )

    @cached_property
    def raw_inventor(self) -> DataFrame:
        named = F.col("s_suppkey") % 29 != 0
        people = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"),
            F.when(named, "Supplier").alias("disambig_inventor_name_first"),
            F.when(named, F.expr("substr(s_name, 10)")).alias("disambig_inventor_name_last"),
            F.col("s_nationkey").cast("string").alias("location_id"),
        )
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
        return lines.join(people, "l_suppkey").select(
            F.col("l_orderkey").cast("string").alias("patent_id"),
            F.col("l_suppkey").cast("string").alias("inventor_id"),
            F.col("l_linenumber").alias("seq"),
            "disambig_inventor_name_first",
            "disambig_inventor_name_last",
            "location_id",
        )

    @cached_property
    def raw_assignee(self) -> DataFrame:
        named = F.col("c_custkey") % 31 != 0
        owners = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name")).alias(
                "disambig_assignee_organization"
            ),
            F.when(named, "Cust").alias("disambig_assignee_individual_name_first"),
            F.when(named, F.expr("substr(c_name, 10)")).alias(
                "disambig_assignee_individual_name_last"
            ),
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return orders.join(owners, "o_custkey").select(
            F.col("o_orderkey").cast("string").alias("patent_id"),
            F.col("o_custkey").cast("string").alias("assignee_id"),
            "disambig_assignee_organization",
            "disambig_assignee_individual_name_first",
            "disambig_assignee_individual_name_last",
        )

    @cached_property
    def raw_location(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("string").alias("location_id"),
            F.when(F.col("n_nationkey") != 0, F.col("n_name")).alias("disambig_country"),
        )

    @cached_property
    def raw_cpc(self) -> DataFrame:
        padded = F.concat(F.lit(" "), F.lower("letter"), F.lit("01"))
        return self.section_rows.select(
            F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" ")).alias("patent_id"),
            F.when(F.col("l_linenumber") != 7, padded).alias("cpc_section"),
        )

    @cached_property
    def raw_repeats(self) -> DataFrame:
        """A patent file in which a patent comes once per order line, partly without a title."""
        titled = F.col("l_returnflag") != "R"
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("patent_id"),
            F.col("l_linenumber").alias("seq"),
            F.when(titled, F.concat_ws("-", "l_returnflag", "l_linestatus", "l_partkey")).alias("title"),
        )

    # ---- text ---------------------------------------------------------------------------------

    @cached_property
    def search_docs(self) -> DataFrame:
        """Documents as patents to search: the title is the first line, the abstract the whole text."""
        text = F.col("text")
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("patent_id"),
            F.substring_index(text, "\n", 1).alias("title"),
            text.alias("abstract"),
        )

    @cached_property
    def search_patents(self) -> DataFrame:
        """The searchable documents with the facts of the patent of the same id."""
        facts = self.patents("grant").drop("title")
        return self.search_docs.join(facts, "patent_id", "left")
