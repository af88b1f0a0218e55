"""Convenience views over the clean model."""

from pyspark.sql import DataFrame


def patent_full(patents: DataFrame, cpc_section_agg: DataFrame) -> DataFrame:
    return patents.join(cpc_section_agg, "patent_id", "left")


def patent_relationships(patent_inventor: DataFrame, patent_company: DataFrame) -> DataFrame:
    """One row per (inventor link, company link) pair of a patent, by definition; Spark splits hot patents."""
    pairs = patent_inventor.join(patent_company, "patent_id", "left")
    return pairs.select("patent_id", "inventor_id", "company_id")
