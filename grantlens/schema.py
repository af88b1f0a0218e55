"""Table shapes and fixed values shared by every module."""

from datetime import date

from pyspark.sql import types as T

# The valid date window of the data set and the years it spans.
MIN_DATE = date(1976, 1, 1)
MAX_DATE = date(2025, 9, 30)
MIN_YEAR = 1976
MAX_YEAR = 2025
DAYS_PER_YEAR = 365.25

UNKNOWN_COUNTRY = "Unknown"
OTHER_SECTION = "Other"

# Technology sections and their readable names.
SECTION_NAMES = {
    "A": "Human Necessities",
    "B": "Operations & Transport",
    "C": "Chemistry & Metallurgy",
    "D": "Textiles & Paper",
    "E": "Fixed Constructions",
    "F": "Mechanical Engineering",
    "G": "Physics",
    "H": "Electricity",
    "Y": "Emerging Technologies",
}
SECTIONS = list(SECTION_NAMES)

# Columns taken from each raw tab-separated file. Everything arrives as text; types
# are given by the cleaning operators, because dates and claim counts are not clean.
RAW_COLUMNS = {
    "g_patent": ["patent_id", "patent_title", "patent_date", "patent_type", "num_claims"],
    "g_patent_abstract": ["patent_id", "patent_abstract"],
    "g_application": ["patent_id", "filing_date"],
    "g_inventor_disambiguated": [
        "patent_id",
        "inventor_id",
        "disambig_inventor_name_first",
        "disambig_inventor_name_last",
        "location_id",
    ],
    "g_assignee_disambiguated": [
        "patent_id",
        "assignee_id",
        "disambig_assignee_organization",
        "disambig_assignee_individual_name_first",
        "disambig_assignee_individual_name_last",
    ],
    "g_location_disambiguated": ["location_id", "disambig_country"],
    "g_cpc_current": ["patent_id", "cpc_section"],
}
# Only these hold prose, hence line breaks inside quotes; the others have a record in each line.
RAW_WITH_PROSE = {"g_patent", "g_patent_abstract"}
WITH_PROSE = {"patents"}  # of the clean tables

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()


def _struct(**columns):
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Tables and columns of the clean model.
CLEAN_SCHEMAS = {
    "patents": _struct(
        patent_id=_S,
        title=_S,
        abstract=_S,
        filing_date=_D,
        patent_date=_D,
        year=_I,
        filing_year=_I,
        patent_year=_I,
        patent_type=_S,
        num_claims=_L,
        grant_lag_days=_I,
    ),
    "inventors": _struct(inventor_id=_S, name=_S, country=_S),
    "companies": _struct(company_id=_S, name=_S, assignee_type=_S),
    "patent_inventor": _struct(patent_id=_S, inventor_id=_S),
    "patent_company": _struct(patent_id=_S, company_id=_S),
    "patent_cpc": _struct(patent_id=_S, cpc_section=_S, cpc_section_name=_S),
    "cpc_section_agg": _struct(patent_id=_S, cpc_sections=_S),
}

# Declared keys, used by the quality checks.
KEYS = {
    "patents": ["patent_id"],
    "inventors": ["inventor_id"],
    "companies": ["company_id"],
    "patent_inventor": ["patent_id", "inventor_id"],
    "patent_company": ["patent_id", "company_id"],
    "patent_cpc": ["patent_id", "cpc_section"],
    "cpc_section_agg": ["patent_id"],
}
# (child table, column, parent table)
FOREIGN_KEYS = [
    ("patent_inventor", "patent_id", "patents"),
    ("patent_inventor", "inventor_id", "inventors"),
    ("patent_company", "patent_id", "patents"),
    ("patent_company", "company_id", "companies"),
    ("patent_cpc", "patent_id", "patents"),
    ("cpc_section_agg", "patent_id", "patents"),
]
