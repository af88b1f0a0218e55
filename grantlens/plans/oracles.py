"""Independent SQL for each registered query, to be run by another engine on the same tables.

Written from the meaning of each question, on purpose in another shape than the Spark code: plain
COUNT(DISTINCT), QUALIFY and correlated text functions instead of staged aggregates.
"""

import re
import string

from grantlens.plans import registry as R
from grantlens.schema import CLEAN_SCHEMAS, SECTION_NAMES

# ---- the test tables as model and raw files ---------------------------------------------------


def _mdy(s):
    return f"(substr({s},6,2) || '/' || substr({s},9,2) || '/' || substr({s},1,4))"


def _iso(c):
    return f"CAST(CAST({c} AS DATE) AS VARCHAR)"


def r(x, digits=0):
    """Half away from zero on the decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


LETTER = "substr('ABCDEFGHYZ', CAST(1 + p_size % 10 AS BIGINT), 1)"
SECTION_CASE = "CASE cpc_section {} ELSE 'Other' END".format(
    " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTION_NAMES.items())
)
FORMATS = "['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%Y/%m/%d', '%Y%m%d', '%d-%b-%Y']"


def _day(c):
    return f"CAST(try_strptime(trim({c}), {FORMATS}) AS DATE)"


def _clamped(c):
    return f"CASE WHEN {_day(c)} BETWEEN DATE '{R.LOW}' AND DATE '{R.HIGH}' THEN {_day(c)} END"


ORG = "CASE WHEN trim(disambig_assignee_organization) <> '' THEN disambig_assignee_organization END"
PERSON = (
    "trim(coalesce(disambig_{0}_name_first,'') || ' ' || coalesce(disambig_{0}_name_last,''))"
)
ASCII_TOKENS = (
    "regexp_extract_all(translate(coalesce({0},''), '%s', '%s'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    % (string.ascii_uppercase, string.ascii_lowercase)
)

CTES = {
    "grants": (
        [],
        """SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS patent_date, count(*) AS num_claims
           FROM lineitem GROUP BY l_orderkey""",
    ),
    "patents": (
        ["grants"],
        """SELECT CAST(o_orderkey AS VARCHAR) AS patent_id,
                  o_orderpriority || ' ' || o_orderstatus AS title, d.text AS abstract,
                  CAST(o_orderdate AS DATE) AS filing_date, g.patent_date,
                  CAST(year(o_orderdate) AS INT) AS year, CAST(year(g.patent_date) AS INT) AS patent_year,
                  o_orderstatus AS patent_type, g.num_claims,
                  CAST(date_diff('day', CAST(o_orderdate AS DATE), g.patent_date) AS INT) AS grant_lag_days
           FROM orders LEFT JOIN grants g ON o_orderkey = g.l_orderkey
           LEFT JOIN documents d ON d.doc_id = o_orderkey""",
    ),
    "inventors": (
        [],
        """SELECT CAST(s_suppkey AS VARCHAR) AS inventor_id, s_name AS name,
                  CASE WHEN s_nationkey = 0 THEN 'Unknown' ELSE n_name END AS country
           FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "companies": (
        [],
        """SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS name,
                  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'individual' ELSE 'organisation' END
                      AS assignee_type
           FROM customer""",
    ),
    "patent_inventor": (
        [],
        """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS patent_id,
                  CAST(l_suppkey AS VARCHAR) AS inventor_id FROM lineitem""",
    ),
    "patent_company": (
        [],
        """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS patent_id,
                  CAST(o_custkey AS VARCHAR) AS company_id FROM orders""",
    ),
    "patent_cpc": (
        [],
        f"""SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS patent_id, {LETTER} AS cpc_section
            FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {LETTER} <> 'Z'""",
    ),
    "section_lists": (
        ["patent_cpc"],
        """SELECT patent_id, '["' || string_agg(cpc_section, '","' ORDER BY cpc_section) || '"]'
                  AS cpc_sections FROM patent_cpc GROUP BY patent_id""",
    ),
    # inventors of a patent with their known countries
    "placed": (
        ["patent_inventor", "inventors"],
        """SELECT patent_id, country FROM patent_inventor JOIN inventors USING (inventor_id)
           WHERE country IS NOT NULL AND country <> '' AND country <> 'Unknown'""",
    ),
    "raw_patent": (
        [],
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS patent_id,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_orderpriority || ' ' || o_orderstatus END
                   AS patent_title,
               CASE WHEN o_orderkey % 11 = 0 THEN 'not-a-date'
                    WHEN o_orderkey % 7 = 0 THEN {_mdy("g.d")} ELSE g.d END AS patent_date,
               o_orderstatus AS patent_type,
               CASE WHEN o_orderkey % 13 = 0 THEN 'abc' WHEN o_orderkey % 17 = 0 THEN '-1'
                    ELSE CAST(g.n AS VARCHAR) END AS num_claims
            FROM orders LEFT JOIN (SELECT l_orderkey, {_iso("max(l_shipdate)")} AS d, count(*) AS n
                                   FROM lineitem GROUP BY l_orderkey) g ON o_orderkey = g.l_orderkey""",
    ),
    "raw_application": (
        [],
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, 1 AS seq,
               CASE WHEN o_orderkey % 10 = 0 THEN {_mdy(_iso("o_orderdate"))}
                    WHEN o_orderkey % 10 = 1 THEN '' ELSE {_iso("o_orderdate")} END AS filing_date
            FROM orders
            UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 2, '1900-01-01' FROM orders
            WHERE o_orderpriority = '1-URGENT'""",
    ),
    "raw_inventor": (
        [],
        """SELECT CAST(l_orderkey AS VARCHAR) AS patent_id, CAST(s_suppkey AS VARCHAR) AS inventor_id,
               l_linenumber AS seq,
               CASE WHEN s_suppkey % 29 <> 0 THEN 'Supplier' END AS disambig_inventor_name_first,
               CASE WHEN s_suppkey % 29 <> 0 THEN substr(s_name, 10) END
                   AS disambig_inventor_name_last,
               CAST(s_nationkey AS VARCHAR) AS location_id
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "raw_assignee": (
        [],
        """SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, CAST(c_custkey AS VARCHAR) AS assignee_id,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS disambig_assignee_organization,
               CASE WHEN c_custkey % 31 <> 0 THEN 'Cust' END
                   AS disambig_assignee_individual_name_first,
               CASE WHEN c_custkey % 31 <> 0 THEN substr(c_name, 10) END
                   AS disambig_assignee_individual_name_last
           FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "raw_location": (
        [],
        """SELECT CAST(n_nationkey AS VARCHAR) AS location_id,
               CASE WHEN n_nationkey <> 0 THEN n_name END AS disambig_country FROM nation""",
    ),
    "raw_cpc": (
        [],
        f"""SELECT ' ' || CAST(l_orderkey AS VARCHAR) || ' ' AS patent_id,
               CASE WHEN l_linenumber <> 7 THEN ' ' || lower({LETTER}) || '01' END AS cpc_section
            FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "raw_repeats": (
        [],
        """SELECT CAST(l_orderkey AS VARCHAR) AS patent_id, l_linenumber AS seq,
               CASE WHEN l_returnflag <> 'R'
                    THEN l_returnflag || '-' || l_linestatus || '-' || l_partkey END AS title
           FROM lineitem""",
    ),
    # cleaned from the raw files
    "core": (
        ["raw_patent", "raw_application"],
        """SELECT p.patent_id, p.patent_title AS title, d.text AS abstract, a.filing_date,
                  p.patent_date, p.patent_type, p.num_claims
           FROM raw_patent p LEFT JOIN raw_application a ON a.patent_id = p.patent_id AND a.seq = 1
           LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = p.patent_id""",
    ),
    "dated": (
        ["core"],
        f"""SELECT patent_id, title, abstract, num_claims, {_clamped("filing_date")} AS filing_date,
                   {_clamped("patent_date")} AS patent_date FROM core""",
    ),
    "c_patents": (
        ["dated"],
        """SELECT *, CAST(year(filing_date) AS INT) AS year FROM dated WHERE title IS NOT NULL""",
    ),
    "c_inventors": (
        ["raw_inventor", "raw_location"],
        f"""SELECT DISTINCT inventor_id, {PERSON.format("inventor")} AS name,
                   coalesce(disambig_country, 'Unknown') AS country
            FROM raw_inventor LEFT JOIN raw_location USING (location_id)
            WHERE {PERSON.format("inventor")} <> ''""",
    ),
    "named_assignees": (
        ["raw_assignee"],
        f"""SELECT patent_id, assignee_id,
                   coalesce({ORG}, {PERSON.format("assignee_individual")}) AS name,
                   CASE WHEN {ORG} IS NULL THEN 'individual' ELSE 'organisation' END AS assignee_type
            FROM raw_assignee""",
    ),
    "c_companies": (
        ["named_assignees"],
        """SELECT DISTINCT assignee_id AS company_id, name, assignee_type
           FROM named_assignees WHERE name <> ''""",
    ),
    "c_patent_inventor": (
        ["raw_inventor"],
        "SELECT patent_id, inventor_id FROM raw_inventor GROUP BY ALL",
    ),
    "c_patent_company": (
        ["raw_assignee"],
        "SELECT patent_id, assignee_id AS company_id FROM raw_assignee GROUP BY ALL",
    ),
    "c_patent_cpc": (
        ["raw_cpc"],
        """SELECT DISTINCT trim(patent_id) AS patent_id, upper(substr(trim(cpc_section), 1, 1))
               AS cpc_section
           FROM raw_cpc WHERE regexp_matches(trim(cpc_section), '^[A-HYa-hy]')""",
    ),
    # text
    "docs": (
        [],
        """SELECT CAST(doc_id AS VARCHAR) AS patent_id, split_part(text, chr(10), 1) AS title,
                  text AS abstract FROM documents""",
    ),
    "words": (
        ["docs"],
        f"""SELECT patent_id, unnest({ASCII_TOKENS.format("title || ' ' || abstract")}) AS term
            FROM docs""",
    ),
    "placed_words": (
        ["docs"],
        f"""SELECT patent_id, field, unnest(found) AS term, generate_subscripts(found, 1) AS i
            FROM (SELECT patent_id, 'title' AS field, {ASCII_TOKENS.format("title")} AS found FROM docs UNION ALL
                  SELECT patent_id, 'abstract', {ASCII_TOKENS.format("abstract")} FROM docs)""",
    ),
    "tf": (["words"], "SELECT patent_id, term, count(*) AS tf FROM words GROUP BY ALL"),
    "doc_len": (
        ["docs"],
        f"""SELECT patent_id, len({ASCII_TOKENS.format("title || ' ' || abstract")}) AS n
            FROM docs""",
    ),
    "changed_docs": (
        ["docs"],
        """SELECT patent_id, title, abstract FROM docs
           WHERE patent_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels
                                   WHERE toxic = 1 OR quality = 0)
           UNION ALL
           SELECT patent_id, title, 'Revised text. ' || abstract FROM docs
           WHERE patent_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels
                               WHERE quality = 0 AND toxic = 0)
           UNION ALL
           SELECT 'c-' || conv_id || '-' || turn, split_part(text, chr(10), 1), text
           FROM conversations""",
    ),
}


def _with(body: str) -> str:
    """Puts the CTEs a statement names, and those they need, in front of it."""
    order: list[str] = []

    def need(name):
        for other in CTES[name][0]:
            need(other)
        if name not in order:
            order.append(name)

    for name in CTES:
        if re.search(rf"\b{name}\b", body):
            need(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


# ---- analytic queries -------------------------------------------------------------------------

LAGS = f"""count(*) AS patent_count, {r("avg(grant_lag_days)")} AS avg_grant_lag_days,
    {r("avg(grant_lag_days) / 365.25", 2)} AS avg_grant_lag_years,
    min(grant_lag_days) AS min_lag_days, max(grant_lag_days) AS max_lag_days"""
PLACED_PATENTS = "(SELECT DISTINCT patent_id, country FROM placed) c"


def _rank(columns):
    return f"CAST(row_number() OVER (ORDER BY {columns}) AS INT) AS rank"


ANALYTIC = {
    "q1_top_inventors": """
        SELECT inventor_id, name, country, patent_count
        FROM (SELECT inventor_id, count(*) AS patent_count FROM patent_inventor GROUP BY ALL
              ORDER BY 2 DESC, 1 LIMIT 20) JOIN inventors USING (inventor_id)""",
    "q2_top_companies": """
        SELECT company_id, name, assignee_type, patent_count
        FROM (SELECT company_id, count(*) AS patent_count FROM patent_company GROUP BY ALL
              ORDER BY 2 DESC, 1 LIMIT 20) JOIN companies USING (company_id)""",
    "q3_top_countries": """
        SELECT country, count(DISTINCT patent_id) AS patent_count FROM placed GROUP BY ALL
        ORDER BY 2 DESC, 1 LIMIT 30""",
    "q4_patents_per_year": """
        SELECT year, count(*) AS patent_count FROM patents WHERE year >= 1976 AND year <= 2025
        GROUP BY ALL""",
    "q5_join_preview": """
        SELECT patent_id, title, year, patent_type, num_claims, grant_lag_days,
          (SELECT string_agg(DISTINCT i.name, ',' ORDER BY i.name) FROM patent_inventor l
           JOIN inventors i USING (inventor_id) WHERE l.patent_id = p.patent_id) AS inventor_names,
          (SELECT string_agg(DISTINCT i.country, ',' ORDER BY i.country) FROM patent_inventor l
           JOIN inventors i USING (inventor_id) WHERE l.patent_id = p.patent_id)
              AS inventor_countries,
          (SELECT string_agg(DISTINCT o.name, ',' ORDER BY o.name) FROM patent_company l
           JOIN companies o USING (company_id) WHERE l.patent_id = p.patent_id) AS company_names
        FROM patents p WHERE year IS NOT NULL ORDER BY year DESC, patent_id LIMIT 100""",
    "q6_countries_by_decade": """
        SELECT CAST(year // 10 * 10 AS INT) AS decade, country,
               count(DISTINCT patent_id) AS patents_per_decade
        FROM placed JOIN patents USING (patent_id) WHERE year BETWEEN 1976 AND 2025
        GROUP BY year // 10, country
        QUALIFY row_number() OVER (PARTITION BY decade ORDER BY patents_per_decade DESC, country) <= 5
        """,
    "q7_inventor_rankings": f"""
        SELECT {_rank("n DESC, inventor_id")}, inventor_id, name, country, n AS patent_count
        FROM (SELECT inventor_id, name, country, count(DISTINCT patent_id) AS n
              FROM patent_inventor JOIN inventors USING (inventor_id) GROUP BY ALL)
        QUALIFY rank <= 20""",
    "e1_cpc_distribution": f"""
        SELECT cpc_section, count(*) AS patent_count,
               {r("count(*) * 100.0 / (SELECT count(*) FROM patent_cpc)::DOUBLE", 2)} AS percentage
        FROM patent_cpc WHERE cpc_section IS NOT NULL GROUP BY cpc_section""",
    "e2_cpc_trends": """
        SELECT year, cpc_section, count(*) AS patent_count
        FROM patent_cpc JOIN patents USING (patent_id) WHERE year BETWEEN 1976 AND 2025
        GROUP BY ALL""",
    "e3_top_companies_by_cpc": """
        SELECT cpc_section, name AS company_name, patent_count
        FROM (SELECT cpc_section, company_id, count(*) AS patent_count
              FROM patent_cpc JOIN patent_company USING (patent_id)
              GROUP BY cpc_section, company_id
              QUALIFY row_number() OVER (PARTITION BY cpc_section
                                         ORDER BY patent_count DESC, company_id) <= 5)
        JOIN companies USING (company_id)""",
    "e4_top_countries_by_cpc": """
        SELECT cpc_section, country, count(DISTINCT patent_id) AS patent_count
        FROM patent_cpc JOIN placed USING (patent_id) GROUP BY cpc_section, country
        QUALIFY row_number() OVER (PARTITION BY cpc_section ORDER BY patent_count DESC, country) <= 5
        """,
    "e5_recent_by_cpc": """
        SELECT cpc_section, patent_id, title, year, filing_date
        FROM patent_cpc JOIN patents USING (patent_id) WHERE year BETWEEN 1976 AND 2025
        QUALIFY row_number() OVER (PARTITION BY cpc_section
            ORDER BY year DESC, filing_date DESC, patent_id) <= 5""",
    "a1_lag_by_cpc": f"""
        SELECT cpc_section, {LAGS} FROM patent_cpc JOIN patents USING (patent_id)
        WHERE grant_lag_days > 0 GROUP BY cpc_section""",
    "a2_lag_by_country": f"""
        SELECT country, {LAGS} FROM {PLACED_PATENTS} JOIN patents USING (patent_id)
        WHERE grant_lag_days > 0 GROUP BY country HAVING count(*) >= 500
        ORDER BY patent_count DESC, country LIMIT 40""",
    "a3_claims_per_year": f"""
        SELECT year, count(*) AS patent_count, {r("avg(num_claims)", 2)} AS avg_claims,
               min(num_claims) AS min_claims, max(num_claims) AS max_claims
        FROM patents WHERE num_claims > 0 AND year BETWEEN 1976 AND 2025 GROUP BY year""",
    "a4_lag_trend": f"""
        SELECT year, count(*) AS patent_count, {r("avg(grant_lag_days)")} AS avg_grant_lag_days,
               {r("avg(grant_lag_days) / 365.25", 2)} AS avg_grant_lag_years
        FROM patents WHERE grant_lag_days > 0 AND year BETWEEN 1976 AND 2025 GROUP BY year""",
    "a5_claims_by_cpc": f"""
        SELECT cpc_section, count(*) AS patent_count, {r("avg(num_claims)", 2)} AS avg_claims,
               max(num_claims) AS max_claims
        FROM patent_cpc JOIN patents USING (patent_id) WHERE num_claims > 0 GROUP BY cpc_section""",
    "a6_patents_by_grant_year": """
        SELECT patent_year AS yr, count(*) AS patent_count FROM patents
        WHERE patent_year BETWEEN 1976 AND 2025 GROUP BY ALL""",
    "x1_country_share": f"""
        SELECT country, count(DISTINCT patent_id) AS patents,
               {r("count(DISTINCT patent_id) / (SELECT count(*) FROM orders)::DOUBLE", 4)} AS share
        FROM placed GROUP BY country ORDER BY patents DESC, country LIMIT 10""",
    "x2_country_trends": """
        SELECT year, country, count(DISTINCT patent_id) AS patents
        FROM placed JOIN patents USING (patent_id) WHERE year BETWEEN 1976 AND 2025 GROUP BY ALL""",
    "x3_summary": """
        SELECT count(*) AS total_patents, min(year) AS year_from, max(year) AS year_to,
               (SELECT count(*) FROM supplier) AS total_inventors,
               (SELECT count(*) FROM customer) AS total_companies
        FROM patents WHERE year IS NOT NULL""",
}
ANALYTIC["x4_rankings_from_top"] = f"""
    SELECT {_rank("patent_count DESC, inventor_id")}, inventor_id, name, country, patent_count
    FROM ({ANALYTIC["q1_top_inventors"]})"""


# ---- derived tables ---------------------------------------------------------------------------


def a(name):
    return f"({ANALYTIC[name]})"


def _list(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


IN_YEARS = "year BETWEEN {} AND {}".format(*R.YEARS)
IN_COUNTRIES = f"country IN {_list(R.COUNTRIES)}"
LABELLED = f"{SECTION_CASE} AS cpc_section_name"
COMPARED = f"""(SELECT coalesce(f.year, g.yr) AS yr, coalesce(f.patent_count, 0) AS filed,
    coalesce(g.patent_count, 0) AS granted
    FROM {a("q4_patents_per_year")} f FULL JOIN {a("a6_patents_by_grant_year")} g ON f.year = g.yr)"""


def _mean_of(order):
    rows = f"SELECT avg_grant_lag_days AS d FROM {a('a4_lag_trend')} ORDER BY year {order} LIMIT 5"
    return f"(SELECT avg(d) FROM ({rows}))"


_OVERALL = f"(SELECT avg(avg_grant_lag_days) FROM {a('a4_lag_trend')})"
DERIVED = {
    "d_total_fallback": f"""
        SELECT CAST(sum(patent_count) AS BIGINT) AS total_patents
        FROM {a("q4_patents_per_year")}""",
    "d_avg_grant_years": f"SELECT {r(_OVERALL + ' / 365.25', 6)} AS avg_grant_years",
    "d_filter_years": f"SELECT * FROM {a('x2_country_trends')} WHERE {IN_YEARS}",
    "d_filter_countries": f"SELECT * FROM {a('x2_country_trends')} WHERE {IN_COUNTRIES}",
    "d_filter_options": """
        SELECT DISTINCT country FROM placed JOIN patents USING (patent_id)
        WHERE year BETWEEN 1976 AND 2025""",
    "d_top10": f"""SELECT * FROM {a("q1_top_inventors")}
        ORDER BY patent_count DESC, inventor_id LIMIT 10""",
    "d_filing_vs_grant": f"SELECT * FROM {COMPARED}",
    "d_filing_grant_gap": f"""
        SELECT *, filed - granted AS gap,
               CASE WHEN filed > 0 THEN {r("granted * 100.0 / filed::DOUBLE", 1)} END AS granted_pct
        FROM {COMPARED}""",
    "d_divergence_years": f"""
        SELECT *, yr = min(yr) OVER () AS is_first FROM {COMPARED}
        WHERE granted > 0 AND granted < filed * 0.9""",
    "d_country_trend_selection": f"""
        SELECT * FROM {a("x2_country_trends")} WHERE {IN_YEARS} AND {IN_COUNTRIES}""",
    "d_decade_slice": f"""
        SELECT * FROM {a("q6_countries_by_decade")} WHERE decade = {R.DECADE}""",
    "d_leaderboard": f"""
        SELECT rank, name, country, patent_count FROM ({ANALYTIC["x4_rankings_from_top"]})
        WHERE {IN_COUNTRIES} ORDER BY rank LIMIT 20""",
    "d_company_board": ANALYTIC["q2_top_companies"],
    "d_country_lag_board": f"""
        SELECT * FROM {a("a2_lag_by_country")} ORDER BY patent_count DESC, country LIMIT 20""",
    "d_section_countries": f"""
        SELECT *, {LABELLED} FROM {a("e4_top_countries_by_cpc")}
        WHERE cpc_section = '{R.SECTION}'""",
    "d_section_companies": f"""
        SELECT *, {LABELLED} FROM {a("e3_top_companies_by_cpc")}
        WHERE cpc_section = '{R.SECTION}'""",
    "d_section_recent": f"""
        SELECT patent_id, title, year, filing_date FROM {a("e5_recent_by_cpc")}
        WHERE cpc_section = '{R.SECTION}'""",
    "d_section_trend_selection": f"""
        SELECT *, {LABELLED} FROM {a("e2_cpc_trends")}
        WHERE {IN_YEARS} AND cpc_section IN {_list(R.SECTION_CHOICE)}""",
    "d_lag_kpis": f"""
        SELECT {r(_OVERALL, 6)} AS overall_days, {r(_OVERALL + " / 365.25", 6)} AS overall_years,
               {r(_mean_of("DESC"), 6)} AS recent_days,
               {r(_mean_of("DESC") + " / 365.25", 6)} AS recent_years,
               {r(_mean_of("ASC"), 6)} AS earliest_days,
               {r(_mean_of("ASC") + " / 365.25", 6)} AS earliest_years""",
    "d_lag_table_cpc": f"SELECT *, {LABELLED} FROM {a('a1_lag_by_cpc')}",
    "d_claims_band": f"""
        SELECT year, avg_claims, min_claims, max_claims FROM {a("a3_claims_per_year")}
        WHERE {IN_YEARS}""",
    "d_claims_delta": f"""
        SELECT lo.year AS first_year, hi.year AS last_year, lo.avg_claims AS first_avg_claims,
               hi.avg_claims AS last_avg_claims, {r("hi.avg_claims - lo.avg_claims", 2)} AS change,
               hi.patent_count AS latest_patents
        FROM {a("a3_claims_per_year")} lo, {a("a3_claims_per_year")} hi
        WHERE lo.year = {R.YEARS[0]} AND hi.year = {R.YEARS[1]}""",
    "d_overview_kpis": f"""
        SELECT *, {r(_OVERALL + " / 365.25", 6)} AS avg_grant_years FROM {a("x3_summary")}""",
    "d_annual_volume": f"SELECT * FROM {a('q4_patents_per_year')} WHERE {IN_YEARS}",
    "d_country_totals": f"""
        SELECT * FROM {a("q3_top_countries")} WHERE {IN_COUNTRIES}
        ORDER BY patent_count DESC, country LIMIT 20""",
    "d_cpc_volume": f"SELECT *, {LABELLED} FROM {a('e1_cpc_distribution')}",
    "d_lag_table_country": ANALYTIC["a2_lag_by_country"],
    "d_claims_table_cpc": f"SELECT *, {LABELLED} FROM {a('a5_claims_by_cpc')}",
    "d_lag_vs_claims": f"""
        SELECT l.*, c.avg_claims, {SECTION_CASE} AS cpc_section_name
        FROM {a("a1_lag_by_cpc")} l JOIN (SELECT cpc_section AS s, avg_claims
            FROM {a("a5_claims_by_cpc")}) c ON l.cpc_section = c.s""",
}

# ---- cleaning and views -----------------------------------------------------------------------

MODEL_COLUMNS = ", ".join(R.PATENT_COLUMNS)
CLEANING = {
    "cl_parse_date": f"SELECT patent_id, {_day('patent_date')} AS patent_date FROM raw_patent",
    "cl_clamp_date": f"SELECT patent_id, {_clamped('patent_date')} AS patent_date FROM raw_patent",
    "cl_year_cols": """
        SELECT patent_id, CAST(year(filing_date) AS INT) AS year,
               CAST(year(filing_date) AS INT) AS filing_year,
               CAST(year(patent_date) AS INT) AS patent_year FROM dated""",
    "cl_grant_lag": """
        SELECT patent_id, CAST(patent_date - filing_date AS INT) AS grant_lag_days FROM dated""",
    "cl_iso_dates": """
        SELECT patent_id, strftime(filing_date, '%Y-%m-%d') AS filing_date,
               strftime(patent_date, '%Y-%m-%d') AS patent_date FROM dated""",
    "cl_num_claims": """
        SELECT patent_id, CASE WHEN regexp_matches(num_claims, '^[0-9]+$')
                               THEN CAST(num_claims AS BIGINT) END AS num_claims
        FROM raw_patent""",
    "cl_join_core": "SELECT patent_id, title, abstract, filing_date, patent_date FROM core",
    "cl_drop_untitled": """
        SELECT patent_id, patent_title FROM raw_patent WHERE patent_title IS NOT NULL""",
    "cl_dedup_patents": """
        SELECT * FROM raw_repeats WHERE title IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY patent_id ORDER BY seq, title) = 1""",
    "cl_inventor_name": f"""
        SELECT inventor_id, {PERSON.format("inventor")} AS name, count(*) AS n
        FROM raw_inventor GROUP BY ALL""",
    "cl_inventor_country": """
        SELECT inventor_id, coalesce(disambig_country, 'Unknown') AS country, count(*) AS n
        FROM raw_inventor LEFT JOIN raw_location USING (location_id) GROUP BY ALL""",
    "cl_inventors": "SELECT * FROM c_inventors",
    "cl_assignee_name": "SELECT patent_id, assignee_id, name FROM named_assignees",
    "cl_assignee_type": "SELECT patent_id, assignee_id, assignee_type FROM named_assignees",
    "cl_companies": "SELECT * FROM c_companies",
    "cl_patent_inventor": "SELECT * FROM c_patent_inventor",
    "cl_patent_company": "SELECT * FROM c_patent_company",
    "cl_cpc_normalize": "SELECT * FROM c_patent_cpc",
    "cl_cpc_label": f"SELECT *, {LABELLED} FROM patent_cpc",
    "cl_cpc_sections": "SELECT * FROM section_lists",
    "cl_patent_cpc_wide": """
        SELECT *, CAST(NULL AS VARCHAR) AS cpc_class, CAST(NULL AS VARCHAR) AS cpc_subclass,
               CAST(NULL AS VARCHAR) AS cpc_group, CAST(NULL AS VARCHAR) AS cpc_type
        FROM patent_cpc""",
    "cl_insert_or_ignore": """
        SELECT unnest(['memory', 'stored']) AS target, patent_id,
               CASE WHEN patent_type = 'O' THEN title ELSE 'again ' || title END AS title, patent_type
        FROM patents""",
    "vw_patent_full": f"""
        SELECT {MODEL_COLUMNS}, abstract, cpc_sections
        FROM patents LEFT JOIN section_lists USING (patent_id)""",
    "vw_patent_relationships": """
        SELECT patent_id, inventor_id, company_id
        FROM patent_inventor LEFT JOIN patent_company USING (patent_id)""",
}

# ---- sources, sinks, checks -------------------------------------------------------------------


def _counts(tables, label="table_name"):
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {label}, (SELECT count(*) FROM {s}) AS n_rows" for n, s in tables.items()
    )


CLEANED = {
    "patents": "c_patents",
    "inventors": "c_inventors",
    "companies": "c_companies",
    "patent_inventor": "c_patent_inventor",
    "patent_company": "c_patent_company",
    "patent_cpc": "c_patent_cpc",
    "cpc_section_agg": "(SELECT DISTINCT patent_id FROM c_patent_cpc)",
}
REPORTS = {
    "top_inventors": "q1_top_inventors",
    "top_companies": "q2_top_companies",
    "top_countries": "q3_top_countries",
    "patents_per_year": "q4_patents_per_year",
    "patents_by_grant_year": "a6_patents_by_grant_year",
    "patents_join_preview": "q5_join_preview",
    "countries_by_decade": "q6_countries_by_decade",
    "top_inventor_rankings": "x4_rankings_from_top",
    "grant_lag_by_country": "a2_lag_by_country",
    "claims_per_year": "a3_claims_per_year",
    "grant_lag_trend": "a4_lag_trend",
    "country_trends": "x2_country_trends",
    "cpc_section_distribution": "e1_cpc_distribution",
    "cpc_section_trends": "e2_cpc_trends",
    "top_companies_by_cpc": "e3_top_companies_by_cpc",
    "top_countries_by_cpc": "e4_top_countries_by_cpc",
    "recent_patents_by_cpc": "e5_recent_by_cpc",
    "grant_lag_by_cpc": "a1_lag_by_cpc",
    "claims_by_cpc": "a5_claims_by_cpc",
}
# key of the document -> (query, order, most entries, {field: expression})
_LAG_FIELDS = {
    "patent_count": "patent_count",
    "avg_grant_lag_days": "CAST(avg_grant_lag_days AS BIGINT)",
    "avg_grant_lag_years": "avg_grant_lag_years",
}
_SECTION_FIELDS = {"cpc_section": "cpc_section", "cpc_name": "cpc_section_name"}
DOCUMENT_LISTS = {
    "top_inventors": (
        "q1_top_inventors",
        "patent_count DESC, inventor_id",
        10,
        {"name": "name", "patents": "patent_count", "country": "country"},
    ),
    "top_companies": (
        "q2_top_companies",
        "patent_count DESC, company_id",
        10,
        {"name": "name", "patents": "patent_count", "assignee_type": "assignee_type"},
    ),
    "top_countries": (
        "x1_country_share",
        "patents DESC, country",
        10,
        {"country": "country", "patents": "patents", "share": "share"},
    ),
    "patents_per_year": (
        "q4_patents_per_year", "year", 50, {"year": "year", "patent_count": "patent_count"}
    ),
    "top_inventor_rankings": (
        "x4_rankings_from_top",
        "rank",
        20,
        {"rank": "rank", "name": "name", "country": "country", "patents": "patent_count"},
    ),
    "cpc_section_distribution": (
        "e1_cpc_distribution",
        "patent_count DESC, cpc_section",
        9,
        _SECTION_FIELDS | {"patents": "patent_count", "percentage": "percentage"},
    ),
    "grant_lag_by_cpc": (
        "a1_lag_by_cpc", "avg_grant_lag_days DESC, cpc_section", 9, _SECTION_FIELDS | _LAG_FIELDS
    ),
    "grant_lag_by_country": (
        "a2_lag_by_country", "patent_count DESC, country", 20, {"country": "country"} | _LAG_FIELDS
    ),
    "claims_per_year": (
        "a3_claims_per_year",
        "year",
        50,
        {c: c for c in ("year", "patent_count", "avg_claims")},
    ),
    "claims_by_cpc": (
        "a5_claims_by_cpc",
        "avg_claims DESC, cpc_section",
        9,
        _SECTION_FIELDS | {"patent_count": "patent_count", "avg_claims": "avg_claims"},
    ),
}


def _document():
    """One row for each field of each entry of the lists, and for each plain value."""
    parts = []
    for key, (query, order, most, fields) in DOCUMENT_LISTS.items():
        source = a(query)
        if "cpc_section_name" in fields.values():
            source = f"(SELECT *, {LABELLED} FROM {source})"
        names = _list(list(fields)).replace("(", "[", 1)[:-1] + "]"
        values = "[" + ", ".join(f"CAST({e} AS VARCHAR)" for e in fields.values()) + "]"
        parts.append(
            f"""SELECT * FROM (SELECT '{key}' AS key, place, unnest({names}) AS field, unnest({values}) AS content
                FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INT) AS place FROM {source})
                WHERE place < {most}) WHERE content IS NOT NULL"""
        )
    facts = {
        "total_patents": "CAST(total_patents AS VARCHAR)",
        "total_inventors": "CAST(total_inventors AS VARCHAR)",
        "total_companies": "CAST(total_companies AS VARCHAR)",
        "year_range": """'{"from":' || year_from || ',"to":' || year_to || '}'""",
    }
    parts += [f"SELECT '{key}', 0, '', (SELECT {text} FROM {a('x3_summary')})" for key, text in facts.items()]
    return " UNION ALL ".join(parts)


def _cells(queries: dict[str, str]) -> str:
    """Every cell as text: (report, row_key of the first two columns, column, value)."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS report, concat_ws('|', j ->> k[1], j ->> k[2]) AS row_key,
                unnest(k) AS "column", unnest(list_transform(k, lambda x: j ->> x)) AS value
            FROM (SELECT to_json(t) AS j, json_keys(to_json(t)) AS k FROM {a(query)} t)"""
        for name, query in queries.items()
    )


_LISTS = """(SELECT patent_id, '["' || string_agg(DISTINCT cpc_section, '","' ORDER BY cpc_section) || '"]'
            AS cpc_sections FROM {} GROUP BY patent_id)"""
CLEANED_ROWS = CLEANED | {
    "patents": """(SELECT c_patents.* EXCLUDE (num_claims), year AS filing_year,
        CAST(year(c_patents.patent_date) AS INT) AS patent_year, raw_patent.patent_type,
        CASE WHEN regexp_matches(raw_patent.num_claims, '^[0-9]+$')
             THEN CAST(raw_patent.num_claims AS BIGINT) END AS num_claims,
        CAST(c_patents.patent_date - filing_date AS INT) AS grant_lag_days
        FROM c_patents JOIN raw_patent USING (patent_id))""",
    "patent_cpc": f"(SELECT *, {LABELLED} FROM c_patent_cpc)",
    "cpc_section_agg": _LISTS.format("c_patent_cpc"),
}
MODEL_ROWS = {n: n for n in CLEANED} | {
    "patents": "(SELECT *, year AS filing_year FROM patents)",
    "patent_cpc": f"(SELECT *, {LABELLED} FROM patent_cpc)",
    "cpc_section_agg": _LISTS.format("patent_cpc"),
}


def _contents(sources: dict[str, str]) -> str:
    parts = []
    for name, source in sources.items():
        shown = lambda c: "md5(abstract) || ':' || strlen(abstract)" if c == "abstract" else f"CAST({c} AS VARCHAR)"
        texts = ", ".join(f"coalesce({shown(c)}, '~')" for c in R.MODEL_TEXT[name])
        parts.append(f"SELECT '{name}' AS table_name, concat_ws('|', {texts}) AS content FROM {source}")
    return " UNION ALL ".join(parts)


def _orphans():
    parts = []
    names = {k: v for k, v in CLEANED.items()}
    for child, column, parent in [
        ("patent_inventor", "patent_id", "patents"),
        ("patent_inventor", "inventor_id", "inventors"),
        ("patent_company", "patent_id", "patents"),
        ("patent_company", "company_id", "companies"),
        ("patent_cpc", "patent_id", "patents"),
        ("cpc_section_agg", "patent_id", "patents"),
    ]:
        parts.append(
            f"""SELECT '{child}' AS child, '{column}' AS key_column, '{parent}' AS parent,
                count(*) AS orphan_links, count(DISTINCT {column}) AS missing_keys
                FROM {names[child]} x WHERE {column} NOT IN (SELECT {column} FROM {names[parent]})"""
        )
    return " UNION ALL ".join(parts)


def _key_violations():
    parts = []
    sections = "(SELECT DISTINCT patent_id FROM c_patent_cpc)"
    for name, (source, columns) in {
        "patents": ("c_patents", "patent_id"),
        "inventors": ("c_inventors", "inventor_id"),
        "companies": ("c_companies", "company_id"),
        "patent_inventor": ("c_patent_inventor", "patent_id, inventor_id"),
        "patent_company": ("c_patent_company", "patent_id, company_id"),
        "patent_cpc": ("c_patent_cpc", "patent_id, cpc_section"),
        "cpc_section_agg": (sections, "patent_id"),
        "raw patents": ("raw_repeats", "patent_id"),
        "raw applications": ("raw_application", "patent_id"),
        "raw patent_inventor": ("raw_inventor", "patent_id, inventor_id"),
        "raw patent_cpc": ("raw_cpc", "patent_id, cpc_section"),
    }.items():
        whole = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
        groups = f"(SELECT {columns}, count(*) AS n FROM {source} WHERE {whole} GROUP BY ALL)"
        parts.append(
            f"""SELECT '{name}' AS table_name,
                (SELECT count(*) FROM {groups} WHERE n > 1) AS repeated_keys,
                (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM {groups}) AS extra_rows,
                (SELECT count(*) FROM {source} WHERE NOT ({whole})) AS null_keys"""
        )
    return " UNION ALL ".join(parts)


_PRESENT = ["orders", "lineitem", "supplier", "customer", "documents"]
INPUTS_AND_CHECKS = {
    "src_raw_tsv": "SELECT patent_id, patent_title, patent_date, patent_type, num_claims FROM raw_patent",
    "src_skip_bad_rows": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS patent_id,
               CASE WHEN l_returnflag <> 'A' THEN {LETTER} END AS cpc_section, count(*) AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY ALL""",
    "src_sample": f"""
        SELECT patent_id, patent_title, assignee_id
        FROM (SELECT * FROM raw_patent ORDER BY patent_id LIMIT {R.SAMPLE})
        JOIN raw_assignee USING (patent_id)""",
    "src_clean_tables": f"""
        SELECT *, unnest(['parquet', 'csv']) AS fmt FROM ({_contents(MODEL_ROWS)})""",
    "snk_clean_tables": _contents(CLEANED_ROWS),
    "snk_report_csv": _cells(REPORTS),
    "snk_report_json": _document(),
    "v_inputs_present": " UNION ALL ".join(
        [
            f"SELECT '{n}' AS input, true AS present, (SELECT count(*) > 0 FROM {n}) AS has_rows"
            for n in _PRESENT
        ]
        + ["SELECT 'citations', false, false"]
    ),
    "v_valid_dates": """
        SELECT count(*) AS patents, count(filing_date) AS valid_filing_dates,
               count(patent_date) AS valid_grant_dates FROM c_patents""",
    "v_row_counts": _counts(
        {n: n for n in CLEAN_SCHEMAS} | {"cpc_section_agg": "(SELECT DISTINCT patent_id FROM patent_cpc)"}
    ),
    "v_year_range": """
        SELECT min(year) AS min_year, max(year) AS max_year, 'integer' AS year_type
        FROM c_patents""",
    "v_orphans": _orphans(),
    "v_key_unique": _key_violations(),
}

# ---- search -----------------------------------------------------------------------------------


def _ranked(queries: dict[int, list[tuple[str, list[str]]]]) -> str:
    """For each query its alternatives: a condition on the words of a document, and the words that score
    where it holds, with repeats."""
    parts = []
    for number, alternatives in queries.items():
        scores = []
        for condition, terms in alternatives:
            gained = " + ".join(f"coalesce(max(gain) FILTER (term = '{t}'), 0)" for t in terms)
            scores.append(f"CASE WHEN {condition} THEN {gained} ELSE 0 END")
        holds = " OR ".join(f"({condition})" for condition, _ in alternatives)
        parts.append(
            f"""SELECT {number} AS query_id, patent_id, round({" + ".join(scores)}, 6) AS score
                FROM gains GROUP BY patent_id HAVING {holds}
                QUALIFY row_number() OVER (ORDER BY score DESC, patent_id) <= 200"""
        )
    conditions = " ".join(c for alternatives in queries.values() for c, _ in alternatives)
    wanted = sorted(set(re.findall(r"'([\w ]+)'", conditions)))
    counted = " UNION ALL ".join(["SELECT * FROM tf", *[_phrase(w) for w in wanted if " " in w]])
    gains = f"""counted AS ({counted}),
    gains AS (
        SELECT patent_id, term,
               greatest(ln((c.n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2
                   / (tf + 1.2 * (0.25 + 0.75 * doc_len.n / c.avg_n)) AS gain
        FROM counted JOIN doc_len USING (patent_id)
        JOIN (SELECT term, count(*) AS df FROM counted GROUP BY term) USING (term),
             (SELECT count(*) AS n, avg(n) AS avg_n FROM doc_len) c
        WHERE term IN {_list(wanted)})"""
    body = " UNION ALL ".join(f"({p})" for p in parts)
    mark = "SELECT * FROM tf, doc_len, placed_words"
    return _with(mark).rsplit("\n" + mark, 1)[0] + f",\n{gains}\n{body}"


def _phrase(term: str) -> str:
    """How often the words of a phrase follow each other in one field."""
    first, *others = term.split(" ")
    joins = "".join(
        f" JOIN placed_words w{n} ON w{n}.patent_id = w.patent_id AND w{n}.field = w.field AND w{n}.i = w.i + {n} AND w{n}.term = '{o}'"
        for n, o in enumerate(others, 1)
    )
    return f"SELECT w.patent_id, '{term}', count(*) FROM placed_words w{joins} WHERE w.term = '{first}' GROUP BY w.patent_id"


def _has(*words):
    return "(" + " AND ".join(f"bool_or(term = '{w}')" for w in words) + ")"


def _plain(texts):
    words = {n: [w.replace("_", " ") for w in re.findall(r"[a-z_]+", q.lower())] for n, q in enumerate(texts)}
    return {n: [(_has(*found), found)] for n, found in words.items()}


MATCH_RANK = _ranked(_plain(R.SEARCHES))
EXPORT_RANK = _ranked(_plain(R.EXPORTS))
BOOLEAN = _ranked(
    {
        0: [(_has("then", "the"), ["then", "the"])],
        1: [(_has("worthless"), ["worthless"]), (_has("que"), ["que"])],
        2: [(f"{_has('the')} AND NOT {_has('then')}", ["the"])],
        3: [(f"{_has('the', 'and')} AND NOT {_has('que', 'la')}", ["the", "and"]), (_has("est"), ["est"])],
        4: [
            (
                f"{_has('then')} AND NOT {_has('the')} AND NOT {_has('que')} AND {_has('est')}",
                ["then", "est"],
            )
        ],
        5: [(_has("que la"), ["que la"])],
        6: [(_has("of the"), ["of the"]), (f"{_has('que la')} AND NOT {_has('est')}", ["que la"])],
        7: [(f"{_has('the of', 'the')} AND NOT {_has('of the of')}", ["the of", "the"])],
        8: [(_has("the and the"), ["the and the"])],
    }
)
_READABLE = {n: words for n, words in _plain(R.TITLE_SEARCHES).items() if R.TITLE_SEARCHES[n] == "worthless then"}


def _search_or_title() -> str:
    titles = " UNION ALL ".join(
        f"""(SELECT {n} AS query_id, patent_id, CAST(NULL AS DOUBLE) AS score, 'title' AS found_by
             FROM docs LEFT JOIN (SELECT patent_id, year FROM patents) p USING (patent_id)
             WHERE contains(lower(docs.title), '{q.lower()}')
             ORDER BY year DESC NULLS LAST, patent_id LIMIT 200)"""
        for n, q in enumerate(R.TITLE_SEARCHES)
        if n not in _READABLE
    )
    mark = "SELECT * FROM patents, docs"
    scan = _with(mark).rsplit("\n" + mark, 1)[0] + "\n" + titles
    return f"SELECT *, 'text' AS found_by FROM ({_ranked(_READABLE)}) UNION ALL SELECT * FROM ({scan})"


def _found(select: str, hits: str = MATCH_RANK) -> str:
    """A statement over ``found``: the hits with their facts."""
    return (
        _with("SELECT * FROM patents, docs")
        .rsplit("\nSELECT * FROM patents, docs", 1)[0]
        + f""", found AS (
            SELECT query_id, score, d.patent_id, d.title, d.abstract, p.* EXCLUDE (patent_id, title, abstract)
            FROM ({hits}) JOIN docs d USING (patent_id)
            LEFT JOIN patents p ON p.patent_id = d.patent_id)
        {select}"""
    )


# The suffix tables and measures as published, written out here on their own.
_CONSONANTS, _VOWELS, _ONE_VOWEL = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*", "[aeiouy]"
_M_OVER_0 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}"
_M_IS_1 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}({_VOWELS})?$"
_M_OVER_1 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}{_VOWELS}{_CONSONANTS}"
_WITH_VOWEL = f"^({_CONSONANTS})?{_ONE_VOWEL}"
_CVC = f"^{_CONSONANTS}{_ONE_VOWEL}[^aeiouwxy]$"
_STEP_2 = dict(
    pair.split(":")
    for pair in (
        "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize"
        " ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log"
    ).split()
)
_STEP_3 = dict(pair.split(":") for pair in "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:".split())
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize ion".split()


def _stemmer() -> str:
    """The suffix steps as a chain of subqueries over the distinct words."""

    def suffix(words):
        return f"regexp_extract(w, '({'|'.join(words)})$', 1)"

    def has(text, pattern):
        return f"regexp_matches({text}, '{pattern}')"

    def step(source, suffix_sql, expression):
        cut = f"SELECT term, w, {suffix_sql} AS s FROM ({source})"
        split = f"SELECT term, w, s, left(w, length(w) - length(s)) AS b FROM ({cut})"
        return f"SELECT term, {expression} AS w FROM ({split})"

    def swap(table):
        cases = " ".join(f"WHEN '{old}' THEN b || '{new}'" for old, new in table.items())
        return f"CASE WHEN s <> '' AND {has('b', _M_OVER_0)} THEN CASE s {cases} END ELSE w END"

    chain = "SELECT DISTINCT term, regexp_replace(term, '^y', 'Y') AS w FROM words"
    chain = step(
        chain,
        "''",
        f"""CASE WHEN {has("w", "(ss|i)es$")} THEN left(w, length(w) - 2)
            WHEN {has("w", "[^s]s$")} THEN left(w, length(w) - 1) ELSE w END""",
    )
    mended = f"""CASE WHEN {has("b", "(at|bl|iz)$")} THEN b || 'e'
        WHEN length(b) > 1 AND right(b, 1) = substr(b, length(b) - 1, 1)
             AND {has("b", "[^aeiouylsz]$")} THEN left(b, length(b) - 1)
        WHEN {has("b", _CVC)} THEN b || 'e' ELSE b END"""
    chain = step(
        chain,
        suffix(["eed", "ed", "ing"]),
        f"""CASE WHEN s = 'eed' AND {has("b", _M_OVER_0)} THEN b || 'ee'
            WHEN s IN ('ed', 'ing') AND {has("b", _WITH_VOWEL)} THEN {mended} ELSE w END""",
    )
    chain = step(
        chain,
        suffix(["y"]),
        f"CASE WHEN s = 'y' AND {has('b', _WITH_VOWEL)} THEN b || 'i' ELSE w END",
    )
    chain = step(chain, suffix(_STEP_2), swap(_STEP_2))
    chain = step(chain, suffix(_STEP_3), swap(_STEP_3))
    chain = step(
        chain,
        suffix(_STEP_4),
        f"""CASE WHEN s <> '' AND {has("b", _M_OVER_1)}
            AND (s <> 'ion' OR {has("b", "[st]$")}) THEN b ELSE w END""",
    )
    chain = step(
        chain,
        suffix(["e"]),
        f"""CASE WHEN s = 'e' AND ({has("b", _M_OVER_1)} OR ({has("b", _M_IS_1)}
            AND NOT {has("b", _CVC)})) THEN b ELSE w END""",
    )
    chain = step(
        chain,
        "''",
        f"""CASE WHEN right(w, 2) = 'll' AND {has("w", _M_OVER_1)}
            THEN left(w, length(w) - 1) ELSE w END""",
    )
    return f"""SELECT term, CASE WHEN strlen(term) >= 3
        THEN regexp_replace(w, '^Y', 'y') ELSE term END AS stem FROM ({chain})"""


def _index_rows(words: str, docs: str) -> str:
    """Postings, terms, documents and corpus of (patent_id, term) words; documents may have none."""
    return f"""SELECT * FROM (
    WITH w AS MATERIALIZED ({words}),
         lengths AS (SELECT patent_id, count(term) AS n FROM {docs} LEFT JOIN w USING (patent_id) GROUP BY patent_id)
    SELECT 'posting' AS kind, term, patent_id, count(*) AS n, CAST(any_value(l.n) AS BIGINT) AS m
    FROM w JOIN lengths l USING (patent_id) GROUP BY term, patent_id
    UNION ALL SELECT 'term', term, NULL, count(DISTINCT patent_id), count(*) FROM w GROUP BY term
    UNION ALL SELECT 'document', NULL, patent_id, 1, CAST(n AS BIGINT) FROM lengths
    UNION ALL SELECT 'corpus', NULL, NULL, count(*), CAST(sum(n) AS BIGINT) FROM lengths)"""


_CHANGED_TOKENS = ASCII_TOKENS.format("title || ' ' || abstract")
INDEX = _index_rows("SELECT patent_id, term FROM words", "docs")
CHANGED_INDEX = _index_rows(f"SELECT patent_id, unnest({_CHANGED_TOKENS}) AS term FROM changed_docs", "changed_docs")
_SLUGS = " ".join(
    f"WHEN {i} THEN 'search_' || left('{q.replace(' ', '_')}', 40)" for i, q in enumerate(R.EXPORTS)
)
SEARCH = {
    "s_normalize_query": r"""
        SELECT conv_id, turn, clean FROM (
            SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS q,
                   regexp_replace(q, '[^\p{L}\p{N}_\s]', ' ', 'g') AS clean FROM conversations)
        WHERE length(q) >= 2 AND trim(clean) <> ''""",
    "s_tokenize": "SELECT * FROM tf",
    "s_stem": _stemmer(),
    "s_index_build": INDEX,
    "s_index_stored": INDEX,
    "s_title_prefix": "SELECT patent_id, title FROM patents WHERE title LIKE '1-URGENT%'",
    "s_name_lookup": f"""
        SELECT inventor_id AS id, name FROM inventors
        WHERE name LIKE 'Supplier#0000%' AND country = '{R.COUNTRIES[0]}'
        UNION ALL SELECT company_id, name FROM companies
        WHERE name LIKE 'Customer#00000%' AND assignee_type = 'individual'""",
    "s_date_type_filter": """
        SELECT patent_id, filing_date, patent_type FROM patents
        WHERE filing_date BETWEEN DATE '1997-03-01' AND DATE '1998-10-31' AND patent_type = 'F'""",
    "s_index_maintain": CHANGED_INDEX,
    "s_index_feed": CHANGED_INDEX,
}
READY = {
    "s_match_rank": MATCH_RANK,
    "s_match_pruned": MATCH_RANK,
    "s_boolean": BOOLEAN,
    "s_result_kpis": _found(f"""
        SELECT query_id, count(*) AS hits, min(year) AS first_year, max(year) AS last_year,
               {r("avg(num_claims)", 4)} AS avg_claims,
               {r("avg(grant_lag_days) / 365.25", 4)} AS avg_lag_years
        FROM found GROUP BY query_id"""),
    "s_year_histogram": _found("""
        SELECT query_id, year, count(*) AS n FROM found WHERE year IS NOT NULL GROUP BY ALL"""),
    "s_result_table": _found("""
        SELECT query_id, patent_id, title, year, patent_type, num_claims, grant_lag_days, filing_date
        FROM found"""),
    "s_fallback_title": _search_or_title(),
    "s_export": _found(
        f"SELECT query_id, CASE query_id {_SLUGS} END AS file, patent_id, year FROM found", EXPORT_RANK
    ),
}

ORACLES = {
    name: _with(sql)
    for group in (ANALYTIC, DERIVED, CLEANING, INPUTS_AND_CHECKS, SEARCH)
    for name, sql in group.items()
} | READY
