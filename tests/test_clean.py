from datetime import date

from grantlens.operators import checks, clean, views

PATENT = "patent_id string, patent_type string, patent_date string, patent_title string, num_claims string, seq int"


def test_patents_end_to_end(spark, rows):
    raw_patent = spark.createDataFrame(
        [
            ("PP1", "plant", "2000-03-01", None, "3", 1),  # untitled rows go first,
            ("PP1", "plant", "2000-03-02", "Rose", "4", 2),  # then the first titled one is kept
            ("PP1", "plant", "2000-03-03", "Later rose", "5", 3),
            ("7", "utility", "1901-01-01", "Old", "x", 1),
            ("8", "utility", "2001-01-01", None, "1", 1),
            ("9", "utility", None, "None", "2", 1),
        ],
        PATENT,
    )
    raw_application = spark.createDataFrame(
        [("PP1", "1999-03-02", 1), ("PP1", "1998-01-01", 2), ("7", "2000-01-01", 1)],
        "patent_id string, filing_date string, seq int",
    )
    raw_abstract = spark.createDataFrame(
        [("PP1", "b red"), ("PP1", "a rose"), ("nobody", "x")],
        "patent_id string, patent_abstract string",
    )
    patents = clean.clean_patents(
        raw_patent, raw_application, raw_abstract, ["seq"], ["seq"], ["patent_abstract"]
    )
    assert rows(patents) == [
        ("7", "Old", None, date(2000, 1, 1), None, 2000, 2000, None, "utility", None, None),
        ("9", "None", None, None, None, None, None, None, "utility", 2, None),
        ("PP1", "Rose", "a rose", date(1999, 3, 2), date(2000, 3, 2), 1999, 1999, 2000, "plant", 4, 366),
    ]
    again = patents.withColumnsRenamed({"title": "patent_title", "abstract": "a"}).selectExpr(
        "patent_id", "patent_type", "CAST(patent_date AS string) AS patent_date", "patent_title",
        "CAST(num_claims AS string) AS num_claims", "1 AS seq",
    )
    filed = patents.selectExpr("patent_id", "CAST(filing_date AS string) AS filing_date", "1 AS seq")
    text = patents.selectExpr("patent_id", "abstract AS patent_abstract")
    twice = clean.clean_patents(again, filed, text, ["seq"], ["seq"], ["patent_abstract"])
    assert rows(twice) == rows(patents)


def test_first_row_of_an_inventor_decides(spark, rows):
    raw_inventor = spark.createDataFrame(
        [
            ("1", "i1", "Ada", "L", "paris", 1),
            ("2", "i1", "A.", "L", "tokyo", 1),
            ("1", "i2", None, None, "paris", 2),  # no name in the first row: dropped
            ("2", "i2", "Bob", "M", "paris", 2),
            ("3", "i3", "Eve", None, None, 1),
            ("4", "i4", "Dan", "N", "nowhere", 1),
            ("5", "i5", "Nam", "O", "windhoek", 1),
        ],
        "patent_id string, inventor_id string, disambig_inventor_name_first string,"
        "disambig_inventor_name_last string, location_id string, seq int",
    )
    raw_location = spark.createDataFrame(
        [("paris", "FR"), ("tokyo", "JP"), ("nowhere", None), ("windhoek", "NA")],
        "location_id string, disambig_country string",
    )
    inventors = clean.clean_inventors(raw_inventor, raw_location, ["patent_id", "seq"])
    assert rows(inventors) == [
        ("i1", "Ada L", "FR"),
        ("i3", "Eve", "Unknown"),
        ("i4", "Dan N", "Unknown"),
        ("i5", "Nam O", "NA"),
    ]
    assert clean.patent_inventor_links(raw_inventor).count() == 7  # dropped inventors keep links


def test_companies(spark, rows):
    raw_assignee = spark.createDataFrame(
        [
            ("1", "c1", "Acme", None, None),
            ("2", "c1", "Acme Corp", None, None),
            ("1", "c2", None, "Ada", "L"),
            ("1", "c3", " ", None, None),
            ("2", "c3", "Named later", None, None),
        ],
        "patent_id string, assignee_id string, disambig_assignee_organization string,"
        "disambig_assignee_individual_name_first string,"
        "disambig_assignee_individual_name_last string",
    )
    assert rows(clean.clean_companies(raw_assignee, ["patent_id"])) == [
        ("c1", "Acme", "organisation"),
        ("c2", "Ada L", "individual"),
    ]


def test_sections(spark, rows):
    raw_cpc = spark.createDataFrame(
        [(" 1 ", "g06"), ("1", " A"), ("1", "G"), ("2", "z"), ("3", ""), (None, "A"), ("4", None)]
        + [("hot", "Y02")] * 50,
        "patent_id string, cpc_section string",
    )
    pairs = clean.normalize_sections(raw_cpc)
    assert rows(pairs) == [("1", "A"), ("1", "G"), ("hot", "Y")]
    assert rows(clean.section_lists(pairs)) == [("1", '["A","G"]'), ("hot", '["Y"]')]
    labels = {r.cpc_section: r.cpc_section_name for r in clean.label_sections(pairs).collect()}
    assert labels == {"A": "Human Necessities", "G": "Physics", "Y": "Emerging Technologies"}
    odd = spark.createDataFrame([("1", "Q"), ("2", None)], "patent_id string, cpc_section string")
    assert {r.cpc_section_name for r in clean.label_sections(odd).collect()} == {"Other"}


def test_insert_or_ignore(spark, rows):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9, 1), ("b", 3, 2), ("b", 2, 1)], "k string, v int, at int")
    assert rows(clean.insert_or_ignore(target, batch, ["k"], ["at"])) == [("a", 1), ("b", 2)]


def test_relationships_keep_patents_without_company(spark, rows):
    people = spark.createDataFrame([("1", "i"), ("1", "j"), ("2", "i")], "patent_id string, inventor_id string")
    owners = spark.createDataFrame([("1", "c"), ("1", "d")], "patent_id string, company_id string")
    found = rows(views.patent_relationships(people, owners))
    assert len(found) == 5 and ("2", "i", None) in found


def test_checks(spark, rows):
    patents = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "patent_id string")
    links = spark.createDataFrame([("1", "i"), ("3", "i"), ("3", "j")], "patent_id string, inventor_id string")
    assert rows(checks.key_violations({"patents": patents})) == [("patents", 1, 1, 1)]
    model = {"patents": patents, "patent_inventor": links}
    assert rows(checks.orphans(model)) == [("patent_inventor", "patent_id", "patents", 2, 1)]
