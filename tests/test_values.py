from datetime import date

import pytest
from pyspark.sql import functions as F

from grantlens.functions import values as V


def one(spark, expression, *values):
    columns = [F.lit(v).cast("string").alias(f"c{i}") for i, v in enumerate(values)]
    frame = spark.range(1).select(*columns)
    return frame.select(expression(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(
    "text, day",
    [
        ("1999-03-04", date(1999, 3, 4)),
        (" 1999-03-04 ", date(1999, 3, 4)),
        ("03/04/1999", date(1999, 3, 4)),  # month first
        ("25/04/1999", date(1999, 4, 25)),  # can only be day first
        ("1999/03/04", date(1999, 3, 4)),
        ("19990304", date(1999, 3, 4)),
        ("04-Mar-1999", date(1999, 3, 4)),
        ("1999-02-30", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, day):
    assert one(spark, V.parse_date, text) == day


@pytest.mark.parametrize(
    "text, kept",
    [
        ("1976-01-01", True),
        ("2025-09-30", True),
        ("1975-12-31", False),
        ("2025-10-01", False),
        ("1074-06-01", False),
    ],
)
def test_clamp_keeps_both_ends(spark, text, kept):
    found = one(spark, lambda c: V.clamp_date(V.parse_date(c)), text)
    assert found == (date.fromisoformat(text) if kept else None)


@pytest.mark.parametrize(
    "text, number",
    [("12", 12), ("12.0", 12), (" 7 ", 7), ("0", 0), ("1.5", None), ("-1", None), ("abc", None),
     ("", None), (None, None)],
)
def test_claim_count(spark, text, number):
    assert one(spark, V.claim_count, text) == number


@pytest.mark.parametrize(
    "first, last, name",
    [("Ada", "L", "Ada L"), (None, "L", "L"), ("Ada", None, "Ada"), (None, None, ""), (" ", "", "")],
)
def test_full_name(spark, first, last, name):
    assert one(spark, V.full_name, first, last) == name


@pytest.mark.parametrize(
    "organisation, first, last, name, kind",
    [
        ("Acme", "A", "B", "Acme", "organisation"),
        (None, "A", "B", "A B", "individual"),
        ("  ", "A", "B", "A B", "individual"),
        ("", None, None, "", "individual"),
    ],
)
def test_assignee(spark, organisation, first, last, name, kind):
    assert one(spark, V.assignee_name, organisation, first, last) == name
    assert one(spark, V.assignee_type, organisation) == kind


def test_grant_lag_keeps_zero_and_negative(spark):
    def lag(a, b):
        return one(spark, lambda x, y: V.grant_lag(V.parse_date(x), V.parse_date(y)), a, b)

    assert lag("2000-01-01", "2000-01-31") == 30
    assert lag("2000-01-01", "2000-01-01") == 0
    assert lag("2000-02-01", "2000-01-01") == -31
    assert lag(None, "2000-01-01") is None


@pytest.mark.parametrize(
    "letter, bit", [("A", 1), ("H", 128), ("Y", 256), ("Z", None), ("", None), (None, None)]
)
def test_section_bit(spark, letter, bit):
    assert one(spark, V.section_bit, letter) == bit


def test_rounding_is_half_away_from_zero(spark):
    frame = spark.createDataFrame([(2.0,), (3.0,)], "x double")
    assert frame.agg(V.average(F.col("x"))).first()[0] == 3.0
    assert frame.agg(V.average(-F.col("x"))).first()[0] == -3.0
