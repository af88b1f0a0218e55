"""Cleaning expressions for single values: dates, numbers, names, sections."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantlens.schema import DAYS_PER_YEAR, MAX_DATE, MIN_DATE, SECTIONS, UNKNOWN_COUNTRY

# Tried in this order; month-first comes before day-first.
DATE_FORMATS = [
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd/MM/yyyy",
    "yyyy/MM/dd",
    "yyyyMMdd",
    "dd-MMM-yyyy",
]


def parse_date(text: Column, formats: list[str] = DATE_FORMATS) -> Column:
    return F.coalesce(*[F.try_to_date(F.trim(text), f) for f in formats])


def clamp_date(day: Column, low: date = MIN_DATE, high: date = MAX_DATE) -> Column:
    """NULL outside [low, high]; both ends are valid."""
    return F.when(day.between(F.lit(low), F.lit(high)), day)


def grant_lag(filed: Column, granted: Column) -> Column:
    """Days from filing to grant; NULL if either is missing, zero and negative lags are kept."""
    return F.datediff(granted, filed)


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def claim_count(text: Column) -> Column:
    """Whole numbers from zero up, written any way a number can be; everything else is NULL."""
    number = F.trim(text).try_cast("double")
    return F.when((number >= 0) & (number == F.floor(number)), number.try_cast("bigint"))


def full_name(first: Column, last: Column) -> Column:
    return F.trim(
        F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    )


def _organisation(text: Column) -> Column:
    """Blank organisations count as missing."""
    return F.when(F.trim(text) != "", text)


def assignee_name(organisation: Column, first: Column, last: Column) -> Column:
    return F.coalesce(_organisation(organisation), full_name(first, last))


def assignee_type(organisation: Column) -> Column:
    return F.when(_organisation(organisation).isNotNull(), "organisation").otherwise("individual")


# Sections as bits of a number, so that a set of sections can be built by a plain hash aggregate.
_LETTERS = "".join(SECTIONS)
_BITS = {letter: 1 << i for i, letter in enumerate(SECTIONS)}


def section_letter(text: Column) -> Column:
    """First letter in upper case, known section or not."""
    return F.substring(F.upper(F.trim(text)), 1, 1)


def section_bit(letter: Column) -> Column:
    """NULL for anything but a known section letter."""
    at = F.instr(F.lit(_LETTERS), letter)
    return F.when((letter != "") & (at > 0), F.call_function("shiftleft", F.lit(1), at - 1))


def each_section() -> Column:
    """To be exploded: every section with its bit."""
    return F.array(
        *[F.struct(F.lit(s).alias("cpc_section"), F.lit(b).alias("bit")) for s, b in _BITS.items()]
    )


def section_json(bits: Column) -> Column:
    """The sorted sections of a bit set as JSON array text."""
    letters = [F.when(bits.bitwiseAND(F.lit(b)) != 0, s) for s, b in _BITS.items()]
    return F.concat(F.lit('["'), F.concat_ws('","', *letters), F.lit('"]'))


def known_country(country: Column) -> Column:
    return country.isNotNull() & ~country.isin(UNKNOWN_COUNTRY, "")


def in_years(year: Column, low: int, high: int) -> Column:
    return year.between(low, high)


def average(value: Column, digits: int = 0) -> Column:
    """Rounded mean, half away from zero, always a double."""
    return F.round(F.avg(value), digits)


def average_years(days: Column) -> Column:
    """Rounds the exact mean, not the already rounded days."""
    return F.round(F.avg(days) / DAYS_PER_YEAR, 2)
