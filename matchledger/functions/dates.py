"""Column functions that read dates. Dates are ISO text in the working rows ('' where unknown), and their days are not validated there."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchledger.functions.letters import lowered
from matchledger.functions.text import number
from matchledger.schema import MONTHS

#: The month with which a season that crosses years begins.
FIRST_MONTH = 8
# How the pages write days.
DAY_MONTH = r"(?iu)(\d{1,2})\s*de\s+([a-záéíóúñ]+)(?:\s*de\s+(\d{4}))?"
PLAYED_ON = r"(?iu)se\s+(?:jug[oó]|jugaron|disput[oó]|disputaron)\s+(?:el\s+)?(\d{1,2}\s*de\s+[a-záéíóúñ]+(?:\s*de\s+\d{4})?)"
TEMPLATE = r"(?i)\{\{\s*fecha\s*\|\s*(\d{1,2})\s*\|\s*(\d{1,2})\s*\|\s*(\d{4})\s*\}\}"
#: Where kick-off is told, and where a date without one was filled in.
LOCAL_ZONE, FILLER_ZONE = "America/Argentina/Buenos_Aires", "Europe/Berlin"


def month_number(name: Column) -> Column:
    months = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in MONTHS.items())))
    return F.try_element_at(months, F.translate(lowered(name), "áéíóúüñ", "aeiouun")).cast("int")


def season_date(day: Column, month: Column, first: Column, last: Column, from_month: int | Column = FIRST_MONTH) -> Column:
    """The ISO date of a day and month in a season of one or two years. `last` is null or equal to `first` for one year."""
    year = F.when(last.isNull() | (month >= from_month), first).otherwise(last)
    return F.format_string("%d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))


def iso_date(text: Column, first: Column, last: Column, from_month: int | Column = FIRST_MONTH) -> Column:
    """`D de MONTH [de YYYY]` anywhere in the text; a year that is written wins; '' for an unknown month or no date."""
    part = lambda k: F.regexp_extract(text, DAY_MONTH, k)
    month, day, year = month_number(part(2)), number(part(1)), number(part(3))
    return F.coalesce(F.when(month.isNotNull(), season_date(day, month, F.coalesce(year, first), F.when(year.isNull(), last), from_month)), F.lit(""))


def template_date(raw: Column) -> Column:
    """A date template with its year; '' out of range."""
    # each number is told once
    parts = F.filter(F.array(F.array(*(number(F.regexp_extract(raw, TEMPLATE, k)) for k in (1, 2, 3)))), lambda p: p[1].between(1, 12) & p[0].between(1, 31))
    return F.coalesce(F.get(F.transform(parts, lambda p: F.format_string("%d-%02d-%02d", p[2], p[1], p[0])), 0), F.lit(""))


def played_on(row: Column) -> Column:
    """What a note tells of the day on which the match was played; '' without a note."""
    return F.regexp_extract(row, PLAYED_ON, 1)


def noted_date(row: Column, first: Column, last: Column, from_month: int | Column = FIRST_MONTH) -> Column:
    """What a note says the match was played on; '' without a note. It may be a year later: see not_before()."""
    return iso_date(played_on(row), first, last, from_month)


def played_date(row: Column, scheduled: Column, first: Column, last: Column, from_month: int | Column = FIRST_MONTH) -> Column:
    """What a note says the match was played on; a year later if that is before the schedule; '' without a note."""
    return not_before(noted_date(row, first, last, from_month), scheduled)


def not_before(played: Column, scheduled: Column) -> Column:
    """played, moved on by a year if it is before scheduled ('' is no date)."""
    later = F.concat((number(F.substring(played, 1, 4)) + 1).cast("string"), F.substring(played, 5, 6))
    return F.when((played != "") & (scheduled != "") & (played < scheduled), later).otherwise(played)


def leg_days(title: Column) -> Column:
    """The distinct (day, month) of a title: `D/M`, and each day of `D, D y D de MONTH`."""
    slashes = F.transform(F.regexp_extract_all(title, F.lit(r"\b(\d{1,2}\s*/\s*\d{1,2})\b"), 1), lambda s: F.struct(F.trim(F.substring_index(s, "/", 1)).try_cast("int").alias("day"), F.trim(F.substring_index(s, "/", -1)).try_cast("int").alias("month")))
    spans = F.regexp_extract_all(title, F.lit(r"(?iu)\b(\d{1,2}(?:\s*(?:,|y|al)\s*\d{1,2})*\s*de\s+[a-záéíóúñ]+)"), 1)
    days = lambda s: F.regexp_extract_all(F.regexp_extract(s, r"(?iu)^(.*?)\s*de\s", 1), F.lit(r"\b(\d{1,2})\b"), 1)
    named = F.flatten(F.transform(spans, lambda s: F.transform(days(s), lambda d: F.struct(d.try_cast("int").alias("day"), month_number(F.regexp_extract(s, r"(?iu)de\s+([a-záéíóúñ]+)$", 1)).alias("month")))))
    return F.array_distinct(F.filter(F.concat(slashes, named), lambda x: x["day"].between(1, 31) & x["month"].between(1, 12)))


def two_days(days: Column, first: Column, last: Column, from_month: int | Column = FIRST_MONTH) -> Column:
    """struct<one,two>: the dates of two legs if leg_days() found exactly two days, else ''."""
    of = lambda k: F.when(F.size(days) == 2, season_date(F.get(days, k)["day"], F.get(days, k)["month"], first, last, from_month)).otherwise("")
    return F.struct(of(0).alias("one"), of(1).alias("two"))


def leg_dates(title: Column, first: Column, last: Column, from_month: int | Column = FIRST_MONTH) -> Column:
    """two_days() of a title."""
    return two_days(leg_days(title), first, last, from_month)


def local_date(instant: Column, kickoff_known: Column, zone: str = LOCAL_ZONE, filler: str = FILLER_ZONE) -> Column:
    """The local day of an instant in UTC (text or timestamp without zone); '' if it cannot be read."""
    at = F.try_to_timestamp(instant) if not isinstance(instant, str) else F.try_to_timestamp(F.col(instant))
    moved = F.when(kickoff_known, F.convert_timezone(F.lit("UTC"), F.lit(zone), at.cast("timestamp_ntz"))).otherwise(F.convert_timezone(F.lit("UTC"), F.lit(filler), at.cast("timestamp_ntz")))
    return F.coalesce(moved.cast("date").cast("string"), F.lit(""))


def day_number(iso: Column) -> Column:
    """Days since 1970; null for what is no date."""
    return F.unix_date(iso.try_cast("date"))


def year_of(iso: Column) -> Column:
    return F.substring(iso, 1, 4).try_cast("int")
