"""Date literals: finding, parsing, ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formweave.functions.binding import let

# The digits that count as digits in a literal, and per accepted
# literal form its pattern between digit boundaries, a character it must hold,
# and the order of its groups in ISO form (None: already year, month, day).
WIDE_DIGITS = "０１２３４５６７８９"
ASCII_DIGITS = "0123456789"
_D = "[0-9０-９]"
LITERAL_FORMS = [
    (f"({_D}{{4}})-({_D}{{1,2}})-({_D}{{1,2}})", "-", None),
    (f"({_D}{{4}})/({_D}{{1,2}})/({_D}{{1,2}})", "/", None),
    (f"({_D}{{1,2}})-({_D}{{1,2}})-({_D}{{4}})", "-", "$3-$1-$2"),
    (f"({_D}{{1,2}})/({_D}{{1,2}})/({_D}{{4}})", "/", "$3-$1-$2"),
    (f"({_D}{{4}})年({_D}{{1,2}})月({_D}{{1,2}})日", "年", None),
    (f"({_D}{{1,2}})\\.({_D}{{1,2}})\\.({_D}{{4}})", ".", "$3-$2-$1"),
]
# The first and last whole year of a 64-bit nanosecond clock.
YEARS = ("1678", "2262")
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# Unbroken runs of the characters literals consist of. A literal and the digits
# that could bound it lie in one run; the shortest literal has 8 characters.
_RUN = "[0-9０-９/.年月日-]{8,}"


def _to_date(literal: Column, pattern: str, order: str | None) -> Column:
    """A literal as a date; null for a day that does not exist.

    The literal is brought to y-m-d and cast: a failed format parse costs a
    Java exception per value, a failed cast mostly does not.
    """
    iso = literal if order is None else F.regexp_replace(literal, f"^{pattern}$", order)
    # 日 has no counterpart and is dropped.
    return F.translate(iso, WIDE_DIGITS + "/年月日", ASCII_DIGITS + "---").try_cast("date")


def _literals_of_form(runs: Column, pattern: str, mark: str, order: str | None) -> Column:
    bounded = f"(?<!{_D}){pattern}(?!{_D})"
    found = F.transform(
        F.regexp_extract_all(runs, F.lit(bounded), F.lit(0)),
        lambda s: F.struct(s.alias("literal"), _to_date(s, pattern, order).alias("day")),
    )
    none = F.array().cast("array<struct<literal:string,day:date>>")
    return F.when(runs.contains(mark), found).otherwise(none)


def date_literals(text: Column) -> Column:
    """All date literals of a text: array<struct<literal string, day date>> (F1, F2).

    Six forms, each bounded by non-digits. Literals naming no real day, or
    year 0, are dropped. Every literal is parsed by the form that found it. One
    cheap scan picks the runs that may hold literals; the forms see only those.
    """
    runs = F.array_join(F.regexp_extract_all(text, F.lit(_RUN), F.lit(0)), " ")
    return let(
        runs,
        lambda r: F.filter(
            F.concat(*[_literals_of_form(r, *form) for form in LITERAL_FORMS]),
            lambda x: x["day"] >= F.lit("0001-01-01").cast("date"),
        ),
    )


def parse_date(value: Column) -> Column:
    """The first date literal of a value as a date, or null (F2)."""
    return F.get(date_literals(value), F.lit(0))["day"]


def date_range(literals: Column) -> Column:
    """Range of one document: struct<n_literals, start_date, end_date> (A1, A2).

    Two different literals are needed, even when they name the same day; with
    fewer, both ends are null. ``literals`` comes from date_literals().
    """
    n = F.size(F.array_distinct(F.transform(literals, lambda x: x["literal"])))
    days = F.transform(literals, lambda x: x["day"])
    return F.struct(
        n.alias("n_literals"),
        F.when(n >= 2, F.array_min(days)).alias("start_date"),
        F.when(n >= 2, F.array_max(days)).alias("end_date"),
    )


def iso_date(day: Column) -> Column:
    """YYYY-MM-DD."""
    return F.date_format(day, "yyyy-MM-dd")


def to_moment(value: Column) -> Column:
    """Text to timestamp, value by value; anything unreadable is null.

    ISO text with an optional time, a bare year, eight digits, y/m/d, m/d/y,
    y年m月d日, d.m.y and dates with an English month name, with an optional
    time, are understood. A year has four digits and no leading zero; standing
    alone it must lie in YEARS, so that not every number of four digits is a date.
    """
    s = F.translate(F.trim(value), WIDE_DIGITS, ASCII_DIGITS)
    tail = "((?:[ T].*)?)$"
    ymd = f"^([0-9]{{4}})(?:/|年)([0-9]{{1,2}})(?:/|月)([0-9]{{1,2}})日?{tail}"
    mdy = f"^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){tail}"
    dmy = f"^([0-9]{{1,2}})\\.([0-9]{{1,2}})\\.([0-9]{{4}}){tail}"
    compact = "^([0-9]{4})([0-9]{2})([0-9]{2})$"
    named = f"^([0-9]{{1,2}})[ -]([A-Za-z]{{3,9}})[ -]([0-9]{{4}}){tail}"
    named_us = f"^([A-Za-z]{{3,9}}) ([0-9]{{1,2}}),? ([0-9]{{4}}){tail}"

    def month(pattern: str, group: int) -> Column:
        name = F.lower(F.substring(F.regexp_extract(s, pattern, group), 1, 3))
        # Names start at 1, 4, 7 ...; anything else, and 0, is no month.
        at = F.instr(F.lit(MONTHS), name)
        return F.when(at % 3 == 1, F.floor(at / 3) + 1).otherwise(0).cast("string")

    # The forms exclude each other; the commonest is tried first.
    iso = (
        # A cast alone would read "12:30" as a time of today.
        F.when(s.rlike("^[0-9]{4}(?:-|$)"), s)
        .when(s.rlike(ymd), F.regexp_replace(s, ymd, "$1-$2-$3$4"))
        .when(s.rlike(mdy), F.regexp_replace(s, mdy, "$3-$1-$2$4"))
        .when(s.rlike(dmy), F.regexp_replace(s, dmy, "$3-$2-$1$4"))
        .when(s.rlike(compact), F.regexp_replace(s, compact, "$1-$2-$3"))
        .when(s.rlike(named), F.concat(F.regexp_replace(s, named, "$3-"), month(named, 2), F.regexp_replace(s, named, "-$1$4")))
        .when(
            s.rlike(named_us),
            F.concat(F.regexp_replace(s, named_us, "$3-"), month(named_us, 1), F.regexp_replace(s, named_us, "-$2$4")),
        )
    )
    dated = F.length(s) > 4
    return let(
        iso, lambda text: F.when(~text.startswith("0") & (dated | text.between(*YEARS)), text.try_cast("timestamp"))
    )
