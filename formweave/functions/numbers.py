"""Numbers and amounts written in prose."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from formweave.functions.binding import let

# Scale words, zero-report phrases and currency words.
SCALES = {"万亿": 10**12, "亿": 10**8, "万": 10**4}
ZERO_REPORTS = ["全零报告", "无新增", "零新增"]
CURRENCY = "元|人民币|美元"

NUMBER = r"-?[0-9][0-9,]*(?:\.[0-9]+)?"
SCALED_NUMBER = rf"({NUMBER})\s*(万亿|亿|万)?"


def shift_point(digits: Column, places: Column) -> Column:
    """Plain digits with their point moved right by ``places`` (left if negative).

    The number stays text: no size or precision is lost. Leading zeros and
    trailing decimals that are zero fall away.
    """
    sign = F.regexp_extract(digits, "^-", 0)
    whole = F.regexp_extract(digits, r"^-?([0-9]*)", 1)
    rest = F.regexp_extract(digits, r"\.([0-9]*)$", 1)

    def shifted(parts: Column) -> Column:
        every, at = parts["every"], parts["at"]
        zeros = F.repeat(F.lit("0"), F.greatest(-at, F.lit(0)))
        filled = F.concat(zeros, every, F.repeat(F.lit("0"), F.greatest(at - F.length(every), F.lit(0))))
        cut = F.greatest(at, F.lit(0))
        before = F.regexp_replace(F.substring(filled, F.lit(1), cut), "^0+", "")
        after = F.rtrim(F.substring(filled, cut + 1, F.length(filled)), F.lit("0"))
        number = F.concat(
            F.when(before == "", F.lit("0")).otherwise(before),
            F.when(after == "", F.lit("")).otherwise(F.concat(F.lit("."), after)),
        )
        return F.when(number == "0", number).otherwise(F.concat(sign, number))

    return let(F.struct(F.concat(whole, rest).alias("every"), (F.length(whole) + places).cast("int").alias("at")), shifted)


def _digits(number: Column) -> Column:
    """A matched SCALED_NUMBER as plain digits; '' for ''."""
    value = F.translate(F.regexp_extract(number, NUMBER, 0), ",", "")
    places = F.create_map(*[F.lit(x) for w, n in {**SCALES, "": 1}.items() for x in (w, len(str(n)) - 1)])
    scale = F.element_at(places, F.regexp_extract(number, "(万亿|亿|万)$", 1))
    return F.when(value == "", F.lit("")).otherwise(shift_point(value, scale))


def is_zero_report(text: Column) -> Column:
    return reduce(or_, [text.contains(words) for words in ZERO_REPORTS])


def plain_number(text: Column) -> Column:
    """The first number of a text as plain digits, or '' (F16, F17).

    Units, thousands commas and words such as 约 fall away; scale words
    multiply; a zero report is '0'.
    """
    number = let(F.regexp_extract(text, SCALED_NUMBER, 0), _digits)
    return F.when(is_zero_report(text), F.lit("0")).otherwise(number)


_AMOUNT = rf"{NUMBER}\s*(?:万亿|亿|万)?\s*(?:{CURRENCY})"


def amounts(text: Column) -> Column:
    """All amounts of money as written."""
    return F.regexp_extract_all(text, F.lit(_AMOUNT), F.lit(0))


def amount(text: Column) -> Column:
    """The first amount of money in the basic unit, or '' (F26)."""
    return let(F.regexp_extract(text, f"({SCALED_NUMBER})\\s*(?:{CURRENCY})", 1), _digits)
