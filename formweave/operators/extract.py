"""Chunks to template records."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions.binding import let
from formweave.functions.dates import iso_date, parse_date
from formweave.functions.jsontext import parse_object, strip_fence
from formweave.functions.numbers import NUMBER, SCALED_NUMBER, ZERO_REPORTS, is_zero_report, plain_number
from formweave.functions.text import strip, unbold
from formweave.operators.daterange import DATE_NAME
from formweave.operators.template import conform, keep_filled
from formweave.session import materialise

# The regions of China, the two fields they fill and the value.
CHINESE_PROVINCES = [
    "北京市", "天津市", "上海市", "重庆市",
    "河北省", "山西省", "辽宁省", "吉林省", "黑龙江省",
    "江苏省", "浙江省", "安徽省", "福建省", "江西省", "山东省",
    "河南省", "湖北省", "湖南省", "广东省", "海南省",
    "四川省", "贵州省", "云南省", "陕西省", "甘肃省", "青海省", "台湾省",
    "内蒙古自治区", "广西壮族自治区", "西藏自治区", "宁夏回族自治区", "新疆维吾尔自治区",
    "香港特别行政区", "澳门特别行政区",
]
REGION_FIELD = "国家/地区"
CONTINENT_FIELD = "大洲"
CONTINENT = "Asia"

Extractor = Callable[[Column], Column]


def rule_extractor(fields: Sequence[str], kinds: dict[str, str] | None = None) -> Extractor:
    """Rules turning a text column into map<field, value> (X4 default).

    A field's value follows its name: "name: value" or, for numbers, the next
    number in the same clause. Kinds: number, count (a number that a zero report
    sets to 0), date, region, text; unnamed fields are judged by their name.
    """
    kinds = kinds or {}

    def extract(text: Column) -> Column:
        return let(unbold(text), lambda plain: rules(text, plain))

    def rules(text: Column, plain: Column) -> Column:
        pairs = []
        for field in fields:
            kind = kinds.get(field) or _kind_of(field)
            pairs += [F.lit(field), _RULES[kind](field, text, plain)]
        return F.create_map(*pairs)

    return extract


def _kind_of(field: str) -> str:
    if field == REGION_FIELD:
        return "region"
    return "date" if DATE_NAME.search(field) else "any"


def _literal(name: str) -> str:
    """A field name as a pattern; no letter, digit or Han character stands before it."""
    return r"(?<![\p{L}\p{N}_])" + re.sub(r"([^\w])", r"\\\1", name)


def _if_named(field: str, plain: Column, found: Column) -> Column:
    """'' without searching when the text does not name the field."""
    return F.when(plain.contains(field), found).otherwise(F.lit(""))


def _labelled(field: str, plain: Column) -> Column:
    value = F.regexp_extract(plain, rf"{_literal(field)}\s*[:：]\s*([^;；,，。\n]+)", 1)
    return _if_named(field, plain, strip(value))


def _number(field: str, text: Column, plain: Column) -> Column:
    near = rf"{_literal(field)}[^0-9;；,，。\n-]*({SCALED_NUMBER})"
    return _if_named(field, plain, plain_number(F.regexp_extract(plain, near, 1)))


def _count(field: str, text: Column, plain: Column) -> Column:
    return let(
        _number(field, text, plain),
        lambda n: F.when((n == "") & is_zero_report(plain), F.lit("0")).otherwise(n),
    )


def _date(field: str, text: Column, plain: Column) -> Column:
    """The first date after the field's name, else the first of the text."""
    after = F.regexp_extract(plain, rf"(?s){_literal(field)}(.*)", 1)
    named = F.when(plain.contains(field), parse_date(after))
    return F.coalesce(iso_date(F.coalesce(named, parse_date(plain))), F.lit(""))


def _region(field: str, text: Column, plain: Column) -> Column:
    """A listed region, else the labelled value, else the first bold text."""
    may_list = plain.contains("省") | plain.contains("市") | plain.contains("区")
    listed = F.regexp_extract(plain, "|".join(CHINESE_PROVINCES), 0)
    bold = F.regexp_extract(text, r"\*\*(.+?)\*\*", 1)
    found = F.when(may_list, listed)
    return let(
        found,
        lambda x: F.when(x != "", x).otherwise(
            let(_labelled(field, plain), lambda y: F.when(y != "", y).otherwise(bold))
        ),
    )


def _text(field: str, text: Column, plain: Column) -> Column:
    return _labelled(field, plain)


def _any(field: str, text: Column, plain: Column) -> Column:
    """A labelled value; with a leading number it is read as that number.

    Digits after a leading zero are a code, and stay as written.
    """
    # Thousands commas would end a labelled text, so numbers are tried first.
    numeric = F.regexp_extract(
        plain, rf"{_literal(field)}\s*[:：]?\s*((?:约|近|逾|超过)?\s*(?!0[0-9]){NUMBER}\s*(?:万亿|亿|万)?)(?![0-9-])", 1
    )
    value = let(numeric, lambda n: F.when(n != "", plain_number(n)).otherwise(_labelled(field, plain)))
    return _if_named(field, plain, value)


_RULES = {
    "number": _number,
    "count": _count,
    "date": _date,
    "region": _region,
    "text": _text,
    "any": _any,
}


def instruction(fields: Sequence[str], text: Column) -> Column:
    """The request a model-backed extractor would send."""
    names = "\n".join(f"- {f}" for f in fields)
    head = (
        "Read the text and give one flat JSON object with exactly these keys:\n"
        f"{names}\n"
        "One main subject only; an unknown value is an empty string.\n"
        "Numbers: digits only, no unit, no thousands comma, 万 and 亿 multiplied out.\n"
        f"The words {', '.join(ZERO_REPORTS)} make a count 0.\n"
        f"{REGION_FIELD}: the region's name without bold marks. "
        f"{CONTINENT_FIELD}: {CONTINENT} for a region of China.\n"
        "Text:\n"
    )
    return F.concat(F.lit(head), text)


def from_replies(reply: Column) -> Column:
    """Model replies to maps; anything but one JSON object is null."""
    return parse_object(strip_fence(reply))


def extract_records(
    chunks: DataFrame,
    fields: Sequence[str],
    extractor: Extractor | None = None,
    text: str = "text",
) -> DataFrame:
    """Records of the template's fields, one per useful chunk.

    Chunks without text, rejected replies and records with no filled field are
    dropped; a blank continent of a Chinese region is filled in. The extractor
    is any function from a text column to map<string,string>; wrap a model in a
    pandas_udf to inject it.
    """
    found = (extractor or rule_extractor(fields))(F.col(text))
    rest = [c for c in chunks.columns if c != text]
    # Exploding a one-item array computes the record once: as a plain column
    # the optimizer would copy the extractor into every field and filter.
    records = chunks.filter(F.col(text).isNotNull()).select(*rest, F.explode(F.array(found)).alias("record"))
    records = conform(records.filter(F.col("record").isNotNull()), fields)
    if REGION_FIELD in fields and CONTINENT_FIELD in fields:
        records = default_from_list(
            records, REGION_FIELD, CONTINENT_FIELD, CHINESE_PROVINCES, CONTINENT
        )
    return keep_filled(records, fields)


def default_from_list(
    df: DataFrame, key: str, target: str, members: Sequence[str], value: str
) -> DataFrame:
    """Set a blank ``target`` when ``key`` is a member of a fixed list."""
    hit = strip(F.col(f"`{key}`")).isin(list(members))
    return df.withColumn(target, _blank_or(df, target, hit, value))


def default_from_table(
    df: DataFrame, key: str, target: str, members: DataFrame, value: str
) -> DataFrame:
    """As default_from_list with the members in a table's ``key`` column.

    The members are written first: knowing their size, Spark broadcasts them
    when small and need not gather the rows of a frequent key.
    """
    known = materialise(members.select(F.col(key).alias("__key")).distinct())
    joined = df.join(known, strip(df[f"`{key}`"]) == known["__key"], "left")
    filled = joined.withColumn(target, _blank_or(joined, target, F.col("__key").isNotNull(), value))
    return filled.drop("__key")


def _blank_or(df: DataFrame, target: str, hit: Column, value: str) -> Column:
    blank = F.coalesce(F.col(f"`{target}`"), F.lit("")) == ""
    return F.when(hit & blank, F.lit(value)).otherwise(F.col(f"`{target}`"))
