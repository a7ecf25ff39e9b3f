"""Date ranges over documents and tables."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.functions.dates import date_literals, date_range, to_moment

# Column-name fragments that mark a date column.
DATE_NAME = re.compile("date|time|日期|时间", re.IGNORECASE)
SAMPLE_ROWS = 100
ACCEPT_RATIO = 0.8

_DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def ranges_of_documents(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per document: key, n_literals, start_date, end_date, status.

    Row-wise: each document is one row, so nothing is shuffled.
    """
    found = docs.select(key, date_literals(F.col(text)).alias("__found"))
    r = date_range(F.col("__found"))
    return found.select(
        key,
        r["n_literals"].alias("n_literals"),
        r["start_date"].alias("start_date"),
        r["end_date"].alias("end_date"),
        _status(r["n_literals"]).alias("status"),
    )


def ranges_of_lines(lines: DataFrame, key: str, text: str = "text") -> DataFrame:
    """As ranges_of_documents, for documents stored as one row per line.

    No literal can span a line, so lines are searched alone; literals are
    deduplicated map-side before the shuffle, which keeps a document with very
    many lines as cheap as its distinct literals.
    """
    found = lines.select(key, F.explode_outer(date_literals(F.col(text))).alias("x")).select(key, "x.*")
    distinct = found.groupBy(key, "literal").agg(F.first("day").alias("day"))
    per_doc = distinct.groupBy(key).agg(
        F.count("literal").cast("int").alias("n_literals"), F.min("day").alias("lo"), F.max("day").alias("hi")
    )
    enough = F.col("n_literals") >= 2
    return per_doc.select(
        key,
        "n_literals",
        F.when(enough, F.col("lo")).alias("start_date"),
        F.when(enough, F.col("hi")).alias("end_date"),
        _status(F.col("n_literals")).alias("status"),
    )


def _status(n_literals: Column) -> Column:
    return F.when(n_literals >= 2, F.lit("ok")).otherwise(F.lit("too few dates"))


def require_range(ranges: DataFrame) -> DataFrame:
    """Fail the query when the one request holds no range, as a request must."""
    checked = F.when(
        F.col("start_date").isNull(), F.raise_error(F.lit("a date range needs two dates")).cast("date")
    ).otherwise(F.col("start_date"))
    return ranges.select(checked.alias("start_date"), "end_date")


def date_column_by_name(df: DataFrame) -> str | None:
    """First column whose name mentions a date or time."""
    return next((c for c in df.columns if DATE_NAME.search(c)), None)


def conversion_ratios(sample: DataFrame) -> DataFrame:
    """One row holding, per candidate column, the share of values that read as dates (A5).

    Numbers are no candidates: every integer would pass as an epoch offset.
    """
    ratios = [
        F.coalesce(F.avg(_as_moment(sample, f).isNotNull().cast("double")), F.lit(0.0)).alias(f.name)
        for f in sample.schema.fields
        if isinstance(f.dataType, (T.StringType, *_DATE_TYPES))
    ]
    return sample.agg(*ratios) if ratios else sample.limit(0).select()


def date_column_by_content(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> str | None:
    """Best-converting column of the first rows, if good enough."""
    row = conversion_ratios(df.limit(sample_rows)).first()
    if not row:
        return None
    ratios = row.asDict()
    best = max(ratios, key=ratios.get)  # the first of equals
    return best if ratios[best] >= ACCEPT_RATIO else None


def find_date_column(df: DataFrame) -> str | None:
    return date_column_by_name(df) or date_column_by_content(df)


@dataclass(frozen=True)
class RangeFilter:
    """Outcome of filter_by_range: the table and the column used, if any."""

    table: DataFrame
    column: str | None


def filter_by_range(
    df: DataFrame, ranges: DataFrame, column: str | None = None, inclusive_day: bool = False
) -> RangeFilter:
    """Rows whose date lies in the one-row range, both ends included.

    The range arrives as two scalar subqueries, so no join is planned and the
    bounds can reach the scan. The end counts as midnight unless
    ``inclusive_day``. A table without a date column passes unchanged.
    """
    column = column or find_date_column(df)
    if column is None:
        return RangeFilter(df, None)
    field = df.schema[column]
    kind = field.dataType
    if not isinstance(kind, _DATE_TYPES):
        # Exploding a one-item array parses each value once; as a plain column
        # the parse would be copied into both comparisons.
        others = [F.col(f"`{c}`") if c != column else F.explode(F.array(_as_moment(df, field))).alias(c) for c in df.columns]
        df, kind = df.select(*others), T.TimestampType()
    # The bounds take the column's type: casting the column instead would
    # keep the comparison out of the scan.
    start = ranges.select("start_date").scalar().cast(kind)
    end = ranges.select("end_date").scalar()
    at = F.col(f"`{column}`")
    upper = at < F.date_add(end, 1).cast(kind) if inclusive_day else at <= end.cast(kind)
    return RangeFilter(df.filter((at >= start) & upper), column)


def _as_moment(df: DataFrame, field: T.StructField) -> Column:
    if isinstance(field.dataType, _DATE_TYPES):
        return df[field.name].cast("timestamp")
    return to_moment(df[field.name].cast("string"))
