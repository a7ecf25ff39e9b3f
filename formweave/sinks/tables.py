"""Sinks (K1-K11). Every writer is a plain Spark write; none gathers rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions.dates import iso_date
from formweave.functions.text import stem, with_suffix
from formweave.operators.positions import global_position
from formweave.operators.status import DONE
from formweave.operators.template import fill_many, overlay


def write_ranges(ranges: DataFrame, path: str, key: str, per_document: bool = False) -> None:
    """Date ranges as JSON, one object per document that has one (K1).

    ``per_document`` makes a folder per document; leave it off for many
    documents, where it would mean as many files.
    """
    good = ranges.filter(F.col("start_date").isNotNull()).select(
        key, iso_date(F.col("start_date")).alias("start_date"), iso_date(F.col("end_date")).alias("end_date")
    )
    writer = good.write.mode("overwrite")
    (writer.partitionBy(key) if per_document else writer).json(path)


def write_records(
    records: DataFrame, path: str, single_file: bool = False, by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Records as JSON lines, nulls written out.

    ``by`` keeps inputs apart, e.g. by source file. ``single_file`` sends all
    rows through one task: for small results only.
    """
    out = records.coalesce(1) if single_file else records
    out.write.mode(mode).option("ignoreNullFields", "false").partitionBy(*by).json(path)


def indexed_records(records: DataFrame, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Records keyed by their 0-based row number, one {"n": {...}} per row (K2, orient index).

    The single object of the whole table would have to meet in one task.
    """
    placed = global_position(records, order, name="__n", start=0)
    body = F.to_json(F.struct(*[F.col(f"`{f}`") for f in fields]), {"ignoreNullFields": "false"})
    return placed.select(
        F.col("__n").alias("row_no"),
        F.concat(F.lit('{"'), F.col("__n").cast("string"), F.lit('": '), body, F.lit("}")).alias("record"),
    )


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)


def write_slices(slices: DataFrame, path: str) -> None:
    """Nested slice documents as JSON, with the name of their output file (K4)."""
    named = slices.withColumn("output", F.concat(stem(F.col("source")), F.lit("_Sliced.json")))
    named.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = ()) -> None:
    """Filtered, projected or filled tables, sheets kept apart by ``by`` (K5, K6, K9)."""
    writer = df.write.mode("overwrite").partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def output_name(path: Column, ending: str) -> Column:
    """Base name plus a fixed ending, as filtered and extracted copies are named (K5-K7)."""
    return F.concat(stem(path), F.lit(ending))


def write_markdown(converted: DataFrame, path: str, append: bool = False) -> None:
    """Converted Markdown texts keyed by output path (K8).

    ``converted``: source, key, markdown, status. Keys keep the source's
    suffix, so a.docx and a.txt do not collide. To keep outputs that exist,
    pass their keys to the conversion and append here.
    """
    done = converted.filter(F.col("status") == DONE).select("source", "key", "markdown")
    done.write.mode("append" if append else "overwrite").parquet(path)


def markdown_key(relative: Column, keep_suffix: bool = True) -> Column:
    """Where a document's Markdown goes, relative to the output folder."""
    return F.concat(relative, F.lit(".md")) if keep_suffix else with_suffix(relative, ".md")


def write_filled(
    template: DataFrame, records: DataFrame, header: Sequence[str | None], path: str, fmt: str = "csv"
) -> None:
    """One template filled from all records (K9). Both sides carry ``pos``."""
    write_table(overlay(template, records, header).drop("pos"), path, fmt)


def write_filled_many(
    records: DataFrame, templates: dict[str, Sequence[str]], key: Sequence[str], path: str
) -> None:
    """One record set into every template, one folder each."""
    write_table(fill_many(records, templates, key), path, by=["template"])
