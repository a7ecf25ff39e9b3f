"""Templates: headers, projection, conforming and filling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.functions.numbers import shift_point
from formweave.functions.text import any_filled

def clean_header(names: Sequence[str | None]) -> list[str]:
    """Header names stripped, empty ones dropped, repeats dropped."""
    stripped = (str(n).strip() for n in names if n is not None)
    return list(dict.fromkeys(n for n in stripped if n))


@dataclass(frozen=True)
class Projection:
    """A table cut to a template; ``table`` is None when no column matches.

    ``columns`` pairs each kept column's raw name with its stripped one.
    """

    table: DataFrame | None
    missing: list[str]
    columns: list[tuple[str, str]]


def project(df: DataFrame, template: Sequence[str]) -> Projection:
    """Keep the template's columns, in the data's order.

    Names match exactly once stripped; a padded data column is renamed.
    """
    wanted = clean_header(template)
    present = {c.strip(): c for c in reversed(df.columns)}
    missing = [w for w in wanted if w not in present]
    kept = [(c, c.strip()) for c in df.columns if c.strip() in wanted and present[c.strip()] == c]
    table = df.select(*[df[_quoted(raw)].alias(name) for raw, name in kept]) if kept else None
    return Projection(table, missing, kept)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers become null."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.nanvl(df[_quoted(f.name)], F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, floats)
            else df[_quoted(f.name)]
            for f in df.schema.fields
        ]
    )


def all_strings(df: DataFrame) -> DataFrame:
    """Every column as text, nulls kept (P10).

    Whole numbers lose ".0" and large ones are written out, as a sheet's
    cells read.
    """
    return df.select(*[_as_text(df[_quoted(f.name)], f.dataType).alias(f.name) for f in df.schema.fields])


def as_text(df: DataFrame, name: str) -> Column:
    """One column as all_strings() would write it."""
    return _as_text(df[_quoted(name)], df.schema[name].dataType)


def _as_text(value: Column, kind: T.DataType) -> Column:
    text = value.cast("string")
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return text
    # Printed digits and exponent, so that neither small nor large values lose any.
    plain = shift_point(F.regexp_extract(text, "^[^E]+", 0), F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int"))
    text = F.when(text.contains("E"), plain).otherwise(text)
    return F.regexp_replace(text, r"\.0?$", "")


def conform(df: DataFrame, fields: Sequence[str], record: str = "record") -> DataFrame:
    """Turn a map column into the template's columns: missing is '', extras go.

    A key holding null stays null, as a field found empty.
    """
    rest = [c for c in df.columns if c != record]
    found = F.col(record)
    return df.select(
        *rest,
        *[
            F.when(F.map_contains_key(found, f), F.element_at(found, F.lit(f)))
            .otherwise(F.lit(""))
            .alias(f)
            for f in fields
        ],
    )


def keep_filled(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows with at least one filled field."""
    return df.filter(any_filled([F.col(_quoted(f)) for f in fields]))


def union_records(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, ragged columns filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def header_columns(header: Sequence[str | None]) -> list[tuple[str, str]]:
    """(column, record key) pairs of a header with gaps and repeats.

    Null cells take nothing; every repeat of a name takes the same key, under
    a numbered column name since a table cannot repeat names.
    """
    seen: dict[str, int] = {}
    pairs = []
    for key in header:
        if key is None:
            continue
        n = seen.get(key, 0)
        seen[key] = n + 1
        pairs.append((f"{key}.{n}" if n else key, key))
    return pairs


def overlay(
    template: DataFrame, records: DataFrame, header: Sequence[str | None], pos: str = "pos"
) -> DataFrame:
    """Write record n over template row n, cell by cell.

    Both sides carry ``pos``; the records' runs from 1 without gaps, as ordered_union() numbers
    them. A record's null or absent field keeps the template's cell, '' overwrites it; template
    rows beyond the records and records beyond the template stay. Rows beyond are told by their
    position alone, so the one join is from the records: a template of known small size is broadcast by the planner.
    """
    columns = header_columns(header)
    t = template.select(pos, *[_or_null(template, c).alias(f"t.{c}") for c, _ in columns])
    r = records.select(pos, *[_or_null(records, k).alias(f"r.{c}") for c, k in columns])
    cells = [F.coalesce(F.col(f"`r.{c}`"), F.col(f"`t.{c}`")).alias(c) for c, _ in columns]
    filled = r.join(t, pos, "left").select(pos, *cells)
    untouched = t.filter(F.col(pos) > _last(records, pos))
    return filled.unionByName(untouched.select(pos, *[F.col(f"`t.{c}`").alias(c) for c, _ in columns]))


def _last(records: DataFrame, pos: str) -> Column:
    return records.agg(F.coalesce(F.max(pos).cast("long"), F.lit(0))).scalar()


def fill_many_in_place(records: DataFrame, headers: DataFrame, rows: DataFrame, pos: str = "pos") -> DataFrame:
    """One record set written over the rows of many templates of different headers.

    ``headers``: template, header array; ``rows``: template, pos, cells array; ``records``: pos from 1 without gaps, and
    fields. Gives template, pos, cells. As in overlay(), cell by cell: a header cell names the
    field of its column, a null one and cells beyond the header take nothing. The list of headers is small, one entry
    a template; records and rows meet in one join by template and position.
    """
    names = [c for c in records.columns if c != pos]
    values = F.array(*[records[_quoted(n)].cast("string") for n in names])
    record = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), values)
    forms = headers.agg(F.collect_list(F.struct("template", "header"))).scalar()
    due = records.select(pos, record.alias("__record"), F.inline(forms))
    held = rows.select("template", pos, "cells")
    width = F.greatest(F.size("header"), F.coalesce(F.size("cells"), F.lit(0)))

    def cell(i: Column) -> Column:
        return F.coalesce(F.element_at("__record", F.get("header", i)), F.get("cells", i))

    places = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))
    filled = due.join(held, ["template", pos], "left").select("template", pos, F.transform(places, cell).alias("cells"))
    known = headers.select("template").distinct()
    return filled.unionByName(held.filter(F.col(pos) > _last(records, pos)).join(known, "template", "left_semi"))


def _or_null(df: DataFrame, name: str) -> Column:
    return df[_quoted(name)].cast("string") if name in df.columns else F.lit(None).cast("string")


def empty_template(header: Column) -> Column:
    """A header array as the empty JSON template {name: ""} (K7)."""
    return F.to_json(F.map_from_arrays(header, F.array_repeat(F.lit(""), F.size(header))))


def present_fields(record: Column, fields: Sequence[str]) -> Column:
    """Template fields a map record holds, in template order."""
    return F.array_intersect(F.array(*[F.lit(f) for f in fields]), F.map_keys(record))


def missing_fields(record: Column, fields: Sequence[str]) -> Column:
    """Template fields a map record lacks."""
    return F.array_except(F.array(*[F.lit(f) for f in fields]), F.map_keys(record))


def fill_many(
    records: DataFrame, templates: dict[str, Sequence[str]], key: Sequence[str]
) -> DataFrame:
    """One record set into every template, in long form.

    Rows are (key columns, template, field_no, field, value). One pass over the
    records serves all templates; fields a record set lacks are not written.
    """
    cells = [
        F.struct(
            F.lit(name).alias("template"),
            F.lit(i).alias("field_no"),
            F.lit(field).alias("field"),
            records[_quoted(field)].cast("string").alias("value"),
        )
        for name, fields in templates.items()
        for i, field in enumerate(fields, start=1)
        if field in records.columns
    ]
    row = "array<struct<template:string,field_no:int,field:string,value:string>>"
    return records.select(*key, F.inline(F.array(*cells).cast(row)))


def distinct_paths(listings: Sequence[DataFrame]) -> DataFrame:
    """File lists of several patterns, each path once."""
    return reduce(lambda a, b: a.union(b), listings).distinct()
