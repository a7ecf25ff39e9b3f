"""From a request, tables and prose to a filled template."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.operators import template as T
from formweave.operators.chunking import document_chunks, numbered_chunks
from formweave.operators.daterange import filter_by_range, ranges_of_documents, require_range
from formweave.operators.extract import Extractor, extract_records, rule_extractor
from formweave.operators.positions import global_position
from formweave.operators.status import DONE, FAILED
from formweave.session import materialise
from formweave.sources.files import convert_folder, only_file, scan_files, texts_of
from formweave.sources.workbook import WORKBOOK_SUFFIXES, decode_workbooks, filter_rows, records


def table_records(
    table: DataFrame,
    request: DataFrame,
    fields: Sequence[str],
    key: Sequence[str],
    date_column: str | None = None,
    inclusive_day: bool = False,
) -> DataFrame | None:
    """Structured branch: rows in the range, cut to the template, as text (G1).

    None when no column fits. ``__order`` keeps the key for row order.
    """
    rows = filter_by_range(table, request, date_column, inclusive_day).table
    cut = T.project(rows, fields)
    if cut.table is None:
        return None
    cells = [T.as_text(rows, raw).alias(name) for raw, name in cut.columns]
    return rows.select(F.struct(*key).alias("__order"), *cells)


def prose_records(
    chunks: DataFrame,
    fields: Sequence[str],
    key: Sequence[str],
    extractor: Extractor | None = None,
    text: str = "text",
) -> DataFrame:
    """Prose branch: chunks to records of the template's fields."""
    carried = chunks.select(F.struct(*key).alias("__order"), F.col(text).alias("text"))
    # Written before it is ordered: extraction is the dear part, and records
    # are far smaller than their texts.
    return materialise(extract_records(carried, fields, extractor))


def ordered_union(branches: Sequence[DataFrame]) -> DataFrame:
    """All branches' records with positions 1..N, branch by branch, key by key.

    Branches may be keyed by different columns: each brings its own sort key,
    null in the rows of the others.
    """
    keyed = [
        b.withColumnRenamed("__order", f"__order{i}").withColumn("__branch", F.lit(i))
        for i, b in enumerate(branches)
    ]
    order = ["__branch", *[f"__order{i}" for i in range(len(branches))]]
    return global_position(T.union_records(keyed), order).drop(*order)


def workbook_records(
    rows: DataFrame, request: DataFrame, fields: Sequence[str], inclusive_day: bool = False, written: bool = False
) -> DataFrame:
    """Structured branch for workbook rows of any headers (G1).

    Rows go through the sheets' own headers as maps, so sheets of different
    shapes need no plan each. Sheets sharing no field with the template drop
    out; absent fields stay null and so keep the template's cells.
    """
    maps = records(filter_rows(rows, request, inclusive_day, written))
    shared = F.arrays_overlap(F.map_keys("record"), F.array(*[F.lit(f) for f in fields]))
    return maps.filter(shared).select(
        F.struct("path", "sheet_idx", "row_idx").alias("__order"),
        *[F.element_at("record", F.lit(f)).alias(f) for f in fields],
    )


@dataclass(frozen=True)
class Job:
    """What a job filled, and what became of each of its files.

    filled: pos and the template's columns
    report: path, kind (table or prose), status, message, n_read (sheet rows or chunks), n_records
    """

    filled: DataFrame
    report: DataFrame


def run_job(
    spark: SparkSession,
    request_folder: str,
    data_folder: str,
    template_folder: str,
    max_len: int = 1000,
    extractor: Extractor | None = None,
    kinds: dict[str, str] | None = None,
    recursive: bool = False,
) -> Job:
    """The whole job over folders: request text, mixed documents, one template book.

    Only the template's header comes to the driver. Every file is one row of the report, broken
    books and undecodable texts included; what was decoded and extracted is written once
    and read by both the filling and the report.
    """
    asked = texts_of(only_file(scan_files(spark, request_folder, (".txt",)), "request"))
    request = require_range(ranges_of_documents(asked, "path"))
    header, template = template_sheet(spark, template_folder)
    fields = T.clean_header(header)

    rows = materialise(decode_workbooks(scan_files(spark, data_folder, WORKBOOK_SUFFIXES, recursive)))
    tables = materialise(workbook_records(rows, request, fields, written=True))

    # Written before the chunks are numbered: ordering reads its input twice.
    docs = materialise(convert_folder(spark, data_folder, recursive=recursive))
    texts = docs.filter(F.col("status") == DONE).select("source", F.col("markdown").alias("text"))
    chunks = numbered_chunks(texts, document_chunks(F.col("text"), max_len), ["source"])
    prose = prose_records(chunks, fields, ["id", "source"], extractor or rule_extractor(fields, kinds))

    filled = T.overlay(template, ordered_union([tables, prose]), header)
    return Job(filled, job_report(rows, tables, docs, chunks, prose))


def job_report(rows: DataFrame, tables: DataFrame, docs: DataFrame, chunks: DataFrame, prose: DataFrame) -> DataFrame:
    """One row per file from what the branches of run_job() wrote.

    Counts come from aggregates by file, each one row a file; run_stats() sums them up.
    """

    def counted(df: DataFrame, path: str, name: str) -> DataFrame:
        return df.groupBy(F.col(path).alias("path")).agg(F.count("*").alias(name))

    error = F.max("error")
    books = rows.groupBy("path").agg(
        F.when(error.isNull(), DONE).otherwise(FAILED).alias("status"),
        F.coalesce(error, F.lit("")).alias("message"),
        F.count("cells").alias("n_read"),
    )
    books = books.join(counted(tables, "__order.path", "n_records"), "path", "left").withColumn("kind", F.lit("table"))
    texts = docs.select(F.col("source").alias("path"), "status", "message", F.lit("prose").alias("kind"))
    texts = texts.join(counted(chunks, "source", "n_read"), "path", "left")
    texts = texts.join(counted(prose, "__order.source", "n_records"), "path", "left")
    zero = lambda n: F.coalesce(F.col(n), F.lit(0)).alias(n)
    columns = ["path", "kind", "status", "message", zero("n_read"), zero("n_records")]
    return books.select(*columns).unionByName(texts.select(*columns))


def fill_from_folders(spark: SparkSession, request_folder: str, data_folder: str, template_folder: str, **options) -> DataFrame:
    """What run_job() fills: ``pos`` and the template's columns."""
    return run_job(spark, request_folder, data_folder, template_folder, **options).filled


def template_sheet(
    spark: SparkSession, folder: str, header_row: int = 0, start_row: int = 1
) -> tuple[list[str | None], DataFrame]:
    """Header cells and numbered rows of the folder's only workbook.

    The header stays as it is, gaps and repeats included; the first data row
    has ``pos`` 1.
    """
    book = only_file(scan_files(spark, folder, WORKBOOK_SUFFIXES), "template")
    sheet = materialise(decode_workbooks(book, sheet=0, header_row=-1))
    top = sheet.filter(F.col("row_idx") == header_row).select("cells").first()
    if top is None or not top["cells"]:
        raise ValueError(f"the template has no header in row {header_row}")
    header = [h.strip() if h is not None and h.strip() else None for h in top["cells"]]
    named = [i for i, h in enumerate(header) if h is not None]
    columns = [column for column, _ in T.header_columns(header)]
    rows = sheet.filter((F.col("row_idx") >= start_row) & F.col("cells").isNotNull())
    return header, rows.select(
        (F.col("row_idx") - start_row + 1).cast("long").alias("pos"),
        *[F.get("cells", F.lit(i)).alias(c) for i, c in zip(named, columns)],
    )


def fill_template(
    request: DataFrame,
    table: DataFrame,
    table_key: Sequence[str],
    chunks: DataFrame,
    chunk_key: Sequence[str],
    template: DataFrame,
    header: Sequence[str | None],
    kinds: dict[str, str] | None = None,
    extractor: Extractor | None = None,
) -> DataFrame:
    """Both branches unioned and written over the template's rows.

    ``template`` carries ``pos``; the result has ``pos`` and the header's
    columns. One range shuffle of the records; the sheet is broadcast.
    """
    fields = T.clean_header(header)
    branches = [
        table_records(table, request, fields, table_key),
        prose_records(chunks, fields, chunk_key, extractor or rule_extractor(fields, kinds)),
    ]
    records = ordered_union([b for b in branches if b is not None])
    return T.overlay(template, records, header)
