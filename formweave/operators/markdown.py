"""Sheet rows to Markdown tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.functions.text import divider, join_cells
from formweave.session import materialise

PART_ROWS = 10_000


def drop_empty_rows(rows: DataFrame) -> DataFrame:
    """Rows with at least one cell (P14). ``rows``: sheet keys, row_idx, cells."""
    return rows.filter(F.exists("cells", lambda c: c.isNotNull()))


def markdown_lines(rows: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """(sheet keys, line_no, line): header row, divider, body rows.

    The first non-empty row is the header; ragged rows are padded to the widest
    row. Both facts come from one small aggregate per sheet, joined back, so a
    sheet's rows need not meet in one task.
    """
    kept = drop_empty_rows(rows)
    # One row per sheet; written, so that the planner knows its size and only
    # shuffles the rows when there are too many sheets to broadcast.
    facts = materialise(
        kept.groupBy(*sheet).agg(
            F.min("row_idx").alias("__head"), F.max(F.size("cells")).alias("__width")
        )
    )
    joined = kept.join(facts, list(sheet))
    padded = F.concat("cells", F.array_repeat(F.lit(None).cast("string"), F.col("__width") - F.size("cells")))
    first = F.col("row_idx") == F.col("__head")
    row = join_cells(padded)
    # Line 2k belongs to row k, so the divider fits in at 2 * head + 1.
    lines = F.when(
        first,
        F.array(
            F.struct((F.col("row_idx") * 2).alias("line_no"), row.alias("line")),
            F.struct((F.col("row_idx") * 2 + 1).alias("line_no"), divider(F.col("__width")).alias("line")),
        ),
    ).otherwise(F.array(F.struct((F.col("row_idx") * 2).alias("line_no"), row.alias("line"))))
    return joined.select(*sheet, F.inline(lines))


def markdown_tables(rows: DataFrame, sheet: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """(sheet keys, part, markdown): the table text of each sheet.

    A sheet longer than ``part_rows`` comes as several parts in order, so that
    no text and no group grows with the sheet.
    """
    lines = markdown_lines(rows, sheet)
    part = F.floor(F.col("line_no") / (2 * part_rows)).alias("part")
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]
    )
    return lines.groupBy(*sheet, part).agg(F.array_join(ordered, "\n").alias("markdown"))


# The line above a sheet, and what stands for a sheet without rows.
_TITLE = "<!-- 工作表: ", " -->\n"
_NO_ROWS = "*(工作表无数据)*\n"


def workbook_parts(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(path, sheet_idx, sheet, part, markdown): every sheet of every workbook in parts.

    Read in the order of sheet_idx and part, the texts of a book joined with line ends are its Markdown:
    the first part of a sheet bears its title, the last one the gap to the next sheet.
    ``rows``: path, sheet, sheet_idx, row_idx, cells; a sheet without rows is one row with null cells and yields a
    notice. No text and no group holds more than ``part_rows`` rows.
    """
    keys = ["path", "sheet_idx", "sheet"]
    # Written: the tables are read again for each sheet's first and last part.
    tables = materialise(markdown_tables(rows, keys, part_rows))
    ends = tables.groupBy(*keys).agg(F.min("part").alias("first"), F.max("part").alias("last"))
    parts = rows.select(*keys).distinct().join(ends, keys, "left").join(tables, keys, "left")
    title = F.concat(F.lit(_TITLE[0]), F.col("sheet"), F.lit(_TITLE[1]))
    head = F.when(F.col("part") == F.col("first"), F.concat(title, F.lit("\n"))).otherwise("")
    tail = F.when(F.col("part") == F.col("last"), "\n\n").otherwise("")
    text = F.when(F.col("part").isNull(), F.concat(title, F.lit(_NO_ROWS))).otherwise(F.concat(head, F.col("markdown"), tail))
    return parts.select(*keys, F.coalesce("part", F.lit(0)).alias("part"), text.alias("markdown"))


def workbook_markdown(rows: DataFrame) -> DataFrame:
    """(path, markdown): the whole Markdown of each workbook as one text.

    For books that one text can hold, as they were one file in one task; workbook_parts()
    gives larger ones in parts.
    """
    parts = workbook_parts(rows)
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("sheet_idx", "part", F.col("markdown").alias("p")))), lambda x: x["p"]
    )
    return parts.groupBy("path").agg(F.array_join(ordered, "\n").alias("markdown"))


def header_rows(rows: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """The first non-empty row of each sheet."""
    packed = F.min_by(F.col("cells"), F.col("row_idx")).alias("header")
    return drop_empty_rows(rows).groupBy(*sheet).agg(packed)
