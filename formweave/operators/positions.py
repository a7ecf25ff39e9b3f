"""Positions, ranks and first-occurrence filters.

A window without a partition key runs in one task, and a window over a hot key
sorts that whole key in one task. Positions here come from a range shuffle
instead: each partition holds one stretch of the global order, numbers its own
rows, and adds the size of the stretches before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formweave.session import materialise

# monotonically_increasing_id keeps the partition above bit 33, the row below.
_ROW_BITS = 33
_MARK = "__mark"
_STRETCH = "__stretch"


def global_position(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "pos",
    start: int = 1,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Number all rows 1..N in the order of ``order`` columns.

    ``order`` must be unique for the numbering to be repeatable. ``narrow`` is
    row-wise work (projecting, filtering, exploding) to do on the sorted rows
    before they are numbered. Costly work belongs there: what comes before the
    range shuffle runs twice, once for the sample that sets its bounds.

    One range shuffle and one written copy.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    stretched = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    if narrow is not None:
        stretched = narrow(stretched)
    return number_rows(stretched, name, start)


def number_rows(df: DataFrame, name: str = "pos", start: int = 1, row_group: int | None = None) -> DataFrame:
    """Number all rows densely in the order they lie, partition after partition. No shuffle.

    The rows are written once, so that the counting pass and the numbering
    pass see the same partitions. ``row_group`` is that of the written copy.
    """
    marked = materialise(df.withColumn(_MARK, F.monotonically_increasing_id()), row_group)
    marked = marked.withColumn(_STRETCH, F.shiftright(_MARK, _ROW_BITS))
    sizes = marked.groupBy(_STRETCH).agg(F.count("*").alias("__n"))
    # One row per partition of the written copy: this window and the broadcast
    # below grow with the number of tasks, not with the rows.
    before = F.sum("__n").over(Window.orderBy(_STRETCH).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(_STRETCH, F.coalesce(before, F.lit(0)).alias("__before"))
    row = F.col(_MARK).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        marked.join(F.broadcast(offsets), _STRETCH)
        .withColumn(name, F.col("__before") + row + F.lit(start))
        .drop(_STRETCH, _MARK, "__before")
    )


def global_rank(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rank",
    narrow: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rank every row inside its ``by`` group from 1, whatever the group size.

    Named sort columns are ascending; a column such as F.desc_nulls_first("score") ranks
    downwards. A group holding most of the rows is spread over many tasks. ``narrow`` drops
    columns before the sorted rows are written; those of ``by`` stay.
    """
    placed = global_position(df, [*by, *order], name="__at", narrow=narrow)
    # One row per group, written so that the planner knows whether it is small:
    # a few groups are broadcast, and a hot one is not gathered for the join.
    firsts = materialise(placed.groupBy(*by).agg(F.min("__at").alias("__first")))
    return (
        placed.join(firsts, list(by))
        .withColumn(name, F.col("__at") - F.col("__first") + 1)
        .drop("__at", "__first")
    )


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each ``by`` group with their rank.

    Spark cuts every group to k rows in each map task before the shuffle, so a
    hot group costs no more than k rows per task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def first_occurrence(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the earliest row of each group (W4), as an aggregate.

    min_by combines map-side; a row_number window would sort each whole group.
    """
    rest = [c for c in df.columns if c not in by]
    packed = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*by).agg(packed).select(*by, "__row.*").select(*df.columns)
