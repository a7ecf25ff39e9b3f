"""Run statistics, skip lists and observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

DONE, SKIPPED, FAILED = "done", "skipped", "failed"


def mark_existing(items: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Status ``skipped`` for items whose output exists, ``done`` for the rest."""
    have = existing.select(*key).distinct().withColumn("__have", F.lit(True))
    return (
        items.join(have, list(key), "left")
        .withColumn("status", F.when(F.col("__have"), SKIPPED).otherwise(DONE))
        .drop("__have")
    )


def not_existing(items: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Items still to convert."""
    return items.join(existing.select(*key), list(key), "left_anti")


_COUNTS = {
    "total": F.count,
    "success": lambda s: F.count_if(s.isin(DONE, SKIPPED)),
    "failed": lambda s: F.count_if(s == FAILED),
    "skipped": lambda s: F.count_if(s == SKIPPED),
}


def run_stats(items: DataFrame, status: str = "status") -> DataFrame:
    """total, success, failed, skipped; a skipped item counts as success too (A4)."""
    return items.agg(*[f(F.col(status)).alias(n) for n, f in _COUNTS.items()])


def observed(items: DataFrame, name: str = "run", status: str = "status") -> tuple[DataFrame, Observation]:
    """``items`` with the same counts gathered while a sink consumes them."""
    seen = Observation(name)
    return items.observe(seen, *[f(F.col(status)).alias(n) for n, f in _COUNTS.items()]), seen
