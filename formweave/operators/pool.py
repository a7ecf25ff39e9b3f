"""The entity pool: rule entities, best values, field match, review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.functions.dates import date_literals, iso_date
from formweave.functions.numbers import amount, amounts
from formweave.operators import vector

# Fixed value: records below this confidence go to a person.
REVIEW_BELOW = 0.8
# Rules match strong patterns only; model tiers bring their own confidence.
RULE_CONFIDENCE = 0.9


def rule_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, field, value, raw, confidence, tier, place): dates and amounts of each document.

    Values are normalised: dates to YYYY-MM-DD, amounts to plain digits in the
    basic unit (F26). Row-wise, no shuffle.
    """
    body = F.col(text)
    dates = F.transform(
        date_literals(body),
        lambda x: F.struct(
            F.lit("date").alias("field"), iso_date(x["day"]).alias("value"), x["literal"].alias("raw")
        ),
    )
    money = F.transform(
        amounts(body),
        lambda s: F.struct(F.lit("amount").alias("field"), amount(s).alias("value"), s.alias("raw")),
    )
    found = docs.select(key, F.posexplode(F.concat(dates, money)).alias("place", "e"))
    return found.select(
        key, "e.*", F.lit(RULE_CONFIDENCE).alias("confidence"), F.lit("rule").alias("tier"), "place"
    )


def best_values(pool: DataFrame, by: Sequence[str], confidence: str = "confidence") -> DataFrame:
    """The most confident row per document and field (A14); ties go to the smaller value.

    An aggregate, so a field with very many candidates is combined map-side.
    """
    rest = [c for c in pool.columns if c not in by]
    order = F.struct((-F.col(confidence)).alias("c"), F.col("value").alias("v"))
    return pool.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*by, "r.*")


def flag_review(pool: DataFrame, below: float = REVIEW_BELOW) -> DataFrame:
    """Mark rows a person must check."""
    return pool.withColumn("review", F.when(F.col("confidence") < below, "review").otherwise("ok"))


def match_fields(template: DataFrame, extracted: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Each template field's most similar extracted field, if similar enough.

    template: query_id, embedding of the field name; extracted: node_id, embedding.
    """
    best = vector.nearest(extracted, template, k=1)
    return best.filter(F.col("score") >= threshold).drop("rank")
