"""Entities of many documents to template fields with a review mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.operators import pool
from formweave.session import materialise


def pooled_values(
    docs: DataFrame,
    key: str,
    template_fields: DataFrame,
    field_vectors: DataFrame,
    other_tiers: DataFrame | None = None,
    threshold: float = 0.0,
) -> DataFrame:
    """(key, template_field, field, value, confidence, tier, review): best value per document and field.

    template_fields: query_id, template_field, embedding; field_vectors:
    node_id, field, embedding, one row per extracted field name. Matching runs
    over names, of which there are few; values follow by an equi join.
    """
    rules = pool.rule_entities(docs, key).select(key, "field", "value", "confidence", "tier")
    values = rules if other_tiers is None else rules.unionByName(other_tiers)
    best = pool.best_values(values, [key, "field"])
    matched = (
        pool.match_fields(template_fields.select("query_id", "embedding"), field_vectors.select("node_id", "embedding"), threshold)
        .join(template_fields.select("query_id", "template_field"), "query_id")
        .join(field_vectors.select("node_id", "field"), "node_id")
        .select("template_field", "field")
    )
    # Few names against all values, a third of which may share a name: written,
    # the names have a known size and are broadcast when small.
    return pool.flag_review(best.join(materialise(matched), "field")).select(
        key, "template_field", "field", "value", "confidence", "tier", F.col("review")
    )
