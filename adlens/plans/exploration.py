"""Exploration job: every profile of an impressions table, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adlens.operators import profile
from adlens.schemas import PLACEMENTS


def explore(df: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """Lazy reports; one whose columns are missing is left out."""
    columns = set(df.columns)
    reports = {"missing": profile.missing_report(df), "numeric": profile.describe_numeric(df, exact=exact)}
    if "timestamp" in columns:
        reports["info"] = profile.table_info(df)
    if "clicked" in columns:
        reports["class_balance"] = profile.class_balance(df)
        for key in ("hour", "device", "placement"):
            if key in columns:
                reports[f"ctr_by_{key}"] = profile.ctr_by(df, key)
        if "day_of_week" in columns:
            reports["ctr_by_day_of_week"] = profile.ctr_by_day_of_week(df)
        if {"device", "placement"} <= columns:
            reports["ctr_matrix"] = profile.ctr_pivot(df, values=PLACEMENTS)
    for key in ("device", "placement"):
        if key in columns:
            reports[f"values_{key}"] = profile.value_counts(df, key)
    entities = [c for c in ("user_id", "ad_id") if c in columns]
    if entities:
        reports["entities"] = profile.entity_stats(df, entities, approx=not exact)
        for entity in entities:
            reports[f"top_{entity}"] = profile.top_entities(df, entity)
    return reports
