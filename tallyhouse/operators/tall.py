"""Wide per-object aggregates -> tall rows of the metrics table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.labels import object_label


@dataclass(frozen=True)
class MetricSpec:
    """One candidate output row per object; dropped when ``current`` or
    ``period_value`` is null (the table's columns are non-nullable)."""

    index: Column
    period_type: Column
    period_value: Column
    current: Column
    previous: Column
    mom: Column


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def to_metric_rows(wide: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Unpivot ``specs`` into rows (a Generate inside the same codegen stage)."""
    structs = [
        F.struct(
            _lit(s.index).cast("string").alias("index"),
            _lit(s.period_type).cast("string").alias("period_type"),
            _lit(s.period_value).cast("string").alias("period_value"),
            _lit(s.current).cast("double").alias("current_result"),
            _lit(s.previous).cast("double").alias("previous_result"),
            _lit(s.mom).cast("double").alias("mom"),
        )
        for s in specs
    ]
    label = object_label("obj_type", "city_id", "obj_key")
    out = wide.select("dim", "obj_type", label.alias("obj_value"), F.inline(F.array(*structs)))
    return out.where(F.col("current_result").isNotNull() & F.col("period_value").isNotNull()).select(
        "dim",
        "index",
        "obj_type",
        "obj_value",
        "period_type",
        "period_value",
        "current_result",
        "previous_result",
        "mom",
        F.lit(None).cast("double").alias("yoy"),
    )
