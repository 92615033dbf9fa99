"""Data quality: the constraints a row store would enforce, as a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import TABLES


def constraint_report(table: DataFrame, name: str) -> DataFrame:
    """Rows, surplus rows per key, and nulls in columns that must not hold any.

    Keys are counted per key first (combined before the shuffle); nulls ride
    along in the same aggregation.
    """
    schema = TABLES[name]
    key = schema.fields[0].name
    required = [f.name for f in schema.fields if not f.nullable]
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in required), F.lit(0))
    per_key = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("missing_values"),
    ).select("table_name", "n_rows", "duplicate_keys", "missing_values")
