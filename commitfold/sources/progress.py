"""Stream position per service: the `sub_state` table.

Streaming queries resume from their own checkpoint; this table serves batch
resumption and reporting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..operators import ops


def checkpoint_position(frames: DataFrame, service: str) -> DataFrame:
    """The position to save: the greatest `seq` of a valid commit that is a multiple of
    the checkpoint interval. No row where there is none; a rejected frame never moves it."""
    due = (F.col("kind") == "commit") & (F.col("seq") % S.CURSOR_EVERY == 0)
    return (
        ops.valid_frames(frames.where(due))
        .agg(F.max("seq").alias("cursor"))
        .where(F.col("cursor").isNotNull())
        .select(F.lit(service).alias("service"), "cursor")
    )


def merge(state: DataFrame, update: DataFrame) -> DataFrame:
    """Upsert: one row per service, positions never move back."""
    return state.unionByName(update).groupBy("service").agg(F.max("cursor").alias("cursor"))


def cursor(state: DataFrame, service: str) -> int | None:
    """The saved position of a service, if any. Reads one row."""
    row = state.where(F.col("service") == service).select("cursor").limit(1).collect()
    return row[0]["cursor"] if row else None


def after_cursor(frames: DataFrame, state: DataFrame, service: str) -> DataFrame:
    """Frames not yet covered by the saved position; all of them without one."""
    position = cursor(state, service)
    return frames if position is None else frames.where(F.col("seq") > position)


def saved(spark: SparkSession, database: str) -> DataFrame:
    """The `sub_state` table of a database, empty before anything is saved."""
    if spark.catalog.tableExists(f"{database}.sub_state"):
        return spark.table(f"{database}.sub_state")
    return spark.createDataFrame([], S.SUB_STATE_TABLE)


def save(spark: SparkSession, database: str, service: str, position: int | None) -> None:
    """Upserts a service's position, which never moves back. The table has a row per service,
    so it is a view of its rows: replacing it is one step, and a reader sees all or nothing."""
    if position is None:
        return
    update = spark.createDataFrame([(service, position)], S.SUB_STATE_TABLE)
    rows = merge(saved(spark, database), update).orderBy("service").collect()
    quoted = lambda name: "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
    listed = ", ".join(f"({quoted(r['service'])}, cast({r['cursor']} as bigint))" for r in rows)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.sub_state AS SELECT * FROM VALUES {listed} AS t(service, cursor)")
