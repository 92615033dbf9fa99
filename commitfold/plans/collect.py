"""Batch collection: landed frames to tables."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import schemas as S
from ..operators import counters, fold, ops
from ..sources import base, progress, tables

# Columns of a written log; `target` is the partition column.
LOG_FILE = (
    "seq bigint, op_idx int, action string, collection string, uri string, author string, ingested_us bigint, "
    "cid string, createdAt string, text string, rootUri string, rootCid string, linkUrl string, linkTitle string, "
    "linkDescription string, type int, subjectUri string, subjectCid string, reasons array<string>, payload string, "
    "kind string, target string"
)


class Tables(NamedTuple):
    post: DataFrame
    engagement: DataFrame


def fold_log(log: DataFrame, with_counters: bool = False) -> Tables:
    """The two tables of a log.

    Posts with counters are shuffled once: the replies to count come from a fold of
    their own that carries nothing but root and deletion.
    """
    engagement = fold.fold_engagement(log)
    if not with_counters:
        return Tables(fold.fold_posts(log), engagement)
    return Tables(_counted_posts(log, engagement), engagement)


def _counted_posts(log: DataFrame, engagement: DataFrame) -> DataFrame:
    replies = fold.fold_post_columns(log, ("rootUri",))
    return counters.attach(fold.fold_posts(log, keep_hash=True), counters.subject_counts(replies, engagement))


def write_log(frames: DataFrame, path: str, ingested: Column | None = None, mode: str = "errorifexists") -> int | None:
    """One pass over the frames, one write: accepted operations, quarantined ones and
    rejected frames in one partitioned table (`target` is post, engagement, quarantine or
    frame). Returns the position to save, which is observed on the way."""
    seen = Observation()
    judged = ops.judged_frames(frames).observe(seen, ops.landed_position().alias("cursor"))
    ops.landed(judged, ingested).write.mode(mode).partitionBy("target").parquet(path)
    return seen.get.get("cursor")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The accepted part of a written log; quarantine folders are pruned."""
    log = spark.read.schema(LOG_FILE).parquet(path)
    return log.where(F.col("target").isin("post", "engagement")).select(*S.OPS.fieldNames())


def rejected(written_log: DataFrame) -> DataFrame:
    """Rejected operations of a written log, one row per broken rule."""
    return written_log.where(F.col("target") == "quarantine").select(
        "seq", "op_idx", "uri", "collection", F.explode("reasons").alias("reason"), "payload"
    )


def rejected_frames(written_log: DataFrame) -> DataFrame:
    """Rejected frames of a written log, one row per broken frame rule."""
    return written_log.where(F.col("target") == "frame").select("kind", "seq", F.explode("reasons").alias("reason"), "payload")


def read_rejected_frames(spark: SparkSession, path: str) -> DataFrame:
    return rejected_frames(spark.read.schema(LOG_FILE).parquet(path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return rejected(spark.read.schema(LOG_FILE).parquet(path))


def backfill(frames: DataFrame, out: str, ingested: Column | None = None) -> None:
    """Frames to a written log (rejected frames included) and tables under `out`.

    The log is written first: decoding happens once, the folds read back only the
    columns and partitions they need, and a lost executor costs a re-read of files
    rather than another pass over the frames.
    """
    spark = frames.sparkSession
    write_log(frames, f"{out}/log", ingested)
    log = read_log(spark, f"{out}/log")
    tables.write(fold.fold_engagement(log), "engagement", f"{out}/engagement")
    engagement = tables.read(spark, "engagement", f"{out}/engagement")
    tables.write(_counted_posts(log, engagement), "post", f"{out}/post")


def resume(
    frames: DataFrame, out: str, database: str, buckets: int, service: str = "default", ingested: Column | None = None
) -> None:
    """The batch job as a run that goes on where the last one ended: frames after the saved
    position are landed under `out` and taken into the standing tables of `database`, and
    the position moves on last. A run that failed on the way is simply done again; frames
    between the position and the end of the last run come twice, which changes nothing."""
    spark = frames.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    later = progress.after_cursor(frames, progress.saved(spark, database), service)
    run = f"{out}/log/run={uuid.uuid4().hex}"
    cursor = write_log(later, run, ingested)
    base.advance(read_log(spark, run), database, buckets)
    progress.save(spark, database, service, cursor)
