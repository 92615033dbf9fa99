"""Structured Streaming collector.

Each micro-batch adds one folder to the operation log, in one pass over its frames;
nothing is rewritten while the stream runs. The tables are the fold of the log, so they
can be read at any moment (`tables`).

Two ways keep that cheap, both run beside the stream and not in its batches. `advance`
takes finished batches into standing tables in the catalog; `standing` reads those with
the batches after them. `compact` replaces the log up to a batch by a smaller one with the
same fold, written beside it and then announced in the manifest; readers of the log take
the announced base with the largest batch and the log after it.

A batch writes to folders named after its id and overwrites them, so a batch
repeated after a failure leaves the same log. Stream positions are committed by
the query's checkpoint once the batch is done.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import fold
from ..plans import collect
from ..sources import base

_MANIFEST = "upto bigint, path string"
_POSITION = "service string, cursor bigint"


def start(
    frames: DataFrame,
    root: str,
    service: str = "default",
    ingested: Column | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Starts the collector on a stream of frames.

    `trigger` goes to the writer, for example `{"availableNow": True}`. The position of a
    batch is written after its log, so it also says that the batch is whole.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        cursor = collect.write_log(batch, f"{root}/log/batch={batch_id}", ingested, mode="overwrite")
        position = batch.sparkSession.createDataFrame([(service, cursor)], _POSITION)
        position.coalesce(1).write.mode("overwrite").parquet(f"{root}/progress/batch={batch_id}")

    writer = frames.writeStream.foreachBatch(land).option("checkpointLocation", f"{root}/checkpoint")
    if trigger is not None:
        writer = writer.trigger(**trigger)
    if name is not None:
        writer = writer.queryName(name)
    return writer.start()


def _base(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Last batch covered by the newest announced base, and where that base is."""
    try:
        manifest = spark.read.schema(_MANIFEST).json(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, None  # nothing compacted yet
    newest = manifest.orderBy(F.desc("upto")).limit(1).collect()
    return (newest[0]["upto"], newest[0]["path"]) if newest else (-1, None)


def _landed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{collect.LOG_FILE}, batch bigint").parquet(f"{root}/log")


def log(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The effective operation log: newest base, then the batches after it."""
    covered, path = _base(spark, root)
    tail = _landed(spark, root).where((F.col("batch") > covered) & F.col("target").isin("post", "engagement"))
    if upto is not None:
        tail = tail.where(F.col("batch") <= upto)
    tail = tail.select(*S.OPS.fieldNames())
    if path is None:
        return tail
    base = spark.read.schema(S.OPS).parquet(path)
    return base.select(*S.OPS.fieldNames()).unionByName(tail)


def compact(spark: SparkSession, root: str, upto: int) -> None:
    """Writes a compacted log of everything up to and including a finished batch, unless
    an announced base has it already. Every run writes a folder of its own and announces
    it last, so no base is ever replaced."""
    if _base(spark, root)[0] >= upto:
        return
    path = f"{root}/base/upto={upto}-{uuid.uuid4().hex}"
    fold.compact(log(spark, root, upto)).write.partitionBy("target").parquet(path)
    spark.createDataFrame([(upto, path)], _MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")


def tables(spark: SparkSession, root: str, with_counters: bool = False) -> collect.Tables:
    """The current tables."""
    return collect.fold_log(log(spark, root), with_counters)


def _finished(spark: SparkSession, root: str) -> int:
    """The last whole batch, -1 before the first."""
    saved = spark.read.schema(f"{_POSITION}, batch bigint").parquet(f"{root}/progress")
    last = saved.agg(F.max("batch")).first()[0]
    return -1 if last is None else last


def _between(spark: SparkSession, root: str, after: int, upto: int) -> DataFrame:
    """The log of the batches after one and up to another, without a look at the others."""
    folders = [f"{root}/log/batch={b}" for b in range(after + 1, upto + 1)]
    if not folders:
        return spark.createDataFrame([], S.OPS)
    landed = spark.read.schema(collect.LOG_FILE).option("basePath", f"{root}/log").parquet(*folders)
    return landed.where(F.col("target").isin("post", "engagement")).select(*S.OPS.fieldNames())


def advance(spark: SparkSession, root: str, database: str, buckets: int) -> None:
    """Takes the finished batches that are not in them yet into the standing tables. Work
    and shuffle grow with those batches and not with the history; the standing tables are
    read and written in their buckets."""
    known = base.current(spark, database)
    done, last = -1 if known is None or known.batch is None else known.batch, _finished(spark, root)
    if last > done:
        base.advance(_between(spark, root, done, last), database, buckets, batch=last)


def standing(spark: SparkSession, root: str, database: str, with_counters: bool = False) -> base.Standing:
    """The current tables: the standing ones and the finished batches after them."""
    known = base.current(spark, database)
    done, last = -1 if known is None or known.batch is None else known.batch, _finished(spark, root)
    tail = _between(spark, root, done, last) if last > done or known is None else None
    return base.tables(spark, database, tail, with_counters)


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rejected operations, one row per broken rule."""
    return collect.rejected(_landed(spark, root))


def rejected_frames(spark: SparkSession, root: str) -> DataFrame:
    """Rejected frames, one row per broken rule."""
    return collect.rejected_frames(_landed(spark, root))


def positions(spark: SparkSession, root: str) -> DataFrame:
    """The `sub_state` table of the stream: one row per service."""
    saved = spark.read.schema(_POSITION).parquet(f"{root}/progress")
    return saved.where("cursor is not null").groupBy("service").agg(F.max("cursor").alias("cursor"))
