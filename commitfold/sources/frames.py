"""Landed commit frames, as a batch or as a stream.

The two readers share one schema, so whatever is built on frames runs on both.
JSON lines that do not parse are kept in the corrupt column and end up in the
quarantine instead of failing the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..session import importable

_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT}


def _configured(reader, fmt: str):
    if fmt == "json":
        return reader.format("json").schema(S.FRAME_WITH_CORRUPT).options(**_JSON)
    if fmt in ("parquet", "orc"):
        return reader.format(fmt).schema(S.FRAME)
    raise ValueError(f"unsupported frame format {fmt!r}")


def read(spark: SparkSession, path: str, fmt: str = "json", after: int | None = None) -> DataFrame:
    """All landed frames, or those after a cursor. The comparison on `seq` reaches
    the scan of columnar files."""
    frames = _configured(spark.read, fmt).load(path)
    return frames if after is None else frames.where(F.col("seq") > after)


def stream(spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """Frames as they land. The position is kept by the query's checkpoint."""
    reader = _configured(spark.readStream, fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_after(spark: SparkSession, path: str, position: int | str = 0, **options) -> DataFrame:
    """Frames landed as Parquet, by position: those after a known one, or with `tail` what
    lands from now on. The query's checkpoint holds positions (`seq_stream`)."""
    from .seq_stream import SeqStream  # needs pyarrow, which nothing else here does

    importable(spark)
    spark.dataSource.register(SeqStream)
    reader = spark.readStream.format(SeqStream.name()).option("path", path).option("start", str(position))
    return reader.options(**options).load()


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options) -> DataFrame:
    """Frames from a topic of JSON messages; starts at the live tail by default.

    Needs the Kafka connector on the class path.
    """
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return from_messages(source.select(F.col("value").cast("string").alias("value")))


def from_messages(messages: DataFrame) -> DataFrame:
    """JSON messages in column `value` to frames, unreadable ones to the corrupt column."""
    parsed = F.from_json("value", S.FRAME_WITH_CORRUPT, _JSON)
    return messages.select(F.explode(F.array(parsed)).alias("frame")).select("frame.*")


def write(frames: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Lands frames (used by backfills and tests)."""
    frames.write.mode(mode).format(fmt).save(path)
