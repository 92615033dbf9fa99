"""Operator 3: proportional stratified interleaving into shards.

Within each source rows are put in a seeded order; the row at rank r (from 0) of n gets
the fraction (r + phase) / n, the phase a seeded number in [0, 1) of the source, so that
sources of a row or two do not all fall on one place. All rows are sorted by fraction and
cut into shards of equal row counts (at most one apart: the law is `rows`). A run of the
sorted rows holds each source in proportion, so every shard has the mixture.

Ranks are found without a task per source: rows are dealt to buckets by their seeded key,
counted per source and bucket, and numbered inside a bucket; running sums over the counts
give the rest. The second sort is done alike, by buckets of the fraction.

Rows are placed for themselves: this law keeps equal counts, not equal texts, together.

Cases: a null text has no bytes (size 1) and the check sum of the empty text; a null
source is a source of its own; rows equal in doc_id, text and source are interchangeable,
and numbered so that each has a key of its own, however many there are; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import hex_unit, written

ROWS_PER_BUCKET = 10_000


def _before(counts: DataFrame, within: list[str], by: str) -> DataFrame:
    """Adds how many rows the earlier buckets hold."""
    upto = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))


def _numbered(rows: DataFrame, at_once: int) -> DataFrame:
    """The rows with `copy`, a number from 0 among equal ones. Those are counted before they
    are shuffled, and dealt out again in runs of `at_once`."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {at_once}"))))
    many = runs.where(F.col("copies") > at_once).repartition("run", *rows.columns)
    runs = runs.where(F.col("copies") <= at_once).unionByName(many)
    upto = F.least(F.col("copies"), (F.col("run") + 1) * at_once) - 1
    return runs.withColumn("copy", F.explode(F.sequence(F.col("run") * at_once, upto))).drop("copies", "run")


def interleave(docs: DataFrame, shards: int = 16, seed: int = 42, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law).

    Writes two narrow tables under the shared folder.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
    )
    rows = _numbered(rows, rows_per_bucket)
    again = F.when(F.col("copy") > 0, F.col("copy").cast("string"))  # a null is no part of the name
    named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", again)
    rows = written(rows.withColumn("key", F.md5(named.cast("binary"))), "shard-rows")
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    rows = rows.withColumn("bucket", F.expr(f"({_unit('key')} * {buckets}L) div 4294967296L"))

    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    offsets = _before(counts, ["stratum"], "bucket").select(
        "stratum", "bucket", "before", F.sum("n").over(Window.partitionBy("stratum")).alias("of")
    )
    inside = Window.partitionBy("stratum", "bucket").orderBy("key", "doc_id", "text_crc32", "size", "copy")
    phase = hex_unit(F.md5(F.concat(F.lit(f"{seed}/"), "stratum").cast("binary"))) / F.lit(4294967296.0)
    placed = (
        rows.withColumn("rank", F.row_number().over(inside))
        .join(offsets, ["stratum", "bucket"])
        .withColumn("fraction", (F.col("before") + F.col("rank") - 1 + phase) / F.col("of"))
        .withColumn("band", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
        .select("doc_id", "size", "text_crc32", "stratum", "key", "copy", "fraction", "band")
    )
    placed = written(placed, "shard-fractions")

    bands = _before(placed.groupBy("band").agg(F.count("*").alias("n")).withColumn("all", F.lit(0)), ["all"], "band")
    order = Window.partitionBy("band").orderBy("fraction", "stratum", "key", "doc_id", "text_crc32", "size", "copy")
    at = placed.withColumn("rank", F.row_number().over(order)).join(bands.select("band", "before"), "band")
    at = at.withColumn("at", F.col("before") + F.col("rank") - 1).withColumn("shard", F.expr(f"(at * {shards}L) div {max(total, 1)}L"))
    return at.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"at - (shard * {total}L + {shards - 1}L) div {shards}L").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _unit(name: str) -> str:
    return f"cast(conv(substring({name}, 1, 8), 16, 10) as bigint)"
