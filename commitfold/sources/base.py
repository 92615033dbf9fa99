"""The standing tables in the catalog: states laid out in buckets by uri.

A version of a table is written beside the one before and never changed. Which versions
belong together, and how far they reach, is said by one view of a single row (`current`);
replacing it is the one step that makes a new version seen, so readers find the tables of
one position only. The version before the current one stays for readers that are under way;
older ones go.

Bucketed tables need a catalog; for one that outlives the session, a metastore.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import fold, merge

TABLES = ("post_state", "engagement_state", "subject_counts", "totals")


class Current(NamedTuple):
    """The names of the versions in use. `batch` is the last log batch taken in, `settled`
    the position up to which the stream has been taken in whole; either may be unknown."""

    post_state: str
    engagement_state: str
    subject_counts: str
    totals: str
    batch: int | None
    settled: int | None
    before: str


def current(spark: SparkSession, database: str) -> Current | None:
    if not spark.catalog.tableExists(f"{database}.current"):
        return None
    return Current(**spark.table(f"{database}.current").first().asDict())


def _version(df: DataFrame, database: str, name: str, version: str, buckets: int | None) -> str:
    full = f"{database}.{name}_{version}"
    writer = df.write.format("parquet").option("compression", "zstd")
    if buckets is not None:
        writer = writer.bucketBy(buckets, *merge.KEY).sortBy(*merge.KEY)
    writer.saveAsTable(full)
    return full


def _announce(spark: SparkSession, database: str, names: list[str], batch: int | None, settled: int | None) -> None:
    was = current(spark, database)
    number = lambda n: "cast(null as bigint)" if n is None else f"cast({n} as bigint)"
    columns = [f"'{full}' as {name}" for name, full in zip(TABLES, names, strict=True)]
    before = ",".join(was[: len(TABLES)]) if was else ""
    columns += [f"{number(batch)} as batch", f"{number(settled)} as settled", f"'{before}' as before"]
    spark.sql(f"CREATE OR REPLACE VIEW {database}.current AS SELECT {', '.join(columns)}")
    for old in filter(None, was.before.split(",") if was else []):
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def advance(
    log: DataFrame, database: str, buckets: int, batch: int | None = None, settled: int | None = None
) -> None:
    """Takes the operations of `log` into the standing tables, starting them if there are
    none: states, counters and totals move together. `batch` and `settled` are kept for the
    next run; operations up to the position settled before are left out, as known."""
    spark = log.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    was = current(spark, database)
    version = uuid.uuid4().hex[:12]
    if was is not None and was.settled is not None:
        log = log.where(F.col("seq") > was.settled)
    posts, engagement = merge.post_state(log), merge.engagement_state(log, settled)
    if was is not None:
        posts = merge.merged_posts(spark.table(was.post_state), posts)
        engagement = merge.merged_engagement(spark.table(was.engagement_state), engagement, settled)
    names = [
        _version(merge.stored_posts(posts, settled), database, TABLES[0], version, buckets),
        _version(merge.stored_engagement(engagement, settled), database, TABLES[1], version, buckets),
    ]
    # The rest comes from the two versions, in their buckets: the log is not worked on again.
    moved = _moves(spark, was, *names)
    counts, totals = merge.count_changes(moved), merge.total_changes(moved)
    if was is not None:
        counts = merge.merged_counts(spark.table(was.subject_counts), counts)
        totals = merge.merged_totals(spark.table(was.totals), totals)
    counts = counts.select(*merge.KEY, *merge.counters.COUNTERS)
    names += [_version(counts, database, TABLES[2], version, buckets), _version(totals, database, TABLES[3], version, None)]
    _announce(spark, database, names, batch, settled if settled is not None else was.settled if was else None)


def _moves(spark: SparkSession, was: Current | None, posts: str, engagement: str) -> DataFrame:
    """What has moved between the versions in use and new ones."""
    before = (None, None) if was is None else (spark.table(was.post_state), spark.table(was.engagement_state))
    post, other = (None if b is None else facts(b) for b, facts in zip(before, (merge.post_facts, merge.engagement_facts), strict=True))
    return merge.moves(post, merge.post_facts(spark.table(posts))).unionByName(
        merge.moves(other, merge.engagement_facts(spark.table(engagement)))
    )


class Standing(NamedTuple):
    post: DataFrame
    engagement: DataFrame


def tables(spark: SparkSession, database: str, tail: DataFrame | None = None, with_counters: bool = False) -> Standing:
    """The `post` and `engagement` tables: what stands, with the operations of a tail that
    have not been taken in yet. Of the two only the tail is shuffled."""
    was = current(spark, database)
    if was is None:
        if tail is None:
            raise ValueError(f"there are no standing tables in {database}")
        return Standing(fold.fold_posts(tail), fold.fold_engagement(tail))
    posts, engagement = spark.table(was.post_state), spark.table(was.engagement_state)
    counts = spark.table(was.subject_counts)
    if tail is not None:
        if was.settled is not None:
            tail = tail.where(F.col("seq") > was.settled)
        before = posts, engagement
        posts = merge.merged_posts(posts, merge.post_state(tail))
        engagement = merge.merged_engagement(engagement, merge.engagement_state(tail))
        if with_counters:
            # Texts move once: what is counted comes from a merge of its own without them.
            outline = merge.post_outline(before[0])
            now = merge.merged_posts(outline, merge.post_state(tail, merge.OUTLINE))
            moved = merge.moves(merge.post_facts(outline), merge.post_facts(now)).unionByName(
                merge.moves(merge.engagement_facts(before[1]), merge.engagement_facts(engagement))
            )
            counts = merge.merged_counts(counts, merge.count_changes(moved))
    if not with_counters:
        return Standing(merge.post_table(posts), merge.engagement_table(engagement))
    return Standing(merge.counted(posts, counts), merge.engagement_table(engagement))


def totals(spark: SparkSession, database: str) -> DataFrame:
    """name (post, repost, like) and n, without reading the tables."""
    return spark.table(current(spark, database).totals).where("n <> 0")
