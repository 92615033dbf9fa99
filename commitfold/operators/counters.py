"""Counters of the `post` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import POST_TABLE, TYPE_LIKE, TYPE_REPOST

COUNTERS = ("likes_count", "repost_count", "comments_count")


def subject_counts(replies: DataFrame, engagement: DataFrame, include_deleted: bool = False) -> DataFrame:
    """Likes, reposts and comments per subject uri.

    Comments are the posts whose thread root is the subject, at any depth; only
    live ones unless `include_deleted`. Of the posts only `rootUri` and `deletedAt`
    are read. The three counts share one shuffle, and partial sums before it absorb
    popular subjects.
    """
    replies = replies.where(F.col("rootUri") != "")
    if not include_deleted:
        replies = replies.where(F.col("deletedAt").isNull())
    one = lambda cond: F.when(cond, 1).otherwise(0)
    marks = engagement.select(
        F.col("subjectUri").alias("uri"),
        one(F.col("type") == TYPE_LIKE).alias("likes_count"),
        one(F.col("type") == TYPE_REPOST).alias("repost_count"),
        F.lit(0).alias("comments_count"),
    ).unionByName(
        replies.select(
            F.col("rootUri").alias("uri"),
            F.lit(0).alias("likes_count"),
            F.lit(0).alias("repost_count"),
            F.lit(1).alias("comments_count"),
        )
    )
    return marks.groupBy("uri").agg(*[F.sum(c).alias(c) for c in COUNTERS])


def attach(post: DataFrame, counts: DataFrame) -> DataFrame:
    """The `post` table with its three counters filled in from `subject_counts`.

    Both sides are unique by uri, so no key can be hot in the join. Posts straight
    from the fold (with `uri_hash`) are already distributed for it.
    """
    key = ["uri_hash", "uri"] if "uri_hash" in post.columns else ["uri"]
    if len(key) > 1:
        counts = counts.withColumn("uri_hash", F.xxhash64("uri"))
    joined = post.drop(*COUNTERS).join(counts, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(f.name), F.lit(0)).cast("int").alias(f.name) if f.name in COUNTERS else f.name
            for f in POST_TABLE.fields
        ]
    )


def with_counters(post: DataFrame, engagement: DataFrame, include_deleted: bool = False) -> DataFrame:
    """Counters of written tables in one step."""
    return attach(post, subject_counts(post, engagement, include_deleted))
