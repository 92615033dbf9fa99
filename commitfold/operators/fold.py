"""Folding the operation log into the `post` and `engagement` tables.

Order of effects: commits by ascending `seq`; inside one commit all deletes act
before all creates. Hence a delete takes effect on a create only when its `seq`
is strictly greater.

* post: the first create wins for ever; the last delete after it sets
  `deletedAt`; re-creating never clears it.
* engagement: the first create at or after the last delete wins; without one
  there is no row.

Both folds depend on the set of operations only, not on row order, batch cuts or
redelivery, so `fold(compact(a) + b) == fold(a + b)` for any split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions import times

# Grouping by uri sorts by it, and all uris start alike. With the hash in front the
# sort compares numbers and looks at the text of equal hashes only.
_KEY = ("uri_hash", "uri")

# Commits in a part of a uri; a commit holds at most 200 operations.
SPLIT = 10_000

_POST_PAYLOAD = (
    "cid",
    "createdAt",
    "author",
    "text",
    "rootUri",
    "rootCid",
    "linkUrl",
    "linkTitle",
    "linkDescription",
)
_ENGAGEMENT_PAYLOAD = ("cid", "subjectUri", "subjectCid", "type", "createdAt", "author")


def _is_create() -> Column:
    return F.col("action") == "create"


def _is_delete() -> Column:
    return F.col("action") == "delete"


def _create(payload: Sequence[str]) -> Column:
    """A create as an ordered value: stream position first, then ingestion time
    (so the earliest delivery of a redelivered create is the one kept)."""
    return F.struct("seq", "op_idx", "ingested_us", *payload)


def _last_delete() -> Column:
    """Greatest delete position; of its redeliveries the earliest one."""
    return F.max(F.when(_is_delete(), F.struct("seq", (-F.col("ingested_us")).alias("neg_us"))))


def posts_of(log: DataFrame) -> DataFrame:
    return log.where(F.col("target") == "post")


def engagement_of(log: DataFrame) -> DataFrame:
    return log.where(F.col("target") == "engagement")


def _keyed(log: DataFrame) -> DataFrame:
    return log.withColumn("uri_hash", F.xxhash64("uri"))


def fold_posts(log: DataFrame, keep_hash: bool = False) -> DataFrame:
    """The `post` table. One shuffle by uri.

    Minimum and maximum are combined before the shuffle, so a uri holding any
    share of the log reaches its reducer as one row per map task. Works on a
    streaming log too (complete or update mode). `keep_hash` leaves the leading
    part of the distribution key in place for a join that follows.
    """
    folded = fold_post_columns(log, _POST_PAYLOAD)
    zero = [F.lit(0).alias(name) for name in ("likes_count", "repost_count", "comments_count")]
    names = [f.name for f in S.POST_TABLE.fields[: -len(zero)]]
    return folded.select(*(["uri_hash"] if keep_hash else []), *names, *zero)


def fold_post_columns(log: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """`uri`, `indexedAt`, `deletedAt` and the named columns of the folded posts.

    For analyses of a log that has not been folded into a written table: a minimum
    over a struct cannot be pruned, so what is not needed must not be in it.
    """
    state = (
        _keyed(posts_of(log))
        .groupBy(*_KEY)
        .agg(F.min(F.when(_is_create(), _create(payload))).alias("first"), _last_delete().alias("gone"))
        .where(F.col("first").isNotNull())
    )
    deleted = F.col("gone.seq") > F.col("first.seq")
    return state.select(
        *_KEY,
        times.iso_millis(F.col("first.ingested_us")).alias("indexedAt"),
        F.when(deleted, times.iso_millis(-F.col("gone.neg_us"))).alias("deletedAt"),
        *[f"first.{name}" for name in payload],
    )


def _last_deletes(log: DataFrame) -> DataFrame:
    """The greatest delete position of each uri, combined before its shuffle."""
    return log.where(_is_delete()).groupBy(*_KEY).agg(F.max("seq").alias("deleted_seq"))


def fold_engagement(log: DataFrame, split: int = SPLIT) -> DataFrame:
    """The `engagement` table.

    Every uri is split along `seq` into parts of `split` commits, so the rows that meet
    in one place are bounded by what that many commits can hold, however hot a uri is.
    A last delete decides inside its own part only: earlier parts drop out whole, and of
    a later part the first create is enough. What is left is one row per uri and part,
    and the smallest of those from the delete's part on is the answer.
    """
    log = _keyed(engagement_of(log)).withColumn("part", F.expr(f"seq div {split}"))
    deletes = _last_deletes(log).withColumn("part", F.expr(f"deleted_seq div {split}"))
    part = (*_KEY, "part")
    alive = log.where(_is_create()).join(deletes, [*part], "left").where(F.col("seq") >= F.coalesce("deleted_seq", F.lit(-1)))
    firsts = alive.groupBy(*part).agg(F.min(_create(_ENGAGEMENT_PAYLOAD)).alias("first"))
    from_part = deletes.select(*_KEY, F.col("part").alias("from_part"))
    kept = firsts.join(from_part, [*_KEY], "left").where(F.col("part") >= F.coalesce("from_part", F.lit(0)))
    return (
        kept.groupBy(*_KEY)
        .agg(F.min("first").alias("first"))
        .select(
            "uri",
            "first.cid",
            "first.subjectUri",
            "first.subjectCid",
            "first.type",
            times.iso_millis(F.col("first.ingested_us")).alias("indexedAt"),
            "first.createdAt",
            "first.author",
        )
    )


# --- compaction: a smaller log with the same folds ---------------------------


def _compact_deletes(log: DataFrame) -> DataFrame:
    """The last delete of each uri as a log row."""
    last = (
        _keyed(log.where(_is_delete()))
        .groupBy(*_KEY)
        .agg(F.max(F.struct("seq", (-F.col("ingested_us")).alias("neg_us"), "op_idx", "collection", "author")).alias("d"))
    )
    known = {
        "uri": F.col("uri"),
        "seq": F.col("d.seq"),
        "op_idx": F.col("d.op_idx"),
        "collection": F.col("d.collection"),
        "author": F.col("d.author"),
        "action": F.lit("delete"),
        "ingested_us": -F.col("d.neg_us"),
        "target": F.when(F.col("d.collection") == S.POST, "post").otherwise("engagement"),
        "type": F.when(F.col("d.collection") == S.REPOST, S.TYPE_REPOST).when(
            F.col("d.collection") == S.LIKE, S.TYPE_LIKE
        ),
    }
    return last.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.OPS.fields]
    )


def compact_posts(log: DataFrame) -> DataFrame:
    """At most two rows per uri: its first create and its last delete."""
    log = posts_of(log)
    payload = [f.name for f in S.OPS.fields if f.name not in ("uri", "seq", "op_idx", "ingested_us")]
    first = _keyed(log.where(_is_create())).groupBy(*_KEY).agg(F.min(_create(payload)).alias("first"))
    creates = first.select(*[("uri" if f.name == "uri" else f"first.{f.name}") for f in S.OPS.fields])
    return creates.unionByName(_compact_deletes(log))


def compact_engagement(log: DataFrame, split: int = SPLIT) -> DataFrame:
    """The last delete of each uri and every distinct create not before it.

    All such creates are kept, not only the first: a late operation with a smaller
    `seq` may still undo the earlier ones. A uri is split along `seq` as in the fold: its
    last delete comes to its own part, and earlier parts drop out by a row per part, so the
    creates of a hot uri meet in no one place.
    """
    log = engagement_of(log)
    deletes = _compact_deletes(log)
    key = ("uri", "seq", "op_idx")
    payload = [f.name for f in S.OPS.fields if f.name not in (*key, "ingested_us")]
    part = [*_KEY, "part"]
    keyed = _keyed(log).withColumn("part", F.expr(f"seq div {split}"))
    distinct = (
        keyed.where(_is_create())
        .groupBy(*part, "seq", "op_idx")
        .agg(F.min(F.struct("ingested_us", *payload)).alias("first"))
    )
    last = _last_deletes(keyed).withColumn("last_part", F.expr(f"deleted_seq div {split}"))
    # What the last delete says to each part that has creates: a row per uri and part.
    met = keyed.where(_is_create()).select(*part).distinct().join(last, [*_KEY])
    bounds = met.where(F.col("part") <= F.col("last_part")).select(*part, "deleted_seq")
    alive = distinct.join(bounds, part, "left").where(F.col("seq") >= F.coalesce("deleted_seq", F.lit(-1)))
    creates = alive.select(*[(f.name if f.name in key else f"first.{f.name}") for f in S.OPS.fields])
    return creates.unionByName(deletes)


def compact(log: DataFrame) -> DataFrame:
    return compact_posts(log).unionByName(compact_engagement(log))
