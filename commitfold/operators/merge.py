"""Standing tables: states that take in the operations that came since.

A state is a row per uri with what a later operation may still ask for:

* post: the first create and the last delete, whichever of them are known;
* engagement: the last delete, and the creates that are not before it, in order. The
  first of them is the row of the table.

States combine: `merged(state(a), state(b)) == state(a + b)` for any two parts of a
stream, in any order and with operations delivered twice. `settled` is a position up to
which the stream has been taken in whole. Nothing at or before it can come for the first
time, so of the creates up to there the first stays, and a delete up to there that has no
row left is forgotten; a tail must then leave out what is not after the position settled
before (`sources.base.advance` does). Without it all of them are kept.

The base is laid out in buckets by uri (`sources.base`), and the join that takes in a tail
moves the tail only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions import times
from . import counters, fold

KEY = ["uri_hash", "uri"]
_POST = ("cid", "createdAt", "author", "text", "rootUri", "rootCid", "linkUrl", "linkTitle", "linkDescription")
OUTLINE = ("rootUri",)
_ENGAGEMENT = ("cid", "subjectUri", "subjectCid", "type", "createdAt", "author")


def _create(payload: tuple[str, ...]) -> Column:
    return F.struct("seq", "op_idx", "ingested_us", *payload)


def _keyed(log: DataFrame) -> DataFrame:
    return log.withColumn("uri_hash", F.xxhash64("uri"))


def _is(action: str) -> Column:
    return F.col("action") == action


# --- posts -------------------------------------------------------------------------


def post_state(log: DataFrame, payload: tuple[str, ...] = _POST) -> DataFrame:
    """uri_hash, uri, `first` (the first create) and `gone` (the last delete, its earliest
    delivery); either may be null. One shuffle, combined before it. A minimum over a struct
    cannot be pruned, so what is not needed must not be in `payload`."""
    return (
        _keyed(fold.posts_of(log))
        .groupBy(*KEY)
        .agg(
            F.min(F.when(_is("create"), _create(payload))).alias("first"),
            F.max(F.when(_is("delete"), F.struct("seq", (-F.col("ingested_us")).alias("neg_us")))).alias("gone"),
        )
    )


def merged_posts(base: DataFrame, tail: DataFrame) -> DataFrame:
    """The base with the state of a tail."""
    joined = _joined(base, tail)
    return joined.select(
        *KEY, F.least("base.first", "tail.first").alias("first"), F.greatest("base.gone", "tail.gone").alias("gone")
    )


def post_outline(state: DataFrame) -> DataFrame:
    """A stored post state as `post_state(log, OUTLINE)` gives it, read without texts."""
    first = F.struct(*[F.col(f"first.{c}") for c in ("seq", "op_idx", "ingested_us", *OUTLINE)])
    return state.select(*KEY, F.when(F.col("first.seq").isNotNull(), first).alias("first"), "gone")


def _joined(base: DataFrame, tail: DataFrame) -> DataFrame:
    sides = [
        df.select(*KEY, F.struct(*[c for c in df.columns if c not in KEY]).alias(name))
        for df, name in ((base, "base"), (tail, "tail"))
    ]
    return sides[0].join(sides[1], KEY, "full")


def _deleted_seq(first: str, gone: str) -> Column:
    return F.col(f"{gone}.seq") > F.col(f"{first}.seq")


def post_table(state: DataFrame) -> DataFrame:
    """The `post` table of a state, counters at zero."""
    return _post_rows(state, [F.lit(0).alias(c) for c in counters.COUNTERS])


def _post_rows(state: DataFrame, counts: list[Column]) -> DataFrame:
    made = {
        "indexedAt": times.iso_millis(F.col("first.ingested_us")),
        "deletedAt": F.when(_deleted_seq("first", "gone"), times.iso_millis(-F.col("gone.neg_us"))),
        "uri": F.col("uri"),
    }
    names = [f.name for f in S.POST_TABLE.fields[: -len(counts)]]
    rows = state.where(F.col("first").isNotNull())
    return rows.select(*[made.get(n, F.col(f"first.{n}")).alias(n) for n in names], *counts)


# --- engagement --------------------------------------------------------------------


def engagement_state(log: DataFrame, settled: int | None = None, split: int = fold.SPLIT) -> DataFrame:
    """uri_hash, uri, `gone` (seq of the last delete) and `creates`, in order.

    A uri is split along `seq` as in the fold, so one that holds any share of the log meets
    in no single place; what its parts leave is a create each, and those past `settled`.
    """
    log = _keyed(fold.engagement_of(log)).withColumn("part", F.expr(f"seq div {split}"))
    deletes = log.where(_is("delete")).groupBy(*KEY).agg(F.max("seq").alias("gone"))
    part = [*KEY, "part"]
    # One delivery of each create, before the rows of a uri meet.
    once = log.where(_is("create")).groupBy(*part, "seq", "op_idx").agg(F.min(F.struct("ingested_us", *_ENGAGEMENT)).alias("c"))
    by_part = deletes.withColumn("part", F.expr(f"gone div {split}"))
    alive = once.join(by_part, part, "left").where(F.col("seq") >= F.coalesce("gone", F.lit(-1)))
    create = F.struct("seq", "op_idx", "c.*")
    old = F.lit(False) if settled is None else F.col("seq") <= settled
    parts = alive.groupBy(*part).agg(F.min(F.when(old, create)).alias("first"), F.collect_list(F.when(~old, create)).alias("later"))
    kept = parts.join(by_part.select(*KEY, F.col("part").alias("from_part")), KEY, "left")
    kept = kept.where(F.col("part") >= F.coalesce("from_part", F.lit(0)))
    creates = kept.groupBy(*KEY).agg(F.min("first").alias("first"), F.flatten(F.collect_list("later")).alias("later"))
    known = _both(F.array_compact(F.array("first")), F.col("later"))
    return creates.join(deletes, KEY, "full").select(*KEY, "gone", _in_order(known, F.col("gone"), settled).alias("creates"))


def _both(a: Column, b: Column) -> Column:
    return F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array()))


def _in_order(creates: Column, gone: Column, settled: int | None) -> Column:
    """Creates not before the last delete, by position and once each, the earliest delivery
    first; of those up to `settled` only the first."""
    alive = F.sort_array(F.filter(creates, lambda c: c["seq"] >= F.coalesce(gone, F.lit(-1))))
    before = lambda i: F.get(alive, i - 1)
    again = lambda c, i: (before(i)["seq"] == c["seq"]) & (before(i)["op_idx"] == c["op_idx"])
    old = (lambda c: F.lit(False)) if settled is None else (lambda c: c["seq"] <= settled)
    return F.filter(alive, lambda c, i: (i == 0) | (~again(c, i) & ~old(c)))


def merged_engagement(base: DataFrame, tail: DataFrame, settled: int | None = None) -> DataFrame:
    """The base with the state of a tail."""
    joined = _joined(base, tail)
    gone = F.greatest("base.gone", "tail.gone")
    return joined.select(
        *KEY,
        gone.alias("gone"),
        _in_order(_both(F.col("base.creates"), F.col("tail.creates")), gone, settled).alias("creates"),
    )


def engagement_table(state: DataFrame) -> DataFrame:
    """The `engagement` table of a state."""
    first = F.get("creates", F.lit(0))
    made = {"uri": F.col("uri"), "indexedAt": times.iso_millis(first["ingested_us"])}
    rows = state.where(F.size("creates") > 0)
    return rows.select(*[made.get(f.name, first[f.name]).alias(f.name) for f in S.ENGAGEMENT_TABLE.fields])


# --- what a tail changes ---------------------------------------------------------------


def post_facts(state: DataFrame) -> DataFrame:
    """What counters and totals ask of stored posts, read without their texts: type, and the
    subject of a live reply."""
    live = ~F.coalesce(F.col("gone.seq") > F.col("first.seq"), F.lit(False))
    there = state.where(F.col("first.seq").isNotNull())
    return there.select(*KEY, F.lit("post").alias("type"), F.when(live & (F.col("first.rootUri") != ""), F.col("first.rootUri")).alias("subject"))


def engagement_facts(state: DataFrame) -> DataFrame:
    """The same of stored engagement: type and subject of the row."""
    kind = F.get("creates.type", F.lit(0))
    name = F.when(kind == S.TYPE_LIKE, "like").when(kind == S.TYPE_REPOST, "repost")
    return state.where(F.size("creates.seq") > 0).select(*KEY, name.alias("type"), F.get("creates.subjectUri", F.lit(0)).alias("subject"))


def moves(before: DataFrame | None, now: DataFrame) -> DataFrame:
    """type, subject and sign: rows that are there now count one, rows that were there before
    one less, those that stayed as they were not at all. Facts of two versions in the same
    buckets meet without a shuffle."""
    if before is None:
        return now.select("type", "subject", F.lit(1).alias("sign"))
    both = _joined(before, now).where("not (base <=> tail)")
    sides = F.array(F.struct("tail.type", "tail.subject", F.lit(1).alias("sign")), F.struct("base.type", "base.subject", F.lit(-1).alias("sign")))
    return both.select(F.explode(sides).alias("m")).select("m.*").where("type is not null")


_COUNTED = {"comments_count": "post", "likes_count": "like", "repost_count": "repost"}


def count_changes(moved: DataFrame) -> DataFrame:
    """What moved rows add to the counters of each subject, and take back."""
    marks = [F.when(F.col("type") == _COUNTED[c], F.col("sign")).otherwise(0).cast("bigint") for c in counters.COUNTERS]
    named = moved.where("subject is not null")
    summed = named.groupBy(F.col("subject").alias("uri")).agg(*[F.sum(m).alias(c) for m, c in zip(marks, counters.COUNTERS, strict=True)])
    return _keyed(summed.where(" or ".join(f"{c} <> 0" for c in counters.COUNTERS)))


def total_changes(moved: DataFrame) -> DataFrame:
    """What moved rows add to the numbers of posts, reposts and likes: name, n."""
    return moved.groupBy(F.col("type").alias("name")).agg(F.sum("sign").alias("n"))


def merged_counts(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored counts (uri_hash, uri and the counters) with the changes; subjects that no
    row names any more are gone."""
    joined = _joined(base, changes)
    total = [(F.coalesce(f"base.{c}", F.lit(0)) + F.coalesce(f"tail.{c}", F.lit(0))).alias(c) for c in counters.COUNTERS]
    return joined.select(*KEY, *total).where(" or ".join(f"{c} <> 0" for c in counters.COUNTERS))


def merged_totals(base: DataFrame, changes: DataFrame) -> DataFrame:
    return base.select("name", "n").unionByName(changes.select("name", "n")).groupBy("name").agg(F.sum("n").alias("n"))


def counted(posts: DataFrame, counts: DataFrame) -> DataFrame:
    """The `post` table of a state with its counters; both sides lie in buckets by uri."""
    joined = posts.join(counts.select(*KEY, *counters.COUNTERS), KEY, "left")
    zero = [F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in counters.COUNTERS]
    return _post_rows(joined, zero)


def stored_posts(merged: DataFrame, settled: int | None = None) -> DataFrame:
    """The state to keep of a merge."""
    state = merged.select(*KEY, "first", "gone")
    return state if settled is None else state.where(F.col("first").isNotNull() | (F.col("gone.seq") > settled))


def stored_engagement(merged: DataFrame, settled: int | None = None) -> DataFrame:
    state = merged.select(*KEY, "gone", "creates")
    return state if settled is None else state.where((F.size("creates") > 0) | (F.col("gone") > settled))
