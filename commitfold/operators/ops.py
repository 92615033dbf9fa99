"""Commit frames to the typed operation log.

Everything here is narrow: no shuffle from the landed files to the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions import text as tx, times
from ..functions.built import built_once
from ..functions.variants import is_string, string_at
from . import rules

NOT_A_FRAME = "frame_unreadable"
UNREADABLE = "payload_unreadable"
NO_CID = "cid_missing"
NO_BLOCK = "block_missing"


def commits(frames: DataFrame) -> DataFrame:
    """Commit frames only; every other kind is dropped."""
    return frames.where(F.col("kind") == "commit")


def frame_violations(frames: DataFrame) -> DataFrame:
    """One row per broken frame rule, with the frame's position.

    A line the reader could not parse at all is reported under its own name.
    """
    if S.CORRUPT not in frames.columns:
        frames = frames.withColumn(S.CORRUPT, F.lit(None).cast("string"))
    line = F.col(S.CORRUPT)
    broken = F.when(line.isNotNull(), F.array(F.lit(NOT_A_FRAME))).otherwise(_frame_reasons())
    return frames.select("kind", "seq", F.explode(broken).alias("reason"), line.alias("payload"))


@built_once
def _frame_reasons() -> Column:
    return rules.violations(rules.frame_rules())


@built_once
def _is_valid_frame() -> Column:
    return rules.all_hold(rules.frame_rules())


def valid_frames(frames: DataFrame) -> DataFrame:
    """Frames that break no rule; the others are skipped, the stream goes on."""
    if S.CORRUPT in frames.columns:
        frames = frames.where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)
    return frames.where(_is_valid_frame())


def judged_frames(frames: DataFrame) -> DataFrame:
    """All frames with `frame_reasons`, the names of the broken frame rules (empty for a
    valid one, an unreadable line under its own name), worked out once."""
    if S.CORRUPT not in frames.columns:
        frames = frames.withColumn(S.CORRUPT, F.lit(None).cast("string"))
    none = F.array().cast("array<string>")
    unreadable = F.col(S.CORRUPT).isNotNull()
    broken = F.when(unreadable, F.array(F.lit(NOT_A_FRAME))).when(_is_valid_frame(), none).otherwise(_frame_reasons())
    return frames.select("*", F.explode(F.array(broken)).alias("frame_reasons"))


def landed_position() -> Column:
    """The position to save (`progress.checkpoint_position`) as an aggregate of judged frames."""
    due = (F.col("kind") == "commit") & (F.col("seq") % S.CURSOR_EVERY == 0) & (F.size("frame_reasons") == 0)
    return F.max(F.when(due, F.col("seq")))


def landed(judged: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Everything that is kept of judged frames, in one pass: the log columns, `reasons` and
    `payload` of tracked operations (target `quarantine` where a rule is broken), and a row
    with target `frame` and the frame's kind for each rejected frame.

    Every rule is asked once. To accept an operation all of them have to be, so a verdict
    before the names would save nothing and ask the others twice."""
    rejected = F.size("frame_reasons") > 0
    nothing = F.array(F.lit(None).cast(S.REPO_OP))
    listed = F.when(rejected, nothing).when(F.col("kind") == "commit", F.col("ops"))
    exploded = judged.select("kind", "seq", "repo", "time", "records", "frame_reasons", S.CORRUPT, F.posexplode(listed).alias("op_idx", "op"))
    kept = exploded.select(*_op_columns(), "kind", "frame_reasons", S.CORRUPT)
    kept = kept.where(rejected | _is_tracked())
    reasons = F.when(rejected, F.col("frame_reasons")).otherwise(_reasons())
    kept = with_record(kept).withColumn("reasons", reasons)
    broken = F.size("reasons") > 0
    payload = F.when(rejected, F.col(S.CORRUPT)).when(broken, F.col("payload"))
    target = F.when(F.size("frame_reasons") > 0, "frame").when(broken, "quarantine").otherwise(F.col("target"))
    out = to_log(kept, ingested, extra=["reasons", payload.alias("payload"), "kind", "frame_reasons"])
    return out.withColumn("target", target).drop("frame_reasons")


def explode_ops(frames: DataFrame) -> DataFrame:
    """One row per repository operation, keeping its position in the commit.

    The payload of a create is looked up by cid in the commit's own records.
    """
    exploded = commits(frames).select(
        "seq", "repo", "time", "records", F.posexplode("ops").alias("op_idx", "op")
    )
    return exploded.select(*_op_columns())


def _op_columns() -> list:
    path = F.col("op.path")
    return [
        "seq",
        "op_idx",
        F.col("repo").alias("author"),
        "time",
        F.col("op.action").alias("action"),
        tx.record_uri(F.col("repo"), path).alias("uri"),
        tx.collection_of(path).alias("collection"),
        F.col("op.cid").alias("cid"),
        F.when(F.col("op.action") == "create", F.try_element_at("records", F.col("op.cid"))).alias("payload"),
    ]


def tracked(ops: DataFrame) -> DataFrame:
    """Creates and deletes of the collected record types.

    Updates, unknown actions and other collections produce nothing. The type
    test is equality: the repost id also ends in "post".
    """
    return ops.where(_is_tracked())


def _is_tracked() -> Column:
    return F.col("action").isin("create", "delete") & F.col("collection").isin(*S.COLLECTIONS)


def with_record(ops: DataFrame) -> DataFrame:
    """Adds `rec`, the payload parsed once.

    The one-element explode is deliberate: a plain projection would be inlined
    into each of the rule expressions and into any filter on them, which parses
    the payload once per rule. A generated column is computed once per row.
    """
    return ops.withColumn("rec", F.explode(F.array(F.try_parse_json("payload"))))


@built_once
def _reasons() -> Column:
    """Names of the broken rules of one tracked operation, empty when accepted."""
    rec = F.col("rec")
    by_type = (
        F.when(F.col("collection") == S.POST, rules.violations(rules.post_rules(rec)))
        .when(F.col("collection") == S.REPOST, rules.violations(rules.repost_rules(rec)))
        .when(F.col("collection") == S.LIKE, rules.violations(rules.like_rules(rec)))
    )
    none = F.array().cast("array<string>")
    cid = F.col("cid")
    return (
        F.when(F.col("action") == "delete", none)
        .when(cid.isNull() | (cid == ""), F.array(F.lit(NO_CID)))
        .when(F.col("payload").isNull(), F.array(F.lit(NO_BLOCK)))
        .when(rec.isNull(), F.array(F.lit(UNREADABLE)))
        .otherwise(by_type)
    )


@built_once
def _is_valid() -> Column:
    """Same verdict as an empty `_reasons`, without naming what is broken."""
    rec = F.col("rec")
    by_type = (
        F.when(F.col("collection") == S.POST, rules.all_hold(rules.post_rules(rec)))
        .when(F.col("collection") == S.REPOST, rules.all_hold(rules.repost_rules(rec)))
        .when(F.col("collection") == S.LIKE, rules.all_hold(rules.like_rules(rec)))
    )
    readable = F.col("cid").isNotNull() & (F.col("cid") != "") & rec.isNotNull()
    return (F.col("action") == "delete") | (readable & by_type)


def op_violations(ops: DataFrame) -> DataFrame:
    """One row per broken rule of a tracked operation."""
    return with_record(tracked(ops)).select(
        "seq", "op_idx", "uri", "collection", F.explode(_reasons()).alias("reason"), "payload"
    )


def accepted(ops: DataFrame, ingested: Column | None = None) -> DataFrame:
    """The operation log (`schemas.OPS`): valid creates and all tracked deletes.

    `ingested` is the ingestion instant as a timestamp: the clock when live, the
    frame time for a backfill. Deletes are routed by collection alone.
    """
    kept = with_record(tracked(ops)).where(_is_valid())
    return to_log(kept, ingested)


def classified(ops: DataFrame, ingested: Column | None = None) -> DataFrame:
    """All tracked operations in one pass: the log columns plus `reasons` and
    `payload`, with target `quarantine` where a rule is broken.

    For writers that need accepted and rejected rows from a single scan.
    """
    judged = with_record(tracked(ops)).withColumn("reasons", _reasons())
    rejected = F.size("reasons") > 0
    return to_log(judged, ingested, extra=["reasons", F.when(rejected, F.col("payload")).alias("payload")]).withColumn(
        "target", F.when(F.size("reasons") > 0, "quarantine").otherwise(F.col("target"))
    )


@built_once
def _log_columns() -> list[Column]:
    """The log's columns but for the ingestion time, in order."""
    rec = F.col("rec")
    is_post = F.col("collection") == S.POST
    creates = F.col("action") == "create"

    def of_post(value: Column) -> Column:
        return F.when(is_post & creates, value)

    def of_engagement(value: Column) -> Column:
        return F.when(~is_post & creates, value)

    def text_or_empty(path: str) -> Column:
        return F.coalesce(string_at(rec, path), F.lit(""))

    # A link card counts when its address is a string, whatever the embed's type.
    has_card = is_string(rec, "$.embed.external.uri")

    def card(field: str) -> Column:
        return F.when(has_card, string_at(rec, f"$.embed.external.{field}"))

    return [
        F.when(is_post, "post").otherwise("engagement").alias("target"),
        F.col("seq"),
        F.col("op_idx").cast("int").alias("op_idx"),
        F.col("action"),
        F.col("collection"),
        F.col("uri"),
        F.col("author"),
        F.col("ingested_us"),
        F.col("cid"),
        F.when(creates, string_at(rec, "$.createdAt")).alias("createdAt"),
        of_post(tx.sanitize(string_at(rec, "$.text"))).alias("text"),
        of_post(text_or_empty("$.reply.root.uri")).alias("rootUri"),
        of_post(text_or_empty("$.reply.root.cid")).alias("rootCid"),
        of_post(F.coalesce(card("uri"), F.lit(""))).alias("linkUrl"),
        of_post(tx.sanitize(card("title"))).alias("linkTitle"),
        of_post(tx.sanitize(card("description"))).alias("linkDescription"),
        F.when(F.col("collection") == S.REPOST, S.TYPE_REPOST)
        .when(F.col("collection") == S.LIKE, S.TYPE_LIKE)
        .alias("type"),
        of_engagement(string_at(rec, "$.subject.uri")).alias("subjectUri"),
        of_engagement(string_at(rec, "$.subject.cid")).alias("subjectCid"),
    ]


def to_log(ops: DataFrame, ingested: Column | None = None, extra: list | None = None) -> DataFrame:
    """Projects operations with a `rec` column to the log's columns."""
    micros = F.unix_micros(F.current_timestamp() if ingested is None else ingested)
    return ops.withColumn("ingested_us", micros).select(*_log_columns(), *(extra or []))


def frame_instant() -> Column:
    """Ingestion instant of a backfill: the frame's own time."""
    return times.instant(F.col("time"))


def log_from_frames(frames: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Landed frames to the operation log."""
    return accepted(explode_ops(valid_frames(frames)), ingested)


def classified_from_frames(frames: DataFrame, ingested: Column | None = None) -> DataFrame:
    return classified(explode_ops(valid_frames(frames)), ingested)
