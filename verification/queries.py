"""One entry per operator: `name -> (spark, folder) -> DataFrame`.

All of them run over the whole given tables, seen as a commit stream by
`commitfold.sources.events`. Lookups take their argument from the data (the most
engaged subject, the busiest author, ...), read as one row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from commitfold import schemas as S
from commitfold.functions import formats, recode, text as tx
from commitfold.operators import analysis, counters, fold, lookups, ops, quality
from commitfold.plans import collect, report
from commitfold.session import shuffles_dropped, work_folder
from commitfold.sources import base, frames as frame_source, progress, tables, text_index
from commitfold.streaming import collector, keyed

from . import events

Query = Callable[[SparkSession, str], DataFrame]

SERVICE = "events"
RANGE = ("2024-01-01T00:01:00.000Z", "2024-01-01T00:03:00.000Z")
TERMS = "kind signup"

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _post(spark: SparkSession, folder: str) -> DataFrame:
    return fold.fold_posts(events.event_log(spark, folder))


def _textless(spark: SparkSession, folder: str) -> DataFrame:
    return events.event_log(spark, folder, text=False)


def _post_times(spark: SparkSession, folder: str) -> DataFrame:
    return fold.fold_post_columns(_textless(spark, folder))


def _engagement(spark: SparkSession, folder: str) -> DataFrame:
    return fold.fold_engagement(_textless(spark, folder))


def _frames(spark: SparkSession, folder: str) -> DataFrame:
    return events.event_frames(spark, folder)


def _frame_log(spark: SparkSession, folder: str) -> DataFrame:
    return ops.log_from_frames(_frames(spark, folder), ops.frame_instant())


def _written_frame_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log as a written table: frames are decoded once, folds read it often."""
    out = work_folder(spark, "log")
    collect.write_log(_frames(spark, folder), out, ops.frame_instant())
    return collect.read_log(spark, out)


def _busiest(df: DataFrame, column: str) -> str:
    """The most frequent value of a column; of equals the smallest."""
    return df.groupBy(column).count().orderBy(F.desc("count"), column).first()[column]


# --- operations of the typed log ------------------------------------------------


@query
def ops_exploded(spark, folder):
    log = events.event_log(spark, folder)
    return log.select("target", "seq", "op_idx", "action", "collection", "uri", "author", "cid")


@query
def ops_by_collection_action(spark, folder):
    return _textless(spark, folder).groupBy("collection", "action").agg(F.count(F.lit(1)).alias("n"))


# --- state fold -----------------------------------------------------------------


@query
def post_state(spark, folder):
    return _post(spark, folder)


@query
def engagement_state(spark, folder):
    return _engagement(spark, folder)


@query
def engagement_state_split(spark, folder):
    """The same fold with every uri split into many parts."""
    return fold.fold_engagement(events.event_log(spark, folder), split=3)


@query
def compacted_post_state(spark, folder):
    return fold.fold_posts(fold.compact_posts(events.event_log(spark, folder)))


@query
def compacted_engagement_state(spark, folder):
    return fold.fold_engagement(fold.compact_engagement(_textless(spark, folder)))


@query
def compacted_log(spark, folder):
    log = fold.compact(events.event_log(spark, folder))
    return log.select("target", "action", "uri", "seq")


@query
def post_deleted(spark, folder):
    return analysis.deleted(_post(spark, folder))


@query
def post_live(spark, folder):
    return analysis.live(_post(spark, folder)).select("uri", "author", "indexedAt")


# --- standing tables --------------------------------------------------------------

BUCKETS = 8  # at least; `events.parts` bounds what one holds


def _standing(spark: SparkSession, folder: str, log: DataFrame, name: str) -> str:
    """The standing tables of a log that came in three parts, the second of which repeats
    the end of the first; `settled` positions are known for the first two."""
    database = f"{name}_{uuid.uuid4().hex[:8]}"
    last, buckets = events.last_seq(spark, folder), events.parts(spark, folder, BUCKETS)
    cuts = [last // 2, last * 4 // 5, last]
    for i, upto in enumerate(cuts):
        after = cuts[i - 1] - 200 if i else -1
        part = log.where((F.col("seq") > after) & (F.col("seq") <= upto))
        base.advance(part, database, buckets, settled=upto if i < 2 else None)
    return database


@query
def merged_post_state(spark, folder):
    return base.tables(spark, _standing(spark, folder, events.event_log(spark, folder), "merged")).post


@query
def merged_engagement_state(spark, folder):
    return base.tables(spark, _standing(spark, folder, _textless(spark, folder), "merged")).engagement


@query
def maintained_counters(spark, folder):
    database = _standing(spark, folder, _textless(spark, folder), "counted")
    return base.tables(spark, database, with_counters=True).post.select("uri", *counters.COUNTERS)


@query
def maintained_totals(spark, folder):
    """Rows per type of post and engagement, kept up to date and not counted."""
    return base.totals(spark, _standing(spark, folder, _textless(spark, folder), "totals"))


@query
def standing_posts_with_tail(spark, folder):
    """Half of the log stands; the other half comes with the read, counters included."""
    log = events.event_log(spark, folder)
    database = f"tail_{uuid.uuid4().hex[:8]}"
    half = events.last_seq(spark, folder) // 2
    base.advance(log.where(F.col("seq") <= half), database, events.parts(spark, folder, BUCKETS))
    return base.tables(spark, database, log.where(F.col("seq") > half), with_counters=True).post


@query
def resumed_posts(spark, folder):
    """Two runs of the batch job, the second from the position that the first has saved."""
    landed, out, database = _frames(spark, folder), work_folder(spark, "resumed"), f"resumed_{uuid.uuid4().hex[:8]}"
    half = ops.commits(landed).agg(F.max("seq").alias("last")).first()["last"] // 2
    for part in (landed.where(F.col("seq") <= half), landed):
        collect.resume(part, out, database, events.parts(spark, folder, BUCKETS), SERVICE, ops.frame_instant())
    return base.tables(spark, database, with_counters=True).post


@query
def observed_position(spark, folder):
    """The position that is observed while the log is written."""
    cursor = collect.write_log(_frames(spark, folder), work_folder(spark, "observed"), ops.frame_instant())
    return spark.createDataFrame([(SERVICE, cursor)], S.SUB_STATE_TABLE)


# --- analysis report ------------------------------------------------------------


@query
def post_count(spark, folder):
    return analysis.row_count(_post_times(spark, folder))


@query
def post_sample(spark, folder):
    return analysis.sample(_post(spark, folder), order_by="uri", keys=_post_times(spark, folder))


@query
def post_sample_limited(spark, folder):
    """A sample smaller than the table."""
    return analysis.sample(_post(spark, folder), n=100, order_by="uri", keys=_post_times(spark, folder))


@query
def engagement_by_type(spark, folder):
    return analysis.engagement_by_type(_engagement(spark, folder))


@query
def engagement_type_names(spark, folder):
    return _engagement(spark, folder).select("uri", recode.engagement_name(F.col("type")).alias("type"))


@query
def deletion_lifetime(spark, folder):
    return analysis.deletion_lifetime(_post_times(spark, folder))


@query
def lifetime_histogram(spark, folder):
    return analysis.histogram(analysis.deletion_lifetime(_post_times(spark, folder)), "time_online_int_clean")


@query
def histogram_max(spark, folder):
    return analysis.max_count(lifetime_histogram(spark, folder))


@query
def histogram_marks(spark, folder):
    return analysis.histogram_marks(lifetime_histogram(spark, folder))


@query
def frame_report_by_type(spark, folder):
    """The report's type count on the tables collected from frames."""
    tabs = collect.fold_log(_written_frame_log(spark, folder))
    return report.report(tabs.post, tabs.engagement)["engagement_by_type"]


# --- tables, constraints, progress ----------------------------------------------


@query
def table_inventory(spark, folder):
    log = _textless(spark, folder)
    state = progress.checkpoint_position(_frames(spark, folder), SERVICE)
    return tables.inventory(
        {"post": fold.fold_post_columns(log), "engagement": fold.fold_engagement(log), "sub_state": state}
    )


@query
def table_constraints(spark, folder):
    log = events.event_log(spark, folder)
    return quality.constraint_report(fold.fold_posts(log), "post").unionByName(
        quality.constraint_report(fold.fold_engagement(log), "engagement")
    )


@query
def log_constraints(spark, folder):
    """The constraints of the tables, asked of the log's rows as they come: created again
    under one uri, and deletes, which have no content."""
    log = events.event_log(spark, folder)
    report_of = lambda rows, name: quality.constraint_report(
        rows.select(*[F.col(f.name) if f.name in rows.columns else F.col("createdAt").alias(f.name) for f in S.TABLES[name].fields]), name
    )
    post = report_of(fold.posts_of(log), "post")
    return post.unionByName(report_of(fold.engagement_of(log), "engagement"))


@query
def cursor_progress(spark, folder):
    return progress.checkpoint_position(_frames(spark, folder), SERVICE)


@query
def frames_after_cursor(spark, folder):
    """Batch resumption from the position saved half way through the stream."""
    commits = ops.commits(_frames(spark, folder))
    half = commits.agg(F.max("seq").alias("last")).first()["last"] // 2
    state = progress.checkpoint_position(commits.where(F.col("seq") <= half), SERVICE)
    return progress.after_cursor(commits, state, SERVICE).select("seq", "repo", "rev", "time")


@query
def catalog_tables(spark, folder):
    """The tables as the catalog lists them, filled from the log, with their rows."""
    database = f"catalog_{uuid.uuid4().hex[:8]}"
    tables.create(spark, database)
    log = events.event_log(spark, folder)
    tables.insert(fold.fold_posts(log), database, "post")
    tables.insert(fold.fold_engagement(log), database, "engagement")
    tables.insert(progress.checkpoint_position(_frames(spark, folder), SERVICE), database, "sub_state")
    listed = tables.catalog(spark, database)
    counted = tables.inventory({name: spark.table(f"{database}.{name}") for name in tables.list_tables(spark, database)})
    return listed.join(counted, "table_name")


# --- counters and lookups -------------------------------------------------------


@query
def post_counters(spark, folder):
    return collect.fold_log(events.event_log(spark, folder), with_counters=True).post


@query
def post_counters_with_deleted(spark, folder):
    log = _textless(spark, folder)
    full = counters.with_counters(fold.fold_posts(log), fold.fold_engagement(log), include_deleted=True)
    return full.select("uri", *counters.COUNTERS)


@query
def subject_counts(spark, folder):
    log = _textless(spark, folder)
    return counters.subject_counts(fold.fold_post_columns(log, ("rootUri",)), fold.fold_engagement(log))


@query
def subject_engagement(spark, folder):
    engagement = _engagement(spark, folder)
    return lookups.subject_engagement(engagement, _busiest(engagement, "subjectUri"))


@query
def subject_engagement_by_type(spark, folder):
    engagement = _engagement(spark, folder)
    return lookups.subject_engagement(engagement, _busiest(engagement, "subjectUri"), S.TYPE_LIKE)


@query
def posts_created_in_range(spark, folder):
    return lookups.created_between(_post(spark, folder), *RANGE)


@query
def posts_created_in_instant_range(spark, folder):
    post = fold.fold_posts(_frame_log(spark, folder))
    return lookups.created_between(post, *RANGE, by_instant=True).select("uri", "createdAt")


@query
def live_posts_in_range(spark, folder):
    return lookups.live_created_between(_post(spark, folder), *RANGE)


@query
def posts_indexed_in_range(spark, folder):
    return lookups.indexed_between(_post(spark, folder), *RANGE)


def _laid_out(spark: SparkSession, df: DataFrame, name: str, column: str) -> DataFrame:
    """A stored copy of a table, laid out to be searched by a column."""
    path = work_folder(spark, f"{name}-by-{column}")
    tables.write(df, name, path, search_by=column, files=BUCKETS)
    return tables.read(spark, name, path)


@query
def author_posts_stored(spark, folder):
    post = _laid_out(spark, _post(spark, folder), "post", "author")
    return lookups.author_posts(post, _busiest(post, "author"))


@query
def author_feed_stored(spark, folder):
    post = _laid_out(spark, _post(spark, folder), "post", "author")
    return lookups.author_feed(post, _busiest(post, "author"))


@query
def thread_posts_stored(spark, folder):
    post = _laid_out(spark, _post(spark, folder), "post", "rootUri")
    return lookups.thread(post, _busiest(post.where("rootUri <> ''"), "rootUri"))


@query
def posts_created_in_range_stored(spark, folder):
    return lookups.created_between(_laid_out(spark, _post(spark, folder), "post", "createdAt"), *RANGE)


@query
def posts_indexed_in_range_stored(spark, folder):
    return lookups.indexed_between(_laid_out(spark, _post(spark, folder), "post", "indexedAt"), *RANGE)


@query
def subject_engagement_stored(spark, folder):
    engagement = _laid_out(spark, _engagement(spark, folder), "engagement", "subjectUri")
    return lookups.subject_engagement(engagement, _busiest(engagement, "subjectUri"))


@query
def likes_of_subject_stored(spark, folder):
    engagement = _laid_out(spark, _engagement(spark, folder), "engagement", "subjectUri")
    return lookups.likes_of(engagement, _busiest(engagement, "subjectUri"))


@query
def posts_liked_by_actor_stored(spark, folder):
    """Posts in buckets by uri, engagement laid out by its author."""
    database = f"liked_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    tables.save_bucketed(_post(spark, folder), database, "post", BUCKETS)
    engagement = _laid_out(spark, _engagement(spark, folder), "engagement", "author")
    return lookups.liked_posts(spark.table(f"{database}.post"), engagement, _busiest(engagement, "author"))


def _indexed(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    path = work_folder(spark, "search")
    tables.write(fold.fold_posts(_frame_log(spark, folder)), "post", f"{path}/post")
    post = tables.read(spark, "post", f"{path}/post")
    text_index.build(post, f"{path}/index", BUCKETS)
    return post, f"{path}/index"


@query
def post_search_indexed(spark, folder):
    return text_index.search_posts(*_indexed(spark, folder), TERMS)


@query
def post_search_total_indexed(spark, folder):
    return text_index.search_total(*_indexed(spark, folder), TERMS)


@query
def author_posts(spark, folder):
    post = _post(spark, folder)
    return lookups.author_posts(post, _busiest(post, "author"))


@query
def thread_posts(spark, folder):
    post = _post(spark, folder)
    return lookups.thread(post, _busiest(post.where(F.col("rootUri") != ""), "rootUri"))


@query
def posts_by_uri(spark, folder):
    """The posts named most often as subjects, as an explicit list."""
    engagement = _engagement(spark, folder)
    top = engagement.groupBy("subjectUri").count().orderBy(F.desc("count"), "subjectUri").limit(lookups.MAX_URIS)
    return lookups.posts_by_uri(_post(spark, folder), [r["subjectUri"] for r in top.collect()])


@query
def likes_of_subject(spark, folder):
    engagement = _engagement(spark, folder)
    return lookups.likes_of(engagement, _busiest(engagement, "subjectUri"))


@query
def reposters_of_subject(spark, folder):
    engagement = _engagement(spark, folder)
    return lookups.reposted_by(engagement, _busiest(engagement, "subjectUri"))


@query
def posts_liked_by_actor(spark, folder):
    engagement = _engagement(spark, folder)
    return lookups.liked_posts(_post(spark, folder), engagement, _busiest(engagement, "author"))


@query
def author_feed(spark, folder):
    post = _post(spark, folder)
    return lookups.author_feed(post, _busiest(post, "author"))


@query
def author_feed_no_replies(spark, folder):
    post = _post(spark, folder)
    return lookups.author_feed(post, _busiest(post, "author"), "posts_no_replies")


@query
def post_search(spark, folder):
    return lookups.search_posts(fold.fold_posts(_frame_log(spark, folder)), TERMS)


@query
def post_search_total(spark, folder):
    return lookups.search_total(fold.fold_posts(_frame_log(spark, folder)), TERMS)


@query
def repo_records(spark, folder):
    post = _post(spark, folder)
    return lookups.repo_records(post, _busiest(post, "author"), S.POST, limit=3)


@query
def repo_records_next_page(spark, folder):
    post = _post(spark, folder)
    return lookups.repo_records(post, _busiest(post, "author"), S.POST, cursor="2", reverse=True, limit=3)


def _next_page(look: Callable[..., DataFrame], at: str, key: str) -> DataFrame:
    """The page after a first one of one row."""
    last = look(limit=1).collect()
    return look(limit=3, cursor=(last[-1][at], last[-1][key]) if last else None)


@query
def likes_of_subject_next_page(spark, folder):
    engagement = _engagement(spark, folder)
    look = partial(lookups.likes_of, engagement, _busiest(engagement, "subjectUri"))
    return _next_page(look, "indexedAt", "uri")


@query
def reposters_of_subject_next_page(spark, folder):
    engagement = _engagement(spark, folder)
    look = partial(lookups.reposted_by, engagement, _busiest(engagement, "subjectUri"))
    return _next_page(look, "indexedAt", "uri")


def _next_page_of_posts(look: Callable[..., DataFrame], spark: SparkSession, folder: str, at: str, key: str) -> DataFrame:
    """The same for a page of posts. It is chosen from posts without their texts; the posts
    of the page, a few uris, are then looked up with them."""
    outline = fold.fold_posts(_textless(spark, folder))
    last = look(outline, limit=1).collect()
    page = partial(look, limit=3, cursor=(last[-1][at], last[-1][key]) if last else None)
    uris = [r["uri"] for r in page(outline).collect()]
    return page(_post(spark, folder).where(F.col("uri").isin(uris)))


def _most(engagement: DataFrame, type: int) -> str:
    """The subject with the most rows of a type."""
    return _busiest(engagement.where(F.col("type") == type), "subjectUri")


@query
def likes_of_most_liked_next_page(spark, folder):
    engagement = _engagement(spark, folder)
    look = partial(lookups.likes_of, engagement, _most(engagement, S.TYPE_LIKE))
    return _next_page(look, "indexedAt", "uri")


@query
def reposters_of_most_reposted_next_page(spark, folder):
    engagement = _engagement(spark, folder)
    look = partial(lookups.reposted_by, engagement, _most(engagement, S.TYPE_REPOST))
    return _next_page(look, "indexedAt", "uri")


@query
def posts_liked_by_actor_next_page(spark, folder):
    engagement = _engagement(spark, folder)
    look = partial(lookups.liked_posts, engagement=engagement, actor=_busiest(engagement, "author"))
    return _next_page_of_posts(look, spark, folder, "likedAt", "likeUri")


@query
def author_feed_next_page(spark, folder):
    author = _busiest(fold.fold_post_columns(_textless(spark, folder), ("author",)), "author")
    return _next_page_of_posts(partial(lookups.author_feed, author=author), spark, folder, "indexedAt", "uri")


@query
def post_search_next_page(spark, folder):
    post = fold.fold_posts(_frame_log(spark, folder))
    return _next_page(partial(lookups.search_posts, post, TERMS), "indexedAt", "uri")


# --- text, formats --------------------------------------------------------------


@query
def sanitized_text(spark, folder):
    """Whole documents with their blanks turned into NUL characters, cleaned."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    dirty = F.when(F.col("doc_id") % 10 != 0, F.replace("text", F.lit(" "), F.chr(F.lit(0))))
    return documents.select("doc_id", tx.sanitize(dirty).alias("text"))


@query
def text_lengths(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    text = F.col("text")
    return documents.select(
        "doc_id",
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        tx.graphemes(text).cast("bigint").alias("n_graphemes"),
        tx.within(text, S.MAX_TEXT_BYTES, S.MAX_TEXT_GRAPHEMES).alias("fits"),
    )


@query
def format_checks(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    return pages.select(
        "page_id",
        formats.uri(F.col("url")).alias("is_uri"),
        formats.at_uri(F.col("url")).alias("is_at_uri"),
        formats.handle(host).alias("host_is_handle"),
        formats.did(F.concat(F.lit("did:web:"), host)).alias("host_makes_did"),
        formats.nsid(host).alias("host_is_nsid"),
    )


# --- frames ---------------------------------------------------------------------


@query
def frame_violations(spark, folder):
    return ops.frame_violations(_frames(spark, folder)).select("kind", "seq", "reason")


@query
def valid_frames_by_kind(spark, folder):
    return ops.valid_frames(_frames(spark, folder)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def frame_ops(spark, folder):
    """Operations of the valid commits, all actions and collections."""
    exploded = ops.explode_ops(ops.valid_frames(_frames(spark, folder)))
    return exploded.select(
        "seq", "op_idx", "author", "action", "uri", "collection", "cid", F.col("payload").isNotNull().alias("has_block")
    )


@query
def frame_ops_routed(spark, folder):
    """Accepted operations per table, action and collection."""
    return _frame_log(spark, folder).groupBy("target", "action", "collection").agg(F.count(F.lit(1)).alias("n"))


@query
def frame_log(spark, folder):
    return _frame_log(spark, folder)


@query
def frame_deletes(spark, folder):
    """Uris deleted per table, reposts and likes together."""
    return _frame_log(spark, folder).where(F.col("action") == "delete").select("target", "uri", "seq", "op_idx")


@query
def validation_violations(spark, folder):
    found = ops.op_violations(ops.explode_ops(ops.valid_frames(_frames(spark, folder))))
    return found.select("seq", "op_idx", "uri", "collection", "reason")


@query
def violations_by_rule(spark, folder):
    return validation_violations(spark, folder).groupBy("collection", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def frame_post_state(spark, folder):
    return fold.fold_posts(_frame_log(spark, folder))


@query
def frame_engagement_state(spark, folder):
    return fold.fold_engagement(_written_frame_log(spark, folder))


@query
def backfilled_posts(spark, folder):
    """The whole batch job: frames to written log and tables, counters filled in."""
    out = work_folder(spark, "backfill")
    collect.backfill(_frames(spark, folder), out, ops.frame_instant())
    return tables.read(spark, "post", f"{out}/post")


@query
def backfilled_quarantine(spark, folder):
    out = work_folder(spark, "quarantine")
    collect.write_log(_frames(spark, folder), out, ops.frame_instant())
    return collect.read_quarantine(spark, out).select("seq", "op_idx", "uri", "collection", "reason")


# --- streaming ------------------------------------------------------------------


def _streamed(spark: SparkSession, folder: str, name: str) -> str:
    """Lands the frames as JSON files and runs the collector over them."""
    root = work_folder(spark, name)
    # One file per position range, so that batches follow the stream: three of them.
    landed, files = events.laid_out(spark, folder, _frames(spark, folder), 6)
    landed.write.json(f"{root}/landed")
    stream = frame_source.stream(spark, f"{root}/landed", files_per_batch=-(-files // 3))
    running = collector.start(stream, root, SERVICE, ops.frame_instant(), trigger={"availableNow": True})
    running.awaitTermination()
    collector.compact(spark, root, 1)
    return root


@query
def stream_post_state(spark, folder):
    return collector.tables(spark, _streamed(spark, folder, "stream")).post


@query
def stream_engagement_state(spark, folder):
    return collector.tables(spark, _streamed(spark, folder, "stream")).engagement


@query
def stream_standing_posts(spark, folder):
    """The stream's first batches taken into standing tables, the others read with them."""
    root, database = _streamed(spark, folder, "stream"), f"stream_{uuid.uuid4().hex[:8]}"
    base.advance(collector.log(spark, root, upto=0), database, events.parts(spark, folder, BUCKETS), batch=0)
    return collector.standing(spark, root, database, with_counters=True).post


@query
def stream_from_position(spark, folder):
    """The stream from a position half way on, by the source whose offset is the position."""
    root = work_folder(spark, "from-position")
    landed, _ = events.laid_out(spark, folder, _frames(spark, folder), 6)
    frame_source.write(landed, f"{root}/landed", "parquet")
    written = frame_source.read(spark, f"{root}/landed", "parquet")
    half = ops.commits(written).agg(F.max("seq").alias("last")).first()["last"] // 2
    stream = frame_source.stream_after(spark, f"{root}/landed", half)
    collector.start(stream, root, SERVICE, ops.frame_instant(), trigger={"availableNow": True}).awaitTermination()
    return collector.log(spark, root).select("target", "seq", "op_idx", "action", "uri", "cid")


COMMITS_PER_ENTRY = 32  # of the state store: some 60 operations, about as many uris or fewer


def _stateful(spark: SparkSession, folder: str, target: str) -> DataFrame:
    root = work_folder(spark, "keyed")
    # Dealt out at random, so that batches come in no order.
    files = events.parts(spark, folder, 6)
    dealt = events.event_log(spark, folder, text=target == "post", files=files)
    with shuffles_dropped(spark):
        dealt.write.option("compression", "zstd").parquet(f"{root}/log")
    log = spark.readStream.schema(S.OPS).option("maxFilesPerTrigger", -(-files // 2)).parquet(f"{root}/log")
    groups = events.last_seq(spark, folder) // COMMITS_PER_ENTRY + 1
    keyed.start(log, root, target, {"availableNow": True}, groups).awaitTermination()
    return keyed.table(spark, root, target)


@query
def stateful_post_state(spark, folder):
    return _stateful(spark, folder, "post")


@query
def stateful_engagement_state(spark, folder):
    return _stateful(spark, folder, "engagement")


@query
def stream_quarantine(spark, folder):
    root = _streamed(spark, folder, "stream")
    return collector.quarantine(spark, root).select("seq", "op_idx", "uri", "collection", "reason")


@query
def stream_position(spark, folder):
    return collector.positions(spark, _streamed(spark, folder, "stream"))
