"""Lookups by the access paths of the two tables.

Filters are plain comparisons on stored columns, so they reach the Parquet scan
(see `sources.tables` for the layout that makes them selective). `createdAt` is
whatever the client sent: as a string it orders lexicographically, which is what
the table's own order means; `by_instant` compares parsed instants instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as tx, times
from ..schemas import TYPE_LIKE, TYPE_REPOST

MAX_URIS = 25
DEFAULT_PAGE = 50
MAX_PAGE = 100
DEFAULT_HITS = 25


def _page(limit: int) -> int:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be within 1..{MAX_PAGE}, got {limit}")
    return limit


Cursor = tuple[str, str] | None


def _latest(found: DataFrame, at: str, key: str, cursor: Cursor, limit: int) -> DataFrame:
    """One page, latest first. The cursor is the (time, key) of the last row of the page
    before; rows up to it are left out before anything is sorted."""
    if cursor is not None:
        last_at, last_key = cursor
        found = found.where((F.col(at) < last_at) | ((F.col(at) == last_at) & (F.col(key) < last_key)))
    return found.orderBy(F.desc(at), F.desc(key)).limit(_page(limit))


# --- engagement ----------------------------------------------------------------


def subject_engagement(engagement: DataFrame, subject: str, type: int | None = None) -> DataFrame:
    found = engagement.where(F.col("subjectUri") == subject)
    return found if type is None else found.where(F.col("type") == type)


def actors_of(
    engagement: DataFrame,
    subject: str,
    type: int,
    cid: str | None = None,
    limit: int = DEFAULT_PAGE,
    cursor: Cursor = None,
) -> DataFrame:
    """Who engaged with a subject, latest first."""
    found = subject_engagement(engagement, subject, type)
    if cid is not None:
        found = found.where(F.col("subjectCid") == cid)
    found = found.select("author", "uri", "subjectUri", "indexedAt", "createdAt")
    return _latest(found, "indexedAt", "uri", cursor, limit)


def likes_of(
    engagement: DataFrame, subject: str, cid: str | None = None, limit: int = DEFAULT_PAGE, cursor: Cursor = None
) -> DataFrame:
    return actors_of(engagement, subject, TYPE_LIKE, cid, limit, cursor)


def reposted_by(
    engagement: DataFrame, subject: str, cid: str | None = None, limit: int = DEFAULT_PAGE, cursor: Cursor = None
) -> DataFrame:
    return actors_of(engagement, subject, TYPE_REPOST, cid, limit, cursor)


def liked_posts(
    post: DataFrame, engagement: DataFrame, actor: str, limit: int = DEFAULT_PAGE, cursor: Cursor = None
) -> DataFrame:
    """Collected posts an actor liked, latest first.

    The page is chosen from the uris alone; the columns of its posts, at most a page of
    them, are fetched afterwards. Of a post table in buckets by uri (`tables.save_bucketed`)
    nothing is shuffled.
    """
    likes = engagement.where((F.col("author") == actor) & (F.col("type") == TYPE_LIKE)).select(
        F.col("subjectUri").alias("uri"), F.col("indexedAt").alias("likedAt"), F.col("uri").alias("likeUri")
    )
    page = _latest(likes.join(post.select("uri"), "uri", "left_semi"), "likedAt", "likeUri", cursor, limit)
    found = post.select("uri", "author", "text").join(F.broadcast(page), "uri")
    return found.select("uri", "author", "text", "likedAt", "likeUri").orderBy(F.desc("likedAt"), F.desc("likeUri"))


# --- posts ---------------------------------------------------------------------


def posts_by_uri(post: DataFrame, uris: list[str]) -> DataFrame:
    """Posts of a short list of uris."""
    if len(uris) > MAX_URIS:
        raise ValueError(f"at most {MAX_URIS} uris, got {len(uris)}")
    return post.where(F.col("uri").isin(*uris))


def created_between(post: DataFrame, start: str, end: str, by_instant: bool = False) -> DataFrame:
    """Posts with `createdAt` in [start, end)."""
    if by_instant:
        at = times.instant(F.col("createdAt"))
        return post.where((at >= times.instant(F.lit(start))) & (at < times.instant(F.lit(end))))
    return post.where((F.col("createdAt") >= start) & (F.col("createdAt") < end))


def indexed_between(post: DataFrame, start: str, end: str) -> DataFrame:
    """Posts with `indexedAt` in [start, end)."""
    return post.where((F.col("indexedAt") >= start) & (F.col("indexedAt") < end))


def live_created_between(post: DataFrame, start: str, end: str) -> DataFrame:
    return created_between(post, start, end).where(F.col("deletedAt").isNull())


def author_posts(post: DataFrame, author: str) -> DataFrame:
    return post.where(F.col("author") == author)


def author_feed(
    post: DataFrame,
    author: str,
    filter: str = "posts_with_replies",
    limit: int = DEFAULT_PAGE,
    cursor: Cursor = None,
) -> DataFrame:
    """An author's live posts, latest first, with or without replies."""
    if filter not in ("posts_with_replies", "posts_no_replies"):
        raise ValueError(f"unsupported filter {filter!r}")
    found = author_posts(post, author).where(F.col("deletedAt").isNull())
    if filter == "posts_no_replies":
        found = found.where(F.col("rootUri") == "")
    return _latest(found, "indexedAt", "uri", cursor, limit)


def thread(post: DataFrame, root: str) -> DataFrame:
    """A thread, flat: its root and every post that names it as root."""
    return post.where((F.col("rootUri") == root) | (F.col("uri") == root))


def _matching(post: DataFrame, query: str) -> DataFrame:
    return post.where(F.col("deletedAt").isNull() & tx.contains_all(F.col("text"), query.split()))


def search_posts(post: DataFrame, query: str, limit: int = DEFAULT_HITS, cursor: Cursor = None) -> DataFrame:
    """Live posts containing every term of the query, ignoring case, latest first."""
    found = _matching(post, query).select("uri", "cid", "author", "text", "indexedAt")
    return _latest(found, "indexedAt", "uri", cursor, limit)


def search_total(post: DataFrame, query: str) -> DataFrame:
    return _matching(post, query).agg(F.count(F.lit(1)).alias("hits_total"))


def repo_records(
    table: DataFrame,
    repo: str,
    collection: str,
    cursor: str | None = None,
    reverse: bool = False,
    limit: int = DEFAULT_PAGE,
) -> DataFrame:
    """One page of a repository's records of a collection, by record key.

    Newest key first unless `reverse`; the cursor is the last key of the page
    before.
    """
    prefix = f"at://{repo}/{collection}/"
    rkey = tx.rkey_of(F.col("uri"))
    found = table.where(F.col("uri").startswith(prefix)).select("uri", "cid", rkey.alias("rkey"))
    if cursor is not None:
        found = found.where(F.col("rkey") > cursor if reverse else F.col("rkey") < cursor)
    order = F.asc("rkey") if reverse else F.desc("rkey")
    return found.orderBy(order).limit(_page(limit))
