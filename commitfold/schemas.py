"""Explicit schemas and the fixed identifiers of the data model.

Nothing is ever inferred: readers always receive one of these schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Record type ids, engagement codes and limits are part of the data contract.
POST = "app.bsky.feed.post"
REPOST = "app.bsky.feed.repost"
LIKE = "app.bsky.feed.like"
COLLECTIONS = (POST, REPOST, LIKE)

EMBED_IMAGES = "app.bsky.embed.images"
EMBED_EXTERNAL = "app.bsky.embed.external"
EMBED_RECORD = "app.bsky.embed.record"
EMBED_RECORD_WITH_MEDIA = "app.bsky.embed.recordWithMedia"
SELF_LABELS = "com.atproto.label.defs#selfLabels"
FACET_MENTION = "app.bsky.richtext.facet#mention"
FACET_LINK = "app.bsky.richtext.facet#link"
FACET_TAG = "app.bsky.richtext.facet#tag"

TYPE_REPOST = 1
TYPE_LIKE = 2

CURSOR_EVERY = 20
MAX_OPS_PER_COMMIT = 200
MAX_BLOCK_BYTES = 1_000_000
MAX_BLOB_BYTES = 1_000_000
MAX_TEXT_BYTES = 3000
MAX_TEXT_GRAPHEMES = 300
MAX_LANGS = 3
MAX_TAGS = 8
MAX_TAG_BYTES = 640
MAX_TAG_GRAPHEMES = 64
MAX_IMAGES = 4
MAX_LABELS = 10
MAX_LABEL_BYTES = 128
# ----------------------------------------------------------------------------

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


REPO_OP = _struct(("action", S), ("path", S), ("cid", S))

# One row per landed frame; the columns of every frame kind side by side.
FRAME = _struct(
    ("kind", S),
    ("seq", L),
    ("rebase", B),
    ("tooBig", B),
    ("repo", S),
    ("commit", S),
    ("prev", S),
    ("rev", S),
    ("since", S),
    ("records", T.MapType(S, S)),
    ("blocks", T.BinaryType()),
    ("ops", T.ArrayType(REPO_OP)),
    ("blobs", T.ArrayType(S)),
    ("time", S),
    ("did", S),
    ("handle", S),
    ("migrateTo", S),
    ("name", S),
    ("message", S),
)
CORRUPT = "_corrupt"
FRAME_WITH_CORRUPT = T.StructType([*FRAME.fields, T.StructField(CORRUPT, S)])

# The typed operation log: one row per accepted create or delete.
OPS = _struct(
    ("target", S),
    ("seq", L),
    ("op_idx", I),
    ("action", S),
    ("collection", S),
    ("uri", S),
    ("author", S),
    ("ingested_us", L),
    ("cid", S),
    ("createdAt", S),
    ("text", S),
    ("rootUri", S),
    ("rootCid", S),
    ("linkUrl", S),
    ("linkTitle", S),
    ("linkDescription", S),
    ("type", I),
    ("subjectUri", S),
    ("subjectCid", S),
)

POST_TABLE = _struct(
    ("uri", S, False),
    ("cid", S, False),
    ("indexedAt", S, False),
    ("createdAt", S, False),
    ("deletedAt", S),
    ("author", S, False),
    ("text", S, False),
    ("rootUri", S, False),
    ("rootCid", S, False),
    ("linkUrl", S, False),
    ("linkTitle", S, False),
    ("linkDescription", S, False),
    ("likes_count", I),
    ("repost_count", I),
    ("comments_count", I),
)

ENGAGEMENT_TABLE = _struct(
    ("uri", S, False),
    ("cid", S, False),
    ("subjectUri", S, False),
    ("subjectCid", S, False),
    ("type", I, False),
    ("indexedAt", S, False),
    ("createdAt", S, False),
    ("author", S, False),
)

SUB_STATE_TABLE = _struct(("service", S, False), ("cursor", L, False))

TABLES = {
    "post": POST_TABLE,
    "engagement": ENGAGEMENT_TABLE,
    "sub_state": SUB_STATE_TABLE,
}
