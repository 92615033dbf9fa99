"""Validation rules as column expressions.

A rule is a name and a condition that must hold. `violations` turns a list of
rules into one array column holding the names of those that do not.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F

from .. import schemas as S
from ..functions import formats, text as tx
from ..functions.variants import (
    absent,
    every,
    integer_where,
    is_string,
    optional,
    string_at,
    string_where,
)


class Rule(NamedTuple):
    name: str
    holds: Column


def violations(rules: list[Rule]) -> Column:
    broken = [F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.name)) for r in rules]
    return F.array_except(F.array(*broken), F.array(F.lit(None).cast("string")))


def all_hold(rules: list[Rule]) -> Column:
    """The conjunction of the rules; stops at the first broken one."""
    ok = F.lit(True)
    for rule in rules:
        ok = ok & F.coalesce(rule.holds, F.lit(False))
    return ok


# --- frames -----------------------------------------------------------------


def _all_present(*names: str) -> Column:
    ok = F.lit(True)
    for name in names:
        ok = ok & F.col(name).isNotNull()
    return ok


def _when_kind(kind: str, ok: Column) -> Column:
    return F.when(F.col("kind") == kind, F.coalesce(ok, F.lit(False))).otherwise(True)


def frame_rules() -> list[Rule]:
    """Landed frames. A frame of an unknown kind is acceptable (and unused)."""
    datetime_ok = formats.datetime(F.col("time"))
    commit = (
        _all_present("seq", "rebase", "tooBig", "repo", "commit", "rev", "records", "ops", "blobs", "time")
        & (F.size("ops") <= S.MAX_OPS_PER_COMMIT)
        & F.coalesce(F.octet_length("blocks") <= S.MAX_BLOCK_BYTES, F.lit(True))
        & formats.did(F.col("repo"))
        & datetime_ok
    )
    ops = F.forall("ops", lambda op: op["action"].isNotNull() & op["path"].isNotNull())
    did_ok = formats.did(F.col("did"))
    return [
        Rule("frame_kind", F.col("kind").isNotNull()),
        Rule("V01_commit", _when_kind("commit", commit)),
        Rule("V02_repo_op", _when_kind("commit", ops)),
        Rule(
            "V03_handle",
            _when_kind(
                "handle",
                _all_present("seq", "did", "handle", "time")
                & did_ok
                & formats.handle(F.col("handle"))
                & datetime_ok,
            ),
        ),
        Rule("V04_migrate", _when_kind("migrate", _all_present("seq", "did", "time") & did_ok & datetime_ok)),
        Rule("V05_tombstone", _when_kind("tombstone", _all_present("seq", "did", "time") & did_ok & datetime_ok)),
        Rule("V06_info", _when_kind("info", _all_present("name"))),
    ]


# --- records ----------------------------------------------------------------


def strong_ref(rec: Column, path: str) -> Column:
    return string_where(rec, f"{path}.uri", formats.at_uri) & string_where(rec, f"{path}.cid", formats.cid)


def _type_is(rec: Column, path: str, type_id: str) -> Column:
    """The discriminator names the type, with or without its `#main` suffix."""
    found = string_at(rec, f"{path}['$type']")
    return F.coalesce(found.isin(type_id, f"{type_id}#main"), F.lit(False))


def _open_union(rec: Column, path: str, cases: list[tuple[str, Column]]) -> Column:
    """An object with a `$type`; known types must pass their rule, others are open."""
    chain = None
    for type_id, ok in cases:
        here = _type_is(rec, path, type_id)
        chain = F.when(here, ok) if chain is None else chain.when(here, ok)
    return is_string(rec, f"{path}['$type']") & chain.otherwise(True)


def image_blob(rec: Column, path: str) -> Column:
    image = lambda mime: mime.like("image/%")
    typed = (
        _type_is(rec, path, "blob")
        & string_where(rec, f"{path}.mimeType", image)
        & integer_where(rec, f"{path}.size", lambda size: size <= S.MAX_BLOB_BYTES)
    )
    legacy = is_string(rec, f"{path}.cid") & string_where(rec, f"{path}.mimeType", image)
    return typed | legacy


def embed_external(rec: Column, path: str) -> Column:
    card = f"{path}.external"
    return (
        string_where(rec, f"{card}.uri", formats.uri)
        & is_string(rec, f"{card}.title")
        & is_string(rec, f"{card}.description")
        & optional(rec, f"{card}.thumb", image_blob(rec, f"{card}.thumb"))
    )


def embed_images(rec: Column, path: str) -> Column:
    positive = lambda n: n >= 1

    def image(item: Column) -> Column:
        ratio = integer_where(item, "$.aspectRatio.width", positive) & integer_where(
            item, "$.aspectRatio.height", positive
        )
        return image_blob(item, "$.image") & is_string(item, "$.alt") & optional(item, "$.aspectRatio", ratio)

    return every(rec, f"{path}.images", image, S.MAX_IMAGES)


def embed_record(rec: Column, path: str) -> Column:
    return strong_ref(rec, f"{path}.record")


def embed_record_with_media(rec: Column, path: str) -> Column:
    media = f"{path}.media"
    return embed_record(rec, f"{path}.record") & _open_union(
        rec,
        media,
        [
            (S.EMBED_IMAGES, embed_images(rec, media)),
            (S.EMBED_EXTERNAL, embed_external(rec, media)),
        ],
    )


def facet(item: Column) -> Column:
    at_least_zero = lambda n: n >= 0

    def feature(one: Column) -> Column:
        tag_ok = string_where(one, "$.tag", lambda t: tx.within(t, S.MAX_TAG_BYTES, S.MAX_TAG_GRAPHEMES))
        return _open_union(
            one,
            "$",
            [
                (S.FACET_MENTION, string_where(one, "$.did", formats.did)),
                (S.FACET_LINK, string_where(one, "$.uri", formats.uri)),
                (S.FACET_TAG, tag_ok),
            ],
        )

    return (
        integer_where(item, "$.index.byteStart", at_least_zero)
        & integer_where(item, "$.index.byteEnd", at_least_zero)
        & every(item, "$.features", feature)
    )


def entity(item: Column) -> Column:
    at_least_zero = lambda n: n >= 0
    return (
        integer_where(item, "$.index.start", at_least_zero)
        & integer_where(item, "$.index.end", at_least_zero)
        & is_string(item, "$.type")
        & is_string(item, "$.value")
    )


def _text_item(test):
    return lambda item: string_where(item, "$", test)


def _self_labels(rec: Column) -> Column:
    value = lambda item: string_where(
        item, "$.val", lambda v: F.octet_length(v) <= S.MAX_LABEL_BYTES
    )
    return _open_union(rec, "$.labels", [(S.SELF_LABELS, every(rec, "$.labels.values", value, S.MAX_LABELS))])


def _type_rule(rec: Column, type_id: str) -> Rule:
    return Rule("V24_type_id", string_where(rec, "$['$type']", lambda t: t == type_id))


def _created_at_rule(rec: Column) -> Rule:
    return Rule("V11_created_at", absent(rec, "$.createdAt") | string_where(rec, "$.createdAt", formats.datetime))


def post_rules(rec: Column) -> list[Rule]:
    """Rules of a post record. Absent required fields are V07's business alone."""
    in_embed = lambda type_id, ok: ~_type_is(rec, "$.embed", type_id) | ok
    reply_refs = ~absent(rec, "$.reply.root") & ~absent(rec, "$.reply.parent")
    return [
        _type_rule(rec, S.POST),
        Rule("V07_required", is_string(rec, "$.text") & ~absent(rec, "$.createdAt")),
        Rule(
            "V08_text_length",
            ~is_string(rec, "$.text")
            | tx.within(string_at(rec, "$.text"), S.MAX_TEXT_BYTES, S.MAX_TEXT_GRAPHEMES),
        ),
        Rule("V09_langs", optional(rec, "$.langs", every(rec, "$.langs", _text_item(formats.language), S.MAX_LANGS))),
        Rule(
            "V10_tags",
            optional(
                rec,
                "$.tags",
                every(
                    rec,
                    "$.tags",
                    _text_item(lambda t: tx.within(t, S.MAX_TAG_BYTES, S.MAX_TAG_GRAPHEMES)),
                    S.MAX_TAGS,
                ),
            ),
        ),
        _created_at_rule(rec),
        Rule("V12_reply", optional(rec, "$.reply", reply_refs)),
        Rule(
            "V13_reply_ref",
            optional(rec, "$.reply.root", strong_ref(rec, "$.reply.root"))
            & optional(rec, "$.reply.parent", strong_ref(rec, "$.reply.parent")),
        ),
        Rule("V16_embed", optional(rec, "$.embed", is_string(rec, "$.embed['$type']"))),
        Rule("V17_embed_external", in_embed(S.EMBED_EXTERNAL, embed_external(rec, "$.embed"))),
        Rule("V18_embed_images", in_embed(S.EMBED_IMAGES, embed_images(rec, "$.embed"))),
        Rule("V19_embed_record", in_embed(S.EMBED_RECORD, embed_record(rec, "$.embed"))),
        Rule(
            "V20_embed_record_with_media",
            in_embed(S.EMBED_RECORD_WITH_MEDIA, embed_record_with_media(rec, "$.embed")),
        ),
        Rule("V21_facets", optional(rec, "$.facets", every(rec, "$.facets", facet))),
        Rule("V22_entities", optional(rec, "$.entities", every(rec, "$.entities", entity))),
        Rule("V23_labels", optional(rec, "$.labels", _self_labels(rec))),
    ]


def _subject_rules(rec: Column, type_id: str, name: str) -> list[Rule]:
    return [
        _type_rule(rec, type_id),
        Rule(name, strong_ref(rec, "$.subject") & ~absent(rec, "$.createdAt")),
        _created_at_rule(rec),
    ]


def like_rules(rec: Column) -> list[Rule]:
    return _subject_rules(rec, S.LIKE, "V14_like")


def repost_rules(rec: Column) -> list[Rule]:
    return _subject_rules(rec, S.REPOST, "V15_repost")
