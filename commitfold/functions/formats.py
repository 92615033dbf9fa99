"""String format predicates, one place for every pattern.

The patterns follow the public protocol specification. Known gaps: `cid` checks
the multibase alphabet and length, not the digest; `datetime` accepts any
calendar-valid instant Spark can parse, so leap seconds are rejected; `language`
checks the shape of a tag, not the registry of subtags.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import times

# --- Fixed values: format patterns ------------------------------------------
_LABEL = r"[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
DID = r"did:[a-z]+:[a-zA-Z0-9._:%-]*[a-zA-Z0-9._-]"
HANDLE = rf"({_LABEL}\.)+[a-zA-Z]([a-zA-Z0-9-]{{0,61}}[a-zA-Z0-9])?"
NSID = rf"[a-zA-Z]([a-zA-Z0-9-]{{0,61}}[a-zA-Z0-9])?(\.{_LABEL})+(\.[a-zA-Z]([a-zA-Z]{{0,61}}[a-zA-Z])?)"
RKEY = r"[a-zA-Z0-9._~:-]{1,512}"
AT_URI = rf"at://({DID}|{HANDLE})(/{NSID}(/{RKEY})?)?(#/[^\s#]*)?"
CID = r"b[a-z2-7]{8,255}|z[1-9A-HJ-NP-Za-km-z]{8,255}|Qm[1-9A-HJ-NP-Za-km-z]{44}"
DATETIME = (
    r"[0-9]{4}-[01][0-9]-[0-3][0-9]T[0-2][0-9]:[0-6][0-9]:[0-6][0-9]"
    r"(\.[0-9]{1,20})?(Z|[+-][0-2][0-9]:[0-5][0-9])"
)
LANGUAGE = r"(i|[a-z]{2,3})(-[a-zA-Z0-9]+)*"
URI = r"\w+:(//)?[^\s/]\S*"
# ----------------------------------------------------------------------------


def _whole(text: Column, pattern: str, max_length: int | None = None) -> Column:
    ok = text.rlike(rf"\A(?:{pattern})\z")
    return ok if max_length is None else (F.octet_length(text) <= max_length) & ok


def did(text: Column) -> Column:
    return _whole(text, DID, 2048)


def handle(text: Column) -> Column:
    return _whole(text, HANDLE, 253)


def nsid(text: Column) -> Column:
    return _whole(text, NSID, 317)


def at_identifier(text: Column) -> Column:
    return did(text) | handle(text)


def at_uri(text: Column) -> Column:
    return _whole(text, AT_URI, 8192)


def cid(text: Column) -> Column:
    return _whole(text, CID)


def datetime(text: Column) -> Column:
    """Shape, no unknown offset, and a date that exists."""
    return _whole(text, DATETIME) & ~text.endswith("-00:00") & times.instant(text).isNotNull()


def language(text: Column) -> Column:
    return _whole(text, LANGUAGE)


def uri(text: Column) -> Column:
    return _whole(text, URI)
