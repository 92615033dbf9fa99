"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sanitize(text: Column) -> Column:
    """Absent text becomes empty, NUL characters are removed."""
    return F.coalesce(F.replace(text, F.chr(F.lit(0)), F.lit("")), F.lit(""))


def graphemes(text: Column) -> Column:
    """Number of extended grapheme clusters (what a reader sees as characters)."""
    return F.regexp_count(text, F.lit(r"\X"))


def within(text: Column, max_bytes: int, max_graphemes: int) -> Column:
    """Both length limits.

    Bytes and characters are cheap to count, and a text of few characters cannot
    hold more graphemes. In a text of ASCII alone every character is one, but for a
    line end of two. The rest is left to a pattern that stops right after the first
    grapheme too many.
    """
    ascii_only = (F.octet_length(text) == F.char_length(text)) & ~F.contains(text, F.lit("\r\n"))
    return (
        F.when(F.octet_length(text) > max_bytes, False)
        .when(F.char_length(text) <= max_graphemes, True)
        .when(ascii_only, False)
        .otherwise(~text.rlike(rf"\A\X{{{max_graphemes + 1}}}"))
    )


def record_uri(repo: Column, path: Column) -> Column:
    return F.concat(F.lit("at://"), repo, F.lit("/"), path)


def collection_of(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def rkey_of(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def contains_all(text: Column, terms: list[str]) -> Column:
    """Every term occurs in the text, ignoring case."""
    low = F.lower(text)
    hit = F.lit(True)
    for term in terms:
        hit = hit & F.contains(low, F.lit(term.lower()))
    return hit
