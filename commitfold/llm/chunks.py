"""Overlapping chunks of long texts, shared by the two tokenisers.

A text that is too long for one piece of work is cut into chunks that overlap. Both
neighbours see the overlap; where they agree on a boundary the earlier one's tokens end
and the later one's begin. `cut` widens an overlap until it holds a position at which
every tokenisation has a boundary, so neighbours always agree somewhere, and a text
without such a position is one chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The pieces of one text; `copies` identical rows share a key and are told apart by count.
PIECES = "doc_id bigint, digest binary, n_bytes bigint, part int, start int, text string"


class Span(NamedTuple):
    start: int
    end: int


def cut(text: str, size: int, overlap: int, stable) -> Iterator[Span]:
    """Spans covering `text`, neighbours overlapping by `overlap` characters or more.

    `stable` is a compiled pattern that matches with nothing but the character before a
    proven boundary; the boundary is where the match ends.
    """
    start, n = 0, len(text)
    while True:
        nominal = start + size
        if nominal + overlap >= n:
            yield Span(start, n)
            return
        width, found = overlap, None
        while found is None and nominal + width // 2 < n:
            found = stable.search(text, nominal, min(n, nominal + width))
            width *= 2
        if found is None or found.end() >= n:
            yield Span(start, n)
            return
        boundary = found.end()
        yield Span(start, max(nominal + overlap, boundary + 1))
        start = max(nominal, boundary - overlap)


def pieces(long_docs: DataFrame, size: int, overlap: int, stable) -> DataFrame:
    """The chunks of long texts, dealt out evenly."""

    def run(batches):
        for batch in batches:
            for one in batch.to_pylist():
                raw = one["text"].encode()
                digest = hashlib.blake2b(raw, digest_size=16).digest()
                spans = list(cut(one["text"], size, overlap, stable))
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "doc_id": one["doc_id"],
                            "digest": digest,
                            "n_bytes": len(raw),
                            "part": i,
                            "start": s.start,
                            "text": one["text"][s.start : s.end],
                        }
                        for i, s in enumerate(spans)
                    ],
                    schema=_SCHEMA,
                )

    made = long_docs.select("doc_id", "text").mapInArrow(run, PIECES)
    return made.repartition(F.col("digest"), F.col("part"))


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("n_bytes", pa.int64()),
        ("part", pa.int32()),
        ("start", pa.int32()),
        ("text", pa.string()),
    ]
)


def ordered_parts(rows: list[dict]) -> tuple[list[dict], int]:
    """One row per part in order, and how many identical documents sent them."""
    by_part: dict[int, dict] = {}
    copies = 0
    for row in rows:
        by_part.setdefault(row["part"], row)
        copies += row["part"] == 0
    return [by_part[i] for i in range(len(by_part))], copies


def splice(parts: list[dict]) -> list[tuple[int, int]]:
    """For each part the token range it contributes.

    Every part brings `at`, the ascending offsets (in the whole text) of its usable
    boundaries, and `index`, the number of its tokens before each. The first offset two
    neighbours share ends the earlier and begins the later one.
    """
    ranges, begin = [], 0
    for i, part in enumerate(parts):
        if i + 1 == len(parts):
            ranges.append((begin, part["n"]))
            break
        after = dict(zip(parts[i + 1]["at"], parts[i + 1]["index"], strict=True))
        mine = next(((j, after[a]) for a, j in zip(part["at"], part["index"], strict=True) if a in after and j >= begin), None)
        if mine is None:
            raise ValueError("neighbouring chunks share no boundary")
        ranges.append((begin, mine[0]))
        begin = mine[1]
    return ranges
