"""Operator 12: fill-in-middle over memoised content-defined chunks.

A text is cut where a rolling hash of its last bytes says so, so equal passages become
equal chunks whatever stands around them. What a chunk adds to the tokens of a text is a
short summary: the word ends inside it, and whether it begins with a space and ends in a
word, which decides about an end between two chunks. Summaries are kept by the chunk's
content (a look-up compares all bytes, so no hash is trusted) and worked out once for all
texts of a worker that share it. Sums over a text's summaries give its number of tokens
and the one chunk in which a cut falls; only that chunk is read for the place.

A token is a word with the spaces before it, or the spaces at the end of a text.

Cases: a null text is empty, and an empty text, or one that holds a mark, stays plain; a
null doc_id is hashed as nothing after the seed; repeated rows give the same result each;
an empty table gives an empty table; other columns are ignored. A text passes through its
rolling hash a segment at a time, so a very long one needs memory for itself only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

WINDOW_DOUBLINGS = 5  # a window of 32 bytes
CHUNK_BITS = 8  # a cut every 256 bytes on average
LONGEST = 4096
SEGMENT = 1 << 20
CACHE_BYTES = 32 << 20

_END = re.compile(rb"[^ \t-\r][ \t-\r]")
_GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, np.uint32)

_OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class Summary(NamedTuple):
    ends: int
    opens_with_space: bool
    closes_in_word: bool


def chunk_ends(raw: bytes) -> list[int]:
    """Where the chunks of a text end; the last is the end of the text."""
    width, found = 1 << WINDOW_DOUBLINGS, []
    for at in range(0, len(raw), SEGMENT):
        back = min(at, width - 1)
        rolled = _GEAR[np.frombuffer(raw, np.uint8, min(SEGMENT, len(raw) - at) + back, at - back)]
        for i in range(WINDOW_DOUBLINGS):
            step = 1 << i
            shifted = rolled[:-step] << np.uint32(step)
            rolled[step:] += shifted
        hits = np.flatnonzero((rolled[back:] >> np.uint32(32 - CHUNK_BITS)) == 0) + at + 1
        found.append(hits[hits >= width])
    ends, last = [], 0
    for end in [*(int(e) for part in found for e in part), len(raw)]:
        ends.extend(range(last + LONGEST, end, LONGEST))
        if end > last:
            ends.append(end)
        last = end
    return ends


class Chunks:
    """Summaries by content, up to a number of bytes; then it starts anew."""

    def __init__(self):
        self.kept: dict[bytes, Summary] = {}
        self.held = 0

    def summary(self, chunk: bytes) -> Summary:
        known = self.kept.get(chunk)
        if known is None:
            if self.held > CACHE_BYTES:
                self.kept.clear()
                self.held = 0
            known = Summary(len(_END.findall(chunk)), chunk[0] in SPACES, chunk[-1] not in SPACES)
            self.kept[chunk] = known
            self.held += len(chunk) + 100
        return known


class Cuts:
    """The tokens of one text, and where a number of them ends."""

    def __init__(self, raw: bytes, chunks: Chunks):
        self.raw, self.bounds = raw, [0, *chunk_ends(raw)]
        self.before, total, in_word = [0], 0, False
        self.joint = []
        for start, end in zip(self.bounds, self.bounds[1:], strict=False):
            own = chunks.summary(raw[start:end])
            joint = in_word and own.opens_with_space
            total += own.ends + joint
            self.joint.append(joint)
            self.before.append(total)
            in_word = own.closes_in_word
        self.n = total + (len(raw) > 0)

    def after(self, tokens: int) -> int:
        """The byte at which so many tokens have ended."""
        if tokens == 0 or tokens >= self.n:
            return 0 if tokens == 0 else len(self.raw)
        j = int(np.searchsorted(self.before, tokens)) - 1
        start, left = self.bounds[j], tokens - self.before[j] - self.joint[j]
        if left == 0:
            return start
        match = next(islice(_END.finditer(self.raw, start, self.bounds[j + 1]), left - 1, None))
        return match.end() - 1


def assembled(prefix: str, middle: str, suffix: str, form: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def rebuilt(output: str, form: str) -> str:
    """The text that became `output`. A text with marks stays plain, so each is found once."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output[len(first) :].split(second, 1)
    other, middle = rest.split(MIDDLE, 1)
    return one + middle + other if form == "psm" else other + middle + one


def _units(seed: int) -> Column:
    """Four whole numbers that the seed and the doc_id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)])


def transform(docs: DataFrame, seed: int = 42, changed_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain) and output."""

    def one(text: str, units: list[int], chunks: Chunks) -> tuple:
        cuts = Cuts(text.encode(), chunks)
        if not text or units[2] % 100 >= changed_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            return cuts.n, "plain", None, None, text
        first, second = sorted(units[i] % (cuts.n + 1) for i in range(2))
        a, b = cuts.after(first), cuts.after(second)
        prefix, middle, suffix = (cuts.raw[x:y].decode() for x, y in ((0, a), (a, b), (b, None)))
        form = "spm" if units[3] % 100 < spm_percent else "psm"
        return cuts.n, form, len(prefix), len(middle), assembled(prefix, middle, suffix, form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [one(t, u, chunks) for t, u in zip(texts(part), part.column(2).to_pylist(), strict=True)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _units(seed).alias("units")).mapInArrow(run, _OUT)


def restored(transformed: DataFrame) -> DataFrame:
    """The transformed rows with the text rebuilt from `output` and `form` as `restored`."""
    rows = transformed.select([c for c in transformed.columns if c != "restored"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [rebuilt(o, f) for o, f in zip(texts(part, "output"), texts(part, "form"), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.string())], [*part.schema.names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, restored string")
