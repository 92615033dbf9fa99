"""Operator 2: secret scans by patterns and by dictionary-primed compression.

Patterns give the base spans. Beyond them, a candidate is a run of key characters near a
word that names something sensitive, on either side of it. Its novelty is
the number of bytes that zstandard needs for it on top of the text around it, with a
dictionary of the corpus's own identifiers: an identifier, a path or a repetition of
what stands nearby costs a few bytes, a random key costs nearly as many as it has
characters. Candidates above a share of bytes per character are reported as `novel`. What
is reported already and copies of the candidate itself do not count as text around it,
and a string that is novel once is reported wherever else it stands in the document.

What is not looked at: runs of fewer than `least_run` key characters, and runs with no
sensitive word within `near` characters before or after them. Both are arguments.

The identifiers are counted over all documents; the dictionary is made of the most
frequent ones up to a fixed size. It holds no digits, so a secret that stands in a
thousand copies does not become familiar.

Cases: a null or empty text has no spans; repeated documents give repeated results; a
novel span never overlaps a base span; an empty table gives an empty table; other
columns pass in `redacted` and are left out of the report. Offsets are code points.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import importable, replaced, texts, written

# Fixed values of the base kinds, in the order of the report. The lengths of matches of
# the last two are part of the pattern: a maximal run is either long enough or not.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "novel")
# A text without any of these, in lower case, has no assignment.
_ASSIGNED = ("passw", "secret", "token", "api")

LEAST_RUN = 16  # key characters of a candidate at least
SENSITIVE = re.compile(r"passw|passphrase|secret|token|api_?key|credential|private|bearer|auth", re.IGNORECASE)
NEAR = 48  # characters before and after a candidate in which a sensitive word counts
CONTEXT = 256  # characters before a candidate that prime the compressor
NOVELTY = 0.6  # bytes per character from which a candidate is novel
DICTIONARY_BYTES = 16_384

IDENTIFIER = re.compile(r"[A-Za-z_]{6,32}")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds by start, then kind."""
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in _ASSIGNED):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


class Novelty:
    """Marginal compressed sizes on top of a context and a dictionary."""

    def __init__(self, dictionary: bytes, least_run: int = LEAST_RUN, near: int = NEAR):
        self.least_run, self.near = least_run, near
        self.candidate = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{least_run},}}")
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False).compress

    def bytes_for(self, candidate: str, context: str) -> int:
        before = context.encode()
        return len(self.compress(before + candidate.encode())) - len(self.compress(before))

    def spans(self, text: str, base: list[Span], least: float) -> list[Span]:
        """Novel candidates of a text that touch no base span."""
        found: list[Span] = []
        if not SENSITIVE.search(text):
            return found
        known = _joined(base)
        taken, at = known[:], 0
        for match in self.candidate.finditer(text):
            start, end = match.span()
            run = match.group()
            while at < len(known) and known[at][1] <= start:
                at += 1
            if at < len(known) and known[at][0] < end:
                continue
            if not SENSITIVE.search(text, max(0, start - self.near), start) and not SENSITIVE.search(text, end, end + self.near):
                continue
            if self.bytes_for(run, _around(text, start, taken).replace(run, "")) >= least * len(run):
                found.append(("novel", start, end))
                insort(taken, (start, end))
        return found + self._further(text, found, base) if found else found

    def _further(self, text: str, found: list[Span], base: list[Span]) -> list[Span]:
        """Every other place of the strings found, wherever it is in the text, that touches no
        span. Runs of key characters are searched by what the strings begin with."""
        begins: dict[str, set[str]] = {}
        for _, start, end in found:
            begins.setdefault(text[start : start + self.least_run], set()).add(text[start:end])
        reported = _joined(base + found)
        more: list[Span] = []
        at = 0
        for match in self.candidate.finditer(text):
            i, end = match.span()
            while i + self.least_run <= end:
                while at < len(reported) and reported[at][1] <= i:
                    at += 1
                if at < len(reported) and reported[at][0] <= i:
                    i = reported[at][1]
                    continue
                room = min(end, reported[at][0]) if at < len(reported) else end
                known = [k for k in begins.get(text[i : i + self.least_run], ()) if i + len(k) <= room and text.startswith(k, i)]
                if known:
                    longest = max(map(len, known))
                    more.append(("novel", i, i + longest))
                    i += longest
                else:
                    i += 1
        return more


def _joined(spans: list[Span]) -> list[tuple[int, int]]:
    """What some spans cover, as [start, end) pairs in order and apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _around(text: str, start: int, taken: list[tuple[int, int]]) -> str:
    """The characters before a candidate, without the spans that are reported already."""
    out, upto = [], max(0, start - CONTEXT)
    # What reaches into the context begins in it, or is the last one to begin before.
    for i in range(max(0, bisect_left(taken, (upto, 0)) - 1), bisect_left(taken, (start, 0))):
        s, e = taken[i]
        out.append(text[upto:s])
        upto = max(upto, e)
    return "".join([*out, text[upto:start]])


@lru_cache(maxsize=2)
def novelty(dictionary: bytes, least_run: int = LEAST_RUN, near: int = NEAR) -> Novelty:
    return Novelty(dictionary, least_run, near)


def identifier_counts(docs: DataFrame) -> DataFrame:
    """name and n, how often each identifier stands in all documents; each task counts
    before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in texts(batch):
                counts.update(IDENTIFIER.findall(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["name", "n"]
            )

    return docs.select("text").mapInArrow(run, "name string, n bigint").groupBy("name").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """The identifiers that most of the corpus's identifier bytes are made of, the most
    frequent last, as a compressor wants them; at most `size` bytes. Runs jobs.

    A histogram of their weights says first from which weight on they fill the dictionary,
    so what comes to the driver is about a dictionary's worth, whatever the number of tasks.
    """
    importable(docs.sparkSession)
    weight, grade = F.col("n") * F.length("name"), F.floor(F.log2("weight") * 64)
    counted = written(identifier_counts(docs).where("n > 1").withColumn("weight", weight).withColumn("grade", grade), "identifiers")
    grades = counted.groupBy("grade").agg(F.sum(F.length("name") + 1).alias("bytes")).orderBy(F.desc("grade")).collect()
    held, last = 0, None
    for row in grades:
        held, last = held + row["bytes"], row["grade"]
        if held > size:
            break
    if last is None:
        return b""
    made, room = [], size
    for row in counted.where(F.col("grade") >= last).orderBy(F.desc("weight"), "name").limit(size // 7).collect():
        room -= len(row["name"]) + 1
        if room < 0:
            break
        made.append(row["name"])
    return " ".join(reversed(made)).encode()


def spans_of(docs: DataFrame, identifiers: bytes, least: float = NOVELTY, least_run: int = LEAST_RUN, near: int = NEAR) -> DataFrame:
    """doc_id and `found`, all spans as structs of kind, start and end, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = novelty(identifiers, least_run, near)
        for batch in batches:
            found = []
            for text in texts(batch):
                base = base_spans(text)
                found.append([dict(zip(("kind", "start", "end"), s)) for s in sorted(base + own.spans(text, base, least), key=_order)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["doc_id", "found"])

    importable(docs.sparkSession)
    schema = "doc_id bigint, found array<struct<kind: string, start: int, end: int>>"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def report(found: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("found", lambda s: s["kind"] != "novel")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def redacted(
    docs: DataFrame, identifiers: bytes, least: float = NOVELTY, mark: str = "[redacted]", least_run: int = LEAST_RUN, near: int = NEAR
) -> DataFrame:
    """The documents with every span replaced by a mark; overlapping spans by one."""

    def make(batch: pa.RecordBatch) -> list:
        own = novelty(identifiers, least_run, near)
        out = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            spans = sorted(base + own.spans(text or "", base, least), key=_order)
            out.append(_marked(text, spans, mark) if spans else text)
        return out

    importable(docs.sparkSession)
    return replaced(docs, "text", make)


def _marked(text: str, spans: list[Span], mark: str) -> str:
    out, upto = [], 0
    for _, start, end in spans:
        if start >= upto:
            out += [text[upto:start], mark]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])
