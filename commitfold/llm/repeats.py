"""Operator 13: exact repeated substrings by common-prefix intervals of suffix arrays.

A string of `length` bytes that stands in two places is found where its anchor is: of the
short grams that begin in its first `width` bytes the one with the least hash (the first
of equals). Equal strings have equal anchors at the same place, so both meet in the
anchor's bucket, however the texts are spread over tasks. An anchor brings its frame along,
the bytes that any such string around it can cover; only anchors that occur again do.

Inside a bucket the suffixes of all frames that hold a whole string are put in order, those
that agree in `length` bytes only. Neighbours' common prefixes are scanned with a stack, as
if the tree of common-prefix intervals were walked; each interval is a set of all suffixes
that share so many bytes. If what precedes them differs, the repeat cannot be extended to
the left, and all its occurrences are a group. Intervals that all continue to the left are
passed over: the suffixes one byte earlier hold them.

Frames are first told apart by their digests. One that stands in several places (a passage
in thousands of texts) is a repeat as a whole, and only the bytes of buckets with different
frames travel, each frame once per task. A bucket with more than `most` different frames (a common
phrase in ever new surroundings) is not put into one task: its frames are split by where
their strings begin, into parts that share a longer core. Equal parts are a repeat as they
are; where different ones share a core, one frame for each gives the few bytes around it, in
which alone the parts differ, and a core's parts are compared in one place. Where more than
`MANY` parts share one, their strings of `length` bytes are looked up by digest instead. So
no group grows with the data and nothing is dropped.

A group is maximal inside the frame of its anchor; in a bucket that was split it is a part
or a run of strings that each occur again. Longer repeats appear as groups of successive, overlapping frames; the union of
their occurrences is exact.

Passages may also be counted by words: those in runs of `words` words that stand in another
document too, white space aside. They meet by anchors as well, the grams of words with the
least hash; the windows of one anchor are a stretch, cut into parts by their place from it,
and equal parts are found by digest. Only where different ones share a core, what all their
windows hold, are these looked up by digest.
Nothing is removed by this, and a run of words may be shorter than `length` bytes.

Cases: a null text is empty; a text shorter than `length` loses nothing; repeated rows are
occurrences like any others; an empty table gives an empty table; a null doc_id stays null;
other columns are ignored. A text is the unit that has to fit into a task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import work_folder
from .common import written

LENGTH = 400
PASSAGE = 51  # words
PIECE = 1 << 17  # words of a text that are hashed at once
MOST = 64  # different frames of a bucket
MANY = 4096  # different parts around a core, each under 200 bytes
SEGMENT = 1 << 17  # positions that are hashed at once, as many as a processor's cache holds
BATCH = 2 << 20  # bytes of frames whose suffixes are ordered together
SALTS = 8

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_POSITION_BITS = np.uint64(22)
_POSITION = np.uint64((1 << 22) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Hashes of all strings of one size in a run of bytes, by differences of one running sum."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def of(self, raw: np.ndarray, size: int) -> np.ndarray:
        n = len(raw)
        if n < size:
            return np.zeros(0, np.uint64)
        sums = self._sums(raw)
        return self._mixed((sums[size:] - sums[:-size]) * self.down[: n - size + 1])

    def between(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self._sums(raw)
        return self._mixed((sums[ends] - sums[starts]) * self.down[starts])

    def _sums(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        if len(self.up) < n + 1:
            self.up = _powers(_BASE, n + 1)
            self.down = _powers(pow(_BASE, -1, 1 << 64), n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return sums

    def _mixed(self, found: np.ndarray) -> np.ndarray:
        found ^= found >> np.uint64(32)
        found *= _MIX
        found ^= found >> np.uint64(29)
        return found


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every `width` successive ones."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def width_of(length: int) -> int:
    return max(1, 3 * length // 4)


def anchors(raws: list[bytes], length: int, hashes: Hashes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the text, places, keys) of the anchors of each text, in order and once;
    short texts are worked on together, long ones by overlapping segments."""
    width = width_of(length)
    gram = length - width + 1
    pieces: list[tuple[int, int, bytes]] = []
    held = 0

    def flush():
        joint = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        keys = hashes.of(joint, gram)
        packed = (keys & ~_POSITION) | np.arange(len(keys), dtype=np.uint64)
        first = (least(packed, width) & _POSITION).astype(np.int64)
        begin = 0
        for nr, at, piece in pieces:
            own = first[begin : begin + len(piece) - length + 1]
            own = own[np.append(True, own[1:] != own[:-1])]
            yield nr, own - begin + at, keys[own].view(np.int64)
            begin += len(piece)

    for nr, raw in enumerate(raws):
        for at in range(0, len(raw) - length + 1, SEGMENT):
            piece = raw[at : at + SEGMENT + length - 1]
            if held + len(piece) > SEGMENT and pieces:
                yield from _merged(flush())
                pieces, held = [], 0
            pieces.append((nr, at, piece))
            held += len(piece)
    if pieces:
        yield from _merged(flush())


def _merged(found: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    return (one for one in found if len(one[1]))


def _by_text(raws: list[bytes], length: int, hashes: Hashes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and keys of every text; two segments of a long text may share an anchor."""
    parts: list[list] = [[] for _ in raws]
    for nr, at, keys in anchors(raws, length, hashes):
        parts[nr].append((at, keys))
    out = []
    for own in parts:
        at = np.concatenate([p[0] for p in own]) if own else np.zeros(0, np.int64)
        keys = np.concatenate([p[1] for p in own]) if own else np.zeros(0, np.int64)
        if len(own) > 1:
            at, index = np.unique(at, return_index=True)
            keys = keys[index]
        out.append((at, keys))
    return out


def _worded(raws: list[bytes]) -> list[bytes]:
    """The words of each text, joined by one space."""
    return [b" ".join(raw.split()) for raw in raws]


def stretches(worded: list[bytes], words: int, hashes: Hashes) -> list[tuple[np.ndarray, ...]]:
    """(first window, number of windows, anchor, key) of the stretches of each text: successive
    windows of `words` words with one anchor, all counted in words. Long texts are worked on by overlapping pieces,
    between which a stretch is cut."""
    width = width_of(words)
    gram = words - width + 1
    pieces: list[tuple[int, int, int, bytes]] = []
    parts: list[list] = [[] for _ in worded]
    held = 0

    def flush() -> None:
        joint = np.frombuffer(b" ".join(p[3] for p in pieces), np.uint8)
        spaces = np.flatnonzero(joint == 32)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(joint))
        keys = hashes.between(joint, starts[: len(starts) - gram + 1], ends[gram - 1 :])
        packed = (keys & ~_POSITION) | np.arange(len(keys), dtype=np.uint64)
        first = (least(packed, width) & _POSITION).astype(np.int64)
        begin = 0
        for nr, at, n, _ in pieces:
            own = first[begin : begin + n - words + 1]
            edges = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            anchors = own[edges]
            parts[nr].append((edges + at, np.diff(np.append(edges, len(own))), anchors - begin + at, keys[anchors].view(np.int64)))
            begin += n

    for nr, raw in enumerate(worded):
        n = raw.count(b" ") + 1 if raw else 0
        if n < words:
            continue
        cuts = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) if n > PIECE else []
        for at in range(0, n - words + 1, PIECE):
            end = min(at + PIECE + words - 1, n)
            piece = raw[cuts[at - 1] + 1 if at else 0 : cuts[end - 1] if end < n else len(raw)]
            if held + len(piece) > SEGMENT and pieces:
                flush()
                pieces, held = [], 0
            pieces.append((nr, at, end - at, piece))
            held += len(piece)
    if pieces:
        flush()
    none = (np.zeros(0, np.int64),) * 4
    return [tuple(np.concatenate(c) for c in zip(*own, strict=True)) if own else none for own in parts]


def _raw(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in batch.column("text").to_pylist()]


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows) if rows else [], kind))


# --- which anchors occur again -----------------------------------------------------


def _digest() -> list[Column]:
    """128 bits of a text as two whole numbers, which aggregate without sorting."""
    hexes = F.sha2(F.coalesce("text", F.lit("")), 256)
    return [F.conv(F.substring(hexes, 16 * i + 1, 16), 16, -10).cast("bigint").alias(name) for i, name in enumerate(("hi", "lo"))]


def _anchored(docs: DataFrame, length: int, words: int | None) -> DataFrame:
    """hi, lo, key, n: the anchors of every text, a key once with its number of places; those
    of its words, too, if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raws = _raw(part)
                found = [np.unique(keys, return_counts=True) for _, keys in _by_text(raws, length, hashes)]
                if words:  # of which it counts in how many documents they are
                    more = [np.unique(one[3]) for one in stretches(_worded(raws), words, hashes)]
                    found = [(np.append(a, b), np.append(n, np.ones(len(b), np.int64))) for (a, n), b in zip(found, more, strict=True)]
                lists = [_lists([f[i] for f in found], pa.int64()) for i in range(2)]
                yield pa.RecordBatch.from_arrays([part.column("hi"), part.column("lo"), *lists], ["hi", "lo", "keys", "ns"])

    lists = docs.select("hi", "lo", "text").mapInArrow(run, "hi bigint, lo bigint, keys array<bigint>, ns array<bigint>")
    opened = lists.select("hi", "lo", F.explode(F.arrays_zip("keys", "ns")).alias("one"))
    return opened.select("hi", "lo", F.col("one.keys").alias("key"), F.col("one.ns").alias("n"))


def _dealt() -> Column:
    """A salt that the doc_id decides."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")


def _keys_by_text(anchors: DataFrame, keys: DataFrame) -> DataFrame:
    """hi, lo, keys: of each text those of its anchors that are among `keys`. A gram may
    stand in any share of the texts; its rows are narrow, and adaptive execution splits it."""
    return anchors.join(keys, "key", "left_semi").groupBy("hi", "lo").agg(F.collect_set("key").alias("keys"))


# --- frames ------------------------------------------------------------------------

# A frame is known by 128 bits of its key, place and bytes, as two numbers that shuffle small.
_FRAME_KEY = ["f1", "f2"]
_PLACES = {"f1": pa.int64(), "f2": pa.int64(), "key": pa.int64(), "ahead": pa.int32(), "hi": pa.int64(), "lo": pa.int64()}
_PLACES |= {"at": pa.list_(pa.int32()), "size": pa.int32(), "repeat": pa.binary()}
_BODIES = {"f1": pa.int64(), "f2": pa.int64(), "key": pa.int64(), "ahead": pa.int32(), "hot": pa.bool_(), "frame": pa.binary()}


def _numbers(raw: bytes) -> tuple[int, int]:
    digest = hashlib.sha256(raw).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:16], "big", signed=True)


def _frame_id(key: int, ahead: int, frame: bytes) -> tuple[int, int]:
    return _numbers(b"%d %d:" % (key, ahead) + frame)


def _name(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()[:16]


def _rows(rows: list[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
        yield pa.RecordBatch.from_arrays(columns, list(kinds))


def _of_texts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple[int, int, dict]]]:
    """(hi, lo, frames) of some texts at a time: the frames (key, bytes before the anchor,
    bytes) around the wanted keys with the places of their anchors."""
    hashes, width = Hashes(), width_of(length)
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part, out = batch.slice(i, 64), []
            raws = _raw(part)
            given = zip(*[part.column(c).to_pylist() for c in ("hi", "lo", "keys")], strict=True)
            for raw, (hi, lo, wanted), (at, keys) in zip(raws, given, _by_text(raws, length, hashes), strict=True):
                use = np.isin(keys, wanted)
                frames: dict[tuple[int, int, bytes], list[int]] = {}
                for a, key in zip(at[use].tolist(), keys[use].tolist(), strict=True):
                    ahead = min(a, width - 1)
                    frames.setdefault((key, ahead, raw[a - ahead : a + length]), []).append(a)
                out.append((hi, lo, frames))
            yield out


def _places(sources: DataFrame, length: int, named: bool) -> DataFrame:
    """Where the frames of the wanted keys stand, equal ones of a text as one row. `ahead` is
    the number of bytes before the anchor; with `named` also the digest of the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _of_texts(batches, length):
            rows = [
                (*_frame_id(key, ahead, frame), key, ahead, hi, lo, at, len(frame), _name(frame) if named else None)
                for hi, lo, frames in texts
                for (key, ahead, frame), at in frames.items()
            ]
            yield from _rows(rows, _PLACES)

    out = "f1 bigint, f2 bigint, key bigint, ahead int, hi bigint, lo bigint, at array<int>, size int, repeat binary"
    return sources.select("hi", "lo", "text", "keys").mapInArrow(run, out)


def _bodies(sources: DataFrame, length: int) -> DataFrame:
    """The bytes of the frames of the wanted keys, once per task; `hot` where the key is
    among the text's `hots`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        known: list[tuple[int, int, set[int]]] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 64):
                    part = batch.slice(i, 64)
                    known.extend(set(h) for h in part.column("hots").to_pylist())
                    yield part

        for texts in _of_texts(noted(), length):
            rows = []
            for (_, _, frames), hots in zip(texts, known, strict=True):
                for key, ahead, frame in frames:
                    one = _frame_id(key, ahead, frame)
                    if one not in told:
                        if len(told) > 200_000:
                            told.clear()
                        told.add(one)
                        rows.append((*one, key, ahead, key in hots, frame))
            known.clear()
            yield from _rows(rows, _BODIES)

    out = "f1 bigint, f2 bigint, key bigint, ahead int, hot boolean, frame binary"
    return sources.select("hi", "lo", "text", "keys", "hots").mapInArrow(run, out)


# --- the suffix array of a batch of buckets ------------------------------------------

_GROUP = pa.struct([("repeat", pa.binary()), ("start", pa.int32()), ("size", pa.int32())])
_ONE = {"f1": pa.int64(), "f2": pa.int64(), "groups": pa.list_(_GROUP)}
_GROUPS = "f1 bigint, f2 bigint, groups array<struct<repeat: binary, start: int, size: int>>"


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def intervals(shared: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the common-prefix intervals of ordered suffixes, of
    which `shared[i]` is what i and i + 1 have in common."""
    stack: list[tuple[int, int]] = []
    for i, size in enumerate([*shared, 0]):
        first = i
        while stack and stack[-1][0] > size:
            top, first = stack.pop()
            yield top, first, i
        if size >= shortest and (not stack or stack[-1][0] < size):
            stack.append((size, first))


def repeats(
    frames: list[tuple[int, int, bytes]], length: int, hashes: Hashes, longest: bool = False
) -> Iterator[tuple[int, bytes, int, int]]:
    """(frame, digest of the repeat, start from the anchor, size) of all occurrences of the
    maximal repeats of different frames (key, ahead, bytes). Equal strings have the same key
    and the same place by it; others are not compared, as two frames of a text may show one
    place of it twice. With `longest` only the longest repeat that begins at a place; it
    covers the others, which lie above it in the tree."""
    raws = [f[2] for f in frames]
    sizes = np.array([len(f) for f in raws], np.int64)
    begins = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - length + 1, 0)
    if counts.sum() < 2:
        return
    of = np.repeat(np.arange(len(raws)), counts)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    joint = np.frombuffer(b"".join(raws), np.uint8)
    place = begins[of] + inside
    keys = np.array([f[0] for f in frames], np.int64).view(np.uint64)
    from_anchor = inside - np.array([f[1] for f in frames], np.int64)[of]
    tags = keys[of] + from_anchor.view(np.uint64) * _MIX
    values = hashes.of(joint, length)[place] ^ ((tags ^ (tags >> np.uint64(31))) * _MIX)
    # What precedes a suffix. Nothing precedes the first of a frame, which is like no other.
    left = np.where(inside > 0, joint[place - 1].astype(np.int64), 256 + np.arange(len(of)))
    order = np.argsort(values, kind="stable")
    ordered, left = values[order], left[order]
    edge = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    diverse = np.minimum.reduceat(left, edge) != np.maximum.reduceat(left, edge)
    ends = np.append(edge[1:], len(ordered))
    for a, b in zip(edge[diverse].tolist(), ends[diverse].tolist(), strict=True):
        # The hash brought them together; key, place and all bytes decide.
        placed: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        for nr, start, before in zip(of[order[a:b]].tolist(), inside[order[a:b]].tolist(), left[a:b].tolist(), strict=True):
            key, ahead, raw = frames[nr]
            placed.setdefault((key, start - ahead), []).append((raw[start:], before, nr))
        for (_, start), suffixes in placed.items():
            suffixes.sort()
            shared = [common(x[0], y[0]) for x, y in zip(suffixes, suffixes[1:], strict=False)]
            told = [False] * len(suffixes)
            for size, i, j in intervals(shared, length):
                if all(suffixes[x][1] == suffixes[i][1] for x in range(i, j + 1)):
                    continue
                name = _name(suffixes[i][0][:size])
                for x in range(i, j + 1):
                    if not told[x]:
                        told[x] = longest
                        yield suffixes[x][2], name, start, size


def _by_frame(found: Iterable[tuple[int, bytes, int, int]], longest: bool) -> dict[int, list[dict]]:
    """The occurrences in each frame, or with `longest` their union."""
    out: dict[int, list] = {}
    for nr, name, start, size in found:
        out.setdefault(nr, []).append((start, start + size) if longest else {"repeat": name, "start": start, "size": size})
    if longest:
        return {nr: [{"repeat": None, "start": a, "size": b - a} for a, b in union(own)] for nr, own in out.items()}
    return out


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order that neither overlap nor touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _bucket_groups(bodies: DataFrame, length: int, longest: bool) -> DataFrame:
    """f1, f2, groups: the repeats (start from the anchor, size) of frames whose buckets fit
    into a task. Buckets come one after the other, and several whole ones are worked on
    together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        held: list[tuple] = []
        bucket: dict[tuple[int, int], tuple] = {}
        size, key = 0, None

        def done() -> Iterator[pa.RecordBatch]:
            found = repeats([row[2:] for row in held], length, hashes, longest)
            yield from _rows([(*held[nr][:2], own) for nr, own in _by_frame(found, longest).items()], _ONE)

        def closed() -> int:
            """A bucket with one frame only has nothing to compare."""
            if len(bucket) > 1:
                held.extend(bucket.values())
                return sum(len(row[4]) for row in bucket.values())
            return 0

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                for row in zip(*[part.column(c).to_pylist() for c in ("f1", "f2", "key", "ahead", "frame")], strict=True):
                    if row[2] != key:
                        size += closed()
                        bucket = {}
                        if size > BATCH:
                            yield from done()
                            held, size = [], 0
                        key = row[2]
                    bucket.setdefault(row[:2], row)
        closed()
        if held:
            yield from done()

    dealt = bodies.select("f1", "f2", "key", "ahead", "frame").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, _GROUPS)


# --- buckets of too many frames -----------------------------------------------------

# Equal parts; 128 bits of place and bytes, as whole numbers, which shuffle small.
_PART = ["core", "back", "p1", "p2"]
_PARTS = {name: pa.int64() for name in ("nr", "n", "core")} | {"back": pa.int32(), "p1": pa.int64(), "p2": pa.int64()}
_SIDES = {"core": pa.int64(), "back": pa.int32(), "p1": pa.int64(), "p2": pa.int64(), "core2": pa.int64(), "left": pa.binary(), "right": pa.binary()}
_STRINGS = {"core": pa.int64(), "back": pa.int32(), "p1": pa.int64(), "p2": pa.int64(), "key": pa.int64(), "at": pa.int32(), "s1": pa.int64(), "s2": pa.int64()}


def _schema(kinds: dict[str, pa.DataType]) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"{name} {names[kind]}" for name, kind in kinds.items())


def _step(length: int) -> int:
    return max(1, width_of(length) // 8)


def _part(size: int, ahead: int, back: int, length: int) -> tuple[int, int]:
    """The first place at which a string of the part begins, and the end of the last one."""
    last = ahead - back
    return max(last - _step(length) + 1, 0), min(last + length, size)


def _core(key: int, ahead: int, back: int, frame: bytes, length: int) -> tuple[int, int]:
    """Digest of key, place and bytes of what all strings of a part share."""
    last = ahead - back
    return _numbers(b"%d %d:" % (key, back) + frame[last : last - _step(length) + 1 + length])


def _parts(bodies: DataFrame, length: int) -> DataFrame:
    """The parts of frames: `back`, the last place of a part's strings counted back from the
    anchor, so that equal strings have equal parts; `core`, a digest of key, place and what
    all its strings share; `p1` and `p2`, that of its place and all its bytes."""
    step = _step(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                rows = []
                for nr, key, ahead, n, frame in zip(*[c.to_pylist() for c in batch.slice(i, 1024).columns], strict=True):
                    for back in range(0, ahead + 1, step):
                        first, end = _part(len(frame), ahead, back, length)
                        if end - first >= length:
                            head = b"%d %d:" % (key, first - ahead)
                            rows.append((nr, n, _core(key, ahead, back, frame, length)[0], back, *_numbers(head + frame[first:end])))
                yield from _rows(rows, _PARTS)

    return bodies.select("nr", "key", "ahead", "n", "frame").mapInArrow(run, _schema(_PARTS))


def _sides(bodies: DataFrame, length: int) -> DataFrame:
    """What stands to the left and to the right of the core in the named parts of frames, and
    the other half of the core's digest, beside what names the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                rows = []
                for key, ahead, frame, parts in zip(*[c.to_pylist() for c in batch.slice(i, 1024).columns], strict=True):
                    for part in parts:
                        last = ahead - part["back"]
                        first, end = _part(len(frame), ahead, part["back"], length)
                        core2 = _core(key, ahead, part["back"], frame, length)[1]
                        right = frame[last - _step(length) + 1 + length : end]
                        rows.append((*[part[c] for c in _PART], core2, frame[first:last], right))
                yield from _rows(rows, _SIDES)

    return bodies.select("key", "ahead", "frame", "parts").mapInArrow(run, _schema(_SIDES))


def shared_strings(sides: list[tuple[int, bytes, bytes]], step: int) -> list[list[int]]:
    """Of different parts (second half of the core's digest, left, right) around one core: how
    many bytes to the left of it those strings of each begin that stand in another, too."""
    found: list[list[int]] = [[] for _ in sides]
    for before in range(step):
        after = step - 1 - before
        held: dict[tuple[int, bytes, bytes], list[int]] = {}
        for nr, (core, left, right) in enumerate(sides):
            if before <= len(left) and after <= len(right):
                held.setdefault((core, left[len(left) - before :], right[:after]), []).append(nr)
        for same in held.values():
            if len(same) > 1:
                for nr in same:
                    found[nr].append(before)
    return found


_SPAN = pa.struct([("start", pa.int32()), ("size", pa.int32())])
_RUNS = {"core": pa.int64(), "back": pa.int32(), "p1": pa.int64(), "p2": pa.int64(), "spans": pa.list_(_SPAN)}


def _side_runs(sides: DataFrame, length: int) -> DataFrame:
    """The spans (start from the anchor, size) of the strings of each part that occur in
    another part around its core. All parts of a core come one after the other."""

    def compared(held: list[tuple]) -> Iterator[tuple]:
        for row, own in zip(held, shared_strings([r[4:] for r in held], _step(length)), strict=True):
            if own:
                low, high = -row[1] - own[-1], -row[1] - own[0]
                one = high - low + 1 == len(own)
                spans = [(low, high - low + length)] if one else [(-row[1] - before, length) for before in own]
                yield (*row[:4], [{"start": at, "size": size} for at, size in spans])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                rows: list[tuple] = []
                for row in zip(*[c.to_pylist() for c in batch.slice(i, 1024).columns], strict=True):
                    if held and row[:2] != held[0][:2]:
                        rows.extend(compared(held))
                        held = []
                    held.append(row)
                yield from _rows(rows, _RUNS)
        yield from _rows(list(compared(held)), _RUNS)

    dealt = sides.repartition("core", "back").sortWithinPartitions("core", "back")
    out = "core bigint, back int, p1 bigint, p2 bigint, spans array<struct<start: int, size: int>>"
    return dealt.select(*_SIDES).mapInArrow(run, out)


def _strings(bodies: DataFrame, length: int) -> DataFrame:
    """All strings of `length` bytes of the named parts of frames: `at` (from the anchor) and
    the digest of the bytes (`s1`, `s2`), beside what names the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = []
                for key, ahead, frame, parts in zip(*[c.to_pylist() for c in batch.slice(i, 256).columns], strict=True):
                    for part in parts:
                        first, end = _part(len(frame), ahead, part["back"], length)
                        for at in range(first, end - length + 1):
                            rows.append((*[part[c] for c in _PART], key, at - ahead, *_numbers(frame[at : at + length])))
                yield from _rows(rows, _STRINGS)

    return bodies.select("key", "ahead", "frame", "parts").mapInArrow(run, _schema(_STRINGS))


def _string_runs(strings: DataFrame, length: int) -> DataFrame:
    """The same as `_side_runs` by digests of all strings, for parts of any number."""
    span = lambda at, size: F.struct(at.cast("int").alias("start"), size.cast("int").alias("size"))
    place = ["s1", "s2", "key", "at"]
    again = strings.groupBy(*place).agg(F.count(F.lit(1)).alias("all")).where("all > 1").select(*place)
    runs = strings.join(again, place, "left_semi").groupBy(*_PART).agg(F.min("at").alias("low"), F.max("at").alias("high"), F.collect_list("at").alias("ats"))
    one = F.col("high") - F.col("low") + 1 == F.size("ats")
    spans = F.when(one, F.array(span(F.col("low"), F.col("high") - F.col("low") + length))).otherwise(
        F.transform("ats", lambda at: span(at, F.lit(length)))
    )
    return runs.select(*_PART, spans.alias("spans"))


def _split_groups(frames: DataFrame, bodies: DataFrame, length: int, longest: bool) -> DataFrame:
    """f1, f2, groups of frames whose buckets do not fit into a task.

    Equal parts are one from here on: of several, the part is a repeat as a whole. Only
    where different parts share a core are their strings compared, of one frame for each.
    Strings that follow one another are given as one span.
    """
    once = bodies.groupBy(*_FRAME_KEY).agg(F.max("key").alias("key"), F.max("ahead").alias("ahead"), F.first("frame").alias("frame"))
    once = once.join(frames.select(*_FRAME_KEY, "n"), _FRAME_KEY)
    once = written(once.withColumn("nr", F.monotonically_increasing_id()), "repeats-split")
    parts = written(_parts(once, length), "repeats-parts")
    different = written(parts.groupBy(*_PART).agg(F.sum("n").alias("n"), F.min("nr").alias("nr")), "repeats-different")
    span = lambda at, size: F.struct(at.cast("int").alias("start"), size.cast("int").alias("size"))
    met = different.groupBy("core", "back").agg(F.count(F.lit(1)).alias("all")).where("all > 1")
    met = written(met.select("core", "back", (F.col("all") > MANY).alias("crowded")), "repeats-met")

    def compared(crowded: bool) -> DataFrame:
        parts = different.join(met.where(F.col("crowded") == crowded), ["core", "back"], "left_semi")
        return once.join(parts.groupBy("nr").agg(F.collect_list(F.struct(*_PART)).alias("parts")), "nr")

    runs = _side_runs(_sides(compared(False), length), length)
    if not met.where("crowded").isEmpty():
        strings = written(_strings(compared(True), length), "repeats-strings")
        runs = runs.unionByName(_string_runs(strings, length))
    several = different.where("n > 1").select(*_PART, F.lit(True).alias("whole"))
    known = several.join(runs, _PART, "full").select(*_PART, "whole", "spans")
    # A frame that stands in several places is a repeat already.
    asking = once.where(F.col("n") == 1) if longest else once
    asked = parts.where(F.col("n") == 1) if longest else parts
    by_frame = asked.select("nr", *_PART).join(known, _PART).groupBy("nr").agg(F.collect_list(F.struct("back", "whole", "spans")).alias("found"))

    def all_spans(one: Column) -> Column:
        first = F.greatest(F.col("ahead") - one["back"] - (_step(length) - 1), F.lit(0))
        end = F.least(F.col("ahead") - one["back"] + length, F.col("length"))
        return F.when(one["whole"], F.array(span(first - F.col("ahead"), end - first))).otherwise(one["spans"])

    def group(span: Column) -> Column:
        # The bytes are needed for the names of the repeats only.
        raw = F.substring(F.col("frame"), span["start"] + F.col("ahead") + 1, span["size"])
        name = F.lit(None).cast("binary") if longest else F.unhex(F.substring(F.sha2(raw, 256), 1, 32))
        return F.struct(name.alias("repeat"), span["start"].alias("start"), span["size"].alias("size"))

    asking = asking.withColumn("length", F.length("frame"))
    opened = (asking.drop("frame") if longest else asking).join(by_frame, "nr")
    return opened.select(*_FRAME_KEY, F.transform(F.flatten(F.transform("found", all_spans)), group).alias("groups"))


def _solved(sources: DataFrame, places: DataFrame, length: int, most: int, longest: bool) -> DataFrame:
    """f1, f2, groups: the repeats of all frames, by start from the anchor and size."""
    columns = [F.max(c).alias(c) for c in ("key", "ahead", "size")]
    name = [] if longest else [F.first("repeat").alias("repeat")]
    counted = written(places.groupBy(*_FRAME_KEY).agg(F.sum(F.size("at")).alias("n"), *columns, *name).where(F.col("size") >= length), "repeats-counted")
    whole = F.struct(F.lit(None).cast("binary").alias("repeat") if longest else F.col("repeat"), (-F.col("ahead")).alias("start"), "size")
    found = counted.where(F.col("n") > 1).select(*_FRAME_KEY, F.array(whole).alias("groups"))

    # A frame that stands in one place has to be compared with the others of its bucket.
    # For the union, a bucket of repeats alone needs no look; their groups may be larger.
    sizes = counted.groupBy("key").agg(F.count(F.lit(1)).alias("n_frames"), F.count_if(F.col("n") == 1).alias("singles"))
    open_ = (F.col("n_frames") > 1) & ((F.col("singles") > 0) | F.lit(not longest))
    sizes = written(sizes.where(open_).select("key", (F.col("n_frames") > most).alias("hot")), "repeats-sizes")
    by_text = places.where(F.col("size") >= length).select("hi", "lo", "key").join(sizes, "key")
    wanted = by_text.groupBy("hi", "lo").agg(F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hots"))
    bodies = written(_bodies(sources.drop("keys").join(wanted, ["hi", "lo"]), length), "repeats-bodies")
    found = found.unionByName(_bucket_groups(bodies.where(~F.col("hot")), length, longest))
    hot = sizes.where("hot").select("key")
    if hot.isEmpty():
        return found
    return found.unionByName(_split_groups(counted.join(hot, "key", "left_semi"), bodies.where("hot"), length, longest))


# --- passages by words ------------------------------------------------------------------

_WORDS = ["core", "p1", "p2"]  # equal parts of stretches; 128 bits of place and words
_WORD_PARTS = {name: pa.int64() for name in ("hi", "lo", "n", "core", "at", "size", "p1", "p2")}
_WINDOWS = {"hi": pa.int64(), "lo": pa.int64(), "at": pa.int64(), "several": pa.bool_(), "s1": pa.int64(), "s2": pa.int64()}


def _words_at(raw: bytes) -> tuple[list[int], list[int]]:
    """Where the words of a text begin and end."""
    spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    return [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(raw)]


def _word_parts(sources: DataFrame, words: int) -> DataFrame:
    """The parts of the stretches of the wanted keys, by first window and number of windows:
    equal windows stand at one place from the anchor, so in equal parts; `core` is a digest of
    the part's place and of the words that all windows there hold."""
    step = max(1, width_of(words) // 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part, rows = batch.slice(i, 64), []
                texts = _worded(_raw(part))
                given = zip(*[part.column(c).to_pylist() for c in ("hi", "lo", "n", "keys")], strict=True)
                for raw, (hi, lo, n, wanted), (*found, keys) in zip(texts, given, stretches(texts, words, hashes), strict=True):
                    use = np.isin(keys, wanted)
                    if not use.any():
                        continue
                    starts, ends = _words_at(raw)
                    for at, size, anchor in zip(*[c[use].tolist() for c in found], strict=True):
                        while size:
                            # The windows from `at` up to the next place that `step` divides, counted back.
                            last = anchor - (anchor - at) // step * step
                            own = min(size, last - at + 1)
                            core = _numbers(b"%d:" % (anchor - last) + raw[starts[last] : ends[last - step + words]])[0]
                            whole = _numbers(b"%d:" % (anchor - at) + raw[starts[at] : ends[at + own + words - 2]])
                            rows.append((hi, lo, n, core, at, own, *whole))
                            at, size = at + own, size - own
                yield from _rows(rows, _WORD_PARTS)

    return sources.select("hi", "lo", "n", "text", "keys").mapInArrow(run, _schema(_WORD_PARTS))


def _windows(sources: DataFrame, words: int) -> DataFrame:
    """All windows of the named parts of texts with the digest of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part, rows = batch.slice(i, 64), []
                given = zip(*[part.column(c).to_pylist() for c in ("hi", "lo", "asked")], strict=True)
                for raw, (hi, lo, asked) in zip(_worded(_raw(part)), given, strict=True):
                    starts, ends = _words_at(raw)
                    for one in asked:
                        for at in range(one["at"], one["at"] + one["size"]):
                            rows.append((hi, lo, at, one["several"], *_numbers(raw[starts[at] : ends[at + words - 1]])))
                yield from _rows(rows, _WINDOWS)

    return sources.select("hi", "lo", "text", "asked").mapInArrow(run, "hi bigint, lo bigint, at bigint, several boolean, s1 bigint, s2 bigint")


def _shared_words(sources: DataFrame, words: int) -> DataFrame:
    """hi, lo, n_shared_words: the words of each text that stand in a window which another
    document has, too."""
    parts = written(_word_parts(sources, words), "repeats-word-parts")
    texts = [f(c).alias(f"{name}_{c}") for f, name in ((F.min, "min"), (F.max, "max")) for c in ("hi", "lo")]
    apart = (F.col("min_hi") != F.col("max_hi")) | (F.col("min_lo") != F.col("max_lo"))
    one = [F.first(c).alias(f"one_{c}") for c in ("hi", "lo", "at")]
    known = parts.groupBy(*_WORDS).agg(*texts, F.max("n").alias("n"), *one)
    known = known.select(*_WORDS, "one_hi", "one_lo", "one_at", ((F.col("n") > 1) | apart).alias("several"))
    known = written(known, "repeats-word-parts-known")

    # A part of one document is compared with the others around its core, each of them once.
    open_ = known.groupBy("core").agg(F.count(F.lit(1)).alias("all"), F.count_if(~F.col("several")).alias("singles"))
    open_ = open_.where("all > 1 and singles > 0").select("core")
    first = (F.col("hi") == F.col("one_hi")) & (F.col("lo") == F.col("one_lo")) & (F.col("at") == F.col("one_at"))
    asked = parts.join(known.join(open_, "core", "left_semi"), _WORDS).where(~F.col("several") | first)
    asked = asked.groupBy("hi", "lo").agg(F.collect_list(F.struct("at", "size", "several")).alias("asked"))
    windows = written(_windows(sources.select("hi", "lo", "text").join(asked, ["hi", "lo"]), words), "repeats-windows")
    again = windows.groupBy("s1", "s2").agg(*texts, F.max("several").alias("several")).where(F.col("several") | apart)
    single = windows.where(~F.col("several")).join(again.select("s1", "s2"), ["s1", "s2"], "left_semi").withColumn("size", F.lit(1).cast("bigint"))

    whole = parts.join(known.where("several").select(*_WORDS), _WORDS, "left_semi")
    spans = whole.select("hi", "lo", "at", "size").unionByName(single.select("hi", "lo", "at", "size"))
    ends = F.struct("at", (F.col("at") + F.col("size") + (words - 1)).alias("end"))
    spans = spans.groupBy("hi", "lo").agg(F.sort_array(F.collect_list(ends)).alias("spans"))
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    more = lambda had, span: F.struct(
        (had["n"] + F.greatest(span["end"] - F.greatest(span["at"], had["end"]), F.lit(0))).cast("bigint").alias("n"),
        F.greatest(had["end"], span["end"]).alias("end"),
    )
    return spans.select("hi", "lo", F.aggregate("spans", none, more, lambda had: had["n"]).alias("n_shared_words"))


# --- results -------------------------------------------------------------------------


class Found:
    """What was found in the texts of `docs`, for as long as the block lasts: `sources` (hi,
    lo, n, salt, text, of the texts that share anything) and `occurrences` (hi, lo, at,
    groups); with `longest` no more of the groups than their union needs. With `words` also
    `shared` (hi, lo, n_shared_words).

    The sources lie in buckets by digest, so what is found out about them comes to them and
    their texts are shuffled once. The table is taken out of the catalog again at the end."""

    def __init__(self, docs: DataFrame, length: int = LENGTH, most: int = MOST, longest: bool = False, words: int | None = None):
        self.spark, self.length = docs.sparkSession, length
        texts = docs.select(*_digest(), F.coalesce("text", F.lit("")).alias("text"), _dealt().alias("salt"))
        anchors = written(_anchored(texts, length, words), "repeats-anchors")
        again = anchors.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
        once = texts.groupBy("hi", "lo").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"), F.min("salt").alias("salt"))
        close = once.join(_keys_by_text(anchors, again), ["hi", "lo"], "left").where(F.col("keys").isNotNull() | (F.col("n") > 1))
        self.table = f"repeats_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = work_folder(self.spark, "repeats-sources")
        close.write.bucketBy(buckets, "hi", "lo").sortBy("hi", "lo").option("path", path).saveAsTable(self.table)
        try:
            self.sources = self.spark.table(self.table)
            with_keys = self.sources.where(F.col("keys").isNotNull())
            places = written(_places(with_keys, length, not longest), "repeats-places")
            solved = written(_solved(with_keys, places, length, most, longest), "repeats-groups")
            merged = solved.groupBy(*_FRAME_KEY).agg(F.flatten(F.collect_list("groups")).alias("groups"))
            self.occurrences = places.join(merged, _FRAME_KEY).select("hi", "lo", "at", "groups")
            self.shared = _shared_words(with_keys, words) if words else None
        except BaseException:
            self.__exit__()
            raise

    def __enter__(self) -> Found:
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def groups(docs: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """Every occurrence of the maximal repeats of the different texts: the text's digest (hi,
    lo), start and size in bytes, and `repeat`, the digest of the repeat's bytes."""
    with Found(docs, length, most) as found:
        opened = found.occurrences.select("hi", "lo", F.explode("at").alias("at"), "groups")
        opened = opened.select("hi", "lo", "at", F.explode("groups").alias("one"))
        start = (F.col("at") + F.col("one.start")).alias("start")
        return written(opened.select("hi", "lo", start, "one.size", "one.repeat").distinct(), "repeats-all")


_CHANGED = {"hi": pa.int64(), "lo": pa.int64(), "n": pa.int64(), "salt": pa.int32(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()}


def _changed(found: Found) -> DataFrame:
    """hi, lo, n, salt, n_removed, n_spans, kept of the texts that lose bytes."""
    length = found.length
    flat = F.transform("groups", lambda g: F.struct(g["start"].alias("start"), g["size"].alias("size")))
    spans = found.occurrences.groupBy("hi", "lo").agg(F.collect_list(F.struct("at", flat.alias("spans"))).alias("found"))
    joined = found.sources.select("hi", "lo", "n", "salt", "text").join(spans, ["hi", "lo"], "left")
    joined = joined.where(F.col("found").isNotNull() | ((F.col("n") > 1) & (F.octet_length("text") >= length)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part, rows = batch.slice(i, 64), []
                given = zip(*[part.column(c).to_pylist() for c in ("hi", "lo", "n", "salt", "found")], strict=True)
                for raw, (hi, lo, n, salt, own) in zip(_raw(part), given, strict=True):
                    if n > 1 and len(raw) >= length:
                        gone = [(0, len(raw))]
                    else:
                        gone = union([(a + s["start"], a + s["start"] + s["size"]) for o in own for s in o["spans"] for a in o["at"]])
                    bounds = [0, *(x for span in gone for x in span), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                    rows.append((hi, lo, n, salt, len(raw) - len(kept), len(gone), kept))
                yield from _rows(rows, _CHANGED)

    return joined.select("hi", "lo", "n", "salt", "text", "found").mapInArrow(
        run, "hi bigint, lo bigint, n bigint, salt int, n_removed bigint, n_spans bigint, kept binary"
    )


def cut(docs: DataFrame, length: int = LENGTH, most: int = MOST, with_kept: bool = True, words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, `kept`: the remaining
    bytes, which need not be whole characters. Without them no text moves for the result.
    With `words` also n_shared_words: the words in runs of so many that another document has,
    too, whether they are removed or not."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    with Found(docs, length, most, longest=True, words=words) as found:
        changed = _changed(found).withColumn("after", F.sha2("kept", 256))
        changed = changed if with_kept else changed.drop("kept")
        if words:
            shared = found.sources.select("hi", "lo", "n", "salt").join(found.shared, ["hi", "lo"])
            changed = changed.join(shared, ["hi", "lo", "n", "salt"], "full")
        changed = written(changed, "repeats-changed")
    # A text that stands in several documents is under all salts, any other under that of its own.
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    changed = changed.withColumn("salt", F.explode(F.when(F.col("n") > 1, every).otherwise(F.array("salt")))).drop("n")
    whole = [F.encode("text", "UTF-8").alias("whole")] if with_kept else []
    rows = docs.select("doc_id", *_digest(), F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("before"), *whole)
    # Repeated rows become one with a number, so no text holds more rows than it has documents.
    key = ["doc_id", "hi", "lo", "n_bytes", "before"]
    rows = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), *[F.first("whole").alias("whole") for _ in whole])
    joined = rows.withColumn("salt", _dealt()).join(changed, ["hi", "lo", "salt"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_removed", "n_spans", *(["n_shared_words"] if words else []))]
    out = [
        "doc_id",
        "n_bytes",
        *counts[:2],
        F.coalesce("after", "before").alias("kept_sha256"),
        *counts[2:],
        *[F.coalesce("kept", "whole").alias("kept") for _ in whole],
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row"),
    ]
    return joined.select(*out).drop("_row")
