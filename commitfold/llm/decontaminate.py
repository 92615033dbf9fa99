"""Operator 4: benchmark decontamination with a generalised suffix automaton.

Benchmark items are normalised to words and go into one automaton of all their runs of
words. The words of each document are streamed through it; the state tracks the longest
run ending at a word that some item contains. Where that length reaches the window, the
window's words are hit, and the items are those of the state that the window belongs to.
An item shorter than the window is hit where the whole of it ends.

Items are taken in blocks of a fixed number of words (a longer item is laid out over
several, overlapping by a window less a word), so an automaton has a bounded size
whatever the benchmark's. Documents pass the blocks one after the other in place,
without a shuffle; between blocks the lineage is cut by a written table.

Cases: null and empty texts have no words, no hits and are not contaminated; an item
without words is ignored; rows of one item_id are one item, a null item_id has an empty
name; repeated documents give repeated results; an empty benchmark hits nothing; an
empty table gives an empty table; other columns of the documents pass in `removed`,
whatever their names, and in `matched` unless they have a name that it adds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import importable, replaced, sheltered, texts, written

WINDOW = 13
BLOCK_WORDS = 100_000

# Bytes of words stay, A-Z in lower case; everything else ends a word.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Automaton:
    """All runs of words of some items. State 0 is the empty run."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.windows: dict[int, set[str]] = {}  # by the state that a window of the length belongs to
        self.short: dict[int, list[tuple[int, str]]] = {}  # by state: length and name of whole items
        items = [(name, run) for name, run in items if run]
        for _, run in items:
            last = 0
            for word in run:
                last = self._extend(last, word)
        # The last state up the links, itself included, whose runs are a window or longer:
        # links lead to shorter runs, so in order of length the one above is known.
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.window_state = list(range(len(self.link)))
        for state in by_length:
            above = self.link[state]
            if self.length[above] >= window:
                self.window_state[state] = self.window_state[above]
        for name, run in items:
            self._name(name, run)
        # The nearest state up the links, itself included, at which a short item ends.
        self.to_short = [-1] * len(self.link)
        for state in by_length:
            self.to_short[state] = state if state in self.short else self.to_short[self.link[state]]

    def _state(self, length: int, link: int, onward: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(onward)
        return len(self.link) - 1

    def _split(self, state: int, word: bytes, to: int) -> int:
        """A state of its own for the runs of `to` that are no longer than one word more than `state`'s."""
        copy = self._state(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        """The state of the run `last` goes on to with a word."""
        to = self.next[last].get(word)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            to = self.next[last][word]
            self.link[new] = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        return new

    def _name(self, name: str, run: list[bytes]) -> None:
        """Notes the item at the states of its windows, or of the whole of a short one."""
        state = 0
        for i, word in enumerate(run):
            state = self.next[state][word]
            if i + 1 >= self.window:
                self.windows.setdefault(self.window_state[state], set()).add(name)
        if len(run) < self.window:
            self.short.setdefault(state, []).append((len(run), name))

    def hits(self, run: list[bytes]) -> tuple[list[int], set[str]]:
        """Joined [start, end) pairs of hit words, flat, and the names of the items."""
        spans: list[int] = []
        found: set[str] = set()
        window, link, length, onward = self.window, self.link, self.length, self.next
        short, to_short = self.short, self.to_short
        state = matched = 0
        here = onward[0]
        for i, word in enumerate(run):
            to = here.get(word)
            if to is None:
                if not state:
                    continue
                while to is None and state:
                    state = link[state]
                    to = onward[state].get(word)
                matched = length[state]
                if to is None:
                    here = onward[0]
                    continue
            state, matched = to, matched + 1
            here = onward[state]
            reach = 0
            if matched >= window:
                reach = window
                found |= self.windows[self.window_state[state]]
            if short:
                at = to_short[state]
                while at >= 0:
                    for size, name in short[at]:
                        if size <= matched:
                            reach = max(reach, size)
                            found.add(name)
                    at = to_short[link[at]] if at else -1
            if reach:
                start = i + 1 - reach
                while spans and spans[-1] >= start:
                    start = min(start, spans[-2])
                    del spans[-2:]
                spans += [start, i + 1]
        return spans, found


@lru_cache(maxsize=1)
def _built(block: tuple[tuple[str, bytes], ...], window: int) -> Automaton:
    return Automaton([(name, run.split()) for name, run in block], window)


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[tuple]:
    """The items as (name, words) rows, in blocks of at most `block_words` words (or one
    window); the driver holds one block at a time."""
    step = max(block_words // 8, window) - (window - 1)

    def lay_out(batches):
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                run = words(text)
                for at in range(0, max(len(run) - (window - 1), min(len(run), 1)), step):
                    part = run[at : at + step + window - 1]
                    rows.append({"name": name, "run": b" ".join(part), "n": len(part)})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("name", pa.string()), ("run", pa.binary()), ("n", pa.int32())]))

    named = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name")
    laid = benchmark.select(named, "text").mapInArrow(lay_out, "name string, run binary, n int")
    block: list[tuple] = []
    size = 0
    for row in laid.toLocalIterator():
        if block and size + row["n"] > block_words:
            yield tuple(block)
            block, size = [], 0
        block.append((row["name"], bytes(row["run"])))
        size += row["n"]
    if block:
        yield tuple(block)


_ADDED = {"n_words": "bigint", "hits": "array<int>", "items": "array<string>"}


def matched(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, keep_text: bool = True
) -> DataFrame:
    """The documents with `n_words`, `hits` ([start, end) word pairs, flat, in order and
    apart) and `items` (sorted names)."""
    importable(docs.sparkSession)
    docs = docs.drop(*_ADDED, "contaminated")
    out = None
    for block in blocks(benchmark, window, block_words):
        if out is not None:
            out = written(out, "decontaminate-block")
        out = _through(docs if out is None else out, block, window)
    out = _through(docs, (), window) if out is None else out
    return out if keep_text else out.drop("text")


def _through(docs: DataFrame, block: tuple, window: int) -> DataFrame:
    """Documents streamed through one block, joined to what earlier blocks found."""
    kept = [f for f in docs.schema.fields if f.name not in _ADDED]
    added = T.StructType(list(kept))
    for name, kind in _ADDED.items():
        added = added.add(name, T.DataType.fromDDL(kind))
    at = docs.columns.index("text")
    names = [f.name for f in kept]
    later = "hits" in docs.columns

    def run(batches):
        own = _built(block, window)
        for batch in batches:
            for begin in range(0, max(batch.num_rows, 1), 512):
                part = batch.slice(begin, 512)
                n_words, spans, items = [], [], []
                before = zip(part.column("hits").to_pylist(), part.column("items").to_pylist()) if later else None
                for text in part.column(at).to_pylist():
                    of_text = words(text)
                    hit, found = own.hits(of_text)
                    if before is not None:
                        earlier, names_before = next(before)
                        hit, found = _union(earlier, hit), found | set(names_before)
                    n_words.append(len(of_text))
                    spans.append(hit)
                    items.append(sorted(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(name) for name in names],
                        pa.array(n_words, pa.int64()),
                        pa.array(spans, pa.list_(pa.int32())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=[*names, *_ADDED],
                )

    return docs.mapInArrow(run, added)


def _union(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and out[-1] >= start:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def judged(found: DataFrame, one_in: int = 20) -> DataFrame:
    """Adds `n_hit` and `contaminated`: some words are hit, and at least one in `one_in`."""
    n_hit = F.aggregate(
        F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2)), F.lit(0).cast("bigint"), lambda n, i: n + F.get("hits", i + 1) - F.get("hits", i)
    )
    found = found.withColumn("n_hit", F.when(F.size("hits") > 0, n_hit).otherwise(F.lit(0).cast("bigint")))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))


def removed(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20) -> DataFrame:
    """The documents that stay: contaminated ones go, and in the others the hit words go
    with what stands between them. Columns as given."""
    docs, restored = sheltered(docs, "text", "n_chars")
    found = judged(matched(docs, benchmark, window), one_in).where(~F.col("contaminated"))

    def strip(batch: pa.RecordBatch) -> list:
        spans = batch.column("hits").to_pylist()
        return [_without(t, s) if s else t for t, s in zip(batch.column("text").to_pylist(), spans, strict=True)]

    return restored(replaced(found.drop("n_words", "items", "n_hit", "contaminated"), "text", strip))


def _without(text: str, spans: list[int]) -> str:
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    out, upto = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        out.append(raw[upto : at[start][0]])
        upto = at[end - 1][1]
    out.append(raw[upto:])
    return b"".join(out).decode()
