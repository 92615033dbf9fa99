"""Operator 7: language-model scores of a hashed maximum-entropy model.

The tokens of a text are its words and one end. Every token is counted over all training
documents. The most frequent ones (`HEAD`) are dealt by rank to classes of equal size;
the others are one more class, `rare`, in which a token's probability follows its count.
The model gives

    log P(token | before) = log P(class | before) + log P(token | class, before)

with two softmaxes of hashed features: the word before, the pair of words before, and the
word before that alone (a skip). The features of the second one are hashed together with
the class. Both start at the counts, so an untrained model is the unigram model.

Training goes through all training documents once, in `rounds`. In a round each task
starts from the same weights and makes gradient steps over its share in sparse numpy
batches; the changes are averaged by numbers of tokens, block by block of the weights,
in two steps of sums. What returns to the driver has the model's fixed size.

Counts beyond the `KNOWN` most frequent tokens do not go to the tasks: documents send
such tokens to where the counts are, and get sums back.

Cases: a null or empty text is its end alone; a null doc_id counts as held out; repeated
documents are learned and scored each; without training documents every score is that
of an empty vocabulary; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import importable, texts, written

END = b""  # no word is empty
CLASSES, MEMBERS = 32, 32
HEAD = CLASSES * MEMBERS
RARE_KEYS = 4096  # hashed histories of tokens outside the head
KNOWN = 100_000
ROWS = 1 << 14  # hashed feature rows of each softmax
BLOCK = 256  # rows of a block of weights
BATCH = 8192
SHORT = 8  # members of a run that are added one after the other
RATE = 0.5
SALTS = 16
SMOOTH = 0.1
START = HEAD + RARE_KEYS  # history before the text
_MOST = np.float32(60)  # of a score; what exceeds it would not fit its exponential

_MIX1, _MIX2, _MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, then the end."""
    return [*text.encode().lower().split(), END]


def counts(training: DataFrame) -> DataFrame:
    """token and n over all texts; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[bytes] = Counter()
            for text in texts(batch):
                seen.update(tokens(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"]
            )

    return training.select("text").mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """Totals, and the most frequent tokens with their counts, in order."""

    total: int
    kinds: int
    known: tuple[bytes, ...]
    n: tuple[int, ...]


def vocabulary(counted: DataFrame, known: int = KNOWN) -> Vocabulary:
    """Runs two jobs. What comes back has a bounded size: sums by step of the counts'
    logarithm, then the tokens of the highest steps that hold no more than `known`."""
    step = F.floor(F.log2("n") * 8)
    sums = counted.groupBy(step.alias("step")).agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).collect()
    room, least = known, None
    for row in sorted(sums, key=lambda r: -r["step"]):
        room -= row["kinds"]
        if room < 0:
            break
        least = row["step"]
    top = [] if least is None else counted.where(step >= least).collect()
    top = sorted(((bytes(r["token"]), r["n"]) for r in top), key=lambda r: (-r[1], r[0]))
    return Vocabulary(sum(r["n"] for r in sums), sum(r["kinds"] for r in sums), tuple(t for t, _ in top), tuple(n for _, n in top))


class Model:
    """Weights of the two softmaxes; a row per hashed feature."""

    def __init__(self, vocabulary: Vocabulary, to_class: np.ndarray, to_member: np.ndarray):
        self.to_class, self.to_member = to_class, to_member
        head = np.zeros(HEAD)
        top = vocabulary.n[:HEAD]
        head[: len(top)] = top
        rare = vocabulary.total - head.sum()
        by_class = np.append(head.reshape(CLASSES, MEMBERS).sum(1), rare + SMOOTH)
        # Members of the head that no token has are out of reach of both softmaxes.
        with np.errstate(divide="ignore"):
            self.class_bias = np.maximum(np.log(by_class / by_class.sum()), -60).astype(np.float32)
            members = head.reshape(CLASSES, MEMBERS)
            share = members / np.maximum(members.sum(1, keepdims=True), 1)
            self.member_bias = np.maximum(np.log(share), -60).astype(np.float32)

    def features(self, ids: np.ndarray, classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of both softmaxes for every position; `first` marks where texts begin."""
        before, second = np.empty_like(ids), np.empty_like(ids)
        before[1:], before[:1] = ids[:-1], START
        before[first] = START
        second[1:], second[:1] = before[:-1], START
        second[first] = START
        a, b = before.astype(np.uint64), second.astype(np.uint64)
        keys = np.stack([a * _MIX1, (a * _MIX1) ^ (b * _MIX2 + np.uint64(1)), b * _MIX3 + np.uint64(2)], 1)
        rows = _row(keys)
        return rows, _row(keys + (classes.astype(np.uint64) * _MIX2)[:, None])

    def chances(self, rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Softmax probabilities of each position."""
        scores = weights.take(rows[:, 0], axis=0)
        for i in range(1, rows.shape[1]):
            scores += weights.take(rows[:, i], axis=0)
        scores += bias
        np.minimum(scores, _MOST, out=scores)
        np.exp(scores, out=scores)
        scores *= (1 / (scores @ np.ones(scores.shape[1], np.float32)))[:, None]
        return scores

    def log10(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per position: of the class, and within it unless it is the rare one."""
        out = np.empty(len(ids))
        classes = np.minimum(ids // MEMBERS, CLASSES)
        rows, member_rows = self.features(ids, classes, first)
        for at in range(0, len(ids), BATCH):
            cut = slice(at, at + BATCH)
            c = classes[cut]
            own = self.chances(rows[cut], self.to_class, self.class_bias)[np.arange(len(c)), c].astype(np.float64)
            head = np.flatnonzero(c < CLASSES)
            of = self.chances(member_rows[cut][head], self.to_member, self.member_bias[c[head]])
            own[head] *= of[np.arange(len(head)), ids[cut][head] % MEMBERS]
            out[cut] = np.log10(np.maximum(own, 1e-30))
        return out

    def learn(self, ids: np.ndarray, first: np.ndarray) -> None:
        """Gradient steps over the positions, a batch at a time."""
        classes = np.minimum(ids // MEMBERS, CLASSES)
        rows, member_rows = self.features(ids, classes, first)
        for at in range(0, len(ids), BATCH):
            cut = slice(at, at + BATCH)
            c = classes[cut]
            gradient = self.chances(rows[cut], self.to_class, self.class_bias)
            gradient[np.arange(len(c)), c] -= 1
            _descend(self.to_class, rows[cut], gradient)
            head = np.flatnonzero(c < CLASSES)
            if len(head):
                gradient = self.chances(member_rows[cut][head], self.to_member, self.member_bias[c[head]])
                gradient[np.arange(len(head)), ids[cut][head] % MEMBERS] -= 1
                _descend(self.to_member, member_rows[cut][head], gradient)


def _row(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * _MIX1
    return (keys >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)


def _descend(weights: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One step for each feature; a row's gradient is the mean over its positions,
    weighted down where it has few."""
    for i in range(rows.shape[1]):
        own = rows[:, i].astype(np.uint16)  # sorted in linear time
        order = np.argsort(own, kind="stable")
        sorted_rows = own[order]
        begin = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
        n = np.diff(np.append(begin, len(order)))
        step = _sums(gradient, order, begin, n)
        step *= (RATE / rows.shape[1] / (n + 4)).astype(np.float32)[:, None]
        at = sorted_rows[begin]
        weights[at] = np.subtract(weights.take(at, axis=0), step, out=step)


def _sums(gradient: np.ndarray, order: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the gradient over runs of `order`. Most runs are short: their first members
    are taken at once, then their second ones, and so on. A sum per run and column, which
    costs a call each, is left for the few long ones."""
    sums = gradient.take(order[begin], axis=0)
    short = np.flatnonzero((n > 1) & (n <= SHORT))
    for j in range(1, SHORT):
        short = short[n[short] > j]
        if not len(short):
            break
        sums[short] += gradient.take(order[begin[short] + j], axis=0)
    long = n > SHORT
    if long.any():
        members = gradient.take(order[np.repeat(long, n)], axis=0)
        ends = np.cumsum(n[long])
        sums[long] = np.add.reduceat(members, ends - n[long], axis=0)
    return sums


class Lookup(dict):
    """What a task needs to number and count tokens: a place for each, of known tokens by
    rank, of others in the order they are met, remembered while they are few."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(zip(vocabulary.known, range(len(vocabulary.known))))
        self.known = len(vocabulary.known)
        self._first = dict(self)
        self._ids = np.array([*range(min(self.known, HEAD)), *map(_rare_id, vocabulary.known[HEAD:])], np.int64)
        self._others = array("q")
        self._counts = np.array([*vocabulary.n, 0], np.float64)

    def __missing__(self, token: bytes) -> int:
        made = self[token] = self.known + len(self._others)
        self._others.append(_rare_id(token))
        return made

    def places(self, of_texts: list[list[bytes]]) -> np.ndarray:
        """Places of the tokens of some texts end to end; good until the next call."""
        if len(self._others) > 200_000:
            self.clear()
            self.update(self._first)
            self._others = array("q")
        every = map(self.__getitem__, chain.from_iterable(of_texts))
        return np.fromiter(every, np.int64, sum(map(len, of_texts)))

    def ids(self, places: np.ndarray) -> np.ndarray:
        """Of the head by rank, of others by hash."""
        return np.append(self._ids, np.array(self._others, np.int64))[places]

    def counts(self, places: np.ndarray) -> np.ndarray:
        return self._counts[np.minimum(places, self.known)]


def _rare_id(token: bytes) -> int:
    return HEAD + zlib.crc32(token) % RARE_KEYS


def _begins(of_texts: list[list[bytes]]) -> np.ndarray:
    """Where each text begins when they stand end to end."""
    lengths = np.array([len(one) for one in of_texts], np.int64)
    return np.cumsum(lengths) - lengths


def _empty() -> np.ndarray:
    return np.zeros((ROWS, CLASSES + 1), np.float32)


def train(training: DataFrame, vocabulary: Vocabulary, rounds: int = 2) -> Model:
    """The model after all rounds; each document belongs to one of them."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary._replace(known=vocabulary.known[:HEAD], n=vocabulary.n[:HEAD]))
    weights = (_empty(), np.zeros((ROWS, MEMBERS), np.float32))
    turn = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).cast("bigint"), F.lit(10 * rounds))
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(weights)
        part = training.where(F.floor(turn / 10) == number).select("text")
        changes = _summed(part.mapInArrow(lambda batches: _changes(batches, shared.value, sent.value), _CHANGE))
        made = [w.copy() for w in weights]
        for row in changes.collect():
            at = row["block"] * BLOCK
            change = np.frombuffer(row["change"], np.float32).reshape(BLOCK, -1)
            made[row["part"]][at : at + BLOCK] += change / max(row["n"], 1)
        weights = (made[0], made[1])
        sent.unpersist()
    return Model(vocabulary, *weights)


_CHANGE = "part int, block int, salt int, n double, change binary"


def _changes(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, weights) -> Iterator[pa.RecordBatch]:
    """What a task's documents change in the weights, times their number of tokens."""
    model = Model(vocabulary, weights[0].copy(), weights[1].copy())
    lookup, seen = Lookup(vocabulary), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            of_texts = [tokens(t) for t in texts(batch.slice(at, 256))]
            ids = lookup.ids(lookup.places(of_texts))
            model.learn(ids, _begins(of_texts))
            seen += len(ids)
    if not seen:
        return
    context = TaskContext.get()
    salt = context.partitionId() % SALTS if context else 0
    for part, (new, old) in enumerate(((model.to_class, weights[0]), (model.to_member, weights[1]))):
        change = (new - old) * np.float32(seen)
        blocks = range(0, ROWS, BLOCK)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part] * len(blocks), pa.int32()),
                "block": pa.array(range(len(blocks)), pa.int32()),
                "salt": pa.array([salt] * len(blocks), pa.int32()),
                "n": pa.array([float(seen)] * len(blocks), pa.float64()),
                "change": pa.array([change[at : at + BLOCK].tobytes() for at in blocks], pa.binary()),
            }
        )


def _summed(changes: DataFrame) -> DataFrame:
    """Sums per block, first within a salt and then over the salts; a group is read
    batch by batch and only its sum is held."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, key = None, 0.0, None
        for batch in batches:
            for row in batch.to_pylist():
                change = np.frombuffer(row["change"], np.float32)
                total = change.copy() if total is None else total + change
                n += row["n"]
                key = row
        yield pa.RecordBatch.from_pylist(
            [{"part": key["part"], "block": key["block"], "salt": key["salt"], "n": n, "change": total.tobytes()}], schema=_ARROW_CHANGE
        )

    by_salt = changes.groupBy("part", "block", "salt").applyInArrow(add, _CHANGE)
    return by_salt.groupBy("part", "block").applyInArrow(add, _CHANGE)


_ARROW_CHANGE = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("salt", pa.int32()), ("n", pa.float64()), ("change", pa.binary())]
)

_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, n_rare bigint, n_far bigint, known_logs double, "
    "rare_logs double, model_logs double, digest binary, far array<struct<token: binary, n: bigint>>"
)


def score(docs: DataFrame, counted: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    sent = spark.sparkContext.broadcast((model.to_class, model.to_member))
    total, kinds = vocabulary.total, vocabulary.kinds
    base_below = math.log10(total + SMOOTH * (kinds + 1))
    n_head = min(kinds, HEAD)
    rare_below = math.log10(total - sum(vocabulary.n[:HEAD]) + SMOOTH * (kinds - n_head + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value, *sent.value)
        lookup = _lookup(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield _scored(own, lookup, batch.slice(at, 256))

    wanted = docs.select("text", F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"))
    scored = written(wanted.mapInArrow(run, _SCORED), "language-scores")

    # Rows of one doc_id and text share a digest; their sums are divided among them.
    sending = scored.where("n_far > 0")
    asked = sending.select("digest", F.explode("far").alias("f")).select("digest", "f.token", F.col("f.n").alias("times"))
    met = asked.join(counted, "token", "left")
    logs = F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("all_logs")
    back = met.groupBy("digest").agg(logs, F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("all_known"))
    back = back.join(sending.groupBy("digest").agg(F.count("*").alias("rows")), "digest").select(
        "digest", (F.col("all_logs") / F.col("rows")).alias("far_logs"), F.expr("all_known div rows").alias("far_known")
    )
    far_logs, far_known = F.coalesce("far_logs", F.lit(0.0)), F.coalesce("far_known", F.lit(0))
    return scored.join(back, "digest", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + far_known).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("known_logs") + far_logs - F.col("n_tokens") * F.lit(base_below)).alias("base_score"),
        (F.col("model_logs") + F.col("rare_logs") + far_logs - F.col("n_rare") * F.lit(rare_below)).alias("score"),
    )


_lookups: dict[int, Lookup] = {}


def _lookup(shared) -> Lookup:
    """One lookup per worker and vocabulary."""
    key = hash(shared.value.known[:100]) ^ shared.value.total
    if key not in _lookups:
        _lookups.clear()
        _lookups[key] = Lookup(shared.value)
    return _lookups[key]


def _scored(model: Model, lookup: Lookup, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Everything about some documents but the counts of tokens beyond the known ones."""
    of_texts = [tokens(t) for t in texts(batch)]
    places, first = lookup.places(of_texts), _begins(of_texts)
    ids, counted = lookup.ids(places), lookup.counts(places)
    logs = np.add.reduceat(model.log10(ids, first), first) if len(first) else np.zeros(0)
    rows = {name: [] for name in ("n_tokens", "n_known", "n_rare", "n_far", "known_logs", "rare_logs", "digest", "far")}
    begin = 0
    for doc_id, one in zip(batch.column(1).to_pylist(), of_texts, strict=True):
        cut = slice(begin, begin + len(one))
        begin += len(one)
        rare, n = ids[cut] >= HEAD, counted[cut]
        near = n > 0
        far = Counter(one[i] for i in np.flatnonzero(places[cut] >= lookup.known))
        log = np.log10(n[near] + SMOOTH)
        rows["n_tokens"].append(len(one))
        rows["n_known"].append(int(near.sum()))
        rows["n_rare"].append(int(rare.sum()))
        rows["n_far"].append(len(far))
        rows["known_logs"].append(float(log.sum()))
        rows["rare_logs"].append(float(log[rare[near]].sum()))
        rows["digest"].append(hashlib.blake2b(b"%a " % doc_id + b" ".join(one), digest_size=16).digest())
        rows["far"].append([{"token": t, "n": c} for t, c in far.items()])
    kind = {"digest": pa.binary(), "known_logs": pa.float64(), "rare_logs": pa.float64()}
    kind["far"] = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))
    made = {name: pa.array(values, kind.get(name, pa.int64())) for name, values in rows.items()}
    made |= {"doc_id": batch.column(1), "held_out": batch.column(2), "model_logs": pa.array(logs, pa.float64())}
    names = [part.split(" ")[0].rstrip(":") for part in _SCORED.split(", ") if not part.startswith("n: ")]
    return pa.RecordBatch.from_arrays([made[name] for name in names], names=names)


def held_out(of: str = "doc_id"):
    """Documents not learned from: crc32 of the id as text divisible by ten."""
    return F.coalesce(F.crc32(F.col(of).cast("bigint").cast("string").cast("binary")) % 10 == 0, F.lit(True))


def scores(docs: DataFrame, rounds: int = 2, known: int = KNOWN) -> DataFrame:
    """Counts, trains and scores; runs jobs and writes two tables under the shared folder."""
    importable(docs.sparkSession)
    training = docs.where(~held_out())
    counted = written(counts(training), "language-counts")
    found = vocabulary(counted, known)
    return score(docs, counted, found, train(training, found, rounds))
