"""Operator 9: exact n-gram Jaccard join by set relations.

Texts are sets of hashed word shingles; two link when the Jaccard index reaches the
threshold. Rows with the same words are one class. A task lays out a class once; where
several tasks hold it, its sets are made one as soon as they are kept. Texts never move.

Index. The sets are laid out in blocks of documents, and the entries of a block go to
ranges of the key space as sorted runs. A range counts how many sets hold each key and
answers only for keys that two or more hold; a key that many sets of one block hold is
sent once, with its count. Back at its block, a set whose shared keys are fewer than the
threshold asks for can have no partner and leaves. The others order their keys from the
rarest; a pair must share one of the first few (its prefix), and an index list is the
sets that have a key in their prefix, with its position. Positions and sizes bound the
overlap that a pair can still reach and skip the rest of a list.

Answers. Of the lists a set is in, the set nearest to what all have in common leads, and
each set is compared with the leader it meets most often. A set that links to its leader
takes over the leader's answers: by the triangle inequality of the Jaccard distance, a
set far enough from a leader is far from all its followers, and needs no comparison.
What remains are leaders of different components that share a list, and, where their
distance leaves it open, followers of theirs. Components need no more links than these:
no pair that is left out can join two components.

Cases: a text of fewer words than a shingle is one shingle of all its words; a null text
or one without words has an empty set, links with nothing and keeps its own doc_id;
repeated rows are copies; a null doc_id takes part and never names a component, unless
nothing else does; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import work_folder
from .common import importable, sheltered, written

SHINGLE = 5
PERCENT = 80
KEY_BITS, DOC_BITS = 48, 12
BLOCK_DOCS, BLOCK_KEYS = 1 << DOC_BITS, 1_000_000
RANGE_KEYS = 1_500_000
OFTEN = 64  # sets of a block from which a key is sent once

# Fixed odd multipliers of the places in a shingle.
_PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_FINAL = np.uint64(0xFF51AFD7ED558CCD)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _digest(of_text: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(of_text), digest_size=16).digest()


def _hashed(of_text: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, of_text), np.uint64, len(of_text))


def _shingles(of_texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all shingles of some texts of hashed words, and the number of the text of each."""
    lengths = np.array([len(t) for t in of_texts], np.int64)
    every = np.concatenate(of_texts) if of_texts else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(of_texts)), lengths)
    starts = np.cumsum(lengths) - lengths
    n = max(len(every) - size + 1, 0)
    keys = np.zeros(n, np.uint64)
    for i in range(size):
        keys += _scrambled(every[i : i + n]) * np.uint64(_PLACES[i % len(_PLACES)] + 2 * (i // len(_PLACES)))
    whole = of[:n] == of[size - 1 :] if n else np.zeros(0, bool)
    keys, owners = keys[whole], of[:n][whole]
    # Texts too short for a shingle are one, of another kind than those of full size.
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        own = [
            sum((int(x) * _PLACES[i % len(_PLACES)] for i, x in enumerate(every[starts[t] : starts[t] + lengths[t]])), 77 * int(lengths[t]))
            for t in short
        ]
        keys = np.concatenate([keys, np.array([x & (1 << 64) - 1 for x in own], np.uint64)])
        owners = np.concatenate([owners, short])
    return _scrambled(keys) >> np.uint64(64 - KEY_BITS), owners


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _FINAL
    return x ^ (x >> np.uint64(29))


# --- sorted runs of keys as bytes ------------------------------------------------

_pack = zstandard.ZstdCompressor(level=1).compress
_unpack = zstandard.ZstdDecompressor().decompress


def _packed(ascending: np.ndarray) -> bytes:
    """An ascending run as its steps, like bytes together."""
    steps = np.diff(ascending, prepend=np.uint64(0)).astype("<u8")
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


_ROWS = "zone int, block binary, kind string, keys binary, docs binary, often binary, counts binary"
_ARROW_ROWS = pa.schema(
    [
        ("zone", pa.int32()),
        ("block", pa.binary()),
        ("kind", pa.string()),
        ("keys", pa.binary()),
        ("docs", pa.binary()),
        ("often", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def _block_rows(place: bytes, digests: list[bytes], of_texts: list[np.ndarray], size: int, zone_bits: int) -> Iterator[pa.RecordBatch]:
    """The rows of one block: what its documents are, and a run of entries per zone. The
    place tells blocks of the same documents apart."""
    keys, owners = _shingles(of_texts, size)
    entries = np.unique((keys << np.uint64(DOC_BITS)) | owners.astype(np.uint64))
    keys, owners = entries >> np.uint64(DOC_BITS), (entries & np.uint64(BLOCK_DOCS - 1)).astype(np.uint16)
    n = np.bincount(owners, minlength=len(digests)).astype(np.int64)
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(begin, len(keys)))
    often = np.repeat(times > OFTEN, times)
    name = hashlib.blake2b(place + b"".join(digests), digest_size=12).digest()
    zones = 1 << zone_bits
    row = {
        "zone": int.from_bytes(name[:4], "big") % zones,
        "block": name,
        "kind": "documents",
        "keys": b"".join(digests),
        "docs": n.tobytes(),
        "often": _packed(keys[often]),
        "counts": _pack(owners[often].tobytes()),
    }
    yield pa.RecordBatch.from_pylist([row], schema=_ARROW_ROWS)
    hot_keys, hot_times = keys[begin][times > OFTEN], times[times > OFTEN].astype(np.int64)
    keys, owners = keys[~often], owners[~often]
    shift = np.uint64(KEY_BITS - zone_bits)
    edges = np.searchsorted(keys >> shift, np.arange(zones + 1, dtype=np.uint64))
    hot_edges = np.searchsorted(hot_keys >> shift, np.arange(zones + 1, dtype=np.uint64))
    rows = []
    for zone in range(zones):
        cut, hot = slice(edges[zone], edges[zone + 1]), slice(hot_edges[zone], hot_edges[zone + 1])
        if cut.start < cut.stop or hot.start < hot.stop:
            rows.append(
                {
                    "zone": zone,
                    "block": name,
                    "kind": "entries",
                    "keys": _packed(keys[cut]),
                    "docs": _pack(owners[cut].tobytes()),
                    "often": _packed(hot_keys[hot]),
                    "counts": _pack(hot_times[hot].tobytes()),
                }
            )
    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_ROWS)


def _blocks(batches: Iterator[pa.RecordBatch], size: int, zone_bits: int) -> Iterator[pa.RecordBatch]:
    """Documents gathered into blocks; the same words only once in a task."""
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    seen: set[bytes] = set()
    held: dict[bytes, np.ndarray] = {}
    n = made = 0

    def block() -> Iterator[pa.RecordBatch]:
        return _block_rows(b"%d/%d:" % (task, made), list(held), list(held.values()), size, zone_bits)

    for batch in batches:
        for text in batch.column(0):
            of_text = words(text.as_py())
            digest = _digest(of_text)
            if not of_text or digest in seen:
                continue
            seen.add(digest)
            held[digest] = _hashed(of_text)
            n += len(of_text)
            if len(held) == BLOCK_DOCS or n >= BLOCK_KEYS:
                yield from block()
                held, n, made = {}, 0, made + 1
    if held:
        yield from block()


def _shared_keys(zone: pa.Table) -> pa.Table:
    """Of a zone's entries those whose key another set holds too, with the number of sets."""
    rows = zone.to_pylist()
    out = [r | {"zone": 0} for r in rows if r["kind"] == "documents"]
    rows = [r for r in rows if r["kind"] == "entries"]
    if rows:
        runs = [_unpacked(r["keys"]) for r in rows]
        hot = [_unpacked(r["often"]) for r in rows]
        keys = np.concatenate(runs + hot)
        weight = np.concatenate([np.ones(sum(map(len, runs)), np.int64), *[np.frombuffer(_unpack(r["counts"]), np.int64) for r in rows]])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        sums = np.add.reduceat(weight[order], begin)
        holders = np.empty(len(keys), np.int64)
        holders[order] = np.repeat(sums, np.diff(np.append(begin, len(keys))))
        at, hot_at = 0, sum(map(len, runs))
        for row, run, own_hot in zip(rows, runs, hot, strict=True):
            of_run = holders[at : at + len(run)]
            kept = of_run > 1
            out.append(
                row
                | {
                    "zone": 0,
                    "keys": _packed(run[kept]),
                    "docs": _pack(np.frombuffer(_unpack(row["docs"]), np.uint16)[kept].tobytes() + of_run[kept].tobytes()),
                    "often": _packed(own_hot),
                    "counts": _pack(holders[hot_at : hot_at + len(own_hot)].tobytes()),
                }
            )
            at += len(run)
            hot_at += len(own_hot)
    return pa.Table.from_pylist(out, schema=_ARROW_ROWS)


_SETS = "digest binary, n bigint, keys array<bigint>"


def _sets(block: pa.Table, percent: int) -> pa.Table:
    """The documents of a block with their shared keys, rarest first, or null keys where
    these are too few for any partner."""
    rows = block.to_pylist()
    own = next(r for r in rows if r["kind"] == "documents")
    n = np.frombuffer(own["docs"], np.int64)
    digests = [own["keys"][i : i + 16] for i in range(0, len(own["keys"]), 16)]
    keys, owners, holders, hot, hot_holders = [], [], [], [], []
    for r in rows:
        if r["kind"] == "entries":
            run = _unpacked(r["keys"])
            raw = _unpack(r["docs"])
            keys.append(run)
            owners.append(np.frombuffer(raw[: 2 * len(run)], np.uint16).astype(np.int64))
            holders.append(np.frombuffer(raw[2 * len(run) :], np.int64))
            hot.append(_unpacked(r["often"]))
            hot_holders.append(np.frombuffer(_unpack(r["counts"]), np.int64))
    often = _unpacked(own["often"])
    if len(often):
        known, of_known = np.concatenate(hot), np.concatenate(hot_holders)
        order = np.argsort(known)
        keys.append(often)
        owners.append(np.frombuffer(_unpack(own["counts"]), np.uint16).astype(np.int64))
        holders.append(of_known[order][np.searchsorted(known[order], often)])
    empty = np.zeros(0, np.int64)
    keys, owners, holders = (np.concatenate(x) if x else empty for x in (keys, owners, holders))
    shared = np.bincount(owners, minlength=len(digests))
    lives = (100 * shared >= percent * n) & (n > 0)
    kept = lives[owners] if len(owners) else np.zeros(0, bool)
    keys, owners, holders = keys[kept].astype(np.int64), owners[kept], holders[kept]
    order = np.lexsort((keys, holders, owners))
    keys, owners = keys[order], owners[order]
    edges = np.searchsorted(owners, np.arange(len(digests) + 1))
    lists = [np.asarray(list(dict.fromkeys(keys[edges[i] : edges[i + 1]].tolist())), np.int64) if lives[i] else None for i in range(len(digests))]
    return pa.table(
        {"digest": pa.array(digests, pa.binary()), "n": pa.array(n, pa.int64()), "keys": pa.array(lists, pa.list_(pa.int64()))}
    )


# --- links -------------------------------------------------------------------------


def _can_link(n: str, m: str, percent: int) -> Column:
    """Sizes near enough."""
    return (100 * F.col(n) >= percent * F.col(m)) & (100 * F.col(m) >= percent * F.col(n))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with `far`, their Jaccard distance, and `linked`, decided in whole
    numbers."""
    of = lambda side: sets.select(F.col("digest").alias(side), F.col("n").alias(f"n_{side}"), F.col("keys").alias(f"keys_{side}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").withColumn("both", F.size(F.array_intersect("keys_a", "keys_b")))
    either = F.col("n_a") + F.col("n_b") - F.col("both")
    return met.select(*pairs.columns, (1 - F.col("both") / either).alias("far"), (100 * F.col("both") >= percent * either).alias("linked"))


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of everything that has a link (a, b).

    Every round sends each node to its smallest neighbour and goes on with the links
    between those; the nodes are digests, so about a constant share is left each time.
    """
    links = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    steps: list[DataFrame] = []
    while not links.isEmpty():
        step = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        step = written(step.select("node", F.least("node", "b").alias("to")), "links-step")
        steps.append(step)
        ends = links.join(step.withColumnsRenamed({"node": "a", "to": "to_a"}), "a").join(step.withColumnsRenamed({"node": "b", "to": "to_b"}), "b")
        links = written(ends.where("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "links")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0].withColumnRenamed("to", "component")
    for step in steps[1:]:
        on = step.withColumnsRenamed({"node": "component", "to": "next"})
        found = found.join(on, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return written(found, "components")


def _index(sets: DataFrame, percent: int) -> DataFrame:
    """The lists: key, digest, n, place (of the key in its set) and lonely (the share of
    the set's keys that it alone holds)."""
    alone = F.col("n") - F.size("keys")
    prefix = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1 - alone
    first = sets.where(prefix >= 1).select(
        "digest", "n", alone.alias("alone"), (alone / F.col("n")).alias("lonely"), F.posexplode(F.slice("keys", F.lit(1), prefix.cast("int"))).alias("i", "key")
    )
    return first.select("key", "digest", "n", (F.col("alone") + F.col("i")).alias("place"), "lonely")


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between sets (digest, n, keys rarest first) that have the components of
    all links. Writes tables under the shared folder."""
    lists = written(_index(sets, percent), "index")
    leaders = (
        lists.groupBy("key")
        .agg(F.min(F.struct("lonely", "digest", "n")).alias("lead"), F.count("*").alias("held"))
        .where("held > 1")
        .select("key", F.col("lead.digest").alias("b"), F.col("lead.n").alias("m"))
    )
    meetings = lists.join(leaders, "key").where((F.col("digest") != F.col("b")) & _can_link("n", "m", percent))
    often = meetings.groupBy(F.col("digest").alias("a"), "b").agg(F.count("*").alias("times"))
    best = often.groupBy("a").agg(F.max(F.struct("times", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    followed = written(_compared(best, sets, percent).where("linked").select("a", "b", "far"), "followers")
    found = components(followed)

    # What is still open: lists with sets of more than one component.
    placed = (
        lists.join(found.withColumnRenamed("node", "digest"), "digest", "left")
        .join(followed.select(F.col("a").alias("digest"), F.col("b").alias("lead"), "far"), "digest", "left")
        .select(
            "key", "digest", "n", "place", F.coalesce("component", "digest").alias("component"),
            F.coalesce("lead", "digest").alias("lead"), F.coalesce("far", F.lit(0.0)).alias("far"),
        )
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2")
    placed = written(placed.join(mixed.select("key"), "key"), "open-lists")
    parts = placed.groupBy("key", "component", "lead").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("far").alias("reach"),
        F.max(F.col("n") - F.col("place")).alias("left"),
    )
    one = parts.select("key", *[F.col(c).alias(f"{c}_a") for c in parts.columns[1:]])
    two = parts.select("key", *[F.col(c).alias(f"{c}_b") for c in parts.columns[1:]])
    # The sizes and the places of some pair must leave enough to share.
    sizes = (100 * F.col("most_a") >= percent * F.col("least_b")) & (100 * F.col("most_b") >= percent * F.col("least_a"))
    needed = percent * (F.col("least_a") + F.col("least_b"))
    places = (100 + percent) * F.least("left_a", "left_b") >= needed
    near = one.join(two, "key").where((F.col("component_a") < F.col("component_b")) & sizes & places)
    pairs = near.groupBy(F.col("lead_a").alias("a"), F.col("lead_b").alias("b")).agg(
        F.max("reach_a").alias("reach_a"), F.max("reach_b").alias("reach_b")
    )
    led = written(_compared(pairs.where("a <> b"), sets, percent), "leaders")

    limit = 1 - percent / 100 + 1e-9
    unsure = led.where(~F.col("linked") & (F.col("far") - F.col("reach_a") - F.col("reach_b") <= limit) & (F.col("reach_a") + F.col("reach_b") > 0))
    side = lambda s: placed.select("key", *[F.col(c).alias(f"{c}_{s}") for c in placed.columns[1:]])
    open_pairs = unsure.select(F.col("a").alias("lead_a"), F.col("b").alias("lead_b"), F.col("far").alias("between"))
    open_keys = near.select("key", "lead_a", "lead_b").join(open_pairs, ["lead_a", "lead_b"])
    members = (
        open_keys.join(side("a"), ["key", "lead_a"])
        .join(side("b"), ["key", "lead_b"])
        .where(
            (F.col("component_a") < F.col("component_b"))
            & _can_link("n_a", "n_b", percent)
            & ((100 + percent) * F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= percent * (F.col("n_a") + F.col("n_b")))
            & (F.col("between") - F.col("far_a") - F.col("far_b") <= limit)
        )
    )
    followers = members.select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b")).distinct()
    more = _compared(followers, sets, percent).where("linked").select("a", "b")
    return followed.select("a", "b").union(led.where("linked").select("a", "b")).union(more)


def classes(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, digest of the words and their number, and the columns named besides."""
    kept = ["doc_id", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, n = [], []
            for text in batch.column("text"):  # the words of one text at a time are held
                of_text = words(text.as_py())
                digests.append(_digest(of_text))
                n.append(len(of_text))
            made = [*map(batch.column, kept), pa.array(digests, pa.binary()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=[*kept, "digest", "n_words"])

    numbered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *also)
    return numbered.mapInArrow(run, f"doc_id bigint, {''.join(f'{c} bigint, ' for c in also)}digest binary, n_words bigint")


def _grouped(docs: DataFrame, keyed: DataFrame, first: DataFrame, size: int, percent: int) -> DataFrame:
    """`first`, a row per digest of the written classes, with n_shingles and component (a
    digest)."""
    total = keyed.agg(F.sum("n_words")).first()[0] or 0
    zone_bits = max(2, (max(total, 1) // RANGE_KEYS).bit_length())
    entries = docs.select("text").mapInArrow(lambda batches: _blocks(batches, size, zone_bits), _ROWS)
    answers = entries.groupBy("zone").applyInArrow(_shared_keys, _ROWS)
    sets = answers.groupBy("block").applyInArrow(lambda block: _sets(block, percent), _SETS)
    sets = written(sets, "sets")
    spark, name = docs.sparkSession, f"jaccard_{uuid.uuid4().hex}"
    try:
        live = _kept_by_digest(sets.where("keys is not null"), 1 << zone_bits, name)
        found = written(components(links(live, percent)).withColumnRenamed("node", "digest"), "components")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sizes = sets.groupBy("digest").agg(F.max("n").alias("n_shingles"))
    return first.join(sizes, "digest").join(found, "digest", "left").withColumn("component", F.coalesce("component", "digest"))


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id per document. Runs jobs and writes tables under
    the shared folder."""
    importable(docs.sparkSession)
    keyed = written(classes(docs), "classes")
    first = keyed.where("n_words > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    known = _grouped(docs, keyed, first, size, percent)
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = known.join(named, "component").select("digest", "n_shingles", "component_id")
    full = keyed.join(of_class, "digest", "left")
    return full.select(
        "doc_id",
        F.coalesce("n_shingles", F.lit(0)).cast("bigint").alias("n_shingles"),
        F.when(F.col("n_words") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _kept_by_digest(sets: DataFrame, buckets: int, name: str) -> DataFrame:
    """The sets, each once, as a catalog table in buckets of the digest: joins by it do not
    move them. Sets of one digest are made one before they move, and again where they meet."""
    spark = sets.sparkSession

    def once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            new = [d not in seen and not seen.add(d) for d in digests]
            yield batch.filter(pa.array(new, pa.bool_()))

    once = sets.mapInArrow(once_a_task, sets.schema).repartition(buckets, "digest").dropDuplicates(["digest"])
    writer = once.write.bucketBy(buckets, "digest").sortBy("digest").option("path", work_folder(spark, "live-sets"))
    writer.format("parquet").saveAsTable(name)
    return spark.table(name)


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with the columns given: that of the smallest doc_id,
    rows without one last, and of rows of one doc_id that of the smallest hash. Rows
    without words have no component; of those equal in all columns one stays.

    Rows are told apart by two hashes of what they hold, so a doc_id may be missing or
    stand on several rows, and reading the documents again finds the same rows."""
    importable(docs.sparkSession)
    docs, restored = sheltered(docs, "doc_id", "text")
    docs = _row_keyed(docs)
    keyed = written(classes(docs, *_ROW), "classes")
    pick = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *_ROW)
    first = keyed.where("n_words > 0").groupBy("digest").agg(F.min(pick).alias("pick"))
    best = _grouped(docs, keyed, first, size, percent).groupBy("component").agg(F.min("pick").alias("pick"))
    stay = best.select(*[f"pick.{c}" for c in _ROW]).union(keyed.where("n_words = 0").select(*_ROW).distinct())

    def once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in _ROW])
            yield batch.filter(pa.array([r not in seen and not seen.add(r) for r in rows], pa.bool_()))

    # Equal rows are made one before they move, and again where they meet.
    once = docs.mapInArrow(once_a_task, docs.schema)
    return restored(once.join(stay, list(_ROW)).dropDuplicates(list(_ROW)))


_ROW = ("row_a", "row_b")


def _row_keyed(docs: DataFrame) -> DataFrame:
    """The documents with two hashes: of all columns that can be hashed, and of id and text.
    Nulls leave a hash as it is, so where they stand goes in too."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not re.search(r"\b(map<|variant)", f.dataType.simpleString())]
    own = [F.col("doc_id"), F.col("text")]
    hashed = lambda of, salt: F.xxhash64(F.lit(salt), *of, *[c.isNull() for c in of])
    return docs.select("*", hashed(plain, 1).alias(_ROW[0]), hashed(own, 2).alias(_ROW[1]))
