"""Operator 1: byte-level BPE encoding and decoding over overlapping chunks.

Texts up to `chunk` characters are encoded as they are. Longer ones are cut into
overlapping chunks that are pre-tokenised by different tasks; neighbours are stitched at
the first pre-token boundary both have found (matching depends on nothing before a
boundary, so from there on they agree), and each pre-token is encoded by itself.
Decoding concatenates the raw bytes of the ids.

Cases: a null or empty text has no tokens and decodes to nothing; a repeated row gives
its result once per repetition; a null doc_id stays null; an empty table gives an empty
table; columns besides `doc_id` and `text` are ignored. A text without white space is
one chunk, however long. One text is the unit that has to fit into a task, as it already
had to as a row.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from .chunks import ordered_parts, pieces, splice

CHUNK, OVERLAP = 24_000, 400

# No alternative of the pattern goes from a character that is no space on to a space.
STABLE = regex.compile(r"\S(?=\s)")

_CACHE_SIZE = 400_000
_OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Codec:
    """The vocabulary of a rank file with its pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self._kept: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        return self.library.encode_ordinary(text)

    def encode_piece(self, piece: str) -> list[int]:
        """One pre-token; what was met before is looked up."""
        ids = self._kept.get(piece)
        if ids is None:
            if len(self._kept) >= _CACHE_SIZE:
                self._kept.clear()
            ids = self._kept[piece] = self.library.encode_ordinary(piece)
        return ids

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def digests(self, ids) -> tuple[str, str]:
        """Of the ids as decimals with spaces between, and of the decoded bytes."""
        listed = " ".join([self.decimal[i] for i in ids])
        return hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _rows(made: list[tuple], with_ids: bool) -> pa.RecordBatch:
    """Result rows from (doc_id, ids, digest of ids, digest of bytes)."""
    columns = {
        "doc_id": pa.array([m[0] for m in made], pa.int64()),
        "n_tokens": pa.array([len(m[1]) for m in made], pa.int64()),
        "ids_sha256": pa.array([m[2] for m in made], pa.string()),
        "decoded_sha256": pa.array([m[3] for m in made], pa.string()),
    }
    if with_ids:
        columns["ids"] = pa.array([m[1] for m in made], pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids per document."""
    out = _OUT + (", ids array<int>" if with_ids else "")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches):
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                encoded = [own.encode(t) for t in texts]
                yield _rows([(d, e, *own.digests(e)) for d, e in zip(ids, encoded, strict=True)], with_ids)

    def encode_chunk(batches):
        own = codec(path, pattern)
        for batch in batches:
            for row in batch.to_pylist():
                yield _encoded_chunk(own, row, overlap)

    def join(group: pa.Table) -> pa.Table:
        own = codec(path, pattern)
        parts, copies = ordered_parts(group.to_pylist())
        arrays = [np.frombuffer(p["ids"], np.int32) for p in parts]
        ids = np.concatenate([a[b:e] for a, (b, e) in zip(arrays, splice(parts), strict=True)]).tolist()
        made = (parts[0]["doc_id"], ids, *own.digests(ids))
        return pa.Table.from_batches([_rows([made] * copies, with_ids)])

    is_long = F.length("text") > chunk + overlap
    short = docs.where(~is_long).mapInArrow(whole, out)
    encoded = pieces(docs.where(is_long), chunk, overlap, STABLE).mapInArrow(encode_chunk, _CHUNK)
    return short.unionByName(encoded.groupBy("doc_id", "digest").applyInArrow(join, out))


_CHUNK = "doc_id bigint, digest binary, part int, n int, ids binary, at array<int>, index array<int>"


def _encoded_chunk(own: Codec, row: dict, overlap: int) -> pa.RecordBatch:
    """A chunk's ids with its pre-token boundaries near both ends.

    The chunk's own ends are no boundaries of the document. Boundaries in the middle
    cannot be shared with a neighbour unless an overlap was widened, so all are kept.
    """
    pre_tokens = own.pattern.findall(row["text"])
    encoded = [own.encode_piece(p) for p in pre_tokens]
    ids = np.fromiter(chain.from_iterable(encoded), np.int32)
    at = np.cumsum([0, *map(len, pre_tokens)])[1:-1] + row["start"]
    index = np.cumsum([0, *map(len, encoded)])[1:-1]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([row["doc_id"]], pa.int64()),
            "digest": pa.array([row["digest"]], pa.binary()),
            "part": pa.array([row["part"]], pa.int32()),
            "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "at": pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
            "index": pa.array([index.astype(np.int32)], pa.list_(pa.int32())),
        }
    )


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes of the `ids` of each row (null ids: no bytes)."""

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [own.decode(ids or ()) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "decoded": pa.array(made, pa.binary())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")
