"""Operator 6: token counts of huge documents by overlap resynchronisation.

Short texts go to the library as they are. Longer ones are cut into overlapping chunks,
each encoded with offsets; neighbours are spliced at a boundary both found and that is
proven stable: no piece of the vocabulary goes from another character on to the space
mark (checked on loading), so no merge ever crosses the start of a run of marks. An
overlap without such a place is widened until it has one; a text without any is one chunk.

The normaliser puts one space mark before its input. A later chunk therefore begins with
what a neighbour has settled already, and nothing before the splice is counted.

Cases: a null or empty text has no tokens; repeated rows give repeated results; a null
doc_id stays null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .chunks import ordered_parts, pieces, splice

CHUNK, OVERLAP = 24_000, 400
MARK = "▁"
STABLE = re.compile(f"[^ {MARK}](?=[ {MARK}])")
_OUT = "doc_id bigint, n_bytes bigint, n_tokens bigint"


class Processor:
    """The library's model, checked for stable boundaries, and the characters of each piece."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.length = np.zeros(self.library.vocab_size(), np.int64)
        for i in range(len(self.length)):
            piece = self.library.id_to_piece(i)
            if re.search(f"[^{MARK}]{MARK}", piece):
                raise ValueError(f"piece {i} goes on over a space mark; boundaries are not stable")
            # Of a character given as bytes, the first one counts.
            self.length[i] = (int(piece[3:5], 16) & 0xC0 != 0x80) if self.library.is_byte(i) else len(piece)


@lru_cache(maxsize=2)
def processor(path: str) -> Processor:
    return Processor(path)


def count(docs: DataFrame, path: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more tokens than `limit`) per document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches):
        own = processor(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = [len(ids) for ids in own.library.encode(part.column(1).to_pylist(), num_threads=1)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column(0), "n_bytes": part.column(2), "n_tokens": pa.array(counts, pa.int64())}
                )

    def encode_chunk(batches):
        own = processor(path)
        for batch in batches:
            for row in batch.to_pylist():
                yield _counted_chunk(own, row)

    def join(group: pa.Table) -> pa.Table:
        parts, copies = ordered_parts(group.to_pylist())
        n = sum(end - begin for begin, end in splice(parts))
        return pa.table(
            {
                "doc_id": pa.array([parts[0]["doc_id"]] * copies, pa.int64()),
                "n_bytes": pa.array([parts[0]["n_bytes"]] * copies, pa.int64()),
                "n_tokens": pa.array([n] * copies, pa.int64()),
            }
        )

    is_long = F.length("text") > chunk + overlap
    size = F.octet_length("text").cast("bigint").alias("n_bytes")
    short = docs.where(~is_long).select("doc_id", "text", size).mapInArrow(whole, _OUT)
    cuts = pieces(docs.where(is_long), chunk, overlap, STABLE)
    counted = cuts.mapInArrow(encode_chunk, _CHUNK)
    sized = counted.groupBy("doc_id", "digest").applyInArrow(join, _OUT)
    return short.unionByName(sized).withColumn("over_limit", F.col("n_tokens") > limit)


_CHUNK = "doc_id bigint, digest binary, n_bytes bigint, part int, n int, at array<int>, index array<int>"


def _counted_chunk(own: Processor, row: dict) -> pa.RecordBatch:
    """The number of a chunk's tokens with the stable boundaries among their offsets."""
    text, ids = row["text"], own.library.encode(row["text"])
    starts = np.cumsum(own.length[ids]) - own.length[ids] - 1  # the mark put before the text is at -1
    stable = [m.end() for m in STABLE.finditer(text)]
    index = np.searchsorted(starts, stable)
    same = [k for k, (j, p) in enumerate(zip(index, stable, strict=True)) if j < len(starts) and starts[j] == p]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([row["doc_id"]], pa.int64()),
            "digest": pa.array([row["digest"]], pa.binary()),
            "n_bytes": pa.array([row["n_bytes"]], pa.int64()),
            "part": pa.array([row["part"]], pa.int32()),
            "n": pa.array([len(ids)], pa.int32()),
            "at": pa.array([[stable[k] + row["start"] for k in same]], pa.list_(pa.int32())),
            "index": pa.array([[int(index[k]) for k in same]], pa.list_(pa.int32())),
        }
    )
