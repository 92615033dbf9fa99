"""A stream of landed frames whose offset is the stream position itself.

The file source of Structured Streaming knows files; the collector it stands for asks the
network for everything after a `seq`. This source does that over the landed folder: a
query starts at a given position or at the live tail, its checkpoint holds positions, and
a batch is a range of positions, whatever files they are in. It is made with the Python
data source API and reads Parquet; row groups outside the range are left out by their
statistics, and the others are dealt out by size, so what a task reads does not grow with
the backlog.

    spark.dataSource.register(SeqStream)
    spark.readStream.format("commit_frames").option("path", landed).option("start", 120).load()

Options: `path`; `start`, the last position already known (default 0, everything), or
`tail` for what lands after the query has first started; `filesPerTask` (default 16) and
`bytesPerTask` (default 64 MB before compression; a row group is read whole by one task).
A batch takes all positions that are there; a long backlog is one batch of many tasks.

Frames without a position cannot be ordered and are not read here; the batch reader shows
them. The folder is listed, and the footers of files that are new are read, by the driver
once per batch: a few numbers per row group, never a frame.
"""

from __future__ import annotations

from collections.abc import Iterator

from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .. import schemas as S

_MAP = pa.map_(pa.string(), pa.string())
_OP = pa.struct([("action", pa.string()), ("path", pa.string()), ("cid", pa.string())])
_KINDS = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
_KINDS |= {"map<string,string>": _MAP, "array<string>": pa.list_(pa.string())}
_KINDS |= {f"array<{S.REPO_OP.simpleString()}>": pa.list_(_OP)}
ARROW = pa.schema([(f.name, _KINDS[f.dataType.simpleString()]) for f in S.FRAME.fields])


BATCH = 256  # frames that a task holds at once


class Group(NamedTuple):
    """A row group: its place in the file, its positions and its bytes before compression."""

    index: int
    least: int
    greatest: int
    size: int


class Part(InputPartition):
    """Row groups by file."""

    def __init__(self, files: dict[str, list[int]], after: int, upto: int):
        super().__init__(None)
        self.files, self.after, self.upto = files, after, upto


class SeqStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "commit_frames"

    def schema(self) -> StructType:
        return S.FRAME

    def streamReader(self, schema: StructType) -> SeqReader:
        return SeqReader(dict(self.options))


class SeqReader(DataSourceStreamReader):
    """Offsets are `{"seq": n}`: everything up to n has been read."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.start = options.get("start", "0")
        self.files_per_task = int(options.get("filespertask", "16"))
        self.bytes_per_task = int(options.get("bytespertask", str(64 << 20)))
        self.groups: dict[str, list[Group]] = {}

    def _files(self) -> dict[str, list[Group]]:
        """The row groups of every landed file; one listing, and new footers only."""
        fs, root = pafs.FileSystem.from_uri(self.path) if "://" in self.path else (pafs.LocalFileSystem(), self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        names = [f.path for f in found if f.is_file and f.path.endswith(".parquet") and not f.base_name.startswith(("_", "."))]
        for name in names:
            if name not in self.groups:
                with fs.open_input_file(name) as raw:
                    self.groups[name] = _groups(pq.ParquetFile(raw))
        return {n: self.groups[n] for n in names}

    def _last(self) -> int | None:
        return max((g.greatest for groups in self._files().values() for g in groups), default=None)

    def initialOffset(self) -> dict:
        if self.start == "tail":
            return {"seq": self._last() or 0}
        return {"seq": int(self.start)}

    def latestOffset(self) -> dict:
        last = self._last()
        return self.initialOffset() if last is None else {"seq": last}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        after, upto = start["seq"], end["seq"]
        parts: list[Part] = []
        room = 0
        for name, groups in sorted(self._files().items()):
            for g in groups:
                if g.greatest <= after or g.least > upto:
                    continue
                full = not parts or g.size > room or (name not in parts[-1].files and len(parts[-1].files) == self.files_per_task)
                if full:
                    parts.append(Part({}, after, upto))
                    room = self.bytes_per_task
                parts[-1].files.setdefault(name, []).append(g.index)
                room -= g.size
        return parts

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        fs = pafs.FileSystem.from_uri(self.path)[0] if "://" in self.path else pafs.LocalFileSystem()
        for name, groups in part.files.items():
            # Buffered and on one thread: pages are decoded as the rows are asked for.
            with fs.open_input_file(name) as raw:
                file = pq.ParquetFile(raw, buffer_size=1 << 20, pre_buffer=False)
                for batch in file.iter_batches(BATCH, row_groups=groups, use_threads=False):
                    seq = batch.column("seq")
                    wanted = batch.filter(pc.and_(pc.greater(seq, part.after), pc.less_equal(seq, part.upto)))
                    if wanted.num_rows:
                        yield _framed(wanted)

    def commit(self, end: dict) -> None:
        pass


def _framed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The columns of a frame; those that a file does not have are null."""
    have = set(batch.schema.names)
    columns = [batch.column(f.name).cast(f.type) if f.name in have else pa.nulls(batch.num_rows, f.type) for f in ARROW]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW)


def _groups(file: pq.ParquetFile) -> list[Group]:
    """The row groups that have positions, by their statistics; by their column without."""
    meta = file.metadata
    column = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == "seq"), None)
    found = []
    for i in range(meta.num_row_groups if column is not None else 0):
        group = meta.row_group(i)
        stats = group.column(column).statistics
        if stats is not None and stats.has_min_max:
            ends = stats.min, stats.max
        else:
            ends = pc.min_max(file.read_row_group(i, ["seq"]).column(0)).as_py().values()
        least, greatest = ends
        if least is not None:
            found.append(Group(i, least, greatest, group.total_byte_size))
    return found
