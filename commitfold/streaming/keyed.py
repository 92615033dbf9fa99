"""The tables as keyed state of a stream, an alternative to the log.

Operations are grouped by uri and each uri keeps what a later operation may ask for, in
Spark's state store (RocksDB, checkpointed to the query's folder): of a post where its first
create and its last delete lie, of an engagement its last delete and the creates not before it.
A batch gives the new row of every uri whose row it changes, so a reader needs the last row
of each uri only. Nothing is rewritten or folded again, and a batch costs what its own
operations cost; in return a Python worker looks at every operation, and the creates of one
uri that no delete clears are kept with it.

A post's record is not in the store, as only a create that comes itself can take the place
of the first one. It is written once, with the batch that brings it; where a batch just
deletes the post, its row has no record, and a reader takes the last one there is.

A look into the store costs far more than an operation, so a few dozen uris share an entry
(`groups`): it is read and written once per batch for all of them.

As with the folds, batches may come in any order, cut anywhere and repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import schemas as S
from ..functions import times
from ..operators import fold
from ..session import importable, shuffles_dropped

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_TABLES = {"post": S.POST_TABLE, "engagement": S.ENGAGEMENT_TABLE}
_COUNTERS = ("likes_count", "repost_count", "comments_count")
_POSITION = ("seq", "op_idx", "ingested_us")


def _payload(target: str) -> list[str]:
    known = {"uri", "indexedAt", "deletedAt", *_COUNTERS}
    return [f.name for f in _TABLES[target].fields if f.name not in known]


def _create(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([S.OPS[name] for name in names])


def _changes(target: str) -> T.StructType:
    """A row that changed: `present` says whether there still is one, `whole` whether it has
    its record, `deleted_us` when the post was deleted."""
    fields = [("uri", T.StringType()), ("present", T.BooleanType()), ("whole", T.BooleanType())]
    fields += [("ingested_us", T.LongType()), ("deleted_us", T.LongType())]
    return T.StructType([*[T.StructField(*f) for f in fields], *[S.OPS[name] for name in _payload(target)]])


class _Folded(StatefulProcessor):
    """An entry has the uris of one group; of each `gone` is the last delete as (seq,
    ingestion time of its earliest delivery). Of a create the first fields, `kept`, are in
    the store; one that came with this batch has all of them."""

    target: str
    kept: tuple[str, ...]

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [("uri", T.StringType()), ("gone_seq", T.LongType()), ("gone_us", T.LongType()), ("creates", T.ArrayType(_create(self.kept)))]
        uris = T.ArrayType(T.StructType([T.StructField(*f) for f in fields]))
        self.state = handle.getValueState("state", T.StructType([T.StructField("uris", uris)]))
        self.fields = (*_POSITION, *_payload(self.target))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        entry = self.state.get()
        # Plain tuples: the store does not take its own rows back.
        known = {u[0]: (*u[:3], [tuple(c) for c in u[3]]) for u in entry[0]} if entry is not None else {}
        now = {}
        for op in rows:
            uri = op["uri"]
            if uri not in now:
                now[uri] = self.unpacked(known.get(uri))
            now[uri] = self.taken_in(op, *now[uri])
        changed = []
        for uri, (gone, creates) in now.items():
            before, creates = self.unpacked(known.get(uri)), self.needed(gone, creates)
            known[uri] = (uri, *(gone or (None, None)), [creates[at][: len(self.kept)] for at in sorted(creates)])
            row, was = self.row(gone, creates), self.row(*before)
            if self.outline(row) != self.outline(was):
                present, create, deleted = row
                whole = create is not None and len(create) == len(self.fields)
                payload = create[2:] if whole else [None] * (len(self.fields) - 2)
                values = (uri, present, whole, payload[0], deleted, *payload[1:])
                changed.append(Row(**dict(zip(_changes(self.target).names, values, strict=True))))
        self.state.update(([known[uri] for uri in sorted(known)],))
        yield from changed

    @staticmethod
    def unpacked(known) -> tuple:
        if known is None:
            return None, {}
        return None if known[1] is None else (known[1], known[2]), {c[:2]: c for c in known[3]}

    def outline(self, row: tuple) -> tuple:
        present, create, deleted = row
        return present, create and create[: len(self.kept)], deleted

    def taken_in(self, op: Row, gone, creates: dict) -> tuple:
        if op["action"] == "delete":
            if gone is None or op["seq"] > gone[0] or (op["seq"] == gone[0] and op["ingested_us"] < gone[1]):
                gone = (op["seq"], op["ingested_us"])
            return gone, creates
        create = tuple(op[name] for name in self.fields)
        at = create[:2]
        if at not in creates or create[2] < creates[at][2]:
            creates[at] = create
        return gone, self.needed(gone, creates) if len(creates) > 64 else creates

    def needed(self, gone, creates: dict) -> dict:
        raise NotImplementedError

    def row(self, gone, creates: dict) -> tuple:
        raise NotImplementedError


class FoldedPosts(_Folded):
    target = "post"
    kept = _POSITION

    def needed(self, gone, creates):
        return {at: creates[at] for at in [min(creates)]} if creates else {}

    def row(self, gone, creates):
        if not creates:
            return False, None, None
        first = creates[min(creates)]
        return True, first, gone[1] if gone and gone[0] > first[0] else None


class FoldedEngagement(_Folded):
    target = "engagement"
    kept = (*_POSITION, *_payload("engagement"))

    def needed(self, gone, creates):
        return creates if gone is None else {at: c for at, c in creates.items() if at[0] >= gone[0]}

    def row(self, gone, creates):
        alive = self.needed(gone, creates)
        return (True, alive[min(alive)], None) if alive else (False, None, None)


def changes(log: DataFrame, target: str, groups: int | None = None) -> DataFrame:
    """The rows of a table that change, from a stream of operations (update mode). The
    session has to use the RocksDB state store (`PROVIDER`)."""
    own = (fold.posts_of if target == "post" else fold.engagement_of)(log)
    key = F.xxhash64("uri") if groups is None else F.pmod(F.xxhash64("uri"), F.lit(groups))
    ops = own.select(key.alias("entry"), "uri", "action", *_POSITION, *_payload(target))
    processor = FoldedPosts() if target == "post" else FoldedEngagement()
    return ops.groupBy("entry").transformWithState(processor, _changes(target), "Update", "None")


def start(
    log: DataFrame, root: str, target: str, trigger: dict | None = None, groups: int | None = None
) -> StreamingQuery:
    """Keeps a table under `root`; a batch adds one folder of changed rows. A batch done
    again after a failure replaces its folder. `groups`, the number of entries in the store,
    stays the same for as long as the query's checkpoint is used; without it every uri has
    an entry of its own, and with it as many should be given as leave an entry a few dozen uris."""

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{target}/batch={batch_id}")

    spark = log.sparkSession
    importable(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    writer = changes(log, target, groups).writeStream.outputMode("update").foreachBatch(land)
    writer = writer.option("checkpointLocation", f"{root}/checkpoint-{target}")
    with shuffles_dropped(spark):  # the stream keeps the settings that it starts with
        return (writer.trigger(**trigger) if trigger else writer).start()


def table(spark: SparkSession, root: str, target: str) -> DataFrame:
    """The table as of the last batch: the last row of each uri, where there still is one,
    with the last record that was written of it."""
    schema = T.StructType([*_changes(target).fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{root}/{target}")
    row, record = F.struct("present", "deleted_us"), F.struct("ingested_us", *_payload(target))
    last = rows.groupBy("uri").agg(
        F.max_by(row, "batch").alias("row"), F.max_by(record, F.when(F.col("whole"), F.col("batch"))).alias("record")
    ).select("uri", "row.*", "record.*")
    made = {
        "indexedAt": times.iso_millis(F.col("ingested_us")),
        "deletedAt": times.iso_millis(F.col("deleted_us")),
        **{name: F.lit(0) for name in _COUNTERS},
    }
    return last.where("present").select(*[made.get(f.name, F.col(f.name)).alias(f.name) for f in _TABLES[target].fields])
