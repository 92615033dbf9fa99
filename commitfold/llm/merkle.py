"""Operator 11: a Merkle manifest of a dataset by butterfly exchange.

The rows of a tree are put in order over all tasks and dealt out in blocks of a power of
the fanout, so a block is a whole subtree. Blocks then exchange subtree roots round by
round: in round r the aligned groups of fanout to the power r + 1 blocks are worked on,
and each block meets the blocks with its own place in the other subtrees of its group. It
takes their roots over as its siblings and hashes the common parent, as all the others of
the group do. After the last round every block holds the root and its own proof, and
nothing has to be sent back down. A tree whose number of blocks is no power of the fanout
has stand-ins without leaves, fewer than fanout - 1 for each block; they only pass on what
they meet, so every round sends fanout rows for each block and no more.

The roots of the trees, in order, are the leaves of one tree more, made in the same way.

Cases: a null in a leaf's columns is `-`; null trees and null ids come first; rows with
equal ids are in the order of their leaves, and equal ones are alike in all but their
place; an empty table has no manifest; columns that are not named are carried along
under their own names, except that the manifest's own names win.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

FANOUT, HEIGHT = 2, 10
ROUNDS_IN_A_PLAN = 8
SALTS = 64

PATH = "array<struct<at: int, others: array<string>>>"
_PLACE_BITS = 33  # of monotonically_increasing_id: what is above is the task


def leaf(columns: Sequence[str | Column]) -> Column:
    """The digest of a row: each value's bytes with their number, `-` for null."""
    named = lambda c: (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
    field = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[field(named(c)) for c in columns]), 256)


def joined(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def subtree(leaves: list[str], fanout: int, height: int, alone: bool) -> list[list[str]]:
    """The nodes of a block, level by level; a block that is the whole tree ends at its root."""
    levels = [leaves]
    while len(levels) <= height and not (alone and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([joined(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def steps(levels: list[list[str]], fanout: int, at: int) -> list[dict]:
    """What stands beside one leaf of a block, level by level."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        run = nodes[first : first + fanout]
        out.append({"at": at - first, "others": run[: at - first] + run[at - first + 1 :]})
        at //= fanout
    return out


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(below: Column, step: Column) -> Column:
        left = F.slice(step["others"], F.lit(1), step["at"])
        right = F.slice(step["others"], step["at"] + 1, F.size(step["others"]))
        return F.sha2(F.concat(F.array_join(left, ""), below, F.array_join(right, "")), 256)

    return F.aggregate(path, node, up)


def siblings(path: Column) -> Column:
    return F.flatten(F.transform(path, lambda step: step["others"]))


def _placed(leaves: DataFrame) -> DataFrame:
    """tree, n (leaves of the tree), place (in the tree), id, leaf, row."""
    order = ["tree", "id", "leaf", "salt"]
    salted = written(leaves.withColumn("salt", F.monotonically_increasing_id()), "merkle-leaves")
    ranged = salted.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumn("rank", F.monotonically_increasing_id()).drop("salt"), "merkle-order")
    ranged = ranged.withColumn("task", F.shiftright("rank", _PLACE_BITS))
    counts = ranged.groupBy("tree", "task").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("tree").alias("of"),
        F.col("task").alias("by"),
        (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("n"),
    )
    found = ranged.join(starts, F.col("tree").eqNullSafe(F.col("of")) & (F.col("task") == F.col("by")))
    return found.select("tree", "n", (F.col("rank") - F.col("shift")).alias("place"), "id", "leaf", "row")


def _blocks(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """One row per block: tree, n, block, members in order, root."""
    size = fanout**height
    member = F.struct((F.col("place") % size).cast("int").alias("at"), "id", "leaf", "row")
    blocks = placed.groupBy("tree", "n", F.expr(f"place div {size}").alias("block")).agg(F.collect_list(member).alias("members"))
    # By place alone: what rows carry need not have an order.
    in_order = F.array_sort("members", lambda a, b: a["at"] - b["at"])
    blocks = blocks.withColumn("members", in_order).withColumn("leaves", F.col("members.leaf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(batch.column("n").to_pylist(), batch.column("leaves").to_pylist(), strict=True)
            roots = [subtree(leaves, fanout, height, n <= size)[-1][0] for n, leaves in given]
            kept = [batch.column(name) for name in ("tree", "n", "block")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(roots, pa.string())], ["tree", "n", "block", "root"])

    blocks = written(blocks, "merkle-blocks")
    tree = blocks.schema["tree"].dataType.simpleString()
    roots = blocks.select("tree", "n", "block", "leaves").mapInArrow(run, f"tree {tree}, n bigint, block bigint, root string")
    return blocks, written(roots, "merkle-roots")


def _exchange(state: DataFrame, step: int, fanout: int) -> DataFrame:
    """One round: every block sends its subtree's root to its own place in each subtree of the group."""
    digit = F.expr(f"(block div {step}) % {fanout}")
    partners = F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda i: F.col("block") + (i - digit) * step)
    active = F.col("padded") > step
    sent = state.select(
        "tree",
        "n",
        "padded",
        F.explode(F.when(active, partners).otherwise(F.array("block"))).alias("to"),
        F.struct(digit.alias("digit"), "root").alias("sent"),
        "path",
        "block",
    )
    met = sent.groupBy("tree", "n", "padded", F.col("to").alias("block")).agg(
        F.sort_array(F.collect_list("sent")).alias("sent"),
        F.first(F.when(F.col("block") == F.col("to"), F.col("path")), ignorenulls=True).alias("path"),
    )
    present = F.filter("sent", lambda one: one["root"].isNotNull())
    side = F.struct(
        F.size(F.filter("present", lambda one: one["digit"] < digit)).alias("at"),
        F.transform(F.filter("present", lambda one: one["digit"] != digit), lambda one: one["root"]).alias("others"),
    )
    roots = F.transform("present", lambda one: one["root"])
    parent = F.when(F.size("present") > 0, F.sha2(F.array_join(roots, ""), 256))
    return met.withColumn("present", present).select(
        "tree",
        "n",
        "padded",
        "block",
        F.when(active, parent).otherwise(F.element_at(F.col("sent.root"), 1)).alias("root"),
        F.when(active, F.concat("path", F.array(side))).otherwise(F.col("path")).alias("path"),
    )


def _upper(roots: DataFrame, fanout: int, height: int) -> DataFrame:
    """tree, block, the root of the tree, and the path from the block's root to it."""
    n_blocks = F.expr(f"(n + {fanout**height - 1}) div {fanout**height}")
    most = roots.select(F.max(n_blocks)).first()[0] or 1
    powers = [1]
    while powers[-1] < most:
        powers.append(powers[-1] * fanout)
    padded = F.coalesce(*[F.when(n_blocks <= p, F.lit(p)) for p in powers]).cast("bigint")
    own = roots.withColumn("padded", padded)
    share = F.expr(f"padded div {fanout}")
    extra = F.filter(
        F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)), lambda i: F.col("block") + i * share),
        lambda b: (F.col("block") < share) & (b >= n_blocks) & (b < F.col("padded")),
    )
    stand_ins = own.select("tree", "n", "padded", F.explode(extra).alias("block"), F.lit(None).cast("string").alias("root"), F.lit(None).cast(PATH).alias("path"))
    state = own.select("tree", "n", "padded", "block", "root", F.array().cast(PATH).alias("path")).unionByName(stand_ins)
    for i, step in enumerate(powers[:-1]):
        if i and i % ROUNDS_IN_A_PLAN == 0:
            state = written(state, "merkle-rounds")
        state = _exchange(state, step, fanout)
    return state.where(F.col("block") < n_blocks).select("tree", "block", F.col("root").alias("subroot"), "path")


def forest(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """The blocks of all trees of `leaves` (tree, id, leaf, row), and per block the path
    from its root to the tree's, which is `subroot`."""
    blocks, roots = _blocks(_placed(leaves), fanout, height)
    return blocks, _upper(roots, fanout, height)


def _opened(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """A row per leaf: the block's columns, id, leaf, row, and its path inside the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                leaves = one.column("leaves")[0].as_py()
                levels = subtree(leaves, fanout, height, one.column("n")[0].as_py() <= fanout**height)
                inner = pa.array([[steps(levels, fanout, at) for at in range(len(leaves))]], _INNER)
                yield pa.RecordBatch.from_arrays([*one.columns, inner], [*one.schema.names, "inner"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields)
    opened = blocks.mapInArrow(run, f"{fields}, inner array<{PATH}>")
    return opened.withColumn("_one", F.explode(F.arrays_zip("members", "inner"))).drop("members", "inner", "leaves")


_INNER = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))])))


def manifest(rows: DataFrame, digest: Column, tree: str, order: str, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """The rows with `leaf` (their `digest`), `subroot` (of their tree), `root` (of the
    dataset) and `path`: per level the place among the siblings and those siblings."""
    made = ("leaf", "subroot", "root", "path")
    carried = [c for c in rows.columns if c not in made]
    inner = F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carried)], F.lit(True).alias("_row"))
    col = lambda c: F.col(f"`{c}`")
    leaves = rows.select(col(tree).cast("string").alias("tree"), col(order).alias("id"), digest.alias("leaf"), inner.alias("row"))
    blocks, upper = forest(leaves, fanout, height)
    upper = written(upper, "merkle-upper")

    # The trees' roots are few rows of one more tree.
    subroots = upper.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("subroot").alias("leaf"), F.struct(F.lit(True).alias("_row")).alias("row"))
    top_blocks, top_upper = forest(subroots, fanout, height)
    both = top_blocks.join(top_upper, ["tree", "block"])
    tops = _opened(both, fanout, height).select(
        F.col("_one.members.id").alias("of"), F.col("subroot").alias("root"), F.concat("_one.inner", "path").alias("top")
    )
    # A tree may hold any share of the blocks: its row stands ready under every salt.
    tops = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    above = upper.select(F.col("tree").alias("of"), F.col("block").alias("nr"), "subroot", F.col("path").alias("upper"))
    above = above.withColumn("salt", (F.col("nr") % SALTS).cast("int"))
    match = above["of"].eqNullSafe(tops["of"]) & (above["salt"] == tops["salt"])
    above = above.join(tops, match).select(above["of"], "nr", "subroot", "root", F.concat("upper", "top").alias("upper"))
    joint = blocks.join(above, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("nr"))).drop("of", "nr")
    opened = _opened(joint, fanout, height)
    return opened.select(
        *[F.col(f"_one.members.row._{i}").alias(c) for i, c in enumerate(carried)],
        F.col("_one.members.leaf").alias("leaf"),
        "subroot",
        "root",
        F.concat("_one.inner", "upper").alias("path"),
    )
