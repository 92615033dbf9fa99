"""The analysis report: counts, sample, recode, deletion lifetime, histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import recode, times

# --- Fixed values: bins marked in the report, with their label and position --
MARKS = (
    (3, "1 min", 60),
    (11, "5 min", 300),
    (21, "10 min", 600),
    (30, "15 min\nand over", 900),
)
# ------------------------------------------------------------------------------


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n"))


def sample(table: DataFrame, n: int = 10_000, order_by: str | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Some `n` rows; the first by `order_by` where the result must be repeatable.

    The first rows of every partition meet in one task. So the last value to be sampled is
    looked for by itself, and rows past it go before they are sorted. `keys` has the values of
    `order_by` where they are cheaper to have than the table (of a written one they are not
    dearer: only their column is read).
    """
    if order_by is None:
        return table.limit(n)
    first = (table if keys is None else keys).select(order_by).orderBy(order_by).limit(n)
    found = first.agg(F.count(F.lit(1)).alias("n"), F.max(order_by).alias("last")).first()
    if found["n"] == n:
        table = table.where(F.col(order_by).isNull() | (F.col(order_by) <= F.lit(found["last"])))
    return table.orderBy(order_by).limit(n)


def engagement_by_type(engagement: DataFrame) -> DataFrame:
    """Rows per engagement type, ordered by type. Codes are counted, then named."""
    return (
        engagement.groupBy(recode.engagement_name(F.col("type")).alias("type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("type")
    )


def deleted(post: DataFrame) -> DataFrame:
    return post.where(F.col("deletedAt").isNotNull())


def live(post: DataFrame) -> DataFrame:
    return post.where(F.col("deletedAt").isNull())


def deletion_lifetime(post: DataFrame) -> DataFrame:
    """How long deleted posts were online, exact, in whole seconds and top-coded."""
    online = times.seconds_between(F.col("indexedAt"), F.col("deletedAt"))
    return (
        deleted(post)
        .select("indexedAt", "deletedAt", online.alias("time_online"))
        .withColumn("time_online_int", F.col("time_online").try_cast("int"))
        .withColumn("time_online_int_clean", times.top_coded(F.col("time_online")))
    )


def _floor_div(a: Column, b: Column) -> Column:
    return ((a - F.pmod(a, b)) / b).cast("long")


def _ceil_div(a: Column, b: Column) -> Column:
    return -_floor_div(-a, b)


def histogram(values: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Bin counts of a whole-number column, empty bins included.

    The bin width is range / (bins - 1) and bin centres are multiples of it, so
    bin edges are odd multiples of half a width. An edge belongs to the bin on its
    left; the first bin also owns its lower edge. Bins are numbered from the one
    holding the minimum, which off the grid makes one bin more than asked for.
    Edges are compared in whole numbers, so no value falls to rounding.

    Values are counted once each before anything else: the data is shuffled as one
    row per distinct value, and range and bins are worked out on those.
    """
    v = F.col(column).cast("long")
    counts = values.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    lo_hi = counts.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("total")).where(
        F.col("lo").isNotNull()
    )
    steps = 2 * (bins - 1)  # half widths in the range
    span = F.col("hi") - F.col("lo")
    first = F.when(span == 0, F.lit(0)).otherwise(_floor_div(steps * F.col("lo") + span, 2 * span))
    last = F.when(span == 0, F.lit(0)).otherwise(
        F.greatest(_ceil_div(steps * F.col("hi") - span, 2 * span), first)
    )
    grid = lo_hi.select(
        "lo", span.alias("span"), "total", first.alias("first"), F.explode(F.sequence(first, last)).alias("cell")
    )
    frame = lo_hi.select(F.struct("lo", "hi", "total", first.alias("first")).alias("f")).scalar()
    binned = counts.withColumn("f", frame).select(
        "n",
        F.when(F.col("f.hi") == F.col("f.lo"), F.lit(0))
        .otherwise(
            F.greatest(
                _ceil_div(
                    steps * F.col("v") - (F.col("f.hi") - F.col("f.lo")), 2 * (F.col("f.hi") - F.col("f.lo"))
                ),
                F.col("f.first"),
            )
        )
        .alias("cell"),
    )
    per_cell = binned.groupBy("cell").agg(F.sum("n").alias("count"))
    width = F.col("span") / F.lit(float(bins - 1))
    centre = F.when(F.col("span") == 0, F.col("lo").cast("double")).otherwise(F.col("cell") * width)
    half = F.when(F.col("span") == 0, F.lit(0.05)).otherwise(width / 2)
    return (
        grid.join(per_cell, "cell", "left")
        .select(
            (F.col("cell") - F.col("first") + 1).cast("int").alias("bin"),
            centre.alias("x"),
            (centre - half).alias("xmin"),
            (centre + half).alias("xmax"),
            F.coalesce("count", F.lit(0)).alias("count"),
            (F.coalesce("count", F.lit(0)) / F.col("total") / (2 * half)).alias("density"),
        )
        .orderBy("bin")
    )


def max_count(hist: DataFrame) -> DataFrame:
    return hist.agg(F.max("count").alias("max_count"))


def histogram_marks(hist: DataFrame) -> DataFrame:
    """The marked bins with the position of their annotation."""
    label = seconds = F.lit(None)
    for bin_no, text, at in MARKS:
        label = F.when(F.col("bin") == bin_no, text).otherwise(label)
        seconds = F.when(F.col("bin") == bin_no, at).otherwise(seconds)
    return (
        hist.where(F.col("bin").isin(*[m[0] for m in MARKS]))
        .select("bin", label.alias("label"), seconds.alias("seconds"), "count", (F.col("count") * 1.1).alias("y"))
        .orderBy("bin")
    )
