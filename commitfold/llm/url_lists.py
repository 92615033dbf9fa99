"""Operator 8: URL filters by a temporal join with dated lists.

List entries are dated: on a day a pattern (a host, or a domain that covers the hosts
below it) is put on a list or taken off. They become validity intervals, the days from
an addition to the next removal, and each capture is judged by the intervals that hold
its fetch day. A captured host meets the patterns that are the host itself and each of
its parent domains.

Captures are reduced to their distinct (host, day) before anything is joined, so a host
with a third of all captures is at most one row per day; of the domains above it only those
that some entry names stay, found by pattern alone. Intervals and captures meet by
pattern and month; an interval stands in every month it covers, so a pattern with many
entries is met a month at a time. The verdicts go back to the captures by host and day.

Cases: a url without a host, a null url or a null fetch day is on no list; entries of
one list, pattern and day: a removal wins over additions; repeated entries count once;
entries with a null field are ignored; an addition while active and a removal while
inactive change nothing; repeated captures give repeated results; empty tables give no
verdicts or verdicts of no list; other columns of the captures pass, but for names that
the verdict has (`host`, `lists`, `blocked`), which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import sheltered

OPEN_END = "9999-12-31"


def host(url: Column) -> Column:
    """The lower-case host of a url without user, port and final dot; null without one."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    found = F.regexp_replace(found, r"\.$", "")
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, valid_from, valid_to (exclusive) from list, pattern, action
    ('add' or 'remove') and day."""
    fields = ["list", "pattern", "day", "action"]
    entries = entries.select(*fields).na.drop().where(F.col("action").isin("add", "remove"))
    entries = entries.withColumn("day", F.col("day").cast("date"))
    daily = entries.groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))
    by_day = Window.partitionBy("list", "pattern").orderBy("day")
    changes = daily.withColumn("earlier", F.lag("action", 1, "remove").over(by_day)).where("action <> earlier")
    spans = changes.withColumn("valid_to", F.coalesce(F.lead("day").over(by_day), F.lit(OPEN_END).cast("date")))
    return spans.where("action = 'add'").select("list", "pattern", F.col("day").alias("valid_from"), "valid_to")


def active(captured: DataFrame, spans: DataFrame) -> DataFrame:
    """host, day and the sorted names of the `lists` whose entries hold them, one row per
    distinct (host, day) that is on a list."""
    asked = captured.select("host", "day").na.drop().distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    month = lambda day: F.year(day) * 12 + F.month(day)
    # Domains that are on no list, as most top-level ones, go before months are looked at.
    listed = asked.select(F.explode(parents).alias("pattern")).distinct().join(spans.select("pattern").distinct(), "pattern", "left_semi")
    of_host = asked.select("host").distinct().select("host", F.explode(parents).alias("pattern")).join(listed, "pattern")
    asked = asked.join(of_host, "host").select("host", "day", "pattern", month(F.col("day")).alias("month"))
    # Months are listed up to the last capture only.
    end = captured.agg(F.max("day")).first()[0]
    if end is None:
        return asked.select("host", "day", F.array().cast("array<string>").alias("lists")).where(F.lit(False))
    until = F.least(F.date_sub("valid_to", 1), F.lit(end))
    by_month = spans.where(F.col("valid_from") <= F.lit(end)).withColumn(
        "month", F.explode(F.sequence(month(F.col("valid_from")), month(until)))
    )
    met = asked.join(by_month, ["pattern", "month"]).where("valid_from <= day and day < valid_to")
    return met.groupBy("host", "day").agg(F.sort_array(F.collect_set("list")).alias("lists"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures (with `url` and `day`) and their `host`, the `lists` they were on at
    fetch time, and `blocked`: on a blocking list and on none that allows."""
    given = captures.drop("host", "lists", "blocked")
    inner, restored = sheltered(given, "url", "day")
    inner = inner.withColumn("host", host(F.col("url"))).withColumn("day", F.col("day").cast("date"))
    verdicts = active(inner, intervals(entries)).withColumnsRenamed({"host": "_on_host", "day": "_on_day"})
    # Captures that no list can hold do not meet in the join.
    known = F.col("host").isNotNull() & F.col("day").isNotNull()
    same = (F.col("host") == F.col("_on_host")) & (F.col("day") == F.col("_on_day"))
    judged = inner.where(known).join(verdicts, same, "left").drop("_on_host", "_on_day")
    rest = inner.where(~known).withColumn("lists", F.lit(None).cast("array<string>"))
    judged = judged.unionByName(rest).withColumn("lists", F.coalesce("lists", F.array().cast("array<string>")))
    blocked = F.exists("lists", lambda name: name.startswith("block")) & ~F.exists("lists", lambda name: name.startswith("allow"))
    judged = judged.withColumn("blocked", blocked)
    return restored(judged, "host", "lists", "blocked")
