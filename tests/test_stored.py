"""Lookups on stored layouts, the substring index, the catalog and keyed state."""

import random

import pytest
from pyspark.sql import functions as F

from commitfold import schemas as S
from commitfold.operators import fold, lookups
from commitfold.sources import tables, text_index
from commitfold.streaming import keyed
from test_fold import log_of, make_late, plan, random_ops
from verification import events


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_index_finds_what_a_scan_finds(spark, folder, tmp_path):
    post = fold.fold_posts(events.event_log(spark, folder))
    tables.write(post, "post", str(tmp_path / "post"))
    post = tables.read(spark, "post", str(tmp_path / "post"))
    path = str(tmp_path / "index")
    text_index.build(post, path, files=8)
    words = [w for r in post.select("text").limit(5).collect() for w in r["text"].split()[:3]]
    for query in (*words, " ".join(words[:2]), words[0][1:-1], words[0][:2], "zzzzqx", f"a {words[3]}", words[1].upper(), "é", ""):
        assert rows(text_index.search_posts(post, path, query)) == rows(lookups.search_posts(post, query)), query
    assert rows(text_index.search_total(post, path, words[0])) == rows(lookups.search_total(post, words[0]))
    text = plan(text_index.candidates(spark, path, words[0]))
    assert "PushedFilters: [In(gram" in text or "EqualTo(gram" in text
    files = lambda gram: text_index._postings(spark, path).where(F.col("gram") == gram).select(F.input_file_name()).distinct().count()
    assert files("the"[:3]) < 8
    assert text_index.candidates(spark, path, "ab c") is None


def test_liked_posts_leave_the_bucketed_posts_in_place(spark, folder):
    log = events.event_log(spark, folder)
    spark.sql("DROP DATABASE IF EXISTS liked_plan CASCADE")
    spark.sql("CREATE DATABASE liked_plan")
    tables.save_bucketed(fold.fold_posts(log), "liked_plan", "post", 16)
    engagement = fold.fold_engagement(log)
    actor = engagement.groupBy("author").count().orderBy(F.desc("count")).first()["author"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookups.liked_posts(spark.table("liked_plan.post"), engagement, actor))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "liked_plan" in line]
    assert len(scans) == 2
    for scan in scans:
        depth = lines[scan].index("FileScan")
        above = []
        for line in reversed(lines[:scan]):
            at = len(line) - len(line.lstrip(" :+-*(0123456789)"))
            if at < depth:
                depth = at
                above.append(line)
        join = next(i for i, line in enumerate(above) if "Join" in line)
        assert not any("Exchange" in line for line in above[:join]), text
    spark.sql("DROP DATABASE liked_plan CASCADE")


def test_required_columns_are_held_on_write(spark):
    spark.sql("DROP DATABASE IF EXISTS required CASCADE")
    tables.create(spark, "required")
    tables.insert(spark.createDataFrame([("a", 1)], S.SUB_STATE_TABLE), "required", "sub_state")
    with pytest.raises(Exception, match="null in sub_state.cursor"):
        tables.insert(spark.createDataFrame([("b", None)], "service string, cursor bigint"), "required", "sub_state")
    assert [tuple(r) for r in spark.table("required.sub_state").collect()] == [("a", 1)]
    listed = tables.catalog(spark, "required")
    assert {r["table_name"] for r in listed.collect()} == set(S.TABLES)
    assert listed.where("table_name = 'post' and required").count() == sum(not f.nullable for f in S.POST_TABLE)
    spark.sql("DROP DATABASE required CASCADE")


@pytest.mark.parametrize("target", ["post", "engagement"])
def test_keyed_state_equals_the_fold(spark, tmp_path, target):
    """Batches in no order, operations delivered twice, and a query that stops and goes on."""
    ops = random_ops(5)
    random.Random(3).shuffle(ops)
    root = str(tmp_path)
    for part in (ops[:150], ops[150:300] + [make_late(r) for r in ops[:100]], ops[300:]):
        log_of(spark, part).coalesce(1).write.mode("append").parquet(f"{root}/log")
        log = spark.readStream.schema(S.OPS).parquet(f"{root}/log")
        keyed.start(log, root, target, {"availableNow": True}).awaitTermination()
    want = (fold.fold_posts if target == "post" else fold.fold_engagement)(log_of(spark, ops))
    assert rows(keyed.table(spark, root, target)) == rows(want)
