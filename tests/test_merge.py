"""Standing tables: any cut of the log, taken in part by part, gives the tables of the whole."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from commitfold import schemas as S
from commitfold.operators import analysis, counters, fold, merge
from commitfold.sources import base
from test_fold import expected, log_of, make, make_late, plan, random_ops

BUCKETS = 4


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def database(spark):
    name = f"standing_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def linked(ops):
    """Replies and subjects among the uris of the posts, so that counters are not zero."""
    rng = random.Random(1)
    uris = sorted({r["uri"] for r in ops if r["target"] == "post"})
    for r in ops:
        if r["action"] == "create":
            r["rootUri" if r["target"] == "post" else "subjectUri"] = rng.choice([*uris, ""]) if r["target"] == "post" else rng.choice(uris)
    return ops


def check(spark, database, ops):
    log = log_of(spark, ops)
    got = base.tables(spark, database, with_counters=True)
    whole = fold.fold_posts(log), fold.fold_engagement(log)
    assert rows(got.post) == rows(counters.with_counters(*whole))
    assert rows(got.engagement) == rows(whole[1])
    kept = {r["uri"]: tuple(r[c] for c in counters.COUNTERS) for r in spark.table(base.current(spark, database).subject_counts).collect()}
    counted = {r["uri"]: tuple(r[c] for c in counters.COUNTERS) for r in counters.subject_counts(*whole).collect()}
    assert kept == counted
    totals = {r["name"]: r["n"] for r in base.totals(spark, database).collect()}
    by_type = {{"1": "repost", "2": "like"}[str(r["type"])]: r["n"] for r in whole[1].groupBy("type").agg(F.count("*").alias("n")).collect()}
    assert totals == {k: v for k, v in {"post": whole[0].count(), **by_type}.items() if v}


@pytest.mark.parametrize("order", ["backwards", "mixed"])
def test_parts_taken_in_one_by_one(spark, database, order):
    ops = sorted(linked(random_ops(31)), key=lambda r: r["seq"])
    if order == "backwards":
        ops.reverse()
    elif order == "mixed":
        random.Random(2).shuffle(ops)
    done = []
    for part in (ops[:120], ops[120:150], [make_late(r) for r in ops[:140]], ops[150:]):
        done += part
        base.advance(log_of(spark, part), database, BUCKETS)
        check(spark, database, done)
    assert {u: c for u, (c, _) in expected(ops)[0].items()} == {r["uri"]: r["cid"] for r in base.tables(spark, database).post.collect()}


@pytest.mark.parametrize("cut", [30])
def test_settled_positions_forget_and_change_nothing(spark, database, cut):
    ops = linked(random_ops(7))
    done = []
    for low, high in ((-1, cut), (cut, 200)):
        part = [r for r in ops if low < r["seq"] <= high]
        again = [make_late(r) for r in ops if r["seq"] <= low]  # delivered once more, in part
        done += part
        base.advance(log_of(spark, part + again[::2]), database, BUCKETS, settled=high)
        check(spark, database, done)
    state = spark.table(base.current(spark, database).engagement_state)
    assert state.where("size(creates) <> 1").count() == 0


def test_tables_with_a_tail(spark, database):
    ops = linked(random_ops(13))
    base.advance(log_of(spark, ops[:250]), database, BUCKETS, batch=4)
    tail = log_of(spark, ops[250:])
    got, log = base.tables(spark, database, tail, with_counters=True), log_of(spark, ops)
    engagement = fold.fold_engagement(log)
    assert rows(got.engagement) == rows(engagement)
    assert rows(got.post) == rows(counters.with_counters(fold.fold_posts(log), engagement))
    assert rows(base.tables(spark, database, tail).post) == rows(fold.fold_posts(log))
    assert base.current(spark, database).batch == 4
    assert analysis.row_count(got.post).first()[0] == got.post.count()


def test_a_delete_without_a_row_is_kept(spark, database):
    gone, late = make("like", "x", 5, 0, "delete"), make("like", "x", 3, 0, "create")
    base.advance(log_of(spark, [gone]), database, BUCKETS)
    base.advance(log_of(spark, [late]), database, BUCKETS)
    assert base.tables(spark, database).engagement.count() == 0
    base.advance(log_of(spark, [make("like", "x", 1, 0, "create"), make("like", "x", 9, 0, "create")]), database, BUCKETS)
    assert [r["cid"] for r in base.tables(spark, database).engagement.collect()] == ["c9.0"]


def test_a_late_delete_between_two_creates(spark, database):
    base.advance(log_of(spark, [make("like", "x", 1, 0, "create"), make("like", "x", 9, 0, "create")]), database, BUCKETS)
    base.advance(log_of(spark, [make("like", "x", 5, 0, "delete")]), database, BUCKETS)
    assert [r["cid"] for r in base.tables(spark, database).engagement.collect()] == ["c9.0"]


def test_only_the_tail_is_shuffled(spark, database, tmp_path):
    """Read from files with broadcasting off, as it would be at scale."""
    path = str(tmp_path / "log")
    base.advance(log_of(spark, random_ops(1)), database, 16)
    log_of(spark, random_ops(2)).write.partitionBy("target").parquet(path)
    tail = spark.read.schema(S.OPS).parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        now = base.current(spark, database)
        for name, merged, state in (
            (now.post_state, merge.merged_posts, merge.post_state),
            (now.engagement_state, merge.merged_engagement, merge.engagement_state),
        ):
            text = plan(merged(spark.table(name), state(tail)))
            assert "Bucketed: true" in text
            above, below = text.split("FullOuter", 1)[0], base_side(text, name)
            assert "Exchange" not in above and "Exchange" not in below, text
        text = plan(base.tables(spark, database, with_counters=True).post)
        assert "Exchange" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def base_side(text, name):
    """The lines of the plan from the outer join down to the scan of the base."""
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "FullOuter" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and name.split(".")[1] in line)
    return "\n".join(lines[join + 1 : scan + 1])


def test_old_versions_go(spark, database):
    for seed in range(4):
        base.advance(log_of(spark, random_ops(seed)), database, BUCKETS)
    names = {t.name for t in spark.catalog.listTables(database)}
    assert len(names) == 1 + 2 * len(base.TABLES)
    with pytest.raises(ValueError):
        base.tables(spark, f"{database}_none")
    tail = log_of(spark, random_ops(5))
    assert rows(base.tables(spark, f"{database}_none", tail).post) == rows(fold.fold_posts(tail))


def test_nothing_taken_in(spark, database):
    log = log_of(spark, random_ops(1))
    base.advance(log.where("false"), database, BUCKETS)
    assert base.tables(spark, database).post.count() == 0
    base.advance(log, database, BUCKETS)
    before = rows(base.tables(spark, database).engagement)
    base.advance(log.where("false"), database, BUCKETS)
    assert rows(base.tables(spark, database).engagement) == before == rows(fold.fold_engagement(log))
