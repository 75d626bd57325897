"""A small log with nulls, a number that gains a digit, deletes, inserts anew, new columns and a change of key."""

import pytest
from pyspark.sql import functions as F

from ripplelog.operators import changelog, latest, offsets, snapshot
from ripplelog.sources.versions import VersionedTable
from ripplelog.streaming.catchup import append, catch_up

ROW = "struct<id: int, a: string, b: int, c: int>"
SCHEMA = f"log_file string, log_pos long, row_idx int, ts_s long, schema_name string, table_name string, op string, before {ROW}, after {ROW}, ddl string"


def event(file, pos, idx, op, before=None, after=None, ddl=None):
    fill = lambda r: None if r is None else (*r, *[None] * (4 - len(r)))
    return (file, pos, idx, 1000 + pos, "shop", "t", op, fill(before), fill(after), ddl)


LOG = [
    event("bin.999999", 100, 0, "insert", None, (1, "x", None)),
    event("bin.999999", 100, 1, "insert", None, (2, "y", 5)),
    event("bin.999999", 200, 0, "update", (1, "x", None), (1, "x", 7)),
    event("bin.1000000", 4, 0, "update", (2, "y", 5), (2, "z", 5)),
    event("bin.1000000", 90, 0, "delete", (1, "x", 7)),
    event("bin.1000000", 150, 0, "insert", None, (1, "n", 1)),
    event("bin.1000000", 200, 0, "ddl", ddl="ALTER TABLE t ADD COLUMN c INT"),
    event("bin.1000000", 260, 0, "insert", None, (3, "w", 2, 9)),
    event("bin.1000000", 300, 0, "update", (3, "w", 2, 9), (4, "w", 2, 9)),
]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, SCHEMA)


def state(rows):
    newest = latest.latest(rows, ["id"], F.col("_position"))
    return {r.id: (r.a, r.b, r.c, r._deleted_at is not None) for r in newest.collect()}


EXPECTED = {1: ("n", 1, None, False), 2: ("z", 5, None, False), 3: ("w", 2, 9, False), 4: ("w", 2, 9, False)}


def test_latest_of_each_key(log):
    rows = changelog.records(log, "s", 0)
    assert state(rows) == EXPECTED
    assert state(rows.union(rows)) == EXPECTED  # a replay changes nothing
    assert {r.id for r in latest.latest_by_aggregate(rows, ["id"], F.col("_position")).collect()} == set(EXPECTED)
    assert latest.deduplicated(rows, [], F.col("_position")).count() == rows.count() == latest.deduplicated(rows, ["id"], F.col("_position"), append=True).count()


def test_a_delete_keeps_the_values_and_is_marked(log):
    rows = changelog.records(log.where("log_file = 'bin.999999' OR log_pos <= 90"), "s", 0)
    assert state(rows)[1] == ("x", 7, None, True)


def test_a_change_of_key_can_delete_the_old_one(log):
    rows = changelog.records(log, "s", 0, emit_delete_on_key_change=["id"])
    assert state(rows)[3][3] and not state(rows)[4][3]


def test_watched_and_ignored_columns(log):
    ids = lambda rows: [(r.log_pos, r.op) for r in rows.where("op = 'update'").orderBy("log_file", "log_pos").collect()]
    assert ids(changelog.relevant(log, watch=["A"])) == [(4, "update")]
    assert sorted(ids(changelog.relevant(log, ignore=["b"]))) == [(4, "update"), (300, "update")]
    assert sorted(ids(changelog.relevant(log, watch=["a"], ignore=["b"]))) == [(4, "update"), (300, "update")]
    assert changelog.relevant(log).count() == len(LOG)
    assert changelog.incomplete_images(log).count() == 0


def test_keys_are_tuples(spark):
    rows = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 2), (None, "c", 3), ("", "c", 4)], "x string, y string, n int")
    assert latest.latest(rows, ["x", "y"], F.col("n")).count() == 4


def test_upsert_takes_new_columns(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), spark.createDataFrame([(2, "c", 9)], "id int, v string, w int")
    assert sorted(map(tuple, latest.upsert(old, new, ["id"]).collect())) == [(1, "a", None), (2, "c", 9)]


def test_offsets(spark):
    marks = spark.createDataFrame([("s1", "bin.999999", 70), ("s2", "bin.1000000", 4), ("s3", "bin.999999", 60)], "stream string, log_file string, log_pos long")
    assert tuple(offsets.start(marks).first()) == ("bin.999999", 60)
    files = spark.createDataFrame([("bin.1000000", 3)], "log_name string, file_size long")
    assert [r.log_file for r in offsets.expired(marks, files).collect()] == ["bin.999999"]
    assert [r.stream for r in offsets.beyond_end(marks, files).collect()] == ["s2"]
    with pytest.raises(ValueError):
        offsets.verify(marks, files)
    assert tuple(offsets.start(marks, files).first()) == ("bin.1000000", 4)
    assert offsets.start(marks.limit(0)).count() == 0


def test_snapshot_goes_on_behind_the_last_key(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(3)], "a int, b int")
    left = snapshot.resumed(rows, ["a", "b"], {"a": 1, "b": 1}, {"a": 3, "b": 1}).collect()
    assert [tuple(r) for r in left] == [(2, 0), (2, 1), (3, 0), (3, 1)]
    assert snapshot.is_resumable(rows.schema, ["a"]) and not snapshot.is_resumable(rows.schema, [])


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id AS a", "id % 7 AS b", "id AS c").write.parquet(f"{tmp_path}/t")
    rows = snapshot.resumed(spark.read.parquet(f"{tmp_path}/t").select("a", "b"), ["a", "b"], {"a": 5, "b": 1})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Or(GreaterThan(a,5),And(EqualTo(a,5),GreaterThan(b,1)))" in plan.replace(" ", "") and "c#" not in plan.split("ReadSchema")[1]


def test_catching_up_equals_one_batch_and_repeats_nothing(spark, log, tmp_path):
    log.repartition(4).write.parquet(f"{tmp_path}/log")
    target = VersionedTable(spark, f"{tmp_path}/target")
    run = lambda: catch_up(spark, f"{tmp_path}/log", log.schema, target, f"{tmp_path}/check", ["id"], lambda: F.col("_position"), lambda x: changelog.records(x, "s", 0), files_a_batch=1)
    run()
    assert state(target.read()) == EXPECTED
    version = target.version()
    run()
    assert target.version() == version
    # a batch that is written again starts from the version before it
    target.upsert(changelog.records(log, "s", 0), version, ["id"], F.col("_position"))
    assert target.version() == version and state(target.read()) == EXPECTED
    log.limit(2).write.mode("append").parquet(f"{tmp_path}/log")
    run()
    assert state(target.read()) == EXPECTED and target.version() > version
    append(spark, f"{tmp_path}/log", log.schema, f"{tmp_path}/all", f"{tmp_path}/check2", lambda x: changelog.records(x, "s", 0))
    assert spark.read.parquet(f"{tmp_path}/all").count() == len(LOG) - 1 + 2
