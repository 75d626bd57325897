"""A staged log as a data source, and following it with a state for each key."""

import random

import pytest
from pyspark.sql import functions as F

from ripplelog.sources import log_source
from ripplelog.sources.versions import VersionedTable
from ripplelog.streaming.catchup import follow

LOG = "log_file string, log_pos long, row_idx int, id int, v string"


def events(n=300, seed=3):
    rng = random.Random(seed)
    return [(f"bin.{9 + i // 100}", i * 10, 0, rng.randrange(40), f"v{i}") for i in range(n)]


def stage(spark, rows, path, mode="append"):
    spark.createDataFrame(rows, LOG).repartition(2, "log_file", "log_pos").write.mode(mode).partitionBy("log_file").option("parquet.block.size", 4096).parquet(path)


def latest(rows):
    out = {}
    for f, p, x, i, v in sorted(rows, key=lambda r: (int(r[0][4:]), r[1], r[2])):
        out[i] = (f, p, v)
    return {(i, *r) for i, r in out.items()}


def before(rows, end):
    return [r for r in rows if (int(r[0][4:]), r[1]) < (int(end[0][4:]), end[1])]


def test_batches_between_positions(spark, tmp_path):
    rows, path = events(), f"{tmp_path}/log"
    stage(spark, rows, path)
    log_source.register(spark)
    for start, end in ((None, None), (("bin.9", 500), ("bin.11", 2500)), (("bin.10", 1200), ("bin.10", 1201)), (("bin.10", 1200), ("bin.10", 1200)), (("bin.12", 0), None)):
        found = spark.read.format("staged_log").schema(LOG).options(**log_source.options(path, start, end)).load()
        expected = rows if end is None else before(rows, end)
        expected = [r for r in expected if start is None or (int(r[0][4:]), r[1]) >= (int(start[0][4:]), start[1])]
        assert sorted(map(tuple, found.collect())) == sorted(expected)
    wider = spark.read.format("staged_log").schema(LOG + ", more double").options(**log_source.options(path)).load()
    assert wider.where("more IS NULL").count() == len(rows)
    with pytest.raises(Exception, match="given schema"):
        spark.read.format("staged_log").options(**log_source.options(path)).load()


def test_following_stops_and_goes_on_in_the_middle_of_a_file(spark, tmp_path):
    rows, path = events(), f"{tmp_path}/log"
    stage(spark, rows[:250], path)
    target = VersionedTable(spark, f"{tmp_path}/target", ["id"], 4)
    go = lambda end=None: follow(spark, path, LOG, target, f"{tmp_path}/check", ["id"], end=end)
    have = lambda: {(r.id, r.log_file, r.log_pos, r.v) for r in target.read().collect()}
    go(("bin.10", 1505))
    assert have() == latest(before(rows, ("bin.10", 1505)))
    # an end that lies before what was read changes nothing
    go(("bin.9", 20))
    assert have() == latest(before(rows, ("bin.10", 1505)))
    go(("bin.11", 2100))
    assert have() == latest(before(rows, ("bin.11", 2100)))
    go()
    assert have() == latest(rows[:250])
    stage(spark, rows[250:], path)
    go()
    assert have() == latest(rows)


def test_events_that_come_again_or_late_change_nothing(spark, tmp_path):
    rows, path = events(120), f"{tmp_path}/log"
    stage(spark, rows, path)
    target = VersionedTable(spark, f"{tmp_path}/target", ["id"], 4)
    go = lambda: follow(spark, path, LOG, target, f"{tmp_path}/check", ["id"])
    go()
    parts = target.content()["parts"]
    # the first events once more, under later positions of the stream but with their own places; and one that is new
    again = spark.createDataFrame([("bin.11", 5_000 + i, 0, r[3], f"old{i}", r[0], r[1]) for i, r in enumerate(rows[:30])] + [("bin.11", 6_000, 0, 7, "new", "bin.11", 6_000)], LOG + ", was_file string, was_pos long")
    again.write.mode("append").partitionBy("log_file").parquet(path)
    wide = LOG + ", was_file string, was_pos long"
    follow(spark, path, wide, target, f"{tmp_path}/check2", ["id"], rows=lambda x: x.select(F.coalesce("was_file", "log_file").alias("log_file"), F.coalesce("was_pos", "log_pos").alias("log_pos"), "row_idx", "id", "v"))
    expected = latest([*rows, ("bin.11", 6_000, 0, 7, "new")])
    assert {(r.id, r.log_file, r.log_pos, r.v) for r in target.read().collect()} == expected
    assert set(parts) == set(target.content()["parts"])


def test_late_rows_after_a_state_write_no_part(spark, tmp_path):
    """The state knows how far each key is: a batch of old events alone leaves the target's parts as they are."""
    rows, path = events(60), f"{tmp_path}/log"
    stage(spark, rows, path)
    target = VersionedTable(spark, f"{tmp_path}/target", ["id"], 4)
    shape = lambda x: x.select(F.when(F.col("v").startswith("again"), F.lit("bin.1")).otherwise(F.col("log_file")).alias("log_file"), "log_pos", "row_idx", "id", "v")
    go = lambda: follow(spark, path, LOG, target, f"{tmp_path}/check", ["id"], rows=shape)
    go()
    parts, version = target.content()["parts"], target.version()
    stage(spark, [("bin.9", 9_000 + i, 0, r[3], f"again{i}") for i, r in enumerate(rows)], path)
    go()
    assert target.version() > version and target.content()["parts"] == parts
    assert {(r.id, r.v) for r in target.read().collect()} == {(i, v) for i, _, _, v in latest(rows)}
