"""Runs over one log: read once, up to an end, repeatable; targets in parts; snapshots by keys of any type."""

import datetime
import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.functions.ddl import column_changes
from ripplelog.operators import evolution, fanout, offsets, snapshot
from ripplelog.operators.fanout import DDL, Followed, read_once
from ripplelog.plans.catalog import State, Stream, is_synced, route, should_sync
from ripplelog.plans.run import read_state, run
from ripplelog.sources.versions import VersionedTable

ROW = "struct<id: int, name: string>"
LOG = f"log_file string, log_pos long, row_idx int, ts_s long, schema_name string, table_name string, op string, before {ROW}, after {ROW}, ddl string"


def event(pos, table, op, before, after, file="bin.1", ddl=None):
    return (file, pos, 0, 100, "s", table, op, before, after, ddl)


def stream(table, **more):
    return Stream("s", table, {"id": "automatic", "name": "available"}, ["id"], selected=True, **more)


def at(tables, file="bin.1", pos=0):
    return State({"bookmarks": {f"s-{t}": {"log_file": file, "log_pos": pos} for t in tables}})


def go(spark, out, streams, state, log, end, **more):
    return run(spark, route(streams, state), state, str(out), lambda s: None, log, {"log_file": end[0], "log_pos": end[1]} if end else {}, "now", **more)


def plan_of(spark, rows):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_ten_streams_are_one_read_and_equal_ten_runs(spark, tmp_path):
    tables = [f"t{i}" for i in range(10)]
    rows = [event(n, f"t{n % 12}", "insert" if n % 5 else "delete", *((None, (n % 30, f"v{n}")) if n % 5 else ((n % 30, f"v{n}"), None))) for n in range(1, 400)]
    spark.createDataFrame(rows, LOG).repartition(3).write.parquet(f"{tmp_path}/log")
    read = spark.sparkContext.accumulator(0)
    schema = spark.read.parquet(f"{tmp_path}/log").schema

    def counted(batches):
        for x in batches:
            read.add(x.num_rows)
            yield x

    log = spark.read.parquet(f"{tmp_path}/log").mapInArrow(counted, schema)
    counters = {}
    for name, states in (("together", [tables]), ("apart", [[t] for t in tables])):
        read.value = 0
        for some in states:
            found = go(spark, tmp_path / name, [stream(t) for t in some], at(some), log, ("bin.1", 350), count_skipped=name == "together")
            counters.setdefault(name, {}).update(found)
        # statements are part of the same read, and so are the counters
        assert read.value == len(rows) * len(states)
    for t in tables:
        both = [sorted(map(tuple, counters[name][f"s-{t}"].collect()), key=str) for name in counters]
        assert both[0] == both[1] and len(both[0]) > 0
    told = json.loads((tmp_path / "together" / "counters.json").read_text())
    assert told["saved"] == sum(1 for r in rows if r[1] < 350 and r[5] in tables) and told["skipped"] == sum(1 for r in rows if r[1] < 350 and r[5] not in tables)
    assert told["rows"]["s-t3"]["insert"] == sum(1 for r in rows if r[1] < 350 and r[5] == "t3" and r[6] == "insert")


def test_positions_and_tables_reach_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([event(n, f"t{n % 3}", "insert", None, (n, "x"), f"bin.{n % 4}") for n in range(40)], LOG)
    rows.withColumn("file_no", offsets.number(rows)).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    kept = offsets.until(offsets.pending(log, "bin.1", 9), "bin.3", 20)
    assert {(r.log_file, r.log_pos) for r in kept.collect()} == {(f"bin.{n % 4}", n) for n in range(40) if (n % 4 == 1 and n >= 9) or n % 4 == 2 or (n % 4 == 3 and n < 20)}
    plan = plan_of(spark, kept.select("*"))
    assert "GreaterThan(file_no,1)" in plan and "LessThan(file_no,3)" in plan
    found = read_once(log, [Followed("s-t1", "s", "t1", "bin.1", 9), Followed("s-t2", "s", "t2", "bin.2", 0)], {"log_file": "bin.3", "log_pos": 20}, f"{tmp_path}/read")
    assert {r.image.id for r in found.of("s-t2").collect()} == {n for n in range(40) if n % 3 == 2 and (n % 4 == 2 or (n % 4 == 3 and n < 20))}
    assert found.skipped is None and found.saved == found.of("s-t1").count() + found.of("s-t2").count() and found.of(DDL).count() == 0
    with pytest.raises(ValueError, match="no number"):
        offsets.pending(log, "binlog", 3)


def test_many_tables_are_counted_where_they_were_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fanout, "OBSERVED", 1)
    log = spark.createDataFrame([event(n, f"t{n % 3}", "insert", None, (n, "x")) for n in range(9)], LOG)
    found = read_once(log, [Followed(f"s-t{i}", "s", f"t{i}", "bin.1", 0) for i in range(2)], {}, f"{tmp_path}/read")
    assert found.by_kind == {("s-t0", "insert"): 3, ("s-t1", "insert"): 3} and found.saved == 6


def test_the_end_is_the_next_runs(spark, tmp_path):
    log = spark.createDataFrame([event(5, "t", "insert", None, (1, "a")), event(50, "t", "insert", None, (2, "b"))], LOG)
    state = at(["t"])
    ids = lambda found: sorted(r.id for r in found["s-t"].collect())
    assert ids(go(spark, tmp_path, [stream("t")], state, log, ("bin.1", 10), append=True)) == [1]
    assert ids(go(spark, tmp_path, [stream("t")], state, log, ("bin.1", 50), append=True)) == [1]
    assert ids(go(spark, tmp_path, [stream("t")], state, log, ("bin.1", 60), append=True)) == [1, 2]
    assert state.get(stream("t"), "log_pos") == 60


def test_a_target_that_is_ahead_of_its_state(spark, tmp_path):
    """A run that is lost between a target and its state is repeated without adding its rows again."""
    log = spark.createDataFrame([event(5, "t", "insert", None, (1, "a")), event(6, "t", "update", (1, "a"), (1, "b"))], LOG)
    for _ in range(2):  # the state of the first time is not kept
        found = go(spark, tmp_path, [stream("t")], at(["t"]), log, ("bin.1", 10), append=True)
    assert found["s-t"].count() == 2
    # rows are added beside those that are there
    more = spark.createDataFrame([event(15, "t", "insert", None, (3, "c"))], LOG)
    found = go(spark, tmp_path, [stream("t")], at(["t"], pos=10), more, ("bin.1", 20), append=True)
    table = VersionedTable(spark, f"{tmp_path}/s-t")
    assert found["s-t"].count() == 3 and sorted(table.content()["parts"].values()) == ["v=0", "v=1"]


def test_statements_count_from_their_tables_position_on(spark, tmp_path):
    """Two tables with unlike positions: what was read before is not applied again."""
    rows = [event(10, None, "ddl", None, None, ddl="ALTER TABLE a ADD x INT, ADD y INT"), event(20, None, "ddl", None, None, ddl="ALTER TABLE b ADD z INT")]
    state = at(["a", "b"])
    state.put(stream("a"), log_pos=15)
    state.layouts = {f"s-{t}": [{"name": "id", "column_type": "int", "key": "PRI", "charset": None, "collation": None}] for t in "ab"}
    go(spark, tmp_path, [stream("a"), stream("b")], state, spark.createDataFrame(rows, LOG), ("bin.1", 30), bucket="in.c-x")
    assert [c["name"] for c in state.layouts["s-a"]] == ["id"] and [c["name"] for c in state.layouts["s-b"]] == ["id", "Z"]
    told = json.loads((tmp_path / "SCHEMA_CHANGES.manifest").read_text())
    assert told["destination"] == "in.c-x_metadata.SCHEMA_CHANGES" and told["primary_key"] == ["COLUMN_NAME", "QUERY", "TIMESTAMP"] and told["incremental"] is True
    assert VersionedTable(spark, f"{tmp_path}/SCHEMA_CHANGES").read().count() == 1


KEYS = {
    "text": (T.StringType(), [f"k{'ü' * (i % 3)}{i:03}" for i in range(60)]),
    "date": (T.DateType(), [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(60)]),
    "time": (T.TimestampType(), [datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i * 1000, microseconds=i) for i in range(60)]),
    "decimal": (T.DecimalType(20, 3), [Decimal(i) / 8 for i in range(60)]),
}


@pytest.mark.parametrize("kind", sorted(KEYS))
def test_snapshots_in_ranges_of_any_key(spark, tmp_path, kind):
    """A key of two columns, the first with many rows for a value; a range fails, the next run reads what is behind the last."""
    of, values = KEYS[kind]
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", of), T.StructField("v", T.IntegerType())])
    rows = spark.createDataFrame([(i // 40, values[i % 60], i) for i in range(120)], schema)
    s = Stream("s", "t", {c: "automatic" for c in "abv"}, ["a", "b"], selected=True, method="FULL_TABLE")
    state = State()
    take = lambda table: run(spark, route([s], state), state, str(tmp_path), lambda _: table, rows.where("false"), {}, "now", snapshot_parts=6)
    with pytest.raises(Exception, match="lost"):
        take(rows.withColumn("v", F.when(F.col("a") >= 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v"))))
    state = read_state(spark, str(tmp_path))
    last = state.get(s, "last_pk_fetched")
    assert set(last) == {"a", "b"} and 0 < rows.where(snapshot.after_key(rows, last)).count() < 120
    found = take(rows.where(snapshot.after_key(rows, last)))["s-t"]
    assert sorted(map(str, found.select("a", "b", "v").collect())) == sorted(map(str, rows.collect()))
    assert not state.get(s, "snapshot") and not any((tmp_path / "s-t.parts").iterdir())
    # another snapshot doesn't see the ranges of the first
    assert take(rows.where("a = 0"))["s-t"].count() == 40


def test_ranges_reach_the_scan_and_meet_each_row_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 10 AS a", "id AS b", "id AS c").write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    cuts = snapshot.key_cuts(rows, ["a", "b"], 8)
    assert len(cuts) == 7
    last, seen = None, []
    for high in [*cuts, None]:
        part = snapshot.up_to(snapshot.remaining(rows, ["a", "b"], last), high)
        seen.append(part.count())
        last = high
    assert sum(seen) == 1000 and max(seen) < 200
    plan = plan_of(spark, snapshot.up_to(rows, cuts[0]))
    assert "PushedFilters: [Or(LessThan(a" in plan
    assert snapshot.key_cuts(rows.limit(0), ["a"], 4) == [] and snapshot.key_cuts(rows, ["a", "b"], 1) == []


def test_a_change_of_one_key_writes_one_part(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ["id"], 8)
    rows = spark.range(500).selectExpr("id", "'a' AS name")
    table.write(rows, 0)
    folders = table.content()["parts"]
    assert len(folders) == 8
    change = lambda i, name: spark.createDataFrame([(i, name)], "id long, name string")
    table.upsert(change(3, "b"), 1)
    moved = [p for p, f in table.content()["parts"].items() if f != folders[p]]
    assert len(moved) == 1 and len(list((tmp_path / "v=1").glob("_part=*"))) == 1
    assert table.read().count() == 500 and table.read().where("name = 'b'").collect()[0].id == 3
    # written again, the version starts from the one before it
    table.upsert(change(4, "c"), 1)
    assert {r.id for r in table.read().where("name <> 'a'").collect()} == {4} and table.previous() == 0
    # new columns, new keys, and a part that had no rows
    table.upsert(change(9_999, "d").withColumn("more", F.lit(1)), 2)
    assert table.read().count() == 501 and table.read().where("more = 1").count() == 1 and table.read(1).count() == 500
    empty = VersionedTable(spark, f"{tmp_path}/empty", ["id"], 4)
    empty.upsert(rows.limit(0), 0)
    assert empty.read().count() == 0
    empty.upsert(change(1, "a"), 1)
    assert [tuple(r) for r in empty.read().collect()] == [(1, "a")]


def test_of_rows_with_one_key_the_last_by_order_stays(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, at int, v string")
    for buckets in (1, 4):
        table = VersionedTable(spark, f"{tmp_path}/{buckets}", ["id"], buckets)
        table.upsert(rows((1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (None, 1, "n")), 0, order=F.col("at"))
        table.upsert(rows((1, 6, "late"), (2, 2, "d"), (None, 0, "late")), 1, order=F.col("at"))
        assert {(r.id, r.v) for r in table.read().collect()} == {(1, "b"), (2, "d"), (None, "n")}


def test_old_versions_can_go(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ["id"], 4)
    for v in range(4):
        table.upsert(spark.range(v, v + 20).selectExpr("id", f"{v} AS v") if v == 0 else spark.createDataFrame([(1, v)], "id long, v int"), v)
    before = sorted(map(tuple, table.read().collect()))
    table.vacuum()
    left = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("v=*/_part=*")}
    assert left == set(table.content()["parts"].values()) | set(table.content(table.previous())["parts"].values())
    assert sorted(map(tuple, table.read().collect())) == before and len(list(tmp_path.glob("versions/*.json"))) == 2


def statements(spark, n):
    """n statements on one table: columns come first, last and behind others, and go again."""
    said, there = [], []
    for i in range(n):
        if i % 3 == 2 and len(there) > 2:
            said.append(f"ALTER TABLE t DROP {there.pop(i % len(there))}")
        else:
            where = ["", " FIRST", f" AFTER {there[i % len(there)]}" if there else ""][i % 3]
            said.append(f"ALTER TABLE t ADD c{i} INT{where}")
            there.append(f"c{i}")
    rows = [(f"bin.{i // 1000}", i, 0, "s", q) for i, q in enumerate(said)]
    start = spark.createDataFrame([("s", "t", [("id", "int", "PRI", None, None)])], "schema_name string, table_name string, layout array<struct<name: string, column_type: string, key: string, charset: string, collation: string>>")
    return said, evolution.history(start, column_changes(spark.createDataFrame(rows, "log_file string, log_pos long, row_idx int, schema_name string, ddl string")))


@pytest.mark.parametrize("folded", [0, 500])
def test_layouts_against_one_after_the_other(spark, monkeypatch, folded):
    """By tasks, and on the driver where the statements are few."""
    from ripplelog.functions.ddl import changes

    monkeypatch.setattr(evolution, "FOLDED", folded)
    said, held = statements(spark, 60)
    found = {r.version: r.columns for r in evolution.layouts(held, evolution.versions(held)).collect()}
    layout = (evolution.Column("id", "int", "PRI"),)
    for version, sql in enumerate(said, 1):
        layout = evolution.apply(layout, changes(sql, "s"))
        assert found[version] == [c.name for c in layout]
    assert found[0] == ["id"]


def test_ten_thousand_statements_on_one_table(spark, tmp_path):
    said, held = statements(spark, 10_000)
    began = time.monotonic()
    held.write.parquet(f"{tmp_path}/held")
    assert time.monotonic() - began < 60
    held = spark.read.schema(evolution.HISTORY).parquet(f"{tmp_path}/held")
    # a row for each version and each column that ever was, not one for each column of each version
    assert held.count() == 1 + len(said) + 1 + sum(" ADD " in s for s in said)
    events = spark.range(500).selectExpr("'s' AS schema_name", "'t' AS table_name", "concat('bin.', id * 20 div 1000) AS log_file", "id * 20 AS log_pos")
    placed = evolution.as_of(events, held)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Window" in plan
    assert all(r.version == r.log_pos for r in placed.collect())


def test_layouts_by_window_equal_those_by_range(spark):
    versions = [("s", t, v, f"bin.{f}" if f else None, p) for t, places in (("t", [(0, -1), (2, 5), (2, 9), (4, 1), (10, 3)]), ("u", [(0, -1), (3, 3)])) for v, (f, p) in enumerate(places)]
    held = spark.createDataFrame([(*v, *[None] * 7) for v in versions], evolution.HISTORY)
    events = spark.createDataFrame([("s", t, f"bin.{f}", p, i) for i, (t, f, p) in enumerate((t, f, p) for t in "tux" for f in (1, 2, 3, 4, 9, 10, 11) for p in (0, 1, 2, 3, 4, 5, 6, 9, 10))], "schema_name string, table_name string, log_file string, log_pos long, no int")
    ranged, windowed = (sorted(map(tuple, evolution.as_of(events, held, window=w).collect()), key=lambda r: r[4]) for w in (False, True))
    assert ranged == windowed and len(ranged) == events.count()
    plan = evolution.as_of(events, held, window=True)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "log_file" in plan


def test_selection_of_a_whole_catalogue_equals_that_of_one_column(spark):
    cases = [(i, s, d) for i in ("automatic", "unsupported", "available") for s in (None, True, False) for d in (True, False)]
    found = spark.createDataFrame(cases, "i string, s boolean, d boolean").withColumn("synced", is_synced(F.col("i"), F.col("s"), F.col("d")))
    assert all(r.synced is should_sync(r.i, r.s, r.d) for r in found.collect())
