"""Types, values, sinks, catalogue, state and a whole run."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.functions import types, values
from ripplelog.plans.catalog import ConfigError, State, Stream, apply_mapping, mapping_of, require, route, should_sync
from ripplelog.operators import changelog, evolution
from ripplelog.plans.config import mapping_text, parse_mapping
from ripplelog.plans.run import read_state, run
from ripplelog.sources import server, sinks


@pytest.mark.parametrize(
    "server_type, spark_type",
    [
        ("tinyint(1)", T.BooleanType()), ("bit(8)", T.BooleanType()), ("tinyint(4) unsigned", T.ShortType()), ("int(11)", T.IntegerType()), ("int unsigned", T.LongType()),
        ("bigint(20) unsigned", T.DecimalType(20, 0)), ("decimal(65,30)", T.StringType()), ("decimal(10,2)", T.DecimalType(10, 2)), ("varchar(255)", T.StringType()),
        ("blob", T.BinaryType()), ("time", T.DayTimeIntervalType()), ("datetime", T.TimestampNTZType()), ("year", None), ("geometry", None),
    ],
)
def test_types(server_type, spark_type):
    assert types.spark_type(server_type) == spark_type


def test_fields_carry_what_the_server_says():
    field = types.ServerColumn("id", "int(11)", 1, "PRI").field()
    assert not field.nullable and field.metadata["inclusion"] == "automatic" and field.metadata["length"] == 11 and field.metadata["minimum"] == str(-(2**31))


def test_values(spark):
    row = spark.range(1).select(
        values.boolean(F.lit(None).cast("int")), values.boolean(F.lit(2)), values.boolean(F.lit(0)),
        *[values.duration_text(F.lit(s)) for s in (3723, -3600, 86400 * 34 + 22 * 3600 + 3599)],
        values.zero_date_to_null(F.lit("0000-00-00 00:00:00")), values.binary_text(F.unhex(F.lit("00610000")), "hex", strip_nul=True),
        values.binary_text(F.lit(None).cast("binary"), "hex"), values.binary_text(F.lit(None).cast("binary"), "base64", null_as_nul=True), values.identifier(F.lit("`a`")),
    ).first()
    assert tuple(row) == (None, 1, 0, "1:02:03", "-1 day, 23:00:00", "34 days, 22:59:59", None, "61", None, "AA==", "A")
    with pytest.raises(Exception, match="MALFORMED"):
        spark.range(1).select(values.binary_text(F.unhex(F.lit("ff")))).collect()


def test_export_by_type(spark):
    row = spark.sql("SELECT true AS f, INTERVAL '1 02:03:04' DAY TO SECOND AS t, TIMESTAMP '2024-01-02 03:04:05.5' AS at, DATE '2024-01-02' AS d, X'41' AS b")
    assert tuple(sinks.exported(row, "base64").first()) == (1, "1 day, 2:03:04", "2024-01-02 03:04:05.500000", "2024-01-02", "QQ==")


def test_csv_keeps_quotes_line_feeds_and_nulls(spark, tmp_path):
    rows = [('say "x",\ny', "1"), ("", "2"), (None, "3")]
    sinks.write_csv(spark.createDataFrame(rows, "a string, b string"), f"{tmp_path}/t", null="\\N")
    assert sorted(map(tuple, sinks.read_csv(spark, f"{tmp_path}/t", "a string, b string", null="\\N").collect()), key=lambda r: r[1]) == rows
    sinks.write_slices(spark.range(25).coalesce(1), f"{tmp_path}/s", 10)
    assert len([f for f in (tmp_path / "s").iterdir() if f.name.startswith("part")]) == 3


@pytest.mark.parametrize("inclusion, selected, default, expected", [("automatic", False, False, True), ("unsupported", True, True, False), ("available", None, True, True), ("available", None, False, False), ("available", True, False, True), ("available", False, True, False)])
def test_selection(inclusion, selected, default, expected):
    assert should_sync(inclusion, selected, default) is expected


def streams():
    return [Stream("shop", "Orders", {"id": "automatic", "note": "available", "shape": "unsupported"}, ["id"]), Stream("shop", "people", {"id": "automatic"}, ["id"]), Stream("shop", "v", {"id": "available"}, [], is_view=True)]


def test_mapping():
    text = json.dumps({"SHOP": {"tables": [{"orders": {"selected": True, "columns": {"NOTE": False}, "columns_to_watch": ["note"]}}, {"gone": {"selected": True}}]}})
    (s,) = apply_mapping(streams(), parse_mapping(text))
    assert s.table == "Orders" and s.desired() == ["id"] and s.watch == ["note"]
    assert set(mapping_of(streams())["shop"]["tables"][0]["Orders"]["columns"]) == {"id", "note", "shape"}
    for wrong in ({"v": {"selected": True}}, {"people": {"selected": True, "replication-method": "INCREMENTAL"}}, {"people": {"selected": True, "replication-method": "X"}}):
        with pytest.raises(ConfigError):
            apply_mapping(streams(), {"shop": {"tables": [wrong]}})
    with pytest.raises(ConfigError):
        require({"a": None, "b": False}, [["a"], ["b"], ["c", "d"]])
    require({"a": 0, "b": False}, [["a"], ["b", "c"]])


def test_state_and_routing():
    state = State({"bookmarks": {"shop-people": {"log_file": "bin.1", "log_pos": 4, "junk": 1}}, "last_table_schemas": [], "storage_columns": {"shop-people": ["id"]}})
    a, b, _ = streams()
    plan = route([b, a], state)
    assert plan.snapshots == [a] and plan.from_log == [b] and state.storage["shop-people"] == ["ID"]
    state.trim(b)
    assert "junk" not in state.bookmarks["shop-people"]
    state.put(b, max_pk_values={"id": 9})
    assert route([b], state).snapshots == [b]
    state.clear(b, "max_pk_values")
    assert not state.needs_snapshot(b)
    state.reset(b)
    assert state.needs_snapshot(b)


def test_a_run_and_the_next(spark, tmp_path):
    """Snapshot first, then its log; a table read by key; state and targets go on."""
    people = Stream("shop", "people", {"id": "automatic", "name": "available"}, ["id"], selected=True)
    visits = Stream("shop", "visits", {"id": "automatic", "at": "available"}, ["id"], method="INCREMENTAL", replication_key="at")
    tables = {"people": [(1, "a"), (2, "b")], "visits": [(1, 5), (2, 6)]}
    read = lambda s: spark.createDataFrame(tables[s.table], "id int, name string" if s is people else "id int, at int")
    row = "struct<id: int, name: string>"
    events = spark.createDataFrame(
        [("bin.1", 10, 0, 100, "shop", "people", "update", (2, "b"), (2, "c")), ("bin.1", 20, 0, 200, "shop", "people", "delete", (1, "a"), None)],
        f"log_file string, log_pos long, row_idx int, ts_s long, schema_name string, table_name string, op string, before {row}, after {row}",
    )
    go = lambda state: run(spark, route([people, visits], state), state, str(tmp_path), read, lambda s: events, {"log_file": "bin.1", "log_pos": end}, "now")
    end = 5
    state = State()
    first = go(state)
    assert first["shop-people"].count() == 2 and state.get(visits, "replication_key_value") == "6" and not state.needs_snapshot(people)
    tables["visits"] = [(2, 7), (3, 8)]
    state, end = read_state(spark, str(tmp_path)), 30
    second = go(state)
    assert {(r.id, r.name, r._deleted_at is not None) for r in second["shop-people"].collect()} == {(1, "a", True), (2, "c", False)}
    assert {(r.id, r.at) for r in second["shop-visits"].collect()} == {(1, 5), (2, 7), (3, 8)}
    assert json.loads((tmp_path / "shop-people.manifest").read_text())["primary_key"] == ["ID"]
    assert state.storage["shop-people"] == ["ID", "NAME", "_SYNCED_AT", "_DELETED_AT", "_CHANGE_AT", "_READ_AT"]
    assert isinstance(second["shop-people"].where("_deleted_at IS NOT NULL").first()._deleted_at, datetime.datetime)


def test_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        server.quoted("a`b")
    assert server.jdbc_options("h", 3306, "u", "p")["fetchsize"] == "100000"
    (tmp_path / "logs.json").write_text(json.dumps({"logs": [{"log_name": "bin.2", "file_size": "10"}, {"log_name": "bin.1", "file_size": "0"}]}))
    assert {tuple(r) for r in server.log_list(spark, f"{tmp_path}/logs.json").collect()} == {("bin.2", 10), ("bin.1", 0)}
    constraints = spark.createDataFrame([("p", "s", "t", "PRIMARY KEY"), ("u", "s", "t", "UNIQUE")], "constraint_name string, schema_name string, table_name string, constraint_type string")
    usage = spark.createDataFrame([("p", "s", "t", "id"), ("u", "s", "t", "x")], "constraint_name string, schema_name string, table_name string, column_name string")
    assert [r.column_name for r in server.primary_keys(constraints, usage).collect()] == ["id"]


ROW = "struct<id: int, name: string, extra: int>"
LOG = f"log_file string, log_pos long, row_idx int, ts_s long, schema_name string, table_name string, op string, before {ROW}, after {ROW}, ddl string"


def people_log(spark, *more):
    """An insert, a column by DDL, an update that sets it; and `more`."""
    at = lambda pos, op, before, after, ddl=None: ("bin.1", pos, 0, 100, "shop", "people", op, before, after, ddl)
    rows = [at(10, "insert", None, (3, "c", None)), at(20, "ddl", None, None, "ALTER TABLE people ADD COLUMN extra INT"), at(30, "update", (2, "b", None), (2, "b", 7))]
    return spark.createDataFrame([*rows, *(at(*m) for m in more)], LOG)


def people():
    return Stream("shop", "people", {"id": "automatic", "name": "available"}, ["id"], selected=True)


def people_catalogue(spark):
    return spark.createDataFrame([("shop", "people", [(1, "id", "int", "PRI"), (2, "name", "text", "")])], "schema_name string, table_name string, columns array<struct<ordinal: int, column_name: string, column_type: string, column_key: string>>")


def started(spark, out):
    state = State()
    run(spark, route([people()], state), state, out, lambda s: spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), spark.createDataFrame([], LOG), {"log_file": "bin.1", "log_pos": 4}, "now")
    return read_state(spark, out)


@pytest.mark.parametrize("append", [False, True])
def test_ddl_in_a_run(spark, tmp_path, append):
    """A column that the log adds is read from then on; layouts, storage columns and the audit table follow; a second run
    over the same log from the new position adds nothing."""
    state, s = started(spark, str(tmp_path)), people()
    go = lambda: run(spark, route([s], state), state, str(tmp_path), None, people_log(spark), {"log_file": "bin.1", "log_pos": 40}, "now", append=append, catalogue=people_catalogue(spark), export="csv")
    found = go()["shop-people"]
    assert {(r.id, r.name, r.extra) for r in found.collect()} == {(1, "a", None), (2, "b", 7), (3, "c", None)} | ({(2, "b", None)} if append else set())
    assert [c["name"] for c in state.layouts["shop-people"]] == ["id", "name", "EXTRA"] and state.storage["shop-people"][-1] == "EXTRA"
    audit = spark.read.parquet(f"{tmp_path}/SCHEMA_CHANGES/v=0").collect()
    assert [(r.table, r.change_type, r.column_name) for r in audit] == [("people", "ADD_COLUMN", "extra")]
    state = read_state(spark, str(tmp_path))
    assert state.layouts["shop-people"][0]["key"] == "PRI"
    assert go()["shop-people"].count() == (4 if append else 3)
    told = json.loads((tmp_path / "shop-people.manifest").read_text())
    assert [c["base_type"] for c in told["column_metadata"]][:3] == ["INTEGER", "STRING", "STRING"] and told["columns"][-1] == "EXTRA"
    assert spark.read.option("header", True).csv(f"{tmp_path}/shop-people.csv/v=1").columns == told["columns"]


def test_a_run_checks_what_it_reads(spark, tmp_path):
    state, s = started(spark, str(tmp_path)), people()
    go = lambda log, files=None: run(spark, route([s], state), state, str(tmp_path), None, log, {"log_file": "bin.1", "log_pos": 40}, "now", files=files, catalogue=people_catalogue(spark))
    with pytest.raises(ValueError, match="gone"):
        go(people_log(spark), spark.createDataFrame([("bin.2", 10)], "log_name string, file_size long"))
    with pytest.raises(ValueError, match="behind the end"):
        go(people_log(spark), spark.createDataFrame([("bin.1", 2)], "log_name string, file_size long"))
    with pytest.raises(ValueError, match="images"):
        go(people_log(spark, (35, "update", None, (1, "x", None))))
    with pytest.raises(evolution.LayoutError, match="fit"):
        go(people_log(spark, (15, "insert", None, (9, "x", 1))))
    assert state.get(s, "log_pos") == 4


def test_state_is_written_after_each_table(spark, tmp_path):
    good, bad = (Stream("shop", t, {"id": "automatic"}, ["id"], selected=True, method="FULL_TABLE") for t in ("good", "bad"))

    def read(s):
        if s.table == "bad":
            raise OSError("no connection")
        return spark.range(3).select("id")

    state = State()
    with pytest.raises(OSError):
        run(spark, route([good, bad], state), state, str(tmp_path), read, lambda s: None, {}, "now")
    left = read_state(spark, str(tmp_path))
    assert left.get(good, "initial_full_table_complete") is True and left.syncing == "shop-bad" and route([good, bad], left).snapshots[0] == bad


def test_lists_of_tables_are_filters_and_layouts_are_broadcast(spark, tmp_path):
    spark.range(10).selectExpr("'s' AS schema_name", "concat('t', id) AS table_name", "'bin.1' AS log_file", "id AS log_pos").write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    pairs = spark.createDataFrame([("s", "t1"), ("s", "t3"), ("x", "t2")], "schema_name string, table_name string")
    kept = changelog.of_tables(log, pairs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 2 and "Join" not in plan and "PushedFilters: []" not in plan
    assert tuple(changelog.saved_and_skipped(log, pairs).first()) == (2, 8)
    held = spark.createDataFrame([("s", "t1", 0, None, -1, *[None] * 7)], evolution.HISTORY)
    plan = evolution.as_of(log, held)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_long_lists_of_tables(spark, monkeypatch):
    monkeypatch.setattr(changelog, "FILTERED", 1)
    log = spark.range(10).selectExpr("'s' AS schema_name", "concat('t', id) AS table_name")
    pairs = spark.createDataFrame([("s", "t1"), ("s", "t3"), ("x", "t2")], "schema_name string, table_name string")
    assert changelog.of_tables(log, pairs).count() == 2 and tuple(changelog.saved_and_skipped(log, pairs).first()) == (2, 8)


def test_discovery_output():
    text = mapping_text(mapping_of(streams()))
    assert parse_mapping(text) == mapping_of(streams())
    pytest.importorskip("yaml")
    assert parse_mapping(mapping_text(mapping_of(streams()), "yaml"), "yaml") == mapping_of(streams())


def test_nested_json(spark):
    row = spark.sql("SELECT named_struct('a', X'41', 'b', array(map('k', X'42'))) AS n, X'7B7D' AS j")
    assert tuple(sinks.exported(row).first()) == ('{"a":"A","b":[{"k":"B"}]}', "{}")
    assert spark.range(1).select(values.json_text(F.lit(None).cast("binary"), True, T.BinaryType())).first()[0] == "null"
