"""Steps whose cost follows their input: what is brought together, and how it is spread over tasks."""

import pytest
from pyspark.sql import functions as F

from ripplelog.functions.ddl import column_changes
from ripplelog.operators import evolution
from ripplelog.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
LAYOUT = "array<struct<name: string, column_type: string, key: string, charset: string, collation: string>>"


def test_columns_are_brought_together_by_table_not_by_version(spark):
    """Each version takes its columns where its row is written: nothing is joined or grouped by version."""
    column = lambda name, place, since, until: ("s", "t", since, None, None, until, place, name, "int", "", None, None)
    begins = [("s", t, v, f"bin.{v}", 10 * v, *[None] * 7) for t, v in (("t", 0), ("t", 1), ("t", 2), ("bare", 0))]
    held = spark.createDataFrame([*begins, column("B", 2, 1, None), column("id", 0, 0, None), column("A", 1, 0, 2)], evolution.HISTORY)
    found = evolution.layouts(held, evolution.versions(held))
    assert {(r.table_name, r.version, r.log_file, r.log_pos, *r.columns) for r in found.collect()} == {("t", 0, "bin.0", 0, "id", "A"), ("t", 1, "bin.1", 10, "id", "A", "B"), ("t", 2, "bin.2", 20, "id", "B"), ("bare", 0, "bin.0", 0)}
    assert all([c.name for c in r.layout] == r.columns for r in found.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.index("Join") < plan.index("Aggregate")


def test_many_small_tables_are_folded_one_after_the_other(spark, monkeypatch):
    """As a stream of rows, with tables that go over the batches' ends, and as on the driver."""
    tables = [f"T{i}" for i in range(40)]
    one = lambda *names: [(n, "int", "", None, None) for n in names]
    known = "schema_name string, table_name string, layout " + LAYOUT
    start = spark.createDataFrame([("s", t, one("id")) for t in tables[:30]], known)
    server = spark.createDataFrame([("S", t.lower(), one("id", "a3")) for t in tables[20:35]], known)
    said = [("bin.10" if n % 2 else "bin.9", n // 4, n, "s", f"ALTER TABLE {t} ADD a{n} INT{' FIRST' if n % 3 else ''}, ADD b{n} INT") for i, t in enumerate(tables) for n in range(i % 9)]
    changes = column_changes(spark.createDataFrame(said[::-1], "log_file string, log_pos long, row_idx int, schema_name string, ddl string"))
    here = sorted(map(repr, evolution.history(start, changes, server).collect()))
    monkeypatch.setattr(evolution, "FOLDED", 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = evolution.history(start, changes, server)
        assert sorted(map(repr, found.collect())) == here
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r.table_name.lower() for r in found.collect()}) == 35
    assert "CoGroup" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["ddl_table_function", "ddl_changes"])
def test_statements_of_one_file_are_parsed_by_many_tasks(spark, name):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert QUERIES[name](spark, SF).select(F.spark_partition_id().alias("task")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_statements_are_spread_before_the_audit_table(spark):
    plan = [line.strip(" :+-") for line in QUERIES["schema_changes"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    parsed = next(i for i, line in enumerate(plan) if line.startswith("MapInArrow"))
    assert plan[parsed + 1].startswith("RebalancePartitions")
