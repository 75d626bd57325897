"""The named queries, one or more for each operator, and SQL that gives the same rows."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog.functions import types, values
from ripplelog.functions.ddl import column_changes, register, spread
from ripplelog.operators import changelog, evolution, latest, offsets, snapshot
from ripplelog.sources import log_source, server
from ripplelog.plans.catalog import ConfigError, State, Stream, apply_mapping, discovered, is_synced, mapping_of, route
from ripplelog.plans.config import mapping_text, parse_mapping
from ripplelog.plans.run import read_state, run
from ripplelog.sources import sinks
from ripplelog.sources.sinks import base_types
from ripplelog.sources.versions import VersionedTable
from ripplelog.streaming.catchup import catch_up, follow

SYNCED = "2024-02-01 00:00:00.000000"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; it goes when the session's JVM ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if shared.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset, and the warehouse is a folder of one machine")
    path = f"{shared.rstrip('/')}/query-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def event_order() -> Column:
    return F.struct("ts", "event_id")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change log of one table: a user's first event is an insert, later ones are updates."""
    versions = snapshot.with_before_image(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "ts", "user_id", "event_type", "value", "props"])
    placed = {
        "log_file": F.concat(F.lit("bin."), F.date_format("ts", "yyyyMMdd")), "log_pos": F.col("event_id"), "row_idx": F.lit(0), "ts_s": values.epoch_seconds(F.col("ts")),
        "schema_name": F.lit("shop"), "table_name": F.lit("events"),
    }
    return versions.select(*[c.alias(n) for n, c in placed.items()], "op", "before", "after")


LATEST_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(LATEST_SQL)
def latest_per_pk(spark, sf_dir):
    return latest.latest(table(spark, sf_dir, "events"), ["user_id"], event_order())


@query(LATEST_SQL)
def latest_per_pk_max_by(spark, sf_dir):
    return latest.latest_by_aggregate(table(spark, sf_dir, "events"), ["user_id"], event_order())


@query("SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def latest_turn(spark, sf_dir):
    return latest.latest(table(spark, sf_dir, "conversations"), ["conv_id"], F.col("turn")).select("conv_id", "turn", "role", "text")


@query(
    f"""SELECT event_id, user_id, event_type, value, '{SYNCED}' AS _synced_at, CAST(NULL AS TIMESTAMP) AS _deleted_at,
    CAST(floor(epoch(ts)) AS BIGINT) AS _change_at, CAST(0 AS BIGINT) AS _read_at FROM events"""
)
def append_mode_events(spark, sf_dir):
    rows = changelog.records(event_log(spark, sf_dir), SYNCED, 0, ["event_id", "user_id", "event_type", "value"])
    return latest.deduplicated(rows, ["user_id"], F.col("_position"), append=True).drop("schema_name", "table_name", "_position")


@query(
    """WITH v AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS old, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id, event_type FROM v WHERE n > 1 AND event_type IS DISTINCT FROM old"""
)
def watch_columns(spark, sf_dir):
    kept = changelog.relevant(event_log(spark, sf_dir), watch=["EVENT_TYPE"]).where("op = 'update'")
    return kept.select("after.event_id", "after.user_id", "after.event_type")


@query(
    """WITH v AS (SELECT *, lag(event_type) OVER w AS old_type, lag(props) OVER w AS old_props, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id FROM v WHERE n > 1 AND (event_type IS DISTINCT FROM old_type OR props IS DISTINCT FROM old_props)"""
)
def ignore_columns(spark, sf_dir):
    kept = changelog.relevant(event_log(spark, sf_dir), ignore=["value", "event_id", "ts"]).where("op = 'update'")
    return kept.select("after.event_id", "after.user_id")


@query(
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS deleted_s,
    CAST(epoch(o_orderdate) AS BIGINT) AS _change_at, '{SYNCED}' AS _synced_at FROM orders"""
)
def soft_delete(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    image = F.struct("o_orderkey", "o_orderstatus")
    log = o.select(
        F.lit("bin.1").alias("log_file"), F.col("o_orderkey").alias("log_pos"), F.lit(0).alias("row_idx"), values.epoch_seconds(F.col("o_orderdate")).alias("ts_s"), F.lit("shop").alias("schema_name"), F.lit("orders").alias("table_name"),
        F.when(F.col("o_orderstatus") == "F", "delete").otherwise("insert").alias("op"), F.when(F.col("o_orderstatus") == "F", image).alias("before"), F.when(F.col("o_orderstatus") != "F", image).alias("after"),
    )
    rows = changelog.records(log, SYNCED, 0)
    return rows.select("o_orderkey", "o_orderstatus", F.coalesce(F.unix_seconds("_deleted_at"), F.lit(-1)).alias("deleted_s"), "_change_at", "_synced_at")


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'changed' ELSE c_name END AS c_name, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def upsert_by_pk(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("changed").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return latest.upsert(c, changed, ["c_custkey"])


@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN CAST(1700000000 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS _change_at,
    '{SYNCED}' AS _synced_at FROM orders"""
)
def snapshot_plus_log(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    log = o.where("o_orderkey % 4 = 0").select(
        F.lit("bin.1").alias("log_file"), F.col("o_orderkey").alias("log_pos"), F.lit(0).alias("row_idx"), F.lit(1_700_000_000).cast("long").alias("ts_s"), F.lit("shop").alias("schema_name"), F.lit("orders").alias("table_name"), F.lit("update").alias("op"),
        F.struct("o_orderkey", "o_orderstatus").alias("before"), F.struct("o_orderkey", F.lit("X").alias("o_orderstatus")).alias("after"),
    )
    new = latest.latest(changelog.records(log, SYNCED, 0), ["o_orderkey"], F.col("_position")).drop("schema_name", "table_name", "_position")
    full = snapshot.snapshot(o, ["o_orderkey", "o_orderstatus"], SYNCED)
    return latest.upsert(full, new, ["o_orderkey"]).select("o_orderkey", "o_orderstatus", "_change_at", "_synced_at")


@query(f"SELECT p_partkey, p_name, p_retailprice, '{SYNCED}' AS _synced_at, CAST(NULL AS TIMESTAMP) AS _deleted_at, CAST(0 AS BIGINT) AS _change_at, CAST(0 AS BIGINT) AS _read_at FROM part")
def full_table_projection(spark, sf_dir):
    return snapshot.snapshot(table(spark, sf_dir, "part"), ["p_partkey", "p_name", "p_retailprice"], SYNCED)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey > 700 OR (l_orderkey = 700 AND l_linenumber > 3)) AND l_orderkey <= 9000 AND l_linenumber <= 6")
def keyset_resume(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return snapshot.resumed(rows, ["l_orderkey", "l_linenumber"], {"l_orderkey": 700, "l_linenumber": 3}, {"l_orderkey": 9000, "l_linenumber": 6})


@query("SELECT max(l_orderkey) AS max_l_orderkey, max(l_linenumber) AS max_l_linenumber FROM lineitem")
def max_pk_values(spark, sf_dir):
    return snapshot.max_key_values(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'")
def incremental_key(spark, sf_dir):
    return snapshot.since_bookmark(table(spark, sf_dir, "events"), "ts", "2024-01-10 00:00:00").select("event_id", "user_id", "ts")


@query("SELECT event_id, user_id, ts FROM events ORDER BY ts, event_id LIMIT 50")
def incremental_page(spark, sf_dir):
    return snapshot.page(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "ts", ["event_id"], 50)


@query("SELECT max(ts) AS bookmark FROM events")
def incremental_bookmark(spark, sf_dir):
    return snapshot.next_bookmark(table(spark, sf_dir, "events"), "ts")


@query("SELECT event_id, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) + 1 AS chunk FROM events")
def chunk_number(spark, sf_dir):
    return snapshot.chunk_numbers(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 1000)


def bookmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bookmark for each user's stream in each day's file."""
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("stream"), F.concat(F.lit("bin."), F.date_format("ts", "yyyyMMdd")).alias("log_file"), F.col("event_id").alias("log_pos"))


@query("SELECT 'bin.' || strftime(ts, '%Y%m%d') AS log_file, min(event_id) AS log_pos, count(DISTINCT user_id) AS n_streams FROM events GROUP BY ALL")
def min_pos_per_file(spark, sf_dir):
    return offsets.first_positions(bookmarks(spark, sf_dir)).select("log_file", "log_pos", F.size("streams").cast("long").alias("n_streams"))


@query("SELECT 'bin.' || strftime(ts, '%Y%m%d') AS log_file, event_id AS log_pos FROM events ORDER BY 1, 2 LIMIT 1")
def start_bookmark(spark, sf_dir):
    return offsets.start(bookmarks(spark, sf_dir))


def kept_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").where(day >= "2024-01-15").select(F.concat(F.lit("bin."), F.date_format("ts", "yyyyMMdd")).alias("log_name"), F.lit(10**12).alias("file_size")).distinct()


@query("SELECT DISTINCT 'bin.' || strftime(ts, '%Y%m%d') AS log_file FROM events EXCEPT SELECT DISTINCT 'bin.' || strftime(ts, '%Y%m%d') FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'")
def expired_logs(spark, sf_dir):
    return offsets.expired(bookmarks(spark, sf_dir), kept_files(spark, sf_dir))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def event_filter(spark, sf_dir):
    log = table(spark, sf_dir, "events").withColumn("schema_name", F.lit("shop")).withColumn("table_name", F.col("event_type"))
    wanted = spark.createDataFrame([("shop", "click"), ("shop", "purchase"), ("other", "view")], "schema_name string, table_name string")
    return changelog.of_tables(log, wanted).select("event_id", "event_type")


@query("SELECT count(*) FILTER (event_type IN ('click', 'view')) AS saved, count(*) FILTER (event_type NOT IN ('click', 'view')) AS skipped FROM events")
def saved_and_skipped(spark, sf_dir):
    log = table(spark, sf_dir, "events").withColumn("schema_name", F.lit("shop")).withColumn("table_name", F.col("event_type"))
    return changelog.saved_and_skipped(log, spark.createDataFrame([("shop", "click"), ("shop", "view")], "schema_name string, table_name string"))


@query("SELECT p_partkey, p_name AS plain, hex(encode(p_name)) AS hex, to_base64(encode(p_name)) AS base64 FROM part")
def binary_encode(spark, sf_dir):
    b = F.encode("p_name", "UTF-8")
    return table(spark, sf_dir, "part").select("p_partkey", *[values.binary_text(b, how).alias(how) for how in ("plain", "hex", "base64")])


@query("SELECT doc_id, CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 0 THEN 0 ELSE 1 END AS toxic, CASE WHEN quality * 7 = 0 THEN 0 ELSE 1 END AS quality FROM labels")
def bool_normalise(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", values.boolean(F.col("toxic")).alias("toxic"), values.boolean(F.col("quality") * 7).alias("quality"))


@query("SELECT event_id, props, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", values.json_text(F.col("props")).alias("props"), F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, epoch_us(ts) AS micros FROM events")
def epoch_seconds(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", values.epoch_seconds(F.col("ts")).alias("seconds"), values.epoch_micros(F.col("ts")).alias("micros"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS utc, strftime(ts, '%Y-%m-%d') AS day FROM events")
def utc_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", values.utc_text(F.col("ts")).alias("utc"), values.date_text(F.col("ts")).alias("day"))


@query(
    """SELECT p_partkey, CAST(d // 86400 AS VARCHAR) || CASE WHEN abs(d // 86400) = 1 THEN ' day, ' ELSE ' days, ' END || CAST(d % 86400 // 3600 AS VARCHAR) || ':' || lpad(CAST(d % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(d % 60 AS VARCHAR), 2, '0') AS took
    FROM (SELECT p_partkey, 86400 + p_size * 3601 AS d FROM part)"""
)
def duration_format(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", values.duration_text((86_400 + F.col("p_size") * 3601).cast("long")).alias("took"))


@query("SELECT event_type AS table_name, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'insert' END AS op, count(*) AS n_rows FROM events GROUP BY ALL")
def row_counters(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("insert")
    log = table(spark, sf_dir, "events").select(F.lit("shop").alias("schema_name"), F.col("event_type").alias("table_name"), kind.alias("op"))
    return changelog.counters(log).drop("schema_name")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def schema_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "s_acctbal")
    return c.unionByName(s, allowMissingColumns=True)


@query("SELECT p_partkey AS \"P_PARTKEY\", CAST(NULL AS VARCHAR) AS \"DROPPED\", p_name AS \"P_NAME\" FROM part")
def storage_order(spark, sf_dir):
    stored = evolution.grown(["P_PARTKEY", "DROPPED"], ["p_partkey", "p_name"])
    return evolution.in_storage_order(table(spark, sf_dir, "part"), stored)


@query(
    """WITH o AS (SELECT c_custkey AS path, c_name AS v FROM customer WHERE c_custkey % 7 <> 0), n AS (SELECT c_custkey AS path, CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE c_name END AS v FROM customer WHERE c_custkey % 11 <> 0)
    SELECT coalesce(o.path, n.path) AS path, CASE WHEN o.path IS NULL THEN 'Add' WHEN n.path IS NULL THEN 'Remove' ELSE 'Change' END AS kind, o.v AS old_value, n.v AS new_value
    FROM o FULL JOIN n ON o.path = n.path WHERE o.path IS NULL OR n.path IS NULL OR o.v IS DISTINCT FROM n.v"""
)
def state_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("path"), F.col("c_name").alias("v"))
    new = c.where("path % 11 <> 0").withColumn("v", F.when(F.col("path") % 5 == 0, "x").otherwise(F.col("v")))
    return evolution.state_diff(c.where("path % 7 <> 0"), new, "path", "v")


@query(LATEST_SQL)
def stream_equals_batch(spark, sf_dir):
    """events as five staged files, caught up with in three batches into a table of versions."""
    folder = new_folder(spark)
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(5, "event_id").write.mode("overwrite").parquet(f"{folder}/log")
    target = VersionedTable(spark, f"{folder}/target")
    catch_up(spark, f"{folder}/log", events.schema, target, f"{folder}/checkpoint", ["user_id"], event_order, files_a_batch=2)
    return target.read()


COLUMNS = [
    ("shop", "orders", "id", "bigint(20) unsigned", 1, "PRI"), ("shop", "orders", "price", "decimal(10,2)", 3, ""), ("shop", "orders", "note", "varchar(255)", 2, ""),
    ("shop", "orders", "paid", "tinyint(1)", 4, ""), ("shop", "people", "born", "date", 2, ""), ("shop", "people", "id", "int(11)", 1, "PRI"), ("shop", "v", "id", "int", 1, ""),
    ("mysql", "user", "name", "char(32)", 1, "PRI"),
]


def column_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COLUMNS, "schema_name string, table_name string, column_name string, column_type string, ordinal int, column_key string")


def supplier_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the columns of their nation's table, with types of all kinds."""
    s = table(spark, sf_dir, "supplier")
    size = (F.col("s_suppkey") % 60 + 1).cast("string")
    kinds = [F.lit("bigint(20) unsigned"), F.concat(F.lit("DECIMAL("), size, F.lit(",2)")), F.concat(F.lit("varchar("), size, F.lit(")")), F.lit("tinyint(1)"), F.lit("Date"), F.lit("geometry"), F.lit("mediumint(8) unsigned"), F.lit("time")]
    kind = F.element_at(F.array(*kinds), (F.col("s_suppkey") % len(kinds) + 1).cast("int"))
    schema = F.when(F.col("s_nationkey") % 7 == 0, "mysql").otherwise("shop")
    return s.select(schema.alias("schema_name"), F.concat(F.lit("t"), "s_nationkey").alias("table_name"), F.col("s_name").alias("column_name"), kind.alias("column_type"), F.col("s_suppkey").cast("int").alias("ordinal"), F.when(F.col("s_suppkey") % 9 == 0, "PRI").otherwise("").alias("column_key"))


@query("SELECT 't' || n_nationkey AS table_name, string_agg(s_name, ',' ORDER BY s_suppkey) AS columns FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 7 <> 0 AND n_regionkey <> 2 GROUP BY ALL")
def catalog_columns(spark, sf_dir):
    """The catalogue without the server's own schema and without views, which the nations of a region are."""
    n = table(spark, sf_dir, "nation")
    kinds = n.select(F.when(F.col("n_nationkey") % 7 == 0, "mysql").otherwise("shop").alias("schema_name"), F.concat(F.lit("t"), "n_nationkey").alias("table_name"), F.when(F.col("n_regionkey") == 2, "VIEW").otherwise("BASE TABLE").alias("table_type"))
    found = server.catalogue(supplier_columns(spark, sf_dir), kinds)
    return found.select("table_name", F.array_join(F.transform("columns", lambda c: c["column_name"]), ",").alias("columns"))


@query(
    """SELECT s_name AS column_name, CASE s_suppkey % 8 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'NUMERIC' WHEN 2 THEN 'STRING' WHEN 3 THEN 'INTEGER' WHEN 4 THEN 'DATE' WHEN 6 THEN 'INTEGER' WHEN 7 THEN 'TIMESTAMP' END AS base_type,
    CASE s_suppkey % 8 WHEN 0 THEN 'decimal(20,0)' WHEN 1 THEN CASE WHEN s_suppkey % 60 + 1 > 38 THEN 'string' ELSE 'decimal(' || greatest(s_suppkey % 60 + 1, 2) || ',2)' END WHEN 2 THEN 'string' WHEN 3 THEN 'boolean' WHEN 4 THEN 'date' WHEN 6 THEN 'int' WHEN 7 THEN 'interval day to second' END AS spark_type,
    CASE WHEN s_suppkey % 9 = 0 THEN 'automatic' WHEN s_suppkey % 8 = 5 THEN 'unsupported' ELSE 'available' END AS inclusion FROM supplier"""
)
def type_mapping(spark, sf_dir):
    """Base types by expression; Spark types and inclusion of the different server types, which are few, on the driver."""
    columns = supplier_columns(spark, sf_dir)
    known = [(r.column_type, r.column_key, kind.simpleString() if (kind := types.spark_type(r.column_type)) else None, types.inclusion(r.column_type, r.column_key)) for r in columns.select("column_type", "column_key").distinct().collect()]
    known = spark.createDataFrame(known, "column_type string, column_key string, spark_type string, inclusion string")
    return base_types(columns).join(known, ["column_type", "column_key"]).select("column_name", "base_type", "spark_type", "inclusion")


DDL_LOG = [
    ("bin.9", 100, 0, 1_700_000_000, "shop", "/* more */ ALTER TABLE orders ADD COLUMN `email` VARCHAR(100) CHARACTER SET utf8 FIRST, DROP COLUMN note, ALGORITHM=INPLACE"),
    ("bin.10", 50, 0, 1_700_000_060, "", "ALTER TABLE shop.orders ADD (rate DECIMAL(19, 4) COMMENT 'a, (b)', KEY k (rate)), ADD INDEX i (rate)"),
    ("bin.10", 60, 0, 1_700_000_120, "shop", "ALTER TABLE `people` ADD nick CHAR(3) AFTER id; "),
]


def ddl_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DDL_LOG, "log_file string, log_pos long, row_idx int, ts_s long, schema_name string, ddl string")


def part_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement for each part on the table of its brand, of three kinds."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string")
    name, size = F.regexp_replace("p_brand", "#", "_"), F.col("p_size").cast("string")
    first = F.concat(F.lit("/* more */ ALTER TABLE "), name, F.lit(" ADD COLUMN `c"), key, F.lit("` VARCHAR("), size, F.lit(") CHARACTER SET utf8 FIRST, DROP COLUMN note, ALGORITHM=INPLACE"))
    second = F.concat(F.lit("ALTER TABLE shop."), name, F.lit(" ADD (c"), key, F.lit(" DECIMAL("), size, F.lit(", 4) COMMENT 'a, (b)', KEY k (rate)), ADD INDEX i (rate)"))
    third = F.concat(F.lit("USE other; alter table `"), name, F.lit("` ADD c"), key, F.lit(" char(3) AFTER id; "))
    said = F.when(F.col("p_partkey") % 3 == 0, first).when(F.col("p_partkey") % 3 == 1, second).otherwise(third)
    return p.select("p_partkey", F.lit("bin.1").alias("log_file"), F.col("p_partkey").alias("log_pos"), F.lit(0).alias("row_idx"), (1_700_000_000 + F.col("p_partkey")).cast("long").alias("ts_s"), F.when(F.col("p_partkey") % 3 == 0, "shop").otherwise("").alias("schema_name"), said.alias("ddl"))


PART_CHANGES = """SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN 'other' ELSE 'shop' END AS schema_name, replace(p_brand, '#', '_') AS table_name, 'ADD' AS type, 'c' || p_partkey AS column_name,
    CASE p_partkey % 3 WHEN 0 THEN 'VARCHAR(' || p_size || ')' WHEN 1 THEN 'DECIMAL(' || p_size || ', 4)' ELSE 'CHAR(3)' END AS data_type FROM part
    UNION ALL SELECT p_partkey, 'shop', replace(p_brand, '#', '_'), 'DROP', 'note', NULL FROM part WHERE p_partkey % 3 = 0"""


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND type = 'ADD' THEN 1 ELSE 0 END AS change_no, schema_name, table_name, type, column_name, data_type FROM ({PART_CHANGES})")
def ddl_changes(spark, sf_dir):
    found = column_changes(part_statements(spark, sf_dir))
    return found.select("p_partkey", "change_no", *[f"change.{c}" for c in ("schema_name", "table_name", "type", "column_name", "data_type")])


@query(PART_CHANGES)
def ddl_table_function(spark, sf_dir):
    """The same in SQL, by the table function."""
    register(spark)
    return spark.sql("SELECT p_partkey, c.schema_name, c.table_name, c.type, c.column_name, c.data_type FROM {said} s, LATERAL column_changes(s.ddl, s.schema_name) c", said=spread(part_statements(spark, sf_dir)))


@query(f"""SELECT schema_name AS "schema", table_name AS "table", type || '_COLUMN' AS change_type, column_name, CAST(1700000000 + p_partkey AS BIGINT) AS at_s FROM ({PART_CHANGES})""")
def schema_changes(spark, sf_dir):
    """Statements that are read twice are in the audit table once."""
    said = part_statements(spark, sf_dir)
    found = evolution.schema_changes(column_changes(said.union(said)))
    return found.select("schema", "table", "change_type", "column_name", F.unix_seconds("timestamp").alias("at_s"))


def orders_layout(spark: SparkSession) -> DataFrame:
    tables = spark.createDataFrame([("shop", "orders", "BASE TABLE")], "schema_name string, table_name string, table_type string")
    return evolution.first_layouts(server.catalogue(column_catalogue(spark), tables))


def orders_history(spark: SparkSession) -> DataFrame:
    """What orders looked like along DDL_LOG, written first, as a run does: statements are folded once."""
    folder = new_folder(spark)
    evolution.history(orders_layout(spark), column_changes(ddl_log(spark).coalesce(1))).coalesce(1).write.parquet(folder)
    return spark.read.schema(evolution.HISTORY).parquet(folder)


@query(
    """SELECT event_id, CASE WHEN event_id < 200 THEN 0 WHEN event_id < 500 THEN 1 ELSE 2 END AS version,
    CASE WHEN event_id < 200 THEN 'id,note,price,paid' WHEN event_id < 500 THEN 'EMAIL,id,price,paid' ELSE 'EMAIL,id,price,paid,RATE' END AS columns FROM events"""
)
def layout_asof(spark, sf_dir):
    layouts = orders_history(spark)
    # events up to 199 stand before the first statement, up to 499 before the second
    place = F.when(F.col("event_id") < 200, F.struct(F.lit("bin.9").alias("f"), F.lit(100).alias("p"))).when(F.col("event_id") < 500, F.struct(F.lit("bin.10").alias("f"), F.lit(50).alias("p"))).otherwise(F.struct(F.lit("bin.11").alias("f"), F.lit(4).alias("p")))
    log = table(spark, sf_dir, "events").select("event_id", place.alias("at")).select("event_id", F.lit("shop").alias("schema_name"), F.lit("orders").alias("table_name"), F.col("at.f").alias("log_file"), F.col("at.p").cast("long").alias("log_pos"))
    return evolution.with_columns(evolution.as_of(log, layouts), layouts).select("event_id", "version", F.array_join("columns", ",").alias("columns"))


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def catalog_join(spark, sf_dir):
    """Columns with their database's defaults, in the shape of nations with their regions."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    columns = n.select(F.col("n_regionkey").alias("schema_name"), "n_nationkey", "n_name")
    schemata = r.select(F.col("r_regionkey").alias("schema_name"), F.col("r_name").alias("default_charset"), F.lit(None).alias("default_collation"))
    return server.with_default_charset(columns, schemata).select("n_nationkey", "n_name", F.col("default_charset").alias("r_name"))


@query(
    """SELECT o_custkey, f + CAST(30 * i AS INTEGER) AS chunk_start, least(f + CAST(30 * i + 29 AS INTEGER), l) AS chunk_end
    FROM (SELECT o_custkey, f, l, unnest(range((l - f) // 30 + 1)) AS i FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS f, CAST(max(o_orderdate) AS DATE) AS l FROM orders GROUP BY 1))"""
)
def date_chunks(spark, sf_dir):
    """The time in which a customer has ordered, in pieces of 30 days."""
    days = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("f"), F.to_date(F.max("o_orderdate")).alias("l"))
    return days.select("o_custkey", F.explode(values.date_chunks(F.col("f"), F.col("l"), 30)).alias("c")).select("o_custkey", F.col("c.start").alias("chunk_start"), F.col("c.end").alias("chunk_end"))


@query(
    """SELECT o_custkey, f + CAST((l - f) * i // n AS INTEGER) AS chunk_start, f + CAST((l - f) * (i + 1) // n AS INTEGER) AS chunk_end
    FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT *, greatest(CAST(ceil((l - f) / 45) AS BIGINT), 1) AS n FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS f, CAST(max(o_orderdate) AS DATE) AS l FROM orders GROUP BY 1)))"""
)
def even_date_chunks(spark, sf_dir):
    """The same time in equal pieces of 45 days at most."""
    days = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("f"), F.to_date(F.max("o_orderdate")).alias("l"))
    return days.select("o_custkey", F.explode(values.even_date_chunks(F.col("f"), F.col("l"), 45)).alias("c")).select("o_custkey", F.col("c.start").alias("chunk_start"), F.col("c.end").alias("chunk_end"))


@query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 1 DAY WHEN 2 THEN ts - to_days(CAST(event_id % 40 AS INTEGER)) WHEN 3 THEN ts - to_hours(event_id % 40) WHEN 4 THEN ts - to_months(CAST(event_id % 40 AS INTEGER)) END AS at FROM events"""
)
def relative_dates(spark, sf_dir):
    n = F.concat((F.col("event_id") % 40).cast("string"), F.lit(" "))
    texts = [F.lit("Today"), F.lit("yesterday"), F.concat(n, F.lit("days ago")), F.concat(n, F.lit("hour ago")), F.concat(n, F.lit("months ago")), F.lit("some day")]
    text = F.element_at(F.array(*texts), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", values.moment(text, F.col("ts").cast("timestamp_ntz")).alias("at"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2024-01-01' ELSE l END AS start, CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2024-01-03' WHEN CAST(l + to_days(greatest(d, 1)) AS DATE) >= DATE '1998-02-02' THEN TIMESTAMP '1998-02-01 12:00:00' ELSE l + to_days(greatest(d, 1)) END AS stop
    FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS l, CAST(o_orderkey % 4 AS INTEGER) AS d FROM orders)"""
)
def backfill_periods(spark, sf_dir):
    """The next period of loads that go back in steps: of orders without a last one, and of those whose last one ended on their date."""
    day = F.to_date("o_orderdate")
    last = F.when(F.col("o_orderkey") % 5 != 0, F.struct(F.date_sub(day, (F.col("o_orderkey") % 4).cast("int")).alias("start"), day.alias("end")))
    period = values.backfill_period(F.lit("2024-01-01"), F.lit("2024-01-03"), last, F.lit("1998-02-01 12:00:00").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").select("o_orderkey", period.alias("p")).select("o_orderkey", F.col("p.start").alias("start"), F.col("p.end").alias("stop"))


@query("SELECT 's' AS schema_name, 't' || c_nationkey AS table_name, c_name AS column_name FROM customer WHERE c_nationkey % 2 = 0")
def primary_keys(spark, sf_dir):
    """Customers as columns of their nation's table, half of which are in primary keys."""
    named = lambda k: [F.concat(F.lit("k"), k).alias("constraint_name"), F.lit("s").alias("schema_name"), F.concat(F.lit("t"), k).alias("table_name")]
    kind = F.when(F.col("n_nationkey") % 2 == 0, "PRIMARY KEY").otherwise("UNIQUE").alias("constraint_type")
    constraints = table(spark, sf_dir, "nation").select(*named(F.col("n_nationkey")), kind)
    usage = table(spark, sf_dir, "customer").select(*named(F.col("c_nationkey")), F.col("c_name").alias("column_name"))
    return server.primary_keys(constraints, usage)


@query("SELECT 'bin.' || strftime(ts, '%Y%m%d') AS log_name, count(*) AS file_size FROM events GROUP BY ALL")
def log_files(spark, sf_dir):
    """A server's list of logs: a file for each day, its size as text."""
    days = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("bin."), F.date_format("ts", "yyyyMMdd")).alias("log_name")).agg(F.count(F.lit(1)).cast("string").alias("file_size"))
    return offsets.log_files(days.agg(F.collect_list(F.struct("log_name", "file_size")).alias("logs")))


@query("SELECT 'bin.' || strftime(ts, '%Y%m%d') AS log_file, event_id AS log_pos, CAST(100 AS BIGINT) AS file_size FROM events WHERE event_id > 100")
def beyond_end(spark, sf_dir):
    files = kept_files(spark, sf_dir).unionByName(table(spark, sf_dir, "events").select(F.concat(F.lit("bin."), F.date_format("ts", "yyyyMMdd")).alias("log_name"), F.lit(1).cast("long").alias("file_size"))).select("log_name").distinct()
    return offsets.beyond_end(bookmarks(spark, sf_dir), files.withColumn("file_size", F.lit(100).cast("long"))).drop("stream")


@query("SELECT event_id FROM events WHERE strftime(ts, '%Y%m%d') > '20240110' OR (strftime(ts, '%Y%m%d') = '20240110' AND event_id >= 400)")
def pending_log(spark, sf_dir):
    return offsets.pending(event_log(spark, sf_dir), "bin.20240110", 400).select(F.coalesce("after.event_id", "before.event_id").alias("event_id"))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n > 1 AND event_id % 97 = 0")
def incomplete_images(spark, sf_dir):
    log = event_log(spark, sf_dir).withColumn("after", F.when(F.col("log_pos") % 97 != 0, F.col("after")))
    return changelog.incomplete_images(log).select(F.col("log_pos").alias("event_id"))


@query("SELECT event_id FROM events WHERE epoch(ts) >= 1705000000")
def since_time(spark, sf_dir):
    return changelog.since(event_log(spark, sf_dir), 1_705_000_000).select(F.col("log_pos").alias("event_id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS at FROM orders")
def zero_dates(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, "0000-00-00 00:00:00").otherwise(values.utc_text(F.col("o_orderdate")))
    return table(spark, sf_dir, "orders").select("o_orderkey", values.zero_date_to_null(text, "timestamp_ntz").alias("at"))


@query("SELECT c_custkey, upper(c_name) AS name FROM customer")
def identifiers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", values.identifier(F.concat(F.lit("`"), "c_name", F.lit("`"))).alias("name"))


@query(
    """SELECT event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS flag, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, strftime(ts, '%Y-%m-%d') AS day, to_base64(encode(event_type)) AS kind,
    '{"user_id":' || user_id || ',"kinds":["' || event_type || '"]}' AS nested FROM events"""
)
def exported_values(spark, sf_dir):
    """Booleans, times, dates, bytes, and a struct with bytes in it, as they are exported."""
    kind = F.encode("event_type", "UTF-8")
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("value") > 50).alias("flag"), "ts", F.to_date("ts").alias("day"), kind.alias("kind"), F.struct("user_id", F.array(kind).alias("kinds")).alias("nested"))
    return sinks.exported(rows, "base64")


@query("SELECT doc_id, text FROM documents")
def csv_round_trip(spark, sf_dir):
    """Texts with quotes, commas and line feeds through CSV."""
    folder, rows = new_folder(spark), table(spark, sf_dir, "documents").select("doc_id", "text")
    sinks.write_csv(rows, folder, null="\\N")
    return sinks.read_csv(spark, folder, rows.schema, null="\\N")


@query(
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN true WHEN p_size % 3 = 1 THEN false ELSE coalesce(CASE p_partkey % 3 WHEN 0 THEN false WHEN 1 THEN true END, p_partkey % 2 = 0) END AS synced FROM part"""
)
def field_selection(spark, sf_dir):
    """Parts as columns: in or out by what they are, by what was selected, or by the default."""
    inclusion = F.element_at(F.array(*[F.lit(x) for x in ("automatic", "unsupported", "available")]), (F.col("p_size") % 3 + 1).cast("int"))
    selected = F.when(F.col("p_partkey") % 3 == 0, False).when(F.col("p_partkey") % 3 == 1, True)
    return table(spark, sf_dir, "part").select("p_partkey", is_synced(inclusion, selected, F.col("p_partkey") % 2 == 0).alias("synced"))


@query(
    """SELECT table_name, step, CAST(row_number() OVER (PARTITION BY step ORDER BY rank, s_suppkey) - 1 AS INTEGER) AS place FROM (
      SELECT s_suppkey, s_name AS table_name, CASE WHEN s_suppkey = 5 THEN 0 WHEN s_suppkey % 4 = 0 THEN 1 ELSE 2 END AS rank,
             CASE WHEN s_suppkey % 5 = 1 THEN 'incremental' WHEN s_suppkey % 5 = 2 OR s_suppkey % 4 IN (0, 1) THEN 'snapshot' ELSE 'log' END AS step FROM supplier)"""
)
def routing(spark, sf_dir):
    """Suppliers as tables: read in full or by key; without a bookmark, with a snapshot under way, or up to date; one was interrupted."""
    names = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey").collect()
    streams = [Stream("s", r.s_name, {"id": "automatic"}, ["id"], selected=True, method={1: "INCREMENTAL", 2: "FULL_TABLE"}.get(r.s_suppkey % 5, "LOG_BASED"), replication_key="id") for r in names]
    marks = {1: {"last_pk_fetched": {"id": 3}, "log_file": "bin.1", "log_pos": 4}, 2: {"log_file": "bin.1", "log_pos": 4}, 3: {"log_file": "bin.1", "log_pos": 9}}
    state = State({"bookmarks": {f"s-{r.s_name}": marks[r.s_suppkey % 4] for r in names if r.s_suppkey % 4}, "currently_syncing": next((f"s-{r.s_name}" for r in names if r.s_suppkey == 5), None)})
    plan = route(streams, state)
    rows = [(s.table, step, i) for step, found in (("snapshot", plan.snapshots), ("incremental", plan.incremental), ("log", plan.from_log)) for i, s in enumerate(found)]
    return spark.createDataFrame(rows, "table_name string, step string, place int")


@query(
    """SELECT * FROM (SELECT unnest(['EVENT_ID', 'TS', 'USER_ID', 'EVENT_TYPE', 'VALUE', 'PROPS', 'PRICE']) AS name, unnest(['INTEGER', 'TIMESTAMP', 'INTEGER', 'STRING', 'FLOAT', 'STRING', 'NUMERIC']) AS base_type,
    unnest(['bigint', 'timestamp_ntz', 'bigint', 'string', 'double', 'string', 'decimal(10,2)']) AS type,
    unnest([count(event_id), count(ts), count(user_id), count(event_type), count(value), count(props), count(value) FILTER (event_id % 3 = 0)]) AS filled FROM events)"""
)
def manifest_columns(spark, sf_dir):
    """The columns of a manifest, and how many rows have a value in them."""
    price = types.ServerColumn("price", "decimal(10,2)", 9).field()
    rows = table(spark, sf_dir, "events").withColumn("price", F.when(F.col("event_id") % 3 == 0, F.col("value").cast(price.dataType)).alias("price", metadata=price.metadata))
    told = spark.createDataFrame([(c["name"], c["base_type"], c["type"]) for c in sinks.manifest("t", ["event_id"], rows.schema, True)["column_metadata"]], "name string, base_type string, type string")
    counts = rows.agg(*[F.count(c).alias(c.upper()) for c in rows.columns])
    return told.join(counts.select(F.explode(F.create_map(*[x for c in counts.columns for x in (F.lit(c), F.col(c))])).alias("name", "filled")), "name")


@query("SELECT event_id, 'u' || user_id AS table_name, CASE WHEN event_id % 2 = 0 THEN 'ADD' ELSE 'DROP' END AS type, 'c' || event_id AS column_name FROM events")
def ddl_of_many_tables(spark, sf_dir):
    """A statement for each event, on its user's table."""
    column = F.concat(F.lit("`c"), "event_id", F.lit("`"))
    action = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" ADD COLUMN "), column, F.lit(" INT"))).otherwise(F.concat(F.lit(" DROP COLUMN "), column))
    said = table(spark, sf_dir, "events").select("event_id", F.lit("s").alias("schema_name"), F.concat(F.lit("ALTER TABLE u"), "user_id", action).alias("ddl"))
    return column_changes(said).select("event_id", "change.table_name", "change.type", "change.column_name")


@query(
    """SELECT 'u' || user_id AS table_name, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS version, event_id AS log_pos,
    'ID,' || string_agg('C' || event_id, ',') OVER (PARTITION BY user_id ORDER BY event_id) AS columns FROM events"""
)
def layouts_of_many_tables(spark, sf_dir):
    """Each event adds a column to its user's table: the layouts, folded for each table in the order of its log."""
    events = table(spark, sf_dir, "events")
    said = events.select(F.lit("bin.1").alias("log_file"), F.col("event_id").alias("log_pos"), F.lit(0).alias("row_idx"), F.lit("s").alias("schema_name"), F.concat(F.lit("ALTER TABLE u"), "user_id", F.lit(" ADD c"), "event_id", F.lit(" INT")).alias("ddl"))
    null = F.lit(None).cast("string")
    identity = F.struct(F.lit("ID").alias("name"), F.lit("int").alias("column_type"), F.lit("PRI").alias("key"), null.alias("charset"), null.alias("collation"))
    start = events.select(F.lit("s").alias("schema_name"), F.concat(F.lit("u"), "user_id").alias("table_name"), F.array(identity).alias("layout")).distinct()
    folder = new_folder(spark)
    evolution.history(start, column_changes(said)).write.parquet(folder)
    held = spark.read.schema(evolution.HISTORY).parquet(folder)
    begins = evolution.versions(held).where("version > 0")
    return evolution.layouts(held, begins).select("table_name", "version", "log_pos", F.array_join("columns", ",").alias("columns"))


@query("SELECT event_id, CASE WHEN event_id < 200 THEN 0 WHEN event_id < 500 THEN 1 ELSE 2 END AS version FROM events WHERE event_id < 500 OR event_id % 2 = 0")
def layout_mismatch(spark, sf_dir):
    """Rows with a rate that came by DDL at event 500, and with a note that was dropped at event 200."""
    row = F.struct(F.col("event_id").alias("id"), F.when(F.col("event_id") < 500, 1.5).alias("rate"), F.when(F.col("event_id") % 2 == 0, "x").alias("note"))
    place = F.when(F.col("event_id") < 200, F.struct(F.lit("bin.9").alias("f"), F.lit(100).alias("p"))).when(F.col("event_id") < 500, F.struct(F.lit("bin.10").alias("f"), F.lit(50).alias("p"))).otherwise(F.struct(F.lit("bin.11").alias("f"), F.lit(4).alias("p")))
    log = table(spark, sf_dir, "events").select("event_id", F.lit("shop").alias("schema_name"), F.lit("orders").alias("table_name"), place["f"].alias("log_file"), place["p"].cast("long").alias("log_pos"), F.lit(None).cast("struct<id: bigint, rate: double, note: string>").alias("before"), row.alias("after"))
    return evolution.mismatches(log, orders_history(spark)).select("event_id", "version")


def _run_tables(spark: SparkSession, sf_dir: str) -> tuple[Stream, DataFrame, DataFrame]:
    """customer as a server's table, and a log in which each tenth one is changed and then gets a column by DDL."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    stream = Stream("shop", "customer", {"c_custkey": "automatic", "c_name": "available"}, ["c_custkey"], selected=True)
    image = lambda name, vip: F.struct("c_custkey", name.alias("c_name"), vip.cast("int").alias("vip"))
    placed = lambda pos: [F.lit("bin.2").alias("log_file"), pos.cast("long").alias("log_pos"), F.lit(0).alias("row_idx"), F.lit(1_700_000_000).cast("long").alias("ts_s"), F.lit("shop").alias("schema_name"), F.lit("customer").alias("table_name")]
    null, name = F.lit(None), F.col("c_name")
    every = c.where("c_custkey % 10 = 0")
    first = every.select(*placed(F.col("c_custkey") + 100), F.lit("update").alias("op"), image(name, null).alias("before"), image(F.lit("changed"), null).alias("after"), null.cast("string").alias("ddl"))
    kind = first.schema["after"].dataType
    said = spark.range(1).select(*placed(F.lit(10**9)), F.lit("ddl").alias("op"), null.cast(kind).alias("before"), null.cast(kind).alias("after"), F.lit("ALTER TABLE customer ADD COLUMN vip INT").alias("ddl"))
    second = every.where("c_custkey % 20 = 0").select(*placed(F.col("c_custkey") + 2 * 10**9), F.lit("update").alias("op"), image(F.lit("changed"), null).alias("before"), image(F.lit("changed"), F.lit(1)).alias("after"), null.cast("string").alias("ddl"))
    return stream, c, first.union(said).union(second)


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'changed' ELSE c_name END AS c_name, CASE WHEN c_custkey % 20 = 0 THEN 1 END AS vip FROM customer")
def whole_run(spark, sf_dir):
    """A run that takes a snapshot, and a second one from the log, with a column that DDL has added in between."""
    stream, source, log = _run_tables(spark, sf_dir)
    catalogue = spark.createDataFrame([("shop", "customer", [(1, "c_custkey", "bigint", "PRI"), (2, "c_name", "varchar(25)", "")])], "schema_name string, table_name string, columns array<struct<ordinal: int, column_name: string, column_type: string, column_key: string>>")
    out, state, files = new_folder(spark), State(), spark.createDataFrame([("bin.2", 10**12)], "log_name string, file_size long")
    for end in (4, 10**10):
        found = run(spark, route([stream], state), state, out, lambda s: source, log, {"log_file": "bin.2", "log_pos": end}, SYNCED, files=files, catalogue=catalogue)
    return found["shop-customer"].select("c_custkey", "c_name", "vip")


@query("SELECT c_custkey, c_name FROM customer")
def interrupted_snapshot(spark, sf_dir):
    """A snapshot in ranges of the key that fails on the way, and the run after it, which goes on behind the last range."""
    stream, source, _ = _run_tables(spark, sf_dir)
    out, state = new_folder(spark), State()
    go = lambda table: run(spark, route([stream], state), state, out, lambda s: table, source.where("false"), {"log_file": "bin.2", "log_pos": 4}, SYNCED, snapshot_parts=4)
    most = source.agg(F.max("c_custkey")).first()[0]
    fails = F.when(F.col("c_custkey") > most * 2 // 3, F.raise_error(F.lit("lost"))).otherwise(F.col("c_name"))
    try:
        go(source.select("c_custkey", fails.cast("string").alias("c_name")))
    except Exception as e:
        if "lost" not in str(e):
            raise
    if not state.get(stream, "last_pk_fetched"):
        raise ValueError("no range was marked before the failure")
    return go(source.where(F.col("c_custkey") > state.get(stream, "last_pk_fetched")["c_custkey"]))["shop-customer"].select("c_custkey", "c_name")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0")
def snapshot_twice(spark, sf_dir):
    """A table that is read in full, in ranges, twice: in between rows have changed and gone."""
    stream = Stream("shop", "orders", {"o_orderkey": "automatic", "o_orderstatus": "available"}, ["o_orderkey"], selected=True, method="FULL_TABLE")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    later = o.where("o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    out, state = new_folder(spark), State()
    for rows in (o, later):
        found = run(spark, route([stream], state), state, out, lambda s, rows=rows: rows, o.where("false"), {}, SYNCED, snapshot_parts=4)
    return found["shop-orders"].select("o_orderkey", "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def interrupted_composite_snapshot(spark, sf_dir):
    """A snapshot in ranges of a key of two columns that fails on the way, and the run after it, which reads only what is left."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    rows = table(spark, sf_dir, "lineitem").select(*columns)
    stream = Stream("shop", "lineitem", {c: "automatic" for c in columns}, columns[:2], selected=True, method="FULL_TABLE")
    out, state = new_folder(spark), State()
    go = lambda source: run(spark, route([stream], state), state, out, lambda s: source, rows.where("false"), {}, SYNCED, snapshot_parts=5)
    fails = F.when(F.col("l_orderkey") > rows.agg(F.max("l_orderkey")).first()[0] * 2 // 3, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("l_quantity"))
    try:
        go(rows.withColumn("l_quantity", fails))
    except Exception as e:
        if "lost" not in str(e):
            raise
    last = state.get(stream, "last_pk_fetched")
    if not last:
        raise ValueError("no range was marked before the failure")
    return go(rows.where(snapshot.after_key(rows, last)))["shop-lineitem"].select(*columns)


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as inserts in three log files, with the files' numbers stored."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    no, image = F.col("o_orderkey") % 3 + 1, F.struct("o_orderkey", "o_custkey", "o_orderstatus")
    return o.select(
        F.concat(F.lit("bin."), no.cast("string")).alias("log_file"), no.alias("file_no"), F.col("o_orderkey").alias("log_pos"), F.lit(0).alias("row_idx"), F.lit(1_700_000_000).cast("long").alias("ts_s"),
        F.lit("shop").alias("schema_name"), F.lit("orders").alias("table_name"), F.lit("insert").alias("op"), F.lit(None).cast("struct<o_orderkey: bigint, o_custkey: bigint, o_orderstatus: string>").alias("before"), image.alias("after"),
    )


@query(
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey < 400 THEN 'first' ELSE 'second' END AS read_by
    FROM orders WHERE o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND o_orderkey < 900)"""
)
def bounded_runs(spark, sf_dir):
    """A log that grows while it is read: each run stops before its end, the next one goes on there; all events are kept, once."""
    stream = Stream("shop", "orders", {c: "automatic" for c in ("o_orderkey", "o_custkey", "o_orderstatus")}, ["o_orderkey"], selected=True)
    log = order_log(spark, sf_dir)
    out, state = new_folder(spark), State({"bookmarks": {"shop-orders": {"log_file": "bin.1", "log_pos": 0}}})
    for end, synced in (((2, 400), "first"), ((2, 900), "second")):
        found = run(spark, route([stream], state), state, out, lambda s: None, log, {"log_file": f"bin.{end[0]}", "log_pos": end[1]}, synced, append=True)
    return found["shop-orders"].select("o_orderkey", "o_orderstatus", F.col("_synced_at").alias("read_by"))


def events_by_type(spark: SparkSession, sf_dir: str) -> tuple[list[Stream], DataFrame, State]:
    """events as updates of the tables of their types, all but one of which are followed; one only from event 300 on."""
    columns = ["event_id", "user_id", "value"]
    e = table(spark, sf_dir, "events")
    image = F.struct(*columns)
    log = e.select(
        F.lit("bin.1").alias("log_file"), F.col("event_id").alias("log_pos"), F.lit(0).alias("row_idx"), values.epoch_seconds(F.col("ts")).alias("ts_s"), F.lit("shop").alias("schema_name"), F.col("event_type").alias("table_name"),
        F.when(F.col("event_id") % 11 == 0, "delete").otherwise("update").alias("op"), F.when(F.col("event_id") % 4 == 0, image).otherwise(F.struct("event_id", "user_id", (F.col("value") + 1).alias("value"))).alias("before"), image.alias("after"),
    )
    names = ("click", "purchase", "signup", "view")
    streams = [Stream("shop", t, {c: "automatic" for c in columns}, ["user_id"], selected=True, watch=["value"] if t == "view" else []) for t in names]
    state = State({"bookmarks": {f"shop-{t}": {"log_file": "bin.1", "log_pos": 300 if t == "signup" else 0} for t in names}})
    return streams, log, state


@query(
    """SELECT event_type, user_id, event_id, gone FROM (SELECT *, event_id % 11 = 0 AS gone, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS n FROM events
    WHERE event_type <> 'error' AND event_id < 900 AND (event_type <> 'signup' OR event_id >= 300) AND (event_type <> 'view' OR event_id % 4 <> 0 OR event_id % 11 = 0)) WHERE n = 1"""
)
def one_read_for_all(spark, sf_dir):
    """The latest rows of four tables by one read of the log they share, each from its own position, up to an end."""
    streams, log, state = events_by_type(spark, sf_dir)
    found = run(spark, route(streams, state), state, new_folder(spark), lambda s: None, log, {"log_file": "bin.1", "log_pos": 900}, SYNCED)
    parts = [found[f"shop-{s.table}"].select(F.lit(s.table).alias("event_type"), "user_id", "event_id", F.col("_deleted_at").isNotNull().alias("gone")) for s in streams]
    return reduce(DataFrame.union, parts)


@query(
    """WITH e AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'delete' ELSE 'update' END AS op, event_type <> 'error' AND (event_type <> 'signup' OR event_id >= 300) AS mine,
      event_type = 'view' AND event_id % 4 = 0 AND event_id % 11 <> 0 AS same FROM events WHERE event_id < 900)
    SELECT 'saved' AS counter, NULL AS op, count(*) FILTER (mine) AS n FROM e UNION ALL SELECT 'skipped', NULL, count(*) FILTER (event_type = 'error') FROM e
    UNION ALL SELECT 'unchanged', NULL, count(*) FILTER (mine AND same) FROM e UNION ALL SELECT 'shop-' || event_type, op, count(*) FROM e WHERE mine AND NOT same GROUP BY ALL"""
)
def run_counters(spark, sf_dir):
    """What a run counts on the way of its one read."""
    streams, log, state = events_by_type(spark, sf_dir)
    out = new_folder(spark)
    run(spark, route(streams, state), state, out, lambda s: None, log, {"log_file": "bin.1", "log_pos": 900}, SYNCED, count_skipped=True)
    told = json.loads(sinks.read_text(spark, f"{out}/counters.json"))
    rows = [(c, None, told[c]) for c in ("saved", "skipped", "unchanged")] + [(name, op, n) for name, kinds in told["rows"].items() for op, n in kinds.items()]
    return spark.createDataFrame(rows, "counter string, op string, n long")


@query("SELECT c_custkey, CASE WHEN c_custkey = 7 THEN 'once more' WHEN c_custkey % 10 = 0 THEN 'changed' ELSE c_name END AS c_name FROM customer")
def upsert_in_parts(spark, sf_dir):
    """A table in eight parts, changed twice; the second change has one key and writes one part."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    target = VersionedTable(spark, new_folder(spark), ["c_custkey"], 8)
    target.write(c, 0)
    target.upsert(c.where("c_custkey % 10 = 0").withColumn("c_name", F.lit("changed")), 1)
    before = target.content()["parts"]
    target.upsert(c.where("c_custkey = 7").withColumn("c_name", F.lit("once more")), 2)
    if len(moved := [p for p, f in target.content()["parts"].items() if before[p] != f]) != 1:
        raise ValueError(f"a change of one key has rewritten the parts {moved}")
    return target.read()


def user_layouts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """events as a log of their users' tables, and what those looked like: each third event adds a column by DDL."""
    null = F.lit(None).cast("string")
    e = table(spark, sf_dir, "events")
    log = e.select("event_id", F.concat(F.lit("bin."), (F.col("event_id") % 7 + 1).cast("string")).alias("log_file"), F.col("event_id").alias("log_pos"), F.lit(0).alias("row_idx"), F.lit("s").alias("schema_name"), F.concat(F.lit("u"), "user_id").alias("table_name"))
    said = log.where("event_id % 3 = 0").withColumn("ddl", F.concat(F.lit("ALTER TABLE "), "table_name", F.lit(" ADD c"), "event_id", F.lit(" INT")))
    identity = F.struct(F.lit("ID").alias("name"), F.lit("int").alias("column_type"), F.lit("PRI").alias("key"), null.alias("charset"), null.alias("collation"))
    folder = new_folder(spark)
    evolution.history(log.select("schema_name", "table_name", F.array(identity).alias("layout")).distinct(), column_changes(said)).write.parquet(folder)
    return log, spark.read.schema(evolution.HISTORY).parquet(folder)


LAYOUTS_BY_USER = """SELECT event_id, coalesce(CAST(count(*) FILTER (event_id % 3 = 0) OVER (PARTITION BY user_id ORDER BY event_id % 7, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER), 0) AS version FROM events"""


@query(LAYOUTS_BY_USER)
def layout_asof_window(spark, sf_dir):
    """The layout of each event by windows over the files of its table, without a join by range."""
    log, held = user_layouts(spark, sf_dir)
    return evolution.as_of(log, held, window=True).select("event_id", "version")


@query(LAYOUTS_BY_USER)
def layout_asof_range(spark, sf_dir):
    """The same by the join with intervals, for short histories."""
    log, held = user_layouts(spark, sf_dir)
    return evolution.as_of(log, held, window=False).select("event_id", "version")


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'int(' || p_size || ')' ELSE 'tinyint(1)' END AS column_type, CASE WHEN p_partkey % 2 = 0 THEN 'MUL' ELSE '' END AS key, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END AS place FROM part"""
)
def server_definition(spark, sf_dir):
    """A column that a statement adds is what the server says it is by now; where the server doesn't have it, what the statement says."""
    p, null = table(spark, sf_dir, "part"), F.lit(None).cast("string")
    named = [F.lit("s").alias("schema_name"), F.concat(F.lit("t"), "p_partkey").alias("table_name")]
    column = lambda name, kind, key: F.struct(F.lit(name).alias("name"), kind.alias("column_type"), key.alias("key"), null.alias("charset"), null.alias("collation"))
    identity = column("id", F.lit("int"), F.lit("PRI"))
    start = p.select(*named, F.array(identity).alias("layout"))
    now = p.where("p_partkey % 2 = 0").select(*named, F.array(identity, column("flag", F.concat(F.lit("int("), "p_size", F.lit(")")), F.lit("MUL"))).alias("layout"))
    ddl = F.concat(F.lit("ALTER TABLE t"), "p_partkey", F.lit(" ADD flag TINYINT(1)"), F.when(F.col("p_partkey") % 3 == 0, " FIRST").otherwise(""))
    said = p.select(F.lit("bin.1").alias("log_file"), F.col("p_partkey").alias("log_pos"), F.lit(0).alias("row_idx"), F.lit("s").alias("schema_name"), ddl.alias("ddl"))
    folder = new_folder(spark)
    evolution.history(start, column_changes(said), now).write.parquet(folder)
    held = spark.read.schema(evolution.HISTORY).parquet(folder)
    found = evolution.layouts(held, evolution.versions(held).where("version = 1")).select(F.substring("table_name", 2, 20).cast("long").alias("p_partkey"), F.posexplode("layout").alias("at", "c")).where("c.name = 'FLAG'")
    return found.select("p_partkey", "c.column_type", "c.key", (F.col("at") + 1).alias("place"))


def staged_events(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """events staged as a log with a file for each day: its folder and its schema."""
    folder = f"{new_folder(spark)}/log"
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("bin."), F.date_format("ts", "yyyyMMdd")).alias("log_file"), F.col("event_id").alias("log_pos"), F.lit(0).alias("row_idx"), "user_id", "event_type")
    rows.repartition("log_file").sortWithinPartitions("log_pos").write.partitionBy("log_file").parquet(folder)
    return folder, "log_file string, log_pos long, row_idx int, user_id long, event_type string"


@query(
    """SELECT event_id, user_id, event_type FROM events WHERE (CAST(ts AS DATE) > DATE '2024-01-05' OR (CAST(ts AS DATE) = DATE '2024-01-05' AND event_id >= 300))
    AND (CAST(ts AS DATE) < DATE '2024-01-12' OR (CAST(ts AS DATE) = DATE '2024-01-12' AND event_id < 700))"""
)
def log_between_positions(spark, sf_dir):
    """A staged log read by its data source, from the middle of a file to the middle of another."""
    folder, schema = staged_events(spark, sf_dir)
    log_source.register(spark)
    found = spark.read.format(log_source.FORMAT).schema(schema).options(**log_source.options(folder, ("bin.20240105", 300), ("bin.20240112", 700))).load()
    return found.select(F.col("log_pos").alias("event_id"), "user_id", "event_type")


@query("SELECT user_id, event_id, event_type FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20' OR (CAST(ts AS DATE) = DATE '2024-01-20' AND event_id < 600) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1")
def follow_to_positions(spark, sf_dir):
    """The latest rows by a stream with a state for each key, which stops in the middle of a file twice and goes on there."""
    folder, schema = staged_events(spark, sf_dir)
    target = VersionedTable(spark, f"{folder}-target", ["user_id"], 4)
    for end in (("bin.20240108", 500), ("bin.20240120", 600)):
        follow(spark, folder, schema, target, f"{folder}-checkpoint", ["user_id"], end=end)
    return target.read().select("user_id", F.col("log_pos").alias("event_id"), "event_type")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def export_slices(spark, sf_dir):
    """orders as files of at most 1,000 rows without headers, read again by the columns of their manifest."""
    folder, rows = new_folder(spark), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.write_slices(rows, folder, 1_000)
    found = spark.read.schema(rows.schema).options(header=False, escape='"').csv(folder)
    if found.groupBy(F.input_file_name()).count().where("count > 1000").count():
        raise ValueError("a slice has more rows than it may have")
    return found


@query(
    """SELECT 't' || s_nationkey AS table_name, string_agg(s_name, ',' ORDER BY s_suppkey) FILTER (s_suppkey % 9 = 0 OR (s_suppkey % 8 <> 5 AND s_suppkey % 4 <> 0)) AS columns, string_agg(s_name, ',' ORDER BY s_suppkey) FILTER (s_suppkey % 9 = 0) AS key
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 7 <> 0 AND n_regionkey <> 2 AND n_nationkey % 2 = 0 GROUP BY ALL"""
)
def discovered_and_mapped(spark, sf_dir):
    """Discovery writes a mapping of all there is; it is edited (every second table, without each fourth column, in other
    letters) and read again: the columns that are read of each selected table, and its key."""
    n = table(spark, sf_dir, "nation")
    kinds = n.select(F.when(F.col("n_nationkey") % 7 == 0, "mysql").otherwise("shop").alias("schema_name"), F.concat(F.lit("t"), "n_nationkey").alias("table_name"), F.when(F.col("n_regionkey") == 2, "VIEW").otherwise("BASE TABLE").alias("table_type"))
    streams = discovered(server.catalogue(supplier_columns(spark, sf_dir), kinds))
    fourth = {r.s_name for r in table(spark, sf_dir, "supplier").where("s_suppkey % 4 = 0").select("s_name").collect()}
    edited = parse_mapping(mapping_text(mapping_of(streams)).replace("shop", "SHOP"))
    for entry in edited.get("SHOP", {}).get("tables", []):
        for name, asked in entry.items():
            asked["selected"] = int(name[1:]) % 2 == 0
            asked["columns"] = {c.upper(): c not in fourth for c in asked["columns"]}
    edited.setdefault("SHOP", {"tables": []})["tables"].append({"gone": {"selected": True}})
    rows = [(s.table, ",".join(s.desired()) or None, ",".join(s.key) or None) for s in apply_mapping(streams, edited)]
    return spark.createDataFrame(rows, "table_name string, columns string, key string")


@query(
    """SELECT s_name AS table_name, s_suppkey % 3 <> 0 AND s_suppkey % 2 = 0 AS incremental, CASE WHEN s_suppkey % 5 = 0 THEN 'in.c-my-app-' || s_suppkey ELSE 'in.c-' || lower(replace(s_name, '#', '')) END || '.' || upper(s_name) AS destination,
    CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'ID' END AS key FROM supplier"""
)
def manifests(spark, sf_dir):
    """Suppliers as tables: whether a load adds to what is there, where it goes, and its key."""
    schema, rows = table(spark, sf_dir, "supplier").schema, []
    for r in table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").collect():
        method = ("FULL_TABLE", "INCREMENTAL", "LOG_BASED")[r.s_suppkey % 3]
        place = sinks.bucket(None if r.s_suppkey % 5 == 0 else r.s_name.replace("#", "").lower(), "my.app", str(r.s_suppkey))
        told = sinks.manifest(f"{place}.{r.s_name.upper()}", [] if r.s_suppkey % 4 == 0 else ["id"], schema, sinks.is_incremental(method, r.s_suppkey % 2 == 0))
        rows.append((r.s_name, told["incremental"], told["destination"], ",".join(told["primary_key"]) or None))
    return spark.createDataFrame(rows, "table_name string, incremental boolean, destination string, key string")


@query(
    """SELECT s_name AS table_name, CASE s_suppkey % 3 WHEN 0 THEN 'initial_full_table_complete,last_pk_fetched' WHEN 1 THEN 'replication_key,replication_key_value' ELSE 'initial_full_table_complete,last_pk_fetched,log_file,log_pos' END AS kept,
    s_suppkey % 3 = 2 AS needs_snapshot FROM supplier"""
)
def state_round_trip(spark, sf_dir):
    """A state of all suppliers' tables with more than their methods use, trimmed, written and read again."""
    streams = [Stream("s", r.s_name, {"id": "automatic"}, ["id"], method=("FULL_TABLE", "INCREMENTAL", "LOG_BASED")[r.s_suppkey % 3], replication_key="id") for r in table(spark, sf_dir, "supplier").collect()]
    state, out = State(), new_folder(spark)
    for s in streams:
        state.put(s, log_file="bin.1", log_pos=4, last_pk_fetched={"id": 3}, initial_full_table_complete=True, replication_key="id", replication_key_value="7", other=1)
        state.trim(s)
    sinks.write_json(spark, f"{out}/state.json", state.document())
    again = read_state(spark, out)
    return spark.createDataFrame([(s.table, ",".join(sorted(again.bookmarks[State.name(s)])), again.needs_snapshot(s)) for s in streams], "table_name string, kept string, needs_snapshot boolean")


@query(
    """SELECT s_name AS table_name, CASE WHEN s_suppkey % 4 = 3 THEN 'unknown method' WHEN s_suppkey % 4 = 2 AND s_suppkey % 3 = 0 THEN 'a view has no log' WHEN s_suppkey % 4 = 1 AND s_suppkey % 5 = 0 THEN 'no replication key' END AS problem FROM supplier"""
)
def configuration_checks(spark, sf_dir):
    """Suppliers as tables, some of which can't be read as they are configured."""
    rows = []
    for r in table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").collect():
        method = ("FULL_TABLE", "INCREMENTAL", "LOG_BASED", "BY_HAND")[r.s_suppkey % 4]
        stream = Stream("s", r.s_name, {"id": "automatic"}, ["id"], is_view=r.s_suppkey % 3 == 0, method=method, replication_key=None if r.s_suppkey % 5 == 0 else "id")
        try:
            stream.check()
            rows.append((r.s_name, None))
        except ConfigError as e:
            rows.append((r.s_name, str(e).partition(": ")[2].removesuffix(f" {method}")))
    return spark.createDataFrame(rows, "table_name string, problem string")
