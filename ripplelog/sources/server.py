"""A server's tables, catalogue and log list over JDBC, and the same from staged files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog.operators.offsets import log_files

#: Schemas that belong to the server itself.
SYSTEM_SCHEMAS = ("information_schema", "performance_schema", "mysql", "sys")
FETCH_ROWS = 100_000


def quoted(name: str) -> str:
    """A name between back-quotes; a name that has one is refused."""
    if "`" in name:
        raise ValueError(f"back-quote in the name {name!r}")
    return f"`{name}`"


def jdbc_options(host: str, port: int, user: str, password: str, connect_s: int = 30, read_s: int = 3000, tls: bool = False, session: Iterable[str] = ()) -> dict[str, str]:
    """Options of spark.read.format("jdbc"); sessions run in UTC. A tunnel, if one is needed, is outside Spark."""
    return {
        "url": f"jdbc:mysql://{host}:{port}/?connectTimeout={connect_s * 1000}&socketTimeout={read_s * 1000}&sslMode={'REQUIRED' if tls else 'DISABLED'}",
        "user": user,
        "password": password,
        "fetchsize": str(FETCH_ROWS),
        "sessionInitStatement": "; ".join(["SET time_zone = '+00:00'", *session]),
    }


def read_table(spark: SparkSession, options: dict[str, str], schema: str, table: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 1) -> DataFrame:
    """A server's table; with a numeric key in so many ranges at once. Filters, columns and maxima reach the server."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", f"{quoted(schema)}.{quoted(table)}")
    if key and parts > 1:
        reader = reader.options(partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def primary_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """schema_name, table_name and column_name of primary keys."""
    on = ["constraint_name", "schema_name", "table_name"]
    return constraints.join(usage, on).where("constraint_type = 'PRIMARY KEY'").select("schema_name", "table_name", "column_name")


def catalogue(columns: DataFrame, tables: DataFrame, databases: Iterable[str] = ()) -> DataFrame:
    """One row for each table: its columns as an array, by ordinal position. Views and the server's schemas are left
    out; with `databases`, all others are."""
    wanted = F.col("schema_name").isin(*databases) if (databases := list(databases)) else ~F.lower("schema_name").isin(*SYSTEM_SCHEMAS)
    real = tables.where(wanted & (F.col("table_type") != "VIEW")).select("schema_name", "table_name")
    named = F.struct("ordinal", "column_name", "column_type", "column_key")
    return columns.join(real, ["schema_name", "table_name"]).groupBy("schema_name", "table_name").agg(F.array_sort(F.collect_list(named)).alias("columns"))


def with_default_charset(columns: DataFrame, schemata: DataFrame) -> DataFrame:
    """The columns with their database's default character set and collation."""
    return columns.join(schemata.select("schema_name", "default_charset", "default_collation"), "schema_name", "left")


def staged_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """A change log staged as files, partitioned by table: filters on the table skip whole folders."""
    return spark.read.schema(schema).parquet(path)


def log_list(spark: SparkSession, path: str) -> DataFrame:
    """log_name and file_size from JSON as a log server returns it."""
    return log_files(spark.read.schema("logs array<struct<log_name: string, file_size: string>>").option("multiLine", True).json(path))
