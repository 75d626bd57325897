"""Where results go: CSV with manifests, Parquet versions, state."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.functions.types import base_type, base_type_of
from ripplelog.functions.values import normalised

SLICE_ROWS = 100_000


def exported(rows: DataFrame, binary: str = "plain") -> DataFrame:
    """The rows as text-friendly values: booleans 0 and 1, times in UTC, binaries encoded."""
    return rows.select(*[normalised(f, binary) for f in rows.schema])


def write_csv(rows: DataFrame, path: str, null: str = "") -> None:
    """All fields quoted, with a header; embedded quotes are doubled."""
    exported(rows).write.options(header=True, quoteAll=True, escape='"', nullValue=null, emptyValue="").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, null: str = "") -> DataFrame:
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=True, nullValue=null, emptyValue="").csv(path)


def write_slices(rows: DataFrame, path: str, size: int = SLICE_ROWS) -> None:
    """Files of at most `size` rows without headers: the columns are in the manifest."""
    exported(rows).write.options(header=False, escape='"', maxRecordsPerFile=size).csv(path)


def manifest(destination: str, key: Iterable[str], schema: T.StructType, incremental: bool) -> dict:
    """What a loader has to know of a table; names in upper case, each column with its base type and its server type."""
    columns = []
    for f in schema:
        known = f.metadata or {}
        columns.append({"name": f.name.upper(), "base_type": base_type_of(f), "type": known.get("column_type", f.dataType.simpleString()), "length": known.get("length"), "nullable": f.nullable})
    return {"destination": destination, "primary_key": [k.upper() for k in key], "columns": [c["name"] for c in columns], "column_metadata": columns, "incremental": incremental}


def is_incremental(method: str, incremental_sync: bool) -> bool:
    """Full tables replace what was there; everything else is added to it."""
    return incremental_sync and method != "FULL_TABLE"


def bucket(name: str | None, component: str = "", configuration: str = "") -> str:
    return f"in.c-{name}" if name else f"in.c-{component.replace('.', '-')}-{configuration}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole, wherever Spark can write."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    """A folder with all that is in it, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, default=str, sort_keys=True))


def base_types(columns: DataFrame) -> DataFrame:
    """Columns (…, column_type) with their storage base type."""
    return columns.withColumn("base_type", base_type(F.col("column_type")))
