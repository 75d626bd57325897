"""Reading tables in full, from where an earlier read stopped, or by a growing key."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.operators.changelog import system_columns

#: Types by which a snapshot can go on where it stopped.
RESUMABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def snapshot(table: DataFrame, columns: Iterable[str], synced_at: str) -> DataFrame:
    """The columns with the system columns of a snapshot: not deleted, changed and read at 0."""
    return table.select(*columns, *system_columns(synced_at, F.lit(None).cast("timestamp"), F.lit(0), 0))


def max_key_values(table: DataFrame, key: Iterable[str]) -> DataFrame:
    """The maximum of each key column by itself, not the largest key."""
    return table.agg(*[F.max(k).alias(f"max_{k}") for k in key])


def _typed(table: DataFrame, name: str, value) -> Column:
    return F.lit(value).cast(table.schema[name].dataType)


def after_key(table: DataFrame, last: Mapping[str, object]) -> Column:
    """Keys behind `last` in their order, spelled out as (a > x) OR (a = x AND b > y): that form reaches the scan."""
    keys = list(last)
    steps = []
    for i, k in enumerate(keys):
        equal = [F.col(p) == _typed(table, p, last[p]) for p in keys[:i]]
        steps.append(reduce(Column.__and__, [*equal, F.col(k) > _typed(table, k, last[k])]))
    return reduce(Column.__or__, steps)


def remaining(table: DataFrame, key: Iterable[str], last: Mapping[str, object] | None = None, most: Mapping[str, object] | None = None) -> DataFrame:
    """The rows behind the last key that was read, up to the maxima at the first start."""
    if last:
        table = table.where(after_key(table, {k: last[k] for k in key}))
    for k, v in (most or {}).items():
        table = table.where(F.col(k) <= _typed(table, k, v))
    return table


def resumed(table: DataFrame, key: Iterable[str], last: Mapping[str, object] | None = None, most: Mapping[str, object] | None = None) -> DataFrame:
    """What remains of the table, in the order of the key."""
    key = list(key)
    return remaining(table, key, last, most).orderBy(*key)


def is_resumable(schema: T.StructType, key: Iterable[str]) -> bool:
    key = list(key)
    return bool(key) and all(isinstance(schema[k].dataType, RESUMABLE) for k in key)


#: So many keys are sampled for each range that is to be cut.
SAMPLED = 200


def key_cuts(table: DataFrame, key: Iterable[str], parts: int, seed: int = 7) -> list[dict[str, str]]:
    """Up to parts - 1 different keys, in order, that cut the table into ranges of about as many rows each.

    Keys are tuples of any types that have an order; values are texts that cast back to them. The cuts come from a sample of
    some SAMPLED keys for each range, ordered as tuples, so what is sent here is bounded by `parts` alone."""
    key = list(key)
    rows = table.count()
    if parts < 2 or rows < 2:
        return []
    keys = table.select(*key)
    keys = keys if rows <= parts * SAMPLED else keys.sample(min(1.0, 1.2 * parts * SAMPLED / rows), seed)
    ordered = keys.distinct().orderBy(*key).select(*[F.col(k).cast("string").alias(k) for k in key])
    found = [r.asDict() for r in ordered.limit(4 * parts * SAMPLED).collect()]
    at = sorted({len(found) * i // parts for i in range(1, parts)} - {0})
    return [found[i - 1] for i in at]


def up_to(table: DataFrame, high: Mapping[str, object] | None) -> DataFrame:
    """The rows up to a key and with it, spelled out as (a < x) OR (a = x AND b <= y); all of them without one."""
    if high is None:
        return table
    keys, steps = list(high), []
    for i, k in enumerate(keys):
        equal = [F.col(p) == _typed(table, p, high[p]) for p in keys[:i]]
        last = F.col(k) <= _typed(table, k, high[k]) if i == len(keys) - 1 else F.col(k) < _typed(table, k, high[k])
        steps.append(reduce(Column.__and__, [*equal, last]))
    return table.where(reduce(Column.__or__, steps))


def since_bookmark(table: DataFrame, replication_key: str, bookmark: object | None) -> DataFrame:
    """Rows of the bookmark's key value and later; ties with the bookmark are read again, as some may be new."""
    return table if bookmark is None else table.where(F.col(replication_key) >= _typed(table, replication_key, bookmark))


def page(table: DataFrame, replication_key: str, key: Iterable[str], n: int) -> DataFrame:
    """The first n rows by replication key, ties by primary key."""
    return table.orderBy(replication_key, *key).limit(n)


def next_bookmark(table: DataFrame, replication_key: str) -> DataFrame:
    return table.agg(F.max(replication_key).alias("bookmark"))


def chunk_numbers(table: DataFrame, order: Iterable[str], size: int = 100_000, chunk: str = "chunk") -> DataFrame:
    """Adds the number of the slice of `size` rows that a row falls in, from 1, in the given order.

    Rows are numbered within ranges of the order and the ranges' sizes are summed, so that no task gets them all.
    """
    order = list(order)
    ranged = table.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    number = F.floor((F.col("_before") + F.col("_in") - 1) / size).cast("long") + 1
    return ranged.join(before, "_part").select(*table.columns, number.alias(chunk))


def with_before_image(rows: DataFrame, key: Iterable[str], order: Iterable[str], names: Iterable[str]) -> DataFrame:
    """A change log from successive versions of rows: op, before and after; the first version of a key is its insert."""
    w, names = Window.partitionBy(*key).orderBy(*order), list(names)
    image = F.struct(*names)
    return rows.select("*", F.lag(image).over(w).alias("before"), image.alias("after")).withColumn("op", F.when(F.col("before").isNull(), "insert").otherwise("update"))
