"""The latest row of each key, and bringing a table up to date."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: Iterable[str], order: Column) -> DataFrame:
    """The row of the highest `order` for each key (a tuple: null and empty are different). One shuffle, and each task
    sends at most one row of a key on."""
    w = Window.partitionBy(*key).orderBy(order.desc())
    return rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def latest_by_aggregate(rows: DataFrame, key: Iterable[str], order: Column) -> DataFrame:
    """The same by max_by over a struct of the row."""
    names, key = rows.columns, list(key)
    rest = [c for c in names if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*[F.col(c) if c in key else F.col(f"_row.`{c}`") for c in names])


def deduplicated(rows: DataFrame, key: Iterable[str], order: Column, append: bool = False) -> DataFrame:
    """The latest rows, or all of them where there is no key or every change is kept."""
    key = list(key)
    return rows if append or not key else latest(rows, key, order)


def upsert(target: DataFrame, changes: DataFrame, key: Iterable[str]) -> DataFrame:
    """target with the rows of `changes` (one for each key) in place of its own; columns of either stay."""
    return target.join(changes.select(*key), list(key), "left_anti").unionByName(changes, allowMissingColumns=True)
