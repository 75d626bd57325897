"""Operators on change logs.

A change log has log_file, log_pos and row_idx (its order), ts_s (seconds), schema_name, table_name, op (insert, update,
delete, ddl or rotate), before and after (structs of the table's columns) and ddl.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYNCED, DELETED, CHANGED, READ = "_synced_at", "_deleted_at", "_change_at", "_read_at"
SYSTEM = (SYNCED, DELETED, CHANGED, READ)


def file_number(log_file: Column) -> Column:
    """The number at the end of a log file's name: the order of text fails once the number gains a digit."""
    return F.regexp_extract(log_file, r"(\d+)$", 1).try_cast("long")


def position(log_file: str = "log_file", log_pos: str = "log_pos", row_idx: str = "row_idx") -> Column:
    """The total order of a log as one comparable struct."""
    return F.struct(file_number(F.col(log_file)).alias("file_no"), F.col(log_file).alias("log_file"), F.col(log_pos).alias("log_pos"), F.col(row_idx).alias("row_idx"))


#: Lists of so many tables become a filter that reaches the scan; lists of so many rows are broadcast; longer ones are joined.
FILTERED, BROADCAST = 1_000, 100_000


def small(rows: DataFrame, most: int = BROADCAST) -> DataFrame:
    """rows, marked for broadcast if there are at most `most` of them."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def one_of(pairs: Iterable[tuple[str, str]]) -> Column:
    """Whether an event is of one of the pairs (schema, table), as a plain filter that reaches the scan."""
    of: dict[str, list[str]] = {}
    for schema, table in pairs:
        of.setdefault(schema, []).append(table)
    out = F.lit(False)
    for schema, tables in of.items():
        out = out | ((F.col("schema_name") == schema) & F.col("table_name").isin(*tables))
    return out


def _listed(pairs: DataFrame) -> Column | None:
    """one_of the rows of `pairs`; None if there are too many for a filter."""
    found = pairs.limit(FILTERED + 1).collect()
    return None if len(found) > FILTERED else one_of((r.schema_name, r.table_name) for r in found)


def _pairs(tables: DataFrame) -> DataFrame:
    return tables.select("schema_name", "table_name").distinct().where("schema_name IS NOT NULL AND table_name IS NOT NULL")


def of_tables(log: DataFrame, tables: DataFrame) -> DataFrame:
    """The events of the pairs (schema_name, table_name) in `tables`; pairs, not every schema with every table."""
    listed = _listed(_pairs(tables))
    return log.join(small(_pairs(tables)), ["schema_name", "table_name"], "left_semi") if listed is None else log.where(listed)


def of_kinds(log: DataFrame, kinds: Iterable[str] = ("insert", "update", "delete")) -> DataFrame:
    return log.where(F.col("op").isin(*kinds))


def since(log: DataFrame, ts_s: int) -> DataFrame:
    return log.where(F.col("ts_s") >= ts_s)


def differs(names: Iterable[str], before: str = "before", after: str = "after") -> Column:
    """Whether any of the columns differs between the images; null and a value differ, null and null don't."""
    out = F.lit(False)
    for n in names:
        out = out | ~F.col(f"{before}.`{n}`").eqNullSafe(F.col(f"{after}.`{n}`"))
    return out


def known(columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    lower = {w.lower() for w in wanted}
    return [c for c in columns if c.lower() in lower]


def relevant(log: DataFrame, watch: Iterable[str] = (), ignore: Iterable[str] = ()) -> DataFrame:
    """Drops updates that change nothing of interest: with `ignore`, those in ignored columns alone; else with `watch`,
    those in no watched column. `ignore` comes first if both are given. Names match in any case."""
    of_interest = interest(log.schema["after"].dataType.names, watch, ignore)
    return log if of_interest is None else log.where(of_interest)


def interest(columns: Iterable[str], watch: Iterable[str] = (), ignore: Iterable[str] = ()) -> Column | None:
    """The condition that relevant() filters by; None if everything is of interest."""
    columns = list(columns)
    if ignored := known(columns, ignore):
        return (F.col("op") != "update") | differs([c for c in columns if c not in ignored])
    if watched := known(columns, watch):
        return (F.col("op") != "update") | differs(watched)
    return None


def system_columns(synced_at: str, deleted: Column, changed_s: Column, read_us: int) -> list[Column]:
    """The four columns that every row gets; times are given, so that reruns write the same."""
    return [F.lit(synced_at).alias(SYNCED), deleted.alias(DELETED), changed_s.cast("long").alias(CHANGED), F.lit(read_us).cast("long").alias(READ)]


def records(log: DataFrame, synced_at: str, read_us: int, desired: Iterable[str] = (), emit_delete_on_key_change: Iterable[str] = ()) -> DataFrame:
    """Rows with the log's order: after-images of inserts and updates, before-images of deletes with their time.

    desired: the columns to keep, all if empty. An update that changes a key leaves the row of the old key; with the key
    given as emit_delete_on_key_change it is marked deleted.
    """
    names = log.schema["after"].dataType.names
    names = known(names, desired) or names
    at = F.timestamp_seconds("ts_s")
    events = of_kinds(log)
    if key := list(emit_delete_on_key_change):
        gone = events.where((F.col("op") == "update") & differs(key)).withColumn("op", F.lit("delete")).withColumn("row_idx", F.col("row_idx") - 0.5)
        events = events.withColumn("row_idx", F.col("row_idx").cast("double")).union(gone.select(*events.columns))
    deleted = F.col("op") == "delete"
    image = [F.when(deleted, F.col(f"before.`{n}`")).otherwise(F.col(f"after.`{n}`")).alias(n) for n in names]
    return events.select("schema_name", "table_name", position().alias("_position"), *image, *system_columns(synced_at, F.when(deleted, at), F.col("ts_s"), read_us))


def counters(log: DataFrame) -> DataFrame:
    """Rows by table and kind."""
    return log.groupBy("schema_name", "table_name", "op").agg(F.count(F.lit(1)).alias("n_rows"))


def saved_and_skipped(log: DataFrame, catalogue: DataFrame) -> DataFrame:
    """How many events belong to a table of the catalogue, and how many do not."""
    known = _listed(_pairs(catalogue))
    if known is None:
        log = log.join(small(_pairs(catalogue).withColumn("_known", F.lit(True))), ["schema_name", "table_name"], "left")
        known = F.col("_known")
    known = F.coalesce(known, F.lit(False))
    return log.agg(F.count_if(known).alias("saved"), F.count_if(~known).alias("skipped"))


def incomplete_images(log: DataFrame) -> DataFrame:
    """Updates without both images: a log like this was not written row by row with full images and can't be used."""
    return log.where((F.col("op") == "update") & (F.col("before").isNull() | F.col("after").isNull()))


def require_images(log: DataFrame) -> None:
    """Fails if an update lacks an image."""
    if wrong := incomplete_images(log).select("log_file", "log_pos").limit(5).collect():
        raise ValueError(f"the log has updates without both images, as at {wrong}: it has to be written row by row with full images")
