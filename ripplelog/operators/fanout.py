"""One read of a change log for all tables that are followed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ripplelog.operators import changelog, offsets

#: The partition that statements go to; no table's, as those have a point in their names.
DDL = "ddl"
KINDS = ("insert", "update", "delete")
#: With more tables than this, rows by table and kind are counted in the parts that were written.
OBSERVED = 100


@dataclass(frozen=True)
class Followed:
    """A table whose events are wanted from a position on; updates can be left out by the columns that they change."""

    name: str
    schema: str
    table: str
    log_file: str
    log_pos: int
    watch: tuple[str, ...] = ()
    ignore: tuple[str, ...] = ()


@dataclass
class Read:
    """What a read has found: rows by table in a folder, and counters.

    saved: events of followed tables; skipped: those of other tables (None where they were not read); unchanged: updates
    that were left out for what they change; statements: of all tables; by_kind: rows that were
    written by (name, kind).
    """

    rows: DataFrame
    saved: int = 0
    skipped: int | None = None
    unchanged: int = 0
    statements: int = 0
    by_kind: dict[tuple[str, str], int] = field(default_factory=dict)

    def of(self, name: str) -> DataFrame:
        return self.rows.where(F.col("_stream") == name)


def _interest(columns: list[str], followed: Iterable[Followed]) -> Column:
    out = F.lit(True)
    for f in followed:
        wanted = changelog.interest(columns, f.watch, f.ignore)
        if wanted is not None:
            out = F.when(F.col("_stream") == f.name, wanted).otherwise(out)
    return out


def read_once(log: DataFrame, followed: Iterable[Followed], end: Mapping[str, object], folder: str, count_skipped: bool = False) -> Read:
    """Reads a log once, from the first position that any table still needs up to before `end`, into `folder`, and returns
    the rows by table.

    The rows have _stream (the table's name), op, log_file, log_pos, row_idx, ts_s, image (the row after the event, or before
    it for deletes), _also (columns that only the image before an update has a value in) and ddl. Statements of all tables
    are in the part `ddl`. Each table's rows are those from its own position on. What is filtered by position and table
    reaches the scan; with count_skipped the tables don't, as others' events have to be read to be counted.

    The same pass checks that updates have both images, and counts: the counters are taken on the way to the writer, in tasks
    that are counted once however often they run. Nothing is shuffled, and a task writes at most one file for each table.
    """
    spark, followed = log.sparkSession, list(followed)
    columns = log.schema["after"].dataType.names
    log = offsets.pending(log, *offsets.least((f.log_file, f.log_pos) for f in followed))
    log = offsets.until(log, end["log_file"], end["log_pos"]) if end else log
    has_ddl = "ddl" in log.columns
    said = (F.col("op") == "ddl") if has_ddl else F.lit(False)
    if not count_skipped and len(followed) <= changelog.FILTERED:
        log = log.where(changelog.one_of((f.schema, f.table) for f in followed) | said)
    places = spark.createDataFrame([(f.schema, f.table, f.name, offsets.number_of(f.log_file), f.log_pos) for f in followed], "_s string, _t string, _name string, _no long, _pos long")
    no = offsets.number(log)
    on = (F.col("schema_name") == F.col("_s")) & (F.col("table_name") == F.col("_t"))
    met = log.withColumn("_file", no).join(F.broadcast(places) if len(followed) <= changelog.BROADCAST else places, on, "left")
    behind = (F.col("_file") < F.col("_no")) | ((F.col("_file") == F.col("_no")) & (F.col("log_pos") < F.col("_pos")))
    rows = F.col("op").isin(*KINDS)
    met = met.where(F.col("_name").isNull() | ~behind | said)
    met = met.withColumn("_stream", F.when(said, DDL).when(rows, F.col("_name")))
    mine = F.col("_stream").isNotNull() & ~said
    met = met.withColumn("_wanted", F.when(mine, _interest(columns, followed)).otherwise(said))
    lacking = mine & (F.col("op") == "update") & (F.col("before").isNull() | F.col("after").isNull())
    counts = [
        F.count_if(mine).alias("saved"), F.count_if(rows & ~mine).alias("skipped"), F.count_if(mine & ~F.col("_wanted")).alias("unchanged"), F.count_if(lacking).alias("lacking"), F.count_if(said).alias("statements"),
        F.min(F.when(lacking, F.struct("_file", "log_file", "log_pos"))).alias("lacking_at"),
    ]
    observed = len(followed) <= OBSERVED
    if observed:
        counts += [F.count_if(mine & F.col("_wanted") & (F.col("_stream") == f.name) & (F.col("op") == kind)).alias(f"n{i}_{kind}") for i, f in enumerate(followed) for kind in KINDS]
    watch = Observation()
    met = met.observe(watch, *counts).where("_wanted")
    gone = F.col("op") == "delete"
    image = F.struct(*[F.when(gone, F.col(f"before.`{c}`")).otherwise(F.col(f"after.`{c}`")).alias(c) for c in columns])
    also = F.array_compact(F.array(*[F.when((F.col("op") == "update") & F.col(f"after.`{c}`").isNull() & F.col(f"before.`{c}`").isNotNull(), F.lit(c)) for c in columns]))
    ddl = F.col("ddl") if has_ddl else F.lit(None).cast("string")
    out = met.select("op", "log_file", "log_pos", F.col("row_idx").cast("double").alias("row_idx"), "ts_s", "schema_name", "table_name", F.when(~said, image).alias("image"), also.alias("_also"), ddl.alias("ddl"), "_stream")
    out.write.mode("overwrite").partitionBy("_stream").parquet(folder)
    told = watch.get
    if told["lacking"]:
        raise ValueError(f"the log has {told['lacking']} updates without both images, the first at {told['lacking_at']}: it has to be written row by row with full images")
    found = Read(spark.read.schema(out.schema).parquet(folder), told["saved"], told["skipped"] if count_skipped else None, told["unchanged"], told["statements"])
    if observed:
        found.by_kind = {(f.name, kind): told[f"n{i}_{kind}"] for i, f in enumerate(followed) for kind in KINDS if told[f"n{i}_{kind}"]}
    else:
        found.by_kind = {(r._stream, r.op): r["count"] for r in found.rows.where(F.col("_stream") != DDL).groupBy("_stream", "op").count().collect()}
    return found
