"""One run: checks, snapshots, key-based loads and the log, each into its target, with the state written after each."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog.functions.ddl import column_changes
from ripplelog.operators import changelog, evolution, latest, offsets, snapshot
from ripplelog.operators.evolution import grown
from ripplelog.operators.fanout import DDL, Followed, Read, read_once
from ripplelog.plans.catalog import Plan, State, Stream
from ripplelog.sources.sinks import delete, is_incremental, manifest, read_text, write_csv, write_json, write_slices
from ripplelog.sources.versions import VersionedTable

AUDIT = "SCHEMA_CHANGES"
LAYOUTS = "schema_name string, table_name string, layout array<struct<name: string, column_type: string, key: string, charset: string, collation: string>>"


def read_state(spark: SparkSession, out: str) -> State:
    """The state that the last run left in `out`; an empty one if there was none."""
    text = read_text(spark, f"{out}/state.json")
    return State(json.loads(text) if text else None)


def log_rows(stream: Stream, read: DataFrame, synced_at: str, read_us: int, append: bool, added: list[str] = ()) -> DataFrame:
    """A stream's rows of what read_once has found: with system columns, the latest of each key unless all are kept. added:
    columns that DDL has brought, which are read like the stream's own."""
    names = read.schema["image"].dataType.names
    names = changelog.known(names, [*stream.desired(), *added]) or names
    deleted = F.when(F.col("op") == "delete", F.timestamp_seconds("ts_s"))
    rows = read.select(changelog.position().alias("_position"), *[F.col(f"image.`{n}`").alias(n) for n in names], *changelog.system_columns(synced_at, deleted, F.col("ts_s"), read_us))
    return latest.deduplicated(rows, stream.key, F.col("_position"), append).drop("_position")


@dataclass
class Run:
    """What a run needs to know; see run()."""

    spark: SparkSession
    state: State
    out: str
    synced_at: str
    read_us: int = 0
    append: bool = False
    export: str | None = None
    target_parts: int = 1
    bucket: str = ""
    counters: dict = field(default_factory=dict)
    results: dict[str, DataFrame] = field(default_factory=dict)

    def save(self) -> None:
        write_json(self.spark, f"{self.out}/state.json", self.state.document())

    def finish(self, stream: Stream, rows: DataFrame, keep: bool, token: str | None = None) -> None:
        """Writes the next version of a stream's target with its manifest, and the export if one is asked for.

        Rows of a key go into the parts of the target that have keys like it, rows that are all kept beside those there are.
        token: what the rows are made of. A target that has them already, as the state was lost behind it, stays as it is.
        """
        name = State.name(stream)
        in_parts = stream.key and not self.append and stream.method != "FULL_TABLE"  # others are written as a whole or added to
        target = VersionedTable(self.spark, f"{self.out}/{name}", stream.key, self.target_parts if in_parts else 1)
        now = target.version()
        new = 0 if now is None else now + 1
        if token is None or token != target.token():
            if not keep or now is None:
                target.write(rows, new, token)
            elif self.append or not stream.key:
                target.add(rows, new, token)
            else:
                target.upsert(rows, new, token=token)
        self.results[name] = target.read()
        self.state.storage[name] = grown(self.state.storage.get(name, []), self.results[name].columns)
        stored = evolution.in_storage_order(self.results[name], self.state.storage[name])
        if self.export:
            (write_slices if self.export == "slices" else write_csv)(stored, f"{self.out}/{name}.csv/v={target.version()}")
        write_json(self.spark, f"{self.out}/{name}.manifest", manifest(name, stream.key, stored.schema, is_incremental(stream.method, keep)))

    def snapshot(self, stream: Stream, table: DataFrame, parts: int) -> None:
        """Reads a table up to its maxima at the first start, in ranges of its key where that can be resumed; each range is
        marked in the state when it is written, and a run that was interrupted goes on behind the last one.

        The ranges are in a folder of this snapshot, which the state names: another one never meets what it has left."""
        rows = snapshot.snapshot(table, stream.desired(), self.synced_at)
        folder = None
        if parts > 1 and snapshot.is_resumable(table.schema, stream.key):
            most, last, token = (self.state.get(stream, k) for k in ("max_pk_values", "last_pk_fetched", "snapshot"))
            if most is None or token is None:
                first = table.agg(*[F.max(k).cast("string").alias(k) for k in stream.key]).first()
                most, last, token = first.asDict(), None, uuid.uuid4().hex
                self.state.put(stream, max_pk_values=most, snapshot=token)
                self.state.clear(stream, "last_pk_fetched")
                self.save()
            folder = f"{self.out}/{State.name(stream)}.parts/{token}"
            if None not in most.values():
                left = snapshot.remaining(table, stream.key, last, most)
                for high in [*snapshot.key_cuts(left, stream.key, parts), None]:
                    part = snapshot.snapshot(snapshot.up_to(snapshot.remaining(table, stream.key, last, most), high), stream.desired(), self.synced_at)
                    named = "rest" if high is None else hashlib.sha256(json.dumps(high).encode()).hexdigest()[:16]
                    part.write.mode("overwrite").parquet(f"{folder}/upto={named}")
                    if high is not None:
                        last = high
                        self.state.put(stream, last_pk_fetched=last)
                        self.save()
                rows = self.spark.read.schema(rows.schema).parquet(folder).select(*rows.columns)
        self.finish(stream, rows, keep=False)
        self.state.clear(stream, "last_pk_fetched", "max_pk_values", "snapshot")
        if folder is not None:
            self.save()
            delete(self.spark, folder)

    def layouts(self, streams: list[Stream], said: DataFrame, catalogue: DataFrame | None, n: int) -> tuple[DataFrame, dict[str, list[str]]]:
        """The layouts along the n statements, and the columns that they add to each stream. New layouts go into the state,
        changes into the audit table. The layouts at the start are the state's, or for other tables the catalogue's. Of each
        table, the statements from its stream's position on count."""
        known = [(s.schema, s.table, self.state.layouts[State.name(s)]) for s in streams if self.state.layouts.get(State.name(s))]
        known = self.spark.createDataFrame(known, LAYOUTS)
        server = evolution.first_layouts(catalogue) if catalogue is not None else None
        mine = [(s.schema.lower(), s.table.lower(), offsets.number_of(self.state.get(s, "log_file")), self.state.get(s, "log_pos")) for s in streams]
        mine = self.spark.createDataFrame(mine, "s string, t string, no long, pos long")
        no = changelog.file_number(F.col("log_file"))
        changes = column_changes(said.select("log_file", "log_pos", "row_idx", "ts_s", "schema_name", "ddl"))
        changes = changes.join(F.broadcast(mine), (F.lower("change.schema_name") == F.col("s")) & (F.lower("change.table_name") == F.col("t")))
        changes = changes.where((no > F.col("no")) | ((no == F.col("no")) & (F.col("log_pos") >= F.col("pos")))).drop("s", "t", "no", "pos")
        folder = f"{self.out}/layouts"
        evolution.history(known, changes, server).write.mode("overwrite").parquet(folder)
        held = self.spark.read.schema(evolution.HISTORY).parquet(folder)
        last = evolution.versions(held).groupBy("schema_name", "table_name").agg(F.max("version").alias("version"))
        last = {(r.schema_name.lower(), r.table_name.lower()): r.layout for r in evolution.layouts(held, last).collect()}
        for s in streams:
            if layout := last.get((s.schema.lower(), s.table.lower())):
                self.state.layouts[State.name(s)] = [c.asDict() for c in layout]
        if n:
            self.audit(evolution.schema_changes(changes))
        return held, {State.name(s): [c.name for c in last.get((s.schema.lower(), s.table.lower()), ()) if c.name.lower() not in {x.lower() for x in s.inclusion}] for s in streams}

    def audit(self, changes: DataFrame) -> None:
        """Adds changes of layouts to their table, each once, and writes its manifest."""
        table, key = VersionedTable(self.spark, f"{self.out}/{AUDIT}"), ["column_name", "query", "timestamp"]
        now = table.version()
        table.write(changes if now is None else table.read().union(changes).dropDuplicates(key), 0 if now is None else now + 1)
        rows = table.read()
        if self.export:
            (write_slices if self.export == "slices" else write_csv)(rows, f"{self.out}/{AUDIT}.csv/v={table.version()}")
        write_json(self.spark, f"{self.out}/{AUDIT}.manifest", manifest(f"{self.bucket}_metadata.{AUDIT}", key, rows.schema, True))

    def catch_up(self, streams: list[Stream], log: DataFrame, end: Mapping[str, object], catalogue: DataFrame | None, count_skipped: bool) -> None:
        """Reads the log once for all streams, and brings each one's target up to its end."""
        followed = [Followed(State.name(s), s.schema, s.table, self.state.get(s, "log_file"), self.state.get(s, "log_pos"), tuple(s.watch), tuple(s.ignore)) for s in streams]
        folder = f"{self.out}/read-{uuid.uuid4().hex}"
        try:
            found = read_once(log, followed, end, folder, count_skipped)
            known = catalogue is not None or any(self.state.layouts.get(f.name) for f in followed)
            held, added = self.layouts(streams, found.of(DDL), catalogue, found.statements) if "ddl" in log.columns and (found.statements or known) else (None, {})
            for s, f in zip(streams, followed, strict=True):
                self.state.syncing = f.name
                rows = found.of(f.name)
                if held is not None and (wrong := evolution.read_mismatches(rows, held).select("log_file", "log_pos").limit(5).collect()):
                    raise evolution.LayoutError(f"{s.id}: rows don't fit the layout, as at {wrong}")
                token = f"{f.log_file}:{f.log_pos}-{end.get('log_file')}:{end.get('log_pos')}" if end else None
                self.finish(s, log_rows(s, rows, self.synced_at, self.read_us, self.append, added.get(f.name, [])), keep=True, token=token)
                self.state.put(s, **end)
                self.state.trim(s)
                self.save()
            self.count(found)
        finally:
            delete(self.spark, folder)

    def count(self, found: Read) -> None:
        self.counters["saved"] = self.counters.get("saved", 0) + found.saved
        self.counters["unchanged"] = self.counters.get("unchanged", 0) + found.unchanged
        if found.skipped is not None:
            self.counters["skipped"] = self.counters.get("skipped", 0) + found.skipped
        for (name, kind), n in found.by_kind.items():
            self.counters.setdefault("rows", {}).setdefault(name, {})[kind] = n


def run(
    spark: SparkSession,
    plan: Plan,
    state: State,
    out: str,
    read: Callable[[Stream], DataFrame],
    log: DataFrame | Callable[[Stream], DataFrame],
    end: Mapping[str, object],
    synced_at: str,
    read_us: int = 0,
    append: bool = False,
    files: DataFrame | None = None,
    catalogue: DataFrame | None = None,
    snapshot_parts: int = 1,
    export: str | None = None,
    target_parts: int = 16,
    count_skipped: bool = False,
    bucket: str = "in.c-main",
) -> dict[str, DataFrame]:
    """Brings every planned stream's target up to date and returns them by name.

    `end` is the log's position (log_file, log_pos) taken before anything is read: what changes during a snapshot comes
    again from the log, and events from `end` on are the next run's. Each target is a table of versions under `out`, numbered
    on from the last, in `target_parts` parts by key (so many that one is some hundred MB); the state is written after each table, so that a failure costs no more
    than the table it was in.

    log: the change log, which is read once for all streams, from the first position that one of them needs; or a function
    that gives a stream's part of it, for logs that are staged apart. Before that, bookmarks are checked against `files`
    (log_name, file_size), where given; the log's images are checked on the way. DDL events of the log change the layouts,
    which begin with the state's or the catalogue's (sources.server.catalogue) and are kept in the state; columns they add
    are read from then on, changes are added to the table SCHEMA_CHANGES, and rows that don't fit their table's layout fail.
    Counters of the log's events are in counters.json; with count_skipped those of other tables are read and counted as well.
    snapshot_parts: so many ranges of the key, each marked when it is there. export: csv (with a header) or slices (without),
    beside each target. bucket: where a loader puts the tables; changes of layouts go to the bucket with `_metadata`.
    """
    r = Run(spark, state, out, synced_at, read_us, append, export, target_parts, bucket)
    if files is not None and plan.from_log:
        placed = [(State.name(s), state.get(s, "log_file"), state.get(s, "log_pos")) for s in plan.from_log]
        offsets.verify(spark.createDataFrame(placed, "stream string, log_file string, log_pos long"), files)
    for s in plan.snapshots:
        state.syncing = State.name(s)
        r.save()
        r.snapshot(s, read(s), snapshot_parts)
        state.put(s, initial_full_table_complete=True, **(dict(end) if s.method == "LOG_BASED" else {}))
        state.trim(s)
        r.save()
    for s in plan.incremental:
        state.syncing = State.name(s)
        rows = snapshot.since_bookmark(read(s), s.replication_key, state.get(s, "replication_key_value"))
        top = snapshot.next_bookmark(rows, s.replication_key).first()["bookmark"]
        r.finish(s, snapshot.snapshot(rows, s.desired(), synced_at), keep=True)
        if top is not None:
            state.put(s, replication_key=s.replication_key, replication_key_value=str(top))
        state.trim(s)
        r.save()
    if callable(log):
        for s in plan.from_log:
            r.catch_up([s], log(s), end, catalogue, count_skipped)
    elif plan.from_log:
        r.catch_up(plan.from_log, log, end, catalogue, count_skipped)
    write_json(spark, f"{out}/counters.json", r.counters)
    state.syncing = None
    r.save()
    return r.results
