"""The driver's side: what is selected, by which method, and where each table stands."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.functions.types import inclusion

METHODS = ("FULL_TABLE", "INCREMENTAL", "LOG_BASED")
BOOKMARK_KEYS = {
    "LOG_BASED": {"log_file", "log_pos", "version"},
    "FULL_TABLE": {"last_pk_fetched", "max_pk_values", "snapshot", "version", "initial_full_table_complete"},
    "INCREMENTAL": {"replication_key", "replication_key_value", "version"},
}


class ConfigError(ValueError):
    """The configuration can't be used as it is."""


def should_sync(inclusion: str, selected: bool | None, default: bool) -> bool:
    """automatic always, unsupported never; else what was selected, or the default where nothing was."""
    if inclusion in ("automatic", "unsupported"):
        return inclusion == "automatic"
    return default if selected is None else selected


def is_synced(inclusion: Column, selected: Column, default: Column) -> Column:
    """should_sync for the columns of a whole catalogue."""
    return F.when(inclusion == "automatic", True).when(inclusion == "unsupported", False).otherwise(F.coalesce(selected, default))


@dataclass
class Stream:
    """One table: its columns by inclusion, its key, and what was asked for."""

    schema: str
    table: str
    inclusion: dict[str, str]
    key: list[str]
    is_view: bool = False
    selected: bool = False
    method: str = "LOG_BASED"
    replication_key: str | None = None
    columns: dict[str, bool] = field(default_factory=dict)
    watch: list[str] = field(default_factory=list)
    ignore: list[str] = field(default_factory=list)

    @property
    def id(self) -> tuple[str, str]:
        return self.schema, self.table

    def desired(self) -> list[str]:
        """The columns to read, in the table's order."""
        wanted = {c.lower(): v for c, v in self.columns.items()}
        return [c for c, how in self.inclusion.items() if should_sync(how, wanted.get(c.lower()), True)]

    def check(self) -> None:
        if self.method not in METHODS:
            raise ConfigError(f"{self.id}: unknown method {self.method}")
        if self.method == "LOG_BASED" and self.is_view:
            raise ConfigError(f"{self.id}: a view has no log")
        if self.method == "INCREMENTAL" and not self.replication_key:
            raise ConfigError(f"{self.id}: no replication key")


def discovered(catalogue: DataFrame) -> list[Stream]:
    """A stream for each table of a server's catalogue (sources.server.catalogue), by schema and table: its columns in order
    with their inclusion, and its primary key. Catalogues are read to the driver, as all planning is there."""
    return [
        Stream(r.schema_name, r.table_name, {c.column_name: inclusion(c.column_type, c.column_key) for c in r.columns}, [c.column_name for c in r.columns if c.column_key == "PRI"])
        for r in catalogue.orderBy("schema_name", "table_name").collect()
    ]


def apply_mapping(streams: Iterable[Stream], mapping: Mapping) -> list[Stream]:
    """Streams with what the mapping asks for: {database: {tables: [{table: {selected, replication-method, ...}}]}}.

    Tables that don't exist are left out. Names match in any case.
    """
    known = {(s.schema.lower(), s.table.lower()): s for s in streams}
    for database, content in mapping.items():
        for entry in content.get("tables") or []:
            for table, asked in entry.items():
                stream = known.get((database.lower(), table.lower()))
                if stream is None:
                    continue
                stream.selected = bool(asked.get("selected"))
                stream.method = asked.get("replication-method") or stream.method
                stream.replication_key = asked.get("replication-key")
                stream.columns = dict(asked.get("columns") or {})
                stream.watch = list(asked.get("columns_to_watch") or [])
                stream.ignore = list(asked.get("columns_to_ignore") or [])
    chosen = [s for s in known.values() if s.selected]
    for s in chosen:
        s.check()
    return chosen


def mapping_of(streams: Iterable[Stream]) -> dict:
    """The mapping that discovery writes: everything there is, to be edited."""
    out: dict = {}
    for s in streams:
        asked = {"selected": s.selected, "replication-method": s.method, "columns": dict.fromkeys(s.inclusion, True), "columns_to_watch": [], "columns_to_ignore": []}
        out.setdefault(s.schema, {"tables": []})["tables"].append({s.table: asked})
    return out


def require(config: Mapping, groups: Iterable[Iterable[str]]) -> None:
    """Of each group of names at least one has to be set; False and 0 are values."""
    missing = [" or ".join(g) for g in map(list, groups) if all(config.get(n) is None for n in g)]
    if missing:
        raise ConfigError(f"missing: {', '.join(missing)}")


class State:
    """Bookmarks by stream, layouts and storage columns; a plain JSON document."""

    def __init__(self, document: Mapping | None = None):
        d = dict(document or {})
        # empty objects may come back as empty lists
        self.bookmarks: dict[str, dict] = {k: dict(v or {}) for k, v in dict(d.get("bookmarks") or {}).items()}
        self.layouts: dict[str, list] = dict(d.get("last_table_schemas") or {})
        self.storage: dict[str, list[str]] = {k: [c.upper() for c in v] for k, v in dict(d.get("storage_columns") or {}).items()}
        self.syncing: str | None = d.get("currently_syncing")

    def document(self) -> dict:
        return {"bookmarks": self.bookmarks, "last_table_schemas": self.layouts, "storage_columns": self.storage, "currently_syncing": self.syncing}

    @staticmethod
    def name(stream: Stream) -> str:
        return f"{stream.schema}-{stream.table}"

    def get(self, stream: Stream, key: str, default=None):
        return self.bookmarks.get(self.name(stream), {}).get(key, default)

    def put(self, stream: Stream, **values) -> None:
        self.bookmarks.setdefault(self.name(stream), {}).update(values)

    def clear(self, stream: Stream, *keys: str) -> None:
        for k in keys:
            self.bookmarks.get(self.name(stream), {}).pop(k, None)

    def reset(self, stream: Stream) -> None:
        self.bookmarks.pop(self.name(stream), None)

    def trim(self, stream: Stream) -> None:
        """Keeps only what the stream's method uses; a log stream may still be in its first snapshot."""
        allowed = BOOKMARK_KEYS[stream.method] | (BOOKMARK_KEYS["FULL_TABLE"] if stream.method == "LOG_BASED" else set())
        self.bookmarks[self.name(stream)] = {k: v for k, v in self.bookmarks.get(self.name(stream), {}).items() if k in allowed}

    def needs_snapshot(self, stream: Stream) -> bool:
        """A log stream without a position, or with a snapshot under way."""
        pending = self.get(stream, "max_pk_values") or self.get(stream, "last_pk_fetched")
        return stream.method == "LOG_BASED" and (self.get(stream, "log_pos") is None or bool(pending))


@dataclass
class Plan:
    snapshots: list[Stream]
    incremental: list[Stream]
    from_log: list[Stream]


def route(streams: Iterable[Stream], state: State) -> Plan:
    """What to do with each stream, decided before anything is read: a table whose snapshot runs now gets its first log
    events in the next run. The stream that was interrupted comes first, then those that were never read."""

    def rank(s: Stream) -> int:
        return 0 if State.name(s) == state.syncing else 1 if State.name(s) not in state.bookmarks else 2

    ordered = sorted(streams, key=rank)
    for s in ordered:
        s.check()
    return Plan(
        [s for s in ordered if s.method == "FULL_TABLE" or state.needs_snapshot(s)],
        [s for s in ordered if s.method == "INCREMENTAL"],
        [s for s in ordered if s.method == "LOG_BASED" and not state.needs_snapshot(s)],
    )
