"""Column layouts as they change along a log."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass, replace
from itertools import groupby, islice

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplelog.functions.ddl import Change
from ripplelog.operators.changelog import BROADCAST, file_number, small


class LayoutError(Exception):
    """The layout and the statement don't fit: the log and the layout are not of the same time."""


@dataclass(frozen=True)
class Column:
    name: str
    column_type: str
    key: str = ""
    charset: str | None = None
    collation: str | None = None


Layout = tuple[Column, ...]


class _Place:
    """A column's place in its table: it has the same neighbours as long as it is there."""

    __slots__ = ("column", "since", "until", "next")

    def __init__(self, column: Column | None, since: int):
        self.column, self.since, self.until, self.next = column, since, None, None


class Evolving:
    """A table's columns along its statements. Columns never change places with each other, so all that ever were are one
    list in order, each with the versions from and up to which it is there: space and time follow the statements."""

    def __init__(self, table: str, layout: Iterable[Column]):
        self.table, self.version, self.head = table, 0, _Place(None, 0)
        self.last, self.live = self.head, {}
        for c in layout:
            self._insert(self.last, c)

    def _insert(self, before: _Place, column: Column) -> None:
        new = _Place(column, self.version)
        new.next, before.next = before.next, new
        if before is self.last:
            self.last = new
        self.live.setdefault(column.name.upper(), new)

    def drop(self, change: Change) -> None:
        place = self.live.pop(change.column_name.upper(), None)
        if place is None:
            raise LayoutError(f"{change.table_name}: column {change.column_name} is to be dropped but isn't there")
        place.until = self.version

    def add(self, change: Change, server: dict[str, Column]) -> None:
        """The column first, behind another, or last. The server's present definition is taken if it has the column, else
        what the statement says. A column that is already there stays as it is."""
        if not self.live:
            raise LayoutError(f"{change.table_name}: there is no layout to add {change.column_name} to")
        name = change.column_name.upper()
        if name in self.live:
            return
        said = Column(name, (change.data_type or "").lower(), change.column_key or "", change.charset_name, change.collation)
        new = replace(server.get(name, said), name=name)
        if change.first_position:
            self._insert(self.head, new)
        elif change.after_column is None:
            self._insert(self.last, new)
        elif (place := self.live.get(change.after_column.upper())) is None:
            raise LayoutError(f"{change.table_name}: {change.column_name} is to follow {change.after_column}, which isn't there")
        else:
            self._insert(place, new)

    def apply(self, changes: Iterable[Change], server: dict[str, Column]) -> None:
        """One statement, and so the next version."""
        self.version += 1
        for c in changes:
            if c.type == "DROP":
                self.drop(c)
            else:
                self.add(c, server)

    def places(self) -> Iterator[_Place]:
        place = self.head.next
        while place is not None:
            yield place
            place = place.next


def apply(layout: Layout, changes: Iterable[Change], server: Layout = ()) -> Layout:
    """The layout after a statement."""
    table = Evolving("", layout)
    table.apply(changes, {c.name.upper(): c for c in server})
    return tuple(p.column for p in table.places() if p.until is None)


#: A row for each version (place is null), and one for each column with the versions from which and up to which it is there.
HISTORY = "schema_name string, table_name string, version int, log_file string, log_pos long, until int, place int, name string, column_type string, key string, charset string, collation string"
#: Up to so many tables and changes are read to the driver and folded there.
FOLDED = 500
#: One row for each version with all its columns.
LAYOUTS = "schema_name string, table_name string, version int, columns array<string>, layout array<struct<name: string, column_type: string, key: string, charset: string, collation: string>>"


def first_layouts(catalogue: DataFrame) -> DataFrame:
    """schema_name, table_name and layout of every table of a catalogue (see sources.server.catalogue)."""
    null = F.lit(None).cast("string")

    def column(c):
        return F.struct(c["column_name"].alias("name"), c["column_type"].alias("column_type"), F.coalesce(c["column_key"], F.lit("")).alias("key"), null.alias("charset"), null.alias("collation"))

    return catalogue.select("schema_name", "table_name", F.transform("columns", column).alias("layout"))


def history(start: DataFrame, changes: DataFrame, server: DataFrame | None = None) -> DataFrame:
    """What every table of `start` looked like, as HISTORY: version 0 at log_pos -1, and a further one after each statement,
    in log order; a column is a row, however many versions it is in. layouts() has whole layouts.

    start: schema_name, table_name and layout; changes: what column_changes finds in DDL events with log_file, log_pos and
    row_idx. server: present layouts; tables that `start` doesn't know begin with theirs, and columns that a statement adds
    are defined by theirs. Statements on tables that neither knows are left out. A task folds its tables one after the other as
    their rows come, by table and position, so that many small tables cost no more than their rows; up to FOLDED tables and
    statements are folded here, without tasks.
    """
    key = [F.lower("schema_name").alias("s"), F.lower("table_name").alias("t")]
    first = start.select(*key, "schema_name", "table_name", "layout", F.lit(0).alias("rank"))
    if server is not None:
        first = first.union(server.select(*key, "schema_name", "table_name", "layout", F.lit(1).alias("rank")))
    placed = [F.lit(_SAID).alias("rank"), F.coalesce(file_number(F.col("log_file")), F.lit(-1)).alias("no"), "log_file", "log_pos", F.col("row_idx").cast("double").alias("row_idx"), F.col("change.n").alias("n")]
    said = changes.select(F.lower("change.schema_name").alias("s"), F.lower("change.table_name").alias("t"), *placed, F.col("change").dropFields("n", "query").alias("change"))

    few = first.limit(FOLDED + 1).collect()
    if len(few) <= FOLDED and len(some := said.limit(FOLDED + 1).collect()) <= FOLDED:
        of: dict[tuple, tuple[list, list]] = {}
        for rows, side in ((few, 0), (some, 1)):
            for r in rows:
                of.setdefault((r.s, r.t), ([], []))[side].append(r.asDict(True))
        return start.sparkSession.createDataFrame([row for left, right in of.values() for row in _folded(sorted(left, key=lambda r: r["rank"]), sorted(right, key=lambda r: (*_place(r), r["n"])))], HISTORY)

    def fold(batches):
        import pyarrow as pa

        out = _folded_in_turn(r for b in batches for r in b.to_pylist())
        while some := list(islice(out, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some, strict=True), kinds, strict=True)], names=fields)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(HISTORY))
    fields, kinds = schema.names, schema.types
    every = first.unionByName(said, allowMissingColumns=True).repartition("s", "t")
    return every.sortWithinPartitions("s", "t", "rank", "no", "log_file", "log_pos", "row_idx", "n").mapInArrow(fold, HISTORY)


#: The rank of statements, behind the layouts of `start` and of `server`.
_SAID = 2


def _place(r: dict) -> tuple:
    return r["no"], r["log_file"], r["log_pos"], r["row_idx"]


def _folded_in_turn(rows: Iterable[dict]) -> Iterator[tuple]:
    """HISTORY of tables that come one after the other, each with its layouts before its statements."""
    for _, of in groupby(rows, key=lambda r: (r["s"], r["t"])):
        known: list[dict] = []
        for is_said, side in groupby(of, key=lambda r: r["rank"] == _SAID):
            if is_said:
                yield from _folded(known, side)
                break
            known = list(side)
        else:
            yield from _folded(known, ())


def _folded(known: list[dict], said: Iterable[dict]) -> Iterator[tuple]:
    """HISTORY of one table: its layouts by rank, and what is said about it in the order of the log."""
    if known:
        named = known[0]["schema_name"], known[0]["table_name"]
        table = Evolving(named[1], [Column(**c) for c in known[0]["layout"]])
        now = {c["name"].upper(): Column(**c) for c in known[-1]["layout"]} if known[-1]["rank"] else {}
        yield (*named, 0, None, -1, *[None] * 7)
        for (_, log_file, log_pos, _), rows in groupby(said, key=_place):
            table.apply([Change(**r["change"], query="") for r in rows], now)
            yield (*named, table.version, log_file, log_pos, *[None] * 7)
        for i, p in enumerate(table.places()):
            yield (*named, p.since, None, None, p.until, i, *astuple(p.column))


def versions(held: DataFrame) -> DataFrame:
    """schema_name, table_name, version, log_file and log_pos of a HISTORY: where each version begins."""
    return held.where("place IS NULL").select("schema_name", "table_name", "version", "log_file", "log_pos")


def layouts(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """LAYOUTS of the versions in `wanted` (schema_name, table_name, version; its other columns stay), a row for each of its rows.

    A table's columns are brought together once, and each version takes from them those that it has, in the task that writes
    its row: what is shuffled and sorted follows the statements, not the layouts, which are as many times longer as a
    table has versions.
    """
    key, c = ["schema_name", "table_name"], F.col
    one = F.struct("place", c("version").alias("since"), "until", F.struct("name", "column_type", "key", "charset", "collation").alias("it"))
    columns = held.where("place IS NOT NULL").groupBy(*key).agg(F.array_sort(F.collect_list(one)).alias("_of"))
    there = lambda x: (c("version") >= x["since"]) & (x["until"].isNull() | (c("version") < x["until"]))
    found = wanted.join(columns, key, "left").withColumn("_of", F.coalesce(F.filter("_of", there), F.array()))
    return found.select(*wanted.columns, F.transform("_of", lambda x: x["it"]["name"]).alias("columns"), F.transform("_of", lambda x: x["it"]).alias("layout"))


#: A table with more versions than this is not compared with each of its events.
COMPARED = 100
#: Of so many versions all layouts are made, without looking which ones are met.
WHOLE = 1_000


def as_of(events: DataFrame, held: DataFrame, window: bool | None = None) -> DataFrame:
    """events with the version of the layout (HISTORY) that held at their position; null for tables without one.

    Each version holds from its position up to the next one's, so that every event finds one. A statement's own position
    still has the layout before it. Short histories are broadcast and joined by range. Where there are many versions in all
    or of a table, and with window=True, events and versions are put in order instead, see as_of_by_window.
    """
    begins = versions(held)
    if window is None:
        counts = begins.groupBy("schema_name", "table_name").count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
        window = (counts["n"] or 0) > BROADCAST or (counts["most"] or 0) > COMPARED
    if window:
        return as_of_by_window(events, begins)
    w = Window.partitionBy("schema_name", "table_name").orderBy("version")
    at = F.struct(_number().alias("no"), F.col("log_pos").alias("pos"))
    begins = F.broadcast(begins.select("schema_name", "table_name", "version", at.alias("_from")).withColumn("_to", F.lead("_from").over(w))).alias("h")
    e, c = events.withColumn("_at", at).alias("e"), F.col
    on = (c("e.schema_name") == c("h.schema_name")) & (c("e.table_name") == c("h.table_name")) & (c("e._at") > c("h._from")) & (c("h._to").isNull() | (c("e._at") <= c("h._to")))
    return e.join(begins, on, "left").select(*[c(f"e.`{n}`") for n in events.columns], "h.version")


def _number() -> Col:
    return F.coalesce(file_number(F.col("log_file")), F.lit(-1))


def as_of_by_window(events: DataFrame, begins: DataFrame) -> DataFrame:
    """as_of for histories of any length: no range join, and no table's events are one task's.

    Events are windows of their own for each table and log file. In a file's window, events and the versions that begin
    there are in order of their position, and each event has the last version before it. The version that a file starts with
    comes from a second window for each table, over its files and versions alone, and is joined by table and file.
    """
    key = ["schema_name", "table_name"]
    names = events.columns
    rows = events.select(*key, _number().alias("_no"), F.col("log_pos").alias("_pos"), F.lit(0).alias("_kind"), F.lit(None).cast("int").alias("_version"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"))
    marks = begins.select(*key, _number().alias("_no"), F.col("log_pos").alias("_pos"), F.lit(1).alias("_kind"), F.col("version").alias("_version"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    before = lambda by, order: F.max("_version").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    files = rows.select(*key, "_no").distinct().select(*key, "_no", F.lit(0).alias("_kind"), F.lit(None).cast("int").alias("_version"))
    files = files.union(marks.select(*key, "_no", "_kind", "_version")).withColumn("_first", before(key, ["_no", "_kind", "_version"])).where("_kind = 0").select(*key, "_no", "_first")
    placed = rows.union(marks).withColumn("_version", before([*key, "_no"], ["_pos", "_kind", "_version"])).where("_kind = 0")
    met = placed.join(files, [*key, "_no"])
    return met.select(*[F.col("_row")[n].alias(n) for n in names], F.coalesce("_version", "_first").alias("version"))


def with_columns(placed: DataFrame, held: DataFrame) -> DataFrame:
    """What as_of returns, with the columns of each row's version: of all versions if they are few, else of those met."""
    begins = versions(held)
    wanted = begins if begins.limit(WHOLE + 1).count() <= WHOLE else placed.where("version IS NOT NULL")
    key = ["schema_name", "table_name", "version"]
    found = layouts(held, wanted.select(*key).distinct()).select(*key, "columns")
    return placed.join(small(found), key, "left")


def mismatches(events: DataFrame, held: DataFrame) -> DataFrame:
    """Events that have a value in a column which the table's layout (HISTORY) didn't have at their position: the log and the
    layout are not of the same time. Events of tables without a layout are left out. events: before and after."""
    there = lambda n: F.col(f"after.`{n}`").isNotNull() | F.col(f"before.`{n}`").isNotNull()
    return _mismatches(events, F.array_compact(F.array(*[F.when(there(n), n.upper()) for n in events.schema["after"].dataType.names])), held)


def read_mismatches(read: DataFrame, held: DataFrame) -> DataFrame:
    """mismatches of a table's rows as operators.fanout has read them: image, and the names of columns in the one before."""
    now = F.array_compact(F.array(*[F.when(F.col(f"image.`{n}`").isNotNull(), n.upper()) for n in read.schema["image"].dataType.names]))
    return _mismatches(read, F.array_union(now, F.transform("_also", F.upper)), held)


def _mismatches(events: DataFrame, filled: Col, held: DataFrame) -> DataFrame:
    kept = with_columns(as_of(events.withColumn("_filled", filled), held), held).where("columns IS NOT NULL")
    return kept.where(F.size(F.array_except("_filled", F.transform("columns", F.upper))) > 0).select(*events.columns, "version")


def schema_changes(changes: DataFrame) -> DataFrame:
    """The audit table of column changes, each once by column, statement and time."""
    flat = changes.select(
        F.col("change.schema_name").alias("schema"), F.col("change.table_name").alias("table"), F.concat(F.col("change.type"), F.lit("_COLUMN")).alias("change_type"),
        F.col("change.column_name").alias("column_name"), F.col("change.query").alias("query"), F.timestamp_seconds("ts_s").alias("timestamp"),
    )
    return flat.dropDuplicates(["column_name", "query", "timestamp"])


def grown(stored: Iterable[str], seen: Iterable[str]) -> list[str]:
    """Storage columns only grow: those there are, then new ones as they were first seen, in upper case."""
    return list(dict.fromkeys(c.upper() for c in (*stored, *seen)))


def in_storage_order(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The columns in the given order, null where the rows don't have them; names match in any case."""
    have = {c.upper(): c for c in rows.columns}
    return rows.select(*[F.col(f"`{have[c.upper()]}`").alias(c) if c.upper() in have else F.lit(None).cast("string").alias(c) for c in columns])


def state_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Paths that were added, changed or removed between two states of (key, value)."""
    o, n = old.select(F.col(key).alias("k"), F.col(value).alias("old_value"), F.lit(True).alias("was")), new.select(F.col(key).alias("k"), F.col(value).alias("new_value"), F.lit(True).alias("is"))
    kind = F.when(F.col("was").isNull(), "Add").when(F.col("is").isNull(), "Remove").when(~F.col("old_value").eqNullSafe(F.col("new_value")), "Change")
    return o.join(n, "k", "full_outer").select(F.col("k").alias(key), kind.alias("kind"), "old_value", "new_value").where("kind IS NOT NULL")
