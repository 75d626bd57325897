"""The newest rows of each key along a stream, by a state that holds how far each key has got."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keys' states are in RocksDB: on the executors' disks and in the checkpoint, not in memory.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
PLACE = T.StructType([T.StructField("file_no", T.LongType()), T.StructField("log_pos", T.LongType()), T.StructField("row_idx", T.DoubleType())])


class Newest(StatefulProcessor):
    """Gives on the last row of a key in a batch if it stands behind all that the key had before."""

    def __init__(self, at: str, columns: list[str]):
        self.at, self.row = at, Row(*columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", PLACE)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        best = place = None
        for r in rows:
            this = tuple(r[self.at][c] for c in PLACE.names)
            if place is None or this > place:
                best, place = r, this
        if not self.place.exists() or place > tuple(self.place.get()):
            self.place.update(place)
            yield self.row(*[best[c] for c in self.row])

    def close(self) -> None:
        pass


def place(log_file: str = "log_file", log_pos: str = "log_pos", row_idx: str = "row_idx") -> Column:
    """A row's place in its log as the state holds it; logs without numbers in their files' names come first."""
    from ripplelog.operators.changelog import file_number

    return F.struct(F.coalesce(file_number(F.col(log_file)), F.lit(-1)).alias("file_no"), F.coalesce(F.col(log_pos).cast("long"), F.lit(-1)).alias("log_pos"), F.coalesce(F.col(row_idx).cast("double"), F.lit(0.0)).alias("row_idx"))


def newest(rows: DataFrame, key: Iterable[str], at: str = "_place") -> DataFrame:
    """Of a stream's rows those that are news: in each batch the last row of a key, if it is behind what the key has had.

    `at` names the column with place(). Rows that come again, and rows that come late, give nothing, so a target that takes
    each row in place of its key's never goes back, and needn't be read to find out. The state is one place for each key."""
    key = list(key)
    return rows.groupBy(*key).transformWithState(Newest(at, rows.columns), rows.schema, "Update", "None")
