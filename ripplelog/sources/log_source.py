"""Staged change logs as a data source: spark.read and spark.readStream, with offsets that are positions in the log."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "staged_log"
FOLDER = "log_file="


@dataclass
class Stretch(InputPartition):
    """A part of one staged file: what stands from a position on and before another; None is the file's end."""

    log_file: str
    path: str
    start: int
    stop: int | None


def number_of(log_file: str) -> int:
    found = re.search(r"(\d+)$", log_file)
    if found is None:
        raise ValueError(f"no number at the end of the log file's name {log_file!r}")
    return int(found[1])


class StagedLog:
    """Log files as folders log_file=<name> of Parquet files with log_pos, as Spark writes them; files are in the order of
    the numbers at the end of their names. Paths are what Arrow can open: local ones, hdfs:// and s3://."""

    def __init__(self, options: dict):
        self.path, self.schema = options["path"], None
        self.start = self._position(options, "start")
        self.end = self._position(options, "end")

    @staticmethod
    def _position(options: dict, which: str) -> tuple[str, int] | None:
        name = options.get(f"{which}_file")
        return None if name is None else (name, int(options.get(f"{which}_pos", 0)))

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path and not self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), "/" + self.path.removeprefix("file:").lstrip("/")

    def files(self) -> dict[str, list[str]]:
        """The staged files of each log file, log files in order."""
        system, root = self._open()
        found: dict[str, list[str]] = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            folder = info.path.rpartition("/")[0].rpartition("/")[2]
            if info.is_file and folder.startswith(FOLDER) and info.path.endswith(".parquet"):
                found.setdefault(folder.removeprefix(FOLDER), []).append(info.path)
        return {name: sorted(found[name]) for name in sorted(found, key=number_of)}

    def last_position(self, paths: list[str]) -> int:
        """Behind the last event of a log file, from the files' statistics."""
        system, _ = self._open()
        last = -1
        for path in paths:
            with system.open_input_file(path) as f:
                for stats in _statistics(pq.ParquetFile(f)):
                    if stats is None:
                        raise ValueError(f"{path} has no statistics of log_pos")
                    last = max(last, stats.max)
        return last + 1

    def latest(self) -> tuple[str, int] | None:
        """The end that was asked for, or the end of the last file; the earlier of both."""
        files = self.files()
        if not files:
            return self.end
        name = list(files)[-1]
        now = (name, self.last_position(files[name]))
        return now if self.end is None else min(now, self.end, key=lambda p: (number_of(p[0]), p[1]))

    def stretches(self, start: tuple[str, int] | None, end: tuple[str, int] | None) -> list[Stretch]:
        """What is to be read between two positions: the rest of the first file, whole files, the beginning of the last."""
        out = []
        for name, paths in self.files().items():
            no = number_of(name)
            if (start and no < number_of(start[0])) or (end and no > number_of(end[0])):
                continue
            low = start[1] if start and no == number_of(start[0]) else 0
            high = end[1] if end and no == number_of(end[0]) else None
            out += [Stretch(name, p, low, high) for p in paths if high is None or high > low]
        return out

    def rows(self, part: Stretch, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A stretch in batches. Row groups that lie outside it are not read."""
        system, _ = self._open()
        with system.open_input_file(part.path) as f:
            file = pq.ParquetFile(f)
            groups = [i for i, s in enumerate(_statistics(file)) if s is None or (s.max >= part.start and (part.stop is None or s.min < part.stop))]
            have = set(file.schema_arrow.names)
            for x in file.iter_batches(row_groups=groups, columns=[n for n in schema.names if n in have]):
                keep = pc.greater_equal(x.column("log_pos"), part.start)
                keep = keep if part.stop is None else pc.and_(keep, pc.less(x.column("log_pos"), part.stop))
                x = x.filter(keep)
                if len(x):
                    columns = [pa.array([part.log_file] * len(x), f.type) if f.name == "log_file" else x.column(f.name).cast(f.type) if f.name in have else pa.nulls(len(x), f.type) for f in schema]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _statistics(file: pq.ParquetFile) -> Iterator[pq.Statistics | None]:
    """The statistics of log_pos in each row group, where there are any."""
    for i in range(file.metadata.num_row_groups):
        group = file.metadata.row_group(i)
        found = next((c.statistics for c in map(group.column, range(group.num_columns)) if c.path_in_schema == "log_pos"), None)
        yield found if found is not None and found.has_min_max else None


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Batch(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.log = schema, StagedLog(options)

    def partitions(self) -> list[Stretch]:
        return self.log.stretches(self.log.start, self.log.end) or [Stretch("", "", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from self.log.rows(partition, _arrow(self.schema))


class _Stream(DataSourceStreamReader):
    """Offsets are {log_file, log_pos}: the next event to read. A batch goes up to what is there, or to the end asked for."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.log = schema, StagedLog(options)

    @staticmethod
    def _offset(place: tuple[str, int]) -> dict:
        return {"log_file": place[0], "log_pos": place[1]}

    def initialOffset(self) -> dict:
        if self.log.start is None:
            files = self.log.files()
            if not files:
                raise ValueError(f"no log files in {self.log.path}, and no start_file")
            return self._offset((next(iter(files)), 0))
        return self._offset(self.log.start)

    def latestOffset(self) -> dict:
        return self._offset(self.log.latest() or self.log.start)

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        a, b = ((x["log_file"], x["log_pos"]) for x in (start, end))
        if (number_of(b[0]), b[1]) <= (number_of(a[0]), a[1]):  # an end before what was read already
            return [Stretch("", "", 0, 0)]
        return self.log.stretches(a, b) or [Stretch("", "", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from self.log.rows(partition, _arrow(self.schema))

    def commit(self, end: dict) -> None:
        """Spark's checkpoint has the offsets; nothing is kept beside it."""


class StagedLogSource(DataSource):
    """format("staged_log"): options path, start_file and start_pos (the first event, by default the first there is),
    end_file and end_pos (behind the last one, by default what is there). A schema has to be given; columns that a staged
    file doesn't have are null, as files of before a column was added are."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("a staged log is read with a given schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StagedLogSource)


def options(path: str, start: tuple[str, int] | None = None, end: tuple[str, int] | None = None) -> dict[str, str]:
    out = {"path": path}
    for which, place in (("start", start), ("end", end)):
        if place is not None:
            out |= {f"{which}_file": place[0], f"{which}_pos": str(place[1])}
    return out
