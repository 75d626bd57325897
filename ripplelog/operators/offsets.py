"""Where to go on in a log."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.operators.changelog import file_number


def log_files(listing: DataFrame) -> DataFrame:
    """log_name and file_size of a listing with an array `logs` of both as text, as a log server returns it."""
    return listing.select(F.explode("logs").alias("l")).select("l.log_name", F.col("l.file_size").cast("long").alias("file_size"))


def first_positions(bookmarks: DataFrame) -> DataFrame:
    """The lowest position that any stream has in each file, and the streams there, of (stream, log_file, log_pos)."""
    return bookmarks.groupBy("log_file").agg(F.min("log_pos").alias("log_pos"), F.array_sort(F.collect_set("stream")).alias("streams"))


def start(bookmarks: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """log_file and log_pos of the earliest bookmark, files by number; only those that the server still has, if given."""
    if files is not None:
        bookmarks = bookmarks.join(files.select(F.col("log_name").alias("log_file")), "log_file", "left_semi")
    least = bookmarks.agg(F.min(F.struct(file_number(F.col("log_file")).alias("no"), "log_file", "log_pos")).alias("m"))
    return least.select("m.log_file", "m.log_pos").where("log_file IS NOT NULL")


def expired(bookmarks: DataFrame, files: DataFrame) -> DataFrame:
    """Files that a stream still needs and the server no longer has."""
    return bookmarks.select("log_file").distinct().join(files.select(F.col("log_name").alias("log_file")), "log_file", "left_anti")


def beyond_end(bookmarks: DataFrame, files: DataFrame) -> DataFrame:
    """Bookmarks behind the end of their file."""
    return bookmarks.join(files, bookmarks["log_file"] == files["log_name"]).where("log_pos > file_size").select("stream", "log_file", "log_pos", "file_size")


def verify(bookmarks: DataFrame, files: DataFrame) -> None:
    """Fails if a needed file has expired or a bookmark stands behind the end of its file."""
    if gone := [r.log_file for r in expired(bookmarks, files).limit(20).collect()]:
        raise ValueError(f"log files are gone, start anew: {sorted(gone)}")
    if wrong := beyond_end(bookmarks, files).limit(20).collect():
        raise ValueError(f"bookmarks stand behind the end of a file: {wrong}")


#: A log staged with this column has its files' numbers, so that positions are filters that reach the scan.
NUMBER = "file_no"


def number(log: DataFrame) -> Column:
    """The number of a row's log file: the stored one, or what its name says."""
    return F.col(NUMBER) if NUMBER in log.columns else file_number(F.col("log_file"))


def number_of(log_file: str) -> int:
    digits = re.search(r"(\d+)$", log_file)
    if digits is None:
        raise ValueError(f"no number at the end of the log file's name {log_file!r}")
    return int(digits[1])


def pending(log: DataFrame, log_file: str, log_pos: int) -> DataFrame:
    """The events of a log from a position on."""
    no = number(log)
    return log.where((no > number_of(log_file)) | ((no == number_of(log_file)) & (F.col("log_pos") >= log_pos)))


def until(log: DataFrame, log_file: str, log_pos: int) -> DataFrame:
    """The events of a log before a position: what stands at it is the next run's."""
    no = number(log)
    return log.where((no < number_of(log_file)) | ((no == number_of(log_file)) & (F.col("log_pos") < log_pos)))


def least(bookmarks: Iterable[tuple[str, int]]) -> tuple[str, int]:
    """The first of (log_file, log_pos), files by number."""
    return min(bookmarks, key=lambda b: (number_of(b[0]), b[1]))
