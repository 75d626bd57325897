"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that separates words and is stripped from line ends: 0x20 and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: One word, for Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the warehouse where it is unset. A warehouse that
    is a folder of the driver's machine will do for a local session only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir")
        if path.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset, and the warehouse is a folder of one machine")
    return path.rstrip("/")


def col(name: str) -> Column:
    """The column of that very name, whatever marks are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def stage_path(spark: SparkSession) -> str:
    """A new folder in the shared one, which goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    path = stage_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives memory that was freed back to the system: Python workers live on, and what one step has freed would count
    beside what the next one takes."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only. lower() does that by bytes where the string is all ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: one narrow scan and a sum."""
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def parts_for(n_bytes: int, each: int, least: int = 1) -> int:
    """How many parts of about `each` bytes; follows the size of the data without a cap."""
    return max(least, -(-n_bytes // each))


def few_of_each(rows: DataFrame, kind: str, each: int) -> DataFrame:
    """Up to `each` different texts (column text) of every value of `kind`, those with the smallest hashes (column h).

    A threshold on the hash, from the number of different hashes, leaves about three times as many before any is moved,
    however many rows and copies a value has. For columns with few values: the numbers go through the driver.
    """
    numbers = {r[kind]: r["n"] for r in rows.groupBy(kind).agg(F.approx_count_distinct("h").alias("n")).collect()}
    share, low = F.abs(F.col("h") / F.lit(2.0**63)), F.lit(False)
    for value, n in numbers.items():
        low = low | ((share * n <= 3 * each + 30) & F.col(kind).eqNullSafe(F.lit(value)))  # in this order: the kind may be dear to tell
    single = rows.where(low).groupBy(kind, "h").agg(F.min("text").alias("text"))
    ranked = single.withColumn("rank", F.row_number().over(Window.partitionBy(kind).orderBy("h")))
    return ranked.where(F.col("rank") <= each)


def unused(columns: list[str], name: str) -> str:
    """`name`, with as many marks as it takes to be no column's name."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name
