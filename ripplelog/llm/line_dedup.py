"""Line deduplication with DataFrame functions alone.

Lines are exploded with their positions and normalised; a line's 128-bit hash stands for it in the two shuffles that
count documents and find the lines to drop. Texts move once, to meet the positions that they lose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.common import SPACES, ascii_lower, col, stage


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Drops long lines that many documents share, except in the largest doc_id that holds them.

    A line's key is the line without white space at its ends and with A-Z in lower case. Keys of at least `min_chars`
    code points in at least `min_docs` documents lose all their lines but those of the largest doc_id.

    Returns the rows of `docs` with `text` reassembled from the lines that stay, in order, and n_lines (before) and
    n_dropped. All other columns are kept; columns already called n_lines or n_dropped are replaced.
    Null and empty texts are one empty line and come out empty. Rows with a null doc_id count as one document that is
    smaller than any other. Rows that share a doc_id count as one document, and each row is reassembled by itself.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = F.coalesce(col(text), F.lit(""))
    base = docs.select(col(doc_id).alias("_id"), whole.alias("_text"), F.xxhash64(whole).alias("_row"))

    line = F.btrim(F.col("_line"), F.lit(SPACES))
    occurrences = (
        base.select("_id", "_row", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
        .where(F.char_length("_line") >= min_chars)
        .withColumn("_key", ascii_lower(line))
        .where(F.char_length("_key") >= min_chars)
        .select("_id", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    # grouped by key and document first, so that no task gets all rows of a common line; written, so that the join below
    # stands on two exchanges, of which the adaptive skew join can split a common line's part, or broadcasts few rows
    shared = stage(
        occurrences.select("_h1", "_h2", "_id").distinct()
        .groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last"))
        .where(F.col("_docs") >= min_docs)
        .select("_h1", "_h2", "_last")
    )
    lost = (
        occurrences.join(shared, ["_h1", "_h2"])
        .where(~F.col("_id").eqNullSafe(F.col("_last")))
        .groupBy("_id", "_row").agg(F.collect_set("_pos").alias("_lost"))
        .withColumnRenamed("_id", "_lost_id").withColumnRenamed("_row", "_lost_row")
    )

    # split before the join: the lambda below then reads an array and doesn't split anew for each line
    # the columns travel in a struct, so that their names don't matter
    it = F.struct(F.lit(0).alias("_"), *[col(c) for c in names if c != text]).alias("_it")
    rows = docs.select(it, col(doc_id).alias("_id"), F.split(whole, "\n", -1).alias("_lines"), F.xxhash64(whole).alias("_row"))
    joined = rows.join(lost, F.col("_id").eqNullSafe(F.col("_lost_id")) & (F.col("_row") == F.col("_lost_row")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_lost"))
    kept = F.when(F.col("_lost").isNull(), F.col("_lines")).otherwise(F.transform(stay, lambda i: F.get(F.col("_lines"), i)))
    return joined.select(
        *[F.array_join(kept, "\n").alias(c) if c == text else F.col("_it")[c].alias(c) for c in names],
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
