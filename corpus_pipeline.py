"""From raw documents to token ids, in five stages. Each one is written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ripplelog.llm.byte_bpe import Vocabulary, decode, encode
from ripplelog.llm.common import col, stage
from ripplelog.llm.language_id import UNKNOWN, identify_language
from ripplelog.llm.line_dedup import drop_repeated_lines
from ripplelog.llm.mixing import mixed_documents
from ripplelog.llm.ngram_join import jaccard_components

#: A text is rejected if no language's classifier comes closer to yes than this.
LEAST_SCORE = 0.3


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang, and all columns but the text as one, so that no name of theirs meets an operator's own."""
    return docs.select(F.struct(*[col(c) for c in docs.columns if c != "text"]).alias("_rest"), "doc_id", "text", "lang")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, with the text of `rows` and its length."""
    size = {c: F.char_length("text").cast(docs.schema[c].dataType) for c in docs.columns if c == "n_chars"}
    return rows.select(*[F.col("text") if c == "text" else size.get(c, F.col("_rest")[c]).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, and those in none of the languages that the labelled documents are in.

    Null and empty texts have no letters and go, as does everything if no document has a label and letters. Each row is
    judged by its text alone, so repeated rows stay or go together; all columns stay as they are.
    """
    judged = identify_language(_packed(docs)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return judged.select(*[F.col("text") if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes long lines that many documents share out of all but the one with the largest doc_id.

    No row goes. A null text is one empty line and becomes an empty text; rows that share a doc_id are one document in the
    count, a null doc_id is one of its own. n_chars follows the text, all other columns stay.
    """
    return _unpacked(drop_repeated_lines(_packed(docs)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates (five-word shingles, similarity 0.8) the document of the smallest doc_id.

    Rows that share a doc_id are one document: where it stays, each of its different texts stays once, from the row that is
    first in the order of all columns. Texts without words are like nothing and stay, as do rows without a doc_id.
    """
    found = jaccard_components(docs, n=5, percent=80)
    heads = found.where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("_it"), "doc_id", F.xxhash64("text").alias("_text"))
    same = Window.partitionBy("doc_id", "_text").orderBy(F.xxhash64(F.col("_it").cast("string")))
    named = rows.join(heads, "doc_id", "left_semi").withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return named.select("_it").union(rows.where("doc_id IS NULL").select("_it")).select(*[F.col("_it")[c].alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sources to their target weights: a row for each time that words of a document are taken.

    Texts without words are never taken. A null source is one of its own. Repeated rows are documents of their own.
    """
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text again. Null and empty texts have no ids."""
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = decode(encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, public_tokenizers.PATTERN), vocabulary)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return decoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
