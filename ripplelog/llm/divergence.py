"""How far the word use of each source lies from that of the other sources of its language, in exact whole numbers.

A group is the documents of one language and source. With p and q the smoothed shares of a term in two groups, in parts of
SCALE, their distance is the sum of floor((p - q)^2 / (p + q)) over all kept terms of the language. Most of the terms occur
in neither of two groups or in one of them alone, so the sum is taken over supports:

* constants: every kept term counts as one that neither group has;
* one-sided terms: a group's terms are priced against another group's share of a term it doesn't have. That depends on the
  count alone, so a histogram of the group's counts is enough, whatever the number of terms;
* overlaps: a term that both have has been priced twice from one side, and once as had by neither. The postings of its
  groups are joined, and each pair of them corrects its sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplelog.llm.common import release, stage
from ripplelog.llm.words import slices

SCALE = 1_000_000_000
SLICE_BYTES, HELD_ROWS = 2 << 20, 400_000
COUNTS = "lang string, source string, term string, n long, docs long"
COUNTS_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

_BYTES = np.arange(256)
_CAPITAL = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
#: Bytes of terms: letters of ASCII, and all of longer characters.
_LETTER = _CAPITAL | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_LOWER = np.where(_CAPITAL, _BYTES + 32, _BYTES).astype(np.uint8)


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, A-Z in lower case, and for each the number of its text. Terms don't cross texts."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    letter = np.concatenate([_LETTER[data], [False]])
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    begins[ends[:-1]] = letter[ends[:-1]]
    starts = np.flatnonzero(begins)
    offsets = np.concatenate([np.cumsum(letter)[starts] - 1, [np.count_nonzero(letter)]]).astype(np.int64)
    kept = _LOWER[data[letter[:-1]]]
    terms = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return terms, np.searchsorted(ends, starts, side="right") - 1


def _counts(x: pa.RecordBatch) -> pa.Table:
    """COUNTS of a few documents; a group's row without a term says that the group is there."""
    groups = pa.table({"lang": x.column("lang"), "source": x.column("source")})
    numbered = groups.group_by(["lang", "source"]).aggregate([]).append_column("g", pa.array(range(groups.group_by(["lang", "source"]).aggregate([]).num_rows)))
    of = {(r["lang"], r["source"]): r["g"] for r in numbered.to_pylist()}
    group = np.array([of[p] for p in zip(x.column("lang").to_pylist(), x.column("source").to_pylist(), strict=True)], np.int64)
    terms, doc = split_terms(x.column("text"))
    coded = terms.dictionary_encode()
    width = max(1, len(coded.dictionary))
    of_docs, n = np.unique(doc * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    keys, at = np.unique(group[of_docs // width] * width + of_docs % width, return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, n)
    named, term = numbered.take(pa.array(keys // width)), coded.dictionary.take(pa.array(keys % width)).cast(pa.string())
    nothing, none = pa.array(np.zeros(len(of), np.int64)), pa.nulls(len(of), pa.string())
    return pa.concat_tables(
        [
            pa.table([named.column("lang"), named.column("source"), term, pa.array(sums), pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64))], schema=COUNTS_SCHEMA),
            pa.table([numbered.column("lang"), numbered.column("source"), none, nothing, nothing], schema=COUNTS_SCHEMA),
        ]
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """COUNTS of what each task reads, added up until HELD_ROWS different rows are there: occurrences and documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def added() -> pa.Table:
            sums = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            return sums.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(COUNTS_SCHEMA.names).cast(COUNTS_SCHEMA)

        for whole in batches:
            for x in slices(whole, "text", SLICE_BYTES):
                held.append(_counts(x))
                if sum(map(len, held)) > 2 * HELD_ROWS:
                    held = [added()]
                    if len(held[0]) > HELD_ROWS:
                        yield from held.pop().combine_chunks().to_batches()
            release()
        if held:
            yield from added().combine_chunks().to_batches()

    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(counted, COUNTS)


def _share(n: str, of: str, terms: str) -> str:
    """p of a term that occurs n times among `of`. The product outgrows a long where a language has 1e10 words."""
    return f"(1 + (CAST({n} + 2 AS DECIMAL(20, 0)) * {SCALE}BD) div CAST(nullif({of} + 2 * {terms}, 0) AS DECIMAL(20, 0)))"


def _apart(p: str, q: str) -> str:
    return f"((({p} - {q}) * ({p} - {q})) div ({p} + {q}))"


def divergences(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """The distances between the sources of each language, and the terms that set each source apart from its language.

    docs: text, lang and source; other columns are not read. Null is '' in all three, so that null and '' are one language
    or source. Every row is a document of its own, also where rows are repeated. A language keeps the terms in at least
    `least_docs` of its documents. Returns lang, source, part, item, value and rank (from 1, the largest value first, ties
    by item in the order of UTF-8 bytes): in part `pair` the item is each other source of the language and the value their
    distance (0 where no term is kept); in part `term` it is each kept term of the source whose share is larger there than
    in the language, with what it adds to the distance from the language, up to rank `top`. A source without kept terms has
    pairs only, the only source of a language has terms only; an empty table gives no rows.

    Words are added up in each task before one shuffle by language and term; a term has a row for each source there. What
    is joined by language alone, the histograms, meets a table of one row for each language and source, which Spark sends
    to all tasks if it is small. Pairs of sources are the result; pairs of postings are added up before they are shuffled.
    """
    key = Window.partitionBy("lang", "term")
    sums = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    sums = sums.withColumns({"lang_n": F.sum("n").over(key), "lang_docs": F.sum("docs").over(key), "first": F.row_number().over(key.orderBy("source")) == 1})
    kept = stage(sums.where(F.col("term").isNull() | (F.col("lang_docs") >= least_docs)).select("lang", "term", "source", "n", "lang_n", "first"))

    real = F.col("term").isNotNull()
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(real & F.col("first")).alias("first"))
    lang = Window.partitionBy("lang")
    groups = groups.withColumns({"terms": F.sum("first").over(lang), "lang_total": F.sum("total").over(lang)}).drop("first")
    groups = stage(groups.withColumn("p0", F.expr(_share("0", "total", "terms"))))

    priced = kept.where(real).join(groups, ["lang", "source"])
    own = priced.withColumns({"p": F.expr(_share("n", "total", "terms")), "q": F.expr(_share("lang_n", "lang_total", "terms"))})
    a, b, on = own.alias("a"), own.alias("b"), "a.lang = b.lang AND a.source < b.source"
    pair = [F.col("a.lang").alias("lang"), F.col("a.source").alias("x"), F.col("b.source").alias("y")]
    both = a.join(b, F.expr(f"{on} AND a.term = b.term"))
    neither = _apart("a.p0", "b.p0")
    overlaps = both.select(*pair, F.expr(f"{_apart('a.p', 'b.p')} - {_apart('a.p', 'b.p0')} - {_apart('a.p0', 'b.p')} + {neither}").alias("value"))

    histogram = kept.where(real).groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("k")).join(groups, ["lang", "source"])
    histogram = histogram.withColumn("p", F.expr(_share("n", "total", "terms")))
    met = histogram.alias("a").join(groups.alias("b"), F.expr("a.lang = b.lang AND a.source <> b.source"))
    sided = met.select(F.col("a.lang"), F.least("a.source", "b.source").alias("x"), F.greatest("a.source", "b.source").alias("y"), F.expr(f"a.k * ({_apart('a.p', 'b.p0')} - {neither})").alias("value"))

    all_pairs = groups.alias("a").join(groups.alias("b"), F.expr(on))
    constants = all_pairs.select(*pair, F.expr(f"coalesce(a.terms * {neither}, 0L)").alias("value"))

    added = [part.groupBy("lang", "x", "y").agg(F.sum("value").alias("value")) for part in (overlaps, sided)]
    distance = added[0].union(added[1]).union(constants).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
    either = F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item"))))
    pairs = distance.select("lang", either.alias("_s"), "value").select("lang", "_s.source", F.lit("pair").alias("part"), "_s.item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = own.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
    return pairs.withColumn("rank", place).union(terms.withColumn("rank", place).where(F.col("rank") <= top))
