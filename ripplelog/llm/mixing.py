"""Mixing sources to target weights with fixed-length blocks.

Every source is one stream of words, cut into blocks of a fixed length. Each output shard draws how many of its slots go
to which source, from multinomials that meet the sources' targets as a whole; the slots of a source are numbered through and mapped to block numbers by pseudorandom permutations, a
new one for each pass over the source; a join by block number gives the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.llm.common import WORD, col, parts_for, release, stage
from ripplelog.llm.words import slices

BLOCK = 32  # words
SHARD = 4096  # slots
STRETCH = 256  # shards that are drawn together
CAP = 3  # times that a word may be taken
ROWS_A_BUCKET = 4_096
BATCH_BYTES = 1 << 20


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(n) for each key: four Feistel rounds, walked until they land below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            x = (right + k + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def targets(sized: DataFrame, cap: int = CAP) -> DataFrame:
    """source, source_size and target of every source.

    Sources in the order of their code points, null last, weigh 1, 2, 3 and so on again, and share all words by weight;
    none gets more than `cap` times its size. In the order of size by weight the capped sources come first, so running
    sums tell where capping ends. One row for each source goes through a window without partitions.
    """
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "weight", F.col("source").asc_nulls_last())
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    rest = F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = ranked.withColumn("level", rest / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    free = F.col("ratio") >= F.col("level")
    final = F.max(F.when(free, F.col("level"))).over(whole)
    return level.select("source", "source_size", F.when(free, F.col("weight") * final).otherwise(cap * F.col("source_size").cast("double")).alias("target"))


def placed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of `docs` as _id, source, _row (hash of the text), size, and start: where the row begins in its source's stream.

    The stream's order is a hash of doc_id, then doc_id. Starts are summed in three steps, within buckets of bounded size,
    over the buckets of a shelf and over the shelves, so that no task gets a whole source.
    """
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("source"), F.xxhash64(text).alias("_row"), size.alias("size"))
    sized = stage(sized)  # the only step that reads the texts
    n = parts_for(sized.count(), ROWS_A_BUCKET)
    sized = sized.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_row"), F.lit(n)))
    within = Window.partitionBy("source", "_bucket").orderBy("_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, order, *by: F.coalesce(F.sum(c).over(Window.partitionBy("source", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shelf = F.floor(F.col("_bucket") / ROWS_A_BUCKET)
    sums = stage(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")).withColumn("_shelf", shelf))
    shelves = sums.groupBy("source", "_shelf").agg(F.sum("_sum").alias("_sum")).withColumn("_base", before("_sum", "_shelf")).select(F.col("source").alias("_of"), F.col("_shelf").alias("_on"), "_base")
    buckets = sums.withColumn("_at", before("_sum", "_bucket", "_shelf")).join(shelves, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_shelf") == F.col("_on")))
    buckets = buckets.select("source", "_bucket", (F.col("_base") + F.col("_at")).alias("_from"))
    inner = sized.withColumn("_at", F.coalesce(F.sum("size").over(within), F.lit(0))).alias("a")
    joined = inner.join(buckets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a._bucket") == F.col("b._bucket")))
    return joined.select("_id", "a.source", "_row", "size", (F.col("_from") + F.col("_at")).alias("start"))


def whole_slots(want: np.ndarray) -> np.ndarray:
    """Whole numbers near `want`, which sum up to its rounded sum: those with the largest fractions are rounded up."""
    out = np.floor(want).astype(np.int64)
    left = round(float(want.sum())) - int(out.sum())
    out[np.argsort(out - want, kind="stable")[:left]] += 1
    return out


def _share(rng: np.random.Generator, counts: np.ndarray, m: int) -> np.ndarray:
    """How many of `m` slots, drawn from `counts` of them without putting back, are of each source.

    NumPy draws from less than 1e9; beyond that, where they are as good as the same, from normal distributions."""
    if counts.sum() < 1_000_000_000:
        return rng.multivariate_hypergeometric(counts, m, method="marginals")
    out, total = np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        share = c / total if total else 0.0
        spread = (m * share * (1 - share) * (total - m) / max(1, total - 1)) ** 0.5
        out[i] = min(max(round(m * share + spread * rng.standard_normal()), 0, m - (total - c)), c, m)
        m, total = m - int(out[i]), total - c
    return out


def shard_counts(totals: np.ndarray, shards: int, low: int, high: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, slots of each source, slots of each source in the shards before) for the shards from `low` up to `high`.

    The shards' counts are multinomial given the totals, which is: drawn from all slots without putting back. They are drawn
    down a tree: the slots of a range of shards are divided between its halves by the range's own random numbers, so that
    any stretch of shards can be drawn by itself, with the same result.
    """
    slots = int(totals.sum())

    def edge(shard: int) -> int:
        return slots * shard // shards

    def draw(a: int, b: int, counts: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if b <= low or a >= high:
            return
        if b - a == 1:
            yield a, counts, before
            return
        middle = (a + b) // 2
        first = _share(np.random.default_rng([seed, a, b]), counts, edge(middle) - edge(a))
        yield from draw(a, middle, first, before)
        yield from draw(middle, b, counts - first, before + first)

    yield from draw(0, shards, totals, np.zeros_like(totals))


def slots(goals: DataFrame, block: int = BLOCK, shard: int = SHARD, cap: int = CAP, seed: int = 0) -> DataFrame:
    """Every slot of the mix: shard, source and the number of the source's block that fills it.

    Slots are dealt evenly to the shards, `shard` at most. How many of its slots go to which source, each shard draws from
    the multinomial with the sources' shares of the targets, given that all shards together give each source its whole number
    of slots (shard_counts). So a source gets what its target asks for, up to a block for each pass over it. A block is
    taken at most `cap` times: slots beyond that, which the whole numbers may ask for, stay empty.
    """
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    # the last block of a source is short, so its mean block is a little shorter than `block`
    goals = goals.where("target > 0").select("source", blocks.alias("n"), (F.col("target") * blocks / F.col("source_size")).alias("want"))
    expected = goals.select("source", "n", "want", F.ceil(F.sum("want").over(Window.partitionBy()) / shard).cast("long").alias("shards"))

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            for low, shards, want in zip(x["from"], x["shards"], x["want"], strict=True):
                drawn = list(shard_counts(whole_slots(np.asarray(want)), int(shards), int(low), min(int(low) + STRETCH, int(shards)), seed))
                yield pd.DataFrame({"shard": [s for s, _, _ in drawn], "counts": [c for _, c, _ in drawn], "firsts": [f for _, _, f in drawn]})

    # the sources' wanted slots travel as one array, one row for each stretch of shards
    order = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "n", "want")))
    stretches = F.sequence(F.lit(0).cast("long"), F.col("shards") - 1, F.lit(STRETCH).cast("long"))
    drawn = expected.agg(order.alias("all"), F.max("shards").alias("shards")).where("shards > 0").select(F.transform("all", lambda x: x["want"]).alias("want"), "shards", F.explode(stretches).alias("from"))
    counts = drawn.repartition("from").mapInPandas(draw, "shard long, counts array<long>, firsts array<long>")
    runs = (
        counts.select("shard", F.posexplode(F.arrays_zip("counts", "firsts")).alias("k", "c"))
        .join(expected.agg(order.alias("all")).select(F.posexplode("all").alias("k", "it")), "k")
        .select("shard", F.col("c.counts").alias("count"), F.col("c.firsts").alias("first"), "k", "it.source", "it.n")
        .where("count > 0")
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for row in x.to_pylist():
                t = row["first"] + np.arange(row["count"])
                t = t[t < cap * row["n"]]
                n = np.full(len(t), row["n"])
                key = (np.uint64(row["k"]) << np.uint64(32)) + (t // n).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(seed)
                yield pa.RecordBatch.from_pydict({"shard": np.full(len(t), row["shard"]), "source": pa.array([row["source"]] * len(t), pa.string()), "block": permuted(t % n, n, key)})

    tasks = int(goals.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as few bytes grow to many rows
    return runs.repartition(tasks, "shard", "k").mapInArrow(fill, "shard long, source string, block long")


def pieces(places: DataFrame, goals: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The words of the mix: shard, source, start (which row of `places`), first and past: words of that row, from 0."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    spread = places.where("size > 0").select("source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("block") * block - F.col("start"), F.lit(0))
    high = F.least((F.col("block") + 1) * block - F.col("start"), F.col("size"))
    named = spread.select(F.xxhash64("source").alias("h"), "source", "start", "block", low.alias("first"), high.alias("past"))
    filled = slots(goals, block, **options).select("shard", F.xxhash64("source").alias("h"), F.col("source").alias("of"), F.col("block").alias("b"))
    on = (F.col("h") == F.col("h2")) & (F.col("block") == F.col("b")) & F.col("source").eqNullSafe(F.col("of"))
    # the slots look like a few rows to the planner, as one row with the sources' shares stands at their beginning
    return named.join(filled.withColumnRenamed("h", "h2").hint("merge"), on).select("shard", "source", "start", "first", "past")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def taken_words(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, cap: int = CAP, seed: int = 0) -> DataFrame:
    """Per row of `docs`: _id, source, _row, size, start, source_size, target and taken (words that the mix takes).

    A null text has no words and is never taken; a null source is a source of its own. Rows that share a doc_id are
    documents of their own. Further columns of `docs` are not looked at. Reruns give the same mix for the same rows.
    """
    places = placed(docs)
    goals = targets(places, cap)
    took = pieces(places, goals, block, shard=shard, cap=cap, seed=seed).groupBy("source", "start").agg(F.sum(F.col("past") - F.col("first")).alias("taken"))
    rows = places.alias("p").join(goals.alias("g"), _same("p", "g")).select("p.*", "source_size", "target").alias("r")
    # empty rows start where the next one does: only rows with words look for theirs
    found = rows.join(took.alias("t"), _same("r", "t") & (F.col("r.start") == F.col("t.start")) & (F.col("r.size") > 0), "left")
    return found.select("r.*", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, cap: int = CAP, seed: int = 0) -> DataFrame:
    """The mix as documents: a row of `docs` for each time that some of its words are taken, with those words as text.

    The n-th row of a document holds the words that are taken n times or more; words that follow each other keep what
    stands between them, and runs are joined by a line feed. A document that is taken whole keeps its text as it is.
    Columns of `docs` stay as they are, n_chars follows the text. Documents of which nothing is taken are left out.
    """
    import re

    word = re.compile(WORD)
    places = placed(docs)
    cuts = pieces(places, targets(places, cap), block, shard=shard, cap=cap, seed=seed).groupBy("source", "start").agg(F.collect_list(F.struct("first", "past")).alias("_cuts"))
    at = places.where("size > 0").alias("p").join(cuts.alias("c"), _same("p", "c") & (F.col("p.start") == F.col("c.start")))
    alike = Window.partitionBy("_id", "_row", "source").orderBy("start")  # rows that are the same in all that counts are told apart by number
    at = at.select("_id", "_row", "p.source", "p.start", "_cuts").withColumn("_nth", F.row_number().over(alike))
    at = at.select(F.struct("_id", "_row", "source", "_nth").alias("_key"), "_cuts")
    # the columns travel in a struct, so that their names don't matter
    others = F.struct(F.lit(0).alias("_"), *[col(c) for c in docs.columns if c != "text"]).alias("_it")
    rows = docs.select(others, F.col("text").alias("text"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_row"), F.col("source").alias("source"))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_row", "source").orderBy(F.xxhash64(F.col("_it").cast("string")))))
    key = [F.col(c).eqNullSafe(F.col(f"_key.{c}")) for c in ("_id", "_row", "source", "_nth")]
    joined = rows.join(at, key[0] & key[1] & key[2] & key[3]).select("_it", "text", "_cuts")
    n_chars = docs.schema["n_chars"].dataType.simpleString() if "n_chars" in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            source_row, texts = [], []
            for i, (text, cuts) in enumerate(zip(x.column("text").to_pylist(), x.column("_cuts").to_pylist(), strict=True)):
                spans = [m.span() for m in word.finditer(text)]
                times = np.zeros(len(spans) + 1, np.int64)
                for c in cuts:
                    times[c["first"]] += 1
                    times[c["past"]] -= 1
                times = np.cumsum(times)
                for n in range(1, times.max() + 1):
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], (times[:-1] >= n).astype(np.int8), [0]])))
                    runs = [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    whole = runs == [(0, len(spans))]
                    source_row.append(i)
                    texts.append(text if whole else "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs))
            taken = x.column("_it").take(pa.array(source_row, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken, pa.array(texts, pa.string())], names=["_it", "text"])
            release()

    mixed = joined.mapInArrow(cut, T.StructType([joined.schema["_it"], T.StructField("text", T.StringType())]))
    size = F.char_length("text").cast(n_chars).alias("n_chars") if n_chars else None
    return mixed.select(*[F.col("text") if c == "text" else size if c == "n_chars" else F.col("_it")[c].alias(c) for c in docs.columns])
