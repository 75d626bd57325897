"""Quality rules: simple counts of a text, and its perplexity under a character n-gram model.

Characters are code points, with capitals, digits and some marks taken together. Spark counts the n-grams of all documents
and makes the modified Kneser-Ney estimates from the counts by joins and sums; as every text has been counted, the model
holds all n-grams that can be asked for. It is kept as sorted arrays of hashes with their log-probabilities: as one pair of arrays that all tasks
get, if its size allows that, or as arrays for ranges of hashes, which answer what blocks of documents ask. Each language
gets a band of log-perplexities from its own quartiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ripplelog.llm.common import SPACES, parts_for, stage, text_bytes
from ripplelog.llm.packed import MESSAGE, MESSAGE_SCHEMA, ask, blocks_of, cut_to_ranges, from_bytes, in_order, messages, ranges, read, ungapped
from ripplelog.llm.words import mix, slices, word_hashes

ORDER = 4
SYMBOLS = b"#*$%&|<>"
BATCH_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: A model of so many n-grams (12 bytes each) goes to all tasks; a larger one answers by ranges of hashes.
BROADCAST_GRAMS = 4_000_000
#: A task holds so many n-grams' counts before it adds them up.
HELD_GRAMS = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: What code points are read as: white space, capitals (of Latin, Greek, Cyrillic and Armenian), digits and the symbols that
#: op5 counts are one character each; all others are themselves.
_READ_AS = np.array([32 if 9 <= c <= 13 else ord("A") if chr(c).isupper() else ord("0") if 48 <= c <= 57 else ord("#") if c < 128 and c in SYMBOLS else c or 0xFFFD for c in range(0x590)], np.uint32)
_NO_LANGUAGE = "\0"
COUNTS = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, nll"


def code_points(texts: pa.Array, models: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code points of the texts, each text behind ORDER - 1 spaces; the places of its own; their n-grams' hashes; and
    where each text's own code points end. Null texts are empty.

    An n-gram of ORDER ends at its place and belongs to its text's model.
    """
    texts = pc.fill_null(texts, "")
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    pad = " " * (ORDER - 1)
    points = np.frombuffer("".join([pad + t for t in texts.to_pylist()]).encode("utf-32-le"), np.uint32).copy()
    low = points < len(_READ_AS)
    points[low] = _READ_AS[points[low]]
    ends = np.cumsum(sizes)
    at = np.arange(sizes.sum()) + np.repeat((ORDER - 1) * np.arange(1, len(sizes) + 1), sizes)
    h = np.repeat(word_hashes(models), sizes)
    for k in range(ORDER - 1, -1, -1):
        h *= _GOLD
        h += points[at - k]
        h = mix(h)
    return points, at, h, ends


def _tally(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each kind of hash, and how many there are of it."""
    bits = np.uint64(max(1, len(h) - 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    both = np.sort((h & ~low) | np.arange(len(h), dtype=np.uint64))  # sorts by most of the hash, with the place behind it
    place = (both & low).astype(np.int64)
    first = np.flatnonzero(np.diff(both & ~low, prepend=~both[:1] & ~low))
    n = np.diff(np.append(first, len(h)))
    if (h[place] != np.repeat(h[place[first]], n)).any():  # two kinds that differ in the last bits alone
        _, at, n = np.unique(h, return_index=True, return_counts=True)
        return at, n
    return place[first], n


def counted(docs: DataFrame) -> DataFrame:
    """model, gram (text of ORDER code points), h (its hash) and n of all n-grams of text by model."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added() -> tuple:
            model, gram, h, n = (np.concatenate(x) for x in zip(*held, strict=True))
            _, at, back = np.unique(h, return_index=True, return_inverse=True)
            return model[at], gram[at], h[at], np.bincount(back, weights=n).astype(np.int64)

        def out() -> pa.RecordBatch:
            model, gram, h, n = added()
            return pa.RecordBatch.from_arrays([pa.array(model, pa.string()), pa.array(gram.view(f"U{ORDER}")[:, 0].tolist(), pa.string()), pa.array(h.view(np.int64)), pa.array(n)], names=["model", "gram", "h", "n"])

        for whole in batches:
            for x in slices(whole, "text", BATCH_BYTES):
                points, at, h, ends = code_points(x.column("text"), x.column("model"))
                if len(h):
                    one, n = _tally(h)
                    gram = np.stack([points[at[one] - k] for k in range(ORDER - 1, -1, -1)], axis=1)
                    model = np.array(x.column("model").to_pylist(), object)[np.searchsorted(ends, one, side="right")]
                    held.append((model, gram, h[one], n))
                    size += len(one)
                if size > HELD_GRAMS:
                    held = [added()]
                    if len(held[0][3]) > HELD_GRAMS // 2:
                        yield out()
                        held = []
                    size = sum(len(x[3]) for x in held)
        if held:
            yield out()

    rows = docs.mapInArrow(count, "model string, gram string, h long, n long")
    return rows.groupBy("model", "gram", "h").agg(F.sum("n").alias("n"))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What is taken off counts of 1, 2 and more, from how many n-grams have the counts 1 to 4."""
    n1, n2, n3, n4 = (max(1, n) for n in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    return np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.1, [0.9, 1.9, 2.9]).tolist()


def estimated(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """h and p, the modified Kneser-Ney estimate of an n-gram's last code point behind the others, for all of `grams`.

    Lower orders count how many different code points stand before. Models are few: one row for each and order is collected.
    """
    levels = {order: grams.withColumnRenamed("n", "c")}
    for k in range(order - 1, 0, -1):
        fewer = levels[k + 1].groupBy("model", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        levels[k] = stage(fewer)
    below = None
    for k in range(1, order + 1):
        having = [F.count_if(F.col("c") == j).alias(f"n{j}") for j in (1, 2, 3, 4)]
        rows = levels[k].groupBy("model").agg(*having, F.count(F.lit(1)).alias("kinds")).collect()
        if not rows:
            return grams.select("h", F.lit(0.0).alias("p"))
        of = F.create_map(*[x for r in rows for x in (F.lit(r.model), F.array(*map(F.lit, [*_discounts(r.n1, r.n2, r.n3, r.n4), 1 / (r.kinds + 1)])))])[F.col("model")]
        cut = levels[k].withColumn("d", F.get(of, F.least("c", F.lit(3)).cast("int") - 1)).withColumn("context", F.substring("gram", 1, k - 1))
        totals = cut.groupBy("model", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("gone"))
        joined = cut.join(F.broadcast(totals) if k == 1 else totals, ["model", "context"])  # one row for each model at first
        if below is None:
            lower = F.get(of, F.lit(3))
        else:
            joined = joined.withColumn("shorter", F.substring("gram", 2, k - 1)).join(below.select("model", F.col("gram").alias("shorter"), F.col("p").alias("below")), ["model", "shorter"])
            lower = F.col("below")
        p = ((F.col("c") - F.col("d")) / F.col("total") + F.col("gone") / F.col("total") * lower).alias("p")
        below = stage(joined.select("model", "gram", p) if k < order else joined.select("h", p))
    return below


class Sorted:
    """Hashes in order with their log-probabilities, and where the hashes of each range begin."""

    def __init__(self, hashes: np.ndarray, logs: np.ndarray):
        order = np.argsort(hashes)
        self.keys, self.logs = hashes[order], logs[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, len(hashes).bit_length()))
        self.first = np.searchsorted(self.keys, np.arange(2 ** (64 - int(self.shift)), dtype=np.uint64) << self.shift)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The logarithms of hashes that are all there: each is looked for from its range's beginning on."""
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        todo = np.flatnonzero(self.keys[at] != hashes)
        while len(todo):
            at[todo] += 1
            todo = todo[self.keys[at[todo]] != hashes[todo]]
        return self.logs[at]


def _word_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    words = pc.list_flatten(parts)
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    words, owner = words.filter(pa.array(real)), owner[real]
    n = np.bincount(owner, minlength=len(texts))
    chars = np.bincount(owner, weights=pc.utf8_length(words).to_numpy(), minlength=len(texts)).astype(np.int64)
    h = word_hashes(words)
    runs = h
    for k in range(1, 8):
        runs = mix(runs[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k:]) if len(runs) else runs
    repeated, start = np.zeros(len(texts), np.int64), 0
    for i, size in enumerate(n.tolist()):
        if size > 8:
            mine = runs[start : start + size - 7]
            order = np.argsort(mine, kind="stable")
            same = mine[order][1:] == mine[order][:-1]
            if same.any():
                twice = np.zeros(len(mine), bool)
                twice[order[1:][same]] = twice[order[:-1][same]] = True
                edges = np.zeros(size + 1, np.int64)
                edges[:-8] += twice
                edges[8:] -= twice
                repeated[i] = (np.cumsum(edges) > 0).sum()
        start += size
    return {"n_words": n.astype(np.int64), "word_chars": chars, "n_repeat_words": repeated}


def _dup_lines(text: str | None) -> int:
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def _measured(t: pa.RecordBatch | pa.Table, lookup: Callable[[np.ndarray], np.ndarray]) -> list[pa.Array]:
    """doc_id, lang and n_bytes as they are, the counts, and nll of some rows."""
    texts, models = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (t.column("text"), t.column("model")))
    _, _, h, ends = code_points(texts, models)
    sums = np.diff(np.concatenate([[0], np.cumsum(lookup(h), dtype=np.float64)])[ends], prepend=0)
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    is_symbol = np.zeros(256, np.int64)
    is_symbol[list(SYMBOLS)] = 1
    marks = np.concatenate([[0], np.cumsum(is_symbol[np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]])])
    counts = _word_counts(texts)
    counts["n_symbols"] = np.diff(marks[offsets - offsets[0]])
    counts["n_dup_lines"] = np.array([_dup_lines(x) for x in texts.to_pylist()], np.int64)
    sizes = np.diff(ends, prepend=0)
    counts["nll"] = np.where(sizes > 0, -sums / np.maximum(sizes, 1), np.nan)
    return [*(t.column(c) for c in ("doc_id", "lang", "n_bytes")), *(pa.array(counts[c], from_pandas=True) for c in COUNTS.split(", ")[1:])]


def measure(rows: DataFrame, model: DataFrame, most: int = BROADCAST_GRAMS) -> DataFrame:
    """doc_id, lang, n_bytes, the counts and nll (the mean negative log-probability of a code point, null without any) of
    doc_id, text, lang, model and n_bytes. A model (h, p) of more than `most` n-grams is never sent to a task as a whole."""
    kind = dict(rows.dtypes)["doc_id"]
    fields = f"doc_id {kind}, lang string, n_bytes int, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, nll double"
    names = ["doc_id", "lang", "n_bytes", *COUNTS.split(", ")[1:]]
    if model.count() <= most:
        known = model.toArrow()
        lookup = Sorted(known.column("h").to_numpy().view(np.uint64), np.log(known.column("p").to_numpy()))

        def counted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for x in slices(whole, "text", BATCH_BYTES):
                    yield pa.RecordBatch.from_arrays(_measured(x, lookup), names=names)

        return rows.mapInArrow(counted_rows, fields)

    blocks, parts = blocks_of(rows, "text", BLOCK_BYTES, ["doc_id"]), parts_for(text_bytes(rows), BLOCK_BYTES)

    def grams_of(payload) -> np.ndarray:
        t = from_bytes(payload)
        found = [code_points(x.column("text").combine_chunks(), x.column("model").combine_chunks())[2] for x in slices(t, "text", BATCH_BYTES)]
        found = [h[_tally(h)[0]] for h in found if len(h)]
        return np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))

    def distinct(h: np.ndarray) -> np.ndarray:
        return h[np.concatenate([np.ones(min(1, len(h)), bool), h[1:] != h[:-1]])]

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            h = x.column("h").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ranges(h, parts).astype(np.int32)), x.column("h"), x.column("p")], names=["bucket", "h", "p"])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        lookup = Sorted(right.column("h").to_numpy().view(np.uint64), np.log(right.column("p").to_numpy()))
        sizes, (steps,) = read(left.column("payload"), np.uint64)
        return pa.table([left.column("bucket").combine_chunks(), left.column("block").combine_chunks(), messages(sizes, lookup(ungapped(sizes, steps)))], schema=MESSAGE_SCHEMA)

    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in T.StructType.fromDDL(fields)])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        payload = left.column("payload")[0].as_buffer()
        keys, logs = distinct(grams_of(payload)), in_order(right, np.float32)[0]
        lookup = Sorted(keys, logs)
        parts = [pa.table(_measured(x, lookup), names=names) for x in slices(from_bytes(payload), "text", BATCH_BYTES)]
        return pa.concat_tables(parts).cast(schema)

    asked = ask(blocks, lambda block, payload: cut_to_ranges(block, distinct(grams_of(payload)), parts))
    answers = asked.groupBy("bucket").cogroup(model.mapInArrow(ranged, "bucket int, h long, p double").groupBy("bucket")).applyInArrow(answer, MESSAGE)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, fields)


def judge(docs: DataFrame, text: str = "text", lang: Column | str = "lang", width: float = 1.0, short: float = 2.0, model: Column | None = None, most: int = BROADCAST_GRAMS) -> DataFrame:
    """doc_id, the five counts, nll, base_failed and kept for every row of `docs`.

    base_failed: fewer than 20 words, or more than 30% of the words stand in 8-word windows that the text repeats. Other
    rows are kept if their mean negative log-probability (log-perplexity) lies in their language's band: from the lower
    quartile to the upper, widened on both sides by `width` times the distance between the quartiles; as the mean of few
    code points varies, `short` by the square root of a text's bytes, about its standard error, is added. Quartiles are
    over the language's rows that pass the base rules; a null language is one of its own. model: whose values have models of
    their own, one for all texts if not given; most: see measure().
    Null and empty texts have no words. Rows that share a doc_id are judged each by itself; no other column is read.
    """
    lang = F.col(lang) if isinstance(lang, str) else lang
    rows = docs.select("doc_id", F.col(text).alias("text"), F.coalesce(lang, F.lit(_NO_LANGUAGE)).alias("lang"), (F.lit("") if model is None else F.coalesce(model, F.lit(_NO_LANGUAGE))).alias("model"), F.coalesce(F.octet_length(text), F.lit(0)).alias("n_bytes"))
    measured = stage(measure(rows, estimated(stage(counted(rows.select("text", "model")))), most))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = measured.withColumn("base_failed", failed)
    bands = judged.where("NOT base_failed").groupBy("lang").agg(F.percentile_approx("nll", [0.25, 0.75], 10_000).alias("q"))
    room = width * (F.get("q", F.lit(1)) - F.get("q", F.lit(0)))
    bands = bands.select("lang", (F.get("q", F.lit(0)) - room).alias("low"), (F.get("q", F.lit(1)) + room).alias("high"))
    noise = short / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    inside = F.coalesce(F.col("nll").between(F.col("low") - noise, F.col("high") + noise), F.lit(False))
    joined = judged.join(F.broadcast(bands), "lang", "left")  # one row for each language
    return joined.select(*COUNTS.split(", "), "base_failed", (~F.col("base_failed") & inside).alias("kept"))
