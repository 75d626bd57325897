"""Jaccard join of documents on their word n-grams, by vertical partitioning.

1. Every row gets its set's size and fingerprint (two 64-bit sums); equal sets become one class with a representative.
2. The representatives' n-grams are counted: each block of documents asks for the counts of its distinct n-grams, packed
   by hash range, and gets them back in the same order. Counts order all n-grams, rare ones first. The texts stay where
   they are.
3. A document whose n-grams mostly occur nowhere else links with nothing. Those that are left look for partners among
   the first of their n-grams in that order (two sets that link share one of these).
4. The order is cut into fragments; a pair's overlap is counted in each fragment by itself and summed.

Step 3 runs twice: first each n-gram's list is compared with one of its members, then, with what these links have joined
taken together, whatever is still apart, where sizes and sketches leave an overlap possible. Groups of near copies are
therefore never written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.common import parts_for, release, stage, text_bytes
from ripplelog.llm.components import components
from ripplelog.llm.packed import MESSAGE, MESSAGE_SCHEMA, blocks_of, columns, cut_to_ranges, from_bytes, in_order, message, messages, read, ungapped
from ripplelog.llm.words import mix, shingle_sets, slices

BLOCK_BYTES = 6 << 20
FRAGMENTS = 4  # for each power of two of the counts
SKETCH = 8  # longs of 64 bits, each bit the parity of the n-grams that a hash sends there
WIDE = 512  # sets of more shared n-grams have wider sketches as well, with two to four bits for each


def _sets(texts: pa.ChunkedArray | pa.Array, n: int) -> Iterator[np.ndarray]:
    for part in slices(pa.table({"t": texts}), "t", 1 << 20):
        yield from shingle_sets(part.column("t").combine_chunks(), n)


def fingerprints(blocks: DataFrame, n: int) -> DataFrame:
    """block, i, _id, n_shingles, s1 and s2 for every row of the blocks: its place, its set's size and two sums of its n-grams' hashes."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for block, payload in zip(x.column("block").to_pylist(), x.column("payload"), strict=True):
                t = from_bytes(payload.as_buffer())
                sets = list(_sets(t.column("_text"), n))
                s1, s2 = (np.array([mix(s ^ np.uint64(seed)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for seed in (0x51ED27, 0xA0761D6478BD642F))
                columns_ = [pa.array(np.full(len(sets), block)), pa.array(np.arange(len(sets))), t.column("_id").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()), pa.array(s1), pa.array(s2)]
                yield pa.RecordBatch.from_arrays(columns_, names=["block", "i", "_id", "n_shingles", "s1", "s2"])
                release()

    return blocks.mapInArrow(of, "block long, i long, _id long, n_shingles long, s1 long, s2 long")


def _least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """The fewest common elements of a set of this size with any set that it links with: percent of its size at least."""
    return -(-size * percent // 100)


def counted(blocks: DataFrame, chosen: DataFrame, n: int, percent: int, n_bytes: int) -> DataFrame:
    """doc, n, k, prefix, sketch and grams of the chosen rows (block, i, doc) that can link at all.

    n: the set's size; k: how many of its n-grams other rows have, too; sketch: the parities of these by hash, wide: more of
    them, where SKETCH is too few; grams: array of (count's power of two, hash), in the global order, of the n-grams that several chosen rows have;
    prefix: how many of these are among the row's first n-grams, one of which any partner shares.
    """
    parts = parts_for(n_bytes, BLOCK_BYTES)  # n-grams are dealt to as many buckets by hash

    def named(group: pa.Table) -> pa.Table:
        which = message(group.column("i").to_numpy(), group.column("doc").to_numpy())
        return pa.table([[-1], group.column("block")[:1].combine_chunks(), [which]], schema=MESSAGE_SCHEMA)

    wanted = chosen.groupBy("block").applyInArrow(named, MESSAGE)

    def chosen_sets(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        which = right.filter(pc.less(right.column("bucket"), 0))
        if not left.num_rows or not which.num_rows:
            return np.zeros(0, np.int64), []
        i, doc = columns(which.column("payload")[0].as_py(), np.int64, np.int64)
        order = np.argsort(i)
        return doc[order], list(_sets(from_bytes(left.column("payload")[0].as_buffer()).column("_text").take(pa.array(i[order])), n))

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        _, sets = chosen_sets(left, right)
        if not sets:
            return MESSAGE_SCHEMA.empty_table()
        grams, counts = np.unique(np.concatenate(sets), return_counts=True)
        del sets
        return cut_to_ranges(left.column("block")[0].as_py(), grams, parts, counts.astype(np.uint32))  # within a block

    def answer(group: pa.Table) -> pa.Table:
        sizes, (grams, counts) = read(group.column("payload"), np.uint64, np.uint32)
        grams = ungapped(sizes, grams)
        order = np.argsort(grams)
        grams = grams[order]
        first = np.flatnonzero(np.diff(grams, prepend=~grams[:1]))
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        level = np.minimum(255, np.where(total < 2, 0, np.floor(np.log2(total)))).astype(np.uint8)
        back = np.empty(len(grams), np.uint8)
        back[order] = np.repeat(level, np.diff(np.append(first, len(grams))))
        payloads = messages(sizes, back)
        release()
        return pa.table([group.column("bucket").combine_chunks(), group.column("block").combine_chunks(), payloads], schema=MESSAGE_SCHEMA)

    def ordered(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, sets = chosen_sets(left, right)
        out = {"doc": [], "n": [], "k": [], "prefix": [], "sketch": [], "wide": [], "grams": []}
        if sets:
            _, place = np.unique(np.concatenate(sets), return_inverse=True)
            levels = in_order(right.filter(pc.greater_equal(right.column("bucket"), 0)), np.uint8)[0]
            levels = np.split(levels[place], np.cumsum([len(s) for s in sets])[:-1])
        for d, s, level in zip(ids.tolist(), sets, levels, strict=True) if sets else ():
            least = int(_least_overlap(np.array(len(s)), percent))
            shared = level > 0
            k = int(shared.sum())
            if k < least:
                continue
            order = np.lexsort((s[shared], level[shared]))
            # the level stands in the highest bits, so that the global order is that of the numbers
            key = (level[shared].astype(np.uint64) << np.uint64(56)) | (s[shared] >> np.uint64(8))
            out["doc"].append(d)
            out["n"].append(len(s))
            out["k"].append(k)
            out["sketch"].append(parities(s[shared], 64 * SKETCH))
            out["wide"].append(parities(s[shared], 1 << (k - 1).bit_length() + 1) if k > WIDE else None)
            out["prefix"].append(len(s) - least + 1 - (len(s) - k))
            out["grams"].append(key[order].view(np.int64))
        release()
        return pa.table(out, pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("prefix", pa.int32()), ("sketch", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))]))

    texts = blocks.groupBy("block")
    answers = texts.cogroup(wanted.groupBy("block")).applyInArrow(ask, MESSAGE).groupBy("bucket").applyInArrow(answer, MESSAGE)
    return texts.cogroup(wanted.union(answers).groupBy("block")).applyInArrow(ordered, "doc long, n long, k long, prefix int, sketch array<long>, wide array<long>, grams array<long>")


def _fragment(gram: Column) -> Column:
    """Which cut of the global order an n-gram belongs to: its count's power of two, and FRAGMENTS ranges in each."""
    return F.shiftright(gram, 56) * FRAGMENTS + F.shiftright(gram, 54) % FRAGMENTS


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of `sets` whose overlap, summed over the fragments, reaches percent of their union."""
    cut = sets.select("doc", F.explode("grams").alias("g")).groupBy("doc", _fragment(F.col("g")).alias("fragment")).agg(F.collect_list("g").alias("segment"))
    segments = stage(cut)
    left = segments.select(F.col("doc").alias("a"), "fragment", F.col("segment").alias("of_a"))
    right = segments.select(F.col("doc").alias("b"), "fragment", F.col("segment").alias("of_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).cast("long").alias("common"))
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return summed.where(F.col("common") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """g, doc, n, k and early for the first n-grams of every set, one of which it shares with any partner.

    early: among the fewer first ones that do for partners that are no smaller.
    """
    firsts = F.slice("grams", F.lit(1), F.greatest("prefix", F.lit(1)))
    placed = sets.select("doc", "n", "k", F.posexplode(firsts).alias("place", "g"))
    least = F.ceil(2 * percent * F.col("n") / F.lit(100 + percent))
    return placed.select("g", "doc", "n", "k", (F.col("n") - F.col("k") + F.col("place") < F.col("n") - least + 1).alias("early"))


def _can_link(percent: int) -> Column:
    """Whether the sizes na and nb, and the n-grams ka and kb of these that others have, leave room for the overlap."""
    sizes = F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")
    return sizes & ((100 + percent) * F.least("ka", "kb") >= percent * (F.col("na") + F.col("nb")))


def parities(grams: np.ndarray, bits: int) -> np.ndarray:
    """Whether an odd number of the n-grams falls on each of `bits` bits, as longs. Where two sets' bits differ, an n-gram
    is in one of them alone: the number of bits that differ is never more than that of such n-grams."""
    odd = np.bincount((grams >> np.uint64(8)) % np.uint64(bits), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sketches_fit(percent: int, differing: Column) -> Column:
    """Whether the sets can link although as many n-grams as `differing` are in one of them alone, and those that no other
    set has: a link leaves room for (100 - percent) of 100 + percent parts of both sizes."""
    own = F.col("na") - F.col("ka") + F.col("nb") - F.col("kb")
    return (100 + percent) * (own + differing) <= (100 - percent) * (F.col("na") + F.col("nb"))


def _differing() -> Column:
    """Bits in which the sketches differ."""
    return sum((F.bit_count(F.get("sketcha", F.lit(i)).bitwiseXOR(F.get("sketchb", F.lit(i)))) for i in range(SKETCH)), F.lit(0))


def candidates(first: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, na and nb of the sets that may link and that `joined` (node, component) leaves apart, each pair once.

    Sets that share one of their first n-grams are compared by size and sketch while they are joined, so that of the texts
    of one form, which share whole paragraphs, only those are given on that differ in about as little as links do. Sets
    that are too large for their sketches are compared by their wider ones after that.
    """
    known = stage(first.join(joined.withColumnRenamed("node", "doc"), "doc", "left").select("g", "doc", "n", "k", "early", F.coalesce("component", "doc").alias("c")))
    mixed = known.groupBy("g").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("g")
    apart = known.join(mixed, "g").join(sets.select("doc", "sketch"), "doc")
    left, right = (apart.select("g", *(F.col(c).alias(f"{c if c != 'doc' else ''}{side}") for c in ("doc", "n", "k", "early", "c", "sketch"))) for side in "ab")
    shorter_early = F.when((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))), F.col("earlya")).otherwise(F.col("earlyb"))
    pairs = left.join(right, "g").where((F.col("ca") < F.col("cb")) & shorter_early & _can_link(percent) & _sketches_fit(percent, _differing()))
    pairs = stage(pairs.select("a", "b", "na", "nb", "ka", "kb").distinct())
    large = pairs.where((F.col("ka") > WIDE) & (F.col("kb") > WIDE))
    wide_a, wide_b = (sets.where("wide IS NOT NULL").select(F.col("doc").alias(side), F.col("wide").alias(f"wide{side}")) for side in "ab")
    bits = F.aggregate(F.zip_with("widea", "wideb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    alike = F.size("widea") != F.size("wideb")  # next to a power of two; such pairs stay
    large = large.join(wide_a, "a").join(wide_b, "b").where(alike | _sketches_fit(percent, bits))
    return pairs.where((F.col("ka") <= WIDE) | (F.col("kb") <= WIDE)).select("a", "b", "na", "nb").union(large.select("a", "b", "na", "nb"))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs`.

    Two documents link when their sets of distinct n-word shingles (words in lower case A-Z; a text with fewer words is
    one shingle) have a Jaccard similarity of `percent` or more; component_id is the smallest doc_id that links reach.
    A null or empty text has no shingles and links with nothing; a null doc_id takes no part and has a null
    component_id. Rows that share a doc_id are one document with several texts: what links with one of them, links with
    all. Other columns of `docs` are not looked at.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    blocks = blocks_of(rows, "_text", BLOCK_BYTES, ["_id"])
    prints = stage(fingerprints(blocks, n))
    full = prints.where("n_shingles > 0 AND _id IS NOT NULL")
    heads = full.groupBy("s1", "s2", "n_shingles").agg(F.min(F.struct("_id", "block", "i")).alias("head"))
    # a class of equal sets has a number of its own: its smallest doc_id may have other texts and so be in other classes
    classes = stage(heads.select("s1", "s2", "n_shingles", "head", F.monotonically_increasing_id().alias("doc")))
    sets = stage(counted(blocks, classes.select("head.block", "head.i", "doc"), n, percent, text_bytes(docs, text)))

    first = stage(_prefixes(sets, percent))
    # the member with the fewest n-grams of its own: in a group of near copies, what they were copied from
    heads = first.groupBy("g").agg(F.min(F.struct((F.col("n") - F.col("k")).alias("own"), F.xxhash64("doc").alias("h"), "doc", "n", "k")).alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    pairs = first.join(heads, "g").where("doc <> head.doc")
    pairs = pairs.select(F.col("head.doc").alias("a"), F.col("doc").alias("b"), F.col("head.n").alias("na"), F.col("n").alias("nb"), F.col("head.k").alias("ka"), F.col("k").alias("kb"))
    links = stage(linked(pairs.where(_can_link(percent)).select("a", "b", "na", "nb").distinct(), sets, percent))
    joined = components(links)

    rest = stage(linked(candidates(first, joined, sets, percent), sets, percent))

    # a doc_id in several classes ties them together
    classed = prints.join(classes.select("s1", "s2", "n_shingles", "doc"), ["s1", "s2", "n_shingles"], "left")
    several = classed.where("doc IS NOT NULL AND _id IS NOT NULL").groupBy("_id").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b")
    tied = classed.join(several.select("_id", "a"), "_id").select("a", F.col("doc").alias("b")).where("a <> b")
    final = components(links.union(rest).union(tied))

    part = F.coalesce("component", "doc").alias("part")
    named = stage(classes.join(final.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "head", part))
    smallest = named.groupBy("part").agg(F.min("head._id").alias("component_id"))
    found = classed.join(named.select("doc", "part"), "doc", "left").join(smallest, "part", "left")
    return found.select(F.col("_id").alias(doc_id), "n_shingles", F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id")).alias("component_id"))
