"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of n-grams are mixed order by order: an order's estimate gets a share that depends on how often
its context was seen, by powers of two, and the mixture of all lower orders gets the rest; a uniform floor lies below. The
shares are learned by expectation-maximisation, from single words up, on a part of the training documents whose counts
are left out of the estimates for that.

Documents are dealt in blocks. A block asks for the counts of its distinct n-grams, packed by hash range, and sends its
own counts along; the answers come back in the same order. The texts stay where they are. A very common n-gram is one
entry for each block, however often it stands there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ripplelog.llm.common import parts_for, release, stage, text_bytes
from ripplelog.llm.packed import MESSAGE, MESSAGE_SCHEMA, ask, blocks_of, columns, cut_to_ranges, from_bytes, in_order, message, messages, read, ungapped
from ripplelog.llm.words import mix, slices, split_words, word_hashes

BLOCK_BYTES = 7 << 20
#: Stand before and after every text; no word has these fingerprints but by chance.
BEGIN, END = np.uint64(0xB5AD4ECEDA1CE2A9), np.uint64(0x278C5A4D8419FE6B)
BUCKETS = 65  # of context counts: none, and the powers of two
BIN = 16  # bins for each power of two of an estimate's ratio to what lies below it
BINS = 2048
TRAIN, DELETED, OTHER = 0, 1, 2
OBSERVED_SCHEMA = pa.schema([("seen", pa.binary())])


def _spare_bits(n_bytes: int, order: int) -> int:
    """How many bits of an n-gram's 64 don't travel, where it is longer than a word: so many stay that one in 2**24 of them is
    taken for another by chance, or all. Two bits of all n-grams tell the order; single words keep the other 62."""
    return max(2, 64 - 24 - int(np.ceil(np.log2(max(2, n_bytes * order / 2)))))


@dataclass
class Grams:
    """The n-grams that end at each token of some texts, for each order; tokens are words and one end for each text."""

    ids: pa.Array
    held: pa.Array
    part: np.ndarray
    sizes: np.ndarray  # tokens in each text
    grams: np.ndarray  # orders x tokens
    first: np.ndarray  # whether a token is its text's first

    @classmethod
    def of(cls, block: pa.Table, order: int, drop: int) -> Grams:
        sizes, rows, firsts = [], [], []
        for t in slices(block, "_text", 1 << 20):
            words, ends = split_words(t.column("_text").combine_chunks())
            h = word_hashes(words)
            n = np.diff(ends, prepend=0)
            # order - 1 beginnings, the words, one end
            width = n + order
            at = np.cumsum(width)
            flat = np.full(int(at[-1]) if len(at) else 0, BEGIN, np.uint64)
            flat[np.arange(len(h)) + np.repeat(at - width + order - 1 - (ends - n), n)] = h
            flat[at - 1] = END
            token = np.arange(int((n + 1).sum())) + np.repeat(at - width + order - 1 - (np.cumsum(n + 1) - n - 1), n + 1)
            levels, run = [], flat
            for k in range(order):
                if k:
                    run = np.concatenate([run[:1], mix(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + flat[1:] + np.uint64(k))])
                spare = np.uint64(drop if k else 2)
                levels.append(((run[token] >> spare) << spare) | np.uint64(min(k, 3)))
            rows.append(np.stack(levels))
            firsts.append(token == np.repeat(at - width + order - 1, n + 1))
            sizes.append(n + 1)
        none = np.zeros(0, np.int64)
        grams = np.concatenate([np.zeros((order, 0), np.uint64), *rows], axis=1)
        ids, held = (block.column(c).combine_chunks() for c in ("_id", "_held"))
        return cls(ids, held, block.column("_part").to_numpy(), np.concatenate([none, *sizes]), grams, np.concatenate([none.astype(bool), *firsts]))


@dataclass
class Counts:
    """Sums over a training part: tokens, distinct tokens, texts."""

    tokens: int
    distinct: int
    texts: int


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context that was never seen, then by powers of two."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def _contexts(g: Grams, counts: np.ndarray, total: Counts) -> np.ndarray:
    """How often every token's context was seen, orders x tokens, from the counts of the tokens' n-grams.

    A context is the n-gram of one order less that ends a token earlier; where that is the beginning of the text, as
    many texts have it as there are. All tokens are the context of single words.
    """
    out = np.full(counts.shape, total.tokens, np.int64)
    for k in range(1, len(counts)):
        out[k] = total.texts
        out[k][1:][~g.first[1:]] = counts[k - 1][:-1][~g.first[1:]]
    return out


def _estimates(counts: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates, 0 where the context is new, and the bucket of the context's count; orders x tokens."""
    p = np.divide(counts, context, out=np.zeros(counts.shape), where=context > 0)
    return np.minimum(p, 1.0), _bucket(context)


def _odds(p: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The bin of an estimate's ratio to what lies below: BIN for each power of two, 0 for nothing."""
    with np.errstate(divide="ignore"):
        b = np.clip(np.floor(np.log2(p / below) * BIN) + BINS // 2, 1, BINS - 1)
    return np.where(p > 0, b, 0).astype(np.int64)


def learn_weights(bucket: np.ndarray, odds: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """For every bucket of context counts the share of one order's estimates, by expectation-maximisation over n tokens of
    each (bucket, bin). Buckets without tokens take the share of all others together; contexts that were never seen have none."""
    ratio = np.where(odds > 0, 2.0 ** ((odds - BINS // 2 + 0.5) / BIN), 0)

    def share(mine: np.ndarray) -> float:
        r, m, w = ratio[mine], n[mine].astype(float), 0.5
        for _ in range(rounds):
            w = float((m * (w * r / (w * r + 1 - w))).sum() / m.sum())
        return min(max(w, 1e-7), 1 - 1e-7)

    weights = np.full(BUCKETS, share(bucket > 0) if (n[bucket > 0] > 0).any() else 0.5)
    for b in np.unique(bucket):
        weights[b] = share(bucket == b)
    weights[0] = 0.0
    return weights


def _mixed(p: np.ndarray, buckets: np.ndarray, weights: list[np.ndarray], floor: float) -> np.ndarray:
    """The mixture of the estimates of as many orders as have weights: each is mixed with what all lower ones give."""
    out = np.full(p.shape[1], floor)
    for k, w in enumerate(weights):
        share = w[buckets[k]]
        out = share * p[k] + (1 - share) * out
    return out


def score_texts(docs: DataFrame, trained: Column, held_out: Column, deleted: Column, order: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`.

    Tokens are the text's words, A-Z in lower case, and one end. The model learns from the rows where `trained` holds;
    the mixing weights come from those of them where `deleted` holds, under the counts of the others. base_score is the
    text's log10 probability under unigrams with 0.1 added to each count, score that of the mixture. Null and empty
    texts are one end. Null conditions don't hold. Rows that share a doc_id are texts of their own. With nothing to
    learn from, all words are new and the floor scores them. Other columns are not looked at.
    """
    held = lambda c: F.coalesce(c, F.lit(False))
    part = F.when(held(trained) & held(deleted), DELETED).when(held(trained), TRAIN).otherwise(OTHER)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"), part.cast("int").alias("_part"), held(held_out).alias("_held"))
    n_bytes = text_bytes(docs, text)
    parts, drop = parts_for(n_bytes, BLOCK_BYTES), _spare_bits(n_bytes, order)
    # the deleted part has blocks of its own, with odd numbers: learning the weights reads these alone
    blocks = blocks_of(rows.withColumn("_apart", F.col("_part") == DELETED), "_text", BLOCK_BYTES, ["_id"], "_apart")
    texts = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def question(block: int, payload) -> pa.Table:
        g = Grams.of(from_bytes(payload), order, drop)
        grams, place = np.unique(g.grams.ravel(), return_inverse=True)
        weight = np.repeat(g.part != OTHER, g.sizes)
        counts = np.bincount(place, weights=np.tile(weight, order), minlength=len(grams)).astype(np.int64)
        return cut_to_ranges(block, grams, parts, counts)

    def answer(group: pa.Table) -> pa.Table:
        release()
        odd = group.column("block").to_numpy() % 2 == 1
        sizes, (grams, counts) = read(group.column("payload"), np.uint64, np.int64)
        grams = ungapped(sizes, grams)
        deleted_part = np.repeat(odd, sizes)
        order_ = np.argsort(grams)
        grams = grams[order_]
        first = np.flatnonzero(np.diff(grams, prepend=~grams[:1]))
        whole, gone = (np.add.reduceat(np.where(apart, counts, 0)[order_], first) for apart in (True, deleted_part))
        found, kept = grams[first], whole - gone
        back = np.empty((2, len(grams)), np.int64)
        back[:, order_] = np.repeat(np.stack([whole, kept]), np.diff(np.append(first, len(grams))), axis=1)
        # the deleted part's blocks get the counts without it as well
        both = [messages(sizes[~odd], back[0][~deleted_part]), messages(sizes[odd], *back[:, deleted_part])]
        payloads = pa.concat_arrays(both).take(pa.array(np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))))
        single = found & np.uint64(3) == 0
        pad = [None] * (len(payloads) - 1)
        sums = [pa.array([int(x), *pad], pa.int64()) for x in (kept[single].sum(), (kept[single] > 0).sum(), whole[single].sum(), (whole[single] > 0).sum())]
        return pa.table([group.column("bucket").combine_chunks(), group.column("block").combine_chunks(), payloads, *sums], names=[*MESSAGE_SCHEMA.names, "n_kept", "v_kept", "n_all", "v_all"])

    fields = f"{MESSAGE}, n_kept long, v_kept long, n_all long, v_all long"
    answers = stage(ask(blocks, question).groupBy("bucket").applyInArrow(answer, fields))
    sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_kept", "v_kept", "n_all", "v_all")]).first()
    kept = Counts(sums.n_kept, sums.v_kept, texts.get(TRAIN, 0))
    whole = Counts(sums.n_all, sums.v_all, texts.get(TRAIN, 0) + texts.get(DELETED, 0))
    counted = answers.select("bucket", "block", "payload")

    def counts_of(left: pa.Table, right: pa.Table, odd: bool) -> tuple[Grams, list[np.ndarray]]:
        release()
        g = Grams.of(from_bytes(left.column("payload")[0].as_buffer()), order, drop)
        _, place = np.unique(g.grams.ravel(), return_inverse=True)
        return g, [x[place].reshape(g.grams.shape) for x in in_order(right, *[np.int64] * (1 + odd))]

    def observe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return OBSERVED_SCHEMA.empty_table()
        g, (_, counts) = counts_of(left, right, True)
        context = _contexts(g, counts, kept)
        return pa.table([[message(*counts, *context)]], schema=OBSERVED_SCHEMA)

    odd_blocks, odd_answers = (x.where("block % 2 = 1").groupBy("block") for x in (blocks, counted))
    observed = stage(odd_blocks.cogroup(odd_answers).applyInArrow(observe, "seen binary"))

    def cells(weights: list[np.ndarray]) -> DataFrame:
        """How often each (bucket of the context's count, bin of the ratio) of the next order stands in the deleted part."""
        k = len(weights)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(BUCKETS * BINS, np.int64)
            for x in batches:
                for seen in x.column("seen"):
                    read = columns(seen.as_buffer().to_pybytes(), *[np.int64] * (2 * order))
                    p, bucket = _estimates(np.stack(read[:order]), np.stack(read[order:]))
                    odds = _odds(p[k], _mixed(p, bucket, weights, 1 / (kept.distinct + 1)))
                    total += np.bincount(bucket[k] * BINS + odds, minlength=len(total))
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

        return observed.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))

    weights: list[np.ndarray] = []
    for _ in range(order):  # from the lowest order up: each is weighed against the mixture of those below
        seen = cells(weights).collect()  # at most BUCKETS * BINS rows
        cell, n = (np.array([r[c] for r in seen], np.int64) for c in ("cell", "n"))
        weights.append(learn_weights(cell // BINS, cell % BINS, n))

    kind = to_arrow_type(rows.schema["_id"].dataType)
    schema = pa.schema([("doc_id", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        odd = bool(left.column("block")[0].as_py() % 2)
        g, (counts, *_) = counts_of(left, right, odd)
        p, bucket = _estimates(counts, _contexts(g, counts, whole))
        mixed = _mixed(p, bucket, weights, 1 / (whole.distinct + 1))
        base = np.log10((counts[0] + 0.1) / (whole.tokens + 0.1 * (whole.distinct + 1)))
        owner = np.repeat(np.arange(len(g.sizes)), g.sizes)
        total = lambda x: np.bincount(owner, weights=x, minlength=len(g.sizes))
        known = total(counts[0] > 0).astype(np.int64)
        return pa.table([g.ids, g.held, g.sizes, known, np.full(len(g.sizes), whole.tokens, np.int64), total(base), total(np.log10(mixed))], schema=schema)

    fields = f"doc_id {dict(rows.dtypes)['_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(score, fields)
