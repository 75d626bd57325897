"""Removal of long repeated byte strings with suffix arrays.

1. In every string of the given length one k-gram, the one of the smallest hash, is its anchor: equal strings have equal
   anchors at equal places. Strings next to each other mostly share theirs, so a text is a row of short runs, each with
   one anchor; a run whose anchor moves from a string's second half to its first is cut there. All strings of a run share
   more than half of their bytes, and a hash of these is the run's key.
2. Blocks of documents ask about their runs by key. The answer says whether the same run stands in an earlier document,
   in which case it is a repeat as a whole, and whether the key has other runs as well. No bytes move for this.
3. The first of each kind of run, where its key has several kinds, differ in part. Their strings are asked about by
   hash; runs are trimmed to the strings that other runs have, too, and go to buckets by key.
4. A suffix array of a bucket's runs, by linear grouping, brings equal strings together; their bytes are compared, and all
   but the first are repeats.
5. The spans found go back to their documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ripplelog.llm.common import parts_for, stage, text_bytes
from ripplelog.llm.gsaca import suffix_array
from ripplelog.llm.packed import MESSAGE, MESSAGE_SCHEMA, ask, blocks_of, cut_to_ranges, from_bytes, in_order, messages, read, to_bytes, ungapped
from ripplelog.llm.words import mix, slices

BLOCK_BYTES = 8 << 20
#: Strings of one suffix array, in bytes. One place costs some 10 microseconds and 60 bytes.
ARRAY_BYTES = 1 << 18
HEAVY_BYTES = 16 << 20
SLICE = 1 << 18
_BYTE = np.random.default_rng(21).integers(1, 2**63, 256, dtype=np.uint64)
_NOBODY = -(2**63)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
EARLIER, VARIES, TIED = 1, 2, 4


def doubled(data: np.ndarray, most: int) -> list[np.ndarray]:
    """Hashes of 1, 2, 4 and so on up to `most` bytes from each place on."""
    levels, width = [_BYTE[data]], 1
    while 2 * width <= most:
        h = levels[-1][:-width] * _GOLD
        h += levels[-1][width:]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        levels.append(h)
        width *= 2
    return levels


def gram_hashes(levels: list[np.ndarray], width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of `width` bytes, from the places `at` on or from every place, put together of two that overlap."""
    h = levels[width.bit_length() - 1]
    step = width - (1 << (width.bit_length() - 1))
    return mix(h[: len(h) - step] * _GOLD + h[step:]) if at is None else mix(h[at] * _GOLD + h[at + step])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    width = 1
    while width < w:
        step = min(width, w - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


def runs(data: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """The runs of strings that share an anchor: text, first and last string's start, anchor's place, key and digest.

    All places are in the joined bytes; no string reaches over the end of its text. The anchor of a string is the first
    k-gram of the smallest hash. Equal strings stand in runs of one key; runs of one digest and key hold the same bytes.
    """
    sizes = np.diff(ends, prepend=0)
    holds = sizes >= length
    if not holds.any():
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    w = length - k + 1
    half = w // 2
    common = min(half + k, length - half + 1) if half else k
    levels = doubled(data, length)
    h = gram_hashes(levels, k)
    low = _sliding_min(h, w)  # of every string's k-grams
    inside = np.zeros(len(low) + 1, np.int8)
    inside[(ends - sizes)[holds]] = 1
    inside[(ends - length + 1)[holds]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0  # strings that don't reach over a text's end
    new = inside.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= new[1:] | ~inside[1:]
    a, b = np.flatnonzero(new), np.flatnonzero(last)
    owner, v = np.searchsorted(ends, a, side="right"), low[a]
    # where each run's anchor is: places of the smallest hash among the strings over them
    low[~inside] = 0
    width, high = 1, np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    while width < w:
        step = min(width, w - width)
        high = np.maximum(high[:-step], high[step:])
        width += step
    anchors = np.flatnonzero(high[: len(h)] == h)
    # each string has the first of its run's anchors that is not before it
    low_, high_ = np.searchsorted(anchors, a), np.searchsorted(anchors, b + w)
    n = high_ - low_
    run = np.repeat(np.arange(len(a)), n)
    p = anchors[np.arange(len(run)) + np.repeat(low_ - (np.cumsum(n) - n), n)]
    mine = h[p] == v[run]  # some are other runs' anchors
    run, p = run[mine], p[mine]
    start = a[run]
    again = run[1:] == run[:-1]
    start[1:][again] = p[:-1][again] + 1
    stop = np.minimum(b[run], p)
    # the anchor is in the second half of the strings up to p - half, in the first half of those behind
    early, late = (start <= stop) & (start <= p - half), (start <= stop) & (stop > p - half)
    owner = owner[run]
    key = np.concatenate([gram_hashes(levels, common, p[early] - half), ~gram_hashes(levels, common, p[late])])
    a = np.concatenate([start[early], np.maximum(start, p - half + 1)[late]])
    b = np.concatenate([np.minimum(stop, p - half)[early], stop[late]])
    owner, p = (np.concatenate([x[early], x[late]]) for x in (owner, p))
    # the first and the last string hold all of a run's bytes
    digest = mix((gram_hashes(levels, length, a) * _GOLD + gram_hashes(levels, length, b)) ^ mix((p - a).astype(np.uint64) << np.uint64(32) | (b - a).astype(np.uint64)))
    return owner, a, b, p, key, digest


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def _unique_rows(block: pa.Table) -> np.ndarray:
    """Whether each row of a block is the first of those that share doc and row, which stand together."""
    doc, row = (block.column(c).to_numpy() for c in ("doc", "row"))
    return np.concatenate([np.ones(min(1, len(doc)), bool), (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])])


@dataclass
class Runs:
    """The runs of a block in its order: the text's place in the block, its doc and row, the first string's start in the
    text, how many strings, how far the anchor is from the first, key and digest; and the bytes of those asked for."""

    i: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    left: np.ndarray
    key: np.ndarray
    digest: np.ndarray

    @classmethod
    def of(cls, block: pa.Table, length: int, k: int) -> Runs:
        alone = block.filter(pa.array(_unique_rows(block)))
        parts, before = [], 0
        for t in slices(alone, "text", SLICE):
            data, ends = _bytes_of(t.column("text").combine_chunks())
            # a long text is read in stretches that share all bytes but one of a string
            far = SLICE if len(t) == 1 and len(data) > 2 * SLICE else len(data) + 1
            for begin in range(0, max(1, len(data)), far):
                part = data[begin : begin + far + length - 1]
                owner, a, b, p, key, digest = runs(part, np.minimum(ends, len(part)), length, k)
                order = np.argsort(a, kind="stable")
                owner, a, b, p = owner[order], a[order], b[order], p[order]
                starts = (ends - np.diff(ends, prepend=0))[owner]
                parts.append((owner + before, a + begin - starts, b - a + 1, p - a, key[order], digest[order]))
            before += len(t)
        if not parts:
            none = np.zeros(0, np.int64)
            parts = [(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))]
        i, start, n, left, key, digest = (np.concatenate(x) for x in zip(*parts, strict=True))
        doc, row = (alone.column(c).to_numpy() for c in ("doc", "row"))
        return cls(i, doc[i], row[i], start, n, left, key, digest)

    def kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """The first of each kind (key and digest), in their order, and the place of every run's kind in these."""
        order = np.lexsort((self.digest, self.key))  # stable: the first in the block stays the first of its kind
        new = np.ones(len(order), bool)
        new[1:] = (self.key[order[1:]] != self.key[order[:-1]]) | (self.digest[order[1:]] != self.digest[order[:-1]])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return order[new], place


_SPANS = pa.schema([("i", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_TOLD = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("n", pa.int64()), ("payload", pa.binary())])
TOLD = "block long, kind string, n long, payload binary"


def _told(block: int, kind: str, n: int, table: pa.Table) -> pa.Table:
    return pa.table([[block], [kind], [n], [to_bytes(table)]], schema=_TOLD)


def _merged(i: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """Overlapping and touching spans of a text as one."""
    if not len(i):
        return _SPANS.empty_table()
    order = np.lexsort((start, i))
    i, start, end = i[order], start[order], end[order]
    number = np.cumsum(np.concatenate([[True], i[1:] != i[:-1]])) - 1
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * far) - number * far
    new = np.ones(len(i), bool)
    new[1:] = (number[1:] != number[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(i)) - 1
    return pa.table([i[first], start[first], reach[last]], schema=_SPANS)


def _later(group: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each group by document, row and start; and the rows that stand at a later place than it."""
    order = np.lexsort((start, row, doc, group))
    g = group[order]
    new = np.ones(len(order), bool)
    new[1:] = g[1:] != g[:-1]
    first = order[new]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    head = first[of] if len(order) else of
    return first, np.flatnonzero((doc != doc[head]) | (row != row[head]) | (start != start[head]))


def _groups(*keys: np.ndarray) -> np.ndarray:
    """A number for each different combination of keys."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _segment_strings(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all strings of some segments: the segment, the place in it, and the place in all of their joined bytes."""
    n = sizes - length + 1
    seg = np.repeat(np.arange(len(sizes)), n)
    inner = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    return seg, inner, inner + np.repeat(np.cumsum(sizes) - sizes, n)


def _string_hashes(segments: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of all strings of the segments, their segments and their places in these; some segments at a time."""
    hashes, segs, inners, before = [], [], [], 0
    for part in slices(pa.table({"b": segments}), "b", SLICE):
        data, ends = _bytes_of(part.column("b").combine_chunks())
        seg, inner, at = _segment_strings(np.diff(ends, prepend=0), length)
        hashes.append(gram_hashes(doubled(data, length), length, at) if len(at) else np.zeros(0, np.uint64))
        segs.append((seg + before).astype(np.int32))
        inners.append(inner.astype(np.int32))
        before += part.num_rows
    none = np.zeros(0, np.int32)
    return np.concatenate([none.astype(np.uint64), *hashes]), np.concatenate([none, *segs]), np.concatenate([none, *inners])


def _stretches(chosen: np.ndarray, seg: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen strings that follow each other in a segment: the segment, and the first and last string."""
    beside = np.concatenate([[False], chosen[:-1] & (seg[1:] == seg[:-1])])
    open_ = chosen & ~beside
    close = chosen & ~np.concatenate([beside[1:] & chosen[1:], [False]])
    return seg[open_].astype(np.int64), inner[open_].astype(np.int64), inner[close].astype(np.int64)


def array_repeats(segments: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, segment, place) of the strings of `segments`: equal strings are neighbours in a suffix array and have one group."""
    data, ends = _bytes_of(segments)
    sizes = np.diff(ends, prepend=0)
    # a mark that is no byte ends each segment
    text = np.zeros(len(data) + len(sizes), np.int16)
    text[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data.astype(np.int16) + 1
    seg, inner, at = _segment_strings(sizes, length)
    of = np.full(len(text), -1)
    of[at + seg] = np.arange(len(seg))
    ordered = suffix_array(text)
    ordered = ordered[of[ordered] >= 0]
    same = np.zeros(len(ordered), bool)
    window = np.arange(length)
    for i in range(1, len(ordered), 10_000):
        a, b = ordered[i - 1 : i + 9_999], ordered[i : i + 10_000]
        same[i : i + len(b)] = (text[a[: len(b)][:, None] + window] == text[b[:, None] + window]).all(axis=1)
    return np.cumsum(~same), seg[of[ordered]], inner[of[ordered]]


def _arrays(t: pa.Table, length: int) -> Iterator[pa.Table]:
    """The segments in parts of about ARRAY_BYTES for one suffix array each. Those of a key stay together; where they are
    more than that, they are cut into their strings, and these are dealt out by hash: equal ones stay together."""
    sizes = pc.binary_length(t.column("bytes")).to_numpy().astype(np.int64)
    reach = np.cumsum(sizes)
    key = t.column("key").to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
    start = 0
    for a, b in zip(edges, edges[1:], strict=False):
        alone = reach[b - 1] - (reach[a - 1] if a else 0)
        if start < a and reach[b - 1] - (reach[start - 1] if start else 0) > ARRAY_BYTES:
            yield t.slice(start, a - start)
            start = a
        if alone > ARRAY_BYTES:
            whole = t.slice(a, b - a)
            hashes, seg, inner = _string_hashes(whole.column("bytes").combine_chunks(), length)
            raw = whole.column("bytes").to_pylist()
            part = (hashes % np.uint64(max(1, len(seg) * length // ARRAY_BYTES))).astype(np.int64)
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(part == p)
                some = whole.take(pa.array(seg[mine])).drop_columns(["start", "bytes"])
                cut = [raw[s][i : i + length] for s, i in zip(seg[mine].tolist(), inner[mine].tolist(), strict=True)]
                yield some.append_column("start", pa.array(whole.column("start").to_numpy()[seg[mine]] + inner[mine])).append_column("bytes", pa.array(cut, pa.binary()))
            start = b
    if start < len(key):
        yield t.slice(start)


def settle(told: pa.Table, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of (block, i, start, end): bytes of the segments of a bucket that an earlier place also holds."""
    t = told.take(pc.sort_indices(told, sort_keys=[("key", "ascending")]))
    key, left, block, i, doc, row, start = (t.column(c).to_numpy() for c in ("key", "left", "block", "i", "doc", "row", "start"))
    # segments that are the same as a whole go into an array once
    kind = _groups(left, key, pc.dictionary_encode(t.column("bytes").combine_chunks()).indices.to_numpy())
    first, later = _later(kind, doc, row, start)
    sizes = pc.binary_length(t.column("bytes")).to_numpy().astype(np.int64)
    yield block[later], i[later], start[later], (start + sizes)[later]
    # rows that share doc and row but not the block: what is found for one of them holds for all
    alike = np.ones(len(kind), bool)
    alike[first] = alike[later] = False
    twins: dict[int, list[int]] = {}
    for j in np.flatnonzero(alike).tolist():
        twins.setdefault(int(kind[j]), []).append(j)
    for part in _arrays(t.append_column("at", pa.array(np.arange(len(kind)))).take(pa.array(np.sort(first))), length):
        group, seg, inner = array_repeats(part.column("bytes").combine_chunks(), length)
        at, begin = part.column("at").to_numpy()[seg], part.column("start").to_numpy()[seg] + inner
        # a string's anchor is at the same place in all equal ones, so that a group never holds two keys
        _, later = _later(group, doc[at], row[at], begin)
        at, begin = at[later], begin[later]
        yield block[at], i[at], begin, begin + length
        for head in np.unique(at).tolist() if twins else ():
            for j in twins.get(int(kind[head]), ()):
                mine = begin[at == head]
                yield np.full(len(mine), block[j]), np.full(len(mine), i[j]), mine, mine + length


def repeated_spans(blocks: DataFrame, length: int, k: int, n_bytes: int, heavy: int = HEAVY_BYTES) -> DataFrame:
    """block, kind, n and payload (i, start, end): spans of the blocks' texts covered by strings that also start earlier.

    heavy: the segments of a context that have more bytes than this are not brought together, but each of their strings."""
    parts = parts_for(n_bytes, BLOCK_BYTES)

    def question(block: int, payload) -> pa.Table:
        r = Runs.of(from_bytes(payload), length, k)
        first, _ = r.kinds()
        return cut_to_ranges(block, r.key[first], parts, r.digest[first], r.doc[first])

    def answer(group: pa.Table) -> pa.Table:
        sizes, (key, digest, doc) = read(group.column("payload"), np.uint64, np.uint64, np.int64)
        key = ungapped(sizes, key)
        order = np.lexsort((doc, digest, key))
        key, digest, doc = key[order], digest[order], doc[order]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key | np.concatenate([[True], digest[1:] != digest[:-1]])
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        kinds_of = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
        tied = new & np.concatenate([(doc[1:] == doc[:-1]) & ~new[1:], [False]])  # the first one, with the next
        flags = np.where(doc > doc[head], EARLIER, 0) | np.where(kinds_of > 1, VARIES, 0) | np.where(tied[head], TIED, 0)
        back = np.empty(len(flags), np.uint8)
        back[order] = flags
        return pa.table([group.column("bucket").combine_chunks(), group.column("block").combine_chunks(), messages(sizes, back)], schema=MESSAGE_SCHEMA)

    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _TOLD.empty_table()
        block, table = left.column("block")[0].as_py(), from_bytes(left.column("payload")[0].as_buffer())
        r = Runs.of(table, length, k)
        first, place = r.kinds()
        flags = in_order(right, np.uint8)[0]
        repeat = (flags[place] & EARLIER) > 0
        again = np.ones(len(place), bool)
        again[first] = False
        gone = np.flatnonzero(repeat | again)
        out = [_told(block, "spans", len(gone), _merged(r.i[gone], r.start[gone], r.start[gone] + r.n[gone] + length - 1))]
        open_ = first[(flags & EARLIER == 0) & (flags & (VARIES | TIED) > 0)]
        if len(open_):
            texts = table.filter(pa.array(_unique_rows(table))).column("text").to_pylist()
            raw: dict[int, bytes] = {}
            cut = []
            for i, s, n in zip(r.i[open_].tolist(), r.start[open_].tolist(), r.n[open_].tolist(), strict=True):
                if i not in raw:
                    raw[i] = (texts[i] or "").encode()
                cut.append(raw[i][s : s + n + length - 1])
            fields = {c: getattr(r, c)[open_] for c in ("key", "left", "i", "doc", "row", "start")}
            out.append(_told(block, "open", int(r.n[open_].sum()), pa.table({**fields, "bytes": pa.array(cut, pa.binary())})))
        return pa.concat_tables(out)

    answers = ask(blocks, question).groupBy("bucket").applyInArrow(answer, MESSAGE)
    told = stage(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tell, TOLD))

    # what is open: the first of each kind of run, where a key has several
    opened = told.where("kind = 'open'")
    strings = opened.agg(F.sum("n")).first()[0] or 0
    parts_open = parts_for(8 * strings, BLOCK_BYTES // 16)

    def question_open(block: int, payload) -> pa.Table:
        t = from_bytes(payload)
        hashes, _, _ = _string_hashes(t.column("bytes").combine_chunks(), length)
        found, count = np.unique(hashes, return_counts=True)
        keys, of = np.unique(t.column("key").to_numpy(), return_inverse=True)
        weights = np.bincount(of, weights=pc.binary_length(t.column("bytes")).to_numpy()).astype(np.int64)
        asked = cut_to_ranges(block, keys, parts_open, weights)  # of keys: how many bytes there are in all
        asked = asked.set_column(0, "bucket", pc.add(asked.column("bucket"), pa.scalar(parts_open, pa.int32())))
        return pa.concat_tables([cut_to_ranges(block, found, parts_open, (count > 1).astype(np.uint8)), asked])

    def answer_open(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() >= parts_open:
            sizes, (steps, weights) = read(group.column("payload"), np.uint64, np.int64)
            _, place = np.unique(ungapped(sizes, steps), return_inverse=True)
            back = np.bincount(place, weights=weights)[place] > heavy
        else:
            sizes, (steps, more) = read(group.column("payload"), np.uint64, np.uint8)
            _, place, count = np.unique(ungapped(sizes, steps), return_inverse=True, return_counts=True)
            back = (count[place] > 1) | (more > 0)
        return pa.table([group.column("bucket").combine_chunks(), group.column("block").combine_chunks(), messages(sizes, back.astype(np.uint8))], schema=MESSAGE_SCHEMA)

    def trim(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return MESSAGE_SCHEMA.empty_table()
        block, t = left.column("block")[0].as_py(), from_bytes(left.column("payload")[0].as_buffer())
        hashes, seg, inner = _string_hashes(t.column("bytes").combine_chunks(), length)
        of_key = pc.greater_equal(right.column("bucket"), parts_open)
        _, place = np.unique(hashes, return_inverse=True)
        chosen = in_order(right.filter(pc.invert(of_key)), np.uint8)[0][place] > 0
        firsts = np.searchsorted(seg, np.arange(t.num_rows))  # of each segment's strings
        seg, low, high = _stretches(chosen, seg, inner)
        if not len(seg):
            return MESSAGE_SCHEMA.empty_table()
        _, of = np.unique(t.column("key").to_numpy(), return_inverse=True)
        # the strings of a key that has too many bytes for a task are dealt out by themselves, equal ones to one bucket
        alone = (in_order(right.filter(of_key), np.uint8)[0][of] > 0)[seg]
        n = np.where(alone, high - low + 1, 1)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        seg, low, high, alone = (np.repeat(x, n) for x in (seg, low, high, alone))
        low, high = np.where(alone, low + step, low), np.where(alone, low + step, high)
        whole = t.column("bytes").to_pylist()
        cut = [whole[s][a : b + length] for s, a, b in zip(seg.tolist(), low.tolist(), high.tolist(), strict=True)]
        c = {x: t.column(x).to_numpy()[seg] for x in ("key", "left", "i", "doc", "row", "start")}
        trimmed = pa.table({**c, "left": c["left"] - low, "start": c["start"] + low, "bytes": pa.array(cut, pa.binary())})
        bucket = (np.where(alone, mix(hashes[firsts[seg] + low]), c["key"]) % np.uint64(parts_open)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
        trimmed = trimmed.take(pa.array(order))
        filled = list(zip(edges, edges[1:], strict=False))
        return pa.table([pa.array(bucket[order][edges[:-1]], pa.int32()), pa.array([block] * len(filled), pa.int64()), pa.array([to_bytes(trimmed.slice(a, b - a).combine_chunks()) for a, b in filled], pa.binary())], schema=MESSAGE_SCHEMA)

    def settled(group: pa.Table) -> pa.Table:
        tables = []
        for block, payload in zip(group.column("block").to_pylist(), group.column("payload"), strict=True):
            t = from_bytes(payload.as_buffer())
            tables.append(t.append_column("block", pa.array(np.full(t.num_rows, block))))
        found = [np.concatenate(x) for x in zip(*settle(pa.concat_tables(tables), length), strict=True)]
        out = []
        for block in np.unique(found[0]).tolist():
            mine = found[0] == block
            out.append(_told(block, "spans", int(mine.sum()), _merged(*(x[mine] for x in found[1:]))))
        return pa.concat_tables([_TOLD.empty_table(), *out])

    answers = ask(opened.select("block", "payload"), question_open).groupBy("bucket").applyInArrow(answer_open, MESSAGE)
    trimmed = opened.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(trim, MESSAGE)
    return told.where("kind = 'spans'").union(trimmed.groupBy("bucket").applyInArrow(settled, TOLD))


def drop_repeated_strings(docs: DataFrame, length: int = 100, k: int = 20, doc_id: str = "doc_id", text: str = "text", heavy: int = HEAVY_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every row of `docs`.

    Every byte of the texts as UTF-8 goes that a string of `length` bytes covers which also starts earlier: in a smaller
    doc_id, or before it in the same document. Strings are judged on the input and never reach over a document's end;
    n_spans counts the runs that went. What is kept may cut a character. Null and empty texts have no bytes. A null
    doc_id is smaller than any other; rows that share a doc_id follow each other by a hash of the text, and rows that
    share both count once and are treated alike. Other columns are not looked at.

    Runs of strings that are the same as a whole are told by two 64-bit hashes of their bytes, all others byte by byte.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_NOBODY)).alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("text"))
    blocks = blocks_of(rows, "text", BLOCK_BYTES, ["doc", "row"])
    spans = repeated_spans(blocks, length, k, text_bytes(docs, text), heavy)
    kind = dict(rows.dtypes)["_id"]
    fields = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    schema = pa.schema([("doc_id", to_arrow_type(rows.schema["_id"].dataType)), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        table = from_bytes(left.column("payload")[0].as_buffer())
        found: dict[int, list[tuple[int, int]]] = {}
        spans = pa.concat_tables([_SPANS.empty_table(), *(from_bytes(p.as_buffer()) for p in right.column("payload"))])
        for i, a, b in zip(*(c.to_pylist() for c in _merged(*(c.to_numpy() for c in spans.columns)).columns), strict=True):
            found.setdefault(i, []).append((a, b))
        n, removed, count, kept = [], [], [], []
        for i, x in zip((np.cumsum(_unique_rows(table)) - 1).tolist(), table.column("text").to_pylist(), strict=True):
            raw, mine = x.encode(), found.get(i, [])
            edges = [0, *(e for s in mine for e in s), len(raw)]
            n.append(len(raw))
            removed.append(sum(b - a for a, b in mine))
            count.append(len(mine))
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        return pa.table([table.column("_id"), n, removed, count, kept], schema=schema)

    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, fields)
