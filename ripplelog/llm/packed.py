"""Rows dealt out in blocks, and the messages that blocks and buckets exchange.

A block is the rows that a task has read together, up to a size: one compressed Arrow table. The blocks are written once,
as a bucketed table, so that what is found out about a block later meets it without moving its texts again.

A message holds columns of numbers, byte by byte: all lowest bytes, then all second ones and so on. There are at most as
many messages as they have entries, as none is empty, and an entry that travels alone takes about as much as a row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ripplelog.llm.common import parts_for, release, stage_path, text_bytes
from ripplelog.llm.words import slices

MESSAGE = "bucket int, block long, payload binary"
MESSAGE_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
#: Spark's own limit on the buckets of a table is higher.
MOST_BUCKETS = 50_000


def to_bytes(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def from_bytes(payload) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(payload) if isinstance(payload, bytes) else payload).read_all()


def message(*columns: np.ndarray) -> bytes:
    """The columns, of one length, as bytes; long ones are compressed."""
    raw = np.int32(len(columns[0])).tobytes() + b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in map(np.ascontiguousarray, columns))
    return b"\0" + raw if len(raw) < PLAIN else b"\1" + np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def columns(payload: bytes, *kinds: type) -> list[np.ndarray]:
    """What message() was made of."""
    raw = payload[1:] if payload[:1] == b"\0" else pa.decompress(payload[9:], int(np.frombuffer(payload[1:9], np.int64)[0]), "zstd", asbytes=True)
    n, at, out = int(np.frombuffer(raw[:4], np.int32)[0]), 4, []
    for kind in map(np.dtype, kinds):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


#: Messages of fewer bytes, with the number of entries, are not compressed.
PLAIN = 100


def messages(sizes: np.ndarray, *cols: np.ndarray) -> pa.Array:
    """message() of each of so many entries of the columns in turn. Short messages, which most are where there are very many
    buckets, are written together, those of one length at a time."""
    starts, each = np.cumsum(sizes) - sizes, sum(c.itemsize for c in cols)
    cols, parts, order = [np.ascontiguousarray(c) for c in cols], [], []
    short = 4 + sizes * each < PLAIN
    for n in np.unique(sizes[short]).tolist():
        mine = np.flatnonzero(short & (sizes == n))
        rows = np.zeros((len(mine), 5 + n * each), np.uint8)
        rows[:, 1:5] = np.frombuffer(np.int32(n).tobytes(), np.uint8)  # behind the mark of plain bytes
        place, at = 5, starts[mine][:, None] + np.arange(n)
        for c in cols:
            planes = c[at].view(np.uint8).reshape(len(mine), n, c.itemsize).transpose(0, 2, 1)
            rows[:, place : place + n * c.itemsize] = planes.reshape(len(mine), -1)
            place += n * c.itemsize
        offsets = np.arange(len(mine) + 1, dtype=np.int64) * rows.shape[1]
        parts.append(pa.Array.from_buffers(pa.large_binary(), len(mine), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]).cast(pa.binary()))
        order.append(mine)
    long = np.flatnonzero(~short)
    parts.append(pa.array([message(*(c[x : x + n] for c in cols)) for x, n in zip(starts[long].tolist(), sizes[long].tolist(), strict=True)], pa.binary()))
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate([*order, long]))))


def read(payloads: pa.Array | pa.ChunkedArray, *kinds: type) -> tuple[np.ndarray, list[np.ndarray]]:
    """How many entries each message has, and the columns of all of them, one message behind the other."""
    payloads = payloads.combine_chunks() if isinstance(payloads, pa.ChunkedArray) else payloads
    kinds, large = [np.dtype(k) for k in kinds], payloads.cast(pa.large_binary())
    each = sum(k.itemsize for k in kinds)
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1] if len(large) else np.zeros(1, np.int64)
    data = np.frombuffer(large.buffers()[2] or b"", np.uint8)
    begins, lengths = offsets[:-1], np.diff(offsets)
    plain = (data[begins] == 0) & (lengths <= PLAIN) if len(large) else np.zeros(0, bool)
    sizes = np.where(plain, (lengths - 5) // each, 0)
    longer = {i: columns(large[i].as_py(), *kinds) for i in np.flatnonzero(~plain).tolist()}
    for i, found in longer.items():
        sizes[i] = len(found[0])
    starts = np.cumsum(sizes) - sizes
    out = [np.empty(int(sizes.sum()), k) for k in kinds]
    for n in np.unique(sizes[plain]).tolist():
        mine, place = np.flatnonzero(plain & (sizes == n)), 5
        at = (starts[mine][:, None] + np.arange(n)).ravel()
        for j, k in enumerate(kinds):
            planes = data[begins[mine][:, None] + np.arange(place, place + n * k.itemsize)].reshape(len(mine), k.itemsize, n).transpose(0, 2, 1)
            out[j][at] = np.ascontiguousarray(planes).view(k).ravel()
            place += n * k.itemsize
    for i, found in longer.items():
        for j, c in enumerate(found):
            out[j][starts[i] : starts[i] + sizes[i]] = c
    return sizes, out


def gaps(ordered: np.ndarray) -> np.ndarray:
    """The distances between numbers in order, which pack better; np.cumsum gives the numbers again."""
    return np.diff(ordered, prepend=np.uint64(0))


def ungapped(sizes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The numbers of which each message has the gaps."""
    if not len(steps):
        return steps
    total = np.cumsum(steps, dtype=np.uint64)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    return total - np.repeat(total[starts] - steps[starts], sizes[sizes > 0])


def blocks_of(rows: DataFrame, text: str, size: int, order: list[str], apart: str | None = None) -> DataFrame:
    """block, payload (to_bytes of the rows, sorted by `order`) of all rows, in blocks of about `size` bytes of `text`.

    The blocks are a bucketed table in the shared folder: grouping by `block` doesn't shuffle them. A block is made of
    what one task reads, so that a text longer than `size` is a block of its own and small partitions make small blocks.
    Rows for which the boolean `apart` holds have blocks of their own, with odd numbers.
    """
    spark = rows.sparkSession

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, groups = TaskContext.get().partitionId() << 32, 0, {False: [0], True: [0]}

        def flush(odd: bool) -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(groups[odd][1:])
            table = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
            number, groups[odd] = number + 1, [0]
            return pa.RecordBatch.from_pydict({"block": pa.array([first + 2 * number + odd], pa.int64()), "payload": pa.array([to_bytes(table.combine_chunks())], pa.binary())})

        for whole in batches:
            for x in slices(whole, text, size // 4):
                odd = x.column(apart) if apart else pa.array([False] * len(x))
                for side, part in ((False, x.filter(pc.invert(odd))), (True, x.filter(odd))):
                    if len(part):
                        groups[side].append(part)
                        groups[side][0] += pc.sum(pc.binary_length(part.column(text))).as_py() or 0
                        if groups[side][0] >= size:
                            yield flush(side)
                            release()
        for side in (False, True):
            if len(groups[side]) > 1:
                yield flush(side)

    found = rows.mapInArrow(packed, "block long, payload binary")
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = min(MOST_BUCKETS, parts_for(text_bytes(rows, text), size))
    found.write.bucketBy(buckets, "block").format("parquet").option("path", stage_path(spark)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name alone: the files are outside the warehouse and stay
    return table


def ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of `parts` equal ranges of 64-bit numbers each key is in: key * parts / 2**64, by halves."""
    n, low = np.uint64(parts), np.uint64(32)
    return (((keys >> low) * n + (((keys & np.uint64(0xFFFFFFFF)) * n) >> low)) >> low).astype(np.int64)


def cut_to_ranges(block: int, keys: np.ndarray, parts: int, *others: np.ndarray) -> pa.Table:
    """Messages of a block to `parts` buckets: keys (in order) by their range, with the other columns beside them. The work
    follows the keys, not the buckets."""
    bucket = ranges(keys, parts)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    sizes = np.diff(np.append(starts, len(keys)))
    steps = gaps(keys)
    steps[starts] = keys[starts]  # each message begins anew
    return pa.table([pa.array(bucket[starts], pa.int32()), pa.array(np.full(len(starts), block), pa.int64()), messages(sizes, steps, *others)], schema=MESSAGE_SCHEMA)


def ask(blocks: DataFrame, question: Callable[[int, bytes], pa.Table]) -> DataFrame:
    """The messages that `question` makes of each block's number and payload."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for block, payload in zip(x.column("block").to_pylist(), x.column("payload"), strict=True):
                yield from question(block, payload.as_buffer()).combine_chunks().to_batches()
                release()

    return blocks.mapInArrow(asked, MESSAGE)


def in_order(group: pa.Table, *kinds: type) -> list[np.ndarray]:
    """A block's answers from all buckets, in the buckets' order, as one."""
    order = np.argsort(group.column("bucket").to_numpy(), kind="stable")
    return read(group.column("payload").combine_chunks().take(pa.array(order)), *kinds)[1]
