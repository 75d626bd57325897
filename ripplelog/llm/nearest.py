"""Nearest neighbours by a block matrix join.

Queries are dealt into strips and candidates into groups of blocks; a strip meets every group once. Vectors travel as 8-bit
codes with their scale and rounding error, and as they are. A tile, some queries by a block of candidates, multiplies the
codes and bounds what quantisation can have changed. Pairs that cannot be ruled out by these bounds are computed anew from
the original vectors in double precision; heaps merge a query's best over the tiles of a group, and over the groups.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.common import col, parts_for, stage

QUERY_ROWS = 1024  # of a tile
#: Bytes of a block of candidates, and of the strips and groups, two of which a task holds at a time.
BLOCK_BYTES, STRIP_BYTES = 1 << 20, 32 << 20
PACKED = "block int, dim int, ids binary, codes binary, scales binary, errors binary, vectors binary"


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """_id and _v (array<float> or array<double>) of the vectors that take part; equal ids are one vector, the smallest as an array."""
    kind = vectors.select(col(embedding)).schema[0].dataType.simpleString()
    v = col(embedding) if kind == "array<float>" else col(embedding).cast("array<double>")
    bad = v.isNull() | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    return vectors.where(~bad & col(vec_id).isNotNull()).select(col(vec_id).cast("long").alias("_id"), v.alias("_v")).groupBy("_id").agg(F.min("_v").alias("_v"))


def _tamed(v: np.ndarray) -> np.ndarray:
    """In double precision, each vector times a power of two, so that squares neither overflow nor vanish: cosines stay as they are."""
    v = v.astype(np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def _codes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the unit vectors in -127..127, each vector's scale, and the length of what rounding has left."""
    v = _tamed(v)
    unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    codes = np.rint(unit / scale)
    return codes.astype(np.int8), scale[:, 0], np.sqrt(((unit - codes * scale) ** 2).sum(axis=1))


class Block:
    """The vectors of one packed row."""

    def __init__(self, row: dict, kind: type):
        self.ids, self.scales, self.errors = (np.frombuffer(row[c], k) for c, k in (("ids", np.int64), ("scales", np.float64), ("errors", np.float64)))
        self.codes, self.vectors = (np.frombuffer(row[c], k).reshape(len(self.ids), -1) for c, k in (("codes", np.int8), ("vectors", kind)))

    def __getitem__(self, some: slice) -> Block:
        out = object.__new__(Block)
        out.__dict__.update({k: v[some] for k, v in self.__dict__.items()})
        return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: sums of up to 1,024 of them are whole numbers that float32 holds exactly."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1024):
        out += a[:, k : k + 1024].astype(np.float32) @ b[:, k : k + 1024].astype(np.float32).T
    return out


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, all sums from the first component to the last."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for k in range(a.shape[1]):
        dot += a[:, k] * b[:, k]
        aa += a[:, k] * a[:, k]
        bb += b[:, k] * b[:, k]
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def tile(asked: Block, found: Block, k: int, floor: np.ndarray) -> Iterator[tuple[int, float, int]]:
    """(query, cosine, id) of all pairs that can be among a query's k best; floor: a value that k of its pairs reach."""
    near = _product(asked.codes, found.codes) * asked.scales[:, None] * found.scales[None, :]
    # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|, with unit x and y; a little more for the roundings on the way
    error = asked.errors[:, None] + (1 + asked.errors[:, None]) * found.errors[None, :] + 1e-9
    own = asked.ids[:, None] == found.ids[None, :]
    low = np.where(own, -np.inf, near - error)
    reach = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k] if len(found.ids) > k else -np.inf)
    q, c = np.nonzero((near + error >= reach[:, None]) & ~own)
    scores = [_cosines(_tamed(asked.vectors[q[i : i + 4096]]), _tamed(found.vectors[c[i : i + 4096]])) for i in range(0, len(q), 4096)]
    return zip(q.tolist(), np.concatenate([np.zeros(0), *scores]).tolist(), found.ids[c].tolist(), strict=True)


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k rows nearest to every query by cosine, nearest first.

    Exact, in double precision; ties go to the smaller vec_id. All rows but the query's own are candidates; with fewer
    than k of them, all are returned. Vectors that are null, zero, or hold null or non-finite components take no part,
    nor do rows with a null vec_id. Rows that share a vec_id are one vector. Vectors of different lengths are never
    compared. Other columns are not looked at; is_query says of a vec_id whether it is asked for.
    """
    rows = stage(usable(vectors, vec_id, embedding))
    kind, width = (np.float32, 4) if rows.schema["_v"].dataType.simpleString() == "array<float>" else (np.float64, 8)
    each = F.size("_v").cast("long") * (1 + width) + 24
    n_bytes, n_asked = rows.agg(F.coalesce(F.sum(each), F.lit(0)), F.coalesce(F.sum(F.when(is_query(F.col("_id")), each)), F.lit(0))).first()
    strips, blocks = parts_for(n_asked, STRIP_BYTES), parts_for(n_bytes, BLOCK_BYTES)
    # enough groups for all cores, where the vectors are few
    groups = max(parts_for(n_bytes, STRIP_BYTES), min(blocks, 2 * vectors.sparkSession.sparkContext.defaultParallelism))

    def pack(group: pa.Table) -> pa.Table:
        ids, dim = group.column("_id").to_numpy(), group.column("dim")[0].as_py()
        v = group.column("_v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        codes, scales, errors = _codes(v)
        row = {"block": pa.array([group.column("block")[0].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32())}
        return pa.table(row | {c: [x.tobytes()] for c, x in (("ids", ids), ("codes", codes), ("scales", scales), ("errors", errors), ("vectors", v))})

    def packed(rows: DataFrame, n: int) -> DataFrame:
        numbered = rows.select("_id", "_v", F.size("_v").alias("dim"), F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int").alias("block"))
        return numbered.groupBy("block", "dim").applyInArrow(pack, PACKED)

    def dealt(rows: DataFrame, strip: Column, group: Column):
        n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as few bytes are much work
        return rows.withColumn("strip", strip).withColumn("part", group).repartition(n, "strip", "part", "dim").groupBy("strip", "part", "dim")

    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # the stated queries' strips meet all groups of candidates
    queries = dealt(packed(rows.where(is_query(F.col("_id"))), strips), F.col("block"), numbers(groups))
    candidates = dealt(packed(rows, blocks), numbers(strips), F.col("block") % groups)
    result = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for strip in left.to_pylist():
            for i in range(0, len(strip["ids"]) // 8, QUERY_ROWS):
                asked = Block(strip, kind)[i : i + QUERY_ROWS]
                for x in range(right.num_rows):
                    floor = np.array([h[0][0] if len(h := heaps.get(q, [])) == k else -np.inf for q in asked.ids.tolist()])
                    for q, score, c in tile(asked, Block(right.slice(x, 1).to_pylist()[0], kind), k, floor):
                        heap = heaps.setdefault(int(asked.ids[q]), [])
                        if len(heap) < k:
                            heapq.heappush(heap, (score, -c))
                        elif (score, -c) > heap[0]:
                            heapq.heapreplace(heap, (score, -c))
        found = [(q, s, -c) for q, heap in heaps.items() for s, c in heap]
        return pa.table([pa.array([f[j] for f in found], t.type) for j, t in enumerate(result)], schema=result)

    def merge(group: pa.Table) -> pa.Table:
        scores, ids = group.column("score").to_pylist(), group.column("vec_id").to_pylist()
        best = heapq.nsmallest(k, ((-s, c) for s, c in zip(scores, ids, strict=True)))
        query = group.column("query_id")[0].as_py()
        return pa.table({"query_id": [query] * len(best), "rank": pa.array(range(1, len(best) + 1), pa.int32()), "vec_id": pa.array([c for _, c in best], pa.int64()), "score": pa.array([-s for s, _ in best], pa.float64())})

    return queries.cogroup(candidates).applyInArrow(search, "query_id long, score double, vec_id long").groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
