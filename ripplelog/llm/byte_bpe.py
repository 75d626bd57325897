"""Byte-level BPE: encoding by ranked merges, and decoding.

Texts are cut into pieces by the tokenizer's pattern. Every batch of documents keeps its distinct pieces once, as byte
arrays; the merges are folded over all of these together, looking ranks up in a fixed table. The pieces' ids are then
laid out in the order of the documents. Nothing is shuffled.

The fold runs on NumPy arrays in an Arrow function: as a Spark higher-order function over the same byte arrays with the
same table as a literal it gave the same ids, but took 70 to 90 microseconds a word (see the README).
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.llm.common import col, release

#: Longer pieces are merged with a heap, in O(n log n), as a fold takes the square of a piece's length.
LONG = 64
NONE = 65_536
GROUP_BYTES = 4 << 20

#: What the pattern's classes are among the code points up to 0xFF. Unicode's letters, numbers and spaces.
LATIN = {r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe", r"\s": "\t-\r \x85\xa0"}


def finder(pattern: str):
    """text -> its pieces. Texts within Latin-1 are split by the same pattern with its classes spelled out, in half the time."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        token = next((t for t in (*LATIN, r"\S") if pattern.startswith(t, i)), pattern[i : i + 2] if pattern[i] == "\\" else pattern[i])
        if token == r"\S":
            out.append(f"[^{LATIN[r'\s']}]")
        elif token in LATIN:
            out.append(LATIN[token] if inside else f"[{LATIN[token]}]")
        else:
            inside = token == "[" or inside and token != "]"
            out.append(token)
        i += len(token)
    general, latin, beyond = regex.compile(pattern).findall, re.compile("".join(out)).findall, re.compile("[^\0-\xff]").search
    return lambda text: latin(text) if text.isascii() or not beyond(text) else general(text)


@dataclass
class Vocabulary:
    """The tokens of a rank file; a token's id is its rank."""

    tokens: list[bytes]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            ranks = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
        tokens = [b""] * (ranks[-1][0] + 1)
        for rank, token in ranks:
            tokens[rank] = token
        return cls(tokens)

    @cached_property
    def ids(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(self.tokens) if t}

    @cached_property
    def pairs(self) -> dict[int, int]:
        """left << 16 | right -> the token that both make, for all tokens that two others make."""
        ids, out = self.ids, {}
        for token, i in ids.items():
            for k in range(1, len(token)):
                a, b = ids.get(token[:k]), ids.get(token[k:])
                if a is not None and b is not None:
                    out[a << 16 | b] = i
        return out

    @cached_property
    def bytes_to_ids(self) -> np.ndarray:
        return np.array([self.ids[bytes([b])] for b in range(256)], np.int64)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a piece of any length: a heap of ranks over a linked list."""
        ids, pairs = [int(self.bytes_to_ids[b]) for b in piece], self.pairs
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[k], i, k) for i in range(n - 1) if (k := ids[i] << 16 | ids[i + 1]) in pairs]
        heapq.heapify(heap)
        while heap:
            rank, i, key = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] << 16 | ids[j] != key:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (k := ids[a] << 16 | ids[b]) in pairs:
                    heapq.heappush(heap, (pairs[k], a, k))
        return [i for i in ids if i >= 0]


class RankTable:
    """Pairs and their ranks: a pair can only stand in two places, given by its key's remainders by two primes."""

    def __init__(self, pairs: dict[int, int], p: int = 120_011, q: int = 140_009):
        entries = [-1] * (p + q)
        for key, rank in pairs.items():
            entry, at = key << 16 | rank, key % p
            for _ in range(500):
                entry, entries[at] = entries[at], entry
                if entry < 0:
                    break
                k = entry >> 16
                at = p + k % q if at < p else k % p
            else:
                raise ValueError("the rank table is too full")
        self.p, self.q, self.entries = p, q, np.array(entries, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of the pairs, NONE for those that make no token."""
        key = left << 16 | right
        out = np.full(len(key), NONE, np.int64)
        for place in (key % self.p, key % self.q + self.p):
            entry = self.entries[place]
            np.copyto(out, entry & 0xFFFF, where=entry >> 16 == key)
        return out


def fold_merges(ids: np.ndarray, sizes: np.ndarray, table: RankTable) -> tuple[np.ndarray, np.ndarray]:
    """Merges in every word the pair of lowest rank, the first of equals, until none of its pairs is a token.

    ids: the words' bytes as ids, one word after the other; sizes: how many each has. Returns both, merged. Each round
    merges one pair of every word that still has one; words without leave the rounds.
    """
    n = len(sizes)
    done_ids, done_words, words = [], [], np.arange(n)
    while len(words):
        owner = np.repeat(np.arange(len(words)), sizes)
        ranks = np.full(len(ids), NONE, np.int64)
        if len(ids) > 1:
            ranks[:-1] = np.where(owner[1:] == owner[:-1], table.ranks(ids[:-1], ids[1:]), NONE)
        starts = np.cumsum(sizes) - sizes
        least = np.minimum.reduceat(ranks, starts)
        over = (least == NONE)[owner]
        done_ids.append(ids[over])
        done_words.append(words[owner[over]])
        hits = np.flatnonzero((ranks == least[owner]) & ~over)
        hits = hits[np.diff(owner[hits], prepend=-1) != 0]  # the first in each word
        ids[hits] = ranks[hits]
        keep = ~over
        keep[hits + 1] = False
        sizes = (sizes - 1)[least != NONE]
        ids, words = ids[keep], words[least != NONE]
    owner = np.concatenate([np.zeros(0, np.int64), *done_words])
    flat = np.concatenate([np.zeros(0, np.int64), *done_ids])
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of `text` to every row of `docs` as array<int>; special tokens are ordinary text.

    A null or empty text has no ids. Texts of any length are encoded whole. A column already called `ids` is replaced.
    """
    names = [c for c in docs.columns if c != ids]
    docs = docs.select(*map(col, names))
    schema = docs.schema

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        group, size = [], 0
        for x in batches:
            for i in range(0, len(x), 1000):
                part = x.slice(i, 1000)
                group.append(part)
                size += part.nbytes
                if size >= GROUP_BYTES:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    class Numbers(dict):
        def __missing__(self, piece):
            self[piece] = n = len(self)
            return n

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table, find = vocabulary.ids, RankTable(vocabulary.pairs), finder(pattern)
        for group in grouped(batches):
            numbers, order = Numbers(), []
            for x in group:
                order += [np.fromiter(map(numbers.__getitem__, find(t or "")), np.int32) for t in x.column(names.index(text)).to_pylist()]
            # pieces that are tokens have their id, long ones are merged one by one, all others by the fold
            pieces = [p.encode() for p in numbers]
            whole = np.array([known.get(b, -1) for b in pieces], np.int64)
            lengths = np.array([len(b) for b in pieces], np.int64)
            fold = np.flatnonzero((whole < 0) & (lengths <= LONG))
            long = {i: vocabulary.merged(pieces[i]) for i in np.flatnonzero((whole < 0) & (lengths > LONG)).tolist()}
            flat = vocabulary.bytes_to_ids[np.frombuffer(b"".join([pieces[i] for i in fold]), np.uint8)]
            folded, counts = fold_merges(flat, lengths[fold], table)
            sizes = np.ones(len(pieces), np.int64)
            sizes[fold] = counts
            for i, merged in long.items():
                sizes[i] = len(merged)
            first = np.cumsum(sizes) - sizes
            ids_of = np.zeros(sizes.sum(), np.int32)
            ids_of[first[whole >= 0]] = whole[whole >= 0]
            ids_of[_spread(first[fold], counts)] = folded
            for i, merged in long.items():
                ids_of[first[i] : first[i] + len(merged)] = merged
            del numbers, pieces, flat, folded
            at = 0
            for x in group:
                part = np.concatenate([np.zeros(0, np.int32), *order[at : at + len(x)]])
                rows = np.cumsum([0, *(len(o) for o in order[at : at + len(x)])])
                at += len(x)
                past = np.concatenate([[0], np.cumsum(sizes[part])])
                lists = pa.ListArray.from_arrays(past[rows].astype(np.int32), pa.array(ids_of[_spread(first[part], sizes[part])]))
                yield pa.RecordBatch.from_arrays([*x.columns, lists], names=[*names, ids])
            release()

    return docs.mapInArrow(encoded, T.StructType([*schema, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... sizes[0] times, then the same from first[1], and so on."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes of `ids` as binary: the tokens' bytes one after the other. Null ids and ids that are no token decode to nothing.

    The tokens are one literal array, in hexadecimal; a column already called `decoded` is replaced.
    """
    tokens = F.split(F.lit(",".join(t.hex() for t in vocabulary.tokens)), ",")
    return encoded.withColumn(decoded, F.unhex(F.array_join(F.transform(F.coalesce(ids, F.array().cast("array<int>")), lambda i: F.get(tokens, i)), "")))
