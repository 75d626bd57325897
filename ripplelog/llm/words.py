"""Words and their fingerprints, for whole Arrow columns at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(x: pa.RecordBatch | pa.Table, column: str, most: int) -> Iterator[pa.RecordBatch | pa.Table]:
    """The rows of x in parts of about `most` bytes of a text column, or of one longer text."""
    sizes = np.cumsum(pc.binary_length(pc.fill_null(x.column(column), "")).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield x.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    spare = out >> np.uint64(27)
    out ^= spare
    out *= np.uint64(0x94D049BB133111EB)
    np.right_shift(out, np.uint64(31), out=spare)
    out ^= spare
    return out


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z in lower case, and where each text's words end. Nulls have none.

    Words are what stands between the bytes 0x20 and 0x09 to 0x0D.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, counts = pc.list_flatten(parts), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.greater(pc.binary_length(words), 0)
    if pc.all(real).as_py() is False:  # white space at the ends, or an empty text
        keep = real.to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(keep)])
        ends = before[np.cumsum(counts)]
        return words.filter(real), ends
    return words, np.cumsum(counts)


#: Longer words are hashed one by one.
_LONGEST = 64


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time; what was read so far is mixed before each next step.

    Different words have the same hash by chance only, one pair in 2**64; results that count words rest on that.
    """
    words = words.cast(pa.large_binary())
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.uint64, buffer=padded, strides=(1,))  # the eight bytes from each place on
    out = mix(sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    todo = np.flatnonzero((sizes > 0) & (sizes <= _LONGEST))
    step = 0
    while len(todo):
        read = eight[starts[todo] + step]
        spare = np.maximum(0, step + 8 - sizes[todo]).astype(np.uint64) * np.uint64(8)
        read = (read << spare) >> spare
        out[todo] = mix((out[todo] ^ read) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step))
        step += 8
        todo = todo[sizes[todo] > step]
    for i in np.flatnonzero(sizes > _LONGEST).tolist():
        digest = hashlib.blake2b(data[starts[i] : starts[i] + sizes[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """For each text the sorted distinct fingerprints of its n words in a row; of all its words if it has fewer."""
    words, ends = split_words(texts)
    h = word_hashes(words)
    runs, width = h.copy(), 1
    for width in range(2, n + 1):
        runs = mix(runs[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[width - 1 :]) if len(runs) else runs
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= n:
            out.append(np.unique(runs[start : end - n + 1]))
        elif end > start:
            whole = np.uint64(end - start)
            for w in h[start:end]:
                whole = _step(whole, w)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def _step(state: np.uint64, word: np.uint64) -> np.uint64:
    with np.errstate(over="ignore"):
        return mix(np.array([state], np.uint64) * np.uint64(0xD6E8FEB86659FD93) + word)[0]
