"""Language identification with a string kernel.

The kernel of two texts is the number of byte-class n-grams of 1 to 3 that both hold (presence, not counts), divided by
the geometric mean of how many each holds. Landmark texts give a Nyström map of it, on which ridge regression learns one
language against the rest. As the kernel is linear in the presence bits, the map and the regression fold into one weight
for each n-gram and language: scoring is a product of a batch's presence matrix with those weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.llm.common import col, few_of_each, release, unused
from ripplelog.llm.words import slices

ORDERS = (1, 2, 3)
CLASSES = 64
BATCH_BYTES = 1 << 20
BATCH_CELLS = 1 << 21  # of a presence matrix
UNKNOWN = "und"


def byte_classes() -> np.ndarray:
    """UTF-8 bytes in 64 classes: 26 letters without case, white space, digits, other ASCII, and 32 of the higher bytes."""
    out = np.full(256, 28, np.uint32)
    for i in range(26):
        out[ord("a") + i] = out[ord("A") + i] = i
    out[[0x20, *range(0x09, 0x0E)]] = 26
    out[ord("0") : ord("9") + 1] = 27
    out[128:] = 32 + np.arange(128) % 32
    return out


@dataclass
class Model:
    languages: list[str]
    columns: list[np.ndarray]  # for each order, the column of an n-gram, or the last column if no landmark holds it
    weights: np.ndarray  # n-grams x languages

    @property
    def width(self) -> int:
        return len(self.weights)

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row of values for each text; data: all their bytes, ends: where each ends."""
        bits, sizes = presence(data, ends, self.columns, self.width)
        return (bits.astype(np.float32) @ self.weights) / np.sqrt(np.maximum(sizes, 1))[:, None]


def grams(data: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams' codes and the text of each; none reaches over the end of its text."""
    lengths = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), lengths)
    codes = byte_classes()[data]
    out = codes.copy()
    for k in range(1, order):
        out = out[:-1] * np.uint32(CLASSES) + codes[k:]
    n = max(0, len(data) - order + 1)
    inside = owner[:n] == owner[order - 1 : order - 1 + n]
    return out[:n][inside], owner[:n][inside]


def presence(data: np.ndarray, ends: np.ndarray, columns: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the bits of the n-grams that have a column, and how many n-grams of any kind it holds."""
    out, sizes = np.zeros((len(ends), width + 1), np.uint8), np.zeros(len(ends), np.int64)
    flat = out.ravel()
    if len(ends) == 1 and len(data) > BATCH_BYTES:  # a long text, some of it at a time
        for order, at in zip(ORDERS, columns, strict=True):
            held = np.zeros(CLASSES**order, bool)
            for i in range(0, len(data), BATCH_BYTES):
                part = data[i : i + BATCH_BYTES + order - 1]
                held[grams(part, np.array([len(part)]), order)[0]] = True
            flat[at[held]] = 1
            sizes += held.sum()
        return out[:, :width], sizes
    for order, at in zip(ORDERS, columns, strict=True):
        code, owner = grams(data, ends, order)
        pairs = np.sort(owner.astype(np.uint64) << np.uint64(6 * order) | code)
        pairs = pairs[np.diff(pairs, prepend=~pairs[:1]) != 0]
        owner = (pairs >> np.uint64(6 * order)).astype(np.int64)
        sizes += np.bincount(owner, minlength=len(ends))
        flat[owner * (width + 1) + at[(pairs & np.uint64(CLASSES**order - 1)).astype(np.int64)]] = 1
    return out[:, :width], sizes


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])


def fit(rows: list[tuple[str, str]], landmarks: int = 128, ridge: float = 0.1) -> Model | None:
    """Learns from (text, language); the first texts of each language are landmarks. None if there is nothing to learn."""
    if not rows:
        return None
    languages = sorted({lang for _, lang in rows})
    each = max(1, landmarks // len(languages))
    of = np.array([languages.index(lang) for _, lang in rows])
    marks = np.concatenate([np.flatnonzero(of == k)[:each] for k in range(len(languages))])
    data, ends = _bytes([rows[i][0] for i in marks])
    columns, width = [], 0
    for order in ORDERS:
        seen = np.unique(grams(data, ends, order)[0])
        columns.append(np.full(CLASSES**order, -1, np.int64))
        columns[-1][seen] = width + np.arange(len(seen))
        width += len(seen)
    for at in columns:
        at[at < 0] = width
    bits, sizes = zip(*(presence(*_bytes([t for t, _ in rows[i : i + 16]]), columns, width) for i in range(0, len(rows), 16)), strict=True)
    bits, size = np.concatenate(bits).astype(np.float32), np.sqrt(np.maximum(np.concatenate(sizes), 1))[:, None].astype(np.float32)
    marked = bits[marks] / size[marks]
    kernel = (bits / size @ marked.T).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[marks])
    use = values > 1e-6 * values.max()
    nystroem = vectors[:, use] / np.sqrt(values[use])
    features = kernel @ nystroem
    signs = np.where(of[:, None] == np.arange(len(languages)), 1.0, -1.0)
    share = np.bincount(of, minlength=len(languages))[of][:, None]  # every language weighs the same
    solved = np.linalg.solve(features.T @ (features / share) + ridge / len(rows) * np.eye(features.shape[1]), features.T @ (signs / share))
    return Model(languages, columns, (marked.T @ (nystroem @ solved)).astype(np.float32))


def sample(labelled: DataFrame, each: int, max_bytes: int) -> list[tuple[str, str]]:
    """Up to `each` texts of every language, of at most `max_bytes` bytes, chosen by a hash of the text."""
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.octet_length("text") <= max_bytes))
    rows = few_of_each(usable.select("text", "lang", F.xxhash64("text").alias("h")), "lang", each).select("rank", "text", "lang").collect()
    return [(r.text, r.lang) for r in sorted(rows, key=lambda r: (r["rank"], r.lang))]


def identify_language(
    docs: DataFrame, learn: Column | bool = True, each: int = 200, max_bytes: int = 65_536, landmarks: int = 128, ridge: float = 0.1
) -> DataFrame:
    """Adds lang_pred and score (0 to 1) to every row of `docs`, learning from `text` and `lang` of the rows where `learn` holds.

    The classifier is fitted on the driver, on a bounded sample: `each` texts of at most `max_bytes` bytes for every
    language, `landmarks` of them as landmarks. Every whole text is then scored, by its text alone. A text that is null
    or has no letter, and any text if nothing could be learned, is `und` with score 0. Ties go to the first language by
    name. The score is the winning one-against-the-rest value, moved from [-1, 1] to [0, 1]. Columns of `docs` called
    lang_pred or score are replaced; all others stay.
    """
    model = fit(sample(docs.where(F.lit(learn) if isinstance(learn, bool) else learn).select("text", "lang"), each, max_bytes), landmarks, ridge)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    letters = unused(names, "letters")
    asked = docs.select(*map(col, names), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(letters))
    rows_at_once = max(16, BATCH_CELLS // model.width) if model else 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for some in slices(whole, "text", BATCH_BYTES):
                for i in range(0, len(some), rows_at_once):
                    x = some.slice(i, rows_at_once)
                    labels, scores = np.full(len(x), UNKNOWN, object), np.zeros(len(x))
                    todo = np.flatnonzero(x.column(letters).to_numpy(zero_copy_only=False)) if model else []
                    if len(todo):
                        texts = x.column("text").take(pa.array(todo)).cast(pa.large_binary())
                        ends = np.frombuffer(texts.buffers()[1], np.int64)[: len(todo) + 1]
                        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
                        values = model.scores(data, ends[1:] - ends[0])
                        labels[todo] = np.array(model.languages, object)[values.argmax(axis=1)]
                        scores[todo] = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
                    keep = [x.column(x.schema.names.index(n)) for n in names]
                    yield pa.RecordBatch.from_arrays([*keep, pa.array(labels, pa.string()), pa.array(scores)], names=[*names, "lang_pred", "score"])
            release()

    return asked.mapInArrow(score, T.StructType([*docs.select(*map(col, names)).schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
