"""Secret scans: fixed patterns, and a linear-chain conditional random field that finds what they miss.

A text's tokens are runs of the characters that keys are made of, and runs of other marks; every line is a chain. A token
is tagged as the beginning of a secret, its inside, or outside, from its shape, the words next to it and how the file
looks. The field learns from what the patterns find in a bounded sample, and tags every line of every text (Viterbi).

So that it finds more than the patterns do, it sees each find several times: as it stands, with its words or its shape
hidden, and with another word, another joint and a made-up secret in its place, beside the same line with a plain word or a
number there. Made-up secrets also stand in other places, in headers, addresses and sentences, and beside them stand things
that look much like secrets and are none: addresses, file names, versions, identifiers. The field has to tell a secret by
the marks and the shape, after a word that it doesn't know.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.common import few_of_each
from ripplelog.llm.words import slices

# The patterns, the group that holds the secret and how long it has to be.
PATTERNS = {
    "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = (*PATTERNS, "tagged")

B, I, O = 0, 1, 2
WORDS = 1 << 10
SHAPES = 1 << 10
FILES = 8 * 16
#: Where each kind of feature begins in the weights: shape, own word, words before and after, file by coarse shape.
OFFSETS = np.cumsum([0, SHAPES, WORDS, WORDS, WORDS, WORDS])  # texture comes behind the file
TEXTURES = 1 << 9
FEATURES = OFFSETS[-1] + FILES + TEXTURES
#: The columns of a token's features that are about words, and about its shape; what stands for a hidden one.
WORD_COLUMNS, FILE_COLUMN, SHAPE_COLUMNS, NOTHING = [1, 2, 3, 4], 5, [0, 5, 6], int(FEATURES)
BATCH_BYTES = 1 << 20


def base_spans(text: str, may_hold_hex: bool = True) -> list[tuple[int, int, str, int, int]]:
    """(start, kind's place, kind, end, start of the secret) of the patterns' matches, in order."""
    out, lower = [], None
    for place, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        if kind == "assign":
            lower = text.lower()
            if not any(h in lower for h in HINTS):
                continue
        elif kind == "access" and "AKIA" not in text or kind == "hex" and not may_hold_hex:
            continue
        # runs of fewer than 32 hexadecimal digits fail whole, so longer ones can be asked for at once
        found = re.finditer(pattern if kind != "hex" else r"[0-9a-f]{32,}", text)
        out += [(m.start(), place, kind, m.end(), m.start(group)) for m in found if m.end(group) - m.start(group) >= least]
    return sorted(out)


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(members)] = 1
    return out


_DIGIT, _LOWER, _UPPER = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
_KEY = _DIGIT + _LOWER + _UPPER + b"+/_.=-"


@dataclass
class Tokens:
    """The tokens of some texts as bytes start to end of their joined bytes; line: a number for each line of each text."""

    data: np.ndarray
    text: np.ndarray
    line: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray  # tokens x kinds of features

    @classmethod
    def of(cls, data: np.ndarray, ends: np.ndarray) -> Tokens:
        kind = np.full(256, 2, np.int8)
        kind[list(_KEY)] = 1
        kind[[0x20, *range(0x09, 0x0E)]] = 0
        k = kind[data]
        # an equals sign between a word and a value is a mark of its own; at the end of a word it belongs to it
        equal, keyed = data == 0x3D, (k == 1) & (data != 0x3D)
        follows, precedes = np.append(keyed[1:], False), np.concatenate([[False], (k == 1)[:-1]])
        k = np.where(equal & (follows | ~precedes), 2, k)
        edge = np.flatnonzero(np.diff(k)) + 1
        starts = np.zeros(len(ends), np.int64)
        starts[1:] = ends[:-1]
        begin = np.unique(np.concatenate([starts[ends > starts], edge]))
        finish = np.append(begin[1:], len(data))[: len(begin)]
        real = k[begin] > 0
        begin, finish = begin[real], finish[real]
        owner = np.searchsorted(ends, begin, side="right")
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        line = breaks[begin] + owner  # grows with every line feed and every text
        return cls(data, owner, line, begin, finish, cls._features(data, ends, k, begin, finish, owner, line))

    @staticmethod
    def _features(data, ends, kind, begin, finish, owner, line) -> np.ndarray:
        n = len(begin)
        size = finish - begin

        def count(members: bytes) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(_table(members)[data], dtype=np.int32)])
            return sums[finish] - sums[begin]

        digits, lower, upper, hexes = count(_DIGIT), count(_LOWER), count(_UPPER), count(_DIGIT + b"abcdef")
        other = size - digits - lower - upper
        length = np.searchsorted([2, 4, 8, 12, 16, 24, 32], size, side="right")
        shape = length + 8 * (digits > 0) + 16 * (lower > 0) + 32 * (upper > 0) + 64 * (other > 0) + 128 * (hexes == size) + 256 * (kind[begin] == 2) + 512 * (digits > 2)
        low = data | np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
        word = size.astype(np.uint64)
        for step in (0, 1, 2, 3):
            word = word * np.uint64(0x100000001B3) ^ np.where(step < size, low[np.minimum(begin + step, len(data) - 1)], 0).astype(np.uint64)
        for step in (1, 2):
            word = word * np.uint64(0x100000001B3) ^ np.where(step <= size, low[np.maximum(finish - step, 0)], 0).astype(np.uint64)
        word = ((word * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64)

        def beside(shift: int) -> np.ndarray:
            out = np.zeros(n, np.int64)
            a, b = (slice(shift, None), slice(None, n - shift)) if shift > 0 else (slice(None, n + shift), slice(-shift, None))
            out[a] = np.where(line[a] == line[b], word[b], 0)
            return out

        marks = np.concatenate([[0], np.cumsum(_table(b"=:{}[]();\"'_#<>/")[data], dtype=np.int64)])
        starts = np.concatenate([[0], ends[:-1]])
        density = (marks[ends] - marks[starts]) / np.maximum(ends - starts, 1)
        file = np.searchsorted([0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2], density, side="right")[owner]
        coarse = (digits > 0) + 2 * (size >= 16) + 4 * (size >= 32) + 8 * (other > 0)
        # how often the kind of character changes, how many marks stand inside, and the longest run of lower-case letters
        sort = np.zeros(256, np.int8)
        for i, members in enumerate((_DIGIT, _LOWER, _UPPER), 1):
            sort[list(members)] = i
        changes = np.concatenate([[0, 0], np.cumsum(np.diff(sort[data]) != 0, dtype=np.int32)])[: len(data) + 1]
        change = (changes[finish] - changes[np.minimum(begin + 1, finish)]) / np.maximum(size - 1, 1)
        runs = np.where(_table(_LOWER)[data] == 1, np.arange(len(data)) - np.maximum.accumulate(np.where(_table(_LOWER)[data] == 0, np.arange(len(data)), -1)), 0)
        run = np.maximum.reduceat(np.append(runs, 0), begin) if n else np.zeros(0, np.int64)
        run = np.minimum(run, size)
        texture = np.searchsorted([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75], change, side="right") + 8 * np.minimum(other, 3) + 32 * np.searchsorted([4, 6, 9], run, side="right") + 128 * np.searchsorted([8, 16, 24], size, side="right")
        columns = [shape, word, beside(1), beside(2), beside(-1), file * 16 + coarse, texture + FILES]
        return np.stack(columns, axis=1) + [*OFFSETS, OFFSETS[-1]] if n else np.zeros((0, 7), np.int64)


@dataclass
class Field:
    weights: np.ndarray  # features (and one for nothing) x 3
    moves: np.ndarray  # from x to

    def emissions(self, tokens: Tokens) -> np.ndarray:
        return sum(self.weights[tokens.features[:, j]] for j in range(tokens.features.shape[1]))

    def tag(self, tokens: Tokens) -> np.ndarray:
        """The best tags of every line. Lines in which no tag but O can pay are left at O; all others are decoded."""
        tags = np.full(len(tokens.start), O, np.int8)
        if not len(tags):
            return tags
        score = self.emissions(tokens)
        # a token's tag takes part in two moves at most; what these can gain over O to O bounds what they can make good
        gain = 2 * max(0.0, float((self.moves - self.moves[O, O]).max()))
        doubtful = score[:, :O].max(axis=1) + gain >= score[:, O]
        first = np.flatnonzero(np.diff(tokens.line, prepend=-1))
        size = np.diff(np.append(first, len(tags)))
        open_lines = np.flatnonzero(np.add.reduceat(doubtful.astype(np.int64), first) > 0)
        open_lines = open_lines[np.argsort(-size[open_lines], kind="stable")]
        first, size = first[open_lines], size[open_lines]
        if len(first) == 0:
            return tags
        best, back = score[first], np.zeros((size.sum(), 3), np.int8)
        begin = np.cumsum(size) - size
        for t in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -t, side="left"))  # lines longer than t come first
            ways = best[:live, :, None] + self.moves[None]
            back[begin[:live] + t] = ways.argmax(axis=1)
            best[:live] = ways.max(axis=1) + score[first[:live] + t]
        tag = best.argmax(axis=1).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -t, side="left"))
            ended = size[:live] - 1 > t
            if t < int(size[0]) - 1:
                tag[:live] = np.where(ended, back[np.minimum(begin[:live] + t + 1, len(back) - 1), tag[:live]], tag[:live])
            tags[first[:live] + t] = tag[:live]
        return tags


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


#: What made-up secrets are made of: upper-case and lower-case hexadecimal, letters and digits, base 64, capitals and digits.
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits)
JOINTS = (("=", ""), (" = ", ""), (": ", ""), (" : ", ""), ('="', '"'), (' = "', '"'), (" = '", "'"), (": '", "'"), ('": "', '"'))


def variants(texts: list[str], rng: np.random.Generator, each: int = 3, most: int = 600) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines like those in which the patterns find an assignment, with where their secrets are: behind another word or
    another joint, and with a made-up secret of another shape. After each comes one with a plain word or a number there."""
    plain = [w for t in texts[-200:] for w in re.findall(r"[^\W\d_]{3,12}", t)[:50]] or ["plain"]
    pick = lambda x: x[int(rng.integers(len(x)))]
    out = []
    for text in texts:
        for begin, _, kind, end, secret in base_spans(text):
            if kind != "assign" or len(out) >= 2 * most:
                continue
            low, high = text.rfind("\n", 0, begin) + 1, text.find("\n", end)
            before, after = text[low:begin][-120:], text[end : high if high >= 0 else len(text)].lstrip("\"'")[:120]
            word = re.match(r"\w+", text[begin:secret])[0]
            for _ in range(each):
                joint, close = pick(JOINTS)
                value = "".join(pick(alphabet) for alphabet in [pick(ALPHABETS)] for _ in range(int(rng.integers(10, 49))))
                head = before + (word if rng.random() < 0.3 else pick(plain)) + joint
                out.append((head + value + close + after, [(len(head), len(head) + len(value))]))
                usual = pick(plain) if rng.random() < 0.6 else str(int(rng.integers(10 ** int(rng.integers(1, 9)))))
                out.append((before + pick(plain) + joint + usual + close + after, []))
    return out


def _secret(rng: np.random.Generator, low: int = 12, high: int = 49) -> str:
    alphabet = ALPHABETS[int(rng.integers(len(ALPHABETS)))]
    while True:  # as long as it takes to have letters and digits
        value = "".join(alphabet[int(i)] for i in rng.integers(len(alphabet), size=int(rng.integers(low, high))))
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            return value


#: Places of secrets, and things that look like them and are none. w is a word, W one in capitals, C one with a capital, n a
#: short number, d a date, v a version, h eight hexadecimal digits, u an identifier of five groups of them, s the secret.
PLACES = (
    "{W}_{W}={s}", "export {W}_{W}={s}", "{w}_{w}: {s}", "-- {w}={s}", "{w}://{w}:{s}@{w}.{w}/{w}", "{C}: {C} {s}", "{C}-{C}: {s}", "{w} {w} {s} {w} {w}", "{w} {w}: {s}", "{w} {w} \"{s}\", {w} {w}.", "{{\"{w}\": \"{s}\"}}",
    "<{w}>{s}</{w}>", "{w} --{w} {s}", "{w} -{w} '{s}'", "{w}({s})", "{w} = {w}_{s}", "{w}_{s} {w}", "({w}: {s})", "[{w}] {s}", "{w}={n}&{w}={s}",
)
LOOKS = (
    "https://{w}.{w}.{w}/{w}/{n}?{w}={n}&{w}={w}", "http://{w}.{w}/{w}/{w}-{w}-{n}.html#{w}", "https://{w}.{w}/{d}/{w}_{n}", "{w}@{w}.{w}", "{w}.{n}@{w}-{w}.{w}", "/{w}/{w}{n}/{w}_{n}.{w}", "{W}_{d}_{n}.jpg", "{w}-{n}x{n}.png", "{W}{n}{n}.{w}",
    "v{v}", "{w}-{v}-{w}.{n}", "{w} {v}-{w}+{h}", "{w}=={v}", "{w}/{v} ({W} {n}.{n})", "{u}", "{w}: {u}", "{C}{C}{C}{n}", "{w}{C}{C}({w}{n})", "{w}_{w}_{n}_{w}", "{W}_{W}_{W}_{n}", "{d}T{n}:{n}:{n}Z", "{n}-{n}-{n}-{n}", "+{n} {n} {n}",
    "{w}={n}", "{w}: {w}-{n}", "{w}={w}&{w}={n}", "#{h}", "0x{h}", "{n}.{n}.{n}.{n}:{n}", "{W}-{n}{W}{n}", "{w} {w} {W}{n}{W} {w}", "{w}://{w}.{w}:{n}/{w}", "{C}: {C} {n}", "export {W}_{W}={w}", "{w} --{w} {w}{n}", "<{w}>{C}{n}</{w}>", "{{\"{w}\": \"{w}-{n}\"}}",
)


def made_up(plain: list[str], rng: np.random.Generator, secrets: int = 900, looks: int = 1400) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with made-up secrets, and where they are, and lines with what only looks like them, between words of the corpus."""
    pick = lambda x: x[int(rng.integers(len(x)))]
    number = lambda: str(int(rng.integers(10 ** int(rng.integers(1, 6)))))
    hexes = lambda n: "".join("0123456789abcdef"[int(i)] for i in rng.integers(16, size=n))
    kinds = {
        "w": lambda: pick(plain).lower(), "W": lambda: pick(plain).upper(), "C": lambda: pick(plain).capitalize(), "n": number, "h": lambda: hexes(8), "u": lambda: "-".join(map(hexes, (8, 4, 4, 4, 12))),
        "d": lambda: f"20{int(rng.integers(10, 30))}-{int(rng.integers(1, 13)):02}-{int(rng.integers(1, 29)):02}", "v": lambda: ".".join(str(int(x)) for x in rng.integers(0, 30, size=3)), "s": lambda: _secret(rng),
    }
    words = lambda: " ".join(pick(plain) for _ in range(int(rng.integers(0, 5))))
    out = []
    for places, many in ((PLACES, secrets), (LOOKS, looks)):
        for i in range(many):
            line, spans = (head := words()) + (" " if head else ""), []
            for literal, name, _, _ in string.Formatter().parse(places[i % len(places)]):
                line += literal
                if name:
                    value = kinds[name]()
                    spans += [(len(line), len(line) + len(value))] if name == "s" else []
                    line += value
            tail = words()
            out.append((line + (" " + tail if tail else ""), spans))
    return out


def train(texts: list[str], rounds: int = 45, rate: float = 0.3, longest: int = 64, seed: int = 0) -> Field:
    """Learns from what the patterns find in `texts`, and variants of that: log-likelihood of whole chains, by adaptive
    gradient steps.

    All lines with a find take part, and 2,000 without at most; lines are cut to chains of `longest` tokens here.
    """
    rng = np.random.default_rng(seed)
    weights, moves = np.zeros((FEATURES + 1, 3)), np.zeros((3, 3))
    moves[O, I] = moves[I, B] = -4.0  # an inside needs a beginning
    told = [(t, [(secret, end) for _, _, _, end, secret in base_spans(t)]) for t in texts]
    words = [w for t in texts[-200:] for w in re.findall(r"[^\W\d_]{3,12}", t)[:50]] or ["plain"]
    told += variants(texts, rng)
    told += made_up(words, rng) if any(finds for _, finds in told) else []
    data, ends = _joined([t.encode() for t, _ in told])
    tokens = Tokens.of(data, ends)
    gold = np.full(len(tokens.start), O, np.int8)
    for i, (text, finds) in enumerate(told):
        before = int(ends[i - 1]) if i else 0
        for secret, end in finds:
            a, b = (before + len(text[:x].encode()) for x in (secret, end))
            low, high = np.searchsorted(tokens.end, a, side="right"), np.searchsorted(tokens.start, b)
            gold[low:high] = I
            gold[low : low + 1] = B
    place = np.arange(len(gold)) - np.repeat(f := np.flatnonzero(np.diff(tokens.line, prepend=-1)), np.diff(np.append(f, len(gold))))
    chain = np.cumsum((place % longest == 0).astype(np.int64)) - 1
    n_chains = int(chain[-1]) + 1 if len(chain) else 0
    positive = np.zeros(n_chains, bool)
    positive[chain[gold != O]] = True
    if not positive.any():
        weights[:, O] = 1.0
        return Field(weights, moves)
    rest = np.flatnonzero(~positive)
    # lines without a find: any, and as many with a longer word that holds digits
    digits = np.concatenate([[0], np.cumsum(_table(_DIGIT)[data], dtype=np.int64)])
    looks = np.zeros(n_chains, bool)
    looks[chain[(tokens.end - tokens.start >= 6) & (digits[tokens.end] > digits[tokens.start])]] = True
    most = 1000
    of = np.zeros(n_chains, np.int64)
    of[chain] = tokens.text
    usual = rest[of[rest] >= len(texts)]  # the variants' plain ones, all of them
    # a line in which a long word changes between letters and digits again and again may hold what the patterns miss: it says
    # nothing
    shape, texture = tokens.features[:, 0], tokens.features[:, 6] - OFFSETS[-1] - FILES
    mixed = (tokens.end - tokens.start >= 16) & (shape >> 3 & 1 > 0) & (shape >> 4 & 3 > 0) & (texture % 8 >= 3)
    unsure = np.zeros(n_chains, bool)
    unsure[chain[mixed]] = True
    rest = rest[(of[rest] < len(texts)) & ~unsure[rest]]
    like = rng.permutation(rest[looks[rest]])[:most]
    found = np.flatnonzero(positive)
    picked = np.concatenate([found, usual, like, rng.permutation(np.setdiff1d(rest, like))[:most]])
    row = np.full(n_chains, -1)
    row[picked] = np.arange(len(picked))
    mine = np.flatnonzero(row[chain] >= 0)
    r, t, features, y = row[chain[mine]], place[mine] % longest, tokens.features[mine], gold[mine]
    features = features.copy()
    features[of[picked][r] >= len(texts), FILE_COLUMN] = NOTHING  # a variant is a line without its file
    again = [(r, t, features, y)]
    seen = np.flatnonzero(of[found] < len(texts))  # the patterns' own
    turn = np.full(len(picked), -1)
    turn[seen] = np.arange(len(seen))
    for hidden in (WORD_COLUMNS, SHAPE_COLUMNS):
        some = np.flatnonzero(turn[r] >= 0)
        masked = features[some].copy()
        masked[:, hidden] = np.where(rng.random((len(some), len(hidden))) < 0.8, NOTHING, masked[:, hidden])
        again.append((turn[r[some]] + len(picked) + (len(again) - 1) * len(seen), t[some], masked, y[some]))
    r, t, features, y = (np.concatenate(x) for x in zip(*again, strict=True))
    size = np.bincount(r)
    n, width = len(size), int(size.max())
    mask = np.arange(width)[None] < size[:, None]
    target = np.zeros((n, width, 3))
    target[r, t, y] = 1
    wanted_moves = np.einsum("nti,ntj->ij", target[:, :-1], target[:, 1:])
    grown_w, grown_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    for _ in range(rounds):
        e = np.zeros((n, width, 3))
        e[r, t] = sum(weights[features[:, j]] for j in range(features.shape[1]))
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for k in range(1, width):
            alpha[:, k] = np.where(mask[:, k, None], np.logaddexp.reduce(alpha[:, k - 1, :, None] + moves, axis=1) + e[:, k], alpha[:, k - 1])
        for k in range(width - 2, -1, -1):
            beta[:, k] = np.where(mask[:, k + 1, None], np.logaddexp.reduce(moves + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2), 0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        at = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + moves + (e + beta)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        slope_t = (target - at)[r, t]
        slope_w = -1e-3 * n * weights / 100
        for j in range(features.shape[1]):
            for c in range(3):
                slope_w[:, c] += np.bincount(features[:, j], weights=slope_t[:, c], minlength=FEATURES + 1)
        slope_m = wanted_moves - pair.sum(axis=(0, 1))
        grown_w += slope_w**2
        grown_m += slope_m**2
        weights += rate * slope_w / np.sqrt(grown_w)
        weights[NOTHING] = 0
        moves += rate * slope_m / np.sqrt(grown_m)
    return Field(weights, moves)


def sample(docs: DataFrame, each: int, max_bytes: int) -> list[str]:
    """Up to `each` texts with a find and as many without, of at most `max_bytes` bytes, those of the smallest hashes."""
    has = F.col("text").rlike(PATTERNS["assign"][0].replace("(?ai:", "(?i:")) | F.col("text").rlike("AKIA[A-Z0-9]{12}|[0-9a-f]{32}")
    rows = docs.where(F.octet_length("text") <= max_bytes).select("text", has.alias("has"), F.xxhash64("text").alias("h"))
    return [r.text for r in sorted(few_of_each(rows, "has", each).select("has", "rank", "text").collect(), key=lambda r: (not r.has, r["rank"]))]


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", each: int = 500, max_bytes: int = 16_384) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_tagged and spans: array of (kind, start, end) of every row of `docs`.

    Starts and ends count code points, end exclusive; spans are ordered by start, then assign, access, hex, tagged. The
    patterns' matches that are long enough always stay; `tagged` are the field's spans that touch none of them. The
    field is fitted on at most 2 * `each` whole texts of `max_bytes` bytes at most and is applied to every whole text.
    A null text is empty. Rows that share a doc_id are scanned each by itself; no other column is read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    field = train(sample(rows, each, max_bytes))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in slices(whole, "text", BATCH_BYTES):
                yield _scan(x, field)

    return rows.mapInArrow(scanned, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, n_tagged long, spans array<struct<kind: string, start: long, end: long>>")


def _scan(x: pa.RecordBatch, field: Field) -> pa.RecordBatch:
    raw = x.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    starts = offsets[:-1] - offsets[0]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    # runs of hexadecimal digits that are long enough, to spare most texts that pattern
    # a run ends with its text, whatever the next one begins with
    hexes = _table(_DIGIT + b"abcdef")[data]
    begin = np.unique(np.concatenate([starts[ends > starts], np.flatnonzero(np.diff(hexes)) + 1]))
    finish = np.append(begin[1:], len(data))[: len(begin)]
    long = begin[(hexes[begin] == 1) & (finish - begin >= 32)]
    hexed = set(np.searchsorted(ends, long, side="right").tolist())
    tokens = Tokens.of(data, ends)
    tags = field.tag(tokens)
    hits = np.flatnonzero(tags != O)
    # a span runs from a beginning over the insides that follow it in its line
    fresh = np.ones(len(hits), bool)
    fresh[1:] = (tags[hits[1:]] == B) | (hits[1:] != hits[:-1] + 1) | (tokens.line[hits[1:]] != tokens.line[hits[:-1]])
    lead = np.flatnonzero(fresh)
    last = np.append(lead[1:], len(hits))[: len(lead)] - 1
    owner = tokens.text[hits[lead]]
    a, b = (points[p] - points[starts[owner]] for p in (tokens.start[hits[lead]], tokens.end[hits[last]]))
    extra: dict[int, list[tuple[int, int]]] = {}
    for i, s, e in zip(owner.tolist(), a.tolist(), b.tolist(), strict=True):
        extra.setdefault(i, []).append((s, e))
    counts, spans = np.zeros((4, len(x)), np.int64), []
    for i, text in enumerate(x.column("text").to_pylist()):
        base = base_spans(text, i in hexed)
        found = [(s, place, kind, e) for s, place, kind, e, _ in base]
        for s, e in extra.get(i, ()):
            if not any(s < stop and start < e for start, _, _, stop, _ in base):
                found.append((s, 3, "tagged", e))
        for _, place, _, _ in found:
            counts[place, i] += 1
        spans.append([{"kind": kind, "start": s, "end": e} for s, _, kind, e in sorted(found)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([x.column("doc_id"), *map(pa.array, counts), pa.array(spans, kind)], names=["doc_id", "n_assign", "n_access", "n_hex", "n_tagged", "spans"])
