"""Distances between sources against sums over all terms, and what happens with nulls, repeats and empty tables."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ripplelog.llm import divergence
from ripplelog.llm.divergence import divergences, split_terms

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TYPE = "doc_id long, text string, lang string, source string"


def documents(n=120):
    rng, rows = random.Random(4), []
    words = ["the", "The", "über", "größe", "don't", "a1b", "Ärger", "x", "日本", "of"] + [f"rare{chr(97 + i)}" for i in range(26)]
    for i in range(n):
        lang = rng.choice(["en", "de", None])
        text = " ".join(rng.choice(words[: 10 + 9 * (i % 3)]) for _ in range(rng.randrange(0, 30)))
        rows.append((i, text + ("!" if i % 2 else "\x00Z"), lang, rng.choice(["s1", "s2", "s3", "", None, "é"])))
    return [*rows, (900, None, "en", "s1"), (901, "", "en", "nothing"), (902, "12 34", "de", "s9"), (903, "alone", "fr", "s1"), rows[0], rows[0], (904, "the " * 20_000 + "of", "en", "s2")]


def brute(rows, least_docs=10, top=10):
    docs = [(lang or "", source or "", TERMS.findall((text or "").translate(A_Z))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for a, _, ts in docs if a == lang for t in set(ts))
        kept = [t for t, n in seen.items() if n >= least_docs]
        counts = {g: Counter() for a, g, _ in docs if a == lang}
        for a, g, ts in docs:
            if a == lang:
                counts[g].update(ts)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}
        p, q = {g: share(c) for g, c in counts.items()}, share(sum(counts.values(), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for g in counts:
            for part, found in (
                ("pair", [(sum(f(p[g][t], p[h][t]) for t in kept), h) for h in counts if h != g]),
                ("term", [(f(p[g][t], q[t]), t) for t in kept if counts[g][t] and p[g][t] > q[t]]),
            ):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, g, part, item, v, i) for i, (v, item) in enumerate(ordered, 1) if part == "pair" or i <= top]
    return out


def test_divergences(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, TYPE).repartition(4)
    for least_docs, top in ((10, 10), (1, 3), (10_000, 10)):
        found = divergences(docs, least_docs, top)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert Counter(map(tuple, found.collect())) == Counter(brute(rows, least_docs, top))


def test_columns_of_clashing_names_and_empty_tables(spark):
    rows = documents(40)
    docs = spark.createDataFrame(rows, TYPE)
    odd = docs.withColumns({c: F.lit("odd") for c in ("term", "n", "docs", "value", "a.b", "p0")})
    assert Counter(map(tuple, divergences(odd, 2).collect())) == Counter(brute(rows, 2))
    assert divergences(docs.limit(0)).collect() == []


def test_counts_that_are_given_on_before_the_end(spark, monkeypatch):
    import pyarrow as pa

    rows = documents(60)
    monkeypatch.setattr(divergence, "HELD_ROWS", 3)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 40)
    # the function that tasks run, here in this process
    caught = {}

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, f, _):
            caught["f"] = f
            return self

    divergence.term_counts(Docs())
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "" for r in rows], "source": [r[3] or "" for r in rows], "text": [r[1] or "" for r in rows]})
    sums = Counter()
    given = list(caught["f"](iter([batch])))
    for r in pa.Table.from_batches(given).to_pylist():
        sums[r["lang"], r["source"], r["term"]] += r["n"]
    expected = Counter((r[2] or "", r[3] or "", t) for r in rows for t in TERMS.findall((r[1] or "").translate(A_Z)))
    assert len(given) > 3 and +sums == expected


def test_terms_end_with_their_text():
    import pyarrow as pa

    terms, doc = split_terms(pa.array(["ab", "cd E", "", "é-f", "g"]))
    assert list(zip(terms.to_pylist(), doc.tolist(), strict=True)) == [("ab", 0), ("cd", 1), ("e", 1), ("é", 3), ("f", 3), ("g", 4)]
