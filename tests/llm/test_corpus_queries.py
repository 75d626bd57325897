"""The registered queries of the corpus operators and the pipeline's stages, on small tables with nulls, empty and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_conversations import conversations
from test_operators import A_Z, DOCS, SPLIT, brute_components, brute_spans, corpus

import corpus_pipeline
from ripplelog.llm import secrets
from ripplelog.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(3), []
    for i, r in enumerate(corpus(5, 50)):
        if r[0] is not None and r[0] not in {x[0] for x in out}:
            extra = f"\npassword = 'pw{i}longenough'\n" if i % 9 == 0 else f"\n{hashlib.sha1(str(i).encode()).hexdigest()}" if i % 9 == 4 else ""
            out.append((r[0], None if r[1] is None else r[1] + extra, *r[2:4], None if r[1] is None else len(r[1] + extra)))
    passage = " ".join(rng.choice("abcdefgh") + str(rng.randrange(90)) for _ in range(60))
    return out + [(2000 + i, f"{i} {passage} {i * 7}", "en", "s9", len(f"{i} {passage} {i * 7}")) for i in range(4)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)] + [(200, None), (250, [0.0] * 8), (300, [float("nan")] * 8)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, folder, name):
    found, db = QUERIES[name](spark, folder), duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    expected = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(names)
    plain = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert Counter(map(plain, found.select(*names).collect())) == Counter(map(plain, expected.fetchall()))


def digest(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_op2(spark, folder, rows):
    found = {r.doc_id: r for r in QUERIES["op2_lm_scoring"](spark, folder).collect()}
    words = {d: [*SPLIT.findall((t or "").translate(A_Z)), None] for d, t, *_ in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in words}
    known = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    for d, ws in words.items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(known[w] > 0 for w in ws), sum(known.values())) and r.score < 0
    assert len(found) == len(rows)


def test_op4(spark, folder, rows):
    import tiktoken

    from ripplelog.llm.byte_bpe import Vocabulary

    ranks = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken")).ids
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {d: library.encode_ordinary(t or "") for d, t, *_ in rows}
    expected = {(d, len(ids[d]), digest(" ".join(map(str, ids[d]))), digest(t or "")) for d, t, *_ in rows}
    assert {tuple(r) for r in QUERIES["op4_byte_bpe"](spark, folder).collect()} == expected


def test_op5_and_op6(spark, folder, rows):
    judged = {r.doc_id: r for r in QUERIES["op5_quality"](spark, folder).collect()}
    told = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, folder).collect()}
    for d, t, *_ in rows:
        w = SPLIT.findall(t or "")
        assert (judged[d].n_words, judged[d].word_chars) == (len(w), sum(map(len, w))) and not (judged[d].base_failed and judged[d].kept)
        assert told[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= told[d].score <= 1 and (told[d].lang_pred == "und") == (not t)
    assert len(judged) == len(told) == len(rows)


def test_op7(spark, folder, rows):
    assert Counter(tuple(r) for r in QUERIES["op7_ngram_join"](spark, folder).collect()) == brute_components(rows, 4, 85)


def test_op8(spark, folder, rows):
    found = {r.doc_id: r for r in QUERIES["op8_secrets"](spark, folder).collect()}
    for d, t, *_ in rows:
        spans = []
        for place, (kind, (pattern, group, least)) in enumerate(secrets.PATTERNS.items()):
            spans += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, t or "") if len(m[group]) >= least]
        base = [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]
        n = Counter(s[2] for s in spans)
        assert (found[d].n_assign, found[d].n_access, found[d].n_hex, found[d].base_sha256) == (n["assign"], n["access"], n["hex"], digest(",".join(base)))
        assert [s for s in found[d].spans.split(",") if s and not s.startswith("tagged")] == base
    assert any(r.n_assign for r in found.values()) and any(r.n_hex for r in found.values())


def test_op9(spark, folder, rows):
    found = {r.doc_id: r for r in QUERIES["op9_mixing"](spark, folder).collect()}
    assert {d: r.size for d, r in found.items()} == {d: len(SPLIT.findall(t or "")) for d, t, *_ in rows}
    assert all(0 <= r.taken <= 3 * r.size for r in found.values())
    assert {d: r.taken for d, r in found.items()} == {r.doc_id: r.taken for r in QUERIES["op9_mixing"](spark, folder).collect()}


def test_op10(spark, folder, rows):
    found = Counter(tuple(r) for r in QUERIES["op10_substring_dedup"](spark, folder).collect())
    assert found == Counter((*k[:4], digest(k[4])) for k in brute_spans(rows, 100).elements())
    assert any(k[2] for k in found)


ODD = ["score", "lang_pred", "n_lines", "a.b", "ti`ck", "_rest", "_it", "_text", "ids", "taken", "block"]


@pytest.fixture(scope="module")
def odd(spark, rows):
    """documents with columns of names that clash, repeated rows, and rows that share a doc_id."""
    more = [rows[0], (rows[1][0], "quite another text under a number that is there before", "en", "s1", 5), (None, "a text without a number", "en", None, None)]
    docs = spark.createDataFrame([*rows, *more], DOCS).repartition(3)
    return docs.select("*", *[F.lit(f"own {n}").alias(n) for n in ODD])


def as_given(found, docs):
    """All columns of documents are there, and those that no stage changes are the row's own."""
    assert found.columns == docs.columns
    kept = found.collect()
    assert all(r[n] == f"own {n}" for r in kept for n in ODD)
    return kept


def test_language_stage(spark, odd):
    clean = as_given(corpus_pipeline.language(spark, odd, ""), odd)
    assert len(clean) == odd.where(F.col("text").rlike(r"\p{L}")).count()
    assert corpus_pipeline.language(spark, odd.limit(0), "").count() == 0


def test_lines_stage(spark, odd):
    found = as_given(corpus_pipeline.lines(spark, odd, ""), odd)
    assert len(found) == odd.count() and all(r.n_chars == len(r.text) for r in found)
    shared = Counter(x.strip().lower() for r in found for x in r.text.split("\n") if len(x.strip()) >= 40)
    assert shared["a line that many of the documents share, with ümlaut and more than forty."] == 1
    assert corpus_pipeline.lines(spark, odd.limit(0), "").count() == 0


def test_near_duplicates_stage(spark, odd, rows):
    found = as_given(corpus_pipeline.near_duplicates(spark, odd, ""), odd)
    expected = brute_components([*rows, (rows[1][0], "quite another text under a number that is there before", *[None] * 3)], 5, 80)
    heads = {d for d, _, c in expected if d == c}
    assert Counter(r.doc_id for r in found) == Counter({**dict.fromkeys(heads, 1), rows[1][0]: 2, None: 1})
    assert len(heads) < len(rows) and corpus_pipeline.near_duplicates(spark, odd.limit(0), "").count() == 0


def test_mixing_stage(spark, odd):
    found = as_given(corpus_pipeline.mixing(spark, odd, ""), odd)
    again = corpus_pipeline.mixing(spark, odd.repartition(2), "").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in again) and all(r.n_chars == len(r.text) for r in found)
    assert corpus_pipeline.mixing(spark, odd.limit(0), "").count() == 0


def test_tokens_stage_and_whole_pipeline(spark, odd, folder):
    found = corpus_pipeline.tokens(spark, odd, "").collect()
    assert len(found) == odd.count() and all(r.round_trip and r.n_tokens == len(r.ids) for r in found)
    assert corpus_pipeline.tokens(spark, odd.limit(0), "").count() == 0
    done = corpus_pipeline.run(spark, folder).collect()
    assert done and all(r.round_trip for r in done)
