"""The field on secrets in places that its training doesn't make, and on things that only look like secrets."""

import random
import string

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ripplelog.llm import secrets

EACH = 40
LETTERS = string.ascii_letters + string.digits


@pytest.fixture(scope="module")
def texts():
    found = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    return [t for t in found if t and len(t.encode()) <= 16_384]


@pytest.fixture(scope="module")
def field(texts):
    """Trained as scan() does: on texts with a find, and on as many without."""
    has = [bool(secrets.base_spans(t)) for t in texts]
    return secrets.train([t for t, h in zip(texts, has, strict=True) if h][:500] + [t for t, h in zip(texts, has, strict=True) if not h][:500])


def tagged(field, rows):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(rows))), "text": rows})
    return [[t[s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "tagged"] for t, r in zip(rows, secrets._scan(batch, field).to_pylist(), strict=True)]


def lines(rng):
    """Places that are not among those of the training: none has its words, joints or marks."""
    word = lambda: rng.choice(["report", "order", "image", "north", "system", "letter", "garden", "window"])
    number = lambda k: str(rng.randrange(10**k))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    secret = {
        "header": "Authorization: Bearer {}", "cookie": "Set-Cookie: sid={}; Path=/", "connection": "Server=db1;AccountKey={};Timeout=30", "curl": "curl -u admin:{} https://host.example.org/x", "yaml": "  client_auth: '{}'",
        "query": "https://cdn.example.org/a.bin?sig={}&exp=9", "prose": "please use {} to sign in", "postgres": "postgres://admin:{}@db.internal:5432/app", "short": "pwd={}",
    }
    benign = {
        "address": lambda: f"https://www.{word()}.example.org/en/{number(4)}?page={number(2)}&ref={word()}", "image": lambda: f"IMG_{number(8)}_{number(6)}.jpg", "version": lambda: f"version {number(2)}.{number(2)}.{number(3)}-rc{number(1)}+build.{number(5)}",
        "isbn": lambda: f"ISBN 978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", "class": lambda: f"com.{word()}.{word()}.{word().title()}Factory{number(1)}", "mac": lambda: ":".join(hexes(2) for _ in range(6)),
        "css": lambda: f".btn-{word()}-{number(3)} {{ color: #{hexes(6)}; }}", "doi": lambda: f"doi:10.{number(4)}/{word()}.{number(4)}.{number(6)}", "path": lambda: f"/usr/lib/x86_64-linux-gnu/lib{word()}{number(2)}.so.{number(1)}",
        "bases": lambda: "".join(rng.choice("ACGT") for _ in range(30)), "seat": lambda: f"flight LH{number(4)} gate B{number(2)} seat {number(2)}A", "article": lambda: f"SKU-{word().upper()}-{number(5)}-XL",
    }
    return secret, benign


def test_precision_and_recall_on_shapes_that_were_not_made(texts, field):
    rng = random.Random(31)
    plain = [t for t in texts if not secrets.base_spans(t) and len(t) > 100]

    def put(line):
        rows = rng.choice(plain).split("\n")
        at = rng.randrange(len(rows) + 1)
        return "\n".join([*rows[:at], line, *rows[at:]])

    secret, benign = lines(rng)
    met = exact = wrong = 0
    for form in secret.values():
        values = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(20, 36))) for _ in range(EACH)]
        found = tagged(field, [put(form.format(v)) for v in values])
        met += sum(any(v in s for s in spans) for v, spans in zip(values, found, strict=True))
        exact += sum(v in spans for v, spans in zip(values, found, strict=True))
    for form in benign.values():
        wrong += sum(map(bool, tagged(field, [put(form()) for _ in range(EACH)])))
    of = EACH * len(secret)
    assert exact >= 0.8 * of and met >= 0.8 * of and met >= 0.8 * (met + wrong), (met / of, exact / of, wrong)


def test_texts_without_secrets_stay_untagged(texts, field):
    assert sum(map(bool, tagged(field, texts))) <= len(texts) // 200


def test_equals_signs():
    """Between a word and its value a mark, at the end of a value a part of it; never across texts."""
    import numpy as np

    def tokens(*texts):
        data, ends = secrets._joined([t.encode() for t in texts])
        t = secrets.Tokens.of(data, ends)
        return [bytes(np.asarray(data[a:b])).decode() for a, b in zip(t.start, t.end, strict=True)]

    assert tokens("pwd=aGk9== x") == ["pwd", "=", "aGk9==", "x"]
    assert tokens("a = b", "c=") == ["a", "=", "b", "c="]
