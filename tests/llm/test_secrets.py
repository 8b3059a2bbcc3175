import itertools
import random
import re

import numpy as np
import pytest

from starflow.llm import secrets
from starflow.llm.queries import secret_digests

ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


def brute(text):
    """The base findings by their definition, each pattern alone, failing matches dropped."""
    text = text or ""
    out = [
        (m.start(), 0, m.end()) for m in re.finditer(f"(?ai:{ASSIGN})", text) if len(m[2]) >= 6
    ]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


TEXTS = [
    None, "", "no secret here", 'token = "abc"', "Token:abcdef", 'API_KEY="a/b+c=d.e-f" and passwd=12345',
    "secret=token=abcdefgh", "password ' = 'xxxxxxx", "apikey:=abcdefg", "é" * 5 + "secret: éabcdefg secret: abcdefg",
    "AKIA" + "A1" * 8, "xAKIA" + "B" * 15 + " AKIA" + "B" * 20, "f" * 23, "f" * 24 + "g" + "0" * 30, "token: " + "ab12" * 8,
    "AKIAAKIA" + "0" * 12, "ſecret: abcdefgh", "token" * 3 + "=abcdef", "a\nsecret =\nabcdefg", "passwordpassword=abcdef",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_patterns(text):
    assert [s[:3] for s in secrets.base_spans(text or "")] == brute(text)


def test_base_patterns_at_random():
    rnd = random.Random(6)
    parts = ["token", "secret", "Api_key", "apikey", "=", ":", " ", '"', "'", "abcdef12", "AKIA", "Z9Z9Z9Z9", "0f" * 6, "é", "\n", "."]
    for _ in range(2000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert [s[:3] for s in secrets.base_spans(text)] == brute(text)


def tags_of(emit, field):
    """All paths tried."""
    best = max(
        itertools.product(range(3), repeat=len(emit)),
        key=lambda p: sum(emit[i][t] for i, t in enumerate(p))
        + sum(field.step[a][b] for a, b in zip((0, *p), (*p, 0))),
    )
    spans, start = [], None
    for i, t in enumerate((*best, 0)):
        if start is not None and t != 2:
            spans.append((start, i - 1))
            start = None
        if t == 1 or (t == 2 and start is None):
            start = i
    return spans


def test_pruned_decoding_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(150):
        emit = rng.normal(size=(7, 3)) * 2 + [rng.choice([0, 3]), 0, 0]
        field = secrets.Field(np.zeros((secrets._WIDTH, 3)), rng.normal(size=(3, 3)))
        assert secrets.decode(emit, field) == tags_of(emit, field)


def test_tokens_know_where_they_stand():
    table = secrets.Tokens()
    for text in ['say "ab-c12" now.', "x  y\n\n(z)", "é,ß! a_b", "one", " lead", "t='q'", "a\x1cb"]:
        tokens, begin, end = secrets.read_tokens(text, table)
        cut = [text[a:b] for a, b in zip(begin, end)]
        assert "".join(cut) == "".join(text.split())
        assert all(c == c.strip() for c in cut)
    assert len(secrets.read_tokens("", table)[0]) == 0


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(3)

    def key(n):
        return "".join(rnd.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n))

    rows, planted = [], {}
    for i in range(400):
        words = [f"w{rnd.randint(0, 99)}" if rnd.random() < 0.1 else rnd.choice(["the", "of", "and", "house", "2021", "a.b@c.de"]) for _ in range(80)]
        if i % 2:
            words.insert(40, f'{rnd.choice(["token", "secret", "password"])} = "{key(32)}"')
        elif i % 40 == 0:
            planted[i] = key(36)  # no key word that the patterns know
            words.insert(30, f'credential = "{planted[i]}"')
        rows.append((i, " ".join(words), "s"))
    return rows, planted


def test_the_field_finds_what_the_patterns_miss(documents, workspace, corpus):
    rows, planted = corpus
    docs = documents(rows)
    field = secrets.train_secrets(docs, sample=150, workspace=workspace)
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs, field).collect()}
    texts = {i: t for i, t, _ in rows}
    for i, spans in found.items():
        base = [(s["start"], s["end"]) for s in spans if s["kind"] != "model"]
        assert base == [(a, b) for a, _, b in brute(texts[i])]
        more = [texts[i][s["start"] : s["end"]] for s in spans if s["kind"] == "model"]
        assert more == ([planted[i]] if i in planted else [])


@pytest.mark.parametrize("finding", ['TOKEN = "Zq7hT2mKp9Xw4LsV8rNb3YcD"', "5f3a9c" * 6])
def test_the_field_is_trained_on_real_findings(documents, workspace, finding):
    """Prose full of key words, and few findings, in upper case or hex only."""
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        words = [rnd.choice(["the", "of", "house", "secretary", "tokenizer", "password"]) for _ in range(40)]
        rows.append((i, " ".join([*words, *[finding] * (i % 100 == 0)]), "s"))
    field = secrets.train_secrets(documents(rows), sample=6, workspace=workspace)
    assert field is not None
    table = secrets.Tokens(field.emit[: secrets._SHAPES])
    found = secrets.model_spans(rows[100][1], table, field)
    assert any(a < b_end and b > b_start for a, b in found for _, _, _, b_start, b_end in secrets.base_spans(rows[100][1]))


def test_no_finding_fails_the_expression_for_spark(spark):
    texts = [t for t in TEXTS if t and secrets.base_spans(t)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.where(df["text"].rlike(secrets.POSSIBLE)).count() == len(texts)


def test_special_rows(documents, workspace, corpus):
    rows = [(1, None, "s"), (2, "", "s"), (3, "token: abcdefgh " * 20_000, "s"), (None, "AKIA" + "Z" * 16, None)] * 2
    docs = documents(rows)
    field = secrets.train_secrets(docs, sample=5, workspace=workspace)
    found = secrets.find_secrets(docs, field)
    out = found.select("doc_id", *secret_digests(found["spans"])).collect()
    assert sorted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"]) for r in out if r["doc_id"]) == [
        (1, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (2, 0, 0, 0), (3, 20_000, 0, 0), (3, 20_000, 0, 0),
    ]
    empty = documents([])
    assert secrets.train_secrets(empty, workspace=workspace) is None
    assert secrets.find_secrets(empty, None).count() == 0


def test_digests(spark):
    import hashlib

    rows = [(1, [("assign", 3, 9), ("hex", 5, 40), ("model", 50, 60)]), (2, [])]
    df = spark.createDataFrame(rows, "doc_id int, spans array<struct<kind:string,start:bigint,end:bigint>>")
    one, two = df.select("doc_id", *secret_digests(df["spans"])).orderBy("doc_id").collect()
    assert (one["n_assign"], one["n_access"], one["n_hex"]) == (1, 0, 1)
    assert one["spans"] == "assign:3:9,hex:5:40,model:50:60"
    assert one["base_sha256"] == hashlib.sha256(b"assign:3:9,hex:5:40").hexdigest()
    assert two["spans"] == "" and two["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_copies_count_once_in_training(documents, workspace):
    """5000 copies of one finding and a few others: the field is there, and its sample is small."""
    rows = [(1, "the password = abcdef123456 is here", "s")] * 5000 + [(i, f"plain text {i}", "s") for i in range(2, 30)]
    for sample in (1, 300):
        assert secrets.train_secrets(documents(rows), sample=sample, workspace=workspace) is not None


def test_evidence_of_a_window_is_that_of_the_text():
    table = secrets.Tokens()
    tokens, _, _ = secrets.read_tokens("a token = 'x1y2z3' and 12 more: words, (here) AKIA99 end.", table)
    full = secrets.evidence(tokens, table)
    for low, high in ((0, 3), (4, 9), (len(tokens) - 2, len(tokens) + 20)):
        assert (secrets.evidence(tokens, table, low, high) == full[low:high]).all()
