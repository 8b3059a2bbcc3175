import random
import re
from collections import Counter

import numpy as np
import pytest

from starflow.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    """By the definition, on (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [
        (lang, source, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(LOWER))) for lang, source, text in rows
    ]
    out = set()
    for lang in {r[0] for r in rows}:
        mine = [t for t in terms if t[0] == lang]
        docs = Counter(x for t in mine for x in set(t[2]))
        kept = [x for x, n in docs.items() if n >= 3]
        v = len(kept)

        def shares(lists):
            counts = Counter(x for words in lists for x in words)
            whole = sum(counts[x] for x in kept) + v
            return {x: (counts[x], 1 + 1_000_000_000 * (counts[x] + 1) // whole) for x in kept}

        total = shares([t[2] for t in mine])
        sources = {s: shares([t[2] for t in mine if t[1] == s]) for s in {t[1] for t in mine}}
        for source, p in sources.items():
            pairs = [
                (sum((p[x][1] - q[x][1]) ** 2 // q[x][1] for x in kept), other) for other, q in sources.items() if other != source
            ]
            above = [((p[x][1] - total[x][1]) ** 2 // total[x][1], x) for x in kept if p[x][0] and p[x][1] > total[x][1]]
            for part, found in (("pair", pairs), ("term", above)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, source, part, item, value, rank))
    return out


@pytest.fixture
def frame(spark):
    def make(rows):
        full = [(*r, 1, "x", 2.0) for r in rows]
        return spark.createDataFrame(full, "lang string, source string, text string, n long, term string, value double")

    return make


def run(df, **options):
    rows = divergence.source_divergences(df, **options).collect()
    assert len({tuple(r)[:4] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("chunk, pairs, held", [(200_000, 1_000_000, 600_000), (7, 5, 20)])
def test_random_texts(frame, workspace, monkeypatch, chunk, pairs, held):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "_PAIRS", pairs)
    monkeypatch.setattr(divergence, "_HELD", held)
    rnd = random.Random(2)
    words = ["the", "THE", "Été", "été", "日本", "x1y", "a_b", "don't", "z", "ß", "×", "~", "Q"]
    rows = []
    for i in range(200):
        text = rnd.choice([" ", "\n", "-", ""]).join(rnd.choice(words[rnd.randrange(4) :]) for _ in range(rnd.randint(0, 30)))
        rows.append((rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", None, "d", "é"]), text))
    assert run(frame(rows), workspace=workspace) == brute(rows)


def test_odd_tables(frame, workspace):
    rows = [("en", "a", None), ("en", "b", ""), ("en", None, "1 2 3"), ("fr", "a", "seul"), (None, None, None)]
    assert run(frame(rows), workspace=workspace) == brute(rows)
    rows += [("en", "a", "one two")] * 3 + [("en", "c", "one " * 20_000)] + [("de", "x", "nur eine quelle")] * 5
    assert run(frame(rows), workspace=workspace) == brute(rows)
    assert run(frame([]), workspace=workspace) == set()


def test_only_the_top_terms(frame, workspace):
    rnd = random.Random(4)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    rows = [("en", "ab"[i % 2], " ".join(rnd.choices(words[i % 2 * 100 :], k=200))) for i in range(40)]
    got = run(frame(rows), workspace=workspace, top=30)
    assert got == brute(rows, top=30) and max(r[5] for r in got) == 30


def test_lookups_too_large_to_broadcast(frame, workspace, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 0)
    rnd = random.Random(7)
    rows = [("en", "hot" if rnd.random() < 0.6 else f"s{rnd.randrange(30)}", " ".join(rnd.choices("abcdefg", k=9))) for _ in range(300)]
    assert run(frame(rows), workspace=workspace) == brute(rows)


def test_shares_are_exact():
    rnd = random.Random(1)
    whole = [rnd.randrange(1, 9_000_000_000_000_000) for _ in range(2000)]
    count = [rnd.randrange(0, w) for w in whole]
    got = divergence.share(np.array(count), np.array(whole)).tolist()
    assert got == [1 + 10**9 * (c + 1) // w for c, w in zip(count, whole)]
    with pytest.raises(OverflowError):
        divergence.share(np.array([1]), np.array([1 << 60]))
