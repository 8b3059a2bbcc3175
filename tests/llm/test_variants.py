import random
import re
import zlib
from collections import Counter

import pytest

from starflow.llm import variants
from starflow.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_near(words):
    """Neighbours by the words that one missing letter leaves, then checked pair by pair."""
    by_form = {}
    for w in words:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_form.setdefault(form, []).append(w)
    out = {w: set() for w in words}
    for group in by_form.values():
        for a in group:
            out[a].update(b for b in group if near(a, b))
    return out


def brute(rows):
    words = brute_words(rows)
    neighbours, forms = brute_near(words), {}
    for w, others in neighbours.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            forms[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, forms.get(w), root, n, len(neighbours[w]), words[forms[w]] if w in forms else None))
    return out


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_random_words(documents, workspace):
    rnd = random.Random(3)
    stems = ["banana", "bandana", "aaaaaa", "éclair", "straße", "xylem", "abcdefgh", "NAÏVETÉ", "papaya"]
    letters = "abcdeéßxÀ"
    rows = []
    for i in range(300):
        words = []
        for _ in range(rnd.randint(0, 60)):
            w = list(rnd.choice(stems))
            for _ in range(rnd.choice((0, 0, 0, 1, 1, 2))):
                at = rnd.randrange(len(w))
                change = rnd.randrange(3)
                if change == 0:
                    w[at] = rnd.choice(letters)
                elif change == 1:
                    w.insert(at, rnd.choice(letters))
                elif len(w) > 1:
                    del w[at]
            words.append("".join(w))
        rows.append((i, rnd.choice([" ", "-", "1", "ÿ ", "日"]).join(words), "s"))
    got = found(variants.spelling_variants(documents(rows), workspace=workspace))
    expected = brute([r[:2] for r in rows])
    assert len(expected) > 300 and any(r[4] > 5 for r in expected) and any(r[2] not in (r[0], r[1]) for r in expected)
    assert got == expected


def test_chains_ties_and_odd_texts(documents, workspace):
    rows = [(1, None, "s"), (2, "", "s"), (None, "tables tables tables", "s"), (3, "12 !! 日本語", None)]
    rows += [(4, "houses " * 3 + "house " * 6 + "hause " * 24 + "haus " * 9, "s")] * 2
    rows += [(5, "tablet " * 12 + "tabled " * 12 + "table's", "s"), (6, "a" * 70_000, "s")]
    assert found(variants.spelling_variants(documents(rows), workspace=workspace)) == brute([r[:2] for r in rows])
    assert variants.spelling_variants(documents([])).collect() == []
    assert variants.spelling_variants(documents([(1, "once only here", "s")])).collect() == []


@pytest.mark.parametrize("size", [64, 3000])
def test_long_words(documents, workspace, size):
    rnd = random.Random(size)
    word = "".join(rnd.choice("abc") for _ in range(size))
    at = size // 2
    others = [word[:at] + word[at + 1 :], word + "a", word[:at] + "z" + word[at + 1 :], "z" + word[1:], word[:-1], "b" + word]
    others += [word[: at // 2] + "zz" + word[at // 2 + 2 :]]
    rows = [(i, " ".join([word] * 7 + others * 3), "s") for i in range(3)]
    assert found(variants.spelling_variants(documents(rows), workspace=workspace)) == brute([r[:2] for r in rows])


def test_edges_too_many_to_broadcast(documents, workspace, monkeypatch):
    monkeypatch.setattr(variants, "BROADCAST_BYTES", 0)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(5, 7))) for _ in range(400)]
    rows = [(i, " ".join(words), "s") for i in range(4)]
    assert found(variants.spelling_variants(documents(rows), workspace=workspace)) == brute([r[:2] for r in rows])


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op11_spelling_variants"](spark, sf_dir)) == brute([tuple(r) for r in rows])
