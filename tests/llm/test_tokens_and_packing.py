import random
import zlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

from starflow.llm import packing
from starflow.llm.tokens import encoder, tokenizer_path

ODD = [
    "a  b", "a\n\nb", " a", "a ", "\n", "a \n b", "a\tb", "<|endoftext|> x", "x <|endoftext|>", "hello <|endoftext|> world", "a<|endoftext|>b", "don't 's 'ª", "",
    "héé... ñ!? ǅa ªº٣x中文.", "3.14 a,b,c (x) [y]!", "end.\nStart now, then.", "\x85a\xa0b", "emoji 😀 ok", "a\r\nb", ".,;:!?",
    "word." * 30, "x" * 5000, "ß q", "I'll they've it's", "a\x1cb c", "﻿bom", "mixed3d to5ken,",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def as_bytes(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_encoding_by_words_equals_encoding_whole(spark, sf_dir, plain):
    texts = [r[0] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    encode = encoder(tokenizer_path()).encode
    for text in texts + ODD + [" ".join(ODD), "\n".join(ODD)]:
        assert encode(text) == as_bytes(plain(text)), text[:60]


@pytest.mark.parametrize("seed", range(4))
def test_random_strings_are_encoded_alike(plain, seed):
    rnd = random.Random(seed)
    letters = "ab Zé\n .,'!3\t中ß\xa0"
    encode = encoder(tokenizer_path()).encode
    for _ in range(300):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40)))
        assert encode(text) == as_bytes(plain(text)), repr(text)


def test_words_with_marks_behind_them_share_the_ids_of_the_marks(plain, monkeypatch):
    from starflow.llm.tokens import Encoder

    made = Encoder(tokenizer_path())
    asked, whole = [], made.whole
    monkeypatch.setattr(made, "whole", lambda text: asked.append(text) or whole(text))
    stems = ["moss", "ñandú", "don", "中文", "x", "I", "relly"]
    tails = [",%%%", "'", ".)", "...", "_", "'\"", "&&&"]
    texts = [" ".join(stem + tail for stem in stems) for tail in tails]
    for _ in range(3):
        for text in texts:
            assert made.encode(text) == as_bytes(plain(text)), text
    assert sorted(asked) == sorted(tails)


def test_marks_of_many_kinds_are_forgotten(plain, monkeypatch):
    from starflow.llm import tokens

    monkeypatch.setattr(tokens, "_CACHE_TAILS", 3)
    made = tokens.Encoder(tokenizer_path())
    text = " ".join("word" + "!" * n + "?" for n in range(1, 20))
    assert made.encode(text) == as_bytes(plain(text))
    assert len(made.tails) <= 3


def check_plan(counts, size, lines):
    used = Counter()
    for line in lines:
        assert line.times > 0 and sum(n * u for n, u in line.fill) <= size
        for n, u in line.fill:
            used[n] += u * line.times
    assert used == Counter({n: c for n, c in counts.items() if c})
    return sum(line.times for line in lines)


def fewest(items, size):
    """Fewest bins by exhaustive search, for a handful of items."""
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= size and bins[b] not in bins[:b]:
                place(i + 1, [*bins[:b], bins[b] + items[i], *bins[b + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_few_documents_are_packed_as_well_as_possible(seed):
    rnd = random.Random(seed)
    items = sorted((rnd.randint(1, 100) for _ in range(9)), reverse=True)
    counts = Counter(items)
    assert check_plan(counts, 100, packing.plan_packing(dict(counts), 100)) == fewest(items, 100)


@pytest.mark.parametrize("n", [10, 200, 1000])
def test_few_lengths_with_large_counts(n):
    counts = {600: n, 130: 8 * n, 100: 4 * n}
    assert check_plan(counts, 2048, packing.plan_packing(counts)) == n


@pytest.mark.parametrize("seed", range(8))
def test_large_counts_come_close_to_the_bound(seed):
    rnd = random.Random(seed)
    counts = {rnd.randrange(40, 900): rnd.randrange(1, 3000) for _ in range(rnd.randrange(3, 12))}
    used = check_plan(counts, 2048, packing.plan_packing(counts))
    room = packing.fullest(counts, 2048)
    assert -(-sum(k * c for k, c in counts.items()) // room) <= used
    plain = check_plan(counts, 2048, packing.plan_packing(counts, steps=1))
    assert used <= plain


def test_a_dominated_filling_gives_way():
    counts = [0] * 101
    counts[60] = counts[50] = counts[30] = counts[20] = counts[5] = 1
    # 30 + 20 is given up for 50, 50 for 60; then 30 fits again, and 5.
    waste, fill = packing.undominated(counts, [5, 20, 30, 50, 60], 50, [(30, 1), (20, 1)])
    assert waste == 100 - sum(n * u for n, u in fill)
    assert packing.undominated(counts, [5, 20, 30, 50, 60], waste, fill) == (waste, fill)
    assert waste <= 5 and all(u <= counts[n] for n, u in fill)


@pytest.mark.parametrize("lengths, most", [([600, 130, 100], 2040), ([3, 2], 2048), ([1025], 1025), ([], 0)])
def test_fullest(lengths, most):
    assert packing.fullest(lengths, 2048) == most


def test_many_documents_leave_next_to_no_waste():
    rnd = random.Random(1)
    counts = Counter(min(2048, max(1, int(rnd.lognormvariate(6, 1)))) for _ in range(20_000))
    n = check_plan(counts, 2048, packing.plan_packing(dict(counts)))
    assert n <= 1.001 * sum(k * c for k, c in counts.items()) / 2048 + 1


def test_plan_lines_do_not_grow_with_the_rows():
    rnd = random.Random(2)
    counts = Counter(rnd.randint(1, 2048) for _ in range(5000))
    huge = {k: c * 10**6 for k, c in counts.items()}
    lines = packing.plan_packing(huge)
    n = check_plan(huge, 2048, lines)
    assert len(lines) < 10_000
    assert n <= 1.01 * sum(k * c for k, c in huge.items()) / 2048


@pytest.mark.parametrize("counts", [{}, {2048: 3}, {1: 5000}, {1500: 10}, {1025: 3, 1023: 2}])
def test_plain_plans(counts):
    n = check_plan(counts, 2048, packing.plan_packing(counts))
    assert n == {0: 0, 3: 3, 5000: 3, 10: 10, 5: 3}[sum(counts.values())]


def brute_pieces(rows, plain, size):
    out = []
    for i, t, _ in rows:
        ids = [*plain(t or ""), 0]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, k, a, b - a, zlib.crc32(as_bytes(ids[a:b]))))
    return sorted(out, key=str)


CASES = {
    "empty table": [],
    "nulls": [(1, None, "s"), (2, "", "s"), (None, "a b", "s"), (None, None, "s")],
    "repeats": [(5, "a b c", "s")] * 6 + [(6, "d", "s")],
    "long": [(1, "one two three. " * 3000, "s"), (2, "four", "s")],
    "many": [(i, "w " * (i * 37 % 90), "s") for i in range(300)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("size", [64, 2048])
def test_pieces_and_places(documents, workspace, plain, name, size):
    rows = CASES[name]
    packed = packing.pack_documents(
        documents(rows).repartition(3), size=size, with_ids=True, workspace=workspace
    )
    found = packed.collect()
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=str)
    assert got == brute_pieces(rows, plain, size)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for parts in by_sequence.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert whole == {s: b"".join(p[2] for p in sorted(parts)) for s, parts in by_sequence.items()}
