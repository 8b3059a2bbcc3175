import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from starflow.llm import class_lm


def tokens_of(text):
    return (text or "").encode().lower().split() + [b""]


def apart(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def base(rows):
    counts = Counter(t for i, text, _ in rows if not apart(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text, _ in rows:
        words = tokens_of(text)
        score = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((i, apart(i), len(words), sum(counts[w] > 0 for w in words), n, score))
    return out


def corpus(n=400, seed=1):
    """Two languages: words of one never follow words of the other."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        letters = "ab" if i % 3 else "yz"
        vocabulary = [letters[0] + str(k) + letters[1] for k in range(150)]
        words = [rnd.choice(vocabulary[: rnd.choice([5, 150])]) for _ in range(rnd.randint(0, 60))]
        rows.append((i, " ".join(words).title(), "s"))
    return rows


OPTIONS = dict(exchanged=60, classes=8, rounds=6)


@pytest.mark.parametrize("known", [1, 40, 200_000])
def test_base_score_equals_brute_force(documents, workspace, known):
    rows = corpus() + [(None, "a1b new", "s"), (1000, None, "s"), (1001, "", "s"), (3, "A1B É é", "s"), (3, "A1B É é", "s")]
    found = class_lm.score_documents(documents(rows).repartition(3), known=known, workspace=workspace, **OPTIONS)
    got = sorted((tuple(r)[:6] for r in found.collect()), key=lambda r: (str(r[0]), r[2], r[5]))
    expected = sorted(base(rows), key=lambda r: (str(r[0]), r[2], r[5]))
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected])


def test_score_equals_the_model_by_hand(documents, workspace):
    rows = corpus(150)
    docs = documents(rows).select("doc_id", "text")
    training = docs.where(~class_lm.held_out(docs["doc_id"])).select("text")
    counts = workspace.store(class_lm.word_counts(training), "counts")
    model = class_lm.train_class_model(training, counts, workspace, **OPTIONS)
    table = {bytes(r["word"]): r["c"] for r in counts.collect()}
    units = class_lm.Units(model.exchanged)
    numbered = docs.selectExpr("doc_id AS row", "doc_id AS id", "text")
    for known in (3, 1000):
        scored = class_lm.score_texts(numbered, model, counts, workspace, known=known)
        got = {r["id"]: r["score"] for r in scored.collect()}
        for i, text, _ in rows:
            before, score = model.unit_class[0], 0.0
            for w in tokens_of(text):
                k = model.unit_class[units[w]]
                score += model.transition[before, k]
                score += np.log10(table.get(w, 0) + class_lm.ADD) - model.emission[k]
                before = k
            assert got[i] == pytest.approx(score)


def test_probabilities_add_up(documents, workspace):
    rows = corpus(150)
    docs = documents(rows).select("text")
    counts = workspace.store(class_lm.word_counts(docs), "counts")
    model = class_lm.train_class_model(docs, counts, workspace, **OPTIONS)
    assert (10**model.transition).sum(axis=1) == pytest.approx(np.ones(8))
    units = class_lm.Units(model.exchanged)
    mass = np.zeros(8)
    for r in counts.collect():
        k = model.unit_class[units[bytes(r["word"])]]
        mass[k] += 10 ** (np.log10(r["c"] + class_lm.ADD) - model.emission[k])
    # What is left in each class is the share of one unseen word.
    rest = 10 ** (np.log10(class_lm.ADD) - model.emission)
    assert mass + rest == pytest.approx(np.ones(8))


def test_classes_learn_the_languages(documents, workspace):
    rows = corpus(600)
    found = class_lm.score_documents(documents(rows), workspace=workspace, **OPTIONS).collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 60
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.97
    assert all(r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"])) for r in held)


def value_of(joint):
    log = lambda x: x * np.log(np.where(x > 0, x, 1))
    return log(joint).sum() - log(joint.sum(axis=1)).sum() - log(joint.sum(axis=0)).sum()


def test_gain_of_a_move_is_the_difference_in_likelihood():
    rng = np.random.default_rng(2)
    n, classes = 9, 4
    pairs = rng.integers(0, 6, (n, n)).astype(float)
    own = rng.integers(0, classes, n)

    def joint_of(of):
        out = np.zeros((classes, classes))
        np.add.at(out, (of[:, None].repeat(n, 1), of[None, :].repeat(n, 0)), pairs)
        return out

    for u in range(n):
        left, right = np.zeros((1, classes)), np.zeros((1, classes))
        for v in range(n):
            if v != u:
                left[0, own[v]] += pairs[v, u]
                right[0, own[v]] += pairs[u, v]
        best, gain = class_lm.best_moves(left, right, np.array([pairs[u, u]]), own[[u]], joint_of(own))
        values = []
        for c in range(classes):
            trial = own.copy()
            trial[u] = c
            values.append(value_of(joint_of(trial)))
        assert values[best[0]] == pytest.approx(max(values))
        assert gain[0] == pytest.approx(max(values) - values[own[u]])


def test_unit_pairs_cover_every_neighbour(documents, workspace):
    rows = corpus(60) + [(900, None, "s")]
    docs = documents(rows).select("text").repartition(4)
    found = {(r["a"], r["b"]): r["n"] for r in class_lm.unit_pairs(docs, [b"a1b", b"y2z"]).collect()}
    units = class_lm.Units([b"a1b", b"y2z"])
    expected = Counter()
    for _, text, _ in rows:
        chain = [b"", *tokens_of(text)]
        expected.update((units[a], units[b]) for a, b in zip(chain, chain[1:]))
    assert found == expected


def test_frequent_words_are_bounded(spark):
    df = spark.createDataFrame([(str(i).encode(), i) for i in range(1, 200)], "word binary, c bigint")
    kept = [r["c"] for r in class_lm.frequent_words(df, 50).collect()]
    assert 20 < len(kept) <= 50 and min(kept) > 140
    assert class_lm.frequent_words(df, 0).count() == 0
    assert class_lm.frequent_words(df, 1000).count() == 199


@pytest.mark.parametrize("rows", [[], [(8, "only apart", "s")], [(8, None, "s"), (None, None, None)]])
def test_small_tables(documents, workspace, rows):
    found = class_lm.score_documents(documents(rows), workspace=workspace, **OPTIONS).collect()
    assert len(found) == len(rows)
    got = sorted((r["n_tokens"], r["base_score"]) for r in found)
    expected = sorted((r[2], r[5]) for r in base(rows))
    assert [n for n, _ in got] == [n for n, _ in expected]
    assert [s for _, s in got] == pytest.approx([s for _, s in expected])
    assert all(np.isfinite(r["score"]) for r in found)


def test_every_frequent_word_is_placed(documents, workspace):
    """1500 words of one ending, in two kinds that take turns: all are exchanged, kinds stay apart."""
    rnd = random.Random(9)
    kinds = [[f"{k}{i}end" for i in range(750)] for k in "pq"]
    rows = [(i, " ".join(rnd.choice(kinds[j % 2]) for j in range(100)), "s") for i in range(600)]
    docs = documents(rows).select("text")
    counts = workspace.store(class_lm.word_counts(docs), "counts")
    model = class_lm.train_class_model(docs, counts, workspace, classes=3)
    assert set(model.exchanged) == {w.encode() for kind in kinds for w in kind}
    units = class_lm.Units(model.exchanged)
    of = [{int(model.unit_class[units[w.encode()]]) for w in kind} for kind in kinds]
    assert sorted(map(sorted, of)) == [[1], [2]]


def test_no_unit_goes_to_the_class_of_the_end_token():
    rng = np.random.default_rng(4)
    left, right, own = rng.integers(0, 9, (20, 4)), rng.integers(0, 9, (20, 4)), rng.integers(1, 4, 20)
    joint = rng.integers(500, 900, (4, 4)).astype(float)
    best, gain = class_lm.best_moves(left.astype(float), right.astype(float), np.zeros(20), own, joint, first=1)
    assert best.min() >= 1 and gain.min() >= 0


def test_tables_and_class_counts_equal_a_recount(documents, workspace, monkeypatch):
    """However the pairs are packed, the exchange keeps the table that its classes have."""
    monkeypatch.setattr(class_lm, "_PACKED", 40)
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(40)), "s") for i in range(80)]
    docs = documents(rows).select("text").repartition(3)
    names = [w.encode() for w in ("a", "b", "aa", "bb", "c", "ccc", "d")]
    pairs = workspace.store(class_lm.unit_pairs(docs, names), "pairs")
    n = class_lm.Units(names).n
    totals = np.zeros(n)
    for r in pairs.collect():
        totals[r["b"]] += r["n"]
    values = []
    for rounds, head in ((0, 2000), (2, 2000), (None, 2000), (None, 3)):
        own, joint = class_lm.exchange(pairs, totals, workspace, 4, rounds, head)
        expected = np.zeros((4, 4))
        for r in pairs.collect():
            expected[own[r["a"]], own[r["b"]]] += r["n"]
        assert (joint == expected).all() and own[0] == 0 and (own[1:] > 0).all()
        values.append(value_of(joint))
    assert values[0] < values[1] <= values[2] and values[3] > values[0]


def test_packed_rows_hold_large_counts(monkeypatch):
    monkeypatch.setattr(class_lm, "_MOST_COUNT", 10)
    side = (np.array([0, 0, 2]), np.array([5, 6, 7]), np.array([9, 35, 20]))
    row = class_lm._packed_row(np.array([1, 2, 3]), np.zeros(3), [side, tuple(x[:0] for x in side)])
    ((units, loops, ends, v, n, ends1, v1, n1),) = class_lm._unpacked([row], class_lm._KINDS)
    at = class_lm._places(ends)
    assert np.bincount(at * 10 + v, n, minlength=30).tolist() == [0] * 5 + [9, 35] + [0] * 20 + [20] + [0] * 2
    assert len(v1) == len(n1) == 0 and ends1.tolist() == [0, 0, 0]


def test_a_word_that_only_held_out_texts_have_is_not_looked_up(documents, workspace):
    rows = [(i, "known words here " * 3 + ("hot " * 50 if apart(i) else ""), "s") for i in range(60)]
    docs = documents(rows)
    flagged = docs.select("text", (~class_lm.held_out(docs["doc_id"])).alias("trains"))
    counts = {bytes(r["word"]): (r["c"], r["t"]) for r in class_lm.word_counts(flagged).collect()}
    assert counts[b"hot"][0] == 0 and counts[b"hot"][1] > 100
    frequent = class_lm.frequent_words(class_lm.word_counts(flagged), 4, "t").collect()
    assert b"hot" in {bytes(r["word"]) for r in frequent}
    found = class_lm.score_documents(docs, workspace=workspace, known=4, **OPTIONS).collect()
    assert {r["tied_words"] for r in found} == {0} and all(r["n_known"] < r["n_tokens"] for r in found if r["held_out"])


def test_words_beyond_the_bound_are_reported(documents, workspace):
    rows = [(i, " ".join(f"w{k}" for k in range(30)), "s") for i in range(40)]
    found = class_lm.score_documents(documents(rows), workspace=workspace, **{**OPTIONS, "exchanged": 10}).first()
    assert found["tied_words"] == 20


def test_a_round_reads_one_half_at_five_bytes_a_neighbour(documents, workspace, monkeypatch):
    monkeypatch.setattr(class_lm, "_PACKED", 30)
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(40)), "s") for i in range(60)]
    names = [c.encode() * n for c in "abcdefgh" for n in (1, 2)]
    pairs = class_lm.unit_pairs(documents(rows).select("text").repartition(3), names)
    packed = class_lm.store_by_half(class_lm.pack_pairs(pairs), "packed", workspace)
    units = {0: set(), 1: set()}
    for r in packed.collect():
        held = np.frombuffer(r["units"], np.int32)
        assert (class_lm.half_of(held) == r["half"]).all() and not units[r["half"]] & set(held.tolist())
        units[r["half"]] |= set(held.tolist())
        assert len(r["v0"]) == 4 * len(r["n0"]) and len(r["v1"]) == 4 * len(r["n1"])
    assert units[0] and units[1]
    for half in (0, 1):
        files = packed.where(packed["half"] == half).select("_metadata.file_path").distinct().collect()
        assert files and all(f"/half={half}/" in f[0] for f in files)


def test_words_without_a_place_take_that_of_their_ending_and_frequent_ones_stay(monkeypatch):
    monkeypatch.setattr(class_lm, "_RARE_SLOTS", 2)
    n = class_lm.Units([b"own"]).n
    model = class_lm.ClassModel([b"own"], np.arange(n) % 5, np.zeros((5, 5)), np.zeros(5), 10, 3)
    slots = class_lm.Slots.of({b"": 4, b"seen": 3, b"heldout": 0}, model)
    memo = class_lm._SlotCache(slots)
    rare = [b"rare%d" % i for i in range(9)]
    for word in rare:
        assert memo[word] == slots.endings + class_lm.ending_of(word)
    memo.trim()
    assert set(memo) == {b"", b"seen", b"heldout", b"own"}
    units = class_lm.Units(model.exchanged)
    for word, known, look_up in ((b"", True, False), (b"seen", True, False), (b"heldout", False, False), (b"own", False, True), (rare[0], False, True)):
        at = memo[word]
        assert (slots.known[at], slots.rare[at], slots.classes[at]) == (known, look_up, units.unit(word) % 5)
        assert slots.base[at] == np.log10({b"": 4, b"seen": 3}.get(word, 0) + class_lm.BASE_ADD) - model.base_log


def test_pairs_move_as_arrays_and_are_summed_once(documents, workspace):
    """One row per task and bucket is shuffled, not one per pair; both forms pack to the same neighbours."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(60)), "s") for i in range(80)]
    names = [c.encode() * n for c in "abcdefgh" for n in range(1, 10)]
    training = documents(rows).select("text").repartition(3)
    counted, pairs = class_lm.counted_pairs(training, names), class_lm.unit_pairs(training, names)
    buckets = int(training.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert counted.count() <= 3 * buckets and pairs.count() == pairs.select("a", "b").distinct().count()
    assert pairs.agg({"n": "sum"}).first()[0] == 80 * 61

    def neighbours(packed):
        found = set()
        for r in packed.collect():
            units, loops = np.frombuffer(r["units"], np.int32), np.frombuffer(r["loops"], np.float64)
            found |= {(u, 2, u, n) for u, n in zip(units.tolist(), loops.tolist()) if n}
            for side in (0, 1):
                at = class_lm._places(np.frombuffer(r[f"at{side}"], np.int32))
                v, n = np.frombuffer(r[f"v{side}"], np.int32), np.frombuffer(r[f"n{side}"], np.uint8)
                found |= set(zip(units[at].tolist(), [side] * len(at), v.tolist(), n.tolist()))
        return found

    expected = set()
    for r in pairs.collect():
        same = r["a"] == r["b"]
        expected |= {(r["a"], 2, r["a"], r["n"])} if same else {(r["b"], 0, r["a"], r["n"]), (r["a"], 1, r["b"], r["n"])}
    assert neighbours(class_lm.pack_pairs(counted)) == neighbours(class_lm.pack_pairs(pairs)) == expected


def test_logs_that_are_looked_up_are_those_of_the_formula(monkeypatch):
    monkeypatch.setattr(class_lm, "_MOST_LOGS", 400)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 50, (8, 8)).astype(float)
    n, at = rng.integers(0, 30, 200).astype(float), rng.integers(0, 8, 200)
    logs = class_lm.Logs(base)
    assert 0 < len(logs.small) < 30
    want = class_lm._log(base[at] + n[:, None])
    assert (logs.plus(n, at) == want).all()
    assert (logs.gain(n, at) == want - class_lm._log(base[at])).all()
    assert (class_lm.Logs(base[0]).plus(n) == class_lm._log(base[0] + n[:, None])).all()


def test_words_are_counted_as_they_are_split(documents, monkeypatch):
    monkeypatch.setattr(class_lm, "_COUNT_BYTES", 30)
    texts = ["  A b\tB \x0b\x0c\r\nc ", None, "", "\n", "x\x1cy x\x85y   É é", "b " * 30, "a\x00 a"]
    rows = documents([(i, t, "s") for i, t in enumerate(texts)]).select("text", (F.col("doc_id") % 2 == 1).alias("trains"))
    found = {bytes(r["word"]): (r["c"], r["t"]) for r in class_lm.word_counts(rows.coalesce(1)).collect()}
    want = {}
    for i, text in enumerate(texts):
        for word in [*class_lm.words_of((text or "").encode()), b""]:
            c, t = want.get(word, (0, 0))
            want[word] = c + i % 2, t + 1
    assert found == want


def test_the_head_is_stored_in_few_files(spark, documents, workspace):
    """A bounded table; a file per shuffle partition would make every round cost more as the input grows."""
    rnd = random.Random(8)
    names = [f"w{i}".encode() for i in range(60)]
    docs = documents([(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(80)), "s") for i in range(40)]).select("text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        totals = np.arange(class_lm.Units(names).n, 0, -1)
        class_lm.exchange(class_lm.counted_pairs(docs, names), totals, workspace, 3, 2, head=20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (head,) = Path(workspace.path).glob("head-*")
    assert 0 < len(list(head.rglob("*.parquet"))) <= 2
