import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starflow.llm import quality, toxicity
from starflow.llm.labelled import fold, labelled_sample
from starflow.llm.queries import QUERIES


def prose(rnd, n=60):
    return " ".join(f"w{rnd.randint(0, 300)}" for _ in range(n))


@pytest.fixture(scope="module")
def toxic_corpus():
    """An insult is toxic only next to the mention of a group; each alone is clean."""
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        words = prose(rnd).split()
        for word, there in (("grumbling", insult), ("martians", group)):
            if there:
                words.insert(rnd.randrange(len(words)), word)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(insult and group)))
    return rows, labels


def test_interaction_is_learned(spark, documents, workspace, toxic_corpus):
    rows, labels = toxic_corpus
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs = documents(rows)
    model = toxicity.train_toxicity(docs, marks, workspace=workspace)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    apart = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scored[i] >= 0.5) == bool(y) for i, y in apart)
    assert right / len(apart) > 0.97
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, _, _ in rows if scored[i] < 0.5]


def test_a_rare_insult_is_kept(spark, documents, workspace):
    """An insult in one of a hundred toxic rows, never in clean ones."""
    rnd = random.Random(11)
    rows, labels = [], []
    for i in range(4000):
        toxic, rare = i % 2, i % 200 == 1
        words = prose(rnd, 30).split() + (["zounderkite"] if rare else ["grumbling"] if toxic else [])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, toxic))
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(documents(rows), marks, held_out_fold=None, workspace=workspace)
    assert set(toxicity.terms_of(b"zounderkite")) <= set(model.terms.tolist())
    unseen = [(1, prose(rnd, 30) + " zounderkite", "s"), (2, prose(rnd, 30), "s")]
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents(unseen), model).collect()}
    assert scored[1] > 0.5 > scored[2]


def test_a_term_that_counts_only_in_a_pair_is_kept(spark, documents, workspace):
    """Toxic is exactly one of two words: neither has a difference of its own."""
    rnd = random.Random(12)
    rows, labels = [], []
    for i in range(1200):
        one, two = i % 2, i // 2 % 2
        words = prose(rnd, 30).split() + ["grumbling"] * one + ["martians"] * two
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(one != two)))
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs = documents(rows)
    model = toxicity.train_toxicity(docs, marks, held_out_fold=None, workspace=workspace)
    for word in (b"grumbling", b"martians"):
        assert set(toxicity.terms_of(word)) <= set(model.terms.tolist())
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum((scored[i] >= 0.5) == bool(y) for i, y in labels) / len(labels) > 0.97


def test_score_by_factors_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    model = toxicity.Machine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    some = [0, 2, 5]
    pairs = sum(model.factors[i] @ model.factors[j] for i in some for j in some if i < j)
    assert model.raw(some) == pytest.approx(0.3 + model.linear[some].sum() + pairs)
    assert model.raw([]) == 0.3


SPECIAL = [(1, None, "s"), (2, "", "s"), (3, " \n", "s"), (4, "grumbling martians " * 40_000, "s"), (None, "x", None)]


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 1)], [(3, 0), (4, 0)]])
def test_toxicity_without_labels_of_both_classes(spark, documents, workspace, labels):
    docs = documents(SPECIAL + SPECIAL[:1])
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, marks, workspace=workspace)
    scores = [r["score"] for r in toxicity.score_toxicity(docs, model).collect()]
    assert len(scores) == 6 and len(set(scores)) == 1 and 0 <= scores[0] <= 1
    assert toxicity.drop_toxic(documents([]), model).count() == 0


def test_labels_of_the_held_out_fold_are_never_seen(spark, documents, workspace, toxic_corpus):
    rows, labels = toxic_corpus
    docs = documents(rows)
    apart = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    folds = {r["doc_id"]: r["f"] for r in docs.select("doc_id", fold(F.col("doc_id")).alias("f")).collect()}
    assert sorted(i for i, f in folds.items() if f == 0) == apart
    sample, _ = labelled_sample(
        docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), "toxic",
        per_class=10_000, held_out_fold=0, workspace=workspace,
    )
    assert not {r["id"] for r in sample.collect()} & set(apart)


def test_sample_is_bounded_and_the_same_again(spark, documents, workspace, toxic_corpus):
    rows, labels = toxic_corpus
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    draws = []
    for docs in (documents(rows), documents(rows[::-1]).repartition(5)):
        sample, sizes = labelled_sample(docs, marks, "toxic", per_class=20, workspace=workspace)
        draws.append(sorted((r["id"], r["label"]) for r in sample.collect()))
    assert draws[0] == draws[1]
    assert [sum(y == c for _, y in draws[0]) for c in (0, 1)] == [20, 20]
    assert sum(sizes.values()) == len(labels)


def test_toxicity_on_the_given_tables(spark, sf_dir):
    """Held-out rows of a larger sample, if it is there: nearly all are judged as labelled."""
    big = sf_dir.replace("sf0.001", "sf0.01")
    scored = QUERIES["op10_toxicity"](spark, big)
    labels = spark.read.parquet(f"{big}/labels.parquet")
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.9
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.02


# --- quality ---


def brute_base(text):
    words = (text or "").encode().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    n = len(words)
    return (
        n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


TEXTS = [
    None, "", " \n\n ", "a", "a b c a b c", "a a a a", "x\ny\nx\nx\n\n\nx ", "#*$%&|<> é## ü", "one\x1ctwo three",
    "a b c d " * 30, " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50)),
    " ".join(f"w{i}" for i in range(60)) + " w0 w1 w2", "é ß\n" * 40, "a\tb\rc\x0bd\x0ce\x85f\xa0g",
]


def test_base_rules_equal_brute_force(documents):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "a b", None)]
    found = quality.judge_quality(documents(rows), None).collect()
    got = {r["doc_id"]: tuple(r)[1:7] for r in found}
    assert got == {i: brute_base(t) for i, t, _ in rows}
    assert all(r["kept"] == (not r["base_failed"]) for r in found)
    assert quality.judge_quality(documents([]), None).count() == 0


def test_very_long_text(documents):
    text = " ".join(f"w{i % 70_000}" for i in range(300_000))
    (row,) = quality.judge_quality(documents([(1, text, "s")]), None).collect()
    assert (row["n_words"], row["n_repeat_words"]) == (300_000, 300_000)


def test_repeated_windows_at_random():
    rnd = random.Random(8)
    for _ in range(200):
        ids = np.array([rnd.randint(0, 4) for _ in range(rnd.randint(0, 40))], dtype=np.int64)
        text = " ".join(map(str, ids))
        assert quality.repeated_words(ids) == brute_base(text)[4]


def test_quality_model_separates_and_is_calibrated(spark, documents, workspace):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(800):
        bad = rnd.random() < 0.3
        words = prose(rnd, 80).split()
        if bad:
            words = [w + rnd.choice(["###", "***"]) if rnd.random() < 0.4 else w for w in words]
        rows.append((i, " ".join(words), "s"))
        # One label in twenty is wrong.
        labels.append((i, int(bad == (rnd.random() < 0.05))))
    docs = documents(rows)
    model = quality.train_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), workspace=workspace)
    found = quality.judge_quality(docs, model).collect()
    good = {i: "#" not in t and "*" not in t for i, t, _ in rows}
    assert sum(r["kept"] == good[r["doc_id"]] for r in found) / len(found) > 0.97
    mean = np.mean([r["quality"] for r in found])
    assert abs(mean - np.mean([y for _, y in labels])) < 0.06


def test_scoring_by_words_equals_the_feature_vector(spark, documents, workspace):
    rng = np.random.default_rng(3)
    model = quality.QualityModel(rng.normal(size=quality.BUCKETS), 0.2, 1.5, -0.3)
    texts = [t for t in TEXTS if t and t.split()]
    found = quality.judge([t.encode() for t in texts], quality._Words(model.weights), model)
    for text, p in zip(texts, found["quality"]):
        buckets, counts = quality.features(text.encode())
        raw = model.bias + model.weights[buckets] @ counts
        assert p == pytest.approx(model.probability(np.array([raw]))[0], abs=1e-9)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None)]])
def test_quality_without_labels_keeps_what_the_rules_keep(spark, documents, workspace, labels):
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    assert quality.train_quality(documents([(1, "a b", "s")]), marks, workspace=workspace) is None


def test_quality_on_the_given_tables(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    found = QUERIES["op3_quality_rules"](spark, big)
    labels = spark.read.parquet(f"{big}/labels.parquet").withColumnRenamed("quality", "good")
    rows = [r for r in found.join(labels, "doc_id").collect() if not r["base_failed"]]
    good = [r["kept"] for r in rows if r["good"]]
    bad = [r["kept"] for r in rows if not r["good"]]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2


def test_an_id_on_many_rows_is_one_of_the_sample(documents, spark, workspace):
    rows = [(7, f"text {i}", "s") for i in range(3000)] + [(i, f"other {i}", "s") for i in range(100, 140)]
    marks = spark.createDataFrame([(7, 1)] * 500 + [(i, i % 2) for i in range(100, 140)], "doc_id bigint, toxic int")
    sample, sizes = labelled_sample(documents(rows), marks, "toxic", per_class=30, workspace=workspace)
    found = [r["id"] for r in sample.collect()]
    assert len(found) == len(set(found)) == 41 and sizes == {0: 20, 1: 21}


def test_company_does_not_change_a_quality():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["alpha", "beta", "γ", "x#1", "delta,"]) for _ in range(rnd.randint(0, 90))).encode() for _ in range(200)]
    rng = np.random.default_rng(3)
    model = quality.QualityModel(rng.normal(size=quality.BUCKETS), 0.1, 1.3, 0.2)
    alone = [quality.judge([t], quality._Words(model.weights), model)["quality"][0] for t in texts]
    together = quality.judge(texts, quality._Words(model.weights), model)["quality"]
    assert list(together) == alone


def test_pairs_in_packed_bits_equal_a_recount():
    rng = np.random.default_rng(6)
    n, labels = 30, rng.integers(0, 2, 150)
    present = [np.flatnonzero(rng.random(n) < 0.2) for _ in labels]
    columns = toxicity.packed_columns(present, labels, n)
    best = toxicity.paired_ratio(columns, 0, n)
    table = np.zeros((len(labels), n))
    for row, terms in zip(table, present):
        row[terms] = 1
    for t in range(n):
        ratios = [0.0]
        for o in range(n):
            both = table[:, t] * table[:, o]
            if o != t:
                counts = [both[labels == 1].sum(), both[labels == 0].sum(), table[labels == 1, o].sum(), table[labels == 0, o].sum()]
                ratios.append(float(toxicity.likelihood_ratio(*[np.array([x]) for x in counts])[0]))
        assert best[t] == pytest.approx(max(ratios))
