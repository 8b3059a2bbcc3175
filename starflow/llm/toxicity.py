"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: its words, and the character n-grams of its words,
so that inflected forms of an insult share terms. The score is linear in the terms plus the
inner products of the factors of every pair of terms present, which the usual identity turns
into two sums per factor; an insult next to the mention of a group can so weigh more than
both alone.

Terms are screened first: counted by class over the sample in the tasks, and kept if a
likelihood-ratio test says that the difference between the classes is not chance. Unlike a
Wald test it does not fade for terms that one class never has: of 4000 documents each, eight
against none are enough. A term without a difference of its own is kept if it has one within the
documents of another term, tested between the MOST_PAIRED most frequent terms. A document is
then a handful of terms, long documents gather no noise, and the fit sees little more than
what matters.

Labels come from a bounded sample: PER_CLASS documents of each class at most (see
``labelled``). Scoring reads every whole text in Arrow batches.

Defined results: NULL and empty texts have no terms and get the score of the intercept.
Repeated rows get equal scores. Without labels of both classes the score is their share, or 0
without any label. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starflow.functions.columns import ref
from starflow.llm.labelled import labelled_sample
from starflow.llm.rows import fresh, map_texts, pick, slices, utf8
from starflow.sources.workspace import Workspace

PER_CLASS = 4000
BUCKETS = 1 << 18
NGRAMS = (4, 5)
FACTORS = 8
MOST_TERMS = 8192  # terms kept by the screening
LEAST_DOCS = 4  # documents of the sample a term must be in
LEAST_RATIO = 10.83  # twice the log likelihood ratio; chance exceeds it once in a thousand terms
MOST_PAIRED = 4096  # most frequent terms that are tested in pairs
CHANCE_PAIRS = 0.05  # pairs expected to pass by chance among all that are tested
THRESHOLD = 0.5
HELD_OUT_FOLD = 0
_CACHE_WORDS = 300_000
_STRIP = 64  # terms whose pairs are tested at once
_MARKS = string.punctuation.encode()
_BLANKS = bytes.maketrans(_MARKS, b" " * len(_MARKS))


def words_of(text: bytes) -> set[bytes]:
    """The distinct words, split at ASCII punctuation too, ASCII letters in lower case."""
    return set(text.lower().translate(_BLANKS).split())


def terms_of(word: bytes) -> list[int]:
    """Buckets of the word and of its character n-grams, word ends marked."""
    framed = ("<" + word.decode() + ">")
    parts = [framed]
    for n in NGRAMS:
        parts += [framed[i : i + n] for i in range(len(framed) - n + 1)]
    return [xxhash.xxh32_intdigest(p.encode()) % BUCKETS for p in set(parts)]


@dataclass
class Machine:
    """``terms`` are the kept buckets; row i of ``linear`` and ``factors`` belongs to terms[i]."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, present: list[int]) -> float:
        """The score of a set of rows, before the logistic function."""
        if not present:
            return self.bias
        v = self.factors[present]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        return self.bias + float(self.linear[present].sum()) + pairs


class _Lookup(dict):
    """Word to the rows of its kept terms; almost always empty."""

    def __init__(self, terms: np.ndarray):
        self.rows = {int(t): i for i, t in enumerate(terms)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        rows = self.rows
        found = self[word] = tuple({rows[t] for t in terms_of(word) if t in rows})
        return found

    def present(self, text: bytes) -> list[int]:
        if len(self) > _CACHE_WORDS:
            self.clear()
        out: set[int] = set()
        for word in words_of(text):
            rows = self[word]
            if rows:
                out.update(rows)
        return sorted(out)


def _surprise(found: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """found * log(found / expected), 0 where nothing is found."""
    return found * np.log(np.where(found > 0, found, 1) / np.where(found > 0, expected, 1))


def likelihood_ratio(toxic: np.ndarray, clean: np.ndarray, all_toxic: np.ndarray, all_clean: np.ndarray) -> np.ndarray:
    """Twice the log likelihood ratio that a term's share differs between the classes."""
    share = (toxic + clean) / np.maximum(all_toxic + all_clean, 1)
    out = _surprise(toxic, all_toxic * share) + _surprise(all_toxic - toxic, all_toxic * (1 - share))
    return 2 * (out + _surprise(clean, all_clean * share) + _surprise(all_clean - clean, all_clean * (1 - share)))


def packed_columns(present: list[np.ndarray], labels: np.ndarray, n: int) -> list[np.ndarray]:
    """Per class (clean, toxic) one bit per document for each of ``n`` terms, as (term, 64-bit word)."""
    out = []
    for value in (0, 1):
        some = np.flatnonzero(labels == value)
        bits = np.zeros((n, -(-max(1, len(some)) // 64) * 8), dtype=np.uint8)
        for k, i in enumerate(some):
            bits[present[i], k >> 3] |= np.uint8(1 << (k & 7))
        out.append(bits.view(np.uint64))
    return out


def paired_ratio(columns: list[np.ndarray], low: int, high: int) -> np.ndarray:
    """For the terms low..high the largest likelihood ratio each has within the documents of another term."""
    n = len(columns[0])
    own = [np.bitwise_count(c).sum(axis=1).astype(float) for c in columns]
    best = np.zeros(high - low)
    for t in range(low, high):
        clean, toxic = (np.bitwise_count(c & c[t]).sum(axis=1).astype(float) for c in columns)
        ratio = likelihood_ratio(toxic, clean, own[1], own[0])
        ratio[t] = 0
        best[t - low] = ratio.max(initial=0) if n > 1 else 0
    return best


def _paired_in_tasks(sample: DataFrame, columns: list[np.ndarray]) -> np.ndarray:
    """``paired_ratio`` of all terms, strip by strip in tasks; the bits (8 MB at the most) are broadcast."""
    spark, n = sample.sparkSession, len(columns[0])
    shared = spark.sparkContext.broadcast(columns)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                best = paired_ratio(shared.value, start, min(n, start + _STRIP))
                yield pa.RecordBatch.from_arrays([pa.array(start + np.arange(len(best))), pa.array(best)], ["t", "best"])

    strips = -(-n // _STRIP)
    found = spark.range(0, n, _STRIP, max(1, min(strips, 64))).mapInArrow(run, "t bigint, best double").toArrow()
    out = np.zeros(n)
    out[found["t"].to_numpy()] = found["best"].to_numpy()
    shared.unpersist()
    return out


def screen(sample: DataFrame, n_terms: int = MOST_TERMS, n_paired: int = MOST_PAIRED) -> np.ndarray:
    """The buckets whose share of documents differs between the classes beyond chance.

    Each task counts documents per bucket and class; at most 2 * BUCKETS sums meet. For the
    pairs, each document of the sample sends which of the ``n_paired`` buckets it has; they
    become one bit per term and document, and the tasks test the pairs.
    """

    def count(batches) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        cache: dict[bytes, list[int]] = {}
        for batch in slices(batches):
            for label, text in zip(batch.column(2).to_pylist(), utf8(batch.column(1))):
                found: set[int] = set()
                for word in words_of(text):
                    terms = cache.get(word)
                    if terms is None:
                        terms = cache[word] = terms_of(word)
                    found.update(terms)
                if len(cache) > _CACHE_WORDS:
                    cache.clear()
                counts[label, list(found)] += 1
        label, bucket = np.nonzero(counts)
        arrays = [pa.array(label.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[label, bucket])]
        yield pa.RecordBatch.from_arrays(arrays, ["label", "bucket", "n"])

    rows = sample.select("id", "text", "label").mapInArrow(count, "label int, bucket int, n bigint")
    by_class = rows.groupBy("bucket").agg(
        *[F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    )
    seen = by_class.where(F.col("n0") + F.col("n1") >= LEAST_DOCS).toArrow()
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2 or not len(seen):
        return np.zeros(0, dtype=np.int64)
    toxic, clean = seen["n1"].to_numpy().astype(float), seen["n0"].to_numpy().astype(float)
    ratio = likelihood_ratio(toxic, clean, sizes[1], sizes[0])
    buckets = seen["bucket"].to_numpy().astype(np.int64)
    passed = ratio >= LEAST_RATIO
    often = np.lexsort((buckets, -(toxic + clean)))[:n_paired]
    paired = buckets[often]

    def reduce(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        lookup = _Lookup(paired)
        rows = [np.array(lookup.present(t), dtype=np.int32).tobytes() for t in texts]
        return [batch.column(2), pa.array(rows, pa.binary())]

    rows = map_texts(sample.select("id", "text", "label"), reduce, "label int, present binary").toArrow()
    present = [np.frombuffer(x, np.int32) for x in rows["present"].to_pylist()]
    columns = packed_columns(present, rows["label"].to_numpy(), len(paired))
    del rows, present
    best = _paired_in_tasks(sample, columns)
    chance = CHANCE_PAIRS / max(1, len(paired) ** 2)
    joint = (best >= NormalDist().inv_cdf(chance / 2) ** 2) & ~passed[often]
    ratio[often[joint]] = best[joint]
    passed[often[joint]] = True
    order = np.lexsort((buckets, -ratio))
    kept = order[passed[order]][:n_terms]
    return np.sort(buckets[kept])


def fit_machine(
    present: list[list[int]], labels: np.ndarray, weights: np.ndarray, n: int,
    *, factors: int = FACTORS, epochs: int = 25, rate: float = 0.03, decay: float = 1e-4, seed: int = 7,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted logistic loss by Adam over small batches of documents."""
    rng = np.random.default_rng(seed)
    # One column of linear weights, then the factors; transposed, so that sums run along rows.
    model = np.zeros((1 + factors, n))
    model[1:] = rng.normal(0, 0.05, (n, factors)).T
    share = float((weights * labels).sum() / weights.sum())
    bias = np.log(share / (1 - share))
    mean, square, steps = np.zeros_like(model), np.zeros_like(model), 0
    bias_mean = bias_square = 0.0
    weights = weights / weights.mean()
    batches = max(1, len(present) // 256)
    for _ in range(epochs):
        order = rng.permutation(len(present))
        for start in range(0, len(order), 256):
            rows = order[start : start + 256]
            terms = np.concatenate([np.asarray(present[i], dtype=np.int64) for i in rows])
            row = np.repeat(np.arange(len(rows)), [len(present[i]) for i in rows])
            values = model[:, terms]
            total = np.stack([np.bincount(row, x, minlength=len(rows)) for x in values])
            squares = np.bincount(row, (values[1:] ** 2).sum(axis=0), minlength=len(rows))
            raw = bias + total[0] + 0.5 * ((total[1:] ** 2).sum(axis=0) - squares)
            error = weights[rows] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[rows]) / len(rows)
            step = error[row] * np.concatenate([np.ones((1, len(row))), total[1:, row] - values[1:]])
            # Of no terms at all bincount makes integers.
            grad = np.stack([np.bincount(terms, x, minlength=n) for x in step]).astype(float)
            grad += decay * model / batches
            steps += 1
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad**2 - square)
            size = rate * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            model -= size * mean / (np.sqrt(square) + 1e-8)
            g = float(error.sum())
            bias_mean += 0.1 * (g - bias_mean)
            bias_square += 0.001 * (g * g - bias_square)
            bias -= size * bias_mean / (np.sqrt(bias_square) + 1e-8)
    return float(bias), model[0].copy(), model[1:].T.copy()


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    *,
    per_class: int = PER_CLASS,
    held_out_fold: int | None = HELD_OUT_FOLD,
    workspace: Workspace | None = None,
) -> Machine:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    workspace = workspace or Workspace(docs.sparkSession)
    sample, sizes = labelled_sample(
        docs, labels, label, doc_id=doc_id, text=text,
        per_class=per_class, held_out_fold=held_out_fold, workspace=workspace,
    )
    terms = screen(sample)
    lookup_terms = terms

    def reduce(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        lookup = _Lookup(lookup_terms)
        rows = pa.array([lookup.present(t) for t in texts], pa.list_(pa.int32()))
        return [batch.column(0), batch.column(2), rows]

    kind = sample.schema["id"].dataType.simpleString()
    rows = map_texts(sample.select("id", "text", "label"), reduce, f"id {kind}, label int, present array<int>")
    fitted = rows.orderBy("id").toArrow()  # at most 2 * per_class short lists
    y = fitted["label"].to_numpy().astype(float)
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Machine(np.zeros(0, np.int64), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    # Each class counts as much as it has labelled rows, however many were taken.
    class_weight = {c: sizes.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1)}
    weights = np.array([class_weight[int(c)] for c in y])
    lists = fitted["present"].combine_chunks()
    cuts = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    present = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    bias, linear, factors = fit_machine(present, y, weights, len(terms))
    return Machine(terms, bias, linear, factors)


def score_toxicity(docs: DataFrame, model: Machine, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) per row; the score is a probability."""
    rows = pick(docs, id=doc_id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    scores = _scorer(model)

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        return [batch.column(0), scores(texts)]

    return map_texts(rows, run, f"id {kind}, score double").withColumnRenamed("id", doc_id)


def _scorer(model: Machine):
    held: list[_Lookup] = []  # one per task, made where it runs

    def scores(texts: list[bytes]) -> pa.Array:
        if not held:
            held.append(_Lookup(model.terms))
        raw = np.array([model.raw(held[0].present(t)) for t in texts])
        return pa.array(1 / (1 + np.exp(-np.clip(raw, -700, 700))))

    return scores


def drop_toxic(
    docs: DataFrame, model: Machine, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. No shuffle."""
    score = fresh(docs, "_score")
    out = StructType([*docs.schema.fields, StructField(score, DoubleType())])
    at = docs.columns.index(text)
    scores = _scorer(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores(utf8(batch.column(at)))], [*batch.schema.names, score]
            )

    return docs.mapInArrow(run, out).where(ref(score) < threshold).drop(score)
