"""Quality rules: fixed base rules, and a calibrated logistic regression on hashed n-grams.

Features are hashed counts per word of the text: words, pairs of neighbouring words (a word
equal to the one before it is written "=", so that any repetition is the same feature) and the
character n-grams of words. The model is linear, so the character n-grams of a word add up to one
number per distinct word; a batch of texts is scored with array operations on word numbers.

It is fitted on a bounded sample of labelled rows (PER_CLASS of each class at most, see
``labelled``); a part of the sample is kept apart to calibrate the score to a probability.

Defined results: NULL counts as empty; a text without words fails the base rules. Repeated rows
get equal results. Without labels of both classes the model keeps everything. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.labelled import labelled_sample
from starflow.llm.rows import map_texts, pick
from starflow.sources.workspace import Workspace

PER_CLASS = 2000
BUCKETS = 1 << 16
NGRAMS = (3, 4)
KEEP_AT = 0.5  # calibrated probability of good quality
LEAST_WORDS = 50
MOST_REPEATED_PCT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
_CACHE_WORDS = 300_000
_SAME = xxhash.xxh32_intdigest(b"=")
_PAIR = np.uint32(0x9E3779B1)


def _bucket(code: np.ndarray) -> np.ndarray:
    """Mixed 32-bit codes to buckets."""
    with np.errstate(over="ignore"):
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        code = code ^ (code >> np.uint32(13))
    return (code >> np.uint32(16)).astype(np.int64) % BUCKETS


def word_buckets(words: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers): each word, by its hash, and its character n-grams.

    Word ends are marked. All words are taken at once, as one row of code points.
    """
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    text = "<" + "><".join(words) + ">"
    chars = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.cumsum(lengths)[owner] - np.arange(len(chars))  # characters to the word's end
    buckets, owners = [_bucket(hashes)], [np.arange(len(words))]
    for n in NGRAMS:
        last = len(chars) - n + 1
        code = np.full(max(0, last), n, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for k in range(n):
                code = code * np.uint32(0x01000193) + chars[k : last + k]
        whole = left[: max(0, last)] >= n
        buckets.append(_bucket(code[whole]))
        owners.append(owner[: max(0, last)][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the pairs of neighbours in one text, from the words' 32-bit hashes."""
    left, right = hashes[:-1], hashes[1:]
    right = np.where(left == right, np.uint32(_SAME), right)
    left = np.where(right == np.uint32(_SAME), np.uint32(_SAME), left)
    with np.errstate(over="ignore"):
        mixed = (left * _PAIR) ^ (right + (right << np.uint32(7)))
    return _bucket(mixed)


@dataclass
class QualityModel:
    """Raw score = bias + mean weight over the words; probability = logistic(a * raw + b)."""

    weights: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * raw + self.b, -30, 30)))


class _Words(dict):
    """Word to a number; per number the word's length, symbols, hash and model weight."""

    def __init__(self, weights: np.ndarray | None):
        self.weights = weights
        self.new: list[bytes] = []
        self.arrays = np.zeros((0, 4))

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        ids = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.new:
            facts = np.zeros((len(self.new), 4))
            texts = [w.decode() for w in self.new]
            hashes = np.array([xxhash.xxh32_intdigest(w) for w in self.new], dtype=np.uint32)
            facts[:, 0] = [len(t) for t in texts]
            facts[:, 1] = [len(w) - len(w.translate(None, SYMBOLS)) for w in self.new]
            facts[:, 2] = hashes
            if self.weights is not None:
                buckets, owner = word_buckets(texts, hashes)
                facts[:, 3] = np.bincount(owner, self.weights[buckets], minlength=len(texts))
            self.arrays = np.concatenate([self.arrays, facts])
            self.new = []
        return ids

    def trim(self) -> None:
        if len(self) > _CACHE_WORDS:
            self.clear()
            self.arrays = self.arrays[:0]


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that occur at least twice in the text. Exact: no hashing."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code = ids[:n]
    for k in range(1, window):
        code = np.unique(code, return_inverse=True)[1] if k > 1 else code
        code = code * (int(ids.max()) + 1) + ids[k : k + n]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    if not twice.any():
        return 0
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(window):
        covered[k : k + n] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    distinct = set(lines)
    if len(distinct) == len(lines):
        return 0
    return sum(1 for x in lines if x.strip()) - sum(1 for x in distinct if x.strip())


def _numbered(texts: list[bytes], table: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, and where each text starts and ends."""
    table.trim()
    split = [t.split() for t in texts]
    ends = np.cumsum([0, *map(len, split)])
    return table.numbers([w for words in split for w in words]), ends


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over the rows start..end of each text, each on its own: company changes nothing."""
    out = np.zeros((len(starts), *values.shape[1:]))
    some = ends > starts
    if some.any():
        # Every second sum is that of the rows between two texts.
        cuts = np.stack([starts[some], ends[some]], axis=1).ravel()
        padded = np.concatenate([values, np.zeros((1, *values.shape[1:]))])
        out[some] = np.add.reduceat(padded, cuts, axis=0)[::2]
    return out


def judge(texts: list[bytes], table: _Words, model: QualityModel | None) -> dict[str, np.ndarray]:
    """Base counts of each text, its probability of good quality, and the two verdicts."""
    ids, ends = _numbered(texts, table)
    facts = table.arrays[ids]
    n = np.diff(ends)
    sums = _sums(facts, ends[:-1], ends[1:])
    out = {
        "n_words": n,
        "word_chars": sums[:, 0].astype(np.int64),
        "n_symbols": sums[:, 1].astype(np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": np.array(
            [repeated_words(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])], dtype=np.int64
        ),
    }
    out["base_failed"] = (n < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED_PCT * n)
    if model is None:
        out["quality"] = np.ones(len(texts))
    else:
        words = np.maximum(n, 1)
        pairs = np.zeros(len(texts))
        hashes = facts[:, 2].astype(np.uint32)
        if len(ids) > 1:
            # A pair lies inside one text.
            pairs = _sums(model.weights[pair_buckets(hashes)], ends[:-1], np.maximum(ends[1:] - 1, ends[:-1]))
        out["quality"] = model.probability(model.bias + (sums[:, 3] + pairs) / words)
    out["kept"] = ~out["base_failed"] & (out["quality"] >= KEEP_AT)
    return out


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts per word) of one text."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    hashes = np.array([xxhash.xxh32_intdigest(w) for w in words], dtype=np.uint32)
    found, _ = word_buckets([w.decode() for w in words], hashes)
    buckets, counts = np.unique(np.concatenate([found, pair_buckets(hashes)]), return_counts=True)
    return buckets.astype(np.int64), counts / len(words)


def fit_logistic(
    docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray,
    *, rounds: int = 120, rate: float = 0.5, decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weighted logistic loss over sparse rows, by Adam on all rows at once."""
    column = np.concatenate([d[0] for d in docs])
    value = np.concatenate([d[1] for d in docs])
    row = np.repeat(np.arange(len(docs)), [len(d[0]) for d in docs])
    model, bias = np.zeros(BUCKETS), 0.0
    mean, square = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    weights = weights / weights.sum()
    for step in range(1, rounds + 1):
        raw = bias + np.bincount(row, value * model[column], minlength=len(docs))
        error = weights * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels)
        grad = np.append(np.bincount(column, value * error[row], minlength=BUCKETS) + decay * model, error.sum())
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad**2 - square)
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        move *= 1 - step / (rounds + 1)
        model -= move[:-1]
        bias -= move[-1]
    return model, float(bias)


def calibrate(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Logistic calibration (a, b), by Newton's method with targets drawn in a little."""
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    theta = np.zeros(2)
    w = weights / weights.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (w * (p - target)) + 1e-3 * theta
        hess = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    *,
    per_class: int = PER_CLASS,
    workspace: Workspace | None = None,
) -> QualityModel | None:
    """Fit and calibrate on a bounded sample; None without labels of both classes."""
    workspace = workspace or Workspace(docs.sparkSession)
    sample, sizes = labelled_sample(
        docs, labels, label, doc_id=doc_id, text=text, per_class=per_class, workspace=workspace
    )

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        found = [features(t) for t in texts]
        return [
            batch.column(0),
            batch.column(2),
            pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
            pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())),
        ]

    kind = sample.schema["id"].dataType.simpleString()
    schema = f"id {kind}, label int, buckets array<int>, counts array<float>"
    table = map_texts(sample.select("id", "text", "label"), run, schema)
    table = table.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(4)))
    table = table.orderBy("id").toArrow()  # at most 2 * per_class rows
    y = table["label"].to_numpy().astype(float)
    if len(set(y)) < 2:
        return None
    rows = [
        (b.values.to_numpy().astype(np.int64), c.values.to_numpy().astype(float))
        for b, c in zip(table["buckets"], table["counts"])
    ]
    class_weight = {c: sizes.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1)}
    weights = np.array([class_weight[int(c)] for c in y])
    fit = table["part"].to_numpy() > 0
    if len(set(y[fit])) < 2 or len(set(y[~fit])) < 2:
        fit = np.ones(len(y), dtype=bool)
    some = np.flatnonzero(fit)
    model, bias = fit_logistic([rows[i] for i in some], y[some], weights[some])
    apart = np.flatnonzero(~fit) if not fit.all() else some
    raw = np.array([bias + model[rows[i][0]] @ rows[i][1] for i in apart])
    a, b = calibrate(raw, y[apart], weights[apart])
    return QualityModel(model, bias, a, b)


def judge_quality(
    docs: DataFrame, model: QualityModel | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, counts, base_failed, quality, kept) per row."""
    rows = pick(docs, id=doc_id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    held: list[_Words] = []

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        if not held:
            held.append(_Words(None if model is None else model.weights))
        out = judge(texts, held[0], model)
        return [
            batch.column(0),
            *[pa.array(out[c].astype(np.int64)) for c in counts],
            *[pa.array(out[c]) for c in ("base_failed", "quality", "kept")],
        ]

    schema = f"id {kind}, {', '.join(f'{c} bigint' for c in counts)}, base_failed boolean, quality double, kept boolean"
    return map_texts(rows, run, schema).withColumnRenamed("id", doc_id)
