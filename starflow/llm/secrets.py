"""Secrets: fixed base patterns, and a linear-chain conditional random field.

The field tags tokens as begin, inside or outside of a secret. A token's evidence is its own
shape (length, kinds of characters, how varied they are), the kinds of the tokens around it
(a key word, an equals sign, a quote, ...) and the file (how much of it looks like code). It is
trained on the base patterns' findings in a bounded sample of documents (SAMPLE with and SAMPLE
without findings), so it learns what secrets and their surroundings look like and finds those that the
patterns miss.

Decoding is exact Viterbi on every token of every text. A token whose evidence for "outside"
exceeds all that its neighbours' tags could say against it is outside on every best path;
such tokens, nearly all, cut the text into short runs, and only those are decoded.

Defined results: NULL and empty texts have no spans. Repeated rows get equal spans. In an
empty table nothing is found and nothing is trained: the field then adds no spans. Other
columns are ignored.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import map_texts, pick
from starflow.llm.spans import covered, outside
from starflow.sources.workspace import Workspace

# The base patterns and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the same as HEX runs of 24 and more
# Matches wherever one of the above has a finding, as one expression for Spark.
POSSIBLE = (
    r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6})"""
    r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
)
KEY_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "model")

SAMPLE = 300  # documents with findings, and as many without, that the field is trained on
REACH = 3  # tokens to either side that are evidence
LEAST_SPAN = 6  # a shorter span of the field is no secret
OUT, BEGIN, INSIDE = 0, 1, 2
_TOKEN = re.compile(r"[^\W_]+(?:[-_+/.][^\W_]+)*|\S")
_KEY_WORD = re.compile(r"pass(word|wd|phrase)?|pwd|secrets?|tokens?|(api|access|auth|private)?[-_.]?keys?|credentials?", re.I)
_CACHE_WORDS = 400_000

# What a token is to its neighbours.
_ROLES = ("word", "key", "equals", "colon", "quote", "at", "other mark", "number", "mixed", "edge")
_MARKS = {"=": 2, ":": 3, '"': 4, "'": 4, "`": 4, "@": 5}
_STOPS = frozenset(".,;:!?")
_LENGTHS = (1, 2, 4, 6, 9, 12, 16, 20, 24, 32, 41)
_SHAPES = len(_LENGTHS) + 10
_FILE = 3
_WIDTH = _SHAPES + 2 * REACH * len(_ROLES) + _FILE + 1


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, secret start, secret end) of the base patterns, in report order."""
    found = []
    lower = text.lower()
    if any(word in lower for word in KEY_WORDS):  # else there is nothing to search
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                found.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= ACCESS_LEAST:
                found.append((m.start(), 1, m.end(), m.start(), m.end()))
    for m in LONG_HEX.finditer(text):
        found.append((m.start(), 2, m.end(), m.start(), m.end()))
    return sorted(found)


def role_of(token: str) -> int:
    if token[0].isalnum():
        if _KEY_WORD.fullmatch(token):
            return 1
        if token.isalpha():
            return 0
        return 7 if token.replace(".", "").replace("-", "").isdigit() else 8
    return _MARKS.get(token, 6)


def shape_of(token: str) -> tuple[bool, ...]:
    """Evidence of the token itself. There are few distinct shapes."""
    n = len(token)
    lengths = tuple(n >= least for least in _LENGTHS)
    case = (token.islower(), token.isupper(), token.istitle())
    if token.isalpha():
        return (*lengths, False, *case, False, False, False, False, False, True)
    digits = sum(c.isdigit() for c in token)
    kinds = (digits > 0) + any(c.isupper() for c in token) + any(c.islower() for c in token)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    return (
        *lengths, digits == n, *case, kinds > 1 and digits > 0, kinds == 3, changes >= 4, changes >= 8,
        kinds > 1 and digits > 0 and len(set(token)) >= 10, token.isalnum() or not token[0].isalnum(),
    )


class Tokens(dict):
    """Distinct words to their tokens; per token start, length, role and shape.

    A word is what stands between white space; its tokens are cut once and kept. Shapes are
    numbered, and with ``weights`` each shape's three scores are kept beside it.
    """

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = weights
        self.shape_numbers: dict[tuple[bool, ...], int] = {}
        self.shapes = np.zeros((0, _SHAPES))
        self.scores = np.zeros((0, 3))
        self.new_words: list[tuple[int, int]] = []
        self.new_tokens: list[tuple[int, int, int, int]] = []
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.n_tokens = 0
        self.first = np.zeros(1, dtype=np.int64)  # per word, where its tokens start
        self.lengths = np.zeros(0, dtype=np.int64)  # per word
        self.tokens = np.zeros((0, 4), dtype=np.int32)  # start, length, role, shape

    def _add(self, token: str, start: int) -> None:
        shape = shape_of(token)
        number = self.shape_numbers.setdefault(shape, len(self.shape_numbers))
        self.new_tokens.append((start, len(token), role_of(token), number))
        self.n_tokens += 1

    def __missing__(self, word: str) -> int:
        if word.isalpha():
            self._add(word, 0)
        elif word[-1] in _STOPS and word[:-1].isalpha():
            self._add(word[:-1], 0)
            self._add(word[-1], len(word) - 1)
        else:
            for m in _TOKEN.finditer(word):
                self._add(m[0], m.start())
        self.new_words.append((self.n_tokens, len(word)))
        n = self[word] = len(self)
        return n

    def settle(self) -> None:
        """Take what was met since the last time into the arrays."""
        if self.new_words:
            words = np.array(self.new_words, dtype=np.int64)
            self.first = np.concatenate([self.first, words[:, 0]])
            self.lengths = np.concatenate([self.lengths, words[:, 1]])
            tokens = np.array(self.new_tokens, dtype=np.int32).reshape(-1, 4)
            self.tokens = np.concatenate([self.tokens, tokens])
            self.new_words, self.new_tokens = [], []
        if len(self.shape_numbers) > len(self.shapes):
            self.shapes = np.array(list(self.shape_numbers), dtype=float)
            if self.weights is not None:
                self.scores = self.shapes @ self.weights

    def trim(self) -> None:
        if len(self) > _CACHE_WORDS:
            self.reset()


def _expand(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a row of words, and the word each belongs to."""
    counts = first[numbers + 1] - first[numbers]
    word = np.repeat(np.arange(len(numbers)), counts)
    shift = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - shift[word] + first[numbers][word], word


def number_words(text: str, table: Tokens) -> np.ndarray:
    """The numbers of a text's words; ``table.settle`` must follow before they are used."""
    words = text.split()
    return np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words))


def read_tokens(
    text: str, table: Tokens, numbers: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token numbers, starts, ends) of a text, in code points."""
    if numbers is None:
        numbers = number_words(text, table)
        table.settle()
    n, lengths = len(numbers), table.lengths[numbers]
    if n and len(text) == lengths.sum() + n - 1:  # single white space
        at = np.cumsum(lengths + 1) - lengths - 1
    else:
        starts, place = [], 0
        for word in text.split():
            place = text.index(word, place)
            starts.append(place)
            place += len(word)
        at = np.array(starts, dtype=np.int64)
    tokens, word = _expand(numbers, table.first)
    begin = at[word] + table.tokens[tokens, 0]
    return tokens, begin, begin + table.tokens[tokens, 1]


def file_evidence(roles: np.ndarray) -> np.ndarray:
    """The file as a whole: marks, numbers and mixed tokens, each if above a twentieth."""
    counts = np.bincount(roles, minlength=len(_ROLES))
    share = np.array([counts[2:7].sum(), counts[7], counts[8]]) / max(1, len(roles))
    return (share > 0.05).astype(float)


@dataclass
class Field:
    """``emit`` is (evidence, tag); ``step`` is (tag before, tag)."""

    emit: np.ndarray
    step: np.ndarray

    def split(self):
        """Weights of the shape, of each neighbour's role, and of the file."""
        neighbours = self.emit[_SHAPES : _SHAPES + 2 * REACH * len(_ROLES)].reshape(2 * REACH, len(_ROLES), 3)
        return self.emit[:_SHAPES], neighbours, self.emit[-_FILE - 1 :]


_OFFSETS = [d for d in range(-REACH, REACH + 1) if d]


def emissions(roles: np.ndarray, shape_scores: np.ndarray, field: Field) -> np.ndarray:
    """(token, tag) scores of one text."""
    _, neighbours, whole = field.split()
    n, edge = len(roles), len(_ROLES) - 1
    padded = np.concatenate([np.full(REACH, edge), roles, np.full(REACH, edge)])
    out = shape_scores + np.append(file_evidence(roles), 1.0) @ whole
    for k, d in enumerate(_OFFSETS):
        out += neighbours[k][padded[REACH + d : REACH + d + n]]
    return out


def viterbi(emit: np.ndarray, step: np.ndarray) -> list[int]:
    """Best tags of a run of tokens between two that are outside."""
    score, back = step[OUT] + emit[0], []
    for row in emit[1:]:
        ways = score[:, None] + step
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + row
    tags = [int((score + step[:, OUT]).argmax())]
    for pointers in reversed(back):
        tags.append(int(pointers[tags[-1]]))
    return tags[::-1]


@functools.lru_cache(maxsize=8)
def _sure_margin(step: bytes) -> np.ndarray:
    return sure_margin(np.frombuffer(step).reshape(3, 3))


def sure_margin(step: np.ndarray) -> np.ndarray:
    """Per tag, the most its neighbours' tags can add to it over "outside"."""
    through = step[:, :, None] + step[None, :, :]  # before, tag, after
    return (through - through[:, [OUT], :]).max(axis=(0, 2))


def decode(emit: np.ndarray, field: Field) -> list[tuple[int, int]]:
    """(first, last) tokens of each secret, by exact Viterbi."""
    against = _sure_margin(field.step.tobytes())
    rival = np.maximum(emit[:, BEGIN] + against[BEGIN], emit[:, INSIDE] + against[INSIDE])
    unsure = np.flatnonzero(emit[:, OUT] <= rival)
    if not len(unsure):
        return []
    found = []
    for run in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1):
        if len(run) == 1:
            tags = [int((emit[run[0]] + field.step[OUT] + field.step[:, OUT]).argmax())]
        else:
            tags = viterbi(emit[run], field.step)
        start = None
        for at, tag in zip([*run, run[-1] + 1], [*tags, OUT]):
            if start is not None and tag != INSIDE:
                found.append((start, int(at) - 1))
                start = None
            if tag == BEGIN or (tag == INSIDE and start is None):
                start = int(at)
    return found


def model_spans(
    text: str, table: Tokens, field: Field, numbers: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """(start, end) of the field's secrets in a text; ``table`` has the field's weights."""
    tokens, begin, end = read_tokens(text, table, numbers)
    if not len(tokens):
        return []
    emit = emissions(table.tokens[tokens, 2], table.scores[table.tokens[tokens, 3]], field)
    spans = [(int(begin[a]), int(end[b])) for a, b in decode(emit, field)]
    return [(a, b) for a, b in spans if b - a >= LEAST_SPAN]


def evidence(tokens: np.ndarray, table: Tokens, low: int = 0, high: int | None = None) -> np.ndarray:
    """The evidence matrix of the tokens low..high of a text, for training."""
    mine = table.tokens[tokens, 2]
    high = len(mine) if high is None else min(high, len(mine))
    n, edge = high - low, len(_ROLES) - 1
    padded = np.concatenate([np.full(REACH, edge), mine, np.full(REACH, edge)])
    out = np.zeros((n, _WIDTH), dtype=np.uint8)
    out[:, :_SHAPES] = table.shapes[table.tokens[tokens[low:high], 3]]
    for k, d in enumerate(_OFFSETS):
        out[np.arange(n), _SHAPES + k * len(_ROLES) + padded[REACH + d + low : REACH + d + high]] = 1
    out[:, -_FILE - 1 : -1] = file_evidence(mine)
    out[:, -1] = 1
    return out


def training_windows(text: str, table: Tokens, reach: int = 24, most: int = 4):
    """(evidence, tags) of windows around the base findings, or spread over a text without."""
    tokens, begin, end = read_tokens(text, table)
    n = len(tokens)
    if not n:
        return []
    tags = np.zeros(n, dtype=np.uint8)
    found = base_spans(text)
    centres = []
    for _, _, _, a, b in found:
        inside = np.flatnonzero((begin < b) & (end > a))
        if len(inside):
            tags[inside] = INSIDE
            tags[inside[0]] = BEGIN
            centres.append(int(inside[0]))
    roles = table.tokens[tokens, 2]
    if not centres:  # anything but plain words is the more instructive part
        odd = np.flatnonzero(roles != 0)
        centres = list(odd[:: max(1, len(odd) // most)]) + [n // 2]
    if len(centres) > most:
        centres = centres[:: -(-len(centres) // most)]
    bounds = [(max(0, c - reach), c + reach) for c in centres[:most]]
    return [(evidence(tokens, table, low, high), tags[low:high]) for low, high in bounds]


def fit_field(windows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 80, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """Conditional log-likelihood by Adam; forward and backward sums over all windows at once."""
    longest = max(len(t) for _, t in windows)
    x = np.zeros((len(windows), longest, _WIDTH), dtype=np.float32)
    y = np.zeros((len(windows), longest), dtype=np.int64)
    live = np.zeros((len(windows), longest), dtype=bool)
    for i, (e, t) in enumerate(windows):
        x[i, : len(t)], y[i, : len(t)], live[i, : len(t)] = e, t, True
    flat = x.reshape(-1, _WIDTH)
    gold = np.eye(3)[y] * live[:, :, None]
    pairs_live = live[:, 1:] & live[:, :-1]
    gold_pairs = np.einsum("nta,ntb->ab", gold[:, :-1] * pairs_live[:, :, None], gold[:, 1:])
    emit, step = np.zeros((_WIDTH, 3)), np.zeros((3, 3))
    size = emit.size + step.size
    mean, square = np.zeros(size), np.zeros(size)
    total = live.sum()
    for turn in range(1, rounds + 1):
        scores = (flat @ emit.astype(np.float32)).reshape(len(windows), longest, 3).astype(float)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            new = _log_sum(forward[:, t - 1, :, None] + step, axis=1) + scores[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _log_sum(step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], new, 0.0)
        norm = _log_sum(forward[:, -1], axis=1)
        node = np.exp(forward + backward - norm[:, None, None]) * live[:, :, None]
        edge = np.exp(
            forward[:, :-1, :, None] + step + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        ) * pairs_live[:, :, None, None]
        grad_emit = flat.T @ (node - gold).reshape(-1, 3).astype(np.float32) / total + decay * emit
        grad_step = (edge.sum(axis=(0, 1)) - gold_pairs) / total + decay * step
        grad = np.concatenate([grad_emit.ravel(), grad_step.ravel()])
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad**2 - square)
        move = rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        emit -= move[: emit.size].reshape(emit.shape)
        step -= move[emit.size :].reshape(step.shape)
    return Field(emit, step)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def train_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    sample: int = SAMPLE,
    workspace: Workspace | None = None,
) -> Field | None:
    """Fit on the distinct documents with the smallest hashes, with and without findings.

    A built-in expression, which no text with a finding fails, leaves few texts to the base
    patterns; these tell for every document whether it has one. None only if no document has.
    A copy counts once. Only the sample's hashes are gathered.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text).where("text IS NOT NULL")
    keyed = rows.select(F.xxhash64("id", "text").alias("key"), "text")
    possible = keyed.select("key", F.when(F.col("text").rlike(POSSIBLE), F.col("text")).alias("text"))

    def mark(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        return [batch.column(0), pa.array([bool(base_spans(content.decode())) for content in texts], pa.bool_())]

    marked = map_texts(possible, mark, "key bigint, found boolean")
    marked = workspace.store(marked.groupBy("key").agg(F.bool_or("found").alias("found")), "marked")
    sizes = {r[0]: r[1] for r in marked.groupBy("found").count().collect()}
    chosen = None
    for value in (True, False):
        # Keys are hashes: most are too large to be among the smallest, and go before the sort.
        share = min(1.0, 4 * sample / max(1, sizes.get(value, 0)))
        largest = min(2**63 - 1, -(2**63) + int(share * 2**64))
        some = marked.where((F.col("found") == value) & (F.col("key") <= F.lit(largest)))
        some = some.select("key").orderBy("key").limit(sample)
        chosen = some if chosen is None else chosen.union(some)
    chosen = workspace.store(chosen, "chosen")
    picked = keyed.join(F.broadcast(chosen), "key")

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        table, keys, places, matrices, tags = Tokens(), [], [], [], []
        for key, content in zip(batch.column(0).to_pylist(), texts):
            for place, (e, t) in enumerate(training_windows(content.decode(), table)):
                keys.append(key)
                places.append(place)
                matrices.append(e.tobytes())
                tags.append(t.tobytes())
        columns = [(keys, pa.int64()), (places, pa.int32()), (matrices, pa.binary()), (tags, pa.binary())]
        return [pa.array(values, kind) for values, kind in columns]

    found = map_texts(picked.select("key", "text"), run, "key bigint, place int, evidence binary, tags binary")
    # A few small windows per sampled document, however many copies it has.
    windows = found.dropDuplicates(["key", "place"]).orderBy("key", "tags", "evidence").toArrow()
    pairs = [
        (np.frombuffer(e, np.uint8).reshape(-1, _WIDTH), np.frombuffer(t, np.uint8))
        for e, t in zip(windows["evidence"].to_pylist(), windows["tags"].to_pylist())
    ]
    if not any((t == BEGIN).any() for _, t in pairs):
        return None
    return fit_field(pairs)


def find_secrets(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) per row; ``spans`` are (kind, start, end), by start and then kind.

    Of a span of the field, the parts outside the base spans are reported if they are long enough.
    """
    rows = pick(docs, id=doc_id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    held: list[Tokens] = []
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        if field is not None and not held:
            held.append(Tokens(field.emit[:_SHAPES]))
        out, contents = [], [content.decode() for content in texts]
        numbers = [None] * len(contents)
        if held:  # all texts first, so that the arrays grow once per batch
            held[0].trim()
            numbers = [number_words(content, held[0]) for content in contents]
            held[0].settle()
        for content, mine in zip(contents, numbers):
            base = [(a, kind_, b) for a, kind_, b, _, _ in base_spans(content)]
            more = []
            if field is not None:
                parts = outside(model_spans(content, held[0], field, mine), covered([(a, b) for a, _, b in base]))
                more = [(a, 3, b) for a, b in parts if b - a >= LEAST_SPAN]
            out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(base + more)])
        return [batch.column(0), pa.array(out, span)]

    schema = f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return map_texts(rows, run, schema).withColumnRenamed("id", doc_id)
