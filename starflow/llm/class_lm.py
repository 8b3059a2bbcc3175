"""Scoring texts with a Brown class-based bigram model.

Each word belongs to a class, and p(word | word before) = p(class | class before) * p(word | class).
Classes come from exchange clustering: words move, one half at a time, to the class that raises
the likelihood of the training bigrams most, until a pass over both halves gains less than LEAST_GAIN per
token. The HEAD most frequent words do so first, among themselves; then all take part, and the rare ones
find classes that already mean something.

The units that are exchanged are all words with LEAST_PLACED tokens or more, each for itself, and
the rare rest, which has too few bigrams to be placed, tied by its ending (ENDINGS hashed groups),
so every word has a class. EXCHANGED bounds what the driver and the tasks hold; if more words are
frequent enough, the rarest of them are tied too, and ``tied_words`` says how many. All counts cover the
whole training text: word counts are an ordinary aggregation, and unit bigrams are counted in
each task as they occur, dealt by a hash of the pair as arrays and summed there. They are then dealt by unit and packed
into arrays, five bytes a neighbour, so that a round of the exchange reads bytes, not rows. The two halves of the units are
stored apart, and a round that moves one half reads that half only; the pairs of the head units lie in a few files. The logs
that gains are made of are looked up where counts are small.

Emission uses the exact count of each word: the KNOWN most frequent words of all texts, held-out
ones too, are broadcast. The others are joined by shuffle, where none of them can hold more than 1/KNOWN of
all tokens.

Defined results: NULL and empty texts are the end token alone. NULL ids count as empty text for
the fold. Repeated rows get equal scores. Without training text every score is that of
the smoothing alone. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.labelled import fold
from starflow.llm.rows import pick, slices, utf8
from starflow.sources.workspace import Workspace

HELD_OUT_FOLD = 1
EXCHANGED = 200_000
LEAST_PLACED = 20  # tokens of a word that is placed for itself
ENDINGS = 512
CLASSES = 64
HEAD = 2_000  # most frequent units, which find their classes first
KNOWN = 200_000
LEAST_GAIN = 2e-3  # of log likelihood per training token in a pass; less ends the exchange
BASE_ADD = 0.5  # fixed value: smoothing of the base score
ADD = 0.1  # of emissions
BACK_OFF = 20.0  # weight of the class shares in a transition
_END = b""  # the end token; no word is empty
_COUNT_BYTES = 32 * 1024 * 1024  # text whose words are counted at once
_FLUSH_PAIRS = 2_000_000
_PACKED = 500_000  # pairs packed together, and then the rest of a unit
_ROWS = 16_000  # rows of class counts whose gains are computed at once
_HEAD_PARTS = 64  # shuffle partitions whose pairs of the head units are stored together
_MOST_LOGS = 1 << 18  # logs of a table with small counts added that a task keeps
_LARGEST_LOG = 1_000
_SLOT_CACHE = 400_000
_RARE_SLOTS = 200_000


def words_of(text: bytes) -> list[bytes]:
    """Words, A-Z in lower case; both steps touch ASCII only."""
    return text.lower().split()


def ending_of(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word[-3:]) % ENDINGS


def _counted_words(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(word, c, t) of some batches of (text, trains). No word becomes an object of Python."""
    text = pa.concat_arrays([batch.column(0) for batch in batches])
    if (binary := pa.types.is_binary(text.type)) or pa.types.is_large_binary(text.type):
        text = text.view(pa.string() if binary else pa.large_string())
    trains = np.concatenate([batch.column(1).to_numpy(zero_copy_only=False) for batch in batches])
    # The same words as ``words_of``, and empty ones for white space before the first or behind the last.
    words = pc.ascii_split_whitespace(pc.ascii_lower(text))
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    found = words.flatten().dictionary_encode()
    index, word = found.indices.to_numpy(), found.dictionary.cast(pa.binary())
    t = np.bincount(index, minlength=len(word))
    c = np.bincount(index[np.repeat(trains, sizes)], minlength=len(word))
    full = pc.greater(pc.binary_length(word), 0)
    kept = full.to_numpy(zero_copy_only=False)
    word = pa.concat_arrays([word.filter(full), pa.array([_END], pa.binary())])
    counts = [pa.array(np.append(n[kept], ends).astype(np.int64)) for n, ends in ((c, trains.sum()), (t, len(text)))]
    return pa.RecordBatch.from_arrays([word, *counts], ["word", "c", "t"])


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c, t) over the tokens of ``rows`` (text, trains), the end token as the empty word.

    c counts the texts that train the model, t all. Without the second column all texts train.
    """
    if "trains" not in rows.columns:
        rows = rows.withColumn("trains", F.lit(True))

    def count(batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            held.append(batch)
            size += batch.column(0).nbytes
            if size > _COUNT_BYTES:
                yield _counted_words(held)
                held, size = [], 0
        if held:
            yield _counted_words(held)

    found = rows.select("text", "trains").mapInArrow(count, "word binary, c bigint, t bigint")
    return found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def frequent_words(counts: DataFrame, most: int, by: str = "c") -> DataFrame:
    """Words from some count (column ``by``) on, ``most`` of them at the most.

    The bound comes from a histogram of the counts' magnitudes (some hundred rows), so no task
    has to send its own candidates to one place.
    """
    size = F.floor(F.log2(by) * 16).cast("int")
    found = counts.where(F.col(by) > 0)
    steps = found.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"), F.min(by).alias("c"))
    bound, held = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["size"]):
        held += row["n"]
        if held > most:
            break
        bound = row["c"]
    return counts.where(F.lit(False)) if bound is None else counts.where(F.col(by) >= bound)


class Units(dict):
    """Word to unit: 0 is the end token, then the exchanged words, then the endings."""

    def __init__(self, exchanged: list[bytes]):
        self.fixed = {_END: 0} | {w: i + 1 for i, w in enumerate(exchanged)}
        self.base = len(exchanged) + 1
        self.n = self.base + ENDINGS
        self.update(self.fixed)

    def unit(self, word: bytes) -> int:
        fixed = self.fixed.get(word)
        return self.base + ending_of(word) if fixed is None else fixed

    def __missing__(self, word: bytes) -> int:
        unit = self[word] = self.base + ending_of(word)
        return unit

    def trim(self) -> None:
        if len(self) > _SLOT_CACHE:
            self.clear()
            self.update(self.fixed)

    def of(self, texts: list[bytes]) -> np.ndarray:
        """Units of all tokens, each text with an end token behind it and one before the first."""
        tokens = [_END]
        for text in texts:
            tokens += words_of(text)
            tokens.append(_END)
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))


_COUNTED = "bucket int, a binary, b binary, n binary"
_DEALT = "bucket int, side binary, u binary, v binary, n binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _dealt(bucket: np.ndarray, columns: list[np.ndarray], names: str) -> pa.RecordBatch:
    """One row per bucket with its part of each column as bytes, in the order given."""
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket)
    held = np.flatnonzero(sizes)
    ends = np.append(0, np.cumsum(sizes[held]))
    arrays = [pa.array(held.astype(np.int32))]
    for column in columns:
        offsets = (ends * column.itemsize).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(column[order])]
        arrays.append(pa.Array.from_buffers(pa.binary(), len(held), buffers))
    return pa.RecordBatch.from_arrays(arrays, re.findall(r"(\w+) (?:int|binary)", names))


def _joined(batches, kinds: list) -> list[np.ndarray]:
    """The byte columns behind the bucket, each as one array over all rows."""
    parts = [[np.zeros(0, dtype=kind)] for kind in kinds]
    for batch in batches:
        for i in range(batch.num_rows):
            for k, kind in enumerate(kinds):
                parts[k].append(np.frombuffer(batch.column(k + 1)[i].as_buffer(), kind))
    return [np.concatenate(part) for part in parts]


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, each with the sum of its ``n``."""
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else order
    return codes[first], np.add.reduceat(n[order], first) if len(codes) else n


def counted_pairs(training: DataFrame, exchanged: list[bytes]) -> DataFrame:
    """How often unit b follows unit a, counted in each task and dealt by a hash of the pair.

    A row holds the pairs of one bucket as bytes (``a``, ``b``, ``n``); those of a bucket are not summed yet,
    and lie in one partition. A text starts behind an end token.
    """
    buckets = _buckets(training)

    def count(batches) -> Iterator[pa.RecordBatch]:
        units = Units(exchanged)
        codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        fresh, held = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            some, times = np.unique(np.concatenate([codes[:0], *fresh]), return_counts=True)
            if not len(codes):
                return some, times.astype(np.int64)
            return _summed(np.concatenate([codes, some]), np.concatenate([counts, times]))

        def emit() -> Iterator[pa.RecordBatch]:
            if len(codes):
                bucket = _bucket(codes.astype(np.uint64) * _MIX >> np.uint64(32), buckets)
                yield _dealt(bucket, [(codes >> 32).astype(np.int32), codes.astype(np.int32), counts], _COUNTED)

        for batch in slices(batches):
            units.trim()
            at = units.of(utf8(batch.column(0)))
            fresh.append(at[:-1] << 32 | at[1:])
            held += len(fresh[-1])
            if held > _FLUSH_PAIRS:
                codes, counts = merged()
                fresh, held = [], 0
                if len(codes) > _FLUSH_PAIRS:
                    yield from emit()
                    codes, counts = codes[:0], counts[:0]
        codes, counts = merged()
        yield from emit()

    return training.mapInArrow(count, _COUNTED).repartitionById(buckets, F.col("bucket"))


def _buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucket(mixed: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of mixed numbers; two bytes where they suffice, which sort faster."""
    return (mixed % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)


def _sum_of_bucket(batches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, b, n of a partition of ``counted_pairs``, each pair once."""
    a, b, n = _joined(batches, [np.int32, np.int32, np.int64])
    codes, n = _summed(a.astype(np.int64) << 32 | b, n)
    return (codes >> 32).astype(np.int32), codes.astype(np.int32), n


def unit_pairs(training: DataFrame, exchanged: list[bytes]) -> DataFrame:
    """(a, b, n): how often unit b follows unit a. A text starts behind an end token."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _sum_of_bucket(batches)], ["a", "b", "n"])

    return counted_pairs(training, exchanged).mapInArrow(rows, "a int, b int, n bigint")


def _log(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return x * np.log(np.where(x > 0, x, 1))


class Logs:
    """``_log(base + n)`` for counts n: the small ones, which most are, are computed once and looked up.

    ``base`` is any table of whole numbers; a lookup gives the same numbers as the formula does.
    """

    def __init__(self, base: np.ndarray):
        self.base = base
        kept = min(_MOST_LOGS // max(1, base.size), _LARGEST_LOG)
        self.small = _log(base[None] + np.arange(kept + 1.0).reshape(-1, *[1] * base.ndim))
        self.none = self.small[0]
        self.gains = self.small - self.none

    def plus(self, n: np.ndarray, *at: np.ndarray) -> np.ndarray:
        """``_log(base[at] + n)`` for each n with its own ``at``; without one, n is added to all of ``base``."""
        return self._found(self.small, n, at)

    def gain(self, n: np.ndarray, *at: np.ndarray) -> np.ndarray:
        """``plus`` less ``_log(base[at])``."""
        return self._found(self.gains, n, at)

    def _found(self, table: np.ndarray, n: np.ndarray, at: tuple) -> np.ndarray:
        small = n < len(table)
        out = table[np.where(small, n, 0).astype(np.intp), *at]
        large = np.flatnonzero(~small)
        if len(large):
            some = tuple(x[large] for x in at)
            logs = _log(self.base[some] + n[large].reshape(-1, *[1] * (self.base.ndim - len(at))))
            out[large] = logs if table is self.small else logs - self.none[some]
        return out


class JointLogs:
    """The class bigrams of a round, and the logs that the gains of all its moves are made of."""

    def __init__(self, joint: np.ndarray):
        self.joint = joint
        self.sides = [Logs(joint), Logs(joint.T.copy())]
        self.diagonal = Logs(np.diag(joint).copy())
        self.margins = [Logs(joint.sum(axis=1)), Logs(joint.sum(axis=0))]


def _part_gains(counts: np.ndarray, other: np.ndarray, loops: np.ndarray, own: np.ndarray, logs: Logs) -> np.ndarray:
    """(unit, class): what the bigrams of each unit with the classes before it gain by its going to a class.

    ``counts[u, c]`` counts class c before u, ``other`` behind it; ``logs`` are of the joint table without regard
    to any unit, so each unit's own part is taken out of it where it stands. Only classes with a count matter.
    For the classes behind, give the transposed joint table and swap the counts.
    """
    unit, before = np.nonzero(counts)
    out = np.zeros(counts.shape)
    if not len(unit):
        return out
    n, at = counts[unit, before], np.arange(len(unit))
    mine = own[unit]
    gain = logs.gain(n, before)
    # In its own class a unit is counted already.
    whole = logs.base[before, mine]
    gain[at, mine] = logs.none[before, mine] - _log(whole - n)
    self_ = np.flatnonzero(before == mine)
    rest = logs.base[before[self_]] - other[unit[self_]]
    rest[np.arange(len(self_)), mine[self_]] -= n[self_] + loops[unit[self_]]
    gain[self_] = _log(rest + n[self_, None]) - _log(rest)
    # Row by row of all units that have as many; reduceat takes several times as long.
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    sizes = np.diff(first, append=len(unit))
    order = np.argsort(-sizes, kind="stable")
    starts = first[order]
    total = np.zeros((len(first), counts.shape[1]))
    for i, held in enumerate(len(sizes) - np.cumsum(np.bincount(sizes))[:-1]):
        total[:held] += gain[starts[:held] + i]
    out[unit[starts]] = total
    return out


def best_moves(left: np.ndarray, right: np.ndarray, loops: np.ndarray, own: np.ndarray, joint: np.ndarray | JointLogs, first: int = 0):
    """Per unit the best class and the gain in log-likelihood of moving there.

    ``left[u, c]`` counts class c before u, ``right[u, c]`` behind it, ``loops`` u behind
    itself; both leave the loops out. ``joint`` are the class bigrams, or their logs, ``own`` the classes.
    Classes below ``first`` take no unit. Likelihood up to terms that no move changes: bigrams less both margins.
    """
    best, gain = own.copy(), np.zeros(len(own))
    before, behind = left.sum(axis=1), right.sum(axis=1)
    used = np.flatnonzero(before + behind + loops)
    if not len(used):
        return best, gain
    logs = joint if isinstance(joint, JointLogs) else JointLogs(joint)
    left, right, loops, own = left[used], right[used], loops[used].astype(float), own[used]
    before, behind = before[used], behind[used]
    gains = _part_gains(left, right, loops, own, logs.sides[0])
    gains += _part_gains(right, left, loops, own, logs.sides[1])
    at = np.arange(len(own))
    # Where the unit meets itself in a class, both parts above have counted the same cell.
    both = left + right + loops[:, None]
    unit, c = np.nonzero(both)
    x, y, z = both[unit, c], left[unit, c], right[unit, c]
    gains[unit, c] += _diagonal(logs.diagonal, own[unit] == c, c, x, y, z)
    # Wherever the unit goes, its neighbours' own margins get its counts back.
    for margin, whole in zip(logs.margins, (behind + loops, before + loops)):
        found, place = np.unique(whole, return_inverse=True)
        part = margin.gain(found)[place]
        part[at, own] = margin.none[own] - _log(margin.base[own] - whole)
        gains -= part
    to = first + gains[:, first:].argmax(axis=1)
    best[used], gain[used] = to, gains[at, to] - gains[at, own]
    return best, gain


def _diagonal(logs: Logs, mine: np.ndarray, c: np.ndarray, both: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What the cell of class c with itself gains beyond its two parts; ``mine`` marks the unit's own class."""
    out = logs.plus(both, c) - logs.plus(left, c) - logs.plus(right, c) + logs.none[c]
    own = np.flatnonzero(mine)
    rest = logs.base[c[own]] - both[own]
    out[own] = _log(rest + both[own]) - _log(rest + left[own]) - _log(rest + right[own]) + _log(rest)
    return out


_PACK = "units binary, loops binary, at0 binary, v0 binary, n0 binary, at1 binary, v1 binary, n1 binary"
_KINDS = [np.int32, np.float64, np.int32, np.int32, np.uint8, np.int32, np.int32, np.uint8]
_MOST_COUNT = 255
HALF = "half"


def half_of(units: np.ndarray) -> np.ndarray:
    """The half that a unit is in, 0 or 1; the halves move in turn."""
    return (units.astype(np.int64) * 2654435761 >> 7) % 2


def _packed_row(units: np.ndarray, loops: np.ndarray, sides: list) -> pa.RecordBatch:
    """One row of ``_PACK``; a side is (place among the units, the other unit, count), in order of places.

    Places become the ends of each unit's entries. A count too large for its byte takes several entries, of
    which there cannot be more than a 255th of the tokens.
    """
    row = [units.astype(np.int32), loops.astype(np.float64)]
    for at, v, n in sides:
        more = -(-n // _MOST_COUNT)
        if len(n) and more.max() > 1:
            at, v, whole = np.repeat(at, more), np.repeat(v, more), np.repeat(n, more)
            step = np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
            n = np.minimum(whole - step * _MOST_COUNT, _MOST_COUNT)
        row += [np.searchsorted(at, np.arange(len(units)), side="right").astype(np.int32), v.astype(np.int32), n.astype(np.uint8)]
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], _PACK.replace(" binary", "").split(", "))


def _places(ends: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


def _unpacked(batches, kinds: list) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield [np.frombuffer(batch.column(k)[i].as_buffer(), kind) for k, kind in enumerate(kinds)]


def pack_pairs(pairs: DataFrame) -> DataFrame:
    """Arrays of the pairs of ``unit_pairs`` or ``counted_pairs``, dealt by unit, whole units together.

    A row holds ``units`` of one half and their ``loops``; side 0 has what stands before them and side 1 what
    stands behind: where each unit's entries end, the other unit, count.
    """
    counted, buckets = "bucket" in pairs.columns, _buckets(pairs)

    def sides(batches) -> Iterator[pa.RecordBatch]:
        held = [_sum_of_bucket(batches)] if counted else ([batch.column(k).to_numpy() for k in range(3)] for batch in batches)
        for a, b, n in (tuple(x[i : i + _FLUSH_PAIRS] for x in part) for part in held for i in range(0, len(part[0]), _FLUSH_PAIRS)):
            loop = a == b
            other = ~loop
            u = np.concatenate([a[loop], b[other], a[other]])
            v = np.concatenate([a[loop], a[other], b[other]])
            which = np.repeat(np.array([2, 0, 1], dtype=np.uint8), [loop.sum(), other.sum(), other.sum()])
            times = np.concatenate([n[loop], n[other], n[other]])
            bucket = _bucket(u.astype(np.uint64) * _MIX >> np.uint64(32), buckets)
            yield _dealt(bucket, [which, u, v, times], _DEALT)

    dealt = pairs.mapInArrow(sides, _DEALT).repartitionById(buckets, F.col("bucket"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        side, u, v, n = _joined(batches, [np.uint8, np.int32, np.int32, np.int64])
        if not len(u):
            return
        half = half_of(u).astype(np.int8)
        order = np.lexsort((u, half))
        starts = np.flatnonzero(np.append(True, np.diff(u[order]) != 0))
        # Cut before the unit that a place lies in, and between the halves.
        border = np.count_nonzero(half == 0)
        cuts = starts[np.searchsorted(starts, np.arange(0, len(u), _PACKED), side="right") - 1]
        cuts = np.unique(np.append(cuts, border))
        for low, high in zip(cuts, [*cuts[1:], len(u)]):
            if low == high:
                continue
            some = order[low:high]
            units, at = np.unique(u[some], return_inverse=True)
            here = [side[some] == which for which in range(3)]
            loops = np.bincount(at[here[2]], n[some][here[2]], minlength=len(units))
            row = _packed_row(units, loops, [(at[h], v[some][h], n[some][h]) for h in here[:2]])
            yield _with_half(row, int(half[some[0]]))

    return dealt.mapInArrow(run, f"{_PACK}, {HALF} int")


def _with_half(row: pa.RecordBatch, half: int) -> pa.RecordBatch:
    return row.append_column(HALF, pa.array([half], pa.int32()))


def store_by_half(packed: DataFrame, name: str, workspace: Workspace) -> DataFrame:
    """Stored with a folder per half, so that a filter on it opens the files of one half."""
    path = workspace.folder(name)
    packed.write.partitionBy(HALF).parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)


def head_pairs(packed: DataFrame, most: int) -> DataFrame:
    """The packed pairs of the units 0..most among themselves."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for units, loops, *sides in _unpacked(batches, _KINDS):
            kept = np.flatnonzero(units <= most)
            if not len(kept):
                continue
            place = np.full(len(units), -1)
            place[kept] = np.arange(len(kept))
            out = []
            for ends, v, n in (sides[:3], sides[3:]):
                at = place[_places(ends)]
                some = (at >= 0) & (v <= most)
                out.append((at[some], v[some], n[some].astype(np.int64)))
            yield _with_half(_packed_row(units[kept], loops[kept], out), int(half_of(units[:1])[0]))

    return packed.mapInArrow(run, f"{_PACK}, {HALF} int")


def exchange(
    pairs: DataFrame, totals: np.ndarray, workspace: Workspace, classes: int = CLASSES, rounds: int | None = None, head: int = HEAD
) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit, and the counts of class bigrams. Class 0 is the end token's alone.

    ``pairs`` are those of ``unit_pairs`` or ``counted_pairs``, whose units come by frequency.
    """
    n = len(totals)
    order = np.argsort(-totals, kind="stable")
    order = order[order != 0]
    own = np.zeros(n, dtype=np.uint8 if classes <= 256 else np.int32)
    own[order] = 1 + np.arange(n - 1) % (classes - 1)
    packed = store_by_half(pack_pairs(pairs), "packed", workspace)
    if n > 2 * head:
        # A bounded table: a few files, not one per shuffle partition, since every round opens them all.
        few = 1 + _buckets(packed) // _HEAD_PARTS
        first = store_by_half(head_pairs(packed, head).repartition(few), "head", workspace)
        own, _ = exchange_packed(first, own, classes, rounds)
    return exchange_packed(packed, own, classes, rounds)


def exchange_packed(
    packed: DataFrame, own: np.ndarray, classes: int, rounds: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """Classes after the exchange from ``own`` on, and the counts of class bigrams.

    Rounds go on until both halves in turn gain less than LEAST_GAIN per token, or to ``rounds``, if given.

    Every round is a job over the packed pairs: each task sums the neighbours of its
    units by class and finds their best moves. Half of the units may move per round, since
    moves that are good one by one can be bad together; if they are, fewer of the best are
    made, in the end one alone. Per unit that moves one small row and per trial one class table reach the
    driver; both sizes are parameters.
    """

    def joint_of(of: np.ndarray) -> np.ndarray:
        def run(batches) -> Iterator[pa.RecordBatch]:
            table = np.zeros(classes * classes)
            for units, loops, ends, v, count in _unpacked(batches, _KINDS[:5]):
                mine = of[units].astype(np.int64)
                code = of[v] * np.int64(classes) + np.repeat(mine, np.diff(ends, prepend=0))
                table += np.bincount(code, count, minlength=classes * classes)
                table += np.bincount(mine * (classes + 1), loops, minlength=classes * classes)
            yield pa.RecordBatch.from_arrays([pa.array([table.astype(np.int64).tobytes()], pa.binary())], ["joint"])

        def total(batches) -> Iterator[pa.RecordBatch]:
            table = np.zeros(classes * classes, dtype=np.int64)
            for (some,) in _unpacked(batches, [np.int64]):
                table += some
            yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["joint"])

        before = packed.select("units", "loops", "at0", "v0", "n0")
        # One table of classes x classes per task, summed in one place.
        summed = before.mapInArrow(run, "joint binary").repartition(1).mapInArrow(total, "joint binary")
        out = np.zeros(classes * classes)
        for row in summed.collect():
            out += np.frombuffer(row["joint"], np.int64)
        return out.reshape(classes, classes)

    def likelihood(joint: np.ndarray) -> float:
        return float(_log(joint).sum() - _log(joint.sum(axis=1)).sum() - _log(joint.sum(axis=0)).sum())

    joint = joint_of(own)
    best_value = likelihood(joint)
    enough = LEAST_GAIN * joint.sum()
    gained, turn = [np.inf, np.inf], 0
    while sum(gained) > enough and (rounds is None or turn < rounds):
        def moves(batches, of=own, joint=joint) -> Iterator[pa.RecordBatch]:
            logs = JointLogs(joint)
            for units, loops, *sides in _unpacked(batches, _KINDS):
                mine = np.flatnonzero(units)
                tables = []
                for ends, v, count in (sides[:3], sides[3:]):
                    place = _places(ends) * classes + of[v]
                    tables.append(np.bincount(place, count, minlength=len(units) * classes).reshape(-1, classes)[mine])
                step = max(1, _ROWS // classes)
                for low in range(0, len(mine), step):
                    some = mine[low : low + step]
                    left, right = (t[low : low + step] for t in tables)
                    old = of[units[some]].astype(np.int64)
                    best, gain = best_moves(left, right, loops[some], old, logs, first=1)
                    keep = gain > 1e-6
                    arrays = [pa.array(units[some][keep]), pa.array(best[keep].astype(np.int32)), pa.array(gain[keep])]
                    yield pa.RecordBatch.from_arrays(arrays, ["u", "class", "gain"])

        movers = packed.where(F.col(HALF) == turn % 2)
        found = movers.mapInArrow(moves, "u int, class int, gain double").toArrow()
        unit, to = found["u"].to_numpy(), found["class"].to_numpy()
        order = np.lexsort((unit, -found["gain"].to_numpy()))
        tried, gain = len(order), 0.0
        while tried:  # too many moves at once: take the best ones only
            trial = own.copy()
            trial[unit[order[:tried]]] = to[order[:tried]]
            trial_joint = joint_of(trial)
            value = likelihood(trial_joint)
            if value > best_value:
                gain = value - best_value
                own, joint, best_value = trial, trial_joint, value
                break
            tried //= 3
        gained[turn % 2] = gain
        turn += 1
    return own, joint


@dataclass
class ClassModel:
    """What the tasks need: classes of units, log transitions, and per class the emission base."""

    exchanged: list[bytes]
    unit_class: np.ndarray
    transition: np.ndarray  # log10 p(class | class before)
    emission: np.ndarray  # log10 of count + ADD * (words + 1), per class
    train_tokens: int
    train_words: int
    tied_words: int = 0  # words with LEAST_PLACED tokens that are tied because of EXCHANGED

    @property
    def base_log(self) -> float:
        return float(np.log10(self.train_tokens + BASE_ADD * (self.train_words + 1)))


def train_class_model(training: DataFrame, counts: DataFrame, workspace: Workspace, *, exchanged: int = EXCHANGED, least: int = LEAST_PLACED, classes: int = CLASSES, rounds: int | None = None) -> ClassModel:
    """Fit on all of ``training`` (text); ``counts`` are its stored word counts."""
    trained = counts.where(F.col("c") > 0)
    row = trained.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if((F.col("c") >= least) & (F.length("word") > 0))
    ).first()
    # Few enough to sort in one place.
    frequent = frequent_words(counts, max(KNOWN, exchanged)).where(F.length("word") > 0)
    frequent = frequent.where(F.col("c") >= least).repartition(1).sortWithinPartitions(F.col("c").desc(), "word").limit(exchanged)
    names = [bytes(r[0]) for r in frequent.select("word").collect()]

    def with_unit(batches) -> Iterator[pa.RecordBatch]:
        units = Units(names)
        for batch in batches:
            units.trim()
            found = [units[w] for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), batch.column(1)], ["u", "c"])

    n_units = Units(names).n
    totals, words = np.zeros(n_units), np.zeros(n_units)
    per_unit = trained.select("word", "c").mapInArrow(with_unit, "u int, c bigint").groupBy("u").agg(F.sum("c"), F.count(F.lit(1)))
    per_unit = per_unit.toDF("u", "c", "v").toArrow()  # one row per unit
    at = per_unit["u"].to_numpy()
    totals[at], words[at] = per_unit["c"].to_numpy(), per_unit["v"].to_numpy()
    own, joint = exchange(counted_pairs(training, names), totals, workspace, classes, rounds)
    class_totals = np.bincount(own, totals, minlength=classes)
    class_words = np.bincount(own, words, minlength=classes)
    share = (class_totals + 0.5) / (class_totals + 0.5).sum()
    transition = (joint + BACK_OFF * share[None, :]) / (joint.sum(axis=1, keepdims=True) + BACK_OFF)
    return ClassModel(
        names, own, np.log10(transition), np.log10(class_totals + ADD * (class_words + 1)),
        int(row[0]), int(row[1]), max(0, int(row[2]) - len(names)),
    )


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD_OUT_FOLD


def score_texts(docs: DataFrame, model: ClassModel, counts: DataFrame, workspace: Workspace, *, known: int = KNOWN) -> DataFrame:
    """(row, id, n_tokens, n_known, base_score, score) of rows of (row, id, text).

    Tokens of broadcast words are scored where they are read. The other words of a text leave as
    (row, word, times) and find their counts by an ordinary join.
    """
    spark = docs.sparkSession
    # KNOWN short words of all texts at most, and the end token in any case.
    frequent = frequent_words(counts, known, "t").union(counts.where(F.length("word") == 0)).toArrow()
    slots = Slots.of(dict(zip(frequent["word"].to_pylist(), frequent["c"].to_pylist())), model)
    del frequent
    shared, transition = spark.sparkContext.broadcast(slots), model.transition
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        memo, table = _SlotCache(shared.value), shared.value
        for batch in slices(batches):
            memo.trim()
            tokens, sizes = [_END], []
            for text in utf8(batch.column(2)):
                words = words_of(text)
                tokens += words
                tokens.append(_END)
                sizes.append(len(words) + 1)
            slot = np.fromiter(map(memo.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            classes, known = table.classes[slot], table.known[slot[1:]]
            step = transition[classes[:-1], classes[1:]]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            rare = np.flatnonzero(table.rare[slot[1:]])
            # One entry per rare token; the texts they belong to follow from their places.
            upto = np.searchsorted(rare, np.append(0, ends)).astype(np.int32)
            words = pa.array([tokens[i + 1] for i in rare.tolist()], pa.binary())
            arrays = [
                batch.column(0), batch.column(1), pa.array(np.array(sizes, dtype=np.int64)),
                pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                pa.array(np.add.reduceat(table.base[slot[1:]], starts)),
                pa.array(np.add.reduceat(table.emission[slot[1:]] + step, starts)),
                pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words),
            ]
            names = ["row", "id", "n_tokens", "n_known", "base", "score", "rare"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = (
        f"row bigint, id {kind}, n_tokens bigint, n_known bigint, base double, score double, "
        "rare array<binary>"
    )
    first = workspace.store(docs.select("row", "id", "text").mapInArrow(run, schema), "frequent_part")
    rare = first.select("row", F.explode("rare").alias("word"))
    # The first pass has taken them as unseen; what a count adds is the same for all models.
    seen = rare.join(counts.where(F.col("c") > 0).select("word", "c"), "word")
    c = F.col("c")
    extra = seen.groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"),
        F.sum(F.log10(c + F.lit(BASE_ADD)) - F.log10(F.lit(BASE_ADD))).alias("more_base"),
        F.sum(F.log10(c + F.lit(ADD)) - F.log10(F.lit(ADD))).alias("more_score"),
    )
    out = first.drop("rare").join(extra, "row", "left")
    return out.select(
        "row", "id", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


@dataclass
class Slots:
    """A place for each word that is broadcast or has a unit of its own, and one for each ending, which any
    other word takes. By place: class, base log, emission log, whether training has it, whether it must be looked up."""

    places: dict[bytes, int]
    endings: int  # the place of ending 0
    classes: np.ndarray
    base: np.ndarray
    emission: np.ndarray
    known: np.ndarray
    rare: np.ndarray

    @classmethod
    def of(cls, counts: dict[bytes, int], model: ClassModel) -> "Slots":
        units = Units(model.exchanged)
        words = [*counts, *(w for w in units.fixed if w not in counts)]
        found = np.array([*(counts.get(w, -1) for w in words), *[-1] * ENDINGS], dtype=np.int64)
        unit = np.array([*map(units.unit, words), *range(units.base, units.n)], dtype=np.int64)
        count, classes = np.maximum(found, 0), model.unit_class[unit]
        return cls(
            {w: i for i, w in enumerate(words)}, len(words), classes.astype(np.int64),
            np.log10(count + BASE_ADD) - model.base_log,
            np.log10(count + ADD) - model.emission[classes],
            count > 0, found < 0,
        )


class _SlotCache(dict):
    """Word to its place; of the words without one of their own some are remembered."""

    def __init__(self, slots: Slots):
        super().__init__(slots.places)
        self.slots = slots

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = self.slots.endings + ending_of(word)
        return slot

    def trim(self) -> None:
        if len(self) > len(self.slots.places) + _RARE_SLOTS:
            self.clear()
            self.update(self.slots.places)


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    known: int = KNOWN,
    workspace: Workspace | None = None,
    **options,
) -> DataFrame:
    """Train on the documents that are not held out, and score all.

    One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity, tied_words (frequent words that had to be tied, the same in every row).
    """
    workspace = workspace or Workspace(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text)
    training = rows.where(~held_out(F.col("id"))).select("text")
    flagged = rows.select("text", (~held_out(F.col("id"))).alias("trains"))
    counts = workspace.store(word_counts(flagged), "counts")
    model = train_class_model(training, counts, workspace, **options)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    out = score_texts(numbered, model, counts, workspace, known=known)
    return out.select(
        F.col("id").alias(doc_id),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
        F.lit(model.tied_words).cast("bigint").alias("tied_words"),
    )
