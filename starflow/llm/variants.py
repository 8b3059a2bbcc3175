"""Spelling variants: words one edit apart, found by walking a trie as a relation.

The trie of all words is a distributed table of edges (node, letter, child). A state (word, position,
node, edits) says that the word's first letters lead to the node with that many edits. Level by
level the states of one depth are joined with the edges of that depth; a state that reaches a word's
node with one edit, and has used all letters, is a pair of neighbours. A word's own path (no edit)
is known without a join: its nodes are hashes of its prefixes. Each pair is found once, by replacing a
letter by a larger one or by leaving out the last letter of a run, and counts both ways.

An edge holds which word lengths lie below it and which letters can follow, so a state that cannot
end is dropped as it is made. Node numbers are 64-bit hashes: a collision can only add candidates,
and every pair is checked by its true distance.

A level per letter suits words, not runs of thousands of letters: words beyond WALKED letters meet
through the hashes of their forms with one letter left out, a number of rows in proportion to their length.

At scale: words are counted in the tasks before they are shuffled. The edges of a level are
broadcast only while they are small; beyond, nodes that many states share are served apart
(``attach``). A node has at most one child per letter of the alphabet (90), so no group is
unbounded. Levels are stored, which cuts the lineage. Forms at least double the count, so chains are
short, and roots are found by doubling.

Defined results: NULL and empty texts have no words. A NULL id counts as empty text in the
crc32. Repeated rows count again. Ties between forms go to the smallest in code-point order. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import BROADCAST_BYTES, pick, slices, utf8
from starflow.operators.lookup import attach
from starflow.sources.workspace import Workspace

# Which letters make a word, when one is left out, and which words count.
EVERY = 97
LEAST_LENGTH, LEAST_TIMES = 5, 3
RATIO = 2

WALKED = 64  # letters of a word that walks the trie: one bit of a number per length
_FLUSH = 300_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def _letters() -> bytes:
    """Latin-1 bytes to themselves if letters (A-Z in lower case), else to a blank."""
    table = bytearray(b" " * 256)
    for b in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]:
        table[b] = b + 32 if b < 0x5B else b
    return bytes(table)


_TABLE = _letters()


def count_runs(doc_id: bytes, text: str, counts: Counter) -> None:
    """Add a document's words; the document's id decides which lose a letter."""
    before = zlib.crc32(doc_id + b":")
    # Every other character becomes a question mark, which is no letter.
    runs = Counter(text.encode("latin-1", "replace").translate(_TABLE).split())
    for run, n in runs.items():
        if len(run) < LEAST_LENGTH:
            continue  # shorter without a letter still
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        counts[run] += n


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) of all words of rows of (id, text) that are long and frequent enough."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def emit() -> pa.RecordBatch:
            found = [(w.decode("latin-1"), n) for w, n in counts.items() if len(w) >= LEAST_LENGTH]
            counts.clear()
            words, times = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], ["word", "n"])

        for batch in slices(batches):
            ids = utf8(batch.column(0))
            for doc_id, text in zip(ids, utf8(batch.column(1))):
                count_runs(doc_id, text.decode(), counts)
                if len(counts) > _FLUSH:
                    yield emit()
        yield emit()

    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_TIMES)


def _letter(place: str):
    """The code of the letter at a place (from 0) of the word; 0 beyond its end."""
    return F.expr(f"ascii(substring(word, ({place}) + 1, 1))")


def _bit(number):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64)).cast("int"))


def trie_edges(words: DataFrame) -> DataFrame:
    """(depth, node, children) of the trie of ``words``; children are at most one per letter."""
    size = F.length("word")
    steps = words.select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("depth"))
    edges = steps.select(
        "depth",
        F.expr("xxhash64(left(word, depth))").alias("node"),
        _letter("depth").alias("letter"),
        F.expr("xxhash64(left(word, depth + 1))").alias("child"),
        _bit(size).alias("sizes"),
        F.when(size > F.col("depth") + 1, _bit(_letter("depth + 1"))).otherwise(F.lit(0).cast("bigint")).alias("next"),
        (size == F.col("depth") + 1).alias("ends"),
    )
    edges = edges.groupBy("depth", "node", "letter", "child").agg(
        F.bit_or("sizes").alias("sizes"), F.bit_or("next").alias("next"), F.bool_or("ends").alias("ends")
    )
    child = F.struct("letter", "child", "sizes", "next", "ends")
    return edges.groupBy("depth", "node").agg(F.collect_list(child).alias("children"))


def _own_states(words: DataFrame, depth: int) -> DataFrame:
    """The states without an edit at this depth, about to make one.

    ``other`` asks for a larger letter than the word's at ``place`` (a replacement); else the
    letter itself must follow (one letter was left out).
    """
    here = words.where(F.length("word") > depth).withColumn("node", F.expr(f"xxhash64(left(word, {depth}))"))
    replace = here.withColumn("place", F.lit(depth)).withColumn("other", F.lit(True))
    left_out = here.where((F.length("word") > depth + 1) & (_letter(str(depth)) != _letter(str(depth + 1))))
    left_out = left_out.withColumn("place", F.lit(depth + 1)).withColumn("other", F.lit(False))
    return replace.unionByName(left_out)


def _step(states: DataFrame, edges: DataFrame, depth: int, size: int) -> DataFrame:
    """One level down: (word, n, place, node, done)."""
    met = attach(states, edges, ["node"], ["children"], size=size, broadcast_bytes=BROADCAST_BYTES, spread_by=["word"])
    met = met.select("word", "n", "place", "other", F.inline("children"))
    letter, here = F.col("letter"), _letter("place")
    follows = F.when(F.col("other"), letter > here).otherwise(letter == here)
    after = F.col("place") + 1
    target = F.length("word") - (F.col("place") - depth)  # one less if a letter was left out
    done = after == F.length("word")
    can_end = F.col("sizes").bitwiseAND(_bit(target)) != 0
    goes_on = F.when(done, F.col("ends")).otherwise(F.col("next").bitwiseAND(_bit(_letter("place + 1"))) != 0)
    return met.where(follows & can_end & goes_on).select(
        "word", "n", after.alias("place"), F.col("child").alias("node"), done.alias("done")
    )


def walked_pairs(words: DataFrame, workspace: Workspace) -> DataFrame:
    """(word, n, node): words one edit away from the word whose node it is. Words of up to WALKED letters."""
    edges = workspace.store(trie_edges(words).sortWithinPartitions("depth"), "edges")
    sizes = edges.groupBy("depth").agg((F.sum(F.size("children")) * 48 + F.count(F.lit(1)) * 48).alias("bytes"))
    found = words.select("word", "n", F.expr("xxhash64(left(word, length(word) - 1))").alias("node"))
    walkers = None
    for depth, size in sorted(map(tuple, sizes.collect())):  # one row per level
        states = _own_states(words, depth)
        if walkers is not None:
            states = states.unionByName(walkers)
        level = edges.where(F.col("depth") == depth).drop("depth")
        level = workspace.store(_step(states, level, depth, size), f"level_{depth}")
        found = found.union(level.where("done").select("word", "n", "node"))
        walkers = level.where(~F.col("done")).drop("done").withColumn("other", F.lit(False))
    return found


def shortened(word: str) -> np.ndarray:
    """Hashes of the word with each letter left out in turn, and of the whole word behind them."""
    codes = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.append(np.uint64(1), np.full(len(codes) - 1, _BASE, dtype=np.uint64)))
        sums = np.cumsum(codes * powers)
        before = np.append(np.uint64(0), sums[:-1])
        return np.append(before + (sums[-1] - sums) * inverse, sums[-1]).view(np.int64)


def long_pairs(words: DataFrame, workspace: Workspace) -> DataFrame:
    """(word, n, other, other_n) for pairs of which one has more than WALKED letters."""
    words = workspace.store(words.where(F.length("word") >= WALKED), "long_words", row_id="number")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = shortened(word)
                size = np.full(len(hashes), len(word), dtype=np.int32)
                size[:-1] -= 1
                place = np.arange(len(hashes), dtype=np.int32)
                place[-1] = -1
                for at in range(0, len(hashes), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hashes[part]), number)), pa.array(hashes[part]), pa.array(size[part]), pa.array(place[part])],
                        ["number", "hash", "size", "place"],
                    )

    forms = words.select("number", "word").mapInArrow(run, "number bigint, hash bigint, size int, place int")
    forms = workspace.store(forms, "long_forms")
    whole = forms.where("place < 0").select(F.col("number").alias("b"), "hash", "size")
    cut = forms.where("place >= 0").withColumnRenamed("number", "a")
    replaced = cut.join(cut.withColumnRenamed("a", "b"), ["hash", "size", "place"]).where("a < b").select("a", "b")
    pairs = replaced.union(cut.join(whole, ["hash", "size"]).select("a", "b")).distinct()
    a = words.select(F.col("number").alias("a"), "word", "n")
    b = words.select(F.col("number").alias("b"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = pairs.join(a, "a").join(b, "b").where(F.greatest(F.length("word"), F.length("other")) > WALKED)
    return pairs.select("word", "n", "other", "other_n")


def near_words(words: DataFrame, workspace: Workspace) -> DataFrame:
    """(word, n, other, other_n): every two words at distance one, both ways. ``words`` is stored."""
    walked = walked_pairs(words.where(F.length("word") <= WALKED), workspace)
    ends = words.select(F.xxhash64("word").alias("node"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = walked.join(ends, "node").select("word", "n", "other", "other_n")
    if not words.where(F.length("word") > WALKED).isEmpty():
        pairs = pairs.union(long_pairs(words, workspace))
    pairs = pairs.where(F.levenshtein("word", "other", 1) == 1).distinct()
    pairs = workspace.store(pairs, "pairs")
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def follow_forms(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """(word, root) of rows of (word, root) whose root is the next form: every step doubles the reach."""
    forms = workspace.store(forms, "roots")
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = attach(forms, onward, ["root"], ["next"], broadcast_bytes=BROADCAST_BYTES, spread_by=["word"])
        step = step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = workspace.store(step, "roots")
        forms = step.drop("moved")
        if step.where("moved").isEmpty():
            return forms


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, workspace: Workspace | None = None
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    workspace = workspace or Workspace(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text).select(F.col("id").cast("string").alias("id"), "text")
    # As many files as cores at least, so that the levels are worked on by all of them.
    spread = docs.sparkSession.sparkContext.defaultParallelism
    words = workspace.store(word_counts(rows.where("text IS NOT NULL")).repartition(spread, "word"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = near_words(words, workspace).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    taken = -F.col("best.less") >= RATIO * F.col("n")
    found = joined.select(
        "word", F.when(taken, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, -F.col("best.less")).alias("form_n"),
    )
    found = workspace.store(found, "forms")
    roots = follow_forms(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), workspace)
    out = found.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
