"""SimHash near-duplicates, found with pivot distance tables.

A fingerprint sums up the hashed shingles of a text in 64 bits. For every distinct
fingerprint the Hamming distances to PIVOTS reference fingerprints are computed once,
kept per quarter of 16 bits; their sums are the distances to the references themselves.

Two fingerprints that differ in at most two bits agree on at least two of the four
quarters, so on all pivot distances of those quarters. The distances of each of the six
pairs of quarters, hashed, are the keys on which pairs meet: an ordinary equi-join. A pair is
then discarded if any of its pivot coordinates differ by more than the limit (by the triangle
inequality it cannot be close), and survivors are verified bit by bit.

A key shared by more than BUCKET fingerprints would make too many pairs. Its members take
another way, exact too: two fingerprints differ in at most two bits if and only if some
value is within one bit of both, so each member names the 65 values within one bit of it,
and those that name the same value (65 at most) are linked to the smallest of them.

Copies share a fingerprint and are linked through it, never in pairs.

Defined results: NULL and word-less texts have fingerprint zero, linked like any other. A
component takes the smallest id in it, NULL if all are NULL. Repeated rows are rows of
their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.components import components
from starflow.llm.rows import BROADCAST_BYTES, keep_rows, map_texts, pick, row_key
from starflow.operators.lookup import attach
from starflow.sources.workspace import Workspace

SHINGLE = 3
MAX_BITS = 2
PIVOTS = 16
BUCKET = 64
_SEED = 42
_QUARTERS = 4
_WIDTH = 64 // _QUARTERS
_CHUNK = 1 << 14  # shingles whose bits are unpacked at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit number."""
    words = text.lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, _SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start : start + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp) per row; ``key`` is the row key of id and text."""
    rows = pick(docs, id=doc_id, text=text)
    rows = rows.withColumn("key", row_key(F.col("id"), F.col("text")))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> list:
        marks = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
        return [batch.column(0), batch.column(2), marks]

    return map_texts(rows, run, f"id {kind}, key bigint, fp bigint")


def _references(n: int) -> list[int]:
    """Reference fingerprints, spread over all values by a hash of their number."""
    marks = [xxhash.xxh64_intdigest(f"reference {i}".encode(), _SEED) for i in range(n)]
    return np.array(marks, dtype=np.uint64).view(np.int64).tolist()


def pivot_table(marks: DataFrame, n: int = PIVOTS) -> DataFrame:
    """Adds ``quarters``: per quarter, the distances of ``fp`` to the references there."""
    masks = np.array([((1 << _WIDTH) - 1) << (_WIDTH * q) for q in range(_QUARTERS)], dtype=np.uint64)
    references = _references(n)

    def distances(mask: int) -> Column:
        part = F.col("fp").bitwiseAND(F.lit(mask))
        return F.array(*[
            F.bit_count(part.bitwiseXOR(F.lit(r & mask))).cast("tinyint") for r in references
        ])

    return marks.withColumn("quarters", F.array(*[distances(m) for m in masks.view(np.int64).tolist()]))


def _coordinates(quarters: Column) -> Column:
    """Distances to the whole references."""
    q = [F.element_at(quarters, i + 1) for i in range(_QUARTERS)]
    total = q[0]
    for other in q[1:]:
        total = F.zip_with(total, other, lambda x, y: (x + y).cast("tinyint"))
    return total


def close_links(marks: DataFrame, workspace: Workspace, bucket: int = BUCKET, pivots: int = PIVOTS) -> DataFrame:
    """Links (a, b) that connect all distinct ``marks.fp`` within MAX_BITS bits.

    Every link is real. Close pairs from an over-full bucket may be connected through a third
    fingerprint that is close to both, instead of directly.
    """
    table = pivot_table(marks.select("fp").distinct(), pivots)
    table = workspace.store(table.withColumn("at", _coordinates(F.col("quarters"))), "pivots")
    q = F.col("quarters")
    agreeing = _QUARTERS - MAX_BITS
    keys = [
        F.xxhash64(F.lit(i), *[F.element_at(q, p + 1) for p in some])
        for i, some in enumerate(itertools.combinations(range(_QUARTERS), agreeing))
    ]
    keyed = workspace.store(table.select("fp", F.explode(F.array(*keys)).alias("bucket")), "buckets")
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = workspace.store(sizes, "sizes")
    shared = attach(keyed, sizes, ["bucket"], ["n"], weight="n", broadcast_bytes=BROADCAST_BYTES)
    shared = workspace.store(shared.where(F.col("n").isNotNull()), "shared")

    small = shared.where(F.col("n") <= bucket).drop("n")
    left, right = small.alias("l"), small.alias("r")
    pairs = left.join(right, "bucket").where("l.fp < r.fp").select(
        F.col("l.fp").alias("a"), F.col("r.fp").alias("b")
    )
    pairs = pairs.distinct()
    for side in ("a", "b"):
        at = table.select(F.col("fp").alias(side), F.col("at").alias(f"at_{side}"))
        pairs = pairs.join(at, side)
    apart = F.array_max(F.zip_with("at_a", "at_b", lambda x, y: F.abs(x - y)))
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = pairs.where(apart <= MAX_BITS).where(bits <= MAX_BITS).select("a", "b")

    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    flips = [F.lit(0).cast("bigint"), *[F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(64)]]
    named = crowded.select("fp", F.explode(F.transform(F.array(*flips), lambda m: m.bitwiseXOR(F.col("fp")))).alias("value"))
    # A group has the 65 values within one bit at most.
    group = named.groupBy("value").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    starred = group.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return near.union(starred.where("a < b").distinct())


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = SHINGLE,
    bucket: int = BUCKET,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, key (of id and text), fp, component_id."""
    workspace = workspace or Workspace(docs.sparkSession)
    rows = workspace.store(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    marks = rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    marks = workspace.store(marks, "marks")
    stars = components(close_links(marks, workspace, bucket), workspace)
    stars = stars.select(F.col("node").alias("fp"), "root")
    rooted = marks.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = workspace.store(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = workspace.store(rooted.join(least, "root").select("fp", "n", "component_id"), "classes")
    out = attach(rows, classes, ["fp"], ["component_id"], weight="n", broadcast_bytes=BROADCAST_BYTES)
    return out.select(F.col("id").alias(doc_id), "key", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    workspace: Workspace | None = None,
    **options,
) -> DataFrame:
    """``docs`` with one document per component: the one with the smallest id.

    Where no row of a component has an id, the one with the smallest row key stays.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    found = workspace.store(near_duplicates(docs, doc_id, text, workspace=workspace, **options), "found")
    named = found.where(F.col(f"`{doc_id}`") == F.col("component_id"))
    # Rows that share the id and differ in text are one document too many: one key stays.
    kept = named.groupBy("component_id").agg(F.min("key").alias("key")).select("key")
    nameless = found.where(F.col("component_id").isNull())
    if nameless.limit(1).count():
        kept = kept.union(_nameless(found, workspace))
    return keep_rows(docs, kept, doc_id, text)


def _nameless(found: DataFrame, workspace: Workspace) -> DataFrame:
    """The smallest key of each component without any id."""
    rows = found.where(F.col("component_id").isNull())
    links = close_links(rows.select("fp").distinct(), workspace)
    stars = components(links, workspace).select(F.col("node").alias("fp"), "root")
    rooted = rows.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rooted.groupBy("root").agg(F.min("key").alias("key")).select("key")
