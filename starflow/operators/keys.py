"""Row numbering that does not depend on how tasks happen to be laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs
from starflow.sources.workspace import Workspace

_SLOT = "_slot"
# monotonically_increasing_id: partition index above bit 33, row index below.
_SLOT_BITS = 33
_SLOT_MASK = (1 << _SLOT_BITS) - 1


def number_by_order(
    df: DataFrame, order: Sequence[Column], out: str, workspace: Workspace
) -> DataFrame:
    """Add ``out`` = 1..N by ``order``, with the work spread over all tasks.

    Rows are range-partitioned and sorted by ``order`` and written with their
    partition and place. The number is the place plus the sizes of the partitions
    before it, so the partition bounds do not show in the result. Ties in ``order``
    should be identical rows; otherwise any of them may come first.

    Only one count per partition reaches the driver and is broadcast, never the rows.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    stored = workspace.store(placed, out, None, "zstd")
    part = F.shiftright(F.col(_SLOT), _SLOT_BITS)
    place = F.col(_SLOT).bitwiseAND(F.lit(_SLOT_MASK))
    offset = _partition_offsets(stored, part)
    if len(offset) <= 1:
        return stored.select(*refs(df.columns), (place + 1).alias(out))
    offsets = df.sparkSession.createDataFrame(offset, "_part bigint, _offset bigint")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*refs(df.columns), (F.col("_offset") + place + 1).alias(out))
    )


def number_as_stored(stored: DataFrame, row_id: str, out: str, start: int = 0) -> DataFrame:
    """Add ``out`` = start+1..start+N to rows that were stored with ``row_id``, in the order they lie in.

    No shuffle and no sort: the id holds partition and place. One count per partition reaches the
    driver.
    """
    part = F.shiftright(ref(row_id), _SLOT_BITS)
    place = ref(row_id).bitwiseAND(F.lit(_SLOT_MASK))
    offset = _partition_offsets(stored, part)
    offsets = stored.sparkSession.createDataFrame(offset, "_part bigint, _offset bigint")
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_offset") + place + F.lit(start + 1)
    return numbered.select(*refs(stored.columns), number.cast("bigint").alias(out))


def _partition_offsets(stored: DataFrame, part: Column) -> list[tuple[int, int]]:
    """(partition, rows in all earlier partitions); one entry per written partition."""
    sizes = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((row["part"], total))
        total += row["n"]
    return offsets


def hash_key(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` = a 64-bit hash of the natural key.

    Needs no sort and never moves when members come or go. Two keys may collide, so
    have ``out`` itself checked for uniqueness before using it.
    """
    flags = [ref(c).isNull() for c in columns]
    return df.withColumn(out, F.xxhash64(*refs(columns), *flags))
