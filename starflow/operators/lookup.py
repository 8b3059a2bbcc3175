"""Many-to-one lookup: attach columns of a table that is unique on its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.columns import hashable, is_plain, ref, refs
from starflow.sources.workspace import Workspace

# A lookup is broadcast whole only if its measured size is at most this.
BROADCAST_BYTES = 128 * 1024 * 1024
# In the shuffled form a key is hot from 1/HOT_KEYS of all rows on, so there are at
# most HOT_KEYS hot keys whatever the data; those rows are served by broadcast.
HOT_KEYS = 10_000
# How many ways rows that need no partner are spread in the shuffled form.
_SPREAD = 4096
_ROW_OVERHEAD = 32
# The hot rows are broadcast only up to this size.
HOT_BYTES = 32 * 1024 * 1024
_RESERVED = ("_spread", "_hot", "_weight", "_place")
# A lookup is dealt into buckets of so many bytes, of which one task holds one; up to MOST_BUCKETS
# buckets they may grow to the second size.
BUCKET_BYTES, MOST_BUCKET_BYTES = 8 * 1024 * 1024, 64 * 1024 * 1024
LEAST_BUCKETS, MOST_BUCKETS = 64, 256


def lookup_bytes(columns: Sequence[str], schema: T.StructType) -> Column:
    """Aggregate: estimated in-memory size of ``columns`` of a table."""
    size = F.count(F.lit(1)) * (_ROW_OVERHEAD + 8 * len(columns))
    for name in columns:
        if isinstance(schema[name].dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.sum(F.octet_length(ref(name)).cast("bigint")), F.lit(0))
    return size


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    take: Sequence[str],
    *,
    null_safe: bool = False,
    weight: str | None = None,
    size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    spread_by: Sequence[str] | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Left join ``take`` from ``lookup``; every row of ``df`` comes out exactly once.

    ``lookup`` must be unique on ``on``. A NULL key finds nothing, unless
    ``null_safe``. ``size`` is the lookup's size in bytes, measured here if not given.
    ``lookup`` is read up to three times; store it first if it is expensive.

    A lookup within ``broadcast_bytes`` is broadcast. A larger one is joined by
    shuffle, where keys with at least 1/``hot_keys`` of the rows are taken out and
    broadcast, and rows that are hot, or have a NULL key that cannot match, are spread
    over the shuffle instead of meeting in one task: by a hash of ``spread_by``, such as a
    row id, or else of all columns, so that identical rows stay together. ``weight`` names
    the column of ``lookup`` with the rows per key; without it they are counted in ``df``.

    Given a ``workspace`` the rows of the shuffled form are not shuffled but written
    as Parquet, dealt by the key into buckets: columns take a fraction of the bytes that rows take in a
    shuffle, and each bucket streams past its part of the lookup, unsorted. A lookup so
    small that Spark broadcasts it by itself is left to Spark.
    """
    clashes = [c for c in df.columns if c in _RESERVED or c.startswith(("_l_", "_h_"))]
    if clashes:
        raise ValueError(f"column names used by the lookup itself: {clashes}")
    weighed = F.lit(None) if weight is None else F.coalesce(F.sum(ref(weight)), F.lit(0))
    total = None
    if size is None:
        size, total = lookup.agg(lookup_bytes([*on, *take], lookup.schema), weighed).first()
    keys = [f"_key{i}" for i in range(len(on))]
    kept = [c for c in df.columns if c not in take]

    def side(table: DataFrame, prefix: str, *extra: Column) -> DataFrame:
        return table.select(
            *[ref(c).alias(prefix + k) for c, k in zip(on, keys)],
            *[ref(c).alias(prefix + c) for c in take],
            *extra,
        )

    def matches(prefix: str) -> Column:
        tests = [
            ref(c).eqNullSafe(ref(prefix + k)) if null_safe else ref(c) == ref(prefix + k)
            for c, k in zip(on, keys)
        ]
        return _all(tests)

    if size <= broadcast_bytes:
        joined = df.join(F.broadcast(side(lookup, "_l_")), matches("_l_"), "left")
        return joined.select(*refs(kept), *[ref("_l_" + c).alias(c) for c in take])

    hot = _hot_rows(df, lookup, on, weight, total, hot_keys)
    held = hot.agg(lookup_bytes([*on, *take], lookup.schema)).first()[0]
    while hot_keys > 1 and held > HOT_BYTES:  # fewer and hotter keys, if they are wide
        hot_keys = max(1, hot_keys // 4)
        hot = _hot_rows(df, lookup, on, weight, total, hot_keys)
        held = hot.agg(lookup_bytes([*on, *take], lookup.schema)).first()[0]
    hot = side(hot, "_h_", F.lit(True).alias("_hot"))
    idle = F.col("_hot").isNotNull()
    if not null_safe:
        idle = idle | ~_all([ref(c).isNotNull() for c in on])
    spread = F.pmod(F.xxhash64(*refs(kept if spread_by is None else spread_by)), F.lit(_SPREAD))
    spread = F.when(idle, spread + 1).otherwise(F.lit(0).cast("bigint"))
    # Always 0, but not a literal: a constant would be folded out of the join keys, and
    # with it the spreading.
    never_spread = F.pmod(F.xxhash64(*refs(on)), F.lit(1))
    spread_rows = df.join(F.broadcast(hot), matches("_h_"), "left").withColumn("_spread", spread)
    other = side(lookup, "_l_", never_spread.alias("_l_spread"))
    number = _buckets(df.sparkSession, size)
    same = matches("_l_") & (F.col("_spread") == F.col("_l_spread"))
    if workspace is not None and number and all(is_plain(df.schema[c].dataType) for c in on):
        spread_rows = spread_rows.select(*refs(kept), *[ref("_h_" + c) for c in take], "_hot", "_spread")
        place, other_place = [*on, "_spread"], [*["_l_" + k for k in keys], "_l_spread"]
        if null_safe:
            # Dealt and joined by a hash of the key; the key itself, NULL or not, is compared behind that.
            spread_rows = spread_rows.withColumn("_place", _key_hash(spread_rows, on))
            other = other.withColumn("_l_place", _key_hash(other, other_place[:-1]))
            place, other_place = ["_place", "_spread"], ["_l_place", "_l_spread"]
            same = _all([ref(a) == ref(b) for a, b in zip(place, other_place)])
            for c, k in zip(on, keys):
                a, b = ref(c), ref("_l_" + k)
                same = same & F.coalesce(a == b, a.isNull() & b.isNull())
        spread_rows = workspace.deal(spread_rows, "dealt", place, number)
        other = other.repartition(number, *refs(other_place)).hint("shuffle_hash")
    joined = spread_rows.join(other, same, "left")
    taken = [
        F.when(F.col("_hot"), ref("_h_" + c)).otherwise(ref("_l_" + c)).alias(c) for c in take
    ]
    return joined.select(*refs(kept), *taken)


def _buckets(spark: SparkSession, size: int) -> int:
    """How many buckets a lookup of ``size`` bytes is dealt into; 0 if it is too small for that, or too large."""
    if size <= _broadcast_threshold(spark) or size > MOST_BUCKETS * MOST_BUCKET_BYTES:
        return 0
    least = min(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, least, min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))


def _broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def _key_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.xxhash64(*hashable(df, columns), *[ref(c).isNull() for c in columns])


def _hot_rows(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    weight: str | None,
    total: int | None,
    hot_keys: int,
) -> DataFrame:
    """The lookup rows of keys with at least 1/hot_keys of all rows: at most hot_keys."""
    counts = lookup
    if weight is None:
        counts = df.groupBy(*refs(on)).agg(F.count(F.lit(1)).alias("_weight"))
    n = ref(weight or "_weight")
    if total is None:
        total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot = counts.where(n * hot_keys >= total)
    if weight is not None:
        return hot
    same = _all([ref(c).eqNullSafe(ref("_hot_" + c)) for c in on])
    hot = hot.select(*[ref(c).alias("_hot_" + c) for c in on])
    return lookup.join(F.broadcast(hot), same, "left_semi")


def _all(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out
