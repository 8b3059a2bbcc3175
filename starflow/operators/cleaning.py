"""Deduplication, numbers from text, imputation, trimming, and their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import hashable, is_plain, ref, require_columns
from starflow.functions.numeric_text import is_invalid_number, parse_number
from starflow.operators.lookup import BROADCAST_BYTES, attach
from starflow.operators.quality import COPIES, count_copies
from starflow.sources.workspace import Workspace

# Rows are found again by blocks of so many: 4096.
_BLOCK_BITS = 12


@dataclass(frozen=True)
class CleaningSpec:
    """What to clean: number columns and their types, fill values, columns to trim."""

    numbers: Mapping[str, str] = field(default_factory=dict)
    fills: Mapping[str, str] = field(default_factory=dict)
    trims: Sequence[str] = ()

    def columns(self) -> list[str]:
        return [*self.numbers, *self.fills, *self.trims]


def drop_duplicate_rows(
    df: DataFrame, *, workspace: Workspace | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Remove exact repeats over all columns. Runs before any trimming, so rows that
    differ only in blanks stay apart.

    The rows are stored once; only their hashes and the rows that share one are shuffled, as in
    ``store_distinct``. Columns whose equal values may have different bytes, such as
    arrays or texts with a collation, take Spark's own form, which moves all rows.
    """
    if not df.columns or not all(is_plain(f.dataType) for f in df.schema):
        return df.dropDuplicates()
    workspace = workspace or Workspace(df.sparkSession)
    names = [f"c{i}" for i in range(len(df.columns))]
    stored = workspace.store(df.toDF(*names), "rows", "row", "zstd")
    return _distinct_rows(stored, "row", workspace, None, broadcast_bytes).select(*names).toDF(*df.columns)


def drop_duplicate_rows_late(
    df: DataFrame, *, workspace: Workspace | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The same rows as ``drop_duplicate_rows``, for wide rows with few repeats.

    The rows are stored once, with a row id and a 128-bit hash. Only hashes and ids are
    shuffled; of each hash that occurs more than once the first row stays, and the others go where
    they lie. A row goes only if it equals the one that stays, cell by cell; rows that merely
    share its hash are deduplicated the ordinary way. NULLs are equal.
    """
    workspace = workspace or Workspace(df.sparkSession)
    names = [f"c{i}" for i in range(len(df.columns))]  # no name of the input can clash
    flags = [F.col(c).isNull() for c in names]
    hashed = df.toDF(*names).select(
        *names,
        F.xxhash64(*names, *flags).alias("h1"),
        F.xxhash64(F.lit("late"), *flags, *names[::-1]).alias("h2"),
    )
    rows = workspace.store(hashed, "hashed", row_id="row")
    seen = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times"), F.min("row").alias("first"))
    repeated = workspace.store(seen.where("times > 1"), "repeated")
    limits = {"broadcast_bytes": broadcast_bytes, "spread_by": ["row"]}
    marked = attach(rows, repeated, ["h1", "h2"], ["first"], weight="times", **limits)
    stays = F.col("first").isNull() | (F.col("first") == F.col("row"))

    # What goes is compared with what stays; both are as few as the repeats.
    firsts = marked.where(F.col("first") == F.col("row")).select(
        "h1", "h2", F.struct(*names).alias("kept")
    )
    others = workspace.store(marked.where(~stays), "others")
    firsts = workspace.store(firsts, "firsts")
    size = firsts.agg(F.count(F.lit(1)) * 64 + F.coalesce(F.sum(F.octet_length(F.to_json("kept"))), F.lit(0))).first()[0]
    compared = attach(others, firsts, ["h1", "h2"], ["kept"], size=size, **limits)
    same = F.struct(*names).eqNullSafe(F.col("kept"))
    strangers = compared.where(~same).select(*names).dropDuplicates()
    return marked.where(stays).select(*names).unionByName(strangers).toDF(*df.columns)


def _row_hash(names: Sequence[str]) -> Column:
    return F.xxhash64(*names, *[F.col(c).isNull() for c in names])


def store_distinct(
    stored: DataFrame,
    row_id: str,
    workspace: Workspace,
    *,
    unwanted: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``count_copies`` of rows that ``Workspace.store`` left with ``row_id``, stored again with a new one.

    Only a 64-bit hash of each row is shuffled. A row whose hash no other row has is distinct and
    stays where it lies; the others, repeats and rows that merely share a hash, are moved and grouped
    by all columns, so the result does not rest on the hash. Where those rows lie is
    broadcast, four bytes a row; if that takes more than ``broadcast_bytes`` all rows are grouped the
    ordinary way. ``unwanted`` holds ids of rows to leave out, with all copies of each.
    """
    distinct = _distinct_rows(stored, row_id, workspace, unwanted, broadcast_bytes)
    return workspace.store(distinct, "distinct", row_id, "zstd")


def _sharing_rows(rows: DataFrame, names: Sequence[str], workspace: Workspace, broadcast_bytes: int) -> DataFrame:
    """The ``row`` of each row whose hash other rows have."""
    hashes = rows.select(_row_hash(names).alias("hash"), "row")
    seen = hashes.groupBy("hash").agg(
        F.count(F.lit(1)).alias("times"), F.min("row").alias("first"), F.max("row").alias("last")
    )
    repeated = workspace.store(seen.where("times > 1"), "repeated")
    sharing = repeated.select(F.explode(F.array("first", "last")).alias("row"))
    between = repeated.where("times > 2")
    if between.isEmpty():
        return sharing
    # Those between the first and the last are found by the hash once more.
    limits = {"broadcast_bytes": broadcast_bytes, "spread_by": ["row"]}
    marked = attach(hashes, between, ["hash"], ["first", "last"], weight="times", **limits)
    others = marked.where((F.col("row") != F.col("first")) & (F.col("row") != F.col("last")))
    return sharing.unionByName(others.select("row"))


def _distinct_rows(
    stored: DataFrame, row_id: str, workspace: Workspace, unwanted: DataFrame | None, broadcast_bytes: int
) -> DataFrame:
    """What ``store_distinct`` stores."""
    columns = [c for c in stored.columns if c != row_id]
    names = [f"c{i}" for i in range(len(columns))]  # no name of the input can clash
    cells = hashable(stored, columns)
    rows = stored.select(*[c.alias(n) for c, n in zip(cells, names)], ref(row_id).alias("row"))
    places = _sharing_rows(rows, names, workspace, broadcast_bytes).select("row", F.lit(False).alias("gone"))
    if unwanted is not None:
        # A row may be named by both; it goes.
        gone = unwanted.select(ref(unwanted.columns[0]).alias("row"), F.lit(True).alias("gone"))
        places = places.unionByName(gone)
    block = F.shiftright("row", _BLOCK_BITS)
    place = F.col("row").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)).cast("int")
    places = workspace.store(
        places.groupBy(block.alias("block")).agg(
            F.collect_set(F.when(F.col("gone"), place)).alias("gone"),
            F.collect_set(F.when(~F.col("gone"), place)).alias("again"),
        ),
        "places",
    )
    held = F.size("gone") + F.size("again")
    size = places.agg(F.coalesce(F.sum(held * 4 + 64), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        found = rows.withColumn("block", block).join(F.broadcast(places), "block", "left")
    else:
        # Every row is taken for a repeat; what is unwanted is found by a shuffle.
        kept = rows
        if unwanted is not None:
            kept = rows.join(unwanted.toDF("row").hint("merge"), "row", "left_anti")
        return count_copies(kept.select(*names)).toDF(*columns, COPIES)
    gone = F.coalesce(F.array_contains("gone", place), F.lit(False))
    again = F.coalesce(F.array_contains("again", place), F.lit(False))
    alone = found.where(~gone & ~again).select(*names, F.lit(1).cast("bigint").alias("copies"))
    grouped = count_copies(found.where(~gone & again).select(*names), "copies")
    return alone.unionByName(grouped).toDF(*columns, COPIES)


def clean_numbers(df: DataFrame, numbers: Mapping[str, str]) -> DataFrame:
    """Replace text columns by numbers; what is not a number becomes a typed NULL."""
    require_columns(df, list(numbers))
    return df.withColumns({name: parse_number(ref(name), to) for name, to in numbers.items()})


def invalid_number_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, invalid_count): texts that are present but not numbers."""
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(is_invalid_number(ref(c))).alias("invalid_count"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def impute(df: DataFrame, fills: Mapping[str, str]) -> DataFrame:
    """Fill NULL, and only NULL, with a sentinel. A blank stays a blank."""
    require_columns(df, list(fills))
    return df.withColumns({c: F.coalesce(ref(c), F.lit(v)) for c, v in fills.items()})


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip outer blanks, so 'Retail' and 'Retail ' are one group."""
    require_columns(df, columns)
    return df.withColumns({c: F.trim(ref(c)) for c in columns})


def clean_distinct(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """All cell-level cleaning in one projection, for rows that are already distinct."""
    require_columns(df, spec.columns())
    cells: dict[str, Column] = {c: parse_number(ref(c), to) for c, to in spec.numbers.items()}
    for c, fill in spec.fills.items():
        cells[c] = F.coalesce(cells.get(c, ref(c)), F.lit(fill))
    for c in spec.trims:
        cells[c] = F.trim(cells.get(c, ref(c)))
    return df.withColumns(cells) if cells else df


def clean(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Deduplicate, then clean every cell."""
    return clean_distinct(drop_duplicate_rows(df), spec)


def metric_exprs(spec: CleaningSpec, weight: str) -> list[Column]:
    """Cleaning metrics as aggregates over rows of ``count_copies``."""
    before = F.coalesce(F.sum(ref(weight)), F.lit(0))
    after = F.count(F.lit(1))
    return [
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("duplicates_removed"),
        F.lit(0).cast("bigint").alias("rows_dropped"),
        *[F.count_if(is_invalid_number(ref(c))).alias(f"invalid_{c}") for c in spec.numbers],
        *[F.count_if(ref(c).isNull()).alias(f"filled_{c}") for c in spec.fills],
    ]


def cleaning_metrics(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """One row: rows_before, rows_after, duplicates_removed, rows_dropped (always 0),
    invalid_<column> and filled_<column>, the last two counted after deduplication."""
    require_columns(df, spec.columns())
    return count_copies(df).agg(*metric_exprs(spec, COPIES))
