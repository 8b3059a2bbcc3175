"""Profiling: null counts, duplicates, thresholds. Reports, never changes data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs

COPIES = "_copies"
DEFAULT_MAX_NULL_PCT = 5.0


class QualityError(ValueError):
    """A null share over its limit, where the caller asked to stop on one."""


def count_copies(df: DataFrame, copies: str = COPIES) -> DataFrame:
    """Distinct rows with the number of times each occurs; NULLs are equal.

    One shuffle gives the deduplicated table, the duplicate count and, weighted by
    ``copies``, every profile of the original rows. Repeats are merged before the
    shuffle, so a row that occurs very often costs one record per task.
    """
    return df.groupBy(*refs(df.columns)).agg(F.count(F.lit(1)).alias(copies))


def _null_entries(columns: Sequence[str], weight: str | None) -> list[Column]:
    """One (column, null_count) struct per column, for a single aggregation."""

    def nulls(name: str) -> Column:
        if weight is None:
            return F.count_if(ref(name).isNull())
        return F.coalesce(F.sum(F.when(ref(name).isNull(), ref(weight))), F.lit(0))

    return [
        F.struct(F.lit(n).alias("column"), nulls(n).alias("null_count")) for n in columns
    ]


def _total(weight: str | None) -> Column:
    if weight is None:
        return F.count(F.lit(1))
    return F.coalesce(F.sum(ref(weight)), F.lit(0))


def null_share(nulls: Column, total: Column) -> Column:
    """Percentage with two decimals, half up; 0.0 for an empty table."""
    return F.when(total > 0, F.round(nulls * 100.0 / total, 2)).otherwise(F.lit(0.0))


def null_profile(
    df: DataFrame,
    max_null_pct: float = DEFAULT_MAX_NULL_PCT,
    columns: Sequence[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rows (column, null_count, null_pct, breach), from one aggregation.

    Only SQL NULL counts; NaN, blanks and placeholders do not. A breach is a rounded
    share strictly above the limit.
    """
    columns = [c for c in (columns or df.columns) if c != weight]
    wide = df.agg(
        _total(weight).alias("total"), F.array(*_null_entries(columns, weight)).alias("entries")
    )
    share = null_share(F.col("null_count"), F.col("total"))
    return wide.select("total", F.inline("entries")).select(
        "column", "null_count", share.alias("null_pct"), (share > max_null_pct).alias("breach")
    )


def row_count(df: DataFrame) -> DataFrame:
    """One row: total_rows."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """One row: total_rows, distinct_rows, duplicate_rows."""
    return count_copies(df).agg(
        _total(COPIES).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (_total(COPIES) - F.count(F.lit(1))).alias("duplicate_rows"),
    )


def quality_exprs(
    columns: Sequence[str], weight: str
) -> list[Column]:
    """The aggregates a quality report needs, over rows of ``count_copies``."""
    return [
        _total(weight).alias("total_rows"),
        (_total(weight) - F.count(F.lit(1))).alias("duplicate_rows"),
        F.array(*_null_entries(columns, weight)).alias("nulls"),
    ]


def with_verdict(report: DataFrame, max_null_pct: float) -> DataFrame:
    """Turn the ``nulls`` array into breaching_columns, n_breaching and passed."""
    over = F.filter(
        "nulls",
        lambda e: null_share(e["null_count"], F.col("total_rows")) > max_null_pct,
    )
    return (
        report.withColumn("breaching_columns", F.transform(over, lambda e: e["column"]))
        .withColumn("n_breaching", F.size("breaching_columns"))
        .withColumn("passed", F.col("n_breaching") == 0)
    )


def quality_report(df: DataFrame, max_null_pct: float = DEFAULT_MAX_NULL_PCT) -> DataFrame:
    """One row: total_rows, duplicate_rows, nulls, breaching_columns, n_breaching, passed.

    Null shares are those of the original rows: each distinct row counts as often as
    it occurs, so profile and duplicates share one shuffle.
    """
    report = count_copies(df).agg(*quality_exprs(df.columns, COPIES))
    return with_verdict(report, max_null_pct)


def require_quality(report: DataFrame) -> None:
    """Raise ``QualityError`` if the one-row report did not pass."""
    row = report.select("passed", "breaching_columns").first()
    if not row["passed"]:
        raise QualityError(f"null share over the limit in {row['breaching_columns']}")
