"""Quality over time: a profile per batch that merges with others without the rows.

A state is one row per batch and column, a few kilobytes wide whatever the batch holds: exact
counts and extremes, and mergeable sketches of the distinct values and of the quantiles. States
of many batches are appended to one small table; the profile of any set of batches, and the way
from one batch to the next, are read from it.

Defined results: an empty batch has a state of zero rows with NULL extremes. NaN is left out of the
quantiles and is the largest value elsewhere, as Spark orders it. A batch that is added twice counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.columns import ref, require_columns
from starflow.operators.quality import DEFAULT_MAX_NULL_PCT, null_share

HLL_LG = 12  # 4,096 registers: about 1.6 % standard error of distinct counts
KLL_K = 200  # about 1.3 % rank error of quantiles


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _state_of(name: str, kind: T.DataType) -> Column:
    """The state of one column as a struct of aggregates, alike for all column types."""
    cell = ref(name)
    text = cell.cast("string")
    none = F.lit(None)
    if _is_number(kind):
        number = cell.cast("double")
        low, high = F.min(number), F.max(number)
        quantiles = F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(KLL_K))
    else:
        low = high = none.cast("double")
        quantiles = none.cast("binary")
    return F.struct(
        F.lit(name).alias("column"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(cell.isNull()).alias("null_count"),
        F.min(F.length(text)).alias("min_length"),
        F.max(F.length(text)).alias("max_length"),
        low.alias("min_number"),
        high.alias("max_number"),
        F.hll_sketch_agg(text, F.lit(HLL_LG)).alias("distinct_sketch"),
        quantiles.alias("quantile_sketch"),
    )


def profile_state(df: DataFrame, batch: str | int, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column of ``df``: batch, column, counts, extremes, sketches.

    One aggregation over the rows, without a shuffle of them: every task sends one row.
    """
    columns = list(columns or df.columns)
    require_columns(df, columns)
    states = F.array(*[_state_of(c, df.schema[c].dataType) for c in columns])
    return df.agg(states.alias("states")).select(F.lit(batch).alias("batch"), F.inline("states"))


def merge_states(states: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """The states of all batches as one per column; old rows are not read again."""
    return states.groupBy(*map(ref, by)).agg(
        F.sum("rows").alias("rows"),
        F.sum("null_count").alias("null_count"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def read_profile(
    states: DataFrame,
    max_null_pct: float = DEFAULT_MAX_NULL_PCT,
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """States as a report: null_pct, breach, distinct_values and quantiles in place of the sketches.

    The last two are estimates; counts and extremes are exact.
    """
    share = null_share(F.col("null_count"), F.col("rows"))
    sketch = F.col("quantile_sketch")
    known = F.when(sketch.isNotNull() & (F.kll_sketch_get_n_double(sketch) > 0), sketch)
    points = F.array(*[F.lit(float(q)) for q in quantiles])
    return states.select(
        *[ref(c) for c in states.columns if not c.endswith("_sketch")],
        share.alias("null_pct"),
        (share > max_null_pct).alias("breach"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        F.kll_sketch_get_quantile_double(known, points).alias("quantiles"),
    )


def null_trend(
    states: DataFrame, max_null_pct: float = DEFAULT_MAX_NULL_PCT, max_rise: float = 1.0
) -> DataFrame:
    """Per batch and column: null_pct, that of the batch before, and whether it is an alarm.

    An alarm is a share over the limit, or one that rose by more than ``max_rise`` points. Batches
    follow by their name or number; the first of a column has no batch before.
    """
    per_batch = states.groupBy("batch", "column").agg(
        F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count")
    )
    share = null_share(F.col("null_count"), F.col("rows"))
    before = F.lag("null_pct").over(Window.partitionBy("column").orderBy("batch"))
    rise = F.round(F.col("null_pct") - F.col("null_pct_before"), 2)
    return (
        per_batch.withColumn("null_pct", share)
        .withColumn("null_pct_before", before)
        .withColumn("alarm", (F.col("null_pct") > max_null_pct) | F.coalesce(rise > max_rise, F.lit(False)))
    )
