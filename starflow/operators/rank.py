"""Dense rank inside a group, also where a few groups hold all the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs, require_columns
from starflow.operators.keys import number_by_order
from starflow.operators.lookup import BROADCAST_BYTES, HOT_KEYS, attach
from starflow.sources.workspace import Workspace

# Above this many rows in its largest group, a table is ranked by pairs.
WINDOW_GROUP_ROWS = 2_000_000
_WEIGHT = "_rows"


def dense_rank_in_group(
    df: DataFrame,
    group: str,
    value: str,
    out: str,
    *,
    method: str = "auto",
    window_group_rows: int = WINDOW_GROUP_ROWS,
    workspace: Workspace | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    row_id: str | None = None,
) -> DataFrame:
    """Add ``out``: rank of ``value``, highest first, among the rows of ``group``.

    Equal values share a rank, ranks have no gaps, NULL values come last and share
    one rank, and a NULL group is a group.

    The distinct (group, value) pairs are ranked, not the rows, and the rank is attached to the
    rows by a lookup. ``df`` is read twice, the first time only those two columns: store it
    first if it is expensive. The pairs are stored, so counting them costs no second
    evaluation.

    * ``"window"`` sorts the pairs of a group in one task.
    * ``"pairs"`` numbers them with groups split over tasks.
    * ``"auto"`` takes the window only if the largest group has at most
      ``window_group_rows`` pairs.

    ``row_id`` names a unique column by which rows may be spread in the lookup.
    """
    require_columns(df, [group, value])
    if method not in ("auto", "window", "pairs"):
        raise ValueError(f"method is 'auto', 'window' or 'pairs', not {method!r}")
    clashes = [c for c in (group, value) if c in (_WEIGHT, "_pos", "_start", "_pairs")]
    if clashes:
        raise ValueError(f"column names used by the rank itself: {clashes}")
    workspace = workspace or Workspace(df.sparkSession)
    pairs = df.groupBy(ref(group), ref(value)).agg(F.count(F.lit(1)).alias(_WEIGHT))
    pairs = workspace.store(pairs, "pairs")
    if method == "auto":
        sizes = pairs.groupBy(ref(group)).agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.agg(F.max("n")).first()[0] or 0
        method = "window" if largest <= window_group_rows else "pairs"
    limits = {"broadcast_bytes": broadcast_bytes, "hot_keys": hot_keys}
    if method == "window":
        order = Window.partitionBy(ref(group)).orderBy(ref(value).desc_nulls_last())
        ranks = pairs.withColumn(out, F.dense_rank().over(order))
    else:
        placed = number_by_order(
            pairs, [ref(group).asc_nulls_first(), ref(value).desc_nulls_last()], "_pos", workspace
        )
        starts = placed.groupBy(ref(group)).agg(
            F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_pairs")
        )
        starts = workspace.store(starts, "starts")
        ranks = attach(
            placed, starts, [group], ["_start"], null_safe=True, weight="_pairs", **limits
        )
        ranks = ranks.select(
            *refs([group, value, _WEIGHT]),
            (F.col("_pos") - F.col("_start") + 1).cast("int").alias(out),
        )
    ranks = workspace.store(ranks, "ranks")
    return attach(
        df, ranks, [group, value], [out],
        null_safe=True, weight=_WEIGHT, spread_by=None if row_id is None else [row_id],
        workspace=workspace, **limits,
    )


def top_in_group(df: DataFrame, group: str, value: str, out: str, n: int) -> DataFrame:
    """Rows ranked 1..n in their group, with ``out`` as rank; ties can make it more than n.

    The filter stands directly on the window, so Spark keeps only n ranks per group and
    task before it shuffles: no group arrives whole, however large it is.
    """
    require_columns(df, [group, value])
    order = Window.partitionBy(ref(group)).orderBy(ref(value).desc_nulls_last())
    return df.withColumn(out, F.dense_rank().over(order)).where(ref(out) <= n)
