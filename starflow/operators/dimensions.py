"""Dimensions: one row per natural key, with a surrogate key, and the gate on that."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs, require_columns
from starflow.operators.keys import hash_key, number_by_order
from starflow.operators.lookup import lookup_bytes
from starflow.sources.workspace import Workspace

MEMBER_ROWS = "_rows"
SHOWN_KEYS = 20
_FIRST = "_first"


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension: surrogate key, natural key, attributes.

    ``first_by`` names the column that says which row's value an attribute takes; if
    it is None the smallest value is taken. ``key_kind`` is "dense" (1..N by natural
    key) or "hash".
    """

    name: str
    key: str
    natural_keys: tuple[str, ...]
    attributes: tuple[str, ...] = ()
    first_by: str | None = None
    key_kind: str = "dense"

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.natural_keys, *self.attributes]


class DuplicateKeyError(ValueError):
    """A dimension that would multiply the rows of a fact joined to it."""


def dimension_members(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row per natural key: the key, a non-NULL value for each attribute where
    there is one, and ``_rows``, how many rows of ``df`` carry the key.

    Each attribute is chosen on its own, so they may come from different rows.
    """
    require_columns(df, [*spec.natural_keys, *spec.attributes])
    keys = refs(spec.natural_keys)
    rows = F.count(F.lit(1)).alias(MEMBER_ROWS)
    if not spec.attributes:
        return df.groupBy(*keys).agg(rows)
    # Merge to the distinct combinations first, by hash: picking a text value takes a
    # sorting aggregate, which then only sees what is left. The order is one more column of
    # the combination, not an aggregate, for the same reason.
    order = [] if spec.first_by is None else [ref(spec.first_by).alias(_FIRST)]
    combinations = df.groupBy(*keys, *refs(spec.attributes), *order).agg(rows)
    return combinations.groupBy(*keys).agg(
        *[_pick(a, by_order=bool(order)).alias(a) for a in spec.attributes],
        F.sum(MEMBER_ROWS).alias(MEMBER_ROWS),
    )


def _pick(attribute: str, by_order: bool) -> Column:
    """Smallest non-NULL value, or the one that comes first; on a tie the smaller one.

    A row whose order is NULL comes after all others.
    """
    value = ref(attribute)
    if not by_order:
        return F.min(value)
    at = F.col(_FIRST)
    placed = F.struct(at.isNull().alias("last"), at.alias("at"), value.alias("value"))
    return F.min(F.when(value.isNotNull(), placed))["value"]


def keyed_members(df: DataFrame, spec: DimensionSpec, workspace: Workspace) -> DataFrame:
    """Members with their surrogate key, stored, with ``_rows`` kept as last column."""
    members = dimension_members(df, spec)
    if spec.key_kind == "hash":
        keyed = workspace.store(hash_key(members, spec.natural_keys, spec.key), spec.name)
    elif spec.key_kind == "dense":
        order = [ref(c).asc_nulls_first() for c in spec.natural_keys]
        keyed = number_by_order(members, order, spec.key, workspace)
    else:
        raise ValueError(f"key_kind is 'dense' or 'hash', not {spec.key_kind!r}")
    return keyed.select(*refs([*spec.columns, MEMBER_ROWS]))


def build_dimension(
    df: DataFrame, spec: DimensionSpec, workspace: Workspace | None = None
) -> DataFrame:
    """Surrogate key, natural key, attributes; exactly one row per natural key.

    A dense key is a function of the set of natural keys alone. Reading the result
    twice gives the same keys, and so does building it again on another cluster.
    """
    workspace = workspace or Workspace(df.sparkSession)
    return keyed_members(df, spec, workspace).select(*refs(spec.columns))


def key_statistics(
    dimensions: Mapping[str, tuple[DataFrame, Sequence[str]]],
) -> DataFrame:
    """Rows (dim, rows, distinct_keys, key_bytes, passed), one per dimension.

    One union, so one action reads them all. A NULL key counts as one key.
    """
    if not dimensions:
        raise ValueError("no dimension given")
    parts = []
    for name, (df, keys) in dimensions.items():
        per_key = df.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias(MEMBER_ROWS))
        parts.append(
            per_key.agg(
                F.lit(name).alias("dim"),
                F.coalesce(F.sum(MEMBER_ROWS), F.lit(0)).alias("rows"),
                F.count(F.lit(1)).alias("distinct_keys"),
                lookup_bytes(keys, df.schema).alias("key_bytes"),
            )
        )
    return reduce(DataFrame.unionByName, parts).withColumn(
        "passed", F.col("rows") == F.col("distinct_keys")
    )


def check_unique(dimensions: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows (dim, rows, distinct_keys, passed)."""
    return key_statistics(dimensions).drop("key_bytes")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys that occur more than once with their count, most frequent first."""
    counted = df.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias("rows"))
    order = [F.col("rows").desc(), *[ref(k).asc_nulls_first() for k in keys]]
    return counted.where(F.col("rows") > 1).orderBy(*order)


def require_unique(
    dimensions: Mapping[str, tuple[DataFrame, Sequence[str]]],
    shown: int = SHOWN_KEYS,
) -> dict[str, dict[str, int]]:
    """Check all dimensions, then raise once, naming every failing one with the number of
    its duplicate keys and up to ``shown`` of them. Returns {dim: {rows, distinct_keys,
    key_bytes}} if all pass."""
    stats = {r["dim"]: r.asDict() for r in key_statistics(dimensions).collect()}
    problems = []
    for name, (df, keys) in dimensions.items():
        if stats[name]["passed"]:
            continue
        report = duplicate_keys(df, keys)
        examples, total = report.limit(shown).collect(), report.count()
        problems.append(f"{name} is not unique on ({', '.join(keys)}), {total} keys repeat:")
        for row in examples:
            key = ", ".join(f"{k}={row[k]!r}" for k in keys)
            problems.append(f"  {key}: {row['rows']} rows")
        if total > len(examples):
            problems.append(f"  and {total - len(examples)} more")
    if problems:
        raise DuplicateKeyError("\n".join(problems))
    return stats
