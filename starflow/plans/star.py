"""The star build: dimensions, gate, fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import refs
from starflow.functions.jobs import run_together
from starflow.operators.dimensions import (
    MEMBER_ROWS,
    DimensionSpec,
    keyed_members,
    require_unique,
)
from starflow.operators.facts import FactSpec, build_fact
from starflow.operators.lookup import attach
from starflow.sources.workspace import Workspace


@dataclass(frozen=True)
class StarSpec:
    dimensions: tuple[DimensionSpec, ...]
    fact: FactSpec


def build_dimensions(
    df: DataFrame, specs: Sequence[DimensionSpec], workspace: Workspace
) -> dict[str, DataFrame]:
    """All dimensions, keyed and stored, each still with its ``_rows`` column.

    Each reads only its own columns of ``df``. They do not depend on each other, so
    their jobs are submitted side by side and fill the gaps in each other's stages.
    """

    built = run_together(
        df.sparkSession, lambda spec: keyed_members(df, spec, workspace), list(specs)
    )
    return {spec.name: dim for spec, dim in zip(specs, built)}


def build_star(
    df: DataFrame,
    spec: StarSpec,
    *,
    row_id: str | None = None,
    ordered_key: bool = False,
    workspace: Workspace | None = None,
    fact_rows: DataFrame | None = None,
    **attach_options,
) -> dict[str, DataFrame]:
    """{table name: DataFrame}: the fact first, then the dimensions.

    The gate runs before any join: a dimension that is not unique on its natural key,
    or on a hashed surrogate key, raises ``DuplicateKeyError``. ``df`` is read once
    per dimension and once for the fact; store it first if it is expensive. What only the
    fact needs, such as a rank, can be left out of ``df`` and be in ``fact_rows`` instead: the same
    rows with more columns.
    """
    workspace = workspace or Workspace(df.sparkSession)
    members = build_dimensions(df, spec.dimensions, workspace)
    gate = {d.name: (members[d.name], d.natural_keys) for d in spec.dimensions}
    hashed = {
        f"{d.name}.{d.key}": (members[d.name], (d.key,))
        for d in spec.dimensions
        if d.key_kind == "hash"
    }
    stats = require_unique({**gate, **hashed})
    fact = build_fact(
        df if fact_rows is None else fact_rows,
        members,
        spec.dimensions,
        spec.fact,
        row_id=row_id,
        ordered_key=ordered_key,
        workspace=workspace,
        # The surrogate key is sent along with the natural key.
        sizes={name: stats[name]["key_bytes"] + 8 * stats[name]["rows"] for name in gate},
        **attach_options,
    )
    return {spec.fact.name: fact, **{n: m.drop(MEMBER_ROWS) for n, m in members.items()}}


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (table, rows, columns), one per table, from one union."""
    parts = [
        df.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("rows"),
            F.lit(len(df.columns)).alias("columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def join_star(
    tables: Mapping[str, DataFrame],
    spec: StarSpec,
    dimensions: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The fact with the columns of some dimensions, looked up by the surrogate keys.

    ``columns`` names those of the fact that are wanted, by default all. Aggregate the fact by those keys first
    where the query allows it.
    """
    fact = tables[spec.fact.name]
    if columns is not None:
        keys = [d.key for d in spec.dimensions if d.name in dimensions]
        fact = fact.select(*refs(dict.fromkeys([*keys, *columns])))
    return attach_dimensions(fact, tables, spec, dimensions, workspace=Workspace(fact.sparkSession))


def attach_dimensions(
    df: DataFrame,
    tables: Mapping[str, DataFrame],
    spec: StarSpec,
    dimensions: Sequence[str],
    **attach_options,
) -> DataFrame:
    """Rows that carry surrogate keys, with the columns of some dimensions.

    A dimension is broadcast only within a measured size; beyond it hot members are handled
    apart and rows without a key are spread.
    """
    for d in spec.dimensions:
        if d.name in dimensions:
            take = [c for c in d.columns if c != d.key]
            df = attach(df, tables[d.name], [d.key], take, **attach_options)
    return df
