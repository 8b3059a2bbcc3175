"""The fact: source rows with surrogate keys in place of natural ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs, require_columns
from starflow.operators.dimensions import MEMBER_ROWS, DimensionSpec
from starflow.operators.keys import number_by_order
from starflow.operators.lookup import BROADCAST_BYTES, HOT_KEYS, attach, lookup_bytes
from starflow.sources.workspace import Workspace


@dataclass(frozen=True)
class FactSpec:
    """A fact: its key, and its own columns as (source name, name in the fact)."""

    name: str
    key: str
    columns: tuple[tuple[str, str], ...]


def attach_keys(
    df: DataFrame,
    dimensions: Mapping[str, DataFrame],
    specs: Sequence[DimensionSpec],
    *,
    null_safe_keys: bool = False,
    sizes: Mapping[str, int] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    spread_by: Sequence[str] | None = None,
    workspace: Workspace | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Left join the surrogate key of every dimension; the grain does not change.

    ``broadcast_bytes`` bounds what all lookups broadcast together: the smallest are
    broadcast first, and those for which nothing is left are joined by shuffle.

    With ``null_safe_keys`` a row whose natural key is NULL is linked to the
    dimension's NULL member; without, it has no key.

    ``workspace`` is where rows may be dealt by a key instead of shuffled, see ``attach``. ``keep`` names the columns of
    ``df`` that are wanted beside the keys; natural keys that are not go once they are looked up.
    """
    if sizes is None:
        sizes = {
            s.name: dimensions[s.name]
            .agg(lookup_bytes([*s.natural_keys, s.key], dimensions[s.name].schema))
            .first()[0]
            for s in specs
        }
    left = broadcast_bytes
    ordered = sorted(specs, key=lambda s: sizes[s.name])
    for i, spec in enumerate(ordered):
        dim = dimensions[spec.name]
        whole = sizes[spec.name] <= left
        left -= sizes[spec.name] if whole else 0
        df = attach(
            df,
            dim,
            spec.natural_keys,
            [spec.key],
            null_safe=null_safe_keys,
            weight=MEMBER_ROWS if MEMBER_ROWS in dim.columns else None,
            size=sizes[spec.name],
            broadcast_bytes=sizes[spec.name] if whole else -1,
            hot_keys=hot_keys,
            spread_by=spread_by,
            workspace=workspace,
        )
        if keep is not None:
            later = [k for s in ordered[i + 1 :] for k in s.natural_keys]
            keys = [s.key for s in ordered[: i + 1]]
            df = df.select(*refs(dict.fromkeys([*keep, *later, *keys])))
    return df


def build_fact(
    df: DataFrame,
    dimensions: Mapping[str, DataFrame],
    specs: Sequence[DimensionSpec],
    fact: FactSpec,
    *,
    row_id: str | None = None,
    ordered_key: bool = False,
    workspace: Workspace | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    derived: Mapping[str, Sequence[str]] | None = None,
    **attach_options,
) -> DataFrame:
    """Fact key, one surrogate key per dimension, then the fact's own columns.

    ``row_id`` names a column that is already unique per row, such as the one
    ``Workspace.store`` adds; it becomes the fact key at no cost. Without it the key
    is unique in each evaluation but not fixed before the fact is written. With
    ``ordered_key`` rows are numbered 1..N by all fact columns instead: the same
    table on every run, for one more shuffle.

    ``derived`` names source columns that ``df`` need not have, with the columns that each is a function of;
    ``derive`` adds them once the rows have been moved.
    """
    derived = derived or {}
    sources = [s for s, _ in fact.columns if s not in derived]
    sources = list(dict.fromkeys([*sources, *[c for inputs in derived.values() for c in inputs]]))
    naturals = [k for spec in specs for k in spec.natural_keys]
    needed = list(dict.fromkeys([*sources, *naturals, *([row_id] if row_id else [])]))
    require_columns(df, needed)
    if row_id:
        attach_options.setdefault("spread_by", [row_id])
    workspace = workspace or Workspace(df.sparkSession)
    keep = list(dict.fromkeys([*sources, *([row_id] if row_id else [])]))
    linked = attach_keys(
        df.select(*refs(needed)), dimensions, specs, workspace=workspace, keep=keep, **attach_options
    )
    keys = refs([spec.key for spec in specs])
    body = [*keys, *[ref(s).alias(name) for s, name in fact.columns]]
    late = derive is not None and (not ordered_key or _follows_order(fact, derived))
    if derive is not None and not late:
        linked = derive(linked)
    if not ordered_key:
        linked = derive(linked) if late else linked
        key = ref(row_id) if row_id else F.monotonically_increasing_id()
        return linked.select(key.alias(fact.key), *body)
    # Identical rows may be many; a row id keeps them from sharing one range. The sort reads its input
    # twice, once to choose the ranges; an id that is made here has to be stored for that.
    left = derived if late else ()
    rows = linked.select(*keys, *[ref(s).alias(name) for s, name in fact.columns if s not in left], *(
        [ref(row_id).alias("_tie")] if row_id else []
    ))
    rows = rows if row_id else workspace.store(rows, fact.name, "_tie", "zstd")
    order = [ref(c).asc_nulls_first() for c in rows.columns]
    numbered = number_by_order(rows, order, fact.key, workspace)
    if not late:
        return numbered.select(*refs([fact.key, *[c for c in rows.columns if c != "_tie"]]))
    named = [ref(name).alias(s) for s, name in fact.columns if s not in derived]
    return derive(numbered.select(ref(fact.key), *keys, *named)).select(ref(fact.key), *body)


def _follows_order(fact: FactSpec, derived: Mapping[str, Sequence[str]]) -> bool:
    """Whether the order by all fact columns is the same without the derived ones: what they
    are a function of stands before them."""
    names = [s for s, _ in fact.columns]
    if len(set(names)) < len(names):
        return False
    return all(set(inputs) <= set(names[: names.index(d)]) - set(derived) for d, inputs in derived.items() if d in names)


def unmatched_keys(fact: DataFrame, specs: Sequence[DimensionSpec]) -> DataFrame:
    """Rows (dim, rows, unmatched_rows): fact rows without a key, per dimension."""
    entries = [
        F.struct(
            F.lit(spec.name).alias("dim"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(ref(spec.key).isNull()).alias("unmatched_rows"),
        )
        for spec in specs
    ]
    return fact.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
