"""Surrogate keys that never move: a registry of natural keys, only ever added to.

A dense key by natural-key order renumbers all members behind a newcomer. Here a member keeps the
number it was given when it was first seen; newcomers are numbered among themselves, behind the largest
key in use. What a fact holds from an earlier load stays right.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs, require_columns
from starflow.operators.keys import number_by_order
from starflow.sources.workspace import Workspace


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equal natural keys; NULL is a key like any other."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def new_keys(
    members: DataFrame,
    registry: DataFrame | None,
    natural_keys: Sequence[str],
    key: str,
    workspace: Workspace,
) -> DataFrame:
    """(key, natural keys) of the members that ``registry`` does not know.

    ``members`` may repeat and may hold other columns; both sides are reduced to their natural keys
    before they meet, so no key is hot. Without a registry all are new. The result
    is a function of the registry and the set of new keys. It is stored.
    """
    require_columns(members, natural_keys)
    found = members.select(*refs(natural_keys)).distinct()
    last = 0
    if registry is not None:
        require_columns(registry, [key, *natural_keys])
        last = registry.agg(F.coalesce(F.max(ref(key)), F.lit(0))).first()[0]
        known = registry.select(*[ref(k).alias(f"_k{i}") for i, k in enumerate(natural_keys)])
        on = _same(refs(natural_keys), [F.col(f"_k{i}") for i in range(len(natural_keys))])
        found = found.join(known, on, "left_anti")
    order = [ref(k).asc_nulls_first() for k in natural_keys]
    numbered = number_by_order(found, order, key, workspace)
    return numbered.select((ref(key) + F.lit(last)).cast("bigint").alias(key), *refs(natural_keys))


def keyed_by_registry(
    members: DataFrame, registry: DataFrame, natural_keys: Sequence[str], key: str
) -> DataFrame:
    """``members`` (unique on their natural keys) with the registered key in front.

    A member that is not registered is an error of the caller and gets no key.
    """
    taken = registry.select(ref(key), *[ref(k).alias(f"_k{i}") for i, k in enumerate(natural_keys)])
    on = _same(refs(natural_keys), [F.col(f"_k{i}") for i in range(len(natural_keys))])
    return members.join(taken, on, "left").select(ref(key), *refs(members.columns))
