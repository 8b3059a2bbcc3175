"""Dimension versions over time (type 2), and facts looked up as of their time.

A member's history is the sequence of its states; equal neighbours are one version, valid from its first
state until the next version starts. Versions of a member neither overlap nor leave gaps.

The as-of lookup does not compare times pairwise. Rows and versions of a member are put in one
sequence by time, and each row takes the last version before it: one shuffle, one sort. A member
with very many rows is cut into stretches of time of about equal size; the version that is valid
where a stretch begins is carried into it. Rows of one stretch are dealt over several tasks where even
that is too many, as when they all have the same time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.functions.columns import ref, refs, require_columns
from starflow.operators.keys import number_by_order
from starflow.operators.lookup import HOT_KEYS
from starflow.sources.workspace import Workspace

VALID_FROM, VALID_TO, VERSION, CURRENT = "valid_from", "valid_to", "version", "is_current"
# A member is hot from 1/HOT_KEYS of all rows on; it is cut into so many stretches at the most.
STRETCHES = 256


@dataclass(frozen=True)
class HistorySpec:
    """A dimension with versions: surrogate key, natural key, attributes, and the column of time, which is
    a number, a date or a timestamp."""

    name: str
    key: str
    natural_keys: tuple[str, ...]
    attributes: tuple[str, ...]
    at: str

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.natural_keys, *self.attributes, VALID_FROM, VALID_TO, VERSION, CURRENT]


def _state(attributes: Sequence[str]) -> Column:
    """The attributes as one value that compares NULLs as equal."""
    if not attributes:
        return F.lit(0)
    return F.struct(*[ref(a).alias(f"a{i}") for i, a in enumerate(attributes)])


def member_states(df: DataFrame, spec: HistorySpec) -> DataFrame:
    """One row per natural key and time; of contradicting values the smallest non-NULL one counts.

    Rows without a time have no place in a history and are left out.
    """
    require_columns(df, [*spec.natural_keys, *spec.attributes, spec.at])
    keys = refs([*spec.natural_keys, spec.at])
    dated = df.where(ref(spec.at).isNotNull())
    if not spec.attributes:
        return dated.select(*keys).distinct()
    # Distinct combinations first, by hash: the smallest text takes a sorting aggregate.
    combinations = dated.select(*keys, *refs(spec.attributes)).distinct()
    return combinations.groupBy(*keys).agg(*[F.min(ref(a)).alias(a) for a in spec.attributes])


def build_history(
    df: DataFrame, spec: HistorySpec, workspace: Workspace | None = None
) -> DataFrame:
    """Surrogate key, natural key, attributes, valid_from, valid_to, version, is_current.

    ``valid_to`` is exclusive and NULL for the current version. A NULL natural key is a member like any
    other. The key numbers the versions by natural key and time, so it is the same on every
    run. States are compared in two steps, within a stretch of time and then between stretches, so a member
    observed at very many times does not arrive whole in one task; its versions do.
    """
    workspace = workspace or Workspace(df.sparkSession)
    states = workspace.store(member_states(df, spec), f"{spec.name}_states")
    cut = stretches(states, spec.natural_keys, spec.at, workspace)
    for keys in ([*refs(spec.natural_keys), F.col("_stretch")], refs(spec.natural_keys)):
        order = Window.partitionBy(*keys).orderBy(ref(spec.at))
        cut = cut.withColumn("_first", F.row_number().over(order) == 1)
        cut = cut.withColumn("_before", F.lag(_state(spec.attributes)).over(order))
        cut = cut.where(F.col("_first") | ~F.col("_before").eqNullSafe(_state(spec.attributes)))
        cut = cut.drop("_first", "_before")
    of_member = Window.partitionBy(*refs(spec.natural_keys)).orderBy(ref(spec.at))
    versions = cut.select(
        *refs([*spec.natural_keys, *spec.attributes]),
        ref(spec.at).alias(VALID_FROM),
        F.lead(ref(spec.at)).over(of_member).alias(VALID_TO),
        F.row_number().over(of_member).alias(VERSION),
    )
    order = [*[ref(k).asc_nulls_first() for k in spec.natural_keys], F.col(VALID_FROM)]
    numbered = number_by_order(versions, order, spec.key, workspace)
    return numbered.withColumn(CURRENT, F.col(VALID_TO).isNull()).select(*refs(spec.columns))


def stretches(
    df: DataFrame, keys: Sequence[str], at: str, workspace: Workspace, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """``df`` with ``_stretch``: which stretch of its member's time a row is in; 0 but for hot members."""
    bounds = _bounds(df, keys, at, workspace, hot_keys)
    return _in_stretch(df, bounds, keys, at, "_stretch").drop("_last", "_salts")


def _bounds(
    df: DataFrame, keys: Sequence[str], at: str, workspace: Workspace, hot_keys: int
) -> DataFrame:
    """(_b0.., _bounds, _salts) of hot members: at most ``hot_keys`` of them, whatever the data.

    The bounds are approximate quantiles of the time, so any of them are right; they only decide how
    even the stretches are. ``_salts`` says over how many tasks a stretch is dealt.
    """
    counts = df.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    share = max(1, total // hot_keys)
    named = [ref(k).alias(f"_b{i}") for i, k in enumerate(keys)]
    hot = workspace.store(counts.where(F.col("_n") > 2 * share).select(*named, "_n"), "hot")
    parts = [F.lit(i / STRETCHES) for i in range(1, STRETCHES)]
    cut = F.percentile_approx(_place(df, at), F.array(*parts), 10_000)
    salts = F.greatest(F.lit(1), F.ceil(F.max("_n") * 4 / F.lit(STRETCHES * share))).cast("int")
    met = df.join(F.broadcast(hot), _on(keys, "_b")).groupBy(*[F.col(f"_b{i}") for i in range(len(keys))])
    return workspace.store(met.agg(F.array_distinct(cut).alias("_bounds"), salts.alias("_salts")), "bounds")


def _place(df: DataFrame, at: str) -> Column:
    """The time as a number."""
    return F.unix_micros(ref(at).cast("timestamp")) if _is_time(df, at) else ref(at)


def _is_time(df: DataFrame, at: str) -> bool:
    return df.schema[at].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")


def _on(keys: Sequence[str], prefix: str) -> Column:
    tests = [ref(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def _in_stretch(df: DataFrame, bounds: DataFrame, keys: Sequence[str], at: str, out: str) -> DataFrame:
    """``df`` with its stretch, the number of bounds at or before its time, the last stretch and the salts."""
    place = _place(df, at)
    number = F.size(F.filter("_bounds", lambda b: b <= place))
    joined = df.join(F.broadcast(bounds), _on(keys, "_b"), "left")
    cold = F.col("_bounds").isNull()
    return joined.select(
        *refs(df.columns),
        F.when(cold, F.lit(0)).otherwise(number).alias(out),
        F.when(cold, F.lit(0)).otherwise(F.size("_bounds")).alias("_last"),
        F.coalesce("_salts", F.lit(1)).alias("_salts"),
    )


def attach_as_of(
    df: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    take: Sequence[str],
    *,
    valid_from: str = VALID_FROM,
    hot_keys: int = HOT_KEYS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Left join ``take`` of the version that is valid at ``at``; every row comes out exactly once.

    ``versions`` is unique on ``on`` and ``valid_from``. A row whose time is NULL or lies before its
    member's first version, or whose member has none, gets NULLs. A NULL key is a member like any other.
    ``df`` is read up to three times; store it first if it is expensive.
    """
    require_columns(df, [*on, at])
    require_columns(versions, [*on, valid_from, *take])
    kept = [c for c in df.columns if c not in take]
    if clashes := [c for c in kept if c.startswith("_")]:
        raise ValueError(f"column names used by the lookup itself: {clashes}")
    workspace = workspace or Workspace(df.sparkSession)
    dated = df.where(ref(at).isNotNull())
    bounds = _bounds(dated, on, at, workspace, hot_keys)
    # Rows of a time stretch, dealt over its salts.
    rows = _in_stretch(df.select(*refs(kept)), bounds, on, at, "_stretch")
    salt = F.pmod(F.xxhash64(*refs(kept)), F.col("_salts"))
    spread = F.when(ref(at).isNull(), F.pmod(F.xxhash64(*refs(kept)), F.lit(4096)) + 1).otherwise(F.lit(0))
    rows = rows.select(
        F.struct(*refs(kept)).alias("_row"),
        *[ref(k).alias(f"_k{i}") for i, k in enumerate(on)],
        ref(at).alias("_at"), F.lit(1).alias("_kind"), "_stretch", salt.alias("_salt"),
        spread.cast("bigint").alias("_spread"),
    )
    # Versions in every stretch they reach into: where they start, and at the start of the later ones.
    named = versions.select(*refs(on), ref(valid_from).alias("_at"), F.struct(*refs(take)).alias("_taken"))
    placed = _in_stretch(named, bounds, on, "_at", "_from")
    of_member = Window.partitionBy(*refs(on)).orderBy("_at")
    placed = placed.withColumn("_to", F.coalesce(F.lead("_from").over(of_member), F.col("_last")))
    reach = F.when(F.col("_to") > F.col("_from"), F.sequence("_from", "_to")).otherwise(F.array("_from"))
    placed = placed.withColumn("_stretch", F.explode(reach))
    placed = placed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    carried = placed.select(
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"),
        *[ref(k).alias(f"_k{i}") for i, k in enumerate(on)],
        "_at", F.lit(0).alias("_kind"), "_stretch", F.col("_salt").cast("bigint").alias("_salt"),
        F.lit(0).cast("bigint").alias("_spread"), "_taken",
    )
    both = rows.withColumn("_taken", F.lit(None).cast(carried.schema["_taken"].dataType)).unionByName(carried)
    keys = [F.col(f"_k{i}") for i in range(len(on))]
    order = Window.partitionBy(*keys, "_stretch", "_salt", "_spread").orderBy("_at", "_kind")
    valid = F.last("_taken", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    valid = F.when(F.col("_at").isNotNull(), valid)
    out = both.withColumn("_valid", valid).where("_kind = 1")
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], *[F.col("_valid")[c].alias(c) for c in take])
