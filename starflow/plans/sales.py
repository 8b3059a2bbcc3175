"""The sales run: from a flat extract to the written star, with its metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.functions.columns import ref, require_columns
from starflow.operators import features as feat
from starflow.operators.cleaning import CleaningSpec, clean_distinct, metric_exprs, store_distinct
from starflow.operators.dimensions import DimensionSpec
from starflow.operators.facts import FactSpec
from starflow.operators.features import FeatureSpec, enrich
from starflow.operators.lookup import BROADCAST_BYTES
from starflow.operators.quality import (
    COPIES,
    DEFAULT_MAX_NULL_PCT,
    quality_exprs,
    require_quality,
    with_verdict,
)
from starflow.operators.rank import WINDOW_GROUP_ROWS
from starflow.plans.star import StarSpec, build_star, table_counts
from starflow.sources.commits import TableSet
from starflow.sources.contract import SchemaContract, column_names, sales_contract
from starflow.sources.files import CORRUPT, require_rows, scan_source
from starflow.sources.tables import read_table, write_table, write_tables
from starflow.sources.workspace import Workspace

ROW_ID = "_row_id"
UNKNOWN = "UNKNOWN"

# What is cleaned, by role.
NUMBER_TYPES = {"value_sales": "double", "units_sales": "bigint"}
FILLED_ROLE = "warehouse_id"
TRIMMED_ROLES = (
    "store_type", "category", "segment", "manufacturer", "brand", "region",
    "state", "city", "sales_channel", "inventory_status", "order_status",
)

# The six dimensions as (table, surrogate key, natural key, attributes),
# by role or derived column.
DIMENSIONS = (
    ("dim_date", "date_key", ("year", "month_num"), ("month", feat.QUARTER, feat.YEAR_MONTH)),
    ("dim_geography", "geography_key", ("city",), ("state", "region")),
    ("dim_store", "store_key", ("store_id",), ("store_type", "sales_channel")),
    (
        "dim_product",
        "product_key",
        ("product_id",),
        ("barcode", "category", "segment", "manufacturer", "brand", "pack_size", "pack_unit"),
    ),
    ("dim_supplier", "supplier_key", ("supplier_id",), ("distribution_center",)),
    ("dim_warehouse", "warehouse_key", ("warehouse_id",), ()),
)

# The fact's own columns as (role or derived column, name in the fact).
FACT_TABLE, FACT_KEY = "fact_sales", "sale_key"
FACT_COLUMNS = (
    ("value_sales", "value_sales"),
    ("units_sales", "units_sales"),
    ("lead_days", "supplier_lead_time_days"),
    ("inventory_status", "inventory_status"),
    ("order_status", "order_status"),
    (feat.UNIT_PRICE, feat.UNIT_PRICE),
    (feat.SALES_RANK, feat.SALES_RANK),
    (feat.RISK_FLAG, feat.RISK_FLAG),
    ("batch_number", "batch_number"),
    ("lot_number", "lot_number"),
)


@dataclass(frozen=True)
class SalesSpec:
    """Everything the run needs to know about the columns of its input."""

    cleaning: CleaningSpec
    features: FeatureSpec
    star: StarSpec


def sales_spec(
    names: Mapping[str, str] | None = None,
    warehouse_fill: str = UNKNOWN,
    key_kind: str = "dense",
) -> SalesSpec:
    """The sales run over an input whose columns are called ``names[role]``.

    Default: the names of the raw extract.
    """
    names = names or column_names()

    def of(role: str) -> str:
        return names.get(role, role)

    cleaning = CleaningSpec(
        numbers={of(r): t for r, t in NUMBER_TYPES.items()},
        fills={of(FILLED_ROLE): warehouse_fill},
        trims=tuple(of(r) for r in TRIMMED_ROLES),
    )
    features = FeatureSpec(
        month=of("month_num"),
        year=of("year"),
        value=of("value_sales"),
        units=of("units_sales"),
        group=of("category"),
        status=of("inventory_status"),
        lead_days=of("lead_days"),
    )
    dimensions = tuple(
        DimensionSpec(
            name, key, tuple(map(of, natural)), tuple(map(of, attributes)), key_kind=key_kind
        )
        for name, key, natural, attributes in DIMENSIONS
    )
    fact = FactSpec(FACT_TABLE, FACT_KEY, tuple((of(s), n) for s, n in FACT_COLUMNS))
    return SalesSpec(cleaning, features, StarSpec(dimensions, fact))


@dataclass
class SalesRun:
    """What a run leaves behind.

    ``quality``, ``cleaning`` and ``summary`` have one row each. ``missing`` has the required
    columns that hold NULLs, ``counts`` the rows and columns of each table, ``features`` how
    each derived column is computed. ``quarantine`` holds the distinct malformed rows with
    their text and how often each occurred.
    """

    tables: dict[str, DataFrame]
    quality: DataFrame
    cleaning: DataFrame
    manifest: DataFrame | None
    summary: DataFrame
    staging: DataFrame = field(repr=False)
    missing: DataFrame
    counts: DataFrame
    features: DataFrame
    quarantine: DataFrame | None = None


def stage_distinct(raw: DataFrame, workspace: Workspace) -> DataFrame:
    """The distinct raw rows, stored with a fixed row id and how often each occurred.

    Rows are stored as they come and again without repeats; before the fact only repeats are shuffled at
    full width. Profile, duplicates, cleaning metrics, dimensions and fact are all read from this table.
    """
    return store_distinct(workspace.store(raw, "raw", ROW_ID, "zstd"), ROW_ID, workspace)


def intake_metrics(staged: DataFrame, spec: SalesSpec, max_null_pct: float) -> DataFrame:
    """One row with the quality report of the raw rows and the cleaning metrics."""
    columns = [c for c in staged.columns if c not in (COPIES, ROW_ID)]
    report = staged.agg(
        *quality_exprs(columns, COPIES), *metric_exprs(spec.cleaning, COPIES)
    )
    return with_verdict(report, max_null_pct)


class MissingValueError(ValueError):
    """A required column that holds NULLs, where the caller asked to stop on one."""


def run_sales(
    raw: DataFrame,
    spec: SalesSpec | None = None,
    *,
    required: Sequence[str] = (),
    on_missing: str = "warn",
    out_dir: str | None = None,
    fmt: str = "parquet",
    partition_by: Mapping[str, Sequence[str]] | None = None,
    max_null_pct: float = DEFAULT_MAX_NULL_PCT,
    on_breach: str = "warn",
    null_safe_keys: bool = False,
    ordered_key: bool = False,
    workspace: Workspace | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    window_group_rows: int = WINDOW_GROUP_ROWS,
    publish: str = "replace",
) -> SalesRun:
    """Profile, deduplicate, clean, enrich, model and, given ``out_dir``, write.

    ``on_breach="fail"`` raises ``QualityError`` if a column holds too many NULLs;
    ``"warn"`` leaves that to the report. ``required`` names columns that may not hold any;
    ``on_missing="fail"`` raises ``MissingValueError``. Rows with a text in
    ``_corrupt_record``, if ``raw`` has that column, are set aside, counted as dropped, and,
    given ``out_dir``, written to ``out_dir/quarantine`` as Parquet. With ``out_dir`` the tables of the result
    are read back from what was written; ``partition_by`` gives the folder columns of a
    table. ``publish="together"`` keeps every run in a folder of its own and makes its tables visible by one
    commit (``TableSet``), so a run that fails leaves the tables of the run before; ``"replace"``
    overwrites ``out_dir/<table>`` one by one. ``broadcast_bytes`` bounds every lookup that is broadcast whole, and
    ``window_group_rows`` the category that may be ranked in one task.
    """
    if on_breach not in ("warn", "fail"):
        raise ValueError(f"on_breach is 'warn' or 'fail', not {on_breach!r}")
    if on_missing not in ("warn", "fail"):
        raise ValueError(f"on_missing is 'warn' or 'fail', not {on_missing!r}")
    if publish not in ("replace", "together"):
        raise ValueError(f"publish is 'replace' or 'together', not {publish!r}")
    if clashes := [c for c in raw.columns if c in (ROW_ID, COPIES)]:
        raise ValueError(f"column names used by the run itself: {clashes}")
    require_columns(raw, required)
    spark = raw.sparkSession
    spec = spec or sales_spec()
    workspace = workspace or Workspace(spark)

    staged = stage_distinct(raw, workspace)
    quarantine = None
    set_aside = F.lit(0).cast("bigint")
    if CORRUPT in raw.columns:
        quarantine = staged.where(ref(CORRUPT).isNotNull()).drop(ROW_ID)
        if out_dir is not None:
            path = f"{out_dir.rstrip('/')}/quarantine"
            write_table(quarantine, path)
            quarantine = read_table(spark, path, quarantine.schema)
        set_aside = quarantine.agg(F.coalesce(F.sum(COPIES), F.lit(0))).scalar()
        staged = staged.where(ref(CORRUPT).isNull()).drop(CORRUPT)
    metrics = workspace.store(intake_metrics(staged, spec, max_null_pct), "metrics")
    quality = metrics.select(
        "total_rows", "duplicate_rows", "nulls", "breaching_columns", "n_breaching", "passed"
    )
    if on_breach == "fail":
        require_quality(quality)
    missing = metrics.select(F.inline("nulls")).select("column", "null_count")
    missing = missing.where(F.col("column").isin(*required) & (F.col("null_count") > 0))
    if on_missing == "fail" and (rows := missing.collect()):
        found = ", ".join(f"{r['column']}: {r['null_count']}" for r in rows)
        raise MissingValueError(f"NULLs in required columns: {found}")

    cleaned = clean_distinct(staged.drop(COPIES), spec.cleaning)
    # No dimension has a rank, so the dimensions read rows without one.
    unranked = feat.add_calendar(cleaned, spec.features.month, spec.features.year)
    enriched = enrich(
        cleaned,
        spec.features,
        workspace=workspace,
        broadcast_bytes=broadcast_bytes,
        window_group_rows=window_group_rows,
        row_id=ROW_ID,
        row_features=False,
    )
    tables = build_star(
        unranked,
        spec.star,
        fact_rows=enriched,
        derive=lambda df: feat.add_row_features(df, spec.features),
        derived=feat.row_feature_inputs(spec.features),
        row_id=ROW_ID,
        ordered_key=ordered_key,
        workspace=workspace,
        null_safe_keys=null_safe_keys,
        broadcast_bytes=broadcast_bytes,
    )
    manifest = None
    if out_dir is not None and publish == "together":
        published = TableSet(spark, out_dir)
        manifest = published.publish(tables, fmt=fmt, partition_by=partition_by)
        commit = published.current()
        tables = {name: published.read(name, commit) for name in tables}
    elif out_dir is not None:
        manifest = write_tables(tables, out_dir, fmt, partition_by)
        tables = {
            name: read_table(spark, f"{out_dir.rstrip('/')}/{name}", df.schema, fmt)
            for name, df in tables.items()
        }
    invalid = [F.col(f"`invalid_{c}`") for c in spec.cleaning.numbers]
    filled = [F.col(f"`filled_{c}`") for c in spec.cleaning.fills]
    # Every row read is among rows_before: it stays, is a repeat, or was set aside.
    counted = [
        (F.col("rows_before") + set_aside).alias("rows_before"),
        F.col("rows_after"),
        F.col("duplicates_removed"),
        (F.col("rows_dropped") + set_aside).alias("rows_dropped"),
    ]
    summary = metrics.select(
        counted[0].alias("rows_loaded"),
        *counted[1:],
        sum(filled, F.lit(0)).alias("nulls_filled"),
        sum(invalid, F.lit(0)).alias("invalid_numbers"),
        F.lit(len(spec.star.dimensions)).alias("dimension_tables"),
        F.lit(1).alias("fact_tables"),
        F.lit(len(tables) if manifest is not None else 0).alias("tables_written"),
        set_aside.alias("rows_quarantined"),
    )
    return SalesRun(
        tables=tables,
        quality=quality,
        cleaning=metrics.select(*counted, *invalid, *filled),
        manifest=manifest,
        summary=summary,
        staging=feat.in_order(feat.add_row_features(enriched, spec.features)),
        missing=missing,
        counts=table_counts(tables),
        features=feat.feature_catalog(spark, spec.features),
        quarantine=quarantine,
    )


def run_sales_files(
    spark: SparkSession,
    path: str,
    spec: SalesSpec | None = None,
    contract: SchemaContract | None = None,
    *,
    header: bool | str = True,
    on_malformed: str = "keep",
    **options,
) -> SalesRun:
    """``run_sales`` over CSV files under a contract, whose required columns it checks.

    ``header="each"`` reads the header of every file, so their columns may come in different orders.
    Malformed rows stay in, with NULL in the bad cells. With ``on_malformed="quarantine"``
    they are set aside instead; they are found by the same scan that feeds the deduplication,
    which parses every column, so the files are read once.
    """
    if on_malformed not in ("quarantine", "keep"):
        raise ValueError(f"on_malformed is 'quarantine' or 'keep', not {on_malformed!r}")
    corrupt = CORRUPT if on_malformed == "quarantine" else None
    contract = contract or sales_contract()
    raw = scan_source(spark, path, contract, header=header, corrupt_record=corrupt)
    require_rows(raw, path)
    return run_sales(raw, spec, **{"required": contract.required, **options})
