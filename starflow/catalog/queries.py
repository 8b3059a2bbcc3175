"""One query per operator, over the flat sales extract and the event table.

Every query takes (spark, sf_dir) and reads whole tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starflow.operators import cleaning, dimensions, facts, features, profiles, quality, rank
from starflow.operators.history import HistorySpec, attach_as_of, build_history
from starflow.operators.quality import COPIES
from starflow.operators.registry import new_keys
from starflow.plans.incremental import SalesStore
from starflow.plans.sales import (
    ROW_ID,
    run_sales,
    run_sales_files,
    sales_spec,
    stage_distinct,
)
from starflow.plans.star import attach_dimensions, build_star, join_star, table_counts
from starflow.sources import contract as con
from starflow.sources import cells as cell
from starflow.sources import files
from starflow.sources.flat_sales import ORDER_KEY, flat_sales
from starflow.sources.tables import read_table, write_tables
from starflow.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

SPEC = sales_spec(con.column_names(short_names=True))
CONTRACT = con.sales_contract(short_names=True)
LINE_IDS = ("batch_number", "lot_number", "product_id", "supplier_id")
DIMENSIONS = {d.name: d for d in SPEC.star.dimensions}
PROFILE_LIMIT_PCT = 1.5
TOP_N = 3

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs -----------------------------------------------------------------------


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flat row, repeats included, with clean cells."""
    return cleaning.clean_distinct(flat_sales(spark, sf_dir), SPEC.cleaning)


def with_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_calendar(cleaned(spark, sf_dir), "month_num", "year")


def star(spark: SparkSession, sf_dir: str, **options) -> dict[str, DataFrame]:
    workspace = Workspace(spark)
    staged = stage_distinct(flat_sales(spark, sf_dir), workspace).drop(COPIES)
    rows = cleaning.clean_distinct(staged, SPEC.cleaning)
    unranked = features.add_calendar(rows, "month_num", "year")
    enriched = features.enrich(rows, SPEC.features, row_features=False, workspace=workspace, row_id=ROW_ID)
    return build_star(
        unranked,
        SPEC.star,
        fact_rows=enriched,
        derive=lambda df: features.add_row_features(df, SPEC.features),
        derived=features.row_feature_inputs(SPEC.features),
        row_id=ROW_ID,
        workspace=workspace,
        **options,
    )


# --- sources ----------------------------------------------------------------------


def _flat_as_csv(spark: SparkSession, sf_dir: str) -> str:
    path = Workspace(spark).folder("flat_csv")
    files.write_csv(flat_sales(spark, sf_dir), path, "gzip")
    return path


@query
def contract_csv_scan(spark, sf_dir):
    return files.scan_csv(spark, _flat_as_csv(spark, sf_dir), CONTRACT)


@query
def csv_scan_by_header(spark, sf_dir):
    """The extract in files of three column orders, one of them with blanks in its header."""
    flat = flat_sales(spark, sf_dir, order_key=True)
    names, part = CONTRACT.names, F.col(ORDER_KEY) % 3
    orders = (names, names[::-1], [*names[7:], *names[:7]])
    path = Workspace(spark).folder("orders")
    for i, order in enumerate(orders):
        rows = flat.where(part == i).select(*order)
        files.write_csv(rows.toDF(*[f" {c} " for c in order]) if i == 2 else rows, f"{path}/part={i}", "gzip")
    return files.scan_csv_by_header(spark, f"{path}/*", CONTRACT)


@query
def required_columns(spark, sf_dir):
    scan = files.scan_csv(spark, _flat_as_csv(spark, sf_dir), CONTRACT)
    return con.missing_required(scan, CONTRACT)


@query
def normalize_columns(spark, sf_dir):
    flat = flat_sales(spark, sf_dir)
    messy = flat.toDF(*[f"  {c.replace('_', ' \t ')} " for c in flat.columns])
    return con.normalize_columns(messy)


def _dirty_lines(spark: SparkSession, sf_dir: str) -> str:
    """CSV lines, some cut short and some with text in a number column."""
    rows = flat_sales(spark, sf_dir, order_key=True)
    cells = [
        F.when(F.col(ORDER_KEY) % 97 == 1, "x").otherwise(F.col(c).cast("string")).alias(c)
        if c == "pack_size"
        else F.col(c).cast("string").alias(c)
        for c in CONTRACT.names
    ]
    short = cells[: CONTRACT.names.index("lot_number") + 1]
    line = F.when(F.col(ORDER_KEY) % 97 == 0, F.to_csv(F.struct(*short))).otherwise(
        F.to_csv(F.struct(*cells))
    )
    path = Workspace(spark).folder("lines")
    rows.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path


@query
def quarantine_malformed(spark, sf_dir):
    path = _dirty_lines(spark, sf_dir)
    _, bad = files.read_contract(
        spark, path, CONTRACT, header=False, on_malformed="quarantine"
    )
    return bad.groupBy("batch_number", "lot_number").agg(F.count(F.lit(1)).alias("rows"))


@query
def bad_cells(spark, sf_dir):
    """Bad cells of the dirty lines, by column and reason."""
    scanned = cell.scan_cells(spark, _dirty_lines(spark, sf_dir), CONTRACT, header=False)
    return cell.bad_cell_counts(scanned)


@query
def bad_cell_rows(spark, sf_dir):
    """Every bad cell with its text and the line it stands in."""
    scanned = cell.scan_cells(spark, _dirty_lines(spark, sf_dir), CONTRACT, header=False)
    rows = scanned.select("batch_number", "lot_number", F.explode(cell.BAD_CELLS).alias("e"))
    return rows.select("batch_number", "lot_number", "e.column", "e.text", "e.reason")


# --- profile ----------------------------------------------------------------------


@query
def row_count(spark, sf_dir):
    return quality.row_count(flat_sales(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return quality.null_profile(flat_sales(spark, sf_dir), PROFILE_LIMIT_PCT)


@query
def duplicate_row_count(spark, sf_dir):
    return quality.duplicate_row_count(flat_sales(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    report = quality.quality_report(flat_sales(spark, sf_dir), PROFILE_LIMIT_PCT)
    return report.select(
        "total_rows",
        "duplicate_rows",
        F.concat_ws(",", "breaching_columns").alias("breaching_columns"),
        "n_breaching",
        "passed",
    )


@query
def events_profile(spark, sf_dir):
    return quality.null_profile(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _yearly_states(spark, sf_dir):
    """One state per year of the extract, as a load per year would leave them."""
    flat = Workspace(spark).store(flat_sales(spark, sf_dir), "rows")
    years = [r[0] for r in flat.select("year").distinct().orderBy("year").collect()]
    states = [profiles.profile_state(flat.where(F.col("year") == y), y) for y in years]
    return Workspace(spark).store(functools.reduce(DataFrame.unionByName, states), "states")


@query
def profile_merged(spark, sf_dir):
    """The exact part of the profile of all years, merged from their states."""
    report = profiles.read_profile(profiles.merge_states(_yearly_states(spark, sf_dir)), PROFILE_LIMIT_PCT)
    return report.drop("distinct_values", "quantiles")


@query
def profile_trend(spark, sf_dir):
    """The share of NULLs per year beside that of the year before."""
    return profiles.null_trend(_yearly_states(spark, sf_dir), PROFILE_LIMIT_PCT, max_rise=0.02)


# --- cleaning ---------------------------------------------------------------------


@query
def dedup_rows(spark, sf_dir):
    return cleaning.drop_duplicate_rows(flat_sales(spark, sf_dir))


@query
def dedup_rows_late(spark, sf_dir):
    """The same, with hashes shuffled in place of rows."""
    return cleaning.drop_duplicate_rows_late(flat_sales(spark, sf_dir))


@query
def clean_numeric_value(spark, sf_dir):
    rows = cleaning.clean_numbers(flat_sales(spark, sf_dir), {"value_sales": "double"})
    return rows.select(*LINE_IDS, "value_sales")


@query
def clean_numeric_units(spark, sf_dir):
    rows = cleaning.clean_numbers(flat_sales(spark, sf_dir), {"units_sales": "bigint"})
    return rows.select(*LINE_IDS, "units_sales")


@query
def invalid_numeric_counts(spark, sf_dir):
    return cleaning.invalid_number_counts(
        flat_sales(spark, sf_dir), ["value_sales", "units_sales"]
    )


@query
def impute_missing(spark, sf_dir):
    rows = cleaning.impute(flat_sales(spark, sf_dir), {"warehouse_id": "UNKNOWN"})
    return rows.groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def standardize_strings(spark, sf_dir):
    rows = cleaning.trim_columns(flat_sales(spark, sf_dir), SPEC.cleaning.trims)
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("rows"))


@query
def clean_sales(spark, sf_dir):
    return cleaning.clean(flat_sales(spark, sf_dir), SPEC.cleaning)


@query
def cleaning_metrics(spark, sf_dir):
    return cleaning.cleaning_metrics(flat_sales(spark, sf_dir), SPEC.cleaning)


# --- features ---------------------------------------------------------------------


@query
def calendar_features(spark, sf_dir):
    rows = features.add_calendar(flat_sales(spark, sf_dir), "month_num", "year")
    return rows.select("year", "month_num", features.QUARTER, features.YEAR_MONTH).distinct()


@query
def price_per_unit(spark, sf_dir):
    rows = features.add_unit_price(cleaned(spark, sf_dir), "value_sales", "units_sales")
    return rows.select(*LINE_IDS, features.UNIT_PRICE)


def _ranked(spark, sf_dir, **options):
    workspace = Workspace(spark)
    rows = cleaned(spark, sf_dir).select(*LINE_IDS, "category", "value_sales")
    rows = workspace.store(rows, "rows", row_id=ROW_ID)
    ranked = features.add_sales_rank(
        rows, "category", "value_sales", row_id=ROW_ID, workspace=workspace, **options
    )
    return ranked.drop(ROW_ID)


@query
def category_sales_rank(spark, sf_dir):
    return _ranked(spark, sf_dir)


@query
def category_sales_rank_pairs(spark, sf_dir):
    """The form for groups too large for one task, down to the shuffled lookup."""
    return _ranked(spark, sf_dir, method="pairs", broadcast_bytes=0, hot_keys=100)


@query
def category_top_n(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select(*LINE_IDS, "category", "value_sales")
    return rank.top_in_group(rows, "category", "value_sales", features.SALES_RANK, TOP_N)


@query
def events_rank(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select("event_id", "event_type", "value")
    return rank.dense_rank_in_group(rows, "event_type", "value", "value_rank")


@query
def inventory_risk_flag(spark, sf_dir):
    rows = features.add_risk_flag(cleaned(spark, sf_dir), "inventory_status", "lead_days")
    return rows.groupBy("inventory_status", "lead_days", features.RISK_FLAG).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def enrich_sales(spark, sf_dir):
    staged = stage_distinct(flat_sales(spark, sf_dir), Workspace(spark)).drop(COPIES)
    rows = cleaning.clean_distinct(staged, SPEC.cleaning)
    return features.enrich(rows, SPEC.features, row_id=ROW_ID).drop(ROW_ID)


# --- dimensions -------------------------------------------------------------------


def _dimension_query(name: str) -> Query:
    def run(spark, sf_dir):
        return dimensions.build_dimension(with_calendar(spark, sf_dir), DIMENSIONS[name])

    return run


for _name in DIMENSIONS:
    QUERIES[_name] = _dimension_query(_name)


@query
def dim_store_first_by_batch(spark, sf_dir):
    """Attributes of the first batch instead of the smallest ones."""
    spec = dimensions.DimensionSpec(
        "dim_store", "store_key", ("store_id",), ("store_type", "sales_channel"),
        first_by="batch_number",
    )
    rows = cleaned(spark, sf_dir)
    # Some orders are unknown; such rows come after all others.
    batch = F.when(~F.col("batch_number").endswith("3"), F.col("batch_number"))
    return dimensions.build_dimension(rows.withColumn("batch_number", batch), spec)


@query
def dim_product_hash(spark, sf_dir):
    """Hashed keys: every member with its attributes, and how many members have its key."""
    spec = dimensions.DimensionSpec(
        "dim_product", "product_key", ("product_id",), ("category", "brand"), key_kind="hash"
    )
    dim = dimensions.build_dimension(cleaned(spark, sf_dir), spec)
    same_key = Window.partitionBy("product_key")
    return dim.select(
        "product_id", "category", "brand", F.count(F.lit(1)).over(same_key).alias("key_members")
    )


@query
def dimension_uniqueness(spark, sf_dir):
    tables = star(spark, sf_dir)
    return dimensions.check_unique(
        {name: (tables[name], d.natural_keys) for name, d in DIMENSIONS.items()}
    )


@query
def duplicate_natural_keys(spark, sf_dir):
    """The report on a bad dimension: the flat rows, which repeat every product."""
    return dimensions.duplicate_keys(flat_sales(spark, sf_dir), ["product_id"])


@query
def duplicate_natural_keys_all(spark, sf_dir):
    return dimensions.duplicate_keys(flat_sales(spark, sf_dir), ["city", "state"])


# --- fact and star ----------------------------------------------------------------


@query
def fact_sales(spark, sf_dir):
    return star(spark, sf_dir)["fact_sales"].drop("sale_key")


@query
def fact_sales_shuffled(spark, sf_dir):
    """The same fact with dimensions taken as too large to broadcast."""
    fact = star(spark, sf_dir, broadcast_bytes=0, hot_keys=100)["fact_sales"]
    return fact.drop("sale_key")


@query
def fact_sales_ordered(spark, sf_dir):
    """Sale keys by the order of all fact columns."""
    return star(spark, sf_dir, ordered_key=True)["fact_sales"]


@query
def sale_key_unique(spark, sf_dir):
    return star(spark, sf_dir)["fact_sales"].agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("sale_key").alias("distinct_keys")
    )


def _unmatched(spark, sf_dir, null_safe: bool) -> DataFrame:
    """Facts whose warehouse was not imputed, so some natural keys are NULL."""
    rows = flat_sales(spark, sf_dir).select("warehouse_id", "supplier_id", "batch_number")
    workspace = Workspace(spark)
    rows = workspace.store(rows, "rows")
    specs = [DIMENSIONS["dim_warehouse"], _SUPPLIER_ONLY]
    dims = {s.name: dimensions.build_dimension(rows, s, workspace) for s in specs}
    fact = facts.attach_keys(rows, dims, specs, null_safe_keys=null_safe)
    return facts.unmatched_keys(fact, specs)


_SUPPLIER_ONLY = dimensions.DimensionSpec("dim_supplier", "supplier_key", ("supplier_id",))


@query
def unmatched_keys(spark, sf_dir):
    return _unmatched(spark, sf_dir, null_safe=False)


@query
def null_safe_keys(spark, sf_dir):
    return _unmatched(spark, sf_dir, null_safe=True)


@query
def star_manifest(spark, sf_dir):
    return table_counts(star(spark, sf_dir))


def _run(spark, sf_dir, fmt="parquet"):
    out = Workspace(spark).folder("curated")
    return run_sales(flat_sales(spark, sf_dir), SPEC, out_dir=out, fmt=fmt)


@query
def curated_roundtrip(spark, sf_dir):
    return _run(spark, sf_dir).tables["fact_sales"].drop("sale_key")


# Texts that a careless CSV sink would break: line breaks, quotes, backslashes, blanks, commas.
AWKWARD = (
    "one\ntwo", 'say "so"', "back\\slash", '\\"', "a,b", "", " blanks ", "\n", '"', "x\\\ny",
)


def _awkward(column: str) -> Column:
    """The column with an awkward text behind it, or nothing but that, or NULL; by order."""
    number = F.substring("batch_number", 2, 20).cast("bigint")
    text = F.element_at(F.array(*map(F.lit, AWKWARD)), (number % len(AWKWARD) + 1).cast("int"))
    return (
        F.when(number % 7 == 0, text)
        .when(number % 7 != 1, F.concat(column, text))
        .alias(column)
    )


@query
def curated_roundtrip_csv(spark, sf_dir):
    """The CSV form, with awkward texts in facts and in natural keys."""
    flat = flat_sales(spark, sf_dir)
    awkward = ("order_status", "lot_number", "store_id", "supplier_id")
    flat = flat.select(*[_awkward(c) if c in awkward else c for c in flat.columns])
    out = Workspace(spark).folder("curated")
    tables = run_sales(flat, SPEC, out_dir=out, fmt="csv.gz").tables
    measures = ["order_status", "lot_number", "value_sales", "units_sales"]
    joined = join_star(tables, SPEC.star, ["dim_store", "dim_supplier"], measures)
    return joined.select(
        "order_status", "lot_number", "store_id", "supplier_id", "value_sales", "units_sales"
    )


@query
def export_manifest(spark, sf_dir):
    """Rows of the manifest, and of each table as read back."""
    tables, out = star(spark, sf_dir), Workspace(spark).folder("curated")
    manifest = write_tables(tables, out, "csv.gz")
    back = {n: read_table(spark, f"{out}/{n}", df.schema, "csv.gz") for n, df in tables.items()}
    counted = table_counts(back).select("table", F.col("rows").alias("rows_read"))
    return manifest.join(counted, "table").select(
        "table", "rows", "rows_read", (F.col("bytes") > 0).alias("has_bytes")
    )


@query
def run_summary(spark, sf_dir):
    return _run(spark, sf_dir).summary


def _run_from_lines(spark, sf_dir, **options):
    """The whole run, from text lines with malformed ones among them."""
    path = _dirty_lines(spark, sf_dir)
    return run_sales_files(spark, path, SPEC, CONTRACT, header=False, **options)


@query
def run_summary_from_csv(spark, sf_dir):
    return _run_from_lines(spark, sf_dir).summary


@query
def fact_from_csv(spark, sf_dir):
    """No line is lost: malformed ones are facts with NULL cells."""
    return _run_from_lines(spark, sf_dir).tables["fact_sales"].drop("sale_key")


@query
def run_summary_quarantined(spark, sf_dir):
    return _run_from_lines(spark, sf_dir, on_malformed="quarantine").summary


@query
def quarantine_written(spark, sf_dir):
    """The malformed lines as the run wrote them beside its tables."""
    out = Workspace(spark).folder("curated")
    run = _run_from_lines(spark, sf_dir, on_malformed="quarantine", out_dir=out)
    return run.quarantine.select("batch_number", "lot_number", F.col(COPIES).alias("lines"))


@query
def run_missing_required(spark, sf_dir):
    """Required columns that hold NULLs, from the pass that profiles."""
    return _run_from_lines(spark, sf_dir).missing


@query
def star_rollup(spark, sf_dir):
    """Sales by category and quarter, through the surrogate keys only."""
    tables = star(spark, sf_dir)
    value, units = F.sum(F.col("value_sales").cast("decimal(18,2)")), F.sum("units_sales")
    # One row per pair of keys before anything is looked up.
    sums = tables["fact_sales"].groupBy("product_key", "date_key").agg(
        value.alias("value_sales"), units.alias("units_sales")
    )
    sums = Workspace(spark).store(sums, "sums")
    joined = attach_dimensions(sums, tables, SPEC.star, ["dim_product", "dim_date"])
    value = F.sum("value_sales").cast("double")
    return joined.groupBy("category", F.col(features.QUARTER).alias("quarter")).agg(
        value.alias("value_sales"),
        units.alias("units_sales"),
        F.when(units > 0, value / units).alias("price_per_unit"),
    )


# --- loads that add to what is there -----------------------------------------------


def _store_of_two_loads(spark: SparkSession, sf_dir: str) -> SalesStore:
    """Files of two halves, loaded one after the other; the second repeats rows of the first."""
    workspace = Workspace(spark)
    folder = workspace.folder("incoming")
    flat = flat_sales(spark, sf_dir, order_key=True)
    key = F.col(ORDER_KEY)
    store = SalesStore(spark, workspace.folder("store"), SPEC, CONTRACT, buckets=8)
    for n, half in enumerate([flat.where(key % 2 == 0), flat.where((key % 2 == 1) | (key % 20 == 0))]):
        files.write_csv(half.drop(ORDER_KEY), f"{folder}/{n}", "gzip")
        store.load(f"{folder}/*/*.csv.gz", workspace)
    return store


@query
def incremental_fact(spark, sf_dir):
    """The fact after two loads, with natural keys in place of the surrogate ones."""
    tables = _store_of_two_loads(spark, sf_dir).tables()
    fact = tables["fact_sales"].drop("sale_key")
    for dim in SPEC.star.dimensions:
        natural = tables[dim.name].select(dim.key, *dim.natural_keys)
        fact = fact.join(natural, dim.key, "left").drop(dim.key)
    return fact


@query
def incremental_loads(spark, sf_dir):
    return _store_of_two_loads(spark, sf_dir).loads().drop("files")


@query
def incremental_dim_store(spark, sf_dir):
    """Attributes merged over two loads; members of the first keep their place in the keys."""
    return _store_of_two_loads(spark, sf_dir).tables()["dim_store"]


@query
def stable_product_keys(spark, sf_dir):
    """Keys given to the products of a few orders, then to all others behind them."""
    workspace = Workspace(spark)
    flat = flat_sales(spark, sf_dir, order_key=True)
    first = new_keys(flat.where(F.col(ORDER_KEY) % 97 == 5), None, ["product_id"], "product_key", workspace)
    first = workspace.store(first, "registry")
    added = new_keys(flat, first, ["product_id"], "product_key", workspace)
    return first.withColumn("load", F.lit(1)).unionByName(added.withColumn("load", F.lit(2)))


# --- versions ----------------------------------------------------------------------

HISTORY = HistorySpec(
    "store_history", "store_version_key", ("store_id",), ("store_type", "sales_channel"), "YearMonthKey"
)


@query
def store_history(spark, sf_dir):
    return build_history(with_calendar(spark, sf_dir), HISTORY)


@query
def fact_as_of(spark, sf_dir):
    """Every sale with the version of its store that was known at its month, from a third of the orders."""
    workspace = Workspace(spark)
    flat = cleaning.clean_distinct(flat_sales(spark, sf_dir, order_key=True), SPEC.cleaning)
    rows = features.add_calendar(flat, "month_num", "year")
    rows = workspace.store(rows.select(*LINE_IDS, "store_id", "YearMonthKey", ORDER_KEY, *HISTORY.attributes), "rows")
    known = workspace.store(build_history(rows.where(F.col(ORDER_KEY) % 3 == 0), HISTORY, workspace), "versions")
    sales = rows.select(*LINE_IDS, "store_id", "YearMonthKey")
    taken = ["store_version_key", "store_type", "sales_channel", "version"]
    return attach_as_of(sales, known, ["store_id"], "YearMonthKey", taken, workspace=workspace)


@query
def published_fact(spark, sf_dir):
    """The fact of a run whose tables became visible together, read through its commit."""
    out = Workspace(spark).folder("published")
    run = run_sales(flat_sales(spark, sf_dir), SPEC, out_dir=out, publish="together")
    return run.tables["fact_sales"].drop("sale_key")
