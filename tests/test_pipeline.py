import pytest
from pyspark.sql import functions as F

from starflow.catalog.queries import SPEC
from starflow.operators import features
from starflow.operators.cleaning import clean_distinct
from starflow.operators.dimensions import dimension_members
from starflow.operators.facts import unmatched_keys
from starflow.operators.quality import QualityError
from starflow.plans.sales import (
    MissingValueError,
    run_sales,
    run_sales_files,
    sales_spec,
    stage_distinct,
)
from starflow.plans.star import join_star
from starflow.sources.contract import SALES_COLUMNS, sales_contract
from starflow.sources.files import EmptySourceError, write_csv
from starflow.sources.flat_sales import flat_sales

CLEAN_ROW = {
    "month_num": "4", "month": "Apr", "year": "2022", "store_type": "Retail ",
    "category": "Dairy", "segment": "Milk", "manufacturer": "M", "brand": "B",
    "barcode": "123", "pack_size": "1", "pack_unit": "EA", "value_sales": "1,000",
    "units_sales": "50", "region": "West", "state": "MH", "city": "Pune", "store_id": "S1",
    "product_id": "P1", "supplier_id": "SUP1", "distribution_center": "DC1",
    "sales_channel": "MT", "batch_number": "B1", "lot_number": "L1", "lead_days": "15",
    "warehouse_id": "WH1", "inventory_status": "Low Stock", "order_status": "Done",
    "data_source": "POS", "ingestion_timestamp": "2024-01-01",
}
# The tables of the model and the columns of its fact.
TABLES = {
    "fact_sales", "dim_date", "dim_geography", "dim_store", "dim_product", "dim_supplier",
    "dim_warehouse",
}
FACT_COLUMNS = [
    "sale_key", "date_key", "geography_key", "store_key", "product_key", "supplier_key",
    "warehouse_key", "value_sales", "units_sales", "supplier_lead_time_days",
    "inventory_status", "order_status", "PricePerUnit", "CategorySalesRank",
    "InventoryRiskFlag", "batch_number", "lot_number",
]


def raw_file(spark, tmp_path, *changes):
    """A CSV under the real header; each change is a row that differs from the clean one."""
    rows = [{**CLEAN_ROW, **c} for c in changes]
    schema = ", ".join(f"`{name}` string" for _, name, _ in SALES_COLUMNS)
    data = [tuple(r[role] for role, _, _ in SALES_COLUMNS) for r in rows]
    path = str(tmp_path / "raw")
    write_csv(spark.createDataFrame(data, schema), path)
    return path


DIRTY = {"value_sales": "-", "units_sales": "N/A", "warehouse_id": None, "store_id": "S2"}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_end_to_end(spark, tmp_path, workspace, ansi, fmt):
    path = raw_file(spark, tmp_path, {}, {}, DIRTY)
    out = str(tmp_path / "curated")
    run = run_sales_files(spark, path, out_dir=out, fmt=fmt, workspace=workspace, max_null_pct=40.0)
    assert set(run.tables) == TABLES
    assert {p.name for p in (tmp_path / "curated").iterdir()} == TABLES
    fact = run.tables["fact_sales"]
    assert fact.columns == FACT_COLUMNS
    rows = {r["units_sales"]: r for r in fact.collect()}
    assert set(rows) == {50, None}
    assert rows[50]["value_sales"] == 1000.0 and rows[50]["PricePerUnit"] == 20.0
    assert rows[50]["InventoryRiskFlag"] == "High Risk" and rows[50]["CategorySalesRank"] == 1
    assert rows[None]["value_sales"] is None and rows[None]["CategorySalesRank"] == 2
    stores = sorted((r["STORE_ID"], r["STORE TYPE"]) for r in run.tables["dim_store"].collect())
    assert stores == [("S1", "Retail"), ("S2", "Retail")]
    houses = [r["WAREHOUSE_ID"] for r in run.tables["dim_warehouse"].orderBy("warehouse_key").collect()]
    assert houses == ["UNKNOWN", "WH1"]
    assert run.summary.first().asDict() == {
        "rows_loaded": 3, "rows_after": 2, "duplicates_removed": 1, "rows_dropped": 0,
        "nulls_filled": 1, "invalid_numbers": 2, "dimension_tables": 6, "fact_tables": 1,
        "tables_written": 7, "rows_quarantined": 0,
    }
    quality = run.quality.first()
    assert (quality["total_rows"], quality["duplicate_rows"], quality["passed"]) == (3, 1, True)
    assert {r["table"]: r["rows"] for r in run.manifest.collect()} == {
        "fact_sales": 2, "dim_date": 1, "dim_geography": 1, "dim_store": 2, "dim_product": 1,
        "dim_supplier": 1, "dim_warehouse": 2,
    }


def test_breach_warns_or_fails(spark, tmp_path, workspace):
    path = raw_file(spark, tmp_path, {}, DIRTY)
    run = run_sales_files(spark, path, workspace=workspace)
    assert run.quality.first()["breaching_columns"] == ["WAREHOUSE_ID"]
    with pytest.raises(QualityError, match="WAREHOUSE_ID"):
        run_sales_files(spark, path, workspace=workspace, on_breach="fail")
    with pytest.raises(ValueError, match="on_breach"):
        run_sales_files(spark, path, on_breach="shrug")


def test_malformed_rows_are_set_aside_or_kept(spark, tmp_path, workspace):
    bad = {"pack_size": "x", "batch_number": "B2"}
    path = raw_file(spark, tmp_path, {}, bad, bad)
    kept = run_sales_files(spark, path, workspace=workspace)
    assert kept.tables["fact_sales"].count() == 2
    assert kept.quarantine is None
    summary = kept.summary.first()
    assert (summary["rows_loaded"], summary["rows_after"], summary["rows_dropped"]) == (3, 2, 0)
    assert {(r["column"], r["null_count"]) for r in kept.missing.collect()} == {("PACK SIZE", 2)}

    out = tmp_path / "out"
    run = run_sales_files(
        spark, path, workspace=workspace, on_malformed="quarantine", out_dir=str(out)
    )
    assert run.tables["fact_sales"].count() == 1
    summary = run.summary.first()
    assert summary["rows_quarantined"] == summary["rows_dropped"] == 2
    assert summary["rows_loaded"] == 3 == (
        summary["rows_after"] + summary["duplicates_removed"] + summary["rows_dropped"]
    )
    (row,) = run.quarantine.collect()
    assert row["_copies"] == 2 and ",x," in row["_corrupt_record"]
    (stored,) = spark.read.parquet(str(out / "quarantine")).collect()
    assert stored["_corrupt_record"] == row["_corrupt_record"]


def test_missing_values_warn_or_fail(spark, tmp_path, workspace):
    path = raw_file(spark, tmp_path, {}, {"city": None})
    assert run_sales_files(spark, path, workspace=workspace).missing.collect() == [("CITY", 1)]
    with pytest.raises(MissingValueError, match="CITY: 1"):
        run_sales_files(spark, path, workspace=workspace, on_missing="fail")
    with pytest.raises(ValueError, match="on_missing"):
        run_sales_files(spark, path, on_missing="shrug")


def test_dimensions_do_not_wait_for_the_rank(spark, sf_dir, workspace):
    """With everything on the paths for large data, a dimension reads its own columns only."""
    staged = stage_distinct(flat_sales(spark, sf_dir), workspace).drop("_copies")
    rows = clean_distinct(staged, SPEC.cleaning)
    unranked = features.add_calendar(rows, "month_num", "year")
    for dim in SPEC.star.dimensions:
        plan = dimension_members(unranked, dim)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
        read = plan.split("ReadSchema: struct<")[1].split(">")[0]
        columns = {c.split(":")[0] for c in read.split(",")}
        assert columns <= {*dim.natural_keys, *dim.attributes, "month_num", "year"}


def test_reserved_names_are_refused(spark, workspace):
    with pytest.raises(ValueError, match="itself"):
        run_sales(spark.range(1).selectExpr("id AS _copies"), SPEC, workspace=workspace)


def test_empty_source(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(",".join(name for _, name, _ in SALES_COLUMNS) + "\n")
    with pytest.raises(EmptySourceError):
        run_sales_files(spark, str(tmp_path / "raw.csv"))


def test_nothing_written_without_a_folder(spark, sf_dir, workspace):
    run = run_sales(flat_sales(spark, sf_dir), SPEC, workspace=workspace)
    assert run.manifest is None and run.summary.first()["tables_written"] == 0
    assert {r["table"] for r in run.counts.collect()} == TABLES
    assert run.features.count() == 5


def test_large_scale_paths_give_the_same_star(spark, sf_dir, run, tmp_path, workspace):
    """Nothing broadcast whole, no window rank, hot keys apart, fact in date folders."""
    large = run_sales(
        flat_sales(spark, sf_dir), SPEC, workspace=workspace, out_dir=str(tmp_path / "out"),
        partition_by={"fact_sales": ["date_key"]}, broadcast_bytes=0, window_group_rows=0,
    )
    assert sum(1 for _ in (tmp_path / "out" / "fact_sales").glob("date_key=*")) > 10
    for name, table in run.tables.items():
        expected = table.drop("sale_key")
        got = large.tables[name].drop("sale_key")
        assert got.dtypes == expected.dtypes
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    from starflow.sources.workspace import Workspace

    place = Workspace(spark, str(tmp_path_factory.mktemp("run")))
    return run_sales(flat_sales(spark, sf_dir), SPEC, workspace=place)


def test_fact_keeps_the_grain_and_the_sums(run):
    fact, staging = run.tables["fact_sales"], run.staging
    sums = [F.count(F.lit(1)), F.sum(F.col("value_sales").cast("decimal(18,2)")), F.sum("units_sales")]
    assert fact.agg(*sums).first() == staging.agg(*sums).first()
    assert fact.select("sale_key").distinct().count() == fact.count()


def test_every_key_resolves(run):
    fact = run.tables["fact_sales"]
    assert unmatched_keys(fact, SPEC.star.dimensions).where("unmatched_rows > 0").isEmpty()
    for dim in SPEC.star.dimensions:
        assert fact.join(run.tables[dim.name], dim.key, "left_anti").isEmpty()


def test_facts_link_to_the_right_members(run):
    """Through the surrogate keys, each line must find its own store and product again."""
    names = [d.name for d in SPEC.star.dimensions]
    joined = join_star(run.tables, SPEC.star, names)
    ids = ["batch_number", "lot_number", "store_id", "product_id", "supplier_id", "warehouse_id",
           "city", "year", "month_num"]
    assert joined.select(*ids).exceptAll(run.staging.select(*ids)).isEmpty()
    assert run.staging.select(*ids).exceptAll(joined.select(*ids)).isEmpty()


def test_dimension_keys_are_the_same_on_every_run(spark, sf_dir, run, workspace):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = run_sales(flat_sales(spark, sf_dir), SPEC, workspace=workspace)
        for dim in SPEC.star.dimensions:
            assert again.tables[dim.name].exceptAll(run.tables[dim.name]).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_raw_names_and_role_names_describe_the_same_run():
    raw, short = sales_spec(), SPEC
    assert [n for n, _ in raw.star.fact.columns][:2] == ["Value Sales", "Units Sales"]
    assert [n for _, n in raw.star.fact.columns] == [n for _, n in short.star.fact.columns]
    assert set(raw.cleaning.columns()) <= set(sales_contract().names)
