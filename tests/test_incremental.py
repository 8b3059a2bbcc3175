import json

import pytest
from pyspark.sql import functions as F

from starflow.operators.registry import keyed_by_registry, new_keys
from starflow.plans import incremental
from starflow.plans.incremental import HASH, ChangedFileError, SalesStore, row_hash, unknown_rows
from starflow.plans.sales import run_sales, sales_spec
from starflow.sources import contract as con
from starflow.sources.commits import Buckets, ConcurrentCommitError, TableSet
from starflow.sources.files import write_csv
from starflow.sources.flat_sales import ORDER_KEY, flat_sales
from starflow.sources.tables import UnwritableTextError, read_bucketed, write_bucketed

SPEC = sales_spec(con.column_names(short_names=True))
CONTRACT = con.sales_contract(short_names=True)


# --- keys -----------------------------------------------------------------------------


def test_known_members_keep_their_keys(spark, workspace):
    schema = "a string, b int, x int"
    first = spark.createDataFrame([("m", 1, 0), ("c", 2, 0), (None, 1, 0), ("m", 1, 5)], schema)
    registry = workspace.store(new_keys(first, None, ["a", "b"], "k", workspace), "registry")
    assert {(r.a, r.b): r.k for r in registry.collect()} == {(None, 1): 1, ("c", 2): 2, ("m", 1): 3}
    more = spark.createDataFrame([("a", 1, 0), ("m", 1, 0), (None, 1, 0), (None, None, 0), ("d", 9, 0)], schema)
    added = new_keys(more, registry, ["a", "b"], "k", workspace)
    assert {(r.a, r.b): r.k for r in added.collect()} == {(None, None): 4, ("a", 1): 5, ("d", 9): 6}
    every = registry.unionByName(added)
    assert new_keys(more, every, ["a", "b"], "k", workspace).isEmpty()
    keyed = keyed_by_registry(more.select("a", "b"), every, ["a", "b"], "k")
    assert keyed.columns == ["k", "a", "b"] and {r.k for r in keyed.collect()} == {5, 3, 1, 4, 6}


def test_new_keys_of_nothing(spark, workspace):
    empty = spark.createDataFrame([], "a string")
    assert new_keys(empty, None, ["a"], "k", workspace).isEmpty()


# --- tables that change as a whole ------------------------------------------------------


def test_a_failed_publication_leaves_the_old_tables(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    good = {"a": spark.range(3), "b": spark.createDataFrame([("x",)], "t string")}
    manifest = tables.publish(good, fmt="csv")
    assert {r["table"]: r["rows"] for r in manifest.collect()} == {"a": 3, "b": 1}
    bad = {"a": spark.range(9), "b": spark.createDataFrame([("with \r return",)], "t string")}
    with pytest.raises(UnwritableTextError):
        tables.publish(bad, fmt="csv")
    assert tables.read("a").count() == 3 and tables.read("b").first()[0] == "x"
    tables.publish({"a": spark.range(9)}, {"b": spark.createDataFrame([("y",)], "t string")}, fmt="csv")
    assert tables.read("a").count() == 9 and {r[0] for r in tables.read("b").collect()} == {"x", "y"}


def test_a_torn_commit_counts_for_nothing(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    assert tables.current().number == 0
    tables.publish({"a": spark.range(3)})
    (tmp_path / "_commits" / "00000002").write_text('{"number": 2, "tab')
    assert tables.current().number == 1 and tables.read("a").count() == 3
    tables.publish({"a": spark.range(4)})
    assert tables.current().number == 3 and tables.read("a").count() == 4
    assert json.loads((tmp_path / "_commits" / "00000003").read_text())["number"] == 3


def test_the_later_of_two_writers_is_told(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    tables.publish({"a": spark.range(3)})
    base = tables.current()
    tables.publish(add={"a": spark.range(1)}, base=base)
    with pytest.raises(ConcurrentCommitError):
        tables.publish(add={"a": spark.range(1)}, base=base)
    assert tables.read("a").count() == 4


def test_buckets_are_joined_without_moving_them(spark, tmp_path, workspace):
    known = spark.range(500).selectExpr("id AS a", "string(id) AS b")
    known = known.select(*row_hash(known))
    write_bucketed(known, str(tmp_path / "h"), HASH, 4)
    part = read_bucketed(spark, str(tmp_path / "h"), known.schema, HASH, 4)
    rows = spark.range(450, 600).selectExpr("id AS a", "string(id) AS b")
    rows = workspace.store(rows.select("*", *row_hash(rows)), "rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = unknown_rows(rows, [part, part], 4)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert {r.a for r in fresh.collect()} == set(range(500, 600))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1  # the new rows, once; none of the stored ones


def test_row_hash_tells_nulls_and_places_apart(spark):
    rows = [("a", None), (None, "a"), ("", None), (None, ""), (None, None), ("", ""), ("a", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(*row_hash(df)).distinct().count() == len(rows)


# --- loads ------------------------------------------------------------------------------


def without_keys(tables):
    fact = tables["fact_sales"].drop("sale_key")
    for dim in SPEC.star.dimensions:
        fact = fact.join(tables[dim.name], dim.key, "left").drop(dim.key)
    return sorted(map(str, fact.select(sorted(fact.columns)).collect()))


@pytest.fixture(scope="module")
def loaded(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("loads")
    flat = flat_sales(spark, sf_dir, order_key=True).where(F.col(ORDER_KEY) % 5 == 0)
    halves = [flat.where(F.col(ORDER_KEY) % 2 == 0), flat.where((F.col(ORDER_KEY) % 2 == 1) | (F.col(ORDER_KEY) % 4 == 0))]
    store = SalesStore(spark, str(folder / "store"), SPEC, CONTRACT, buckets=4)
    seen = []
    for n, half in enumerate(halves):
        write_csv(half.drop(ORDER_KEY).coalesce(2), str(folder / "in" / str(n)))
        files = store.load(str(folder / "in" / "*" / "*.csv"))
        seen.append((files, {r["store_id"]: r["store_key"] for r in store.tables()["dim_store"].collect()}))
    return folder, store, seen


def test_two_loads_equal_one(spark, loaded):
    folder, store, seen = loaded
    assert all(files > 0 for files, _ in seen)
    whole = run_sales(
        spark.read.schema(CONTRACT.schema).option("header", True).csv(str(folder / "in" / "*" / "*.csv")), SPEC
    )
    tables = store.tables()
    assert without_keys(tables) == without_keys(whole.tables)
    keys = [r[0] for r in tables["fact_sales"].select("sale_key").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    loads = store.loads().orderBy("load").collect()
    summary = whole.summary.first()
    assert sum(r["rows_loaded"] for r in loads) == summary["rows_loaded"]
    assert sum(r["rows_added"] for r in loads) == summary["rows_after"] and loads[1]["repeats"] > 0


def test_members_keep_their_keys(loaded):
    (_, before), (_, after) = loaded[2]
    assert len(after) > len(before) and all(after[m] == k for m, k in before.items())


def test_loading_again_does_nothing(loaded):
    folder, store, _ = loaded
    number = store.set.current().number
    assert store.load(str(folder / "in" / "*" / "*.csv")) == 0 and store.set.current().number == number


def test_a_changed_file_is_an_error(spark, workspace, tmp_path):
    listing = spark.createDataFrame([("f1", 5, 1), ("f2", 6, 1)], "path string, bytes bigint, modified int")
    ledger = spark.createDataFrame([("f1", 5, 1, 1)], "path string, bytes bigint, modified int, load int")
    assert [r["path"] for r in incremental.unread_files(listing, ledger).collect()] == ["f2"]
    with pytest.raises(ChangedFileError, match="f1"):
        incremental.unread_files(listing.withColumn("bytes", F.lit(7).cast("bigint")), ledger)


def test_a_run_published_together(spark, sf_dir, tmp_path):
    raw = flat_sales(spark, sf_dir).limit(300)
    run = run_sales(raw, SPEC, out_dir=str(tmp_path), publish="together")
    assert run.summary.first()["tables_written"] == 7
    first = {n: t.count() for n, t in run.tables.items()}
    assert {r["table"]: r["rows"] for r in run.manifest.collect()} == first
    run_sales(raw.limit(10), SPEC, out_dir=str(tmp_path), publish="together")
    assert {n: t.count() for n, t in run.tables.items()} == first  # an old commit stays readable
    assert TableSet(spark, str(tmp_path)).read("fact_sales").count() <= 10
    with pytest.raises(ValueError, match="publish"):
        run_sales(raw, SPEC, publish="other")


def test_known_rows_moves_hashes_and_no_row(spark, tmp_path, workspace):
    known = spark.range(500).selectExpr("id AS a", "string(id) AS b")
    known = known.select(*row_hash(known))
    parts = []
    for n, part in enumerate([known, known.limit(20)]):
        write_bucketed(part, str(tmp_path / str(n)), HASH, 4)
        parts.append(read_bucketed(spark, str(tmp_path / str(n)), known.schema, HASH, 4))
    rows = spark.range(450, 600).selectExpr("id AS a", "string(id) AS b")
    rows = workspace.store(rows.select("*", *row_hash(rows)), "rows", row_id="at")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = incremental.known_rows(rows, parts, 4, "at")
        plan = found._jdf.queryExecution().executedPlan().toString()
        ids = {r["at"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["a"] for r in rows.where(F.col("at").isin(*ids)).collect()} == set(range(450, 500))
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 1 and "a#" not in plan.split("Exchange")[1].split("Scan")[0]


def test_added_hashes_are_dealt_where_they_lie(spark, tmp_path, workspace, monkeypatch):
    """Before, a load shuffled the hashes of all its rows to store them."""
    from starflow.sources import commits

    monkeypatch.setattr(commits, "write_bucketed", None)
    store = TableSet(spark, str(tmp_path))
    buckets = {"h": Buckets(HASH, 4)}
    for start in (0, 300):
        rows = spark.range(start, start + 300).selectExpr("id AS a")
        store.publish(add={"h": rows.select(*row_hash(rows))}, buckets=buckets)
    parts = store.parts("h")
    rows = spark.range(500, 700).selectExpr("id AS a")
    rows = workspace.store(rows.select("*", *row_hash(rows)), "rows", row_id="at")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = incremental.known_rows(rows, parts, 4, "at")
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert found.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
