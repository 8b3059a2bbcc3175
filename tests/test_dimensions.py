import pytest

from starflow.operators.dimensions import (
    DimensionSpec,
    DuplicateKeyError,
    build_dimension,
    check_unique,
    dimension_members,
    duplicate_keys,
    require_unique,
)

PRODUCT = DimensionSpec("dim_product", "product_key", ("PRODUCT_ID",), ("CATEGORY", "PACK unit"))
SCHEMA = "PRODUCT_ID string, CATEGORY string, `PACK unit` string, day int"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_contradicting_attributes_give_one_row(spark, workspace):
    df = spark.createDataFrame(
        [("tea", "hot", None, 1), ("tea", "drink", "bag", 2), ("ice", None, "cube", 3)], SCHEMA
    )
    dim = build_dimension(df, PRODUCT, workspace)
    assert dim.columns == ["product_key", "PRODUCT_ID", "CATEGORY", "PACK unit"]
    assert dict(dim.dtypes)["product_key"] == "bigint"
    assert rows_of(dim) == [(1, "ice", None, "cube"), (2, "tea", "drink", "bag")]


def test_attributes_of_the_first_row_by_a_column(spark, workspace):
    spec = DimensionSpec(
        "d", "k", ("PRODUCT_ID",), ("CATEGORY", "PACK unit"), first_by="day"
    )
    df = spark.createDataFrame(
        [
            ("P", "Z", None, 1), ("P", "A", "EA", 2), ("P", "B", "GR", 3), ("P", "Y", None, 1),
            ("P", "0", "0", None), ("Q", "late", "l", 5), ("Q", "earlier", "e", None),
            ("R", "only", None, None),
        ],
        SCHEMA,
    )
    assert rows_of(build_dimension(df, spec, workspace)) == [
        (1, "P", "Y", "EA"), (2, "Q", "late", "l"), (3, "R", "only", None),
    ]


@pytest.mark.parametrize("first_by", [None, "day"])
def test_the_whole_table_is_aggregated_by_hash(spark, first_by):
    spec = DimensionSpec("d", "k", ("PRODUCT_ID",), ("CATEGORY",), first_by=first_by)
    df = spark.createDataFrame([("P", "A", "EA", 1)], SCHEMA)
    plan = plan_of(dimension_members(df, spec))
    # From the bottom: two hash aggregates before the first one that sorts.
    kinds = [k for k in plan.replace("(", " ").split() if k.endswith("Aggregate")]
    assert kinds[-2:] == ["HashAggregate", "HashAggregate"]


def test_null_key_is_one_member_and_comes_first(spark, workspace):
    spec = DimensionSpec("dim_warehouse", "warehouse_key", ("W",))
    df = spark.createDataFrame([("WH2",), (None,), ("WH1",), (None,), ("WH2",)], "W string")
    assert rows_of(build_dimension(df, spec, workspace)) == [(1, None), (2, "WH1"), (3, "WH2")]


def test_composite_key_is_numbered_in_order(spark, workspace):
    spec = DimensionSpec("dim_date", "date_key", ("Year", "Month #"))
    rows = [(2021, 12), (2022, 1), (2021, 2), (2022, 1), (2021, None)]
    df = spark.createDataFrame(rows, "Year int, `Month #` int")
    assert [tuple(r) for r in build_dimension(df, spec, workspace).orderBy("date_key").collect()] == [
        (1, 2021, None),
        (2, 2021, 2),
        (3, 2021, 12),
        (4, 2022, 1),
    ]


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_keys_are_the_same_for_any_shuffle_width(spark, workspace, partitions):
    rows = [(f"P{i % 300}", f"C{i % 7}", "EA", i) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        dim = build_dimension(df, PRODUCT, workspace)
        keys = {r["PRODUCT_ID"]: r["product_key"] for r in dim.collect()}
        again = {r["PRODUCT_ID"]: r["product_key"] for r in dim.select("PRODUCT_ID", "product_key").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert keys == {k: i + 1 for i, k in enumerate(sorted(f"P{i}" for i in range(300)))}
    assert again == keys


def test_hash_keys_stay_when_members_are_added(spark, workspace):
    spec = DimensionSpec("d", "k", ("PRODUCT_ID",), ("CATEGORY",), key_kind="hash")
    some = spark.createDataFrame([("P1", "A", "EA", 1)], SCHEMA)
    more = some.union(spark.createDataFrame([("P0", "A", "EA", 1)], SCHEMA))
    old = {r["PRODUCT_ID"]: r["k"] for r in build_dimension(some, spec, workspace).collect()}
    new = {r["PRODUCT_ID"]: r["k"] for r in build_dimension(more, spec, workspace).collect()}
    assert len(set(new.values())) == 2
    assert new["P1"] == old["P1"]


def test_empty_dimension(spark, workspace):
    df = spark.createDataFrame([], SCHEMA)
    assert build_dimension(df, PRODUCT, workspace).count() == 0


def bad(spark):
    rows = [(1, "north"), (2, "south"), (3, "south"), (4, "south")]
    return spark.createDataFrame(rows, "warehouse_key int, W string")


def good(spark):
    return spark.createDataFrame([(1, "north"), (2, None)], "warehouse_key int, W string")


def test_gate_passes(spark):
    stats = require_unique({"good": (good(spark), ["W"])})
    assert (stats["good"]["rows"], stats["good"]["distinct_keys"]) == (2, 2)


def test_gate_names_every_failing_dimension(spark):
    other = spark.createDataFrame([(5, 6), (5, 6)], "y int, m int")
    with pytest.raises(DuplicateKeyError) as e:
        require_unique(
            {"one": (bad(spark), ["W"]), "fine": (good(spark), ["W"]), "two": (other, ["y", "m"])}
        )
    text = str(e.value)
    assert "one is not unique on (W), 1 keys repeat" in text and "W='south': 3 rows" in text
    assert "two is not unique on (y, m)" in text and "fine" not in text
    assert isinstance(e.value, ValueError)


def test_check_unique_reports(spark):
    report = check_unique({"one": (bad(spark), ["W"]), "fine": (good(spark), ["W"])})
    assert rows_of(report) == [("fine", 2, 2, True), ("one", 4, 2, False)]


def test_duplicate_keys_are_all_there_in_order(spark):
    keys = [str(i) for i in range(100, 130)] * 2 + ["zz"] * 3 + [None] * 2 + ["once"]
    report = duplicate_keys(spark.createDataFrame([(k,) for k in keys], "k string"), ["k"])
    got = [tuple(r) for r in report.collect()]
    assert got == [("zz", 3), (None, 2), *[(str(i), 2) for i in range(100, 130)]]


def test_gate_says_how_many_keys_it_does_not_show(spark):
    df = spark.range(30).selectExpr("explode(array(id, id)) AS k")
    with pytest.raises(DuplicateKeyError, match="30 keys repeat") as e:
        require_unique({"d": (df, ["k"])})
    assert "and 10 more" in str(e.value) and str(e.value).count("2 rows") == 20
