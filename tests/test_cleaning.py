import pytest

from starflow.functions.numeric_text import parse_number
from starflow.operators import cleaning
from starflow.operators.cleaning import (
    CleaningSpec,
    clean,
    clean_numbers,
    cleaning_metrics,
    drop_duplicate_rows,
    impute,
    invalid_number_counts,
    trim_columns,
)
from starflow.operators.quality import count_copies
from starflow.sources.flat_sales import flat_sales
from pyspark.sql import functions as F

NO_NUMBER = ["?", "n.a.", "", "   ", "nil", "missing", "-", "#N/A", "none yet", "----", "NULL"]
ODD_NUMBERS = ["+5", ".5", "5.", "1e5", "(500)", "₹5", "1 2", "\t5", "5\n", "5.5.5", "--5"]

# text, as double, as bigint
NUMBERS = [
    ("904", 904.0, 904),
    ("60312.75", 60312.75, 60312),
    ("-77", -77.0, -77),
    ("3,04,112", 304112.0, 304112),
    ("1,2,3", 123.0, 123),
    ("  42  ", 42.0, 42),
    ("12.5", 12.5, 12),
    ("-12.9", -12.9, -12),
    ("-0.5", -0.5, 0),
    ("007", 7.0, 7),
    ("9223372036854775807", 9.223372036854776e18, 9223372036854775807),
    ("-9223372036854775808", -9.223372036854776e18, -9223372036854775808),
    ("9223372036854775808", 9.223372036854776e18, None),
    ("12345678901234567890", 1.2345678901234567e19, None),
    (None, None, None),
]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("to", ["double", "bigint"])
def test_text_that_is_not_a_number_becomes_null(spark, ansi, to):
    df = texts(spark, NO_NUMBER + ODD_NUMBERS)
    cleaned = clean_numbers(df, {"value": to})
    assert dict(cleaned.dtypes)["value"] == to
    assert cleaned.where("value IS NOT NULL").count() == 0
    counts = invalid_number_counts(df, ["value"]).collect()
    assert counts == [("value", len(NO_NUMBER + ODD_NUMBERS))]


def test_numbers_in_text(spark, ansi):
    df = texts(spark, [n[0] for n in NUMBERS])
    rows = df.select(
        "value",
        parse_number(F.col("value"), "double").alias("d"),
        parse_number(F.col("value"), "bigint").alias("l"),
    ).collect()
    assert [tuple(r) for r in rows] == NUMBERS
    assert invalid_number_counts(df, ["value"]).collect() == [("value", 0)]


def test_unknown_number_type_is_refused(spark):
    with pytest.raises(ValueError, match="bigint"):
        clean_numbers(texts(spark, ["1"]), {"value": "float"})


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="nope"):
        clean_numbers(texts(spark, ["1"]), {"nope": "double"})


def test_only_exact_repeats_go(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "b "), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "id int, v string")
    assert sorted(drop_duplicate_rows(df).collect(), key=str) == sorted(
        [(1, "a"), (2, "b"), (2, "b "), (None, None)], key=str
    )


def test_impute_fills_null_only(spark):
    df = spark.createDataFrame([("WH1",), (None,), ("",), (" ",)], "w string")
    filled = [r[0] for r in impute(df, {"w": "UNKNOWN"}).collect()]
    assert filled == ["WH1", "UNKNOWN", "", " "]


def test_trim_strips_blanks_not_tabs(spark):
    df = spark.createDataFrame([(" Retail ", " x ")], "a string, b string")
    assert trim_columns(df, ["a"]).first() == ("Retail", " x ")
    tab = spark.createDataFrame([("\tRetail",)], "a string")
    assert trim_columns(tab, ["a"]).first()[0] == "\tRetail"


SPEC = CleaningSpec({"Value Sales": "double"}, {"W.ID": "UNKNOWN"}, ("CAT",))
ROWS = [
    ("1,000", None, "a "),
    ("1,000", None, "a "),
    ("-", "W1", "a"),
    (None, "W2", "b"),
    ("5", None, None),
]


def test_clean_and_metrics_with_odd_column_names(spark, ansi):
    df = spark.createDataFrame(ROWS, "`Value Sales` string, `W.ID` string, CAT string")
    cleaned = clean(df, SPEC)
    assert sorted(map(tuple, cleaned.collect()), key=str) == sorted(
        [(1000.0, "UNKNOWN", "a"), (None, "W1", "a"), (None, "W2", "b"), (5.0, "UNKNOWN", None)],
        key=str,
    )
    assert cleaning_metrics(df, SPEC).first().asDict() == {
        "rows_before": 5,
        "rows_after": 4,
        "duplicates_removed": 1,
        "rows_dropped": 0,
        "invalid_Value Sales": 1,
        "filled_W.ID": 2,
    }


def test_metrics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "`Value Sales` string, `W.ID` string, CAT string")
    assert set(cleaning_metrics(df, SPEC).first()) == {0}


LATE = {
    "empty": [],
    "nulls": [(None, None)] * 3 + [(1, None), (None, "a"), (None, "")],
    "hot": [(7, "hot")] * 500 + [(i % 40, "x" * (i % 3)) for i in range(400)],
    "distinct": [(i, str(i)) for i in range(100)],
}


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("case", LATE)
def test_late_dedup_keeps_the_same_rows(spark, workspace, case, broadcast_bytes):
    df = spark.createDataFrame(LATE[case], "h1 bigint, `row` string").repartition(3)
    found = cleaning.drop_duplicate_rows_late(df, workspace=workspace, broadcast_bytes=broadcast_bytes)
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(set(LATE[case]), key=str)


def test_late_dedup_keeps_rows_that_only_share_a_hash(spark, workspace, monkeypatch):
    monkeypatch.setattr(cleaning.F, "xxhash64", lambda *columns: F.lit(5).cast("bigint"))
    rows = [(1, "a"), (2, "b"), (1, "a"), (2, "b"), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "id bigint, value string")
    found = cleaning.drop_duplicate_rows_late(df, workspace=workspace).collect()
    assert sorted(map(tuple, found), key=str) == sorted(set(rows), key=str)


def test_late_dedup_shuffles_no_wide_rows(spark, workspace):
    """What is read for the rows that stay reaches the output without an exchange but the broadcast."""
    df = spark.range(1000).selectExpr("id % 900 AS id", "repeat('x', 200) AS wide")
    stays = cleaning.drop_duplicate_rows_late(df, workspace=workspace)
    tree = stays._jdf.queryExecution().sparkPlan().toString().split("HashAggregate")[0]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree and "ShuffledHashJoin" not in tree


def _copies(df):
    return sorted(map(str, df.drop("_id").collect()))


def test_store_distinct_counts_as_the_plain_form(spark, workspace):
    rows = [(i, "x" if i % 3 else None, float(i % 7)) for i in range(300)] * 2
    rows += [(None, None, None)] * 500 + [(i, "once", None) for i in range(9000, 14000)] + [(5, "", 0.0), (5, None, 0.0)]
    rows += [(-1, "zero", 0.0), (-1, "zero", -0.0), (-2, "zero", -0.0), (-3, "nan", float("nan")), (-3, "nan", float("nan"))]
    df = spark.createDataFrame(rows, "a int, `b.c` string, row double").repartition(3)
    stored = workspace.store(df, "raw", row_id="_id")
    for limit in (1 << 20, 0):  # the repeats where they lie, and all rows grouped
        got = cleaning.store_distinct(stored, "_id", workspace, broadcast_bytes=limit)
        assert got.columns == [*df.columns, "_copies", "_id"]
        assert _copies(got) == _copies(count_copies(df))
        assert got.select("_id").distinct().count() == got.count()


def test_store_distinct_does_not_rest_on_its_hash(spark, workspace, monkeypatch):
    monkeypatch.setattr(cleaning, "_row_hash", lambda names: F.coalesce(F.col(names[0]) % 5, F.lit(0)).cast("bigint"))
    df = spark.createDataFrame([(i % 40, i % 4) for i in range(120)] + [(None, 1)] * 2, "a int, b int")
    got = cleaning.store_distinct(workspace.store(df, "raw", row_id="_id"), "_id", workspace)
    assert _copies(got) == _copies(count_copies(df))


def test_store_distinct_leaves_out_what_is_unwanted(spark, workspace):
    df = spark.createDataFrame([(i % 50, "t") for i in range(60)], "a int, b string")
    stored = workspace.store(df, "raw", row_id="_id")
    unwanted = stored.where("a in (3, 20)").select("_id")
    for limit in (1 << 20, 0):
        got = cleaning.store_distinct(stored, "_id", workspace, unwanted=unwanted, broadcast_bytes=limit)
        assert {r["a"]: r["_copies"] for r in got.collect()} == {
            a: 2 if a < 10 else 1 for a in range(50) if a not in (3, 20)
        }


def test_store_distinct_of_nothing(spark, workspace):
    stored = workspace.store(spark.createDataFrame([], "a int"), "raw", row_id="_id")
    assert cleaning.store_distinct(stored, "_id", workspace).isEmpty()


def test_texts_of_the_extract_are_not_shuffled_before_its_joins(spark, sf_dir):
    """Long texts that are made of keys stay out of the exchanges; before, every join moved them."""
    plan = flat_sales(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[plan.index("Join") :]
    assert not any(name in joins for name in ("batch_number", "store_id", "supplier_id", "value_sales", "product_id"))


def test_dropping_repeats_shuffles_hashes_in_place_of_rows(spark, workspace):
    """Before, every row was shuffled with all its columns."""
    rows = [(i, f"text {i}") for i in range(500)] + [(7, "text 7")] * 4 + [(8, None)] * 2 + [(8, "")]
    df = spark.createDataFrame(rows, "`a.b` int, row string").repartition(4)
    got = drop_duplicate_rows(df, workspace=workspace)
    assert got.schema == df.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, set(df.collect())))
    alone = got._jdf.queryExecution().sparkPlan().toString().split("HashAggregate")[0]
    assert "Union" in alone and "BroadcastHashJoin" in alone  # rows that occur once come without an aggregation


def test_dropping_repeats_does_not_rest_on_the_hash(spark, workspace, monkeypatch):
    monkeypatch.setattr(cleaning, "_row_hash", lambda names: F.coalesce(F.col(names[0]) % 5, F.lit(0)).cast("bigint"))
    df = spark.createDataFrame([(i % 40, i % 4) for i in range(120)] + [(None, 1)] * 2, "a int, b int")
    for limit in (1 << 20, 0):
        got = drop_duplicate_rows(df, workspace=workspace, broadcast_bytes=limit)
        assert sorted(map(str, got.collect())) == sorted(map(str, df.dropDuplicates().collect()))


def test_dropping_repeats_of_odd_types(spark, workspace):
    zeros = spark.createDataFrame([(0.0, "a"), (-0.0, "a"), (float("nan"), "b"), (float("nan"), "b")], "x double, y string")
    assert drop_duplicate_rows(zeros, workspace=workspace).count() == 2
    lists = spark.createDataFrame([([0.0],), ([-0.0],), (None,), (None,)], "x array<double>")
    assert drop_duplicate_rows(lists, workspace=workspace).count() == lists.dropDuplicates().count() == 2


def test_small_numbers_are_moved_as_one(spark, tmp_path, sf_dir):
    """Numbers of any size come out of the extract as they went in; only small ones share a column."""
    from starflow.sources import flat_sales as source

    values = [(1, 2, 3), (0, 0, 0), (1023, 63, -1), (1024, 1, 1), (-5, 64, 2), (None, 1, 1), (None, None, None), (1 << 40, 1, 0)]
    df = spark.createDataFrame(values, "a bigint, b int, c int")
    numbers = {"a": (F.col("a"), 10), "b": (F.col("b"), 6), "c": (F.col("c"), 2)}
    packed, plain = source._pack(numbers)
    moved = df.select(packed.alias(source._PACKED), plain.alias(source._PLAIN))
    assert moved.where(F.col(source._PACKED).isNotNull()).count() == 2
    assert moved.where(F.col(source._PLAIN).isNotNull()).count() == len(values) - 2
    got = moved.withColumns(source._unpack(numbers)).select("a", "b", "c")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    plan = flat_sales(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[plan.index("Join") :].split("Relation")[0]
    assert "l_extendedprice" not in joins.split("\n")[0]
