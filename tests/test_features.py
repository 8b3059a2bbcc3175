import pytest

from starflow.operators import features as feat
from starflow.operators.features import (
    FeatureSpec,
    add_calendar,
    add_risk_flag,
    add_unit_price,
    enrich,
    feature_catalog,
)


@pytest.mark.parametrize(
    "month, year, quarter, year_month",
    [
        (1, 2022, 1, 202201),
        (3, 2022, 1, 202203),
        (4, 2022, 2, 202204),
        (12, 2021, 4, 202112),
        (0, 2022, 0, 202200),
        (13, 2022, 5, 202213),
        (None, 2022, None, None),
        (5, None, 2, None),
    ],
)
def test_calendar(spark, month, year, quarter, year_month):
    df = spark.createDataFrame([(month, year)], "m int, y int")
    row = add_calendar(df, "m", "y").first()
    assert (row[feat.QUARTER], row[feat.YEAR_MONTH]) == (quarter, year_month)
    assert dict(add_calendar(df, "m", "y").dtypes)[feat.QUARTER] == "int"


@pytest.mark.parametrize(
    "value, units, price",
    [
        (1000.0, 50, 20.0),
        (1000.0, 0, None),
        (1000.0, -5, None),
        (1000.0, None, None),
        (None, 5, None),
        (0.0, 5, 0.0),
    ],
)
def test_unit_price(spark, ansi, value, units, price):
    df = spark.createDataFrame([(value, units)], "v double, u bigint")
    assert add_unit_price(df, "v", "u").first()[feat.UNIT_PRICE] == price


@pytest.mark.parametrize(
    "status, lead, flag",
    [
        ("Low Stock", 15, "High Risk"),
        ("Out of Stock", 10, "High Risk"),
        ("Low Stock", 9, "Watch"),
        ("Out of Stock", 3, "Watch"),
        ("Low Stock", None, "Watch"),
        ("In Stock", 30, "Normal"),
        ("low stock", 30, "Normal"),
        (None, 30, "Normal"),
        (None, None, "Normal"),
    ],
)
def test_risk_flag(spark, status, lead, flag):
    df = spark.createDataFrame([(status, lead)], "s string, l int")
    assert add_risk_flag(df, "s", "l").first()[feat.RISK_FLAG] == flag


SPEC = FeatureSpec("Month #", "Year", "Value Sales", "Units Sales", "CATEGORY", "STATUS", "LEAD")
SCHEMA = (
    "`Month #` int, Year int, `Value Sales` double, `Units Sales` bigint, CATEGORY string, "
    "STATUS string, LEAD int"
)


def test_enrich_adds_five_columns_and_no_row(spark):
    df = spark.createDataFrame(
        [(4, 2022, 1000.0, 50, "Dairy", "Low Stock", 15), (5, 2022, 2000.0, 0, "Dairy", None, None)],
        SCHEMA,
    )
    rows = enrich(df, SPEC).orderBy("`Month #`").collect()
    added = [feat.QUARTER, feat.YEAR_MONTH, feat.UNIT_PRICE, feat.SALES_RANK, feat.RISK_FLAG]
    assert rows[0].__fields__ == df.columns + added
    assert [r[feat.SALES_RANK] for r in rows] == [2, 1]
    assert [tuple(r[c] for c in added) for r in rows] == [
        (2, 202204, 20.0, 2, "High Risk"),
        (2, 202205, None, 1, "Normal"),
    ]


def test_catalog_names_the_added_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    names = [r["name"] for r in feature_catalog(spark, SPEC).collect()]
    assert names == [c for c in enrich(df, SPEC).columns if c not in df.columns]
