"""Derived sales columns. Each operator adds its columns and leaves the rest alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starflow.functions.columns import ref, refs, require_columns
from starflow.functions.sales import quarter_of, risk_level, unit_price, year_month_of
from starflow.operators.rank import dense_rank_in_group

# Names of the derived columns.
QUARTER = "Quarter"
YEAR_MONTH = "YearMonthKey"
UNIT_PRICE = "PricePerUnit"
SALES_RANK = "CategorySalesRank"
RISK_FLAG = "InventoryRiskFlag"


@dataclass(frozen=True)
class FeatureSpec:
    """The columns that play each part."""

    month: str
    year: str
    value: str
    units: str
    group: str
    status: str
    lead_days: str


def add_calendar(df: DataFrame, month: str, year: str) -> DataFrame:
    require_columns(df, [month, year])
    return df.withColumns(
        {QUARTER: quarter_of(ref(month)), YEAR_MONTH: year_month_of(ref(year), ref(month))}
    )


def add_unit_price(df: DataFrame, value: str, units: str) -> DataFrame:
    require_columns(df, [value, units])
    return df.withColumn(UNIT_PRICE, unit_price(ref(value), ref(units)))


def add_sales_rank(df: DataFrame, group: str, value: str, **options) -> DataFrame:
    """See ``dense_rank_in_group`` for the options."""
    return dense_rank_in_group(df, group, value, SALES_RANK, **options)


def add_risk_flag(df: DataFrame, status: str, lead_days: str) -> DataFrame:
    require_columns(df, [status, lead_days])
    return df.withColumn(RISK_FLAG, risk_level(ref(status), ref(lead_days)))


def enrich(df: DataFrame, spec: FeatureSpec, *, row_features: bool = True, **rank_options) -> DataFrame:
    """Add all five derived columns, in the order of ``feature_catalog``.

    Without ``row_features`` price and risk are left to ``add_row_features``, for rows that are still to be moved.
    """
    df = add_calendar(df, spec.month, spec.year)
    df = add_sales_rank(df, spec.group, spec.value, **rank_options)
    return in_order(add_row_features(df, spec)) if row_features else df


def in_order(df: DataFrame) -> DataFrame:
    """The derived columns behind all others, in the order of ``feature_catalog``."""
    names = (QUARTER, YEAR_MONTH, UNIT_PRICE, SALES_RANK, RISK_FLAG)
    return df.select(*refs([c for c in df.columns if c not in names]), *refs(names))


def add_row_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The derived columns that follow from a few cells of the row: ``row_feature_inputs``."""
    df = add_unit_price(df, spec.value, spec.units)
    return add_risk_flag(df, spec.status, spec.lead_days)


def row_feature_inputs(spec: FeatureSpec) -> dict[str, tuple[str, str]]:
    """Each column of ``add_row_features`` and the columns that it is a function of."""
    return {UNIT_PRICE: (spec.value, spec.units), RISK_FLAG: (spec.status, spec.lead_days)}


def feature_catalog(spark: SparkSession, spec: FeatureSpec) -> DataFrame:
    """Rows (name, formula): how each derived column is computed."""
    rows = [
        (QUARTER, f"ceil({spec.month} / 3)"),
        (YEAR_MONTH, f"{spec.year} * 100 + {spec.month}"),
        (UNIT_PRICE, f"{spec.value} / {spec.units} where {spec.units} > 0, else NULL"),
        (SALES_RANK, f"dense rank of {spec.value}, highest first, within {spec.group}"),
        (RISK_FLAG, f"stock running out by {spec.status}, graded by {spec.lead_days}"),
    ]
    return spark.createDataFrame(rows, "name string, formula string")
