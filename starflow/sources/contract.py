"""The schema contract of a source, and the one of the retail sales extract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.functions.columns import normalize_name, require_columns
from starflow.operators.quality import null_profile


@dataclass(frozen=True)
class SchemaContract:
    """Names and types a source must have, and the columns that may not be NULL.

    Spark makes every column of a file source nullable, so ``required`` is checked on
    the data by ``missing_required``, not by the reader.
    """

    schema: T.StructType
    required: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return self.schema.names


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim column names and collapse blanks in them, all in one projection."""
    names = [normalize_name(n) for n in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide once normalised: {clashes}")
    return df.toDF(*names)


def missing_required(
    df: DataFrame, contract: SchemaContract, weight: str | None = None
) -> DataFrame:
    """Rows (column, null_count) for required columns that hold NULLs."""
    require_columns(df, contract.required)
    profile = null_profile(df, columns=contract.required, weight=weight)
    return profile.where(F.col("null_count") > 0).select("column", "null_count")


# The 29 columns of the sales extract, as (role, column name, type).
# Every column but the warehouse is required.
SALES_COLUMNS = (
    ("month_num", "Month #", "int"),
    ("month", "Month", "string"),
    ("year", "Year", "int"),
    ("store_type", "STORE TYPE", "string"),
    ("category", "CATEGORY", "string"),
    ("segment", "SEGMENT", "string"),
    ("manufacturer", "MANUFACTURER_1", "string"),
    ("brand", "BRAND_2", "string"),
    ("barcode", "BARCODE", "bigint"),
    ("pack_size", "PACK SIZE", "int"),
    ("pack_unit", "PACK unit", "string"),
    ("value_sales", "Value Sales", "string"),
    ("units_sales", "Units Sales", "string"),
    ("region", "REGION", "string"),
    ("state", "STATE", "string"),
    ("city", "CITY", "string"),
    ("store_id", "STORE_ID", "string"),
    ("product_id", "PRODUCT_ID", "string"),
    ("supplier_id", "SUPPLIER_ID", "string"),
    ("distribution_center", "DISTRIBUTION_CENTER", "string"),
    ("sales_channel", "SALES_CHANNEL", "string"),
    ("batch_number", "BATCH_NUMBER", "string"),
    ("lot_number", "LOT_NUMBER", "string"),
    ("lead_days", "SUPPLIER_LEAD_TIME_DAYS", "int"),
    ("warehouse_id", "WAREHOUSE_ID", "string"),
    ("inventory_status", "INVENTORY_STATUS", "string"),
    ("order_status", "ORDER_STATUS", "string"),
    ("data_source", "DATA_SOURCE", "string"),
    ("ingestion_timestamp", "INGESTION_TIMESTAMP", "string"),
)
OPTIONAL_ROLES = ("warehouse_id",)
ROLES = tuple(role for role, _, _ in SALES_COLUMNS)


def sales_contract(short_names: bool = False) -> SchemaContract:
    """The sales contract under its file names, or under the role names."""
    types = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType()}
    fields, required = [], []
    for role, name, kind in SALES_COLUMNS:
        column = role if short_names else name
        fields.append(T.StructField(column, types[kind], True))
        if role not in OPTIONAL_ROLES:
            required.append(column)
    return SchemaContract(T.StructType(fields), tuple(required))


def column_names(short_names: bool = False) -> dict[str, str]:
    """Role to column name."""
    return {role: role if short_names else name for role, name, _ in SALES_COLUMNS}


def check_header(header: Sequence[str], contract: SchemaContract) -> list[str]:
    """Normalised header names in file order; raises if they are not the contract's."""
    names = [normalize_name(h) for h in header]
    missing = [n for n in contract.names if n not in names]
    extra = [n for n in names if n not in contract.names]
    if missing or extra or len(set(names)) != len(names):
        raise ValueError(f"header does not fit the contract: missing {missing}, extra {extra}")
    return names
