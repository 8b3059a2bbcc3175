"""A flat, dirty sales extract made from the normalised order tables.

The order tables are clean, so dirt is added by key arithmetic: thousands commas,
placeholders, zero units, trailing blanks, missing warehouses, repeated rows and
attributes that contradict each other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.sources.contract import ROLES

ORDER_KEY = "l_orderkey"
_PACKED, _PLAIN = "_packed", "_plain"

# The columns used, with their types: no footer has to be read to plan a query.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _pack(numbers: Mapping[str, tuple[Column, int]]) -> tuple[Column, Column]:
    """(all numbers in one bigint, of so many bits each, or NULL; a struct of them as they are, if it is NULL).

    NULL, negative or larger numbers do not fit; such a row keeps its numbers apart.
    """
    fits, packed = F.lit(True), F.lit(0).cast("bigint")
    for value, bits in numbers.values():
        fits = fits & (value >= 0) & (value < 1 << bits)
        packed = F.shiftleft(packed, bits).bitwiseOR(value.cast("bigint"))
    fits = F.coalesce(fits, F.lit(False))
    plain = F.struct(*[value.alias(name) for name, (value, _) in numbers.items()])
    return F.when(fits, packed), F.when(~fits, plain)


def _unpack(numbers: Mapping[str, tuple[Column, int]]) -> dict[str, Column]:
    """The numbers that ``_pack`` moved."""
    out, shift = {}, 0
    for name, (_, bits) in reversed(numbers.items()):
        held = F.shiftright(_PACKED, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        plain = F.col(_PLAIN)[name]
        out[name] = F.when(F.col(_PACKED).isNotNull(), held).otherwise(plain.cast("bigint"))
        shift += bits
    return out


def flat_sales(spark: SparkSession, sf_dir: str, order_key: bool = False) -> DataFrame:
    """The 29 sales columns under their role names, one row per line item, some twice.

    ``order_key`` keeps the order number as a 30th column.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    key = F.col(ORDER_KEY)
    # Only keys and numbers are moved, the small ones as one; texts are made of them behind the last join.
    numbers = {
        "_thousands": (F.floor(F.col("l_extendedprice") / 1000).cast("bigint"), 14),
        "_rest": (F.floor("l_extendedprice").cast("bigint") % 1000, 10),
        "_days": (F.unix_date(F.col("l_shipdate").cast("date")), 16),
        "_qty": (F.col("l_quantity").cast("int"), 10),
        "_line": (F.col("l_linenumber"), 6),
        "_stock": (F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2), 2),
    }
    packed, plain = _pack(numbers)
    lines = table("lineitem").select(
        ORDER_KEY,
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_suppkey").alias("s_suppkey"),
        packed.alias(_PACKED),
        plain.alias(_PLAIN),
    )
    orders = table("orders").select(
        F.col("o_orderkey").alias(ORDER_KEY),
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("sales_channel"),
        F.col("o_orderstatus").alias("order_status"),
    )
    customers = table("customer").select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("store_type")
    )
    parts = table("part").select(
        "p_partkey",
        F.col("p_type").alias("_type"),
        F.col("p_name").alias("segment"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("pack_size"),
    )
    suppliers = table("supplier").select("s_suppkey", "s_nationkey")
    nations = table("nation")
    regions = table("region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
    )
    states = nations.join(regions, "n_regionkey").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"), "region"
    )
    centers = nations.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("distribution_center")
    )
    brand_number = F.substring("brand", 7, 10).cast("int")
    months = F.lit("JanFebMarAprMayJunJulAugSepOctNovDec")
    # Customers are found per order, not per line. The tables come in few row groups; dealt by the
    # part, all tasks work, and what a row has of its part lies beside what others have of it.
    joined = (
        lines.join(orders.join(customers, "c_custkey"), ORDER_KEY)
        .join(parts.hint("merge"), "p_partkey")
        .join(suppliers, "s_suppkey")
        .join(F.broadcast(states), "c_nationkey")
        .join(F.broadcast(centers), "s_nationkey")
        .withColumns(_unpack(numbers))
        .withColumn("_day", F.date_from_unix_date(F.col("_days").cast("int")))
        .withColumns(
            {
                "value_sales": F.when(key % 50 == 0, "-")
                .when(key % 50 == 1, " NA ")
                .when(key % 50 == 2, "")
                .otherwise(
                    F.concat(
                        F.col("_thousands").cast("string"),
                        F.lit(","),
                        F.lpad(F.col("_rest").cast("string"), 3, "0"),
                    )
                ),
                "units_sales": F.when(key % 37 == 0, "0")
                .when(key % 37 == 1, "N/A")
                .otherwise(F.col("_qty").cast("string")),
                "supplier_id": F.concat(F.lit("SUP"), F.col("s_suppkey").cast("string")),
                "batch_number": F.concat(F.lit("B"), key.cast("string")),
                "lot_number": F.concat(F.lit("L"), F.col("_line").cast("string")),
                "lead_days": (F.col("s_suppkey") % 21).cast("int"),
                "warehouse_id": F.when(
                    key % 50 != 7,
                    F.concat(F.lit("WH"), (F.col("s_suppkey") % 10).cast("string")),
                ),
                "inventory_status": F.when(F.col("_stock") == 0, "In Stock")
                .when(F.col("_stock") == 1, "Low Stock")
                .otherwise("Out of Stock"),
                "city": F.concat(F.lit("City_"), (F.col("c_custkey") % 60).cast("string")),
                "store_id": F.concat(F.lit("S"), F.col("c_custkey").cast("string")),
                "manufacturer": F.concat(F.lit("MFR_"), (brand_number % 5).cast("string")),
                "barcode": F.lit(1000000000000) + F.col("p_partkey"),
                "pack_unit": F.when(F.col("pack_size") % 3 == 0, "ML")
                .when(F.col("pack_size") % 3 == 1, "GR")
                .otherwise("EACH"),
                "product_id": F.concat(F.lit("P"), F.col("p_partkey").cast("string")),
                "month_num": F.month("_day"),
                "year": F.year("_day"),
                "month": F.substring(months, F.month("_day") * 3 - 2, F.lit(3)),
                "category": F.when(
                    key % 11 == 0, F.concat(F.col("_type"), F.lit(" "))
                ).otherwise(F.col("_type")),
                "data_source": F.lit("POS"),
                "ingestion_timestamp": F.lit("2024-01-01T00:00:00"),
                "_copy": F.explode(
                    F.when(key % 40 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
                        F.array(F.lit(1))
                    )
                ),
            }
        )
    )
    return joined.select(*ROLES, *([ORDER_KEY] if order_key else []))
