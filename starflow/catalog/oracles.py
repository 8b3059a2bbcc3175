"""The same answers in SQL, written for DuckDB over the same tables."""

from __future__ import annotations

# Written out here, so that a mistake in the library's own tables shows.
PROFILE_LIMIT_PCT = 1.5
TOP_N = 3
SALES_COLUMNS = (
    ("month_num", "int"), ("month", "string"), ("year", "int"), ("store_type", "string"),
    ("category", "string"), ("segment", "string"), ("manufacturer", "string"),
    ("brand", "string"), ("barcode", "bigint"), ("pack_size", "int"), ("pack_unit", "string"),
    ("value_sales", "string"), ("units_sales", "string"), ("region", "string"),
    ("state", "string"), ("city", "string"), ("store_id", "string"), ("product_id", "string"),
    ("supplier_id", "string"), ("distribution_center", "string"), ("sales_channel", "string"),
    ("batch_number", "string"), ("lot_number", "string"), ("lead_days", "int"),
    ("warehouse_id", "string"), ("inventory_status", "string"), ("order_status", "string"),
    ("data_source", "string"), ("ingestion_timestamp", "string"),
)
ROLES = tuple(role for role, _ in SALES_COLUMNS)
# Fixed value: the columns that are trimmed.
TRIMMED = (
    "store_type", "category", "segment", "manufacturer", "brand", "region",
    "state", "city", "sales_channel", "inventory_status", "order_status",
)
DIMENSIONS = (
    ("dim_date", "date_key", ("year", "month_num"), ("month", "Quarter", "YearMonthKey")),
    ("dim_geography", "geography_key", ("city",), ("state", "region")),
    ("dim_store", "store_key", ("store_id",), ("store_type", "sales_channel")),
    ("dim_product", "product_key", ("product_id",),
     ("barcode", "category", "segment", "manufacturer", "brand", "pack_size", "pack_unit")),
    ("dim_supplier", "supplier_key", ("supplier_id",), ("distribution_center",)),
    ("dim_warehouse", "warehouse_key", ("warehouse_id",), ()),
)

LINES = """
lines AS (
 SELECT CAST(month(l_shipdate) AS INT) AS month_num,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec',
         CAST(month(l_shipdate) AS INT) * 3 - 2, 3) AS month,
  CAST(year(l_shipdate) AS INT) AS year, c_mktsegment AS store_type,
  CASE WHEN l_orderkey % 11 = 0 THEN concat(p_type, ' ') ELSE p_type END AS category,
  p_name AS segment,
  concat('MFR_', CAST(CAST(substr(p_brand, 7) AS INT) % 5 AS VARCHAR)) AS manufacturer,
  p_brand AS brand, CAST(1000000000000 + p_partkey AS BIGINT) AS barcode,
  p_size AS pack_size,
  CASE p_size % 3 WHEN 0 THEN 'ML' WHEN 1 THEN 'GR' ELSE 'EACH' END AS pack_unit,
  CASE WHEN l_orderkey % 50 = 0 THEN '-' WHEN l_orderkey % 50 = 1 THEN ' NA '
       WHEN l_orderkey % 50 = 2 THEN ''
       ELSE concat(CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR), ',',
                   lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0'))
  END AS value_sales,
  CASE WHEN l_orderkey % 37 = 0 THEN '0' WHEN l_orderkey % 37 = 1 THEN 'N/A'
       ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS units_sales,
  r_name AS region, cn.n_name AS state,
  concat('City_', CAST(c_custkey % 60 AS VARCHAR)) AS city,
  concat('S', CAST(c_custkey AS VARCHAR)) AS store_id,
  concat('P', CAST(p_partkey AS VARCHAR)) AS product_id,
  concat('SUP', CAST(l_suppkey AS VARCHAR)) AS supplier_id,
  sn.n_name AS distribution_center, o_orderpriority AS sales_channel,
  concat('B', CAST(l_orderkey AS VARCHAR)) AS batch_number,
  concat('L', CAST(l_linenumber AS VARCHAR)) AS lot_number,
  CAST(l_suppkey % 21 AS INT) AS lead_days,
  CASE WHEN l_orderkey % 50 = 7 THEN NULL
       ELSE concat('WH', CAST(l_suppkey % 10 AS VARCHAR)) END AS warehouse_id,
  CASE l_returnflag WHEN 'A' THEN 'In Stock' WHEN 'N' THEN 'Low Stock'
       ELSE 'Out of Stock' END AS inventory_status,
  o_orderstatus AS order_status, 'POS' AS data_source,
  '2024-01-01T00:00:00' AS ingestion_timestamp, l_orderkey
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
 JOIN region ON cn.n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
 JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey),
keyed AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_orderkey % 40 = 0),
flat AS (SELECT * EXCLUDE (l_orderkey) FROM keyed),
uniq AS (SELECT DISTINCT * FROM flat)"""


def bare(column: str) -> str:
    return f"replace(trim({column}, ' '), ',', '')"


def is_number(column: str) -> str:
    return f"regexp_full_match({bare(column)}, '-?\\d+(\\.\\d+)?')"


def as_double(column: str) -> str:
    return f"CASE WHEN {is_number(column)} THEN TRY_CAST({bare(column)} AS DOUBLE) END"


def as_bigint(column: str) -> str:
    whole = f"regexp_extract({bare(column)}, '^-?\\d+')"
    return f"CASE WHEN {is_number(column)} THEN TRY_CAST({whole} AS BIGINT) END"


def invalid(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NOT NULL AND NOT {is_number(column)})"


TRIMS = ", ".join(f"trim({c}, ' ') AS {c}" for c in TRIMMED)
CLEAN_CELLS = f"""* REPLACE (
  {as_double('value_sales')} AS value_sales, {as_bigint('units_sales')} AS units_sales,
  coalesce(warehouse_id, 'UNKNOWN') AS warehouse_id, {TRIMS})"""
CLEAN = f"""
cells AS (SELECT {CLEAN_CELLS} FROM flat),
clean AS (SELECT {CLEAN_CELLS} FROM uniq)"""

CALENDAR = """CAST(ceil(month_num / 3.0) AS INT) AS "Quarter",
  CAST(year * 100 + month_num AS INT) AS "YearMonthKey\""""
PRICE = """CASE WHEN units_sales > 0 THEN value_sales / units_sales END AS "PricePerUnit\""""
RANK = """CAST(dense_rank() OVER (PARTITION BY category ORDER BY value_sales DESC NULLS LAST)
  AS INT) AS "CategorySalesRank\""""
RISK = """CASE WHEN inventory_status IN ('Out of Stock', 'Low Stock') AND lead_days >= 10
       THEN 'High Risk' WHEN inventory_status IN ('Out of Stock', 'Low Stock') THEN 'Watch'
       ELSE 'Normal' END AS "InventoryRiskFlag\""""
ENRICHED = f"""
enriched AS (SELECT *, {CALENDAR}, {PRICE}, {RANK}, {RISK} FROM clean)"""


def quoted(name: str) -> str:
    return f'"{name}"'


def dimension(name: str, source: str = "enriched") -> str:
    """Surrogate keys by natural-key order, smallest attribute value per key."""
    _, key, natural, attributes = next(d for d in DIMENSIONS if d[0] == name)
    keys = ", ".join(natural)
    picked = "".join(f", min({quoted(a)}) AS {quoted(a)}" for a in attributes)
    order = ", ".join(f"{k} NULLS FIRST" for k in natural)
    outer = "".join(f", {quoted(a)}" for a in attributes)
    return (
        f"SELECT row_number() OVER (ORDER BY {order}) AS {key}, {keys}{outer} "
        f"FROM (SELECT {keys}{picked} FROM {source} GROUP BY {keys})"
    )


DIMS = "".join(f",\n{d[0]} AS ({dimension(d[0])})" for d in DIMENSIONS)
FACT_BODY = """date_key, geography_key, store_key, product_key, supplier_key, warehouse_key,
  value_sales, units_sales, lead_days AS supplier_lead_time_days, inventory_status,
  order_status, "PricePerUnit", "CategorySalesRank", "InventoryRiskFlag", batch_number,
  lot_number"""
FACT = f""",
fact AS (SELECT {FACT_BODY} FROM enriched
 LEFT JOIN (SELECT year, month_num, date_key FROM dim_date) USING (year, month_num)
 LEFT JOIN (SELECT city, geography_key FROM dim_geography) USING (city)
 LEFT JOIN (SELECT store_id, store_key FROM dim_store) USING (store_id)
 LEFT JOIN (SELECT product_id, product_key FROM dim_product) USING (product_id)
 LEFT JOIN (SELECT supplier_id, supplier_key FROM dim_supplier) USING (supplier_id)
 LEFT JOIN (SELECT warehouse_id, warehouse_key FROM dim_warehouse) USING (warehouse_id))"""

ON_FLAT = f"WITH {LINES}\n"
ON_CELLS = f"WITH {LINES},{CLEAN}\n"
ON_ENRICHED = f"WITH {LINES},{CLEAN},{ENRICHED}\n"
ON_STAR = f"WITH {LINES},{CLEAN},{ENRICHED}{DIMS}{FACT}\n"
IDS = "batch_number, lot_number, product_id, supplier_id"
FLAT_NAMES = ", ".join(ROLES)
CSV_CELLS = ", ".join(
    f"nullif({role}, '') AS {role}" if kind == "string" else role
    for role, kind in SALES_COLUMNS
)
# The dirty lines as a lenient reader sees them: cut lines end behind the lot number, a text
# in place of the pack size is NULL.
BEHIND_LOT = ROLES[ROLES.index("lot_number") + 1 :]


def _line_cell(role: str, kind: str) -> str:
    cell = f"nullif({role}, '')" if kind == "string" else role
    if role in BEHIND_LOT:
        return f"CASE WHEN l_orderkey % 97 <> 0 THEN {cell} END AS {role}"
    if role == "pack_size":
        return f"CASE WHEN l_orderkey % 97 <> 1 THEN {cell} END AS {role}"
    return f"{cell} AS {role}"


KEPT_LINES = ", ".join(_line_cell(role, kind) for role, kind in SALES_COLUMNS)
# The awkward texts of the CSV round trip, as DuckDB literals.
AWKWARD = (
    "concat('one', chr(10), 'two')", "'say \"so\"'", "'back\\slash'", "'\\\"'", "'a,b'", "''",
    "' blanks '", "chr(10)", "'\"'", "concat('x\\', chr(10), 'y')",
)
AWKWARD_TEXT = f"list_extract([{', '.join(AWKWARD)}], n % {len(AWKWARD)} + 1)"
AWKWARD_CELLS = ", ".join(
    f"CASE WHEN n % 7 = 0 THEN {AWKWARD_TEXT} WHEN n % 7 <> 1 THEN concat({c}, {AWKWARD_TEXT}) "
    f"END AS {c}"
    for c in ("order_status", "lot_number", "store_id", "supplier_id")
)
# The same star from the dirty lines.
FROM_LINES = (
    f"WITH {LINES.replace('uniq AS (SELECT DISTINCT * FROM flat)', '')}"
    f"uniq AS (SELECT DISTINCT {KEPT_LINES} FROM keyed),{CLEAN},{ENRICHED}{DIMS}{FACT}\n"
)


def profile(columns: list[str], source: str, limit: float) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {quoted(c)} IS NULL) AS null_count, "
        f"count(*) AS total FROM {source}"
        for c in columns
    ]
    return (
        'SELECT "column", null_count, CAST(null_pct AS DOUBLE) AS null_pct, '
        f"null_pct > {limit} AS breach FROM (SELECT \"column\", null_count, "
        "CASE WHEN total > 0 THEN round(null_count * 100.0::DOUBLE / total, 2) ELSE 0 END "
        f"AS null_pct FROM ({' UNION ALL '.join(parts)}))"
    )


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
NULL_LIST = "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ROLES
)
STAR_TABLES = ["fact", *[d[0] for d in DIMENSIONS]]
FACT_WIDTH = 17


def table_rows(extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{'fact_sales' if t == 'fact' else t}' AS \"table\", "
        f"count(*) AS rows{extra.format(t=t)} FROM {t}"
        for t in STAR_TABLES
    )


def _widths() -> str:
    widths = {"fact": FACT_WIDTH, **{d[0]: 1 + len(d[2]) + len(d[3]) for d in DIMENSIONS}}
    return " UNION ALL ".join(
        f"SELECT '{'fact_sales' if t == 'fact' else t}' AS \"table\", count(*) AS rows, "
        f"CAST({w} AS INT) AS columns FROM {t}"
        for t, w in widths.items()
    )


def metrics(rows: str = "flat", distinct: str = "uniq") -> str:
    return f"""SELECT (SELECT count(*) FROM {rows}) AS rows_before, count(*) AS rows_after,
 (SELECT count(*) FROM {rows}) - count(*) AS duplicates_removed,
 CAST(0 AS BIGINT) AS rows_dropped, {invalid('value_sales')} AS invalid_value_sales,
 {invalid('units_sales')} AS invalid_units_sales,
 count(*) FILTER (WHERE warehouse_id IS NULL) AS filled_warehouse_id FROM {distinct}"""


def summary(written: int, set_aside: str) -> str:
    return f"""SELECT CAST(rows_before + {set_aside} AS BIGINT) AS rows_loaded, rows_after,
 duplicates_removed, CAST({set_aside} AS BIGINT) AS rows_dropped,
 filled_warehouse_id AS nulls_filled, invalid_value_sales + invalid_units_sales
 AS invalid_numbers, CAST(6 AS INT) AS dimension_tables, CAST(1 AS INT) AS fact_tables,
 CAST({written} AS INT) AS tables_written, CAST({set_aside} AS BIGINT) AS rows_quarantined
 FROM metrics"""

UNMATCHED = """SELECT 'dim_warehouse' AS dim, count(*) AS rows, {n} AS unmatched_rows FROM flat
UNION ALL SELECT 'dim_supplier', count(*), CAST(0 AS BIGINT) FROM flat"""

BREACHING = profile(list(ROLES), "flat", PROFILE_LIMIT_PCT)

ORACLES: dict[str, str] = {
    "contract_csv_scan": ON_FLAT + f"SELECT {CSV_CELLS} FROM flat",
    "csv_scan_by_header": ON_FLAT + f"SELECT {CSV_CELLS} FROM flat",
    "required_columns": ON_FLAT
    + f", csv AS (SELECT {CSV_CELLS} FROM flat) "
    + 'SELECT "column", null_count FROM ('
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM csv"
        for c in ROLES
        if c != "warehouse_id"
    )
    + ") WHERE null_count > 0",
    "normalize_columns": ON_FLAT
    + "SELECT "
    + ", ".join(f'{c} AS "{c.replace("_", " ")}"' for c in ROLES)
    + " FROM flat",
    "quarantine_malformed": ON_FLAT
    + "SELECT batch_number, lot_number, count(*) AS rows FROM keyed "
    "WHERE l_orderkey % 97 IN (0, 1) GROUP BY batch_number, lot_number",
    "row_count": ON_FLAT + "SELECT count(*) AS total_rows FROM flat",
    "null_profile": ON_FLAT + BREACHING,
    "duplicate_row_count": ON_FLAT
    + "SELECT (SELECT count(*) FROM flat) AS total_rows, count(*) AS distinct_rows, "
    "(SELECT count(*) FROM flat) - count(*) AS duplicate_rows FROM uniq",
    "quality_report": ON_FLAT
    + f", profile AS ({BREACHING}) "
    + """SELECT (SELECT count(*) FROM flat) AS total_rows,
 (SELECT count(*) FROM flat) - (SELECT count(*) FROM uniq) AS duplicate_rows,
 coalesce(string_agg("column", ',') FILTER (WHERE breach), '') AS breaching_columns,
 CAST(count(*) FILTER (WHERE breach) AS INT) AS n_breaching,
 count(*) FILTER (WHERE breach) = 0 AS passed FROM profile""",
    "events_profile": profile(EVENT_COLUMNS, "events", 5.0),
    "dedup_rows": ON_FLAT + "SELECT * FROM uniq",
    "clean_numeric_value": ON_FLAT
    + f"SELECT {IDS}, {as_double('value_sales')} AS value_sales FROM flat",
    "clean_numeric_units": ON_FLAT
    + f"SELECT {IDS}, {as_bigint('units_sales')} AS units_sales FROM flat",
    "invalid_numeric_counts": ON_FLAT
    + f"SELECT 'value_sales' AS \"column\", {invalid('value_sales')} AS invalid_count FROM flat "
    + f"UNION ALL SELECT 'units_sales', {invalid('units_sales')} FROM flat",
    "impute_missing": ON_FLAT
    + "SELECT coalesce(warehouse_id, 'UNKNOWN') AS warehouse_id, count(*) AS rows "
    "FROM flat GROUP BY 1",
    "standardize_strings": ON_FLAT
    + "SELECT trim(category, ' ') AS category, count(*) AS rows FROM flat GROUP BY 1",
    "clean_sales": ON_CELLS + "SELECT * FROM clean",
    "cleaning_metrics": ON_FLAT + metrics(),
    "calendar_features": ON_FLAT + f"SELECT DISTINCT year, month_num, {CALENDAR} FROM flat",
    "price_per_unit": ON_CELLS + f"SELECT {IDS}, {PRICE} FROM cells",
    "category_sales_rank": ON_CELLS
    + f"SELECT {IDS}, category, value_sales, {RANK} FROM cells",
    "category_sales_rank_pairs": ON_CELLS
    + f"SELECT {IDS}, category, value_sales, {RANK} FROM cells",
    "category_top_n": ON_CELLS
    + f'SELECT * FROM (SELECT {IDS}, category, value_sales, {RANK} FROM cells) '
    + f'WHERE "CategorySalesRank" <= {TOP_N}',
    "events_rank": """SELECT event_id, event_type, value, CAST(dense_rank() OVER (
 PARTITION BY event_type ORDER BY value DESC NULLS LAST) AS INT) AS value_rank FROM events""",
    "inventory_risk_flag": ON_CELLS
    + f"SELECT inventory_status, lead_days, {RISK}, count(*) AS rows FROM cells GROUP BY 1, 2, 3",
    "enrich_sales": ON_ENRICHED + "SELECT * FROM enriched",
    **{d[0]: ON_ENRICHED + dimension(d[0]) for d in DIMENSIONS},
    "dim_store_first_by_batch": ON_CELLS
    + """SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_type,
 sales_channel FROM (SELECT store_id,
  arg_min(store_type, (batch_number LIKE '%3', batch_number, store_type)) AS store_type,
  arg_min(sales_channel, (batch_number LIKE '%3', batch_number, sales_channel)) AS sales_channel
 FROM (SELECT * REPLACE (CASE WHEN batch_number LIKE '%3' THEN 'B3' ELSE batch_number END
   AS batch_number) FROM cells) GROUP BY store_id)""",
    "dim_product_hash": ON_CELLS
    + """SELECT product_id, min(category) AS category, min(brand) AS brand,
 CAST(1 AS BIGINT) AS key_members FROM cells GROUP BY product_id""",
    "dimension_uniqueness": ON_STAR
    + " UNION ALL ".join(
        f"SELECT '{d[0]}' AS dim, count(*) AS rows, "
        f"count(DISTINCT ({', '.join(d[2])})) AS distinct_keys, "
        f"count(*) = count(DISTINCT ({', '.join(d[2])})) AS passed FROM {d[0]}"
        for d in DIMENSIONS
    ),
    "duplicate_natural_keys": ON_FLAT
    + "SELECT product_id, count(*) AS rows FROM flat GROUP BY product_id "
    "HAVING count(*) > 1",
    "duplicate_natural_keys_all": ON_FLAT
    + "SELECT city, state, count(*) AS rows FROM flat GROUP BY city, state HAVING count(*) > 1",
    "fact_sales": ON_STAR + "SELECT * FROM fact",
    "fact_sales_shuffled": ON_STAR + "SELECT * FROM fact",
    "fact_sales_ordered": ON_STAR
    + "SELECT row_number() OVER (ORDER BY "
    + ", ".join(
        f"{c} NULLS FIRST"
        for c in FACT_BODY.replace("lead_days AS ", "").replace("\n", " ").split(",")
    )
    + ") AS sale_key, * FROM fact",
    "sale_key_unique": ON_STAR
    + "SELECT count(*) AS rows, count(*) AS distinct_keys FROM fact",
    "unmatched_keys": ON_FLAT
    + UNMATCHED.format(n="count(*) FILTER (WHERE warehouse_id IS NULL)"),
    "null_safe_keys": ON_FLAT + UNMATCHED.format(n="CAST(0 AS BIGINT)"),
    "star_manifest": ON_STAR + _widths(),
    "curated_roundtrip": ON_STAR + "SELECT * FROM fact",
    "curated_roundtrip_csv": ON_FLAT
    + f""", awkward AS (SELECT * REPLACE ({AWKWARD_CELLS}) FROM
  (SELECT *, CAST(substr(batch_number, 2) AS BIGINT) AS n FROM flat)),
 awkward_uniq AS (SELECT DISTINCT * EXCLUDE (n) FROM awkward)
 SELECT trim(order_status, ' ') AS order_status, lot_number, store_id, supplier_id,
  {as_double('value_sales')} AS value_sales, {as_bigint('units_sales')} AS units_sales
 FROM awkward_uniq""",
    "export_manifest": ON_STAR + table_rows(", count(*) AS rows_read, true AS has_bytes"),
    "run_summary": ON_FLAT + f", metrics AS ({metrics()}) " + summary(7, "0"),
    "run_summary_from_csv": ON_FLAT
    + f""", kept AS (SELECT {KEPT_LINES} FROM keyed),
 kept_uniq AS (SELECT DISTINCT * FROM kept), metrics AS ({metrics('kept', 'kept_uniq')}) """
    + summary(0, "0"),
    "fact_from_csv": FROM_LINES + "SELECT * FROM fact",
    "quarantine_written": ON_FLAT
    + "SELECT batch_number, lot_number, count(*) AS lines FROM keyed "
    "WHERE l_orderkey % 97 IN (0, 1) GROUP BY l_orderkey, batch_number, lot_number, "
    + ", ".join(r for r in ROLES if r not in ("batch_number", "lot_number")),
    "run_missing_required": ON_FLAT
    + f", kept AS (SELECT {KEPT_LINES} FROM keyed) "
    + 'SELECT "column", null_count FROM ('
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM kept"
        for c in ROLES
        if c != "warehouse_id"
    )
    + ") WHERE null_count > 0",
    "run_summary_quarantined": ON_FLAT
    + f""", good AS (SELECT {CSV_CELLS} FROM keyed WHERE l_orderkey % 97 NOT IN (0, 1)),
 good_uniq AS (SELECT DISTINCT * FROM good), metrics AS ({metrics('good', 'good_uniq')}) """
    + summary(0, "(SELECT count(*) FROM flat) - (SELECT count(*) FROM good)"),
    # From the flat rows, not through keys: category is that of the product, the quarter
    # that of the date.
    "star_rollup": ON_ENRICHED
    + """SELECT category, "Quarter" AS quarter,
 CAST(sum(CAST(value_sales AS DECIMAL(18, 2))) AS DOUBLE) AS value_sales,
 CAST(sum(units_sales) AS BIGINT) AS units_sales,
 CASE WHEN sum(units_sales) > 0 THEN
  CAST(sum(CAST(value_sales AS DECIMAL(18, 2))) AS DOUBLE) / CAST(sum(units_sales) AS BIGINT)
 END AS price_per_unit FROM enriched GROUP BY 1, 2""",
}

# Cells as they come back from CSV files, where the empty text is NULL.
FROM_CSV = (
    f"WITH {LINES.replace('uniq AS (SELECT DISTINCT * FROM flat)', '')}"
    f"uniq AS (SELECT DISTINCT {CSV_CELLS} FROM keyed),{CLEAN},{ENRICHED}\n"
)
FACT_COLUMNS = FACT_BODY.partition("value_sales")
NATURAL = ", ".join(k for d in DIMENSIONS for k in d[2])


def _load(number: int, rows: str, before: str) -> str:
    """What one load of two brings."""
    return f"""SELECT CAST({number} AS INT) AS load,
 (SELECT count(*) FROM ({rows})) AS rows_loaded, count(*) AS rows_added,
 (SELECT count(*) FROM ({rows})) - count(*) AS repeats,
 {invalid('value_sales')} AS invalid_value_sales, {invalid('units_sales')} AS invalid_units_sales,
 count(*) FILTER (WHERE warehouse_id IS NULL) AS filled_warehouse_id
 FROM (SELECT DISTINCT {CSV_CELLS} FROM ({rows}) EXCEPT SELECT DISTINCT {CSV_CELLS} FROM ({before}))"""


FIRST_HALF = "SELECT * FROM keyed WHERE l_orderkey % 2 = 0"
SECOND_HALF = "SELECT * FROM keyed WHERE l_orderkey % 2 = 1 OR l_orderkey % 20 = 0"
VERSIONS = """
states AS (SELECT store_id, "YearMonthKey", min(store_type) AS store_type,
  min(sales_channel) AS sales_channel FROM observed GROUP BY ALL),
changes AS (SELECT *, lag((store_type, sales_channel)) OVER w IS DISTINCT FROM
  (store_type, sales_channel) AS changed FROM states
  WINDOW w AS (PARTITION BY store_id ORDER BY "YearMonthKey")),
versions AS (SELECT row_number() OVER (ORDER BY store_id NULLS FIRST, "YearMonthKey")
   AS store_version_key, store_id, store_type, sales_channel, "YearMonthKey" AS valid_from,
  lead("YearMonthKey") OVER w AS valid_to, CAST(row_number() OVER w AS INT) AS version
  FROM changes WHERE changed WINDOW w AS (PARTITION BY store_id ORDER BY "YearMonthKey"))"""
DATED = f"dated AS (SELECT {CLEAN_CELLS}, {CALENDAR} FROM keyed)"

ORACLES |= {
    "incremental_fact": FROM_CSV
    + f"SELECT {NATURAL}, {FACT_COLUMNS[1]}{FACT_COLUMNS[2]} FROM enriched",
    "incremental_loads": ON_FLAT.rstrip()
    + "\n"
    + _load(1, FIRST_HALF, "SELECT * FROM keyed WHERE false")
    + " UNION ALL "
    + _load(2, SECOND_HALF, FIRST_HALF),
    "incremental_dim_store": FROM_CSV.rstrip()
    + """, first_load AS (SELECT DISTINCT concat('S', CAST(o_custkey AS VARCHAR)) AS store_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 2 = 0)
 SELECT row_number() OVER (ORDER BY f.store_id IS NULL, s.store_id) AS store_key, s.store_id,
  s.store_type, s.sales_channel FROM (SELECT store_id, min(store_type) AS store_type,
  min(sales_channel) AS sales_channel FROM enriched GROUP BY 1) s
 LEFT JOIN first_load f USING (store_id)""",
    "stable_product_keys": ON_FLAT.rstrip()
    + """, seen AS (SELECT product_id, bool_or(l_orderkey % 97 = 5) AS early FROM keyed GROUP BY 1)
 SELECT row_number() OVER (ORDER BY NOT early, product_id) AS product_key, product_id,
  CAST(CASE WHEN early THEN 1 ELSE 2 END AS INT) AS load FROM seen""",
    "store_history": ON_FLAT.rstrip()
    + f""", {DATED}, observed AS (SELECT * FROM dated),{VERSIONS}
 SELECT *, valid_to IS NULL AS is_current FROM versions""",
    "fact_as_of": ON_FLAT.rstrip()
    + f""", {DATED}, observed AS (SELECT * FROM dated WHERE l_orderkey % 3 = 0),{VERSIONS}
 SELECT {', '.join('d.' + c for c in IDS.split(', '))}, d.store_id, d."YearMonthKey",
  v.store_version_key, v.store_type, v.sales_channel, v.version
 FROM dated d ASOF LEFT JOIN versions v
 ON d.store_id = v.store_id AND d."YearMonthKey" >= v.valid_from""",
    "published_fact": ON_STAR + "SELECT * FROM fact",
}

BAD = {
    **{c: ("l_orderkey % 97 = 0", "missing cell", "NULL::VARCHAR") for c in BEHIND_LOT},
    "pack_size": ("l_orderkey % 97 = 1", "not int", "'x'"),
}
BAD_CELLS = " UNION ALL ".join(
    f"SELECT batch_number, lot_number, '{c}' AS \"column\", {text} AS text, '{reason}' AS reason "
    f"FROM keyed WHERE {where}"
    for c, (where, reason, text) in BAD.items()
)
NUMBERS = tuple(role for role, kind in SALES_COLUMNS if kind != "string")


def _extremes(column: str) -> str:
    """Exact counts and extremes of one column of the flat rows."""
    number = f"CAST({column} AS DOUBLE)" if column in NUMBERS else "NULL::DOUBLE"
    length = f"length(CAST({column} AS VARCHAR))"
    return (
        f"SELECT '{column}' AS \"column\", count(*) AS rows, CAST(min({length}) AS INT) AS min_length, "
        f"CAST(max({length}) AS INT) AS max_length, min({number}) AS min_number, "
        f"max({number}) AS max_number FROM flat"
    )


def _per_year(column: str) -> str:
    return (
        f"SELECT year AS batch, '{column}' AS \"column\", count(*) AS rows, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS null_count FROM flat GROUP BY year"
    )


ORACLES |= {
    "dedup_rows_late": ON_FLAT + "SELECT * FROM uniq",
    "bad_cell_rows": ON_FLAT + BAD_CELLS,
    "bad_cells": ON_FLAT
    + f'SELECT "column", reason, count(*) AS cells FROM ({BAD_CELLS}) GROUP BY 1, 2',
    "profile_merged": ON_FLAT
    + f"SELECT * FROM ({BREACHING}) JOIN ({' UNION ALL '.join(map(_extremes, ROLES))}) USING (\"column\")",
    "profile_trend": ON_FLAT
    + f""", years AS ({' UNION ALL '.join(map(_per_year, ROLES))}),
 shares AS (SELECT *, CAST(round(null_count * 100.0::DOUBLE / rows, 2) AS DOUBLE) AS null_pct FROM years),
 trend AS (SELECT *, lag(null_pct) OVER (PARTITION BY "column" ORDER BY batch) AS null_pct_before FROM shares)
 SELECT *, null_pct > {PROFILE_LIMIT_PCT}
  OR coalesce(round(null_pct - null_pct_before, 2) > 0.02, false) AS alarm FROM trend""",
}
