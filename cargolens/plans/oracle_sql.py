"""Reference SQL (DuckDB dialect) for every query with an oracle.

Each text is self-contained: it rebuilds the fixture from the pre-registered
star-table views, then computes one result. Column names equal the Spark
query's. Means come from exact DECIMAL sums on both sides, so they agree bit for bit; counts
are cast to BIGINT because DuckDB sums to HUGEINT.
"""

from __future__ import annotations

from cargolens import schemas as S

STATUS_LIST = "(" + ",".join(f"'{s}'" for s in S.VALID_STATUSES) + ")"

RAW_CTE = """
raw_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate,
    l.l_orderkey*10 + l.l_linenumber AS shipment_id, l.l_orderkey AS order_id, p.p_type AS product,
    CASE l.l_suppkey % 5 WHEN 0 THEN 'FedEx' WHEN 1 THEN 'DHL' WHEN 2 THEN ' Blue Dart '
         WHEN 3 THEN 'DTDC' ELSE 'Delhivery' END AS carrier,
    'TRK' || CAST(100000 + (l.l_orderkey * 7 + l.l_linenumber) % 900000 AS VARCHAR) AS tracking_number,
    CASE WHEN l.l_partkey % 211 = 0 THEN NULL WHEN l.l_partkey % 101 = 0 THEN 'LOST'
         WHEN l.l_partkey % 13 = 0 THEN ' delivered '
         ELSE CASE (l.l_orderkey + l.l_linenumber) % 7
           WHEN 0 THEN 'ORDER_PLACED' WHEN 1 THEN 'PROCESSING' WHEN 2 THEN 'SHIPPED' WHEN 3 THEN 'IN_TRANSIT'
           WHEN 4 THEN 'OUT_FOR_DELIVERY' WHEN 5 THEN 'DELIVERED' ELSE 'DELAYED' END END AS status,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL WHEN l.l_partkey % 83 = 0 THEN '  ' ELSE sn.n_name END AS origin,
    CASE WHEN l.l_partkey % 89 = 0 THEN NULL ELSE cn.n_name END AS destination,
    CAST(l.l_quantity AS BIGINT) AS quantity,
    l.l_quantity * p.p_size / CAST(50 AS DOUBLE) - CAST(0.02 AS DOUBLE) AS weight_kg
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw AS (
  SELECT shipment_id, order_id, product, carrier, tracking_number, status, origin, destination,
    quantity, weight_kg,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS shipped_at,
    CASE WHEN status = 'DELIVERED'
      THEN strftime(l_shipdate + to_days(CAST(1 + l_orderkey % 7 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') END
      AS delivered_at,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS event_timestamp
  FROM raw_base
)"""

SHIPMENT_COLS = (
    "shipment_id, order_id, product, carrier, tracking_number, status, origin, destination, "
    "quantity, weight_kg, shipped_at, delivered_at, event_timestamp"
)

SILVER_CTES = (
    RAW_CTE
    + f""",
norm AS (
  SELECT shipment_id, order_id, product, trim(carrier) AS carrier, tracking_number,
    upper(trim(status)) AS status, trim(origin) AS origin, trim(destination) AS destination,
    quantity, weight_kg, shipped_at, delivered_at, event_timestamp
  FROM raw
),
val AS (
  SELECT *, status IN {STATUS_LIST} AS is_valid_status, weight_kg > 0 AND weight_kg < CAST('inf' AS DOUBLE) AS is_valid_weight,
    origin IS NOT NULL AS has_origin, destination IS NOT NULL AS has_destination,
    CASE WHEN (status IN {STATUS_LIST}) AND weight_kg > 0 AND weight_kg < CAST('inf' AS DOUBLE) AND origin IS NOT NULL
              AND destination IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS dq_flag
  FROM norm
),
biz AS (
  SELECT *, CASE WHEN weight_kg < 1 THEN 'LIGHT' WHEN weight_kg < 10 THEN 'MEDIUM'
                 WHEN weight_kg < 25 THEN 'HEAVY' ELSE 'EXTRA_HEAVY' END AS weight_category,
    status = 'DELAYED' AS is_delayed, status = 'DELIVERED' AS is_delivered
  FROM val
),
silver AS (SELECT * FROM biz WHERE dq_flag = 'PASS')"""
)

RATE = "ROUND(CAST({d} AS DOUBLE) * 100.0 / NULLIF({n}, 0), 2)"


def _rate(d: str, n: str) -> str:
    return RATE.format(d=d, n=n)


# decimal part summed exactly, the rest in floating point
MEAN_WEIGHT = (
    "(CAST(SUM(CAST(weight_kg AS DECIMAL(38,6))) AS DOUBLE) "
    "+ SUM(weight_kg - CAST(CAST(weight_kg AS DECIMAL(38,6)) AS DOUBLE))) / COUNT(weight_kg)"
)

GOLD_CTES = (
    SILVER_CTES
    + f""",
g_carrier AS (
  SELECT carrier, COUNT(shipment_id) AS total_shipments,
    CAST(COUNT_IF(is_delayed) AS BIGINT) AS delayed_shipments,
    CAST(COUNT_IF(is_delivered) AS BIGINT) AS delivered_shipments,
    {MEAN_WEIGHT} AS avg_weight_kg,
    {_rate("COUNT_IF(is_delayed)", "COUNT(shipment_id)")} AS delay_rate_pct
  FROM silver GROUP BY carrier
),
g_status AS (
  SELECT status, COUNT(shipment_id) AS total_shipments, COUNT(DISTINCT order_id) AS unique_orders
  FROM silver GROUP BY status
),
g_route AS (
  SELECT origin, destination, COUNT(shipment_id) AS total_shipments,
    CAST(COUNT_IF(is_delayed) AS BIGINT) AS delayed_shipments,
    {_rate("COUNT_IF(is_delayed)", "COUNT(shipment_id)")} AS delay_rate_pct,
    {MEAN_WEIGHT} AS avg_weight_kg
  FROM silver GROUP BY origin, destination
),
g_product AS (
  SELECT product, COUNT(shipment_id) AS total_shipments, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
    CAST(COUNT_IF(is_delayed) AS BIGINT) AS delayed_shipments,
    {_rate("COUNT_IF(is_delayed)", "COUNT(shipment_id)")} AS delay_rate_pct,
    {MEAN_WEIGHT} AS avg_weight_kg
  FROM silver GROUP BY product
)"""
)


def with_silver(select: str) -> str:
    return f"WITH {SILVER_CTES}\n{select}"


def with_gold(select: str) -> str:
    return f"WITH {GOLD_CTES}\n{select}"


SILVER_OUT_COLS = (
    SHIPMENT_COLS
    + ", is_valid_status, is_valid_weight, has_origin, has_destination, dq_flag, "
    "weight_category, is_delayed, is_delivered"
)

ORACLE: dict[str, str] = {
    "raw_shipments": f"WITH {RAW_CTE}\nSELECT {SHIPMENT_COLS} FROM raw",
    "normalize_shipments": with_silver(f"SELECT {SHIPMENT_COLS} FROM norm"),
    "validate_shipments": with_silver(
        "SELECT shipment_id, is_valid_status, is_valid_weight, has_origin, has_destination, dq_flag FROM val"
    ),
    "silver_shipments": with_silver(f"SELECT {SILVER_OUT_COLS} FROM silver"),
    "carrier_performance": with_gold("SELECT * FROM g_carrier"),
    "shipment_status_summary": with_gold("SELECT * FROM g_status"),
    "route_analysis": with_gold("SELECT * FROM g_route"),
    "product_summary": with_gold("SELECT * FROM g_product"),
    "dq_flag_counts": with_silver("SELECT dq_flag, COUNT(*) AS n FROM biz GROUP BY dq_flag"),
    "weight_category_counts": with_silver(
        "SELECT weight_category, COUNT(*) AS n FROM silver GROUP BY weight_category"
    ),
    "silver_row_count": with_silver("SELECT COUNT(*) AS n FROM silver"),
    "quarantine_reasons": with_silver(
        """, f AS (SELECT * FROM biz WHERE dq_flag = 'FAIL')
SELECT 'bad_status' AS reason, CAST(COUNT_IF(NOT COALESCE(is_valid_status, FALSE)) AS BIGINT) AS n FROM f
UNION ALL SELECT 'bad_weight', CAST(COUNT_IF(NOT COALESCE(is_valid_weight, FALSE)) AS BIGINT) FROM f
UNION ALL SELECT 'no_origin', CAST(COUNT_IF(NOT has_origin) AS BIGINT) FROM f
UNION ALL SELECT 'no_destination', CAST(COUNT_IF(NOT has_destination) AS BIGINT) FROM f"""
    ),
}

def checks_cte(table: str) -> str:
    return f""",
st AS (
  SELECT COUNT(*) AS n,
    COUNT_IF(carrier IS NULL) AS null_carrier, COUNT_IF(status IS NULL) AS null_status,
    COUNT_IF(origin IS NULL) AS null_origin, COUNT_IF(destination IS NULL) AS null_destination,
    COUNT_IF(NOT (status IN {STATUS_LIST})) AS bad_status, MIN(weight_kg) AS min_weight,
    COUNT(DISTINCT shipment_id) AS distinct_ids,
    COALESCE(MAX(CAST(shipment_id IS NULL AS INTEGER)), 0) AS null_id,
    COUNT_IF(dq_flag = 'FAIL') AS dq_fails
  FROM {table}
),
checks AS (
  SELECT 'Minimum row count >= 50' AS check_name, n >= 50 AS passed, CAST(n AS DOUBLE) AS actual,
    '>= 50' AS expected FROM st
  UNION ALL SELECT 'No nulls in carrier', null_carrier = 0, CAST(null_carrier AS DOUBLE), '0' FROM st
  UNION ALL SELECT 'No nulls in status', null_status = 0, CAST(null_status AS DOUBLE), '0' FROM st
  UNION ALL SELECT 'No nulls in origin', null_origin = 0, CAST(null_origin AS DOUBLE), '0' FROM st
  UNION ALL SELECT 'No nulls in destination', null_destination = 0, CAST(null_destination AS DOUBLE), '0'
    FROM st
  UNION ALL SELECT 'All status values are valid', bad_status = 0, CAST(bad_status AS DOUBLE), '0' FROM st
  UNION ALL SELECT 'All weights are positive', COALESCE(min_weight > 0, FALSE), min_weight, '> 0' FROM st
  UNION ALL SELECT 'No duplicate shipment IDs', n - (distinct_ids + null_id) = 0,
    CAST(n - (distinct_ids + null_id) AS DOUBLE), '0' FROM st
  UNION ALL SELECT 'All DQ flags are PASS', dq_fails = 0, CAST(dq_fails AS DOUBLE), '0' FROM st
)"""


CHECKS_CTE = checks_cte("silver")


def _long(value: str, key: str, step: int, place: int, limit: int) -> str:
    return f"CASE WHEN {key} % {step} = {place} THEN repeat('x', {limit + 1}) ELSE {value} END"


def _copies(name: str, select: str, key: str, step: int, place: int) -> str:
    """A table whose rows at the planted keys appear twice."""
    return (
        f"{name}_once AS ({select}),\n"
        f"{name} AS (SELECT * FROM {name}_once UNION ALL SELECT * FROM {name}_once WHERE {key} % {step} = {place})"
    )


OPS_CTES = RAW_CTE + ",\n" + ",\n".join(
    [
        _copies(
            "oltp_suppliers",
            "SELECT s_suppkey AS supplier_id, "
            + _long("CASE WHEN s_suppkey % 50 = 7 THEN NULL ELSE s_name END", "s_suppkey", 50, 8, 100)
            + f" AS supplier_name, {_long('n_name', 's_suppkey', 50, 9, 50)} AS country, "
            + f"{_long('r_name', 's_suppkey', 50, 10, 50)} AS region, "
            + _long("'s' || s_suppkey || '@example.com'", "s_suppkey", 50, 11, 100)
            + " AS contact_email, s_acctbal / CAST(900 AS DOUBLE) AS rating, s_acctbal > 0 AS is_active "
            "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
            "supplier_id",
            50,
            12,
        ),
        _copies(
            "oltp_products",
            "SELECT p_partkey AS product_id, "
            + _long("CASE WHEN p_partkey % 500 = 3 THEN NULL ELSE p_name END", "p_partkey", 500, 4, 100)
            + f" AS product_name, {_long('p_type', 'p_partkey', 500, 5, 50)} AS category, "
            "CASE WHEN p_partkey % 500 = 6 THEN CAST(123456789012.5 AS DOUBLE) ELSE p_retailprice END AS unit_price, "
            "CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_partkey % 105 END AS supplier_id FROM part",
            "product_id",
            500,
            7,
        ),
        _copies(
            "oltp_inventory",
            "SELECT p_partkey AS inventory_id, p_partkey + 5 AS product_id, "
            + _long("'WH-' || p_brand", "p_partkey", 500, 4, 20)
            + " AS warehouse_id, CASE WHEN p_partkey % 500 <> 3 THEN p_size * 20 END AS quantity, "
            "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 100 END AS reorder_level FROM part",
            "inventory_id",
            500,
            7,
        ),
        _copies(
            "oltp_orders",
            "SELECT o_orderkey AS order_id, o_orderkey % 2003 AS product_id, o_custkey % 101 AS supplier_id, "
            "CASE WHEN o_orderkey % 500 <> 3 THEN 1 + o_orderkey % 100 END AS quantity, "
            + _long("o_orderstatus", "o_orderkey", 500, 4, 20)
            + " AS order_status FROM orders",
            "order_id",
            500,
            7,
        ),
        "oltp_shipments AS (SELECT CASE WHEN shipment_id % 5000 = 11 THEN shipment_id + 3000000000 ELSE shipment_id END "
        "AS shipment_id, CASE WHEN shipment_id % 5000 = 12 THEN -order_id ELSE order_id END AS order_id, "
        + ", ".join(
            f"{_long(c, 'shipment_id', 5000, place, limit)} AS {c}"
            for c, place, limit in [
                ("carrier", 13, 50),
                ("tracking_number", 14, 100),
                ("status", 15, 20),
                ("origin", 16, 100),
                ("destination", 17, 100),
            ]
        )
        + ", CASE WHEN shipment_id % 5000 = 21 THEN 'soon' ELSE shipped_at END AS shipped_at, delivered_at FROM raw)",
    ]
)


def _orphans(child: str, fk: str, parent: str, pk: str, child_tab: str, parent_tab: str) -> str:
    return (
        f"SELECT '{child}.{fk} -> {parent}.{pk}' AS constraint_name, COUNT(*) AS n FROM {child_tab} c "
        f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent_tab} p WHERE p.{pk} = c.{fk})"
    )


def _length(table: str, col: str, n: int, tab: str) -> str:
    return (
        f"SELECT '{table}.{col}' AS constraint_name, {n} AS max_length, "
        f"CAST(COUNT_IF(length({col}) > {n}) AS BIGINT) AS n FROM {tab}"
    )


ORACLE.update(
    {
        "dq_checks": with_silver(CHECKS_CTE + "\nSELECT * FROM checks"),
        "dq_tally": with_silver(
            CHECKS_CTE
            + "\nSELECT COUNT(*) AS total, CAST(COUNT_IF(passed) AS BIGINT) AS passed, "
            "CAST(COUNT_IF(NOT passed) AS BIGINT) AS failed FROM checks"
        ),
        "dq_checks_flagged": with_silver(checks_cte("biz") + "\nSELECT * FROM checks"),
        "pk_violations": f"WITH {OPS_CTES}\n"
        + "\nUNION ALL ".join(
            f"SELECT '{t}.{k}' AS constraint_name, COUNT(*) - COUNT(DISTINCT {k}) AS n FROM {tab}"
            for t, k, tab in [
                ("suppliers", "supplier_id", "oltp_suppliers"),
                ("products", "product_id", "oltp_products"),
                ("inventory", "inventory_id", "oltp_inventory"),
                ("orders", "order_id", "oltp_orders"),
                ("shipments", "shipment_id", "oltp_shipments"),
            ]
        ),
        "not_null_violations": f"WITH {OPS_CTES}\n"
        + "\nUNION ALL ".join(
            f"SELECT '{t}.{c}' AS constraint_name, CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS n FROM {tab}"
            for t, c, tab in [
                ("suppliers", "supplier_name", "oltp_suppliers"),
                ("products", "product_name", "oltp_products"),
                ("inventory", "quantity", "oltp_inventory"),
                ("orders", "quantity", "oltp_orders"),
            ]
        ),
        "fk_orphans": f"WITH {OPS_CTES}\n"
        + "\nUNION ALL ".join(
            [
                _orphans("products", "supplier_id", "suppliers", "supplier_id", "oltp_products", "oltp_suppliers"),
                _orphans("inventory", "product_id", "products", "product_id", "oltp_inventory", "oltp_products"),
                _orphans("orders", "product_id", "products", "product_id", "oltp_orders", "oltp_products"),
                _orphans("orders", "supplier_id", "suppliers", "supplier_id", "oltp_orders", "oltp_suppliers"),
                _orphans("shipments", "order_id", "orders", "order_id", "oltp_shipments", "oltp_orders"),
            ]
        ),
        "length_violations": f"WITH {OPS_CTES}\n"
        + "\nUNION ALL ".join(
            _length(t, c, n, tab)
            for t, c, n, tab in [
                ("suppliers", "supplier_name", 100, "oltp_suppliers"),
                ("suppliers", "country", 50, "oltp_suppliers"),
                ("suppliers", "region", 50, "oltp_suppliers"),
                ("suppliers", "contact_email", 100, "oltp_suppliers"),
                ("products", "product_name", 100, "oltp_products"),
                ("products", "category", 50, "oltp_products"),
                ("inventory", "warehouse_id", 20, "oltp_inventory"),
                ("orders", "order_status", 20, "oltp_orders"),
                ("shipments", "carrier", 50, "oltp_shipments"),
                ("shipments", "tracking_number", 100, "oltp_shipments"),
                ("shipments", "status", 20, "oltp_shipments"),
                ("shipments", "origin", 100, "oltp_shipments"),
                ("shipments", "destination", 100, "oltp_shipments"),
            ]
        ),
        "decimal_violations": f"WITH {OPS_CTES}\n"
        "SELECT 'suppliers.rating decimal(3,2)' AS constraint_name, CAST(COUNT_IF(rating IS NOT NULL "
        "AND TRY_CAST(rating AS DECIMAL(3,2)) IS NULL) AS BIGINT) AS n FROM oltp_suppliers\n"
        "UNION ALL SELECT 'products.unit_price decimal(10,2)', CAST(COUNT_IF(unit_price IS NOT NULL "
        "AND TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL) AS BIGINT) FROM oltp_products",
        # omitted columns take their default, nulls of a present column stay
        "apply_defaults": f"""WITH {OPS_CTES}
SELECT 'inventory.reorder_level omitted' AS case_name, COUNT(*) AS n, COUNT(*) AS filled FROM oltp_inventory
UNION ALL SELECT 'inventory.reorder_level present', COUNT(*), COUNT(reorder_level) FROM oltp_inventory
UNION ALL SELECT 'inventory.last_updated omitted', COUNT(*), COUNT(*) FROM oltp_inventory
UNION ALL SELECT 'suppliers.is_active omitted', COUNT(*), COUNT(*) FROM oltp_suppliers
UNION ALL SELECT 'suppliers.created_at omitted', COUNT(*), COUNT(*) FROM oltp_suppliers
UNION ALL SELECT 'products.created_at omitted', COUNT(*), COUNT(*) FROM oltp_products
UNION ALL SELECT 'orders.order_status omitted', COUNT(*), COUNT(*) FROM oltp_orders
UNION ALL SELECT 'orders.order_date omitted', COUNT(*), COUNT(*) FROM oltp_orders
UNION ALL SELECT 'shipments.status omitted', COUNT(*), COUNT(*) FROM oltp_shipments
UNION ALL SELECT 'shipments.status present', COUNT(*), CAST(COUNT_IF(status = 'IN_TRANSIT') AS BIGINT) FROM oltp_shipments
UNION ALL SELECT 'shipments.shipped_at omitted', COUNT(*), COUNT(*) FROM oltp_shipments""",
        # declared columns of the fixture tables that can fail their type, and those that are missing
        "cast_violations": f"""WITH {OPS_CTES}
SELECT 'suppliers.rating decimal(3,2)' AS constraint_name, CAST(COUNT_IF(rating IS NOT NULL
  AND TRY_CAST(rating AS DECIMAL(3,2)) IS NULL) AS BIGINT) AS n FROM oltp_suppliers
UNION ALL SELECT 'products.unit_price decimal(10,2)', CAST(COUNT_IF(unit_price IS NOT NULL
  AND TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL) AS BIGINT) FROM oltp_products
UNION ALL SELECT 'shipments.shipment_id int', CAST(COUNT_IF(TRY_CAST(shipment_id AS INTEGER) IS NULL) AS BIGINT) FROM oltp_shipments
UNION ALL SELECT 'shipments.shipped_at timestamp', CAST(COUNT_IF(shipped_at IS NOT NULL
  AND TRY_CAST(shipped_at AS TIMESTAMP) IS NULL) AS BIGINT) FROM oltp_shipments
UNION ALL SELECT c, CAST(NULL AS BIGINT) FROM (VALUES ('suppliers.created_at timestamp'), ('products.created_at timestamp'),
  ('inventory.last_updated timestamp'), ('orders.actual_delivery date')) m(c)
UNION ALL SELECT c, CAST(0 AS BIGINT) FROM (VALUES ('suppliers.supplier_id int'), ('suppliers.supplier_name string'),
  ('suppliers.country string'), ('suppliers.region string'), ('suppliers.contact_email string'),
  ('suppliers.is_active boolean'), ('products.product_id int'), ('products.product_name string'),
  ('products.category string'), ('products.supplier_id int'), ('inventory.inventory_id int'),
  ('inventory.product_id int'), ('inventory.warehouse_id string'), ('inventory.quantity int'),
  ('inventory.reorder_level int'), ('orders.order_id int'), ('orders.product_id int'), ('orders.supplier_id int'),
  ('orders.quantity int'), ('orders.order_status string'), ('orders.order_date timestamp'),
  ('orders.expected_delivery date'), ('shipments.order_id int'), ('shipments.carrier string'),
  ('shipments.tracking_number string'), ('shipments.status string'), ('shipments.origin string'),
  ('shipments.destination string'), ('shipments.delivered_at timestamp')) z(c)""",
    }
)

ROUTE = "origin || ' → ' || destination"

CARDS = """SELECT CAST(SUM(total_shipments) AS BIGINT) AS total_shipments,
  CAST(SUM(delivered_shipments) AS BIGINT) AS total_delivered,
  CAST(SUM(delayed_shipments) AS BIGINT) AS total_delayed,
  ROUND(CAST(SUM(CAST(delay_rate_pct AS DECIMAL(38,6))) AS DOUBLE) / COUNT(delay_rate_pct), 1) AS avg_delay_rate,
  ROUND(CAST(SUM(delayed_shipments) AS DOUBLE) * 100.0 / NULLIF(SUM(total_shipments), 0), 2)
    AS weighted_delay_rate
FROM g_carrier"""

ORACLE.update(
    {
        "carrier_detail": with_gold(
            "SELECT carrier, total_shipments, delivered_shipments, delayed_shipments, delay_rate_pct, "
            "avg_weight_kg FROM g_carrier"
        ),
        "product_detail": with_gold(
            "SELECT product, total_shipments, total_quantity, delay_rate_pct, avg_weight_kg FROM g_product"
        ),
        "route_detail": with_gold(
            f"SELECT {ROUTE} AS route, total_shipments, delayed_shipments, delay_rate_pct, avg_weight_kg "
            "FROM g_route"
        ),
        "carriers_by_rate": with_gold("SELECT carrier, delay_rate_pct FROM g_carrier"),
        "carriers_by_volume": with_gold("SELECT carrier, total_shipments FROM g_carrier"),
        "top_products": with_gold(
            "SELECT product, total_shipments, delay_rate_pct FROM g_product "
            "ORDER BY total_shipments DESC, product LIMIT 10"
        ),
        "top_routes": with_gold(
            f"SELECT {ROUTE} AS route, delay_rate_pct, total_shipments FROM g_route "
            f"ORDER BY delay_rate_pct DESC NULLS LAST, route LIMIT 10"
        ),
        "top5_delayed_routes": with_gold(
            "SELECT origin, destination, delay_rate_pct FROM g_route "
            "ORDER BY delay_rate_pct DESC NULLS LAST, origin, destination LIMIT 5"
        ),
        "status_share": with_gold(
            "SELECT status, total_shipments, CAST(total_shipments AS DOUBLE) / SUM(total_shipments) OVER () "
            "AS share FROM g_status"
        ),
        "kpi_cards": with_gold(
            f"""SELECT *, CASE WHEN avg_delay_rate > 20 THEN 'red' WHEN avg_delay_rate > 10 THEN 'amber'
  ELSE 'green' END AS band FROM ({CARDS}) c"""
        ),
        "business_questions": with_gold(
            f"""(SELECT 1 AS question_id, carrier AS answer_key, delay_rate_pct AS answer_value FROM g_carrier
  ORDER BY delay_rate_pct DESC NULLS LAST, carrier LIMIT 1)
UNION ALL SELECT 2, 'IN_TRANSIT', CAST(COALESCE(SUM(total_shipments), 0) AS DOUBLE) FROM g_status
  WHERE status = 'IN_TRANSIT'
UNION ALL (SELECT 3, product, CAST(total_shipments AS DOUBLE) FROM g_product
  ORDER BY total_shipments DESC, product LIMIT 1)
UNION ALL (SELECT 4, {ROUTE}, delay_rate_pct FROM g_route
  ORDER BY delay_rate_pct DESC NULLS LAST, origin, destination LIMIT 1)
UNION ALL SELECT 5, 'DELIVERED',
  ROUND(CAST(SUM(delivered_shipments) AS DOUBLE) * 100.0 / NULLIF(SUM(total_shipments), 0), 2) FROM g_carrier"""
        ),
        "weekly_summary": with_gold(
            f"""SELECT 1 AS point, 'all carriers' AS key,
  ROUND(CAST(SUM(delayed_shipments) AS DOUBLE) * 100.0 / NULLIF(SUM(total_shipments), 0), 2) AS value
  FROM g_carrier
UNION ALL (SELECT 2, carrier, delay_rate_pct FROM g_carrier ORDER BY delay_rate_pct ASC NULLS LAST, carrier
  LIMIT 1)
UNION ALL (SELECT 3, carrier, delay_rate_pct FROM g_carrier ORDER BY delay_rate_pct DESC NULLS LAST, carrier
  LIMIT 1)
UNION ALL (SELECT 4, {ROUTE}, delay_rate_pct FROM g_route
  ORDER BY delay_rate_pct DESC NULLS LAST, origin, destination LIMIT 1)
UNION ALL (SELECT 5, product, CAST(total_shipments AS DOUBLE) FROM g_product
  ORDER BY total_shipments DESC, product LIMIT 1)"""
        ),
    }
)

SILVER_TYPES = [
    ("shipment_id", "bigint"), ("order_id", "bigint"), ("product", "string"), ("carrier", "string"),
    ("tracking_number", "string"), ("status", "string"), ("origin", "string"), ("destination", "string"),
    ("quantity", "bigint"), ("weight_kg", "double"), ("shipped_at", "string"), ("delivered_at", "string"),
    ("event_timestamp", "string"), ("is_valid_status", "boolean"), ("is_valid_weight", "boolean"),
    ("has_origin", "boolean"), ("has_destination", "boolean"), ("dq_flag", "string"),
    ("processed_at", "timestamp"), ("weight_category", "string"), ("is_delayed", "boolean"),
    ("is_delivered", "boolean"),
]


GOLD_VALUES = """SELECT 'carrier_performance' AS table_name, carrier AS key, total_shipments AS n, avg_weight_kg AS value FROM g_carrier
UNION ALL SELECT 'carrier_performance rate', carrier, delayed_shipments, delay_rate_pct FROM g_carrier
UNION ALL SELECT 'shipment_status_summary', status, total_shipments, CAST(unique_orders AS DOUBLE) FROM g_status
UNION ALL SELECT 'route_analysis', origin || ' → ' || destination, total_shipments, avg_weight_kg FROM g_route
UNION ALL SELECT 'route_analysis rate', origin || ' → ' || destination, delayed_shipments, delay_rate_pct FROM g_route
UNION ALL SELECT 'product_summary', product, total_shipments, avg_weight_kg FROM g_product
UNION ALL SELECT 'product_summary rate', product, total_quantity, delay_rate_pct FROM g_product"""


def _schema_report() -> str:
    parts = []
    for name, typ in SILVER_TYPES:
        expr = "COUNT(*)" if name == "processed_at" else f"COUNT({name})"
        parts.append(f"SELECT '{name}' AS column_name, '{typ}' AS data_type, {expr} AS non_null FROM silver")
    return with_silver("\nUNION ALL ".join(parts))


ORACLE.update(
    {
        "bronze_by_date": with_silver(
            "SELECT substr(shipped_at, 1, 10) AS ingest_date, COUNT(*) AS n FROM raw "
            "WHERE substr(shipped_at, 1, 10) BETWEEN '1996-03-01' AND '1996-03-31' GROUP BY 1"
        ),
        "bronze_scan": f"WITH {RAW_CTE}\nSELECT {SHIPMENT_COLS} FROM raw",
        "schema_report": _schema_report(),
        # rows of every written table, and the stored gold values
        "medallion_run": with_gold(
            """SELECT 'bronze' AS table_name, '' AS key, COUNT(*) AS n, CAST(NULL AS DOUBLE) AS value FROM raw
UNION ALL SELECT 'silver', '', COUNT(*), NULL FROM silver
UNION ALL SELECT 'quarantine', '', COUNT(*), NULL FROM biz WHERE dq_flag = 'FAIL'
UNION ALL SELECT 'checks', '', CAST(9 AS BIGINT), NULL
"""
            + f"UNION ALL {GOLD_VALUES}"
        ),
        "bronze_inventory": f"WITH {RAW_CTE}\nSELECT COUNT(*) AS landed_rows, TRUE AS files_not_empty FROM raw",
    }
)

ORACLE.update(
    {
        "stream_source": "SELECT event_id, user_id, event_type, value FROM events",
        # every 997th message is cut after 12 characters: {"event_id":
        "decode_events": """SELECT CAST(event_id AS VARCHAR) AS key, event_id % 997 <> 3 AS parsed,
  CASE WHEN event_id % 997 = 3 THEN '{"event_id":' END AS rejected,
  CASE WHEN event_id % 997 <> 3 THEN event_id END AS event_id, CASE WHEN event_id % 997 <> 3 THEN user_id END AS user_id,
  CASE WHEN event_id % 997 <> 3 THEN event_type END AS event_type, CASE WHEN event_id % 997 <> 3 THEN value END AS value,
  CASE WHEN event_id % 997 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS prop_k FROM events""",
        "stream_silver": with_silver(f"SELECT {SILVER_OUT_COLS} FROM silver"),
        "stream_dedup": f"WITH {RAW_CTE}\nSELECT DISTINCT shipment_id FROM raw",
    }
)

DAY_TWO = "shipment_id % 3 = 0"
BROKEN = "shipment_id % 1000 = 7"

ORACLE.update(
    {
        # every line of both landings is there, and the rejects of both
        "landing_two_runs": f"""WITH {RAW_CTE}
SELECT 'bronze' AS place, COUNT(*) AS n FROM raw WHERE NOT ({BROKEN})
UNION ALL SELECT 'quarantine', COUNT(*) FROM raw WHERE {BROKEN}""",
        # one day replaced, the other untouched
        "silver_two_days": with_silver(
            f"""SELECT CASE WHEN {DAY_TWO} THEN '2026-01-02' ELSE '2026-01-01' END AS ingest_date, dq_flag, COUNT(*) AS n
FROM biz GROUP BY 1, 2"""
        ),
        "landing_malformed": f"""WITH {RAW_CTE}
SELECT 'bronze' AS place, COUNT(*) AS n, CAST(NULL AS VARCHAR) AS first_text FROM raw WHERE NOT ({BROKEN})
UNION ALL SELECT 'quarantine', COUNT(*), MIN('broken {{ ' || shipment_id) FROM raw WHERE {BROKEN}""",
        "stream_quarantine": with_silver(
            """SELECT shipment_id, status, weight_kg, concat_ws(',',
  CASE WHEN NOT COALESCE(is_valid_status, FALSE) THEN 'bad_status' END,
  CASE WHEN NOT COALESCE(is_valid_weight, FALSE) THEN 'bad_weight' END,
  CASE WHEN NOT has_origin THEN 'no_origin' END,
  CASE WHEN NOT has_destination THEN 'no_destination' END) AS reasons
FROM biz WHERE dq_flag = 'FAIL'"""
        ),
        "arrays_one_day": with_silver(f"SELECT dq_flag, COUNT(*) AS n FROM biz WHERE {DAY_TWO} GROUP BY 1"),
        "stream_landing": f"""WITH {RAW_CTE}
SELECT COUNT(*) AS total, TRUE AS at_most_ten FROM raw""",
        "stream_restart": f"""WITH {RAW_CTE}
SELECT 1 AS run, COUNT(*) AS new_rows FROM raw UNION ALL SELECT 2, CAST(0 AS BIGINT)""",
        # ids once; rows without an id and rows older than the delay are kept apart
        "stream_dedup_outputs": f"""WITH {RAW_CTE}
SELECT 'new' AS place, COUNT(DISTINCT shipment_id) AS n FROM raw WHERE shipment_id % 50 <> 2 AND shipment_id % 50 <> 1
UNION ALL SELECT 'no_key', COUNT(*) FROM raw WHERE shipment_id % 50 = 2
UNION ALL SELECT 'late', COUNT(*) FROM raw WHERE shipment_id % 50 = 1""",
        "publish_payload": f"""WITH {RAW_CTE}
SELECT CAST(order_id AS VARCHAR) AS key, {SHIPMENT_COLS} FROM raw""",
        "kpi_cards_text": with_gold(
            f"""SELECT format('{{:,}}', total_shipments) AS total_shipments, format('{{:,}}', total_delivered) AS total_delivered,
  format('{{:,}}', total_delayed) AS total_delayed, CAST(avg_delay_rate AS VARCHAR) || '%' AS avg_delay_rate,
  CASE WHEN avg_delay_rate > 20 THEN 'red' WHEN avg_delay_rate > 10 THEN 'amber' ELSE 'green' END AS band
FROM ({CARDS}) c"""
        ),
        "kpi_report": with_gold(
            """, r AS (SELECT * FROM g_route ORDER BY delay_rate_pct DESC NULLS LAST, origin, destination LIMIT 5),
l AS (
  SELECT 1 AS section_no, CAST('inf' AS DOUBLE) AS k1, CAST(NULL AS VARCHAR) AS k2, CAST(NULL AS VARCHAR) AS k3,
    -1 AS sub, 'CARRIER PERFORMANCE DATA' AS line
  UNION ALL SELECT 2, CAST('inf' AS DOUBLE), NULL, NULL, -1, 'SHIPMENT STATUS SUMMARY'
  UNION ALL SELECT 3, CAST('inf' AS DOUBLE), NULL, NULL, -1, 'TOP DELAYED ROUTES'
  UNION ALL SELECT 4, CAST('inf' AS DOUBLE), NULL, NULL, -1, 'PRODUCT SUMMARY'
  UNION ALL SELECT 1, delay_rate_pct, carrier, NULL, sub, CASE sub WHEN 0 THEN 'Carrier: ' || carrier
    WHEN 1 THEN '- Total Shipments: ' || total_shipments WHEN 2 THEN '- Delayed: ' || delayed_shipments
    WHEN 3 THEN '- Delivered: ' || delivered_shipments WHEN 4 THEN '- Delay Rate: ' || delay_rate_pct || '%'
    ELSE '- Avg Weight: ' || ROUND(avg_weight_kg, 2) || ' kg' END
  FROM g_carrier, (SELECT CAST(range AS INTEGER) AS sub FROM range(6)) s
  UNION ALL SELECT 2, CAST(total_shipments AS DOUBLE), status, NULL, 0, 'Status ' || status || ': ' || total_shipments || ' shipments' FROM g_status
  UNION ALL SELECT 3, delay_rate_pct, origin, destination, 0, origin || ' → ' || destination || ': ' || delay_rate_pct || '% delay rate' FROM r
  UNION ALL SELECT 4, CAST(total_shipments AS DOUBLE), product, NULL, 0,
    product || ': ' || total_shipments || ' shipments, ' || delay_rate_pct || '% delay rate' FROM g_product
)
SELECT row_number() OVER (ORDER BY section_no, k1 DESC NULLS LAST, k2 NULLS FIRST, k3 NULLS FIRST, sub) AS pos, line FROM l"""
        ),
        "gold_order": with_gold(
            """SELECT 'carrier_performance' AS table_name, row_number() OVER (ORDER BY delay_rate_pct DESC NULLS LAST, carrier) AS pos, carrier AS key FROM g_carrier
UNION ALL SELECT 'shipment_status_summary', row_number() OVER (ORDER BY total_shipments DESC, status), status FROM g_status
UNION ALL SELECT 'route_analysis', row_number() OVER (ORDER BY delay_rate_pct DESC NULLS LAST, origin, destination), origin || ' → ' || destination FROM g_route
UNION ALL SELECT 'product_summary', row_number() OVER (ORDER BY total_shipments DESC, product), product FROM g_product"""
        ),
    }
)

ORACLE["stream_messages"] = f"WITH {RAW_CTE}\nSELECT {SHIPMENT_COLS} FROM raw"


# incremental runs: what each run read, and what the table holds; gold as after one full run
_RUN = {"a": 1, "b": 0, "c": 2}
ORACLE["silver_incremental"] = with_silver(
    "\nUNION ALL ".join(
        f"""SELECT 'run {name}' AS place, f AS dq_flag, COUNT(*) FILTER (WHERE dq_flag = f AND shipment_id % 3 = {rest}) AS n
FROM biz, (VALUES ('PASS'), ('FAIL')) v(f) GROUP BY f
UNION ALL SELECT 'run {name}', 'landings', CAST(1 AS BIGINT)"""
        for name, rest in _RUN.items()
    )
    + f"""
UNION ALL SELECT 'run without new landings', f, CAST(0 AS BIGINT) FROM (VALUES ('PASS'), ('FAIL'), ('landings')) v(f)
UNION ALL SELECT CASE WHEN {DAY_TWO} THEN '2026-01-02' ELSE '2026-01-01' END, dq_flag, COUNT(*) FROM biz GROUP BY 1, 2"""
)
ORACLE["gold_incremental"] = with_gold(GOLD_VALUES)
ORACLE["checks_incremental"] = ORACLE["dq_checks"]
ORACLE["distinct_orders_by_day"] = f"WITH {RAW_CTE}\nSELECT carrier, COUNT(DISTINCT order_id) AS orders FROM raw GROUP BY carrier"
ORACLE["topic_stream"] = f"WITH {RAW_CTE}\nSELECT {SHIPMENT_COLS} FROM raw"
ORACLE["topic_order"] = f"""WITH {RAW_CTE}
SELECT CAST(order_id AS VARCHAR) AS key, COUNT(*) AS n, CAST(1 AS BIGINT) AS partitions,
  COUNT(*) = COUNT(DISTINCT shipment_id) AS in_order FROM raw GROUP BY 1"""
ORACLE["landing_exact"] = f"""WITH {RAW_CTE}, t AS (SELECT COUNT(*) AS n FROM raw), l AS (SELECT * FROM (VALUES ('stream'), ('batch')) v(landing))
SELECT landing, CAST(10 AS BIGINT) AS events, n // 10 AS files FROM t, l WHERE n >= 10
UNION ALL SELECT landing, n % 10, CAST(1 AS BIGINT) FROM t, l WHERE n % 10 > 0"""
ORACLE["stream_gate"] = with_silver(
    """, c AS (SELECT *, COUNT(*) OVER (PARTITION BY shipment_id) AS copies FROM biz)
SELECT CASE WHEN copies = 1 THEN 'silver' ELSE 'held' END AS place, dq_flag, COUNT(*) AS n FROM c GROUP BY 1, 2
UNION ALL SELECT 'stopped', NULL, CAST(1 AS BIGINT)"""
)
ORACLE["fk_orphans_bucketed"] = (
    f"SELECT * FROM ({ORACLE['fk_orphans']}) f WHERE constraint_name LIKE 'shipments.%' OR constraint_name LIKE 'inventory.%'"
)
