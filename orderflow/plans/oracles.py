"""Independent SQL for the queries, runnable by DuckDB on the same Parquet tables.

Written from the definitions, with plain window functions and sorts where the Spark operators use
distributed running counts.
"""

from __future__ import annotations

from itertools import combinations

ORACLES: dict[str, str] = {}

# --- shared steps -------------------------------------------------------------------------------

STEPS = {
    "d_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_hours(o_orderkey % 48) END AS order_approved_at,
               o_orderdate + INTERVAL 2 DAY AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 89 <> 0
                    THEN o_orderdate + to_hours(24 * (3 + (o_orderkey * 31) % 40)) END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
        FROM orders""",
    "d_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "d_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
    "d_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 40 <> 7 THEN p_type END AS product_category_name,
               CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
               CAST(length(p_brand) AS DOUBLE) AS product_description_lenght,
               CAST(1 + p_partkey % 5 AS DOUBLE) AS product_photos_qty,
               CAST(CASE WHEN p_partkey % 50 <> 0 THEN p_size * 100 END AS DOUBLE) AS product_weight_g,
               CAST(CASE WHEN p_partkey % 60 <> 0 THEN p_size END AS DOUBLE) AS product_length_cm,
               CAST(1 + p_partkey % 20 AS DOUBLE) AS product_height_cm,
               CAST(5 + p_partkey % 7 AS DOUBLE) AS product_width_cm
        FROM part""",
    "d_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city,
               n_name AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "d_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag || l_linestatus WHEN 'NO' THEN 'credit_card' WHEN 'RF' THEN 'voucher'
                    WHEN 'AF' THEN 'boleto' WHEN 'NF' THEN 'debit_card'
                    ELSE l_returnflag || l_linestatus END AS payment_type,
               CAST(l_quantity AS INTEGER) % 12 AS payment_installments,
               l_extendedprice * (1 - l_discount) AS payment_value
        FROM lineitem""",
    "enriched": """
        SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
        FROM d_items LEFT JOIN d_products USING (product_id) LEFT JOIN d_sellers USING (seller_id)""",
    "item_features": """
        SELECT order_id, count(*) AS item_count,
               count(DISTINCT product_id) AS unique_product_count, count(DISTINCT seller_id) AS unique_seller_count,
               count(DISTINCT seller_state) AS unique_seller_state_count,
               count(DISTINCT product_category_name) AS unique_category_count,
               sum(price) AS total_item_price, avg(price) AS average_item_price,
               min(price) AS minimum_item_price, max(price) AS maximum_item_price,
               sum(freight_value) AS total_freight, avg(freight_value) AS average_freight_per_item,
               max(freight_value) AS maximum_freight_per_item,
               CASE WHEN sum(price) > 0 THEN round(sum(freight_value) / sum(price), 12) END AS freight_to_price_ratio,
               sum(product_weight_g) AS total_product_weight_g, avg(product_weight_g) AS average_product_weight_g,
               max(product_weight_g) AS maximum_product_weight_g,
               sum(product_volume_cm3) AS total_product_volume_cm3,
               avg(product_volume_cm3) AS average_product_volume_cm3,
               max(product_volume_cm3) AS maximum_product_volume_cm3,
               avg(product_photos_qty) AS average_product_photos, max(product_photos_qty) AS maximum_product_photos,
               count(*) - count(product_weight_g) AS missing_weight_item_count,
               count(*) - count(product_volume_cm3) AS missing_volume_item_count,
               count(*) - count(product_category_name) AS missing_category_item_count,
               first(seller_state ORDER BY price DESC, order_item_id, product_id, seller_id)
                   FILTER (WHERE seller_state IS NOT NULL AND price IS NOT NULL) AS primary_seller_state,
               min(shipping_limit_date) AS earliest_shipping_limit_date,
               max(shipping_limit_date) AS latest_shipping_limit_date
        FROM enriched GROUP BY order_id""",
    "payment_features": """
        SELECT order_id, count(*) AS payment_count, count(DISTINCT payment_type) AS payment_type_count,
               sum(payment_value) AS total_payment_value, avg(payment_value) AS average_payment_value,
               min(payment_value) AS minimum_payment_value, max(payment_value) AS maximum_payment_value,
               max(payment_value) AS primary_payment_value,
               max(payment_installments) AS maximum_installments, avg(payment_installments) AS average_installments,
               CAST(bool_or(payment_type = 'credit_card') AS INTEGER) AS used_credit_card,
               CAST(bool_or(payment_type = 'voucher') AS INTEGER) AS used_voucher,
               CAST(bool_or(payment_type = 'boleto') AS INTEGER) AS used_boleto,
               CAST(bool_or(payment_type = 'debit_card') AS INTEGER) AS used_debit_card,
               first(payment_type ORDER BY payment_value DESC, payment_sequential, payment_type)
                   FILTER (WHERE payment_value IS NOT NULL) AS primary_payment_type
        FROM d_payments GROUP BY order_id""",
    "joined": """
        SELECT o.*, c.* EXCLUDE (customer_id), i.* EXCLUDE (order_id), p.* EXCLUDE (order_id),
               CAST(customer_state = primary_seller_state AS INTEGER) AS same_state_delivery,
               CAST(i.order_id IS NOT NULL AS INTEGER) AS has_item_features,
               CAST(p.order_id IS NOT NULL AS INTEGER) AS has_payment_features,
               total_payment_value - (total_item_price + total_freight) AS payment_order_value_difference
        FROM d_orders o LEFT JOIN d_customers c ON o.customer_id = c.customer_id
        LEFT JOIN item_features i ON o.order_id = i.order_id
        LEFT JOIN payment_features p ON o.order_id = p.order_id""",
    "model": """
        SELECT order_id, customer_id, customer_unique_id, order_purchase_timestamp, order_approved_at,
               customer_state, primary_seller_state, primary_payment_type,
               year(order_purchase_timestamp) AS purchase_year, month(order_purchase_timestamp) AS purchase_month,
               dayofweek(order_purchase_timestamp) AS purchase_weekday, hour(order_purchase_timestamp) AS purchase_hour,
               same_state_delivery,
               date_diff('second', order_purchase_timestamp, order_approved_at) / 3600e0 AS approval_delay_hours,
               date_diff('second', order_purchase_timestamp, order_estimated_delivery_date) / 86400e0
                   AS promised_delivery_days,
               date_diff('second', order_purchase_timestamp, latest_shipping_limit_date) / 86400e0
                   AS seller_shipping_window_days,
               item_count, unique_product_count, unique_seller_count, unique_seller_state_count,
               unique_category_count, total_item_price, average_item_price, minimum_item_price, maximum_item_price,
               total_freight, average_freight_per_item, maximum_freight_per_item, freight_to_price_ratio,
               total_product_weight_g, average_product_weight_g, maximum_product_weight_g,
               total_product_volume_cm3, average_product_volume_cm3, maximum_product_volume_cm3,
               average_product_photos, maximum_product_photos, missing_weight_item_count,
               missing_volume_item_count, missing_category_item_count, payment_count, payment_type_count,
               total_payment_value, average_payment_value, minimum_payment_value, maximum_payment_value,
               maximum_installments, average_installments, used_credit_card, used_voucher, used_boleto,
               used_debit_card,
               CAST(order_delivered_customer_date > order_estimated_delivery_date AS INTEGER) AS late_delivery,
               date_diff('second', order_purchase_timestamp, order_delivered_customer_date) / 86400e0
                   AS actual_delivery_days,
               date_diff('second', order_estimated_delivery_date, order_delivered_customer_date) / 86400e0
                   AS lateness_days
        FROM joined
        WHERE order_status = 'delivered' AND has_item_features = 1 AND has_payment_features = 1
          AND order_purchase_timestamp IS NOT NULL AND order_approved_at IS NOT NULL
          AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL""",
    "parted": """
        SELECT *, CASE WHEN place < floor(n * 0.70::DOUBLE) THEN 'train'
                       WHEN place < floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS place,
                     count(*) OVER () AS n FROM model)""",
    "grouped": """
        SELECT *, strftime(order_purchase_timestamp, '%Y-%m') AS purchase_period,
               CASE WHEN same_state_delivery = 1 THEN 'same_state' ELSE 'cross_state_or_missing' END AS delivery_scope,
               CASE WHEN item_count > 1 THEN 'multi_item' ELSE 'single_item' END AS multi_item_group,
               CASE WHEN unique_seller_count > 1 THEN 'multi_seller' ELSE 'single_seller' END AS multi_seller_group,
               coalesce(primary_seller_state, 'missing') || '->' || coalesce(customer_state, 'missing')
                   AS seller_customer_route
        FROM model""",
    "scored": """
        SELECT CAST((l_linenumber * 37 + l_partkey) % 101 AS DOUBLE) / 100e0 AS score,
               CAST((l_orderkey * 7 + l_partkey) % 10 < 3 AS INTEGER) AS label
        FROM lineitem""",
    "young_orders": "SELECT * FROM orders WHERE o_orderstatus <> 'P'",
}

DEPENDS = {
    "enriched": ["d_items", "d_products", "d_sellers"],
    "item_features": ["enriched"],
    "payment_features": ["d_payments"],
    "joined": ["d_orders", "d_customers", "item_features", "payment_features"],
    "model": ["joined"],
    "parted": ["model"],
    "grouped": ["model"],
}


def _needed(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for n in [*_needed(DEPENDS.get(name, [])), name]:
            if n not in ordered:
                ordered.append(n)
    return ordered


def sql(body: str, uses: str = "", digits: int = 6, doubles: str = "") -> str:
    """Query text with the shared steps it uses; ``doubles`` names the columns to round."""
    steps = ", ".join(f"{n} AS ({STEPS[n]})" for n in _needed(uses.split()))
    text = f"WITH {steps} {body}" if steps else body
    if not doubles:
        return text
    replaced = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in doubles.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({text})"


ITEM_DOUBLES = (
    "total_item_price average_item_price minimum_item_price maximum_item_price total_freight "
    "average_freight_per_item maximum_freight_per_item freight_to_price_ratio total_product_weight_g "
    "average_product_weight_g maximum_product_weight_g total_product_volume_cm3 average_product_volume_cm3 "
    "maximum_product_volume_cm3 average_product_photos maximum_product_photos"
)
PAYMENT_DOUBLES = "total_payment_value average_payment_value minimum_payment_value maximum_payment_value average_installments"
TIME_DOUBLES = (
    "approval_delay_hours promised_delivery_days seller_shipping_window_days actual_delivery_days lateness_days"
)
MONEY = ["total_item_price", "total_freight", "total_payment_value"]
FEATURES = """customer_state primary_seller_state primary_payment_type purchase_year purchase_month purchase_weekday
    purchase_hour same_state_delivery approval_delay_hours promised_delivery_days seller_shipping_window_days item_count
    unique_product_count unique_seller_count unique_seller_state_count unique_category_count total_item_price
    average_item_price minimum_item_price maximum_item_price total_freight average_freight_per_item
    maximum_freight_per_item freight_to_price_ratio total_product_weight_g average_product_weight_g
    maximum_product_weight_g total_product_volume_cm3 average_product_volume_cm3 maximum_product_volume_cm3
    average_product_photos maximum_product_photos missing_weight_item_count missing_volume_item_count
    missing_category_item_count payment_count payment_type_count total_payment_value average_payment_value
    minimum_payment_value maximum_payment_value maximum_installments average_installments used_credit_card used_voucher
    used_boleto used_debit_card""".split()
CATEGORICAL, NUMERICAL = FEATURES[:7], FEATURES[7:]
SUMMARISED = [*NUMERICAL, "late_delivery", "actual_delivery_days"]
GROUPED = [*CATEGORICAL, "delivery_scope", "multi_item_group", "multi_seller_group"]
RANKED = [*MONEY, "item_count", "total_product_weight_g", "total_product_volume_cm3", "actual_delivery_days"]


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


# --- sources and quality ------------------------------------------------------------------------

TABLES = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6}
ORACLES["table_row_counts"] = union(
    [
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS column_count FROM {t}"
        for t, n in TABLES.items()
    ]
)

LINE_TYPES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
ORACLES["profile_columns"] = union(
    [
        f"SELECT 'lineitem' AS table_name, '{c}' AS column_name, CAST({i} AS BIGINT) AS position, "
        f"'{kind}' AS data_type, count(*) AS row_count, count(*) - count({c}) AS missing_count FROM lineitem"
        for i, (c, kind) in enumerate((x.split() for x in LINE_TYPES.split(", ")), 1)
    ]
)
ORACLES["scan_projected"] = "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity >= 45"


def _pk(name: str, table: str, keys: str) -> str:
    null_key = " OR ".join(f"{k} IS NULL" for k in keys.split(", "))
    return f"""
        SELECT '{name}' AS table_name, (SELECT count(*) FROM {table}) AS row_count,
               (SELECT count(*) FROM {table} WHERE {null_key}) AS null_key_rows,
               count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows_after_first,
               CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows_all
        FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys})"""


ORACLES["pk_check"] = union(
    [
        _pk("lineitem", "lineitem", "l_orderkey, l_linenumber"),
        _pk("lineitem_full", "lineitem", "l_orderkey, l_linenumber, l_partkey, l_suppkey"),
        _pk("orders", "orders", "o_orderkey"),
    ]
)
ORACLES["duplicate_keys"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1"
)


def _fk(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    orphan = f"{key} IS NULL OR {key} NOT IN (SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL)"
    return f"""
        SELECT '{name}' AS relationship, count(*) AS child_rows, count(DISTINCT {key}) AS distinct_child_keys,
               (SELECT count(DISTINCT {parent_key}) FROM {parent}) AS distinct_parent_keys,
               count(*) FILTER (WHERE {orphan}) AS orphan_rows,
               count(DISTINCT {key}) FILTER (WHERE {orphan}) AS distinct_orphan_keys,
               CASE WHEN count(*) FILTER (WHERE {orphan}) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM {child}"""


ORACLES["fk_check"] = sql(_fk("line -> order", "lineitem", "l_orderkey", "young_orders", "o_orderkey"), "young_orders")
ORACLES["fk_orphans"] = sql(
    "SELECT l_orderkey, count(*) AS row_count FROM lineitem WHERE NOT EXISTS "
    "(SELECT 1 FROM young_orders WHERE o_orderkey = l_orderkey) GROUP BY l_orderkey",
    "young_orders",
)
ORACLES["fk_check_all"] = union(
    [
        _fk("orders.customer_id -> customers.customer_id", "orders", "o_custkey", "customer", "c_custkey"),
        _fk("order_items.order_id -> orders.order_id", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _fk("order_items.product_id -> products.product_id", "lineitem", "l_partkey", "part", "p_partkey"),
        _fk("order_items.seller_id -> sellers.seller_id", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _fk("payments.order_id -> orders.order_id", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ]
)
PER_ORDER = "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey"
ORACLES["key_multiplicity"] = f"""
    SELECT count(*) AS unique_keys, count(*) FILTER (WHERE n = 1) AS keys_with_one_row,
           count(*) FILTER (WHERE n > 1) AS keys_with_many_rows, max(n) AS maximum_rows_per_key FROM ({PER_ORDER})"""
ORACLES["key_multiplicity_top"] = (
    f"SELECT l_orderkey, n AS row_count FROM ({PER_ORDER}) ORDER BY n DESC, l_orderkey LIMIT 5"
)
PRODUCT_TYPES = {
    "product_id": "bigint",
    "product_category_name": "string",
    **dict.fromkeys(
        [
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ],
        "double",
    ),
}
ORACLES["missing_values"] = sql(
    union(
        [
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
            f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS missing_rate, '{kind}' AS data_type FROM d_products"
            for c, kind in PRODUCT_TYPES.items()
        ]
    ),
    "d_products",
    9,
    "missing_rate",
)


def _keyed(side: str, table: str) -> str:
    counts = f"(SELECT order_id, count(*) AS n FROM {table} GROUP BY order_id)"
    return (
        f"(SELECT count(*) FROM {table}) AS {side}_rows, (SELECT count(DISTINCT order_id) FROM {table}) AS {side}_keys, "
        f"(SELECT count(*) FROM {counts} WHERE n > 1) AS {side}_duplicate_keys"
    )


ORACLES["join_row_preservation"] = sql(
    f"""SELECT *, CASE WHEN before_rows = after_rows AND before_keys = after_keys
                        AND before_duplicate_keys = after_duplicate_keys THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT {_keyed("before", "d_items")}, {_keyed("after", "enriched")})""",
    "enriched",
)
ORACLES["rollup_reconcile"] = sql(
    f"""SELECT source_rows, source_keys, rolled_rows, rolled_duplicate_keys, counted_rows,
               CASE WHEN source_keys = rolled_rows AND rolled_duplicate_keys = 0 AND counted_rows = source_rows
                    THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT {_keyed("source", "d_items")}, {_keyed("rolled", "item_features")},
                     (SELECT CAST(sum(item_count) AS BIGINT) FROM item_features) AS counted_rows)""",
    "item_features",
)


def _totals(measure: str, source: str, rolled: str) -> str:
    def exact(column: str, table: str) -> str:
        return f"(SELECT CAST(sum(CAST({column} AS DECIMAL(18,4))) AS DOUBLE) FROM {table})"

    return f"""SELECT '{measure}' AS measure, {exact(source, "d_items")} AS source_total,
                      {exact(rolled, "item_features")} AS rolled_total"""


ORACLES["totals_reconcile"] = sql(
    f"""SELECT *, abs(source_total - rolled_total) AS difference,
               CASE WHEN abs(source_total - rolled_total) <= 0.01 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM ({union([_totals("price", "price", "total_item_price"), _totals("freight", "freight_value", "total_freight")])})""",
    "item_features",
    2,
    "source_total rolled_total difference",
)
GAP_COUNTS = """count(*) AS row_count, count(*) FILTER (WHERE has_item_features = 0) AS orders_without_items,
    count(*) FILTER (WHERE has_payment_features = 0) AS orders_without_payments,
    count(*) FILTER (WHERE customer_state IS NULL) AS orders_without_customer_state"""
ORACLES["missing_join_summary"] = sql(f"SELECT {GAP_COUNTS} FROM joined", "joined")
ORACLES["missing_join_by_status"] = sql(
    f"SELECT order_status, {GAP_COUNTS} FROM joined GROUP BY order_status", "joined"
)
ORACLES["value_reconciliation"] = sql(
    """SELECT count(*) AS comparable_rows, count(*) FILTER (WHERE gap <= 0.01) AS matching_rows,
              avg(gap) AS mean_absolute_difference, max(gap) AS maximum_absolute_difference
       FROM (SELECT abs(payment_order_value_difference) AS gap FROM joined) WHERE gap IS NOT NULL""",
    "joined",
    4,
    "mean_absolute_difference maximum_absolute_difference",
)
ORACLES["label_checks"] = """
    SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_keys,
           count(*) FILTER (WHERE d IS NULL) AS null_ship_days, count(*) FILTER (WHERE d < 0) AS negative_ship_days
    FROM (SELECT l_orderkey, date_diff('second', o_orderdate, l_shipdate) AS d
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""


def _domain(column: str, table: str, bad: str) -> str:
    return f"""SELECT '{column}' AS target, count(*) AS row_count, count(*) - count({column}) AS null_rows,
                      count(*) FILTER (WHERE {bad}) AS out_of_domain_rows,
                      CASE WHEN count({column}) = count(*) AND count(*) FILTER (WHERE {bad}) = 0
                           THEN 'PASSED' ELSE 'FAILED' END AS status FROM {table}"""


ORACLES["target_domain"] = sql(
    union(
        [
            *[_domain(c, "labels", f"{c} NOT IN (0, 1)") for c in ("quality", "toxic")],
            _domain("late_delivery", "model", "late_delivery NOT IN (0, 1)"),
            *[_domain(c, "model", f"{c} < 0") for c in ("actual_delivery_days", "lateness_days")],
        ]
    ),
    "model",
)
RECONCILED = """
    SELECT coalesce(o_orderkey, l_orderkey) AS order_id, o_totalprice AS left_value, total AS right_value,
           CASE WHEN l_orderkey IS NULL THEN 'MISSING' WHEN o_orderkey IS NULL THEN 'UNEXPECTED'
                WHEN abs(o_totalprice - total) <= 150000 THEN 'MATCH' ELSE 'MISMATCH' END AS status
    FROM young_orders FULL OUTER JOIN
         (SELECT l_orderkey, sum(l_extendedprice) AS total FROM lineitem GROUP BY l_orderkey)
         ON o_orderkey = l_orderkey"""
ORACLES["reconcile_two_tables"] = sql(RECONCILED, "young_orders", 4, "left_value right_value")
ORACLES["reconcile_summary"] = sql(
    f"""SELECT status, count(*) AS row_count, CAST(sum(CAST(left_value AS DECIMAL(18,4))) AS DOUBLE) AS left_total,
               CAST(sum(CAST(right_value AS DECIMAL(18,4))) AS DOUBLE) AS right_total
        FROM ({RECONCILED}) GROUP BY status""",
    "young_orders",
    2,
    "left_total right_total",
)

# --- rollups and the labelled table -------------------------------------------------------------

ORACLES["enrich_items"] = sql("SELECT * FROM enriched", "enriched", 6, "price freight_value product_volume_cm3")
ORACLES["order_item_rollup"] = sql("SELECT * FROM item_features", "item_features", 8, ITEM_DOUBLES)
ORACLES["payment_rollup"] = sql(
    "SELECT * FROM payment_features", "payment_features", 8, PAYMENT_DOUBLES + " primary_payment_value"
)
ORACLES["joined_orders"] = sql(
    "SELECT * FROM joined",
    "joined",
    7,
    f"{ITEM_DOUBLES} {PAYMENT_DOUBLES} primary_payment_value payment_order_value_difference",
)
ORACLES["model_dataset"] = sql("SELECT * FROM model", "model", 8, f"{ITEM_DOUBLES} {PAYMENT_DOUBLES} {TIME_DOUBLES}")
EVENT_TIME = """year(ts) AS purchase_year, month(ts) AS purchase_month, dayofweek(ts) AS purchase_weekday,
    hour(ts) AS purchase_hour"""
ORACLES["purchase_time_features"] = f"SELECT event_id, {EVENT_TIME} FROM events"
ORACLES["duration_features"] = sql(
    """SELECT event_id, date_diff('second', ts, later) AS seconds, date_diff('second', ts, later) / 3600e0 AS hours,
              date_diff('second', later, ts) / 86400e0 AS days
       FROM (SELECT event_id, ts, ts + to_milliseconds((event_id % 1000) * 100) AS later FROM events)""",
    "",
    9,
    "hours days",
)
CLOCK_FLAGS = """CAST(purchase_weekday IN (0, 6) AS INTEGER) AS is_weekend_purchase,
    CAST(purchase_hour < 6 OR purchase_hour >= 22 AS INTEGER) AS is_night_purchase,
    CAST(purchase_hour >= 9 AND purchase_hour < 18 AS INTEGER) AS is_business_hours"""
ORACLES["calendar_flags"] = sql(
    f"""SELECT order_id, {CLOCK_FLAGS},
               CAST(coalesce(same_state_delivery = 0, false) AS INTEGER) AS cross_state_delivery FROM model""",
    "model",
)
CYCLES = [("month", "purchase_month - 1", 12), ("weekday", "purchase_weekday", 7), ("hour", "purchase_hour", 24)]
WAVES = ", ".join(f"{f}(2 * pi() * ({x}) / {p}) AS {n}_{f}" for n, x, p in CYCLES for f in ("sin", "cos"))
ORACLES["cyclic_features"] = sql(
    f"SELECT event_id, {WAVES}, {CLOCK_FLAGS} FROM (SELECT event_id, {EVENT_TIME} FROM events)",
    "",
    9,
    " ".join(f"{n}_{f}" for n, _, _ in CYCLES for f in ("sin", "cos")),
)
ORACLES["multi_flags"] = sql(
    """SELECT order_id, CAST(item_count > 1 AS INTEGER) AS is_multi_item_order,
              CAST(unique_product_count > 1 AS INTEGER) AS is_multi_product_order,
              CAST(unique_seller_count > 1 AS INTEGER) AS is_multi_seller_order,
              CAST(unique_category_count > 1 AS INTEGER) AS is_multi_category_order,
              CAST(maximum_installments > 1 AS INTEGER) AS is_installment_payment FROM model""",
    "model",
)
RATIOS = {
    "items_per_seller": ("item_count", "unique_seller_count"),
    "products_per_seller": ("unique_product_count", "unique_seller_count"),
    "categories_per_seller": ("unique_category_count", "unique_seller_count"),
    "price_per_item": ("total_item_price", "item_count"),
    "freight_per_item": ("total_freight", "item_count"),
    "freight_to_payment_ratio": ("total_freight", "total_payment_value"),
    "payment_to_item_price_ratio": ("total_payment_value", "total_item_price"),
    "installment_value": ("total_payment_value", "maximum_installments"),
    "weight_per_item": ("total_product_weight_g", "item_count"),
    "volume_per_item": ("total_product_volume_cm3", "item_count"),
    "density_g_per_cm3": ("total_product_weight_g", "total_product_volume_cm3"),
    "shipping_window_to_promised_ratio": ("seller_shipping_window_days", "promised_delivery_days"),
    "approval_delay_to_promised_ratio": ("approval_delay_hours", "promised_delivery_days"),
    "freight_per_kg": ("total_freight", "(total_product_weight_g / 1000e0)"),
}
ORACLES["ratio_features"] = sql(
    "SELECT order_id, "
    + ", ".join(f"CASE WHEN {d} <> 0 THEN CAST({n} AS DOUBLE) / {d} END AS {r}" for r, (n, d) in RATIOS.items())
    + ", average_product_photos AS photos_per_item,"
    " promised_delivery_days - seller_shipping_window_days AS promised_minus_shipping_window"
    f" FROM (SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in MONEY)}) FROM model)",
    "model",
)
LOGS = {
    "log1p_total_item_price": "total_item_price",
    "log1p_total_freight": "total_freight",
    "log1p_total_weight": "total_product_weight_g",
    "log1p_total_volume": "total_product_volume_cm3",
    "log1p_payment_value": "total_payment_value",
}
ORACLES["log_features"] = sql(
    "SELECT order_id, "
    + ", ".join(f"CASE WHEN {c} >= 0 THEN ln(1 + {c}) END AS {n}" for n, c in LOGS.items())
    + " FROM model",
    "model",
    8,
    " ".join(LOGS),
)
ORACLES["reporting_groups"] = sql(
    """SELECT order_id, purchase_period, delivery_scope, multi_item_group, multi_seller_group, seller_customer_route
       FROM grouped""",
    "grouped",
)
ROUTE = "coalesce(primary_seller_state, '<missing>') || '->' || coalesce(customer_state, '<missing>')"
ORACLES["route_frequency"] = sql(
    f"""SELECT order_id, {ROUTE} AS seller_customer_route, coalesce(share, 0e0) AS route_frequency
        FROM parted LEFT JOIN
             (SELECT {ROUTE} AS route, count(*) / CAST((SELECT count(*) FROM parted WHERE split = 'train') AS DOUBLE) AS share
              FROM parted WHERE split = 'train' GROUP BY 1) ON route = {ROUTE}""",
    "parted",
    9,
    "route_frequency",
)

# --- reports ------------------------------------------------------------------------------------

ORACLES["status_distribution"] = sql(
    "SELECT order_status, count(*) AS row_count FROM d_orders GROUP BY order_status", "d_orders"
)
ORACLES["type_distribution"] = sql(
    """SELECT payment_type, count(*) AS payment_rows, count(DISTINCT order_id) AS orders,
              sum(payment_value) AS total_value FROM d_payments GROUP BY payment_type""",
    "d_payments",
    3,
    "total_value",
)
ORACLES["label_share"] = sql(
    """SELECT late_delivery, count(*) AS row_count, CAST(100.0 * count(*) / sum(count(*)) OVER () AS DOUBLE) AS percentage
       FROM model GROUP BY late_delivery""",
    "model",
    9,
    "percentage",
)
ORACLES["date_range"] = sql(
    """SELECT min(order_purchase_timestamp) AS earliest, max(order_purchase_timestamp) AS latest,
              count(DISTINCT purchase_year) AS years FROM model""",
    "model",
)
ORACLES["largest_orders"] = sql(
    """SELECT order_id, item_count, unique_product_count, unique_seller_count, total_item_price FROM item_features
       ORDER BY item_count DESC, order_id LIMIT 10""",
    "item_features",
    4,
    "total_item_price",
)
ORACLES["most_payments"] = sql(
    """SELECT order_id, payment_count, payment_type_count, total_payment_value FROM payment_features
       ORDER BY payment_count DESC, order_id LIMIT 10""",
    "payment_features",
    4,
    "total_payment_value",
)
ORACLES["earliest_orders"] = sql(
    """SELECT order_id, order_status, customer_state, primary_seller_state, order_purchase_timestamp FROM joined
       WHERE has_item_features = 1 AND has_payment_features = 1
       ORDER BY order_purchase_timestamp, order_id LIMIT 10""",
    "joined",
)


# --- split --------------------------------------------------------------------------------------


def _split(table: str, time: str, key: str, first: str, second: str) -> str:
    return f"""
        SELECT {key}, {time}, CASE WHEN place < floor(n * {first}::DOUBLE) THEN 'train'
               WHEN place < floor(n * {second}::DOUBLE) THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT {key}, {time}, row_number() OVER (ORDER BY {time}, {key}) - 1 AS place, count(*) OVER () AS n
              FROM {table})"""


ORACLES["chronological_split"] = _split("orders", "o_orderdate", "o_orderkey", "0.70", "0.85")
ORACLES["split_events"] = _split("events", "ts", "event_id", "0.5", "0.9")
ORACLES["split_summary"] = sql(
    f"""SELECT split, count(*) AS row_count, count(DISTINCT order_id) AS distinct_keys,
               min(order_purchase_timestamp) AS start_time, max(order_purchase_timestamp) AS end_time,
               CAST(sum(late_delivery) AS BIGINT) AS positives,
               CAST(100.0 * sum(late_delivery) / count(*) AS DOUBLE) AS positive_percentage,
               avg(actual_delivery_days) AS mean_measure, median(actual_delivery_days) AS median_measure,
               CAST(sum({" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in FEATURES)}) AS BIGINT) AS missing_cells
        FROM parted GROUP BY split""",
    "parted",
    6,
    "positive_percentage mean_measure median_measure",
)
ORACLES["split_overlap"] = sql(
    """SELECT customer_id, min(split) AS first_split, max(split) AS last_split, count(*) AS row_count
       FROM parted GROUP BY customer_id HAVING count(DISTINCT split) > 1""",
    "parted",
)

# --- profiles -----------------------------------------------------------------------------------

ORACLES["target_distribution"] = sql(
    """SELECT 'actual_delivery_days' AS measure, min(actual_delivery_days) AS minimum_value,
              avg(actual_delivery_days) AS mean_value, max(actual_delivery_days) AS maximum_value,
              median(actual_delivery_days) AS median_value, quantile_cont(actual_delivery_days, 0.95) AS p95_value
       FROM model""",
    "model",
    6,
    "minimum_value mean_value maximum_value median_value p95_value",
)
ORACLES["line_quantiles"] = sql(
    """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS p25, median(l_extendedprice) AS median,
              quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem GROUP BY l_returnflag""",
    "",
    4,
    "p25 median p95",
)
PERCENTILES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def _summary(column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    cuts = ", ".join(f"quantile_cont({v}, {p}) AS {name}" for name, p in PERCENTILES.items())
    fences = (
        f"(SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM model)"
    )
    return f"""
        SELECT '{column}' AS column_name, count({column}) AS non_missing_count, count(*) - count({column}) AS missing_count,
               avg({v}) AS mean, stddev_samp({v}) AS std, min({v}) AS minimum, {cuts}, max({v}) AS maximum,
               CASE WHEN min({v}) = max({v}) AND count({v}) > 2 THEN 0 ELSE skewness({v}) END AS skewness,
               count(*) FILTER (WHERE {v} < q1 - 1.5 * (q3 - q1) OR {v} > q3 + 1.5 * (q3 - q1)) AS iqr_outlier_count,
               count(*) FILTER (WHERE {v} < 0) AS negative_count
        FROM model, {fences}"""


ORACLES["numerical_summary"] = sql(
    union([_summary(c) for c in SUMMARISED]),
    "model",
    7,
    "mean std minimum p01 p05 p25 median p75 p95 p99 maximum skewness",
)


def _categories(column: str) -> str:
    return f"""
        SELECT '{column}' AS feature, category, row_count, row_count / CAST(sum(row_count) OVER () AS DOUBLE) AS rate,
               row_number() OVER (ORDER BY row_count DESC, category) AS rank
        FROM (SELECT coalesce(CAST({column} AS VARCHAR), '<missing>') AS category, count(*) AS row_count
              FROM grouped GROUP BY 1)"""


ORACLES["categorical_summary"] = sql(
    union([_categories(c) for c in [*GROUPED, "seller_customer_route"]]), "grouped", 9, "rate"
)
ORACLES["suspicious_columns"] = sql(
    "SELECT * FROM ("
    + union(
        [
            f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS minimum, count(*) FILTER (WHERE {c} < 0) AS negative_count FROM model"
            for c in [*SUMMARISED, "lateness_days"]
        ]
    )
    + ") WHERE minimum < 0 OR negative_count > 0",
    "model",
    6,
    "minimum",
)
TARGETS = """count(*) AS order_count, avg(late_delivery) AS late_delivery_rate,
    avg(actual_delivery_days) AS mean_actual_delivery_days, median(actual_delivery_days) AS median_actual_delivery_days"""
TARGET_DOUBLES = "late_delivery_rate mean_actual_delivery_days median_actual_delivery_days"


def _targets(feature: str, category: str, kind: str, source: str) -> str:
    return f"""SELECT '{feature}' AS feature, {category} AS category, {TARGETS}, {kind}{"" if " AS " in kind else " AS group_type"}
               FROM {source} GROUP BY 2"""


ORACLES["target_by_category"] = sql(
    union([_targets(c, f"coalesce(CAST({c} AS VARCHAR), '<missing>')", "'category'", "grouped") for c in GROUPED]),
    "grouped",
    8,
    TARGET_DOUBLES,
)


def _quartiles(column: str) -> str:
    """Bucket = number of distinct inner edges below the value (edges equal to an outer one collapse); columns with fewer
    than four values are grouped by value."""
    edges = ", ".join(f"quantile_cont(CAST({column} AS DOUBLE), {p}) AS e{i}" for i, p in enumerate((0, 0.25, 0.5, 0.75, 1)))
    inner = "list_filter(list_distinct([e1, e2, e3]), lambda x: x > e0 AND x < e4)"
    number = f"1 + len(list_filter({inner}, lambda x: x < CAST({column} AS DOUBLE)))"
    bucket = f"CASE WHEN {column} IS NULL THEN '<missing>' ELSE 'q' || CAST({number} AS VARCHAR) END"
    category = f"CASE WHEN d < 4 THEN CAST(CAST(coalesce({column}, -1) AS DOUBLE) AS VARCHAR) ELSE {bucket} END"
    bounds = "list_sort(list_distinct([e0, e1, e2, e3, e4]))"
    lower, upper = (f"any_value(CASE WHEN d >= 4 AND {column} IS NOT NULL THEN {bounds}[{number} + {i}] END)" for i in (0, 1))
    kind = f"CASE WHEN any_value(d) < 4 THEN 'value' ELSE 'quartile' END AS group_type, {lower} AS lower_bound, {upper} AS upper_bound"
    return _targets(column, category, kind, f"model, (SELECT {edges}, count(DISTINCT {column}) AS d FROM model)")


ORACLES["target_by_quartile"] = sql(
    union([_quartiles(c) for c in NUMERICAL]),
    "model",
    8,
    TARGET_DOUBLES + " lower_bound upper_bound",
)
ORACLES["top_routes"] = sql(
    _targets(
        "seller_customer_route",
        """CASE WHEN seller_customer_route IN
                (SELECT seller_customer_route FROM grouped GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12)
                THEN seller_customer_route ELSE 'other_route' END""",
        "'top_route'",
        "grouped",
    ),
    "grouped",
    8,
    TARGET_DOUBLES,
)
ORACLES["group_target_top"] = sql(
    """SELECT customer_state, count(*) AS orders, avg(late_delivery) AS late_rate,
              avg(actual_delivery_days) AS delivery_days
       FROM model WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY orders DESC, customer_state LIMIT 12""",
    "model",
    8,
    "late_rate delivery_days",
)
ORACLES["monthly_trend"] = sql(
    """SELECT purchase_period AS period, count(*) AS orders, avg(late_delivery) AS late_rate,
              avg(actual_delivery_days) AS mean_days FROM grouped GROUP BY 1""",
    "grouped",
    8,
    "late_rate mean_days",
)


def _histogram(column: str, bins: int, source: str) -> str:
    return f"""
        SELECT '{column}' AS column_name, bin, lo + (hi - lo) * bin / {bins} AS lower,
               lo + (hi - lo) * (bin + 1) / {bins} AS upper, coalesce(row_count, 0) AS row_count
        FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}), (SELECT unnest(range({bins})) AS bin)
        LEFT JOIN (SELECT least(CAST(floor(({column} - a) / (b - a) * {bins}) AS BIGINT), {bins - 1}) AS bin,
                          count(*) AS row_count
                   FROM {source}, (SELECT min({column}) AS a, max({column}) AS b FROM {source}) GROUP BY 1) USING (bin)"""


ORACLES["histogram"] = sql(_histogram("l_extendedprice", 50, "lineitem"), "", 4, "lower upper")
ORACLES["clipped_histogram"] = sql(
    union(
        [
            _histogram(
                c, 35, f"(SELECT least({c}, (SELECT quantile_cont({c}, 0.99) FROM model)) AS {c} FROM model WHERE {c} IS NOT NULL)"
            )
            for c in MONEY
        ]
    ),
    "model",
    4,
    "lower upper",
)


def _numeric_drift(column: str, source: str) -> str:
    v, train, late = f"CAST({column} AS DOUBLE)", "split = 'train'", "split = 'validation'"
    deciles = ", ".join(f"quantile_cont({v}, {i / 10})" for i in range(11))
    edges = f"(SELECT list_sort(list_distinct([{deciles}])) AS e FROM {source} WHERE {train})"
    binned = f"""
        SELECT len(list_filter(e[2:-2], lambda x: x < {v})) AS bin, count(*) FILTER (WHERE {train}) AS p,
               count(*) FILTER (WHERE {late}) AS q
        FROM {source}, {edges} WHERE {column} IS NOT NULL AND ({train} OR {late}) GROUP BY 1"""
    shares = f"""SELECT p / CAST(sum(p) OVER () AS DOUBLE) + 1e-6 AS p, q / CAST(sum(q) OVER () AS DOUBLE) + 1e-6 AS q
                 FROM ({binned})"""
    return f"""
        SELECT '{column}' AS feature, avg(CAST({column} IS NULL AS INTEGER)) FILTER (WHERE {train}) AS train_missing_rate,
               avg(CAST({column} IS NULL AS INTEGER)) FILTER (WHERE {late}) AS validation_missing_rate,
               avg({v}) FILTER (WHERE {train}) AS train_mean, avg({v}) FILTER (WHERE {late}) AS validation_mean,
               (SELECT sum((q - p) * ln(q / p)) FROM ({shares})) AS population_stability_index,
               avg({v}) FILTER (WHERE {late}) - avg({v}) FILTER (WHERE {train}) AS mean_difference
        FROM {source}"""


DRIFT_DOUBLES = (
    "train_missing_rate validation_missing_rate train_mean validation_mean population_stability_index mean_difference"
)
ORACLES["numeric_drift"] = sql(
    union([_numeric_drift(c, "parted") for c in NUMERICAL]), "parted", 6, DRIFT_DOUBLES
)
SPLIT_EVENTS = f"(SELECT * FROM events JOIN ({ORACLES['split_events']}) USING (event_id, ts))"
ORACLES["event_drift"] = sql(
    union([_numeric_drift(c, SPLIT_EVENTS) for c in ("value", "user_id")]), "", 6, DRIFT_DOUBLES
)


def _categorical_drift(column: str) -> str:
    train, late = "split = 'train'", "split = 'validation'"
    counts = f"""
        SELECT coalesce(CAST({column} AS VARCHAR), '<missing>') AS category, count(*) FILTER (WHERE {train}) AS p,
               count(*) FILTER (WHERE {late}) AS q FROM parted WHERE {train} OR {late} GROUP BY 1"""
    shares = f"""SELECT p / CAST(sum(p) OVER () AS DOUBLE) AS p, q / CAST(sum(q) OVER () AS DOUBLE) AS q FROM ({counts})"""
    return f"""
        SELECT '{column}' AS feature, avg(CAST({column} IS NULL AS INTEGER)) FILTER (WHERE {train}) AS train_missing_rate,
               avg(CAST({column} IS NULL AS INTEGER)) FILTER (WHERE {late}) AS validation_missing_rate,
               (SELECT 0.5 * sum(abs(p - q)) FROM ({shares})) AS total_variation_distance,
               (SELECT coalesce(sum(q) FILTER (WHERE p = 0), 0) FROM ({shares})) AS validation_unseen_rate
        FROM parted"""


ORACLES["categorical_drift"] = sql(
    union([_categorical_drift(c) for c in CATEGORICAL]),
    "parted",
    9,
    "train_missing_rate validation_missing_rate total_variation_distance validation_unseen_rate",
)

ORACLES["drift_ranking"] = sql(
    "SELECT * FROM ("
    + union(
        [
            *[
                f"SELECT feature, 'numeric' AS feature_type, population_stability_index AS drift_score, 0e0 AS validation_unseen_rate FROM ({_numeric_drift(c, 'parted')})"
                for c in NUMERICAL
            ],
            *[
                f"SELECT feature, 'categorical' AS feature_type, total_variation_distance AS drift_score, validation_unseen_rate FROM ({_categorical_drift(c)})"
                for c in CATEGORICAL
            ],
        ]
    )
    + ") ORDER BY drift_score DESC, feature LIMIT 10",
    "parted",
    6,
    "drift_score validation_unseen_rate",
)
ORACLES["outlier_columns"] = sql(
    "SELECT column_name, iqr_outlier_count FROM ("
    + union([_summary(c) for c in FEATURES[7:]])
    + ") ORDER BY iqr_outlier_count DESC, column_name LIMIT 10",
    "model",
)


def _spearman(a: str, b: str) -> str:
    def rank(c: str) -> str:
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0"

    return f"""
        SELECT '{a}' AS left_column, '{b}' AS right_column, count(*) AS pair_count, corr(x, y) AS value
        FROM (SELECT {rank(a)} AS x, {rank(b)} AS y FROM model WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


ORACLES["spearman_pairs"] = sql(
    "SELECT * FROM (" + union([_spearman(a, b) for a, b in combinations(RANKED, 2)]) + ") WHERE pair_count >= 100 AND NOT isnan(value)",
    "model",
    7,
    "value",
)
_LONG = union([f"SELECT order_id, '{c}' AS c, round(CAST({c} AS DOUBLE), 8) AS v FROM model WHERE {c} IS NOT NULL" for c in SUMMARISED])
_OWN = union([f"SELECT '{c}' AS left_column, '{c}' AS right_column, count({c}) AS pair_count, CASE WHEN min({c}) < max({c}) THEN 1e0 END AS value FROM model" for c in SUMMARISED])
_RANKS = ", ".join(
    f"rank() OVER (PARTITION BY l, r ORDER BY {v}) + (count(*) OVER (PARTITION BY l, r, {v}) - 1) / 2e0 AS {v}_rank" for v in ("x", "y")
)
ORACLES["correlation_matrix"] = sql(
    f"""SELECT CASE flip WHEN 0 THEN l ELSE r END AS left_column, CASE flip WHEN 0 THEN r ELSE l END AS right_column, pair_count, value
        FROM (SELECT l, r, count(*) AS pair_count, corr(x_rank, y_rank) AS value
              FROM (SELECT l, r, {_RANKS}
                    FROM (SELECT a.c AS l, b.c AS r, a.v AS x, b.v AS y FROM ({_LONG}) a JOIN ({_LONG}) b ON a.order_id = b.order_id AND a.c < b.c))
              GROUP BY l, r), (SELECT unnest([0, 1]) AS flip) WHERE NOT isnan(value)
        UNION ALL {_OWN}""",
    "model",
    7,
    "value",
)
TEXT, LONGS, INTS = FEATURES[:3], [*FEATURES[3:7], *FEATURES[11:16], *FEATURES[32:37]], [FEATURES[7], FEATURES[41], *FEATURES[43:47]]
NUMBERS = [c for c in FEATURES if c not in {*TEXT, *LONGS, *INTS}]
SAME_TYPE = [pair for kind in (TEXT, LONGS, INTS, NUMBERS) for pair in combinations(sorted(kind, key=FEATURES.index), 2)]
ORACLES["duplicate_columns"] = sql(
    "SELECT left_column, right_column, CAST(1 AS DOUBLE) AS value FROM ("
    + union(
        [
            f"SELECT '{a}' AS left_column, '{b}' AS right_column, count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) AS n FROM model"
            for a, b in SAME_TYPE
        ]
    )
    + ") WHERE n = 0",
    "model",
)

# --- preparation --------------------------------------------------------------------------------

ORACLES["median_impute"] = sql(
    "SELECT order_id, "
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM parted WHERE split = 'train')) AS {c}" for c in NUMERICAL)
    + " FROM parted",
    "parted",
    8,
    " ".join(NUMERICAL),
)


def _mode(column: str) -> str:
    return f"""coalesce(CAST({column} AS VARCHAR), (SELECT CAST({column} AS VARCHAR) FROM d_products
        WHERE product_height_cm <= 10 AND {column} IS NOT NULL GROUP BY {column}
        ORDER BY count(*) DESC, {column} LIMIT 1)) AS {column}"""


ORACLES["mode_impute"] = sql(
    f"SELECT product_id, {_mode('product_category_name')}, {_mode('product_weight_g')} FROM d_products", "d_products"
)


def _scaled(column: str) -> str:
    part = "FROM parted WHERE split = 'train'"
    return f"""({column} - (SELECT avg({column}) {part}))
        / (SELECT CASE WHEN stddev_pop({column}) = 0 THEN 1 ELSE stddev_pop({column}) END {part}) AS {column}"""


ORACLES["standardize"] = sql(
    f"SELECT order_id, {', '.join(_scaled(c) for c in NUMERICAL)} FROM parted", "parted", 7, " ".join(NUMERICAL)
)
ORACLES["one_hot"] = sql(
    "SELECT order_id, "
    + ", ".join(
        f"CAST(primary_payment_type = '{x}' AS INTEGER) AS is_{x}" for x in ("AO", "RO", "boleto", "debit_card", "voucher")
    )
    + " FROM model",
    "model",
)
ORACLES["class_weights"] = sql(
    """SELECT late_delivery AS label, count(*) AS row_count, sum(count(*)) OVER () / (2e0 * count(*)) AS balanced_weight,
              sum(count(*) FILTER (WHERE late_delivery = 0)) OVER ()
                  / CAST(sum(count(*) FILTER (WHERE late_delivery = 1)) OVER () AS DOUBLE) AS positive_weight
       FROM parted WHERE split = 'train' GROUP BY late_delivery""",
    "parted",
    9,
    "balanced_weight positive_weight",
)

# --- evaluation ---------------------------------------------------------------------------------


def _counts(threshold: str) -> str:
    return f"""count(*) FILTER (WHERE label = 0 AND score < {threshold}) AS true_negative,
        count(*) FILTER (WHERE label = 0 AND score >= {threshold}) AS false_positive,
        count(*) FILTER (WHERE label = 1 AND score < {threshold}) AS false_negative,
        count(*) FILTER (WHERE label = 1 AND score >= {threshold}) AS true_positive"""


METRICS = """CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END AS f1_score,
    CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) ELSE 0 END AS accuracy"""
SHORT = "true_negative AS tn, false_positive AS fp, false_negative AS fn, true_positive AS tp"
METRIC_NAMES = "precision recall f1_score accuracy"
AT_065 = f"SELECT {_counts('65e0 / 100')} FROM scored"
ORACLES["confusion_matrix"] = sql(AT_065, "scored")
ORACLES["classification_metrics"] = sql(
    f"SELECT * EXCLUDE (tn, fp, fn, tp), {METRICS} FROM (SELECT *, {SHORT} FROM ({AT_065}))", "scored", 9, METRIC_NAMES
)
CLASS_ROWS = f"""
    SELECT '1' AS class, {METRICS}, tp + fn AS support FROM c
    UNION ALL SELECT '0', {METRICS}, tp + fn FROM (SELECT tn AS tp, fn AS fp, fp AS fn, tp AS tn FROM c)"""
ORACLES["classification_report"] = sql(
    f"""SELECT class, precision, recall, f1_score, support FROM (
          WITH c AS (SELECT {SHORT} FROM ({AT_065})), r AS ({CLASS_ROWS})
          SELECT class, precision, recall, f1_score, support FROM r
          UNION ALL SELECT 'accuracy', any_value(accuracy), any_value(accuracy), any_value(accuracy), CAST(sum(support) AS BIGINT) FROM r
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM r
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                           sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM r)""",
    "scored",
    9,
    "precision recall f1_score",
)
ORACLES["roc_auc"] = sql(
    """SELECT p AS positives, n AS negatives, (ranks - p * (p + 1) / 2e0) / (CAST(p AS DOUBLE) * n) AS roc_auc
       FROM (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n,
                    sum(r) FILTER (WHERE label = 1) AS ranks
             FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS r
                   FROM scored))""",
    "scored",
    9,
    "roc_auc",
)
ORACLES["score_coverage"] = """
    SELECT l_returnflag, count(*) AS row_count, count(*) FILTER (WHERE score IS NOT NULL AND label IN (0, 1)) AS used_rows,
           count(*) FILTER (WHERE score IS NULL) AS rows_without_score, count(*) FILTER (WHERE label IS NULL) AS rows_without_label,
           count(*) FILTER (WHERE label = 2) AS rows_with_other_label
    FROM (SELECT l_returnflag, CASE WHEN l_linenumber % 5 <> 0 THEN l_discount END AS score,
                 CASE WHEN l_orderkey % 11 <> 0 THEN l_partkey % 3 END AS label FROM lineitem) GROUP BY l_returnflag"""
CURVE = """
    SELECT score, p, sum(p) OVER w AS hits, sum(n) OVER w AS seen, sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
    FROM (SELECT score, sum(label) AS p, count(*) AS n FROM scored GROUP BY score) WINDOW w AS (ORDER BY score DESC)"""
ORACLES["average_precision"] = sql(
    f"SELECT sum(p / CAST(all_p AS DOUBLE) * hits / CAST(seen AS DOUBLE)) AS average_precision FROM ({CURVE})",
    "scored",
    9,
    "average_precision",
)
ORACLES["pr_curve"] = sql(
    f"""SELECT score AS threshold, hits / CAST(seen AS DOUBLE) AS precision, hits / CAST(all_p AS DOUBLE) AS recall,
               all_p / CAST(all_n AS DOUBLE) AS base_rate FROM ({CURVE})""",
    "scored",
    9,
    "threshold precision recall base_rate",
)
SWEEP = f"""
    SELECT * EXCLUDE (tn, fp, fn, tp), {METRICS} FROM (SELECT *, {SHORT} FROM (
        SELECT t AS threshold, {_counts("t")}
        FROM scored, (SELECT CAST(unnest(range(5, 96)) AS DOUBLE) / 100 AS t) GROUP BY t))"""
ORACLES["threshold_sweep"] = sql(SWEEP, "scored", 9, f"threshold {METRIC_NAMES}")
ORACLES["best_threshold"] = sql(
    f"SELECT * FROM ({SWEEP}) ORDER BY f1_score DESC, recall DESC, precision DESC, threshold LIMIT 1",
    "scored",
    9,
    f"threshold {METRIC_NAMES}",
)
ORACLES["regression_metrics"] = sql(
    """SELECT count(*) AS row_count, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
              1 - sum(e * e) / (var_pop(y) * count(*)) AS r2_score,
              avg(CAST(abs(e) <= 2 AS INTEGER)) AS within_2_days, avg(CAST(abs(e) <= 5 AS INTEGER)) AS within_5_days,
              avg(CAST(abs(e) <= 7 AS INTEGER)) AS within_7_days, min(p) AS minimum_prediction,
              max(p) AS maximum_prediction, avg(p) AS average_prediction, median(abs(e)) AS median_absolute_error
       FROM (SELECT actual_delivery_days AS y, CAST(15 + order_id % 17 AS DOUBLE) AS p, y - p AS e FROM model)""",
    "model",
    8,
    """mae rmse r2_score within_2_days within_5_days within_7_days minimum_prediction maximum_prediction
       average_prediction median_absolute_error""",
)

# --- models with a closed form ------------------------------------------------------------------

ORACLES["baseline_models"] = sql(
    """SELECT count(*) AS row_count, any_value(rate) AS late_probability, any_value(middle) AS days,
              avg(abs(actual_delivery_days - middle)) AS mae
       FROM parted, (SELECT avg(late_delivery) AS rate, median(actual_delivery_days) AS middle
                     FROM parted WHERE split = 'train')
       WHERE split = 'validation'""",
    "parted",
    8,
    "late_probability days mae",
)
ORACLES["linear_model"] = sql(
    """SELECT order_id, a + b * total_item_price AS prediction
       FROM parted, (SELECT regr_intercept(total_payment_value, total_item_price) AS a,
                            regr_slope(total_payment_value, total_item_price) AS b FROM parted WHERE split = 'train')
       WHERE split = 'validation'""",
    "parted",
    4,
    "prediction",
)
ORACLES["reject_records"] = """
    SELECT o_orderkey, CASE WHEN fine AND k IN (0, 6) THEN o_orderkey END AS quantity,
           CASE WHEN fine THEN o_totalprice END AS amount, CASE WHEN fine THEN 'accepted' ELSE 'rejected' END AS status,
           missing_features, invalid_features
    FROM (SELECT *, missing_features = '' AND invalid_features = '' AS fine
          FROM (SELECT *, CASE k WHEN 2 THEN 'quantity' WHEN 4 THEN 'quantity,amount' ELSE '' END AS missing_features,
                       CASE WHEN k = 4 THEN '' WHEN k IN (1, 5) AND o_orderkey % 5 = 0 THEN 'quantity,amount'
                            WHEN k IN (1, 5) THEN 'quantity' WHEN o_orderkey % 5 = 0 THEN 'amount' ELSE '' END AS invalid_features
                FROM (SELECT *, o_orderkey % 7 AS k FROM orders)))"""
