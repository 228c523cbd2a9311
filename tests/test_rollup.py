from datetime import datetime

import pytest

from orderflow.operators import rollup
from orderflow.operators.rollup import model_dataset
from orderflow.plans.delivery import CONTRACT, DeliveryTables, table_specs

T = datetime


@pytest.fixture(scope="module")
def tables(spark):
    specs = {name: spec.schema for name, spec in table_specs().items()}

    def day(d, h=0):
        return datetime(2020, 1, d, h)

    data = {
        "orders": [
            ("o1", "c1", "delivered", day(1), day(1, 6), day(2), day(11), day(11)),  # exactly on time
            ("o2", "c2", "delivered", day(1), day(2), day(2), day(12), day(11)),  # late
            ("o3", "c1", "delivered", day(3), day(3), day(4), day(9), day(11)),  # no items
            ("o4", "c9", "delivered", day(3), day(3), day(4), day(9), day(11)),  # no payments, no customer
            ("o5", "c2", "shipped", day(4), day(4), day(5), None, day(14)),
            ("o6", "c2", "delivered", day(4), None, day(5), day(6), day(14)),  # never approved
        ],
        "customers": [("c1", "u1", 1, "x", "SP"), ("c2", "u2", 2, "y", "RJ")],
        "order_items": [
            ("o1", 1, "p1", "s1", day(5), 10.0, 1.0),
            ("o1", 2, "p2", "s2", day(6), 10.0, 2.0),  # same top price: the first item decides
            ("o2", 1, "p1", "s9", day(7), 0.0, 3.0),  # unknown seller, price 0
            ("o4", 1, "p3", "s1", day(5), 5.0, 1.0),
            ("o5", 1, "p1", "s1", day(5), 5.0, 1.0),
            ("o6", 1, "p1", "s1", day(5), 5.0, 1.0),
        ],
        "products": [
            ("p1", "toys", 1.0, 1.0, 2.0, 100.0, 2.0, 3.0, 4.0),
            ("p2", None, 1.0, 1.0, 4.0, None, 2.0, None, 4.0),
        ],
        "sellers": [("s1", 1, "x", "SP"), ("s2", 2, "y", "RJ")],
        "payments": [
            ("o1", 1, "credit_card", 3, 20.0),
            ("o1", 2, "voucher", 1, 3.0),
            ("o2", 1, "boleto", 1, 4.0),
            ("o3", 1, "boleto", 1, 4.0),
            ("o6", 1, "boleto", 1, 4.0),
        ],
    }
    return DeliveryTables(**{n: spark.createDataFrame(rows, specs[n]) for n, rows in data.items()})


def test_item_features(tables):
    got = {r["order_id"]: r for r in tables.item_features().collect()}
    one = got["o1"]
    assert one["item_count"] == 2 and one["unique_product_count"] == 2 and one["unique_category_count"] == 1
    assert one["primary_seller_state"] == "SP" and one["total_freight"] == 3.0 and one["freight_to_price_ratio"] == 0.15
    assert one["total_product_weight_g"] == 100.0 and one["missing_weight_item_count"] == 1
    assert one["total_product_volume_cm3"] == 24.0 and one["missing_volume_item_count"] == 1
    assert one["average_product_photos"] == 3.0 and one["latest_shipping_limit_date"] == datetime(2020, 1, 6)
    two = got["o2"]
    assert two["freight_to_price_ratio"] is None and two["primary_seller_state"] is None
    assert two["unique_seller_count"] == 1 and two["unique_seller_state_count"] == 0
    assert got["o4"]["missing_category_item_count"] == 1


def test_payment_features(tables):
    one = {r["order_id"]: r for r in tables.payment_features().collect()}["o1"]
    assert one["payment_type_count"] == 2 and one["primary_payment_type"] == "credit_card"
    assert one["primary_payment_value"] == one["maximum_payment_value"] == 20.0
    assert (one["used_credit_card"], one["used_voucher"], one["used_boleto"]) == (1, 1, 0)
    assert one["average_installments"] == 2.0


def test_joined_orders_keep_every_order(tables):
    got = {r["order_id"]: r for r in tables.joined_orders().collect()}
    assert len(got) == 6
    assert got["o1"]["same_state_delivery"] == 1 and got["o2"]["same_state_delivery"] is None
    assert (got["o3"]["has_item_features"], got["o3"]["has_payment_features"]) == (0, 1)
    assert got["o4"]["customer_state"] is None and got["o4"]["has_payment_features"] == 0
    assert got["o1"]["payment_order_value_difference"] == 0.0


def test_model_dataset_filters_and_targets(tables):
    data = tables.model_dataset()
    assert data.columns == CONTRACT.columns
    CONTRACT.check(data)
    got = {r["order_id"]: r for r in data.collect()}
    assert set(got) == {"o1", "o2"}
    assert got["o1"]["late_delivery"] == 0 and got["o2"]["late_delivery"] == 1
    assert got["o1"]["approval_delay_hours"] == 6.0 and got["o1"]["actual_delivery_days"] == 10.0
    assert got["o2"]["lateness_days"] == 1.0 and got["o1"]["purchase_weekday"] == 3
    assert got["o1"]["seller_shipping_window_days"] == 5.0


def test_outer_joins_to_required_rollups_become_inner(tables):
    plan = model_dataset(tables.joined_orders(), CONTRACT.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan


def test_one_order_with_a_third_of_all_items(spark):
    from pyspark.sql import functions as F

    from orderflow.operators.rollup import order_item_rollup

    items = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("order_id"),
        F.col("id").alias("order_item_id"),
        (F.hash("id") % 700).alias("product_id"),
        (F.hash(F.col("id") + 1) % 50).alias("seller_id"),
        (F.hash(F.col("id") + 1) % 50 % 7).cast("string").alias("seller_state"),
        (F.hash("id") % 700 % 9).cast("string").alias("product_category_name"),
        F.abs(F.hash(F.col("id") + 2) % 1000).cast("double").alias("price"),
        F.lit(1.0).alias("freight_value"),
        F.lit(2.0).alias("product_weight_g"),
        F.lit(None).cast("double").alias("product_volume_cm3"),
        F.lit(1.0).alias("product_photos_qty"),
        F.expr("timestamp_ntz'2020-01-01'").alias("shipping_limit_date"),
    )
    pdf = items.toPandas()
    expected = pdf.groupby("order_id").agg(
        n=("price", "size"), total=("price", "sum"), products=("product_id", "nunique"), states=("seller_state", "nunique")
    )
    top = pdf.sort_values(["price", "order_item_id"], ascending=[False, True]).groupby("order_id").seller_state.first()
    for layout in (items.repartition(1), items.repartition(17)):
        got = order_item_rollup(layout).toPandas().set_index("order_id").sort_index()
        assert (got.item_count == expected.n).all() and (got.total_item_price == expected.total).all()
        assert (got.unique_product_count == expected.products).all()
        assert (got.unique_seller_state_count == expected.states).all() and (got.primary_seller_state == top).all()
        assert got.total_product_volume_cm3.isna().all() and (got.missing_volume_item_count == expected.n).all()


def test_rows_without_a_key_keep_their_group(spark):
    items = spark.createDataFrame(
        [(1, 1, 1, 1, 5.0, 1.0), (None, 1, 2, 2, 7.0, 2.0), (None, 2, 3, 2, 8.0, 2.0), (0, 1, 4, 1, 9.0, 1.0)],
        "order_id long, order_item_id int, product_id long, seller_id long, price double, freight_value double",
    ).selectExpr(
        "*",
        "1.0D AS product_weight_g",
        "1.0D AS product_volume_cm3",
        "1 AS product_photos_qty",
        "'c' AS product_category_name",
        "current_timestamp() AS shipping_limit_date",
        "'s' || seller_id AS seller_state",
    )
    got = {r.order_id: r for r in rollup.order_item_rollup(items).collect()}
    assert {k: (r.item_count, r.unique_product_count, r.primary_seller_state) for k, r in got.items()} == {
        1: (1, 1, "s1"),
        None: (2, 2, "s2"),
        0: (1, 1, "s1"),
    }
    payments = spark.createDataFrame(
        [(1, 1, "card", 1, 5.0), (None, 1, "card", 2, 6.0), (None, 2, "slip", 1, 1.0)],
        "order_id long, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    paid = {r.order_id: (r.payment_count, r.payment_type_count, r.primary_payment_type) for r in rollup.payment_rollup(payments).collect()}
    assert paid == {1: (1, 1, "card"), None: (2, 2, "card")}


def test_item_rollup_scans_the_items_twice(spark, tiny):
    from orderflow.plans.testbed import delivery_tables

    plan = delivery_tables(spark, tiny).item_features()._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) == 2
    assert "Expand" not in plan and "collect_set" not in plan


def test_rollups_deal_their_rows_once(spark, tiny):
    from orderflow.plans.testbed import delivery_tables

    def dealt(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    tables = delivery_tables(spark, tiny)
    assert dealt(tables.item_features()) == 2 and dealt(tables.payment_features()) == 1
    assert dealt(rollup.joined_orders(tables.orders, tables.customers, tables.item_features(keyed=True), rollup.payment_rollup(tables.payments, keyed=True))) <= 4


def test_crowded_orders_are_spread_and_equal(spark, tiny, monkeypatch):
    from pyspark.sql import functions as F

    from orderflow.plans.testbed import delivery_tables

    tables = delivery_tables(spark, tiny)
    one = F.when(F.col("order_id") % 3 == 0, 3).when(F.col("order_id") % 3 == 1, F.col("order_id")).alias("order_id")
    items, payments = (df.select(one, *[c for c in df.columns if c != "order_id"]) for df in (tables.order_items, tables.payments))
    ties = ["order_item_id", "product_id", "seller_id", "price"]
    enriched = rollup.enrich_items(items, tables.products, tables.sellers)
    paid = ["payment_sequential", "payment_value", "payment_installments"]

    def both():
        made = rollup.order_item_rollup(enriched, ties), rollup.payment_rollup(payments, ties=paid)
        return [{r[0]: [round(v, 6) if isinstance(v, float) else v for v in r] for r in df.collect()} for df in made]

    plain = both()
    assert rollup.crowded_keys(items, "order_id") is None
    monkeypatch.setattr(rollup, "CROWDED", 100)
    assert sorted(map(tuple, rollup.crowded_keys(items, "order_id").collect())) == [(False, 3), (True, 0)]
    assert both() == plain and {None, 3} < set(plain[0])
