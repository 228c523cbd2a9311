import math

from pyspark.sql import functions as F

from orderflow.functions import columns as C
from orderflow.functions.derived import add_derived, add_reporting_groups, derived_names
from orderflow.ml.prep import FrequencyEncoder
from orderflow.plans.delivery import CONTRACT

# Three orders: the second has zero denominators and no photo average, the third is a same-state order.
ORDERS = [
    ("RJ", "SP", 0, 1, 0, 2, 2.0, 10.0, 3.0, 2, 2, 1, 2, 100.0, 20.0, 2000.0, 1000.0, 4.0, 120.0, 3),
    ("RJ", "SP", 0, 6, 3, 12, 4.0, 0.0, 2.0, 0, 0, 0, 0, 0.0, 5.0, 0.0, 0.0, None, 0.0, 0),
    ("SP", "MG", 1, 12, 6, 23, 1.0, 20.0, 5.0, 1, 1, 1, 1, 20.0, 2.0, 100.0, 50.0, 1.0, 22.0, 1),
]
SCHEMA = (
    "customer_state string, primary_seller_state string, same_state_delivery int, purchase_month int, "
    "purchase_weekday int, purchase_hour int, approval_delay_hours double, promised_delivery_days double, "
    "seller_shipping_window_days double, item_count int, unique_product_count int, unique_seller_count int, "
    "unique_category_count int, total_item_price double, total_freight double, total_product_weight_g double, "
    "total_product_volume_cm3 double, average_product_photos double, total_payment_value double, maximum_installments int"
)


def frame(spark):
    return spark.createDataFrame(ORDERS, SCHEMA)


def test_derived_values_and_missing(spark):
    rows = add_derived(frame(spark)).collect()
    first, second, third = rows
    assert first["seller_customer_route"] == "SP->RJ"
    assert first["photos_per_item"] == 4.0 and second["photos_per_item"] is None
    assert second["price_per_item"] is None and second["shipping_window_to_promised_ratio"] is None
    assert first["freight_per_kg"] == 10.0 and second["freight_per_kg"] is None
    assert [r["is_weekend_purchase"] for r in rows] == [1, 0, 1]
    assert [r["is_night_purchase"] for r in rows] == [1, 0, 1]
    assert [r["is_business_hours"] for r in rows] == [0, 1, 0]
    assert [r["cross_state_delivery"] for r in rows] == [1, 1, 0]
    assert third["promised_minus_shipping_window"] == 15.0
    assert math.isclose(first["log1p_total_item_price"], math.log1p(100.0))
    assert abs(first["month_sin"]) < 1e-12 and abs(first["month_cos"] - 1) < 1e-12
    for row in rows:
        assert all(not (isinstance(v, float) and (math.isnan(v) or math.isinf(v))) for v in row)


def test_inputs_are_kept_and_derived_only_when_possible(spark):
    df = frame(spark)
    assert add_derived(df).columns[: len(df.columns)] == df.columns
    few = df.select("purchase_hour", "item_count")
    assert set(derived_names(few.columns)) == {
        "is_night_purchase", "is_business_hours", "hour_sin", "hour_cos", "is_multi_item_order"
    }
    assert len(derived_names(CONTRACT.features)) == 37


def test_route_frequency_is_learned_on_train_only(spark):
    train = add_derived(frame(spark))
    model = FrequencyEncoder(inputCol="seller_customer_route", outputCol="route_frequency").fit(train)
    seen = {r["seller_customer_route"]: r["route_frequency"] for r in model.transform(train).collect()}
    assert math.isclose(seen["SP->RJ"], 2 / 3) and math.isclose(seen["MG->SP"], 1 / 3)
    other = train.limit(1).withColumn("seller_customer_route", F.lit("SP->AM"))
    assert model.transform(other).first()["route_frequency"] == 0.0


def test_missing_flags_and_reporting_groups(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, "2020-02-29 10:00:00")],
        "customer_state string, primary_seller_state string, same_state_delivery int, item_count int, "
        "unique_seller_count int, t string",
    ).withColumn("order_purchase_timestamp", F.col("t").cast("timestamp_ntz"))
    derived = add_derived(df).first()
    assert derived["cross_state_delivery"] == 0 and derived["is_multi_item_order"] == 0
    assert derived["seller_customer_route"] == "<missing>-><missing>"
    groups = add_reporting_groups(df).first()
    assert groups["purchase_period"] == "2020-02" and groups["delivery_scope"] == "cross_state_or_missing"
    assert groups["multi_item_group"] == "single_item" and groups["seller_customer_route"] == "missing->missing"


def test_non_finite_numbers_become_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), (None,)], "v string")
    assert [r[0] for r in df.select(C.finite("v")).collect()] == [1.5, None, None, None, None]


def test_seconds_are_wall_clock_boundaries(spark):
    df = spark.createDataFrame(
        [("2020-01-01 00:00:00.9", "2020-01-01 00:00:01.1"), ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00.2"),
         ("2020-03-08 01:00:00", "2020-03-09 01:00:00"), ("2020-01-02 00:00:00", "2020-01-01 00:00:00")],
        "a string, b string",
    ).selectExpr("cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")
    assert [r[0] for r in df.select(C.seconds_between("a", "b")).collect()] == [1, 1, 86400, -86400]
    assert df.select(C.days_between("a", "b")).collect()[2][0] == 1.0


def test_weekday_starts_on_sunday(spark):
    df = spark.createDataFrame([("2024-06-02",), ("2024-06-08",)], "d string")  # a Sunday, a Saturday
    assert [r[0] for r in df.select(C.weekday(F.col("d").cast("timestamp_ntz"))).collect()] == [0, 6]


def test_value_at_max_skips_missing_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, None, 9.0, 1), (1, "b", 5.0, 3), (1, "a", 5.0, 2), (1, "c", None, 0), (2, None, 1.0, 1)],
        "k int, v string, p double, i int",
    )
    got = df.groupBy("k").agg(C.value_at_max("v", "p", ["i"]).alias("v")).collect()
    assert {r["k"]: r["v"] for r in got} == {1: "a", 2: None}


def test_flags_of_three_values(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), (None, "y")], "a string, b string")
    assert [r[0] for r in df.select(C.equality_flag("a", "b")).collect()] == [1, 0, None]
    assert [r[0] for r in df.select(C.flag(F.col("a") == F.col("b"))).collect()] == [1, 0, 0]


def test_sum_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select((F.rand(7) * 1000).cast("decimal(12,2)").cast("double").alias("v"))
    totals = {df.repartition(n).agg(C.exact_sum("v")).first()[0] for n in (1, 7, 17)}
    assert len(totals) == 1
