"""Order pipeline steps on the six raw tables: enrich, roll up, join, label.

Child rows are aggregated before they are joined, so every join keeps the grain of its left side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.columns import (
    any_flag,
    days_between,
    equality_flag,
    guarded_ratio,
    hours_between,
    weekday,
)
from orderflow.session import pin

# Payment methods that get an indicator column, and the status of a finished order.
PAYMENT_METHODS = ("credit_card", "voucher", "boleto", "debit_card")
DELIVERED = "delivered"


def rollup(df: DataFrame, key: str | Sequence[str], **aggregates: Column) -> DataFrame:
    """One row per key with named aggregates (partial aggregation happens before the shuffle)."""
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(*[c.alias(name) for name, c in aggregates.items()])


def enrich_items(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with product and seller attributes and the product volume; grain stays one item."""
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return (
        items.join(products, "product_id", "left")
        .join(sellers, "seller_id", "left")
        .withColumn("product_volume_cm3", volume)
    )


#: Sums of doubles differ in their last bits with the order in which tasks deliver them. Rounding keeps equal ratios equal, so
#: that a quartile edge within such a tie parts the same orders on every run.
RATIO_DECIMALS = 12
#: Rows of one key above which it is no longer rolled up in one place, and cells of the hash that finds such keys.
CROWDED, CELLS = 1_000_000, 65_536
#: The key of a rollup as two columns that are never NULL, so that the group of rows without a key joins too.
KEYS = ["_no_key", "_key"]


def _keyed(df: DataFrame, key: str) -> DataFrame:
    kind = df.schema[key].dataType
    return df.withColumns({"_no_key": F.col(key).isNull(), "_key": F.coalesce(F.col(key), F.lit("0").cast(kind))})


def _together(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join rollups by KEYS; both lie by ``_key`` alone, so nothing moves again. The second condition is no join key: with it the
    planner would ask for a partitioning by both columns."""
    named = right.withColumnsRenamed({k: f"_right{k}" for k in KEYS})
    same_kind = F.when(F.col("_no_key"), F.col("_right_no_key")).otherwise(~F.col("_right_no_key"))
    return left.join(named, (F.col("_key") == F.col("_right_key")) & same_kind).drop("_right_no_key", "_right_key")


def _named(rolled: DataFrame, key: str) -> DataFrame:
    return rolled.select(F.when(~F.col("_no_key"), F.col("_key")).alias(key), *[c for c in rolled.columns if c not in KEYS])


def crowded_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """KEYS of the keys that hold more than CROWDED rows, or None. Cells of a hash are counted first: no key of a cell without
    so many rows is counted by itself."""
    keyed = _keyed(rows, key).select(*KEYS, F.pmod(F.xxhash64(key), F.lit(CELLS)).alias("_cell"))
    full = F.col("_n") > CROWDED
    cells = pin(keyed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).where(full).select("_cell"))
    if cells.isEmpty():
        return None
    found = pin(keyed.join(cells, "_cell", "left_semi").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n")).where(full).select(*KEYS))
    return None if found.isEmpty() else found


def _rolled(rows: DataFrame, key: str, crowded: DataFrame | None, levels: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``levels`` over rows with KEYS. Rows are dealt by key once and then stay: every level finds its groups in one place. Rows of
    crowded keys aren't dealt by key; there each level deals and merges its own groups."""
    keyed = _keyed(rows, key)
    if crowded is None:
        return levels(keyed.repartition("_key"))
    few, many = keyed.join(crowded, KEYS, "left_anti"), keyed.join(crowded, KEYS, "left_semi")
    return levels(few.repartition("_key")).unionByName(levels(many))


def _count(column: str) -> Column:
    return F.sum(F.col(column).isNotNull().cast("long"))


def order_item_rollup(
    enriched: DataFrame,
    ties: Sequence[str] = ("order_item_id", "product_id", "seller_id"),
    items: DataFrame | None = None,
    sold: DataFrame | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Item counts, price, freight, weight, volume and listing measures per order.

    Two scans of the items, each dealt by order once. One goes from (order, product) to (order, category) to the order, the other
    from (order, seller) to (order, state) to the order: each level merges the sums of the one before and counts its groups, so a
    distinct count is a by-product, needs no Expand and no set. An order with very many items is spread by its products and
    sellers. A product has one category and a seller one state, as ``enrich_items`` joins them.

    ``items`` are counted to find such orders and ``sold`` are read for the sellers, which need nothing of the products; both
    default to the enriched items. ``keyed`` keeps KEYS in place of the order, for ``joined_orders``.
    """
    key = "order_id"
    crowded = crowded_keys(enriched if items is None else items, key)
    measures = _rolled(enriched, key, crowded, _item_measures)
    sellers = _rolled(enriched if sold is None else sold, key, crowded, lambda rows: _item_sellers(rows, ties))
    rolled = _together(measures, sellers)
    return rolled if keyed else _named(rolled, key)


def _item_measures(enriched: DataFrame) -> DataFrame:
    product, category = "product_id", "product_category_name"
    sums = {"price": "price", "freight": "freight_value", "weight": "product_weight_g", "volume": "product_volume_cm3", "photos": "product_photos_qty"}
    by_product = enriched.groupBy(*KEYS, product, category).agg(
        F.count(F.lit(1)).alias("items"),
        *[F.sum(c).alias(f"{n}_sum") for n, c in sums.items()],
        *[F.count(c).alias(f"{n}_count") for n, c in sums.items()],
        *[F.max(c).alias(f"{n}_max") for n, c in sums.items()],
        F.min("price").alias("price_min"),
        F.min("shipping_limit_date").alias("limit_min"),
        F.max("shipping_limit_date").alias("limit_max"),
    )
    merged = [
        F.sum("items").alias("items"),
        *[F.sum(f"{n}_{kind}").alias(f"{n}_{kind}") for kind in ("sum", "count") for n in sums],
        *[F.max(f"{n}_max").alias(f"{n}_max") for n in sums],
        F.min("price_min").alias("price_min"),
        F.min("limit_min").alias("limit_min"),
        F.max("limit_max").alias("limit_max"),
    ]
    by_category = by_product.groupBy(*KEYS, category).agg(*merged, _count(product).alias("products"))
    missing = F.sum(F.when(F.col(category).isNull(), F.col("items")).otherwise(0))
    by_order = by_category.groupBy(*KEYS).agg(
        *merged, F.sum("products").alias("products"), _count(category).alias("categories"), missing.alias("uncategorised")
    )

    def average(name: str) -> Column:
        return F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_count"))

    return by_order.select(
        *KEYS,
        F.col("items").alias("item_count"),
        F.col("price_sum").alias("total_item_price"),
        average("price").alias("average_item_price"),
        F.col("price_min").alias("minimum_item_price"),
        F.col("price_max").alias("maximum_item_price"),
        F.col("freight_sum").alias("total_freight"),
        average("freight").alias("average_freight_per_item"),
        F.col("freight_max").alias("maximum_freight_per_item"),
        F.round(guarded_ratio(F.col("freight_sum"), F.col("price_sum")), RATIO_DECIMALS).alias("freight_to_price_ratio"),
        F.col("weight_sum").alias("total_product_weight_g"),
        average("weight").alias("average_product_weight_g"),
        F.col("weight_max").alias("maximum_product_weight_g"),
        F.col("volume_sum").alias("total_product_volume_cm3"),
        average("volume").alias("average_product_volume_cm3"),
        F.col("volume_max").alias("maximum_product_volume_cm3"),
        average("photos").alias("average_product_photos"),
        F.col("photos_max").alias("maximum_product_photos"),
        (F.col("items") - F.col("weight_count")).alias("missing_weight_item_count"),
        (F.col("items") - F.col("volume_count")).alias("missing_volume_item_count"),
        F.col("uncategorised").alias("missing_category_item_count"),
        F.col("limit_min").alias("earliest_shipping_limit_date"),
        F.col("limit_max").alias("latest_shipping_limit_date"),
        F.col("products").alias("unique_product_count"),
        F.col("categories").alias("unique_category_count"),
    )


def _item_sellers(sold: DataFrame, ties: Sequence[str]) -> DataFrame:
    seller, state = "seller_id", "seller_state"
    # The best item of a seller, then of a state, then of the order; those without a price or state are no candidates.
    order = F.struct((-F.col("price")).alias("by"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    # One sort serves all three levels: each groups by a prefix of the one before.
    by_seller = sold.groupBy(*KEYS, state, seller).agg(F.min(F.when(F.col("price").isNotNull() & F.col(state).isNotNull(), order)).alias("best"))
    by_state = by_seller.groupBy(*KEYS, state).agg(F.min("best").alias("best"), _count(seller).alias("sellers"))
    return by_state.groupBy(*KEYS).agg(
        F.sum("sellers").alias("unique_seller_count"),
        _count(state).alias("unique_seller_state_count"),
        F.min_by(state, "best").alias("primary_seller_state"),
    )


def payment_rollup(
    payments: DataFrame,
    methods: Sequence[str] = PAYMENT_METHODS,
    ties: Sequence[str] = ("payment_sequential",),
    keyed: bool = False,
) -> DataFrame:
    """Payment counts, values, instalments, main method and method indicators per order, by way of (order, method); ``keyed`` as in
    ``order_item_rollup``."""
    key = "order_id"
    rolled = _rolled(payments, key, crowded_keys(payments, key), lambda rows: _payment_levels(rows, methods, ties))
    return rolled if keyed else _named(rolled, key)


def _payment_levels(payments: DataFrame, methods: Sequence[str], ties: Sequence[str]) -> DataFrame:
    kind, value, parts = "payment_type", "payment_value", "payment_installments"
    order = F.struct((-F.col(value)).alias("by"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    by_kind = rollup(
        payments,
        [*KEYS, kind],
        payments=F.count(F.lit(1)),
        value_sum=F.sum(value),
        value_count=F.count(value),
        value_min=F.min(value),
        value_max=F.max(value),
        parts_sum=F.sum(parts),
        parts_count=F.count(parts),
        parts_max=F.max(parts),
        # The best payment of a method, then of the order; those without a method or value are no candidates.
        best=F.min(F.when(F.col(kind).isNotNull() & F.col(value).isNotNull(), order)),
    )
    return rollup(
        by_kind,
        KEYS,
        payment_count=F.sum("payments"),
        payment_type_count=_count(kind),
        total_payment_value=F.sum("value_sum"),
        average_payment_value=F.try_divide(F.sum("value_sum").cast("double"), F.sum("value_count")),
        minimum_payment_value=F.min("value_min"),
        maximum_payment_value=F.max("value_max"),
        # The largest payment is also the amount of the main method.
        primary_payment_value=F.max("value_max"),
        maximum_installments=F.max("parts_max"),
        average_installments=F.try_divide(F.sum("parts_sum").cast("double"), F.sum("parts_count")),
        **{f"used_{m}": any_flag(F.col(kind) == m) for m in methods},
        primary_payment_type=F.min_by(kind, "best"),
    )


def _with_rollup(orders: DataFrame, rolled: DataFrame) -> DataFrame:
    if "_key" not in rolled.columns:
        return orders.join(rolled, "order_id", "left")
    known = rolled.where(~F.col("_no_key")).drop("_no_key")
    return orders.join(known, F.col("order_id") == F.col("_key"), "left").drop("_key")


def joined_orders(orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with its customer, item rollup and payment rollup (all at most one match). Rollups with KEYS are joined where
    they lie."""
    joined = orders.join(customers, "customer_id", "left")
    joined = _with_rollup(joined, items.withColumn("_items", F.lit(1)))
    joined = _with_rollup(joined, payments.withColumn("_payments", F.lit(1)))
    order_value = F.col("total_item_price") + F.col("total_freight")
    return joined.withColumns(
        {
            "same_state_delivery": equality_flag("customer_state", "primary_seller_state"),
            "has_item_features": F.coalesce("_items", F.lit(0)),
            "has_payment_features": F.coalesce("_payments", F.lit(0)),
            "payment_order_value_difference": F.col("total_payment_value") - order_value,
        }
    ).drop("_items", "_payments")


def purchase_time(ts: str) -> dict[str, Column]:
    """Year, month, weekday (Sunday = 0) and hour of a timestamp."""
    return {
        "purchase_year": F.year(ts).cast("bigint"),
        "purchase_month": F.month(ts).cast("bigint"),
        "purchase_weekday": weekday(ts).cast("bigint"),
        "purchase_hour": F.hour(ts).cast("bigint"),
    }


def model_dataset(joined: DataFrame, columns: Sequence[str], status: str = DELIVERED) -> DataFrame:
    """Finished orders with complete summaries, time features, both targets and the contract's columns."""
    purchase, promised = "order_purchase_timestamp", "order_estimated_delivery_date"
    received = "order_delivered_customer_date"
    complete = joined.where(
        (F.col("order_status") == status)
        & (F.col("has_item_features") == 1)
        & (F.col("has_payment_features") == 1)
    ).dropna(subset=[purchase, received, promised, "order_approved_at"])
    timed = complete.withColumns(
        {
            **purchase_time(purchase),
            "approval_delay_hours": hours_between(purchase, "order_approved_at"),
            "promised_delivery_days": days_between(purchase, promised),
            "seller_shipping_window_days": days_between(purchase, "latest_shipping_limit_date"),
            "actual_delivery_days": days_between(purchase, received),
            "late_delivery": (F.col(received) > F.col(promised)).cast("int"),
            "lateness_days": days_between(promised, received),
        }
    )
    return timed.select(*columns)
