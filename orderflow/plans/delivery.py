"""The order-delivery preset: tables, relationships, contract and the chained steps."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderflow.contract import FeatureContract, TableSpec
from orderflow.operators.quality import ForeignKey
from orderflow.operators.rollup import enrich_items, joined_orders, model_dataset, order_item_rollup, payment_rollup


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)  # type: ignore[attr-defined]


# Table and column names, types, keys and grain of the raw tables.
RAW_TABLES = {
    spec[0]: spec
    for spec in (
        (
            "orders",
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
            ("order_id",),
            "one order",
        ),
        (
            "customers",
            "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
            "customer_state string",
            ("customer_id",),
            "one customer record of an order",
        ),
        (
            "order_items",
            "order_id string, order_item_id int, product_id string, seller_id string, "
            "shipping_limit_date timestamp_ntz, price double, freight_value double",
            ("order_id", "order_item_id"),
            "one item of an order",
        ),
        (
            "products",
            "product_id string, product_category_name string, product_name_lenght double, "
            "product_description_lenght double, product_photos_qty double, product_weight_g double, "
            "product_length_cm double, product_height_cm double, product_width_cm double",
            ("product_id",),
            "one product",
        ),
        (
            "sellers",
            "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
            ("seller_id",),
            "one seller",
        ),
        (
            "payments",
            "order_id string, payment_sequential int, payment_type string, payment_installments int, "
            "payment_value double",
            ("order_id", "payment_sequential"),
            "one payment of an order",
        ),
    )
}

RELATIONSHIPS = (
    ForeignKey("orders.customer_id -> customers.customer_id", "orders", ("customer_id",), "customers", ("customer_id",)),
    ForeignKey("order_items.order_id -> orders.order_id", "order_items", ("order_id",), "orders", ("order_id",)),
    ForeignKey("order_items.product_id -> products.product_id", "order_items", ("product_id",), "products", ("product_id",)),
    ForeignKey("order_items.seller_id -> sellers.seller_id", "order_items", ("seller_id",), "sellers", ("seller_id",)),
    ForeignKey("payments.order_id -> orders.order_id", "payments", ("order_id",), "orders", ("order_id",)),
)

# Roles of the model dataset's columns.
CONTRACT = FeatureContract(
    tracking=(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "order_purchase_timestamp",
        "order_approved_at",
    ),
    categorical=(
        "customer_state",
        "primary_seller_state",
        "primary_payment_type",
        "purchase_year",
        "purchase_month",
        "purchase_weekday",
        "purchase_hour",
    ),
    numerical=(
        "same_state_delivery",
        "approval_delay_hours",
        "promised_delivery_days",
        "seller_shipping_window_days",
        "item_count",
        "unique_product_count",
        "unique_seller_count",
        "unique_seller_state_count",
        "unique_category_count",
        "total_item_price",
        "average_item_price",
        "minimum_item_price",
        "maximum_item_price",
        "total_freight",
        "average_freight_per_item",
        "maximum_freight_per_item",
        "freight_to_price_ratio",
        "total_product_weight_g",
        "average_product_weight_g",
        "maximum_product_weight_g",
        "total_product_volume_cm3",
        "average_product_volume_cm3",
        "maximum_product_volume_cm3",
        "average_product_photos",
        "maximum_product_photos",
        "missing_weight_item_count",
        "missing_volume_item_count",
        "missing_category_item_count",
        "payment_count",
        "payment_type_count",
        "total_payment_value",
        "average_payment_value",
        "minimum_payment_value",
        "maximum_payment_value",
        "maximum_installments",
        "average_installments",
        "used_credit_card",
        "used_voucher",
        "used_boleto",
        "used_debit_card",
    ),
    classification_target="late_delivery",
    regression_target="actual_delivery_days",
    analysis_only=("lateness_days",),
)


def table_specs() -> dict[str, TableSpec]:
    return {name: TableSpec(name, _schema(text), key, grain) for name, text, key, grain in RAW_TABLES.values()}


@dataclass(frozen=True)
class DeliveryTables:
    orders: DataFrame
    customers: DataFrame
    order_items: DataFrame
    products: DataFrame
    sellers: DataFrame
    payments: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def enriched_items(self) -> DataFrame:
        return enrich_items(self.order_items, self.products, self.sellers)

    def item_features(self, enriched: DataFrame | None = None, keyed: bool = False) -> DataFrame:
        """Rollup of the enriched items; pass them written to join products and sellers only once."""
        if enriched is not None:
            return order_item_rollup(enriched, keyed=keyed)
        sold = self.order_items.join(self.sellers, "seller_id", "left")
        return order_item_rollup(self.enriched_items(), items=self.order_items, sold=sold, keyed=keyed)

    def payment_features(self) -> DataFrame:
        return payment_rollup(self.payments)

    def joined_orders(self, items: DataFrame | None = None, payments: DataFrame | None = None) -> DataFrame:
        """Orders with all summaries; pass rollups that were written before to read them instead."""
        items = self.item_features(keyed=True) if items is None else items
        payments = payment_rollup(self.payments, keyed=True) if payments is None else payments
        return joined_orders(self.orders, self.customers, items, payments)

    def model_dataset(self, joined: DataFrame | None = None) -> DataFrame:
        return model_dataset(self.joined_orders() if joined is None else joined, CONTRACT.columns)
