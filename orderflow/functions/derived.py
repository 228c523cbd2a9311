"""Registry of row-level derived features.

Every entry names its inputs and states one SQL expression; an entry is used only when all inputs
are present, and everything is added in a single projection.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderflow.functions.columns import number_sql

MISSING = "<missing>"
ROUTE = "seller_customer_route"
ROUTE_FREQUENCY = "route_frequency"


@dataclass(frozen=True)
class Derived:
    name: str
    requires: tuple[str, ...]
    expression: str


# Feature names, source columns, periods and hours of the feature contract.
CYCLES = (
    # prefix, source, period, first value
    ("month", "purchase_month", 12, 1),
    ("weekday", "purchase_weekday", 7, 0),
    ("hour", "purchase_hour", 24, 0),
)
MORE_THAN_ONE = (
    ("is_multi_item_order", "item_count"),
    ("is_multi_product_order", "unique_product_count"),
    ("is_multi_seller_order", "unique_seller_count"),
    ("is_multi_category_order", "unique_category_count"),
    ("is_installment_payment", "maximum_installments"),
)
RATIOS = (
    ("items_per_seller", "item_count", "unique_seller_count"),
    ("products_per_seller", "unique_product_count", "unique_seller_count"),
    ("categories_per_seller", "unique_category_count", "unique_seller_count"),
    ("price_per_item", "total_item_price", "item_count"),
    ("freight_per_item", "total_freight", "item_count"),
    ("freight_to_payment_ratio", "total_freight", "total_payment_value"),
    ("payment_to_item_price_ratio", "total_payment_value", "total_item_price"),
    ("installment_value", "total_payment_value", "maximum_installments"),
    ("weight_per_item", "total_product_weight_g", "item_count"),
    ("volume_per_item", "total_product_volume_cm3", "item_count"),
    ("density_g_per_cm3", "total_product_weight_g", "total_product_volume_cm3"),
    ("shipping_window_to_promised_ratio", "seller_shipping_window_days", "promised_delivery_days"),
    ("approval_delay_to_promised_ratio", "approval_delay_hours", "promised_delivery_days"),
)
LOGARITHMS = (
    ("log1p_total_item_price", "total_item_price"),
    ("log1p_total_freight", "total_freight"),
    ("log1p_total_weight", "total_product_weight_g"),
    ("log1p_total_volume", "total_product_volume_cm3"),
    ("log1p_payment_value", "total_payment_value"),
)
WEEKEND = (0, 6)
NIGHT_ENDS, NIGHT_STARTS = 6, 22
OFFICE_OPENS, OFFICE_CLOSES = 9, 18


def route_sql(missing: str) -> str:
    """``seller->customer`` text, with a marker for a missing end."""
    ends = [f"coalesce({end}, '{missing}')" for end in ("primary_seller_state", "customer_state")]
    return f"concat({ends[0]}, '->', {ends[1]})"


def _flag(condition: str) -> str:
    """0/1 flag; an unknown condition counts as 0."""
    return f"CAST(coalesce({condition}, false) AS INT)"


def _ratio(numerator: str, denominator: str) -> str:
    """NULL for a zero or missing denominator."""
    return f"try_divide(try_cast({numerator} AS DOUBLE), try_cast({denominator} AS DOUBLE))"


def _calendar() -> list[Derived]:
    day, hour = "purchase_weekday", "purchase_hour"
    entries = [
        Derived("is_weekend_purchase", (day,), _flag(f"{day} IN {WEEKEND}")),
        Derived("is_night_purchase", (hour,), _flag(f"{hour} < {NIGHT_ENDS} OR {hour} >= {NIGHT_STARTS}")),
        Derived("is_business_hours", (hour,), _flag(f"{hour} >= {OFFICE_OPENS} AND {hour} < {OFFICE_CLOSES}")),
        Derived("cross_state_delivery", ("same_state_delivery",), _flag("same_state_delivery = 0")),
    ]
    for prefix, source, period, first in CYCLES:
        angle = f"2 * pi() * ({source} - {first}) / {period}"
        entries += [Derived(f"{prefix}_{wave}", (source,), f"{wave}({angle})") for wave in ("sin", "cos")]
    return entries


def _amounts() -> list[Derived]:
    weight = "total_product_weight_g"
    promised, window = "promised_delivery_days", "seller_shipping_window_days"
    return [
        *[Derived(name, (source,), _flag(f"{source} > 1")) for name, source in MORE_THAN_ONE],
        *[Derived(name, (n, d), _ratio(n, d)) for name, n, d in RATIOS],
        *[Derived(name, (x,), f"CASE WHEN {x} >= 0 THEN log1p({x}) END") for name, x in LOGARITHMS],
        Derived("freight_per_kg", ("total_freight", weight), _ratio("total_freight", f"{weight} / 1000D")),
        Derived("photos_per_item", ("average_product_photos",), "average_product_photos"),
        Derived("promised_minus_shipping_window", (promised, window), f"{promised} - {window}"),
    ]


def registry() -> list[Derived]:
    route = Derived(ROUTE, ("primary_seller_state", "customer_state"), route_sql(MISSING))
    return [*_calendar(), *_amounts(), route]


def derived_names(columns: Iterable[str]) -> list[str]:
    """Names the registry can add to a frame with these columns."""
    present = set(columns)
    return [d.name for d in registry() if present.issuperset(d.requires)]


def add_derived(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Add all (or the named) derived columns whose inputs are available, in one projection."""
    wanted = None if names is None else set(names)
    present = set(df.columns)
    added = [
        f"{d.expression} AS {d.name}"
        for d in registry()
        if present.issuperset(d.requires) and (wanted is None or d.name in wanted)
    ]
    return finite_doubles(df.selectExpr("*", *added))


def finite_doubles(df: DataFrame) -> DataFrame:
    """Turn NaN and infinities in every floating-point column into NULL."""
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.selectExpr(*[f"{number_sql(c)} AS `{c}`" if c in floating else f"`{c}`" for c in df.columns])


# --- groups used by reports only ----------------------------------------------------------------


def add_reporting_groups(df: DataFrame) -> DataFrame:
    """Month, delivery scope, order-size groups and the route with the report's marker for a gap."""
    groups = {
        "purchase_period": "date_format(order_purchase_timestamp, 'yyyy-MM')",
        "delivery_scope": "if(same_state_delivery = 1, 'same_state', 'cross_state_or_missing')",
        "multi_item_group": "if(item_count > 1, 'multi_item', 'single_item')",
        "multi_seller_group": "if(unique_seller_count > 1, 'multi_seller', 'single_seller')",
        ROUTE: route_sql("missing"),
    }
    return df.selectExpr("*", *[f"{expression} AS {name}" for name, expression in groups.items()])
