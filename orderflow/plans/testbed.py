"""Adapter from the star-schema test tables to the six delivery tables (integer arithmetic only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.plans.delivery import DeliveryTables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delivery_tables(spark: SparkSession, sf_dir: str) -> DeliveryTables:
    # The names of the nations, as one value: behind a join the planner takes even a small table for too large to be broadcast.
    nations = table(spark, sf_dir, "nation").where("n_nationkey IS NOT NULL")
    names = nations.agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name")))).scalar()
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")

    def later(days, hours=F.lit(0)):
        return F.col("o_orderdate") + F.make_dt_interval(days.cast("int"), hours.cast("int"))

    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
    customer = table(spark, sf_dir, "customer").withColumn("n_name", F.try_element_at(names, F.col("c_nationkey")))
    supplier = table(spark, sf_dir, "supplier").withColumn("n_name", F.try_element_at(names, F.col("s_nationkey")))
    part, size = F.col("p_partkey"), F.col("p_size")
    method = F.concat("l_returnflag", "l_linestatus")
    return DeliveryTables(
        orders=orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.otherwise("processing").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.when(key % 97 != 0, later(F.lit(0), key % 48)).alias("order_approved_at"),
            later(F.lit(2)).alias("order_delivered_carrier_date"),
            F.when(key % 89 != 0, later(3 + (key * 31) % 40)).alias("order_delivered_customer_date"),
            later(F.lit(30)).alias("order_estimated_delivery_date"),
        ),
        customers=customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        ),
        order_items=line.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        ),
        products=table(spark, sf_dir, "part").select(
            part.alias("product_id"),
            F.when(part % 40 != 7, F.col("p_type")).alias("product_category_name"),
            F.length("p_name").cast("double").alias("product_name_lenght"),
            F.length("p_brand").cast("double").alias("product_description_lenght"),
            (1 + part % 5).cast("double").alias("product_photos_qty"),
            F.when(part % 50 != 0, size * 100).cast("double").alias("product_weight_g"),
            F.when(part % 60 != 0, size).cast("double").alias("product_length_cm"),
            (1 + part % 20).cast("double").alias("product_height_cm"),
            (5 + part % 7).cast("double").alias("product_width_cm"),
        ),
        sellers=supplier.select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        ),
        payments=line.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            # The four most common line types play the named methods, the other two stay as they are.
            F.when(method == "NO", "credit_card")
            .when(method == "RF", "voucher")
            .when(method == "AF", "boleto")
            .when(method == "NF", "debit_card")
            .otherwise(method)
            .alias("payment_type"),
            (F.col("l_quantity").cast("int") % 12).alias("payment_installments"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment_value"),
        ),
    )
