"""Orders and customers: raw text rows to typed, checked tables to summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.texts import parse_bool
from tarn.operators.quality import Rule, expect
from tarn.operators.sequences import dedup

CUSTOMER_RULES = [
    Rule("valid_customer_id", "customer_id IS NOT NULL", "drop"),
    Rule("valid_payment_terms", "payment_terms_days BETWEEN 0 AND 365", "warn"),
]
ORDER_RULES = [
    Rule("has_order_id", "order_id IS NOT NULL", "drop"),
    Rule("has_customer_id", "customer_id IS NOT NULL", "drop"),
    Rule("has_positive_qty", "quantity_units > 0", "drop"),
    Rule("plausible_price", "unit_price BETWEEN 0 AND 1", "warn"),
]
PRICE_SCALE = 1000


def typed_customers(raw: DataFrame) -> DataFrame:
    """Active customers, one row per id, before the expectations are applied."""
    typed = raw.select(
        "customer_id", "customer_name", "tier", "region", "contract_type",
        F.col("payment_terms_days").try_cast("int").alias("payment_terms_days"),
        parse_bool("is_active").alias("is_active"))
    return dedup(typed, ["customer_id"], ["customer_name"]).filter("is_active")


def silver_customers(raw: DataFrame) -> DataFrame:
    return expect(typed_customers(raw), CUSTOMER_RULES)


def typed_orders(raw: DataFrame) -> DataFrame:
    """Typed orders with exact decimal revenue and freight, before the expectations."""
    typed = raw.select(
        "order_id", F.col("order_date").try_cast("date").alias("order_date"), "customer_id", "product_id", "plant_id",
        F.col("quantity_units").try_cast("int").alias("quantity_units"),
        (F.col("unit_price").try_cast("decimal(10,4)") / F.lit(PRICE_SCALE)).alias("unit_price"),
        F.col("freight_cost_per_unit").try_cast("decimal(10,4)").alias("freight_cost_per_unit"),
        F.col("requested_delivery_date").try_cast("date").alias("requested_delivery_date"), "status")
    return typed.select(
        "*", (F.col("quantity_units") * F.col("unit_price")).alias("gross_revenue"),
        (F.col("quantity_units") * F.col("freight_cost_per_unit")).alias("total_freight_cost"))


def silver_orders(raw: DataFrame) -> DataFrame:
    """Works on a batch frame and, being stateless, on a stream."""
    return expect(typed_orders(raw), ORDER_RULES)


def gold_customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Lifetime order metrics of every customer, with or without orders.

    Orders are aggregated before the join: customers are unique by then, so only
    one row per customer crosses the second shuffle, however hot a customer is.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("order_count"), F.sum("quantity_units").alias("total_units_sold"),
        F.round(F.sum("gross_revenue"), 2).alias("lifetime_revenue"),
        F.round(F.sum("total_freight_cost"), 2).alias("lifetime_freight_cost"),
        F.round(F.avg("gross_revenue"), 2).alias("avg_order_revenue"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    who = customers.select("customer_id", "customer_name", "tier", "region", "contract_type")
    return who.join(per_customer, "customer_id", "left").withColumn(
        "order_count", F.coalesce("order_count", F.lit(0).cast("long")))


def gold_region_summary(customer_summary: DataFrame) -> DataFrame:
    """Region figures from the (already rounded) customer rows."""
    revenue = F.sum("lifetime_revenue")
    return customer_summary.filter(F.col("region").isNotNull()).groupBy("region").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("order_count").alias("total_orders"),
        F.round(revenue, 2).alias("total_revenue"), F.round(F.sum("lifetime_freight_cost"), 2).alias("total_freight"),
        F.round(revenue / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias("revenue_per_customer"))
