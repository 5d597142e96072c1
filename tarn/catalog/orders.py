"""Queries of the order pipeline, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.catalog.adapters_sql import CUSTOMERS, EMAILS, EVENTS, GOLD, ORDERS, SIGNINS
from tarn.catalog.registry import big, query, r6
from tarn.functions.texts import contains_any, parse_bool
from tarn.functions.times import parse_ts
from tarn.functions.values import clip, fill, filter_in, require
from tarn.operators import sequences as seq
from tarn.operators.quality import expect, expectation_metrics, load_checked, with_warnings
from tarn.plans import events as ev
from tarn.plans import medallion as med
from tarn.session import scratch_path
from tarn.sources import adapters as ad
from tarn.sources import tables as tb


def customers(spark, d):
    return med.silver_customers(ad.customers_raw(spark, d))


def orders(spark, d):
    return med.silver_orders(ad.orders_raw(spark, d))


def gold(spark, d):
    return med.gold_customer_summary(customers(spark, d), orders(spark, d))


ORDER_COLUMNS = ", ".join([
    "order_id", "CAST(order_date AS VARCHAR) AS order_date", "customer_id", "product_id", "plant_id",
    big("quantity_units"), r6("unit_price"), r6("freight_cost_per_unit"),
    "CAST(requested_delivery_date AS VARCHAR) AS requested_delivery_date", "status", r6("gross_revenue"),
    r6("total_freight_cost")])
CUSTOMER_COLUMNS = ("customer_id, customer_name, tier, region, contract_type, "
                    "CAST(payment_terms_days AS BIGINT) AS payment_terms_days, is_active")
GOLD_COLUMNS = ", ".join([
    "customer_id", "customer_name", "tier", "region", "contract_type", big("order_count"), big("total_units_sold"),
    r6("lifetime_revenue"), r6("lifetime_freight_cost"), r6("avg_order_revenue"),
    "CAST(first_order_date AS VARCHAR) AS first_order_date", "CAST(last_order_date AS VARCHAR) AS last_order_date"])
EVENT_ROWS = "SELECT event_id, user_id, event_type, round(value, 6) + 0.0 AS value FROM events"


def event_rows(spark, d):
    return tb.read_table(spark, d, "events").select("event_id", "user_id", "event_type", "value")


# --- sources and sinks -------------------------------------------------------

@query("src_table", EVENT_ROWS)
def _(spark, d):
    return event_rows(spark, d)


@query("src_inline_rows", f"WITH {CUSTOMERS}, tier_rank(tier, tier_rank) AS (VALUES ('Gold', 1), ('Silver', 2), ('Bronze', 3))"
       " SELECT c.tier, CAST(r.tier_rank AS BIGINT) AS tier_rank, count(*) AS n_customers FROM customers_raw c"
       " LEFT JOIN tier_rank r USING (tier) GROUP BY ALL")
def _(spark, d):
    ranks = tb.inline(spark, [("Gold", "1"), ("Silver", "2"), ("Bronze", "3")], "tier string, tier_rank string")
    joined = ad.customers_raw(spark, d).join(ranks, "tier", "left")
    return joined.groupBy("tier", F.col("tier_rank").cast("int").alias("tier_rank")).agg(F.count(F.lit(1)).alias("n_customers"))


@query("src_since_watermark", f"WITH {SIGNINS}, scored AS (SELECT * FROM signins WHERE ts < TIMESTAMP '2024-01-15')"
       " SELECT login_id, user_id FROM signins WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '2000-01-01') FROM scored)")
def _(spark, d):
    s = ad.signins(spark, d)
    return tb.read_since(s, s.filter("ts < timestamp'2024-01-15'")).select("login_id", "user_id")


@query("sink_overwrite", f"WITH {CUSTOMERS} SELECT {CUSTOMER_COLUMNS} FROM silver_customers")
def _(spark, d):
    path = scratch_path(spark, "overwrite")
    tb.write_table(ad.customers_raw(spark, d), path)
    tb.write_table(customers(spark, d), path)
    return spark.read.parquet(path)


@query("sink_append", EVENT_ROWS)
def _(spark, d):
    path = scratch_path(spark, "append")
    rows = event_rows(spark, d)
    tb.write_table(rows.filter("event_type = 'error'"), path)
    tb.write_table(rows.filter("event_type <> 'error'"), path, "append")
    return spark.read.parquet(path)


@query("sink_jsonl_batches", EVENT_ROWS)
def _(spark, d):
    path = scratch_path(spark, "jsonl")
    tb.land_jsonl(event_rows(spark, d), path, 500)
    return spark.read.schema("event_id long, user_id long, event_type string, value double").json(path)


@query("sink_typed_empty", f"WITH {ORDERS} SELECT order_id, customer_id, status FROM silver_orders")
def _(spark, d):
    path = scratch_path(spark, "typed")
    tb.ensure_table(spark, path, "order_id string, customer_id string, status string")
    tb.write_table(orders(spark, d).select("order_id", "customer_id", "status"), path, "append")
    return tb.ensure_table(spark, path, "order_id string, customer_id string, status string")


@query("sink_view", f"WITH {EVENTS} SELECT event_id, event_type, risk_tier FROM alerts")
def _(spark, d):
    alerts = ev.security_alerts(ev.email_scores(ad.email_events(spark, d)), ev.signin_scores(ad.signin_events(spark, d)))
    tb.publish_view(alerts, "security_alerts")
    return spark.sql("SELECT event_id, event_type, risk_tier FROM security_alerts")


@query("sink_materialized", f"WITH {GOLD} SELECT {GOLD_COLUMNS} FROM gold")
def _(spark, d):
    c = tb.materialize(med.silver_customers, [ad.customers_raw(spark, d)], scratch_path(spark, "silver_customers"))
    o = tb.materialize(med.silver_orders, [ad.orders_raw(spark, d)], scratch_path(spark, "silver_orders"))
    return tb.materialize(med.gold_customer_summary, [c, o], scratch_path(spark, "gold"))


@query("sink_json_rows", f"WITH {CUSTOMERS} SELECT concat('{{\"customer_id\":\"', customer_id, '\",\"tier\":\"', tier, '\",\"payment_terms_days\":',"
       " coalesce(CAST(payment_terms_days AS VARCHAR), 'null'), '}') AS payload FROM silver_customers")
def _(spark, d):
    return tb.to_json_rows(customers(spark, d).select("customer_id", "tier", "payment_terms_days"))


# --- typing, projection, filters ---------------------------------------------

@query("typ_try_cast", f"WITH {ORDERS} SELECT {ORDER_COLUMNS} FROM priced_orders")
def _(spark, d):
    return med.typed_orders(ad.orders_raw(spark, d))


@query("typ_bool_parse", f"WITH {CUSTOMERS} SELECT customer_id, customer_name, is_active FROM typed_customers")
def _(spark, d):
    return ad.customers_raw(spark, d).select("customer_id", "customer_name", parse_bool("is_active").alias("is_active"))


@query("typ_decimal_scale", f"WITH {ORDERS} SELECT {ORDER_COLUMNS} FROM silver_orders")
def _(spark, d):
    return orders(spark, d)


@query("typ_parse_ts", "SELECT event_id, epoch_us(ts) AS micros FROM events")
def _(spark, d):
    text = tb.read_table(spark, d, "events").select("event_id", F.col("ts").cast("string").alias("text"))
    return text.select("event_id", F.unix_micros(parse_ts("text")).alias("micros"))


@query("prj_prune", f"WITH {EMAILS} SELECT email_id AS event_id, sender, recipient, has_attachment FROM emails")
def _(spark, d):
    return ad.email_events(spark, d).drop("_synthetic_category").select("event_id", "sender", "recipient", "has_attachment")


@query("flt_required", f"WITH {ORDERS} SELECT order_id, customer_id, product_id FROM orders_raw"
       " WHERE order_id IS NOT NULL AND customer_id IS NOT NULL")
def _(spark, d):
    return require(ad.orders_raw(spark, d), ["order_id", "customer_id"]).select("order_id", "customer_id", "product_id")


@query("flt_business", f"WITH {CUSTOMERS} SELECT {CUSTOMER_COLUMNS} FROM active_customers")
def _(spark, d):
    return med.typed_customers(ad.customers_raw(spark, d))


@query("flt_in_tiers", f"WITH {CUSTOMERS} SELECT customer_id, customer_name, tier FROM customers_raw WHERE tier IN ('Gold', 'Platinum')")
def _(spark, d):
    return filter_in(ad.customers_raw(spark, d), "tier", ["Gold", "Platinum"]).select("customer_id", "customer_name", "tier")


@query("flt_keyword_any", f"WITH {EMAILS} SELECT email_id, contains(lower(subject), 'urgent') OR contains(lower(subject), 'zip up')"
       " AS hit FROM emails")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", contains_any("subject", ["URGENT", "zip up"]).alias("hit"))


@query("fil_defaults", f"WITH {ORDERS} SELECT order_id, product_id, coalesce(CAST(quantity_units AS BIGINT), 0) AS quantity_units,"
       " coalesce(customer_id, 'unknown') AS customer_id FROM typed_orders")
def _(spark, d):
    o = med.typed_orders(ad.orders_raw(spark, d)).select("order_id", "product_id", "quantity_units", "customer_id")
    return fill(o, {"quantity_units": 0, "customer_id": "unknown"})


@query("fil_clip", f"WITH {EMAILS} SELECT email_id, round(least(size_mb, 20), 6) + 0.0 AS size_mb FROM emails")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", clip("size_mb", hi=20.0).alias("size_mb"))


# --- expectations -------------------------------------------------------------

@query("dq_drop_row", f"WITH {ORDERS} SELECT order_id, customer_id, CAST(quantity_units AS BIGINT) AS quantity_units FROM silver_orders")
def _(spark, d):
    return orders(spark, d).select("order_id", "customer_id", "quantity_units")


@query("dq_warn", f"WITH {CUSTOMERS} SELECT {CUSTOMER_COLUMNS}, CASE WHEN coalesce(payment_terms_days BETWEEN 0 AND 365, false) THEN ''"
       " ELSE 'valid_payment_terms' END AS warnings FROM silver_customers")
def _(spark, d):
    """All customers that are kept, with the rules that they violate."""
    return with_warnings(customers(spark, d), med.CUSTOMER_RULES)


@query("dq_warn_counts", f"WITH {CUSTOMERS} SELECT 'valid_payment_terms' AS rule, 'warn' AS action,"
       " count(*) FILTER (NOT coalesce(payment_terms_days BETWEEN 0 AND 365, false)) AS violations FROM active_customers"
       " UNION ALL SELECT 'valid_customer_id', 'drop', count(*) FILTER (customer_id IS NULL) FROM active_customers")
def _(spark, d):
    """Violations that the load of the customers counted on its way."""
    out, log = scratch_path(spark, "customers"), scratch_path(spark, "violations")
    load_checked(med.typed_customers(ad.customers_raw(spark, d)), med.CUSTOMER_RULES, out, log)
    return spark.read.parquet(log)


@query("dq_fail", f"WITH {ORDERS} SELECT order_id, customer_id FROM silver_orders")
def _(spark, d):
    from tarn.operators.quality import Rule

    return expect(orders(spark, d), [Rule("still_present", "order_id IS NOT NULL", "fail")]).select("order_id", "customer_id")


@query("dq_metrics", f"WITH {ORDERS} "
       "SELECT 'has_order_id' AS rule, 'drop' AS action, count(*) FILTER (order_id IS NULL) AS violations FROM priced_orders"
       " UNION ALL SELECT 'has_customer_id', 'drop', count(*) FILTER (customer_id IS NULL) FROM priced_orders"
       " UNION ALL SELECT 'has_positive_qty', 'drop', count(*) FILTER (NOT coalesce(quantity_units > 0, false)) FROM priced_orders"
       " UNION ALL SELECT 'plausible_price', 'warn', count(*) FILTER (NOT coalesce(unit_price BETWEEN 0 AND 1, false)) FROM priced_orders")
def _(spark, d):
    return expectation_metrics(med.typed_orders(ad.orders_raw(spark, d)), med.ORDER_RULES)


COUNTED = f"""WITH {GOLD}
SELECT 'customers_raw' AS table_name, count(*) AS row_count FROM customers_raw
UNION ALL SELECT 'orders_raw', count(*) FROM orders_raw
UNION ALL SELECT 'silver_customers', count(*) FROM silver_customers
UNION ALL SELECT 'silver_orders', count(*) FROM silver_orders"""


def counted(spark, d):
    return tb.check_counts({"customers_raw": ad.customers_raw(spark, d), "orders_raw": ad.orders_raw(spark, d),
                            "silver_customers": customers(spark, d), "silver_orders": orders(spark, d)})


query("dq_row_counts", COUNTED)(counted)
query("set_counts_union", COUNTED)(counted)


# --- summaries ----------------------------------------------------------------

GOLD_SQL = f"WITH {GOLD} SELECT {GOLD_COLUMNS} FROM gold"
query("join_customer_orders", GOLD_SQL)(gold)
query("agg_customer_360", GOLD_SQL)(gold)


@query("agg_region_kpi", f"WITH {GOLD} SELECT region, count(*) AS active_customers, CAST(sum(order_count) AS BIGINT) AS total_orders, "
       + ", ".join([r6("round(sum(lifetime_revenue), 2)", "total_revenue"), r6("round(sum(lifetime_freight_cost), 2)", "total_freight"),
                    r6("round(CAST(sum(lifetime_revenue) AS DOUBLE) / nullif(count(*), 0), 2)", "revenue_per_customer")])
       + " FROM gold WHERE region IS NOT NULL GROUP BY region")
def region_kpi(spark, d):
    return med.gold_region_summary(gold(spark, d))


@query("win_dedup", f"WITH {CUSTOMERS} SELECT customer_id, customer_name, tier FROM (SELECT *, row_number() OVER"
       " (PARTITION BY customer_id ORDER BY customer_name) AS rn FROM customers_raw) WHERE rn = 1")
def _(spark, d):
    return seq.dedup(ad.customers_raw(spark, d), ["customer_id"], ["customer_name"]).select("customer_id", "customer_name", "tier")
