"""The driver tables, given the shape of the inputs the jobs expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.sources.tables import read_table

# Ten places, the first five are the usual ones.
PLACES = [
    ("Site_A", 39.53, -119.75), ("Site_B", 39.74, -104.99), ("Site_C", 34.73, -86.59),
    ("Site_D", 36.17, -115.14), ("Site_E", 33.45, -112.07), ("Far_A", 55.76, 37.62),
    ("Far_B", 31.23, 121.47), ("Far_C", -23.55, -46.63), ("Far_D", 6.52, 3.38), ("Far_E", 0.0, 0.0),
]
KNOWN_CITIES = ["Site_A", "Site_B", "Site_C", "Site_D", "Site_E"]
BAD_DEVICES = ["odd_0", "odd_1", "odd_2", "odd_3", "odd_4"]
INTERNAL_DOMAINS = ["corp.example"]


def signins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"))
    ev = ev.withColumn("loc_idx", F.expr("CASE WHEN k >= 96 THEN 5 + k % 5 ELSE user_id % 5 END").cast("int"))
    pick = F.col("loc_idx") + 1

    def place(i):
        return F.element_at(F.array(*[F.lit(p[i]) for p in PLACES]), pick)

    return ev.select(
        F.col("event_id").alias("login_id"), "user_id", "ts", "loc_idx",
        place(0).alias("location_name"), place(1).alias("latitude"), place(2).alias("longitude"),
        F.expr("CASE WHEN k % 20 = 0 THEN concat('odd_', event_id % 5)"
               " ELSE concat('dev_', (user_id + k % 3) % 5) END").alias("device"),
        F.expr("concat('10.', user_id % 250, '.', k, '.', event_id % 250)").alias("ip_address"),
        (F.col("event_type") != "error").alias("success"),
        F.expr("CASE WHEN event_type = 'error' THEN k % 21 ELSE k % 2 END").cast("long").alias("failed_attempts_before"),
        F.col("value").alias("session_duration_min"),
        (F.col("k") % 7 != 0).alias("mfa_used"),
        F.expr("CASE WHEN k >= 98 THEN 'impossible_travel' WHEN k >= 96 THEN 'new_device_location'"
               " WHEN event_type = 'error' AND k % 21 >= 15 THEN 'brute_force'"
               " WHEN hour(ts) < 5 AND k % 10 = 0 THEN 'off_hours' ELSE 'normal' END").alias("_anomaly_type"))


def signin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ins under the column names of the event pipeline."""
    return signins(spark, sf_dir).select(
        F.lit("signin").alias("event_type"), F.col("login_id").alias("event_id"), F.col("ts").alias("timestamp"),
        "user_id", "ip_address", "latitude", "longitude", F.col("location_name").alias("city"),
        F.substring("location_name", 1, 3).alias("country"), F.col("device").alias("device_type"),
        F.concat(F.col("device"), F.lit("#"), F.col("user_id")).alias("device_id"),
        "mfa_used", F.col("success").alias("login_success"),
        F.col("failed_attempts_before").alias("failed_attempts"), F.lit("portal").alias("application"),
        F.col("_anomaly_type").alias("_synthetic_category"))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("email_id"),
        F.timestamp_seconds(F.lit(1735689600) + F.col("doc_id") * 2220).alias("ts"),
        F.col("source").alias("sender"),
        F.expr("concat('src', doc_id * 7 % 25)").alias("recipient"),
        F.expr("CASE WHEN doc_id % 5 = 0 THEN 'ext.example' ELSE 'corp.example' END").alias("sender_domain"),
        F.expr("CASE WHEN doc_id % 7 = 0 THEN 'ext.example' ELSE 'corp.example' END").alias("recipient_domain"),
        F.expr("concat(CASE doc_id % 17 WHEN 1 THEN 'URGENT: ' WHEN 2 THEN 'Zip up ' WHEN 3 THEN 'Admin password '"
               " ELSE '' END, substr(text, 1, 40))").alias("subject"),
        F.col("text").alias("body"),
        (F.col("doc_id") % 3 == 0).alias("has_attachment"),
        F.expr("CASE WHEN doc_id % 3 = 0 THEN 1 + doc_id % 2 ELSE 0 END").cast("long").alias("attachment_count"),
        F.expr("CASE doc_id % 12 WHEN 0 THEN 'dump.sql|all.tar.gz' WHEN 3 THEN 'notes.docx'"
               " WHEN 6 THEN 'page.html|pic.png' WHEN 9 THEN 'sheet.xlsx' END").alias("attachment_names"),
        (F.col("n_chars").cast("double") / 100).alias("size_mb"),
        F.expr("CASE WHEN doc_id % 5 = 0 THEN 'inbound' WHEN doc_id % 7 = 0 THEN 'outbound' ELSE 'internal' END").alias("direction"),
        F.col("lang").alias("_label"))


def email_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages under the column names of the event pipeline."""
    e = emails(spark, sf_dir)
    return e.select(
        F.lit("email").alias("event_type"), F.col("email_id").alias("event_id"), F.col("ts").alias("timestamp"),
        "sender", "sender_domain", "recipient", "recipient_domain", "subject",
        F.length("body").cast("long").alias("body_length"), "has_attachment", "attachment_count",
        F.col("attachment_names").alias("attachment_types"), "size_mb", "direction",
        F.col("_label").alias("_synthetic_category"))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    base = c.select(
        F.expr("CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE concat('C', c_custkey) END").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.expr("CASE c_custkey % 4 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Platinum' ELSE 'Bronze' END").alias("tier"),
        F.expr("concat('R', c_nationkey % 5)").alias("region"),
        F.col("c_mktsegment").alias("contract_type"),
        F.expr("CASE WHEN c_custkey % 89 = 1 THEN 'n/a' WHEN c_custkey % 83 = 2 THEN '999'"
               " ELSE CAST(15 * (1 + c_custkey % 4) AS STRING) END").alias("payment_terms_days"),
        F.expr("CASE WHEN c_custkey % 11 = 3 THEN 'false' WHEN c_custkey % 2 = 0 THEN 'TRUE' ELSE 'yes' END").alias("is_active"))
    again = c.filter("c_custkey % 50 = 0").select(
        F.expr("CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE concat('C', c_custkey) END").alias("customer_id"),
        F.concat(F.col("c_name"), F.lit(" (dup)")).alias("customer_name"), F.lit("Gold").alias("tier"),
        F.lit("R0").alias("region"), F.col("c_mktsegment").alias("contract_type"),
        F.lit("30").alias("payment_terms_days"), F.lit("true").alias("is_active"))
    return base.unionByName(again)


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    day = "CASE WHEN o_orderkey % 103 = 0 THEN '2024-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"
    return o.select(
        F.expr("CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('O', o_orderkey) END").alias("order_id"),
        F.expr(day).alias("order_date"),
        F.expr("CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('C', o_custkey) END").alias("customer_id"),
        F.expr("concat('P', o_orderkey % 9)").alias("product_id"),
        F.expr("concat('S', o_orderkey % 6)").alias("plant_id"),
        F.expr("CASE WHEN o_orderkey % 107 = 0 THEN 'x' ELSE CAST(o_orderkey % 60 - 1 AS STRING) END").alias("quantity_units"),
        F.expr("CAST(CAST(90 + o_orderkey % 1000 AS DECIMAL(10,4)) AS STRING)").alias("unit_price"),
        F.expr("CAST(CAST(o_orderkey % 30 AS DECIMAL(10,4)) AS STRING)").alias("freight_cost_per_unit"),
        F.expr(day).alias("requested_delivery_date"), F.col("o_orderstatus").alias("status"))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    g = ev.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("value") < 1).alias("null_count"),
        F.min("ts").alias("min_event_ts"), F.max("ts").alias("max_event_ts"), F.sum("value").alias("total"))
    return g.select(
        F.lit("bronze_to_silver").alias("pipeline_stage"), "event_type",
        F.date_add("day", 1).cast("timestamp").alias("run_timestamp"), "row_count", "null_count",
        F.round(F.col("null_count") / (2 * F.col("row_count")).cast("double"), 6).alias("null_rate"),
        "min_event_ts", "max_event_ts", F.round(F.col("total") / 10, 4).alias("processing_seconds"),
        F.lit("success").alias("status"))
