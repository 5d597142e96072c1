"""The adapters of ``tarn.sources.adapters`` as common table expressions."""

from __future__ import annotations

from tarn.sources.adapters import PLACES

CUTOFF = "2024-01-20"


def _place(i: int) -> str:
    kind = "VARCHAR" if i == 0 else "DOUBLE"
    arms = " ".join(f"WHEN {n} THEN {p[i]!r}" for n, p in enumerate(PLACES))
    return f"CAST(CASE loc_idx {arms} END AS {kind})"


SIGNINS = f"""
ev AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
ev2 AS (SELECT *, CASE WHEN k >= 96 THEN 5 + k % 5 ELSE user_id % 5 END AS loc_idx FROM ev),
signins AS (SELECT event_id AS login_id, user_id, ts, loc_idx,
  {_place(0)} AS location_name, {_place(1)} AS latitude, {_place(2)} AS longitude,
  CASE WHEN k % 20 = 0 THEN concat('odd_', event_id % 5) ELSE concat('dev_', (user_id + k % 3) % 5) END AS device,
  concat('10.', user_id % 250, '.', k, '.', event_id % 250) AS ip_address,
  event_type <> 'error' AS success,
  CAST(CASE WHEN event_type = 'error' THEN k % 21 ELSE k % 2 END AS BIGINT) AS failed_attempts_before,
  value AS session_duration_min, k % 7 <> 0 AS mfa_used,
  CASE WHEN k >= 98 THEN 'impossible_travel' WHEN k >= 96 THEN 'new_device_location'
       WHEN event_type = 'error' AND k % 21 >= 15 THEN 'brute_force'
       WHEN hour(ts) < 5 AND k % 10 = 0 THEN 'off_hours' ELSE 'normal' END AS _anomaly_type,
  CAST(hour(ts) AS BIGINT) AS hour, CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week,
  CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s
  FROM ev2)"""

SEQ = SIGNINS + """,
seq AS (SELECT *, lag(epoch_s) OVER w AS prev_epoch, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon
  FROM signins WINDOW w AS (PARTITION BY user_id ORDER BY ts, login_id)),
travel AS (SELECT *, (epoch_s - prev_epoch) / CAST(60 AS DOUBLE) AS gap_min,
  CASE WHEN plat IS NOT NULL THEN CAST(12742 AS DOUBLE) * asin(sqrt(least(CAST(1 AS DOUBLE),
    pow(sin(radians(latitude - plat) / 2), 2)
    + cos(radians(plat)) * cos(radians(latitude)) * pow(sin(radians(longitude - plon) / 2), 2)))) END AS km
  FROM seq)"""

FEATURES = SEQ + f""",
known_loc AS (SELECT DISTINCT location_name FROM signins WHERE _anomaly_type = 'normal'),
baseline AS (SELECT user_id, avg(session_duration_min) AS baseline_session_avg,
  stddev_samp(session_duration_min) AS baseline_session_std, avg(failed_attempts_before) AS baseline_failed_avg,
  avg(hour) AS baseline_hour_avg, stddev_samp(hour) AS baseline_hour_std, count(*) AS baseline_login_count,
  count(DISTINCT device) AS baseline_device_count, count(DISTINCT ip_address) AS baseline_ip_count
  FROM signins WHERE ts < TIMESTAMP '{CUTOFF}' GROUP BY user_id),
known_dev AS (SELECT DISTINCT user_id, device, 1 AS known FROM signins WHERE ts < TIMESTAMP '{CUTOFF}'),
feat AS (SELECT t.login_id, t.user_id, t.ts, t.hour, t.day_of_week,
  CASE WHEN t.day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN t.hour < 7 OR t.hour > 19 THEN 1 ELSE 0 END AS is_off_hours,
  sin(2 * pi() * t.hour / 24) AS hour_sin, cos(2 * pi() * t.hour / 24) AS hour_cos,
  t.gap_min AS minutes_since_last_login, t.km AS distance_from_prev_km,
  CASE WHEN t.gap_min > 0 THEN t.km / (t.gap_min / 60) END AS geo_velocity_kmh,
  CASE WHEN l.location_name IS NOT NULL THEN 0 ELSE 1 END AS is_unknown_location, t.latitude, t.longitude,
  t.failed_attempts_before, CASE WHEN t.mfa_used THEN 1 ELSE 0 END AS mfa_numeric, t.session_duration_min,
  CASE WHEN b.baseline_session_std > 0
       THEN (t.session_duration_min - b.baseline_session_avg) / b.baseline_session_std ELSE 0 END AS session_duration_zscore,
  CASE WHEN d.known = 1 THEN 0 ELSE 1 END AS is_new_device,
  count(*) OVER (PARTITION BY t.user_id ORDER BY t.epoch_s RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS logins_last_hour,
  t.location_name, t.device, t.ip_address, t._anomaly_type
  FROM travel t LEFT JOIN known_loc l USING (location_name) LEFT JOIN baseline b ON b.user_id = t.user_id
  LEFT JOIN known_dev d ON d.user_id = t.user_id AND d.device = t.device)"""

MATRIX_COLUMNS = [
    "hour_sin", "hour_cos", "is_weekend", "is_off_hours", "minutes_since_last_login", "distance_from_prev_km",
    "geo_velocity_kmh", "is_unknown_location", "failed_attempts_before", "mfa_numeric", "session_duration_min",
    "session_duration_zscore", "is_new_device", "logins_last_hour",
]
_CELLS = ", ".join(
    f"round(CAST(coalesce({'CASE WHEN geo_velocity_kmh > 50000 THEN 50000 ELSE geo_velocity_kmh END' if c == 'geo_velocity_kmh' else c}, 0) AS DOUBLE), 6) + 0.0 AS {c}"
    for c in MATRIX_COLUMNS)
MATRIX = FEATURES + f""",
mat AS (SELECT login_id, user_id, _anomaly_type, {_CELLS} FROM feat)"""

EMAILS = """
emails AS (SELECT doc_id AS email_id, make_timestamp((1735689600 + doc_id * 2220) * 1000000) AS ts, source AS sender,
  concat('src', doc_id * 7 % 25) AS recipient,
  CASE WHEN doc_id % 5 = 0 THEN 'ext.example' ELSE 'corp.example' END AS sender_domain,
  CASE WHEN doc_id % 7 = 0 THEN 'ext.example' ELSE 'corp.example' END AS recipient_domain,
  concat(CASE doc_id % 17 WHEN 1 THEN 'URGENT: ' WHEN 2 THEN 'Zip up ' WHEN 3 THEN 'Admin password ' ELSE '' END,
         substr(text, 1, 40)) AS subject,
  text AS body, doc_id % 3 = 0 AS has_attachment,
  CAST(CASE WHEN doc_id % 3 = 0 THEN 1 + doc_id % 2 ELSE 0 END AS BIGINT) AS attachment_count,
  CASE doc_id % 12 WHEN 0 THEN 'dump.sql|all.tar.gz' WHEN 3 THEN 'notes.docx' WHEN 6 THEN 'page.html|pic.png'
       WHEN 9 THEN 'sheet.xlsx' END AS attachment_names,
  CAST(n_chars AS DOUBLE) / 100 AS size_mb,
  CASE WHEN doc_id % 5 = 0 THEN 'inbound' WHEN doc_id % 7 = 0 THEN 'outbound' ELSE 'internal' END AS direction,
  lang AS _label FROM documents)"""

CUSTOMERS = """
customers_raw AS (
  SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE concat('C', c_custkey) END AS customer_id, c_name AS customer_name,
    CASE c_custkey % 4 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Platinum' ELSE 'Bronze' END AS tier,
    concat('R', c_nationkey % 5) AS region, c_mktsegment AS contract_type,
    CASE WHEN c_custkey % 89 = 1 THEN 'n/a' WHEN c_custkey % 83 = 2 THEN '999'
         ELSE CAST(15 * (1 + c_custkey % 4) AS VARCHAR) END AS payment_terms_days,
    CASE WHEN c_custkey % 11 = 3 THEN 'false' WHEN c_custkey % 2 = 0 THEN 'TRUE' ELSE 'yes' END AS is_active
  FROM customer
  UNION ALL
  SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE concat('C', c_custkey) END, concat(c_name, ' (dup)'), 'Gold', 'R0',
    c_mktsegment, '30', 'true' FROM customer WHERE c_custkey % 50 = 0),
typed_customers AS (
  SELECT customer_id, customer_name, tier, region, contract_type, TRY_CAST(payment_terms_days AS INTEGER) AS payment_terms_days,
    lower(is_active) IN ('true', 't', '1', 'yes') AS is_active FROM customers_raw),
active_customers AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_name) AS rn
  FROM typed_customers) WHERE rn = 1 AND is_active),
silver_customers AS (SELECT * FROM active_customers WHERE customer_id IS NOT NULL)"""

_DAY = "CASE WHEN o_orderkey % 103 = 0 THEN '2024-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END"
ORDERS = f"""
orders_raw AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('O', o_orderkey) END AS order_id, {_DAY} AS order_date,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('C', o_custkey) END AS customer_id,
    concat('P', o_orderkey % 9) AS product_id, concat('S', o_orderkey % 6) AS plant_id,
    CASE WHEN o_orderkey % 107 = 0 THEN 'x' ELSE CAST(o_orderkey % 60 - 1 AS VARCHAR) END AS quantity_units,
    CAST(CAST(90 + o_orderkey % 1000 AS DECIMAL(10,4)) AS VARCHAR) AS unit_price,
    CAST(CAST(o_orderkey % 30 AS DECIMAL(10,4)) AS VARCHAR) AS freight_cost_per_unit,
    {_DAY} AS requested_delivery_date, o_orderstatus AS status FROM orders),
typed_orders AS (
  SELECT order_id, TRY_CAST(order_date AS DATE) AS order_date, customer_id, product_id, plant_id,
    TRY_CAST(quantity_units AS INTEGER) AS quantity_units,
    TRY_CAST(unit_price AS DECIMAL(10,4)) * CAST(0.001 AS DECIMAL(4,3)) AS unit_price,
    TRY_CAST(freight_cost_per_unit AS DECIMAL(10,4)) AS freight_cost_per_unit,
    TRY_CAST(requested_delivery_date AS DATE) AS requested_delivery_date, status FROM orders_raw),
priced_orders AS (
  SELECT *, CAST(quantity_units AS DECIMAL(10,0)) * unit_price AS gross_revenue,
    CAST(quantity_units AS DECIMAL(10,0)) * freight_cost_per_unit AS total_freight_cost FROM typed_orders),
silver_orders AS (SELECT * FROM priced_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND quantity_units > 0)"""

GOLD = CUSTOMERS + "," + ORDERS + """,
gold AS (
  SELECT c.customer_id, c.customer_name, c.tier, c.region, c.contract_type, count(DISTINCT o.order_id) AS order_count,
    sum(o.quantity_units) AS total_units_sold, round(sum(o.gross_revenue), 2) AS lifetime_revenue,
    round(sum(o.total_freight_cost), 2) AS lifetime_freight_cost,
    (2 * CAST(sum(o.gross_revenue) * 10000000 AS HUGEINT) + 100000 * count(o.gross_revenue))
      // nullif(200000 * count(o.gross_revenue), 0) / CAST(100 AS DOUBLE) AS avg_order_revenue,
    min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date
  FROM silver_customers c LEFT JOIN silver_orders o ON c.customer_id = o.customer_id
  GROUP BY ALL)"""

HEALTH = """
health AS (
  SELECT 'bronze_to_silver' AS pipeline_stage, event_type, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS run_timestamp,
    count(*) AS row_count, count(*) FILTER (value < 1) AS null_count,
    round(CAST(count(*) FILTER (value < 1) AS DOUBLE) / (2 * count(*)), 6) AS null_rate,
    min(ts) AS min_event_ts, max(ts) AS max_event_ts, round(sum(value) / 10, 4) AS processing_seconds, 'success' AS status
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""


def _any(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + ")"


def _event_scores() -> str:
    from tarn.functions.rules import EXFILTRATION_PHRASES, PHISHING_PHRASES, POLICY_PHRASES, SUSPICIOUS_TYPES

    odd = "(" + " OR ".join(f"contains(coalesce(attachment_types, ''), '{t}')" for t in SUSPICIOUS_TYPES) + ")"
    tier = ("CASE WHEN risk_score >= 0.6 THEN 'Critical' WHEN risk_score >= 0.4 THEN 'High'"
            " WHEN risk_score >= 0.2 THEN 'Medium' ELSE 'Low' END")
    return SEQ + "," + EMAILS + f""",
silver_email AS (
  SELECT email_id AS event_id, ts AS timestamp, sender, sender_domain, recipient, recipient_domain, subject,
    CAST(length(body) AS BIGINT) AS body_length, has_attachment, attachment_count, attachment_names AS attachment_types,
    size_mb, CAST(hour(ts) AS BIGINT) AS hour, CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week,
    hour(ts) < 7 OR hour(ts) > 19 AS is_off_hours, dayofweek(ts) IN (0, 6) AS is_weekend,
    sender_domain <> 'corp.example' AS is_external_sender, recipient_domain <> 'corp.example' AS is_external_recipient,
    CASE WHEN sender_domain <> 'corp.example' THEN 'inbound' WHEN recipient_domain <> 'corp.example' THEN 'outbound'
         ELSE 'internal' END AS direction,
    subject IS NULL AS _dq_missing_subject, sender IS NULL AS _dq_missing_sender, size_mb > 100 AS _dq_oversized
  FROM emails WHERE email_id IS NOT NULL AND ts IS NOT NULL),
email_sig AS (
  SELECT *, CASE WHEN {_any('subject', EXFILTRATION_PHRASES)} THEN 'data_exfiltration'
      WHEN {_any('subject', PHISHING_PHRASES)} THEN 'phishing'
      WHEN {_any('subject', POLICY_PHRASES)} THEN 'policy_violation' ELSE 'none' END AS keyword_category,
    CAST(CASE WHEN has_attachment AND {odd} AND size_mb > 10 THEN 0.9 WHEN has_attachment AND size_mb > 50 THEN 0.8
      WHEN has_attachment AND {odd} THEN 0.6 WHEN has_attachment AND size_mb > 10 THEN 0.4 ELSE 0 END AS DOUBLE) AS attachment_signal,
    CAST(CASE WHEN direction = 'outbound' AND has_attachment AND size_mb > 5 THEN 0.8
      WHEN direction = 'outbound' AND has_attachment THEN 0.5
      WHEN direction = 'inbound' AND is_external_sender THEN 0.3 ELSE 0 END AS DOUBLE) AS direction_signal,
    CAST(CASE WHEN is_off_hours AND is_weekend THEN 0.7 WHEN is_off_hours THEN 0.4 WHEN is_weekend THEN 0.3 ELSE 0 END AS DOUBLE)
      AS temporal_signal FROM silver_email),
email_sig2 AS (
  SELECT *, CAST(CASE keyword_category WHEN 'data_exfiltration' THEN 0.9 WHEN 'phishing' THEN 0.85
    WHEN 'policy_violation' THEN 0.8 ELSE 0 END AS DOUBLE) AS keyword_signal FROM email_sig),
email_sum AS (
  SELECT *, CAST(0.35 AS DOUBLE) * keyword_signal + CAST(0.25 AS DOUBLE) * attachment_signal
    + CAST(0.2 AS DOUBLE) * direction_signal + CAST(0.2 AS DOUBLE) * temporal_signal AS risk_score FROM email_sig2),
email_scores AS (
  SELECT *, {tier} AS risk_tier, concat_ws('; ',
    CASE WHEN keyword_signal > 0 THEN concat('keyword_match:', keyword_category) END,
    CASE WHEN attachment_signal > 0.5 THEN concat('suspicious_attachment:', CAST(round(size_mb, 1) AS VARCHAR), 'MB') END,
    CASE WHEN direction_signal > 0.3 THEN concat('external_', direction) END,
    CASE WHEN temporal_signal > 0 THEN 'off_hours_activity' END) AS risk_reasons FROM email_sum),
silver_signin AS (
  SELECT login_id AS event_id, ts AS timestamp, user_id, ip_address, latitude, longitude, location_name AS city,
    substr(location_name, 1, 3) AS country, device AS device_type, concat(device, '#', user_id) AS device_id, mfa_used,
    success AS login_success, failed_attempts_before AS failed_attempts, 'portal' AS application, hour, day_of_week,
    hour < 7 OR hour > 19 AS is_off_hours, day_of_week IN (1, 7) AS is_weekend, gap_min AS minutes_since_last,
    coalesce(km, 0) AS distance_km, CASE WHEN gap_min > 0 THEN km / (gap_min / 60) ELSE 0 END AS geo_velocity_kmh,
    starts_with(location_name, 'Site_') AS is_known_location, user_id IS NULL AS _dq_missing_user,
    abs(latitude) > 90 OR abs(longitude) > 180 AS _dq_impossible_coords
  FROM travel WHERE login_id IS NOT NULL AND ts IS NOT NULL),
signin_sig AS (
  SELECT *, starts_with(device_type, 'odd_') AS bad_device,
    CAST(CASE WHEN geo_velocity_kmh > 5000 THEN 1.0 WHEN geo_velocity_kmh > 900 THEN 0.9 WHEN geo_velocity_kmh > 500 THEN 0.6
      ELSE 0 END AS DOUBLE) AS geo_signal,
    CAST(CASE WHEN failed_attempts >= 10 THEN 1.0 WHEN failed_attempts >= 5 THEN 0.8
      WHEN failed_attempts >= 3 AND NOT login_success THEN 0.6 WHEN failed_attempts >= 2 THEN 0.3 ELSE 0 END AS DOUBLE) AS auth_signal,
    CAST(CASE WHEN is_off_hours AND NOT mfa_used THEN 0.8 WHEN is_off_hours THEN 0.4 WHEN NOT mfa_used THEN 0.3
      ELSE 0 END AS DOUBLE) AS temporal_mfa_signal FROM silver_signin),
signin_sig2 AS (
  SELECT *, CAST(CASE WHEN NOT is_known_location AND bad_device THEN 1.0 WHEN NOT is_known_location THEN 0.6
    WHEN bad_device THEN 0.5 ELSE 0 END AS DOUBLE) AS location_device_signal FROM signin_sig),
signin_sum AS (
  SELECT *, CAST(0.3 AS DOUBLE) * geo_signal + CAST(0.25 AS DOUBLE) * auth_signal
    + CAST(0.25 AS DOUBLE) * location_device_signal + CAST(0.2 AS DOUBLE) * temporal_mfa_signal AS risk_score FROM signin_sig2),
signin_scores AS (
  SELECT *, {tier} AS risk_tier, concat_ws('; ',
    CASE WHEN geo_signal > 0.5 THEN concat('impossible_travel:', CASE WHEN round(geo_velocity_kmh, 0) >= 1e7 THEN 'big'
      ELSE concat(CAST(CAST(round(geo_velocity_kmh, 0) AS BIGINT) AS VARCHAR), '.0') END, 'km/h') END,
    CASE WHEN auth_signal > 0.3 THEN concat('failed_attempts:', failed_attempts) END,
    CASE WHEN location_device_signal > 0.3 THEN concat('unknown_location_or_device:', city, '/', device_type) END,
    CASE WHEN temporal_mfa_signal > 0.3 THEN CASE WHEN NOT mfa_used THEN 'off_hours_no_mfa' ELSE 'off_hours' END END)
    AS risk_reasons FROM signin_sum),
alerts AS (
  SELECT event_id, timestamp, 'email' AS event_type, CAST(sender AS VARCHAR) AS principal, risk_score, risk_tier, risk_reasons,
    subject AS detail FROM email_scores WHERE risk_tier IN ('Critical', 'High')
  UNION ALL
  SELECT event_id, timestamp, 'signin', CAST(user_id AS VARCHAR), risk_score, risk_tier, risk_reasons,
    concat(city, '/', country, ' via ', device_type) FROM signin_scores WHERE risk_tier IN ('Critical', 'High'))"""


EVENTS = _event_scores()
