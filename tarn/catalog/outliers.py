"""Queries over detector scores, ensembles, threshold tuning and the timeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.catalog.adapters_sql import CUTOFF, EVENTS, MATRIX, MATRIX_COLUMNS, SIGNINS
from tarn.catalog.registry import query, r6
from tarn.catalog.signin import matrix, signins
from tarn.operators import aggregates as agg
from tarn.operators import ensemble as en
from tarn.operators import evaluation as evl
from tarn.operators import forest as fo
from tarn.operators import joins as jn
from tarn.operators import neighbours as nb
from tarn.operators import sequences as seq
from tarn.operators.quantiles import flag_quantile, flag_quantiles
from tarn.operators.scaling import apply_minmax, apply_standard, fit_minmax, fit_standard
from tarn.operators.tails import tail_scores
from tarn.plans import events as ev
from tarn.plans import signins as sg
from tarn.plans import timeline as tl
from tarn.session import cut_lineage
from tarn.sources import adapters as ad
from tarn.sources.tables import read_table

FEATURES = sg.MODEL_FEATURES
_LONG = f"long AS (UNPIVOT mat ON {', '.join(MATRIX_COLUMNS)} INTO NAME feature VALUE value)"


def tails_sql(long: str, key: str) -> str:
    """Tail scores of a CTE ``long(key, feature, value)``."""
    return f"""
cnt AS (SELECT feature, value, count(*) AS n FROM {long} GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY value) AS upto, sum(n) OVER (PARTITION BY feature) AS total FROM cnt),
skew AS (SELECT feature, sign(coalesce(skewness(value), 0)) AS s FROM {long} GROUP BY feature),
lr AS (SELECT c.feature, value, -ln(CAST(upto AS DOUBLE) / total) AS l, -ln(CAST(total - upto + n AS DOUBLE) / total) AS r, s
  FROM cum c JOIN skew USING (feature)),
contrib AS (SELECT *, CASE WHEN s < 0 THEN l WHEN s > 0 THEN r ELSE l + r END AS k FROM lr),
tails AS (SELECT {key}, sum(greatest(l, r, k)) AS ecod, sum(greatest(k, (l + r) / 2)) AS copod
  FROM {long} JOIN contrib USING (feature, value) GROUP BY {key})"""


TAILS = MATRIX + "," + _LONG + "," + tails_sql("long", "login_id")


def tails(spark, d):
    return tail_scores(matrix(spark, d), FEATURES)


@query("od_ecod", f"WITH {TAILS} SELECT login_id, {r6('ecod')} FROM tails")
def _(spark, d):
    return tails(spark, d).select("login_id", "ecod")


@query("od_copod", f"WITH {TAILS} SELECT login_id, {r6('copod')} FROM tails")
def _(spark, d):
    return tails(spark, d).select("login_id", "copod")


@query("sc_standard", f"WITH {MATRIX} SELECT login_id, "
       + r6("(session_duration_min - avg(session_duration_min) OVER ()) / stddev_pop(session_duration_min) OVER ()", "session_duration_min")
       + ", " + r6("(hour_sin - avg(hour_sin) OVER ()) / stddev_pop(hour_sin) OVER ()", "hour_sin") + " FROM mat")
def _(spark, d):
    cols = ["session_duration_min", "hour_sin"]
    m = matrix(spark, d, cols)
    return apply_standard(m, fit_standard(m, cols), cols).select("login_id", *cols)


@query("sc_minmax", f"WITH {MATRIX} SELECT login_id, "
       + r6("(session_duration_min - min(session_duration_min) OVER ()) / (max(session_duration_min) OVER () - min(session_duration_min) OVER ())",
            "session_duration_min") + " FROM mat")
def _(spark, d):
    m = matrix(spark, d, ["session_duration_min"])
    return apply_minmax(m, fit_minmax(m, ["session_duration_min"]), ["session_duration_min"]).select("login_id", "session_duration_min")


# rounded scores: both engines must see the same ties at a threshold
SCORED = TAILS + """,
scored AS (SELECT login_id, round(ecod, 6) AS ecod, round(copod, 6) AS copod, _anomaly_type FROM tails JOIN mat USING (login_id))"""


def scored(spark, d):
    m = matrix(spark, d)
    t = tail_scores(m, FEATURES).select("login_id", F.round("ecod", 6).alias("ecod"), F.round("copod", 6).alias("copod"))
    return cut_lineage(t.join(m, "login_id"))


@query("od_label_threshold", f"WITH {SCORED} SELECT login_id, CAST(ecod > (SELECT quantile_cont(ecod, 0.95) FROM scored) AS BIGINT)"
       " AS is_flagged FROM scored")
def _(spark, d):
    return flag_quantile(scored(spark, d), "ecod", 0.95).select("login_id", "is_flagged")


@query("od_contamination_sweep", f"WITH {SCORED}, c(contamination) AS (VALUES (0.02), (0.05), (0.08), (0.1)),"
       " q AS (SELECT CAST(0.02 AS DOUBLE) AS contamination, quantile_cont(-ecod, 0.02) AS t FROM scored"
       " UNION ALL SELECT 0.05, quantile_cont(-ecod, 0.05) FROM scored UNION ALL SELECT 0.08, quantile_cont(-ecod, 0.08) FROM scored"
       " UNION ALL SELECT 0.1, quantile_cont(-ecod, 0.1) FROM scored)"
       f" SELECT {r6('contamination')}, count(*) FILTER (-ecod < t) AS flagged, count(*) AS total,"
       f" {r6('CAST(count(*) FILTER (-ecod < t) AS DOUBLE) / count(*)', 'share')} FROM scored, q GROUP BY contamination")
def _(spark, d):
    return en.contamination_sweep(scored(spark, d).withColumn("score", -F.col("ecod")), "score")


@query("od_feature_divergence", f"WITH {SCORED}, f AS (SELECT login_id, ecod > (SELECT quantile_cont(ecod, 0.95) FROM scored) AS fl FROM scored)"
       f" SELECT feature, {r6('avg(value) FILTER (fl)', 'flagged_mean')}, {r6('avg(value) FILTER (NOT fl)', 'normal_mean')},"
       f" {r6('stddev_samp(value)', 'std')}, {r6('coalesce(abs(avg(value) FILTER (fl) - avg(value) FILTER (NOT fl)) / nullif(stddev_samp(value), 0), 0)', 'divergence')}"
       " FROM long JOIN f USING (login_id) GROUP BY feature")
def _(spark, d):
    return en.feature_divergence(cut_lineage(flag_quantile(scored(spark, d), "ecod", 0.95)), FEATURES, "is_flagged")


@query("agg_detection_rate", f"WITH {SCORED}, f AS (SELECT _anomaly_type, CAST(ecod > (SELECT quantile_cont(ecod, 0.95) FROM scored) AS INT) AS ecod_label,"
       " CAST(copod > (SELECT quantile_cont(copod, 0.95) FROM scored) AS INT) AS copod_label FROM scored),"
       " l AS (SELECT _anomaly_type, 'ecod_label' AS method, ecod_label AS x FROM f UNION ALL SELECT _anomaly_type, 'copod_label', copod_label FROM f)"
       " SELECT _anomaly_type, count(*) AS total, method, CAST(sum(x) AS BIGINT) AS detected,"
       f" {r6('round(sum(x) * 100.0 / count(*), 1)', 'rate_pct')} FROM l GROUP BY _anomaly_type, method")
def _(spark, d):
    s = scored(spark, d)
    s = flag_quantiles(s, {"ecod": "ecod_label", "copod": "copod_label"}, 0.95)
    return agg.detection_rates(s, ["ecod_label", "copod_label"])


LAYERS = SCORED + """,
f AS (SELECT login_id, _anomaly_type, CAST(ecod > (SELECT quantile_cont(ecod, 0.95) FROM scored) AS BIGINT) AS is_anomaly,
  CAST(copod > (SELECT quantile_cont(copod, 0.95) FROM scored) AS BIGINT) AS per_user_anomaly FROM scored)"""


def layers(spark, d):
    s = scored(spark, d)
    flagged = cut_lineage(flag_quantiles(s, {"ecod": "is_anomaly", "copod": "per_user_anomaly"}, 0.95))
    a, b = flagged.select("login_id", "is_anomaly"), flagged.select("login_id", "per_user_anomaly")
    return jn.compare_layers(b, a, s.select("login_id", "_anomaly_type"))


@query("join_scores_3way", f"WITH {LAYERS} SELECT login_id, per_user_anomaly, is_anomaly, _anomaly_type FROM f")
def _(spark, d):
    return layers(spark, d)


@query("agg_disagreement", f"WITH {LAYERS} SELECT CASE WHEN per_user_anomaly = 1 AND is_anomaly = 1 THEN 'Both flag' WHEN per_user_anomaly = 1"
       " THEN 'Per-user only' WHEN is_anomaly = 1 THEN 'Global only' ELSE 'Both normal' END AS detection_category, _anomaly_type,"
       " count(*) AS n_rows FROM f GROUP BY ALL")
def _(spark, d):
    return agg.disagreement(layers(spark, d))


@query("join_label_backfill", f"WITH {SCORED} SELECT login_id, {r6('ecod')}, _anomaly_type FROM scored"
       .replace("mat AS (", "mat AS MATERIALIZED (").replace("cnt AS (", "cnt AS MATERIALIZED ("))
def _(spark, d):
    return jn.scores_with_label(tails(spark, d).select("login_id", "ecod"), signins(spark, d))


# --- neighbours and the four-detector ensemble, on the embedding table --------

_PAIRS = """
pairs AS (SELECT a.vec_id, b.vec_id AS nbr, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nbr) AS rank FROM pairs)"""
_LOF = """
n20 AS (SELECT * FROM near WHERE rank <= 20),
kd AS (SELECT vec_id AS nbr, max(dist) AS k_dist FROM n20 GROUP BY vec_id),
lrd AS (SELECT vec_id, 20 / (sum(greatest(dist, k_dist)) + 1e-10) AS lrd FROM n20 JOIN kd USING (nbr) GROUP BY vec_id),
lof AS (SELECT n.vec_id, avg(o.lrd) / any_value(m.lrd) AS lof FROM n20 n JOIN lrd o ON o.vec_id = n.nbr JOIN lrd m ON m.vec_id = n.vec_id
  GROUP BY n.vec_id),
knn AS (SELECT vec_id, avg(dist) AS knn FROM near WHERE rank <= 10 GROUP BY vec_id)"""


def embeddings(spark, d):
    return read_table(spark, d, "embeddings")


@query("od_knn", f"WITH {_PAIRS} SELECT vec_id, {r6('avg(dist)', 'knn')} FROM near WHERE rank <= 10 GROUP BY vec_id")
def _(spark, d):
    return nb.knn_score(embeddings(spark, d), "vec_id", "embedding", 10)


@query("od_knn_edges", f"WITH {_PAIRS} SELECT vec_id AS id, nbr, {r6('dist')}, rank FROM near WHERE rank <= 10")
def _(spark, d):
    return nb.knn_edges(embeddings(spark, d), "vec_id", "embedding", 10)


@query("od_lof", f"WITH {_PAIRS}, {_LOF} SELECT vec_id, {r6('lof')} FROM lof")
def _(spark, d):
    return nb.lof_score(embeddings(spark, d), "vec_id", "embedding", 20)


_FOUR = _PAIRS + "," + _LOF + """,
elong AS (SELECT vec_id, unnest(range(64)) AS feature, unnest(CAST(embedding AS DOUBLE[])) AS value FROM embeddings),""" + tails_sql(
    "elong", "vec_id") + """,
four AS (SELECT vec_id, round(ecod, 6) AS ecod, round(copod, 6) AS copod, round(knn, 6) AS knn, round(lof, 6) AS lof
  FROM tails JOIN knn USING (vec_id) JOIN lof USING (vec_id)),
labels4 AS (SELECT vec_id, """ + ", ".join(
    f"CAST({c} > (SELECT quantile_cont({c}, 0.95) FROM four) AS BIGINT) AS {c}_label" for c in ("ecod", "copod", "knn", "lof")) + " FROM four)"
DETECTORS = ["ecod", "copod", "knn", "lof"]


def four(spark, d):
    e = embeddings(spark, d)
    width = len(e.select("embedding").first()[0])
    dims = [f"d{i}" for i in range(width)]
    wide = cut_lineage(e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(dims)]))
    joined = tail_scores(wide, dims, "vec_id").join(nb.neighbour_scores(e, "vec_id", "embedding", 10, 20), "vec_id")
    return cut_lineage(joined.select("vec_id", *[F.round(c, 6).alias(c) for c in DETECTORS]))


def four_labels(spark, d):
    return cut_lineage(flag_quantiles(four(spark, d), {c: f"{c}_label" for c in DETECTORS}, 0.95))


@query("od_agreement_count", f"WITH {_FOUR} SELECT ecod_label + copod_label + knn_label + lof_label AS n_detectors_flagged,"
       " count(*) AS n_rows FROM labels4 GROUP BY 1")
def _(spark, d):
    return en.agreement(four_labels(spark, d), [f"{c}_label" for c in DETECTORS])


def _jaccard_sql():
    cells = [f"SELECT '{a}_label' AS detector_a, '{b}_label' AS detector_b, round(coalesce(CAST(sum({a}_label * {b}_label) AS DOUBLE)"
             f" / nullif(sum(greatest({a}_label, {b}_label)), 0), 0), 6) AS jaccard FROM labels4" for a in DETECTORS for b in DETECTORS]
    return f"WITH {_FOUR} " + " UNION ALL ".join(cells)


@query("od_jaccard_matrix", _jaccard_sql())
def _(spark, d):
    return en.jaccard_matrix(four_labels(spark, d), [f"{c}_label" for c in DETECTORS])


_MEAN = " + ".join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())" for c in DETECTORS)


@query("od_ensemble", f"WITH {_FOUR} SELECT vec_id, {r6(f'({_MEAN}) / 4', 'ensemble_score')} FROM four")
def _(spark, d):
    return en.ensemble(four(spark, d), DETECTORS).select("vec_id", "ensemble_score")


def with_forest(spark, d):
    """The four detector scores and the raw score of a forest fitted on the same vectors."""
    e = embeddings(spark, d)
    dims = [f"d{i}" for i in range(len(e.select("embedding").first()[0]))]
    wide = cut_lineage(e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(dims)]))
    scores = fo.iforest_score(wide, fo.iforest_fit(wide, dims, "vec_id"), dims, "vec_id")
    return cut_lineage(four(spark, d).join(scores, "vec_id"))


@query("od_ensemble_iforest")
def _(spark, d):
    return en.ensemble(with_forest(spark, d), DETECTORS, iforest="iforest").select("vec_id", "ensemble_score", "ensemble_with_iforest")


@query("od_ensemble_stats", f"WITH {_FOUR}, e AS (SELECT ({_MEAN}) / 4 AS s FROM four) SELECT {r6('avg(s)', 'mean')}, {r6('stddev_pop(s)', 'std')},"
       f" {r6('min(s)', 'min')}, {r6('max(s)', 'max')} FROM e")
def _(spark, d):
    return en.score_statistics(en.ensemble(four(spark, d), DETECTORS), "ensemble_score")


# --- composite and evaluation, on the rule scores and the tail scores ---------

_MM = "(({0}) - min({0}) OVER ()) / (max({0}) OVER () - min({0}) OVER ())"
COMPOSITE = SCORED + f""",
layer AS (SELECT login_id, {_MM.format('copod')} AS a, {_MM.format('ecod')} AS b, {_MM.format('session_duration_zscore')} AS c,
  _anomaly_type FROM scored JOIN (SELECT login_id, session_duration_zscore FROM mat) USING (login_id)),
wsum AS (SELECT *, CAST(0.35 AS DOUBLE) * a + CAST(0.3 AS DOUBLE) * b + CAST(0.35 AS DOUBLE) * c AS raw FROM layer),
comp AS (SELECT login_id, _anomaly_type, round({_MM.format('raw')}, 6) AS risk_score FROM wsum)"""
_TIER = "CASE WHEN risk_score >= 0.8 THEN 'Critical' WHEN risk_score >= 0.6 THEN 'High' WHEN risk_score >= 0.3 THEN 'Medium' ELSE 'Low' END"


def composite(spark, d):
    """Composite of three given score columns (two tail scores and the session z)."""
    s = scored(spark, d).select("login_id", "_anomaly_type", (-F.col("copod")).alias("iforest"), "ecod",
                                (-F.col("session_duration_zscore")).alias("per_user"))
    out = en.composite_risk(s).withColumn("risk_score", F.round("risk_score", 6))
    return out.select("login_id", "_anomaly_type", "risk_score", "risk_tier", "is_anomaly")


@query("od_composite", f"WITH {COMPOSITE} SELECT login_id, {r6('risk_score')}, {_TIER} AS risk_tier,"
       " CAST(risk_score >= 0.6 AS BIGINT) AS is_anomaly FROM comp")
def _(spark, d):
    return composite(spark, d).select("login_id", "risk_score", "risk_tier", "is_anomaly")


SWEEP = COMPOSITE + """,
grid AS (SELECT CAST(i AS DOUBLE) / 20 AS threshold FROM range(21) t(i)),
tf AS (SELECT threshold, count(*) FILTER (risk_score >= threshold AND _anomaly_type <> 'normal') AS tp,
  count(*) FILTER (risk_score >= threshold AND _anomaly_type = 'normal') AS fp,
  count(*) FILTER (_anomaly_type <> 'normal') AS p FROM grid, comp GROUP BY threshold),
pr AS (SELECT threshold, tp, fp, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(p, 0), 0) AS recall FROM tf),
sweep AS (SELECT threshold, precision, recall, CAST(tp + fp AS DOUBLE) / 30 AS alerts_per_day, tp AS true_positives, fp AS false_positives,
  coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr)"""
_SWEEP_COLS = (f"{r6('threshold')}, {r6('precision')}, {r6('recall')}, {r6('alerts_per_day')}, true_positives, false_positives, {r6('f1')}")


def sweep(spark, d):
    truth = composite(spark, d).withColumn("truth", F.when(F.col("_anomaly_type") != "normal", 1).otherwise(0))
    return evl.threshold_sweep(truth, "risk_score", "truth", 30)


@query("ev_threshold_sweep", f"WITH {SWEEP} SELECT {_SWEEP_COLS} FROM sweep")
def _(spark, d):
    return sweep(spark, d)


@query("ev_best_threshold", f"WITH {SWEEP} SELECT * FROM (SELECT {_SWEEP_COLS}, 'max_f1' AS criterion FROM sweep ORDER BY sweep.f1 DESC, sweep.threshold LIMIT 1)"
       f" UNION ALL SELECT * FROM (SELECT {_SWEEP_COLS}, 'capacity' AS criterion FROM sweep ORDER BY sweep.alerts_per_day <= 20 DESC,"
       " CASE WHEN sweep.alerts_per_day <= 20 THEN sweep.threshold ELSE -sweep.threshold END LIMIT 1)")
def _(spark, d):
    return evl.best_threshold(cut_lineage(sweep(spark, d)), 20)


@query("ev_feedback_join", f"WITH {SIGNINS}, fb AS (SELECT login_id, _anomaly_type <> 'normal' AS verdict FROM signins WHERE failed_attempts_before > 0)"
       " SELECT s.login_id, verdict FROM signins s LEFT JOIN fb ON fb.login_id = s.login_id")
def _(spark, d):
    s = signins(spark, d)
    feedback = s.filter("failed_attempts_before > 0").select(
        "login_id", F.lit("analyst").alias("analyst_id"), F.explode(F.array(F.col("ts"), F.col("ts") + F.expr("INTERVAL 1 DAY"))).alias("review_timestamp"),
        "_anomaly_type", "ts").withColumn(
        "is_true_positive", F.when(F.col("review_timestamp") > F.col("ts"), F.col("_anomaly_type") != "normal").otherwise(F.lit(False)))
    return evl.feedback_labels(s.select("login_id"), feedback)


# --- timeline -----------------------------------------------------------------

_METRICS = ["total_logins", "distinct_ips", "avg_failed_attempts_before", "failure_rate"]


def timeline_sql(seg: str = "") -> str:
    key, part, join = (f"{seg}, ", f"PARTITION BY {seg} ", f" AND m.{seg} = g.{seg}") if seg else ("", "", "")
    slot = "epoch_s % 86400 // 300"
    med = ", ".join(f"round(CAST({m} AS DOUBLE) - quantile_cont(CAST({m} AS DOUBLE), 0.5) OVER (PARTITION BY {key}{slot}), 6) AS {m}_resid" for m in _METRICS)
    z = ", ".join(
        f"CASE WHEN count({m}_resid) OVER w >= 288 AND stddev_samp({m}_resid) OVER w > 1e-9 THEN round(({m}_resid - avg({m}_resid) OVER w)"
        f" / stddev_samp({m}_resid) OVER w, 6) ELSE 0 END + 0.0 AS {m}_z" for m in _METRICS)
    top = " ".join(f"WHEN abs({m}_z) = anomaly_score THEN '{m}'" for m in _METRICS)
    return SIGNINS + f""",
buck AS (SELECT {key}epoch_s // 300 * 300 AS b, count(*) AS total_logins, count(DISTINCT user_id) AS distinct_users,
  count(DISTINCT ip_address) AS distinct_ips, avg(failed_attempts_before) AS avg_failed_attempts_before,
  avg(CASE WHEN failed_attempts_before > 0 THEN 1 ELSE 0 END) AS failure_rate FROM signins GROUP BY ALL),
spans AS (SELECT {key}min(b) AS lo, max(b) AS hi FROM buck {'GROUP BY ' + seg if seg else ''}),
grid0 AS (SELECT {key}unnest(range(lo, hi + 1, 300)) AS epoch_s FROM spans),
grid AS (SELECT g.*, coalesce(total_logins, 0) AS total_logins, coalesce(distinct_users, 0) AS distinct_users,
  coalesce(distinct_ips, 0) AS distinct_ips, coalesce(avg_failed_attempts_before, 0) AS avg_failed_attempts_before,
  coalesce(failure_rate, 0) AS failure_rate FROM grid0 g LEFT JOIN buck m ON m.b = g.epoch_s{join}),
resid AS (SELECT *, {med} FROM grid),
zs AS (SELECT *, {z} FROM resid WINDOW w AS ({part}ORDER BY epoch_s ROWS BETWEEN 863 PRECEDING AND CURRENT ROW)),
mx AS (SELECT *, greatest({', '.join(f'abs({m}_z)' for m in _METRICS)}) AS anomaly_score FROM zs),
buckets AS (SELECT *, make_timestamp(epoch_s * 1000000) AS bucket_ts, CASE {top} END AS top_signal, CASE WHEN anomaly_score < 3 THEN 'low'
  WHEN anomaly_score < 5 THEN 'medium' WHEN anomaly_score < 8 THEN 'high' ELSE 'critical' END AS tier FROM mx)"""


TIMELINE = timeline_sql()
_Z = ", ".join(r6(f"{m}_z") for m in _METRICS)


def buckets(spark, d, segment=None):
    return cut_lineage(tl.scored_timeline(signins(spark, d), segment=segment, digits=6))


@query("join_time_grid", f"WITH {TIMELINE} SELECT bucket_ts, total_logins, distinct_users, distinct_ips, {r6('avg_failed_attempts_before')},"
       f" {r6('failure_rate')} FROM buckets")
def _(spark, d):
    return tl.timeline(signins(spark, d)).select(
        "bucket_ts", "total_logins", "distinct_users", "distinct_ips", "avg_failed_attempts_before", "failure_rate")


@query("ts_seasonal_median", f"WITH {TIMELINE} SELECT bucket_ts, {', '.join(r6(f'{m}_resid') for m in _METRICS)} FROM buckets")
def _(spark, d):
    return tl.slot_residual(tl.timeline(signins(spark, d)), tl.SCORED_METRICS).select(
        "bucket_ts", *[f"{m}_resid" for m in tl.SCORED_METRICS])


@query("win_rolling_zscore", f"WITH {TIMELINE} SELECT bucket_ts, {_Z} FROM buckets")
def _(spark, d):
    return buckets(spark, d).select("bucket_ts", *[f"{m}_z" for m in tl.SCORED_METRICS])


@query("ts_max_z", f"WITH {TIMELINE} SELECT bucket_ts, {r6('anomaly_score')}, top_signal, tier FROM buckets")
def _(spark, d):
    return buckets(spark, d).select("bucket_ts", "anomaly_score", "top_signal", "tier")


@query("ts_segment_baseline", f"WITH {timeline_sql('location_name')} SELECT location_name, bucket_ts, {r6('anomaly_score')}, top_signal, tier FROM buckets")
def _(spark, d):
    return buckets(spark, d, "location_name").select("location_name", "bucket_ts", "anomaly_score", "top_signal", "tier")


@query("join_bucket_labels", f"WITH {TIMELINE} SELECT bucket_ts, {r6('anomaly_score')}, tier FROM buckets WHERE epoch_s IN"
       " (SELECT epoch_s // 300 * 300 FROM signins WHERE _anomaly_type = 'brute_force')")
def _(spark, d):
    return jn.attack_buckets(buckets(spark, d), signins(spark, d)).select("bucket_ts", "anomaly_score", "tier")


@query("join_event_in_bucket", f"WITH {TIMELINE} SELECT s.bucket_ts, s.tier, {r6('s.anomaly_score', 'anomaly_score')}, s.top_signal, count(*) AS n_events,"
       " count(DISTINCT b.user_id) AS n_users, count(DISTINCT b.ip_address) AS n_ips,"
       f" {r6('round(avg(b.failed_attempts_before), 1)', 'avg_failed')},"
       " string_agg(DISTINCT b._anomaly_type, '|' ORDER BY b._anomaly_type) AS anomaly_types_in_bucket"
       " FROM buckets s JOIN signins b ON b.ts >= s.bucket_ts AND b.ts < s.bucket_ts + INTERVAL 5 MINUTES"
       " WHERE s.tier IN ('high', 'critical') GROUP BY s.bucket_ts, s.tier, s.anomaly_score, s.top_signal"
       " ORDER BY s.anomaly_score DESC, s.bucket_ts LIMIT 20")
def _(spark, d):
    return jn.triage(buckets(spark, d), signins(spark, d))


@query("srt_context_slice", f"WITH {TIMELINE}, peak AS (SELECT epoch_s AS p FROM buckets ORDER BY anomaly_score DESC, epoch_s LIMIT 1)"
       f" SELECT bucket_ts, {r6('anomaly_score')} FROM buckets, peak WHERE abs(epoch_s - p) <= 43200")
def _(spark, d):
    return seq.around_peak(buckets(spark, d)).select("bucket_ts", "anomaly_score")


@query("ts_event_vs_bucket", f"WITH {EVENTS.replace(SIGNINS, TIMELINE, 1)}, ev_s AS (SELECT count(*) AS n, avg(risk_score) AS mean_score,"
       " avg(CASE WHEN risk_tier IN ('Critical', 'High') THEN 1.0 ELSE 0 END) AS flagged_share FROM signin_scores JOIN signins ON login_id = event_id"
       " WHERE _anomaly_type = 'brute_force'),"
       " bk AS (SELECT count(*) AS n, avg(anomaly_score) AS mean_score, avg(CASE WHEN tier IN ('high', 'critical') THEN 1.0 ELSE 0 END) AS flagged_share"
       " FROM buckets WHERE epoch_s IN (SELECT epoch_s // 300 * 300 FROM signins WHERE _anomaly_type = 'brute_force'))"
       f" SELECT n, {r6('mean_score')}, {r6('flagged_share')}, 'event' AS lens FROM ev_s UNION ALL"
       f" SELECT n, {r6('mean_score')}, {r6('flagged_share')}, 'bucket' AS lens FROM bk")
def _(spark, d):
    s = signins(spark, d)
    scores = ev.signin_scores(ad.signin_events(spark, d)).select(
        F.col("event_id").alias("login_id"), F.col("risk_score").alias("score"),
        F.when(F.col("risk_tier").isin("Critical", "High"), 1).otherwise(0).alias("is_anomaly"))
    return jn.lens_compare(jn.scores_with_label(scores, s), jn.attack_buckets(buckets(spark, d), s))


@query("ts_alert_union", f"WITH {EVENTS.replace(SIGNINS, TIMELINE, 1)} SELECT event_id AS login_id FROM signin_scores WHERE risk_tier IN ('Critical', 'High')"
       " UNION SELECT login_id FROM signins WHERE epoch_s // 300 * 300 IN (SELECT epoch_s FROM buckets WHERE tier IN ('high', 'critical'))")
def _(spark, d):
    scores = ev.signin_scores(ad.signin_events(spark, d)).select(
        F.col("event_id").alias("login_id"), F.col("timestamp").alias("ts"), "risk_tier")
    return jn.alert_union(scores, buckets(spark, d))
