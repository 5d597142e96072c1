"""Queries that fit models: forests, explanations, decomposition, the full composite."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.catalog.registry import query
from tarn.catalog.signin import matrix, signins
from tarn.operators import aggregates as agg
from tarn.operators import ensemble as en
from tarn.operators import forest as fo
from tarn.operators import joins as jn
from tarn.operators.tails import ecod_score
from tarn.plans import timeline as tl
from tarn.plans.signins import MODEL_FEATURES
from tarn.session import cut_lineage


def global_scores(m):
    nodes = fo.iforest_fit(m, MODEL_FEATURES)
    return nodes, cut_lineage(fo.iforest_score(m, nodes, MODEL_FEATURES))


def per_user(m):
    return cut_lineage(fo.per_user_scores(m, MODEL_FEATURES))


@query("od_iforest_fit")
def _(spark, d):
    nodes = fo.iforest_fit(matrix(spark, d), MODEL_FEATURES)
    return nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n_nodes"), F.max("depth").alias("depth"), F.max("size").alias("n_rows"))


@query("od_iforest_score")
def _(spark, d):
    _, scored = global_scores(matrix(spark, d))
    return fo.iforest_decision(scored)


@query("od_per_user_forest")
def _(spark, d):
    return per_user(matrix(spark, d))


def explained(m):
    return cut_lineage(fo.per_user_explain(m, None, MODEL_FEATURES, 3))


@query("od_explain_topk")
def _(spark, d):
    m = matrix(spark, d)
    nodes, scored = global_scores(m)
    flagged = fo.iforest_decision(scored).filter("is_anomaly = 1").select("login_id", "iforest", "decision")
    tops = fo.explain(m.join(flagged.select("login_id"), "login_id", "left_semi"), nodes, MODEL_FEATURES, 3)
    return flagged.join(tops, "login_id")


@query("agg_explain_drivers")
def _(spark, d):
    return agg.top_drivers(explained(matrix(spark, d)))


@query("join_explained_context")
def _(spark, d):
    context = signins(spark, d).select("login_id", "ts", "location_name", "device", "_anomaly_type")
    return jn.explained_top(explained(matrix(spark, d)), context)


@query("od_composite_full")
def _(spark, d):
    """All three layers, the composite and the two strongest features of every flagged row."""
    m = matrix(spark, d)
    nodes, scored = global_scores(m)
    layers = scored.join(ecod_score(m, MODEL_FEATURES), "login_id").join(
        per_user(m).select("login_id", F.col("per_user_score").alias("per_user")), "login_id")
    risk = cut_lineage(en.composite_risk(cut_lineage(layers)))
    flagged = m.join(risk.filter("is_anomaly = 1").select("login_id"), "login_id", "left_semi")
    tops = fo.explain(flagged, nodes, MODEL_FEATURES, 2).drop("attribution_sum", "base")
    return risk.join(tops, "login_id", "left")


@query("ts_stl_residual")
def _(spark, d):
    from tarn.operators.seasonal import stl_residual

    grid = tl.timeline(signins(spark, d))
    return stl_residual(grid, tl.SCORED_METRICS, tl.PERIOD).select("bucket_ts", *[f"{m}_resid" for m in tl.SCORED_METRICS])


@query("ts_stl_scores")
def _(spark, d):
    return tl.scored_timeline(signins(spark, d), residual="stl").select("bucket_ts", "anomaly_score", "top_signal", "tier")
