"""Robust seasonal-trend decomposition of bucket series (Cleveland et al. 1990)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.sequences import series_key, with_row_index
from tarn.session import cut_lineage, spread

FLAT = 1e-9
PIECE_PERIODS = 56
HALO_PERIODS = 28
OUTER = 15
MEDIAN_ACCURACY = 100_000


def _odd(v: float) -> int:
    n = int(np.ceil(v))
    return n if n % 2 else n + 1


def _fit(y: np.ndarray, rho: np.ndarray, q: int, at: float) -> np.ndarray:
    """Local line through the q points nearest to ``at``, evaluated there; columns are independent series."""
    m = len(y)
    width = min(q, m)
    lo = int(np.clip(round(at) - width // 2, 0, m - width))
    idx = np.arange(lo, lo + width)
    d = idx - at
    h = max(abs(d[0]), abs(d[-1]), 1.0) + (q - m) / 2 * (q > m)
    w = (np.clip(1 - (np.abs(d) / (h * 1.001)) ** 3, 0, None) ** 3)[:, None] * rho[idx]
    s0, s1, s2 = w.sum(0), (w * d[:, None]).sum(0), (w * d[:, None] ** 2).sum(0)
    t0, t1 = (w * y[idx]).sum(0), (w * d[:, None] * y[idx]).sum(0)
    det = s0 * s2 - s1 ** 2
    line = np.where(det > 1e-12, (s2 * t0 - s1 * t1) / np.where(det > 1e-12, det, 1), t0 / np.where(s0 > 0, s0, 1))
    return np.where(s0 > 0, line, y[idx].mean(0))


def loess(y: np.ndarray, rho: np.ndarray, q: int) -> np.ndarray:
    """LOESS of one long series: convolutions inside, explicit fits near both ends."""
    m = len(y)
    half = q // 2
    if m <= q:
        return np.array([_fit(y[:, None], rho[:, None], q, i)[0] for i in range(m)])
    d = np.arange(-half, half + 1)
    w = np.clip(1 - (np.abs(d) / (half * 1.001)) ** 3, 0, None) ** 3

    def conv(kernel, v):
        return np.convolve(v, kernel[::-1], mode="valid")

    ry = rho * y
    s0, s1, s2 = conv(w, rho), conv(w * d, rho), conv(w * d * d, rho)
    t0, t1 = conv(w, ry), conv(w * d, ry)
    det = s0 * s2 - s1 ** 2
    out = np.empty(m)
    out[half:m - half] = np.where(det > 1e-12, (s2 * t0 - s1 * t1) / np.where(det > 1e-12, det, 1),
                                  t0 / np.where(s0 > 0, s0, 1))
    out[:half] = _end_fits(y[:q], rho[:q], half)
    out[m - half:] = _end_fits(y[m - q:][::-1], rho[m - q:][::-1], half)[::-1]
    return out


def _end_fits(y: np.ndarray, rho: np.ndarray, count: int) -> np.ndarray:
    """Local lines at the first ``count`` points, all through the same window that starts at the end of the series."""
    d = np.arange(len(y))[None, :] - np.arange(count)[:, None]
    h = np.abs(d).max(axis=1, keepdims=True) * 1.001
    w = np.clip(1 - (np.abs(d) / h) ** 3, 0, None) ** 3
    s0, s1, s2 = w @ rho, (w * d) @ rho, (w * d * d) @ rho
    t0, t1 = w @ (rho * y), (w * d) @ (rho * y)
    det = s0 * s2 - s1 ** 2
    return np.where(det > 1e-12, (s2 * t0 - s1 * t1) / np.where(det > 1e-12, det, 1), t0 / np.where(s0 > 0, s0, 1))


def _moving_mean(v: np.ndarray, n: int) -> np.ndarray:
    return np.convolve(v, np.ones(n) / n, mode="valid")


def _decompose(y: np.ndarray, rho: np.ndarray, trend: np.ndarray, period: int, seasonal: int = 7,
               inner: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(season, trend) after the inner loop, from given weights and the trend before."""
    n = len(y)
    trend_q = _odd(1.5 * period / (1 - 1.5 / seasonal))
    low_q = _odd(period + 1)
    cycles = -(-n // period)
    pad = cycles * period - n
    season = np.zeros(n)
    for _ in range(inner):
        detrended = np.r_[y - trend, np.zeros(pad)].reshape(cycles, period)
        weight = np.r_[rho, np.zeros(pad)].reshape(cycles, period)
        smooth = np.stack([_fit(detrended, weight, seasonal, i) for i in range(-1, cycles + 1)])
        flat = smooth.ravel()[:n + 2 * period]
        low = _moving_mean(_moving_mean(_moving_mean(flat, period), period), 3)
        low = loess(low, np.ones(len(low)), low_q)
        season = flat[period:period + n] - low[:n]
        trend = loess(y - season, rho, trend_q)
    return season, trend


def _weights(resid: np.ndarray, scale: float) -> np.ndarray:
    u = np.abs(resid) / scale
    return np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - u ** 2) ** 2, 0.0))


def stl(y: np.ndarray, period: int, seasonal: int = 7, inner: int = 2, outer: int = OUTER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seasonal, trend, residual) with robustness weights."""
    rho, trend = np.ones(len(y)), np.zeros(len(y))
    for _ in range(outer + 1):
        season, trend = _decompose(y, rho, trend, period, seasonal, inner)
        resid = y - season - trend
        scale = 6 * np.median(np.abs(resid))
        if scale <= FLAT:
            break
        rho = _weights(resid, scale)
    return season, trend, y - season - trend


def residual(y: np.ndarray, period: int) -> np.ndarray:
    """Zero for a flat series or one shorter than two periods."""
    if len(y) < 2 * period or np.std(y, ddof=1) < FLAT:
        return np.zeros(len(y))
    return stl(y.astype(float), period)[2]


def in_pieces(rows: DataFrame, core: int, halo: int) -> DataFrame:
    """``rows`` (with ``_series`` and ``_i``) once for each piece of the series they belong to: ``_piece``, ``_own`` (false in a halo) and
    ``_pieces``, the number of pieces of the series.

    A piece is ``core`` places and ``halo`` further ones on both sides; the last one also takes what is left over, so
    that it has at most twice as many, and a series shorter than that is one piece.
    """
    if halo > core:
        raise ValueError("the halo must not be longer than the piece")
    sizes = rows.groupBy("_series").agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / core)).alias("_pieces"))
    home = F.least(F.floor(F.col("_i") / core), F.col("_pieces") - 1)
    homed = rows.join(sizes, "_series").withColumn("_home", home)
    left = F.when((F.col("_home") > 0) & (F.col("_i") < F.col("_home") * core + halo), F.col("_home") - 1)
    right = F.when((F.col("_home") < F.col("_pieces") - 1) & (F.col("_i") >= (F.col("_home") + 1) * core - halo), F.col("_home") + 1)
    sent = homed.withColumn("_piece", F.explode(F.array_compact(F.array(F.col("_home"), left, right))))
    return sent.withColumn("_own", F.col("_piece") == F.col("_home")).drop("_home")


def _long_residual(pieces: DataFrame, keys: list[str], period: int) -> DataFrame:
    """The rows of ``pieces`` (several per series and metric) that are no halo, with the residual as ``value``.

    All pieces take the same robustness rounds together: after each one the median residual of the whole series is taken by
    Spark and goes back to its pieces, which keep weights and trend between rounds.
    """
    series = ["_series", "metric"]
    groups = [*series, "_piece"]
    spreads = pieces.filter("_own").groupBy(*series).agg((F.coalesce(F.stddev_samp("value"), F.lit(0.0)) < FLAT).alias("_flat"))
    none = F.lit(None).cast("double")
    state = pieces.withColumns({"_trend": F.lit(0.0), "_resid": F.lit(0.0), "_scale": none})

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket_ts")
        scale = pdf["_scale"].iloc[0]
        first = pd.isna(scale)
        if not first and scale <= FLAT:
            return pdf
        y, trend, resid = (pdf[c].to_numpy(dtype=float) for c in ("value", "_trend", "_resid"))
        season, trend = _decompose(y, np.ones(len(y)) if first else _weights(resid, scale), trend, period)
        return pdf.assign(_trend=trend, _resid=y - season - trend)

    for _ in range(OUTER + 1):
        state = cut_lineage(spread(state, *groups).groupBy(*groups).applyInPandas(step, state.schema))
        middle = F.percentile_approx(F.abs("_resid"), F.lit(0.5), F.lit(MEDIAN_ACCURACY))
        scales = state.filter("_own").groupBy(*series).agg((6 * middle).alias("_s"))
        state = state.join(scales, series).withColumn("_scale", F.col("_s")).drop("_s")
    done = state.filter("_own").join(spreads, series)
    return done.select(*keys, "bucket_ts", "metric", F.when(F.col("_flat"), 0.0).otherwise(F.col("_resid")).alias("value"))


def stl_residual(grid: DataFrame, columns: Sequence[str], period: int, segment: str | None = None,
                 piece: int = PIECE_PERIODS, halo: int = HALO_PERIODS) -> DataFrame:
    """``<column>_resid`` for every metric; (segment, metric, piece) groups run in parallel.

    A series shorter than 2 x ``piece`` periods is decomposed whole, in one task. A longer one is cut into pieces that see ``halo`` more
    periods on both sides, whole periods each, so that the season keeps its phase. Its robustness weights compare a residual with
    the median of the whole series. What is left of a cut fades with the halo: from 14 periods on, the result is that of
    the whole series within a hundredth of the residuals' standard deviation.
    """
    keys = [segment] if segment else []
    rows = with_row_index(grid.select(*keys, "bucket_ts", *[F.col(c).cast("double").alias(c) for c in columns]), "bucket_ts", keys)
    rows = rows.withColumn("_series", F.to_json(series_key(keys), {"ignoreNullFields": "false"}))
    pieces = cut_lineage(in_pieces(rows, piece * period, halo * period).drop("_i").unpivot(
        [*keys, "bucket_ts", "_series", "_pieces", "_piece", "_own"], list(columns), "metric", "value"))
    whole = pieces.filter("_pieces = 1").select(*keys, "bucket_ts", "_series", "metric", "value")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket_ts")
        return pdf.assign(value=residual(pdf["value"].to_numpy(), period))

    done = spread(whole, "_series", "metric").groupBy("_series", "metric").applyInPandas(run, whole.schema).drop("_series")
    long = pieces.filter("_pieces > 1").drop("_pieces")
    if long.limit(1).count():
        done = done.unionByName(_long_residual(long, keys, period))
    wide = done.groupBy(*keys, "bucket_ts").agg(
        *[F.max(F.when(F.col("metric") == c, F.col("value"))).alias(f"{c}_resid") for c in columns])
    if not segment:
        return grid.join(wide, "bucket_ts")
    wide = wide.withColumnsRenamed({segment: "_segment", "bucket_ts": "_bucket"})
    return grid.join(wide, grid[segment].eqNullSafe(F.col("_segment")) & (grid["bucket_ts"] == F.col("_bucket"))).drop("_segment", "_bucket")
