"""Forecasts 2 and 3: exponential smoothing of the deseasonalised series.

Spark nests each key's series (bounded by the calendar) and hands Arrow
batches of keys to one numpy function, which advances all keys of a batch
through time together.  There is no per-key Python call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from stockloom.plans.forecast.chunks import length_chunks
from stockloom.functions import output_transform
from stockloom.operators.joins import update_from
from stockloom.spec import SeriesSpec

# The ratio and the width at which the search stops.
GOLDEN = 1.618033988
TOLERANCE = 0.01


def _minimise(cost: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Golden-section search on [0, 1] for ``n`` independent problems at once."""
    left, right = np.zeros(n), np.ones(n)
    mid = (right + GOLDEN * left) / (GOLDEN + 1)
    mid_cost = cost(mid)
    while True:
        open_ = right - left >= TOLERANCE
        if not open_.any():
            return (left + right) / 2
        probe = left + (right - mid)
        probe_cost = cost(probe)
        better = probe_cost < mid_cost
        above = probe > mid
        low, high = np.minimum(mid, probe), np.maximum(mid, probe)
        # The better inner point becomes the middle; the bracket ends at the
        # other inner point on its far side.
        go_up = better == above
        new_left, new_right = np.where(go_up, low, left), np.where(go_up, right, high)
        new_mid = np.where(better, probe, mid)
        left = np.where(open_, new_left, left)
        right = np.where(open_, new_right, right)
        mid_cost = np.where(open_ & better, probe_cost, mid_cost)
        mid = np.where(open_, new_mid, mid)


def _levels(x: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Smoothed level over time; axis 0 is time, axis 1 the problems."""
    out = np.empty_like(x)
    out[0] = x[0]
    keep = 1.0 - alpha
    for t in range(1, len(x)):
        out[t] = alpha * x[t] + keep * out[t - 1]
    return out


def _best_alphas(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Alpha with the least squared one-step error over steps lo..hi."""
    steps = np.arange(1, len(x))[:, None]
    counted = (steps >= lo) & (steps <= hi)

    def cost(alpha: np.ndarray) -> np.ndarray:
        miss = x[1:] - _levels(x, alpha)[:-1]
        return np.where(counted, miss * miss, 0.0).sum(axis=0)

    return _minimise(cost, x.shape[1])


def smooth_batch(series: list[np.ndarray], short: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Levels and alphas for a batch of keys, padded to the longest series.

    A level is taken from an alpha fitted on *another* stretch of the series:
    halves swap for the long-term level, quarters shift by one for the
    short-term level; the last point uses the full fit and the last quarter's.
    """
    n = np.array([len(s) for s in series])
    steps = int(n.max())
    keys = len(series)

    def padded(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((steps, keys))
        for k, row in enumerate(rows):
            out[: len(row), k] = row
        return out

    x, y = padded(series), padded(short)
    last = n - 1
    half, quarter = n // 2, n // 4
    q2, q3 = 2 * quarter, 3 * quarter
    zero = np.zeros_like(n)
    ranges = [
        (zero, last), (zero, half), (half + 1, last),
        (zero, quarter), (quarter + 1, q2), (q2 + 1, q3), (q3 + 1, last),
    ]
    stacked = np.concatenate([x, x, x, y, y, y, y], axis=1)
    lo = np.concatenate([r[0] for r in ranges])
    hi = np.concatenate([r[1] for r in ranges])
    alphas = _best_alphas(stacked, lo, hi).reshape(7, keys)
    levels = _levels(stacked, alphas.reshape(-1)).reshape(steps, 7, keys)
    every, of_h1, of_h2, of_q1, of_q2, of_q3, of_q4 = range(7)
    t = np.arange(steps)[:, None]

    def pick(default: int, rules: list[tuple[np.ndarray, int]]) -> np.ndarray:
        chosen = levels[:, default, :].copy()
        for where, source in rules:
            chosen = np.where(where, levels[:, source, :], chosen)
        chosen[0] = np.nan
        return chosen

    long_level = pick(
        of_h2,
        [((t > half) & (t < last), of_h1), (t == last, every)],
    )
    short_level = pick(
        of_q4,
        [
            ((t > quarter) & (t <= q2), of_q1),
            ((t > q2) & (t <= q3), of_q2),
            ((t > q3) & (t < last), of_q3),
        ],
    )
    return {"n": n, "long": long_level, "short": short_level, "alphas": alphas}


ALPHAS = ("alpha", "alpha_h1", "alpha_h2", "alpha_q1", "alpha_q2", "alpha_q3", "alpha_q4")
_NESTED = (
    "agg_level string, dts array<date>, long array<double>, short array<double>, "
    + ", ".join(f"{a} double" for a in ALPHAS)
)


# Five arrays of seven fits each per key and step.
STEP_BYTES = 8 * 7 * 5


def _fit_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def listed(levels: np.ndarray, n: np.ndarray) -> list[list[float | None]]:
        return [[None, *levels[1:length, k].tolist()] for k, length in enumerate(n)]

    chunks = (c for pdf in batches for c in length_chunks(pdf, "x", STEP_BYTES))
    for pdf in chunks:
        fit = smooth_batch(
            [np.asarray(v, dtype=float) for v in pdf["x"]],
            [np.asarray(v, dtype=float) for v in pdf["y"]],
        )
        out = pd.DataFrame({"agg_level": pdf["agg_level"], "dts": pdf["dts"]})
        out["long"] = listed(fit["long"], fit["n"])
        out["short"] = listed(fit["short"], fit["n"])
        for name, values in zip(ALPHAS, fit["alphas"], strict=True):
            out[name] = values
        yield out


def exp_smooth_fit(deseason: DataFrame) -> DataFrame:
    """Fitted levels per key and date, with the alphas behind them.

    Columns: agg_level, dt, fcst_deseasonalized_qty,
    st_fcst_deseasonalized_qty, alpha...  The first date of a key has no level.
    """
    entry = F.struct(
        "dt",
        F.col("deseasonalized_adj_qty").alias("x"),
        F.col("st_deseasonalized_adj_qty").alias("y"),
    )
    nested = (
        deseason.filter("fcst_crt_dt_flg")
        .groupBy("agg_level")
        .agg(F.array_sort(F.collect_list(entry)).alias("s"))
        .select("agg_level", F.col("s.dt").alias("dts"), F.col("s.x").alias("x"), F.col("s.y").alias("y"))
    )
    fitted = nested.mapInPandas(_fit_batches, _NESTED)
    rows = F.explode(F.arrays_zip("dts", "long", "short")).alias("r")
    return fitted.select("agg_level", rows, *ALPHAS).select(
        "agg_level",
        F.col("r.dts").alias("dt"),
        F.col("r.long").alias("fcst_deseasonalized_qty"),
        F.col("r.short").alias("st_fcst_deseasonalized_qty"),
        *ALPHAS,
    )


def forecast23(deseason: DataFrame, levels: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Level at a date plus the season of each of the next dates.

    Columns: agg_level, fcst_crt_dt, fcst_dt, lag, qty, fcst_qty, st_fcst_qty.
    A series has no gaps, so the seasons ahead are its following rows.
    """
    in_order = Window.partitionBy("agg_level").orderBy("dt")

    def ahead(step: int):
        def following(c: str):
            return F.lead(c, step).over(in_order)

        return F.struct(
            following("dt").alias("fcst_dt"),
            F.lit(step).alias("lag"),
            following("qty").alias("qty"),
            following("smoothed_seasonal_qty").alias("long_season"),
            following("seasonal_qty").alias("short_season"),
        )

    steps = [ahead(step) for step in range(1, spec.horizon + 1)]
    created = (
        deseason.withColumn("_ahead", F.array(*steps))
        .filter("fcst_crt_dt_flg")
        .select("agg_level", "dt", "next_dt", F.explode("_ahead").alias("a"))
        .filter(F.col("a.fcst_dt").isNotNull())
    )
    fitted = levels.select(
        "agg_level", "dt", "fcst_deseasonalized_qty", "st_fcst_deseasonalized_qty"
    )
    return created.join(fitted, ["agg_level", "dt"]).select(
        "agg_level",
        F.col("next_dt").alias("fcst_crt_dt"),
        F.col("a.fcst_dt").alias("fcst_dt"),
        F.col("a.lag").alias("lag"),
        F.col("a.qty").alias("qty"),
        (F.col("fcst_deseasonalized_qty") + F.col("a.long_season")).alias("fcst_qty"),
        (F.col("st_fcst_deseasonalized_qty") + F.col("a.short_season")).alias("st_fcst_qty"),
    )


def apply_forecast23(fact: DataFrame, forecasts: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The fact with forecasts 2 and 3 set; unmatched rows keep theirs."""
    source = forecasts.select(
        F.col("fcst_crt_dt").alias("snpsht"),
        F.col("fcst_dt").alias("fcst"),
        "agg_level",
        "fcst_qty",
        "st_fcst_qty",
    )

    def value(c: str):
        return output_transform(F.col(c), spec.round_output, spec.nonneg_output)

    return update_from(
        fact,
        source,
        ["snpsht", "fcst", "agg_level"],
        {"forecast2": value("s_fcst_qty"), "forecast3": value("s_st_fcst_qty")},
    )
