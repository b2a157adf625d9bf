"""Choosing a forecast with a seeded learner per key.

For every key, in time order, a small network scores the three forecasts from
the last selected error and the three error gaps; it explores less and less
and stops exploring after four fifths of the periods.  Rewards are immediate
(no discounting), so this is a contextual bandit.

Spark nests each key's periods (bounded by the calendar) and hands batches of
keys to numpy, which trains all keys of a batch side by side.  A draw is a hash
of run seed, key, purpose and its number, not the next value of a generator, so
a result depends neither on batching nor on partitioning, and any single draw
can be made again without those before it.

What a choice is worth needs no learner: rewards, values and errors are columns
of the period (:func:`choice_outcomes`), and a chosen forecast only picks among
them.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


from stockloom.operators.joins import update_from
from stockloom.plans.forecast.chunks import length_chunks

# Network size, learning rate, exploration and replay settings.
HIDDEN, LEARNING_RATE, INIT_SCALE = 100, 0.1, 0.01
EXPLORE_SHARE, REPLAY_SHARE, REPLAY_STEPS, ERROR_CLAMP = 0.8, 0.2, 10, 1.0
REWARD_LIMIT = 100.0
NAMES = np.array(["forecast1", "forecast2", "forecast3"])


# Purposes of a draw.
FIRST_LAYER, SECOND_LAYER, COIN, DICE, REPLAY = range(5)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(seed: int, key: str, purpose: int, count: int) -> np.ndarray:
    """Uniform draws 0..count-1 of a key for a purpose, in [0, 1)."""
    name = np.array([(seed % (1 << 32)) << 32 | zlib.crc32(key.encode())], np.uint64)
    stream = _scramble(_scramble(name) + np.array([purpose + 1], np.uint64) * _STEP)
    values = _scramble(stream + (np.arange(count, dtype=np.uint64) + np.uint64(1)) * _STEP)
    return (values >> np.uint64(11)) / float(1 << 53)


def normals(seed: int, key: str, purpose: int, count: int) -> np.ndarray:
    """Normal draws, each from a pair of uniform ones."""
    u = draws(seed, key, purpose, 2 * count).reshape(count, 2)
    return np.sqrt(-2.0 * np.log1p(-u[:, 0])) * np.cos(2.0 * np.pi * u[:, 1])


def rewards(errors: np.ndarray) -> np.ndarray:
    """Reward of choosing each forecast, shape (..., 3).

    Zero when all errors are equal; otherwise scaled by the spread of errors,
    positive for the better half of the range and negative for the worse.
    """
    low, high = errors.min(axis=-1, keepdims=True), errors.max(axis=-1, keepdims=True)
    spread = high - low
    ratio = 1.0 - (errors - low) / np.where(spread > 0, spread, 1.0)
    good = np.minimum(ratio * REWARD_LIMIT * spread, REWARD_LIMIT)
    bad = np.maximum(-REWARD_LIMIT * (1.0 - ratio) * spread, -REWARD_LIMIT)
    return np.where(spread > 0, np.where(ratio > 0.5, good, bad), 0.0)


class _Networks:
    """One 4-100-3 network per key, evaluated and trained in parallel."""

    def __init__(self, w1: np.ndarray, w2: np.ndarray):
        keys = len(w1)
        self.w1, self.b1 = w1, np.zeros((keys, HIDDEN))
        self.w2, self.b2 = w2, np.zeros((keys, 3))

    def scores(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(np.einsum("khs,ks->kh", self.w1, state) + self.b1)
        return np.einsum("kah,kh->ka", self.w2, hidden) + self.b2, hidden

    def train(self, state, action, reward, active) -> None:
        rows = np.arange(len(state))
        out, hidden = self.scores(state)
        miss = np.clip(out[rows, action] - reward, -ERROR_CLAMP, ERROR_CLAMP)
        step = LEARNING_RATE * np.where(active, miss, 0.0)[:, None]
        back = self.w2[rows, action] * (1.0 - hidden * hidden) * step
        self.w2[rows, action] -= hidden * step
        self.b2[rows, action] -= step[:, 0]
        self.w1 -= back[:, :, None] * state[:, None, :]
        self.b1 -= back


def choose_batch(
    keys: list[str], errors: list[np.ndarray], gaps: list[np.ndarray], seed: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Actions and rewards per key; errors and gaps are (periods, 3) arrays."""
    count = len(keys)
    n = np.array([len(e) for e in errors])
    periods = int(n.max())
    mape, gap = np.ones((count, periods, 3)), np.zeros((count, periods, 3))
    w1, w2 = np.empty((count, HIDDEN, 4)), np.empty((count, 3, HIDDEN))
    coin, dice = np.zeros((count, periods)), np.zeros((count, periods), dtype=int)
    replay = np.zeros((count, periods, REPLAY_STEPS))
    for k, key in enumerate(keys):
        length = n[k]
        mape[k, :length], gap[k, :length] = errors[k], gaps[k]
        w1[k] = INIT_SCALE * normals(seed, key, FIRST_LAYER, HIDDEN * 4).reshape(HIDDEN, 4)
        w2[k] = INIT_SCALE * normals(seed, key, SECOND_LAYER, 3 * HIDDEN).reshape(3, HIDDEN)
        coin[k, :length] = draws(seed, key, COIN, length)
        dice[k, :length] = np.floor(3 * draws(seed, key, DICE, length))
        replay[k, :length] = draws(seed, key, REPLAY, length * REPLAY_STEPS).reshape(length, REPLAY_STEPS)
    gain = rewards(mape)
    nets = _Networks(w1, w2)
    rows = np.arange(count)
    capacity = np.floor(n * REPLAY_SHARE).astype(int) + 1
    memory_state = np.zeros((count, int(capacity.max()), 4))
    memory_action = np.zeros((count, int(capacity.max())), dtype=int)
    memory_reward = np.zeros((count, int(capacity.max())))
    actions = np.zeros((count, periods), dtype=int)
    last_error = np.ones(count)
    previous = None
    for t in range(periods):
        live = t < n
        state = np.concatenate([last_error[:, None], gap[:, t]], axis=1)
        explore = np.where(t > n * EXPLORE_SHARE, 0.0, 1.0 - t / (n * EXPLORE_SHARE))
        greedy = nets.scores(state)[0].argmax(axis=1)
        action = np.where(coin[:, t] < explore, dice[:, t], greedy)
        actions[:, t] = action
        if previous is not None:
            # Feedback arrives one period late: the step just taken closes the
            # previous one, which is then learnt from and remembered.
            nets.train(*previous, live)
            slot = (t - 1) % capacity
            write = rows[live]
            memory_state[write, slot[live]] = previous[0][live]
            memory_action[write, slot[live]] = previous[1][live]
            memory_reward[write, slot[live]] = previous[2][live]
            filled = np.minimum(t, capacity)
            for draw in range(REPLAY_STEPS):
                pick = np.floor(np.where(live, replay[:, t, draw], 0.0) * filled).astype(int)
                nets.train(
                    memory_state[rows, pick], memory_action[rows, pick],
                    memory_reward[rows, pick], live,
                )
        previous = (state, action, gain[rows, t, action])
        last_error = mape[rows, t, action]
    return [
        (actions[k, :length], gain[k, np.arange(length), actions[k, :length]])
        for k, length in enumerate(n)
    ]


# Replay draws, memory and errors per key and period; per key the weights, their
# gradients and the hidden layers of a step.
STEP_BYTES = 8 * (REPLAY_STEPS + 20)
ROW_BYTES = 8 * HIDDEN * 3 * 9
_OUT = "agg_level string, fcsts array<date>, chosen array<string>"


def _reward(chosen: Column) -> Column:
    """What :func:`rewards` gives for the chosen forecast."""
    errors = [F.col(f"mape{i}") for i in (1, 2, 3)]
    own = _of(chosen, errors)
    low, spread = F.least(*errors), F.greatest(*errors) - F.least(*errors)
    ratio = 1.0 - (own - low) / spread
    good = F.least(ratio * REWARD_LIMIT * spread, F.lit(REWARD_LIMIT))
    bad = F.greatest(-REWARD_LIMIT * (1.0 - ratio) * spread, F.lit(-REWARD_LIMIT))
    return F.when(spread > 0, F.when(ratio > 0.5, good).otherwise(bad)).otherwise(F.lit(0.0))


def _of(chosen: Column, values: list[Column]) -> Column:
    return F.when(chosen == "forecast1", values[0]).when(chosen == "forecast2", values[1]).otherwise(values[2])


def _outcome(choices: DataFrame) -> DataFrame:
    """Adds reward, value and percent errors (NULL where the actual is missing
    or 0) of the column forecast_chosen."""
    chosen, names = F.col("forecast_chosen"), [str(n) for n in NAMES]

    def error(name: str) -> Column:
        share = F.abs(F.col(name) - F.col("actual")) / F.col("actual")
        return F.when(F.col("actual") != 0, F.round(share, 4)).alias(f"{name}_mape")

    valued = choices.withColumn("one_value", _of(chosen, [F.col(n) for n in names]))
    return valued.select("agg_level", "fcst", "forecast_chosen", _reward(chosen).alias("reward"), *names, "actual", "one_value",
                         error("one_value"), *[error(n) for n in names])


def choice_outcomes(stats: DataFrame, as_of: dt.date) -> DataFrame:
    """What each of the three choices gives, per key and scored period up to a
    date; the columns are those of :func:`bandit_selection`."""
    choice = F.explode(F.array(*[F.lit(str(n)) for n in NAMES])).alias("forecast_chosen")
    return _outcome(stats.filter(F.col("fcst") <= F.lit(as_of)).select("*", choice))


def bandit_selection(stats: DataFrame, as_of: dt.date, seed: int = 0) -> DataFrame:
    """Chosen forecast and reward per key and scored period up to a date.

    Columns: agg_level, fcst, forecast_chosen, reward, one_value, forecast1..3,
    actual, and the four percent errors (NULL where the actual is missing or 0).
    """
    scored = stats.filter(F.col("fcst") <= F.lit(as_of))
    zero = F.lit(0.0)
    entry = F.struct(
        "fcst",
        *[F.col(f"mape{i}") for i in (1, 2, 3)],
        *[F.coalesce(f"least_avg{i}", zero).alias(f"gap{i}") for i in (1, 2, 3)],
    )
    nested = scored.groupBy("agg_level").agg(F.array_sort(F.collect_list(entry)).alias("s"))
    fields = ["fcst", *[f"{kind}{i}" for kind in ("mape", "gap") for i in (1, 2, 3)]]
    nested = nested.select("agg_level", *[F.col(f"s.{f}").alias(f) for f in fields])

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = (c for pdf in batches for c in length_chunks(pdf, "fcst", STEP_BYTES, row_bytes=ROW_BYTES))
        for pdf in chunks:

            def stacked(kind: str, pdf: pd.DataFrame = pdf) -> list[np.ndarray]:
                cols = zip(pdf[f"{kind}1"], pdf[f"{kind}2"], pdf[f"{kind}3"], strict=True)
                return [np.column_stack(c).astype(float) for c in cols]

            picks = choose_batch(list(pdf["agg_level"]), stacked("mape"), stacked("gap"), seed)
            out = pd.DataFrame({"agg_level": pdf["agg_level"], "fcsts": pdf["fcst"]})
            out["chosen"] = [NAMES[a].tolist() for a, _ in picks]
            yield out

    row = F.explode(F.arrays_zip("fcsts", "chosen")).alias("r")
    choices = nested.mapInPandas(learn, _OUT).select("agg_level", row).select(
        "agg_level", F.col("r.fcsts").alias("fcst"), F.col("r.chosen").alias("forecast_chosen"))
    return _outcome(choices.join(scored, ["agg_level", "fcst"]))


def apply_selection(fact: DataFrame, choices: DataFrame, use_forecast4: bool = False) -> DataFrame:
    """one_forecast of every target of a snapshot, by the chosen forecast."""
    source = choices.select(F.col("fcst").alias("snpsht"), "agg_level", "forecast_chosen")
    third = F.col("forecast4") if use_forecast4 else F.col("forecast3")
    chosen = (
        F.when(F.col("s_forecast_chosen") == "forecast1", F.col("forecast1"))
        .when(F.col("s_forecast_chosen") == "forecast2", F.col("forecast2"))
        .when(F.col("s_forecast_chosen") == "forecast3", third)
    )
    return update_from(fact, source, ["snpsht", "agg_level"], {"one_forecast": chosen})
