"""Pipelines on small frames: hand cases, brute force and invariants."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.calendar import covering_calendar
from stockloom.plans import baskets as bk
from stockloom.plans import bulk, orders
from stockloom.plans import forecast as fc
from stockloom.plans.forecast.bandit import choose_batch, rewards
from stockloom.plans.forecast.smoothing import smooth_batch
from stockloom.spec import SeriesSpec

SUNDAY = dt.date(1998, 1, 4)
SPEC = SeriesSpec("dt", ("k",), "qty", "week", 3)


def weekly(spark, series):
    rows = [(k, SUNDAY + dt.timedelta(weeks=w), float(v)) for k, values in series.items() for w, v in values]
    return spark.createDataFrame(rows, "k string, dt date, qty double")


# --- exponential smoothing -------------------------------------------------


def closed_level(x, alpha, t):
    """Level after t steps, written out: every value with its remaining weight."""
    rest = (1 - alpha) ** np.arange(t, -1, -1.0)
    return rest[0] * x[0] + alpha * float(np.dot(rest[1:], x[1:t + 1]))


def span_cost(x, alpha, lo, hi):
    return sum((x[i] - closed_level(x, alpha, i - 1)) ** 2 for i in range(max(lo, 1), hi + 1))


def test_smoothing_fits_and_crosses_its_spans():
    """Alphas are as good as a dense grid's, and each part of a series is
    smoothed with the alpha of another part."""
    rng = np.random.default_rng(5)
    batch = [np.cumsum(rng.normal(0, 1, n)) + rng.normal(10, 0.7, n) for n in (12, 21, 60)]
    fit = smooth_batch(batch, batch)
    grid = np.linspace(0, 1, 201)
    for k, x in enumerate(batch):
        n, last = len(x), len(x) - 1
        h, q = n // 2, n // 4
        spans = [(0, last), (0, h), (h + 1, last), (0, q), (q + 1, 2 * q), (2 * q + 1, 3 * q), (3 * q + 1, last)]
        for alpha, (lo, hi) in zip(fit["alphas"][:, k], spans):
            costs = [span_cost(x, a, lo, hi) for a in grid]
            near = abs(alpha - grid[int(np.argmin(costs))]) <= 0.011
            assert near or span_cost(x, alpha, lo, hi) <= min(costs) * 1.02 + 1e-9
        halves = np.where(np.arange(n) <= h, 2, 1)
        quarters = np.array([6, 3, 4, 5])[np.clip((np.arange(n) - 1) // q, 0, 3)]
        halves[last], quarters[last] = 0, 6
        for i in range(1, n):
            assert fit["long"][i, k] == pytest.approx(closed_level(x, fit["alphas"][halves[i], k], i))
            assert fit["short"][i, k] == pytest.approx(closed_level(x, fit["alphas"][quarters[i], k], i))


def test_short_series_by_hand():
    assert closed_level([1.0, 3.0, 2.0], 0.5, 2) == 2.0  # 1, then 2, then 2
    fit = smooth_batch([np.array([4.0]), np.array([4.0, 4.0])], [np.array([4.0]), np.array([4.0, 4.0])])
    assert fit["long"][1, 1] == 4.0 and np.isnan(fit["long"][0]).all()


def test_results_do_not_depend_on_chunks(spark, monkeypatch):
    from stockloom.plans.forecast import chunks

    rng = random.Random(2)
    rows = [(k, SUNDAY + dt.timedelta(weeks=w), rng.random(), rng.random(), True) for k in "abcdefg" for w in range(5 + 3 * (ord(k) % 5))]
    df = spark.createDataFrame(rows, "agg_level string, dt date, deseasonalized_adj_qty double, "
                               "st_deseasonalized_adj_qty double, fcst_crt_dt_flg boolean").coalesce(1)
    import pandas as pd

    frame = pd.DataFrame({"x": [[0] * n for n in (9, 1, 4, 4, 2)], "key": list("abcde")})
    cut = list(chunks.length_chunks(frame, "x", 10, budget=80))
    assert [list(c["key"]) for c in cut] == [["b", "e"], ["c", "d"], ["a"]]
    from stockloom.plans.forecast.smoothing import _NESTED, _fit_batches

    nested = pd.DataFrame([(k, [r[1] for r in rows if r[0] == k], [r[2] for r in rows if r[0] == k], [r[3] for r in rows if r[0] == k])
                           for k in "abcdefg"], columns=["agg_level", "dts", "x", "y"])
    whole = pd.concat(_fit_batches([nested])).sort_values("agg_level").reset_index(drop=True)
    monkeypatch.setattr(chunks, "BUDGET", 1)
    single = pd.concat(_fit_batches([nested])).sort_values("agg_level").reset_index(drop=True)
    assert whole.to_json() == single.to_json() and _NESTED and df.count() == len(rows)


def test_constant_series_has_constant_level(spark):
    rows = [("a", SUNDAY + dt.timedelta(weeks=w), 4.0, 4.0, True) for w in range(30)]
    df = spark.createDataFrame(rows, "agg_level string, dt date, deseasonalized_adj_qty double, "
                               "st_deseasonalized_adj_qty double, fcst_crt_dt_flg boolean")
    got = fc.exp_smooth_fit(df).orderBy("dt").collect()
    assert got[0].fcst_deseasonalized_qty is None and got[0].st_fcst_deseasonalized_qty is None
    assert all(r.fcst_deseasonalized_qty == pytest.approx(4) for r in got[1:])


# --- bandit ------------------------------------------------------------------


def test_rewards():
    got = rewards(np.array([[0.1, 0.2, 0.3], [0.5, 0.5, 0.5], [0.0, 9.0, 1.0]]))
    assert np.allclose(got[0], [20, -10, -20])
    assert np.allclose(got[1], 0)
    assert np.allclose(got[2], [100, -100, 100])


def test_bandit_is_independent_of_batching():
    rng = np.random.default_rng(1)
    keys = ["a", "b", "c"]
    errors, gaps = [rng.random((n, 3)) for n in (40, 7, 1)], [rng.random((n, 3)) for n in (40, 7, 1)]
    together = choose_batch(keys, errors, gaps, 3)
    for k in range(3):
        alone = choose_batch(keys[k:k + 1], errors[k:k + 1], gaps[k:k + 1], 3)[0]
        assert (alone[0] == together[k][0]).all() and np.allclose(alone[1], together[k][1])
    other = choose_batch(keys, errors, gaps, 4)
    assert (other[0][0] != together[0][0]).any()
    assert set(np.concatenate([a for a, _ in together])) <= {0, 1, 2}


def test_bandit_learns_a_clear_winner():
    errors = np.tile([0.9, 0.1, 0.9], (200, 1))
    actions, _ = choose_batch(["k"], [errors], [np.zeros((200, 3))], 0)[0]
    assert (actions[170:] == 1).all()


def plain_uniform(seed, key, purpose, n):
    """A draw by itself, in whole numbers."""
    import zlib

    size = (1 << 64) - 1

    def scramble(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & size
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & size
        return x ^ (x >> 31)

    step = 0x9E3779B97F4A7C15
    stream = scramble(scramble(seed << 32 | zlib.crc32(key.encode())) + (purpose + 1) * step & size)
    return (scramble(stream + (n + 1) * step & size) >> 11) / 2 ** 53


def plain_learner(key, errors, gaps, seed):
    """One key, one period, one hidden unit after the other."""
    import math

    def normal(purpose, n):
        u, v = (plain_uniform(seed, key, purpose, 2 * n + i) for i in (0, 1))
        return 0.01 * math.sqrt(-2 * math.log1p(-u)) * math.cos(2 * math.pi * v)

    w1 = [[normal(0, 4 * h + s) for s in range(4)] for h in range(100)]
    w2 = [[normal(1, 100 * a + h) for h in range(100)] for a in range(3)]
    b1, b2 = [0.0] * 100, [0.0] * 3

    def scores(state):
        hidden = [math.tanh(sum(w * x for w, x in zip(row, state)) + b) for row, b in zip(w1, b1)]
        return [sum(w * h for w, h in zip(row, hidden)) + b for row, b in zip(w2, b2)], hidden

    def train(state, action, reward):
        out, hidden = scores(state)
        step = 0.1 * max(-1.0, min(1.0, out[action] - reward))
        back = [w * (1 - h * h) * step for w, h in zip(w2[action], hidden)]
        for h in range(100):
            w2[action][h] -= hidden[h] * step
            b1[h] -= back[h]
            for s in range(4):
                w1[h][s] -= back[h] * state[s]
        b2[action] -= step

    n, memory, actions, gains = len(errors), {}, [], []
    last, before = 1.0, None
    size = int(n * 0.2) + 1
    for t in range(n):
        state = [last, *gaps[t]]
        explore = 0.0 if t > n * 0.8 else 1 - t / (n * 0.8)
        out = scores(state)[0]
        action = int(3 * plain_uniform(seed, key, 3, t)) if plain_uniform(seed, key, 2, t) < explore else out.index(max(out))
        if before:
            train(*before)
            memory[(t - 1) % size] = before
            for d in range(10):
                train(*memory[int(plain_uniform(seed, key, 4, 10 * t + d) * min(t, size))])
        gain = float(rewards(np.array(errors[t]))[action])
        actions.append(action)
        gains.append(gain)
        before, last = (state, action, gain), errors[t][action]
    return actions, gains


def test_bandit_equals_a_plain_loop_per_key():
    rng = np.random.default_rng(11)
    keys = ["north|a", "south|b", "é"]
    errors, gaps = [rng.random((n, 3)) for n in (60, 25, 1)], [rng.random((n, 3)) / 4 for n in (60, 25, 1)]
    for seed in (0, 7):
        for key, e, g, (actions, gains) in zip(keys, errors, gaps, choose_batch(keys, errors, gaps, seed)):
            want = plain_learner(key, e.tolist(), g.tolist(), seed)
            assert actions.tolist() == want[0] and gains.tolist() == pytest.approx(want[1])


def test_a_chosen_forecast_picks_among_the_outcomes(spark):
    rng = random.Random(3)
    fact = fact_rows(spark, [(w, rng.uniform(5, 15), rng.uniform(5, 15) if w % 5 else 0.0) for w in range(30)]).withColumn(
        "forecast2", F.col("forecast1") * 1.1)
    last = SUNDAY + dt.timedelta(weeks=29)
    stats = fc.rolling_error_stats(fc.selection_base(fact, last, SPEC), SPEC, last)
    chosen, outcomes = fc.bandit_selection(stats, last, seed=3), fc.choice_outcomes(stats, last)
    assert chosen.columns == outcomes.columns and outcomes.count() == 3 * chosen.count() == 3 * stats.count()
    all_rows = {repr(r) for r in outcomes.collect()}
    assert {repr(r) for r in chosen.collect()} <= all_rows


# --- history, year match -----------------------------------------------------


def test_growth_limits_of_a_daily_series(spark):
    """Percentiles of the year before, against a sort of everything per snapshot."""
    from fractions import Fraction

    rng = random.Random(12)
    start = dt.date(1999, 1, 1)
    days = sorted(rng.sample(range(800), 500))
    rows = [(k, start + dt.timedelta(days=d), yr, rng.choice([rng.random(), 0.5, 1.0])) for k in "ab" for d in days for yr in range(1, 1 + rng.randrange(1, 5))]
    df = spark.createDataFrame(rows, "agg_level string, snpsht date, yr int, comp_fctr double")
    got = {(r.agg_level, r.snpsht, r.yr): (r.p10, r.p50, r.p90, r.comp_fctr) for r in fc.cap_growth(df, SPEC).collect()}
    assert len(got) == len(rows)
    for key, day, yr, factor in rng.sample(rows, 120) + [r for r in rows if r[1].month == 2 and r[1].day == 29]:
        try:
            begin = day.replace(year=day.year - 1)
        except ValueError:
            begin = day.replace(year=day.year - 1, day=28)
        copies = 3 * sum(r[:2] == (key, day) for r in rows)
        pool = sorted(r[3] for r in rows if r[0] == key and begin < r[1] < day for _ in range(copies))
        limits = got[key, day, yr][:3]
        if not pool:
            assert limits == (None, None, None)
            continue
        for p, have in zip((Fraction(1, 10), Fraction(1, 2), Fraction(9, 10)), limits):
            place = (len(pool) - 1) * p
            low, high = pool[int(place)], pool[-int(-place // 1)]
            assert have == pytest.approx(low + (high - low) * float(place - int(place)))
        assert got[key, day, yr][3] == (limits[1] if factor > limits[2] else factor)


def test_years_are_compared_inside_the_row(spark):
    """The recent quarter is not copied onto the earlier entries."""
    rng = random.Random(1)
    raw = weekly(spark, {"a": [(w, 20 + rng.random()) for w in range(52 * 3)]})
    cal = covering_calendar(raw, SPEC.time_col, 5, 2)
    hist = fc.densify_history(raw, SPEC)
    last = SUNDAY + dt.timedelta(weeks=52 * 3 - 1)
    periods = fc.snapshot_periods(cal, hist, SPEC, last, last, last)
    compared = fc.year_comparison(periods, hist, cal, SPEC, (last, last))
    plan = compared._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("collect_list")]
    assert above.count("Generate explode") == 1 and "Join" not in above
    assert 1 <= compared.count() <= 3


def test_densify_starts_at_first_positive_value(spark):
    raw = weekly(spark, {"a": [(0, 0), (2, 5), (4, 1)], "b": [(1, 2)], "c": [(3, 0)]})
    got = sorted((r.agg_level, (r.dt - SUNDAY).days // 7, r.value) for r in fc.densify_history(raw, SPEC).collect())
    assert got == [("a", 2, 5.0), ("a", 3, 0.0), ("a", 4, 1.0),
                   ("b", 1, 2.0), ("b", 2, 0.0), ("b", 3, 0.0), ("b", 4, 0.0)]


def test_densify_shuffles_key_date_and_value_only(spark):
    raw = weekly(spark, {"a": [(0, 1), (5, 2)], "b": [(2, 1)]})
    df = fc.densify_history(raw.union(raw.limit(1)), SPEC)
    assert df.count() == 6  # three rows, one of them twice, and two gaps of "b"
    above, window, below = df._jdf.queryExecution().optimizedPlan().toString().partition("Window [")
    assert window and "scalar-subquery" in above
    assert "scalar-subquery" not in below and "array" not in below


def test_dates_outside_the_calendar_are_an_error(spark):
    from stockloom.calendar import fiscal_calendar, in_calendar

    cal = fiscal_calendar(spark, SUNDAY, SUNDAY + dt.timedelta(days=9))
    days = spark.createDataFrame([(SUNDAY,), (SUNDAY + dt.timedelta(days=30),)], "d date")
    assert in_calendar(days.limit(1), "d", cal).count() == 1
    with pytest.raises(Exception, match="outside the calendar"):
        in_calendar(days, "d", cal).select("fscl_yr").collect()


def test_incremental_run_leaves_the_past_alone(spark):
    rng = random.Random(9)
    values = [(w, 20 + w % 7 + rng.random()) for w in range(52 * 3)]
    raw = weekly(spark, {"a": values, "b": values[60:]})
    cal = covering_calendar(raw, "dt", 5, 2)
    last = SUNDAY + dt.timedelta(weeks=52 * 3 - 2)
    before = fc.run_forecast(raw.filter(F.col("dt") < last), cal, SPEC, last - dt.timedelta(weeks=4), last - dt.timedelta(weeks=1),
                             last - dt.timedelta(weeks=1))
    from stockloom.session import materialise

    before = materialise(before, "test-fact")
    after = materialise(fc.run_incremental(before, raw, cal, SPEC, last), "test-fact")
    old = sorted(map(repr, before.collect()))
    assert sorted(map(repr, after.filter(F.col("snpsht") < last).collect())) == old
    fresh = after.filter(F.col("snpsht") == last)
    assert fresh.count() > 0 and fresh.filter("forecast1 is null").count() == 0
    assert after.groupBy("snpsht", "fcst", "agg_level").count().filter("count > 1").count() == 0
    again = fc.run_incremental(after, raw, cal, SPEC, last)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, after.collect()))


def test_a_period_from_state_equals_the_recomputed_one(spark):
    """Keys that begin in the period, pause, or have not begun; run twice."""
    rng = random.Random(14)
    n = 52 * 3
    raw = weekly(spark, {
        "a": [(w, 20 + w % 9 + rng.random()) for w in range(n)], "pauses": [(w, 5 + rng.random()) for w in range(60, n - 9)],
        "begins": [(n - 1, 7.0)], "never": [(n - 3, 0.0), (n - 1, 0.0)], "ends": [(w, 3.0 + w % 2) for w in range(n - 1)]})
    cal = covering_calendar(raw, "dt", 5, 2)
    last = SUNDAY + dt.timedelta(weeks=n - 1)
    past, now = raw.filter(F.col("dt") < last), raw.filter(F.col("dt") == last)
    from stockloom.session import materialise, stage_path

    fact = materialise(fc.run_forecast(past, cal, SPEC, last - dt.timedelta(weeks=3), last - dt.timedelta(weeks=1), last - dt.timedelta(weeks=1)), "test-fact")
    state = fc.series_state(past, SPEC).write(stage_path(spark, "test-state"))
    got, after = fc.run_period(fact, state, now, cal, SPEC, last)
    want = fc.run_incremental(fact, raw, cal, SPEC, last)

    def rounded(df):
        return sorted(repr([round(v, 8) if isinstance(v, float) else v for v in r]) for r in df.select(want.columns).collect())

    assert rounded(got) == rounded(want)
    again = fc.advance(after, now, SPEC)
    whole = fc.series_state(raw, SPEC)
    for a in (after, again):
        assert sorted(map(repr, a.series.collect())) == sorted(map(repr, whole.series.collect()))
        assert sorted(a.dates.collect()) == sorted(whole.dates.collect())
    assert {r.agg_level for r in whole.series.collect()} == {"a", "pauses", "begins", "ends"}
    read = {f.rsplit("/", 2)[-2] for f in fc.advance(state, now, SPEC).series.inputFiles()}
    assert read == {"series"}  # the period's rows are in memory here, the sales before it are not read


def test_weights_add_up_and_steady_series_is_repeated(spark):
    rng = random.Random(0)
    base = [rng.randrange(20, 40) for _ in range(52)]
    values = [(w, base[w % 52] + rng.random()) for w in range(52 * 4)]
    raw = weekly(spark, {"a": values, "b": values})
    cal = covering_calendar(raw, SPEC.time_col, 5, 2)
    hist = fc.densify_history(raw, SPEC)
    last = SUNDAY + dt.timedelta(weeks=52 * 4 - 1)
    start = last - dt.timedelta(weeks=4)
    periods = fc.snapshot_periods(cal, hist, SPEC, start, last, last)
    weights = fc.similarity_weights(fc.year_comparison(periods, hist, cal, SPEC, (start, last)))
    sums = weights.groupBy("agg_level", "snpsht").agg(F.sum("weight").alias("w")).collect()
    assert sums and all(r.w == pytest.approx(1) for r in sums)
    fact = fc.forecast1(hist, weights, periods, SPEC, (start, last))
    errors = [abs(r.forecast1 - r.actual) for r in fact.filter("actual IS NOT NULL").collect()]
    assert errors and max(errors) < 25


# --- selection and adjustment ------------------------------------------------


def fact_rows(spark, rows):
    return spark.createDataFrame(
        [(SUNDAY + dt.timedelta(weeks=w), SUNDAY + dt.timedelta(weeks=w), "a", f, f, f, None, None, actual) for w, f, actual in rows],
        "snpsht date, fcst date, agg_level string, forecast1 double, forecast2 double, forecast3 double, "
        "forecast4 double, one_forecast double, actual double")


def test_reactive_adjust(spark):
    fact = fact_rows(spark, [(0, 12.0, 10.0), (1, 13.0, 10.0), (2, 14.0, 10.0), (3, 20.4, None), (4, 9.5, 9.0)])
    got = {(r.fcst - SUNDAY).days // 7: r.forecast1 for r in fc.reactive_adjust(fact, SUNDAY, SUNDAY + dt.timedelta(weeks=9)).collect()}
    assert got == {0: 12.0, 1: 13.0, 2: 14.0, 3: 17.0, 4: 10.0}


def test_error_windows_count_calendar_periods(spark):
    fact = fact_rows(spark, [(0, 11.0, 10.0), (1, 12.0, 10.0), (5, 13.0, 10.0), (6, 14.0, 10.0)])
    last = SUNDAY + dt.timedelta(weeks=6)
    stats = fc.rolling_error_stats(fc.selection_base(fact, last, SPEC), SPEC, last)
    got = {(r.fcst - SUNDAY).days // 7: r for r in stats.collect()}
    assert set(got) == {0, 1, 6}
    assert got[0].least_avg is None and got[0].avg1 == 1.0
    assert got[6].avg1 == pytest.approx((0.1 + 0.2 + 0.3) / 3) and got[6].avg1_short == pytest.approx(0.3)
    assert got[6].prev_best_forecast is None and got[1].prev_best_forecast == "Default - FORECAST2"


# --- baskets -----------------------------------------------------------------


def brute_split(hist):
    """All splits of (quantity, count) pairs, largest quantity first."""
    n = len(hist)
    options = [(2, 3)] if n < 3 else [(a, b) for a in range(2, n) for b in range(a + 1, n + 1)]

    def sse(group):
        cnt = sum(c for _, c in group)
        if not cnt:
            return 0.0
        mean = sum(q * c for q, c in group) / cnt
        return sum(c * (q - mean) ** 2 for q, c in group)

    return min((round(sse(hist[:a - 1]) + sse(hist[a - 1:b - 1]) + sse(hist[b - 1:]), 6), a, b) for a, b in options)


def test_best_split_matches_brute_force(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for sku in range(30):
        n = rng.choice([1, 2, 3, 4, 9, 25])
        hist = sorted(((q, rng.randrange(1, 9)) for q in rng.sample(range(1, 60), n)), reverse=True)
        rows += [(1, sku, SUNDAY, q) for q, c in hist for _ in range(c)]
        expected[sku] = brute_split(hist)
    hist = bk.qty_histogram(spark.createDataFrame(rows, "store int, sku int, sku_crt_dt date, item_qty long"))
    splits = bk.cluster_sse(hist)
    best = {r.sku: min((x.sse, x.k2_start, x.k3_start) for x in [r]) for r in splits.groupBy("sku").agg(
        F.min(F.struct("sse", "k2_start", "k3_start")).alias("b")).select("sku", "b.*").collect()}
    for sku, (sse, a, b) in expected.items():
        assert best[sku][1:] == (a, b) and best[sku][0] == pytest.approx(sse, abs=1e-5)
    per_pair = splits.groupBy("sku").count().join(hist.groupBy("sku").agg(F.max("max_pkey").alias("n")), "sku")
    assert per_pair.filter("count > n").count() == 0
    single = bk.best_split(splits, SUNDAY).join(hist.filter("max_pkey = 1").select("sku"), "sku").first()
    assert single.mid_freq is None and single.top_freq >= 1


def test_split_errors_of_large_numbers_are_exact(spark):
    """Quantities near a million with counts of millions, against fractions."""
    from fractions import Fraction

    pairs = [(1_000_003, 4_000_001), (1_000_001, 3_999_999), (1_000_000, 5_000_000), (999_999, 2_000_003), (7, 9)]
    rows = [(1, 1, SUNDAY, len(pairs), k + 1, q, c) for k, (q, c) in enumerate(pairs)]
    hist = spark.createDataFrame(rows, "store int, sku int, sku_crt_dt date, max_pkey long, pkey int, item_qty long, trans_cnt long")

    def sse(group):
        n = sum(c for _, c in group)
        return sum(c * q * q for q, c in group) - Fraction(sum(c * q for q, c in group) ** 2, n)

    got = {r.k2_start: (r.k3_start, r.sse) for r in bk.cluster_sse(hist).collect()}
    for k2 in range(2, 5):
        want = min((float(sse(pairs[:k2 - 1]) + sse(pairs[k2 - 1:k3 - 1]) + sse(pairs[k3 - 1:])), k3) for k3 in range(k2 + 1, 6))
        assert got[k2] == (want[1], pytest.approx(want[0], rel=1e-12))


@pytest.mark.parametrize("spread", [3, 40, 10_000])
def test_thirds_match_all_candidates(spread):
    """Every start of the second group, against all starts of the third in whole numbers."""
    from fractions import Fraction

    from stockloom.plans.basket_split import SAME, Histograms, best_thirds

    rng = random.Random(spread)
    sizes = [1, 2, 3, 4, 7, 30, 61]
    data = [(np.array(sorted(rng.sample(range(spread * 70), n), reverse=True)), np.array([rng.randrange(1, spread + 1) for _ in range(n)])) for n in sizes]
    data.append((np.array([10 ** 9 - i for i in range(40)]), np.array([10 ** 8 + rng.randrange(9) for _ in range(40)])))

    def sse(x, c):
        x, c = [int(v) for v in x], [int(v) for v in c]
        return sum(n * v * v for v, n in zip(x, c)) - Fraction(sum(n * v for v, n in zip(x, c)) ** 2, sum(c)) if c else 0

    pair, k2, k3 = best_thirds(Histograms([x for x, _ in data], [c for _, c in data]))
    got = {(p, a): b for p, a, b in zip(pair.tolist(), k2.tolist(), k3.tolist())}
    want = {}
    for p, (x, c) in enumerate(data):
        n = len(x)
        if n < 3:
            want[p, 2] = 3
        for a in range(2, n):
            sums = {b: sse(x[a - 1:b - 1], c[a - 1:b - 1]) + sse(x[b - 1:], c[b - 1:]) for b in range(a + 1, n + 1)}
            # Sums that a double can't tell apart are equal.
            want[p, a] = min(b for b, v in sums.items() if v <= min(sums.values()) * (1 + Fraction(SAME)))
    assert got == want


def test_split_of_a_pair_with_many_quantities(spark):
    """5,000 distinct quantities: a linear number of rows, the least error of all 12 million splits."""
    n = 5_000
    rng = np.random.default_rng(6)
    x = np.sort(rng.choice(200_000, n, replace=False))[::-1].astype(np.int64)
    c = rng.integers(1, 50, n)
    rows = [(1, 1, SUNDAY, n, k + 1, int(q), int(m)) for k, (q, m) in enumerate(zip(x, c))]
    hist = spark.createDataFrame(rows, "store int, sku int, sku_crt_dt date, max_pkey long, pkey int, item_qty long, trans_cnt long")
    N, S, Q = (np.concatenate([[0], np.cumsum(v)]).astype(float) for v in (c, c * (x - 100_000), c * (x - 100_000) ** 2))

    def sse(a, b):
        """Of ranks a..b, counted from 1."""
        return Q[b] - Q[a - 1] - (S[b] - S[a - 1]) ** 2 / (N[b] - N[a - 1])

    third = np.arange(3, n + 1)
    best = [(sse(1, k2 - 1) + (at := sse(k2, third[k2 - 2:] - 1) + sse(third[k2 - 2:], n)).min(), k2, k2 + 1 + int(at.argmin())) for k2 in range(2, n)]
    splits = bk.cluster_sse(hist)
    got = {r.k2_start: (r.k3_start, r.sse) for r in splits.collect()}
    assert len(got) == n - 2
    assert all(got[k2][0] == k3 and got[k2][1] == pytest.approx(total, rel=1e-9) for total, k2, k3 in best)
    one = bk.winning_split(hist).collect()
    assert [(r.k2_start, r.k3_start) for r in one] == [min(best)[1:]]
    assert one[0].k1_cnt + one[0].k2_cnt + one[0].k3_cnt == c.sum()
    named = bk.best_split(splits, SUNDAY).first()
    assert named == bk.name_groups(bk.winning_split(hist), SUNDAY).first()


# --- bulk --------------------------------------------------------------------


def test_tier_diff_statuses(spark):
    base = spark.createDataFrame([(s, 1) for s in range(1, 7)], "sku int, store int")
    schema = "sku int, loc int, vol_disc_min_qty double"
    new = spark.createDataFrame([(1, 1, 5.0), (3, 1, 4.0), (4, 1, 9.0), (5, 1, 7.0)], schema)
    last = spark.createDataFrame([(2, 1, 5.0), (3, 1, 6.0), (4, 1, 6.0), (5, 1, 7.0)], schema)
    got = {r.sku: r.status for r in bulk.tier_diff(base, new, last).collect()}
    assert got == {1: "ADDED", 2: "REMOVED", 3: "REDUCED", 4: "INCREASED", 5: "NO CHANGE"}


def test_removed_items(spark):
    keys = "sku int, sku_crt_dt date"
    last = spark.createDataFrame([(1, SUNDAY), (1, SUNDAY), (2, SUNDAY), (3, SUNDAY)], keys)
    new = spark.createDataFrame([(2, SUNDAY)], keys)
    items = spark.createDataFrame(
        [(s, SUNDAY, d, 1, "c", 2, "s") for s, d in ((1, "0025"), (2, "0026"), (3, None))],
        keys + ", sub_dept string, class_nbr int, class_desc string, sub_class_nbr int, sub_class_desc string")
    got = bulk.removed_items(last, new, items).collect()
    assert [(r.sku, r.dept) for r in got] == [(1, "025")]


def test_missing_settings_stop_the_run(spark):
    bulk.require_settings(spark.createDataFrame([], "sku int"))
    with pytest.raises(bulk.MissingSettings):
        bulk.require_settings(spark.createDataFrame([(1,)], "sku int"))


# --- orders ------------------------------------------------------------------


def greedy(rows, cap):
    used, taken = 0.0, set()
    for _, po, cube in sorted(rows, key=lambda r: (-r[0], r[1])):
        if used + cube <= cap:
            used += cube
            taken.add(po)
    return taken


def test_truck_skips_and_goes_on(spark):
    rows = [("s", 1, 9, 2000.0), ("s", 2, 8, 500.0), ("s", 3, 7, 300.0), ("s", 4, 6, 200.0), ("s", 5, 5, 0.0), ("s", 6, 9, 2500.0)]
    got = orders.build_truck(spark.createDataFrame(rows, "store string, po long, new_priority long, cube double"))
    assert {r.po for r in got.filter("included").collect()} == {1, 3, 5}
    assert got.count() == 6 and orders.check_capacity(got).count() == 0


def test_truck_matches_greedy_with_a_hot_store(spark):
    rng = random.Random(8)
    rows = []
    for po in range(4000):
        store = "hot" if po % 3 == 0 else f"s{po % 7}"
        rows.append((store, po, rng.randrange(6), float(rng.choice([0, 1, 3, 7, 40, 41, 99.5, 130, 2399]))))
    got = orders.build_truck(
        spark.createDataFrame(rows, "store string, po long, new_priority long, cube double"), cap=1000.0)
    taken = {}
    for r in got.filter("included").collect():
        taken.setdefault(r.store, set()).add(r.po)
    for store in {r[0] for r in rows}:
        assert taken[store] == greedy([(p, po, c) for s, po, p, c in rows if s == store], 1000.0)


@pytest.mark.parametrize("cubes", [[2400 / 7] * 9, [2400 / 11] * 30 + [0.1] * 5, None])
def test_truck_of_real_valued_cubes(spark, cubes):
    rng = random.Random(3)
    cubes = cubes or [rng.uniform(0.01, 900) for _ in range(3000)]
    rows = [("s", po, rng.randrange(1000) if len(cubes) > 100 else 5, cube) for po, cube in enumerate(cubes)]
    rows += [(None, po, 1, 1000.0) for po in range(4)]
    df = spark.createDataFrame(rows, "store string, po long, new_priority long, cube double")
    want = greedy([(p, po, c) for s, po, p, c in rows if s == "s"], 2400.0)
    for group_rows in (200_000, 50):
        got = orders.build_truck(df, group_rows=group_rows)
        assert {r.po for r in got.filter("included and store = 's'").collect()} == want
        assert got.count() == len(rows)
