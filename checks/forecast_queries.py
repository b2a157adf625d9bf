"""Forecast queries with their reference SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.inputs import AS_OF, SNAP_END, SNAP_START, SPEC, Inputs
from checks.registry import Query
from stockloom.operators import semi_in
from stockloom.plans import forecast as fc
from stockloom.plans.forecast.run import create_fact, deseasonalised
from stockloom.plans.forecast.seasonal import smoothing_weights
from stockloom.session import materialise, stage_path
from stockloom.spec import SeriesSpec

DAILY = SeriesSpec("dt", ("p_brand",), "qty", "day", 2)
DAILY_START, DAILY_END = dt.date(2001, 6, 1), dt.date(2001, 6, 3)


def lit(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def week(d: str) -> str:
    return f"(({d} - DATE '1970-01-04') // 7)"


def years_back(d: str, n: str) -> str:
    return f"CAST({d} - to_years(CAST({n} AS INTEGER)) AS DATE)"


# --- reference SQL -------------------------------------------------------


def history_ctes(spec: SeriesSpec) -> tuple[tuple[str, str], ...]:
    source = "history" if spec.freq == "week" else "daily_history"
    key = " || '|' || ".join(spec.keys)
    return (
        ("keyed", f"SELECT {key} AS agg_level, dt, qty AS value FROM {source}"),
        ("starts", "SELECT agg_level, MIN(dt) AS start_dt FROM keyed WHERE value > 0 GROUP BY 1"),
        ("hist", """SELECT s.agg_level, d.dt, COALESCE(k.value, 0) AS value,
            dayofweek(d.dt) + 1 AS dayofweek, s.start_dt
            FROM starts s JOIN (SELECT DISTINCT dt FROM keyed) d ON d.dt >= s.start_dt
            LEFT JOIN keyed k ON k.agg_level = s.agg_level AND k.dt = d.dt"""),
    )


def year_match_ctes(spec: SeriesSpec, start: dt.date, end: dt.date, capped: bool = True):
    weekly = spec.freq == "week"
    step, quarter, h = spec.days_per_period, spec.window, spec.horizon
    on_period = "cal_dt = fscl_wk_end_dt" if weekly else "TRUE"
    same_year = years_back("a.d", "a.back")
    next_year = years_back("a.d", "a.back - 1")

    def diff(a: str, b: str) -> str:
        return f"({week(a)} - {week(b)})" if weekly else f"({a} - {b})"

    growth = "CASE WHEN p90 IS NOT NULL AND comp_fctr > p90 THEN p50 ELSE comp_fctr END"
    return (
        *history_ctes(spec),
        ("pairs", f"""SELECT a.d AS snpsht, b.d AS eval_dt,
            {diff(same_year, 'b.d')} AS d1, {diff(next_year, 'b.d')} AS d2
            FROM (SELECT cal_dt AS d, back FROM cal, (SELECT range AS back FROM range(0, 7)) y
                  WHERE {on_period} AND cal_dt BETWEEN {lit(start)} AND {lit(end)}
                  AND cal_dt >= (SELECT MIN(dt) FROM hist) AND cal_dt <= {lit(AS_OF)}) a
            JOIN (SELECT cal_dt AS d FROM cal WHERE {on_period} AND cal_dt BETWEEN
                  (SELECT MIN(dt) FROM hist) AND (SELECT MAX(dt) FROM hist)) b
            ON year(a.d) - year(b.d) = a.back AND a.d > b.d"""),
        ("dated", f"""SELECT snpsht, eval_dt, GREATEST(d1, d2) % 52 AS off,
            year(snpsht) - year(eval_dt + CAST({step} * (GREATEST(d1, d2) % 52) AS INTEGER)) AS yr
            FROM pairs WHERE d1 BETWEEN 1 AND {quarter} OR d2 BETWEEN 1 AND {quarter}"""),
        ("periods", f"""SELECT p.snpsht, p.snpsht + CAST({step} * s.step AS INTEGER) AS fcst,
            p.eval_dt, p.yr, p.off FROM dated p
            JOIN (SELECT snpsht, yr FROM dated GROUP BY 1, 2 HAVING COUNT(*) = {quarter}) w
            USING (snpsht, yr) CROSS JOIN (SELECT range AS step FROM range(0, {h})) s"""),
        ("samples", """SELECT p.snpsht, p.fcst, h.dt, h.agg_level, h.value, p.yr,
            h.value / NULLIF(SUM(h.value) OVER
            (PARTITION BY p.snpsht, p.fcst, p.yr, h.agg_level), 0) AS share
            FROM hist h JOIN periods p ON h.dt = p.eval_dt"""),
        ("comparison", f"""SELECT t.snpsht, t.fcst, k.agg_level, t.yr,
            SUM(c.value) AS cur_value, SUM(p.value) AS prev_value,
            COALESCE(CASE
                WHEN SUM(c.value) <= {quarter} AND SUM(p.value) <= {quarter}
                    OR SUM(c.value) < SUM(p.value) THEN AVG(c.value) / NULLIF(AVG(p.value), 0)
                ELSE AVG(c.value) / NULLIF(AVG(CASE WHEN p.value < 1 THEN 1 ELSE p.value END), 0)
                END, 1) AS comp_fctr,
            1 / NULLIF(SUM((COALESCE(c.share, 0) - COALESCE(p.share, 0)) ** 2), 0) AS similarity
            FROM (SELECT a.snpsht, a.fcst, b.yr, a.eval_dt AS ty, b.eval_dt AS py
                  FROM periods a JOIN periods b ON a.snpsht = b.snpsht AND a.fcst = b.fcst
                  AND a.off = b.off WHERE a.yr = 0 AND b.yr <> 0) t
            CROSS JOIN (SELECT DISTINCT agg_level FROM samples) k
            JOIN starts s ON s.agg_level = k.agg_level
            LEFT JOIN samples c ON c.dt = t.ty AND c.snpsht = t.snpsht AND c.fcst = t.fcst
                AND c.agg_level = k.agg_level
            LEFT JOIN samples p ON p.dt = t.py AND p.snpsht = t.snpsht AND p.fcst = t.fcst
                AND p.agg_level = k.agg_level
            GROUP BY t.snpsht, t.fcst, k.agg_level, t.yr, s.start_dt
            HAVING MIN(t.py) >= s.start_dt"""),
        ("spread", """SELECT a.snpsht, a.agg_level, quantile_cont(b.comp_fctr, 0.1) AS p10,
            quantile_cont(b.comp_fctr, 0.5) AS p50, quantile_cont(b.comp_fctr, 0.9) AS p90
            FROM comparison a JOIN comparison b ON a.agg_level = b.agg_level
            AND b.snpsht < a.snpsht AND b.snpsht > CAST(a.snpsht - to_years(1) AS DATE)
            AND a.fcst - a.snpsht = b.fcst - b.snpsht GROUP BY 1, 2"""),
        ("growth", f"""SELECT c.snpsht, c.fcst, c.agg_level, c.yr, c.similarity, s.p10, s.p50, s.p90,
            {growth if capped else 'c.comp_fctr'} AS comp_fctr
            FROM comparison c LEFT JOIN spread s USING (snpsht, agg_level)"""),
        ("weights", """SELECT *, similarity / NULLIF(SUM(similarity) OVER
            (PARTITION BY snpsht, fcst, agg_level), 0) AS weight,
            COUNT(*) OVER (PARTITION BY snpsht, fcst, agg_level) AS years FROM growth"""),
        ("unmatched", """SELECT snpsht, agg_level FROM (
            SELECT DISTINCT snpsht, agg_level, 0 AS known FROM samples
            UNION ALL SELECT DISTINCT snpsht, agg_level, 1 FROM weights)
            GROUP BY 1, 2 HAVING MAX(known) = 0"""),
    )


def forecast1_sql(spec: SeriesSpec, fill: str = "0.0") -> str:
    names = ", ".join(
        f"split_part(f.agg_level, '|', {i + 1}) AS {k}" for i, k in enumerate(spec.keys)
    )
    back = years_back("w.fcst", "year(w.fcst) - year(h.dt)")
    return f"""SELECT f.snpsht, f.fcst, f.agg_level, COALESCE(f.f1, 0) AS forecast1,
        CAST({fill} AS DOUBLE) AS forecast2, CAST({fill} AS DOUBLE) AS forecast3,
        CAST(NULL AS DOUBLE) AS forecast4, CAST(NULL AS DOUBLE) AS one_forecast,
        h.value AS actual, {names}
        FROM (
            SELECT w.snpsht, w.fcst, w.agg_level, SUM(h.value * w.weight * w.comp_fctr) AS f1
            FROM hist h JOIN weights w ON h.agg_level = w.agg_level
            AND year(h.dt) = year(w.fcst) - w.yr AND {week(back)} = {week('h.dt')}
            AND dayofweek(w.fcst) = dayofweek(h.dt) WHERE w.years > 1 GROUP BY 1, 2, 3
            UNION ALL
            SELECT s.snpsht, s.fcst, s.agg_level, AVG(s.value) FROM samples s
            JOIN (SELECT DISTINCT snpsht, agg_level, fcst FROM weights WHERE years <= 1) w
            USING (snpsht, agg_level, fcst) WHERE s.yr = 0 GROUP BY 1, 2, 3
            UNION ALL
            SELECT s.snpsht, s.fcst, s.agg_level, AVG(s.value) FROM samples s
            JOIN unmatched USING (snpsht, agg_level) GROUP BY 1, 2, 3
        ) f LEFT JOIN hist h ON h.dt = f.fcst AND h.agg_level = f.agg_level"""


def _holiday(month: int, day: int) -> str:
    def on(d: str) -> str:
        return f"(month({d}) = {month} AND day({d}) = {day})"

    w = "dayofweek(cal_dt)"
    return (
        f"({on('cal_dt')} AND {w} BETWEEN 1 AND 5 OR {on('(cal_dt - 1)')} AND {w} = 1 "
        f"OR {on('(cal_dt + 1)')} AND {w} = 5)"
    )


def season_ctes(spec: SeriesSpec) -> tuple[tuple[str, str], ...]:
    lags = ", ".join(f"('{kind}', {n})" for kind, n in spec.season_lags)
    daily = """SELECT cal_dt AS dt, 'DAILY' AS type, COALESCE(d.h, d.b, d.a,
        CAST(dayofweek(cal_dt) + 1 AS VARCHAR)) AS season,
        COALESCE(d.h, d.b, d.a) IS NOT NULL AS holiday_flg FROM near_days d UNION ALL """
    on_period = "cal_dt = fscl_wk_end_dt" if spec.freq == "week" else "TRUE"
    first = spec.season_lags[0][0]
    return (
        ("near_days", f"""SELECT *, 'BEFORE ' || LEAD(h) OVER (ORDER BY cal_dt) AS b,
            'AFTER ' || LAG(h) OVER (ORDER BY cal_dt) AS a FROM (SELECT *,
            CASE WHEN {_holiday(1, 1)} THEN 'NEW YEARS'
                 WHEN month(cal_dt) = 11 AND day(cal_dt) BETWEEN 22 AND 28 AND dayofweek(cal_dt) = 4
                 THEN 'THANKSGIVING' WHEN {_holiday(12, 25)} THEN 'CHRISTMAS' END AS h FROM cal)"""),
        ("near_weeks", """SELECT *, 'BEFORE ' || LEAD(h) OVER (ORDER BY fscl_wk_end_dt) AS b,
            'AFTER ' || LAG(h) OVER (ORDER BY fscl_wk_end_dt) AS a
            FROM (SELECT fscl_wk_end_dt, MAX(h) AS h, MAX(fscl_wk_nbr) AS nbr
                  FROM near_days GROUP BY 1)"""),
        ("seasons", (daily if spec.freq == "day" else "") + f"""SELECT cal_dt AS dt, 'WEEKLY' AS type,
            COALESCE(w.h, w.b, w.a, CAST(LEAST(w.nbr, 52) AS VARCHAR)) AS season,
            COALESCE(w.h, w.b, w.a) IS NOT NULL AS holiday_flg
            FROM near_days JOIN near_weeks w USING (fscl_wk_end_dt) WHERE {on_period}"""),
        ("season_cal", f"""SELECT dt, holiday_flg, ROW_NUMBER() OVER (ORDER BY dt) AS dt_rnk,
            LEAD(dt) OVER (ORDER BY dt) AS next_dt, list(dt) OVER (ORDER BY dt
            ROWS BETWEEN 1 FOLLOWING AND {spec.horizon} FOLLOWING) AS fcst_dts
            FROM seasons WHERE type = '{first}'"""),
        ("lag_types", f"SELECT * FROM (VALUES {lags}) v(type, lags)"),
        ("ordinary", """SELECT dt, ROW_NUMBER() OVER (ORDER BY dt) AS rnk
            FROM season_cal WHERE NOT holiday_flg"""),
        ("smooth_cal", """SELECT t.type, a.dt, b.dt AS smooth_dt FROM ordinary a CROSS JOIN lag_types t
            JOIN ordinary b ON b.rnk BETWEEN a.rnk - (t.lags - 1) // 2 AND a.rnk + (t.lags - 1) // 2
            UNION ALL SELECT t.type, dt, dt FROM season_cal CROSS JOIN lag_types t WHERE holiday_flg"""),
    )


def series_ctes(spec: SeriesSpec) -> tuple[tuple[str, str], ...]:
    pad = (spec.max_lags - 1) // 2
    n, h = spec.num_periods, spec.horizon
    return (
        *history_ctes(spec)[:1],
        *season_ctes(spec),
        ("summed", "SELECT agg_level, dt, SUM(value) AS qty FROM keyed GROUP BY 1, 2"),
        ("limits", """SELECT s.agg_level, MIN(c.dt_rnk) AS lo,
            (SELECT MAX(c.dt_rnk) FROM summed s JOIN season_cal c USING (dt)) AS hi
            FROM summed s JOIN season_cal c USING (dt) WHERE s.qty > 0 GROUP BY 1"""),
        ("padded", f"""SELECT l.agg_level, c.dt, c.next_dt, c.dt_rnk BETWEEN l.lo AND l.hi
            AS fcst_crt_dt_flg,
            CASE WHEN c.dt_rnk BETWEEN l.lo AND l.hi THEN COALESCE(s.qty, 0.0) END AS qty
            FROM limits l JOIN season_cal c
            ON c.dt_rnk BETWEEN l.lo - {pad} AND l.hi + {pad + h}
            LEFT JOIN summed s ON s.agg_level = l.agg_level AND s.dt = c.dt"""),
        ("clipped", """SELECT p.*, CASE WHEN p.qty IS NOT NULL
            THEN LEAST(GREATEST(p.qty, q.lo), q.hi) END AS adj_qty
            FROM padded p JOIN (SELECT agg_level, quantile_cont(qty, 0.01) AS lo,
                quantile_cont(qty, 0.99) AS hi FROM padded GROUP BY 1) q USING (agg_level)"""),
        ("series", f"""SELECT *, AVG(adj_qty) OVER w AS period_avg_qty,
            COUNT(adj_qty) OVER w AS period_count_qty FROM clipped WINDOW w AS
            (PARTITION BY agg_level ORDER BY dt ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"""),
        ("deviations", f"""SELECT s.agg_level, s.dt, c.type, c.season,
            CASE WHEN s.period_count_qty = {n} THEN s.adj_qty - s.period_avg_qty END AS dev
            FROM series s JOIN seasons c USING (dt)"""),
        ("seasonality", """SELECT agg_level, dt, type, season,
            (SUM(dev) OVER g - COALESCE(dev, 0)) / NULLIF(COUNT(dev) OVER g
            - CASE WHEN dev IS NULL THEN 0 ELSE 1 END, 0) AS seasonal_qty
            FROM deviations WINDOW g AS (PARTITION BY agg_level, type, season)"""),
        ("weighted", """SELECT a.agg_level, a.dt, a.type, c.seasonal_qty,
            0.5 ** ABS((COUNT(*) OVER g - 1) / 2.0 - (ROW_NUMBER() OVER o - 1)) AS w_long,
            CASE WHEN (COUNT(*) OVER g - 1) / 2.0 = ROW_NUMBER() OVER o - 1 THEN 1.0 ELSE 0.0 END
            AS w_short
            FROM seasonality a JOIN smooth_cal b ON a.type = b.type AND a.dt = b.dt
            LEFT JOIN seasonality c ON c.agg_level = a.agg_level AND c.type = a.type
                AND c.dt = b.smooth_dt
            WINDOW g AS (PARTITION BY a.agg_level, a.dt, a.type),
                o AS (PARTITION BY a.agg_level, a.dt, a.type ORDER BY b.smooth_dt)"""),
        ("smoothed", """SELECT agg_level, dt, SUM(long_s) AS smoothed_seasonal_qty,
            SUM(short_s) AS seasonal_qty FROM (SELECT agg_level, dt, type,
                SUM(w_long * seasonal_qty) / NULLIF(SUM(w_long), 0) AS long_s,
                SUM(w_short * seasonal_qty) / NULLIF(SUM(w_short), 0) AS short_s
                FROM weighted GROUP BY 1, 2, 3) GROUP BY 1, 2"""),
    )


DESEASON_SQL = """SELECT s.agg_level, s.dt, s.fcst_crt_dt_flg, s.qty, s.adj_qty,
    COALESCE(m.smoothed_seasonal_qty, m.seasonal_qty, 0) AS smoothed_seasonal_qty,
    s.adj_qty - COALESCE(m.smoothed_seasonal_qty, m.seasonal_qty, 0) AS deseasonalized_adj_qty,
    COALESCE(m.seasonal_qty, 0) AS seasonal_qty,
    s.adj_qty - COALESCE(m.seasonal_qty, 0) AS st_deseasonalized_adj_qty
    FROM series s JOIN smoothed m USING (agg_level, dt)"""
DESEASON_COLUMNS = (
    "agg_level:s, dt:d, fcst_crt_dt_flg:b, qty:f8, adj_qty:f8, smoothed_seasonal_qty:f8, "
    "deseasonalized_adj_qty:f8, seasonal_qty:f8, st_deseasonalized_adj_qty:f8"
)
FACT_COLUMNS = (
    "snpsht:d, fcst:d, agg_level:s, forecast1:f, forecast2:f, forecast3:f, forecast4:f, "
    "one_forecast:f, actual:f, "
)

# Smoothing: one problem per series and stretch, a golden-section search as a
# recursion over its steps, and the series itself as a fold over time.
_G = "1.618033988::DOUBLE"


def _cost(alpha: str) -> str:
    """Squared one-step errors of a stretch; ``w`` tells which points count."""
    return f"""list_reduce(pts, lambda a, b: {{'x': b.x, 'w': b.w,
        'level': {alpha} * b.x + (1.0::DOUBLE - {alpha}) * a.level,
        'cost': a.cost + b.w * ((b.x - a.level) * (b.x - a.level))}}).cost"""


_ALPHAS = ("alpha", "alpha_h1", "alpha_h2", "alpha_q1", "alpha_q2", "alpha_q3", "alpha_q4")
SMOOTHING_CTES = (
    ("deseason", DESEASON_SQL.replace("SELECT s.agg_level,", "SELECT s.next_dt, s.agg_level,", 1)),
    ("nested", """SELECT *, n - 1 AS last, n // 2 AS h, n // 4 AS q FROM (SELECT agg_level, COUNT(*) AS n,
        list(dt ORDER BY dt) AS dts, list(deseasonalized_adj_qty ORDER BY dt) AS x,
        list(st_deseasonalized_adj_qty ORDER BY dt) AS y FROM deseason WHERE fcst_crt_dt_flg GROUP BY 1)"""),
    ("stretches", """SELECT agg_level, CASE WHEN s.p < 3 THEN x ELSE y END AS v, s.p AS p, s.lo AS lo, s.hi AS hi
        FROM (SELECT *, unnest([{'p': 0, 'lo': 0, 'hi': last}, {'p': 1, 'lo': 0, 'hi': h}, {'p': 2, 'lo': h + 1, 'hi': last},
            {'p': 3, 'lo': 0, 'hi': q}, {'p': 4, 'lo': q + 1, 'hi': 2 * q}, {'p': 5, 'lo': 2 * q + 1, 'hi': 3 * q},
            {'p': 6, 'lo': 3 * q + 1, 'hi': last}]) AS s FROM nested)"""),
    ("points", """SELECT agg_level, p, list_transform(v, lambda x, i: {'x': x,
        'w': CASE WHEN i - 1 BETWEEN greatest(lo, 1) AND hi THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END,
        'level': x, 'cost': 0.0::DOUBLE}) AS pts FROM stretches"""),
    ("search", f"""SELECT agg_level, p, 0.0::DOUBLE AS l, 1.0::DOUBLE AS r, m, {_cost('m')} AS c
        FROM (SELECT *, (1.0::DOUBLE + {_G} * 0.0::DOUBLE) / ({_G} + 1.0::DOUBLE) AS m FROM points)
        UNION ALL
        SELECT agg_level, p, CASE WHEN (pc < c) = (probe > m) THEN least(m, probe) ELSE l END,
            CASE WHEN (pc < c) = (probe > m) THEN r ELSE greatest(m, probe) END,
            CASE WHEN pc < c THEN probe ELSE m END, CASE WHEN pc < c THEN pc ELSE c END
        FROM (SELECT s.*, {_cost('probe')} AS pc FROM (SELECT *, l + (r - m) AS probe FROM search
              WHERE r - l >= 0.01::DOUBLE) s JOIN points USING (agg_level, p))"""),
    ("solved", "SELECT agg_level, p, (l + r) / 2 AS a FROM search WHERE r - l < 0.01::DOUBLE"),
    ("levelled", """SELECT agg_level, p, a, list_reduce(list_transform(v, lambda x: [x]),
        lambda u, b: u || [a * b[1] + (1.0::DOUBLE - a) * u[len(u)]]) AS lv FROM stretches JOIN solved USING (agg_level, p)"""),
    ("spread_out", "SELECT agg_level, " + ", ".join(
        f"any_value(a) FILTER (WHERE p = {p}) AS {name}, any_value(lv) FILTER (WHERE p = {p}) AS l{p}"
        for p, name in enumerate(_ALPHAS)) + " FROM levelled GROUP BY 1"),
    ("fitted", f"""SELECT agg_level, dts[t + 1] AS dt, {', '.join(_ALPHAS)},
        CASE WHEN t = 0 THEN NULL WHEN t = last THEN l0[t + 1] WHEN t > h THEN l1[t + 1] ELSE l2[t + 1] END
        AS fcst_deseasonalized_qty,
        CASE WHEN t = 0 THEN NULL WHEN t > 3 * q AND t < last THEN l5[t + 1] WHEN t > 2 * q AND t <= 3 * q THEN l4[t + 1]
            WHEN t > q AND t <= 2 * q THEN l3[t + 1] ELSE l6[t + 1] END AS st_fcst_deseasonalized_qty
        FROM (SELECT *, unnest(range(n)) AS t FROM nested JOIN spread_out USING (agg_level))"""),
)


def outlook_ctes(spec: SeriesSpec) -> tuple[tuple[str, str], ...]:
    """Forecasts 2 and 3: a level plus the seasons of the dates that follow."""
    ahead = " UNION ALL ".join(
        f"""SELECT agg_level, dt, next_dt, fcst_crt_dt_flg, LEAD(dt, {k}) OVER w AS fcst,
        LEAD(smoothed_seasonal_qty, {k}) OVER w AS long_season, LEAD(seasonal_qty, {k}) OVER w AS short_season
        FROM deseason WINDOW w AS (PARTITION BY agg_level ORDER BY dt)""" for k in range(1, spec.horizon + 1))
    return (
        ("ahead", ahead),
        ("outlook", """SELECT agg_level, next_dt AS snpsht, fcst, fcst_deseasonalized_qty + long_season AS f2,
            st_fcst_deseasonalized_qty + short_season AS f3 FROM ahead JOIN fitted USING (agg_level, dt)
            WHERE fcst_crt_dt_flg AND fcst IS NOT NULL"""),
    )


def together(*groups: tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    """CTEs of several groups, those that they share once."""
    return tuple({name: text for group in groups for name, text in group}.items())


def created_sql(fill: str = "0.0") -> str:
    return f"""SELECT f.* REPLACE (CASE WHEN o.snpsht IS NOT NULL THEN o.f2 ELSE f.forecast2 END AS forecast2,
        CASE WHEN o.snpsht IS NOT NULL THEN o.f3 ELSE f.forecast3 END AS forecast3)
        FROM ({forecast1_sql(SPEC, fill)}) f LEFT JOIN outlook o
        ON f.snpsht = o.snpsht AND f.fcst = o.fcst AND f.agg_level = o.agg_level"""


SERIES_FITS = together(series_ctes(SPEC), SMOOTHING_CTES, outlook_ctes(SPEC))

SELECTION_CTES = (
    ("selection", f"""SELECT fcst, agg_level, actual, GREATEST(COALESCE(forecast1, 0), 0) AS forecast1,
        COALESCE(forecast2, 0) AS forecast2,
        CASE WHEN forecast3 IS NOT NULL THEN GREATEST(forecast3, 0) END AS forecast3,
        COALESCE(ABS(COALESCE(forecast1, 0) - actual) / NULLIF(actual, 0), 1) AS mape1,
        COALESCE(ABS(COALESCE(forecast2, 0) - actual) / NULLIF(actual, 0), 1) AS mape2,
        COALESCE(ABS(COALESCE(forecast3, 0) - actual) / NULLIF(actual, 0), 1) AS mape3
        FROM fact WHERE snpsht = fcst AND fcst <= {lit(AS_OF)}"""),
)


def _past(n: int, suffix: str, deviations: bool) -> str:
    columns = ", ".join(
        f"CAST(SUM(CAST(ROUND(mape{i} * 1e9) AS HUGEINT)) AS DOUBLE) / COUNT(mape{i}) / 1e9 AS avg{i}{suffix}"
        + (f", STDDEV_SAMP(ROUND(mape{i} * 1e9) / 1e9) AS sd{i}{suffix}" if deviations else "")
        for i in (1, 2, 3)
    )
    empty = ", ".join("NULL" for _ in range(6 if deviations else 3))
    return f"""SELECT a.fcst, b.agg_level, {columns}
        FROM (SELECT cal_dt AS fcst FROM cal WHERE cal_dt = fscl_wk_end_dt
              AND cal_dt <= {lit(AS_OF)}) a
        JOIN selection b ON {week('a.fcst')} - {week('b.fcst')} BETWEEN 1 AND {n} GROUP BY 1, 2
        UNION ALL SELECT (SELECT MIN(fcst) FROM selection), agg_level, {empty}
        FROM (SELECT DISTINCT agg_level FROM selection)"""


def _strict_least(names: list[str]) -> str:
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"CASE WHEN {known} THEN LEAST({', '.join(names)}) END"


STAT_KINDS = (("avg", "", 1), ("avg", "_short", 1), ("avg", "_long", 1), ("sd", "", 0), ("sd", "_long", 0))
_STATS = []
for _kind, _suffix, _default in STAT_KINDS:
    _raw = [f"{_kind}{i}{_suffix}" for i in (1, 2, 3)]
    _low = _strict_least(_raw)
    _STATS.append(f"{_low} AS least_{_kind}{_suffix}")
    for _i, _name in zip((1, 2, 3), _raw, strict=True):
        _STATS.append(f"COALESCE({_name}, {_default}) AS {_name}_")
        _STATS.append(f"COALESCE({_name}, {_default}) - ({_low}) AS least_{_name}")
STAT_NAMES = [
    name
    for kind, suffix, _ in STAT_KINDS
    for name in (
        f"least_{kind}{suffix}",
        *[n for i in (1, 2, 3) for n in (f"{kind}{i}{suffix}", f"least_{kind}{i}{suffix}")],
    )
]
STATS_CTES = (
    *SELECTION_CTES,
    ("medium", _past(6, "", True)),
    ("short", _past(2, "_short", False)),
    ("long", _past(52, "_long", True)),
    ("joined", f"""SELECT d.*, e.time_rank,
        CASE WHEN mape1 > mape2 AND mape3 > mape2 THEN 'forecast2'
             WHEN mape2 > mape3 AND mape1 > mape3 THEN 'forecast3'
             WHEN mape2 > mape1 AND mape3 > mape1 THEN 'forecast1'
             ELSE 'Default - FORECAST2' END AS best_forecast, {', '.join(_STATS)}
        FROM medium a JOIN long b USING (fcst, agg_level) JOIN short c USING (fcst, agg_level)
        JOIN selection d USING (fcst, agg_level)
        JOIN (SELECT fcst, ROW_NUMBER() OVER (ORDER BY fcst) AS time_rank
              FROM (SELECT DISTINCT fcst FROM selection)) e USING (fcst)"""),
    ("stats", f"""SELECT a.best_forecast AS prev_best_forecast, b.fcst, b.agg_level, b.actual,
        b.forecast1, b.forecast2, b.forecast3, b.mape1, b.mape2, b.mape3, b.best_forecast, b.time_rank,
        {', '.join(f'b.{n if n.startswith("least") else n + "_"} AS {n}' for n in STAT_NAMES)}
        FROM joined b LEFT JOIN joined a ON a.agg_level = b.agg_level
        AND b.time_rank - a.time_rank = 1"""),
)
_G = ["least_avg1", "least_avg2", "least_avg3"]
_LOW = _strict_least(_G)


def _pick(f1: str, f2: str, f3: str, tie: str, tie2: str | None = None) -> str:
    return f"""CASE WHEN ({_LOW}) = least_avg2 AND (least_avg1 = least_avg2 OR least_avg2 = least_avg3)
            THEN {tie2 or f2}
        WHEN ({_LOW}) = least_avg3 AND least_avg1 = least_avg3 THEN {tie}
        WHEN ({_LOW}) = least_avg2 THEN {f2} WHEN ({_LOW}) = least_avg3 THEN {f3}
        WHEN ({_LOW}) = least_avg1 THEN {f1} END"""


_MISS = [f"ABS(forecast{i} - COALESCE(actual, 0))" for i in (1, 2, 3)]
RULES_CTES = (
    *STATS_CTES,
    ("past", f"""SELECT COALESCE({_pick('COALESCE(forecast1, 0)', 'forecast2',
            'COALESCE(forecast3, 0)', 'COALESCE(forecast1, 0)')}, 0) AS one_value,
        {_pick("'Forecast1'", "'Forecast2'", "'Forecast3'", "'Default - Forecast1'",
               "'Default - Forecast2'")} AS one_selection,
        actual, forecast1, forecast2, forecast3, fcst, agg_level, least_avg1, least_avg2, least_avg3,
        CASE WHEN LEAST({', '.join(_MISS)}) = {_MISS[1]} THEN forecast2
             WHEN LEAST({', '.join(_MISS)}) = {_MISS[0]} THEN forecast1
             WHEN LEAST({', '.join(_MISS)}) = {_MISS[2]} THEN forecast3 END AS best_value
        FROM stats WHERE fcst <= {lit(AS_OF)}"""),
)
RULES_SQL = f"""SELECT * FROM past UNION ALL
    SELECT COALESCE({_pick('COALESCE(a.forecast1, 0)', 'a.forecast2', 'COALESCE(b.forecast3, 0)',
        'COALESCE(b.forecast3, 0)')}, 0), c.one_selection, a.actual, COALESCE(a.forecast1, 0),
        COALESCE(a.forecast2, 0), COALESCE(b.forecast3, 0), a.fcst, a.agg_level, NULL, NULL, NULL, NULL
    FROM fact a JOIN fact b ON a.agg_level = b.agg_level AND a.fcst = b.snpsht AND b.fcst = b.snpsht
    JOIN (SELECT agg_level, one_selection, least_avg1, least_avg2, least_avg3
          FROM past WHERE fcst = {lit(AS_OF)}) c ON c.agg_level = a.agg_level
    WHERE a.snpsht = {lit(AS_OF)} AND a.fcst >= {lit(AS_OF)}"""


def applied_sql(table: str) -> str:
    """The table's one_forecast by the decision of its snapshot's period."""
    return f"""SELECT a.* REPLACE ({_pick('a.forecast1', 'a.forecast2', 'a.forecast3', 'a.forecast1')}
        AS one_forecast) FROM {table} a LEFT JOIN (SELECT fcst AS at, agg_level AS k, least_avg1,
        least_avg2, least_avg3 FROM past) b ON a.snpsht = b.at AND a.agg_level = b.k"""


def reading(table: str, ctes: tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    """The selection's CTEs over another table than the fact."""
    return tuple((name, text.replace("FROM fact WHERE", f"FROM {table} WHERE")) for name, text in ctes)


RUN_CTES = together(
    year_match_ctes(SPEC, SNAP_START, SNAP_END), SERIES_FITS, (("created", created_sql()),), reading("created", RULES_CTES))
PERIOD_CTES = together(
    year_match_ctes(SPEC, AS_OF, AS_OF, capped=False), SERIES_FITS, (("fresh", created_sql("NULL")),
    ("whole", f"SELECT * FROM fact WHERE snpsht < {lit(AS_OF)} UNION ALL BY NAME SELECT * FROM fresh")),
    reading("whole", RULES_CTES))


# --- Spark side ----------------------------------------------------------


def _hist(i: Inputs):
    return materialise(fc.densify_history(i.history, SPEC), "hist")


def _snap(i: Inputs, hist):
    periods = fc.snapshot_periods(i.cal, hist, SPEC, SNAP_START, SNAP_END, AS_OF)
    return materialise(periods, "periods")


SPAN = (SNAP_START, SNAP_END)


def _comparison(i: Inputs):
    hist = _hist(i)
    return fc.year_comparison(_snap(i, hist), hist, i.cal, SPEC, SPAN)


def _samples(i: Inputs, hist):
    periods = fc.forecast_periods(i.cal, hist, SPEC, SNAP_START, SNAP_END, AS_OF)
    return fc.forecast_samples(hist, periods, SPEC)


def _forecast1(raw, cal, spec, start, end):
    return fc.staged_forecast1(raw, cal, spec, start, end, AS_OF)


def _series(i: Inputs):
    return fc.prepare_series(i.history, fc.seasonal_calendar(i.cal, SPEC), SPEC)


def _smoothed(i: Inputs):
    weights = smoothing_weights(fc.seasonal_calendar(i.cal, SPEC), SPEC)
    return fc.smooth_seasonality(fc.seasonality(_series(i), SPEC), weights)


def _calendar_of(raw, cal, spec):
    """Seasons of the dates present in the data."""
    dates = raw.select("dt").distinct()
    seasons = semi_in(fc.seasonal_calendar(cal, spec), dates, ["dt"])
    text = F.concat_ws(",", F.transform("fcst_dts", lambda d: d.cast("string")))
    return seasons.withColumn("fcst_dts", text).select(
        "*", F.explode("seasonality").alias("s")
    ).drop("holiday_flg").select("*", "s.type", "s.season", "s.holiday_flg")


def _calendar_sql(source: str) -> str:
    return f"""SELECT s.dt, s.type, s.season, s.holiday_flg, c.dt_rnk, c.next_dt,
        list_aggregate(list_transform(c.fcst_dts, lambda d: CAST(d AS VARCHAR)), 'string_agg', ',')
        AS fcst_dts FROM seasons s JOIN season_cal c USING (dt)
        WHERE s.dt IN (SELECT dt FROM {source})"""


def _stats(i: Inputs):
    return fc.rolling_error_stats(fc.selection_base(i.fact, AS_OF, SPEC), SPEC, AS_OF)


def _external(i: Inputs):
    return i.fact.select("snpsht", "fcst", "agg_level", (F.col("forecast1") * 1.1).alias("value"))


def _percent_error(v: str) -> str:
    return f"CASE WHEN actual <> 0 THEN ROUND(ABS({v} - actual) / actual, 4) END"


OUTCOME_COLUMNS = (
    "agg_level:s, fcst:d, forecast_chosen:s, reward:f, one_value:f, actual:f, "
    "one_value_mape:f, forecast1_mape:f, forecast2_mape:f, forecast3_mape:f")
OUTCOMES_SQL = f"""SELECT agg_level, fcst, 'forecast' || i AS forecast_chosen, one_value, actual,
    {_percent_error('one_value')} AS one_value_mape,
    {', '.join(f"{_percent_error(f'forecast{i}')} AS forecast{i}_mape" for i in (1, 2, 3))},
    CASE WHEN width = 0 THEN 0 WHEN gain > 0.5 THEN LEAST(100 * gain * width, 100)
        ELSE GREATEST(-100 * (1 - gain) * width, -100) END AS reward
    FROM (SELECT *, 1 - ([mape1, mape2, mape3][i] - LEAST(mape1, mape2, mape3)) / NULLIF(width, 0) AS gain,
        [forecast1, forecast2, forecast3][i] AS one_value
        FROM (SELECT *, GREATEST(mape1, mape2, mape3) - LEAST(mape1, mape2, mape3) AS width FROM stats)
        CROSS JOIN (VALUES (1), (2), (3)) v(i)) WHERE fcst <= {lit(AS_OF)}"""
SEASON_COLUMNS = (
    "dt:d, type:s, season:s, holiday_flg:b, dt_rnk:i, next_dt:d, fcst_dts:s"
)
SERIES_COLUMNS = (
    "agg_level:s, dt:d, next_dt:d, fcst_crt_dt_flg:b, qty:f8, adj_qty:f8, period_avg_qty:f8, "
    "period_count_qty:i"
)
WEEKLY = year_match_ctes(SPEC, SNAP_START, SNAP_END)
COMPARED = "snpsht:d, fcst:d, agg_level:s, yr:i, "
STATS_COLUMNS = (
    "prev_best_forecast:s, fcst:d, agg_level:s, actual:f, forecast1:f, forecast2:f, forecast3:f, "
    "mape1:f, mape2:f, mape3:f, best_forecast:s, time_rank:i, "
    + ", ".join(f"{n}:f" for n in STAT_NAMES)
)
RULES_COLUMNS = (
    "one_value:f, one_selection:s, actual:f, forecast1:f, forecast2:f, forecast3:f, fcst:d, "
    "agg_level:s, least_avg1:f, least_avg2:f, least_avg3:f, best_value:f"
)
KEYS = "p_brand:s, p_type:s"
FULL_FACT = FACT_COLUMNS + KEYS
REPORT_FROM, REPORT_TO = dt.date(2000, 6, 4), AS_OF


def _report_sql(expr: str) -> str:
    forecasts = ("forecast1", "forecast2", "forecast3", "forecast4", "one_forecast")
    return f"""SELECT snpsht, fcst, {', '.join(expr.format(f=f) for f in forecasts)},
        SUM(actual) AS actual_value FROM fact
        WHERE {week('fcst')} - {week('snpsht')} = 1 AND actual IS NOT NULL
        AND fcst BETWEEN {lit(REPORT_FROM)} AND {lit(REPORT_TO)} GROUP BY 1, 2"""


def _adjusted_sql() -> str:
    def diff(f: str, n: int) -> str:
        return f"LAG({f} - actual, {n}) OVER w"

    columns = []
    for f in ("forecast1", "forecast2", "forecast3"):
        d = [diff(f, n) for n in (1, 2, 3)]
        same = " OR ".join("(" + " AND ".join(f"{x} {s} 0" for x in d) + ")" for s in "<>")
        move = f"{f} - ({d[0]} + {d[1]} + {d[2]}) / 3"
        columns.append(
            f"FLOOR(CASE WHEN {same} THEN GREATEST({move}, 0) ELSE {f} END + 0.5) AS {f}"
        )
    own = f"snpsht = fcst AND fcst BETWEEN {lit(REPORT_FROM)} AND {lit(REPORT_TO)}"
    return f"""SELECT snpsht, fcst, agg_level, {', '.join(columns)}, forecast4, one_forecast, actual,
        p_brand, p_type FROM fact WHERE {own}
        WINDOW w AS (PARTITION BY agg_level ORDER BY fcst)
        UNION ALL SELECT snpsht, fcst, agg_level, forecast1, forecast2, forecast3, forecast4,
        one_forecast, actual, p_brand, p_type FROM fact WHERE NOT ({own})"""


def _state(i: Inputs):
    """The state before the last date of the history, written, and that date's rows."""
    last = i.history.agg(F.max("dt").alias("dt"))
    before = fc.series_state(i.history.join(last, "dt", "left_anti"), SPEC).write(stage_path(i.spark, "state"))
    return before, i.history.join(last, "dt", "left_semi")


def _period(i: Inputs):
    return fc.run_period(_earlier(i), *_state(i), i.cal, SPEC, AS_OF)[0]


def _advanced(i: Inputs):
    series = fc.advance(*_state(i), SPEC).series
    return series.select("agg_level", F.size("entries").alias("series"), F.explode("entries").alias("e")).select("*", "e.*")


def _earlier(i: Inputs):
    """The fact as it stood before the current period."""
    return i.fact.filter(F.col("snpsht") < F.lit(AS_OF))


QUERIES = [
    Query("f0_densify_history", lambda i: fc.densify_history(i.history, SPEC), "agg_level:s, dt:d, value:f, dayofweek:i",
          "SELECT * FROM hist", ("history",), history_ctes(SPEC)),
    Query("f0_densify_history_daily", lambda i: fc.densify_history(i.daily_history, DAILY),
          "agg_level:s, dt:d, value:f, dayofweek:i", "SELECT * FROM hist", ("daily_history",),
          history_ctes(DAILY)),
    Query("f1_1_forecast_periods",
          lambda i: fc.forecast_periods(i.cal, _hist(i), SPEC, SNAP_START, SNAP_END, AS_OF),
          "snpsht:d, fcst:d, eval_dt:d, yr:i, offset:i",
          'SELECT *, off AS "offset" FROM periods', ("history", "cal"), WEEKLY),
    Query("f1_2_forecast_samples",
          lambda i: _samples(i, _hist(i)),
          "snpsht:d, fcst:d, dt:d, agg_level:s, value:f, share:f8",
          "SELECT * FROM samples", ("history", "cal"), WEEKLY),
    Query("f1_3_year_comparison", lambda i: fc.with_targets(_comparison(i), SPEC),
          COMPARED + "cur_value:f, prev_value:f, comp_fctr:f, similarity:f4",
          "SELECT * FROM comparison", ("history", "cal"), WEEKLY),
    Query("f1_4_similarity_weights",
          lambda i: fc.with_targets(fc.similarity_weights(_comparison(i)), SPEC),
          COMPARED + "weight:f, comp_fctr:f", "SELECT * FROM weights", ("history", "cal"),
          year_match_ctes(SPEC, SNAP_START, SNAP_END, capped=False)),
    Query("f1_5_cap_growth", lambda i: fc.with_targets(fc.cap_growth(_comparison(i), SPEC), SPEC),
          COMPARED + "comp_fctr:f, p10:f, p50:f, p90:f", "SELECT * FROM growth",
          ("history", "cal"), WEEKLY),
    Query("f1_6_forecast1", lambda i: _forecast1(i.history, i.cal, SPEC, SNAP_START, SNAP_END),
          FULL_FACT, forecast1_sql(SPEC), ("history", "cal"), WEEKLY),
    Query("f1_6_forecast1_daily",
          lambda i: _forecast1(i.daily_history, i.cal, DAILY, DAILY_START, DAILY_END),
          FACT_COLUMNS + "p_brand:s", forecast1_sql(DAILY), ("daily_history", "cal"),
          year_match_ctes(DAILY, DAILY_START, DAILY_END)),
    Query("f1_i_forecast1_incremental",
          lambda i: fc.forecast1_incremental(_earlier(i), i.history, i.cal, SPEC, AS_OF), FULL_FACT,
          f"""SELECT snpsht, fcst, agg_level, forecast1, forecast2, forecast3, forecast4, one_forecast,
          actual, p_brand, p_type FROM fact WHERE snpsht < DATE '{AS_OF.isoformat()}'
          UNION {forecast1_sql(SPEC, 'NULL')}""",
          ("history", "cal", "fact"), year_match_ctes(SPEC, AS_OF, AS_OF, capped=False)),
    Query("f2_1_seasonal_calendar", lambda i: _calendar_of(i.history, i.cal, SPEC), SEASON_COLUMNS,
          _calendar_sql("history"), ("history", "cal"), season_ctes(SPEC)),
    Query("f2_1_seasonal_calendar_daily", lambda i: _calendar_of(i.daily_history, i.cal, DAILY),
          SEASON_COLUMNS, _calendar_sql("daily_history"), ("daily_history", "cal"),
          season_ctes(DAILY)),
    Query("f2_2_smoothing_calendar",
          lambda i: semi_in(
              fc.smoothing_calendar(fc.seasonal_calendar(i.cal, SPEC), SPEC),
              i.history.select("dt").distinct(), ["dt"]),
          "type:s, dt:d, smooth_dt:d",
          "SELECT * FROM smooth_cal WHERE dt IN (SELECT dt FROM history)", ("history", "cal"),
          season_ctes(SPEC)),
    Query("f2_3_prepare_series", _series, SERIES_COLUMNS, "SELECT * FROM series",
          ("history", "cal"), series_ctes(SPEC)),
    Query("f2_4_seasonality", lambda i: fc.seasonality(_series(i), SPEC),
          "agg_level:s, dt:d, type:s, season:s, seasonal_qty:f8", "SELECT * FROM seasonality",
          ("history", "cal"), series_ctes(SPEC)),
    Query("f2_5_smooth_seasonality", _smoothed,
          "agg_level:s, dt:d, smoothed_seasonal_qty:f8, seasonal_qty:f8", "SELECT * FROM smoothed",
          ("history", "cal"), series_ctes(SPEC)),
    Query("f2_6_deseasonalise", lambda i: deseasonalised(i.history, i.cal, SPEC),
          DESEASON_COLUMNS, DESEASON_SQL, ("history", "cal"), series_ctes(SPEC)),
    Query("f2_6_deseasonalise_daily", lambda i: deseasonalised(i.daily_history, i.cal, DAILY),
          DESEASON_COLUMNS, DESEASON_SQL, ("daily_history", "cal"), series_ctes(DAILY)),
    Query("f2_7_exp_smooth_fit",
          lambda i: fc.exp_smooth_fit(deseasonalised(i.history, i.cal, SPEC)),
          "agg_level:s, dt:d, fcst_deseasonalized_qty:f, st_fcst_deseasonalized_qty:f, alpha:f, "
          "alpha_h1:f, alpha_h2:f, alpha_q1:f, alpha_q2:f, alpha_q3:f, alpha_q4:f",
          "SELECT * FROM fitted", ("history", "cal"), together(series_ctes(SPEC), SMOOTHING_CTES)),
    Query("f2_8_forecast23",
          lambda i: create_fact(i.history, i.cal, SPEC, SNAP_START, SNAP_END, AS_OF), FULL_FACT,
          created_sql(), ("history", "cal"), together(WEEKLY, SERIES_FITS)),
    Query("f4_external_forecast", lambda i: fc.external_forecast(i.fact, _external(i)), FULL_FACT,
          "SELECT * REPLACE (forecast1 * 1.1 AS forecast4) FROM fact", ("history", "fact")),
    Query("f4_external_as_third",
          lambda i: fc.selection_base(
              fc.external_forecast(i.fact, _external(i)), AS_OF, SPEC, use_forecast4=True),
          "fcst:d, agg_level:s, actual:f, forecast1:f, forecast2:f, forecast3:f, mape3:f",
          f"""SELECT fcst, agg_level, actual, GREATEST(COALESCE(forecast1, 0), 0) AS forecast1,
          COALESCE(forecast2, 0) AS forecast2, GREATEST(forecast1 * 1.1, 0) AS forecast3,
          COALESCE(ABS(forecast1 * 1.1 - actual) / NULLIF(actual, 0), 1) AS mape3
          FROM fact WHERE snpsht = fcst AND fcst <= {lit(AS_OF)}""", ("history", "fact")),
    Query("f5_selection_base", lambda i: fc.selection_base(i.fact, AS_OF, SPEC),
          "fcst:d, agg_level:s, actual:f, forecast1:f, forecast2:f, forecast3:f, mape1:f, mape2:f, "
          "mape3:f", "SELECT * FROM selection", ("history", "fact"), SELECTION_CTES),
    Query("f6_rolling_error_stats", _stats, STATS_COLUMNS, "SELECT * FROM stats",
          ("history", "cal", "fact"), STATS_CTES),
    Query("f7_rules_selection",
          lambda i: fc.rules_selection(_stats(i), i.fact, i.cal, SPEC, AS_OF), RULES_COLUMNS,
          RULES_SQL, ("history", "cal", "fact"), RULES_CTES),
    Query("f7_apply_rules",
          lambda i: fc.apply_rules(i.fact, fc.rules_selection(_stats(i), i.fact, i.cal, SPEC, AS_OF)),
          FULL_FACT,
          applied_sql("fact"),
          ("history", "cal", "fact"), RULES_CTES),
    Query("f8_bandit_selection", lambda i: fc.bandit_selection(_stats(i), AS_OF, seed=7),
          OUTCOME_COLUMNS),
    Query("f8_choice_outcomes", lambda i: fc.choice_outcomes(_stats(i), AS_OF), OUTCOME_COLUMNS,
          OUTCOMES_SQL, ("history", "cal", "fact"), STATS_CTES),
    Query("f8_u_apply_selection",
          lambda i: fc.apply_selection(i.fact, _stats(i).select(
              "fcst", "agg_level", F.col("best_forecast").alias("forecast_chosen"))), FULL_FACT,
          """SELECT a.* REPLACE (CASE b.best_forecast WHEN 'forecast1' THEN a.forecast1
          WHEN 'forecast2' THEN a.forecast2 WHEN 'forecast3' THEN a.forecast3 END AS one_forecast)
          FROM fact a LEFT JOIN stats b ON a.snpsht = b.fcst AND a.agg_level = b.agg_level""",
          ("history", "cal", "fact"), STATS_CTES),
    Query("f9_reactive_adjust", lambda i: fc.reactive_adjust(i.fact, REPORT_FROM, REPORT_TO),
          FULL_FACT, _adjusted_sql(), ("history", "fact")),
    Query("f10_percent_adjust", lambda i: fc.percent_adjust(i.fact, 15, -1, SeriesSpec(
        "dt", ("p_brand", "p_type"), "qty", "week", 3, round_output=True, nonneg_output=True)),
          FULL_FACT,
          """SELECT * REPLACE (ROUND(GREATEST(forecast1 * 0.85, 0)) AS forecast1,
          ROUND(GREATEST(forecast2 * 0.85, 0)) AS forecast2,
          ROUND(GREATEST(forecast3 * 0.85, 0)) AS forecast3) FROM fact""", ("history", "fact")),
    Query("f11_error_report", lambda i: fc.error_report(i.fact, 2, REPORT_FROM, REPORT_TO, SPEC),
          "snpsht:d, fcst:d, forecast1_mape:f, forecast2_mape:f, forecast3_mape:f, forecast4_mape:f, "
          "one_forecast_mape:f",
          _report_sql("SUM(ABS({f} - actual)) / NULLIF(SUM(actual), 0) AS {f}_mape"),
          ("history", "fact")),
    Query("f11_value_report", lambda i: fc.value_report(i.fact, 2, REPORT_FROM, REPORT_TO, SPEC),
          "snpsht:d, fcst:d, forecast1_value:f4, forecast2_value:f4, forecast3_value:f4, "
          "forecast4_value:f4, one_forecast_value:f4, actual_value:f4",
          _report_sql("SUM({f}) AS {f}_value"), ("history", "fact")),
    Query("f12_run_forecast",
          lambda i: fc.run_forecast(i.history, i.cal, SPEC, SNAP_START, SNAP_END, AS_OF), FULL_FACT,
          applied_sql("created"), ("history", "cal"), RUN_CTES),
    Query("f12_run_forecast_bandit",
          lambda i: fc.run_forecast(
              i.history, i.cal, SPEC, SNAP_START, SNAP_END, AS_OF, method="bandit", seed=7),
          FULL_FACT),
    Query("f12_run_incremental",
          lambda i: fc.run_incremental(_earlier(i), i.history, i.cal, SPEC, AS_OF), FULL_FACT,
          f"""SELECT * FROM fact WHERE snpsht < {lit(AS_OF)} UNION ALL BY NAME {applied_sql('fresh')}""",
          ("history", "cal", "fact"), PERIOD_CTES),
    Query("f12_run_period", _period, FULL_FACT,
          f"""SELECT * FROM fact WHERE snpsht < {lit(AS_OF)} UNION ALL BY NAME {applied_sql('fresh')}""",
          ("history", "cal", "fact"), PERIOD_CTES),
    Query("f12_series_state", _advanced, "agg_level:s, dt:d, value:f, series:i", """SELECT agg_level, dt, value,
          COUNT(*) OVER (PARTITION BY agg_level) AS series FROM keyed JOIN starts USING (agg_level) WHERE dt >= start_dt""",
          ("history",), history_ctes(SPEC)[:2]),
]
