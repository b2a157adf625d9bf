"""Pipeline inputs derived from the test tables, for Spark and for DuckDB.

Each input is one SELECT over the given tables.  The two engines share its
text; the few functions they spell differently come from an ``Engine``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockloom.calendar import covering_calendar
from stockloom.session import materialise
from stockloom.spec import SeriesSpec

AS_OF = dt.date(2001, 6, 3)
BULK_AS_OF = dt.date(2001, 11, 11)
SNAP_START, SNAP_END = dt.date(2001, 4, 1), dt.date(2001, 6, 3)
SPEC = SeriesSpec("dt", ("p_brand", "p_type"), "qty", "week", 3)
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class SparkText:
    """Spark spellings."""

    def add(self, d: str, n: str) -> str:
        return f"date_add({d}, CAST({n} AS INT))"

    def dow(self, d: str) -> str:
        return f"dayofweek({d})"

    def key_list(self, c: str) -> str:
        return f"concat_ws(',', transform(array_sort(collect_list({c})), x -> CAST(x AS STRING)))"


class DuckText:
    """DuckDB spellings."""

    def add(self, d: str, n: str) -> str:
        return f"({d} + CAST({n} AS INTEGER))"

    def dow(self, d: str) -> str:
        return f"(dayofweek({d}) + 1)"

    def key_list(self, c: str) -> str:
        return f"string_agg(CAST({c} AS VARCHAR), ',' ORDER BY {c})"


SHIP = "CAST(l_shipdate AS DATE)"
# Stores grow with the data; a pair of store and SKU has some dozen lines.
STORE, SKU = "l_suppkey", "l_partkey % 50"
BASE = "DATE '1995-01-01'"


def _lit(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def week_end(e, d: str = SHIP) -> str:
    return e.add(d, f"(8 - {e.dow(d)}) % 7")


def history(e) -> str:
    return f"""SELECT p_brand, p_type, {week_end(e)} AS dt, SUM(l_quantity) AS qty
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey GROUP BY 1, 2, 3"""


def daily_history(e) -> str:
    return f"""SELECT p_brand, {SHIP} AS dt, SUM(l_quantity) AS qty
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey GROUP BY 1, 2"""


def fact(e) -> str:
    """A forecast fact with simple forecasts, two targets after each snapshot."""
    def row(step: int) -> str:
        return f"""SELECT a.dt AS snpsht, {e.add('a.dt', str(7 * step))} AS fcst,
            concat(a.p_brand, '|', a.p_type) AS agg_level,
            a.qty * (60 + 10 * (EXTRACT(DAY FROM a.dt) % 9)) / 100 + CAST(1 + 3 * {step} AS DOUBLE) / 3 AS forecast1,
            a.qty * (70 + 10 * (EXTRACT(DAY FROM a.dt) % 7)) / 100 + CAST(11 AS DOUBLE) / 9 AS forecast2,
            a.qty * (40 + 10 * (EXTRACT(DAY FROM a.dt) % 11)) / 100 - CAST(25 AS DOUBLE) / 7 AS forecast3,
            CAST(NULL AS DOUBLE) AS forecast4, CAST(NULL AS DOUBLE) AS one_forecast,
            b.qty AS actual, a.p_brand AS p_brand, a.p_type AS p_type
            FROM {{history}} a LEFT JOIN {{history}} b
            ON a.p_brand = b.p_brand AND a.p_type = b.p_type
            AND b.dt = {e.add('a.dt', str(7 * step))}
            WHERE a.dt <= {_lit(AS_OF)}"""
    return " UNION ALL ".join(f"({row(s)})" for s in range(3))


def items(e) -> str:
    sku = "p_partkey % 50"
    return f"""SELECT {sku} AS sku, {e.add(BASE, 'p_partkey % 3')} AS sku_crt_dt,
        MIN(concat('"', p_name, '"')) AS sku_desc,
        CAST(20 + {sku} % 10 AS INT) AS dept_nbr,
        CASE WHEN {sku} % 25 <> 24 THEN concat('00', CAST(20 + {sku} % 10 AS STRING)) END AS sub_dept,
        CAST({sku} % 4 AS INT) AS class_nbr, concat('CLASS ', CAST({sku} % 4 AS STRING)) AS class_desc,
        CAST({sku} % 3 AS INT) AS sub_class_nbr,
        concat('SUB ', CAST({sku} % 3 AS STRING)) AS sub_class_desc,
        CAST(CASE WHEN {sku} % 10 = 9 THEN 400 ELSE 100 * (1 + {sku} % 3) END AS INT) AS sku_stat_cd
        FROM {{part}} GROUP BY {sku}, p_partkey % 3"""


def prefs(e) -> str:
    return """SELECT DISTINCT sub_dept, class_nbr, sub_class_nbr AS sc_nbr,
        CASE (class_nbr + sub_class_nbr) % 4 WHEN 1 THEN 'FULL' WHEN 2 THEN 'BYPASS' ELSE '1' END
        AS jlq_method, 2 + sub_class_nbr AS min_jlq_freq, 10 AS min_jlq_size,
        CASE WHEN class_nbr = 0 THEN 0 ELSE 45 END AS max_jlq_size
        FROM {items} WHERE sub_dept IS NOT NULL"""


def trans_lines(e) -> str:
    return f"""SELECT {STORE} AS store, {SHIP} AS sls_dt,
        CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'S' END AS trans_type,
        CASE WHEN l_linenumber % 7 = 6 THEN 'VD' ELSE 'NO' END AS trans_status,
        l_orderkey % 97 = 0 AS training, l_linenumber % 3 AS register, l_orderkey AS trans_id,
        {SKU} AS sku,
        {e.add(BASE, "CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 2 END")} AS sku_crt_dt,
        CASE WHEN l_orderkey % 53 = 0 THEN -l_quantity ELSE l_quantity - (l_linenumber % 2) / 2.0 END
        AS unt_sls FROM {{lineitem}}"""


def demand(e) -> str:
    return f"""SELECT {STORE} AS store, {SKU} AS sku, {e.add(BASE, '2')} AS sku_crt_dt,
        fscl_yr_wk_key_val AS fscl_yr_wk, SUM(l_quantity) * 9 / 10 - 1.5 AS corrected_qty
        FROM {{lineitem}} JOIN {{cal}} ON {SHIP} = cal_dt GROUP BY 1, 2, 3, 4"""


def inventory(as_of: dt.date) -> Callable:
    def text(e) -> str:
        sk, st = "sku", "store"

        def some(null_when: str, value: str) -> str:
            return f"CASE WHEN {null_when} THEN NULL ELSE CAST({value} AS DOUBLE) END"

        return f"""SELECT store, sku, {e.add(BASE, '2')} AS sku_crt_dt,
        {e.add(_lit(as_of), '-2 - age')} AS cal_dt,
        CAST(20 + {sk} % 10 AS INT) AS dept_nbr,
        concat('00', CAST(20 + {sk} % 10 AS STRING)) AS sub_dept,
        CAST({sk} % 4 AS INT) AS class_nbr, CAST({sk} % 3 AS INT) AS sub_class_nbr,
        CAST(CASE WHEN {sk} % 10 = 9 THEN 400 ELSE 100 * (1 + {sk} % 3) END AS INT) AS sku_stat_cd,
        substr('ABCDE', CAST(1 + ({st} + {sk}) % 5 AS INT), 1) AS vlcty_cd,
        CAST(CASE WHEN ({st} + 2 * {sk}) % 17 = 0 THEN 2 ELSE 1 END AS INT) AS rmeth_cd,
        CAST(CASE WHEN ({st} + {sk}) % 11 = 0 THEN 0 ELSE 1 END AS INT) AS reple_ind,
        CASE WHEN ({st} * 3 + {sk}) % 13 = 0 THEN 'N' ELSE 'Y' END AS ok_to_ord,
        CAST(n % 37 AS DOUBLE) AS oh_qty, CAST(q % 29 AS DOUBLE) AS oo_qty,
        {some(f'({st} + {sk}) % 6 = 0', f'{sk} % 5')} AS expctd_alloc_qty,
        {some(f'({st} + {sk}) % 6 = 1', f'{st} % 3')} AS conf_alloc_qty,
        CAST(1 + ({sk} * 37) % 500 AS DOUBLE) / 4 AS curr_retl_amt,
        {some(f'({st} + {sk}) % 7 = 0', 'q % 23')} AS lead_tm_qty,
        CAST(n % 9 AS DOUBLE) AS rev_tm_qty,
        CAST(CASE WHEN ({st} + {sk}) % 19 <> 3 THEN 5 + ({st} + {sk}) % 40 END AS INT) AS lead_tm_days,
        CAST(1 + {sk} % 14 AS INT) AS rev_tm_days,
        {some(f'({st} + {sk}) % 29 = 1', f'({st} * {sk}) % 31')} AS sfty_stk_qty,
        CAST(60 + ({st} * 5 + {sk}) % 80 AS DOUBLE) AS max_inv_qty,
        CAST(1 + {sk} % 6 AS DOUBLE) AS buy_uom_qty,
        {some(f'({st} + {sk}) % 4 = 0', f'({st} + {sk}) % 5')} AS cmtd_min_map_qty,
        {some(f'({st} + {sk}) % 4 = 1', f'{st} % 4')} AS cmtd_min_xmer_qty,
        {some(f'({st} + {sk}) % 4 = 2', f'{sk} % 3')} AS cmtd_min_bulk_wall_qty,
        {some(f'({st} + {sk}) % 4 = 3', f'{sk} % 7')} AS mohq_prst_qty,
        {some(f'{sk} % 3 = 0', f'({st} * 2 + {sk}) % 19')} AS mohq_ad_qty,
        {some(f'{sk} % 3 = 1', f'({st} * 3 + {sk}) % 23')} AS mohq_jlq_qty,
        {some(f'{sk} % 3 = 2', f'({st} * 5 + {sk}) % 17')} AS mohq_fld_rqst_qty,
        {some(f'{st} % 3 = 0', f'({st} * 7 + {sk}) % 13')} AS mohq_wos_min_qty,
        {some(f'{st} % 3 = 1', f'({st} + {sk} * 3) % 11')} AS mohq_spprt_new_item_qty,
        {some(f'{st} % 3 = 2', f'({st} + {sk} * 5) % 41')} AS mohq_bulk_dspl_qty,
        {some(f'{st} % 5 = 0', f'({st} + {sk} * 7) % 9')} AS mohq_non_spi_prst_qty,
        {some(f'{st} % 5 = 1', f'({st} + {sk}) % 8')} AS mohq_inv_soln_team_qty,
        CAST(({st} * 11 + {sk}) % 70 AS DOUBLE) AS subparm_min_oh_qty,
        CAST(CASE WHEN ({st} + {sk}) % 3 = 0 THEN 1707 ELSE 1703 END AS INT) AS wng_mohq_subparm_cd,
        {some(f'({st} + {sk}) % 5 = 2', f'{sk} % 4')} AS subparm_cmtd_stk_qty,
        {some(f'({st} + {sk}) % 5 = 3', f'{sk} % 6')} AS cmtd_stk_qty,
        CAST(q % 90 AS DOUBLE) AS trgt_oh_qty
        FROM (SELECT {STORE} AS store, {SKU} AS sku, l_linenumber % 2 AS age,
              COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS q
              FROM {{lineitem}} GROUP BY 1, 2, 3) pairs"""
    return text


def weekly(e) -> str:
    return f"""SELECT {STORE} AS store, {SKU} AS sku, {week_end(e)} AS week_end_dt,
        CAST(COUNT(*) AS DOUBLE) AS oh_qty, CAST(1 + MAX(({SKU} * 37) % 500) AS DOUBLE) / 4 AS curr_retl_amt,
        SUM(l_quantity) * 9 / 4 AS r8w_avg_sls_amt
        FROM {{lineitem}} GROUP BY 1, 2, 3"""


def factors(e) -> str:
    weeks = ", ".join(
        f"CAST(50 + 5 * ((sku * 3 + store + {i}) % 21) AS DOUBLE) / 100 AS sf{i:02d}"
        for i in range(1, 53)
    )
    return f"""SELECT sku, store, {e.add(_lit(AS_OF), '-7 * (1 + age)')} AS sf_calc_date, {weeks}
        FROM (SELECT DISTINCT {SKU} AS sku, {STORE} AS store, l_linenumber % 2 AS age
              FROM {{lineitem}}) pairs"""


def stores(e) -> str:
    return """SELECT s_suppkey AS store, MIN(s_nationkey) AS mkt, 1000 + s_suppkey AS bu_id,
        CASE WHEN s_suppkey % 20 = 18 THEN DATE '2000-01-01' ELSE DATE '9999-12-31' END AS cls_dt
        FROM {supplier} GROUP BY s_suppkey"""


def lead_parms(e) -> str:
    return f"""SELECT 1000 + {STORE} AS bu_id, {SKU} AS sku, CAST(1 + l_linenumber % 3 AS INT) AS parm_cd,
        SUM(l_quantity) / 64 AS dec_val, COUNT(*) AS int_val FROM {{lineitem}} GROUP BY 1, 2, 3"""


def prices(e) -> str:
    return f"""SELECT {SKU} AS sku, s_nationkey AS mkt, CAST(1 + l_linenumber % 2 AS INT) AS tier,
        {SHIP} AS eff_bgn, CASE WHEN {SKU} = 23 THEN DATE '2001-11-01'
            ELSE {e.add(SHIP, f'CASE WHEN {SKU} % 13 = 0 THEN 8 ELSE 180 END')} END AS eff_end,
        MAX(l_quantity) AS vol_disc_min_qty, MAX(l_discount) AS vol_disc_pct,
        CASE WHEN ({SKU} + s_nationkey) % 9 = 0 THEN DATE '2001-01-01' ELSE DATE '9999-12-31' END
        AS row_end_dt,
        CASE WHEN ({SKU} + s_nationkey) % 8 = 1 THEN 'D' ELSE 'I' END AS row_action
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
        GROUP BY {SKU}, s_nationkey, 1 + l_linenumber % 2, {SHIP}"""


def overrides(e) -> str:
    def d(days: int) -> str:
        return _lit(BULK_AS_OF + dt.timedelta(days=days))

    return f"""SELECT DISTINCT sku, sku % 20 AS str, CAST(1 + sku % 3 AS INT) AS ovrd_type,
        CAST(12 AS DOUBLE) AS ovrd_qty, CAST(18 AS DOUBLE) AS min_ovrd_qty,
        CAST(30 AS DOUBLE) AS max_ovrd_qty, {d(-30)} AS beg_dt,
        CASE WHEN sku % 14 = 0 THEN {d(-3)} ELSE {d(30)} END AS end_dt
        FROM {{items}} WHERE sku % 7 = 0"""


def settings(e) -> str:
    return """SELECT DISTINCT CAST(dept_nbr AS STRING) AS dept, class_nbr, sub_class_nbr AS sc_nbr,
        CASE WHEN (dept_nbr + class_nbr) % 6 = 0 THEN 'OFF' ELSE 'ON' END AS bulk_price_inv_feed,
        CAST(1 + sub_class_nbr AS DOUBLE) / 2 AS bulk_price_multiplier
        FROM {items} WHERE (class_nbr + sub_class_nbr) % 5 <> 4"""


def exclude(e) -> str:
    return "SELECT DISTINCT sku AS sku_nbr FROM {items} WHERE sku IN (5, 17)"


def velocity(e) -> str:
    return """SELECT DISTINCT store, sku, substr('ABCDE', CAST(1 + (store * 3 + sku) % 5 AS INT), 1)
        AS sku_vlcty_cd, dept_nbr AS mer_dept_nbr FROM {bulk_inventory}"""


def parms(e) -> str:
    nulls = ", ".join(
        f"CAST(NULL AS STRING) AS {c}"
        for c in ("store_group", "volume_id", "velocity_id", "sku_grp", "start_fscl_wk_nbr",
                  "end_fscl_wk_nbr", "ootl_reason_code")
    )
    return f"""SELECT 5 AS trumping_level, 2 AS type, {STORE} AS store, {SKU} AS sku,
        1709 AS parm_code, SUM(l_quantity) * 250 AS parm_value,
        '01/01/2001' AS eff_begin_date, '02/01/2001' AS eff_end_date, 'SSN' AS param_desc, {nulls},
        {e.add(week_end(e), '-6')} AS upload_dt FROM {{lineitem}} GROUP BY {STORE}, {SKU}, {week_end(e)}"""


def po(e) -> str:
    return f"""SELECT c_nationkey AS store, o_orderkey AS po,
        CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, SUM(l_quantity) AS cube,
        {e.key_list('l_partkey')} AS skus
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
        JOIN {{lineitem}} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3"""


def priority_skus(e) -> str:
    return "SELECT p_partkey AS sku FROM {part} WHERE p_size = 1"


def measures(e) -> str:
    return """SELECT CAST(user_id AS STRING) AS row_nbr, event_type AS measure_name, SUM(value) AS measure_value
        FROM {events} GROUP BY 1, 2
        UNION ALL SELECT 'All', event_type, SUM(value) FROM {events} GROUP BY 1, 2"""


BUILDERS: dict[str, Callable] = {
    "history": history, "daily_history": daily_history, "fact": fact, "items": items,
    "prefs": prefs, "trans_lines": trans_lines, "demand": demand,
    "inventory": inventory(AS_OF), "bulk_inventory": inventory(BULK_AS_OF), "weekly": weekly,
    "factors": factors, "stores": stores, "lead_parms": lead_parms, "prices": prices,
    "overrides": overrides, "settings": settings, "exclude": exclude, "velocity": velocity,
    "parms": parms, "po": po, "priority_skus": priority_skus, "measures": measures,
}
# Inputs an input is itself built from.
PARENTS = {
    "fact": ("history",), "prefs": ("items",), "demand": ("cal",), "overrides": ("items",),
    "settings": ("items",), "exclude": ("items",), "velocity": ("bulk_inventory",),
}


# Inputs that several steps of a pipeline read, written once as they would be
# in use.  For the factors there is a second reason: filters on 52 columns that
# are themselves expressions make the optimizer's constraint sets explode.
STORED = ("history", "daily_history", "fact", "factors", "inventory", "bulk_inventory", "po")


class Inputs:
    """Spark side: tables of one data folder and the inputs built from them.

    While ``shared`` is a dict, inputs are made once per folder and used by all
    queries; the bench does this to time operators without their inputs.
    """

    shared: dict[str, dict[str, DataFrame]] | None = None

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {} if self.shared is None else self.shared.setdefault(folder, {})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "cal":
            return covering_calendar(self.lineitem, "l_shipdate", 5, 5)
        if name == "trans":
            line = F.struct("sku", "sku_crt_dt", "unt_sls")
            basket = [c for c in self.trans_lines.columns if c not in ("sku", "sku_crt_dt", "unt_sls")]
            return self.trans_lines.groupBy(*basket).agg(F.collect_list(line).alias("dtl"))
        text = BUILDERS[name](SparkText())
        used = {t for t in (*TABLES, *PARENTS.get(name, ())) if "{" + t + "}" in text}
        made = self.spark.sql(text, **{t: getattr(self, t) for t in sorted(used)})
        return materialise(made, name) if name in STORED else made


CALENDAR_SQL = """
    SELECT cal_dt, cal_dt - CAST(wd - 1 AS INTEGER) AS fscl_wk_bgn_dt,
        cal_dt + CAST(7 - wd AS INTEGER) AS fscl_wk_end_dt, wk AS fscl_wk_nbr, prd AS fscl_prd_nbr,
        CASE WHEN prd = 12 THEN next_st - 1
             ELSE st + CAST(7 * (13 * q + CASE prd - 3 * q WHEN 1 THEN 4 WHEN 2 THEN 9 ELSE 13 END) - 1
                  AS INTEGER) END AS fscl_prd_end_dt,
        fy AS fscl_yr, CAST(fy * 100 + wk AS VARCHAR) AS fscl_yr_wk_key_val, wd AS day_of_wk_nbr
    FROM (
        SELECT *, 3 * q + CASE WHEN wk - 1 - 13 * q < 4 THEN 1 WHEN wk - 1 - 13 * q < 9 THEN 2 ELSE 3 END
            AS prd
        FROM (
            SELECT *, CASE WHEN (wk - 1) // 13 > 3 THEN 3 ELSE (wk - 1) // 13 END AS q
            FROM (
                SELECT d.cal_dt, y.fy, y.st, n.st AS next_st, ((dayofweek(d.cal_dt) + 6) % 7) + 1 AS wd,
                    (d.cal_dt - y.st) // 7 + 1 AS wk
                FROM (SELECT CAST(unnest(range(
                        (SELECT make_date(min(year(CAST(l_shipdate AS DATE))) - 5, 1, 1) FROM lineitem),
                        (SELECT make_date(max(year(CAST(l_shipdate AS DATE))) + 6, 1, 1) FROM lineitem),
                        INTERVAL 1 DAY)) AS DATE) AS cal_dt) d
                JOIN year_starts n ON n.fy = 1 + CASE WHEN d.cal_dt >=
                    (SELECT s.st FROM year_starts s WHERE s.fy = year(d.cal_dt))
                    THEN year(d.cal_dt) ELSE year(d.cal_dt) - 1 END
                JOIN year_starts y ON y.fy = n.fy - 1
            )))
"""
YEAR_STARTS_SQL = """
    SELECT fy, make_date(fy, 1, 29) + CAST((8 - dayofweek(make_date(fy, 1, 29))) % 7 AS INTEGER) AS st
    FROM (SELECT unnest(range((SELECT min(year(CAST(l_shipdate AS DATE))) - 8 FROM lineitem),
        (SELECT max(year(CAST(l_shipdate AS DATE))) + 9 FROM lineitem))) AS fy)
"""


def duck_ctes(names: list[str]) -> list[tuple[str, str]]:
    """CTEs for the named inputs and what they need, parents first."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        if name in out:
            return
        if name == "cal":
            out["year_starts"] = YEAR_STARTS_SQL
            out["cal"] = CALENDAR_SQL
            return
        for parent in PARENTS.get(name, ()):
            add(parent)
        text = BUILDERS[name](DuckText())
        out[name] = text.format(**{t: t for t in (*TABLES, *PARENTS.get(name, ()))})

    for name in names:
        add(name)
    return list(out.items())
