"""Large-basket and bulk-price queries with their reference SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.basic_queries import BUCKETS, SINGLES, bucket_sql, level_sql
from checks.inputs import AS_OF, BULK_AS_OF, Inputs
from checks.registry import Query
from stockloom.plans import baskets as bk
from stockloom.plans import bulk
from stockloom.session import materialise, stage_path
from stockloom.sources import append_history

DAY = f"DATE '{AS_OF.isoformat()}'"
BULK_DAY = f"DATE '{BULK_AS_OF.isoformat()}'"
PAIR = "store, sku, sku_crt_dt"
PAIR_COLUMNS = "store:i, sku:i, sku_crt_dt:d, "

LATEST = ("latest", """SELECT i.* FROM items i JOIN (SELECT sku, MAX(sku_crt_dt) AS sku_crt_dt FROM items GROUP BY 1) m
    USING (sku, sku_crt_dt)""")
ACTIVE = ("active", f"""SELECT d.store, a.sku, a.sku_crt_dt, replace(a.sku_desc, '"', '') AS sku_desc, a.dept_nbr,
    a.class_nbr, a.class_desc, a.sub_class_nbr, a.sub_class_desc FROM latest a
    JOIN (SELECT DISTINCT sku, sku_crt_dt, store FROM inventory WHERE cal_dt = {DAY} - 2 AND reple_ind = 1
          AND ok_to_ord = 'Y') d USING (sku, sku_crt_dt)
    JOIN prefs c ON a.sub_dept = c.sub_dept AND a.class_nbr = c.class_nbr AND a.sub_class_nbr = c.sc_nbr""")
BASKETS = ("baskets", f"""SELECT {PAIR}, fscl_yr_wk, item_qty FROM (
    SELECT t.store, t.sku, t.sku_crt_dt, register, trans_id, fscl_yr_wk_key_val AS fscl_yr_wk,
    CAST(CEIL(SUM(unt_sls)) AS BIGINT) AS item_qty FROM trans_lines t JOIN cal ON sls_dt = cal_dt
    JOIN active a ON a.store = t.store AND a.sku = t.sku AND a.sku_crt_dt = t.sku_crt_dt
    WHERE trans_type = 'S' AND trans_status = 'NO' AND NOT training AND unt_sls > 0
    AND sls_dt BETWEEN {DAY} - 364 AND {DAY} - 1 GROUP BY 1, 2, 3, 4, 5, 6) x""")
CAPPED = ("capped", f"""SELECT {PAIR}, fscl_yr_wk, CASE WHEN cap < item_qty THEN cap ELSE item_qty END AS item_qty
    FROM baskets LEFT JOIN (SELECT {PAIR}, fscl_yr_wk, CAST(FLOOR(corrected_qty) AS BIGINT) AS cap FROM demand
    WHERE corrected_qty >= 0) d USING ({PAIR}, fscl_yr_wk)""")
HIST = ("histogram", f"""SELECT {PAIR}, COUNT(*) OVER (PARTITION BY {PAIR}) AS max_pkey,
    ROW_NUMBER() OVER (PARTITION BY {PAIR} ORDER BY item_qty DESC) AS pkey, item_qty, COUNT(*) AS trans_cnt
    FROM capped GROUP BY {PAIR}, item_qty""")
SPLITS = ("splits", """SELECT n AS max_pkey, k2 AS k2_start, k3 AS k3_start FROM
    (SELECT DISTINCT max_pkey AS n FROM histogram) m JOIN (SELECT range AS k2 FROM range(2, 1000)) a
    ON k2 <= GREATEST(n - 1, 2) JOIN (SELECT range AS k3 FROM range(3, 1001)) b ON k3 > k2 AND k3 <= GREATEST(n, 3)""")


def _sums(values: str) -> str:
    groups = ("pkey < k2_start", "pkey >= k2_start AND pkey < k3_start", "pkey >= k3_start")
    return ", ".join(values.format(k=k + 1, cond=cond) for k, cond in enumerate(groups))


MEANS = ("means", f"""SELECT {PAIR}, max_pkey, k2_start, k3_start,
    {_sums('SUM(CASE WHEN {cond} THEN item_qty * trans_cnt END) / CAST(SUM(CASE WHEN {cond} THEN trans_cnt END) AS DOUBLE) AS k{k}_mean, CAST(SUM(CASE WHEN {cond} THEN trans_cnt END) AS BIGINT) AS k{k}_cnt')}
    FROM histogram JOIN splits USING (max_pkey) GROUP BY {PAIR}, max_pkey, k2_start, k3_start""")
ERRORS = ("errors", f"""SELECT {PAIR}, max_pkey, k2_start, k3_start, k1_mean, k1_cnt, k2_mean, k2_cnt, k3_mean, k3_cnt,
    {_sums('SQRT(SUM(CASE WHEN {cond} THEN (item_qty - k{k}_mean) ** 2 * trans_cnt END) / k{k}_cnt) AS k{k}_stddev')},
    ROUND(COALESCE(SUM(CASE WHEN pkey < k2_start THEN (item_qty - k1_mean) ** 2 * trans_cnt
        WHEN pkey < k3_start THEN (item_qty - k2_mean) ** 2 * trans_cnt
        ELSE (item_qty - k3_mean) ** 2 * trans_cnt END), 0), 6) AS sse
    FROM histogram JOIN means USING ({PAIR}, max_pkey)
    GROUP BY {PAIR}, max_pkey, k2_start, k3_start, k1_mean, k1_cnt, k2_mean, k2_cnt, k3_mean, k3_cnt""")
PER_K2 = ("per_k2", f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {PAIR}, k2_start
    ORDER BY sse, k3_start) AS place FROM errors) x WHERE place = 1""")
BEST = ("best", f"""SELECT {PAIR}, {DAY} AS last_upd_dt,
    k1_mean AS top_jlq, k1_stddev AS top_stddev, k1_cnt AS top_freq, k2_mean AS mid_jlq, k2_stddev AS mid_stddev,
    k2_cnt AS mid_freq, k3_mean AS bot_jlq, k3_stddev AS bot_stddev, k3_cnt AS bot_freq
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {PAIR} ORDER BY sse, k2_start, k3_start) AS rn FROM errors) x
    WHERE rn = 1""")


def _frequent(a: str, b: str, c: str) -> str:
    return f"""CASE WHEN top_freq >= min_jlq_freq THEN {a} WHEN top_freq + mid_freq >= min_jlq_freq THEN {b}
        WHEN top_freq + mid_freq + bot_freq >= min_jlq_freq THEN {c} END"""


CHOSEN = ("chosen", f"""SELECT a.store, a.sku, a.sku_crt_dt, a.last_upd_dt,
    {_frequent('top_jlq', 'mid_jlq', 'bot_jlq')} AS jlq, {_frequent('top_stddev', 'mid_stddev', 'bot_stddev')} AS stddev,
    {_frequent('top_freq', 'top_freq + mid_freq', 'top_freq + mid_freq + bot_freq')} AS freq
    FROM best a JOIN inventory b USING ({PAIR})
    JOIN prefs c ON b.sub_dept = c.sub_dept AND b.class_nbr = c.class_nbr AND b.sub_class_nbr = c.sc_nbr
    WHERE b.cal_dt = {DAY} - 2 AND b.reple_ind = 1 AND {_frequent('top_jlq', 'mid_jlq', 'bot_jlq')}
    BETWEEN min_jlq_size AND COALESCE(NULLIF(max_jlq_size, 0), 9999)""")
NEW_FACTORS = ("new_factors", """SELECT f.* FROM factors f JOIN (SELECT MAX(sf_calc_date) AS sf_calc_date FROM factors) m
    USING (sf_calc_date)""")
THIS_WEEK = ("this_week", f"SELECT fscl_wk_nbr FROM cal WHERE cal_dt = {DAY}")
# Week 17 of the fiscal year contains the run date, so weeks 19 to 22 count.
SEASONAL = ("seasonal", f"""SELECT *, CAST(LEAST(GREATEST(ROUND(freq * f4_sf), 3), 500) AS BIGINT) AS adj_freq FROM (
    SELECT a.*, CASE w.fscl_wk_nbr WHEN 17 THEN (sf19 + sf20 + sf21 + sf22) / 4
        WHEN 18 THEN (sf20 + sf21 + sf22 + sf23) / 4 END AS f4_sf,
    LEAST(e.rev_tm_days + e.lead_tm_days, 50) AS rtlt
    FROM chosen a JOIN new_factors d ON a.sku = d.sku AND a.store = d.store CROSS JOIN this_week w
    JOIN inventory e ON a.store = e.store AND a.sku = e.sku AND a.sku_crt_dt = e.sku_crt_dt
    WHERE e.cal_dt = {DAY} - 2 AND e.reple_ind = 1 AND e.rev_tm_days IS NOT NULL AND e.lead_tm_days IS NOT NULL) x
    WHERE f4_sf > 0.6""")
MULTIPLES = ("multiples", """SELECT rtlt, freq, 1.0 + (p0 + p1 < 0.85)::INT + (p0 + p1 + p2 < 0.85)::INT
    + (p0 + p1 + p2 + p3 < 0.85)::INT + (p0 + p1 + p2 + p3 + p4 < 0.85)::INT AS m
    FROM (SELECT *, EXP(-r) AS p0, EXP(-r) * r AS p1, EXP(-r) * r ** 2 / 2 AS p2, EXP(-r) * r ** 3 / 6 AS p3,
    EXP(-r) * r ** 4 / 24 AS p4 FROM (SELECT a.range AS rtlt, b.range AS freq, b.range * a.range / 364.0::DOUBLE AS r
    FROM range(0, 51) a CROSS JOIN range(3, 501) b) x) y""")
RESULT = ("minimums", """SELECT s.*, CAST(m.m AS DOUBLE) AS jlq_mult, CAST(CEIL(s.jlq * m.m + SQRT(m.m) * s.stddev) AS BIGINT) AS full_jlq
    FROM seasonal s JOIN multiples m ON s.rtlt = m.rtlt AND s.adj_freq = m.freq""")
UPLOAD = ("upload", f"""SELECT 5 AS trumping_level, 2 AS type, NULL AS store_group, NULL AS volume_id, NULL AS velocity_id,
    a.sku, NULL AS sku_grp, a.store, 1703 AS parm_code,
    CASE d.jlq_method WHEN '1' THEN CAST(CEIL(a.jlq) AS BIGINT) WHEN 'FULL' THEN a.full_jlq END AS parm_value,
    strftime(f.cal_dt, '%m/%d/%Y') AS eff_begin_date, strftime(f.cal_dt + 22, '%m/%d/%Y') AS eff_end_date,
    NULL AS start_fscl_wk_nbr, NULL AS end_fscl_wk_nbr, 'JLQ FW' || f.fscl_wk_nbr AS param_desc, NULL AS ootl_reason_code
    FROM minimums a JOIN latest g ON a.sku = g.sku AND a.sku_crt_dt = g.sku_crt_dt AND g.sub_dept IS NOT NULL
    JOIN prefs d ON g.sub_dept = d.sub_dept AND g.class_nbr = d.class_nbr AND g.sub_class_nbr = d.sc_nbr
    CROSS JOIN (SELECT c.cal_dt, c.fscl_wk_nbr FROM cal c JOIN cal w USING (fscl_yr_wk_key_val)
                WHERE w.cal_dt = {DAY} AND c.day_of_wk_nbr = 5) f
    WHERE d.jlq_method <> 'BYPASS'""")
LEAD = ("lead_demand", """SELECT s.store, p.sku, SUM(dec_val) AS lt_rt_qty, SUM(int_val) AS lt_rt_days
    FROM stores s JOIN lead_parms p USING (bu_id) WHERE p.parm_cd IN (1, 2) GROUP BY 1, 2""")
IMPACT = ("impact", f"""SELECT *, trgt_oh_qty * curr_retl_amt AS trgt_oh_amt, curr_outl_qty * curr_retl_amt AS curr_outl_amt,
    new_outl_qty * curr_retl_amt AS new_outl_amt,
    CEIL(GREATEST(curr_outl_qty - eff_oo_qty, 0) / buy_uom_qty) * buy_uom_qty AS curr_ord_qty,
    CEIL(GREATEST(new_outl_qty - eff_oo_qty, 0) / buy_uom_qty) * buy_uom_qty AS new_ord_qty
    FROM (SELECT a.* EXCLUDE (sub_dept), g.sub_dept, {level_sql(cap=False)} AS curr_outl_no_max_qty,
        {level_sql()} AS curr_outl_qty, {level_sql('d.parm_value')} AS new_outl_qty,
        oh_qty + oo_qty + COALESCE(expctd_alloc_qty, 0) + COALESCE(conf_alloc_qty, 0) AS eff_oo_qty
        FROM inventory a JOIN upload d ON a.sku = d.sku AND a.store = d.store AND d.parm_value <> 0
        JOIN latest g ON a.sku = g.sku AND a.sku_crt_dt = g.sku_crt_dt
        LEFT JOIN lead_demand e ON a.sku = e.sku AND a.store = e.store
        WHERE a.cal_dt = {DAY} - 2 AND a.reple_ind = 1 AND a.ok_to_ord = 'Y') x""")

BASKET_INPUTS = ("items", "inventory", "prefs", "trans_lines", "cal", "demand", "factors", "stores", "lead_parms")
TO_HIST = (LATEST, ACTIVE, BASKETS, CAPPED, HIST)
TO_BEST = (*TO_HIST, SPLITS, MEANS, ERRORS, PER_K2, BEST)
TO_SEASONAL = (*TO_BEST, CHOSEN, NEW_FACTORS, THIS_WEEK, SEASONAL)
TO_RESULT = (*TO_SEASONAL, MULTIPLES, RESULT)
TO_IMPACT = (*TO_RESULT, UPLOAD, LEAD, IMPACT)


def _lines(i: Inputs):
    return bk.basket_lines(i.trans, i.cal, bk.active_items(i.items, i.inventory, i.prefs, AS_OF), AS_OF)


def _hist(i: Inputs):
    return bk.qty_histogram(bk.demand_cap(_lines(i), i.demand))


def _best(i: Inputs):
    return bk.name_groups(bk.winning_split(_hist(i)), AS_OF)


def _chosen(i: Inputs):
    return bk.choose_cluster(_best(i), i.inventory, i.prefs, AS_OF)


def _seasonal(i: Inputs):
    return bk.seasonal_frequency(_chosen(i), i.factors, i.inventory, i.cal, AS_OF)


def _minimums(i: Inputs):
    return bk.basket_minimums(
        i.trans, i.items, i.inventory, i.prefs, i.demand, i.factors, bk.default_multiples(i.spark), i.cal, AS_OF)


def _upload(i: Inputs):
    return bk.parm_upload(_minimums(i), i.items, i.prefs, i.cal, AS_OF)


def _stamped(i: Inputs):
    """Weeks stamped on the minimums, appended to a history by week."""
    path = stage_path(i.spark, "minimums")
    append_history(bk.stamp_weeks(_minimums(i), i.cal, AS_OF), path, ["fscl_wk_end_dt"])
    return i.spark.read.parquet(path)


def _lead(i: Inputs):
    return bk.lead_review_demand(i.stores, i.lead_parms)


def _impact(i: Inputs):
    return i.inventory, materialise(_upload(i), "upload"), i.items, _lead(i), AS_OF


# --- bulk ----------------------------------------------------------------

PRICES = ("live_prices", """SELECT a.* FROM prices a JOIN (SELECT sku, mkt, tier, MAX(eff_bgn) AS eff_bgn FROM prices
    GROUP BY 1, 2, 3) b USING (sku, mkt, tier, eff_bgn)
    WHERE row_end_dt = DATE '9999-12-31' AND row_action = 'I'""")
PADDED = ("padded", """SELECT *, CASE length(dept) WHEN 2 THEN '00' || dept WHEN 3 THEN '0' || dept ELSE dept END AS pad
    FROM settings""")
MISSING_SQL = f"""SELECT DISTINCT a.sku, c.sub_dept, c.class_nbr, c.class_desc, c.sub_class_nbr, c.sub_class_desc,
    'ON' AS bulk_price_inv_feed, '1' AS bulk_price_multiplier
    FROM (SELECT DISTINCT sku FROM live_prices) a JOIN latest c USING (sku)
    LEFT JOIN padded e ON c.sub_dept = e.pad AND c.class_nbr = e.class_nbr AND c.sub_class_nbr = e.sc_nbr
    JOIN (SELECT DISTINCT sku FROM bulk_inventory WHERE cal_dt = {BULK_DAY} - 2 AND sku_stat_cd IN (100, 200, 300)
          AND reple_ind = 1) h USING (sku) WHERE e.sc_nbr IS NULL"""


def _tiers_sql(weeks_back: int) -> str:
    stock = "" if weeks_back else f"""JOIN bulk_inventory f ON a.sku = f.sku AND b.store = f.store
        AND f.cal_dt = {BULK_DAY} - 2 AND f.sku_stat_cd IN (100, 200, 300) AND f.reple_ind = 1"""
    extra = "" if weeks_back else ", f.sku_stat_cd, f.reple_ind"

    def rule(o: str) -> str:
        return f"""CASE {o}.ovrd_type WHEN 1 THEN {o}.ovrd_qty WHEN 2 THEN GREATEST({o}.min_ovrd_qty, a.vol_disc_min_qty)
            WHEN 3 THEN LEAST({o}.max_ovrd_qty, a.vol_disc_min_qty) END"""

    return f"""SELECT a.sku, a.mkt, c.sku_crt_dt, CASE WHEN g.sku IS NOT NULL THEN {rule('g')}
        WHEN h.sku IS NOT NULL THEN {rule('h')} ELSE a.vol_disc_min_qty END AS vol_disc_min_qty, a.vol_disc_pct,
        b.store AS loc, a.eff_end, a.eff_bgn, 1 AS mkt_lvl{extra}
        FROM live_prices a JOIN stores b USING (mkt)
        JOIN latest c ON a.sku = c.sku AND c.sku_stat_cd IN (100, 200, 300) {stock}
        JOIN (SELECT DISTINCT fscl_wk_bgn_dt AS bgn FROM cal WHERE cal_dt = {BULK_DAY} - {7 * weeks_back}) e
        ON e.bgn > a.eff_bgn AND e.bgn <= a.eff_end
        LEFT JOIN overrides g ON a.sku = g.sku AND b.store = g.str AND {BULK_DAY} BETWEEN g.beg_dt AND g.end_dt
        LEFT JOIN overrides h ON a.sku = h.sku AND {BULK_DAY} BETWEEN h.beg_dt AND h.end_dt
        WHERE a.tier = 1 AND b.cls_dt > {BULK_DAY}"""


NEW, LAST = ("new_tiers", _tiers_sql(0)), ("last_tiers", _tiers_sql(1))
STATUS = """CASE WHEN g.sku IS NULL THEN 'ADDED' WHEN b.sku IS NULL THEN 'REMOVED'
    WHEN b.vol_disc_min_qty < g.vol_disc_min_qty THEN 'REDUCED' WHEN b.vol_disc_min_qty > g.vol_disc_min_qty THEN 'INCREASED'
    WHEN b.vol_disc_min_qty = g.vol_disc_min_qty THEN 'NO CHANGE' END"""
NON_BULK = bucket_sql([s for s in SINGLES if s != "mohq_bulk_dspl_qty"])
MEASURED = ("measured", f"""SELECT DISTINCT a.sku, a.sku_crt_dt, a.store, {STATUS} AS status, a.curr_retl_amt,
    {' + '.join(f'COALESCE({b}, 0)' for b in BUCKETS)} AS com_min_qty,
    subparm_min_oh_qty, wng_mohq_subparm_cd, sfty_stk_qty, mohq_bulk_dspl_qty AS curr_bulk_min_qty,
    CASE WHEN sfty_stk_qty IS NOT NULL AND subparm_min_oh_qty IS NOT NULL THEN GREATEST(subparm_min_oh_qty, sfty_stk_qty) END
    AS curr_sysmohq, CASE WHEN sfty_stk_qty IS NOT NULL THEN {NON_BULK} END AS non_bulk_sysmohq,
    g.vol_disc_min_qty AS lw_bulk_price_qty, b.vol_disc_min_qty AS new_bulk_price_qty,
    COALESCE(b.vol_disc_min_qty * e.bulk_price_multiplier, 0) AS new_bulk_min_qty
    FROM bulk_inventory a LEFT JOIN new_tiers b ON a.sku = b.sku AND a.store = b.loc
    JOIN latest c ON a.sku = c.sku AND a.sku_crt_dt = c.sku_crt_dt AND c.sub_dept IS NOT NULL
    LEFT JOIN padded e ON c.sub_dept = e.pad AND c.class_nbr = e.class_nbr AND c.sub_class_nbr = e.sc_nbr
    LEFT JOIN exclude f ON a.sku = f.sku_nbr LEFT JOIN last_tiers g ON a.sku = g.sku AND a.store = g.loc
    WHERE (b.sku IS NOT NULL OR g.sku IS NOT NULL) AND e.bulk_price_inv_feed = 'ON' AND f.sku_nbr IS NULL
    AND a.cal_dt = {BULK_DAY} - 2 AND a.rmeth_cd = 1 AND a.reple_ind = 1
    AND (a.vlcty_cd NOT IN ('D', 'E') AND a.dept_nbr NOT IN (25, 28) OR a.dept_nbr IN (25, 28))""")
_NEW_SYS = """CASE WHEN new_bulk_min_qty = curr_bulk_min_qty THEN curr_sysmohq
    ELSE GREATEST(COALESCE(non_bulk_sysmohq, 0), new_bulk_min_qty) END"""
_DRIVEN = "wng_mohq_subparm_cd = 1707 AND subparm_min_oh_qty > sfty_stk_qty"
DIAG = ("diag", f"""SELECT a.*, CASE WHEN {_DRIVEN} THEN subparm_min_oh_qty ELSE 0 END AS current_bulk_driven_qty,
    CASE WHEN {_DRIVEN} THEN curr_sysmohq - non_bulk_sysmohq ELSE 0 END AS curr_bulk_incremental,
    {_NEW_SYS} AS new_sysmohq,
    CASE WHEN non_bulk_sysmohq IS NOT NULL THEN GREATEST(new_bulk_min_qty - non_bulk_sysmohq, 0) END AS new_bulk_incremental,
    {_NEW_SYS} - curr_sysmohq AS new_units
    FROM measured a JOIN velocity v ON a.sku = v.sku AND a.store = v.store
    WHERE v.sku_vlcty_cd NOT IN ('D', 'E') AND v.mer_dept_nbr NOT IN (25, 28) OR v.mer_dept_nbr IN (25, 28)""")
TO_DIAG = (LATEST, PRICES, PADDED, NEW, LAST, MEASURED, DIAG)
BULK_INPUTS = (
    "prices", "stores", "items", "cal", "overrides", "bulk_inventory", "settings", "exclude", "velocity", "weekly")


def _effect(status: str) -> str:
    return f"SUM(CASE WHEN status = '{status}' THEN new_units * curr_retl_amt ELSE 0 END)"


def _week_sql(back: int) -> str:
    closed = f"(SELECT MAX(fscl_wk_end_dt) FROM cal WHERE fscl_wk_end_dt < {BULK_DAY})"
    return f"""(SELECT MAX(cal_dt) FROM cal WHERE day_of_wk_nbr = 7
        AND fscl_wk_nbr = (SELECT fscl_wk_nbr FROM cal WHERE cal_dt = {closed})
        AND fscl_yr = (SELECT fscl_yr FROM cal WHERE cal_dt = {closed}) - {back})"""


INVEST_SQL = f"""SELECT DISTINCT a.*, c.current_oh_ret, c.r8w_ret_sls_ty, d.r8w_ret_sls_ly FROM (
    SELECT CASE WHEN substr(sub_dept, 1, 1) = '0' THEN substr(sub_dept, 2, 3) ELSE sub_dept END AS dept,
    class_nbr AS class_number, class_desc AS class_name, sub_class_nbr AS subclass, sub_class_desc AS subclass_name, a.sku,
    COUNT(*) AS stores_with_bulk_price_qty,
    SUM(CASE WHEN status = 'ADDED' THEN 1 ELSE 0 END) AS new_stores_with_bulk_price_qty,
    SUM(curr_sysmohq * curr_retl_amt) AS current_sysmohq_dlrs,
    SUM(curr_bulk_incremental * curr_retl_amt) AS current_bulk_contribution,
    SUM(new_bulk_incremental * curr_retl_amt) AS new_bulk_contribution, SUM(new_units * curr_retl_amt) AS net_impact,
    SUM(CASE WHEN status <> 'REMOVED' THEN new_units * curr_retl_amt ELSE 0 END) AS net_impact_effective,
    {_effect('ADDED')} AS new_str_sku_impact, {_effect('INCREASED')} AS higher_qty_impact,
    {_effect('REMOVED')} AS removed_str_sku_impact, {_effect('REDUCED')} AS lower_qty_impact,
    {_effect('NO CHANGE')} AS other_impact
    FROM diag a JOIN latest c ON a.sku = c.sku AND a.sku_crt_dt = c.sku_crt_dt AND c.sub_dept IS NOT NULL
    GROUP BY 1, 2, 3, 4, 5, 6) a
    LEFT JOIN (SELECT a.sku, COALESCE(SUM(oh_qty * w.curr_retl_amt), 0) AS current_oh_ret,
        COALESCE(SUM(r8w_avg_sls_amt), 0) * 8 AS r8w_ret_sls_ty FROM diag a JOIN weekly w ON a.sku = w.sku
        AND a.store = w.store WHERE w.week_end_dt = {_week_sql(0)} GROUP BY 1) c USING (sku)
    LEFT JOIN (SELECT a.sku, COALESCE(SUM(r8w_avg_sls_amt), 0) * 8 AS r8w_ret_sls_ly FROM diag a JOIN weekly w
        ON a.sku = w.sku AND a.store = w.store WHERE w.week_end_dt = {_week_sql(1)} GROUP BY 1) d USING (sku)"""


def _tiers(i: Inputs, weeks_back: int = 0):
    inv = None if weeks_back else i.bulk_inventory
    return bulk.active_tiers(i.prices, i.stores, i.items, i.cal, i.overrides, BULK_AS_OF, inv, weeks_back)


def _diag(i: Inputs):
    return bulk.bulk_minimum(
        i.bulk_inventory, _tiers(i), _tiers(i, 1), i.items, i.settings, i.exclude, i.velocity, BULK_AS_OF)


TIER_COLUMNS = (
    "sku:i, mkt:i, sku_crt_dt:d, vol_disc_min_qty:f, vol_disc_pct:f, loc:i, eff_end:d, eff_bgn:d, mkt_lvl:i")
UPLOAD_COLUMNS = (
    "trumping_level:i, type:i, store_group:s, volume_id:s, velocity_id:s, sku:i, sku_grp:s, store:i, parm_code:i, "
    "parm_value:{v}, eff_begin_date:s, eff_end_date:s, start_fscl_wk_nbr:s, end_fscl_wk_nbr:s, param_desc:s, "
    "ootl_reason_code:s")
GROUP_COLUMNS = ", ".join(f"k{k}_mean:f, k{k}_stddev:f5, k{k}_cnt:i" for k in (1, 2, 3))
BEST_COLUMNS = PAIR_COLUMNS + "last_upd_dt:d, " + ", ".join(
    f"{n}_jlq:f, {n}_stddev:f5, {n}_freq:i" for n in ("top", "mid", "bot"))
RESULT_COLUMNS = PAIR_COLUMNS + "jlq:f, stddev:f5, freq:i, f4_sf:f, rtlt:i, adj_freq:i"
REPORT_COLUMNS = (
    "sub_dept:s, total_str_sku_cnt:i, outl_impact_sku_str_count:i, trgt_oh_qty:f4, trgt_oh_amt:f4, curr_outl_calc_qty:f4, "
    "curr_outl_calc_amt:f4, outl_diff_amt:f4, new_outl_calc_qty:f4, new_outl_calc_amt:f4, outl_impact_amt:f4")
_SUMS = """COUNT(*) AS total_str_sku_cnt, SUM(CASE WHEN new_outl_amt <> curr_outl_amt THEN 1 ELSE 0 END)
    AS outl_impact_sku_str_count, SUM(trgt_oh_qty) AS trgt_oh_qty, SUM(trgt_oh_amt) AS trgt_oh_amt,
    SUM(curr_outl_qty) AS curr_outl_calc_qty, SUM(curr_outl_amt) AS curr_outl_calc_amt,
    SUM(trgt_oh_amt - curr_outl_amt) AS outl_diff_amt, SUM(new_outl_qty) AS new_outl_calc_qty,
    SUM(new_outl_amt) AS new_outl_calc_amt, SUM(new_outl_amt - curr_outl_amt) AS outl_impact_amt FROM impact"""

QUERIES = [
    Query("b1_active_items", lambda i: bk.active_items(i.items, i.inventory, i.prefs, AS_OF),
          PAIR_COLUMNS + "sku_desc:s, dept_nbr:i, class_nbr:i, class_desc:s, sub_class_nbr:i, sub_class_desc:s",
          "SELECT * FROM active", BASKET_INPUTS, (LATEST, ACTIVE)),
    Query("b2_basket_lines", _lines, PAIR_COLUMNS + "fscl_yr_wk:s, item_qty:i", "SELECT * FROM baskets",
          BASKET_INPUTS, TO_HIST[:3]),
    Query("b3_demand_cap", lambda i: bk.demand_cap(_lines(i), i.demand), PAIR_COLUMNS + "fscl_yr_wk:s, item_qty:i",
          "SELECT * FROM capped", BASKET_INPUTS, TO_HIST[:4]),
    Query("b4_qty_histogram", _hist, PAIR_COLUMNS + "max_pkey:i, pkey:i, item_qty:i, trans_cnt:i",
          "SELECT * FROM histogram", BASKET_INPUTS, TO_HIST),
    Query("b5_split_space", lambda i: bk.split_space(_hist(i)), PAIR_COLUMNS + "max_pkey:i, n_splits:i",
          f"""SELECT {PAIR}, max_pkey, COUNT(*) AS n_splits FROM (SELECT DISTINCT {PAIR}, max_pkey FROM histogram) h
          JOIN splits USING (max_pkey) GROUP BY {PAIR}, max_pkey""", BASKET_INPUTS, (*TO_HIST, SPLITS)),
    Query("b6_cluster_means", lambda i: bk.cluster_means(bk.cluster_sse(_hist(i))),
          PAIR_COLUMNS + "max_pkey:i, k2_start:i, k3_start:i, sse:f4, " + GROUP_COLUMNS, "SELECT * FROM per_k2",
          BASKET_INPUTS, TO_BEST),
    Query("b6_cluster_sse", lambda i: bk.cluster_sse(_hist(i)), PAIR_COLUMNS + "k2_start:i, k3_start:i, sse:f4",
          "SELECT * FROM per_k2", BASKET_INPUTS, TO_BEST),
    Query("b7_best_split", _best, BEST_COLUMNS, "SELECT * FROM best", BASKET_INPUTS, TO_BEST),
    Query("b8_choose_cluster", _chosen, PAIR_COLUMNS + "last_upd_dt:d, jlq:f, stddev:f5, freq:i", "SELECT * FROM chosen",
          BASKET_INPUTS, (*TO_BEST, CHOSEN)),
    Query("b9_seasonal_frequency", _seasonal, RESULT_COLUMNS, "SELECT * FROM seasonal", BASKET_INPUTS,
          TO_SEASONAL),
    Query("b10_safety_multiple", _minimums, RESULT_COLUMNS + ", jlq_mult:f, full_jlq:i", "SELECT * FROM minimums",
          BASKET_INPUTS, TO_RESULT),
    Query("b11_stamp_weeks", _stamped, "fscl_wk_end_dt:d, " + RESULT_COLUMNS + ", jlq_mult:f, full_jlq:i",
          f"""SELECT f.cal_dt AS fscl_wk_end_dt, a.* FROM minimums a CROSS JOIN (SELECT DISTINCT c.cal_dt FROM cal c
          JOIN cal w USING (fscl_yr_wk_key_val) WHERE w.cal_dt IN ({DAY} + 7, {DAY} + 14) AND c.day_of_wk_nbr = 7) f""",
          BASKET_INPUTS, TO_RESULT),
    Query("b12_parm_upload", _upload, UPLOAD_COLUMNS.format(v="i"), "SELECT * FROM upload", BASKET_INPUTS,
          (*TO_RESULT, UPLOAD)),
    Query("b13_lead_review_demand", _lead, "store:i, sku:i, lt_rt_qty:f, lt_rt_days:i", "SELECT * FROM lead_demand",
          BASKET_INPUTS, (LEAD,)),
    Query("b14_impact_detail", lambda i: bk.impact_detail(*_impact(i)),
          "store:i, sku:i, sub_dept:s, eff_oo_qty:f, curr_outl_no_max_qty:f, curr_outl_qty:f, new_outl_qty:f, "
          "curr_ord_qty:f, new_ord_qty:f, curr_outl_amt:f4, new_outl_amt:f4", "SELECT * FROM impact", BASKET_INPUTS,
          TO_IMPACT),
    Query("b14_impact_report", lambda i: bk.impact_report(*_impact(i)), REPORT_COLUMNS,
          f"SELECT sub_dept, {_SUMS} GROUP BY 1 UNION ALL SELECT 'TOTAL', {_SUMS}", BASKET_INPUTS, TO_IMPACT),
    Query("c1_missing_settings",
          lambda i: bulk.missing_settings(i.prices, i.items, i.settings, i.bulk_inventory, BULK_AS_OF),
          "sku:i, sub_dept:s, class_nbr:i, class_desc:s, sub_class_nbr:i, sub_class_desc:s, bulk_price_inv_feed:s, "
          "bulk_price_multiplier:s", MISSING_SQL, BULK_INPUTS, (LATEST, PRICES, PADDED)),
    Query("c2_active_tiers", _tiers, TIER_COLUMNS + ", sku_stat_cd:i, reple_ind:i", "SELECT * FROM new_tiers",
          BULK_INPUTS, (LATEST, PRICES, NEW)),
    Query("c2_active_tiers_last_week", lambda i: _tiers(i, 1), TIER_COLUMNS, "SELECT * FROM last_tiers", BULK_INPUTS,
          (LATEST, PRICES, LAST)),
    Query("c3_tier_diff", lambda i: bulk.tier_diff(i.bulk_inventory.select("store", "sku", "cal_dt"), _tiers(i), _tiers(i, 1)),
          "store:i, sku:i, cal_dt:d, new_bulk_price_qty:f, lw_bulk_price_qty:f, status:s",
          f"""SELECT a.store, a.sku, a.cal_dt, b.vol_disc_min_qty AS new_bulk_price_qty,
          g.vol_disc_min_qty AS lw_bulk_price_qty, {STATUS} AS status FROM bulk_inventory a
          LEFT JOIN new_tiers b ON a.sku = b.sku AND a.store = b.loc
          LEFT JOIN last_tiers g ON a.sku = g.sku AND a.store = g.loc WHERE b.sku IS NOT NULL OR g.sku IS NOT NULL""",
          BULK_INPUTS, (LATEST, PRICES, NEW, LAST)),
    Query("c4_bulk_minimum", _diag,
          "sku:i, sku_crt_dt:d, store:i, status:s, curr_retl_amt:f, com_min_qty:f, curr_bulk_min_qty:f, curr_sysmohq:f, "
          "non_bulk_sysmohq:f, lw_bulk_price_qty:f, new_bulk_price_qty:f, new_bulk_min_qty:f, current_bulk_driven_qty:f, "
          "curr_bulk_incremental:f, new_sysmohq:f, new_bulk_incremental:f, new_units:f", "SELECT * FROM diag", BULK_INPUTS,
          TO_DIAG),
    Query("c5_investment_report",
          lambda i: bulk.investment_report(materialise(_diag(i), "diag"), i.items, i.weekly, i.cal, BULK_AS_OF),
          "dept:s, class_number:i, class_name:s, subclass:i, subclass_name:s, sku:i, stores_with_bulk_price_qty:i, "
          "new_stores_with_bulk_price_qty:i, current_sysmohq_dlrs:f4, current_bulk_contribution:f4, "
          "new_bulk_contribution:f4, net_impact:f4, net_impact_effective:f4, new_str_sku_impact:f4, higher_qty_impact:f4, "
          "removed_str_sku_impact:f4, lower_qty_impact:f4, other_impact:f4, current_oh_ret:f4, r8w_ret_sls_ty:f4, "
          "r8w_ret_sls_ly:f4", INVEST_SQL, BULK_INPUTS, TO_DIAG),
    Query("c6_removed_items", lambda i: bulk.removed_items(_tiers(i, 1), _tiers(i), i.items),
          "sku_crt_dt:d, dept:s, class_number:i, class_name:s, subclass:i, subclass_name:s, sku:i",
          """SELECT a.sku_crt_dt, CASE WHEN substr(sub_dept, 1, 1) = '0' THEN substr(sub_dept, 2, 3) ELSE sub_dept END AS dept,
          class_nbr AS class_number, class_desc AS class_name, sub_class_nbr AS subclass, sub_class_desc AS subclass_name,
          a.sku FROM (SELECT DISTINCT sku, sku_crt_dt FROM last_tiers) a
          JOIN latest c ON a.sku = c.sku AND a.sku_crt_dt = c.sku_crt_dt AND sub_dept IS NOT NULL
          WHERE NOT EXISTS (SELECT 1 FROM new_tiers b WHERE b.sku = a.sku AND b.sku_crt_dt = a.sku_crt_dt)""",
          BULK_INPUTS, (LATEST, PRICES, NEW, LAST)),
    Query("c7_parm_export", lambda i: bulk.parm_export(i.parms, i.cal, AS_OF), UPLOAD_COLUMNS.format(v="f"),
          f"""SELECT * REPLACE (CASE WHEN parm_value > 9999 THEN 9999 ELSE parm_value END AS parm_value) FROM parms
          WHERE upload_dt = (SELECT fscl_wk_bgn_dt FROM cal WHERE cal_dt = {DAY})""", ("parms", "cal")),
]
