"""Sources, expressions, joins, aggregates, windows and order queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.inputs import AS_OF, Inputs
from checks.registry import Query
from stockloom import functions as fx
from stockloom import operators as op
from stockloom import sources as src
from stockloom.plans import orders as po
from stockloom.plans.inventory import order_up_to_level
from stockloom.session import materialise, stage_path

DAY = f"DATE '{AS_OF.isoformat()}'"

def _lines(i: Inputs):
    return i.lineitem.select("*", F.to_date("l_shipdate").alias("ship"))


def _no_a(c: str):
    """A text key with NULL in place of one value."""
    return F.nullif(c, F.lit("A")).alias(c)


def _no_7(c: str):
    """A key that is NULL for every seventh value."""
    return F.when(F.col(c) % 7 != 0, F.col(c)).alias("k")


def _round_trip_csv(i: Inputs, explicit: bool):
    """Export part as CSV and load it with declared types."""
    path = stage_path(i.spark, "preferences")
    schema = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    i.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice").write.mode(
        "overwrite").option("header", True).csv(path)
    if explicit:
        return src.load_csv_explicit(i.spark, path, schema)
    table = stage_path(i.spark, "preference-table")
    src.write_stage(i.part.select("p_partkey", "p_name").limit(100), table)  # what is replaced
    return src.replace_table(i.spark, path, schema, table)


def _stage(i: Inputs):
    path = stage_path(i.spark, "stage")
    src.write_stage(i.orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("n")), path)
    src.write_stage(i.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n")), path)
    return i.spark.read.parquet(path)


def _history(i: Inputs):
    path = stage_path(i.spark, "history")
    weekly = _lines(i).groupBy(fx.trunc_period("ship", "week").alias("week")).agg(
        F.sum("l_quantity").alias("qty"))
    early, late = weekly.filter("year(week) < 1998"), weekly.filter("year(week) >= 1998")
    for part in (early, late):
        src.append_history(part.withColumn("yr", F.year("week")), path, ["yr"])
    return i.spark.read.parquet(path)


def _exported(i: Inputs, chunked: bool):
    path = stage_path(i.spark, "report")
    rows = i.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    if chunked:
        src.export_chunked(rows, path, rows_per_file=100)
        sep = ","
    else:
        src.export_delimited(rows, path)
        sep = "\t"
    schema = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING"
    return i.spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def _tagged(i: Inputs):
    by_type = i.events.groupBy("event_type").agg(F.sum("value").alias("total"))
    first = by_type.withColumn("load_dt", F.lit("20200901"))
    return src.append_tagged(first, by_type, "load_dt", "20200906")


def _displayed(i: Inputs):
    rows = i.lineitem.groupBy(F.col("l_suppkey").alias("store_group"), F.col("l_returnflag").alias("sku_grp")).agg(
        F.sum("l_quantity").alias("parm_value"))
    return src.rename_display(rows)


def _calendar_day(i: Inputs):
    return _lines(i).select("l_orderkey", "l_linenumber", "ship")


def _market_prices(i: Inputs, *columns):
    """What the override of market prices by store is made from, as arguments."""
    return (i.prices.select(*columns), i.stores.select("mkt", F.col("store").alias("loc")), i.overrides,
            "sku", "mkt", "loc", "vol_disc_min_qty", dt.date(2001, 11, 11))


def _overridden(i: Inputs):
    # The day's text is made once a price, not once a store.
    day = F.col("eff_bgn").cast("string").alias("eff_bgn")
    return op.market_override(*_market_prices(i, "sku", "mkt", "tier", day, "vol_disc_min_qty")).drop("mkt")


OVERRIDDEN = """SELECT p.sku, s.store AS loc, p.tier, p.eff_bgn,
    CASE WHEN g.sku IS NOT NULL THEN CASE g.ovrd_type WHEN 1 THEN g.ovrd_qty
            WHEN 2 THEN GREATEST(g.min_ovrd_qty, p.vol_disc_min_qty)
            ELSE LEAST(g.max_ovrd_qty, p.vol_disc_min_qty) END
         WHEN h.sku IS NOT NULL THEN CASE h.ovrd_type WHEN 1 THEN h.ovrd_qty
            WHEN 2 THEN GREATEST(h.min_ovrd_qty, p.vol_disc_min_qty)
            ELSE LEAST(h.max_ovrd_qty, p.vol_disc_min_qty) END
         ELSE p.vol_disc_min_qty END AS vol_disc_min_qty
    FROM prices p JOIN stores s USING (mkt)
    LEFT JOIN overrides g ON g.sku = p.sku AND g.str = s.store
        AND DATE '2001-11-11' BETWEEN g.beg_dt AND g.end_dt
    LEFT JOIN overrides h ON h.sku = p.sku AND DATE '2001-11-11' BETWEEN h.beg_dt AND h.end_dt"""

BUCKETS = ("cmtd_min_map_qty", "cmtd_min_xmer_qty", "cmtd_min_bulk_wall_qty", "mohq_prst_qty")
SINGLES = (
    "mohq_ad_qty", "mohq_jlq_qty", "mohq_fld_rqst_qty", "mohq_wos_min_qty", "mohq_spprt_new_item_qty",
    "mohq_bulk_dspl_qty", "mohq_non_spi_prst_qty", "mohq_inv_soln_team_qty",
)


def bucket_sql(singles=SINGLES) -> str:
    total = " + ".join(f"COALESCE({b}, 0)" for b in BUCKETS)
    return f"GREATEST({total}, {', '.join(f'COALESCE({b}, 0)' for b in (*singles, 'sfty_stk_qty'))})"


def level_sql(new: str | None = None, cap: bool = True) -> str:
    floor = bucket_sql() if new is None else (
        f"GREATEST({bucket_sql([s for s in SINGLES if s != 'mohq_jlq_qty'])}, COALESCE({new}, 0))")
    level = f"""(COALESCE(lead_tm_qty + rev_tm_qty, lt_rt_qty, 0) + {floor}
        + COALESCE(subparm_cmtd_stk_qty, cmtd_stk_qty, 0))"""
    return f"CEIL(CASE WHEN {level} > max_inv_qty THEN max_inv_qty ELSE {level} END)" if cap else f"CEIL({level})"


SEASONS = [f"sf{n:02d}" for n in range(1, 53)]


def _season_sql() -> str:
    def at(w: int) -> str:
        return " + ".join(SEASONS[(w + 1 + k) % 52] for k in range(4))

    cases = " ".join(f"WHEN {w} THEN ({at(w)}) / 4" for w in range(1, 54 - 1))
    return f"""SELECT f.sku, f.store, f.sf_calc_date,
        CASE LEAST(fscl_wk_nbr, 52) {cases} END AS season FROM factors f
        JOIN cal ON cal_dt = f.sf_calc_date + CAST(7 * f.sku AS INTEGER)"""


def _seasons(i: Inputs):
    weeks = i.cal.select(F.col("cal_dt").alias("_at"), "fscl_wk_nbr")
    dated = i.factors.withColumn("_at", F.date_add("sf_calc_date", (F.col("sku") * 7).cast("int")))
    return dated.join(weeks, "_at").select(
        "sku", "store", "sf_calc_date", fx.forward_season(SEASONS, "fscl_wk_nbr").alias("season"))


def _percent(i: Inputs):
    return op.partition_percentile(
        i.lineitem.select(_no_a("l_returnflag"), "l_extendedprice"), ["l_returnflag"], "l_extendedprice",
        [0.1, 0.5, 0.99], ["p10", "p50", "p99"])


def _weekly(i: Inputs):
    return i.history.groupBy("p_brand", "dt").agg(F.sum("qty").alias("qty"))


WEEKLY_SQL = "(SELECT p_brand, dt, SUM(qty) AS qty FROM history GROUP BY 1, 2)"


def _trucks(i: Inputs):
    boosted = po.boost_priority(i.po, i.priority_skus)
    return po.build_truck(materialise(boosted, "orders"))


BOOST_SQL = """SELECT po.*, priority + CASE WHEN EXISTS (SELECT 1 FROM hits WHERE hits.po = po.po)
    THEN 50000 ELSE 0 END AS new_priority FROM po"""
HITS = ("hits", """SELECT DISTINCT po FROM (SELECT po, unnest(string_split(skus, ',')) AS item FROM po) x
    WHERE item IN (SELECT CAST(sku AS VARCHAR) FROM priority_skus)""")
RANKED = ("ranked", f"""SELECT store, po, cube, new_priority, ROW_NUMBER() OVER
    (PARTITION BY store ORDER BY new_priority DESC, po) AS rn FROM ({BOOST_SQL})""")
TRUCK = ("truck", """SELECT * FROM (WITH RECURSIVE fill AS (
    SELECT store, po, cube, rn, cube <= 2400 AS included, CASE WHEN cube <= 2400 THEN cube ELSE 0 END AS used
    FROM ranked WHERE rn = 1
    UNION ALL SELECT r.store, r.po, r.cube, r.rn, f.used + r.cube <= 2400,
    CASE WHEN f.used + r.cube <= 2400 THEN f.used + r.cube ELSE f.used END
    FROM fill f JOIN ranked r ON r.store = f.store AND r.rn = f.rn + 1) SELECT * FROM fill)""")

QUERIES = [
    Query("s1_scan_limit", lambda i: src.scan_limit(
        i.orders, ["o_orderkey", "o_totalprice"], 100, [F.desc("o_totalprice"), "o_orderkey"]),
        "o_orderkey:i, o_totalprice:f2",
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"),
    Query("s2_load_csv_typed", lambda i: _round_trip_csv(i, False),
          "p_partkey:i, p_name:s, p_brand:s, p_type:s, p_size:i, p_retailprice:f2", "SELECT * FROM part"),
    Query("s3_load_csv_explicit", lambda i: _round_trip_csv(i, True),
          "p_partkey:i, p_name:s, p_brand:s, p_type:s, p_size:i, p_retailprice:f2", "SELECT * FROM part"),
    Query("s4_write_stage", _stage, "o_orderpriority:s, n:i",
          "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1"),
    Query("s5_append_history", _history, "week:d, qty:f, yr:i",
          """SELECT week, SUM(l_quantity) AS qty, year(week) AS yr FROM (SELECT l_quantity,
          CAST(l_shipdate AS DATE) - CAST(dayofweek(l_shipdate) AS INTEGER) AS week FROM lineitem) x
          GROUP BY 1"""),
    Query("s6_export_delimited", lambda i: _exported(i, False),
          "c_custkey:i, c_name:s, c_nationkey:i, c_mktsegment:s", "SELECT * FROM customer"),
    Query("s7_export_chunked", lambda i: _exported(i, True),
          "c_custkey:i, c_name:s, c_nationkey:i, c_mktsegment:s", "SELECT * FROM customer"),
    Query("s8_rename_display", _displayed, "Store Group:i, SKU Grp:s, Parm Value:f",
          """SELECT l_suppkey AS "Store Group", l_returnflag AS "SKU Grp", SUM(l_quantity) AS "Parm Value"
          FROM lineitem GROUP BY 1, 2"""),
    Query("s9_append_tagged", _tagged, "event_type:s, total:f4, load_dt:s",
          """SELECT event_type, SUM(value) AS total, t AS load_dt FROM events
          CROSS JOIN (VALUES ('20200901'), ('20200906')) v(t) GROUP BY 1, 3"""),
    Query("s10_explode_lines", lambda i: src.explode_lines(i.trans),
          "store:i, sls_dt:d, trans_type:s, trans_status:s, training:b, register:i, trans_id:i, sku:i, "
          "sku_crt_dt:d, unt_sls:f", "SELECT * FROM trans_lines", ("trans_lines",)),
    Query("p1_build_key", lambda i: i.part.select("p_partkey", fx.build_key(["p_brand", "p_type", "p_size"]).alias("k")),
          "p_partkey:i, k:s",
          "SELECT p_partkey, p_brand || '|' || p_type || '|' || CAST(p_size AS VARCHAR) AS k FROM part"),
    Query("p2_split_key", lambda i: i.part.select(
        "p_partkey", fx.build_key(["p_brand", "p_type"]).alias("k")).select(
        "p_partkey", *fx.split_key("k", ["brand", "kind"])), "p_partkey:i, brand:s, kind:s",
        "SELECT p_partkey, p_brand AS brand, p_type AS kind FROM part"),
    Query("p3_safe_divide", lambda i: i.lineitem.select(
        "l_orderkey", "l_linenumber", fx.safe_divide("l_tax", "l_discount").alias("q")),
        "l_orderkey:i, l_linenumber:i, q:f",
        "SELECT l_orderkey, l_linenumber, l_tax / NULLIF(l_discount, 0) AS q FROM lineitem"),
    Query("p4_output_transform", lambda i: i.customer.select(
        "c_custkey",
        *[fx.output_transform(F.col("c_acctbal") / 8, r, n).alias(name) for name, r, n in (
            ("plain", False, False), ("rounded", True, False), ("floored", False, True), ("both", True, True))]),
        "c_custkey:i, plain:f, rounded:f, floored:f, both:f",
        """SELECT c_custkey, c_acctbal / 8 AS plain, ROUND(c_acctbal / 8) AS rounded,
        GREATEST(c_acctbal / 8, 0) AS floored, ROUND(GREATEST(c_acctbal / 8, 0)) AS both FROM customer"""),
    Query("p5_clip_percentile", lambda i: op.clip_percentile(
        i.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _no_a("l_returnflag"), "l_extendedprice"), ["l_returnflag"],
        "l_extendedprice", 0.01, 0.99, "clipped"),
        "l_orderkey:i, l_linenumber:i, l_partkey:i, l_suppkey:i, clipped:f4",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, LEAST(GREATEST(l_extendedprice, lo), hi) AS clipped
        FROM lineitem JOIN (SELECT NULLIF(l_returnflag, 'A') AS f, quantile_cont(l_extendedprice, 0.01) AS lo,
        quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem GROUP BY 1) q
        ON NULLIF(l_returnflag, 'A') IS NOT DISTINCT FROM f"""),
    Query("p6_cap_value", lambda i: i.orders.select("o_orderkey", fx.cap_value("o_totalprice").alias("capped")),
          "o_orderkey:i, capped:f2",
          "SELECT o_orderkey, CASE WHEN o_totalprice > 9999 THEN 9999 ELSE o_totalprice END AS capped FROM orders"),
    Query("p7_override_value", _overridden, "sku:i, loc:i, tier:i, eff_bgn:d, vol_disc_min_qty:f",
          OVERRIDDEN, ("prices", "stores", "overrides")),
    Query("p8_pad_dept", lambda i: i.part.select(
        "p_partkey", fx.pad_dept(F.col("p_partkey").cast("string")).alias("dept")).withColumn(
        "shown", fx.unpad_dept("dept")), "p_partkey:i, dept:s, shown:s",
        """SELECT p_partkey, dept, CASE WHEN dept LIKE '0%' THEN substr(dept, 2, 3) ELSE dept END AS shown
        FROM (SELECT p_partkey, CASE length(CAST(p_partkey AS VARCHAR)) WHEN 2 THEN '00' || p_partkey
        WHEN 3 THEN '0' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS dept FROM part) x"""),
    Query("p9_strip_quotes", lambda i: i.items.select(
        "sku", "sku_crt_dt", fx.strip_quotes("sku_desc").alias("sku_desc")),
        "sku:i, sku_crt_dt:d, sku_desc:s",
        """SELECT sku, sku_crt_dt, replace(sku_desc, '"', '') AS sku_desc FROM items""", ("items",)),
    Query("p10_strip_thousands", lambda i: i.orders.select(
        "o_orderkey", F.format_number("o_totalprice", 2).alias("t")).select(
        "o_orderkey", fx.strip_thousands("t").alias("price")), "o_orderkey:i, price:f2",
        "SELECT o_orderkey, o_totalprice AS price FROM orders"),
    Query("p11_ceil_to_pack", lambda i: i.lineitem.select(
        "l_orderkey", "l_linenumber", fx.ceil_to_pack(F.col("l_quantity") - 10, F.col("l_linenumber") + 3).alias("q")),
        "l_orderkey:i, l_linenumber:i, q:f",
        """SELECT l_orderkey, l_linenumber, CEIL(GREATEST(l_quantity - 10, 0) / (l_linenumber + 3))
        * (l_linenumber + 3) AS q FROM lineitem"""),
    Query("p12_max_of_buckets", lambda i: i.inventory.select(
        "store", "sku", "cal_dt", fx.max_of_buckets(BUCKETS, (*SINGLES, "sfty_stk_qty")).alias("q")),
        "store:i, sku:i, cal_dt:d, q:f", f"SELECT store, sku, cal_dt, {bucket_sql()} AS q FROM inventory",
        ("inventory",)),
    Query("p13_order_up_to_level", lambda i: i.inventory.withColumns(
        {"lt_rt_qty": F.col("store") + 0.5, "new_jlq": F.col("sku") * 1.5}).select(
        "store", "sku", "cal_dt", order_up_to_level().alias("capped"), order_up_to_level(cap=False).alias("uncapped"),
        order_up_to_level(new_min="new_jlq").alias("changed")),
        "store:i, sku:i, cal_dt:d, capped:f, uncapped:f, changed:f",
        f"""SELECT store, sku, cal_dt, {level_sql()} AS capped, {level_sql(cap=False)} AS uncapped,
        {level_sql('new_jlq')} AS changed FROM (SELECT *, store + 0.5 AS lt_rt_qty, sku * 1.5 AS new_jlq
        FROM inventory) x""", ("inventory",)),
    Query("p14_calendar_parts", lambda i: _calendar_day(i).select("l_orderkey", "l_linenumber", fx.calendar_parts("ship").alias("c")).select(
        "l_orderkey", "l_linenumber", "c.*"), "l_orderkey:i, l_linenumber:i, month:i, day:i, dayofweek:i",
        """SELECT l_orderkey, l_linenumber, month(l_shipdate) AS month, day(l_shipdate) AS day,
        dayofweek(l_shipdate) + 1 AS dayofweek FROM lineitem"""),
    Query("p15_boundary_diffs", lambda i: _lines(i).join(i.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber",
        fx.week_boundary_diff("ship", F.to_date("o_orderdate")).alias("weeks"),
        fx.year_boundary_diff("ship", F.to_date("o_orderdate")).alias("years")),
        "l_orderkey:i, l_linenumber:i, weeks:i, years:i",
        """SELECT l_orderkey, l_linenumber, (CAST(l_shipdate AS DATE) - DATE '1970-01-04') // 7
        - (CAST(o_orderdate AS DATE) - DATE '1970-01-04') // 7 AS weeks,
        year(l_shipdate) - year(o_orderdate) AS years FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    Query("p16_trunc_period", lambda i: _calendar_day(i).select(
        "l_orderkey", "l_linenumber", fx.trunc_period("ship", "week").alias("week"), fx.trunc_period("ship", "day").alias("day")),
        "l_orderkey:i, l_linenumber:i, week:d, day:d",
        """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day,
        CAST(l_shipdate AS DATE) - CAST(dayofweek(l_shipdate) AS INTEGER) AS week FROM lineitem"""),
    Query("p17_shift_date", lambda i: _calendar_day(i).select(
        "l_orderkey", "l_linenumber", fx.shift_date("ship", -3, "day").alias("d"),
        fx.shift_date("ship", 2, "week").alias("w"), fx.shift_date("ship", -1, "year").alias("y")),
        "l_orderkey:i, l_linenumber:i, d:d, w:d, y:d",
        """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) - 3 AS d, CAST(l_shipdate AS DATE) + 14 AS w,
        CAST(CAST(l_shipdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS y FROM lineitem"""),
    Query("p18_format_date", lambda i: _calendar_day(i).select(
        "l_orderkey", "l_linenumber", fx.format_date("ship").alias("txt"), fx.week_label("JLQ FW", F.month("ship")).alias("label")),
        "l_orderkey:i, l_linenumber:i, txt:s, label:s",
        """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%m/%d/%Y') AS txt,
        'JLQ FW' || month(l_shipdate) AS label FROM lineitem"""),
    Query("p19_select_by_least", lambda i: i.lineitem.select(
        "l_orderkey", "l_linenumber", fx.select_by_least(
            [F.col("l_quantity") % 3, F.col("l_partkey") % 3, F.col("l_suppkey") % 3],
            [F.lit("first"), F.lit("second"), F.lit("third")], F.lit("tie")).alias("choice")),
        "l_orderkey:i, l_linenumber:i, choice:s",
        """SELECT l_orderkey, l_linenumber, CASE WHEN b <= a AND b <= c THEN 'second' WHEN c = a THEN 'tie'
        WHEN c < a THEN 'third' ELSE 'first' END AS choice FROM (SELECT *, l_quantity % 3 AS a,
        l_partkey % 3 AS b, l_suppkey % 3 AS c FROM lineitem) x"""),
    Query("p20_current_period", lambda i: op.semi_in(_lines(i), op.current_period(
        i.cal, AS_OF, "fscl_wk_bgn_dt", "fscl_wk_end_dt").select(F.col("cal_dt").alias("ship")), ["ship"]),
        "l_orderkey:i, l_linenumber:i, l_partkey:i, l_suppkey:i, ship:d",
        f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ship FROM lineitem
        WHERE CAST(l_shipdate AS DATE) BETWEEN {DAY} - 6 AND {DAY}"""),
    Query("p21_normal_sales", lambda i: op.normal_sales(i.trans_lines, AS_OF),
          "store:i, sls_dt:d, trans_type:s, register:i, trans_id:i, sku:i, unt_sls:f",
          f"""SELECT * FROM trans_lines WHERE trans_type = 'S' AND trans_status = 'NO' AND NOT training
          AND unt_sls > 0 AND sls_dt BETWEEN {DAY} - 364 AND {DAY} - 1""", ("trans_lines",)),
    Query("p22_active_items_filter", lambda i: op.active_items_filter(i.inventory),
          "store:i, sku:i, cal_dt:d, sku_stat_cd:i, vlcty_cd:s, dept_nbr:i",
          """SELECT * FROM inventory WHERE sku_stat_cd IN (100, 200, 300) AND reple_ind = 1
          AND (vlcty_cd NOT IN ('D', 'E') OR dept_nbr IN (25, 28))""", ("inventory",)),
    Query("p23_forward_season", _seasons, "sku:i, store:i, sf_calc_date:d, season:f", _season_sql(),
          ("factors", "cal")),
    Query("j1_inner_equi", lambda i: op.inner_equi(
        i.trans_lines.select("store", "sku", "trans_id", "register", "unt_sls"),
        i.lead_parms.select((F.col("bu_id") - 1000).alias("store"), "sku", "parm_cd", "int_val"), ["store", "sku"]),
        "store:i, sku:i, trans_id:i, register:i, unt_sls:f, parm_cd:i, int_val:i",
        """SELECT t.store, t.sku, trans_id, register, unt_sls, parm_cd, int_val FROM trans_lines t
        JOIN lead_parms p ON p.bu_id - 1000 = t.store AND p.sku = t.sku""", ("trans_lines", "lead_parms")),
    Query("j2_left_default", lambda i: op.left_default(
        i.customer, i.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")),
        ["c_custkey"], {"n": 0}), "c_custkey:i, n:i",
        "SELECT c_custkey, COUNT(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1"),
    Query("j3_previous_period_join", lambda i: op.previous_period_join(
        _weekly(i).join(op.period_rank(i.history, "dt", "rnk"), "dt"), ["p_brand"], "rnk", ["qty"]),
        "p_brand:s, dt:d, qty:f, rnk:i, prev_qty:f",
        f"""SELECT b.p_brand, b.dt, b.qty, b.rnk, a.qty AS prev_qty FROM
        (SELECT *, DENSE_RANK() OVER (ORDER BY dt) AS rnk FROM {WEEKLY_SQL}) b LEFT JOIN
        (SELECT *, DENSE_RANK() OVER (ORDER BY dt) AS rnk FROM {WEEKLY_SQL}) a
        ON a.p_brand = b.p_brand AND b.rnk - a.rnk = 1""", ("history",)),
    Query("j4_cross_grid", lambda i: op.cross_grid(
        i.history.groupBy("p_brand", "p_type").agg(F.min("dt").alias("start")), op.date_array(i.history, "dt"), "dt", "start"),
        "p_brand:s, p_type:s, dt:d",
        """SELECT p_brand, p_type, d.dt FROM (SELECT p_brand, p_type, MIN(dt) AS start FROM history GROUP BY 1, 2) k
        JOIN (SELECT DISTINCT dt FROM history) d ON d.dt >= start""", ("history",)),
    Query("j5_range_join", lambda i: op.range_join(
        _lines(i).select("l_orderkey", "l_linenumber", "l_suppkey", fx.period_index("ship", "day").alias("a")),
        i.orders.select(F.col("o_orderkey").alias("l_orderkey"), fx.period_index(F.to_date("o_orderdate"), "day").alias("b")),
        "a", "b", -60, 30, ["l_orderkey"]), "l_orderkey:i, l_linenumber:i, l_suppkey:i, a:i, b:i",
        """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) - DATE '1970-01-04' AS a,
        CAST(o_orderdate AS DATE) - DATE '1970-01-04' AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
        WHERE b - a BETWEEN -60 AND 30"""),
    Query("j6_effective_at", lambda i: op.effective_at(i.prices, AS_OF, "eff_bgn", "eff_end"),
          "sku:i, mkt:i, tier:i, eff_bgn:d, eff_end:d, vol_disc_min_qty:f",
          f"SELECT * FROM prices WHERE {DAY} BETWEEN eff_bgn AND eff_end", ("prices",)),
    Query("j7_rolling_reference", lambda i: op.rolling_reference(_weekly(i), ["p_brand"], "dt", "qty").select(
        "p_brand", "dt", F.size("reference").alias("n"), F.array_min("reference").alias("lo"),
        F.aggregate("reference", F.lit(0.0), lambda a, v: a + v).alias("total")),
        "p_brand:s, dt:d, n:i, lo:f, total:f",
        f"""SELECT a.p_brand, a.dt, COUNT(b.dt) AS n, MIN(b.qty) AS lo, COALESCE(SUM(b.qty), 0) AS total
        FROM {WEEKLY_SQL} a LEFT JOIN {WEEKLY_SQL} b ON a.p_brand = b.p_brand AND b.dt < a.dt
        AND b.dt > CAST(a.dt - INTERVAL 1 YEAR AS DATE) GROUP BY 1, 2""", ("history",)),
    Query("j8_semi_in", lambda i: op.semi_in(
        i.customer, i.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"]), "c_custkey:i, c_name:s",
        "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"),
    Query("j9_anti_missing", lambda i: op.anti_missing(
        i.customer, i.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"]), "c_custkey:i, c_name:s",
        """SELECT * FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
        AND o_orderpriority = '1-URGENT')"""),
    Query("j10_contains_any", lambda i: op.contains_any(i.po, "skus", i.priority_skus, "sku", ["store", "po"], "hit"),
          "store:i, po:i, hit:b", "SELECT store, po, po IN (SELECT po FROM hits) AS hit FROM po",
          ("po", "priority_skus"), (HITS,)),
    Query("j11_latest_version", lambda i: op.latest_version(i.prices, ["sku", "mkt", "tier"], "eff_bgn"),
          "sku:i, mkt:i, tier:i, eff_bgn:d, vol_disc_min_qty:f, vol_disc_pct:f",
          """SELECT * FROM prices p JOIN (SELECT sku, mkt, tier, MAX(eff_bgn) AS eff_bgn FROM prices GROUP BY 1, 2, 3) m
          USING (sku, mkt, tier, eff_bgn)""", ("prices",)),
    Query("j12_with_scalar", lambda i: op.with_scalar(
        i.orders.select("o_orderkey", "o_totalprice"),
        i.orders.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))),
        "o_orderkey:i, o_totalprice:f2, lo:f2, hi:f2",
        "SELECT o_orderkey, o_totalprice, MIN(o_totalprice) OVER () AS lo, MAX(o_totalprice) OVER () AS hi FROM orders"),
    Query("j13_update_from", lambda i: op.update_from(
        i.customer, i.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top")),
        ["c_custkey"], {"c_acctbal": F.col("c_acctbal") + F.col("s_top")}), "c_custkey:i, c_name:s, c_acctbal:f4",
        """SELECT c_custkey, c_name, CASE WHEN top IS NULL THEN c_acctbal ELSE c_acctbal + top END AS c_acctbal
        FROM customer LEFT JOIN (SELECT o_custkey, MAX(o_totalprice) AS top FROM orders GROUP BY 1) o ON o_custkey = c_custkey"""),
    Query("j14_two_grain_override", lambda i: op.market_override_totals(
        *_market_prices(i, "sku", "mkt", "vol_disc_min_qty"), "n", "q"), "sku:i, loc:i, n:i, q:f",
        f"SELECT sku, loc, COUNT(*) AS n, SUM(vol_disc_min_qty) AS q FROM ({OVERRIDDEN}) x GROUP BY 1, 2",
        ("prices", "stores", "overrides")),
    Query("a1_group_agg", lambda i: op.group_agg(i.lineitem, ["l_returnflag", "l_linestatus"], {
        "total": F.sum("l_quantity"), "mean": F.avg("l_quantity"), "low": F.min("l_extendedprice"),
        "high": F.max("l_extendedprice"), "n": F.count("*")}),
        "l_returnflag:s, l_linestatus:s, total:f, mean:f, low:f2, high:f2, n:i",
        """SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS total, AVG(l_quantity) AS mean,
        MIN(l_extendedprice) AS low, MAX(l_extendedprice) AS high, COUNT(*) AS n FROM lineitem GROUP BY 1, 2"""),
    Query("a2_distinct_count", lambda i: op.distinct_count(i.lineitem, ["l_suppkey"], "l_partkey", "n"),
          "l_suppkey:i, n:i", "SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1"),
    Query("a3_sample_stddev", lambda i: op.sample_stddev(i.lineitem, ["l_partkey"], "l_quantity", "sd"),
          "l_partkey:i, sd:f", "SELECT l_partkey, STDDEV_SAMP(l_quantity) AS sd FROM lineitem GROUP BY 1"),
    Query("a4_having", lambda i: op.having(i.lineitem, ["l_orderkey"], {"n": F.count("*")}, F.col("n") == 4),
          "l_orderkey:i, n:i", "SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) = 4"),
    Query("a5_conditional_sum", lambda i: op.conditional_sum(i.lineitem, ["l_suppkey"], {
        "returned": (F.col("l_returnflag") == "R", F.col("l_quantity")),
        "opened": (F.col("l_linestatus") == "O", F.col("l_quantity"))}), "l_suppkey:i, returned:f, opened:f",
        """SELECT l_suppkey, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned,
        SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS opened FROM lineitem GROUP BY 1"""),
    Query("a6_distinct_rows", lambda i: op.distinct_rows(i.lineitem, ["l_suppkey", "l_returnflag"]),
          "l_suppkey:i, l_returnflag:s", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem"),
    Query("a7_dedup_all", lambda i: op.dedup_all(i.lineitem.select("l_partkey", "l_quantity")),
          "l_partkey:i, l_quantity:f", "SELECT l_partkey, l_quantity FROM lineitem GROUP BY 1, 2"),
    Query("a8_with_total", lambda i: op.with_total(i.lineitem, "l_returnflag", {
        "n": F.count("*"), "qty": F.sum("l_quantity")}), "l_returnflag:s, n:i, qty:f",
        """SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1
        UNION ALL SELECT 'TOTAL', COUNT(*), SUM(l_quantity) FROM lineitem"""),
    Query("a9_ordered_array", lambda i: op.ordered_array(_weekly(i), ["p_brand"], "dt", ["qty"], "s").select(
        "p_brand", F.concat_ws(",", F.transform("s", lambda e: F.concat_ws(
            ":", e["dt"].cast("string"), e["qty"].cast("bigint").cast("string")))).alias("s")), "p_brand:s, s:s",
        f"""SELECT p_brand, string_agg(CAST(dt AS VARCHAR) || ':' || CAST(CAST(qty AS BIGINT) AS VARCHAR), ',' ORDER BY dt) AS s
        FROM {WEEKLY_SQL} x GROUP BY 1""", ("history",)),
    Query("a10_wape", lambda i: op.wape(i.fact.filter("actual IS NOT NULL"), ["snpsht"], ["forecast1", "forecast2"], "actual"),
          "snpsht:d, forecast1_mape:f, forecast2_mape:f",
          """SELECT snpsht, SUM(ABS(forecast1 - actual)) / NULLIF(SUM(actual), 0) AS forecast1_mape,
          SUM(ABS(forecast2 - actual)) / NULLIF(SUM(actual), 0) AS forecast2_mape FROM fact
          WHERE actual IS NOT NULL GROUP BY 1""", ("history", "fact")),
    Query("a11_weighted_pop_sd", lambda i: op.weighted_pop_sd(
        i.lineitem.groupBy("l_suppkey", "l_quantity").agg(F.count("*").alias("n")), ["l_suppkey"], "l_quantity", "n"),
        "l_suppkey:i, cnt:f, mean:f, sd:f",
        """SELECT l_suppkey, COUNT(*) AS cnt, AVG(l_quantity) AS mean, STDDEV_POP(l_quantity) AS sd
        FROM lineitem GROUP BY 1"""),
    Query("w1_share_of_total", lambda i: op.share_of_total(
        i.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", _no_7("l_suppkey")), ["k"], "l_quantity", "share"),
        "l_orderkey:i, l_linenumber:i, l_partkey:i, l_suppkey:i, share:f8",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / SUM(l_quantity) OVER
        (PARTITION BY CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END) AS share FROM lineitem"""),
    Query("w2_period_rank", lambda i: op.period_rank(_lines(i), "ship"), "ship:d, period_rank:i",
          """SELECT ship, ROW_NUMBER() OVER (ORDER BY ship) AS period_rank FROM
          (SELECT DISTINCT CAST(l_shipdate AS DATE) AS ship FROM lineitem) x"""),
    Query("w3_row_number_by", lambda i: op.row_number_by(
        i.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_totalprice"),
        ["o_orderpriority"], "o_totalprice", ties=["o_orderkey"], descending=True), "o_orderkey:i, o_orderpriority:s, rn:i",
        """SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority, ROW_NUMBER() OVER
        (PARTITION BY NULLIF(o_orderpriority, '5-LOW') ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders"""),
    Query("w4_count_over", lambda i: op.count_over(
        i.lineitem.groupBy("l_suppkey", "l_quantity").agg(F.count("*").alias("trans")).select("*", _no_7("l_suppkey")), ["k"], "n"),
        "l_suppkey:i, l_quantity:f, trans:i, n:i",
        """SELECT *, COUNT(*) OVER (PARTITION BY CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END) AS n
        FROM (SELECT l_suppkey, l_quantity, COUNT(*) AS trans FROM lineitem GROUP BY 1, 2)"""),
    Query("w5_neighbours", lambda i: op.neighbours(_weekly(i), ["p_brand"], "dt", "qty", "prev", "nxt"),
          "p_brand:s, dt:d, prev:f, nxt:f",
          f"""SELECT p_brand, dt, LAG(qty) OVER w AS prev, LEAD(qty) OVER w AS nxt FROM {WEEKLY_SQL} x
          WINDOW w AS (PARTITION BY p_brand ORDER BY dt)""", ("history",)),
    Query("w6_trailing_stats", lambda i: op.trailing_stats(_weekly(i), ["p_brand"], "dt", "qty", 52, "mean", "n"),
          "p_brand:s, dt:d, mean:f, n:i",
          f"""SELECT p_brand, dt, AVG(qty) OVER w AS mean, COUNT(qty) OVER w AS n FROM {WEEKLY_SQL} x
          WINDOW w AS (PARTITION BY p_brand ORDER BY dt ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING)""", ("history",)),
    Query("w7_next_h_array", lambda i: op.next_h_array(_weekly(i), ["p_brand"], "dt", 3, "nxt").select(
        "p_brand", "dt", F.size("nxt").alias("n"), F.concat_ws(",", F.transform("nxt", lambda d: d.cast("string"))).alias("nxt")),
        "p_brand:s, dt:d, n:i, nxt:s",
        f"""SELECT p_brand, dt, COUNT(*) OVER w AS n, COALESCE(string_agg(CAST(dt AS VARCHAR), ',') OVER w, '') AS nxt
        FROM {WEEKLY_SQL} x WINDOW w AS (PARTITION BY p_brand ORDER BY dt ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""",
        ("history",)),
    Query("w8_partition_percentile", _percent, "l_returnflag:s, p10:f4, p50:f4, p99:f4",
          """SELECT NULLIF(l_returnflag, 'A') AS l_returnflag, quantile_cont(l_extendedprice, 0.1) AS p10, quantile_cont(l_extendedprice, 0.5) AS p50,
          quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY 1"""),
    Query("w9_leave_one_out_mean", lambda i: op.leave_one_out_mean(
        i.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", _no_7("l_partkey")), ["k"], "l_quantity", "others"),
        "l_orderkey:i, l_linenumber:i, l_partkey:i, l_suppkey:i, others:f8",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (SUM(l_quantity) OVER p - l_quantity)
        / NULLIF(COUNT(*) OVER p - 1, 0) AS others FROM lineitem
        WINDOW p AS (PARTITION BY CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END)"""),
    Query("w10_max_over", lambda i: op.max_over(
        i.orders.select("o_orderkey", "o_custkey", "o_orderpriority", _no_7("o_custkey")), ["k"], "o_orderpriority", "top"),
        "o_orderkey:i, o_custkey:i, top:s",
        """SELECT o_orderkey, o_custkey, MAX(o_orderpriority) OVER
        (PARTITION BY CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END) AS top FROM orders"""),
    Query("o1_report_order", lambda i: op.report_order(
        i.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty")), ["l_suppkey"]), "l_suppkey:i, qty:f",
        "SELECT l_suppkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1 ORDER BY 1"),
    Query("o2_top1_min", lambda i: op.top1_min(
        i.orders, ["o_custkey"], ["o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"]),
        "o_custkey:i, o_orderkey:i, o_totalprice:f2",
        """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
        ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) x WHERE rn = 1"""),
    Query("o3_sort_desc", lambda i: op.sort_desc(i.customer.select("c_custkey", "c_acctbal"), "c_acctbal"),
          "c_custkey:i, c_acctbal:f2", "SELECT c_custkey, c_acctbal FROM customer ORDER BY 2 DESC"),
    Query("u1_union_all", lambda i: op.union_all([
        i.customer.select(F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("bal")),
        i.supplier.select(F.col("s_nationkey").alias("n"), F.col("s_acctbal").alias("bal"))]), "n:i, bal:f2",
        "SELECT c_nationkey AS n, c_acctbal AS bal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier"),
    Query("u2_union_distinct", lambda i: op.union_distinct(
        i.customer.select(F.col("c_nationkey").alias("n")), i.supplier.select(F.col("s_nationkey").alias("n"))), "n:i",
        "SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier"),
    Query("v1_pivot_sum", lambda i: op.pivot_sum(
        i.measures, "row_nbr", "measure_name", "measure_value"),
        "row_nbr:s, click:f4, error:f4, purchase:f4, signup:f4, view:f4",
        """SELECT row_nbr, SUM(measure_value) FILTER (measure_name = 'click') AS click,
        SUM(measure_value) FILTER (measure_name = 'error') AS error,
        SUM(measure_value) FILTER (measure_name = 'purchase') AS purchase,
        SUM(measure_value) FILTER (measure_name = 'signup') AS signup,
        SUM(measure_value) FILTER (measure_name = 'view') AS view
        FROM measures WHERE row_nbr IS DISTINCT FROM 'All' GROUP BY 1""",
        ("measures",)),
    Query("e1_unnest", lambda i: op.unnest(i.po.select("po", F.split("skus", ",").alias("l")), "l", "sku", "pos"),
          "po:i, sku:s, pos:i",
          """SELECT po, unnest(string_split(skus, ',')) AS sku, generate_subscripts(string_split(skus, ','), 1) - 1 AS pos
          FROM po""", ("po",)),
    Query("t1_boost_priority", lambda i: po.boost_priority(i.po, i.priority_skus),
          "store:i, po:i, priority:i, new_priority:i", BOOST_SQL, ("po", "priority_skus"), (HITS,)),
    Query("t2_build_truck", _trucks, "store:i, po:i, cube:f, included:b", "SELECT * FROM truck",
          ("po", "priority_skus"), (HITS, RANKED, TRUCK)),
    Query("t3_check_capacity", lambda i: po.check_capacity(_trucks(i)), "store:i, included_cube:f",
          """SELECT store, SUM(cube) AS included_cube FROM truck WHERE included GROUP BY 1
          HAVING SUM(cube) > 2400""", ("po", "priority_skus"), (HITS, RANKED, TRUCK)),
]
