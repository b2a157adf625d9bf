"""Large-basket minimum: typical big purchase per store and SKU.

Basket quantities of a store/SKU pair are split into three groups of similar
size; the top group that is frequent enough gives the minimum.  Everything is
keyed by (store, sku, sku_crt_dt).  After the quantity histogram a pair holds
one row per distinct integer quantity, however many baskets it sold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stockloom.functions import ceil_to_pack, format_date, forward_season, strip_quotes, week_label
from stockloom.operators.aggregates import with_total
from stockloom.operators.filters import normal_sales
from stockloom.calendar import in_calendar
from stockloom.operators.joins import cross_grid, date_array
from stockloom.plans.basket_split import GROUPS, STATS, split_batches
from stockloom.plans.inventory import latest_items, order_up_to_level, snapshot
from stockloom.sources.readers import explode_lines

PAIR = ["store", "sku", "sku_crt_dt"]
# Limits and codes of the minimum calculation and its upload.
FREQ_RANGE = (3, 500)
MAX_DAYS, MIN_SEASON, NO_MAX_SIZE = 50, 0.6, 9999
MULTIPLES = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)
SERVICE_LEVEL, YEAR_DAYS = 0.85, 364
UPLOAD_LEVEL, UPLOAD_TYPE, UPLOAD_CODE, UPLOAD_DAYS = 5, 2, 1703, 22
LABEL = "JLQ FW"
DEMAND_CODES = (1, 2)


def active_items(items: DataFrame, inv: DataFrame, prefs: DataFrame, as_of: dt.date) -> DataFrame:
    """Orderable store/SKU pairs of the sub-classes with a preference."""
    pairs = (
        snapshot(inv, as_of)
        .filter((F.col("reple_ind") == 1) & (F.col("ok_to_ord") == "Y"))
        .select("sku", "sku_crt_dt", "store")
        .distinct()
    )
    wanted = prefs.select("sub_dept", "class_nbr", F.col("sc_nbr").alias("sub_class_nbr"))
    chosen = latest_items(items).join(wanted, ["sub_dept", "class_nbr", "sub_class_nbr"])
    return chosen.join(pairs, ["sku", "sku_crt_dt"]).select(
        *PAIR, strip_quotes("sku_desc").alias("sku_desc"), "dept_nbr", "class_nbr",
        "class_desc", "sub_class_nbr", "sub_class_desc",
    )


def basket_lines(
    trans: DataFrame, calendar: DataFrame, items: DataFrame, as_of: dt.date
) -> DataFrame:
    """Units of a SKU per basket and fiscal week, rounded up."""
    weeks = calendar.select("cal_dt", F.col("fscl_yr_wk_key_val").alias("fscl_yr_wk"))
    lines = normal_sales(explode_lines(trans), as_of)
    return (
        in_calendar(lines, "sls_dt", weeks)
        .join(items.select(*PAIR), PAIR)
        .groupBy(*PAIR, "register", "trans_id", "fscl_yr_wk")
        .agg(F.ceil(F.sum("unt_sls")).alias("item_qty"))
        .drop("register", "trans_id")
    )


def demand_cap(lines: DataFrame, demand: DataFrame) -> DataFrame:
    """Basket quantities limited to the week's corrected demand, if known."""
    known = demand.filter(F.col("corrected_qty") >= 0).select(
        *PAIR, "fscl_yr_wk", F.floor("corrected_qty").alias("_cap")
    )
    capped = F.when(F.col("_cap") < F.col("item_qty"), F.col("_cap")).otherwise(F.col("item_qty"))
    return lines.join(known, [*PAIR, "fscl_yr_wk"], "left").select(
        *PAIR, "fscl_yr_wk", capped.alias("item_qty")
    )


def qty_histogram(lines: DataFrame) -> DataFrame:
    """Baskets per distinct quantity, ranked from the largest quantity.

    Columns: the pair, max_pkey (distinct quantities), pkey (rank), item_qty,
    trans_cnt.  The windows run over distinct quantities, not baskets.
    """
    counts = lines.groupBy(*PAIR, "item_qty").agg(F.count(F.lit(1)).alias("trans_cnt"))
    pair = Window.partitionBy(*PAIR)
    return counts.select(
        *PAIR,
        F.count(F.lit(1)).over(pair).alias("max_pkey"),
        F.row_number().over(pair.orderBy(F.desc("item_qty"))).alias("pkey"),
        "item_qty",
        "trans_cnt",
    )


def split_space(hist: DataFrame) -> DataFrame:
    """Number of ways to cut each pair's quantities into three groups.

    With fewer than three distinct quantities there is one way, with empty
    groups.
    """
    n = F.col("max_pkey")
    ways = F.when(n < 3, F.lit(1)).otherwise(((n - 1) * (n - 2) / 2).cast("long"))
    return hist.groupBy(*PAIR).agg(F.max("max_pkey").alias("max_pkey")).withColumn(
        "n_splits", ways.cast("long")
    )


def _splits(hist: DataFrame, only_best: bool) -> DataFrame:
    """Splits of each pair's quantities, searched inside one row per pair."""
    entry = F.struct("pkey", F.coalesce("item_qty", F.lit(0)).cast("long").alias("q"), F.col("trans_cnt").cast("long").alias("c"))
    nested = hist.groupBy(*PAIR, "max_pkey").agg(F.array_sort(F.collect_list(entry)).alias("h")).select(
        *PAIR, "max_pkey", F.col("h.q").alias("quantities"), F.col("h.c").alias("counts"))
    keys = [*PAIR, "max_pkey"]
    schema = ", ".join(f"{c} {hist.schema[c].dataType.simpleString()}" for c in keys)
    found = nested.mapInArrow(split_batches(keys, only_best), f"{schema}, {STATS}")
    return found.withColumn("sse", F.round("sse", 6))


def cluster_sse(hist: DataFrame) -> DataFrame:
    """For every start of the second group the best start of the third.

    Columns: the pair, max_pkey, k2_start, k3_start, sse (6 decimals), and mean,
    stddev and cnt of the groups k1, k2 and k3 (NULL if empty).  One row per
    start, found in n log n steps.  Equal sums of errors are decided by the
    smaller k3_start.
    """
    return _splits(hist, only_best=False)


def winning_split(hist: DataFrame) -> DataFrame:
    """As :func:`cluster_sse`, but only the pair's best split leaves its row."""
    return _splits(hist, only_best=True)


def cluster_means(splits: DataFrame) -> DataFrame:
    """Mean, deviation and count of the three groups of each given split."""
    return splits.select(
        *PAIR, "max_pkey", "k2_start", "k3_start", "sse",
        *[f"{group}_{name}" for group in GROUPS for name in ("mean", "stddev", "cnt")],
    )


def best_split(splits: DataFrame, as_of: dt.date) -> DataFrame:
    """The split with the least error per pair; ties take the earlier starts.

    ``splits`` comes from :func:`cluster_sse`.  Columns: top_, mid_ and bot_
    jlq (mean), stddev and freq (baskets).
    """
    others = [c for c in splits.columns if c not in PAIR and c not in ("sse", "k2_start", "k3_start")]
    best = splits.groupBy(*PAIR).agg(F.min(F.struct("sse", "k2_start", "k3_start", *others)).alias("b"))
    return name_groups(best.select(*PAIR, "b.*"), as_of)


def name_groups(chosen: DataFrame, as_of: dt.date) -> DataFrame:
    """Groups of one split per pair by their names, with the date."""
    names = {"k1": "top", "k2": "mid", "k3": "bot"}
    return chosen.select(
        *PAIR,
        F.lit(as_of).alias("last_upd_dt"),
        *[
            F.col(f"{group}_{stat}").alias(f"{name}_{label}")
            for group, name in names.items()
            for stat, label in (("mean", "jlq"), ("stddev", "stddev"), ("cnt", "freq"))
        ],
    )


def choose_cluster(best: DataFrame, inv: DataFrame, prefs: DataFrame, as_of: dt.date) -> DataFrame:
    """Largest group whose baskets, with those above it, are frequent enough.

    Kept if its size lies within the preference; a maximum of 0 means none.
    """
    classes = snapshot(inv, as_of).filter(F.col("reple_ind") == 1).select(
        *PAIR, "sub_dept", "class_nbr", "sub_class_nbr"
    )
    limits = prefs.select(
        "sub_dept", "class_nbr", F.col("sc_nbr").alias("sub_class_nbr"),
        "min_jlq_freq", "min_jlq_size", "max_jlq_size",
    )
    top = F.col("top_freq")
    mid = top + F.col("mid_freq")
    bot = mid + F.col("bot_freq")
    need = F.col("min_jlq_freq")

    def first_frequent(a, b, c) -> Column:
        return F.when(top >= need, a).when(mid >= need, b).when(bot >= need, c)

    largest = F.when(F.col("max_jlq_size") == 0, NO_MAX_SIZE).otherwise(
        F.coalesce("max_jlq_size", F.lit(NO_MAX_SIZE))
    )
    return (
        best.join(classes, PAIR)
        .join(limits, ["sub_dept", "class_nbr", "sub_class_nbr"])
        .select(
            *PAIR,
            F.lit(as_of).alias("last_upd_dt"),
            first_frequent(F.col("top_jlq"), F.col("mid_jlq"), F.col("bot_jlq")).alias("jlq"),
            first_frequent(
                F.col("top_stddev"), F.col("mid_stddev"), F.col("bot_stddev")
            ).alias("stddev"),
            first_frequent(top, mid, bot).alias("freq"),
            F.col("min_jlq_size").alias("_min"),
            largest.alias("_max"),
        )
        .filter(F.col("jlq").between(F.col("_min"), F.col("_max")))
        .drop("_min", "_max")
    )


def seasonal_frequency(
    subset: DataFrame, factors: DataFrame, inv: DataFrame, calendar: DataFrame, as_of: dt.date
) -> DataFrame:
    """Yearly frequency scaled to the coming weeks, with lead and review days."""
    newest = factors.agg(F.max("sf_calc_date")).scalar()
    names = [f"sf{i:02d}" for i in range(1, 53)]
    week = calendar.filter(F.col("cal_dt") == F.lit(as_of)).select("fscl_wk_nbr").scalar()
    latest = factors.filter(F.col("sf_calc_date") == newest).withColumn("_week", week)
    seasons = latest.select("sku", "store", forward_season(names, "_week").alias("f4_sf"))
    days = snapshot(inv, as_of).filter(
        (F.col("reple_ind") == 1)
        & F.col("rev_tm_days").isNotNull()
        & F.col("lead_tm_days").isNotNull()
    ).select(
        *PAIR, F.least(F.col("rev_tm_days") + F.col("lead_tm_days"), F.lit(MAX_DAYS)).alias("rtlt")
    )
    lo, hi = FREQ_RANGE
    scaled = F.round(F.col("freq") * F.col("f4_sf"))
    clamped = F.when(scaled > hi, hi).when(scaled < lo, lo).otherwise(scaled).cast("long")
    return (
        subset.join(seasons, ["sku", "store"])
        .join(days, PAIR)
        .filter(F.col("f4_sf") > MIN_SEASON)
        .withColumn("adj_freq", clamped)
    )


def default_multiples(spark: SparkSession) -> DataFrame:
    """Safety multiple per lead days (0..50) and frequency (3..500).

    The number of large baskets during the lead time that is not exceeded in
    85 of 100 cases, for Poisson arrivals, limited to 1..5.  A planner's own
    table may be passed instead.  The size is fixed by the two ranges.
    """
    lo, hi = FREQ_RANGE
    grid = spark.range(0, MAX_DAYS + 1, 1, 1).select(
        F.col("id").cast("int").alias("rtlt"),
        F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("freq"),
    )
    rate = F.col("freq") * F.col("rtlt") / YEAR_DAYS
    term, reached, multiple = F.exp(-rate), F.exp(-rate), F.lit(1.0)
    for k in range(1, 5):
        term = term * rate / k
        reached = reached + term
        multiple = multiple + F.when(reached < SERVICE_LEVEL, 1.0).otherwise(0.0)
    return grid.select("rtlt", "freq", multiple.alias("prob_85"))


def safety_multiple(freq: DataFrame, lookup: DataFrame) -> DataFrame:
    """Minimum covering several large baskets in the lead time, rounded up."""
    table = lookup.select("rtlt", F.col("freq").alias("adj_freq"), F.col("prob_85").alias("jlq_mult"))
    m = F.col("jlq_mult")
    full = F.ceil(F.col("jlq") * m + F.sqrt(m) * F.col("stddev"))
    return freq.join(table, ["rtlt", "adj_freq"]).withColumn(
        "full_jlq", F.when(m.isin(*MULTIPLES), full)
    )


def stamp_weeks(result: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """The result once for the end of each of the next two fiscal weeks."""
    coming = [as_of + dt.timedelta(days=7), as_of + dt.timedelta(days=14)]
    weeks = calendar.filter(F.col("cal_dt").isin(coming))
    return cross_grid(result, date_array(weeks, "fscl_wk_end_dt"), "fscl_wk_end_dt")


def parm_upload(
    result: DataFrame, items: DataFrame, prefs: DataFrame, calendar: DataFrame, as_of: dt.date
) -> DataFrame:
    """Upload rows: one parameter value per store and SKU, with its validity.

    Method 1 uploads the basket size, FULL the size with safety, BYPASS none.
    """
    week = calendar.filter(
        (F.col("fscl_wk_bgn_dt") <= F.lit(as_of))
        & (F.col("fscl_wk_end_dt") >= F.lit(as_of))
        & (F.col("day_of_wk_nbr") == 5)
    )
    begin, number = week.select("cal_dt").scalar(), week.select("fscl_wk_nbr").scalar()
    classes = latest_items(items, known_dept=True).select(
        "sku", "sku_crt_dt", "sub_dept", "class_nbr", "sub_class_nbr"
    )
    methods = prefs.select(
        "sub_dept", "class_nbr", F.col("sc_nbr").alias("sub_class_nbr"), "jlq_method"
    ).filter(F.col("jlq_method") != "BYPASS")
    value = F.when(F.col("jlq_method") == "1", F.ceil("jlq")).when(
        F.col("jlq_method") == "FULL", F.col("full_jlq")
    )
    unset = F.lit(None).cast("string")
    return (
        result.join(classes, ["sku", "sku_crt_dt"])
        .join(methods, ["sub_dept", "class_nbr", "sub_class_nbr"])
        .select(
            F.lit(UPLOAD_LEVEL).alias("trumping_level"),
            F.lit(UPLOAD_TYPE).alias("type"),
            unset.alias("store_group"),
            unset.alias("volume_id"),
            unset.alias("velocity_id"),
            "sku",
            unset.alias("sku_grp"),
            "store",
            F.lit(UPLOAD_CODE).alias("parm_code"),
            value.alias("parm_value"),
            format_date(begin).alias("eff_begin_date"),
            format_date(F.date_add(begin, UPLOAD_DAYS)).alias("eff_end_date"),
            unset.alias("start_fscl_wk_nbr"),
            unset.alias("end_fscl_wk_nbr"),
            week_label(LABEL, number).alias("param_desc"),
            unset.alias("ootl_reason_code"),
        )
    )


def lead_review_demand(stores: DataFrame, parms: DataFrame) -> DataFrame:
    """Lead and review demand and days per store and SKU."""
    wanted = parms.filter(F.col("parm_cd").isin(*DEMAND_CODES))
    return stores.select("store", "bu_id").join(wanted, "bu_id").groupBy("store", "sku").agg(
        F.sum("dec_val").alias("lt_rt_qty"), F.sum("int_val").alias("lt_rt_days")
    )


def impact_detail(
    inv: DataFrame, upload: DataFrame, items: DataFrame, demand: DataFrame, as_of: dt.date
) -> DataFrame:
    """Order-up-to levels, orders and amounts before and after an upload."""
    orderable = snapshot(inv, as_of).filter(
        (F.col("reple_ind") == 1) & (F.col("ok_to_ord") == "Y")
    ).drop("sub_dept")
    changes = upload.filter(F.col("parm_value") != 0).select(
        "sku", "store", F.col("parm_value").cast("double").alias("new_jlq")
    )
    described = latest_items(items).select("sku", "sku_crt_dt", "sub_dept")
    base = (
        orderable.join(changes, ["sku", "store"])
        .join(described, ["sku", "sku_crt_dt"])
        .join(demand.select("store", "sku", "lt_rt_qty"), ["store", "sku"], "left")
    )
    zero = F.lit(0.0)
    on_order = (
        F.col("oh_qty") + F.col("oo_qty")
        + F.coalesce("expctd_alloc_qty", zero) + F.coalesce("conf_alloc_qty", zero)
    )
    retail = F.col("curr_retl_amt")
    levels = base.withColumns(
        {
            "eff_oo_qty": on_order,
            "curr_outl_no_max_qty": order_up_to_level(cap=False),
            "curr_outl_qty": order_up_to_level(),
            "new_outl_qty": order_up_to_level(new_min="new_jlq"),
            "trgt_oh_amt": F.col("trgt_oh_qty") * retail,
        }
    )
    pack = F.col("buy_uom_qty")
    ordered = levels.withColumns(
        {
            "curr_outl_amt": F.col("curr_outl_qty") * retail,
            "new_outl_amt": F.col("new_outl_qty") * retail,
            "curr_ord_qty": ceil_to_pack(F.col("curr_outl_qty") - F.col("eff_oo_qty"), pack),
            "new_ord_qty": ceil_to_pack(F.col("new_outl_qty") - F.col("eff_oo_qty"), pack),
        }
    )
    return ordered.withColumns(
        {
            "curr_ord_amt": F.col("curr_ord_qty") * retail,
            "new_ord_amt": F.col("new_ord_qty") * retail,
            "outl_diff_amt": F.col("trgt_oh_amt") - F.col("curr_outl_amt"),
            "outl_impact_amt": F.col("new_outl_amt") - F.col("curr_outl_amt"),
            "changed": F.when(F.col("new_outl_amt") != F.col("curr_outl_amt"), 1).otherwise(0),
        }
    )


def impact_report(
    inv: DataFrame, upload: DataFrame, items: DataFrame, demand: DataFrame, as_of: dt.date
) -> DataFrame:
    """Impact of an upload by sub-department with a grand total."""
    detail = impact_detail(inv, upload, items, demand, as_of)
    sums = {
        "outl_impact_sku_str_count": "changed",
        "trgt_oh_qty": "trgt_oh_qty",
        "trgt_oh_amt": "trgt_oh_amt",
        "curr_outl_calc_qty": "curr_outl_qty",
        "curr_outl_calc_amt": "curr_outl_amt",
        "outl_diff_amt": "outl_diff_amt",
        "new_outl_calc_qty": "new_outl_qty",
        "new_outl_calc_amt": "new_outl_amt",
        "outl_impact_amt": "outl_impact_amt",
    }
    aggs = {"total_str_sku_cnt": F.count(F.lit(1))}
    aggs.update({name: F.sum(c) for name, c in sums.items()})
    return with_total(detail, "sub_dept", aggs)


def basket_minimums(
    trans: DataFrame, items: DataFrame, inv: DataFrame, prefs: DataFrame, demand: DataFrame,
    factors: DataFrame, lookup: DataFrame, calendar: DataFrame, as_of: dt.date,
) -> DataFrame:
    """The whole calculation, from transactions to minimums."""
    lines = basket_lines(trans, calendar, active_items(items, inv, prefs, as_of), as_of)
    hist = qty_histogram(demand_cap(lines, demand))
    best = name_groups(winning_split(hist), as_of)
    chosen = choose_cluster(best, inv, prefs, as_of)
    return safety_multiple(seasonal_frequency(chosen, factors, inv, calendar, as_of), lookup)


__all__ = [
    "active_items", "basket_lines", "basket_minimums", "best_split", "choose_cluster",
    "cluster_means", "cluster_sse", "default_multiples", "demand_cap", "impact_detail",
    "impact_report", "lead_review_demand", "name_groups", "parm_upload", "qty_histogram",
    "safety_multiple", "seasonal_frequency", "split_space", "stamp_weeks", "winning_split",
]
