"""Bulk-price minimum: quantity price tiers turned into inventory minimums."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions import cap_value, max_of_buckets, pad_dept, strict_greatest, unpad_dept
from stockloom.operators.filters import ACTIVE_STATUS, ANY_VELOCITY_DEPTS, SLOW_VELOCITY
from stockloom.operators.joins import anti_missing, latest_version, semi_in, two_grain_override
from stockloom.plans.inventory import (
    BULK_BUCKET,
    COMMITTED_BUCKETS,
    SAFETY_STOCK,
    SINGLE_BUCKETS,
    latest_items,
    snapshot,
)

# Codes of open price rows, the tier used, the feed switch and
# the subparameter of the bulk minimum.
OPEN_END, INSERTED, FIRST_TIER = "9999-12-31", "I", 1
FEED_ON, DEFAULT_MULTIPLIER = "ON", "1"
BULK_CODE, RETAIL_METHOD = 1707, 1
WEEKS_OF_SALES = 8
STATUSES = ("ADDED", "REMOVED", "REDUCED", "INCREASED", "NO CHANGE")


class MissingSettings(ValueError):
    """Priced sub-classes without a setting; the run must not go on."""


def current_prices(prices: DataFrame) -> DataFrame:
    """Newest price row per SKU, market and tier, if it is an open one."""
    newest = latest_version(prices, ["sku", "mkt", "tier"], "eff_bgn")
    return newest.filter(
        (F.col("row_end_dt") == F.lit(OPEN_END).cast("date")) & (F.col("row_action") == INSERTED)
    )


def _settings(settings: DataFrame) -> DataFrame:
    return settings.select(
        pad_dept("dept").alias("sub_dept"),
        "class_nbr",
        F.col("sc_nbr").alias("sub_class_nbr"),
        "bulk_price_inv_feed",
        "bulk_price_multiplier",
    )


CLASS_KEYS = ["sub_dept", "class_nbr", "sub_class_nbr"]


def missing_settings(
    prices: DataFrame, items: DataFrame, settings: DataFrame, inv: DataFrame, as_of: dt.date
) -> DataFrame:
    """Active priced SKUs whose sub-class has no setting, with defaults."""
    stocked = snapshot(inv, as_of).filter(
        F.col("sku_stat_cd").isin(*ACTIVE_STATUS) & (F.col("reple_ind") == 1)
    )
    priced = semi_in(latest_items(items), current_prices(prices), ["sku"])
    unset = anti_missing(semi_in(priced, stocked, ["sku"]), _settings(settings), CLASS_KEYS)
    return unset.select(
        "sku", "sub_dept", "class_nbr", "class_desc", "sub_class_nbr", "sub_class_desc",
        F.lit(FEED_ON).alias("bulk_price_inv_feed"),
        F.lit(DEFAULT_MULTIPLIER).alias("bulk_price_multiplier"),
    ).distinct()


def require_settings(missing: DataFrame) -> None:
    """Stop if any SKU lacks a setting; looks at one row only."""
    if missing.limit(1).count():
        raise MissingSettings("there are priced sub-classes without a bulk setting")


def active_tiers(
    prices: DataFrame, locations: DataFrame, items: DataFrame, calendar: DataFrame,
    overrides: DataFrame, as_of: dt.date, inv: DataFrame | None = None, weeks_back: int = 0,
) -> DataFrame:
    """First-tier quantities per store in force in a fiscal week.

    Prices are per market and spread to the market's open stores; overrides
    are those in force on ``as_of``.  With ``inv`` only stocked items remain.
    """
    day = as_of - dt.timedelta(weeks=weeks_back)
    week = calendar.filter(F.col("cal_dt") == F.lit(day)).select("fscl_wk_bgn_dt").scalar()
    live = current_prices(prices).filter(
        (F.col("tier") == FIRST_TIER) & (F.col("eff_bgn") < week) & (F.col("eff_end") >= week)
    )
    stores = locations.filter(F.col("cls_dt") > F.lit(as_of)).select("mkt", F.col("store").alias("loc"))
    versions = latest_items(items).filter(F.col("sku_stat_cd").isin(*ACTIVE_STATUS)).select(
        "sku", "sku_crt_dt"
    )
    spread = live.join(stores, "mkt").join(versions, "sku")
    extra: list[str] = []
    if inv is not None:
        stocked = snapshot(inv, as_of).filter(
            F.col("sku_stat_cd").isin(*ACTIVE_STATUS) & (F.col("reple_ind") == 1)
        ).select("sku", F.col("store").alias("loc"), "sku_stat_cd", "reple_ind")
        spread = spread.join(stocked, ["sku", "loc"])
        extra = ["sku_stat_cd", "reple_ind"]
    columns = spread.select(
        "sku", "mkt", "sku_crt_dt", "vol_disc_min_qty", "vol_disc_pct", "loc", "eff_end",
        "eff_bgn", F.lit(1).alias("mkt_lvl"), *extra,
    )
    return two_grain_override(columns, overrides, "sku", "loc", "vol_disc_min_qty", as_of)


def _status(new: Column, last: Column, in_new: Column, in_last: Column) -> Column:
    return (
        F.when(in_last.isNull(), "ADDED")
        .when(in_new.isNull(), "REMOVED")
        .when(new < last, "REDUCED")
        .when(new > last, "INCREASED")
        .when(new == last, "NO CHANGE")
    )


def tier_diff(base: DataFrame, new: DataFrame, last: DataFrame) -> DataFrame:
    """Base rows priced in either week, with both quantities and the change."""
    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            "sku",
            F.col("loc").alias("store"),
            F.col("vol_disc_min_qty").alias(f"{prefix}_bulk_price_qty"),
            F.lit(True).alias(f"_{prefix}"),
        )

    joined = base.join(side(new, "new"), ["sku", "store"], "left").join(
        side(last, "lw"), ["sku", "store"], "left"
    )
    status = _status(
        F.col("new_bulk_price_qty"), F.col("lw_bulk_price_qty"), F.col("_new"), F.col("_lw")
    )
    return (
        joined.filter(F.col("_new").isNotNull() | F.col("_lw").isNotNull())
        .withColumn("status", status)
        .drop("_new", "_lw")
    )


def _sold_well(velocity: str, dept: str) -> Column:
    always = F.col(dept).isin(*ANY_VELOCITY_DEPTS)
    return always | ~F.col(velocity).isin(*SLOW_VELOCITY)


def bulk_minimum(
    inv: DataFrame, new: DataFrame, last: DataFrame, items: DataFrame, settings: DataFrame,
    exclude: DataFrame, velocity: DataFrame, as_of: dt.date,
) -> DataFrame:
    """Current and new bulk minimum per store and SKU with their difference."""
    stocked = snapshot(inv, as_of).filter(
        (F.col("rmeth_cd") == RETAIL_METHOD)
        & (F.col("reple_ind") == 1)
        & _sold_well("vlcty_cd", "dept_nbr")
    ).drop("sub_dept", "class_nbr", "sub_class_nbr")
    classes = latest_items(items, known_dept=True).select("sku", "sku_crt_dt", *CLASS_KEYS)
    switched_on = _settings(settings).filter(F.col("bulk_price_inv_feed") == FEED_ON).select(
        *CLASS_KEYS, "bulk_price_multiplier"
    )
    base = anti_missing(stocked, exclude.select(F.col("sku_nbr").alias("sku")), ["sku"]).join(
        classes, ["sku", "sku_crt_dt"]
    ).join(switched_on, CLASS_KEYS)
    moved = tier_diff(base, new, last)
    zero = F.lit(0.0)
    committed = reduce(
        lambda a, b: a + b, [F.coalesce(F.col(c), zero) for c in COMMITTED_BUCKETS]
    )
    others = [b for b in SINGLE_BUCKETS if b != BULK_BUCKET]
    non_bulk = F.when(
        F.col(SAFETY_STOCK).isNotNull(), max_of_buckets(COMMITTED_BUCKETS, (*others, SAFETY_STOCK))
    )
    measured = moved.select(
        "sku", "sku_crt_dt", "store", "status", "curr_retl_amt",
        *[F.coalesce(F.col(b), zero).alias(b) for b in ("mohq_prst_qty", *SINGLE_BUCKETS)],
        "subparm_min_oh_qty", "wng_mohq_subparm_cd", SAFETY_STOCK,
        committed.alias("com_min_qty"),
        F.col(BULK_BUCKET).alias("curr_bulk_min_qty"),
        strict_greatest("subparm_min_oh_qty", SAFETY_STOCK).alias("curr_sysmohq"),
        non_bulk.alias("non_bulk_sysmohq"),
        "lw_bulk_price_qty",
        "new_bulk_price_qty",
        F.coalesce(F.col("new_bulk_price_qty") * F.col("bulk_price_multiplier"), zero).alias(
            "new_bulk_min_qty"
        ),
    ).distinct()
    bulk_driven = (F.col("wng_mohq_subparm_cd") == BULK_CODE) & (
        F.col("subparm_min_oh_qty") > F.col(SAFETY_STOCK)
    )
    unchanged = F.col("new_bulk_min_qty") == F.col("curr_bulk_min_qty")
    new_system = F.when(unchanged, F.col("curr_sysmohq")).otherwise(
        F.greatest(F.coalesce("non_bulk_sysmohq", zero), F.col("new_bulk_min_qty"))
    )
    result = measured.withColumns(
        {
            "current_bulk_driven_qty": F.when(bulk_driven, F.col("subparm_min_oh_qty")).otherwise(zero),
            "curr_bulk_incremental": F.when(
                bulk_driven, F.col("curr_sysmohq") - F.col("non_bulk_sysmohq")
            ).otherwise(zero),
            "new_sysmohq": new_system,
            "new_bulk_incremental": strict_greatest(
                F.col("new_bulk_min_qty") - F.col("non_bulk_sysmohq"), zero
            ),
            "new_units": new_system - F.col("curr_sysmohq"),
        }
    )
    sellers = velocity.filter(_sold_well("sku_vlcty_cd", "mer_dept_nbr")).select("sku", "store")
    return result.join(sellers, ["sku", "store"])


def _last_closed_week(calendar: DataFrame, as_of: dt.date, years_back: int) -> Column:
    """End of the last fiscal week closed before a date, or of its namesake."""
    weeks = calendar.filter(F.col("cal_dt") == F.col("fscl_wk_end_dt"))
    closed = weeks.filter(F.col("cal_dt") < F.lit(as_of)).agg(
        F.max_by(F.struct("fscl_yr", "fscl_wk_nbr"), "cal_dt").alias("w")
    )
    year = closed.select("w.fscl_yr").scalar() - years_back
    week = closed.select("w.fscl_wk_nbr").scalar()
    same = weeks.filter((F.col("fscl_yr") == year) & (F.col("fscl_wk_nbr") == week))
    return same.agg(F.max("cal_dt")).scalar()


def _weekly_sums(diag: DataFrame, weekly: DataFrame, week: Column, aggs: list[Column]) -> DataFrame:
    """Weekly figures of the diagnosed pairs; the week filter prunes the scan."""
    pairs = diag.select("sku", "store")
    return pairs.join(weekly.filter(F.col("week_end_dt") == week), ["sku", "store"]).groupBy(
        "sku"
    ).agg(*aggs)


def investment_report(
    diag: DataFrame, items: DataFrame, weekly: DataFrame, calendar: DataFrame, as_of: dt.date
) -> DataFrame:
    """Counts and amounts per SKU by kind of change, with stock and sales."""
    classes = latest_items(items, known_dept=True).select(
        "sku", "sku_crt_dt", "sub_dept", "class_nbr", "class_desc", "sub_class_nbr", "sub_class_desc"
    )
    retail, status = F.col("curr_retl_amt"), F.col("status")
    effect = F.col("new_units") * retail

    def effect_of(name: str) -> Column:
        return F.sum(F.when(status == name, effect).otherwise(F.lit(0.0)))

    per_sku = (
        diag.join(classes, ["sku", "sku_crt_dt"])
        .groupBy(
            unpad_dept("sub_dept").alias("dept"),
            F.col("class_nbr").alias("class_number"),
            F.col("class_desc").alias("class_name"),
            F.col("sub_class_nbr").alias("subclass"),
            F.col("sub_class_desc").alias("subclass_name"),
            "sku",
        )
        .agg(
            F.count(F.lit(1)).alias("stores_with_bulk_price_qty"),
            F.sum(F.when(status == "ADDED", 1).otherwise(0)).alias("new_stores_with_bulk_price_qty"),
            F.sum(F.col("curr_sysmohq") * retail).alias("current_sysmohq_dlrs"),
            F.sum(F.col("curr_bulk_incremental") * retail).alias("current_bulk_contribution"),
            F.sum(F.col("new_bulk_incremental") * retail).alias("new_bulk_contribution"),
            F.sum(effect).alias("net_impact"),
            F.sum(F.when(status != "REMOVED", effect).otherwise(F.lit(0.0))).alias("net_impact_effective"),
            effect_of("ADDED").alias("new_str_sku_impact"),
            effect_of("INCREASED").alias("higher_qty_impact"),
            effect_of("REMOVED").alias("removed_str_sku_impact"),
            effect_of("REDUCED").alias("lower_qty_impact"),
            effect_of("NO CHANGE").alias("other_impact"),
        )
    )
    sales = F.coalesce(F.sum("r8w_avg_sls_amt") * WEEKS_OF_SALES, F.lit(0.0))
    stock = F.coalesce(F.sum(F.col("oh_qty") * F.col("curr_retl_amt")), F.lit(0.0))
    this_year = _weekly_sums(
        diag, weekly, _last_closed_week(calendar, as_of, 0),
        [stock.alias("current_oh_ret"), sales.alias("r8w_ret_sls_ty")],
    )
    last_year = _weekly_sums(
        diag, weekly, _last_closed_week(calendar, as_of, 1), [sales.alias("r8w_ret_sls_ly")]
    )
    return per_sku.join(this_year, "sku", "left").join(last_year, "sku", "left").distinct()


def removed_items(last: DataFrame, new: DataFrame, items: DataFrame) -> DataFrame:
    """SKUs priced last week but not this week, with their hierarchy."""
    keys = ["sku", "sku_crt_dt"]
    gone = anti_missing(last.select(*keys).distinct(), new.select(*keys), keys)
    return gone.join(latest_items(items, known_dept=True), keys).select(
        "sku_crt_dt",
        unpad_dept("sub_dept").alias("dept"),
        F.col("class_nbr").alias("class_number"),
        F.col("class_desc").alias("class_name"),
        F.col("sub_class_nbr").alias("subclass"),
        F.col("sub_class_desc").alias("subclass_name"),
        "sku",
    )


def parm_export(parms: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """Upload rows of the current fiscal week's first day, values capped."""
    monday = calendar.filter(F.col("cal_dt") == F.lit(as_of)).select("fscl_wk_bgn_dt").scalar()
    return (
        parms.filter(F.col("upload_dt") == monday)
        .withColumn("parm_value", cap_value("parm_value"))
        .drop("upload_dt")
    )
