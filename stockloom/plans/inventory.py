"""Columns and arithmetic shared by the inventory-minimum pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions import max_of_buckets
from stockloom.operators.joins import latest_version

# Minimum buckets of the daily inventory table.  Commitment
# buckets add up; the others compete with that sum.
COMMITTED_BUCKETS = (
    "cmtd_min_map_qty", "cmtd_min_xmer_qty", "cmtd_min_bulk_wall_qty", "mohq_prst_qty",
)
BULK_BUCKET, BASKET_BUCKET = "mohq_bulk_dspl_qty", "mohq_jlq_qty"
SINGLE_BUCKETS = (
    "mohq_ad_qty", "mohq_jlq_qty", "mohq_fld_rqst_qty", "mohq_wos_min_qty",
    "mohq_spprt_new_item_qty", "mohq_bulk_dspl_qty", "mohq_non_spi_prst_qty",
    "mohq_inv_soln_team_qty",
)
SAFETY_STOCK = "sfty_stk_qty"
# Fixed value: age in days of the inventory snapshot a run works on.
SNAPSHOT_AGE = 2


def snapshot(inv: DataFrame, as_of) -> DataFrame:
    """The inventory snapshot of a run; a literal date, so partitions prune."""
    return inv.filter(F.col("cal_dt") == F.date_sub(F.lit(as_of), SNAPSHOT_AGE))


def latest_items(items: DataFrame, known_dept: bool = False) -> DataFrame:
    """Newest version of every SKU, optionally only those in a sub-department."""
    newest = latest_version(items, ["sku"], "sku_crt_dt")
    return newest.filter(F.col("sub_dept").isNotNull()) if known_dept else newest


def order_up_to_level(new_min: str | None = None, cap: bool = True) -> Column:
    """Stock level orders are raised to, rounded up.

    Lead and review time demand (with ``lt_rt_qty`` as fallback), plus the
    largest minimum bucket, plus committed stock; at most the maximum
    inventory unless ``cap`` is off.  ``new_min`` replaces the basket bucket.
    """
    zero = F.lit(0.0)
    demand = F.coalesce(F.col("lead_tm_qty") + F.col("rev_tm_qty"), F.col("lt_rt_qty"), zero)
    if new_min is None:
        floor = max_of_buckets(COMMITTED_BUCKETS, (*SINGLE_BUCKETS, SAFETY_STOCK))
    else:
        others = [b for b in SINGLE_BUCKETS if b != BASKET_BUCKET]
        floor = max_of_buckets(COMMITTED_BUCKETS, (*others, SAFETY_STOCK, new_min))
    committed = F.coalesce("subparm_cmtd_stk_qty", "cmtd_stk_qty", zero)
    level = demand + floor + committed
    if cap:
        level = F.when(level > F.col("max_inv_qty"), F.col("max_inv_qty")).otherwise(level)
    return F.ceil(level)
