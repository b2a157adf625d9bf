"""Purchase orders: priority boost and truck filling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stockloom.operators.joins import contains_any
from stockloom.operators.windows import join_back, split_running_sum
from stockloom.session import materialise

# Priority added for wanted SKUs, and truck capacity in cube.
BOOST, CAPACITY = 50_000, 2_400.0
# Candidates of a store that one task may fill from, about 100 bytes each.
GROUP_ROWS = 200_000


def boost_priority(
    orders: DataFrame, items: DataFrame, boost: int = BOOST,
    store: str = "store", po: str = "po",
) -> DataFrame:
    """Orders that contain a priority SKU move up by ``boost``."""
    flagged = contains_any(orders, "skus", items, "sku", [store, po], "_wanted")
    gain = F.when(F.col("_wanted"), F.lit(boost)).otherwise(F.lit(0))
    return flagged.withColumn("new_priority", F.col("priority") + gain).drop("_wanted")


def _candidates(orders: DataFrame, cap: float, group_rows: int) -> DataFrame:
    """Orders that a greedy fill may still take, few enough per store.

    Room on a truck only shrinks.  The first orders of a store whose cubes
    together fit are certain to be taken; after them every order larger than
    the room they leave is certain to be skipped.  Rounds of this go on until
    no store has more than ``group_rows`` candidates or nothing is left to
    drop.  The running sums are split, so a hot store is reduced in parallel;
    the tolerance covers the different order in which they add up.
    """
    slack = cap * 1e-9
    left = orders.filter((F.col("cube") > 0) & (F.col("cube") <= cap))
    while True:
        sizes = left.groupBy("store").agg(F.count(F.lit(1)).alias("n"))
        most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) <= group_rows:
            return left
        run = split_running_sum(
            left, ["store"], "new_priority", F.col("cube"), "_run", ties=["po"], descending=True
        )
        sure = F.col("_run") <= cap - slack
        rooms = run.groupBy("store").agg(
            (cap - F.coalesce(F.max(F.when(sure, F.col("_run"))), F.lit(0.0))).alias("_room")
        )
        kept = join_back(run, rooms, ["store"]).filter(sure | (F.col("cube") <= F.col("_room") + slack))
        left = materialise(kept.drop("_run", "_room"), "truck")
        if left.count() == rows:
            return left


def build_truck(
    orders: DataFrame, cap: float = CAPACITY, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Which orders go on each store's next truck.

    Columns needed: store, po, new_priority, cube (not negative); ``po`` is
    unique within a store.  By falling priority, then order number, an order
    is included if it still fits, else skipped.  Adds ``included``.

    The greedy pass itself is sequential per store.  It runs on a store's
    candidates, which are first reduced in parallel to ``group_rows`` or to the
    orders that one truck takes, whichever is more.  Orders without volume
    always fit.  ``orders`` is read several times, so pass a written table.
    """
    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["new_priority", "po"], ascending=[False, True], kind="stable")
        used, taken = 0.0, np.zeros(len(pdf), dtype=bool)
        for i, cube in enumerate(pdf["cube"].to_numpy()):
            if used + cube <= cap:
                taken[i] = True
                used += cube
        return pdf.loc[taken, ["store", "po"]]

    possible = _candidates(orders.select("store", "po", "new_priority", "cube"), cap, group_rows)
    types = {f.name: f.dataType.simpleString() for f in orders.schema}
    loaded = possible.groupBy("store").applyInPandas(
        fill, f"store {types['store']}, po {types['po']}"
    )
    weightless = orders.filter(F.col("cube") == 0).select("store", "po")
    chosen = loaded.unionByName(weightless).withColumn("included", F.lit(True))
    return orders.join(chosen, ["store", "po"], "left").withColumn(
        "included", F.coalesce("included", F.lit(False))
    )


def check_capacity(loaded: DataFrame, cap: float = CAPACITY) -> DataFrame:
    """Stores whose included orders exceed the capacity; none, if all is well."""
    return (
        loaded.filter("included")
        .groupBy("store")
        .agg(F.sum("cube").alias("included_cube"))
        .filter(F.col("included_cube") > cap)
    )
