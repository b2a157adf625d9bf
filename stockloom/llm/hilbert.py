"""Shards cut from a Hilbert curve through several metadata dimensions.

Each dimension is quantised at its own quantiles, the cells are numbered along
a Hilbert curve, and runs of the curve become shards with row counts at most
one apart.  Rows near each other in all dimensions share a shard, so a reader
that filters on any of them skips most files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import in_ranges, with_before, with_python

BITS = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve positions of integer points, one row per point.

    Public method of J. Skilling, "Programming the Hilbert curve" (2004):
    undo the excess rotations from the highest bit down, Gray-encode, then
    interleave the bits.
    """
    x = cells.astype(np.uint64).T.copy()
    one, dims = np.uint64(1), len(x)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        low = bit - one
        for i in range(dims):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - one), turn)
    x ^= turn
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | ((x[i] >> np.uint64(level)) & one)
    return out.astype(np.int64)


def with_rank(df: DataFrame, c: str, name: str) -> DataFrame:
    """Adds ``name``, the place of the whole text in column ``c`` among the
    distinct ones, from 0; null has none.  ``name`` and ``part`` must not be in
    ``df``."""
    values = df.select(F.col(c).alias("_value")).where("_value is not null").distinct()
    ranked = with_before(in_ranges(values, ["_value"], "ranks"), ["_value"], {name: F.lit(1).cast("long")})
    return df.join(ranked, F.col(c) == F.col("_value"), "left").drop("_value")


def boundaries(df: DataFrame, dims: list[str], bits: int) -> list[np.ndarray]:
    """At most 2^bits - 1 distinct quantiles of each numeric column."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in dims]).first()
    return [np.unique(np.array(row[c] or [], dtype=float)) for c in dims]


def hilbert_shards(df: DataFrame, dims: dict[str, Column], tie: list[str], shards: int, bits: int = BITS) -> DataFrame:
    """``df`` with curve (index), shard and slot (place in the shard from 0).

    ``dims`` maps names to numeric columns; nulls count as below all values.
    ``tie`` names the columns that order rows of one cell, nulls first; rows equal
    in them are interchangeable, and are told apart by a running number, so that
    however many of them there are, they span ranges like others.  Columns of ``df`` named curve, shard or slot give
    way to the result's; all others, whatever their names, are as they were.  An
    empty table gives an empty result.
    """
    places = {n: f"dim{i}" for i, n in enumerate(dims)}
    order = ["curve", *[f"tie{i}" for i in range(len(tie))], "copy"]
    keyed = df.select(F.struct(*df.columns).alias("row"), F.monotonically_increasing_id().alias("copy"),
                      *[F.col(c).alias(f"tie{i}") for i, c in enumerate(tie)],
                      *[F.coalesce(c.cast("double"), F.lit(-1.0)).alias(places[n]) for n, c in dims.items()])
    cuts = boundaries(keyed, [*places.values()], bits)

    def place(b: pa.RecordBatch) -> dict[str, list]:
        # Few distinct values are spread over the whole axis, else the curve's
        # leading bits would never see them.
        cells = np.stack([(np.searchsorted(cut, b.column(n).to_numpy(), side="right") << bits) // (len(cut) + 1)
                          for n, cut in zip(places.values(), cuts)], axis=1)
        return {"curve": hilbert_index(cells, bits)}

    curved = with_python(keyed, place, "curve long", drop=tuple(places.values()))
    staged = in_ranges(curved, order, "hilbert")
    ranked = with_before(staged, order, {"rank": F.lit(1).cast("long")})
    placed = (ranked.withColumn("rows", staged.agg(F.count(F.lit(1))).scalar())
              .withColumn("shard", F.expr(f"(rank * {shards}) div rows").cast("int"))
              .withColumn("slot", F.expr(f"rank - (shard * rows + {shards - 1}) div {shards}")))
    kept = [F.col(f"row.`{c}`") for c in df.columns if c not in ("curve", "shard", "slot")]
    return placed.select(*kept, "curve", "shard", "slot")


def write_shards(df: DataFrame, path: str, order: list[str]) -> None:
    """One folder per shard, rows in curve order; Parquet footers keep the
    least and greatest value of each column for pruning."""
    shards = df.select("shard").distinct().count()
    (df.repartitionByRange(max(1, shards), "shard").sortWithinPartitions("shard", *order)
     .write.mode("overwrite").partitionBy("shard").parquet(path))
