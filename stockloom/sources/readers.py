"""Scans and CSV loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def scan_limit(
    df: DataFrame, cols: Sequence[str], n: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Projected scan, optionally the first ``n`` rows.

    With an order this is a top-n: each task keeps ``n`` rows and only those
    are merged.
    """
    out = df.select(*cols)
    if order:
        out = out.orderBy(*order)
    return out if n is None else out.limit(n)


def load_csv_typed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Preference file with a header; columns are typed as declared.

    Malformed rows fail the read instead of turning into NULLs.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def load_csv_explicit(
    spark: SparkSession, path: str, schema: StructType | str, skip_header: bool = True
) -> DataFrame:
    """CSV load by column position, the header line skipped if there is one."""
    return (
        spark.read.schema(schema)
        .option("header", skip_header)
        .option("enforceSchema", True)
        .csv(path)
    )


def explode_lines(df: DataFrame, lines: str = "dtl") -> DataFrame:
    """Transactions with nested lines to one row per line."""
    rest = [c for c in df.columns if c != lines]
    return df.select(*rest, F.explode(lines).alias("_line")).select(*rest, "_line.*")
