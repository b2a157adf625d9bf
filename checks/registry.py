"""A query, its output columns and its reference SQL, kept together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.inputs import Inputs, duck_ctes
from stockloom.session import ship_package


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    if kind.startswith("f"):
        c = c.cast("double")
        # Whole numbers are spared the decimal arithmetic of a rounding.
        rounded = F.when(F.rint(c) == c, c).otherwise(F.round(c, int(kind[1:] or 6)))
        return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded).alias(name)
    casts = {"d": "string", "s": "string", "i": "bigint", "b": "boolean"}
    return c.cast(casts[kind]).alias(name)


def _duck_column(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind.startswith("f"):
        r = f"ROUND(CAST({c} AS DOUBLE), {int(kind[1:] or 6)})"
        return f"CAST(CASE WHEN {r} = 0 THEN 0 ELSE {r} END AS DOUBLE) AS {c}"
    casts = {"d": "VARCHAR", "s": "VARCHAR", "i": "BIGINT", "b": "BOOLEAN"}
    return f"CAST({c} AS {casts[kind]}) AS {c}"


def _kept(name: str, text: str) -> str:
    """Every CTE is computed once; a recursive one is so by itself."""
    return "" if f"FROM {name}\n" in text else "MATERIALIZED"


@dataclass(frozen=True)
class Query:
    """``columns`` lists ``name:kind`` with kinds d date, s text, i integer,
    b boolean and f or f<digits> a rounded double; both engines present the
    result in exactly this form."""

    name: str
    run: Callable[[Inputs], DataFrame]
    columns: str
    sql: str | None = None
    inputs: tuple[str, ...] = ()
    ctes: tuple[tuple[str, str], ...] = ()

    def _columns(self) -> list[tuple[str, str]]:
        pairs = [c.rsplit(":", 1) for c in self.columns.split(",")]
        return [(name.strip(), kind.strip()) for name, kind in pairs]

    def spark(self, spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        df = self.run(Inputs(spark, folder))
        return df.select(*[_spark_column(n, k) for n, k in self._columns()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        ctes = [*duck_ctes(list(self.inputs)), *self.ctes]
        head = ",\n".join(f"{name} AS {_kept(name, text)} ({text})" for name, text in ctes)
        columns = ", ".join(_duck_column(n, k) for n, k in self._columns())
        prefix = f"WITH RECURSIVE {head}\n" if ctes else ""
        return f"{prefix}SELECT {columns} FROM ({self.sql}) AS result"
