"""Keys, null-aware arithmetic and decision expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

KEY_SEPARATOR = "|"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _all_known(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def strict_greatest(*cols) -> Column:
    """Largest argument, NULL if any is NULL (Spark's own skips NULLs)."""
    cols = [_c(c) for c in cols]
    return F.when(_all_known(cols), F.greatest(*cols))


def strict_least(*cols) -> Column:
    """Smallest argument, NULL if any is NULL."""
    cols = [_c(c) for c in cols]
    return F.when(_all_known(cols), F.least(*cols))


def build_key(cols: Sequence[str]) -> Column:
    """Composite key text; NULL if any part is NULL (``concat_ws`` would skip)."""
    parts: list[Column] = []
    for name in cols:
        if parts:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(_c(name).cast("string"))
    return F.concat(*parts)


def split_key(key, names: Sequence[str]) -> list[Column]:
    """The parts of a composite key as aliased string columns."""
    parts = F.split(_c(key), "[|]")
    return [parts[i].alias(name) for i, name in enumerate(names)]


def safe_divide(a, b) -> Column:
    """Quotient, NULL where the divisor is zero."""
    return F.try_divide(_c(a), _c(b))


def output_transform(x, round_output: bool, nonneg: bool) -> Column:
    """Optional floor at zero, then optional rounding; NULL becomes zero."""
    x = _c(x)
    if nonneg:
        x = strict_greatest(x, F.lit(0.0))
    if round_output:
        x = F.round(x)
    return F.coalesce(x, F.lit(0.0))


def clip(x, low, high) -> Column:
    """Value limited to a range; NULL stays NULL."""
    return strict_least(strict_greatest(x, low), high)


def cap_value(x, cap: int = 9999) -> Column:
    """Value limited from above; NULL stays NULL."""
    x = _c(x)
    return F.when(x > cap, F.lit(cap)).otherwise(x)


def _override(base: Column, kind: Column, fixed: Column, low: Column, high: Column) -> Column:
    return (
        F.when(kind == 1, fixed)
        .when(kind == 2, strict_greatest(low, base))
        .when(kind == 3, strict_least(high, base))
    )


def override_value(base, store: str, sku: str) -> Column:
    """Apply the override of the finer grain, else the coarser, else none.

    ``store`` and ``sku`` are aliases of two override relations with columns
    sku, ovrd_type (1 replace, 2 floor, 3 ceiling), ovrd_qty, min_ovrd_qty and
    max_ovrd_qty.  A row counts as present when its sku is not NULL.
    """
    base = _c(base)

    def rule(alias: str) -> Column:
        names = ("ovrd_type", "ovrd_qty", "min_ovrd_qty", "max_ovrd_qty")
        return _override(base, *(F.col(f"{alias}.{n}") for n in names))

    return (
        F.when(F.col(f"{store}.sku").isNotNull(), rule(store))
        .when(F.col(f"{sku}.sku").isNotNull(), rule(sku))
        .otherwise(base)
    )


def pad_dept(c) -> Column:
    """Two- and three-character codes left-padded to four with zeros."""
    c = _c(c)
    return F.when(F.length(c).isin(2, 3), F.lpad(c, 4, "0")).otherwise(c)


def unpad_dept(c) -> Column:
    """Display form of a department code: one leading zero dropped."""
    c = _c(c)
    return F.when(c.startswith("0"), F.substring(c, 2, 3)).otherwise(c)


def strip_quotes(c) -> Column:
    return F.replace(_c(c), F.lit('"'), F.lit(""))


def strip_thousands(c) -> Column:
    """Number text with thousands separators, as a double."""
    return F.replace(_c(c), F.lit(","), F.lit("")).cast("double")


def ceil_to_pack(need, pack) -> Column:
    """Order quantity: the need, at least zero, in whole packs."""
    need, pack = _c(need), _c(pack)
    open_need = F.when(need < 0, F.lit(0)).otherwise(need)
    return F.ceil(open_need.cast("double") / pack) * pack


def max_of_buckets(summed: Sequence[str], single: Sequence[str]) -> Column:
    """Largest of several minimum buckets, the first being a sum of columns."""
    zero = F.lit(0.0)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), zero) for c in summed])
    return F.greatest(total, *[F.coalesce(F.col(c), zero) for c in single])


def select_by_least(errors: Sequence, values: Sequence, tie_value) -> Column:
    """Value belonging to the smallest of three errors.

    Order of preference on ties: the second wins any tie it is part of; a tie
    of the first and third gives ``tie_value``; otherwise second, third, first.
    NULL errors select nothing, so the result is NULL.
    """
    e1, e2, e3 = (_c(e) for e in errors)
    v1, v2, v3 = (v if isinstance(v, Column) else F.col(v) for v in values)
    low = strict_least(e1, e2, e3)
    return (
        F.when(low == e2, v2)
        .when((low == e3) & (e1 == e3), tie_value)
        .when(low == e3, v3)
        .when(low == e1, v1)
    )


def forward_season(factors: Sequence[str], week) -> Column:
    """Mean of four weekly factors starting two weeks ahead, wrapping at 52.

    Week 53 counts as week 52.
    """
    if len(factors) != 52:
        raise ValueError("52 weekly factor columns are needed")
    wrapped = F.array(*[F.col(c) for c in (*factors, *factors[:5])])
    first = F.least(_c(week), F.lit(52)).cast("int") + 2
    coming = F.slice(wrapped, first, F.lit(4))
    return F.aggregate(coming, F.lit(0.0), lambda total, factor: total + factor) / 4
