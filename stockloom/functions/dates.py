"""Date arithmetic with Sunday-based weeks.

Spark's ``trunc`` starts weeks on Monday and ``timestampdiff`` counts whole
units, while the pipelines count *boundaries crossed* with weeks that start on
Sunday.  Both are plain integer arithmetic on day numbers, so that is how they
are written: it stays in generated code and constant-folds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a Sunday, origin of the week count.
FIRST_SUNDAY = "1970-01-04"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def week_index(d) -> Column:
    """Number of the Sunday-started week a date lies in."""
    days = F.datediff(_c(d), F.lit(FIRST_SUNDAY).cast("date"))
    return F.floor(days / 7).cast("int")


def period_index(d, freq: str) -> Column:
    """Running number of a period; consecutive periods differ by one."""
    if freq == "week":
        return week_index(d)
    return F.datediff(_c(d), F.lit(FIRST_SUNDAY).cast("date"))


def week_boundary_diff(a, b) -> Column:
    """Sundays crossed going from ``b`` to ``a``."""
    return week_index(a) - week_index(b)


def year_boundary_diff(a, b) -> Column:
    """New Years crossed going from ``b`` to ``a``."""
    return F.year(_c(a)) - F.year(_c(b))


def trunc_period(d, freq: str) -> Column:
    """First day of the period: the Sunday of the week, or the day itself."""
    d = _c(d)
    if freq == "week":
        return F.date_sub(d, F.dayofweek(d) - 1)
    if freq == "day":
        return d.cast("date")
    raise ValueError(f"unknown frequency {freq!r}")


def shift_date(d, n, unit: str) -> Column:
    """Move a date by ``n`` days, weeks or years (29 Feb goes to 28 Feb)."""
    d = _c(d)
    n = F.lit(n) if isinstance(n, int) else _c(n)
    if unit == "day":
        return F.date_add(d, n.cast("int"))
    if unit == "week":
        return F.date_add(d, (n * 7).cast("int"))
    if unit == "year":
        return F.add_months(d, (n * 12).cast("int"))
    raise ValueError(f"unknown unit {unit!r}")


def calendar_parts(d) -> Column:
    """Month, day of month and day of week (Sunday is 1) as a struct."""
    d = _c(d)
    return F.struct(
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("dayofweek"),
    )


def format_date(d) -> Column:
    """Upload date format, month/day/year with leading zeros."""
    return F.date_format(_c(d), "MM/dd/yyyy")


def week_label(prefix: str, week) -> Column:
    """Text label such as ``JLQ FW18``."""
    return F.concat(F.lit(prefix), _c(week).cast("string"))
