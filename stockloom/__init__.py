"""stockloom: demand forecasting and inventory planning as Spark DataFrame jobs.

Layout

* ``functions``  column expressions (keys, dates, null-safe arithmetic)
* ``operators``  reusable DataFrame -> DataFrame steps (joins, windows, ...)
* ``sources``    readers and writers for stages, reports and uploads
* ``plans``      the pipelines: forecast, baskets, bulk price, orders
* ``streaming``  intentionally empty, every pipeline here is batch
"""

from stockloom.spec import SeriesSpec

__all__ = ["SeriesSpec"]
__version__ = "0.1.0"
