"""Pipelines composed of operators: forecast, baskets, bulk price, orders."""
