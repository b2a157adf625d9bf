"""Queries over the test tables and the SQL they are checked against."""


def all_queries() -> list:
    from checks import basic_queries, forecast_queries, inventory_queries

    return [*basic_queries.QUERIES, *forecast_queries.QUERIES, *inventory_queries.QUERIES]
