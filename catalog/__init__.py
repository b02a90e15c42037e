"""The registered queries over the supplied tables, each next to the SQL it is checked against."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Registers a query ``(spark, sf_dir) -> DataFrame`` and, where SQL can say it, its check."""

    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def load_all() -> None:
    from catalog import enrichment, extraction, identity, pii, reporting, rules, search, sites, streams  # noqa: F401
