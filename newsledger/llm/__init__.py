"""Operators that prepare corpora for language-model training; nothing else in the library imports them."""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = ("embeddings", "token_files", "packing", "exact", "quality", "ppm", "bpe", "templates", "toxicity", "minhash",
           "audit", "novelty", "trie")


def query(name: str, sql: str | None = None):
    """Registers a query ``(spark, sf_dir) -> DataFrame`` and, where SQL can say it, its check."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def load_all() -> None:
    for module in MODULES:
        import_module(f"newsledger.llm.{module}")
