"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with its DuckDB SQL where SQL can express it."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if oracle is not None:
            _ORACLE[name] = oracle
        return f

    return add


def _load() -> None:
    """Imports the modules that register queries."""
    from . import conversations, derived, documents, pages, ranked, reviews, tables  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
