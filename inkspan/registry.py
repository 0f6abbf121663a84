"""Query name to callable and to oracle SQL, for every query of the engine itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Registers the decorated (spark, sf_dir) -> DataFrame under its name, with the SQL that DuckDB answers alike."""

    def add(f: Callable) -> Callable:
        key = name or f.__name__
        assert key not in _QUERIES, key
        _QUERIES[key] = f
        if sql:
            _ORACLE[key] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import inkspan.plans  # noqa: F401  registers

    return _QUERIES


def oracle_sql() -> dict[str, str]:
    import inkspan.plans  # noqa: F401  registers

    return _ORACLE
