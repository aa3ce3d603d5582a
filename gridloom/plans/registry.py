"""All registered queries of the raster engine, each with the SQL that DuckDB must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Engines hand dates to Python in different types; their text is one."""
    return df.withColumns({c: df[c].cast("string") for c, kind in df.dtypes if kind == "date"})


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(function: Query) -> Query:
        _queries[name] = lambda spark, sf_dir: _dates_as_text(function(spark, sf_dir))
        if sql:
            _sql[name] = sql
        return function

    return put


def _load() -> None:
    from gridloom.plans import catalog_queries, raster_queries  # noqa: F401  they register themselves


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
