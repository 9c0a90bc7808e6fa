"""Registry of queries: a name, the Spark plan, and the equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import sql as with_tables
from .world import World, world

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[World], DataFrame]], Callable[[World], DataFrame]]:
    """Register `make(world)` under `name`; `sql` may use the tables of the oracle module."""

    def register(make: Callable[[World], DataFrame]) -> Callable[[World], DataFrame]:
        QUERIES[name] = lambda spark, sf: make(world(spark, sf))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return make

    return register
