"""Reading the published layer for exploration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import explore
from ..sinks import publish


@dataclass(frozen=True)
class Layer:
    """One published version. `sales` prunes to the explored columns and keeps the month partition."""

    spark: SparkSession
    root: str
    version: str

    def table(self, name: str) -> DataFrame:
        return publish.read_table(self.spark, self.root, name, self.version)

    @property
    def sales(self) -> DataFrame:
        fact = publish.read_table(self.spark, self.root, "fact_vendas", self.version, month_partition=True)
        return explore.explored(fact)

    @property
    def report(self) -> DataFrame:
        return explore.board_order(self.table("quality_report").select("check", "severity", "failed_rows", "status"))

    @property
    def volumes(self) -> DataFrame:
        return explore.volumes(self.table("raw_vendas"), self.table("fact_vendas"), self.table("rejected_sales"))


_CACHED: dict[tuple[str, str, str], DataFrame] = {}


def open_layer(spark: SparkSession, root: str) -> Layer:
    return Layer(spark, root, publish.current_version(root))


def cached_sales(layer: Layer) -> DataFrame:
    """The explored sales, cached per session and version: a new version takes the place of the old one."""
    session = layer.spark.sparkContext.applicationId
    key = (session, layer.root, layer.version)
    if key not in _CACHED:
        for old in [k for k in _CACHED if k[0] != session or k[1] == layer.root]:
            gone = _CACHED.pop(old)
            if old[0] == session:
                gone.unpersist()
        _CACHED[key] = layer.sales.cache()
    return _CACHED[key]
