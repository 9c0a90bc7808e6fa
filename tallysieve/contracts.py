"""Column contracts: one closed, ordered, all-string header per dataset plus row provenance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import fixed_values as fv


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[str, ...]

    @property
    def raw_schema(self) -> T.StructType:
        """Raw rows: every domain column a string, then source file and physical line."""
        fields = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType(
            [*fields, T.StructField(fv.SOURCE_FILE, T.StringType()), T.StructField(fv.SOURCE_LINE, T.LongType())]
        )


CONTRACTS: dict[str, Contract] = {name: Contract(name, cols) for name, cols in fv.CONTRACT_COLUMNS.items()}


def contract_table(spark: SparkSession, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """The contracts as rows (schema_name, expected array<string>); a handful of rows by construction."""
    chosen = contracts or CONTRACTS
    return spark.createDataFrame(
        [(c.name, list(c.columns)) for c in chosen.values()], "schema_name string, expected array<string>"
    )
