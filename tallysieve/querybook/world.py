"""Tables shared by the registered queries of one session, staged once per data folder.

Cleaning functions run on the raw tables directly. A query that reads some columns of the judged sales has them judged for
itself, narrow, unless the whole evaluation is staged already; whole facts and published layers stage it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explore, keys
from ..operators.metrics import with_metrics
from ..operators.rules import VALID, flag_column, sales_rules
from ..plans.evaluate import (
    BETWEEN, DIMENSIONS, SALE_KEYS, Evaluation, canonical, canonical_columns, evaluate, evaluate_slices, failing_rows, hot_of_needs, judge, narrow_dims,
    prepare_sales, report_of, slices_of,
)
from ..session import tune
from ..sinks.staging import Staging
from . import adapter

_WORLDS: dict[tuple[str, str], World] = {}


def as_of():
    return F.lit(adapter.AS_OF).cast("date")


def staged_slices(stage: Staging, name: str, slices: Iterable[Evaluation], of: Callable[[Evaluation], DataFrame]) -> DataFrame:
    """A part of all slices, each staged before the next is made."""
    return reduce(DataFrame.unionAll, [stage(f"{name}_{k}", of(ev)) for k, ev in enumerate(slices)])


class World:
    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = tune(spark), sf
        self.stage = Staging(spark)
        self._kept: dict[str, DataFrame] = {}
        self._evaluation: Evaluation | None = None

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = self.stage(name, make())
        return self._kept[name]

    def raw(self, name: str) -> DataFrame:
        return adapter.raw(self.spark, self.sf, name)

    def clean(self, name: str) -> DataFrame:
        return self._once(f"clean_{name}", lambda: adapter.clean(self.spark, self.sf, name))

    def read(self, name: str) -> DataFrame:
        """Clean rows for one pass: the staged table where it is there, else cleaned while they are read."""
        staged = self._kept.get(f"clean_{name}")
        return adapter.clean(self.spark, self.sf, name) if staged is None else staged

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.clean(name) for name in adapter.RAW}

    def once(self, name: str, df: DataFrame) -> DataFrame:
        """A stage that writes each name once and gives the written table from then on."""
        return self._once(name, lambda: df)

    def canon(self, *names: str) -> dict[str, DataFrame]:
        """Canonical dimensions, written; all of them where none is named."""
        return {name: self._once(f"canon_{name}", lambda name=name: canonical(self.clean(name), name)) for name in names or DIMENSIONS}

    def hot(self) -> DataFrame:
        return self.once("hot_keys", keys.hot_keys(self.clean("vendas"), SALE_KEYS))

    def hot_of(self, key: str) -> DataFrame:
        return self.hot().where(F.col("key_name") == key).select(F.col("key").alias("hot_key"))

    def lazy_tables(self) -> dict[str, DataFrame]:
        """The clean tables, each cleaned where it is read unless it is staged."""
        return {name: self.read(name) for name in adapter.RAW}

    def looked_up(self, needs: set[str], wide: bool = True) -> DataFrame:
        """Clean sales with look-ups, hot keys past the shuffle as in the full run."""
        tables = self.lazy_tables()
        hot, detours = hot_of_needs(tables["vendas"], needs, self.once)
        wanted = [c for name in DIMENSIONS for c in canonical_columns(tables[name], name)] if wide else ()
        return prepare_sales(tables["vendas"], narrow_dims(tables, needs, wanted), needs, hot, self.once, detours, wide, in_place=True)

    def failing(self, rule_id: str) -> DataFrame:
        """Sales that fail one rule; no more is cleaned than the rule reads and than tells the sale."""
        rule = next(r for r in sales_rules(as_of()) if r.rule_id == rule_id)
        needs = set(rule.needs)
        if not needs:
            return failing_rows(rule_id, self.read("vendas"), {}, as_of())
        tables = self.lazy_tables()
        read = dict.fromkeys(("venda_id", *rule.reads, *keys.SOURCE_ORDER))
        sales = self.once("failing_" + "_".join(read), tables["vendas"].select(*read))
        hot, detours = hot_of_needs(sales, needs, self.once)
        return failing_rows(rule_id, sales, narrow_dims(tables, needs, ()), as_of(), hot, self.once, detours)

    def judged(self, *columns: str) -> DataFrame:
        """All sales with these columns and whether they are valid: from the evaluation where it is there, else made for them."""
        return self._judged(columns)

    def _judged(self, columns: tuple[str, ...], valid_only: bool = False) -> DataFrame:
        if self._evaluation is None:
            return judge(self.lazy_tables(), columns, as_of(), self.once, valid_only)
        whole = with_metrics(self._evaluation.judged)
        return whole.select(VALID, *[c for c in dict.fromkeys(columns) if c != VALID])

    def fact_of(self, *columns: str) -> DataFrame:
        """These columns of the valid sales."""
        return self._judged(columns, valid_only=True).where(VALID).select(*dict.fromkeys(columns))

    def sales_of(self, *columns: str) -> DataFrame:
        """The valid sales as explored, with these columns."""
        return explore.explored(self.fact_of(*columns))

    def evaluation(self) -> Evaluation:
        if self._evaluation is None:
            self._evaluation = evaluate(self.tables(), as_of(), stage=self.once)
            self.stage.drop(BETWEEN)
            del self._kept[BETWEEN]
        return self._evaluation

    def evaluations(self) -> Evaluation | Iterable[Evaluation]:
        """The whole evaluation where it is there or small, else its slices, of which none is kept."""
        if self._evaluation is None:
            slices = slices_of(self.clean("vendas"))
            if slices > 1:
                return evaluate_slices(self.tables(), as_of(), self.once, slices)
        return self.evaluation()

    def part(self, name: str, of: Callable[[Evaluation], DataFrame]) -> DataFrame:
        """A part of the evaluation, of slices staged in turn."""
        if name not in self._kept:
            found = self.evaluations()
            if isinstance(found, Evaluation):
                return of(found)
            self._kept[name] = staged_slices(self.stage, name, found, of)
        return self._kept[name]

    @property
    def fact(self) -> DataFrame:
        return self.part("fact", lambda ev: ev.fact)

    @property
    def rejected(self) -> DataFrame:
        return self.part("rejected", lambda ev: ev.rejected)

    @property
    def report(self) -> DataFrame:
        def make() -> DataFrame:
            chosen = sales_rules(as_of())
            return report_of(self.judged(*[flag_column(r.rule_id) for r in chosen]), self.lazy_tables(), chosen)

        return self._once("report", make)

    @property
    def sales(self) -> DataFrame:
        return explore.explored(self.fact)


def world(spark: SparkSession, sf: str) -> World:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WORLDS:
        _WORLDS[key] = World(spark, sf)
    return _WORLDS[key]
