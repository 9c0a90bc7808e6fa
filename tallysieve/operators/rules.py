"""The quality rules as data: a rule is an id plus a boolean Column over a prepared sales row.

A rule names the look-ups it needs, so that asking for one rule only joins what that rule reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv

VALID = "is_valid"
ISSUES = "quality_issues"
# Columns the prepared sales row carries besides its own, by look-up.
LATER_SALE = "__later_sale"
VEHICLE_SALES = "__vehicle_repeats"
VEHICLE_KNOWN = "__vehicle_known"
STORE_KNOWN = "__store_known"
CONSULTANT_KNOWN = "__consultant_known"
CONSULTANT_STORE = "consultor_loja_id"


@dataclass(frozen=True)
class RuleText:
    rule_id: str
    description: str
    severity: str
    dataset: str
    condition: str
    treatment: str
    reason: str
    invalidates_sale: bool


CATALOG: tuple[RuleText, ...] = tuple(RuleText(*row) for row in fv.RULE_TEXTS)
BY_ID: dict[str, RuleText] = {r.rule_id: r for r in CATALOG}
DIMENSION_RULES = {
    "duplicate_consultor_id": ("consultores", "consultor_id"),
    "duplicate_loja_id": ("lojas", "loja_id"),
    "duplicate_veiculo_id": ("veiculos", "veiculo_id"),
}


@dataclass(frozen=True)
class Rule:
    """A sales rule. `needs` lists look-ups among: later, repeats, vehicle, store, consultant; `reads` columns of the sale."""

    text: RuleText
    fails: Callable[[], Column]
    needs: tuple[str, ...] = ()
    reads: tuple[str, ...] = ()

    @property
    def rule_id(self) -> str:
        return self.text.rule_id


def _missing(c: str) -> Callable[[], Column]:
    return lambda: F.col(c).isNull()


def _unknown(c: str, known: str) -> Callable[[], Column]:
    return lambda: F.col(c).isNotNull() & F.col(known).isNull()


# The sale's columns that the rules read, keys of their look-ups included.
_READS: dict[str, tuple[str, ...]] = {
    "missing_venda_id": ("venda_id",), "duplicate_venda_id": ("venda_id",),
    "invalid_data_venda": ("data_venda",), "future_data_venda": ("data_venda",),
    "invalid_valor_venda": ("valor_venda",), "negative_valor_venda": ("valor_venda",), "zero_valor_venda": ("valor_venda",),
    "suspicious_valor_venda_placeholder": ("valor_venda",), "invalid_valor_referencia": ("valor_referencia",),
    "missing_veiculo_id": ("veiculo_id",), "orphan_veiculo_id": ("veiculo_id",), "missing_loja_id": ("loja_id",),
    "orphan_loja_id": ("loja_id",), "missing_consultor_id": ("consultor_id",), "orphan_consultor_id": ("consultor_id",),
    "consultor_loja_mismatch": ("consultor_id", "loja_id"), "veiculo_multiple_sales": ("veiculo_id",),
}


def sales_rules(as_of: Column | None = None, placeholder: str = fv.PLACEHOLDER_AMOUNT) -> tuple[Rule, ...]:
    """The sales rules in report order. `as_of` is the day that counts as today."""
    today = F.current_date() if as_of is None else as_of
    amount = F.col("valor_venda")
    checks: dict[str, tuple[Callable[[], Column], tuple[str, ...]]] = {
        "missing_venda_id": (_missing("venda_id"), ()),
        "duplicate_venda_id": (lambda: F.col(LATER_SALE), ("later",)),
        "invalid_data_venda": (_missing("data_venda"), ()),
        "future_data_venda": (lambda: F.col("data_venda") > today, ()),
        "invalid_valor_venda": (_missing("valor_venda"), ()),
        "negative_valor_venda": (lambda: amount < 0, ()),
        "zero_valor_venda": (lambda: amount == 0, ()),
        "suspicious_valor_venda_placeholder": (
            lambda: amount == F.lit(placeholder).cast("decimal(18,2)"), ()),
        "invalid_valor_referencia": (_missing("valor_referencia"), ()),
        "missing_veiculo_id": (_missing("veiculo_id"), ()),
        "orphan_veiculo_id": (_unknown("veiculo_id", VEHICLE_KNOWN), ("vehicle",)),
        "missing_loja_id": (_missing("loja_id"), ()),
        "orphan_loja_id": (_unknown("loja_id", STORE_KNOWN), ("store",)),
        "missing_consultor_id": (_missing("consultor_id"), ()),
        "orphan_consultor_id": (_unknown("consultor_id", CONSULTANT_KNOWN), ("consultant",)),
        "consultor_loja_mismatch": (
            lambda: F.col("consultor_id").isNotNull() & (F.col(CONSULTANT_STORE) != F.col("loja_id")),
            ("consultant",)),
        "veiculo_multiple_sales": (lambda: F.col(VEHICLE_SALES), ("repeats",)),
    }
    return tuple(Rule(BY_ID[rule_id], fails, needs, _READS[rule_id]) for rule_id, (fails, needs) in checks.items())


def failing(rule: Rule) -> Column:
    """The rule as a plain boolean; an undecided (NULL) check did not fail."""
    return F.coalesce(rule.fails(), F.lit(False))


def needs_of(rules: Iterable[Rule]) -> set[str]:
    return {n for r in rules for n in r.needs}


def flag_column(rule_id: str) -> str:
    return f"__fails_{rule_id}"


def apply_rules(prepared: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the `|`-joined ids of failed rules, in rule order, and whether the sale stays valid."""
    flagged = prepared.withColumns({flag_column(r.rule_id): failing(r) for r in rules})
    issues = F.concat_ws("|", *[F.when(F.col(flag_column(r.rule_id)), F.lit(r.rule_id)) for r in rules])
    fatal = [F.col(flag_column(r.rule_id)) for r in rules if r.text.invalidates_sale]
    broken = reduce(lambda a, b: a | b, fatal) if fatal else F.lit(False)
    return flagged.withColumns({ISSUES: issues, VALID: ~broken})


def catalog_table(spark: SparkSession, extra: Sequence[RuleText] = ()) -> DataFrame:
    """The rule texts as rows with their report position, rules of the user last."""
    rows = [(i, *astuple(text)) for i, text in enumerate((*CATALOG, *extra))]
    return spark.createDataFrame(
        rows,
        "position int, rule_id string, description string, severity string, dataset string, "
        "condition string, treatment string, reason string, invalidates_sale boolean",
    )


def rule_status(failed_rows: Column, severity: Column) -> Column:
    return (
        F.when(failed_rows == 0, "passed").when(severity == "error", "failed").otherwise("warning")
    )


def sales_failures(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_id, failed_rows) for all sales rules from one aggregation over the flagged rows."""
    counts = flagged.agg(*[F.count_if(flag_column(r.rule_id)).alias(r.rule_id) for r in rules])
    return counts.unpivot([], [r.rule_id for r in rules], "rule_id", "failed_rows")


def quality_report(failures: DataFrame, extra: Sequence[RuleText] = ()) -> DataFrame:
    """One row per catalog rule, zero counts included. `failures` has at most one row per rule."""
    catalog = catalog_table(failures.sparkSession, extra)
    n = F.coalesce(F.col("failed_rows"), F.lit(0)).cast("bigint")
    return (
        catalog.join(F.broadcast(failures), "rule_id", "left")
        .select(
            "position", F.col("rule_id").alias("check"), "rule_id", "description", "severity", "dataset",
            "condition", "treatment", "reason", "invalidates_sale", n.alias("failed_rows"),
            rule_status(n, F.col("severity")).alias("status"),
        )
    )
