"""Valid fact, quarantine and quality report from four normalised tables; everything stays lazy."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Collection, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import keys, rules
from ..operators.metrics import METRIC_COLUMNS, with_metrics

SALE_KEYS = ("venda_id", "veiculo_id", "loja_id", "consultor_id")
# Dimension -> (key, prefix of its renamed provenance).
DIMENSIONS = {
    "veiculos": ("veiculo_id", "veiculo"),
    "lojas": ("loja_id", "loja"),
    "consultores": ("consultor_id", "consultor"),
}
_KNOWN = {
    "veiculos": rules.VEHICLE_KNOWN,
    "lojas": rules.STORE_KNOWN,
    "consultores": rules.CONSULTANT_KNOWN,
}
# Look-ups whose attributes the fact carries.
ATTRIBUTES = frozenset({"vehicle", "store", "consultant"})
# The table that `evaluate` stages on the way; its stage may drop it once the evaluation is there.
BETWEEN = "consultants_looked_up"
#: Bytes of written sales that are looked up at once; what is shuffled for them takes some twenty times as much.
SLICE_BYTES = 1 << 30
MAX_SLICES = 256
# A stage writes a frame to shared storage and reads it back; the default leaves the plan lazy.
Stage = Callable[[str, DataFrame], DataFrame]


def lazy(_name: str, df: DataFrame) -> DataFrame:
    return df


def canonical(dim: DataFrame, name: str) -> DataFrame:
    """First row per key, provenance renamed so that the three dimensions can be joined side by side."""
    key, prefix = DIMENSIONS[name]
    renamed = {fv.SOURCE_FILE: f"{prefix}_source_file", fv.SOURCE_LINE: f"{prefix}_source_line"}
    if name == "consultores":
        renamed["loja_id"] = rules.CONSULTANT_STORE
    return keys.first_per_key(dim, key).withColumnsRenamed(renamed)


def prepare_sales(
    sales: DataFrame,
    dims: dict[str, DataFrame],
    needs: set[str],
    hot: DataFrame | None = None,
    stage: Stage = lazy,
    detours: frozenset[str] = frozenset(SALE_KEYS),
    wide: bool = True,
    in_place: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Sales rows with the look-ups that `needs` asks for; `detours` are the keys that have hot values.

    `wide` brings the attributes of the dimensions along, otherwise only what the rules read. `in_place` marks duplicates
    where rows of a key meet anyway, without a list of repeated keys: right for narrow sales that are read once; `counted` has
    the vehicles of the same rows and is cheaper to read again.
    `dims` are canonical (one row per key). Vehicles and the repeat mark are looked up behind one shuffle of the sales.
    The tables that bring the most come last, so that what is shuffled before is narrow.
    """

    def hot_of(key: str) -> DataFrame | None:
        if hot is None or key not in detours:
            return None
        return hot.where(F.col("key_name") == key).select(F.col("key").alias("hot_key"))

    def known(name: str) -> DataFrame:
        key = DIMENSIONS[name][0]
        mark = F.when(F.col(key).isNotNull(), F.lit(True))
        read = [c for c in dims[name].columns if wide or c in (key, rules.CONSULTANT_STORE)]
        return dims[name].select(*read).withColumn(_KNOWN[name], mark)

    out = sales
    if "later" in needs and in_place:
        out = keys.rank_later(out, "venda_id", rules.LATER_SALE, hot_of("venda_id"))
    elif "later" in needs:
        firsts = stage("repeated_sales", keys.first_occurrences(sales, "venda_id", hot_of("venda_id")))
        joined = keys.lookup_join(out, firsts, "venda_id", hot_of("venda_id"))
        out = joined.withColumn(
            rules.LATER_SALE, F.coalesce(keys.order_value() > F.col("first_order"), F.lit(False))
        ).drop("first_order")
    if "consultant" in needs:
        # A sale without consultant takes up the row of a NULL consultant where the dimension has one.
        out = keys.lookup_join(
            out, known("consultores"), "consultor_id", hot_of("consultor_id"), null_matches=True
        )
        if wide and "vehicle" in needs and not in_place:
            # Written in between, so that the shuffles before need not lie on disk beside those of the vehicles.
            out = stage(BETWEEN, out)
    vehicles = []
    if "repeats" in needs and not in_place:
        repeats = keys.repeated_keys(sales.where(F.col("veiculo_id").isNotNull()), "veiculo_id").select(
            "veiculo_id", F.lit(True).alias(rules.VEHICLE_SALES)
        )
        vehicles.append(stage("repeated_veiculos", repeats))
    if "vehicle" in needs:
        vehicles.append(known("veiculos"))
    mark = rules.VEHICLE_SALES if "repeats" in needs and in_place else None
    if vehicles or mark:
        out = keys.lookup_join(out, vehicles, "veiculo_id", hot_of("veiculo_id"), repeated=mark, counted=counted)
    if "store" in needs:
        out = keys.lookup_join(out, known("lojas"), "loja_id", hot_of("loja_id"))
    return out


def failing_rows(
    rule_id: str,
    sales: DataFrame,
    dims: dict[str, DataFrame],
    as_of: Column | None = None,
    hot: DataFrame | None = None,
    stage: Stage = lazy,
    detours: frozenset[str] = frozenset(SALE_KEYS),
) -> DataFrame:
    """Sales rows that fail one rule, joined only to what that rule reads."""
    rule = next(r for r in rules.sales_rules(as_of) if r.rule_id == rule_id)
    prepared = prepare_sales(sales, dims, set(rule.needs), hot, stage, detours, wide=False, in_place=True)
    return prepared.where(rules.failing(rule))


# Look-up -> dimension and the sale's key; the other look-ups have the key of the sale alone.
_KEY_OF = {"later": "venda_id", "repeats": "veiculo_id", "vehicle": "veiculo_id", "store": "loja_id", "consultant": "consultor_id"}
# The rules that a sale is known to fail, one bit each.
_CHECKED = "__checked"
_DIMENSION_OF = {"vehicle": "veiculos", "store": "lojas", "consultant": "consultores"}


def hot_of_needs(sales: DataFrame, needs: set[str], stage: Stage) -> tuple[DataFrame, frozenset[str]]:
    """Hot keys of the columns that some look-ups join on, and which columns have any."""
    used = sorted({_KEY_OF[n] for n in needs})
    hot = stage("hot_" + "_".join(used), keys.hot_keys(sales, used))
    # At most one row per join column. Columns without hot values take the plain join.
    return hot, frozenset(row[0] for row in hot.select("key_name").distinct().collect())


def narrow_dims(tables: dict[str, DataFrame], needs: set[str], wanted: Collection[str]) -> dict[str, DataFrame]:
    """Canonical dimensions of some look-ups with no more than the wanted columns and what rules read."""
    out = {}
    for need, name in _DIMENSION_OF.items():
        if need in needs:
            key = DIMENSIONS[name][0]
            read = [c for c in canonical_columns(tables[name], name) if c in wanted or c == rules.CONSULTANT_STORE]
            # Without attributes the keys alone are asked for, and they need no order.
            dim = canonical(tables[name], name).select(key, *read) if read else tables[name].select(key).distinct()
            # Sizes of what is not written are guesses, too small for exploded rows; no table is broadcast on a guess.
            out[name] = dim.hint("merge")
    return out


# Look-ups in the order they are made; those of one step share a shuffle.
_STEPS = (("later",), ("consultant",), ("repeats", "vehicle"), ("store",))


def judge(
    tables: dict[str, DataFrame], wanted: Collection[str], as_of: Column | None = None, stage: Stage = lazy, valid_only: bool = False
) -> DataFrame:
    """All sales with the wanted columns and whether they are valid, for one reader that needs no whole evaluation.

    `tables` are normalised and lazy. No more is cleaned, looked up and shuffled than the wanted columns and validity ask for:
    rules that only warn are checked where issues or flags are wanted, and each rule as soon as what it reads is there, so that
    one number goes on instead of marks and columns. Metrics and attributes are those of valid sales.
    `valid_only` gives the valid sales alone: others go as soon as they are known, or go on bare while their vehicles are counted.
    """
    asked = set(wanted)
    flags = {rules.flag_column(rule_id) for rule_id in rules.BY_ID}
    every = rules.sales_rules(as_of)
    chosen = every if asked & ({rules.ISSUES} | flags) else tuple(r for r in every if r.text.invalidates_sale)
    needs = rules.needs_of(chosen)
    for need, name in _DIMENSION_OF.items():
        if asked & set(canonical_columns(tables[name], name)):
            needs.add(need)
    metric = asked & set(METRIC_COLUMNS)
    bits = {r.rule_id: 1 << i for i, r in enumerate(chosen)}
    fatal = sum(bits[r.rule_id] for r in chosen if r.text.invalidates_sale)
    shown = asked | ({"valor_venda", "valor_referencia"} if metric else set())

    def checked(df: DataFrame, now: Collection[rules.Rule], rest: Collection[str]) -> DataFrame:
        """With the rules of now in the number, and only columns that are shown or that the look-ups in `rest` read."""
        reads = {_KEY_OF[n] for n in rest}.union(*(r.reads for r in chosen if set(r.needs) & set(rest)))
        places = set(keys.SOURCE_ORDER) if "later" in rest else set()
        known = [F.col(_CHECKED)] if _CHECKED in df.columns else []
        known += [F.when(rules.failing(r), bits[r.rule_id]).otherwise(0) for r in now]
        out = df.withColumn(_CHECKED, reduce(Column.bitwiseOR, known, F.lit(0)))
        joined = {c for name in dims for c in dims[name].columns[1:]} & asked
        stay = shown | reads | places | joined | {_CHECKED, keys.SALT}
        out = out.select(*[c for c in out.columns if c in stay])
        if not valid_only:
            return out
        good = F.col(_CHECKED).bitwiseAND(fatal) == 0
        if not {"later", "repeats"} & set(rest):
            return out.where(good)
        # What marks of other sales read stays, and what spreads the rows.
        bare = places | {_CHECKED, keys.SALT, fv.SOURCE_LINE} | {_KEY_OF[n] for n in ("later", "repeats") if n in rest}
        return out.withColumns({c: F.when(good, F.col(c)) for c in out.columns if c not in bare})

    steps = [tuple(n for n in step if n in needs) for step in _STEPS]
    steps = [step for step in steps if step]
    dims = narrow_dims(tables, needs, asked)
    read = shown.union(keys.SOURCE_ORDER, *(r.reads for r in chosen)) | {_KEY_OF[n] for n in needs}
    sales = tables["vendas"].select(*[c for c in tables["vendas"].columns if c in read])
    sales = sales if asked >= set(keys.SOURCE_ORDER) else keys.salted(sales)
    sales = checked(sales, [r for r in chosen if not r.needs], sum(steps, ()))
    digest = zlib.crc32(" ".join([*sales.columns, *bits, str(valid_only)]).encode())
    sales = stage(f"sales_{digest:08x}", sales)
    hot, detours = hot_of_needs(sales, needs, stage)
    if "lojas" in dims:  # written, so that its size is known and a small one is broadcast
        dims["lojas"] = stage("stores_" + "_".join(dims["lojas"].columns[1:]), dims["lojas"])
    out = sales
    for i, step in enumerate(steps):
        out = prepare_sales(out, dims, set(step), hot, lazy, detours, in_place=True, counted=sales)
        done = set(sum(steps[: i + 1], ()))
        out = checked(out, [r for r in chosen if set(r.needs) & set(step) and set(r.needs) <= done], sum(steps[i + 1 :], ()))
    told = tuple(replace(r, fails=lambda bit=bits[r.rule_id]: F.col(_CHECKED).bitwiseAND(bit) != 0) for r in chosen)
    marked = rules.apply_rules(out, told)
    joined = [c for name in dims for c in dims[name].columns[1:] if c in marked.columns]
    marked = marked.withColumns({c: F.when(F.col(rules.VALID), F.col(c)) for c in joined})
    marked = with_metrics(marked) if metric else marked
    return marked.select(rules.VALID, *[c for c in dict.fromkeys(wanted) if c != rules.VALID])


def report_of(judged: DataFrame, dims: dict[str, DataFrame], chosen: Sequence[rules.Rule]) -> DataFrame:
    """The quality report from flagged sales and the dimensions with all their rows."""
    return report_from(rules.sales_failures(judged, chosen), dims, chosen)


def report_from(sales_part: DataFrame, dims: dict[str, DataFrame], chosen: Sequence[rules.Rule]) -> DataFrame:
    """The quality report from the counts of the sales rules."""
    dim_parts = [
        keys.repeated_row_count(dims[dataset], key).select(F.lit(rule_id).alias("rule_id"), "failed_rows")
        for rule_id, (dataset, key) in rules.DIMENSION_RULES.items()
    ]
    own = [r.text for r in chosen if r.rule_id not in rules.BY_ID]
    return rules.quality_report(reduce(DataFrame.unionByName, dim_parts, sales_part), own)


@dataclass(frozen=True)
class Evaluation:
    """All parts read `judged`; stage or cache it when more than one part is needed."""

    #: All sales with flags, issues and, where they are valid, the attributes of all dimensions.
    judged: DataFrame
    dims: dict[str, DataFrame]
    rules: tuple[rules.Rule, ...]
    sale_columns: tuple[str, ...]
    #: Joins sales to the attributes of all dimensions.
    look_up: Callable[[DataFrame], DataFrame]

    @property
    def sale_output(self) -> list[str]:
        return [*self.sale_columns, rules.ISSUES, rules.VALID]

    @property
    def joined(self) -> list[str]:
        return [c for name in DIMENSIONS for c in canonical_columns(self.dims[name], name)]

    @property
    def flagged(self) -> DataFrame:
        """All sales with flags and issues."""
        return self.judged.drop(*self.joined)

    @property
    def fact(self) -> DataFrame:
        """Valid sales with their vehicle, store and consultant, and the metrics."""
        return with_metrics(self.judged.where(rules.VALID)).select(*self.sale_output, *self.joined, *METRIC_COLUMNS)

    @property
    def rejected(self) -> DataFrame:
        return self.judged.where(~F.col(rules.VALID)).select(*self.sale_output)

    @property
    def report(self) -> DataFrame:
        return report_of(self.judged, self.dims, self.rules)


def canonical_columns(dim: DataFrame, name: str) -> list[str]:
    """Names of a dimension's columns inside the fact, key excluded."""
    key, prefix = DIMENSIONS[name]
    renamed = {fv.SOURCE_FILE: f"{prefix}_source_file", fv.SOURCE_LINE: f"{prefix}_source_line"}
    if name == "consultores":
        renamed["loja_id"] = rules.CONSULTANT_STORE
    return [renamed.get(c, c) for c in dim.columns if c != key]


def evaluate(
    tables: dict[str, DataFrame],
    as_of: Column | None = None,
    extra_rules: Sequence[rules.Rule] = (),
    split_hot_keys: bool = True,
    stage: Stage = lazy,
) -> Evaluation:
    """Flag all sales against the rules. `tables` are normalised: vendas, veiculos, lojas, consultores."""
    sales = tables["vendas"]
    chosen = (*rules.sales_rules(as_of), *extra_rules)
    hot, detours = None, frozenset(SALE_KEYS)
    if split_hot_keys:
        hot = stage("hot_keys", keys.hot_keys(sales, SALE_KEYS))
        if stage is not lazy:
            # At most one row per join column. Columns without hot values take the plain join.
            detours = frozenset(row[0] for row in hot.select("key_name").distinct().collect())
    canon = {name: stage(f"canon_{name}", canonical(tables[name], name)) for name in DIMENSIONS}
    ev = _evaluation(sales, canon, tables, chosen, hot, detours, stage)
    return replace(ev, judged=stage("judged", ev.judged))


def slices_of(sales: DataFrame) -> int:
    """In how many slices written sales are judged, by their size on disk."""
    size = int(str(sales._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(-(-size // SLICE_BYTES), 1), MAX_SLICES)


def evaluate_slices(tables: dict[str, DataFrame], as_of: Column | None, stage: Stage, slices: int) -> Iterator[Evaluation]:
    """The evaluation of all sales, a slice of them after another, so that shuffles of all sales never lie on disk at once.

    Marks that need all sales are found once and staged. A slice has all sales of its vehicles, and is lazy: each reader makes it
    again, with the columns that it reads.
    """
    sales, chosen = tables["vendas"], rules.sales_rules(as_of)
    hot = stage("hot_keys", keys.hot_keys(sales, SALE_KEYS))
    detours = frozenset(row[0] for row in hot.select("key_name").distinct().collect())  # at most one row per join column
    canon = {name: stage(f"canon_{name}", canonical(tables[name], name)) for name in DIMENSIONS}
    marks: dict[str, DataFrame] = {}

    def marked(name: str, df: DataFrame) -> DataFrame:
        if name == BETWEEN:
            return df
        if name not in marks:
            marks[name] = stage(name, df)
        return marks[name]

    # The plan over all sales has the marks staged; it is not run.
    _evaluation(sales, canon, tables, chosen, hot, detours, marked)
    for k in range(slices):
        vehicle = F.xxhash64("veiculo_id")
        here = F.pmod(F.when(F.col("veiculo_id").isNull(), F.xxhash64(*keys.SOURCE_ORDER)).otherwise(vehicle), slices) == k
        some = canon | {"veiculos": canon["veiculos"].where(F.pmod(vehicle, slices) == k)}
        yield _evaluation(sales.where(here), some, tables, chosen, hot, detours, marked)


def _evaluation(
    sales: DataFrame, canon: dict[str, DataFrame], tables: dict[str, DataFrame], chosen: Sequence[rules.Rule], hot: DataFrame | None,
    detours: frozenset[str], stage: Stage,
) -> Evaluation:
    # One look-up serves both the rules and the fact, so that a sale is shuffled once for each dimension.
    prepared = prepare_sales(sales, canon, rules.needs_of(chosen) | ATTRIBUTES, hot, stage, detours)
    marked = rules.apply_rules(prepared, chosen)
    dims = {name: tables[name] for name in DIMENSIONS}
    joined = [c for name in DIMENSIONS for c in canonical_columns(dims[name], name)]
    flags = [rules.flag_column(r.rule_id) for r in chosen]
    # Rejected sales never show attributes.
    attributes = [F.when(F.col(rules.VALID), F.col(c)).alias(c) for c in joined]
    judged = marked.select(*sales.columns, *flags, rules.ISSUES, rules.VALID, *attributes)

    def look_up(valid: DataFrame) -> DataFrame:
        return prepare_sales(valid, canon, set(ATTRIBUTES), hot, lazy, detours)

    return Evaluation(judged, dims, tuple(chosen), tuple(sales.columns), look_up)
