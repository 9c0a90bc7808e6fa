from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import CARS, PEOPLE, STORES
from tallysieve.operators import keys, marts, metrics, rules
from tallysieve.plans.normalise import normalise


def report_of(ev):
    return {r["check"]: (r["failed_rows"], r["status"]) for r in ev.report.collect()}


CASES = [
    ("missing_venda_id", [{"venda_id": None}], 1, False),
    ("duplicate_venda_id", [{}, {"valor_venda": "80.00"}], 1, False),
    ("invalid_data_venda", [{"data_venda": "invalid"}], 1, False),
    ("invalid_valor_venda", [{"valor_venda": "invalid"}], 1, False),
    ("negative_valor_venda", [{"valor_venda": "-1.00"}], 1, False),
    ("zero_valor_venda", [{"valor_venda": "0"}], 1, False),
    ("suspicious_valor_venda_placeholder", [{"valor_venda": "9999999"}], 1, False),
    ("missing_veiculo_id", [{"veiculo_id": None}], 1, False),
    ("orphan_veiculo_id", [{"veiculo_id": "V404"}], 1, False),
    ("missing_loja_id", [{"loja_id": ""}], 1, False),
    ("orphan_loja_id", [{"loja_id": "L404"}], 1, False),
    ("future_data_venda", [{"data_venda": "2099-01-01"}], 1, True),
    ("invalid_valor_referencia", [{"valor_referencia": "invalid"}], 1, True),
    ("missing_consultor_id", [{"consultor_id": None}], 1, True),
    ("orphan_consultor_id", [{"consultor_id": "C404"}], 1, True),
    ("consultor_loja_mismatch", [{"consultor_id": "C2"}], 1, True),
    ("veiculo_multiple_sales", [{}, {"venda_id": "S2"}], 2, True),
]


@pytest.mark.parametrize(("rule", "changes", "failed", "kept"), CASES, ids=[c[0] for c in CASES])
def test_each_sales_rule(run_rules, rule, changes, failed, kept):
    ev = run_rules(*changes)
    rows = ev.flagged.select(rules.ISSUES, rules.VALID).collect()
    hit = [r for r in rows if rule in r[0].split("|")]
    assert len(hit) == failed
    assert all(r[1] is kept for r in hit)


def test_report_has_every_rule_in_order(run_rules):
    rows = run_rules().report.orderBy("position").collect()
    assert [r["check"] for r in rows] == [r.rule_id for r in rules.CATALOG]
    assert {r["status"] for r in rows} == {"passed"}


def test_first_sale_stays(run_rules):
    ev = run_rules({}, {"valor_venda": "80.00"})
    assert [r[0] for r in ev.fact.select("valor_venda").collect()] == [Decimal("90.00")]
    assert [r[0] for r in ev.rejected.select("__source_line").collect()] == [3]


def test_combined_counts(run_rules):
    ev = run_rules(
        {"consultor_id": "C404"},
        {"venda_id": "S2", "veiculo_id": "V404"},
        {"venda_id": "S3", "veiculo_id": "V2", "loja_id": "L404"},
        {"venda_id": "S4", "veiculo_id": "V3", "consultor_id": "C2"},
    )
    assert sorted(r[0] for r in ev.fact.select("venda_id").collect()) == ["S1", "S4"]
    assert sorted(r[0] for r in ev.rejected.select("venda_id").collect()) == ["S2", "S3"]
    report = report_of(ev)
    assert report["orphan_consultor_id"] == (1, "warning")
    assert report["orphan_veiculo_id"] == (1, "failed")
    assert report["orphan_loja_id"] == (1, "failed")
    assert report["consultor_loja_mismatch"] == (2, "warning")


def test_repeated_dimension_keys_keep_the_first(run_rules):
    stores = [*STORES, ("l1 ", "Outra", "X", "SP", "Z")]
    cars = [*CARS, ("V1", "2020", "Outra", *CARS[0][3:])]
    people = [*PEOPLE, ("C1", "Outro", "L1", "A", "2020-01-01")]
    ev = run_rules({}, stores=stores, cars=cars, people=people)
    report = report_of(ev)
    for rule in rules.DIMENSION_RULES:
        assert report[rule] == (2, "failed")
    row = ev.fact.collect()
    assert len(row) == 1
    assert (row[0]["loja"], row[0]["marca"], row[0]["consultor"], row[0]["quality_issues"]) == ("Centro", "Marca", "Ana", "")


def test_sale_without_consultant_meets_null_consultant(run_rules):
    people = [*PEOPLE, ("n/a", "Sem cadastro", "L1", "A", "")]
    for split in (False, True):
        row = run_rules({"consultor_id": None}, people=people, split=split).fact.collect()[0]
        assert row["consultor"] == "Sem cadastro"


@pytest.mark.parametrize(("amount", "expected"), [("90", "10/0/10"), ("110", "0/10/-10"), ("100", "0/0/0")])
def test_metrics(run_rules, amount, expected):
    row = run_rules({"valor_venda": amount}).fact.select(*metrics.METRIC_COLUMNS).collect()[0]
    assert [int(x) for x in row[:3]] == [int(x) for x in expected.split("/")]


def test_no_metrics_without_reference(run_rules):
    row = run_rules({"valor_referencia": "x"}).fact.select(*metrics.METRIC_COLUMNS).collect()[0]
    assert list(row) == [None] * 4


def mart_rows(ev):
    return {
        (str(r["mes"])[:7], r["loja"]): tuple(None if x is None else str(x) for x in r[4:])
        for r in marts.monthly_mart(ev.fact).collect()
    }


MART_SALES = (
    {"data_venda": "2025-01-10"},
    {"venda_id": "S2", "data_venda": "2025-01-20", "veiculo_id": "V2", "valor_referencia": "1000", "valor_venda": "950"},
    {"venda_id": "S3", "data_venda": "2025-02-10", "veiculo_id": "V3", "loja_id": "L2", "consultor_id": "C2",
     "valor_referencia": "200", "valor_venda": "250"},
)


def test_mart_and_overall(run_rules):
    ev = run_rules(*MART_SALES)
    assert mart_rows(ev) == {
        ("2025-01", "Centro"): ("2", "1040.00", "520.00", "60.00", "0.00", "60.00", "5.4545"),
        ("2025-02", "Norte"): ("1", "250.00", "250.00", "0.00", "50.00", "-50.00", None),
    }
    total = [str(x) for x in metrics.overall(ev.fact).collect()[0]]
    assert total == ["3", "1290.00", "430.0000", "60.00", "50.00", "10.00", "5.4545"]
    assert all(r["confere"] for r in marts.reconcile(ev.fact, marts.monthly_mart(ev.fact)).collect())


def skewed(n=900):
    """A third of the rows on one sale id and one vehicle, a third without consultant, orphans among the hot keys."""
    out = []
    for i in range(n):
        hot = i % 3 == 0
        out.append({
            "venda_id": "HOT" if hot else f"S{i // 2}", "veiculo_id": "V404" if hot else f"V{1 + i % 4}",
            "loja_id": "L1" if i % 4 else "L2", "consultor_id": None if i % 3 == 1 else f"C{1 + i % 2}",
            "valor_venda": str(50 + i % 90),
        })
    return out


def test_hot_key_path_gives_the_same_rows(run_rules):
    people = [*PEOPLE, ("-", "Sem cadastro", "L1", "A", "")]
    plain = run_rules(*skewed(), people=people, split=False)
    split = run_rules(*skewed(), people=people, split=True)
    columns = ["__source_line", rules.ISSUES, rules.VALID, "consultor", "marca", "loja"]
    expected = sorted(map(str, plain.look_up(plain.flagged).select(*columns).collect()))
    assert sorted(map(str, split.look_up(split.flagged).select(*columns).collect())) == expected
    assert not {"consultor", "marca", "loja"} & set(split.flagged.columns)  # attributes meet valid sales only
    assert len(expected) == 900


def test_hot_key_list_is_bounded_and_finds_hot_keys(make_tables):
    sales = normalise(make_tables(*skewed())["vendas"], "vendas")
    found = {(r[0], r[1]) for r in keys.hot_keys(sales, ["venda_id", "consultor_id"]).collect()}
    assert ("venda_id", "HOT") in found
    assert ("consultor_id", "C1") in found
    assert len(found) <= 2 * keys.MAX_HOT_KEYS


def test_result_does_not_depend_on_partitioning(make_tables):
    sales = normalise(make_tables(*skewed(120))["vendas"], "vendas")
    marked = [
        sorted(map(str, keys.mark_later(df, "venda_id", "x").select("__source_line", "x").collect()))
        for df in (sales, sales.repartition(7, "__source_line"), sales.coalesce(1))
    ]
    assert marked[0] == marked[1] == marked[2]


def test_unique_guard(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert keys.assert_unique(df, "k").collect()[0]["rows"] == 2
    with pytest.raises(Exception, match="key is not unique"):
        keys.assert_unique(df.union(df), "k").collect()


def test_user_rule(make_tables):
    from tallysieve.plans.evaluate import evaluate
    from tallysieve.plans.normalise import normalise_all

    text = rules.RuleText("cheap_sale", "d", "error", "vendas", "c", "reject_sale", "r", True)
    own = rules.Rule(text, lambda: F.col("valor_venda") < 50)
    ev = evaluate(normalise_all(make_tables({"valor_venda": "10"}, {"venda_id": "S2"})), extra_rules=[own])
    assert [r[0] for r in ev.rejected.select("quality_issues").collect()][0].endswith("cheap_sale")
    assert report_of(ev)["cheap_sale"] == (1, "failed")


def test_several_tables_of_one_key_meet_behind_one_shuffle(spark, make_tables):
    """Far and hot keys find the same payloads; a key without match has none."""
    sales = normalise(make_tables(*skewed(90))["vendas"], "vendas")
    names = spark.createDataFrame([("V1", "a"), ("V404", "b")], "veiculo_id string, name string")
    marks = spark.createDataFrame([("V2", True), ("V404", False)], "veiculo_id string, mark boolean")
    hot = spark.createDataFrame([("V404",), ("V3",)], "hot_key string")
    want = {"V1": ("a", None), "V2": (None, True), "V3": (None, None), "V4": (None, None), "V404": ("b", False)}
    for listed in (None, hot):
        rows = keys.lookup_join(sales, [names, marks], "veiculo_id", listed).select("veiculo_id", "name", "mark").collect()
        assert len(rows) == 90 and all((r[1], r[2]) == want[r[0]] for r in rows)


def test_a_build_writes_no_dimension_and_no_sale_twice(spark, make_tables, tmp_path):
    """Marks and attributes come from one look-up; what is written on the way is dropped, rejected sales show no attributes."""
    from tallysieve.plans.run import build
    from tallysieve.sinks.staging import Staging

    stage = Staging(spark, str(tmp_path / "stage"))
    _, ev = build(make_tables(*skewed(90)), stage)
    written = {p.name for p in (tmp_path / "stage").iterdir()}
    assert written == {
        *(f"clean_{n}" for n in ("vendas", "lojas", "consultores", "veiculos")), *(f"canon_{n}" for n in ("lojas", "consultores", "veiculos")),
        "hot_keys", "repeated_sales", "repeated_veiculos", "judged",
    }
    assert ev.fact.where("marca is not null").count() == ev.fact.count() > 0
    assert ev.judged.where("not is_valid and (marca is not null or loja is not null or consultor is not null)").count() == 0


def test_only_wanted_parts_are_published(spark, make_tables, tmp_path):
    from tallysieve.plans.run import build, publish_parts
    from tallysieve.sinks.staging import Staging

    tables = make_tables({}, {"venda_id": None})
    clean, ev = build(tables, Staging(spark, str(tmp_path / "stage")))
    made = publish_parts(spark, str(tmp_path / "out"), str(tmp_path / "bad"), tables["vendas"], clean, ev, "v", {"rejected_sales"})
    assert [(f["name"], f["rows"]) for f in made] == [("rejected_sales", 1)]
    assert [p.name for p in (tmp_path / "out" / "version=v").iterdir()] == ["rejected_sales"]


def test_a_rule_on_the_sale_alone_writes_nothing(spark, tmp_path):
    from tallysieve.querybook.world import World

    at = str(tmp_path)
    rows = [(13, 6, 1, 1, 100.0, 0.1, date(1997, 3, 5), "A"), (13, 7, 1, 1, 100.0, 0.1, date(1997, 3, 5), "A")]
    names = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_discount double, l_shipdate date, l_returnflag string"
    spark.createDataFrame(rows, names).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(13, 1, "1-URGENT")], "o_orderkey bigint, o_custkey bigint, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(1,)], "s_suppkey bigint").write.parquet(f"{at}/supplier.parquet")
    w = World(spark, at)
    assert [r["venda_id"] for r in w.failing("invalid_data_venda").collect()] == ["S13-6"]  # 13 * 7 + 6 = 97
    assert not w._kept


def test_judging_some_columns_gives_what_the_whole_evaluation_gives(make_tables):
    """Hot keys, sales without consultant, orphans and repeats included; with issues and without."""
    from tallysieve.plans.evaluate import evaluate, judge
    from tallysieve.plans.normalise import normalise_all

    people = [*PEOPLE, ("-", "Sem cadastro", "L1", "A", ""), ("C1", "Outra", "L2", "A", "")]
    odd = [{"venda_id": None, "loja_id": None}, {"venda_id": None, "veiculo_id": None}, {"data_venda": "x"}, {"valor_venda": "-1"}]
    tables = normalise_all(make_tables(*skewed(300), *odd, people=people, cars=[*CARS, ("V1", "2020", "Outra", *CARS[0][3:])]))
    today = F.lit("2026-01-01").cast("date")
    whole = metrics.with_metrics(evaluate(tables, today, split_hot_keys=False).judged)
    for columns in (
        ["venda_id", "marca", "loja", "desconto_concedido"], ["canal_origem"], [rules.ISSUES, "consultor", rules.CONSULTANT_STORE, "loja_id"],
        [rules.flag_column(r.rule_id) for r in rules.sales_rules()],
    ):
        shown = ["__source_line", rules.VALID, *columns]
        found = sorted(map(str, judge(tables, shown, today).select(*shown).collect()))
        assert found == sorted(map(str, whole.select(*shown).collect())) and len(found) == 304


def test_later_and_repeated_rows_are_marked_where_they_meet(spark):
    """Against counting by hand: hot, NULL and equal places among them."""
    rows = [(None if i % 5 == 0 else f"K{i % 7}", f"{'ab'[i % 2]}.csv", i // 3) for i in range(60)] + [("K1", "a.csv", 0), ("K9", "A.csv", 1)]
    df = spark.createDataFrame(rows, "k string, __source_file string, __source_line bigint")
    order = {r: (r[1].lower(), r[1], r[2]) for r in rows}
    later = sorted((str(r), r[0] is not None and order[r] > min(order[x] for x in rows if x[0] == r[0])) for r in rows)
    often = sorted((str(r), r[0] is not None and sum(x[0] == r[0] for x in rows) > 1) for r in rows)
    for hot in (None, spark.createDataFrame([("K1",), (None,), ("K9",), ("K404",)], "hot_key string")):
        marked = keys.rank_later(df, "k", "x", hot).collect()
        assert sorted((str(tuple(r[:3])), r["x"]) for r in marked) == later
        marked = keys.lookup_join(df, [], "k", hot, repeated="x").collect()
        assert sorted((str(tuple(r[:3])), r["x"]) for r in marked) == often


def test_a_query_on_some_columns_writes_no_whole_table(spark, tmp_path):
    """No clean or canonical table and no whole evaluation: what is written of the sales is what the query reads."""
    from tallysieve.querybook.table_queries import marts
    from tallysieve.querybook.world import World

    at = str(tmp_path)
    names = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_discount double, l_shipdate date, l_returnflag string"
    rows = [(k, 1, 1, 1, 100.0, 0.1, date(1997, 3, 5), "A") for k in range(1, 9)]
    spark.createDataFrame(rows, names).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(k, 1, "1-URGENT") for k in range(1, 9)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(1, "S1", 1)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{at}/supplier.parquet")
    spark.createDataFrame([(1, "N1")], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(1, "c", "X")], "c_custkey bigint, c_name string, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(1, "p", "B1", "T", 1)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{at}/part.parquet")
    w = World(spark, at)
    fact = w.fact_of(*marts.MART_READS)
    staged = dict(w._kept)
    assert w._evaluation is None and not any(n.startswith(("clean_", "canon_", "judged")) for n in staged)
    (sales,) = [df for n, df in staged.items() if n.startswith("sales_")]
    assert not {"canal_origem", "forma_pagamento", "consultor_id", "data_venda_original"} & set(sales.columns)
    expected = w.evaluation().fact.select(*marts.MART_READS)  # the same rows from the whole evaluation
    assert sorted(map(str, fact.collect())) == sorted(map(str, expected.collect()))
    assert fact.count() == 0 or {r["loja"] for r in fact.collect()} == {"S1"}


def test_judging_valid_sales_alone_carries_nothing_of_others(make_tables):
    """The same valid sales as the whole evaluation; a sale known to be invalid is written bare, none is left at the end."""
    from tallysieve.plans.evaluate import evaluate, judge
    from tallysieve.plans.normalise import normalise_all

    people = [*PEOPLE, ("-", "Sem cadastro", "L1", "A", "")]
    odd = [{"venda_id": None}, {"venda_id": "S7", "data_venda": "x"}, {"venda_id": "Z", "valor_venda": "-1"}, {"venda_id": "Z"}, {"venda_id": "Y"}]
    tables = normalise_all(make_tables(*skewed(300), *odd, people=people))
    today = F.lit("2026-01-01").cast("date")
    whole = metrics.with_metrics(evaluate(tables, today, split_hot_keys=False).judged).where(rules.VALID)
    staged = {}

    def stage(name, df):
        return staged.setdefault(name, df)

    for columns in (
        ["canal_origem"], ["venda_id", "marca", "loja", "desconto_concedido"],
        ["__source_file", "__source_line", "valor_venda", rules.ISSUES, "consultor", "modelo"], ["__source_line", rules.flag_column("veiculo_multiple_sales")],
    ):
        staged.clear()
        found = judge(tables, columns, today, stage, valid_only=True).select(rules.VALID, *columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.select(rules.VALID, *columns).collect()))
        (sales,) = [df for name, df in staged.items() if name.startswith("sales_")]
        payload = [c for c in ("canal_origem", "valor_venda", "loja_id") if c in sales.columns]
        assert sales.where("venda_id is null").count() == 1 and payload
        assert all(r[0] is None for r in sales.where("venda_id is null").select(*payload).collect())


def test_money_with_and_without_comma(spark):
    texts = {
        "R$ 1.234,50": "1234.50", "1.2,3": "12.30", "1,2.3": "1.23", "1,2,3": None, "1_0,5": "10.50", "1.5": "1.50", "1.2.3": None, "R$": None,
        " - 1 ,5 ": "-1.50", "1,5e1": "15.00", "1.555": None, "1,550": "1.55", ",": None, None: None,
    }
    from tallysieve.functions.numbers import parse_money

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r["t"]: None if r["x"] is None else str(r["x"]) for r in df.select("t", parse_money(F.col("t")).alias("x")).collect()}
    assert found == texts
    plan = df.select(parse_money(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan  # dots and commas cost no regex


def test_slices_publish_what_the_whole_evaluation_does(spark, make_tables, tmp_path, monkeypatch):
    """Many sales are looked up and published slice after slice; rows, counts and fingerprints are those of one piece."""
    from tallysieve.plans import run
    from tallysieve.sinks import publish
    from tallysieve.sinks.staging import Staging

    tables, found = make_tables(*skewed(90), {"veiculo_id": None}, {"veiculo_id": "V2", "data_venda": "2024-03-01"}, {"venda_id": ""}), {}
    for slices in (1, 3):
        monkeypatch.setattr(run, "slices_of", lambda sales, n=slices: n)
        stage, out = Staging(spark, str(tmp_path / f"stage{slices}")), str(tmp_path / f"out{slices}")
        clean, ev = run.build(tables, stage, F.lit("2026-01-01").cast("date"))
        made = run.publish_parts(spark, out, f"{out}-bad", tables["vendas"], clean, ev, "v", run.TABLES, stage)
        found[slices] = {f["name"]: f for f in made}
        assert [f["name"] for f in made] == list(run.TABLES)
        for name in ("fact_vendas", "rejected_sales"):
            read = publish.read_table(spark, out, name, "v")
            assert publish.fingerprint(read) == {k: v for k, v in found[slices][name].items() if k != "name"}
        assert slices == 1 or not list((tmp_path / "stage3").glob("judged*"))
    assert found[1] == found[3] and found[1]["fact_vendas"]["rows"] > 1 and found[1]["rejected_sales"]["rows"] > 1


def test_written_sales_are_sliced_by_their_size(spark, make_tables, tmp_path, monkeypatch):
    from tallysieve.plans import evaluate as plan
    from tallysieve.sinks.staging import Staging

    sales = Staging(spark, str(tmp_path))("sales", make_tables(*skewed(90))["vendas"])
    size = sum(f.stat().st_size for f in (tmp_path / "sales").glob("*.parquet"))
    assert plan.slices_of(sales) == 1
    monkeypatch.setattr(plan, "SLICE_BYTES", -(-size // 4))
    assert plan.slices_of(sales) == 4
