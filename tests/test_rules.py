"""Rules: language, goldens, reports, linter."""

import json

import pytest
from pyspark.sql import functions as F

from rulewright.operators import evaluate as E
from rulewright.plans import rules as R
from rulewright.plans.language import Unsupported, compile_predicate
from rulewright.plans.schema import CORE, FieldSpec, Schema, coverage, spark_type

GOOD = {f.name: True for f in CORE.fields if f.type == "boolean"} | {
    "is_debarred": False, "has_debarred_directors": False, "is_fraudulent": False, "is_fugitive": False, "has_outstanding_convertibles": False, "changed_name_recently": False,
    "net_tangible_assets": [40_000_000] * 3, "operating_profits": [200_000_000, 160_000_000, 149_189_000], "net_worths": [20_000_000] * 3,
    "monetary_asset_ratio": 10, "percent_revenue_from_new_name": 60, "general_corp_purpose_ratio": 20,
}


def filings(spark, *records):
    rows = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "issuer_id int, text string")
    return rows.select("issuer_id", CORE.decode(F.col("text")).alias("r")).select("issuer_id", "r.*")


def test_one_failure_with_its_reason(spark):
    got = E.evaluate(filings(spark, GOOD), R.core()).where("not passed").collect()
    assert [(r["id"], r["reason"].split("\n")[0]) for r in got] == [("SEBI ICDR 6(1)(b)", "Operating profit below ₹15 cr in: Year 3")]
    assert got[0]["reason"].split("\n")[1].startswith("Suggested remedy: Demonstrate")


def test_defaults_decide_an_empty_filing(spark):
    failed = E.evaluate(filings(spark, {}), R.core()).where("not passed").select("id").toPandas()["id"].tolist()
    assert failed == ["SEBI ICDR 6(1)(a)", "SEBI ICDR 6(1)(b)", "SEBI ICDR 6(1)(c)", "SEBI ICDR 7(1)"]


def test_report_keeps_order_and_leaves_out_reasons(spark):
    rows = E.reports(filings(spark, GOOD, {}), R.core()).orderBy("issuer_id").select(E.report_json(F.col("report")).alias("j")).collect()
    one = json.loads(rows[0]["j"])
    assert one["eligible"] is False and len(one["passed"]) == 6 and "reason" not in one["passed"][0]
    assert list(one) == ["eligible", "failed", "passed"] and list(one["failed"][0]) == ["id", "passed", "reason", "reference", "title"]


def test_no_rules_are_all_passed(spark):
    got = E.reports(filings(spark, GOOD), R.Ruleset("none", CORE, ())).first()["report"]
    assert got["eligible"] and not got["failed"] and not got["passed"]


def test_rendering(spark):
    text = E.reports(filings(spark, GOOD), R.core()).select(E.render(F.col("report")).alias("t")).first()["t"]
    assert text.startswith("❌ Not Eligible: some rules failed\n\n— Failed —\n❌ SEBI ICDR 6(1)(b) — Operating profit")
    assert "\n\n— Passed —\n✅ SEBI ICDR 5(1)" in text


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("fun i => i.xs.length == 2 && i.xs.all (fun x => x >= 3)", True),
        ("fun i => i.xs.any (· ≥ 7)", False),
        ("fun i => (i.xs.sum * 25) / 100 == 2", True),
        ("fun i => (25 / 100) * i.n == 0", True),
        ("fun i => i.n - 100 == 0", True),
        ("fun i => !(i.b ∨ i.n < 2)", False),
        ("fun i => let big := i.n ≥ 5 big && i.b", True),
        ("fun i => if i.o.isSome then i.o == some 4 else true", True),
        ("fun i => i.xs.contains 4", True),
        ("fun i => i.s ≠ \"\"", True),
        ("fun i => (i.xs.filter (fun x => x > 3)).all (fun x => x > 100)", False),
        ("fun _ => True", True),
        ("fun i => match i.o with some 4 => True | _ => False", True),
        ("fun i => match i.o with some x => x == 5 | _ => True", False),
        ("fun i => not (i.o == none) and i.xs.exists (λ x, x == 5)", True),
        ("fun i => i.ps.all (fun p => p.1 == 2 && p.2 == \"b\")", True),
        ("fun i => i.ds.any (fun d => d.other.length > 1)", True),
    ],
)
def test_language(spark, source, expected):
    form = Schema.of(xs="List Nat", n="Nat", b="Bool", o="Option Nat", s="String")
    form = Schema((*form.fields, FieldSpec("ps", "array<struct<_1:bigint,_2:string>>"), FieldSpec("ds", "array<struct<other:array<bigint>>>")))
    sql, _ = compile_predicate(source, form)
    row = spark.createDataFrame([([4, 5], 7, True, 4, "x", [(2, "b")], [([],), ([1, 2],)])], form.ddl)
    assert row.select(F.expr(sql).alias("v")).first()["v"] is expected


@pytest.mark.parametrize("source", ["i.x", "fun i => i.unknown", "fun i => i.n.frobnicate", "fun i => i.n >", "fun i => other"])
def test_language_rejects(source):
    with pytest.raises(Unsupported):
        compile_predicate(source, Schema.of(n="Nat"))


def test_ruleset_file_and_linter(spark):
    from rulewright.catalogue.rules import FAULTY

    rules = R.load("faulty", FAULTY, CORE)
    assert [r.id for r in rules.rules] == ["R_1", "R_2", "R_2_2", "R_3", "R 4", "R_5"]
    assert [r.status for r in rules.rules] == ["ok", "stub", "not_evaluable", "tautology", "not_evaluable", "not_evaluable"]
    found = {(r["id"], r["finding"].split(":")[0]) for r in R.lint(rules, rules.metadata(spark)).collect()}
    assert found >= {("R_2", "stubbed_check"), ("R_2_2", "not_evaluable"), ("R_3", "tautology"), ("R 4", "wrapped_failReason"), ("R_5", "suspected_function_field_usage")}
    assert not any(i == "R_1" for i, _ in found)
    assert rules.fields == {"is_debarred", "monetary_asset_ratio"}


def test_many_rules_in_one_projection(spark):
    rules = tuple(R.Rule(f"r{k}", "t", "", f"general_corp_purpose_ratio >= {k}", "low") for k in range(130))
    n = E.evaluate(filings(spark, GOOD), R.Ruleset("wide", CORE, rules)).where("passed").count()
    assert n == 21


def test_types_and_envelopes(spark):
    assert spark_type("Option (List Nat)") == spark_type("OptionListNat") == ("array<bigint>", True)
    with pytest.raises(ValueError):
        spark_type("Float")
    form = Schema.of(k="Nat", o="Option Nat")
    texts = ['{"k": 3, "x": 1}', '{"issuer_id": "a", "fields": {"k": 4}}', '{"k": null}', "{", '{"k": 1} x', None, '{"k": -1}']
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", form.decode(F.col("t")).alias("r"), form.problem(F.col("t")).alias("p")).orderBy("i").collect()
    assert [r["r"] and r["r"]["k"] for r in got] == [3, 4, 0, None, None, None, -1]
    assert [r["p"] for r in got] == [None, None, "invalid filing", "invalid JSON", "invalid JSON", "invalid JSON", "invalid filing"]
    assert spark.range(1).select(coverage(form, lambda _: F.lit(None)).alias("n")).first()["n"] == 0


def test_list_functions(spark):
    form = Schema.of(a="List Nat", b="List Nat", n="Nat")
    checks = {
        "(i.a.zip i.b).any (fun p => p.1 > p.2)": [True, False],
        "(i.a.zip i.b).length": [2, 0],
        "(i.a.zipIdx).all (fun p => p.1 >= p.2)": [True, True],
        "(i.a.find? (fun x => x > 2)).getD 0": [3, 0],
        "(i.a.find? (fun x => x > 9)).isNone": [True, True],
        "(i.a.partition (fun x => x > 2)).1.length": [1, 0],
        "(i.a.partition (fun x => x > 2)).2.sum": [3, 0],
        "(List.range i.n).sum": [3, 0],
    }
    rows = spark.createDataFrame([([1, 2, 3], [0, 5], 3), ([], [1], 0)], "a array<bigint>, b array<bigint>, n bigint").coalesce(1)
    for check, want in checks.items():
        sql, _ = R.compile_predicate("fun i => " + check, form)
        assert [r[0] for r in rows.select(F.expr(sql)).collect()] == want, check


def test_registry():
    R.register("mine", lambda: R.load("mine", '{ id := "A  1"\n, title := "t"\n, check := fun i => i.is_debarred }', R.CORE))
    assert R.registered() == ["core", "mine"] and [r.id for r in R.named("core").rules] == [r.id for r in R.core().rules]
    assert R.named("mine").rules[0].id == "A 1" and R.named("mine").rules[0].fixes == ("normalized_rule_id",)
    with pytest.raises(KeyError, match="core, mine"):
        R.named("other")


def test_the_core_form_is_whole():
    assert len(R.CORE.fields) == 38
    sr = "fun i => i.sr_net_worth == 0 ∨ (i.is_tech_firm ∧ i.sr_voting_ratio ≥ 2 ∧ i.sr_class_count == 1)"
    assert R.compile_predicate(sr, R.CORE)[1] == {"sr_net_worth", "is_tech_firm", "sr_voting_ratio", "sr_class_count"}
