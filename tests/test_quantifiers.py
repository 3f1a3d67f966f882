"""Rules over rows against the same rules over lists, and against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from rulewright.plans import quantifiers as Q
from rulewright.plans.language import Unsupported, compile_predicate
from rulewright.plans.schema import Schema

FORM = Schema.of(limit="Nat", flag="Bool", lots="array<struct<id:bigint,price:bigint,open:boolean>>", paid="array<struct<id:bigint,price:bigint,day:bigint>>", held="List Nat")
RULES = {
    "plain": "fun i => i.lots.any (fun s => s.price > 12)",
    "truth": "fun i => i.lots.all (fun s => s.open)",
    "with_field": "fun i => i.paid.any (fun p => p.price > i.limit) || i.flag",
    "field_in_body": "fun i => i.lots.all (fun s => i.flag || s.price >= i.limit)",
    "below": "fun i => i.lots.all (fun s => i.paid.any (fun p => p.id == s.id && p.price < s.price))",
    "mirrored": "fun i => i.lots.any (fun s => i.paid.all (fun p => s.id != p.id || s.price <= p.price))",
    "unequal": "fun i => i.lots.all (fun s => i.paid.any (fun p => p.id != s.id))",
    "unequal_where": "fun i => i.lots.any (fun s => i.paid.any (fun p => p.id == s.id && p.day != s.price))",
    "two_ranges": "fun i => i.lots.any (fun s => s.open && i.paid.any (fun p => p.price < s.price && p.day > s.id))",
    "three_ranges": "fun i => i.lots.all (fun s => i.paid.any (fun p => p.price <= s.price && p.day >= s.id && p.id != s.id))",
    "disjoint": "fun i => i.lots.all (fun s => i.paid.any (fun p => (p.id == s.id || p.day > s.price) && p.price > 3))",
    "levels": "fun i => i.lots.any (fun s => i.held.any (fun h => h == s.id && i.paid.any (fun p => p.id == h && p.day < i.limit)))",
    "none_at_all": "fun i => !(i.lots.any (fun s => i.paid.all (fun p => p.price < s.price + 2)))",
    "members": "fun i => i.lots.all (fun s => i.held.contains s.id) || i.held.isEmpty",
    "arithmetic": "fun i => i.paid.any (fun p => p.price * 2 - 3 > 10 && p.day / 2 == 1)",
    "constant": "fun i => i.lots.any (fun s => true) && !i.flag",
}


@pytest.fixture(scope="module")
def both(spark):
    chance = random.Random(11)
    n = chance.randint
    rows = [
        (k, n(0, 9), n(0, 1) == 1, [(n(0, 3), n(0, 15), n(0, 3) > 0) for _ in range(n(0, 3))], [(n(0, 3), n(0, 15), n(0, 6)) for _ in range(n(0, 4))], [n(0, 3) for _ in range(n(0, 3))])
        for k in range(400)
    ]
    rows.append((400, 5, False, [(n(0, 3), n(0, 15), True) for _ in range(3000)], [(n(0, 3), n(0, 15), n(0, 6)) for _ in range(3000)], [1, 2]))
    lists = spark.createDataFrame(rows, "issuer_id long, " + FORM.ddl).repartition(5).cache()
    apart = lambda c: lists.select("issuer_id", F.inline(c))
    stray = spark.createDataFrame([(None, 1, 1, True), (9999, 1, 1, True)], "issuer_id long, id long, price long, open boolean")
    relations = {"lots": Q.Relation(apart("lots").unionByName(stray)), "paid": Q.Relation(apart("paid")), "held": Q.Relation(lists.select("issuer_id", F.explode("held").alias("value")))}
    return lists, relations


@pytest.mark.parametrize("name", RULES)
def test_rows_give_what_lists_give(both, name):
    lists, relations = both
    want = {r[0]: r[1] for r in lists.select("issuer_id", F.expr(compile_predicate(RULES[name], FORM)[0]).alias("x")).collect()}
    got = Q.evaluate(lists.select("issuer_id", "limit", "flag"), relations, {"x": RULES[name]}).collect()
    assert {r[0]: r[1] for r in got} == want and len(got) == 401
    assert 0 < sum(want.values()) < 401


def test_many_rules_at_once_and_no_cartesian_product(both):
    lists, relations = both
    some = {n: RULES[n] for n in ("below", "two_ranges", "levels", "with_field", "members")}
    got = Q.evaluate(lists.select("issuer_id", "limit", "flag"), relations, some)
    assert got.columns == ["issuer_id", *some]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "collect_list" not in plan
    for name in some:
        alone = Q.evaluate(lists.select("issuer_id", "limit", "flag"), relations, {name: some[name]})
        assert got.select("issuer_id", name).exceptAll(alone).isEmpty()


def test_options_empty_tables_and_repeated_rows(spark):
    filings = spark.createDataFrame([(1, None), (2, 5), (2, 5), (None, 5), (3, 7)], "k long, x long")
    entries = spark.createDataFrame([(1, None), (2, 5), (2, 5), (3, 8), (None, 5)], "k long, value long")
    rules = {"same": "fun i => i.v.any (fun e => e == i.x)", "other": "fun i => i.v.any (fun e => e != i.x)", "all": "fun i => i.v.all (fun e => e == i.x)"}
    got = [tuple(r) for r in Q.evaluate(filings, {"v": Q.Relation(entries, "k")}, rules, "k").collect()]
    assert sorted(got, key=str) == sorted([(1, True, False, True), (2, True, False, True), (2, True, False, True), (None, False, False, True), (3, False, True, False)], key=str)
    none = Q.evaluate(filings, {"v": Q.Relation(entries.limit(0), "k")}, rules, "k").where("k = 3").first()
    assert tuple(none) == (3, False, False, True)
    assert Q.evaluate(filings.limit(0), {"v": Q.Relation(entries, "k")}, rules, "k").count() == 0


@pytest.mark.parametrize(
    ("source", "said"),
    [
        ("fun i => i.v.length", "length of rows"),
        ("fun i => i.v.any (fun e => e.nothing > 1)", "unknown field nothing"),
        ("fun i => i.v.any (fun e => x > 1)", "unknown name x"),
        ("fun i => i.v.any (fun e => i.v.any (fun f => f + e > 3))", "no comparison of f"),
        ("fun i => i.v.any (fun e => i.v.any (fun e => e > 3))", "named twice"),
        ("i.v", "not a function"),
    ],
)
def test_what_is_not_understood(spark, source, said):
    rows = spark.range(1).selectExpr("id as k", "id as value")
    with pytest.raises(Unsupported, match=said):
        Q.evaluate(rows.select("k"), {"v": Q.Relation(rows, "k")}, {"r": source}, "k")
