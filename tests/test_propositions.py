"""Proposition libraries: reading, order, cycles, three-valued gates."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from rulewright.operators import gates
from rulewright.plans import propositions as P
from rulewright.plans.schema import Schema

FORM = Schema.of(a="Bool", b="Bool", n="Nat", years="List Nat", name="String")


def library(text, module="Chapter3_Part2"):
    return P.load({module: text}, FORM)


def prop(name, body, doc=""):
    return f"/-- {doc} -/\ndef {name} (i : Issuer) : Prop :=\n  {body}\n\n"


@pytest.fixture
def filings(spark):
    def make(*rows):
        return spark.createDataFrame([(k, *r, "extra", "x") for k, r in enumerate(rows)], "issuer_id long, a boolean, b boolean, n long, years array<long>, name string, value string, kind string")

    return make


def test_labels_kinds_and_places():
    lib = library(prop("reg_7_1_a", 'i.name = "x"', "Reg 7(1)(a): named: so") + prop("reg_8A", "i.n ≥ 0 ∧ i.n ≥ 0", "Reg 8A: any") + prop("reg_9_eligible", "reg_7_1_a i ∧ reg_8A i", "Combined Regulation 9 gate") + prop("chapter5_part4_eligible", "reg_9_eligible i") + prop("other", "i.years.all (· ≥ 1)"))
    said = {p.name: (p.kind, p.label, p.title, p.chapter, p.part, p.regulation) for p in lib.propositions}
    assert said["reg_7_1_a"] == ("string", "7(1)(a)", "named: so", "3", "2", "7")
    assert said["reg_8A"][0] == "tautology" and said["reg_8A"][-1] == "8A"
    assert said["reg_9_eligible"] == ("gate", "", "Combined Regulation 9 gate", "3", "2", "9")
    assert said["chapter5_part4_eligible"] == ("gate", "", "", "5", "4", None)
    assert said["other"] == ("list", "", "", "3", "2", None) and not lib.problems
    assert [p.name for p in lib.gates] == ["reg_9_eligible", "chapter5_part4_eligible"]


def test_order_holds_whatever_order_they_are_written_in():
    parts = [prop("top", "mid i ∧ low i"), prop("mid", "low i ∨ base i"), prop("low", "base i"), prop("base", "i.a")]
    for shuffled in itertools.permutations(parts):
        lib = library("".join(shuffled))
        assert [p.name for p in lib.propositions] == ["base", "low", "mid", "top"] and [len(x) for x in lib.levels] == [1, 1, 1, 1]
    assert [p.name for p in lib.needed("mid").propositions] == ["base", "low", "mid"]


def test_what_cannot_be_used_is_reported_and_unknown():
    lib = library(prop("a1", "b1 i") + prop("b1", "c1 i ∧ d1 i") + prop("c1", "a1 i") + prop("d1", "i.a") + prop("own", "own i") + prop("gone", "nowhere i") + prop("field", "i.nothing = 1") + prop("later", "sorry") + prop("d1", "i.b") + prop("hinges", "a1 i ∨ d1 i"))
    assert dict(lib.problems) == {"d1": "defined again", "gone": "no proposition nowhere", "field": "unknown field nothing", "b1": "cycle: b1 -> c1 -> a1 -> b1", "own": "cycle: own -> own"} or dict(lib.problems)["a1"].startswith("cycle: a1 -> b1 -> c1 -> a1")
    assert {p.name for p in lib.propositions if p.kind == "not_evaluable"} == {"a1", "b1", "c1", "own", "gone", "field", "later"}
    assert lib["d1"].sql == "a" and lib["hinges"].kind == "gate"


def test_gates_combine_unknowns_as_logic_does(filings):
    lib = library(prop("p", "i.a = true") + prop("q", "i.b = true") + prop("both", "p i ∧ q i") + prop("any", "p i ∨ q i") + prop("no", "¬ (p i)"))
    values = [True, False, None]
    rows = filings(*[(a, b, 1, [], "") for a in values for b in values])
    got = {(r["issuer_id"], r["name"]): r["value"] for r in gates.verdicts(rows, lib).collect()}
    for k, (a, b) in enumerate((a, b) for a in values for b in values):
        assert got[k, "both"] is (False if False in (a, b) else None if None in (a, b) else True)
        assert got[k, "any"] is (True if True in (a, b) else None if None in (a, b) else False)
        assert got[k, "no"] is (None if a is None else not a)
    told = {r["issuer_id"]: (r["failing"], r["unknown"]) for r in gates.gates(rows, lib).where("name = 'both'").collect()}
    assert told[5] == (["p"], ["q"]) and told[0] == ([], []) and told[8] == ([], ["p", "q"])
    sums = {r["name"]: (r["passed"], r["failed"], r["unknown"]) for r in gates.counted(gates.verdicts(rows, lib), "name").collect()}
    assert sums["both"] == (1, 5, 3) and sums["any"] == (5, 1, 3)


def test_each_proposition_is_computed_once(filings):
    names = [f"g{k}" for k in range(12)]
    text = prop("heavy", "i.years.all (· ≥ 7777)") + "".join(prop(n, "heavy i ∧ i.a" if k == 0 else f"heavy i ∧ {names[k - 1]} i") for k, n in enumerate(names))
    plan = gates.verdicts(filings((True, True, 1, [9000], "")).repartition(2), library(text))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"forall\(", plan)) <= 2  # once in the adaptive plan, once more where both plans are shown


def test_roll_up_and_empty_tables(filings):
    lib = P.load({"Chapter1_Part1": prop("reg_1", "i.a = true"), "Chapter1_Part2": prop("reg_2", "i.b = true")}, FORM)
    rows = filings((True, None, 1, None, None), (True, True, 1, None, None))
    got = {(r["chapter"], r["part"], r["regulation"], r["level"]): r["passed"] for r in gates.rolled_up(gates.verdicts(rows, lib)).collect()}
    assert got == {("1", "1", "1", 0): True, ("1", "2", "2", 0): None, ("1", "1", None, 1): True, ("1", "2", None, 1): None, ("1", None, None, 3): None, (None, None, None, 7): None}
    assert gates.verdicts(rows.limit(0), lib).count() == 0
    assert gates.verdicts(rows.withColumn("a", F.lit(None).cast("boolean")), lib).where("value").count() == 1


def test_schema_of_a_definitions_file():
    text = """
abbrev Crore := Nat
inductive Kind where
  | A | B
structure Person where
  is_barred : Bool
  share     : Crore  -- percent
structure Issuer where
  /-- a comment : Nat -/
  worth     : Crore
  kind      : Kind
  years     : List Nat
  partial   : Option (List Nat) := none
  people    : List Person
  deriving Repr
"""
    assert P.read_schema(text).ddl == "`worth` bigint, `kind` string, `years` array<bigint>, `partial` array<bigint>, `people` array<struct<is_barred: boolean, share: bigint>>"
    with pytest.raises(ValueError, match="no structure Offer; there are Issuer, Person"):
        P.read_schema(text, "Offer")


def test_nested_records_in_a_proposition(spark):
    form = P.read_schema("structure Person where\n  barred : Bool\nstructure Issuer where\n  people : List Person\n")
    lib = P.load({"m": prop("clean", "i.people.all (fun p => p.barred = false)")}, form)
    rows = spark.createDataFrame([(1, [(False,)]), (2, [(True,), (None,)]), (3, [(None,)]), (4, [])], "issuer_id long, people array<struct<barred: boolean>>")
    assert {r["issuer_id"]: r["value"] for r in gates.verdicts(rows, lib).collect()} == {1: True, 2: False, 3: None, 4: True}
