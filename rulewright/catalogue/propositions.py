"""Queries about proposition libraries and their gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates
from ..plans import propositions as P
from ..plans.schema import CORE
from . import base
from .base import FILINGS_SQL, WORTH

query = base.Registry()
QUERIES, ORACLES = query.queries, query.oracles

#: A library of three modules with what real ones have: gates over gates, unproven propositions, a cycle, a name that isn't there.
MODULES = {
    "Chapter1_Part1": f"""
/-! ## Regulation 1 -/
/-- Reg 1(1)(a): the issuer is not debarred -/
def reg_1_1_a (i : Issuer) : Prop :=
  i.is_debarred = false
/-- Reg 1(1)(b): nor a defaulter or fugitive -/
def reg_1_1_b (i : Issuer) : Prop :=
  i.is_fraudulent = false ∧ i.is_fugitive = false
/-- Reg 1(2): further conditions -/
def reg_1_2 (i : Issuer) : Prop :=
  sorry  -- no fields yet
/-- Combined Regulation 1 gate -/
def reg_1_eligible (i : Issuer) : Prop :=
  reg_1_1_a i
  ∧ reg_1_1_b i
/-- Reg 2(1): three years of net worth -/
def reg_2_1 (i : Issuer) : Prop :=
  (i.net_worths.length = 3 ∧ i.net_worths.all (· ≥ {WORTH}))
/-- Reg 2(2): a share of monetary assets -/
def reg_2_2 (i : Issuer) : Prop :=
  i.monetary_asset_ratio ≥ 0  -- any
/-- Reg 2(3): an agreement with a depository -/
def reg_2_3 (i : Issuer) : Prop :=
  i.has_demat_agreement = true
/-- Combined Regulation 2 gate -/
def reg_2_eligible (i : Issuer) : Prop :=
  reg_2_1 i ∧ reg_2_2 i ∧ reg_2_3 i
def chapter1_part1_eligible (i : Issuer) : Prop :=
  reg_1_eligible i ∧ reg_2_eligible i
""",
    "Chapter1_Part2": """
/-- Reg 3(1): monetary assets, unless debarred -/
def reg_3_1 (i : Issuer) : Prop :=
  ¬ (reg_1_1_a i) ∨ i.monetary_asset_ratio ≤ 50
/-- Reg 3(2): general purposes -/
def reg_3_2 (i : Issuer) : Prop :=
  i.general_corp_purpose_ratio ≤ 25
/-- Combined Regulation 3 gate -/
def reg_3_eligible (i : Issuer) : Prop :=
  reg_3_1 i ∧ reg_3_2 i ∧ reg_1_2 i
/-- Reg 4(1): as in the second -/
def reg_4_1 (i : Issuer) : Prop :=
  reg_4_2 i
/-- Reg 4(2): as in the first -/
def reg_4_2 (i : Issuer) : Prop :=
  reg_4_1 i
/-- Combined Regulation 4 gate -/
def reg_4_eligible (i : Issuer) : Prop :=
  reg_4_1 i ∨ reg_3_2 i
/-- Reg 5(1): refers to nothing -/
def reg_5_1 (i : Issuer) : Prop :=
  reg_99_1 i
def chapter1_part2_eligible (i : Issuer) : Prop :=
  reg_3_eligible i ∧ reg_4_eligible i
""",
    "Chapter2_Part1": """
/-- Reg 6(1): an application for listing -/
def reg_6_1 (i : Issuer) : Prop :=
  i.applied_to_stock_exchange = true
/-- Combined Regulation 6 gate -/
def reg_6_eligible (i : Issuer) : Prop :=
  reg_6_1 i ∧ chapter1_part1_eligible i
def offer_eligible (i : Issuer) : Prop :=
  chapter1_part1_eligible i ∧ chapter1_part2_eligible i ∧ reg_6_eligible i
""",
}
LIBRARY = P.load(MODULES, CORE)
_UNKNOWN = "CASE WHEN issuer_id % 10 <> 0 THEN has_demat_agreement END"

#: name, kind, chapter, part, regulation and the value, level by level: the oracle's own reading of the modules.
_LEVELS = (
    (
        ("reg_1_1_a", "bool", 1, 1, 1, "NOT is_debarred"), ("reg_1_1_b", "bool", 1, 1, 1, "NOT is_fraudulent AND NOT is_fugitive"), ("reg_1_2", "not_evaluable", 1, 1, 1, "CAST(NULL AS BOOLEAN)"),
        ("reg_2_1", "list", 1, 1, 2, f"len(net_worths) = 3 AND coalesce(list_bool_and([x >= {WORTH} for x in net_worths]), true)"), ("reg_2_2", "tautology", 1, 1, 2, "true"), ("reg_2_3", "bool", 1, 1, 2, _UNKNOWN),
        ("reg_3_2", "bool", 1, 2, 3, "general_corp_purpose_ratio <= 25"), ("reg_4_1", "not_evaluable", 1, 2, 4, "CAST(NULL AS BOOLEAN)"), ("reg_4_2", "not_evaluable", 1, 2, 4, "CAST(NULL AS BOOLEAN)"), ("reg_5_1", "not_evaluable", 1, 2, 5, "CAST(NULL AS BOOLEAN)"),
        ("reg_6_1", "bool", 2, 1, 6, "applied_to_stock_exchange"),
    ),
    (
        ("reg_1_eligible", "gate", 1, 1, 1, "reg_1_1_a AND reg_1_1_b"), ("reg_2_eligible", "gate", 1, 1, 2, "reg_2_1 AND reg_2_2 AND reg_2_3"), ("reg_3_1", "gate", 1, 2, 3, "NOT reg_1_1_a OR monetary_asset_ratio <= 50"),
        ("reg_4_eligible", "gate", 1, 2, 4, "reg_4_1 OR reg_3_2"),
    ),
    (("chapter1_part1_eligible", "gate", 1, 1, None, "reg_1_eligible AND reg_2_eligible"), ("reg_3_eligible", "gate", 1, 2, 3, "reg_3_1 AND reg_3_2 AND reg_1_2")),
    (("chapter1_part2_eligible", "gate", 1, 2, None, "reg_3_eligible AND reg_4_eligible"), ("reg_6_eligible", "gate", 2, 1, 6, "reg_6_1 AND chapter1_part1_eligible")),
    (("offer_eligible", "gate", 2, 1, None, "chapter1_part1_eligible AND chapter1_part2_eligible AND reg_6_eligible"),),
)
_ALL = [p for level in _LEVELS for p in level]
_MEMBERS = {n: [m for m in e.replace("NOT ", "").replace(" AND ", " ").replace(" OR ", " ").split() if m.startswith(("reg_", "chapter"))] for n, kind, *_, e in _ALL if kind == "gate"}


def _text(value) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


_VALUES_SQL = f"WITH {FILINGS_SQL}, v0 AS (SELECT * FROM filings)" + "".join(
    f", v{k + 1} AS (SELECT *, {', '.join(f'{e} AS {n}' for n, *_, e in level)} FROM v{k})" for k, level in enumerate(_LEVELS)
)
_LONG_SQL = _VALUES_SQL + ", long AS (" + " UNION ALL ".join(f"SELECT issuer_id, '{n}' AS name, '{kind}' AS kind, {_text(c)} AS chapter, {_text(p)} AS part, {_text(r)} AS regulation, {n} AS value FROM v{len(_LEVELS)}" for n, kind, c, p, r, _ in _ALL) + ")"


def filings(spark, d):
    """Filings of which every tenth doesn't tell whether there is an agreement."""
    return base.filings(spark, d).withColumn("has_demat_agreement", F.expr(_UNKNOWN))


@query(
    "q09b_proposition_gates",
    f"{_LONG_SQL} SELECT name, kind, chapter, part, regulation, count(*) FILTER (value) AS passed, count(*) FILTER (NOT value) AS failed, count(*) FILTER (value IS NULL) AS unknown FROM long GROUP BY ALL",
)
def q09b(spark, d):
    return gates.counted(gates.verdicts(filings(spark, d), LIBRARY), "name", "kind", "chapter", "part", "regulation")


@query(
    "q09c_gate_explanations",
    _VALUES_SQL
    + " "
    + " UNION ALL ".join(
        f"SELECT issuer_id, '{n}' AS name, {n} AS value, concat_ws(',', {', '.join(f'CASE WHEN NOT {m} THEN {_text(m)} END' for m in ms)}) AS failing, concat_ws(',', {', '.join(f'CASE WHEN {m} IS NULL THEN {_text(m)} END' for m in ms)}) AS unknown FROM v{len(_LEVELS)}"
        for n, ms in _MEMBERS.items()
    ),
)
def q09c(spark, d):
    return gates.gates(filings(spark, d), LIBRARY).select("issuer_id", "name", "value", F.array_join("failing", ",").alias("failing"), F.array_join("unknown", ",").alias("unknown"))


@query(
    "q09d_gate_hierarchy",
    f"""{_LONG_SQL}, r AS (SELECT chapter, part, regulation, CAST(grouping(chapter, part, regulation) AS BIGINT) AS level, count(*) AS members, count(*) FILTER (NOT value) AS failed, count(*) FILTER (value IS NULL) AS unknown
    FROM long WHERE kind <> 'gate' GROUP BY ROLLUP (chapter, part, regulation)) SELECT *, CASE WHEN failed > 0 THEN false WHEN unknown > 0 THEN NULL ELSE true END AS passed FROM r""",
)
def q09d(spark, d):
    return gates.rolled_up(gates.verdicts(filings(spark, d), LIBRARY))
