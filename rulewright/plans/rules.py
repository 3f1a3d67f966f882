"""Rules as data: specifications, rulesets from files, the core ruleset, and the linter."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .language import Unsupported, compile_predicate, read_records
from .schema import CORE, Schema

STUB_REASON = "(rule {}: check stub — schema mismatch)"


@dataclass(frozen=True)
class Rule:
    """`check` is Spark SQL over a filing's fields; `reason` a column that is read only where it fails."""

    id: str
    title: str
    reference: str
    check: str
    reason: Column | Callable[[], Column] | str
    remedy: str | None = None
    status: str = "ok"  # ok, stub, tautology or not_evaluable
    fields: frozenset[str] = frozenset()
    note: str = ""
    fixes: tuple[str, ...] = ()  # what reading the rule had to repair

    def reason_column(self) -> Column:
        made = self.reason() if callable(self.reason) and not isinstance(self.reason, Column) else self.reason
        return F.lit(made) if isinstance(made, str) else made


@dataclass(frozen=True)
class Ruleset:
    name: str
    schema: Schema
    rules: tuple[Rule, ...]

    @property
    def fields(self) -> set[str]:
        """Fields that any rule reads; all others can be pruned."""
        return set().union(*(r.fields for r in self.rules)) if self.rules else set()

    def metadata(self, spark: SparkSession) -> DataFrame:
        rows = [(self.name, k, r.id, r.title, r.reference, r.remedy, r.status, sorted(r.fields), r.note, list(r.fixes)) for k, r in enumerate(self.rules)]
        return spark.createDataFrame(rows, "ruleset string, ordinal int, id string, title string, reference string, remedy string, status string, fields array<string>, note string, fixes array<string>")


def _literal(text: str | None) -> str | None:
    m = re.search(r'"((?:[^"\\]|\\.)*)"', text or "", re.S)
    return m[1].replace('\\"', '"') if m else None


_CONSTANT = re.compile(r"fun\s+\w+\s*=>\s*(?:True|true)")
_TAUTOLOGY = re.compile(r"(?:>=\s*0\)|size\([a-z_]+\) >= 0)")


def repairs(record: dict[str, str], own: str, stubbed: bool, known: set[str]) -> tuple[str, ...]:
    """What is wrong with a rule record as written, in the order of the report."""
    check, reason, out = record.get("check", ""), record.get("failReason", ""), []
    if stubbed:
        out.append("stubbed_check")
    if reason and not reason.startswith("fun"):
        out.append("wrapped_failReason")
    if own != record["id"]:
        out.append("normalized_rule_id")
    if head := re.match(r"fun\s+(\w+)\s*=>", check):
        named = re.findall(rf"\b{head[1]}\.([A-Za-z_]\w*)", check)
        out += [f"missing_fields:{f}" for f in dict.fromkeys(named) if f not in known]
        if re.search(rf"\b{head[1]}\.(?:{'|'.join(sorted(known)) or '(?!)'})\s+(?:{head[1]}\b|\d|\()", check):
            out.append("suspected_function_field_usage")
    return tuple(out)


def normal_id(rule_id: str) -> str:
    """An id without blanks at its ends and with single blanks inside."""
    return re.sub(r"\s+", " ", rule_id).strip()


def from_records(name: str, records: list[dict[str, str]], schema: Schema) -> Ruleset:
    """A ruleset of rule records; what can't be evaluated becomes a passing stub that says why.

    Repeated ids get ``_2``, ``_3`` and so on.
    """
    rules, seen, known = [], Counter(), {f.name for f in schema.fields}
    for r in records:
        base = normal_id(r["id"])
        seen[base] += 1
        own = base if seen[base] == 1 else f"{base}_{seen[base]}"
        check, status, fields, note = r.get("check", ""), "ok", frozenset(), ""
        reason = _literal(r.get("failReason")) or "(no detail)"
        if not check:
            sql, status, note = "true", "not_evaluable", "missing check"
        elif _CONSTANT.fullmatch(check):
            sql, status = "true", "stub"
        elif "sorry" in check:
            sql, status, note = "true", "not_evaluable", "sorry"
        else:
            try:
                sql, fields = compile_predicate(check, schema)
                status = "tautology" if _TAUTOLOGY.search(sql) and " AND " not in sql and " OR " not in sql else "ok"
            except Unsupported as e:
                sql, status, note, reason = "true", "not_evaluable", str(e), STUB_REASON.format(own)
        rules.append(Rule(own, _literal(r.get("title")) or "", _literal(r.get("reference")) or "", sql, reason, _literal(r.get("remedy")), status, fields, note, repairs(r, own, status in ("stub", "not_evaluable"), known)))
    return Ruleset(name, schema, tuple(rules))


def load(name: str, text: str, schema: Schema) -> Ruleset:
    """The ruleset of a rule file's text."""
    return from_records(name, read_records(text), schema)


_REGISTRY: dict[str, Callable[[], Ruleset]] = {}


def register(name: str, make: Callable[[], Ruleset]) -> None:
    """Makes a ruleset known by name; `make` runs when it is asked for, and a later one of the name takes its place."""
    _REGISTRY[name] = make


def registered() -> list[str]:
    return sorted(_REGISTRY)


def named(name: str) -> Ruleset:
    if name not in _REGISTRY:
        raise KeyError(f"no ruleset {name}; there are {', '.join(registered())}")
    return _REGISTRY[name]()


def lint(ruleset: Ruleset, metadata: DataFrame) -> DataFrame:
    """Findings about a ruleset's metadata: ordinal, id, finding."""
    known = [f.name for f in ruleset.schema.fields]
    found = F.array_compact(
        F.array(
            F.when(F.col("status") == "stub", F.lit("stubbed_check")),
            F.when(F.col("status") == "not_evaluable", F.concat(F.lit("not_evaluable: "), "note")),
            F.when(F.col("status") == "tautology", F.lit("tautology")),
            F.when(F.size(F.array_except("fields", F.lit(known))) > 0, F.concat(F.lit("unknown_fields: "), F.array_join(F.array_except("fields", F.lit(known)), ","))),
            F.when(F.col("id").rlike(r"_\d+$") & ~F.col("id").rlike("^[A-Za-z]+_"), F.lit("renamed_duplicate")),
            F.when(F.col("title") == "", F.lit("missing_fields:title")),
        )
    )
    return metadata.select("ordinal", "id", F.explode(F.array_distinct(F.concat(found, "fixes"))).alias("finding"))


# -- the core ruleset -----------------------------------------------------------


def _listed(sep: str, *parts: tuple[str, str]) -> Column:
    return F.concat_ws(sep, *[F.when(F.expr(when), F.lit(said)) for when, said in parts])


def years_below(column: str, least: int) -> Column:
    """``Year 1, Year 3``: the places of the entries under `least`."""
    marked = F.transform(column, lambda v, k: F.when(v < least, F.concat(F.lit("Year "), (k + 1).cast("string"))))
    return F.array_join(F.array_compact(marked), ", ")


def _years(column: str, least: int, few: str, below: str) -> Callable[[], Column]:
    return lambda: F.when(F.size(column) != 3, F.lit(few)).otherwise(F.concat(F.lit(below), years_below(column, least)))


def core(nta: int = 30_000_000, profit: int = 150_000_000, worth: int = 10_000_000) -> Ruleset:
    """The seven core listing rules; amounts are in the unit of the filings."""
    # Ids, titles, references, messages and remedies of the report.
    three = "size({0}) = 3 AND forall({0}, x -> x >= {1})"
    rules = (
        Rule(
            "SEBI ICDR 5(1)", "No debarments/defaulter/fraudulent/fugitive", "ICDR 5(1)",
            "NOT is_debarred AND NOT has_debarred_directors AND NOT is_fraudulent AND NOT is_fugitive",
            lambda: F.concat(F.lit("Disqualifying condition(s): "), _listed("; ", ("is_debarred", "Issuer/affiliates debarred"), ("has_debarred_directors", "Promoter/Director debarred"), ("is_fraudulent", "Wilful defaulter / fraudulent borrower"), ("is_fugitive", "Fugitive economic offender"))),
            "Resolve disqualifications (expiry of debarment, remedial orders) before filing.",
        ),
        Rule(
            "SEBI ICDR 5(2)", "No outstanding convertibles (with ESOP/SAR/MandConv carve-outs)", "ICDR 5(2)",
            "NOT has_outstanding_convertibles OR has_esop_exemption OR has_sar_exemption OR has_mandatory_convertibles",
            "Outstanding convertibles/rights exist without falling under ESOP/SAR pre-exercise or mandatory conversion carve-outs.",
            "Ensure ESOPs/SARs are exercised pre-RHP and mandatory convertibles are converted by filing.",
        ),
        Rule(
            "SEBI ICDR 6(1)(a)", "Net tangible assets ≥ ₹3 cr; monetary assets ≤ 50% (or committed use) / OSF carve-out", "ICDR 6(1)(a)",
            f"{three.format('net_tangible_assets', nta)} AND (monetary_asset_ratio <= 50 OR used_monetary_assets OR is_offer_for_sale_only)",
            lambda: F.concat_ws(
                " ",
                F.expr(f"CASE WHEN size(net_tangible_assets) <> 3 THEN 'Need 3 full-year NTA figures.' WHEN exists(net_tangible_assets, x -> x < {nta}) THEN 'Each year’s net tangible assets must be ≥ ₹3.0 crore.' END"),
                F.expr("CASE WHEN NOT is_offer_for_sale_only AND monetary_asset_ratio > 50 AND NOT used_monetary_assets THEN 'Monetary assets exceed 50% of NTA without evidence of committed/actual use.' END"),
            ),
            "Demonstrate firm commitments/use of monetary assets, or restructure to OSF-only; ensure each NTA year ≥ ₹3 cr.",
        ),
        Rule(
            "SEBI ICDR 6(1)(b)", "Operating profit: ≥ ₹15 cr in each of the last 3 years", "ICDR 6(1)(b)",
            three.format("operating_profits", profit),
            _years("operating_profits", profit, "Need 3 full-year operating profit figures.", "Operating profit below ₹15 cr in: "),
            "Demonstrate ≥ ₹15 cr operating profit in each of the last 3 full financial years (restated, consolidated).",
        ),
        Rule(
            "SEBI ICDR 6(1)(c)", "Net worth: ≥ ₹1 cr in each of the last 3 years", "ICDR 6(1)(c)",
            three.format("net_worths", worth),
            _years("net_worths", worth, "Need 3 full-year net worth figures.", "Net worth below ₹1 cr in: "),
            "Increase equity/retained earnings to meet ≥ ₹1 cr in each of the last 3 full years.",
        ),
        Rule(
            "SEBI ICDR 6(1)(d)", "If name changed within 1 year: ≥50% revenue from new-line activity", "ICDR 6(1)(d)",
            "NOT changed_name_recently OR percent_revenue_from_new_name >= 50",
            "Changed name within 1 year but <50% revenue from new-name activity in the preceding full year.",
            "Demonstrate ≥50% revenue from the activity indicated by the new name or defer filing.",
        ),
        Rule(
            "SEBI ICDR 7(1)", "Listing application, demat agreements, promoter holdings fully demat, no partly-paid", "ICDR 7(1); 7(2)",
            "applied_to_stock_exchange AND has_demat_agreement AND promoter_securities_demat AND no_partly_paid_shares AND general_corp_purpose_ratio <= 25",
            lambda: _listed(" ", ("NOT applied_to_stock_exchange", "No in-principle listing approval applied."), ("NOT has_demat_agreement", "No depository agreement executed."), ("NOT promoter_securities_demat", "Promoter securities not fully in demat."), ("NOT no_partly_paid_shares", "Outstanding partly-paid equity exists."), ("general_corp_purpose_ratio > 25", "General corporate purposes exceed 25% cap.")),
            "Obtain in-principle approvals, execute depository agreements, demat promoter holdings, forfeit/fully pay partly-paid shares, cap GCP ≤ 25%.",
        ),
    )
    names = {f.name for f in CORE.fields}
    return Ruleset("core", CORE, tuple(Rule(**{**r.__dict__, "fields": frozenset(w for w in re.findall(r"[a-z_]+", r.check) if w in names)}) for r in rules))


register("core", core)
