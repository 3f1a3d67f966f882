"""Evaluation of rulesets over filings: long results, reports, gates and rendered text.

Rules become elements of one array per filing, so evaluation is a projection:
no join and no shuffle, however many rules or filings there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.rules import Rule, Ruleset

#: Rules in one array expression; more are concatenated, which keeps generated methods small.
CHUNK = 40


def result(rule: Rule, ordinal: int) -> Column:
    """struct(ordinal, id, title, reference, passed, reason) of one rule; the reason is null where it passes."""
    passed = F.expr(rule.check) if rule.status != "stub" else F.lit(True)
    reason = rule.reason_column()
    if rule.remedy:
        reason = F.concat(reason, F.lit("\nSuggested remedy: " + rule.remedy))
    return F.struct(F.lit(ordinal).alias("ordinal"), F.lit(rule.id).alias("id"), F.lit(rule.title).alias("title"), F.lit(rule.reference).alias("reference"), passed.alias("passed"), F.when(~passed, reason).alias("reason"))


def results(ruleset: Ruleset) -> Column:
    """The array of all results of a filing, in rule order."""
    parts = [F.array(*[result(r, k) for k, r in enumerate(ruleset.rules)][a : a + CHUNK]) for a in range(0, len(ruleset.rules), CHUNK)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def evaluate(filings: DataFrame, ruleset: Ruleset, key: str = "issuer_id") -> DataFrame:
    """One row per filing and rule: key, ordinal, id, title, reference, passed, reason."""
    return filings.select(key, F.inline(results(ruleset)))


def reports(filings: DataFrame, ruleset: Ruleset, key: str = "issuer_id") -> DataFrame:
    """key and report: struct(eligible, failed, passed), built within the row; rule order is kept."""
    whole = filings.select(key, results(ruleset).alias("results")) if ruleset.rules else filings.select(key, F.lit(None).cast("array<struct<ordinal:int,id:string,title:string,reference:string,passed:boolean,reason:string>>").alias("results"))
    some = F.coalesce(F.col("results"), F.expr("cast(array() as array<struct<ordinal:int,id:string,title:string,reference:string,passed:boolean,reason:string>>)"))
    # Members in alphabetical order, as the report is written.
    bare = lambda r: F.struct(r["id"].alias("id"), r["passed"].alias("passed"), r["reason"].alias("reason"), r["reference"].alias("reference"), r["title"].alias("title"))
    failed, passed = F.filter(some, lambda r: ~r["passed"]), F.filter(some, lambda r: r["passed"])
    return whole.select(key, F.struct(F.forall(some, lambda r: r["passed"]).alias("eligible"), F.transform(failed, bare).alias("failed"), F.transform(passed, bare).alias("passed")).alias("report"))


def report_json(report: Column) -> Column:
    """Compact JSON; a reason that is null is left out."""
    return F.to_json(report, {"ignoreNullFields": "true"})


def regroup(long: DataFrame, key: str = "issuer_id") -> DataFrame:
    """key, eligible, n_failed and n_passed of long results, for results that come from elsewhere; a filing without results isn't there."""
    return long.groupBy(key).agg(F.coalesce(F.every("passed"), F.lit(True)).alias("eligible"), F.count_if(~F.col("passed")).alias("n_failed"), F.count_if("passed").alias("n_passed"))


# Words and marks of the rendered reports.
STYLES = {"marks": ("✅", "❌", "—"), "ascii": ("[PASS]", "[FAIL]", "-")}


def render(report: Column, style: str = "marks") -> Column:
    """A report as text: a headline, the failed rules with reason and reference, the passed rules."""
    yes, no, dash = STYLES[style]
    line = lambda mark, r: F.concat(F.lit(f"{mark} "), r["id"], F.lit(f" {dash} "), r["title"])
    full = lambda r: F.concat(line(no, r), F.lit("\nReason: "), F.coalesce(r["reason"], F.lit("(no detail)")), F.lit("\nRef: "), r["reference"])
    listed = lambda rows, show, sep: F.when(F.size(rows) == 0, F.lit("(none)\n")).otherwise(F.array_join(F.transform(rows, show), sep))
    head = F.when(F.size(report["failed"]) == 0, F.lit(f"{yes} Eligible: All applicable rules satisfied\n")).otherwise(F.lit(f"{no} Not Eligible: some rules failed\n"))
    return F.concat(head, F.lit(f"\n{dash} Failed {dash}\n"), listed(report["failed"], full, "\n\n"), F.lit(f"\n\n{dash} Passed {dash}\n"), listed(report["passed"], lambda r: line(yes, r), "\n"))


def summarise(report: Column, reasons: bool = True) -> Column:
    """Short text: failed rules first, one line each; `reasons` false leaves the reasons blank."""
    failed = F.transform(report["failed"], lambda r: F.concat(F.lit("FAIL "), r["id"], F.lit(": "), F.coalesce(r["reason"], F.lit("")) if reasons else F.lit("")))
    return F.concat_ws("\n", failed, F.transform(report["passed"], lambda r: F.concat(F.lit("PASS "), r["id"])))


def gate(*members: Column) -> Column:
    """A conjunction in which a member that can't be evaluated (null) leaves the gate unknown unless another fails."""
    out = members[0]
    for m in members[1:]:
        out = out & m
    return out


def roll_up(long: DataFrame, levels: list[str], passed: str = "passed") -> DataFrame:
    """Gates of a hierarchy: for each prefix of `levels`, whether all below pass (those that are unknown aside), how many there are, and how many are unknown."""
    return long.rollup(*levels).agg(F.coalesce(F.every(passed), F.lit(True)).alias("passed"), F.count("*").alias("members"), F.count_if(F.col(passed).isNull()).alias("unknown"), F.grouping_id().alias("level"))
