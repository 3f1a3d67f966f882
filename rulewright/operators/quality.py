"""Quality of rule sets: scores against gold, promotion, counters, judge status, the rule store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .validate import kept_first


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(100.0 * part / whole, 2)).otherwise(0.0)


def compared(gold: DataFrame, found: DataFrame, key: str = "rule_id", *also: str) -> DataFrame:
    """key, in_gold, in_found of the distinct ids of both; a null id of one side never equals one of the other."""
    a = gold.select(key, *also).distinct().withColumn("in_gold", F.lit(True))
    b = found.select(key, *also).distinct().withColumn("in_found", F.lit(True))
    both = a.join(b, [key, *also], "full_outer")
    return both.select(key, *also, F.coalesce("in_gold", F.lit(False)).alias("in_gold"), F.coalesce("in_found", F.lit(False)).alias("in_found"))


def counts() -> list[Column]:
    return [F.count_if(F.col("in_gold") & F.col("in_found")).alias("tp"), F.count_if(F.col("in_gold") & ~F.col("in_found")).alias("fn"), F.count_if(~F.col("in_gold") & F.col("in_found")).alias("fp")]


def scores(both: DataFrame) -> DataFrame:
    """Micro recall, precision and F1 in per cent over all ids."""
    n = both.agg(*counts())
    recall, precision = percent(F.col("tp"), F.col("tp") + F.col("fn")), percent(F.col("tp"), F.col("tp") + F.col("fp"))
    f1 = percent(2 * F.col("tp"), 2 * F.col("tp") + F.col("fn") + F.col("fp"))
    return n.select((F.col("tp") + F.col("fn")).alias("gold_total"), (F.col("tp") + F.col("fp")).alias("extracted_unique"), "tp", "fn", "fp", recall.alias("recall"), precision.alias("precision"), f1.alias("f1"))


def by_group(both: DataFrame, group: str, key: str = "rule_id") -> DataFrame:
    """Counts and sorted id lists (as text) of each group, which must be as small as a regulation's; lists are empty, not null."""
    listed = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col(key)))), ",")
    return both.groupBy(group).agg(F.count_if("in_gold").alias("gold"), *counts(), listed(F.col("in_gold") & ~F.col("in_found")).alias("missing"), listed(~F.col("in_gold") & F.col("in_found")).alias("extra"))


def differing(both: DataFrame, group: str, key: str = "rule_id") -> DataFrame:
    """group, `key` and side (missing or extra) of the ids that one side alone has: the lists of `by_group` as rows, for groups of any size."""
    side = F.when(F.col("in_gold") & ~F.col("in_found"), "missing").when(~F.col("in_gold") & F.col("in_found"), "extra")
    return both.select(group, key, side.alias("side")).where("side is not null")


def promotion(fields: DataFrame, generic: list[str], threshold: int = 2) -> DataFrame:
    """Of mentions (field, near_number, in_parens): occurrences, context, details, score and whether promoted.

    Two points for two occurrences, two for a number near one, three off for a
    generic name; `details` lists what gave points.
    """
    yes = lambda c: F.coalesce(F.some(c), F.lit(False))
    n = fields.groupBy("field").agg(F.count("*").alias("occurrences"), yes("near_number").alias("comparator_context"), F.every("in_parens").alias("only_in_parens"))
    marks = {"reusable_2plus_rules": (F.col("occurrences") >= 2, 2), "numeric_threshold_nearby": (F.col("comparator_context"), 2), "generic_token": (F.col("field").isin(generic), -3)}
    score = sum((F.when(when, points).otherwise(0) for when, points in marks.values()), F.lit(0))
    details = F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, (when, _) in marks.items()]))
    return n.withColumns({"details": details, "score": score}).withColumn("promoted", F.col("score") >= threshold)


def histogram(rows: DataFrame, lists: str, name: str) -> DataFrame:
    """How many rows have each entry of a list column; null and empty lists have none."""
    return rows.select(F.explode(F.array_distinct(lists)).alias(name)).groupBy(name).agg(F.count("*").alias("rules"))


def mapped(gold: DataFrame, found: DataFrame, key: str = "rule_id", fields: str = "maps_to") -> DataFrame:
    """key, in_gold and in_found of the ids that both have: whether a rule maps to fields there."""
    some = lambda rows, name: rows.select(key, (F.coalesce(F.size(fields), F.lit(0)) > 0).alias(name))
    return some(gold, "in_gold").join(some(found, "in_found"), key)


def counters(rows: DataFrame, by: str, reg: str, expected: list[str]) -> DataFrame:
    """Rules, regulations (count and list) and expected ones that are absent, for each status; a null regulation counts as none."""
    regs = F.array_sort(F.collect_set(reg))
    return rows.groupBy(by).agg(F.count("*").alias("rules"), F.count_distinct(reg).alias("regs"), F.array_join(regs, ",").alias("reg_list"), F.array_join(F.array_except(F.lit(sorted(expected)), regs), ",").alias("absent"))


#: Members of a judge's report.
CRITERIA = ("atomicity", "fidelity", "completeness", "maps_to_quality", "source_alignment")
JUDGE_REPORT = (
    "pdf string, pages array<int>, window_start int, validation map<string, struct<hard_fail_reasons: array<string>, soft_fail_reasons: array<string>>>, "
    "judge_report struct<judgments: array<struct<rule_id: string, scores: struct<" + ", ".join(f"{c}: double" for c in CRITERIA) + ">, overall: double, failure_modes: array<string>, feedback_for_refinement: string>>>"
)


def failures(reports: DataFrame, *keys: str) -> DataFrame:
    """keys, window_start, rule_id, kind (hard or soft) and reason: a row for each reason of a report's map; rules without reasons have none."""
    rules = reports.select(*keys, "window_start", F.explode("validation").alias("rule_id", "v"))

    def told(kind: str) -> Column:
        reasons = F.coalesce(F.col(f"v.{kind}_fail_reasons"), F.expr("cast(array() as array<string>)"))
        return F.transform(reasons, lambda r: F.struct(F.lit(kind).alias("kind"), r.alias("reason")))

    return rules.select(*keys, "window_start", "rule_id", F.inline(F.concat(told("hard"), told("soft"))))


def judgments(reports: DataFrame, *keys: str) -> DataFrame:
    """keys, window_start, rule_id, the five criteria, overall, failure_modes and feedback of each judgment."""
    rows = reports.select(*keys, "window_start", F.explode("judge_report.judgments").alias("j"))
    return rows.select(*keys, "window_start", "j.rule_id", "j.scores.*", "j.overall", "j.failure_modes", F.col("j.feedback_for_refinement").alias("feedback"))


def weighted(scores_: dict[str, float]) -> Column:
    """The weighted mean of criterion columns."""
    return sum((F.col(c) * w for c, w in scores_.items()), F.lit(0.0)) / sum(scores_.values())


def status(score: Column, hard: Column, fixed: Column, accept: float = 0.8, fix: float = 0.5) -> Column:
    """accepted, fixed or quarantined; a hard failure or a low score quarantines, a middling score or a repair is a fix."""
    return F.when(hard | (score < fix), F.lit("quarantined")).when(fixed | (score < accept), F.lit("fixed")).otherwise(F.lit("accepted"))


def last_iteration(reports: DataFrame, key: list[str], iteration: str) -> DataFrame:
    """The row of each key with the highest iteration; of equal ones any, and of rows whose iteration is null, null columns."""
    rest = [c for c in reports.columns if c not in key]
    return reports.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(iteration)).alias("r")).select(*key, "r.*")


def best_record(confidence: str, text: str, *last: str) -> Column:
    """What orders the records of a signature, best first: the highest confidence, then the shortest text, then `last`."""
    return F.struct((-F.col(confidence)).alias("a"), F.length(text).alias("b"), *last)


def new_records(records: DataFrame, store: DataFrame | None, key: str = "rule_id", *order: Column | str) -> DataFrame:
    """Records whose key isn't stored, the first of each key (in `order`, or any one without), without members named ``_…``."""
    out = records if store is None else records.join(store.select(key).distinct(), key, "left_anti")
    out = kept_first(out, key, *order) if order else out.dropDuplicates([key])
    return out.select(*[c for c in out.columns if not c.startswith("_")])


#: Characters of a normal form that make the signature of a text, and the fewest that a text needs to have one.
SIGNATURE_CHARS, LEAST_CHARS = 160, 20


def signature(text: Column, chars: int = SIGNATURE_CHARS, least: int = LEAST_CHARS) -> Column:
    """What texts that say the same have in common: a digest of the first `chars` characters of the normal form, which is lower case with one blank for all between letters and digits; null for a null text and a normal form under `least` characters."""
    normal = F.transform(F.array(F.trim(F.regexp_replace(T.lower(text), r"[^\p{L}\p{N}]+", " "))), lambda t: F.when(F.length(t) >= least, F.md5(F.substring(t, 1, chars))))
    return normal[0]


def keep_best(records: DataFrame, *order: Column | str, text: str = "text", key: str = "rule_id", chars: int = SIGNATURE_CHARS, least: int = LEAST_CHARS) -> DataFrame:
    """One record of each signature, the first in `order`, with `copies`, how many there were.

    Texts too short for a signature, and null ones, are told apart by `key`
    instead, so a short text never swallows another rule.  `order` should be
    total: of records equal in it any one stays.  One aggregate with partial
    results, so a signature that a third of all records share is no burden.
    """
    known = signature(F.col(text), chars, least)
    group = F.struct(F.coalesce(known, F.lit("")).alias("signature"), F.when(known.isNull(), F.col(key)).alias("key"))
    whole = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    best = records.groupBy(group.alias("_group")).agg(F.min_by(whole, F.struct(*order)).alias("_best"), F.count("*").alias("copies"))
    return best.select("_best.*", "copies")
