"""Findings about rule records that are rows of a table.

The rules of one ruleset are few, and the compiler looks at them one by one
(`plans.rules`); records of many extraction runs are a table, and what can be
said of a record by its text is said here by column expressions: stubs,
constant and missing checks, unknown fields, fields used as functions, bare
reasons, ids that are not in normal form or that an earlier record has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HEAD = r"^fun\s+(\w+)\s*=>"


def normal_id(rule_id: Column) -> Column:
    """An id without blanks at its ends and with single blanks inside."""
    return F.trim(F.regexp_replace(rule_id, r"\s+", " "))


def numbered_ids(records: DataFrame, order: str, rule_id: str = "rule_id", name: str = "own_id") -> DataFrame:
    """`records` with `name`: the id in normal form, and for the second record of an id in `order` and those after it the number with it (``_2``, ``_3``).

    The places of an id's records come from a window over that id, which Spark
    sorts and spills; only id and order go into it beside the record.
    """
    base = normal_id(F.col(rule_id))
    k = F.row_number().over(Window.partitionBy(base).orderBy(order))
    return records.withColumn(name, F.when(k == 1, base).otherwise(F.concat(base, F.lit("_"), k.cast("string"))))


def fields_read(check: Column) -> Column:
    """The fields of the filing that a check names, each once, in order; empty for what is no function."""
    head = F.regexp_extract(check, _HEAD, 1)
    words = F.regexp_extract_all(check, F.lit(r"([A-Za-z_][\w']*)\.([A-Za-z_]\w*)"), 0)
    own = F.filter(words, lambda w: F.substring_index(w, ".", 1) == head)
    return F.when((head == "") | check.isNull(), F.expr("cast(array() as array<string>)")).otherwise(F.array_distinct(F.transform(own, lambda w: F.substring_index(w, ".", -1))))


def kind(check: Column, known: list[str]) -> Column:
    """missing check, stub, sorry, tautology, unknown_field or ok, as far as the text of a check shows."""
    unknown = F.array_except(fields_read(check), F.lit(known).cast("array<string>"))
    return (
        F.when(F.coalesce(F.trim(check), F.lit("")) == "", "missing_check")
        .when(check.rlike(r"^fun\s+\w+\s*=>\s*(?:True|true)\s*$"), "stub")
        .when(check.rlike(r"\bsorry\b"), "sorry")
        .when(F.size(unknown) > 0, "unknown_field")
        .when(check.rlike(r"^fun\s+(\w+)\s*=>\s*\w+\.\w+\s*(?:>=|≥)\s*0\s*$"), "tautology")
        .otherwise("ok")
    )


def findings(records: DataFrame, known: list[str], order: str, rule_id: str = "rule_id") -> DataFrame:
    """`order`, own_id and finding: a row for each finding about records (`rule_id`, title, check, fail_reason) of a table.

    Null and empty members are missing ones; records without a finding have no row, an empty table none.
    """
    check = F.coalesce("check", F.lit(""))
    rows = numbered_ids(records, order, rule_id).withColumn("_kind", kind(F.col("check"), known))
    unknown = F.array_except(fields_read(check), F.lit(known).cast("array<string>"))
    head = F.regexp_extract(check, _HEAD, 1)
    applied = F.exists(F.regexp_extract_all(check, F.lit(r"(\w+)\.(\w+)\s+(\w+|\()"), 0), lambda w: _applied(w, head, known))
    said = F.array_compact(
        F.array(
            F.when(F.col("_kind").isin("missing_check", "sorry", "unknown_field"), F.concat(F.lit("not_evaluable:"), "_kind")),
            F.when(F.col("_kind").isin("missing_check", "stub", "sorry", "unknown_field"), F.lit("stubbed_check")),
            F.when(F.col("_kind") == "tautology", F.lit("tautology")),
            F.when(F.coalesce("title", F.lit("")) == "", F.lit("missing_fields:title")),
            F.when((F.coalesce("fail_reason", F.lit("")) != "") & ~F.col("fail_reason").startswith("fun"), F.lit("wrapped_failReason")),
            F.when(~F.col("own_id").eqNullSafe(F.col(rule_id)), F.lit("normalized_rule_id")),
            F.when(F.coalesce(applied, F.lit(False)), F.lit("suspected_function_field_usage")),
        )
    )
    named = F.transform(unknown, lambda f: F.concat(F.lit("missing_fields:"), f))
    return rows.select(order, "own_id", F.explode(F.concat(said, named)).alias("finding"))


def _applied(words: Column, head: Column, known: list[str]) -> Column:
    """Whether ``i.field x`` applies a known field to the filing, a number or a bracket."""
    path, after = F.regexp_extract(words, r"^(\w+\.\w+)", 1), F.regexp_extract(words, r"\s(\w+|\()$", 1)
    return (F.substring_index(path, ".", 1) == head) & F.substring_index(path, ".", -1).isin(known) & ((after == head) | after.rlike(r"^(?:\d|\()"))


def mapping_report(rules: DataFrame, maps_to: str = "maps_to", rule_id: str = "rule_id") -> tuple[DataFrame, DataFrame]:
    """(counts, unmapped): one row with rules, mapped, unmapped and fields that are parsed as names; and rule_id of every rule that maps to nothing, as rows.

    `maps_to` is an array of structs with a `field`; null and empty arrays map to nothing.
    """
    some = F.coalesce(F.size(maps_to), F.lit(0)) > 0
    good = F.aggregate(maps_to, F.lit(0), lambda n, m: n + F.coalesce(m["field"].rlike("^[a-z][a-z0-9_]*$"), F.lit(False)).cast("int"))
    counts = rules.agg(F.count("*").alias("rules"), F.count_if(some).alias("mapped"), F.count_if(~some).alias("unmapped"), F.coalesce(F.sum(good), F.lit(0)).alias("fields"))
    return counts, rules.where(~some).select(rule_id)
