"""Queries about evidence, field schemas, quality scores and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, grids, lint, quality
from . import base
from .base import table

query = base.Registry()
QUERIES, ORACLES = query.queries, query.oracles

#: Fields that a rule (here a document) maps to: its longer words in lower case.
_WORDS_SQL = "w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS field FROM documents)"


def words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), 0)).alias("field"))


@query(
    "q12_field_rule_inverted_index",
    f"""WITH {_WORDS_SQL}, f AS (SELECT field, 'R_' || (doc_id % 50) AS rule_id, doc_id % 50 AS reg FROM w), g AS (SELECT field, count(DISTINCT rule_id) AS n, array_to_string(list_sort(list_distinct(list(rule_id))), ',') AS rule_ids, min(reg) AS reg FROM f GROUP BY field)
    SELECT field, n, md5(rule_ids) AS rule_ids, CASE WHEN n > 1 THEN field || '_reg' || reg ELSE field END AS first_name, CASE WHEN n > 1 THEN 'renamed_colliding_field' END AS note FROM g""",
)
def q12(spark, d):
    fields = words(spark, d).select("field", F.concat(F.lit("R_"), F.col("doc_id") % 50).alias("rule_id"), (F.col("doc_id") % 50).alias("reg"))
    return evidence.field_index(fields).withColumn("rule_ids", F.md5("rule_ids"))


@query(
    "q12b_fields_by_rule",
    f"""WITH {_WORDS_SQL}, p AS (SELECT DISTINCT field, 'R_' || (doc_id % 50) AS rule_id, doc_id % 50 AS reg FROM w), n AS (SELECT *, count(*) OVER (PARTITION BY field) AS n FROM p)
    SELECT field, rule_id, CASE WHEN n > 1 THEN field || '_reg' || reg ELSE field END AS own_name FROM n""",
)
def q12b(spark, d):
    return evidence.field_rules(words(spark, d).select("field", F.concat(F.lit("R_"), F.col("doc_id") % 50).alias("rule_id"), (F.col("doc_id") % 50).alias("reg")))


_RAW = """CASE doc_id % 7 WHEN 0 THEN 'yes' WHEN 1 THEN '1,44,445.3, 22,10,000 and 5' WHEN 2 THEN concat(CAST(n_chars AS VARCHAR(9)), ' months') WHEN 3 THEN 'not mentioned' WHEN 4 THEN CAST(NULL AS VARCHAR(9)) WHEN 5 THEN 'as stated' ELSE CAST(doc_id AS VARCHAR(9)) END"""


@query(
    "q13_evidence_pick_and_metrics",
    f"""WITH e AS (SELECT d.doc_id, source AS field, {_RAW.replace("doc_id", "d.doc_id")} AS raw, quality IS NOT NULL AS tabled, CASE WHEN d.doc_id % 3 = 0 THEN substr(text, 1, 10) ELSE '' END AS quote FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
    c AS (SELECT *, doc_id % 7 IN (0, 1, 2, 5, 6) AS there, CASE WHEN tabled THEN 0.9 WHEN quote <> '' THEN 0.4 ELSE 0.2 END AS confidence FROM e),
    p AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY CASE WHEN tabled THEN 0 ELSE 1 END, confidence DESC, doc_id) AS k FROM c),
    m AS (SELECT field, count(*) AS n, round(avg(CASE WHEN doc_id % 7 = 0 THEN 1.0 ELSE 0 END), 6) AS bool_rate, round(avg(CASE WHEN doc_id % 7 IN (1, 2, 6) THEN 1.0 ELSE 0 END), 6) AS nat_rate, round(avg(CASE WHEN doc_id % 7 = 1 THEN 1.0 ELSE 0 END), 6) AS list_rate, round(avg(CASE WHEN there THEN 0.0 ELSE 1 END), 6) AS missing_rate FROM c GROUP BY field)
    SELECT field, n, bool_rate, nat_rate, list_rate, missing_rate, 'Option ' || CASE WHEN list_rate >= 0.5 THEN 'List Nat' WHEN nat_rate >= 0.5 THEN 'Nat' WHEN bool_rate >= 0.5 THEN 'Bool' ELSE 'String' END AS final_type, doc_id AS chosen, raw AS chosen_raw, CAST(confidence AS DOUBLE) AS confidence,
    CASE doc_id % 7 WHEN 1 THEN 144445 WHEN 2 THEN CAST(regexp_extract(raw, '[0-9]+') AS BIGINT) WHEN 6 THEN doc_id END AS nat, CASE WHEN doc_id % 7 = 1 THEN '144445|2210000|5' END AS nats FROM m JOIN p USING (field) WHERE k = 1""",
)
def q13(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id", F.lit(True).alias("labelled"))
    rows = docs.join(labels, "doc_id", "left").select(
        F.col("source").alias("field"),
        F.col("doc_id").alias("ordinal"),
        F.expr(_RAW).alias("raw"),
        F.coalesce("labelled", F.lit(False)).alias("tabled"),
        F.when(F.col("doc_id") % 3 == 0, F.substring("text", 1, 10)).otherwise("").alias("quote"),
    )
    rows = rows.select("field", "ordinal", "raw", F.when(F.col("tabled"), 0).otherwise(1).alias("source_priority"), evidence.confidence(F.col("tabled"), F.col("quote")).alias("confidence"), evidence.candidates(F.col("raw")).alias("candidate"))
    rates = evidence.parse_rates(rows)
    rates = rates.withColumn("final_type", evidence.final_type(*[F.col(c) for c in ("bool_rate", "nat_rate", "list_rate", "missing_rate")]))
    pick = evidence.chosen(rows).select("field", F.col("ordinal").alias("chosen"), F.col("raw").alias("chosen_raw"), "confidence", "candidate.nat", F.array_join("candidate.nats", "|").alias("nats"))
    return rates.join(pick, "field")


@query(
    "q13b_evidence_rules_schema",
    f"""WITH {_WORDS_SQL}, f AS (SELECT *, 'R_' || (doc_id % 50) AS rule_id FROM w),
    e AS (SELECT rule_id, field, count(*) AS pieces, min(doc_id) AS best_doc FROM f WHERE doc_id % 3 <> 0 GROUP BY ALL),
    m AS (SELECT DISTINCT rule_id, field, CASE length(field) % 3 WHEN 0 THEN 'Bool' WHEN 1 THEN 'Nat' ELSE 'List Nat' END AS type_hint FROM f WHERE doc_id % 2 = 0),
    s AS (SELECT DISTINCT rule_id, field, CASE WHEN length(field) % 7 = 0 THEN 'String' ELSE CASE length(field) % 3 WHEN 0 THEN 'Bool' WHEN 1 THEN 'Nat' ELSE 'List Nat' END END AS type FROM f WHERE doc_id % 5 <> 1)
    SELECT rule_id, field, coalesce(pieces, 0) AS pieces, best_doc, type_hint, type, CASE WHEN type_hint IS NULL THEN 'unmapped' WHEN type IS NULL THEN 'not_in_schema' WHEN pieces IS NULL THEN 'no_evidence' WHEN type_hint <> type THEN 'type_differs' ELSE 'complete' END AS status
    FROM e FULL JOIN m USING (rule_id, field) FULL JOIN s USING (rule_id, field)""",
)
def q13b(spark, d):
    found = words(spark, d).select(F.concat(F.lit("R_"), (F.col("doc_id") % 50).cast("string")).alias("rule_id"), "field", "doc_id")
    kind = F.expr("CASE length(field) % 3 WHEN 0 THEN 'Bool' WHEN 1 THEN 'Nat' ELSE 'List Nat' END")
    pieces = evidence.best_evidence(found.where("doc_id % 3 <> 0"), "doc_id")
    mappings = found.where("doc_id % 2 = 0").select("rule_id", "field", kind.alias("type_hint")).distinct()
    # Fields with the rules that they come from, a few at a time.
    fields = found.where("doc_id % 5 <> 1").select("field", F.when(F.length("field") % 7 == 0, "String").otherwise(kind).alias("type"), F.array("rule_id").alias("from_rules"))
    out = evidence.reconciled(pieces, mappings, evidence.schema_sides(fields))
    return out.select("rule_id", "field", "pieces", F.col("best.doc_id").alias("best_doc"), "type_hint", "type", "status")


@query(
    "q14_schema_coverage",
    """WITH f AS (SELECT p_partkey AS field, p_size % 5 = 0 AS inactive FROM part), v AS (SELECT l_partkey AS field, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT field, value, CASE WHEN inactive THEN 'inactive' WHEN value IS NOT NULL THEN 'present' ELSE 'missing' END AS status FROM f LEFT JOIN v USING (field)""",
)
def q14(spark, d):
    fields = table(spark, d, "part").select(F.col("p_partkey").alias("field"), (F.col("p_size") % 5 == 0).alias("inactive"))
    found = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("field")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("value"))
    return evidence.coverage(fields, found, F.col("inactive")).select("field", "value", "status")


@query(
    "q15_table_parse_latest3",
    """WITH y AS (SELECT o_orderpriority AS label, year(o_orderdate) AS yr, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS v, avg(o_custkey % 3) * 10 AS pct FROM orders GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY yr DESC) AS n FROM y)
    SELECT label, CASE WHEN label LIKE '1%' THEN 'million' WHEN label LIKE '2%' THEN 'crore' WHEN label LIKE '3%' THEN '%' END AS unit, string_agg(CAST(v AS VARCHAR), '|' ORDER BY yr DESC) FILTER (n <= 3) AS newest, count(*) AS years,
    CASE WHEN label LIKE '3%' THEN 12.5 END AS share FROM k GROUP BY label""",
)
def q15(spark, d):
    yearly = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("label"), F.year("o_orderdate").alias("yr")).agg(F.sum(F.floor("o_totalprice").cast("bigint")).alias("v"))
    # One extracted table: a row per label, a column per year, amounts written with digit groups and decimals; labels name their unit.
    said = F.concat("label", F.expr("CASE substring(label, 1, 1) WHEN '1' THEN ' (Rs. in Million)' WHEN '2' THEN ' in crores' WHEN '3' THEN ' 12.5 %' ELSE '' END"))
    row = F.struct("label", F.array(F.concat(F.format_number("v", 0), F.lit(".50"))).alias("values"), evidence.unit(said).alias("unit"))
    tables = yearly.select("yr", evidence.percent_value(said).alias("share"), F.array(row).alias("rows"))
    cells = evidence.table_cells(tables)
    listed = evidence.newest(cells, ["label", "unit", "share"], "yr")
    years = cells.groupBy("label").agg(F.count("*").alias("years"))
    return listed.join(years, "label").select("label", "unit", F.array_join(F.transform("values", lambda v: v.cast("string")), "|").alias("newest"), "years", "share")


#: Headings that name the fiscal year yr, by the first character of a label.
_HEADINGS = "CASE substring(label, 1, 1) WHEN '1' THEN concat('March 31, ', yr) WHEN '2' THEN concat('FY ', yr - 1, '-', lpad(cast(yr % 100 as string), 2, '0')) WHEN '3' THEN concat('Fiscal ', yr) WHEN '4' THEN concat(yr - 1, '-', yr) ELSE concat('30 September ', yr - 1) END"


@query(
    "q15b_tables_from_headers",
    """WITH y AS (SELECT o_orderpriority AS label, year(o_orderdate) AS yr, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS v, count(*) AS n, count(*) FILTER (o_custkey % 4 = 0) AS f FROM orders GROUP BY ALL),
    r AS (SELECT label, yr, 'Total' || CASE WHEN label LIKE '2%' THEN ' (Rs. in million)' ELSE '' END AS line, CASE WHEN label LIKE '2%' THEN 'million' WHEN label LIKE '1%' THEN 'lakh' WHEN label LIKE '3%' THEN 'crore' END AS unit, v FROM y
      UNION ALL SELECT label, yr, 'Orders', CASE WHEN label LIKE '1%' THEN 'lakh' WHEN label LIKE '3%' OR label LIKE '4%' THEN 'crore' END, n FROM y
      UNION ALL SELECT label, yr, 'Share', '%', f * 100 // n FROM y), k AS (SELECT *, row_number() OVER (PARTITION BY label, line ORDER BY yr DESC) AS k FROM r)
    SELECT label, line, unit, string_agg(CAST(v AS VARCHAR), '|' ORDER BY yr DESC) AS newest, CAST(max(yr) AS INTEGER) AS latest FROM k WHERE k <= 3 GROUP BY ALL""",
)
def q15b(spark, d):
    yearly = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("label"), F.year("o_orderdate").alias("yr")).agg(F.sum(F.floor("o_totalprice").cast("bigint")).alias("v"), F.count("*").alias("n"), F.count_if(F.col("o_custkey") % 4 == 0).alias("f"))
    # One table for each label, a few years each; years stand above the last of three columns for some labels and above their own for others.
    years = yearly.withColumn("head", F.expr(_HEADINGS)).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("yr", "head", "v", "n", "f"))).alias("y"))
    wide = F.col("label").substr(1, 1).isin("1", "4")
    spread = lambda cell, last: F.flatten(F.transform("y", lambda y: F.when(wide, F.array(F.lit(""), F.lit("") if last else cell(y), cell(y) if last else F.lit(""))).otherwise(F.array(cell(y)))))
    row = lambda label, cells: F.concat(F.array(label), cells)
    blank = lambda text: F.concat(F.array(text), F.transform("y", lambda y: F.lit("")))
    total = F.concat(F.lit("Total"), F.when(F.col("label").startswith("2"), " (Rs. in million)").otherwise(""))
    grid = F.array(
        blank(F.expr("CASE substring(label, 1, 1) WHEN '1' THEN 'Restated, in lakhs' WHEN '3' THEN '(Rs. in Crore)' ELSE 'As restated' END")),
        row(F.lit(""), spread(lambda y: y["head"], True)),
        row(total, spread(lambda y: F.concat(F.format_number(y["v"], 0), F.lit(".5")), False)),
        blank(F.when(F.col("label").startswith("4"), "Numbers in crores").otherwise("Numbers")),
        row(F.lit("Orders"), spread(lambda y: y["n"].cast("string"), False)),
        row(F.lit("Share"), spread(lambda y: F.concat(F.floor(y["f"] * 100 / y["n"]).cast("string"), F.lit(".25%")), False)),
    )
    cells = grids.rows_of(years.select("label", grid.alias("grid")).withColumnRenamed("label", "of")).withColumnsRenamed({"label": "line", "of": "label"})
    latest = cells.groupBy("label", "line").agg(F.max("year").alias("latest"))
    listed = evidence.newest(cells, ["label", "line", "unit"], "year")
    return listed.join(latest, ["label", "line"]).select("label", "line", "unit", F.array_join(F.transform("values", lambda v: v.cast("string")), "|").alias("newest"), "latest")


_GENERIC = ["tionth", "theand", "pouran"]


@query(
    "q17_promotion_scoring",
    rf"""WITH p AS (SELECT doc_id, false AS inside, regexp_replace(lower(text), '\([^()]*\)', ' ', 'g') AS part FROM documents UNION ALL SELECT doc_id, true, array_to_string(regexp_extract_all(lower(text), '\(([^()]*)\)', 1), ' ') FROM documents),
    t AS (SELECT inside, list_filter(string_split_regex(part, '\s+'), lambda x: x <> '') AS tokens FROM p), k AS (SELECT inside, tokens, unnest(range(1, len(tokens) + 1)) AS k FROM t),
    m AS (SELECT inside, regexp_extract(tokens[k], '[a-z]{{6,}}') AS field, len(list_filter(tokens[greatest(k - 3, 1) : k + 3], lambda x: regexp_matches(x, '[0-9]'))) > 0 AS near_number FROM k),
    g AS (SELECT field, count(*) AS occurrences, bool_or(near_number) AS comparator_context, bool_and(inside) AS only_in_parens FROM m WHERE field <> '' GROUP BY field),
    s AS (SELECT *, field IN ({", ".join(f"'{g}'" for g in _GENERIC)}) AS generic FROM g), n AS (SELECT *, 2 * CAST(occurrences >= 2 AS INTEGER) + 2 * CAST(comparator_context AS INTEGER) - 3 * CAST(generic AS INTEGER) AS score FROM s)
    SELECT field, occurrences, comparator_context, only_in_parens, concat_ws(',', CASE WHEN occurrences >= 2 THEN 'reusable_2plus_rules' END, CASE WHEN comparator_context THEN 'numeric_threshold_nearby' END, CASE WHEN generic THEN 'generic_token' END) AS details, score, score >= 2 AS promoted FROM n""",
)
def q17(spark, d):
    found = table(spark, d, "documents").select(F.inline(evidence.mentions(F.lower("text"), "[a-z]{6,}")))
    return quality.promotion(found, _GENERIC).withColumn("details", F.array_join("details", ","))


#: Fields that a document's rule maps to: its words of ten letters and more, and words with capitals, which are no field names.
_MAPS_SQL = "m AS (SELECT doc_id, list_concat(list_distinct(regexp_extract_all(lower(text), '[a-z]{12,}')), CASE WHEN doc_id % 50 = 0 THEN ['Not_A_Field'] ELSE [] END) AS fields FROM documents)"


def with_fields(spark, d):
    words_ = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{12,}"), 0))
    named = F.concat(words_, F.when(F.col("doc_id") % 50 == 0, F.array(F.lit("Not_A_Field"))).otherwise(F.expr("cast(array() as array<string>)")))
    return table(spark, d, "documents").select(F.concat(F.lit("R_"), "doc_id").alias("rule_id"), F.transform(named, lambda f: F.struct(f.alias("field"))).alias("maps_to"))


@query("q44b_mapping_report", f"WITH {_MAPS_SQL} SELECT count(*) AS rules, count(*) FILTER (len(fields) > 0) AS mapped, count(*) FILTER (len(fields) = 0) AS unmapped, CAST(coalesce(sum(len(list_filter(fields, lambda f: f <> 'Not_A_Field'))), 0) AS BIGINT) AS fields FROM m")
def q44b(spark, d):
    return lint.mapping_report(with_fields(spark, d))[0]


@query("q44c_unmapped_rules", f"WITH {_MAPS_SQL} SELECT 'R_' || doc_id AS rule_id FROM m WHERE len(fields) = 0")
def q44c(spark, d):
    return lint.mapping_report(with_fields(spark, d))[1]


def gold(spark, d):
    """Gold and extracted rule ids: two overlapping sets of parts, by brand."""
    rows = table(spark, d, "part").select(F.concat(F.lit("R_"), "p_partkey").alias("rule_id"), F.col("p_brand").alias("reg"), "p_partkey", "p_size", "p_type")
    return rows.where("p_partkey % 3 <> 0"), rows.where("p_partkey % 4 <> 1 and p_size > 5")


_BOTH_SQL = """g AS (SELECT 'R_' || p_partkey AS rule_id, p_brand AS reg FROM part WHERE p_partkey % 3 <> 0), e AS (SELECT 'R_' || p_partkey AS rule_id, p_brand AS reg FROM part WHERE p_partkey % 4 <> 1 AND p_size > 5),
b AS (SELECT coalesce(g.rule_id, e.rule_id) AS rule_id, coalesce(g.reg, e.reg) AS reg, g.rule_id IS NOT NULL AS in_gold, e.rule_id IS NOT NULL AS in_found FROM g FULL JOIN e USING (rule_id, reg))"""
_N_SQL = "count(*) FILTER (in_gold AND in_found) AS tp, count(*) FILTER (in_gold AND NOT in_found) AS fn, count(*) FILTER (NOT in_gold AND in_found) AS fp"


@query(
    "q40_gold_scoring_micro",
    f"WITH {_BOTH_SQL}, n AS (SELECT {_N_SQL} FROM b) SELECT tp + fn AS gold_total, tp + fp AS extracted_unique, tp, fn, fp, round(100.0 * tp / (tp + fn), 2) AS recall, round(100.0 * tp / (tp + fp), 2) AS precision, round(100.0 * 2 * tp / (2 * tp + fn + fp), 2) AS f1 FROM n",
)
def q40(spark, d):
    return quality.scores(quality.compared(*gold(spark, d)))


@query(
    "q41_gold_scoring_per_group_delta",
    f"""WITH {_BOTH_SQL}, n AS (SELECT reg, count(*) FILTER (in_gold) AS gold, {_N_SQL}, coalesce(string_agg(rule_id, ',' ORDER BY rule_id) FILTER (in_gold AND NOT in_found), '') AS missing, coalesce(string_agg(rule_id, ',' ORDER BY rule_id) FILTER (NOT in_gold AND in_found), '') AS extra FROM b GROUP BY reg),
    base AS (SELECT reg, count(*) FILTER (in_gold AND in_found AND right(rule_id, 1) <> '4') AS base_tp FROM b GROUP BY reg) SELECT n.*, tp - base_tp AS delta_tp FROM n LEFT JOIN base USING (reg)""",
)
def q41(spark, d):
    want, have = gold(spark, d)
    groups = quality.by_group(quality.compared(want, have, "rule_id", "reg"), "reg")
    before = quality.by_group(quality.compared(want, have.where("p_partkey % 10 <> 4"), "rule_id", "reg"), "reg").select("reg", F.col("tp").alias("base_tp"))
    return groups.join(before, "reg", "left").select("*", (F.col("tp") - F.col("base_tp")).alias("delta_tp")).drop("base_tp")


@query("q41b_missing_and_extra", f"WITH {_BOTH_SQL} SELECT reg, rule_id, CASE WHEN in_gold THEN 'missing' ELSE 'extra' END AS side FROM b WHERE in_gold <> in_found")
def q41b(spark, d):
    return quality.differing(quality.compared(*gold(spark, d), "rule_id", "reg"), "reg")


@query(
    "q42_set_equality_coverage",
    """WITH o AS (SELECT DISTINCT o_orderkey AS id FROM orders), l AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_quantity > 2)
    SELECT (SELECT count(*) FROM o WHERE id NOT IN (SELECT id FROM l)) AS only_left, (SELECT count(*) FROM l WHERE id NOT IN (SELECT id FROM o)) AS only_right, (SELECT count(*) FROM o WHERE id NOT IN (SELECT id FROM l)) + (SELECT count(*) FROM l WHERE id NOT IN (SELECT id FROM o)) = 0 AS equal""",
)
def q42(spark, d):
    left = table(spark, d, "orders").select(F.col("o_orderkey").alias("rule_id"))
    right = table(spark, d, "lineitem").where("l_quantity > 2").select(F.col("l_orderkey").alias("rule_id"))
    n = quality.compared(left, right).agg(*quality.counts())
    return n.select(F.col("fn").alias("only_left"), F.col("fp").alias("only_right"), (F.col("fn") + F.col("fp") == 0).alias("equal"))


_MAPPED_SQL = "b AS (SELECT id, g.maps AS in_gold, e.maps AS in_found FROM (SELECT p_partkey AS id, p_size % 2 = 0 AS maps FROM part WHERE p_partkey % 3 <> 0) g JOIN (SELECT p_partkey AS id, p_size % 3 = 0 AS maps FROM part WHERE p_partkey % 4 <> 1) e USING (id))"


def mapped(spark, d):
    fields = lambda when: F.when(when, F.array("p_brand")).otherwise(F.expr("cast(array() as array<string>)")).alias("maps_to")
    part = table(spark, d, "part").withColumn("id", F.col("p_partkey"))
    return quality.mapped(part.where("id % 3 <> 0").select("id", fields(F.col("p_size") % 2 == 0)), part.where("id % 4 <> 1").select("id", fields(F.col("p_size") % 3 == 0)), "id")


@query(
    "q43_maps_to_coverage",
    f"WITH {_MAPPED_SQL} SELECT count(*) AS shared, count(*) FILTER (in_gold) AS gold_has, count(*) FILTER (in_found) AS extracted_has, count(*) FILTER (in_gold AND in_found) AS both_have FROM b",
)
def q43(spark, d):
    return mapped(spark, d).agg(F.count("*").alias("shared"), F.count_if("in_gold").alias("gold_has"), F.count_if("in_found").alias("extracted_has"), F.count_if(F.col("in_gold") & F.col("in_found")).alias("both_have"))


@query("q43b_maps_to_delta", f"WITH {_MAPPED_SQL} SELECT id, in_gold FROM b WHERE in_gold <> in_found")
def q43b(spark, d):
    return mapped(spark, d).where("in_gold <> in_found").select("id", "in_gold")


@query(
    "q44_pipeline_counters",
    """WITH r AS (SELECT d.doc_id, source, lang, CASE WHEN toxic = 1 THEN 'quarantined' WHEN quality = 1 THEN 'accepted' WHEN quality = 0 THEN 'fixed' ELSE 'none' END AS status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT status, count(*) AS rules, count(DISTINCT lang) AS regs, string_agg(DISTINCT lang, ',' ORDER BY lang) AS reg_list, array_to_string(list_sort([x for x in ['en', 'de', 'fr', 'es', 'it'] if NOT list_contains(list(lang), x)]), ',') AS absent, count(*) FILTER (doc_id % 4 = 0) AS unmapped, count(*) FILTER (doc_id % 5 = 0) AS stubbed FROM r GROUP BY status""",
)
def q44(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    status = F.when(F.col("toxic") == 1, "quarantined").when(F.col("quality") == 1, "accepted").when(F.col("quality") == 0, "fixed").otherwise("none")
    maps_to = F.when(F.col("doc_id") % 4 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array("source"))
    fixes = F.array_compact(F.array(F.when(F.col("doc_id") % 5 == 0, "stubbed_check")))
    each = rows.select(status.alias("status"), "lang", maps_to.alias("maps_to"), fixes.alias("fixes"))
    more = each.groupBy("status").agg(F.count_if(F.size("maps_to") == 0).alias("unmapped"), F.count_if(F.array_contains("fixes", "stubbed_check")).alias("stubbed"))
    return quality.counters(each, "status", "lang", ["en", "de", "fr", "es", "it"]).join(more, "status")


#: A judge's report of each turn of a conversation, in SQL that both engines read.
_REPORT = """concat('{"pdf": "', CAST(conv_id AS VARCHAR(20)), '", "pages": [', CAST(turn AS VARCHAR(20)), '], "window_start": ', CAST(turn AS VARCHAR(20)), ', "validation": {"R_', CAST(conv_id % 5 AS VARCHAR(20)), '": {"hard_fail_reasons": [', CASE WHEN turn % 2 = 0 THEN '"span", "id"' ELSE '' END,
 '], "soft_fail_reasons": [', CASE WHEN conv_id % 3 = 0 THEN '"anchor"' ELSE '' END, ']}, "R_x": {"hard_fail_reasons": [], "soft_fail_reasons": []}}, "judge_report": {"judgments": [{"rule_id": "R_', CAST(conv_id % 5 AS VARCHAR(20)), '", "scores": {"atomicity": 1.0, "fidelity": 0.', CAST(turn % 10 AS VARCHAR(20)),
 ', "completeness": 0.5, "maps_to_quality": 0.25, "source_alignment": 0.75}, "overall": 0.5, "failure_modes": [', CASE WHEN turn % 10 < 5 THEN '"LOSES_THRESHOLD"' ELSE '"NOT_ATOMIC", "HALLUCINATION"' END, '], "feedback_for_refinement": "see turn ', CAST(turn AS VARCHAR(20)), '"}]}}')"""


def reports(spark, d):
    return table(spark, d, "conversations").select("conv_id", F.from_json(F.expr(_REPORT), quality.JUDGE_REPORT).alias("r")).select("conv_id", "r.*")


@query(
    "q49_judge_failures",
    """SELECT conv_id, CAST(turn AS INTEGER) AS window_start, 'R_' || (conv_id % 5) AS rule_id, kind, reason FROM conversations, (VALUES ('hard', 'span'), ('hard', 'id'), ('soft', 'anchor')) v(kind, reason) WHERE CASE kind WHEN 'hard' THEN turn % 2 = 0 ELSE conv_id % 3 = 0 END""",
)
def q49(spark, d):
    return quality.failures(reports(spark, d), "conv_id")


@query(
    "q49b_judgments",
    """SELECT conv_id, CAST(turn AS INTEGER) AS window_start, 'R_' || (conv_id % 5) AS rule_id, 1.0::DOUBLE AS atomicity, (turn % 10) / 10.0 AS fidelity, 0.5::DOUBLE AS completeness, 0.25::DOUBLE AS maps_to_quality, 0.75::DOUBLE AS source_alignment, 0.5::DOUBLE AS overall,
    CASE WHEN turn % 10 < 5 THEN 'LOSES_THRESHOLD' ELSE 'NOT_ATOMIC,HALLUCINATION' END AS failure_modes, 'see turn ' || turn AS feedback, round((1.0 + (turn % 10) / 10.0 + 0.5 + 0.25 + 0.75) / 5, 6) AS mean FROM conversations""",
)
def q49b(spark, d):
    found = quality.judgments(reports(spark, d), "conv_id")
    return found.withColumn("failure_modes", F.array_join("failure_modes", ",")).withColumn("mean", F.round(quality.weighted(dict.fromkeys(quality.CRITERIA, 1.0)), 6))


@query(
    "q45_judge_score_status",
    """WITH t AS (SELECT conv_id, turn, length(text) % 101 AS a, (turn * 37 + conv_id) % 101 AS b FROM conversations), l AS (SELECT conv_id, max(turn) AS turn FROM t GROUP BY 1),
    s AS (SELECT t.conv_id, t.turn, CAST((t.a * 3 + t.b) AS DOUBLE) / 400 AS score, t.b < 3 AS hard, t.a % 10 = 0 AS repaired FROM t JOIN l USING (conv_id, turn))
    SELECT conv_id, turn, round(score, 6) AS score, CASE WHEN hard OR score < 0.5 THEN 'quarantined' WHEN repaired OR score < 0.8 THEN 'fixed' ELSE 'accepted' END AS status FROM s""",
)
def q45(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", (F.length("text") % 101 / 100).alias("faithful"), ((F.col("turn") * 37 + F.col("conv_id")) % 101 / 100).alias("complete"), (F.length("text") % 101 % 10 == 0).alias("repaired"))
    last = quality.last_iteration(turns, ["conv_id"], "turn")
    score = F.round(quality.weighted({"faithful": 3.0, "complete": 1.0}), 6)
    return last.select("conv_id", "turn", score.alias("score"), quality.status(score, F.col("complete") < 0.03, F.col("repaired")).alias("status"))


@query(
    "q50_stream_rule_eval",
    """WITH k AS (SELECT strftime(ts, '%Y-%m-%d') AS day, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k FROM events), r AS (SELECT day, 'small' AS id, k <= 50 AS passed FROM k UNION ALL SELECT day, 'even', k % 2 = 0 FROM k)
    SELECT day, id, count(*) FILTER (passed) AS passed, count(*) AS results FROM r GROUP BY ALL""",
)
def q50(spark, d):
    from ..streaming.evaluate import demonstration

    return demonstration(spark, f"{d}/events.parquet")


#: Batches that events arrive in by time; one in four ids has its third event come a batch later, one its second at the very end, and the ids that would meet in a batch are told apart.
_BATCHES, _WITHIN = 5, 9 * 86_400_000_000
_ARRIVING = f"""SELECT event_id, ts, j, k, CASE WHEN k % 4 = 1 AND j = 2 THEN 3 WHEN k % 4 = 2 AND j = 1 THEN {_BATCHES} ELSE j END AS batch, concat(CASE WHEN k % 4 = 1 AND j = 3 THEN 'S_' ELSE 'R_' END, CAST(k AS VARCHAR(19))) AS rule_id
    FROM (SELECT event_id, ts, CAST(floor(event_id / m) AS BIGINT) AS j, CAST(event_id % m AS BIGINT) AS k FROM events, (SELECT CAST(floor((max(event_id) + {_BATCHES}) / {_BATCHES}) AS BIGINT) AS m FROM events) s) e"""


def _ingested_sql() -> str:
    """What a stream makes of the batches, batch by batch: the watermark from those before, then who is late, remembered or new."""
    parts = [f"r AS (SELECT *, epoch_us(ts) AS t FROM ({_ARRIVING}) x)", "s0 AS (SELECT '' AS rule_id, CAST(0 AS BIGINT) AS until WHERE false)"]
    for b in range(_BATCHES + 1):
        parts.append(f"w{b} AS (SELECT coalesce((max(t) // 1000) * 1000 - {_WITHIN}, 0) AS w FROM r WHERE batch < {b})")
        parts.append(f"a{b} AS (SELECT r.* FROM r CROSS JOIN w{b} LEFT JOIN s{b} s ON s.rule_id = r.rule_id WHERE batch = {b} AND t > greatest(w, 0) AND (s.until IS NULL OR s.until <= w))")
        parts.append(f"s{b + 1} AS (SELECT rule_id, max(until) AS until FROM (SELECT rule_id, until FROM s{b} UNION ALL SELECT rule_id, t + {_WITHIN} FROM a{b}) u GROUP BY rule_id)")
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(f"SELECT rule_id, event_id, batch FROM a{b}" for b in range(_BATCHES + 1))


@query("q50b_stream_rule_ingestion", _ingested_sql())
def q50b(spark, d):
    from uuid import uuid4

    from ..streaming.evaluate import Ingestion, scratch

    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.max("event_id")).first()[0] or 0
    m = (last + _BATCHES) // _BATCHES
    j, k = F.expr(f"event_id div {m}"), F.col("event_id") % m
    batch = F.when((k % 4 == 1) & (j == 2), 3).when((k % 4 == 2) & (j == 1), _BATCHES).otherwise(j)
    rows = events.select(F.concat(F.when((k % 4 == 1) & (j == 3), "S_").otherwise("R_"), k.cast("string")).alias("rule_id"), "event_id", "ts", batch.cast("bigint").alias("batch"))
    found = Ingestion(spark, f"{scratch(spark)}/ingestion-{uuid4().hex}", "rule_id string, event_id bigint, ts timestamp, batch bigint", within="9 days")
    for b in range(_BATCHES + 1):
        found.arrive(rows.where(F.col("batch") == b))
    return found.accepted().select("rule_id", "event_id", "batch")
