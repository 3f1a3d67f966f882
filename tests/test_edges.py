"""Nulls, ties, repeated rows, empty tables and clashing names in the operators of the rule side."""

from pyspark.sql import functions as F

from rulewright.functions import text as T
from rulewright.operators import enrich, evidence, quality, sections, validate
from rulewright.operators import evaluate as E
from rulewright.plans import rules as R
from rulewright.plans.schema import CORE


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc int, text string, rule_id string, page int, field string")
    assert sections.clauses(sections.sections(docs, "doc"), "doc").count() == 0
    assert sections.page_windows(docs, "doc", "page").count() == 0
    assert enrich.with_parents(docs).count() == 0
    assert validate.repeated(docs, "rule_id", "doc").count() == 0
    assert quality.compared(docs, docs).count() == 0
    assert quality.by_group(quality.compared(docs, docs, "rule_id", "field"), "field").count() == 0
    assert evidence.field_index(docs.select("field", "rule_id", F.lit(1).alias("reg"))).count() == 0
    assert quality.histogram(docs.select(F.array("field").alias("l")), "l", "x").count() == 0
    assert quality.counters(docs, "doc", "field", ["a"]).count() == 0
    filings = CORE.normalise(docs.select(F.col("doc").alias("issuer_id")), "issuer_id")
    assert E.evaluate(filings, R.core()).count() == E.reports(filings, R.core()).count() == 0
    assert E.roll_up(docs.select("doc", "page", F.lit(True).alias("passed")), ["doc", "page"]).where("level = 0").count() == 0


def test_nulls(spark):
    docs = spark.createDataFrame([(1, None, None), (1, "", None), (None, "Regulation 4: A\nx", "ICDR_4")], "doc int, text string, rule_id string")
    got = sections.clauses(sections.sections(docs, "doc"), "doc").collect()
    assert [(r["doc"], r["rule_id"], r["text"]) for r in got] == [(None, "ICDR_4", "x")]
    places = spark.createDataFrame([("4", "II")], "reg string, chapter string")
    clash = docs.withColumns({"reg": F.lit("old"), "number": F.lit(9), "chapter": F.lit("old")})
    placed = {r["rule_id"]: (r["number"], r["reg"], r["chapter"]) for r in enrich.with_hierarchy(clash, places).collect()}
    assert placed == {"ICDR_4": ("4", "4", "II"), None: (None, None, None)}
    linked = enrich.with_parents(docs).collect()
    assert len(linked) == 3 and not any(r["proviso"] for r in linked)
    none = docs.where("text is null")
    assert none.select(enrich.rule_type(F.col("text")), enrich.actor(F.col("text")), enrich.condition_type(F.col("text"))).first()[:] == ("general", "issuer", "positive_requirement")
    assert none.select(T.regulation_references(F.col("text")), T.act_references(F.col("text")), T.years_named(F.col("text"))).first()[:] == (None, None, None)
    assert quality.compared(docs, docs).where("rule_id is null").count() == 2  # a null is nobody's equal


def test_ties_and_repeated_rows(spark):
    pieces = spark.createDataFrame([("f", 1, 0.4, 7), ("f", 1, 0.4, 3), ("f", 1, 0.2, 1), (None, 0, 0.9, 2), ("g", None, 0.1, 5), ("g", 0, 0.9, 6)], "field string, source_priority int, confidence double, ordinal int")
    assert {r["field"]: r["ordinal"] for r in evidence.chosen(pieces).collect()} == {"f": 3, None: 2, "g": 5}
    cells = spark.createDataFrame([("a", 2020, 1), ("a", 2021, 2), ("a", 2021, 3), ("a", None, 9), ("b", 2019, 4)], "label string, yr int, value int")
    assert {r["label"]: r["values"] for r in evidence.newest(cells, ["label"], "yr").collect()} == {"a": [3, 2, 1], "b": [4]}
    rows = spark.createDataFrame([("r", 1, "x"), ("r", 1, "x"), ("s", 2, "y")], "rule_id string, reg int, field string")
    index = {r["field"]: (r["n"], r["rule_ids"], r["first_name"]) for r in evidence.field_index(rows).collect()}
    assert index == {"x": (1, "r", "x"), "y": (1, "s", "y")}
    counted = quality.counters(rows, "field", "rule_id", ["r", "q"]).collect()
    assert {(r["field"], r["rules"], r["regs"], r["reg_list"], r["absent"]) for r in counted} == {("x", 2, 1, "r", "q"), ("y", 1, 1, "s", "q,r")}
    pages = spark.createDataFrame([("d", 1), ("d", 1), ("d", None), ("d", 2)], "doc string, page int")
    assert sorted((r["start"], r["page"]) for r in sections.page_windows(pages, "doc", "page").collect()) == [(1, 1), (1, 1), (1, 2), (2, 2)]
