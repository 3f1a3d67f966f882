"""Readers, sinks, stores, connectors; validation and judge reports."""

import json
import sys
import types

import pytest
from pyspark.sql import functions as F

from rulewright.functions import text as T
from rulewright.operators import evidence, quality, validate
from rulewright.plans.schema import Schema
from rulewright.sources import jsonl

FORM = Schema.of(k="Nat", flag="Bool", share="Option Nat")


def test_filings(spark, tmp_path):
    for name, text in (("a", '{"k": 3, "flag": true, "more": 1}'), ("b", '{"issuer_id": "x", "fields": {"k": 4, "flag": false}}'), ("c", "{"), ("d", '{"k": -1, "flag": true}')):
        (tmp_path / f"{name}.json").write_text(text)
    got = {r["source"][-6]: r for r in jsonl.read_filings(spark, str(tmp_path), FORM).collect()}
    assert [(got[n]["problem"], got[n]["k"], got[n]["flag"], got[n]["share"]) for n in "abcd"] == [(None, 3, True, 0), (None, 4, False, 0), ("invalid JSON", None, None, None), ("invalid filing", -1, True, 0)]
    assert jsonl.read_filings(spark, str(tmp_path / "a.json"), FORM, strict=True).first()["k"] == 3
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        jsonl.read_filings(spark, str(tmp_path / "c.json"), FORM, strict=True).collect()


def test_lines_and_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text('{"rule_id": "a"}\n\nno\n{"rule_id": "b"}\n')
    assert sorted(r["rule_id"] for r in jsonl.read_jsonl(spark, str(tmp_path / "in"), "rule_id string").collect()) == ["a", "b"]
    rows = spark.createDataFrame([("a", None), ("b", "x")], "id string, note string").coalesce(1)
    jsonl.write_documents(rows.where("id = 'b'"), str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in (tmp_path / "doc").glob("part*"))
    assert json.loads(text) == {"id": "b", "note": "x"} and "\n  " in text
    jsonl.write_reports(spark.createDataFrame([('{"eligible":true}',)], "value string"), str(tmp_path / "reports"))
    assert spark.read.json(str(tmp_path / "reports")).first()["eligible"]
    (tmp_path / "shots.json").write_text(json.dumps({"about": 1, "examples": [{"text": "p", "rule_id": "r"}, {"text": "q"}]}, indent=1))
    assert [tuple(r) for r in jsonl.read_examples(spark, str(tmp_path / "shots.json"), "text string, rule_id string").collect()] == [("p", "r"), ("q", None)]


def test_store_modes(spark, tmp_path):
    records = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "rule_id string, _tmp int")
    at = str(tmp_path / "store")
    assert jsonl.store_records(records, at, "append") == 2  # nothing there yet
    assert jsonl.store_records(records.unionByName(spark.createDataFrame([("c", 9)], records.schema)), at, "append") == 1
    assert jsonl.store_records(records.limit(0), at, "append") == 0
    assert sorted(r["rule_id"] for r in spark.read.json(at).collect()) == ["a", "b", "c"] and spark.read.json(at).columns == ["rule_id"]
    assert jsonl.store_records(records.where("rule_id = 'b'"), at) == 1
    assert [r["rule_id"] for r in spark.read.json(at).collect()] == ["b"]
    with pytest.raises(ValueError, match="mode"):
        jsonl.store_records(records, at, "upsert")


def test_connector(spark):
    def call(prompt):
        if "fail" in prompt:
            raise OSError("no service")
        return f'Sure: {{"p": {len(prompt)}}} done'

    rows = spark.createDataFrame([(1, "ab"), (2, "fail"), (3, None)], "i int, prompt string")
    got = [(r["i"], r["block"]) for r in jsonl.answered(rows, "prompt", call).orderBy("i").collect()]
    assert got == [(1, '{"p": 2}'), (2, None), (3, None)]


def test_pages(spark, monkeypatch):
    class Page:
        def __init__(self, text):
            self.get_text = lambda: text

    monkeypatch.setitem(sys.modules, "fitz", types.SimpleNamespace(open=lambda stream, filetype: [Page(t) for t in stream.decode().split("|")]))
    assert jsonl.pages_of(b"one|two") == ["one", "two"]
    monkeypatch.setitem(sys.modules, "fitz", None)
    monkeypatch.setitem(sys.modules, "pdfminer", types.ModuleType("pdfminer"))
    monkeypatch.setitem(sys.modules, "pdfminer.high_level", types.SimpleNamespace(extract_text=lambda f: f.read().decode().replace("|", "\f") + "\f"))
    assert jsonl.pages_of(b"one|two") == ["one", "two"]
    monkeypatch.setitem(sys.modules, "pdfminer.high_level", None)
    with pytest.raises(RuntimeError, match="PyMuPDF or pdfminer"):
        jsonl.pages_of(b"one")
    pages = spark.createDataFrame([("d", 2, "tail"), ("d", 1, " \n Title \nx"), ("e", 1, "")], "doc string, page_no int, text string")
    got = {r["doc"]: (r["title"], r["text"]) for r in jsonl.whole_texts(pages).collect()}
    assert got == {"d": (" Title ", " \n Title \nx\ntail"), "e": (None, "")}
    assert pages.select(T.title_line(F.lit("\n\n a"))).first()[0] == " a"


def test_validation_summary(spark):
    records = spark.createDataFrame([("a", "x"), ("a", ""), (None, None), ("b", "y")], "rule_id string, title string").withColumns({"n": F.lit(7), "first_seen": F.lit(1)})
    assert tuple(validate.summary(records, "rule_id", ["rule_id", "title"]).first()) == (4, 1, 2)
    assert {tuple(r) for r in validate.missing_counts(records, ["rule_id", "title"]).collect()} == {("rule_id", 1), ("title", 2)}
    assert tuple(validate.summary(records.limit(0), "rule_id", ["title"]).first()) == (0, 0, 0)
    placed = records.withColumn("at", F.monotonically_increasing_id())
    twice = validate.repeated(placed, "rule_id", "at").collect()
    assert len(twice) == 1 and twice[0]["n"] == 7 and twice[0]["first_seen"] < twice[0]["at"]


def test_lists_tell_all_errors(spark):
    schema = {"properties": {"l": {"items": {"pattern": "^[a-z]+$", "minLength": 2}}}}
    rows = spark.createDataFrame([(["ab", "c", "9"],), ([],), (None,)], "l array<string>").select(F.struct("l").alias("r"))
    assert [r[0] for r in rows.select(F.concat_ws("|", *validate.errors(schema, F.col("r")))).collect()] == ["l[]: minLength|l[]: pattern|l[]: minLength", "", ""]


def test_mentions(spark):
    text = "net_worth of at least 3 crore (promoter lists promoter) and elsewhere one two three four promoter"
    rows = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(F.inline(evidence.mentions(F.col("t"), "[a-z_]{8,}")))
    got = {r["field"]: r for r in quality.promotion(rows, ["elsewhere"]).collect()}
    assert {f: (r["occurrences"], r["comparator_context"], r["only_in_parens"], r["details"], r["score"], r["promoted"]) for f, r in got.items()} == {
        "net_worth": (1, False, False, [], 0, False),
        "promoter": (3, False, False, ["reusable_2plus_rules"], 2, True),
        "elsewhere": (1, True, False, ["numeric_threshold_nearby", "generic_token"], -1, False),
    }


def test_units(spark):
    rows = spark.createDataFrame([("Revenue (Rs. in Million)",), ("share 12.5 % of it",), ("lakhs",), ("none",), (None,)], "t string")
    assert [tuple(r) for r in rows.select(evidence.unit(F.col("t")), evidence.percent_value(F.col("t"))).collect()] == [("million", None), ("%", 12.5), ("lakh", None), (None, None), (None, None)]


def test_judge_reports(spark):
    text = '{"window_start": 2, "validation": {"r": {"hard_fail_reasons": ["x", "y"], "soft_fail_reasons": null}, "q": {}}, "judge_report": {"judgments": []}}'
    rows = spark.createDataFrame([(1, text), (2, "{}"), (3, None)], "i int, t string").select("i", F.from_json("t", quality.JUDGE_REPORT).alias("r")).select("i", "r.*")
    assert [tuple(r) for r in quality.failures(rows, "i").collect()] == [(1, 2, "r", "hard", "x"), (1, 2, "r", "hard", "y")]
    assert quality.judgments(rows, "i").count() == 0
