"""Findings about tables of rule records, mapping reports, PDF pages in Spark."""

import re

from pyspark.sql import functions as F

from rulewright.functions import text as T
from rulewright.operators import lint
from rulewright.plans import rules as R
from rulewright.sources import jsonl


def test_findings_agree_with_the_reader_of_rulesets(spark):
    checks = ["fun i => i.is_debarred", "fun _ => True", "fun i => i.nowhere > 1", "fun i => i.monetary_asset_ratio >= 0", "", "fun i => sorry", "fun i => i.is_debarred i && i.elsewhere", "fun x => x.is_fugitive && i.lost"]
    records = [{"id": f"R_{k % 3}" if k % 2 else f" R  {k % 3} ", "title": '"t"' if k else "", "reference": '"r"', "check": c, "failReason": '"bare"' if k == 3 else 'fun _ => "r"'} for k, c in enumerate(checks)]
    ruleset = R.from_records("t", records, R.CORE)
    fixes = {(k, f) for k, r in enumerate(ruleset.rules) for f in r.fixes}
    rows = [(k, r["id"], r["title"].strip('"'), r["check"], r["failReason"]) for k, r in enumerate(records)]
    df = spark.createDataFrame(rows, "k int, rule_id string, title string, check string, fail_reason string").repartition(3)
    found = {(r["k"], r["finding"]) for r in lint.findings(df, [f.name for f in R.CORE.fields], "k").collect()}
    told = {(k, f) for k, f in found if not f.startswith(("not_evaluable", "tautology")) and f != "missing_fields:title"}
    # A name that isn't bound is known to the compiler alone.
    assert told | {(7, "stubbed_check")} == fixes
    assert {(k, f) for k, f in found if f.startswith(("not_evaluable", "tautology"))} == {(2, "not_evaluable:unknown_field"), (3, "tautology"), (4, "not_evaluable:missing_check"), (5, "not_evaluable:sorry"), (6, "not_evaluable:unknown_field")}
    own = {r["k"]: r["own_id"] for r in lint.numbered_ids(df, "k").collect()}
    assert own == {k: r.id for k, r in enumerate(ruleset.rules)}


def test_findings_of_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (2, "a", "t", "fun i => i.is_debarred", None)], "k int, rule_id string, title string, check string, fail_reason string")
    found = {(r["k"], r["finding"]) for r in lint.findings(df, ["is_debarred"], "k").collect()}
    assert found == {(1, "not_evaluable:missing_check"), (1, "stubbed_check"), (1, "missing_fields:title")}
    assert lint.findings(df.limit(0), [], "k").count() == 0


def test_mapping_report(spark):
    rows = [("a", [("x",), ("Y",)]), ("b", []), ("c", None), ("d", [(None,)])]
    df = spark.createDataFrame(rows, "rule_id string, maps_to array<struct<field:string>>")
    counts, unmapped = lint.mapping_report(df)
    assert tuple(counts.first()) == (4, 2, 2, 1) and sorted(r[0] for r in unmapped.collect()) == ["b", "c"]
    assert tuple(lint.mapping_report(df.limit(0))[0].first()) == (0, 0, 0, 0)


def test_stamps(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS a, timestamp'2024-01-02 03:04:05.000070' AS b, cast(null as timestamp) AS c")
    assert tuple(df.select(*[T.utc_stamp(F.col(c)) for c in "abc"]).first()) == ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05.000070Z", None)


def test_pdf_pages_in_spark(spark, tmp_path):
    """The reader in Spark's workers, with a library of our own that has pages end at form feeds."""
    (tmp_path / "lib").mkdir()
    (tmp_path / "lib" / "fitz.py").write_text("class Page:\n    def __init__(self, t): self.t = t\n    def get_text(self): return self.t\n\ndef open(stream, filetype):\n    return [Page(t) for t in stream.decode().split('\\f')]\n")
    spark.sparkContext.addPyFile(str(tmp_path / "lib" / "fitz.py"))
    (tmp_path / "pdf").mkdir()
    for name, text in {"a.pdf": "\n Title\nbody\ftwo\f", "b.pdf": "only"}.items():
        (tmp_path / "pdf" / name).write_bytes(text.encode())
    pages = jsonl.read_pages(spark, f"{tmp_path}/pdf/*.pdf")
    got = {(re.search(r"(\w)\.pdf", r["doc"])[1], r["page_no"]): r["text"] for r in pages.collect()}
    assert got == {("a", 1): "\n Title\nbody", ("a", 2): "two", ("a", 3): "", ("b", 1): "only"}
    whole = {r["title"].strip(): r["text"] for r in jsonl.whole_texts(pages).collect()}
    assert whole == {"Title": "\n Title\nbody\ntwo\n", "only": "only"}
