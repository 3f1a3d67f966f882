"""Sections, text functions, validation, evidence, quality."""

from pyspark.sql import functions as F

from rulewright.functions import text as T
from rulewright.operators import enrich, evidence, quality, sections, validate
from rulewright.sources import jsonl

REGULATION = """Preamble
Regulation 4: Scope
Lead in
(1) First clause.
(2) Second
(a) alpha
(b) beta
Regulation 5 - Bars
Whole text.
Regulation 6:
"""


def rows(spark, values, name="t"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"i int, {name} string")


def one(spark, values, column):
    return [r["v"] for r in rows(spark, values).select("i", column.alias("v")).orderBy("i").collect()]


def test_sections_and_clauses(spark):
    docs = spark.createDataFrame([(1, REGULATION), (2, "9. plain title\nbody"), (3, "nothing"), (4, None), (5, "")], "doc int, text string")
    got = sections.clauses(sections.sections(docs, "doc"), "doc").orderBy("doc", "section", "rule_id").collect()
    assert [(r["doc"], r["rule_id"], r["title"], r["text"]) for r in got] == [
        (1, "ICDR_4_1", "Scope — (1)", "First clause."),
        (1, "ICDR_4_2_a", "Scope — (2)(a)", "alpha"),
        (1, "ICDR_4_2_b", "Scope — (2)(b)", "beta"),
        (1, "ICDR_5", "Bars", "Whole text."),
        (2, "ICDR_9", "plain title", "body"),
    ]
    assert sections.clauses(sections.sections(docs, "doc"), "doc", 5, 5).count() == 1


def test_windows(spark):
    pages = spark.createDataFrame([(1, k) for k in range(1, 6)], "doc int, page int")
    got = sections.page_windows(pages, "doc", "page", 3, 1).groupBy("start").agg(F.sort_array(F.collect_list("page")).alias("p")).orderBy("start").collect()
    assert [(r["start"], r["p"]) for r in got] == [(1, [1, 2, 3]), (3, [3, 4, 5]), (5, [5])]


def test_text_functions(spark):
    assert one(spark, ["a \r\n\n \n\nb  ", None, ""], T.normalise(F.col("t"))) == ["a\n\nb", None, ""]
    assert one(spark, ["--A b!c", "x" * 59 + " y"], T.slug(F.col("t"))) == ["a_b_c", "x" * 59 + "_"]
    assert one(spark, ["..a b? c.", "none", "?!"], T.first_sentence(F.col("t"))) == ["a b?", "none", "?!"]
    assert one(spark, ["xxDefs a STOP b END", "no"], T.between_markers(F.col("t"), "Defs", ["END", "STOP"])) == ["Defs a STOP b ", ""]
    assert one(spark, ["no"], T.between_markers(F.col("t"), "Defs", ["END"], quirk=True)) == ["o"]
    assert one(spark, ["ICDR_6_1_a", "ICDR_8A"], T.dotted_number(F.col("t"))) == ["6(1)(a)", "8A"]
    assert one(spark, ["1,44,445.3", "18 months", "x", None], T.whole_number(F.col("t"))) == [144445, 18, None, None]
    assert one(spark, ["the last Three financial years", "preceding 2 year", "last Three full years", "three years", "last few years, previous six years", None], T.years_named(F.col("t"))) == [3, 2, None, None, None, None]
    assert one(spark, [' x {"a": 1} y', "[1] {", "{"], jsonl.first_json_block(F.col("t"))) == ['{"a": 1}', "[1]", None]


def test_identifier_guards(spark):
    long = "ICDR_17_that_such_equity_shares_shall_be_locked_in_for_a_year"
    got, note = T.guarded_id(F.col("t"))
    assert one(spark, [long, "ICDR_6_1_" + "a" * 60, "ICDR_6_1_a_b_c", None], got) == ["ICDR_17_that_such_equity", "ICDR_6_1_" + "a" * 60, "ICDR_6_1_a_b_c", None]
    assert one(spark, [long, "ICDR_6"], note) == ["rule_id_truncated_from_13_tokens", None]
    tail = " Provided that such equity shares stay locked in"
    assert one(spark, ["8A(1)(2)" + tail, "17" + tail, tail, "6(1)", None], T.guarded_number(F.col("t"))) == ["8A(1)(2)_proviso", "17_proviso", tail, "6(1)", None]


def test_references(spark):
    assert one(spark, ["sub-regulation 6(1)(2), regulation 4, Regulation 6(1)(2); regulations 9", "", None], T.regulation_references(F.col("t"))) == [["6(1)(2)", "4"], [], None]
    got = one(spark, ["Companies Act, 2013, reserve bank of india act 1934, Companies Act 1956, Companies Act,2013, SEBI Act 1992"], T.act_references(F.col("t")))
    assert [tuple(x) for x in got[0]] == [("Companies Act", 2013), ("RBI Act", 1934), ("Companies Act", 1956)]


def test_yearly_types(spark):
    data = spark.createDataFrame([("last three years", "length=3"), ("last three years", None), ("last three years", "x"), ("three years", "x")], "t string, c string")
    maps_to = F.array(F.struct(F.lit("f").alias("field"), F.lit("Nat").alias("type_hint"), F.col("c").alias("constraints_text")))
    got = data.select(enrich.yearly_types(maps_to, F.col("t"))[0].alias("m"), enrich.yearly_notes(maps_to, F.col("t")).alias("n")).collect()
    assert [(r["m"]["type_hint"], r["m"]["constraints_text"], len(r["n"])) for r in got] == [("List Nat", "length=3", 1), ("List Nat", "length=3", 1), ("List Nat", "length=3; x", 1), ("Nat", "x", 0)]


def test_parents(spark):
    ids = spark.createDataFrame([("ICDR_1", "x"), ("ICDR_1_proviso", "Provided that"), ("ICDR_1_z", " Explanation: "), ("ICDR_9_proviso", "provided that")], "rule_id string, text string")
    ids = ids.withColumns({c: F.lit(1) for c in ("first", "second", "bare", "short", "known")})
    found = enrich.with_parents(ids)
    assert found.columns == [*ids.columns, "proviso", "exception_to"]
    got = {r["rule_id"]: r["exception_to"] for r in found.collect()}
    assert got == {"ICDR_1": None, "ICDR_1_proviso": "ICDR_1", "ICDR_1_z": "ICDR_1", "ICDR_9_proviso": None}


def test_classes_take_the_first_of_equals(spark):
    classes = {"a": ("x", "y"), "b": ("x", "z")}
    assert one(spark, ["x", "x z", "q", None], enrich.best_class(F.col("t"), classes, "none")) == ["a", "b", "none", "none"]


def test_schema_errors(spark):
    schema = {"required": ["a"], "properties": {"a": {"pattern": "^x"}, "n": {"minimum": 0, "maximum": 1}, "l": {"minItems": 1, "items": {"enum": ["p", "q"]}}}}
    data = spark.createDataFrame([(1, ("x", 0.5, ["p"])), (2, (None, 2.0, [])), (3, ("y", -1.0, ["r", "p"]))], "i int, r struct<a:string,n:double,l:array<string>>")
    got = [r["e"] for r in data.select("i", F.concat_ws("|", *validate.errors(schema, F.col("r"))).alias("e")).orderBy("i").collect()]
    assert got == ["", "record: missing a|n: maximum|l: minItems", "a: pattern|n: minimum|l[]: enum"]


def test_span_match(spark):
    data = spark.createDataFrame([("A b  c", "A b"), ("A b  c", "a B c"), ("A b c", "c a"), ("A", "z")], "t string, h string")
    assert [r["v"] for r in data.select(validate.span_match(F.col("t"), F.col("h")).alias("v")).collect()] == ["strict", "lenient", "fuzzy", "none"]


def test_candidates(spark):
    got = one(spark, ["yes", "1,44,445.3, 7", "18 months", "not mentioned", "", None, "None"], evidence.candidates(F.col("t")))
    assert [tuple(r) for r in got] == [(True, None, None, "yes"), (None, 1444453, None, "1,44,445.3, 7")[:1] + (144445, [144445, 7], "1,44,445.3, 7"), (None, 18, None, "18 months")] + [(None, None, None, None)] * 4


def test_scores(spark):
    ids = lambda *x: spark.createDataFrame([(v,) for v in x], "rule_id string")
    got = quality.scores(quality.compared(ids("a", "b", "c", "c"), ids("b", "c", "d", "e"))).first()
    assert (got["tp"], got["fn"], got["fp"], got["recall"], got["precision"], got["f1"]) == (2, 1, 2, 66.67, 50.0, 57.14)
    empty = quality.scores(quality.compared(ids("a").limit(0), ids("a").limit(0))).first()
    assert (empty["recall"], empty["f1"]) == (0.0, 0.0)


def test_store(spark, tmp_path):
    records = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "rule_id string, n int, _tmp string")
    at = str(tmp_path / "store")
    jsonl.append_records(records.where("rule_id = 'b'"), at)
    jsonl.append_records(records, at, spark.read.json(at))
    stored = spark.read.json(at)
    assert stored.columns == ["n", "rule_id"] and sorted(r["rule_id"] for r in stored.collect()) == ["a", "b"]


def test_lines_are_numbered_across_partitions(spark):
    lines = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, '{"k": 1}').otherwise("{").alias("value"))
    got = jsonl.parse_lines(jsonl.number_lines(lines, "id"), "k bigint").orderBy("line").collect()
    assert [r["line"] for r in got] == [k + 1 for k in range(1000) if k % 3] and sum(r["good"] for r in got) == 333


def test_case_mappings_are_one_to_one(spark):
    given = ["geß öde ﬁn", "ᾳ ᾀ ŉ ǰ", "plain", "", None, "ßß\nß", "Größe 3 - ẞ"]
    assert one(spark, given, T.upper(F.col("t"))) == ["GEẞ ÖDE ﬁN", "ᾼ ᾈ ŉ ǰ", "PLAIN", "", None, "ẞẞ\nẞ", "GRÖẞE 3 - ẞ"]
    assert one(spark, ["İI ΟΔΟΣ", "GEẞ", None], T.lower(F.col("t"))) == ["ii οδοσ", "geß", None]


def test_mentions_of_a_long_text_take_linear_time(spark):
    from time import monotonic

    text = "revenue of 12 and total (margins near 7 the) " * 4000
    began = monotonic()
    found = spark.createDataFrame([(text,)], "t string").select(F.inline(evidence.mentions(F.col("t"), "[a-z]{6,}"))).groupBy("field", "near_number", "in_parens").count().collect()
    assert sorted(map(tuple, found)) == [("margins", True, True, 4000), ("revenue", True, False, 4000)]
    assert monotonic() - began < 60
