"""Queries about decoding filings, evaluating rules and reporting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import lint, quality
from ..plans import quantifiers as Q
from ..plans import rules as R
from ..plans.schema import Schema
from . import base
from .base import FILINGS_SQL, NTA, PROFIT, WORTH, table

query = base.Registry()
QUERIES, ORACLES = query.queries, query.oracles

CORE = R.core(NTA, PROFIT, WORTH)
FORM = Schema.of(k="Nat", flag="Bool", tags="List Nat", name="String", share="Option Nat")
#: Filings as text: every fifth in an envelope, every seventh cut short.
_TEXT = """CASE WHEN event_id % 7 = 3 THEN substr(props, 1, length(props) - 1)
 WHEN event_id % 5 = 0 THEN concat('{"issuer_id": "', CAST(event_id AS VARCHAR(20)), '", "fields": ', props, '}') ELSE props END"""


@query(
    "q01_default_fill_decode",
    f"""WITH t AS (SELECT event_id, {_TEXT} s FROM events), p AS (SELECT event_id, try_cast(s AS JSON) j FROM t),
    f AS (SELECT event_id, j IS NOT NULL ok, CASE WHEN json_extract(j, '$.fields') IS NOT NULL THEN json_extract(j, '$.fields') ELSE j END j FROM p)
    SELECT event_id, ok AS decoded, CASE WHEN ok THEN coalesce(CAST(json_extract(j, '$.k') AS BIGINT), 0) END AS k, CASE WHEN ok THEN false END AS flag,
    CASE WHEN ok THEN CAST(0 AS BIGINT) END AS n_tags, CASE WHEN ok THEN '' END AS name, CASE WHEN ok THEN CAST(0 AS BIGINT) END AS share,
    CASE WHEN NOT ok THEN 'invalid JSON' ELSE 'invalid filing' END AS strict_problem FROM f""",
)
def q01(spark, d):
    text = F.expr(_TEXT)
    rows = table(spark, d, "events").select("event_id", FORM.decode(text).alias("r"), FORM.problem(text).alias("strict_problem"))
    return rows.select("event_id", F.col("r").isNotNull().alias("decoded"), "r.k", "r.flag", F.size("r.tags").cast("bigint").alias("n_tags"), "r.name", "r.share", "strict_problem")


_LINE = "CASE WHEN event_id % 6 = 1 THEN concat(props, '}}') WHEN event_id % 6 = 2 THEN '' ELSE props END"


@query(
    "q02_jsonl_tolerant_scan",
    f"""WITH t AS (SELECT event_id, {_LINE} s FROM events), n AS (SELECT *, row_number() OVER (ORDER BY event_id) line FROM t)
    SELECT CAST(line AS BIGINT) AS line, try_cast(s AS JSON) IS NOT NULL AS good, CAST(json_extract(try_cast(s AS JSON), '$.k') AS BIGINT) AS k FROM n WHERE trim(s) <> ''""",
)
def q02(spark, d):
    from ..sources.jsonl import number_lines, parse_lines

    lines = table(spark, d, "events").select("event_id", F.expr(_LINE).alias("value"))
    return parse_lines(number_lines(lines, "event_id"), "k bigint").select("line", "good", "record.k")


@query(
    "q03_scalar_predicate_rules",
    f"""WITH {FILINGS_SQL} SELECT issuer_id, NOT is_debarred AND NOT has_debarred_directors AND NOT is_fraudulent AND NOT is_fugitive AS conjunction,
    NOT has_outstanding_convertibles OR has_esop_exemption OR has_sar_exemption OR has_mandatory_convertibles AS disjunction,
    NOT changed_name_recently OR percent_revenue_from_new_name >= 50 AS implication, general_corp_purpose_ratio <= 25 AS at_most, monetary_asset_ratio >= 10 AS at_least,
    general_corp_purpose_ratio BETWEEN 2 AND 10 AS in_range, monetary_asset_ratio = 7 AS equal,
    monetary_asset_ratio = 0 OR (is_offer_for_sale_only AND general_corp_purpose_ratio >= 2 AND general_corp_purpose_ratio <= 10 AND has_demat_agreement) AS conditional,
    sr_net_worth = 0 OR (is_tech_firm AND sr_holder_exec AND sr_voting_ratio BETWEEN 2 AND 10 AND sr_class_count = 1 AND sr_same_face_value AND sr_issued_3mo_prior) AS superior_shares FROM filings""",
)
def q03(spark, d):
    checks = {
        "conjunction": "fun i => (!i.is_debarred) && (!i.has_debarred_directors) && (!i.is_fraudulent) && (!i.is_fugitive)",
        "disjunction": "fun i => (!i.has_outstanding_convertibles) || i.has_esop_exemption || i.has_sar_exemption || i.has_mandatory_convertibles",
        "implication": "fun i => !i.changed_name_recently ∨ i.percent_revenue_from_new_name ≥ 50",
        "at_most": "fun i => i.general_corp_purpose_ratio ≤ 25",
        "at_least": "fun i => i.monetary_asset_ratio >= 10",
        "in_range": "fun i => i.general_corp_purpose_ratio ≥ 2 && i.general_corp_purpose_ratio ≤ 10",
        "equal": "fun i => i.monetary_asset_ratio == 7",
        "conditional": "fun i => (i.monetary_asset_ratio == 0) ∨ (i.is_offer_for_sale_only ∧ (i.general_corp_purpose_ratio ≥ 2 ∧ i.general_corp_purpose_ratio ≤ 10) ∧ i.has_demat_agreement)",
        "superior_shares": "fun i => i.sr_net_worth == 0 ∨ (i.is_tech_firm ∧ i.sr_holder_exec ∧ i.sr_voting_ratio ≥ 2 ∧ i.sr_voting_ratio ≤ 10 ∧ i.sr_class_count == 1 ∧ i.sr_same_face_value ∧ i.sr_issued_3mo_prior)",
    }
    return base.filings(spark, d).select("issuer_id", *[F.expr(R.compile_predicate(c, R.CORE)[0]).alias(n) for n, c in checks.items()])


@query(
    "q04_list_predicate_rules",
    f"""WITH {FILINGS_SQL} SELECT issuer_id, len(operating_profits) = 3 AS exact_length, coalesce(list_bool_and([x >= {PROFIT} for x in operating_profits]), true) AS all_of,
    coalesce(list_bool_or([x = 0 for x in net_worths]), false) AS any_of, list_contains(net_worths, 0) AS member, len(net_tangible_assets) > 0 AS non_empty,
    coalesce(list_bool_and([x >= {NTA} for x in net_tangible_assets if x > 0]), true) AS filtered,
    general_corp_purpose_ratio <= (coalesce(CAST(list_sum(net_worths) AS BIGINT), 0) * 25) // 100 AS floored, CAST(coalesce(list_sum(net_worths), 0) AS BIGINT) AS total,
    general_corp_purpose_ratio >= 18 * 30 // 100 AS constant FROM filings""",
)
def q04(spark, d):
    checks = {
        "exact_length": "fun i => lengthIs i.operating_profits 3",
        "all_of": f"fun i => allGeNat i.operating_profits {PROFIT}",
        "any_of": "fun i => i.net_worths.any (fun c => c == 0)",
        "member": "fun i => i.net_worths.contains 0",
        "non_empty": "fun i => !i.net_tangible_assets.isEmpty",
        "filtered": f"fun i => (i.net_tangible_assets.filter (fun x => x > 0)).all (· ≥ {NTA})",
        "floored": "fun i => i.general_corp_purpose_ratio <= (i.net_worths.sum * 25) / 100",
        "total": "fun i => i.net_worths.sum",
        "constant": "fun i => i.general_corp_purpose_ratio >= 18 * 30 / 100",
    }
    return base.filings(spark, d).select("issuer_id", *[F.expr(R.compile_predicate(c, R.CORE)[0]).alias(n) for n, c in checks.items()])


def _below(column: str, least: int) -> str:
    return f"""array_to_string([concat('Year ', CAST(k AS VARCHAR)) for k in range(1, len({column}) + 1) if {column}[k] < {least}], ', ')"""


def _three(column: str, least: int) -> str:
    return f"len({column}) = 3 AND coalesce(list_bool_and([x >= {least} for x in {column}]), true)"


def _joined(sep: str, *parts: tuple[str, str]) -> str:
    return f"concat_ws('{sep}', " + ", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in parts) + ")"


_ORACLE_RULES = [
    ("SEBI ICDR 5(1)", "NOT is_debarred AND NOT has_debarred_directors AND NOT is_fraudulent AND NOT is_fugitive", "'Disqualifying condition(s): ' || " + _joined("; ", ("is_debarred", "Issuer/affiliates debarred"), ("has_debarred_directors", "Promoter/Director debarred"), ("is_fraudulent", "Wilful defaulter / fraudulent borrower"), ("is_fugitive", "Fugitive economic offender"))),
    ("SEBI ICDR 5(2)", "NOT has_outstanding_convertibles OR has_esop_exemption OR has_sar_exemption OR has_mandatory_convertibles", "'Outstanding convertibles/rights exist without falling under ESOP/SAR pre-exercise or mandatory conversion carve-outs.'"),
    ("SEBI ICDR 6(1)(a)", f"{_three('net_tangible_assets', NTA)} AND (monetary_asset_ratio <= 50 OR used_monetary_assets OR is_offer_for_sale_only)", _joined(" ", ("len(net_tangible_assets) <> 3", "Need 3 full-year NTA figures."), (f"len(net_tangible_assets) = 3 AND list_bool_or([x < {NTA} for x in net_tangible_assets])", "Each year’s net tangible assets must be ≥ ₹3.0 crore."), ("NOT is_offer_for_sale_only AND monetary_asset_ratio > 50 AND NOT used_monetary_assets", "Monetary assets exceed 50% of NTA without evidence of committed/actual use."))),
    ("SEBI ICDR 6(1)(b)", _three("operating_profits", PROFIT), f"CASE WHEN len(operating_profits) <> 3 THEN 'Need 3 full-year operating profit figures.' ELSE 'Operating profit below ₹15 cr in: ' || {_below('operating_profits', PROFIT)} END"),
    ("SEBI ICDR 6(1)(c)", _three("net_worths", WORTH), f"CASE WHEN len(net_worths) <> 3 THEN 'Need 3 full-year net worth figures.' ELSE 'Net worth below ₹1 cr in: ' || {_below('net_worths', WORTH)} END"),
    ("SEBI ICDR 6(1)(d)", "NOT changed_name_recently OR percent_revenue_from_new_name >= 50", "'Changed name within 1 year but <50% revenue from new-name activity in the preceding full year.'"),
    ("SEBI ICDR 7(1)", "applied_to_stock_exchange AND has_demat_agreement AND promoter_securities_demat AND no_partly_paid_shares AND general_corp_purpose_ratio <= 25", _joined(" ", ("NOT applied_to_stock_exchange", "No in-principle listing approval applied."), ("NOT has_demat_agreement", "No depository agreement executed."), ("NOT promoter_securities_demat", "Promoter securities not fully in demat."), ("NOT no_partly_paid_shares", "Outstanding partly-paid equity exists."), ("general_corp_purpose_ratio > 25", "General corporate purposes exceed 25% cap."))),
]
_LONG_SQL = FILINGS_SQL + ", long AS (" + " UNION ALL ".join(f"SELECT issuer_id, {k} AS ordinal, '{i}' AS id, ({c}) AS passed, CASE WHEN NOT ({c}) THEN {r} END AS bare FROM filings" for k, (i, c, r) in enumerate(_ORACLE_RULES)) + ")"
_META_SQL = "meta AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{r.title}', '{r.reference}', '{r.remedy}')" for k, r in enumerate(CORE.rules)) + ") v(ordinal, title, reference, remedy)), full_ AS (SELECT long.*, title, reference, bare || chr(10) || 'Suggested remedy: ' || remedy AS reason FROM long JOIN meta USING (ordinal))"


@query("q05_evaluate_ruleset_long", f"WITH {_LONG_SQL}, {_META_SQL} SELECT issuer_id, ordinal, id, title, reference, passed, reason FROM full_")
def q05(spark, d):
    return E.evaluate(base.filings(spark, d), CORE)


@query("q05b_results_join_metadata", f"WITH {_LONG_SQL}, {_META_SQL} SELECT id, title, count(*) AS filings, count(*) FILTER (NOT passed) AS failing FROM full_ GROUP BY ALL")
def q05b(spark, d):
    long = E.evaluate(base.filings(spark, d), CORE).select("id", "passed")
    counts = long.groupBy("id").agg(F.count("*").alias("filings"), F.count_if(~F.col("passed")).alias("failing"))
    return counts.join(CORE.metadata(spark).select("id", "title"), "id").select("id", "title", "filings", "failing")


@query(
    "q06_eligibility_report",
    f"""WITH {_LONG_SQL}, {_META_SQL} SELECT issuer_id, bool_and(passed) AS eligible, count(*) FILTER (NOT passed) AS n_failed, coalesce(string_agg(id, '|' ORDER BY ordinal) FILTER (passed), '') AS passed_ids,
    '{{"eligible":' || CAST(bool_and(passed) AS VARCHAR) || ',"failed":[' || coalesce(string_agg('{{"id":"' || id || '","passed":false,"reason":"' || replace(reason, chr(10), '\\n') || '","reference":"' || reference || '","title":"' || title || '"}}', ',' ORDER BY ordinal) FILTER (NOT passed), '') || ']' AS json_head
    FROM full_ GROUP BY issuer_id""",
)
def q06(spark, d):
    report = F.col("report")
    rows = E.reports(base.filings(spark, d), CORE)
    head = F.split_part(E.report_json(report), F.lit(',"passed":['), F.lit(1))
    return rows.select("issuer_id", "report.eligible", F.size("report.failed").cast("bigint").alias("n_failed"), F.array_join(F.transform(report["passed"], lambda r: r["id"]), "|").alias("passed_ids"), head.alias("json_head"))


@query(
    "q06b_regrouped_eligibility",
    f"WITH {_LONG_SQL} SELECT issuer_id, bool_and(passed) AS eligible, count(*) FILTER (NOT passed) AS n_failed, count(*) FILTER (passed) AS n_passed FROM long GROUP BY issuer_id",
)
def q06b(spark, d):
    return E.regroup(E.evaluate(base.filings(spark, d), CORE))


#: A supplier as a filing with three directors; a director is an entry with a list of debarred companies, which some have none of.
_BOARD = Schema.of(directors="array<struct<other_debarred_companies:array<bigint>>>")
_DIRECTORS = "transform(sequence(0, 2), j -> named_struct('other_debarred_companies', IF((s_suppkey + j) % 4 = 0, array(s_suppkey % 10, cast(j as bigint)), cast(array() as array<bigint>))))"


@query(
    "q07_nested_struct_exists",
    "SELECT s_suppkey, s_suppkey % 4 <> 1 AND s_suppkey % 10 > 5 AS any_high, s_suppkey % 4 = 1 AS all_clean, 3::BIGINT AS n_directors FROM supplier",
)
def q07(spark, d):
    filings = _BOARD.normalise(table(spark, d, "supplier").select("s_suppkey", F.expr(_DIRECTORS).alias("directors")), "s_suppkey")
    checks = {
        "any_high": "fun i => i.directors.any (fun d => d.other_debarred_companies.any (fun c => c > 5))",
        "all_clean": "fun i => i.directors.all (fun d => d.other_debarred_companies.isEmpty)",
        "n_directors": "fun i => i.directors.length",
    }
    compiled = [F.expr(R.compile_predicate(c, _BOARD)[0]).alias(n) for n, c in checks.items()]
    return filings.select("s_suppkey", *compiled).withColumn("n_directors", F.col("n_directors").cast("bigint"))


@query(
    "q08_option_semantics",
    """WITH o AS (SELECT o_custkey, CAST(max(date_diff('month', TIMESTAMP '1992-01-01', date_trunc('month', o_orderdate))) AS BIGINT) m, count(*) n FROM orders GROUP BY o_custkey),
    f AS (SELECT c_custkey, c_mktsegment, m, n FROM customer LEFT JOIN o ON c_custkey = o_custkey)
    SELECT c_custkey, m IS NOT NULL AS is_some, m IS NULL AS is_none, coalesce(m = 18, false) AS equals_some, coalesce(m, 0) AS or_default, coalesce(CASE m WHEN 78 THEN true ELSE false END, false) AS matched,
    c_mktsegment = 'BUILDING' AS text_equal, c_mktsegment <> '' AS text_not_empty, coalesce(n, 0) >= 5 * (coalesce(m, 0) // 60) AS ratio FROM f""",
)
def q08(spark, d):
    month = (F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate") - 1
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(month).cast("bigint").alias("m"), F.count("*").alias("n"))
    f = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    form = Schema.of(m="Option Nat", n="Option Nat", c_mktsegment="String")
    checks = {
        "is_some": "fun i => i.m.isSome",
        "is_none": "fun i => i.m.isNone",
        "equals_some": "fun i => i.m.getD 0 == 18",
        "or_default": "fun i => i.m.getD 0",
        "matched": "fun i => match i.m with | some 78 => true | _ => false",
        "text_equal": 'fun i => i.c_mktsegment == "BUILDING"',
        "text_not_empty": 'fun i => i.c_mktsegment ≠ ""',
        "ratio": "fun i => i.n.getD 0 ≥ 5 * (i.m.getD 0 / 60)",
    }
    return f.select("c_custkey", *[F.expr(R.compile_predicate(c, form)[0]).alias(n) for n, c in checks.items()])


@query(
    "q09_hierarchical_gates",
    """WITH g AS (SELECT r_name, n_name, c_custkey, c_acctbal >= 0 AS a, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 3 <> 0 END AS b FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    m AS (SELECT r_name, n_name, a AND b AS ok FROM g)
    SELECT r_name, n_name, coalesce(bool_and(ok), true) AS passed, count(*) AS members, count(*) FILTER (ok IS NULL) AS unknown, CAST(grouping(r_name, n_name) AS BIGINT) AS level FROM m GROUP BY ROLLUP (r_name, n_name)""",
)
def q09(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ok = E.gate(F.col("c_acctbal") >= 0, F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") % 3 != 0))
    return E.roll_up(rows.select("r_name", "n_name", ok.alias("ok")), ["r_name", "n_name"], "ok")


@query("q10_failure_reasons", f"WITH {_LONG_SQL}, {_META_SQL} SELECT issuer_id, id, bare AS reason, reason AS with_remedy FROM full_ WHERE NOT passed")
def q10(spark, d):
    bare = R.Ruleset("core", CORE.schema, tuple(R.Rule(**{**r.__dict__, "remedy": None}) for r in CORE.rules))
    both = base.filings(spark, d).select("issuer_id", F.inline(F.arrays_zip(E.results(bare).alias("b"), E.results(CORE).alias("f"))))
    return both.where("NOT b.passed").select("issuer_id", "b.id", "b.reason", F.col("f.reason").alias("with_remedy"))


def _render_sql(yes: str, no: str, dash: str) -> str:
    return f"""CASE WHEN bool_and(passed) THEN '{yes} Eligible: All applicable rules satisfied' ELSE '{no} Not Eligible: some rules failed' END || chr(10) || chr(10) || '{dash} Failed {dash}' || chr(10) ||
    coalesce(string_agg('{no} ' || id || ' {dash} ' || title || chr(10) || 'Reason: ' || reason || chr(10) || 'Ref: ' || reference, chr(10) || chr(10) ORDER BY ordinal) FILTER (NOT passed), '(none)' || chr(10)) ||
    chr(10) || chr(10) || '{dash} Passed {dash}' || chr(10) || coalesce(string_agg('{yes} ' || id || ' {dash} ' || title, chr(10) ORDER BY ordinal) FILTER (passed), '(none)' || chr(10))"""


@query(
    "q11_rendered_report",
    f"""WITH {_LONG_SQL}, {_META_SQL} SELECT issuer_id, {_render_sql("✅", "❌", "—")} AS marks, {_render_sql("[PASS]", "[FAIL]", "-")} AS ascii,
    concat_ws(chr(10), string_agg('FAIL ' || id || ': ', chr(10) ORDER BY ordinal) FILTER (NOT passed), string_agg('PASS ' || id, chr(10) ORDER BY ordinal) FILTER (passed)) AS summary FROM full_ GROUP BY issuer_id""",
)
def q11(spark, d):
    report = F.col("report")
    return E.reports(base.filings(spark, d), CORE).select("issuer_id", E.render(report).alias("marks"), E.render(report, "ascii").alias("ascii"), E.summarise(report, reasons=False).alias("summary"))


@query(
    "q16_theta_exists_rules",
    """WITH s AS (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) price FROM part), p AS (SELECT l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) price, l_returnflag FROM lineitem)
    SELECT p_partkey, EXISTS (SELECT 1 FROM p WHERE l_partkey = p_partkey AND p.price < s.price) AS any_below, EXISTS (SELECT 1 FROM p WHERE l_partkey = p_partkey AND p.price < s.price AND l_returnflag = 'R') AS nested,
    NOT EXISTS (SELECT 1 FROM p WHERE l_partkey = p_partkey AND l_returnflag NOT IN ('A', 'N')) AS contained FROM s""",
)
def q16(spark, d):
    securities = table(spark, d, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).cast("bigint").alias("issue"))
    paid = table(spark, d, "lineitem").select("l_partkey", F.expr("CAST(round(l_extendedprice * 100) AS bigint) div CAST(l_quantity AS bigint)").alias("paid"), "l_returnflag")
    # One partial aggregate per security answers every "exists a payment below": only the least price counts.
    least = paid.groupBy("l_partkey").agg(F.min("paid").alias("low"), F.min(F.when(F.col("l_returnflag") == "R", F.col("paid"))).alias("low_r"), F.collect_set("l_returnflag").alias("flags"))
    rows = securities.join(least, F.col("p_partkey") == F.col("l_partkey"), "left")
    inside = F.size(F.array_except(F.coalesce("flags", F.expr("cast(array() as array<string>)")), F.lit(["A", "N"]))) == 0
    return rows.select("p_partkey", F.coalesce(F.col("low") < F.col("issue"), F.lit(False)).alias("any_below"), F.coalesce(F.col("low_r") < F.col("issue"), F.lit(False)).alias("nested"), inside.alias("contained"))


#: Securities and payments of a supplier as entries of one filing.
_TRADES = Schema.of(securities="array<struct<id:bigint,price:bigint>>", payments="array<struct<id:bigint,price:bigint>>", held="List Nat", known="List Nat")
_TRADES_SQL = {
    "securities": ("transform(sequence(0, 2), j -> named_struct('id', cast(j as bigint), 'price', (s_suppkey * 7 + j * 3) % 20))", "[{'id': j, 'price': (s_suppkey * 7 + j * 3) % 20} for j in [0, 1, 2]]"),
    "payments": ("transform(sequence(0, 3), j -> named_struct('id', (s_suppkey + j) % 4, 'price', (s_suppkey * 5 + j) % 20))", "[{'id': (s_suppkey + j) % 4, 'price': (s_suppkey * 5 + j) % 20} for j in [0, 1, 2, 3]]"),
    "held": ("array(s_suppkey % 5, s_suppkey % 3)", "[s_suppkey % 5, s_suppkey % 3]"),
    "known": ("array(0L, 1L, s_suppkey % 4)", "[0, 1, s_suppkey % 4]"),
}


@query(
    "q16b_theta_exists_in_rules",
    "WITH t AS (SELECT s_suppkey, " + ", ".join(f"{sql} AS {n}" for n, (_, sql) in _TRADES_SQL.items()) + """ FROM supplier),
    s AS (SELECT s_suppkey, unnest(securities) AS s, payments, held, known FROM t), b AS (SELECT s_suppkey, len([p for p in payments if p.id = s.id AND p.price < s.price]) > 0 AS below, len([h for h in held if h = s.id AND len([p for p in payments if p.id = h]) > 0]) > 0 AS two FROM s)
    SELECT t.s_suppkey, bool_and(below) AS all_below, bool_or(two) AS two_levels, any_value(len([h for h in held if NOT list_contains(known, h)]) = 0) AS contained FROM t JOIN b USING (s_suppkey) GROUP BY t.s_suppkey""",
)
def q16b(spark, d):
    filings = _TRADES.normalise(table(spark, d, "supplier").select("s_suppkey", *[F.expr(e).alias(n) for n, (e, _) in _TRADES_SQL.items()]), "s_suppkey")
    checks = {
        "all_below": "fun i => i.securities.all (fun s => i.payments.any (fun p => p.id == s.id && p.price < s.price))",
        "two_levels": "fun i => i.securities.any (fun s => i.held.any (fun h => h == s.id && i.payments.any (fun p => p.id == h)))",
        "contained": "fun i => i.held.all (fun h => i.known.contains h)",
    }
    return filings.select("s_suppkey", *[F.expr(R.compile_predicate(c, _TRADES)[0]).alias(n) for n, c in checks.items()])


@query(
    "q46_questionnaire_union_all",
    """SELECT r_name AS field, 'Is ' || r_name || ' covered?' AS question, 'Bool' AS type FROM region UNION ALL SELECT n_name, 'How many filings in ' || n_name || '?', 'Nat' FROM nation UNION ALL SELECT r_name, 'List the years of ' || r_name, 'List Nat' FROM region""",
)
def q46(spark, d):
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    part = lambda df, c, before, after, kind: df.select(F.col(c).alias("field"), F.concat(F.lit(before), c, F.lit(after)).alias("question"), F.lit(kind).alias("type"))
    return part(region, "r_name", "Is ", " covered?", "Bool").unionByName(part(nation, "n_name", "How many filings in ", "?", "Nat")).unionByName(part(region, "r_name", "List the years of ", "", "List Nat"))


#: A ruleset with the faults that the linter looks for.
FAULTY = """
def generatedRuleset : List ComplianceRule := [
{ id := "R_1"
  , title := "Fine"
  , reference := "1"
  , check := fun i => i.is_debarred && i.monetary_asset_ratio >= 3
  , failReason := fun _ => "no"
  , remedy? := none },
{ id := "R_2"
  , title := "Stub"
  , reference := "2"
  , check := fun _ => True
  , failReason := fun _ => "stub" },
{ id := "R_2"
  , title := "Unknown"
  , reference := "2"
  , check := fun i => i.no_such_field
  , failReason := fun _ => "unknown" },
{ id := "R_3"
  , title := "Always"
  , reference := "3"
  , check := fun i => i.monetary_asset_ratio >= 0
  , failReason := fun _ => "never" },
{ id := " R  4 "
  , title := "Nothing"
  , reference := "4"
  , failReason := "none" },
{ id := "R_5"
  , title := ""
  , reference := "5"
  , check := fun i => i.is_debarred i && i.nowhere
  , failReason := fun _ => "function" }
]
"""
#: (ordinal, id, finding) of its rules.
_FINDINGS = (
    (1, "R_2", "stubbed_check"),
    (2, "R_2_2", "not_evaluable: unknown field no_such_field"), (2, "R_2_2", "stubbed_check"), (2, "R_2_2", "normalized_rule_id"), (2, "R_2_2", "missing_fields:no_such_field"),
    (3, "R_3", "tautology"),
    (4, "R 4", "not_evaluable: missing check"), (4, "R 4", "stubbed_check"), (4, "R 4", "wrapped_failReason"), (4, "R 4", "normalized_rule_id"),
    (5, "R_5", "not_evaluable: left over: i"), (5, "R_5", "missing_fields:title"), (5, "R_5", "stubbed_check"), (5, "R_5", "missing_fields:nowhere"), (5, "R_5", "suspected_function_field_usage"),
)


@query("q47_ruleset_lint", "SELECT ordinal, id, finding, (SELECT count(*) FROM customer) AS passing FROM (VALUES " + ", ".join(f"({k}, '{i}', '{f}')" for k, i, f in _FINDINGS) + ") v(ordinal, id, finding)")
def q47(spark, d):
    faulty = R.load("faulty", FAULTY, R.CORE)
    found = R.lint(faulty, faulty.metadata(spark))
    passed = E.evaluate(base.filings(spark, d), faulty).groupBy("ordinal").agg(F.count_if("passed").alias("passing"))
    return found.join(passed, "ordinal").select("ordinal", "id", "finding", "passing")


#: Rule records of a table, one for each document: a check by turns right, constant, always true, missing, unproven, of a field that isn't there (a word of the text) and with a field used as a function.
_RULE_RECORDS = """SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN concat(' R  ', CAST(doc_id % 300 AS VARCHAR(9))) ELSE concat('R_', CAST(doc_id % 300 AS VARCHAR(9))) END AS rule_id, CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 9 = 1 THEN NULL ELSE word END AS title,
    CASE doc_id % 7 WHEN 0 THEN 'fun _ => True' WHEN 1 THEN 'fun i => i.is_debarred && i.monetary_asset_ratio >= 3' WHEN 2 THEN concat('fun i => i.', word, '_x > 2 && i.is_debarred') WHEN 3 THEN 'fun i => i.monetary_asset_ratio >= 0' WHEN 4 THEN NULL WHEN 5 THEN 'fun i => sorry' ELSE concat('fun i => i.is_debarred i && i.', word, '_y') END AS "check",
    CASE doc_id % 5 WHEN 0 THEN concat('"', word, '"') WHEN 1 THEN NULL ELSE 'fun _ => "no"' END AS fail_reason FROM (SELECT doc_id, regexp_extract(text, '([A-Za-z]+)', 1) AS word FROM documents) w"""


def rule_records(spark, d):
    return spark.sql(_RULE_RECORDS.replace('"check"', "`check`").replace("FROM documents", "FROM {documents}"), documents=table(spark, d, "documents"))


_LINT_SQL = f"""WITH r AS ({_RULE_RECORDS}), o AS (SELECT *, trim(regexp_replace(rule_id, '\\s+', ' ', 'g')) AS base FROM r), n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY doc_id) AS k FROM o),
    i AS (SELECT *, CASE WHEN k = 1 THEN base ELSE base || '_' || k END AS own_id, regexp_extract("check", 'i\\.([A-Za-z]*_[xy])', 1) AS field FROM n),
    f AS (SELECT doc_id, own_id, unnest(list_filter([CASE doc_id % 7 WHEN 4 THEN 'not_evaluable:missing_check' WHEN 5 THEN 'not_evaluable:sorry' WHEN 2 THEN 'not_evaluable:unknown_field' WHEN 6 THEN 'not_evaluable:unknown_field' END, CASE WHEN doc_id % 7 IN (0, 2, 4, 5, 6) THEN 'stubbed_check' END,
      CASE WHEN doc_id % 7 = 3 THEN 'tautology' END, CASE WHEN coalesce(title, '') = '' THEN 'missing_fields:title' END, CASE WHEN doc_id % 5 = 0 THEN 'wrapped_failReason' END, CASE WHEN own_id <> rule_id THEN 'normalized_rule_id' END, CASE WHEN doc_id % 7 = 6 THEN 'suspected_function_field_usage' END,
      CASE WHEN field <> '' THEN 'missing_fields:' || field END], lambda x: x IS NOT NULL)) AS finding FROM i)"""


@query("q47b_rule_table_lint", f"{_LINT_SQL} SELECT doc_id, own_id, finding FROM f")
def q47b(spark, d):
    return lint.findings(rule_records(spark, d), [f.name for f in R.CORE.fields], "doc_id")


@query("q48_stub_and_fix_histogram", f"{_LINT_SQL} SELECT CASE WHEN finding LIKE 'missing_fields:%' AND finding <> 'missing_fields:title' THEN 'missing_fields' ELSE finding END AS fix, count(*) AS rules FROM f GROUP BY ALL")
def q48(spark, d):
    found = lint.findings(rule_records(spark, d), [f.name for f in R.CORE.fields], "doc_id")
    fix = F.when(F.col("finding").startswith("missing_fields:") & (F.col("finding") != "missing_fields:title"), "missing_fields").otherwise(F.col("finding"))
    return quality.histogram(found.select(F.array(fix).alias("fixes")), "fixes", "fix")



def _entries(rows, name: str):
    """The entries of a list of filings as rows of their own."""
    return Q.Relation(rows.select("s_suppkey", F.inline(name)) if name in ("securities", "payments") else rows.select("s_suppkey", F.explode(name).alias("value")), "s_suppkey")


@query("q16c_rules_over_rows", ORACLES["q16b_theta_exists_in_rules"])
def q16c(spark, d):
    lists = table(spark, d, "supplier").select("s_suppkey", *[F.expr(e).alias(n) for n, (e, _) in _TRADES_SQL.items()])
    checks = {
        "all_below": "fun i => i.securities.all (fun s => i.payments.any (fun p => p.id == s.id && p.price < s.price))",
        "two_levels": "fun i => i.securities.any (fun s => i.held.any (fun h => h == s.id && i.payments.any (fun p => p.id == h)))",
        "contained": "fun i => i.held.all (fun h => i.known.contains h)",
    }
    return Q.evaluate(lists.select("s_suppkey"), {n: _entries(lists, n) for n in _TRADES_SQL}, checks, "s_suppkey")


@query(
    "q16d_rules_over_tables",
    """WITH o AS (SELECT o_custkey k, o_orderkey id, CAST(round(o_totalprice * 100) AS BIGINT) price, o_orderstatus status FROM orders),
    l AS (SELECT k, l_orderkey id, l_linenumber line, CAST(round(l_extendedprice * 100) AS BIGINT) paid, l_returnflag flag, CAST(l_quantity AS BIGINT) quantity, l_suppkey supplier FROM lineitem JOIN o ON l_orderkey = o.id)
    SELECT c_custkey, NOT EXISTS (SELECT 1 FROM o WHERE k = c_custkey AND NOT EXISTS (SELECT 1 FROM l WHERE l.id = o.id AND l.paid < o.price)) AS each_has_a_smaller,
    EXISTS (SELECT 1 FROM o JOIN l ON l.id = o.id WHERE o.k = c_custkey AND l.paid > o.price AND l.quantity >= 45 AND l.flag <> 'N') AS overpaid,
    NOT EXISTS (SELECT 1 FROM l WHERE l.k = c_custkey AND l.flag = 'R' AND c_acctbal < 0) AS none_returned_in_debt,
    EXISTS (SELECT 1 FROM o a JOIN o b ON a.k = b.k WHERE a.k = c_custkey AND a.status = 'F' AND b.price > a.price AND b.id < a.id) AS earlier_and_dearer,
    NOT EXISTS (SELECT 1 FROM o WHERE o.k = c_custkey) AS idle FROM customer""",
)
def q16d(spark, d):
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), cents("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), cents("l_extendedprice").alias("paid"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("bigint").alias("quantity"))
    lines = lines.join(orders.select("id", "k"), "id")
    customers = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") < 0).alias("in_debt"))
    checks = {
        "each_has_a_smaller": "fun i => i.orders.all (fun o => i.lines.any (fun l => l.id == o.id && l.paid < o.price))",
        "overpaid": 'fun i => i.orders.any (fun o => i.lines.any (fun l => l.id == o.id && l.paid > o.price && l.quantity >= 45 && l.flag != "N"))',
        "none_returned_in_debt": 'fun i => !(i.in_debt && i.lines.any (fun l => l.flag == "R"))',
        "earlier_and_dearer": 'fun i => i.orders.any (fun a => a.status == "F" && i.orders.any (fun b => b.price > a.price && b.id < a.id))',
        "idle": "fun i => i.orders.isEmpty",
    }
    return Q.evaluate(customers, {"orders": Q.Relation(orders, "k"), "lines": Q.Relation(lines, "k")}, checks, "c_custkey")
