"""Queries about regulation texts and rule records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import once
from ..operators import enrich, quality, sections, validate
from . import base
from .base import table

query = base.Registry()
QUERIES, ORACLES = query.queries, query.oracles

def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _case(values, by: str) -> str:
    """One of `values` by the remainder of `by`, in SQL that both engines read."""
    return f"CASE {by} % {len(values)} " + " ".join(f"WHEN {k} THEN {_sql(v)}" for k, v in enumerate(values)) + " END"


def _rows(cases) -> str:
    return "(VALUES " + ", ".join(f"({k}, " + ", ".join(map(_sql, c)) + ")" for k, c in enumerate(cases)) + ")"


_LINES_SQL = """lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
body AS (SELECT doc_id, CAST(i AS INTEGER) i, trim('item ' || regexp_replace(x, '[^A-Za-z]+', ' ', 'g')) x, CAST(doc_id % 20 + i // 4 + 1 AS INTEGER) n FROM lines),
rules AS (SELECT doc_id, i // 4 AS section, n, i % 4 AS k, x, 'ICDR_' || n || CASE i % 4 WHEN 1 THEN '_1' WHEN 2 THEN '_2_a' WHEN 3 THEN '_2_b' ELSE '' END AS rule_id,
  'Title of ' || n || CASE i % 4 WHEN 1 THEN ' — (1)' WHEN 2 THEN ' — (2)(a)' WHEN 3 THEN ' — (2)(b)' ELSE '' END AS title
  FROM body b WHERE i % 4 > 0 OR NOT EXISTS (SELECT 1 FROM body c WHERE c.doc_id = b.doc_id AND c.i = b.i + 1))"""


def regulations(spark, d):
    """doc_id and text with headings, clauses and sub-clauses put before the lines of documents: each fourth line begins a section."""
    number = lambda i: (F.col("doc_id") % 20 + F.floor(i / 4) + 1).cast("int").cast("string")
    clean = lambda x: F.trim(F.concat(F.lit("item "), F.regexp_replace(x, "[^A-Za-z]+", " ")))
    label = lambda i: F.when(i % 4 == 0, F.concat(F.lit("Regulation "), number(i), F.lit(": Title of "), number(i), F.lit("\n"))).when(i % 4 == 1, "(1) ").when(i % 4 == 2, "(2)\n(a) ").otherwise("(b) ")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(label(i), clean(x)))
    return table(spark, d, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))


def clause_rows(spark, d):
    return sections.clauses(sections.sections(regulations(spark, d), "doc_id"), "doc_id")


@query("q20_sectionize_clauses", f"WITH {_LINES_SQL} SELECT doc_id, CAST(section AS INTEGER) AS section, rule_id, replace(rule_id, 'ICDR', 'rule') AS lean_id, title, x AS text FROM rules WHERE n BETWEEN 3 AND 25")
def q20(spark, d):
    return sections.clauses(sections.sections(regulations(spark, d), "doc_id"), "doc_id", 3, 25)


def plainly_headed(spark, d):
    """The regulation texts, with headings of the second form in every other document; the others have lines that look like such headings in their bodies."""
    number = lambda i: (F.col("doc_id") % 20 + F.floor(i / 4) + 1).cast("int").cast("string")
    clean = lambda x: F.trim(F.concat(F.lit("item "), F.regexp_replace(x, "[^A-Za-z]+", " ")))
    plain = F.col("doc_id") % 2 == 1
    head = lambda i: F.concat(F.when(plain, F.concat(number(i), F.lit(". "))).otherwise(F.concat(F.lit("Regulation "), number(i), F.lit(": "))), F.lit("Title of "), number(i), F.lit("\n"))
    label = lambda i: F.when(i % 4 == 0, head(i)).when(i % 4 == 1, "(1) ").when(i % 4 == 2, "(2)\n(a) ").otherwise("(b) ")
    annex = lambda i: F.when((i % 4 == 3) & ~plain, "\n9. Annex").otherwise("")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(label(i), clean(x), annex(i)))
    return table(spark, d, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))


@query(
    "q20b_fallback_headings",
    f"WITH {_LINES_SQL} SELECT doc_id, CAST(section AS INTEGER) AS section, rule_id, title, x || CASE WHEN k = 3 AND doc_id % 2 = 0 THEN chr(10) || '9. Annex' ELSE '' END AS text FROM rules",
)
def q20b(spark, d):
    return sections.clauses(sections.sections(plainly_headed(spark, d), "doc_id"), "doc_id").select("doc_id", "section", "rule_id", "title", "text")


@query(
    "q21_page_windows",
    """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS page FROM documents),
    f AS (SELECT doc_id, page, length(x) AS n, substr(x, 1, 1) AS c FROM p WHERE page <= 30), w AS (SELECT DISTINCT doc_id, page AS start FROM f)
    SELECT w.doc_id, w.start, count(*) AS pages, CAST(sum(n) AS BIGINT) AS chars, array_to_string(list_sort(list_distinct(list(c))), '') AS visible FROM w JOIN f ON f.doc_id = w.doc_id AND f.page BETWEEN w.start AND w.start + 1 GROUP BY ALL""",
)
def q21(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    numbered = lines.select("doc_id", (F.col("k") + 1).alias("page"), F.concat(F.lit(" "), (F.col("k") + 1).cast("string"), F.lit("\n"), "line").alias("text"))
    pages = numbered.select("doc_id", "page", T.page_number_stripped(F.col("text")).alias("line"))
    windows = sections.page_windows(pages, "doc_id", "page", 2, 1, first=30)
    return windows.groupBy("doc_id", "start").agg(F.count("*").alias("pages"), F.sum(F.length("line")).cast("bigint").alias("chars"), F.array_join(F.array_sort(F.array_distinct(F.collect_list(F.substring("line", 1, 1)))), "").alias("visible"))


#: Lines of a page of a regulation text.
PAGE_LINES = 3
#: Pages of the regulation texts and the headings on them, found by the place of a heading among the lines: two labels of four stand on lines of their own.
_PAGES_SQL = f"""src AS (SELECT doc_id, CAST(i AS BIGINT) i, n FROM (SELECT doc_id, i, doc_id % 20 + i // 4 + 1 AS n FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents))),
heads AS (SELECT doc_id, (i + (i + 3) // 4 + (i + 1) // 4) // {PAGE_LINES} + 1 AS page, n FROM src WHERE i % 4 = 0),
size AS (SELECT doc_id, (max(i) + 1) + (max(i) + 4) // 4 + (max(i) + 2) // 4 AS lines FROM src GROUP BY doc_id),
page AS (SELECT doc_id, unnest(range(1, (lines - 1) // {PAGE_LINES} + 2)) AS page FROM size),
regs AS (SELECT doc_id, page, n FROM heads UNION SELECT p.doc_id, p.page, max(h.n) FROM page p JOIN heads h ON h.doc_id = p.doc_id AND h.page < p.page GROUP BY p.doc_id, p.page)"""


def regulation_pages(spark, d):
    """doc_id, page and text: the regulation texts in pages of a few lines, so that most show no heading."""
    lines = F.split("text", "\n")
    pages = regulations(spark, d).select("doc_id", once(lines).alias("lines"))
    at = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / PAGE_LINES).cast("int"))
    return pages.select("doc_id", F.posexplode(F.transform(at, lambda k: F.array_join(F.slice("lines", k * PAGE_LINES + 1, PAGE_LINES), "\n"))).alias("k", "text")).select("doc_id", (F.col("k") + 1).alias("page"), "text")


@query(
    "q21b_regulations_in_force",
    f"""WITH {_PAGES_SQL}, w AS (SELECT DISTINCT doc_id, page AS start FROM page), u AS (SELECT w.doc_id, w.start, r.n FROM w LEFT JOIN regs r ON r.doc_id = w.doc_id AND r.page BETWEEN w.start AND w.start + 1)
    SELECT doc_id, CAST(start AS INTEGER) AS start, coalesce(array_to_string(list_sort(list_distinct(list(CAST(n AS VARCHAR)))), ','), '') AS regulations FROM u GROUP BY ALL""",
)
def q21b(spark, d):
    pages = sections.in_force(regulation_pages(spark, d), "doc_id", "page").select("doc_id", "page", "regulations")
    found = sections.window_regulations(sections.page_windows(pages, "doc_id", "page", 2, 1), "doc_id")
    return found.select("doc_id", "start", F.array_join("regulations", ",").alias("regulations"))


_NORMAL_SQL = r"regexp_replace(regexp_replace(regexp_replace(replace(text, chr(13), ''), '(?m)[ \t]+$', '', 'g'), '\n(?:\s*\n)+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"


@query(
    "q22_text_normalise_slug_first_sentence",
    rf"""WITH t AS (SELECT doc_id, text, {_NORMAL_SQL} AS normal FROM documents)
    SELECT doc_id, md5(normal) AS normal, lower(substr(regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 60)) AS slug,
    regexp_replace(CASE WHEN regexp_extract(normal, '([^.?!]+[.?!])', 1) <> '' THEN regexp_extract(normal, '([^.?!]+[.?!])', 1) ELSE substr(normal, 1, 120) END, '^\s+|\s+$', '', 'g') AS sentence, substr(normal, 1, 200) AS head FROM t""",
)
def q22(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text", once(T.normalise(F.col("text"))).alias("n"))
    return t.select("doc_id", F.md5("n").alias("normal"), T.slug(F.col("text")).alias("slug"), T.first_sentence(F.col("n")).alias("sentence"), F.substring("n", 1, 200).alias("head"))


@query(
    "q23_marker_substring",
    """WITH r AS (SELECT page_id, html, CASE WHEN strpos(html, '<article>') > 0 THEN substr(html, strpos(html, '<article>')) ELSE '' END AS s FROM pages)
    SELECT page_id, md5(substr(s, 1, coalesce(CASE WHEN strpos(s, '</b>') > 0 THEN strpos(s, '</b>') END, CASE WHEN strpos(s, '</p>') > 0 THEN strpos(s, '</p>') END, length(s) + 1) - 1)) AS part,
    CASE WHEN strpos(html, '<none>') > 0 THEN '' ELSE right(html, 1) END AS quirk, length(html) > 0 AS filled FROM r""",
)
def q23(spark, d):
    html = F.col("html")
    return table(spark, d, "pages").select("page_id", F.md5(T.between_markers(html, "<article>", ["</b>", "</p>"])).alias("part"), T.between_markers(html, "<none>", ["x"], quirk=True).alias("quirk"), (F.length(html) > 0).alias("filled"))


_NOISY = "CASE event_id % 4 WHEN 0 THEN concat('Sure: ', props, ' done.') WHEN 1 THEN concat('[1, ', props, '] and') WHEN 2 THEN concat('x {', props) ELSE 'nothing' END"


@query(
    "q24_first_json_block",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN concat('[1, ', props, ']') END AS block, CASE event_id % 4 WHEN 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events",
)
def q24(spark, d):
    from ..sources.jsonl import first_json_block

    rows = table(spark, d, "events").select("event_id", first_json_block(F.expr(_NOISY)).alias("block"))
    return rows.select("event_id", "block", F.get_json_object("block", "$.k").cast("bigint").alias("k"))


@query(
    "q30_rule_store_dedupe",
    """WITH r AS (SELECT 'R_' || (doc_id % 300) AS rule_id, doc_id, text, n_chars % 7 AS confidence, source FROM documents), n AS (SELECT * FROM r WHERE rule_id NOT IN (SELECT rule_id FROM r WHERE doc_id % 7 = 0 AND doc_id < 200)),
    k AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY doc_id) a, row_number() OVER (PARTITION BY rule_id ORDER BY confidence DESC, length(text) NULLS FIRST, doc_id) b FROM n)
    SELECT rule_id, max(doc_id) FILTER (a = 1) AS first_doc, max(doc_id) FILTER (b = 1) AS best_doc, max(source) FILTER (a = 1) AS source FROM k GROUP BY rule_id""",
)
def q30(spark, d):
    records = table(spark, d, "documents").select(F.concat(F.lit("R_"), F.col("doc_id") % 300).alias("rule_id"), "doc_id", "text", (F.col("n_chars") % 7).alias("confidence"), "source")
    new = records.join(records.where("doc_id % 7 = 0 and doc_id < 200").select("rule_id").distinct(), "rule_id", "left_anti")
    # The first and the best record of each id, in one aggregate.
    first = F.min_by(F.struct("doc_id", "source"), "doc_id").alias("first")
    best = F.min_by("doc_id", quality.best_record("confidence", "text", "doc_id")).alias("best_doc")
    return new.groupBy("rule_id").agg(first, best).select("rule_id", F.col("first.doc_id").alias("first_doc"), "best_doc", "first.source")


_KEPT = "CASE WHEN doc_id % 11 = 0 THEN substr(text, 1, 15) WHEN doc_id % 13 = 0 THEN upper(replace(text, ' ', ' - ')) WHEN doc_id % 17 = 0 THEN NULL ELSE text END"


@query(
    "q30b_keep_best_by_signature",
    rf"""WITH r AS (SELECT 'R_' || (doc_id % 300) AS rule_id, doc_id, {_KEPT} AS text, n_chars % 7 AS confidence, source FROM documents), s AS (SELECT * FROM r WHERE rule_id NOT IN (SELECT rule_id FROM r WHERE doc_id % 7 = 0 AND doc_id < 200)),
    n AS (SELECT *, trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS t FROM s), g AS (SELECT *, CASE WHEN length(t) >= 20 THEN md5(substr(t, 1, 160)) ELSE 'id ' || rule_id END AS sig FROM n),
    k AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY sig) AS copies FROM g WINDOW w AS (PARTITION BY sig ORDER BY confidence DESC, length(text) NULLS FIRST, doc_id))
    SELECT rule_id, doc_id, source, copies FROM k WHERE k = 1""",
)
def q30b(spark, d):
    n, text = F.col("doc_id"), F.col("text")
    kept = F.when(n % 11 == 0, F.substring(text, 1, 15)).when(n % 13 == 0, T.upper(F.replace(text, F.lit(" "), F.lit(" - ")))).when(n % 17 == 0, None).otherwise(text)
    records = table(spark, d, "documents").select(F.concat(F.lit("R_"), F.col("doc_id") % 300).alias("rule_id"), "doc_id", kept.alias("text"), (F.col("n_chars") % 7).alias("confidence"), "source")
    store = records.where("doc_id % 7 = 0 and doc_id < 200").select("rule_id").distinct()
    new = records.join(store, "rule_id", "left_anti")
    best = quality.keep_best(new, quality.best_record("confidence", "text", "doc_id"))
    return best.select("rule_id", "doc_id", "source", "copies")


@query(
    "q30c_rule_store_batches",
    """WITH r AS (SELECT 'R_' || (doc_id * 7 % 400) AS rule_id, doc_id, doc_id % 3 AS batch, source FROM documents), k AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY batch, doc_id) AS k FROM r)
    SELECT rule_id, doc_id, batch, source FROM k WHERE k = 1""",
)
def q30c(spark, d):
    from uuid import uuid4

    from ..sources.store import RuleStore
    from ..streaming.evaluate import scratch

    records = table(spark, d, "documents").select(F.concat(F.lit("R_"), F.col("doc_id") * 7 % 400).alias("rule_id"), "doc_id", (F.col("doc_id") % 3).alias("batch"), "source", F.lit("x").alias("_internal"))
    store = RuleStore(spark, f"{scratch(spark)}/store-{uuid4().hex}", buckets=16)
    store.overwrite(records.where("batch = 0"), "first", "doc_id")
    for batch, name in ((1, "second"), (2, "third"), (1, "second"), (2, "third")):  # the last two were sent before
        store.append(records.where(F.col("batch") == batch), name, "doc_id")
    return store.read()


@query(
    "q31_validate_required_dups",
    """WITH r AS (SELECT doc_id, 'R_' || (doc_id % 400) AS rule_id, CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN '' ELSE source END AS domain, CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END AS title FROM documents)
    SELECT doc_id, rule_id, concat_ws(',', CASE WHEN coalesce(domain, '') = '' THEN 'domain' END, CASE WHEN coalesce(title, '') = '' THEN 'title' END) AS missing,
    CASE WHEN row_number() OVER w > 1 THEN first_value(doc_id) OVER w END AS first_seen FROM r WINDOW w AS (PARTITION BY rule_id ORDER BY doc_id)""",
)
def q31(spark, d):
    records = table(spark, d, "documents").select(
        "doc_id",
        F.concat(F.lit("R_"), F.col("doc_id") % 400).alias("rule_id"),
        F.expr("CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN '' ELSE source END").alias("domain"),
        F.expr("CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END").alias("title"),
    )
    return records.select("doc_id", "rule_id", F.array_join(validate.missing(["domain", "title"]), ",").alias("missing"), validate.first_seen("rule_id", "doc_id").alias("first_seen"))


@query(
    "q31b_validation_summary",
    """WITH r AS (SELECT 'R_' || (doc_id % 400) AS rule_id, doc_id % 9 = 0 OR doc_id % 10 = 0 AS d, doc_id % 11 = 0 AS t FROM documents)
    SELECT 'records' AS what, count(*) AS n FROM r UNION ALL SELECT 'duplicates', count(*) - count(DISTINCT rule_id) FROM r UNION ALL SELECT 'incomplete', count(*) FILTER (d OR t) FROM r UNION ALL SELECT 'domain', count(*) FILTER (d) FROM r UNION ALL SELECT 'title', count(*) FILTER (t) FROM r""",
)
def q31b(spark, d):
    records = table(spark, d, "documents").select(F.concat(F.lit("R_"), F.col("doc_id") % 400).alias("rule_id"), F.expr("IF(doc_id % 9 = 0 OR doc_id % 10 = 0, '', 'd')").alias("domain"), F.expr("IF(doc_id % 11 = 0, NULL, 't')").alias("title"))
    total = validate.summary(records, "rule_id", ["domain", "title"]).select(F.expr("stack(3, 'records', records, 'duplicates', duplicates, 'incomplete', incomplete) AS (what, n)"))
    return total.unionByName(validate.missing_counts(records, ["domain", "title"]).select(F.col("member").alias("what"), F.col("records").alias("n")))


#: A JSON Schema in the manner of the one for rule records.
RECORD_SCHEMA = {
    "required": ["rule_id", "status"],
    "properties": {
        "rule_id": {"pattern": r"^[A-Za-z_][A-Za-z0-9_]*$"},
        "status": {"enum": ["accepted", "fixed", "quarantined"]},
        "confidence": {"minimum": 0, "maximum": 1},
        "pages": {"minItems": 1, "uniqueItems": True},
        "span_hint": {"maxLength": 120},
        "fields": {"items": {"pattern": "^[a-z][a-z0-9_]*$"}},
    },
}


#: Its types and members, for records as JSON texts; texts, and what is wrong with them.
RAW_SCHEMA = {"type": "object", "additionalProperties": False, "properties": {"rule_id": {"type": "string"}, "confidence": {"type": "number"}, "pages": {"type": "array"}, "status": {"type": ["string", "null"]}}}
_RAW_RECORDS = (
    ('{"rule_id": 1, "extra": 2}', "record: additionalProperties extra|rule_id: type"),
    ('{"rule_id": "a", "confidence": 0.5, "pages": []}', ""),
    ('{"rule_id": "a", "confidence": "x", "pages": {"a": 1}, "status": null}', "confidence: type|pages: type"),
    ("[1]", "record: type"),
    ("no record", ""),
)


@query(
    "q32_schema_validation_errors",
    r"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN NULL ELSE source || CASE WHEN doc_id % 6 = 0 THEN '-x' ELSE '' END END AS rule_id, CASE doc_id % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'open' WHEN 2 THEN 'fixed' ELSE 'quarantined' END AS status,
    (n_chars % 150) / 100.0 AS confidence, doc_id % 4 AS pages, substr(text, 1, CAST(n_chars % 200 AS INTEGER)) AS span_hint, regexp_extract(text, '(\w+)', 1) AS field FROM documents)
    SELECT doc_id, concat_ws('|', CASE WHEN rule_id IS NULL THEN 'record: missing rule_id' END, CASE WHEN NOT regexp_matches(rule_id, '^[A-Za-z_][A-Za-z0-9_]*$') THEN 'rule_id: pattern' END, CASE WHEN status = 'open' THEN 'status: enum' END,
    CASE WHEN confidence > 1 THEN 'confidence: maximum' END, CASE WHEN pages = 0 THEN 'pages: minItems' END, CASE WHEN pages = 3 THEN 'pages: uniqueItems' END, CASE WHEN length(span_hint) > 120 THEN 'span_hint: maxLength' END,
    CASE WHEN NOT regexp_matches(field, '^[a-z][a-z0-9_]*$') THEN 'fields[]: pattern' END) AS errors, """
    + f"{_case([e for _, e in _RAW_RECORDS], 'doc_id')} AS raw_errors FROM r",
)
def q32(spark, d):
    docs = table(spark, d, "documents")
    pages = F.expr("CASE doc_id % 4 WHEN 0 THEN cast(array() as array<bigint>) WHEN 3 THEN array(1L, 1L) ELSE array(doc_id % 4) END")
    record = F.struct(
        F.when(F.col("doc_id") % 8 != 0, F.concat("source", F.when(F.col("doc_id") % 6 == 0, "-x").otherwise(""))).alias("rule_id"),
        F.expr("CASE doc_id % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'open' WHEN 2 THEN 'fixed' ELSE 'quarantined' END").alias("status"),
        ((F.col("n_chars") % 150) / 100.0).alias("confidence"),
        pages.alias("pages"),
        F.expr("substring(text, 1, cast(n_chars % 200 as int))").alias("span_hint"),
        F.array(F.regexp_extract("text", r"(\w+)", 1)).alias("fields"),
    )
    rows = docs.select("doc_id", record.alias("r"), F.expr(_case([t for t, _ in _RAW_RECORDS], "doc_id")).alias("raw"))
    found = validate.errors(RECORD_SCHEMA, F.col("r"))
    return rows.select("doc_id", F.concat_ws("|", *found).alias("errors"), F.concat_ws("|", *validate.raw_errors(RAW_SCHEMA, F.col("raw"))).alias("raw_errors"))


#: The nested part of a rule record: lists of objects and of numbers, closed.
NESTED_SCHEMA = {
    "type": "object",
    "required": ["rule_id", "maps_to"],
    "properties": {
        "rule_id": {"type": "string", "minLength": 3},
        "maps_to": {"type": "array", "items": {"type": "object", "required": ["field"], "properties": {"field": {"type": "string", "pattern": "^[a-z][a-z0-9_]*$"}, "type_hint": {"type": "string"}}, "additionalProperties": False}},
        "source": {
            "type": "object", "required": ["pdf", "pages"], "additionalProperties": False,
            "properties": {"pdf": {"type": "string"}, "pages": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"type": "integer", "minimum": 0}}, "span_hint": {"type": "string", "maxLength": 40}},
        },
        "confidence": {"type": "number", "minimum": 0, "maximum": 1},
    },
}
#: A record as JSON, made of a document, in SQL that both engines read; word is the first word of its text, hint what begins it.
_RECORD = """CASE WHEN doc_id % 11 = 0 THEN concat('{"rule_id": "', source) WHEN doc_id % 13 = 0 THEN concat('["', source, '"]') ELSE concat('{"rule_id": "', source, '", "maps_to": [{"field": "', lower(word), '", "type_hint": "Nat"}, {"field": "', word, '"', CASE WHEN doc_id % 6 = 1 THEN ', "extra": 1, "more": []' ELSE '' END, '}',
  CASE doc_id % 4 WHEN 1 THEN ', 5' WHEN 2 THEN ', {"type_hint": 7}' WHEN 3 THEN ', {"field": null}' ELSE '' END, ']', CASE WHEN doc_id % 7 = 0 THEN ', "source": "none"' WHEN doc_id % 7 = 1 THEN '' ELSE concat(', "source": {"pdf": "', source, '", "pages": [', CASE doc_id % 3 WHEN 0 THEN '1, 2' WHEN 1 THEN '' ELSE '3, -1, "x", 3' END, '], "span_hint": "', hint, '"', CASE WHEN doc_id % 5 = 0 THEN ', "page": 1' ELSE '' END, '}') END,
  ', "confidence": ', CAST(n_chars % 3 AS VARCHAR(9)), '}') END"""
_HINT = "substr(regexp_replace(text, '[^A-Za-z ]+', ' '), 1, 30 + doc_id % 20)"


@query(
    "q32b_nested_schema_errors",
    r"""WITH d AS (SELECT doc_id, n_chars, source, regexp_extract(text, '([A-Za-z]+)', 1) AS word, length(substr(regexp_replace(text, '[^A-Za-z ]+', ' ', 'g'), 1, CAST(30 + doc_id % 20 AS INTEGER))) AS hint FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'record: no JSON' WHEN doc_id % 13 = 0 THEN 'record: type' ELSE concat_ws('|', CASE WHEN length(source) < 3 THEN 'rule_id: minLength' END,
    CASE WHEN lower(word) = '' THEN 'maps_to[0].field: pattern' END, CASE WHEN doc_id % 6 = 1 THEN 'maps_to[1]: additionalProperties extra,more' END, CASE WHEN NOT regexp_matches(word, '^[a-z][a-z0-9_]*$') THEN 'maps_to[1].field: pattern' END,
    CASE doc_id % 4 WHEN 1 THEN 'maps_to[2]: type' WHEN 2 THEN 'maps_to[2]: missing field|maps_to[2].type_hint: type' WHEN 3 THEN 'maps_to[2].field: type' END,
    CASE WHEN doc_id % 7 = 0 THEN 'source: type' WHEN doc_id % 7 > 1 THEN nullif(concat_ws('|', CASE WHEN doc_id % 5 = 0 THEN 'source: additionalProperties page' END, CASE doc_id % 3 WHEN 1 THEN 'source.pages: minItems' WHEN 2 THEN 'source.pages: uniqueItems|source.pages[1]: minimum|source.pages[2]: type' END, CASE WHEN hint > 40 THEN 'source.span_hint: maxLength' END), '') END,
    CASE WHEN n_chars % 3 = 2 THEN 'confidence: maximum' END) END AS errors FROM d""",
)
def q32b(spark, d):
    made = table(spark, d, "documents").select("doc_id", "n_chars", "source", F.regexp_extract("text", "([A-Za-z]+)", 1).alias("word"), F.expr(_HINT.replace("doc_id % 20", "cast(doc_id % 20 as int)")).alias("hint"))
    return made.select("doc_id", F.array_join(validate.document_errors(NESTED_SCHEMA, F.expr(_RECORD)), "|").alias("errors"))


@query(
    "q33_anchoring_and_span",
    r"""WITH m AS (SELECT max(item_id) + 1 AS n FROM benchmark), j AS (SELECT doc_id, d.text, CASE WHEN doc_id % 3 = 0 THEN substr(d.text, 5, 40) WHEN doc_id % 3 = 1 THEN replace(substr(d.text, 3, 30), ' ', '  ') ELSE b.text END AS hint FROM documents d, m JOIN benchmark b ON b.item_id = d.doc_id % m.n),
    f AS (SELECT *, regexp_replace(lower(trim(text, ' ')), '\s+', ' ', 'g') AS t, regexp_replace(lower(trim(hint, ' ')), '\s+', ' ', 'g') AS h FROM j),
    s AS (SELECT doc_id, CASE WHEN contains(text, hint) THEN 'strict' WHEN contains(t, h) THEN 'lenient' WHEN len([w for w in list_distinct(string_split(h, ' ')) if NOT list_contains(string_split(t, ' '), w)]) <= 0 THEN 'fuzzy' ELSE 'none' END AS span FROM f)
    SELECT doc_id, span, doc_id % 7 IN (doc_id % 10, doc_id * 3 % 10) AS anchored, CAST(CASE WHEN doc_id % 7 IN (doc_id % 10, doc_id * 3 % 10) THEN 90 ELSE 70 END AS BIGINT) AS confidence_pct,
    concat_ws(',', CASE WHEN span = 'none' THEN 'hard:span' END, CASE WHEN doc_id % 7 NOT IN (doc_id % 10, doc_id * 3 % 10) THEN 'soft:anchor' END) AS failures FROM s""",
)
def q33(spark, d):
    items = table(spark, d, "benchmark")
    n = items.agg((F.max("item_id") + 1).alias("n"))
    docs = table(spark, d, "documents").join(F.broadcast(n)).withColumn("item_id", F.col("doc_id") % F.col("n"))
    both = docs.join(items.select("item_id", F.col("text").alias("item")), "item_id")
    hint = F.when(F.col("doc_id") % 3 == 0, F.substring("text", 5, 40)).when(F.col("doc_id") % 3 == 1, F.replace(F.substring("text", 3, 30), F.lit(" "), F.lit("  "))).otherwise(F.col("item"))
    rows = both.select("doc_id", "text", hint.alias("hint"), (F.col("doc_id") % 7).cast("string").alias("reg"), sections.visible(F.concat(F.lit("Regulation "), (F.col("doc_id") % 10).cast("string"), F.lit(": Scope\n\tregulation "), (F.col("doc_id") * 3 % 10).cast("string"), F.lit(" - Bars\nregulations 4"))).alias("visible"))
    span, anchored = validate.span_match(F.col("text"), F.col("hint")), F.array_contains("visible", F.col("reg"))
    found = rows.select("doc_id", span.alias("span"), anchored.alias("anchored"))
    return found.select("doc_id", "span", "anchored", F.when(F.col("anchored"), 90).otherwise(70).cast("bigint").alias("confidence_pct"), F.concat_ws(",", F.when(F.col("span") == "none", "hard:span"), F.when(~F.col("anchored"), "soft:anchor")).alias("failures"))


#: The page that a rule claims to stand on: its own for some, others before or after it, or past the end.
_CLAIMED = "(doc_id * 7 + section * 3) % (doc_id % 5 + section + 3) + 1"


@query(
    "q33c_anchors_on_pages",
    f"""WITH {_PAGES_SQL}, c AS (SELECT DISTINCT doc_id, i // 4 AS section, n FROM src WHERE i % 4 > 0 OR NOT EXISTS (SELECT 1 FROM src s WHERE s.doc_id = src.doc_id AND s.i = src.i + 1)),
    k AS (SELECT doc_id, section, n, {_CLAIMED} AS claimed FROM c), a AS (SELECT k.*, p.page IS NOT NULL AS there, EXISTS (SELECT 1 FROM regs r WHERE r.doc_id = k.doc_id AND r.page = claimed AND r.n = k.n) AS hit FROM k LEFT JOIN page p ON p.doc_id = k.doc_id AND p.page = claimed)
    SELECT doc_id, CAST(section AS INTEGER) AS section, CAST(n AS VARCHAR) AS regulation, CAST(claimed AS INTEGER) AS page, hit AS anchored, CASE WHEN NOT there THEN 'soft:no_page' WHEN NOT hit THEN 'soft:anchor' END AS failure, CAST(CASE WHEN hit THEN 90 ELSE 70 END AS BIGINT) AS confidence_pct FROM a""",
)
def q33c(spark, d):
    claims = clause_rows(spark, d).select("doc_id", "section", F.split_part("rule_id", F.lit("_"), F.lit(2)).alias("regulation")).distinct().withColumn("page", F.expr(_CLAIMED).cast("int"))
    pages = sections.in_force(regulation_pages(spark, d), "doc_id", "page")
    found = sections.anchored(claims, pages, "doc_id", "page", "regulation")
    return found.select("doc_id", "section", "regulation", "page", "anchored", F.col("anchor_failure").alias("failure"), F.when(F.col("anchored"), 90).otherwise(70).cast("bigint").alias("confidence_pct"))


#: Hints of documents: as they stand, in capitals with wider blanks, with characters put in and left out, and backwards; the texts in ASCII, as the oracle counts edits in bytes.
_HINTS = """CASE doc_id % 4 WHEN 0 THEN substr(t, 5, 30) WHEN 1 THEN upper(replace(substr(t, 3, 28), ' ', '  ')) WHEN 2 THEN concat(substr(t, 40, 12), 'zq', substr(t, 53, 12)) ELSE reverse(substr(t, 20, 24)) END"""


@query(
    "q33b_fuzzy_spans",
    rf"""WITH a AS (SELECT doc_id, regexp_replace(text, '[^\n -~]', '?', 'g') AS t FROM documents), h AS (SELECT doc_id, t, {_HINTS} AS h FROM a),
    f AS (SELECT doc_id, contains(t, h) AS strict, regexp_replace(lower(trim(t, ' ')), '\s+', ' ', 'g') AS t, regexp_replace(lower(trim(h, ' ')), '\s+', ' ', 'g') AS h FROM h),
    e AS (SELECT doc_id, length(h) AS m, strict, strpos(t, h) - 1 AS place, t, h FROM f),
    w AS (SELECT doc_id, h, m, m // 8 AS most, s, substr(t, s, m + m // 8) AS w FROM e, range(1, length(t) + 1) r(s) WHERE place < 0),
    c AS (SELECT doc_id, s - 1 AS a, s - 1 + n AS b, levenshtein(h, w[1:n]) AS d, most FROM w, range(m - most, m + most + 1) r(n) WHERE n <= length(w)),
    b AS (SELECT doc_id, a, b, d FROM c WHERE d <= most QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d, b, a DESC) = 1)
    SELECT e.doc_id, CASE WHEN place >= 0 AND (strict OR m = 0) THEN 'strict' WHEN place >= 0 THEN 'lenient' WHEN b.doc_id IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS kind,
    CAST(CASE WHEN place >= 0 THEN place ELSE b.a END AS INTEGER) AS "start", CAST(CASE WHEN place >= 0 THEN place + m ELSE b.b END AS INTEGER) AS "end", CAST(CASE WHEN place >= 0 THEN 0 ELSE b.d END AS INTEGER) AS edits FROM e LEFT JOIN b USING (doc_id)""",
)
def q33b(spark, d):
    texts = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", r"[^\n -~]", "?").alias("t"))
    found = texts.select("doc_id", validate.placed_span(F.col("t"), F.expr(_HINTS)).alias("s"))
    return found.select("doc_id", "s.*")


@query(
    "q34_hierarchy_enrichment",
    f"""WITH {_LINES_SQL}, p AS (SELECT CAST(n_nationkey + 1 AS VARCHAR) AS reg, n_name AS part, r_name AS chapter FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT rule_id, CAST(n AS VARCHAR) || CASE k WHEN 1 THEN '(1)' WHEN 2 THEN '(2)(a)' WHEN 3 THEN '(2)(b)' ELSE '' END AS number, chapter, part, '2018-09-11' AS effective, count(*) AS records
    FROM rules LEFT JOIN p ON p.reg = CAST(n AS VARCHAR) GROUP BY ALL""",
)
def q34(spark, d):
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select((F.col("n_nationkey") + 1).cast("string").alias("reg"), F.col("n_name").alias("part"), F.col("r_name").alias("chapter"))
    counted = clause_rows(spark, d).groupBy("rule_id").agg(F.count("*").alias("records"))  # one row per id before the join
    return enrich.with_hierarchy(counted, places).select("rule_id", "number", "chapter", "part", F.date_format(F.to_date(F.lit("2018-09-11")), "yyyy-MM-dd").alias("effective"), "records")


@query(
    "q34b_extraction_stamps",
    "SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(t, '%f') = '000000' THEN '' ELSE '.' || strftime(t, '%f') END || 'Z' AS extracted_at, '2018-09-11' AS effective FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE ts END AS t FROM events) e",
)
def q34b(spark, d):
    time = F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return table(spark, d, "events").select("event_id", T.utc_stamp(time).alias("extracted_at"), F.date_format(F.to_date(F.lit("2018-09-11")), "yyyy-MM-dd").alias("effective"))


_PROVISO_SQL = """r AS (SELECT doc_id, 'ICDR_' || (doc_id % 40) || '_' || (doc_id % 3) || CASE WHEN doc_id % 5 = 0 THEN '_proviso' WHEN doc_id % 7 = 0 THEN '_x' ELSE '' END AS rule_id,
CASE WHEN doc_id % 5 = 0 THEN '  Provided that ' WHEN doc_id % 7 = 0 THEN 'Explanation: ' ELSE '' END || substr(text, 1, 10) AS text FROM documents)"""


@query(
    "q35_proviso_parent_link",
    f"""WITH {_PROVISO_SQL}, ids AS (SELECT DISTINCT rule_id FROM r), a AS (SELECT *, doc_id % 5 = 0 OR doc_id % 7 = 0 OR starts_with(lower(trim(text)), 'provided that') OR starts_with(lower(trim(text)), 'explanation') AS proviso FROM r)
    SELECT doc_id, rule_id, proviso, CASE WHEN NOT proviso THEN NULL WHEN ends_with(rule_id, '_proviso') AND replace(rule_id, '_proviso', '') IN (SELECT rule_id FROM ids) THEN replace(rule_id, '_proviso', '')
    WHEN regexp_replace(rule_id, '_[^_]*$', '') IN (SELECT rule_id FROM ids) THEN regexp_replace(rule_id, '_[^_]*$', '') END AS exception_to FROM a""",
)
def q35(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id",
        F.expr("concat('ICDR_', doc_id % 40, '_', doc_id % 3, CASE WHEN doc_id % 5 = 0 THEN '_proviso' WHEN doc_id % 7 = 0 THEN '_x' ELSE '' END)").alias("rule_id"),
        F.expr("concat(CASE WHEN doc_id % 5 = 0 THEN '  Provided that ' WHEN doc_id % 7 = 0 THEN 'Explanation: ' ELSE '' END, substring(text, 1, 10))").alias("text"),
    )
    return enrich.with_parents(rows).select("doc_id", "rule_id", "proviso", "exception_to")


#: (text, chapter, rule type, actor, condition type, scope): what the classes give for texts on which plainer rules would differ.
_CLAUSES = (
    ("An issuer shall not be eligible to make a public offer", "II", "eligibility", "issuer", "prohibition", "IPO"),
    ("The promoter group shall disclose the price band", "III", "pricing", "promoter", "positive_requirement", "rights_issue"),
    ("The issuer shall see that promoters' contribution of the promoter group is locked-in", "IV", "promoter_contribution", "promoter", "positive_requirement", "FPO"),
    ("Provided that the lead manager shall furnish a certificate", "V", "procedural", "lead_manager", "carve_out", "preferential_issue"),
    ("Nothing contained herein shall not apply", "VI", "prohibition", "issuer", "prohibition", "QIP"),
    ("Basis of allotment is fixed with the merchant banker", "VII", "allotment", "lead_manager", "positive_requirement", "IDR_IPO"),
    ("Selling shareholder and the board of directors of the issuer", "VIII", "general", "issuer", "positive_requirement", "IDR_rights"),
    ("Securities under lock-in and not be transferable by debarred persons", "IX", "lock_in", "issuer", "prohibition", "SME_IPO"),
    ("Board of the issuer, board of directors", "XII", "general", "board_of_directors", "positive_requirement", "general"),
    (None, None, "general", "issuer", "positive_requirement", "general"),
)


def _planted(phrase: str) -> str:
    """A phrase in the middle of a document's text, in SQL that both engines read."""
    return f"concat(substr(text, 1, CAST(floor(length(text) / 2) AS INTEGER)), ' ', coalesce({phrase}, ''), ' ', substr(text, CAST(floor(length(text) / 2) AS INTEGER) + 1))"


def _class_sql(text: str, classes: dict, default: str) -> str:
    """The class most of whose words a text has, in the oracle's SQL."""
    scores = {name: " + ".join(f"CAST(contains(lower({text}), {_sql(w)}) AS INTEGER)" for w in words) for name, words in classes.items()}
    best = f"greatest({', '.join(scores.values())})"
    return f"CASE WHEN {best} = 0 THEN '{default}' " + " ".join(f"WHEN {score} = {best} THEN '{name}'" for name, score in scores.items()) + " END"


def _any_sql(text: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), {_sql(w)})" for w in words) + ")"


_CLAUSE_SQL = _planted(_case([c[0] for c in _CLAUSES], "doc_id"))


@query(
    "q36_keyword_classification",
    f"""WITH t AS (SELECT doc_id, {_CLAUSE_SQL} AS t FROM documents)
    SELECT doc_id, {_class_sql("t", enrich.RULE_TYPES, "general")} AS rule_type, {_class_sql("t", enrich.ACTORS, "issuer")} AS actor,
    CASE WHEN {_any_sql("t", "shall not", "prohibited", "debarred")} THEN 'prohibition' WHEN {_any_sql("t", "provided that", "nothing contained")} THEN 'carve_out' ELSE 'positive_requirement' END AS condition,
    CASE doc_id % {len(_CLAUSES)} {" ".join(f"WHEN {k} THEN '{c[5]}'" for k, c in enumerate(_CLAUSES))} END AS scope FROM t""",
)
def q36(spark, d):
    text = F.expr(_planted("phrase"))
    phrase = F.expr(_case([c[0] for c in _CLAUSES], "doc_id").replace("''", "\\'"))
    chapter = F.expr(_case([c[1] for c in _CLAUSES], "doc_id"))
    rows = table(spark, d, "documents").withColumn("phrase", phrase).select("doc_id", once(text).alias("t"))
    t = F.col("t")
    return rows.select("doc_id", enrich.rule_type(t).alias("rule_type"), enrich.actor(t).alias("actor"), enrich.condition_type(t).alias("condition"), F.array_join(enrich.scopes(chapter), ",").alias("scope"))


#: (phrase, regulations, schedules, acts): what the references of a text with that phrase in its midst are, in order; its prose has none.
_REFERRING = (
    ("and sub-regulation 4(3), regulation 6(1)(2), Regulation 6(1)(2) and regulations 9 with Schedule IV, schedule vi and Schedule IV", "4(3),6(1)(2)", "IV,vi", ""),
    ("of the Companies Act, 2013, the Securities and Exchange Board of India Act,1992, Companies Act 1956 and the Companies Act, 2013", "", "", "Companies Act:2013,SEBI Act:1992,Companies Act:1956"),
    ("or regulation 8A and REGULATION 8a(1), the SEBI Act 1992 and the reserve bank of india act 1934", "8A,8a(1)", "", "RBI Act:1934"),
    ("under Schedules XI and Schedule XI, the Securities Contracts (Regulation) Act, 1956 or the Depositories Act 1996", "", "XI", "Depositories Act:1996"),
)


@query(
    "q37_cross_reference_extract",
    f"SELECT doc_id, CAST(100 + doc_id % 30 AS VARCHAR) || CASE WHEN r = '' THEN '' ELSE ',' || r END AS regulations, schedules, acts FROM documents JOIN {_rows([c[1:] for c in _REFERRING])} v(k, r, schedules, acts) ON doc_id % {len(_REFERRING)} = k",
)
def q37(spark, d):
    phrase = F.concat(F.lit("under regulation "), (100 + F.col("doc_id") % 30).cast("string"), F.lit(" "), F.expr(_case([c[0] for c in _REFERRING], "doc_id")))
    rows = table(spark, d, "documents").withColumn("phrase", phrase).select("doc_id", once(F.expr(_planted("phrase"))).alias("text"))
    text = F.col("text")
    acts = F.transform(T.act_references(text), lambda a: F.concat(a["act"], F.lit(":"), a["year"].cast("string")))
    return rows.select("doc_id", F.array_join(T.regulation_references(text), ",").alias("regulations"), F.array_join(T.schedule_references(text), ",").alias("schedules"), F.array_join(acts, ",").alias("acts"))


#: Ids with a word of the text at their end, and sentences of the text where a number was asked for.
_RAW_ID = "concat('ICDR_', CAST(doc_id % 50 AS VARCHAR(9)), CASE WHEN doc_id % 10 = 0 THEN 'A' ELSE '' END, '_1_', CASE doc_id % 6 WHEN 0 THEN 'Provided further' WHEN 1 THEN 'Provided that' WHEN 2 THEN 'Explanation' WHEN 3 THEN 'Category II' WHEN 4 THEN 'a' ELSE 'very_long_tail_of_an_identifier_that_goes_on_and_on_x' END, '_', regexp_extract(lower(text), '([a-z]+)', 1))"
_SENTENCE = "CASE doc_id % 4 WHEN 0 THEN concat('6(1)(Provided that ', text, ')') WHEN 1 THEN concat('8A(1)(2) Provided that ', text) WHEN 2 THEN concat('Provided that ', text) ELSE '6(3)(a)' END"


@query(
    "q38_rule_id_canonicalise",
    rf"""WITH b AS (SELECT doc_id, CAST(doc_id % 50 AS VARCHAR) || CASE WHEN doc_id % 10 = 0 THEN 'A' ELSE '' END AS n, doc_id % 6 AS k, nullif(regexp_extract(lower(text), '([a-z]+)', 1), '') AS word, {_SENTENCE} AS s FROM documents),
    c AS (SELECT doc_id, n, s, regexp_extract(s, '^(\d+[A-Z]?(?:\(\d+\))*)', 1) AS begins, concat_ws('_', n, '1', CASE k WHEN 0 THEN 'proviso2' WHEN 1 THEN 'proviso' WHEN 2 THEN 'explanation' WHEN 3 THEN 'category' WHEN 4 THEN 'a' ELSE 'very_long_tail_of_an_identifier_that_goes_on_and_on_x' END, word) AS id FROM b),
    t AS (SELECT *, 'ICDR_' || id AS whole, string_split('ICDR_' || id, '_') AS tokens FROM c), g AS (SELECT *, length(whole) > 50 AND len(tokens) > 5 AS long FROM t)
    SELECT doc_id, id AS canonical, CASE WHEN long THEN array_to_string(tokens[1:5], '_') ELSE whole END AS guarded, CASE WHEN long THEN 'rule_id_truncated_from_' || len(tokens) || '_tokens' END AS note,
    md5(CASE WHEN length(s) > 40 AND begins <> '' THEN begins || '_proviso' ELSE s END) AS number, regexp_matches(n, '^[0-9]+[A-Za-z]?$') AS is_token FROM g""",
)
def q38(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.expr(_SENTENCE).alias("s"), once(T.canonical_id(F.expr(_RAW_ID))).alias("c"))
    guarded, note = T.guarded_id(F.concat(F.lit("ICDR_"), "c"))
    return rows.select("doc_id", F.col("c").alias("canonical"), guarded.alias("guarded"), note.alias("note"), F.md5(T.guarded_number(F.col("s"))).alias("number"), T.is_regulation_token(F.element_at(F.split("c", "_"), 1)).alias("is_token"))


#: (phrase in the midst of a text, years): only phrases about past years name a number, and only the first such phrase counts.
_YEARLY = (
    ("in the last three financial years", "3"),
    ("of the preceding 5 years", "5"),
    ("for Seven full years", None),
    ("for a lock-in period of three years", None),
    ("in each of the Previous seven years", "7"),
    ("in the last few years and the preceding two years", None),
    ("", None),
    ("in the previous 12 financial year", "12"),
)


@query(
    "q39_multi_year_type_override",
    f"""WITH t AS (SELECT doc_id, CAST(y AS INTEGER) AS years, y, doc_id // 8 % 2 = 0 AS nat, CASE doc_id % 3 WHEN 0 THEN '>= 1' WHEN 1 THEN '' ELSE 'length=3' END AS had FROM documents JOIN {_rows([c[1:] for c in _YEARLY])} v(k, y) ON doc_id % {len(_YEARLY)} = k)
    SELECT doc_id, years, CASE WHEN NOT nat THEN 'Bool' WHEN y IS NULL THEN 'Nat' ELSE 'List Nat' END AS type_hint,
    CASE WHEN NOT nat OR y IS NULL OR (had = 'length=3' AND y = '3') THEN had WHEN had = '' THEN 'length=' || y ELSE 'length=' || y || '; ' || had END AS constraints,
    CASE WHEN nat AND y IS NOT NULL THEN 'type_override:Nat->ListNat(n=' || y || ')_for_profits' ELSE '' END AS notes FROM t""",
)
def q39(spark, d):
    phrase = F.concat(F.lit("profits "), F.expr(_case([c[0] for c in _YEARLY], "doc_id")))
    docs = table(spark, d, "documents").withColumn("phrase", phrase).select("doc_id", once(F.expr(_planted("phrase"))).alias("text"))
    text = F.col("text")
    had = F.expr("CASE doc_id % 3 WHEN 0 THEN '>= 1' WHEN 1 THEN '' ELSE 'length=3' END")
    maps_to = F.array(F.struct(F.lit("profits").alias("field"), F.when(F.expr("doc_id div 8") % 2 == 0, "Nat").otherwise("Bool").alias("type_hint"), had.alias("constraints_text")))
    rows = docs.select("doc_id", T.years_named(text).alias("years"), enrich.yearly_types(maps_to, text).alias("m"), F.array_join(enrich.yearly_notes(maps_to, text), ",").alias("notes"))
    return rows.select("doc_id", "years", F.col("m")[0]["type_hint"].alias("type_hint"), F.col("m")[0]["constraints_text"].alias("constraints"), "notes")
