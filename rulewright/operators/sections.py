"""Sections and clauses of regulation texts, page windows, rule records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import once

#: Header and label patterns; the second header form counts only where the first is nowhere in a document.
HEADER = r"(?mid)^(?U)\s*Regulation\s+(\d+)\s*[:.\-]?\s*(.*)$"
PLAIN_HEADER = r"(?mid)^(?U)\s*(\d{1,3})\.\s+([A-Z].*)$"
CLAUSE = r"(?md)^\s*\((\d+)\)\s*"
SUBCLAUSE = r"(?md)^\s*\(([a-z])\)\s*"
#: Marks a cut; texts can't hold it after `strip_marks`.
_CUT, _SEP = "\u0001", "\u0002"


def split_at(text: Column, pattern: str, groups: int) -> Column:
    """Array of arrays (groups…, body): the text from each match up to the next; what stands before the first is dropped."""
    marked = F.regexp_replace(F.translate(text, _CUT + _SEP, ""), pattern, _CUT + _SEP.join(f"${k + 1}" for k in range(groups)) + _SEP)
    return F.transform(F.slice(F.split(marked, _CUT), 2, 1 << 30), lambda part: F.split(part, _SEP))


def sections(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, section (its place), number, title and body of every section; null and empty texts, and those without a header, have none."""
    normal = docs.select(key, once(T.normalise(F.col(text))).alias("t"))
    first = normal.select(key, "t", once(split_at(F.col("t"), HEADER, 2)).alias("found"))
    both = first.select(key, F.when(F.size("found") > 0, F.col("found")).otherwise(split_at(F.col("t"), PLAIN_HEADER, 2)).alias("found"))
    parts = both.select(key, F.posexplode("found").alias("section", "p"))
    return parts.select(key, "section", F.col("p")[0].cast("int").alias("number"), T.strip(F.col("p")[1]).alias("title"), T.strip(F.col("p")[2]).alias("body"))


def clauses(found: DataFrame, key: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """key, rule_id, title, text of the rules of sections: one for a section without clauses, else one for each clause, or for each sub-clause of one that has some.  Clauses without text, or with a null one, are left out."""
    if low is not None:
        found = found.where(F.col("number") >= low)
    if high is not None:
        found = found.where(F.col("number") <= high)
    kept = [key, "section", "number", "title"]
    alone = lambda c: F.array(F.array(F.lit(""), F.col(c)))
    level1 = found.select(*kept, "body", once(split_at(F.col("body"), CLAUSE, 1)).alias("s"))
    level1 = level1.select(*kept, F.explode(F.when(F.size("s") > 0, F.col("s")).otherwise(alone("body"))).alias("p"))
    level1 = level1.select(*kept, F.col("p")[0].alias("a"), F.col("p")[1].alias("text"))
    level2 = level1.select(*kept, "a", "text", once(F.when(F.col("a") != "", split_at(F.col("text"), SUBCLAUSE, 1))).alias("s"))
    level2 = level2.select(*kept, "a", F.explode(F.when(F.size("s") > 0, F.col("s")).otherwise(alone("text"))).alias("p"))
    rows = level2.select(key, "section", "number", "title", "a", F.col("p")[0].alias("b"), T.strip(F.col("p")[1]).alias("text")).where(F.col("text") != "")
    label = F.concat(F.when(F.col("a") != "", F.concat(F.lit("("), "a", F.lit(")"))).otherwise(""), F.when(F.col("b") != "", F.concat(F.lit("("), "b", F.lit(")"))).otherwise(""))
    base = F.when(F.col("title") != "", F.col("title")).otherwise(T.first_sentence(F.col("text")))
    parts = [F.col("number").cast("string"), F.when(F.col("a") != "", F.col("a")), F.when(F.col("b") != "", F.col("b"))]
    return rows.select(key, "section", F.concat_ws("_", F.lit("ICDR"), *parts).alias("rule_id"), F.concat_ws("_", F.lit("rule"), *parts).alias("lean_id"), F.concat(base, F.when(label != "", F.concat(F.lit(" — "), label)).otherwise("")).alias("title"), "text")


def visible(text: Column) -> Column:
    """The numbers of the regulations whose headings a page shows, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(HEADER), 1))


def page_windows(pages: DataFrame, doc: str, page: str, width: int = 2, overlap: int = 1, first: int | None = None) -> DataFrame:
    """doc, start, page: the pages of each window of `width` pages, `overlap` of them shared; windows begin at pages that are there.

    A page names the windows it may belong to.  Null pages are in no window, repeated ones in each as often, and an empty table has none.
    """
    step = width - overlap
    if first is not None:
        pages = pages.where(F.col(page) <= first)
    lowest = pages.groupBy(doc).agg(F.min(page).alias("lowest"), F.max(page).alias("highest"))
    placed = pages.join(lowest, doc)
    k = F.col(page) - F.col("lowest")
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda b: k - b), lambda s: (s >= 0) & (s % step == 0))
    return placed.select(*pages.columns, F.explode(F.transform(starts, lambda s: F.col("lowest") + s)).alias("start"))


#: Pages of a stretch within which headings are carried by one task.
STRETCH = 512


def carried(rows: DataFrame, group: str, order: str, value: str, name: str, inclusive: bool = True, width: int = STRETCH, depth: int = 2) -> DataFrame:
    """`rows` with, as `name`, the last non-null `value` at or before (`inclusive` false: before) the row's place `order` within `group`.

    `order` is a whole number.  A group is cut into stretches of `width` places;
    what each stretch ends with goes on to those after it, found in the same way
    over the stretches, so a group with most of the rows is still many tasks: a
    task sees one stretch, or a row for each `width` ** `depth` places.  Of equal
    places the greatest value counts.  Rows with a null group or place get null,
    or their own value if `inclusive`.
    """
    stretch, own, end = f"_stretch{depth}", f"_own{depth}", f"_end{depth}"
    known = F.when(F.col(value).isNotNull() & F.col(order).isNotNull(), F.struct(F.col(order).alias("at"), F.col(value).alias("value")))
    frame = Window.partitionBy(group, stretch).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    placed = rows.withColumn(stretch, F.floor(F.col(order) / width) if depth else F.lit(0)).withColumn(own, F.max(known).over(frame)["value"])
    somewhere = F.col(group).isNotNull() & F.col(order).isNotNull()
    here = F.when(somewhere, F.col(own)).otherwise(F.col(value) if inclusive else F.lit(None))
    if not depth:
        return placed.select(*rows.columns, here.alias(name))
    # A stretch asks after what those before it ended with.
    ends = placed.where(somewhere).groupBy(group, stretch).agg(F.max(known)["value"].alias(end))
    before = carried(ends, group, stretch, end, "_before", False, width, depth - 1).where("_before is not null")
    before = before.select(F.col(group).alias("_group"), F.col(stretch).alias("_of"), "_before")
    joined = placed.join(before, (F.col(group) == F.col("_group")) & (F.col(stretch) == F.col("_of")), "left")
    return joined.select(*rows.columns, F.coalesce(here, F.col("_before")).alias(name))


def in_force(pages: DataFrame, doc: str, page: str, text: str = "text") -> DataFrame:
    """`pages` with `regulations`: the numbers of those that a page deals with, in order, each once: the one in force as it begins, then those whose headings it shows.

    A page without a heading before or on it has none; null pages have their own headings alone, and repeated ones the same.
    """
    shown = pages.withColumn("_shown", F.coalesce(visible(F.col(text)), F.expr("cast(array() as array<string>)")))
    shown = shown.withColumn("_last", F.try_element_at(F.regexp_extract_all(F.col(text), F.lit(HEADER), 1), F.lit(-1)))
    found = carried(shown, doc, page, "_last", "_held", inclusive=False)
    return found.select(*pages.columns, F.array_distinct(F.concat(F.array_compact(F.array("_held")), "_shown")).alias("regulations"))


def window_regulations(windows: DataFrame, doc: str, start: str = "start", regulations: str = "regulations") -> DataFrame:
    """doc, start, regulations: those of all pages of a window, each once, by number; a window has few pages, so their union is small."""
    found = windows.select(doc, start, F.explode(regulations).alias("regulation")).distinct()
    own = found.groupBy(doc, start).agg(F.array_sort(F.collect_list("regulation")).alias(regulations))
    return windows.select(doc, start).distinct().join(own, [doc, start], "left").select(doc, start, F.coalesce(regulations, F.expr("cast(array() as array<string>)")).alias(regulations))


def anchored(claims: DataFrame, pages: DataFrame, doc: str, page: str, regulation: str) -> DataFrame:
    """`claims` with `anchored`, whether the page that a claim names deals with its regulation, and `anchor_failure`, null or why not.

    `pages` is what `in_force` gives; equal pages count together.  A page that
    isn't there, and a claim without page or regulation, is no anchor.
    """
    known = pages.select(F.col(doc).alias("_doc"), F.col(page).alias("_page"), F.explode("regulations").alias("_regulation")).distinct()
    there = pages.select(F.col(doc).alias("_d"), F.col(page).alias("_p")).distinct().withColumn("_there", F.lit(True))
    hit = claims.join(known.withColumn("_hit", F.lit(True)), (F.col(doc) == F.col("_doc")) & (F.col(page) == F.col("_page")) & (F.col(regulation) == F.col("_regulation")), "left")
    hit = hit.join(there, (F.col(doc) == F.col("_d")) & (F.col(page) == F.col("_p")), "left")
    why = F.when(F.col("_there").isNull(), "soft:no_page").when(F.col("_hit").isNull(), "soft:anchor")
    return hit.select(*claims.columns, F.coalesce("_hit", F.lit(False)).alias("anchored"), why.alias("anchor_failure"))
