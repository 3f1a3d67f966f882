"""Extracted tables: which row of a grid names the fiscal years, which columns hold their values, and which unit a row is in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import once
from .evidence import percent_value, unit

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_NAMED = "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS) + "|sept"
#: The last month of a fiscal year.
YEAR_END = 3
_PARTIAL = r"(?i)\b(?:three|six|nine|3|6|9)[\s-]+months?\b|\bquarter|\bhalf[\s-]*year"
_SPAN = r"(?<![\d,.])((?:19|20)\d\d)\s*[-–/]\s*(\d{4}|\d\d)(?![\d,.])"
_MONTH_FIRST = rf"(?i)\b({_NAMED})\.?\s+\d{{1,2}}(?:\s*,\s*|\s+)((?:19|20)\d\d)\b"
_DAY_FIRST = rf"(?i)\b\d{{1,2}}(?:st|nd|rd|th)?\s+({_NAMED})\.?(?:\s*,\s*|\s+)((?:19|20)\d\d)\b"
_NAMED_YEAR = r"(?i)\b(?:FY|F\.Y\.|fiscal(?:\s+year)?|financial\s+year)\s*'?((?:19|20)\d\d|\d\d)(?!\d)"


def fiscal_year(text: Column, year_end: int = YEAR_END) -> Column:
    """The year in which the fiscal year of a heading ends, else null: ``FY 2023-24``, ``2023-2024``, ``Fiscal 2024``, ``FY24``, ``March 31, 2024``, ``31 March 2024``; a date after the last month belongs to the next year, and part of a year is none."""

    def dated(pattern: str) -> Column:
        month = F.array_position(F.lit([m[:3] for m in _MONTHS]), F.lower(F.substring(F.regexp_extract(text, pattern, 1), 1, 3)))
        year = F.regexp_extract(text, pattern, 2).try_cast("int")
        return year + F.when(month > year_end, 1).otherwise(0)

    first, last = F.regexp_extract(text, _SPAN, 1).try_cast("int"), F.regexp_extract(text, _SPAN, 2)
    short = first - first % 100 + last.try_cast("int")
    ends = F.when(F.length(last) == 4, last.try_cast("int")).when(F.length(last) == 2, F.when(short < first, short + 100).otherwise(short))
    named = F.regexp_extract(text, _NAMED_YEAR, 1)
    year = F.when(F.length(named) == 2, named.try_cast("int") + 2000).otherwise(named.try_cast("int"))
    span = F.when(ends == first + 1, ends)  # other spans are no fiscal years
    return F.when(~text.rlike(_PARTIAL), F.coalesce(dated(_MONTH_FIRST), dated(_DAY_FIRST), span, F.when(last == "", year)))


def _columns(years: Column) -> Column:
    """Array of struct(year, first, last): the columns that belong to each year, up to half way to the next year's on either side."""
    at = F.filter(F.transform(years, lambda y, k: F.struct(y.alias("year"), k.alias("k"))), lambda c: c["year"].isNotNull())
    half = lambda a, n: F.floor((F.get(a, n)["k"] + F.get(a, n + 1)["k"]) / 2).cast("int")

    def spread(a: Column) -> Column:
        return F.transform(
            a,
            lambda c, n: F.struct(
                c["year"].alias("year"), F.when(n == 0, F.lit(1)).otherwise(half(a, n - 1) + 1).alias("first"), F.when(n == F.size(a) - 1, F.lit(1 << 20)).otherwise(half(a, n)).alias("last")
            ),
        )

    return F.transform(F.array(at), spread)[0]


def _values(row: Column, columns: Column) -> Column:
    """Array of struct(year, text): the first cell with a digit among each year's columns, null if there is none."""
    own = lambda c: F.filter(F.slice(row, c["first"] + 1, c["last"] - c["first"] + 1), lambda x: x.rlike(r"\d"))
    return F.transform(columns, lambda c: F.struct(c["year"].alias("year"), F.get(own(c), F.lit(0)).alias("text")))


def rows_of(tables: DataFrame, grid: str = "grid", year_end: int = YEAR_END) -> DataFrame:
    """keys…, row, label, unit, year, text, value, share: a row for each value of each body row of tables with a `grid` (array of rows of cells).

    The header is the first row with the most cells that name fiscal years,
    besides the first column, which holds labels; a grid without one has no
    rows.  A row is in the unit that its label names, or per cent if all its
    values say so; else in that of the last row without values above it that
    names one, else in that of what stands up to the header.  `value` is the
    whole number, `share` the number before a per cent sign.  Null rows, cells
    and grids hold nothing.
    """
    keys = [c for c in tables.columns if c != grid]
    no_rows, no_cells = F.expr("cast(array() as array<array<string>>)"), F.expr("cast(array() as array<string>)")
    rows = F.transform(F.coalesce(grid, no_rows), lambda r: F.transform(F.coalesce(r, no_cells), lambda c: F.coalesce(c, F.lit(""))))
    held = tables.select(*keys, once(rows).alias("_rows"))
    years = F.transform("_rows", lambda r: F.transform(r, lambda c, k: F.when(k > 0, fiscal_year(c, year_end))))
    held = held.select(*keys, "_rows", once(years).alias("_years"))
    counts = F.transform("_years", lambda r: F.size(F.array_compact(r)))
    held = held.select(*keys, "_rows", "_years", once(counts).alias("_counts")).where(F.array_max("_counts") > 0)
    at = F.array_position("_counts", F.array_max("_counts")).cast("int")
    held = held.select(*keys, "_rows", once(at).alias("_at"), "_years").select(*keys, "_rows", "_at", once(_columns(F.element_at("_years", F.col("_at")))).alias("_columns"))
    above = F.transform(F.slice("_rows", 1, F.col("_at")), lambda r: unit(F.array_join(r, " ")))
    first = F.try_element_at(F.array_compact(above), F.lit(-1))
    body = F.transform(F.slice("_rows", F.col("_at") + 1, F.size("_rows")), lambda r: F.struct(F.coalesce(F.get(r, F.lit(0)), F.lit("")).alias("label"), _values(r, F.col("_columns")).alias("values"), F.array_join(r, " ").alias("all")))

    def step(state: Column, row: Column) -> Column:
        some = F.exists(row["values"], lambda v: v["text"].isNotNull())
        shares = F.forall(F.filter(row["values"], lambda v: v["text"].isNotNull()), lambda v: v["text"].endswith("%"))
        own = F.coalesce(unit(row["label"]), F.when(shares, "%"), state["unit"])
        kept = F.array_append(state["out"], F.struct(row["label"].alias("label"), own.alias("unit"), row["values"].alias("values")))
        return F.struct(F.when(some, state["unit"]).otherwise(F.coalesce(unit(row["all"]), state["unit"])).alias("unit"), F.when(some, kept).otherwise(state["out"]).alias("out"))

    none = F.expr("cast(array() as array<struct<label:string,unit:string,values:array<struct<year:int,text:string>>>>)")
    out = held.select(*keys, F.posexplode(F.aggregate(body, F.struct(first.alias("unit"), none.alias("out")), step, lambda s: s["out"])).alias("row", "r"))
    cells = out.select(*keys, "row", "r.label", "r.unit", F.inline("r.values")).where("text is not null")
    return cells.select(*keys, "row", "label", "unit", "year", "text", T.whole_number(F.col("text")).alias("value"), percent_value(F.col("text")).alias("share"))
