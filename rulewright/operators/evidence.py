"""Evidence for facts: typed candidates, choice, type reconciliation, coverage, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import let

#: Confidence of evidence from a table, from text with a quote, and without.
TABLE, QUOTED, BARE = 0.9, 0.4, 0.2
#: Raw values that say there is none.
ABSENT = ("", "none", "not mentioned", "null")


def candidates(raw: Column) -> Column:
    """struct(bool, nat, nats, text) of a raw value: what it is as each type, null where it isn't."""
    low = F.lower(F.trim(raw))
    there = raw.isNotNull() & ~low.isin(*ABSENT)
    numbers = T.whole_numbers(raw)
    return F.struct(
        F.when(low.isin("yes", "true"), F.lit(True)).when(low.isin("no", "false"), F.lit(False)).alias("bool"),
        F.when(there, T.whole_number(F.regexp_replace(raw, ",", ""))).alias("nat"),
        F.when(there & (F.size(numbers) >= 2), numbers).alias("nats"),
        F.when(there, raw).alias("text"),
    )


def confidence(from_table: Column, quote: Column) -> Column:
    return F.when(from_table, F.lit(TABLE)).when(quote.isNotNull() & (quote != ""), F.lit(QUOTED)).otherwise(F.lit(BARE))


def chosen(evidence: DataFrame, key: str = "field") -> DataFrame:
    """The piece of each field with the least source_priority, then the highest confidence, then the first by `ordinal`; a null field is one like any other, null priorities come first."""
    w = Window.partitionBy(key).orderBy("source_priority", F.desc("confidence"), "ordinal")
    return evidence.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def parse_rates(evidence: DataFrame, key: str = "field") -> DataFrame:
    """Of each field, the share of its evidence that parses as each type, and that is missing; fields without evidence aren't there."""
    c = F.col("candidate")
    rate = lambda cond: F.round(F.avg(cond.cast("double")), 6)
    return evidence.groupBy(key).agg(F.count("*").alias("n"), rate(c["bool"].isNotNull()).alias("bool_rate"), rate(c["nat"].isNotNull()).alias("nat_rate"), rate(c["nats"].isNotNull()).alias("list_rate"), rate(c["text"].isNull()).alias("missing_rate"))


def final_type(bool_rate: Column, nat_rate: Column, list_rate: Column, missing_rate: Column, least: float = 0.5) -> Column:
    """The type that most evidence supports: lists before numbers before truth values, text otherwise; Option where some is missing."""
    kind = F.when(list_rate >= least, "List Nat").when(nat_rate >= least, "Nat").when(bool_rate >= least, "Bool").otherwise("String")
    return F.when(missing_rate > 0, F.concat(F.lit("Option "), kind)).otherwise(kind)


def coverage(fields: DataFrame, found: DataFrame, inactive: Column) -> DataFrame:
    """Every field with its value and a status: inactive, present or missing."""
    both = fields.join(found, "field", "left")
    return both.withColumn("status", F.when(inactive, F.lit("inactive")).when(F.col("value").isNotNull(), F.lit("present")).otherwise(F.lit("missing")))


#: Units that amounts are written in, as texts name them.
UNITS = ("million", "crore", "lakh", "%")


def unit(label: Column) -> Column:
    """The unit that a table's label or heading names, else null."""
    low = F.lower(label)
    return F.coalesce(*[F.when(F.contains(low, F.lit(u)), F.lit(u)) for u in UNITS])


def percent_value(text: Column) -> Column:
    """The number before a per cent sign, decimals kept, else null."""
    return F.regexp_extract(F.regexp_replace(text, ",", ""), r"(\d+(?:\.\d+)?)\s*%", 1).try_cast("double")


def table_cells(tables: DataFrame) -> DataFrame:
    """Cells (keys…, label, unit, k, value) of tables with rows (array of struct(label, values, unit)); numbers in Indian or western groups, decimals dropped."""
    keys = [c for c in tables.columns if c != "rows"]
    rows = tables.select(*keys, F.inline("rows"))
    cells = rows.select(*keys, "label", "unit", F.posexplode("values").alias("k", "text"))
    return cells.select(*keys, "label", "unit", "k", T.whole_number(F.col("text")).alias("value"))


def newest(cells: DataFrame, key: list[str], year: str, n: int = 3) -> DataFrame:
    """key and values of the newest `n` years, newest first; a year that is there twice counts twice, larger value first, and a null year is the oldest."""
    listed = F.slice(F.sort_array(F.collect_list(F.struct(year, "value")), asc=False), 1, n)
    return cells.groupBy(*key).agg(listed.alias("v")).select(*key, F.col("v.value").alias("values"))


def field_index(fields: DataFrame) -> DataFrame:
    """Of fields (field, rule_id, reg): field, rule_ids (sorted), n, the name where it is first used, and a note if it was renamed.

    One aggregate; a field of several rules gets its least regulation as a suffix.
    """
    each = fields.groupBy("field").agg(F.array_sort(F.collect_set("rule_id")).alias("ids"), F.min("reg").alias("reg"))
    shared = F.size("ids") > 1
    return each.select("field", F.array_join("ids", ",").alias("rule_ids"), F.size("ids").cast("bigint").alias("n"), F.when(shared, F.concat("field", F.lit("_reg"), "reg")).otherwise(F.col("field")).alias("first_name"), F.when(shared, F.lit("renamed_colliding_field")).alias("note"))


def field_rules(fields: DataFrame) -> DataFrame:
    """Of fields (field, rule_id, reg): field, rule_id and own_name, a row for each rule of a field, the inverted index for fields of any number of rules.

    A field of several rules is named by each rule's regulation.  Counts come
    from partial aggregates; no row holds the rules of a field.
    """
    pairs = fields.groupBy("field", "rule_id").agg(F.min("reg").alias("reg"))
    many = pairs.groupBy("field").agg(F.count("*").alias("n")).where("n > 1").select(F.col("field").alias("shared"))
    named = pairs.join(many, F.col("field") == F.col("shared"), "left")
    return named.select("field", "rule_id", F.when(F.col("shared").isNotNull(), F.concat("field", F.lit("_reg"), F.col("reg").cast("string"))).otherwise(F.col("field")).alias("own_name"))


def mentions(text: Column, field: str, reach: int = 3) -> Column:
    """Array of struct(field, near_number, in_parens): words of a text that `field` (a pattern) finds, one for each blank-separated token.

    A number is near if it is among the `reach` tokens before or after; what
    stands in round brackets is read apart from the rest.
    """
    inside = F.array_join(F.regexp_extract_all(text, F.lit(r"\(([^()]*)\)"), 1), " ")
    outside = F.regexp_replace(text, r"\([^()]*\)", " ")

    def found(part: Column, brackets: bool) -> Column:
        def named(given: Column) -> Column:
            def near(t: Column, k: Column) -> Column:
                around = F.slice(given["digits"], F.greatest(k + 1 - reach, F.lit(1)), k + 2 + reach - F.greatest(k + 1 - reach, F.lit(1)))
                mention = lambda name: F.when(name != "", F.struct(name.alias("field"), F.exists(around, lambda x: x).alias("near_number"), F.lit(brackets).alias("in_parens")))
                return let(F.regexp_extract(t, field, 0), mention)

            return F.filter(F.transform(given["tokens"], near), lambda m: m.isNotNull())

        # A text's tokens, and which of them have digits, are worked out once and not for each token.
        marked = lambda t: F.struct(t.alias("tokens"), F.transform(t, lambda x: x.rlike(r"\d")).alias("digits"))
        return let(let(F.filter(F.split(part, r"\s+"), lambda t: t != ""), marked), named)

    return F.concat(found(outside, False), found(inside, True))


def inverted(maps_to: DataFrame) -> DataFrame:
    """field and rule_ids (sorted, joined by commas) of rules (rule_id, fields)."""
    return maps_to.select("rule_id", F.explode("fields").alias("field")).groupBy("field").agg(F.array_join(F.array_sort(F.collect_set("rule_id")), ",").alias("rule_ids"), F.count_distinct("rule_id").alias("n"))


def schema_sides(schema: DataFrame, rules: str = "from_rules") -> DataFrame:
    """A schema (field, type, `rules`, an array) as rows (rule_id, field, type), so that it joins by rule and field."""
    return schema.select(F.explode(rules).alias("rule_id"), "field", "type").distinct()


def best_evidence(evidence: DataFrame, *order: Column | str) -> DataFrame:
    """Of each rule and field the first piece of evidence in `order`, as `best`, and how many there are, as `pieces`.  One aggregate with partial results."""
    rest = [c for c in evidence.columns if c not in ("rule_id", "field")]
    return evidence.groupBy("rule_id", "field").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("best"), F.count("*").alias("pieces"))


def reconciled(evidence: DataFrame, mappings: DataFrame, schema: DataFrame) -> DataFrame:
    """rule_id, field, pieces, best, type_hint, type, status: evidence, what rules map to, and the schema side by side.

    `evidence` is of `best_evidence`, `mappings` (rule_id, field, type_hint) of
    the rules, `schema` (rule_id, field, type) of `schema_sides`; each has a
    rule and field once.  All three meet on rule and field in one step: rows of
    the three are grouped by both, so a field that most rules share is divided
    by rule, and what only one or two sides know stays.  `status` says what is
    amiss, worst first: unmapped (the rule doesn't name the field),
    not_in_schema, no_evidence, type_differs, else complete.  A null rule or
    field is one like any other.
    """
    none = lambda kind: F.lit(None).cast(kind)
    best = evidence.schema["best"].dataType
    sides = (
        evidence.select("rule_id", "field", "best", "pieces", none("string").alias("type_hint"), none("string").alias("type"), F.lit(1).alias("side"))
        .unionByName(mappings.select("rule_id", "field", none(best).alias("best"), none("bigint").alias("pieces"), "type_hint", none("string").alias("type"), F.lit(2).alias("side")))
        .unionByName(schema.select("rule_id", "field", none(best).alias("best"), none("bigint").alias("pieces"), none("string").alias("type_hint"), "type", F.lit(4).alias("side")))
    )
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in ("best", "type_hint", "type")]
    met = sides.groupBy("rule_id", "field").agg(*firsts, F.coalesce(F.max("pieces"), F.lit(0)).alias("pieces"), F.bit_or("side").alias("sides"))
    has = lambda side: F.col("sides").bitwiseAND(side) != 0
    status = F.when(~has(2), "unmapped").when(~has(4), "not_in_schema").when(~has(1), "no_evidence").when(~F.col("type_hint").eqNullSafe(F.col("type")), "type_differs").otherwise("complete")
    return met.select("rule_id", "field", "pieces", "best", "type_hint", "type", status.alias("status"))
