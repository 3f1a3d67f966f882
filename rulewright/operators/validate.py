"""Validation of rule records: required members, repeated ids, JSON Schema as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import spans

IDENTIFIER = "^[A-Za-z_][A-Za-z0-9_]*$"
FIELD_NAME = "^[a-z][a-z0-9_]*$"


def missing(columns: list[str]) -> Column:
    """The names of required members that are null or empty, in order."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in columns]))


def repeated(records: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key an earlier row has, with the place of the first."""
    return records.withColumn("first_seen", first_seen(key, order)).where("first_seen is not null")


def first_seen(key: str, order: str) -> Column:
    """The place of the first row with the key of a row that isn't the first itself; a null key is a key like any other."""
    w = Window.partitionBy(key).orderBy(order)
    return F.when(F.row_number().over(w) > 1, F.first(order).over(w))


def summary(records: DataFrame, key: str, required: list[str]) -> DataFrame:
    """One row: records, ids that repeat another record's, and records with members missing."""
    each = records.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.size(missing(required)) > 0).alias("m"))
    return each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in ((F.col("n"), "records"), (F.col("n") - 1, "duplicates"), (F.col("m"), "incomplete"))])


def missing_counts(records: DataFrame, required: list[str]) -> DataFrame:
    """member and records: how many records miss each required member; members that none misses aren't there."""
    return records.select(F.explode(missing(required)).alias("member")).groupBy("member").agg(F.count("*").alias("records"))


def kept_first(records: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row per key, the first in order."""
    w = Window.partitionBy(key).orderBy(*order)
    return records.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def errors(schema: dict, value: Column, path: str = "") -> list[Column]:
    """JSON Schema as columns that are null or a message; type and additionalProperties are of JSON texts, by `raw_errors` and, inside lists too, `document_errors`.

    Known: required, enum, const, pattern, minimum, maximum, minLength,
    maxLength, minItems, uniqueItems, properties, items (of objects' members);
    a list's entries tell all their messages.
    """
    out, name = [], path or "record"
    for member in schema.get("required", []):
        out.append(F.when(value[member].isNull(), F.lit(f"{name}: missing {member}")))
    for member, sub in schema.get("properties", {}).items():
        out += errors(sub, value[member], f"{path}.{member}".lstrip("."))
    checks = {
        "enum": lambda x: ~value.isin(x),
        "const": lambda x: value != F.lit(x),
        "pattern": lambda x: ~value.rlike(x),
        "minimum": lambda x: value < x,
        "maximum": lambda x: value > x,
        "minLength": lambda x: F.length(value) < x,
        "maxLength": lambda x: F.length(value) > x,
        "minItems": lambda x: F.size(value) < x,
        "uniqueItems": lambda x: (F.size(F.array_distinct(value)) < F.size(value)) & F.lit(x),
    }
    for key, wrong in checks.items():
        if key in schema:
            out.append(F.when(value.isNotNull() & wrong(schema[key]), F.lit(f"{name}: {key}")))
    if "items" in schema:
        found = lambda x: F.array_compact(F.array(*errors(schema["items"], x, f"{name}[]"), F.lit(None).cast("string")))
        out.append(F.nullif(F.array_join(F.flatten(F.transform(value, found)), "|"), F.lit("")))
    return out


#: What a variant calls the types of JSON Schema.
_KINDS = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*", "null": "VOID"}


def raw_errors(schema: dict, text: Column, path: str = "$") -> list[Column]:
    """The types and closed objects of a JSON Schema, of JSON texts: columns that are null or a message; texts that don't parse have none."""
    value = F.try_variant_get(F.try_parse_json(text), path, "variant")
    name, out = path[2:] or "record", []
    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        out.append(F.when(~F.schema_of_variant(value).rlike(f"^(?:{'|'.join(_KINDS[k] for k in kinds)})$"), F.lit(f"{name}: type")))
    if schema.get("additionalProperties") is False:
        there = F.json_object_keys(F.to_json(value))
        more = F.array_except(there, F.lit([*schema.get("properties", {})]).cast("array<string>"))
        out.append(F.when(F.size(more) > 0, F.concat(F.lit(f"{name}: additionalProperties "), F.array_join(more, ","))))
    for member, sub in schema.get("properties", {}).items():
        out += raw_errors(sub, text, f"{path}.{member}")
    return out


def span_match(text: Column, hint: Column, most: int = 0) -> Column:
    """``strict`` if a text holds a hint as it is, ``lenient`` in lower case with single spaces, ``fuzzy`` if all but `most` of its words occur, else ``none``."""
    flat = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    words = F.array_distinct(F.split(flat(hint), " "))
    absent = F.size(F.array_except(words, F.split(flat(text), " ")))
    return F.when(F.contains(text, hint), F.lit("strict")).when(F.contains(flat(text), flat(hint)), F.lit("lenient")).when(absent <= most, F.lit("fuzzy")).otherwise(F.lit("none"))


def flat(text: Column) -> Column:
    """A text in lower case with single spaces and none at its ends."""
    return F.regexp_replace(F.lower(F.trim(text)), r"\s+", " ")


def placed_span(text: Column, hint: Column, share: float = 0.125) -> Column:
    """struct(kind, start, end, edits): where a text holds a hint.

    ``strict`` if it holds it as it is, ``lenient`` if in lower case with single
    spaces, ``fuzzy`` if with at most `share` of the hint's characters edited
    (put in, left out or replaced), else ``none``, without a place.  Places are
    code points of the flat text, the end exclusive.  A null text or hint has
    ``none``; an empty hint is found at 0.
    """

    def found(g: Column) -> Column:
        at = F.instr(g["text"], g["hint"]) - 1
        kind = F.when(F.contains(text, hint), "strict").when(at >= 0, "lenient")
        fuzzy = F.transform(F.array(spans.nearest_span(g["text"], g["hint"], F.floor(F.length(g["hint"]) * share))), lambda s: F.struct(F.when(s.isNotNull(), "fuzzy").otherwise("none").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["edits"].alias("edits")))[0]
        exact = F.struct(kind.alias("kind"), at.alias("start"), (at + F.length(g["hint"])).alias("end"), F.lit(0).alias("edits"))
        return F.when(g["hint"] == "", F.struct(F.lit("strict").alias("kind"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("edits"))).when(at >= 0, exact).otherwise(fuzzy)

    none = F.struct(F.lit("none").alias("kind"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("int").alias("edits"))
    given = F.struct(flat(text).alias("text"), flat(hint).alias("hint"))
    return F.when(text.isNull() | hint.isNull(), none).otherwise(F.transform(F.array(given), found)[0])


def document_errors(schema: dict, text: Column) -> Column:
    """Array of ``path: what is wrong`` of a JSON text against a JSON Schema, entries of lists by their place (``maps_to[2].field``).

    The text is read as a variant and walked as the schema says, lists entry by
    entry, so types, closed objects and required members are judged at every
    depth as they are written; the order is that of the schema.  Known: type,
    required, additionalProperties (false), properties, items, enum, const (of
    texts), pattern, minimum, maximum, minLength, maxLength, minItems, maxItems
    and uniqueItems; each holds only for values of the kind that it speaks of.
    A text that doesn't parse has ``record: no JSON``, a null one no errors.
    """
    found = F.transform(F.array(F.try_parse_json(text)), lambda v: F.when(v.isNull(), F.array(F.lit("record: no JSON"))).otherwise(_walked(schema, v, F.lit(""))))
    return F.when(text.isNull(), F.expr("cast(array() as array<string>)")).otherwise(found[0])


def _into(schema: dict, path: Column):
    return lambda value: _walked(schema, value, path)


def _walked(schema: dict, value: Column, path: Column) -> Column:
    name, kind = F.when(path == "", "record").otherwise(path), F.schema_of_variant(value)
    of = lambda *kinds: kind.rlike(f"^(?:{'|'.join(_KINDS[k] for k in kinds)})$")
    member = lambda m: F.try_variant_get(value, f"$.{m}", "variant")
    text, number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    entries = F.try_variant_get(value, "$", "array<variant>")
    alone = []
    if "type" in schema:
        alone.append((~of(*([schema["type"]] if isinstance(schema["type"], str) else schema["type"])), "type"))
    alone += [(of("object") & member(m).isNull(), f"missing {m}") for m in schema.get("required", [])]
    texts, lists = of("string"), of("array")
    rules = {
        "enum": lambda x: texts & ~text.isin(x), "const": lambda x: texts & (text != x), "pattern": lambda x: texts & ~text.rlike(x),
        "minLength": lambda x: texts & (F.length(text) < x), "maxLength": lambda x: texts & (F.length(text) > x),
        "minimum": lambda x: of("number") & (number < x), "maximum": lambda x: of("number") & (number > x),
        "minItems": lambda x: lists & (F.size(entries) < x), "maxItems": lambda x: lists & (F.size(entries) > x),
        "uniqueItems": lambda x: lists & F.lit(x) & (F.size(F.array_distinct(F.transform(entries, lambda x: F.to_json(x)))) < F.size(entries)),
    }
    alone += [(wrong(schema[rule]), rule) for rule, wrong in rules.items() if rule in schema]
    said = [F.when(wrong, F.concat(name, F.lit(f": {what}"))) for wrong, what in alone]
    if schema.get("additionalProperties") is False:
        more = F.array_except(F.json_object_keys(F.to_json(value)), F.lit([*schema.get("properties", {})]).cast("array<string>"))
        said.append(F.when(of("object") & (F.size(more) > 0), F.concat(name, F.lit(": additionalProperties "), F.array_join(more, ","))))
    none = F.expr("cast(array() as array<string>)")
    parts = [F.array_compact(F.array(*said, F.lit(None).cast("string")))]
    for m, sub in schema.get("properties", {}).items():
        inner = F.concat(F.when(path == "", "").otherwise(F.concat(path, F.lit("."))), F.lit(m))
        parts.append(F.when(of("object") & member(m).isNotNull(), F.transform(F.array(member(m)), _into(sub, inner))[0]).otherwise(none))
    if "items" in schema:
        each = F.transform(entries, lambda v, k: _walked(schema["items"], v, F.concat(name, F.lit("["), k.cast("string"), F.lit("]"))))
        parts.append(F.when(lists, F.flatten(each)).otherwise(none))
    return F.concat(*parts)
