"""Enrichment of rule records: classes, scopes, places in the hierarchy, parents, types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def hits(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the words a text has, in lower case."""
    low = F.lower(text)
    return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))


def best_class(text: Column, classes: dict[str, tuple[str, ...]], default: str) -> Column:
    """The class most of whose words a text has; of equals the first listed, without any the default."""
    scores = {name: hits(text, words) for name, words in classes.items()}
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    return F.coalesce(*[F.when((s == best) & (s > 0), F.lit(name)) for name, s in scores.items()], F.lit(default))


#: Classes of rules, and of who must comply, with their words.
RULE_TYPES = {
    "eligibility": ("eligible", "eligibility", "shall not be eligible", "ineligible"),
    "disclosure": ("disclose", "disclosure", "shall contain", "shall include"),
    "lock_in": ("lock-in", "locked-in", "not be transferable", "lock in"),
    "pricing": ("price", "pricing", "floor price", "price band"),
    "promoter_contribution": ("promoter", "promoters' contribution", "minimum contribution"),
    "procedural": ("shall file", "shall submit", "shall furnish", "shall obtain"),
    "prohibition": ("shall not", "prohibited", "shall not be eligible", "debarred"),
    "allotment": ("allotment", "allot", "basis of allotment"),
}
ACTORS = {
    "issuer": ("issuer", "the issuer shall"),
    "promoter": ("promoter", "promoters'", "promoter group"),
    "lead_manager": ("lead manager", "merchant banker", "book running"),
    "board_of_directors": ("board of directors", "board of the issuer"),
    "selling_shareholder": ("selling shareholder",),
}
#: What a chapter applies to.
SCOPES = {
    "II": "IPO", "III": "rights_issue", "IV": "FPO", "V": "preferential_issue", "VI": "QIP", "VII": "IDR_IPO",
    "VIII": "IDR_rights", "IX": "SME_IPO", "X": "ITP", "XI": "bonus_issue",
}


def rule_type(text: Column) -> Column:
    return best_class(text, RULE_TYPES, "general")


def actor(text: Column) -> Column:
    return best_class(text, ACTORS, "issuer")


def condition_type(text: Column) -> Column:
    """A prohibition's words come before an exception's; null and other texts require something."""
    prohibited, excepted = hits(text, ("shall not", "prohibited", "debarred")), hits(text, ("provided that", "nothing contained"))
    return F.when(prohibited > 0, "prohibition").when(excepted > 0, "carve_out").otherwise("positive_requirement")


def scopes(chapter: Column) -> Column:
    """What a rule of a chapter (Roman number) applies to, as a list; ``general`` for other chapters and null."""
    return F.array(lookup(chapter, SCOPES, "general"))


def lookup(value: Column, table: dict[str, str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), value), F.lit(default))


def with_hierarchy(rules: DataFrame, places: DataFrame, rule_id: str = "rule_id") -> DataFrame:
    """`rules` with number and the columns of `places` (reg, …); what isn't found, null ids included, has nulls.

    Of clashing names, the new columns replace those of `rules`.  The
    dimension is small; Spark broadcasts it by its size.
    """
    new = {"number", *places.columns}
    placed = rules.select(*[F.col(f"`{c}`") for c in rules.columns if c not in new or c == rule_id], T.dotted_number(F.col(rule_id)).alias("number"), T.top_regulation(F.col(rule_id)).alias("reg"))
    return placed.join(places, "reg", "left")


def with_parents(rules: DataFrame, rule_id: str = "rule_id", text: str = "text") -> DataFrame:
    """`rules` with proviso and exception_to: of a proviso, the id without suffix if there is such a rule, else the id without its last segment if there is.

    All columns of `rules` stay, but for two of those names; a null id or text is no proviso and has no parent.
    """
    ids = rules.select(F.col(rule_id).alias("_known")).where("_known is not null").distinct()
    bare, short = T.parent_ids(F.col(rule_id))
    proviso = F.coalesce(T.is_proviso(F.col(text)), F.lit(False))
    asked = rules.withColumns({"_proviso": proviso, "_bare": F.when(proviso, bare), "_short": F.when(proviso, short)})
    asked = asked.join(ids.select(F.col("_known").alias("_bare"), F.col("_known").alias("_first")), "_bare", "left")
    asked = asked.join(ids.select(F.col("_known").alias("_short"), F.col("_known").alias("_second")), "_short", "left")
    kept = [F.col(f"`{c}`") for c in rules.columns if c not in ("proviso", "exception_to")]
    return asked.select(*kept, F.col("_proviso").alias("proviso"), F.coalesce("_first", "_second").alias("exception_to"))


def yearly_types(maps_to: Column, text: Column) -> Column:
    """Number fields of a rule about several years become lists, with the length in front of their constraints if it isn't there yet."""
    years, length = T.years_named(text), F.concat(F.lit("length="), T.years_named(text).cast("string"))

    def listed(m: Column) -> Column:
        had = F.coalesce(m["constraints_text"], F.lit(""))
        return F.struct(m["field"].alias("field"), F.lit("List Nat").alias("type_hint"), F.when(F.contains(had, length), had).when(had == "", length).otherwise(F.concat(length, F.lit("; "), had)).alias("constraints_text"))

    return F.transform(maps_to, lambda m: F.when(years.isNotNull() & (m["type_hint"] == "Nat"), listed(m)).otherwise(m))


def yearly_notes(maps_to: Column, text: Column) -> Column:
    """The repair notes of `yearly_types`, one for each field that it changes."""
    years = T.years_named(text)
    changed = F.filter(maps_to, lambda m: years.isNotNull() & (m["type_hint"] == "Nat"))
    return F.transform(changed, lambda m: F.concat(F.lit("type_override:Nat->ListNat(n="), years.cast("string"), F.lit(")_for_"), F.coalesce(m["field"], F.lit(""))))
