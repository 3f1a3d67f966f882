"""Schemas of filings: fields with types and defaults, null handling, envelopes."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import valid_json

#: Written types, blanks removed, and their Spark types; an optional type is the type itself, nullable.
TYPES = {"Bool": "boolean", "Nat": "bigint", "ListNat": "array<bigint>", "String": "string", "ListString": "array<string>", "ListBool": "array<boolean>", "List": "array<bigint>"}
_DEFAULTS = {"boolean": "false", "bigint": "0L", "string": "''"}


def spark_type(written: str) -> tuple[str, bool]:
    """(Spark type, optional) of a written type; blanks, brackets and the place of ``Option`` vary between sources."""
    if re.match(r"array<|struct<", written):  # of entries with members of their own
        return written, False
    bare = re.sub(r"[\s()]", "", written)
    optional = "Option" in bare
    bare = bare.replace("Option", "")
    if bare not in TYPES:
        raise ValueError(f"unknown type: {written}")
    return TYPES[bare], optional


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str
    optional: bool = False

    @property
    def default(self) -> str:
        return _DEFAULTS.get(self.type, f"cast(array() as {self.type})")


@dataclass(frozen=True)
class Schema:
    fields: tuple[FieldSpec, ...]

    @classmethod
    def of(cls, **types: str) -> Schema:
        return cls(tuple(FieldSpec(name, *spark_type(t)) for name, t in types.items()))

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)

    def filled(self, get=F.col, strict: bool = False) -> list[Column]:
        """The fields with nulls as defaults; `strict` keeps the nulls of optional fields, which collapse to defaults otherwise."""
        return [(get(f.name).cast(f.type) if strict and f.optional else F.coalesce(get(f.name).cast(f.type), F.expr(f.default))).alias(f.name) for f in self.fields]

    def normalise(self, df: DataFrame, *keep: str, strict: bool = False) -> DataFrame:
        """`df` with exactly these fields, missing columns and nulls filled, besides the columns in `keep`."""
        have = set(df.columns)
        return df.select(*keep, *self.filled(lambda name: F.col(name) if name in have else F.lit(None), strict))

    def decode(self, text: Column, strict: bool = False) -> Column:
        """A JSON object as a struct of these fields, defaults filled; unknown keys are ignored, and an envelope gives its ``fields``.

        `strict` makes a struct with a null field where a key is missing.
        """
        inner = F.get_json_object(text, "$.fields")
        envelope = F.get_json_object(text, "$.issuer_id").isNotNull() & inner.isNotNull()
        parsed = F.from_json(F.when(envelope, inner).otherwise(text), self.ddl)
        if strict:
            return parsed
        return F.when(valid_json(text), F.struct(*self.filled(lambda name: parsed[name])))

    def problem(self, text: Column) -> Column:
        """Null for a decodable filing, else ``invalid JSON`` or ``invalid filing`` (a required field missing, or a negative number)."""
        parsed = self.decode(text, strict=True)
        required = [parsed[f.name].isNull() for f in self.fields if not f.optional]
        negative = [parsed[f.name] < 0 for f in self.fields if f.type == "bigint"]
        bad = F.coalesce(F.array_max(F.array(*required, *negative, F.lit(False))), F.lit(True))
        return F.when(~valid_json(text), F.lit("invalid JSON")).when(bad, F.lit("invalid filing"))


def coverage(schema: Schema, get=F.col) -> Column:
    """How many fields are there at all: 0 marks a filing that would be judged on defaults alone."""
    return sum((get(f.name).isNotNull().cast("int") for f in schema.fields), F.lit(0))


#: Fields of the core form.
CORE = Schema.of(
    **dict.fromkeys(
        (
            "is_debarred", "has_debarred_directors", "is_fraudulent", "is_fugitive", "has_outstanding_convertibles", "has_esop_exemption",
            "has_sar_exemption", "has_mandatory_convertibles", "used_monetary_assets", "is_offer_for_sale_only", "changed_name_recently",
            "applied_to_stock_exchange", "has_demat_agreement", "promoter_securities_demat", "no_partly_paid_shares",
            "uses_book_building", "qib_allocation_done", "is_tech_firm", "sr_holder_exec", "sr_same_face_value", "sr_issued_3mo_prior",
            "finance_75_percent_done", "shares_fully_paid", "is_govt_entity", "via_merger_scheme", "is_bonus_from_free_reserve",
            "underlying_held_1y", "bonus_not_from_revaluation",
        ),
        "Bool",
    ),
    **dict.fromkeys(("net_tangible_assets", "operating_profits", "net_worths"), "List Nat"),
    **dict.fromkeys(
        ("monetary_asset_ratio", "percent_revenue_from_new_name", "general_corp_purpose_ratio", "sr_net_worth", "sr_voting_ratio", "sr_class_count", "shares_held_duration_months"),
        "Nat",
    ),
)
