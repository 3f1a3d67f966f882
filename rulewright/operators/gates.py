"""Propositions and gates over filings: their values, what a gate fails on, and how filings fare by regulation, part and chapter.

Each proposition is a column, computed once however many gates apply it; gates
are columns over those, level by level.  A filing stays one row, so there is no
shuffle but for counts over filings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.propositions import Library, Proposition, column


def with_values(filings: DataFrame, library: Library, *keep: str) -> DataFrame:
    """`keep` and a nullable Boolean column (named by `column`) for every proposition; only the fields that are read stay in between."""
    out = filings.select(*keep, *[c for c in sorted(library.fields) if c not in keep])
    for level in library.levels:
        out = out.withColumns({column(p.name): F.expr(p.sql) for p in level})
    return out.select(*keep, *[F.col(f"`{column(p.name)}`") for p in library.propositions])


def _place(p: Proposition) -> list[Column]:
    text = lambda value: F.lit(value).cast("string")
    return [F.lit(p.name).alias("name"), F.lit(p.kind).alias("kind"), text(p.chapter).alias("chapter"), text(p.part).alias("part"), text(p.regulation).alias("regulation")]


def verdicts(filings: DataFrame, library: Library, key: str = "issuer_id") -> DataFrame:
    """key, name, kind, chapter, part, regulation, value: a row for each filing and proposition; value is null where it is unknown."""
    values = [F.struct(*_place(p), F.col(f"`{column(p.name)}`").alias("value")) for p in library.propositions]
    return with_values(filings, library, key).select(key, F.inline(F.array(*values)))


def gates(filings: DataFrame, library: Library, key: str = "issuer_id") -> DataFrame:
    """key, name, chapter, part, regulation, value, failing, unknown: a row for each filing and gate, with the names of its members that fail and that are unknown.

    A gate with a failing member fails, whatever is unknown; one with none
    failing and some unknown is unknown itself, if it is a conjunction.
    """
    rows = []
    for p in library.gates:
        named = lambda when: F.array_compact(F.array(*[F.when(when(F.col(f"`{column(m)}`")), F.lit(m)) for m in p.members]))  # noqa: B023, E731
        rows.append(F.struct(*[c for k, c in enumerate(_place(p)) if k != 1], F.col(f"`{column(p.name)}`").alias("value"), named(lambda v: ~v).alias("failing"), named(lambda v: v.isNull()).alias("unknown")))
    return with_values(filings, library, key).select(key, F.inline(F.array(*rows)))


def counted(long: DataFrame, *by: str) -> DataFrame:
    """For each of `by` (of `verdicts` or `gates`): filings that pass, fail and are unknown.  Sums by task, then by group."""
    value = F.col("value")
    return long.groupBy(*by).agg(F.count_if(value).alias("passed"), F.count_if(~value).alias("failed"), F.count_if(value.isNull()).alias("unknown"))


def rolled_up(long: DataFrame) -> DataFrame:
    """chapter, part, regulation, level, members, failed, unknown, passed over all verdicts, and the same for each part, each chapter and the whole.

    `passed` is false if a member fails for any filing, null if none does and
    some are unknown, else true: the gates of the hierarchy over all filings.
    """
    members = long.where("kind <> 'gate'").rollup("chapter", "part", "regulation")
    sums = members.agg(F.grouping_id().alias("level"), F.count("*").alias("members"), F.count_if(~F.col("value")).alias("failed"), F.count_if(F.col("value").isNull()).alias("unknown"))
    return sums.withColumn("passed", F.when(F.col("failed") > 0, F.lit(False)).when(F.col("unknown") > 0, F.lit(None)).otherwise(F.lit(True)))
