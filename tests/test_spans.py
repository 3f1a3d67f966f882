"""Fuzzy spans against the dynamic programme written out."""

import random

from pyspark.sql import functions as F

from rulewright.functions import spans
from rulewright.operators import validate


def columns(text, hint, anchored):
    """The last row of the programme, one entry for each end."""
    col = [*range(len(hint) + 1)]
    out = [col[-1]]
    for j, c in enumerate(text, 1):
        new = [j if anchored else 0]
        for i, h in enumerate(hint, 1):
            new.append(min(col[i] + 1, new[-1] + 1, col[i - 1] + (h != c)))
        col = new
        out.append(col[-1])
    return out


def plainly(text, hint, most):
    if text is None or hint is None:
        return None
    if not hint:
        return (0, 0, 0)
    costs = columns(text, hint, False)
    edits = min(costs)
    if edits > most:
        return None
    end = costs.index(edits)
    return (end - columns(text[:end][::-1], hint[::-1], True).index(edits), end, edits)


def test_spans_of_all_sizes_and_distances(spark):
    chance, rows = random.Random(4), []
    for k in range(300):
        text = "".join(chance.choice("abcd é😀") for _ in range(chance.choice([0, 1, 7, 60, 250])))
        m = chance.choice([0, 1, 4, 12, 59, 60, 61, 121, 180])
        hint = list(text[(s := chance.randint(0, max(0, len(text) - m))) : s + m]) if chance.random() < 0.7 else [chance.choice("abcd é") for _ in range(m)]
        for _ in range(chance.randint(0, 5)):
            at = chance.randint(0, len(hint))
            hint[at : at + chance.randint(0, 1)] = chance.choice(["", "a", "zz", "é"])
        rows.append((k, text, "".join(hint), chance.choice([0, 1, 3, 8, 500])))
    rows += [(300, None, "a", 1), (301, "a", None, 1), (302, None, None, 1), (303, "x" * 40_000 + "hint that is here" + "y" * 40_000, "hint taht is here", 2)]
    df = spark.createDataFrame(rows, "k int, text string, hint string, most int").repartition(4)
    got = {r["k"]: r["s"] and tuple(r["s"]) for r in df.select("k", spans.nearest_span(F.col("text"), F.col("hint"), F.col("most")).alias("s")).collect()}
    assert got == {k: plainly(t, h, most) for k, t, h, most in rows}
    assert sum(x is not None and x[2] > 0 for x in got.values()) > 40


def test_spans_lie_in_the_windows_of_pieces(spark):
    """Pieces that overlap themselves, stand at the edges or many times, and hold what patterns have signs for."""
    chance, rows = random.Random(5), []
    for k in range(250):
        letters = chance.choice(["a", "ab", r"\EQ[.]", "é😀x"])
        m = chance.choice([8, 16, 30, 70])
        hint = "".join(chance.choice(letters) for _ in range(m))
        near = "".join(c for c in hint if chance.random() > 0.1)
        text = "".join(chance.choice([near, hint[: m // 2], hint[m // 3 :], "--" * m, "".join(chance.choice(letters) for _ in range(m))]) for _ in range(chance.randint(1, 6)))
        rows.append((k, text, hint, chance.choice([1, 3, m // 8, m // 4])))
    df = spark.createDataFrame(rows, "k int, text string, hint string, most int").repartition(4)
    got = {r["k"]: r["s"] and tuple(r["s"]) for r in df.select("k", spans.nearest_span(F.col("text"), F.col("hint"), F.col("most")).alias("s")).collect()}
    assert got == {k: plainly(t, h, most) for k, t, h, most in rows}


def test_work_is_around_the_pieces_of_a_hint(spark):
    from time import monotonic

    def seconds(hint):
        df = spark.createDataFrame([(k, f"{'lorem ipsum ' * 20_000}hint that is here{' dolor sit' * 20_000}", hint) for k in range(8)], "k int, text string, hint string").repartition(4)
        began = monotonic()
        assert df.select(spans.nearest_span(F.col("text"), F.col("hint"), F.lit(2)).alias("s")).where("s.edits = 2 and s.start = 240000").count() == 8
        return monotonic() - began

    seconds("hint taht is here")
    assert seconds("hint taht is here") < 8


def test_kinds_of_spans(spark):
    rows = [("The  quick brown fox", "quick brown"), ("The  QUICK brown fox", "the quick Brown"), ("The quick brown fox jumps", "quikc brown fox"), ("The quick brown fox", "lazy dog"), ("", "a"), ("a", ""), (None, "a"), ("a", None), ("", "")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, text string, hint string")
    got = [tuple(r["s"]) for r in df.select("k", validate.placed_span(F.col("text"), F.col("hint"), 0.2).alias("s")).orderBy("k").collect()]
    none = ("none", None, None, None)
    assert got == [("strict", 4, 15, 0), ("lenient", 0, 15, 0), ("fuzzy", 4, 19, 2), none, none, ("strict", 0, 0, 0), none, none, ("strict", 0, 0, 0)]
