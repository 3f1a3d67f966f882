"""Headings carried over pages, windows of regulations, anchors."""

import random

import pytest

from rulewright.operators import sections


@pytest.mark.parametrize(("width", "depth"), [(512, 2), (3, 2), (2, 3), (7, 1), (4, 0)])
@pytest.mark.parametrize("inclusive", [True, False])
def test_carried_over_stretches(spark, width, depth, inclusive):
    chance = random.Random(width)
    rows = [(g, p, chance.choice([None, None, None, "a", "b", "c"])) for g in ("x", "y") for p in chance.sample(range(1, 200), 120 if g == "x" else 9)]
    rows += [("x", 50, "z"), ("x", 50, None), (None, 3, "n"), ("y", None, "m"), ("y", None, None)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, g string, p int, v string").repartition(3)
    got = {r["k"]: r["held"] for r in sections.carried(df, "g", "p", "v", "held", inclusive, width, depth).collect()}
    for k, (g, p, v) in enumerate(rows):
        if g is None or p is None:
            want = v if inclusive else None
        else:
            seen = [(q, w) for h, q, w in rows if h == g and q is not None and w is not None and (q <= p if inclusive else q < p)]
            want = max(seen)[1] if seen else None
        assert got[k] == want, (k, rows[k])
    assert len(got) == len(rows)


def test_pages_windows_and_anchors(spark):
    text = {1: "preface", 2: "Regulation 4: A\nbody\nRegulation 5: B", 3: "more of it", 4: "and more\nRegulation 6. C", 6: None, 7: "Regulation 5: again\nRegulation 5: again"}
    pages = spark.createDataFrame([("d", p, t, "x") for p, t in text.items()] + [("e", 3, "nothing", "x"), (None, 1, "Regulation 9: Z", "x")], "doc string, page int, text string, regulations_of string")
    found = sections.in_force(pages, "doc", "page")
    assert {(r["doc"], r["page"]): r["regulations"] for r in found.collect()} == {
        ("d", 1): [], ("d", 2): ["4", "5"], ("d", 3): ["5"], ("d", 4): ["5", "6"], ("d", 6): ["6"], ("d", 7): ["6", "5"], ("e", 3): [], (None, 1): ["9"],
    }
    windows = sections.window_regulations(sections.page_windows(found, "doc", "page", 2, 1), "doc")
    assert {(r["doc"], r["start"]): r["regulations"] for r in windows.collect()} == {("d", 1): ["4", "5"], ("d", 2): ["4", "5"], ("d", 3): ["5", "6"], ("d", 4): ["5", "6"], ("d", 5): ["6"], ("d", 6): ["5", "6"], ("d", 7): ["5", "6"], ("e", 3): []}
    claims = spark.createDataFrame([(1, "d", 3, "5"), (2, "d", 3, "4"), (3, "d", 5, "6"), (4, "d", None, "5"), (5, "d", 3, None), (6, None, 1, "9"), (7, "e", 3, "5")], "k int, doc string, page int, reg string")
    got = {r["k"]: (r["anchored"], r["anchor_failure"]) for r in sections.anchored(claims, found.unionAll(found), "doc", "page", "reg").collect()}
    assert got == {1: (True, None), 2: (False, "soft:anchor"), 3: (False, "soft:no_page"), 4: (False, "soft:no_page"), 5: (False, "soft:anchor"), 6: (False, "soft:no_page"), 7: (False, "soft:anchor")}
    assert sections.in_force(pages.limit(0), "doc", "page").count() == 0
