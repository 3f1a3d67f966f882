"""The mix of sources against a plain loop."""

import hashlib
import random
import re

import pytest

from rulewright.llm import mixing, running


def plainly(docs, weights=(5, 2, 1), most=3):
    """{source: target} by sharing anew until none is above its cap, and {(doc_id, size): taken} by walking along each source."""
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), t) for d, t, s in docs]
    sources = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, x, n, _ in sized if x == s) for s in sources}
    weight, target, free = {s: weights[k % len(weights)] for k, s in enumerate(sources)}, dict.fromkeys(sources, 0.0), set(sources)
    left = float(sum(size.values()))
    while free and left > 1e-9:
        share, left_weight = left, sum(weight[s] for s in free)
        for s in [*free]:
            target[s] += share * weight[s] / left_weight
            left -= share * weight[s] / left_weight
        for s in [*free]:
            if target[s] >= most * size[s]:
                left += target[s] - most * size[s]
                target[s] = float(most * size[s])
                free.discard(s)
    taken = []
    for s in sources:
        name = lambda d, t: str(d) if d is not None else "null:" + hashlib.md5((t or "").encode()).hexdigest()
        own = sorted((hashlib.md5(("mix:" + name(d, t)).encode()).hexdigest()[:15], -1 if d is None else d, n) for d, x, n, t in sized if x == s)
        budget, done = min(int(target[s] + 0.5), most * size[s]), 0
        laps = budget // size[s] if size[s] else 0
        for _, d, n in own:
            taken.append((d, s, n, laps * n + max(0, min(n, budget - laps * size[s] - done))))
            done += n
    return target, taken


@pytest.fixture
def sourced(spark):
    def make(rows):
        schema = "doc_id long, text string, source string, size string, key string, rank string, bucket string, target string, n_chars long"
        return spark.createDataFrame([(*r, "s", "k", "r", "b", "t", 1) for r in rows], schema)

    return make


def check(got, docs):
    target, taken = plainly(docs)
    rows = got.collect()
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["source"], r["size"], r["taken"]) for r in rows), key=str) == sorted(taken, key=str)
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in target:
        assert sum(r["taken"] for r in rows if r["source"] == s) == pytest.approx(target[s], abs=0.51)


def test_a_hot_source_and_small_ones_that_reach_their_caps(sourced):
    chance = random.Random(3)
    docs = [(k, "w " * chance.randint(0, 30), chance.choices(["a", "b", "c", "d", None, "é"], [60, 1, 20, 1, 2, 3])[0]) for k in range(700)]
    check(mixing.mix(sourced(docs)), docs)


def test_nulls_empty_texts_ties_and_repeated_rows(sourced):
    docs = [(1, "one two", "a"), (1, "one two", "a"), (1, "x", "a"), (2, None, "a"), (None, "five words are in here", "b"), (None, "and three here", "b"), (None, None, None), (3, "\t \n", None), (4, "nbsp is a letter", "b"), (5, "long " * 50_000, "c")]
    check(mixing.mix(sourced(docs)), docs)


def test_sources_without_words_and_empty_tables(sourced):
    none = mixing.mix(sourced([(1, "", "a"), (2, None, None)])).collect()
    assert [(r["target"], r["taken"], r["size"]) for r in none] == [(0.0, 0, 0)] * 2
    assert mixing.mix(sourced([(1, "", "a")]).limit(0)).count() == 0


def test_reruns_agree_however_rows_are_dealt(sourced):
    docs = sourced([(k, "w " * (k % 13), "ab"[k % 3 == 0]) for k in range(300)])
    first = sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.coalesce(1)).collect()))


def test_main_path_runs_no_python(sourced):
    plan = mixing.mix(sourced([(1, "a b", "a")]))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Pandas|Arrow|MapInBatch|PhysicalRDD", plan.split("== Physical Plan ==")[1])


def test_places_and_sums_along_an_order(spark):
    values = [(random.Random(k).randint(0, 9), k) for k in range(500)] + [(None, 500)]
    rows = spark.createDataFrame(values, "x int, k int").repartition(5)
    from pyspark.sql import functions as F

    by = (F.col("x").asc_nulls_last(), F.col("k").asc())
    ordered = sorted(values, key=lambda v: (v[0] is None, v[0] or 0, v[1]))
    got = {r["k"]: r["rank"] for r in running.numbered(rows, *by, parts=6).collect()}
    assert got == {k: n for n, (_, k) in enumerate(ordered)}
    sums = {r["k"]: r["s"] for r in running.summed(rows, *by, parts=6, s=F.col("k")).collect()}
    assert sums == {k: sum(v for _, v in ordered[:n]) for n, (_, k) in enumerate(ordered)}
