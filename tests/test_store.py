"""The rule store, and the best record of each signature."""

import pytest
from pyspark.sql import functions as F

from rulewright.operators import quality
from rulewright.sources import store as S


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame([(*x, "hidden") for x in r], "rule_id string, n int, _note string")


def held(store, version=None):
    df = store.read(version)
    return sorted(map(tuple, df.collect()), key=str)


def test_batches_keep_the_first_of_each_key_and_repeats_change_nothing(spark, rows, tmp_path):
    store = S.RuleStore(spark, f"{tmp_path}/s", buckets=8)
    assert store.read() is None and store.version == 0
    first = store.append(rows(("a", 2), ("a", 1), ("b", 5), (None, 7), (None, 6)), "one", "n")
    assert (first.version, first.records, first.files_read) == (1, 3, 0)
    assert held(store) == [("a", 1), ("b", 5), (None, 6)]
    second = store.append(rows(("a", 9), ("c", 3), (None, 1)), "two", "n")
    assert second.records == 1 and held(store) == [("a", 1), ("b", 5), ("c", 3), (None, 6)]
    again = store.append(rows(("z", 9)), "two", "n")
    assert again.repeated and again.records == 0 and store.version == 2 and len(held(store)) == 4
    assert held(store, 1) == [("a", 1), ("b", 5), (None, 6)]
    assert S.RuleStore(spark, f"{tmp_path}/s", buckets=99).buckets == 8
    fresh = store.overwrite(rows(("q", 1)), "three")
    assert fresh.version == 3 and held(store) == [("q", 1)] and held(store, 2) != held(store)


def test_an_append_reads_the_buckets_it_adds_to(spark, tmp_path):
    store = S.RuleStore(spark, f"{tmp_path}/s", buckets=32)
    store.append(spark.range(2000).selectExpr("cast(id as string) as rule_id", "id as n"), "all")
    files = sum(map(len, store._manifest()["files"].values()))
    one = store.append(spark.range(5, 6).selectExpr("cast(id as string) as rule_id", "id as n"), "one")
    assert files == 32 and (one.records, one.buckets, one.files_read) == (0, 0, 1)
    few = store.append(spark.range(2000, 2003).selectExpr("cast(id as string) as rule_id", "id as n"), "few")
    assert few.records == 3 and few.files_read == few.buckets <= 3


def test_what_is_not_committed_is_not_seen(spark, rows, tmp_path, monkeypatch):
    store = S.RuleStore(spark, f"{tmp_path}/s", buckets=4)
    store.append(rows(("a", 1)), "one")
    late = S.RuleStore(spark, f"{tmp_path}/s")
    commit = S.RuleStore._commit

    def beaten(self, manifest):
        monkeypatch.setattr(S.RuleStore, "_commit", commit)
        store.append(rows(("b", 2)), "other")
        commit(self, manifest)

    monkeypatch.setattr(S.RuleStore, "_commit", beaten)
    with pytest.raises(S.Conflict):
        late.append(rows(("c", 3)), "late")
    assert held(store) == [("a", 1), ("b", 2)]
    late.append(rows(("c", 3)), "late")  # sent again, it is written
    assert held(store) == [("a", 1), ("b", 2), ("c", 3)]
    assert store.vacuum() == 1 and held(store) == [("a", 1), ("b", 2), ("c", 3)]


def test_compaction_and_schemas(spark, rows, tmp_path):
    store = S.RuleStore(spark, f"{tmp_path}/s", buckets=2)
    for k in range(5):
        store.append(rows(*[(f"{k}-{j}", j) for j in range(6)]), f"b{k}")
    before = held(store)
    done = store.compact("tidy", more_than=3)
    assert done.files_read == 10 and held(store) == before and all(len(f) == 1 for f in store._manifest()["files"].values())
    assert store.compact("tidy").repeated and store.compact("more").records == 0
    with pytest.raises(ValueError, match="records have"):
        store.append(spark.createDataFrame([("x", "y")], "rule_id string, other string"), "odd")
    assert store.append(rows().limit(0), "empty").records == 0
    with pytest.raises(ValueError, match="no version 77"):
        store.read(77)


def test_best_of_each_signature(spark):
    long = "The issuer shall have a net worth of one crore"
    records = [(1, "A", long, 3), (2, "B", long.upper().replace(" ", " -- "), 5), (3, "C", long + "!" + " more" * 40, 9), (4, "D", "short", 1), (5, "D", "other", 2), (6, "E", "short", 9), (7, "F", None, 1), (8, "F", None, 3), (9, "G", "", 1), (10, None, "", 1), (11, None, None, 1)]
    df = spark.createDataFrame([(*r, "x") for r in records], "k int, rule_id string, text string, confidence int, copies_of string")
    got = {r["k"]: r["copies"] for r in quality.keep_best(df, -F.col("confidence"), F.col("k")).collect()}
    assert got == {2: 2, 3: 1, 5: 2, 6: 1, 8: 2, 9: 1, 10: 2}
    wide = spark.createDataFrame([(k, "R", "x" * 159 + c + "tail", 1) for k, c in enumerate("abca")], "k int, rule_id string, text string, confidence int")
    assert {r["k"]: r["copies"] for r in quality.keep_best(wide, "k").collect()} == {0: 2, 1: 1, 2: 1}
    assert quality.keep_best(df.limit(0), "k").count() == 0


def test_a_text_in_capitals_says_the_same(spark):
    from rulewright.functions import text as T

    rows = spark.createDataFrame([("a", 1, "der grosse Spaß und das weiße Maß"), ("b", 2, "der grosse Spaß und das weiße Maß")], "rule_id string, n int, text string")
    shouted = rows.withColumn("text", F.when(F.col("n") == 2, T.upper(F.col("text"))).otherwise(F.col("text")))
    assert [(r["rule_id"], r["copies"]) for r in quality.keep_best(shouted, "n").collect()] == [("a", 2)]
