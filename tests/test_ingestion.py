"""Rule ingestion as a stream, and the three sides of a field."""

import datetime as dt

from rulewright.operators import evidence
from rulewright.streaming.evaluate import Ingestion


def test_late_and_repeated_rules(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(hours=h, minutes=m)
    found = Ingestion(spark, f"{tmp_path}/s", "rule_id string, ts timestamp, n int", within="1 hour")
    send = lambda *rows: found.arrive(spark.createDataFrame(rows, "rule_id string, ts timestamp, n int"))
    kept = lambda: sorted(r["n"] for r in found.accepted().collect())
    send(("a", at(10), 1), ("b", at(10, 30), 2), (None, at(10), 3))
    assert kept() == [1, 2, 3]
    send(("a", at(10, 20), 4), ("c", at(9), 5), (None, at(10, 10), 6), ("d", at(11), 7))  # repeated, too late, repeated, new
    assert kept() == [1, 2, 3, 7]
    send(("a", at(11, 30), 8), ("e", at(14), 9))  # still remembered
    assert kept() == [1, 2, 3, 7, 9]
    send(("a", at(14, 30), 10), ("b", at(12), 11))  # forgotten; too late
    assert kept() == [1, 2, 3, 7, 9, 10]
    found.run()  # nothing has arrived
    again = Ingestion(spark, f"{tmp_path}/s", "rule_id string, ts timestamp, n int", within="1 hour")  # as after a restart
    again.arrive(spark.createDataFrame([("a", at(14, 40), 12), ("f", at(14, 40), 13)], "rule_id string, ts timestamp, n int"))
    assert kept() == [1, 2, 3, 7, 9, 10, 13]


def test_three_sides_meet_on_rule_and_field(spark):
    pieces = spark.createDataFrame([("r1", "f", "x", 2), ("r1", "f", "y", 1), ("r2", "g", "z", 1), (None, "f", "n", 1), ("r4", None, "m", 1)], "rule_id string, field string, raw string, rank int")
    mappings = spark.createDataFrame([("r1", "f", "Nat"), ("r2", "f", "Nat"), ("r3", "h", "Bool"), (None, "f", "Nat"), ("r5", "f", None)], "rule_id string, field string, type_hint string")
    schema = spark.createDataFrame([("f", "Nat", ["r1", "r2", "r2", "r5", None]), ("g", "Bool", ["r2"]), ("q", "Nat", [])], "field string, type string, from_rules array<string>")
    out = evidence.reconciled(evidence.best_evidence(pieces, "rank"), mappings, evidence.schema_sides(schema))
    got = {(r["rule_id"], r["field"]): (r["pieces"], r["best"] and r["best"]["raw"], r["type_hint"], r["type"], r["status"]) for r in out.collect()}
    assert got == {
        ("r1", "f"): (2, "y", "Nat", "Nat", "complete"), ("r2", "g"): (1, "z", None, "Bool", "unmapped"), (None, "f"): (1, "n", "Nat", "Nat", "complete"), ("r4", None): (1, "m", None, None, "unmapped"),
        ("r2", "f"): (0, None, "Nat", "Nat", "no_evidence"), ("r3", "h"): (0, None, "Bool", None, "not_in_schema"), ("r5", "f"): (0, None, None, "Nat", "no_evidence"),
    }
    assert evidence.reconciled(evidence.best_evidence(pieces.limit(0), "rank"), mappings.limit(0), evidence.schema_sides(schema.limit(0))).count() == 0
