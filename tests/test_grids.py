"""Fiscal years and units of extracted tables; JSON Schema at depth."""

import json

import pytest
from pyspark.sql import functions as F

from rulewright.operators import grids, validate


def test_fiscal_years(spark):
    said = {
        "FY 2023-24": 2024, "2023-2024": 2024, "2023–24": 2024, "Fiscal 2024": 2024, "FY24": 2024, "FY'24": 2024, "March 31, 2024": 2024, "As at March 31,2021": 2021, "31st March 2024": 2024, "December 31, 2023": 2024, "Sept. 30, 2023": 2024,
        "nine months ended December 31, 2023": None, "Quarter ended March 31, 2024": None, "2019-99": None, "1999-00": 2000, "2010-25": None, "1,44,445.3": None, "12-2024": None, "2024": None, "": None, None: None,
    }
    rows = spark.createDataFrame([(t,) for t in said], "t string").select("t", grids.fiscal_year(F.col("t")).alias("y"), grids.fiscal_year(F.col("t"), 12).alias("calendar")).collect()
    assert {r["t"]: r["y"] for r in rows} == said
    assert {r["t"]: r["calendar"] for r in rows}["December 31, 2023"] == 2023


def test_rows_of_a_table(spark):
    spread = [
        ["Restated figures (in lakhs)"], ["", "", "March 31, 2025", "", "", "March 31, 2024", "", "", "March 31, 2023", ""],
        ["Tangible assets (in\nmillion)(1)", "1,44,445.3", "", "", "1,24,541.0", "", "", "1,01,714.2", "", ""], ["Profit", "9", "", "", "-", "", "", "7", "", ""],
        ["Shares in crore", "", "", "", "", "", "", "", "", ""], ["Worth", "5", None, "", "", "6", "", "", "", "8"], ["Part of it", "6.60%", "", "", "5.22%", "", "", "4.90%", None, ""], None,
    ]
    plain = [["Particulars", "Fiscal 2024", "Fiscal 2023"], ["Plan for FY25", "10", "20"]]
    tables = spark.createDataFrame([(1, spread, "u"), (2, plain, "u"), (3, None, "u"), (4, [], "u"), (5, [["a", "b"], ["c", "1"]], "u"), (6, [["", "FY 2023-24"]], "u")], "k int, grid array<array<string>>, note string")
    got = {(r["k"], r["label"], r["year"]): (r["unit"], r["value"], r["share"]) for r in grids.rows_of(tables).collect()}
    assert got == {
        (1, "Tangible assets (in\nmillion)(1)", 2025): ("million", 144445, None), (1, "Tangible assets (in\nmillion)(1)", 2024): ("million", 124541, None), (1, "Tangible assets (in\nmillion)(1)", 2023): ("million", 101714, None),
        (1, "Profit", 2025): ("lakh", 9, None), (1, "Profit", 2023): ("lakh", 7, None), (1, "Worth", 2025): ("crore", 5, None), (1, "Worth", 2024): ("crore", 6, None), (1, "Worth", 2023): ("crore", 8, None),
        (1, "Part of it", 2025): ("%", 6, 6.6), (1, "Part of it", 2024): ("%", 5, 5.22), (1, "Part of it", 2023): ("%", 4, 4.9), (2, "Plan for FY25", 2024): (None, 10, None), (2, "Plan for FY25", 2023): (None, 20, None),
    }


SCHEMA = {
    "type": "object",
    "required": ["id"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": ["string", "null"], "enum": ["a", "b"]},
        "rows": {"type": "array", "maxItems": 3, "uniqueItems": True, "items": {"type": "array", "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "maximum": 9}}, "additionalProperties": False}}},
        "deep": {"type": "object", "properties": {"er": {"type": "object", "required": ["x"], "properties": {"x": {"type": "boolean"}}}}},
    },
}


@pytest.mark.parametrize(
    ("record", "errors"),
    [
        ({"id": "a"}, []),
        ({"id": None, "rows": []}, []),
        ({"id": "c"}, ["id: enum"]),
        ({"id": 1, "x": 2}, ["record: additionalProperties x", "id: type"]),
        ({"rows": 5}, ["record: missing id", "rows: type"]),
        ({"id": "a", "rows": [[{"n": 1}, {"n": 10}], [], [{"m": 1}, 7]]}, ["rows[0][1].n: maximum", "rows[2][0]: missing n", "rows[2][0]: additionalProperties m", "rows[2][1]: type"]),
        ({"id": "a", "rows": [[], [], 1, 2]}, ["rows: maxItems", "rows: uniqueItems", "rows[2]: type", "rows[3]: type"]),
        ({"id": "a", "deep": {"er": {}}}, ["deep.er: missing x"]),
        ({"id": "a", "deep": {"er": {"x": "t"}}}, ["deep.er.x: type"]),
        ({"id": "a", "deep": None}, ["deep: type"]),
        ([], ["record: type"]),
        ("text", ["record: type"]),
    ],
)
def test_errors_at_depth(spark, record, errors):
    df = spark.createDataFrame([(json.dumps(record),)], "t string")
    assert df.select(validate.document_errors(SCHEMA, F.col("t")).alias("e")).first()["e"] == errors


def test_texts_that_are_no_json(spark):
    df = spark.createDataFrame([("{",), (None,), ("",)], "t string")
    assert [r["e"] for r in df.select(validate.document_errors(SCHEMA, F.col("t")).alias("e")).collect()] == [["record: no JSON"], [], ["record: no JSON"]]
