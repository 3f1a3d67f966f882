"""Readers and sinks of filings and rule records."""

from __future__ import annotations

from collections.abc import Callable
from io import BytesIO

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.json import valid_json
from ..functions.text import title_line
from ..plans.schema import Schema


def read_filings(spark: SparkSession, path: str, schema: Schema, strict: bool = False) -> DataFrame:
    """Filings of JSON objects, one per file or line: source, problem and the fields.

    Strict reading fails on the first bad object; otherwise a bad one keeps its
    row with a problem and null fields, and missing fields get their defaults.
    """
    if strict:
        return spark.read.schema(schema.ddl).option("mode", "FAILFAST").json(path, multiLine=True)
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")
    return lines.select("source", schema.problem(F.col("value")).alias("problem"), schema.decode(F.col("value")).alias("r")).select("source", "problem", "r.*")


def number_lines(lines: DataFrame, order: str) -> DataFrame:
    """`lines` with line numbers from 1 by `order`.

    Numbers are per-range ranks plus offsets of the ranges before, so no task
    sees all lines; only the number of lines of each range goes to the driver's plan.
    """
    from pyspark.storagelevel import StorageLevel

    dealt = lines.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()).persist(StorageLevel.DISK_ONLY)
    ranked = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    sizes = dealt.groupBy("_part").count()
    before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    return ranked.join(before, "_part").withColumn("line", F.col("_k") + F.coalesce("_before", F.lit(0))).drop("_part", "_k", "_before")


def parse_lines(lines: DataFrame, ddl: str) -> DataFrame:
    """line, good and record of JSON lines (line, value); blank lines are skipped, bad ones have a null record."""
    some = lines.where(F.trim("value") != "")
    good = valid_json(F.col("value"))
    return some.select("line", good.alias("good"), F.when(good, F.from_json("value", ddl)).alias("record"), "value")


def read_jsonl(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Records of a JSON-lines folder; blank and bad lines are dropped."""
    return spark.read.schema(ddl).option("mode", "DROPMALFORMED").json(path)


def first_json_block(text: Column) -> Column:
    """The first JSON object or array in noisy text: from the first opening bracket to the last closing one of its kind, if that parses."""
    braces, brackets = F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    at_brace, at_bracket = F.instr(text, "{"), F.instr(text, "[")
    block = F.when((at_bracket > 0) & ((at_brace == 0) | (at_bracket < at_brace)), brackets).otherwise(braces)
    return F.when(valid_json(block), block)


def write_reports(rows: DataFrame, path: str) -> None:
    """One compact JSON report per line."""
    rows.select("value").write.mode("overwrite").text(path)


def write_documents(rows: DataFrame, path: str) -> None:
    """Each row as one indented JSON document; null members are written."""
    whole = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    rows.select(whole.alias("value")).write.mode("overwrite").text(path)


def store_records(records: DataFrame, path: str, mode: str = "overwrite", key: str = "rule_id") -> int:
    """Writes the first record of each key, without members named ``_…``, and gives how many were written.

    ``append`` leaves out keys that are stored already; ``overwrite`` starts afresh.
    """
    from ..operators.quality import new_records

    spark, store = records.sparkSession, None
    if mode == "append":
        there = spark.read.schema(f"`{key}` string").json(path) if _exists(spark, path) else None
        store = there
    elif mode != "overwrite":
        raise ValueError(f"mode is overwrite or append, not {mode}")
    written = Observation()
    new_records(records, store, key).observe(written, F.count("*").alias("n")).write.mode(mode).json(path)
    return written.get["n"]


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def read_examples(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The entries of the ``examples`` lists of JSON documents, one per row."""
    return spark.read.schema(f"examples array<struct<{ddl}>>").json(path, multiLine=True).select(F.inline("examples"))


def answered(rows: DataFrame, prompt: str, call: Callable[[str], str]) -> DataFrame:
    """`rows` with reply and block: what `call`, any function from a prompt to a text, says, and the first JSON block of it.

    `call` goes to the workers; where it fails, and for a null prompt, the reply is null.
    """
    def one(text):
        try:
            return None if text is None else call(text)
        except Exception:  # whatever a service raises
            return None

    ask = F.udf(one, "string")  # a call takes far longer than a row's way to Python
    return rows.withColumn("reply", ask(F.col(prompt))).withColumn("block", first_json_block(F.col("reply")))


def append_records(records: DataFrame, path: str, store: DataFrame | None = None, key: str = "rule_id") -> DataFrame:
    """Appends the records whose key is not in `store`, without members named ``_…``; gives what was written."""
    from ..operators.quality import new_records

    out = new_records(records, store, key)
    out.write.mode("append").json(path)
    return out


def pages_of(pdf: bytes) -> list[str]:
    """The page texts of a PDF file, by PyMuPDF or else pdfminer."""
    try:
        import fitz
    except ImportError:
        pass
    else:
        return [page.get_text() for page in fitz.open(stream=pdf, filetype="pdf")]
    try:
        from pdfminer.high_level import extract_text
    except ImportError as e:
        raise RuntimeError("reading PDF files needs PyMuPDF or pdfminer; give page texts as a table instead") from e
    return extract_text(BytesIO(pdf)).removesuffix("\f").split("\f")  # pdfminer ends pages so


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """doc, page_no, text of PDF files, if a PDF library is there; page texts may as well come from a table."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(p, k + 1, text) for p, data in zip(pdf["path"], pdf["content"], strict=True) for k, text in enumerate(pages_of(data))]
            yield pd.DataFrame(rows, columns=["doc", "page_no", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "doc string, page_no int, text string")


def whole_texts(pages: DataFrame) -> DataFrame:
    """doc, title (the first line of the first page that isn't blank) and text (all pages, joined by line feeds) of pages (doc, page_no, text)."""
    each = pages.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("page_no", "text"))).alias("p"))
    return each.select("doc", title_line(F.get("p", 0)["text"]).alias("title"), F.array_join(F.col("p.text"), "\n").alias("text"))
