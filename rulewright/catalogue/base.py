"""Tables, registration, and the filings that stand in for real ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, oracle: str | None = None):
        def keep(f):
            self.queries[name] = f
            if oracle:
                self.oracles[name] = oracle
            return f

        return keep


#: Scalar facts of a filing, from a customer; the text is valid in Spark SQL and in the oracle's SQL.
FACTS = {
    "is_debarred": "c_custkey % 17 = 0",
    "has_debarred_directors": "c_custkey % 19 = 0",
    "is_fraudulent": "c_custkey % 23 = 0",
    "is_fugitive": "c_custkey % 29 = 0",
    "has_outstanding_convertibles": "c_custkey % 2 = 0",
    "has_esop_exemption": "c_mktsegment = 'BUILDING'",
    "has_sar_exemption": "c_mktsegment = 'MACHINERY'",
    "has_mandatory_convertibles": "c_custkey % 3 = 0",
    "used_monetary_assets": "c_acctbal > 5000",
    "is_offer_for_sale_only": "c_custkey % 7 = 0",
    "changed_name_recently": "c_custkey % 4 = 1",
    "applied_to_stock_exchange": "c_custkey % 11 <> 0",
    "has_demat_agreement": "c_custkey % 13 <> 0",
    "promoter_securities_demat": "c_nationkey <> 3",
    "no_partly_paid_shares": "c_custkey % 31 <> 0",
    "monetary_asset_ratio": "c_custkey % 90",
    "percent_revenue_from_new_name": "c_custkey % 100",
    "general_corp_purpose_ratio": "c_custkey % 40",
    "uses_book_building": "c_custkey % 2 = 1",
    "qib_allocation_done": "c_custkey % 5 <> 0",
    "is_tech_firm": "c_mktsegment <> 'FURNITURE'",
    "sr_net_worth": "CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END",
    "sr_holder_exec": "c_custkey % 4 <> 0",
    "sr_voting_ratio": "c_custkey % 12",
    "sr_class_count": "1 + CASE WHEN c_custkey % 9 = 1 THEN 1 ELSE 0 END",
    "sr_same_face_value": "c_custkey % 7 <> 2",
    "sr_issued_3mo_prior": "c_custkey % 8 <> 5",
    "finance_75_percent_done": "c_acctbal > 0",
    "shares_fully_paid": "c_custkey % 31 <> 0",
    "shares_held_duration_months": "c_custkey % 24",
    "is_govt_entity": "c_nationkey = 7",
    "via_merger_scheme": "c_custkey % 37 = 0",
    "is_bonus_from_free_reserve": "c_custkey % 6 = 0",
    "underlying_held_1y": "c_custkey % 6 <> 1",
    "bonus_not_from_revaluation": "c_custkey % 41 <> 0",
}
#: Yearly amounts of a filing, from the status of its orders, newest year first.
LISTS = {"net_tangible_assets": "F", "operating_profits": "O", "net_worths": "P"}
#: Thresholds in the unit of the driver's amounts (cents).
NTA, PROFIT, WORTH = 10_000_000, 5_000_000, 100_000


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """issuer_id and the fields of the core form; three newest years with orders, fewer or none if there are no more."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    sums = [F.sum(F.when(F.col("o_orderstatus") == s, F.col("cents")).otherwise(0)).alias(name) for name, s in LISTS.items()]
    years = orders.groupBy("o_custkey", "yr").agg(*sums)
    listed = years.groupBy("o_custkey").agg(F.slice(F.sort_array(F.collect_list(F.struct("yr", *LISTS)), asc=False), 1, 3).alias("y"))
    facts = table(spark, sf_dir, "customer").select("c_custkey", *[F.expr(e).alias(name) for name, e in FACTS.items()])
    lists = [F.coalesce(F.col(f"y.{name}"), F.expr("cast(array() as array<bigint>)")).alias(name) for name in LISTS]
    return facts.join(listed, facts["c_custkey"] == listed["o_custkey"], "left").select(F.col("c_custkey").alias("issuer_id"), *FACTS, *lists)


#: The same in the oracle's SQL.
FILINGS_SQL = f"""
yearly AS (SELECT o_custkey, year(o_orderdate) yr, {", ".join(f"sum(CASE WHEN o_orderstatus = '{s}' THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE 0 END) {n}" for n, s in LISTS.items())}
  FROM orders GROUP BY ALL),
listed AS (SELECT o_custkey, {", ".join(f"list(CAST({n} AS BIGINT) ORDER BY yr DESC)[1:3] {n}" for n in LISTS)} FROM yearly GROUP BY o_custkey),
filings AS (SELECT c_custkey issuer_id, {", ".join(f"({e}) {n}" for n, e in FACTS.items())}, {", ".join(f"coalesce({n}, CAST([] AS BIGINT[])) {n}" for n in LISTS)}
  FROM customer LEFT JOIN listed ON c_custkey = o_custkey)"""
