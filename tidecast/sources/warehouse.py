"""Bank views over order-management tables.

Orders act as transactions, customers own two accounts each, nations are the
branches. Every rule is a plain projection, so filters and column pruning reach
the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.sources.bank import Bank

ID_WIDTH = 12
TYPE_BY_PRIORITY = {"1": "deposit", "2": "withdrawal", "3": "payment", "4": "transfer"}
SEGMENT_BY_MARKET = {
    "HOUSEHOLD": "retail",
    "AUTOMOBILE": "corporate",
    "MACHINERY": "corporate",
    "FURNITURE": "premium",
}


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), ID_WIDTH, "0"))


def customers(c: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    market = F.col("c_mktsegment")
    kind = F.lit("other")
    for name, value in SEGMENT_BY_MARKET.items():
        kind = F.when(market == name, F.lit(value)).otherwise(kind)
    return c.select(
        _id("CUST", key).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.date_add(F.lit("1940-01-01").cast("date"), ((key * 37) % 20000).cast("int")).alias("dob"),
        F.when(key % 2 == 0, "Female").otherwise("male").alias("gender"),
        F.date_add(F.lit("1985-01-01").cast("date"), ((key * 13) % 6000).cast("int")).alias(
            "account_open_date"
        ),
        kind.alias("customer_segment"),
        F.col("c_nationkey").cast("string").alias("branch_code"),
    )


def accounts(c: DataFrame) -> DataFrame:
    c = c.select(
        "c_custkey", "c_acctbal", F.explode(F.array(F.lit(0), F.lit(1))).alias("b")
    )
    return c.select(
        _id("ACC", F.col("c_custkey") * 2 + F.col("b")).alias("account_id"),
        _id("CUST", F.col("c_custkey")).alias("customer_id"),
        F.col("c_acctbal").alias("balance"),
        F.when((F.col("c_custkey") + F.col("b")) % 5 == 0, "closed")
        .otherwise("active")
        .alias("account_status"),
    )


def branches(n: DataFrame) -> DataFrame:
    return n.select(
        F.col("n_nationkey").cast("string").alias("branch_code"),
        F.when(F.col("n_nationkey") % 3 == 0, "Melbourne")
        .when(F.col("n_nationkey") % 3 == 1, "Sydney")
        .otherwise(F.col("n_name"))
        .alias("city"),
    )


def loans(o: DataFrame) -> DataFrame:
    o = o.where(
        (F.col("o_orderstatus") == "O") & F.col("o_orderpriority").startswith("5")
    )
    return o.select(
        _id("LOAN", F.col("o_orderkey")).alias("loan_id"),
        _id("CUST", F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").alias("principal_amount"),
        F.lit("active").alias("loan_status"),
    )


def transactions(o: DataFrame) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    kind = F.lit("fee")
    for digit, value in TYPE_BY_PRIORITY.items():
        kind = F.when(priority == digit, F.lit(value)).otherwise(kind)
    return o.select(
        _id("TX", F.col("o_orderkey")).alias("transaction_id"),
        _id("ACC", F.col("o_custkey") * 2 + F.col("o_orderkey") % 2).alias("account_id"),
        kind.alias("transaction_type"),
        F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise("completed").alias("status"),
    )


def load_bank(spark: SparkSession, root: str) -> Bank:
    customer, nation, orders = (
        spark.read.parquet(f"{root}/{name}.parquet") for name in ("customer", "nation", "orders")
    )
    return Bank(
        customers=customers(customer),
        accounts=accounts(customer),
        loans=loans(orders),
        branches=branches(nation),
        transactions=transactions(orders),
    )
