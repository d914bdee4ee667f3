"""``loan_tape``: one loan per order, derived from the star-schema tables.

The driver's tables carry no loan tape, so the tape the operators run on is
derived from them (orders + customer + nation + lineitem aggregated per
order).  The work therefore grows with the input tables.

Plan shape: ``lineitem`` is partially aggregated per task and shuffled once
on ``l_orderkey``; ``orders`` joins it on the same key (sort-merge join
reuses the partitioning, or a broadcast when AQE sees a small side);
``customer`` is joined on ``o_custkey`` (AQE splits a skewed customer
partition); ``nation`` is a 25-row dimension and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewise.functions.exprs import default_label_expr

GOOD_STATUS = ("O", "F")  # fixed values: order statuses counted as performing loans
LABEL = "default_flag"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived tape (FIXTURES §4), without the label."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.round(F.lit(100.0) * F.avg(F.col("l_discount") + F.col("l_tax")), 6).alias("apr"),
            F.round(F.avg("l_tax"), 6).alias("dti"),
            F.count_if(F.col("l_returnflag") == "R").alias("inquiries_6m"),
            F.round(F.sum("l_extendedprice"), 2).alias("revolving_balance"),
            F.round(F.avg("l_discount"), 6).alias("revolving_util"),
            F.bool_or(F.col("l_linestatus") == "O").alias("modified_flag"),
        )
    )
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    joined = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey, "left")
    )
    key = F.col("o_orderkey")
    cust = F.col("c_custkey")
    return joined.select(
        key.alias("loan_id"),
        F.col("o_orderstatus").alias("status"),
        F.substring("o_orderpriority", 1, 1).alias("grade"),
        F.col("c_mktsegment").alias("purpose"),
        F.col("n_name").alias("state"),
        F.when(key % 2 == 0, F.lit(36)).otherwise(F.lit(60)).alias("term_months"),
        F.col("o_totalprice").alias("loan_amount"),
        F.col("o_orderdate").alias("origination_date"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"),
               F.col("o_orderdate")).alias("charged_off_date"),
        "apr", "dti", "inquiries_6m", "revolving_balance", "revolving_util", "modified_flag",
        F.col("c_acctbal").alias("annual_income"),
        F.when(cust % 17 == 0, F.lit(None)).otherwise(F.lit(300) + cust % 551).cast("bigint").alias("fico"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
         .when(cust % 3 == 0, F.lit("OWN"))
         .when(cust % 3 == 1, F.lit("RENT"))
         .otherwise(F.lit("MORTGAGE")).alias("home_ownership"),
    )


def labelled_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loan_tape`` plus the 0/1 default label (good statuses O and F)."""
    tape = loan_tape(spark, sf_dir)
    return tape.withColumn(LABEL, default_label_expr("status", GOOD_STATUS))


def materialize_tape(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Write the labelled tape once as Parquet and read it back, cutting the join lineage.

    ``path`` names shared storage and must not exist yet; executors lost later
    re-read the table instead of re-running the join.
    """
    labelled_tape(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


# DuckDB twin of ``labelled_tape``; oracle queries start with this CTE.
LOAN_TAPE_SQL = """
WITH li AS (
  SELECT l_orderkey,
         round(100.0 * avg(l_discount + l_tax), 6) AS apr,
         round(avg(l_tax), 6) AS dti,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS inquiries_6m,
         round(sum(l_extendedprice), 2) AS revolving_balance,
         round(avg(l_discount), 6) AS revolving_util,
         bool_or(l_linestatus = 'O') AS modified_flag
  FROM lineitem GROUP BY l_orderkey
),
loan_tape AS (
  SELECT o.o_orderkey AS loan_id,
         o.o_orderstatus AS status,
         substr(o.o_orderpriority, 1, 1) AS grade,
         c.c_mktsegment AS purpose,
         n.n_name AS state,
         CAST(CASE WHEN o.o_orderkey % 2 = 0 THEN 36 ELSE 60 END AS INTEGER) AS term_months,
         o.o_totalprice AS loan_amount,
         o.o_orderdate AS origination_date,
         CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT' THEN o.o_orderdate END AS charged_off_date,
         li.apr, li.dti, li.inquiries_6m, li.revolving_balance, li.revolving_util, li.modified_flag,
         c.c_acctbal AS annual_income,
         CAST(CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE 300 + c.c_custkey % 551 END AS BIGINT) AS fico,
         CASE WHEN c.c_acctbal < 0 THEN NULL
              WHEN c.c_custkey % 3 = 0 THEN 'OWN'
              WHEN c.c_custkey % 3 = 1 THEN 'RENT'
              ELSE 'MORTGAGE' END AS home_ownership,
         CAST(CASE WHEN o.o_orderstatus IN ('O', 'F') THEN 0 ELSE 1 END AS INTEGER) AS default_flag
  FROM orders o
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)
"""
