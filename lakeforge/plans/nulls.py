"""2.12 NULL handling (on the reference's NULL-injected customer frame)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.functions import nulls as NL
from lakeforge.plans.registry import query
from lakeforge.plans.sqlkit import NULL_CUSTOMER_SQL, inject_nulls_customer
from lakeforge.sources.tables import typed, with_typed


def _nullcust(spark, sf_dir):
    return inject_nulls_customer(typed(spark, sf_dir, "customer"))


def _sql(body):
    return with_typed(body, "customer", extra=NULL_CUSTOMER_SQL)


@query("nl_01_inject_nulls", oracle=_sql("SELECT * FROM t_nullcust"))
def nl_01(spark, sf_dir):
    return _nullcust(spark, sf_dir)


@query("ag_16_null_counts", oracle=_sql("""
SELECT count(*) - count(c_custkey) AS c_custkey, count(*) - count(c_name) AS c_name,
       count(*) - count(c_nationkey) AS c_nationkey, count(*) - count(c_acctbal) AS c_acctbal,
       count(*) - count(c_mktsegment) AS c_mktsegment FROM t_nullcust"""))
def ag_16(spark, sf_dir):
    return NL.null_counts(_nullcust(spark, sf_dir))


@query("nl_02_fill_per_column", oracle=_sql(
    "SELECT c_custkey, c_name, c_nationkey, coalesce(c_acctbal, 0) AS c_acctbal, "
    "coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment FROM t_nullcust"))
def nl_02(spark, sf_dir):
    return _nullcust(spark, sf_dir).na.fill({"c_acctbal": 0, "c_mktsegment": "UNKNOWN"})


@query("nl_03_drop_any", oracle=_sql(
    "SELECT * FROM t_nullcust WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL "
    "AND c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_nationkey IS NOT NULL"))
def nl_03(spark, sf_dir):
    return _nullcust(spark, sf_dir).na.drop(how="any")


@query("nl_04_drop_subset", oracle=_sql("SELECT * FROM t_nullcust WHERE c_mktsegment IS NOT NULL"))
def nl_04(spark, sf_dir):
    return _nullcust(spark, sf_dir).na.drop(subset=["c_mktsegment"])


@query("nl_05_drop_thresh", oracle=_sql(
    "SELECT * FROM t_nullcust WHERE (CAST(c_custkey IS NOT NULL AS INT) + CAST(c_name IS NOT NULL AS INT) "
    "+ CAST(c_nationkey IS NOT NULL AS INT) + CAST(c_acctbal IS NOT NULL AS INT) "
    "+ CAST(c_mktsegment IS NOT NULL AS INT)) >= 5"))
def nl_05(spark, sf_dir):
    return _nullcust(spark, sf_dir).na.drop(thresh=5)


@query("nl_06_coalesce", oracle=_sql(
    "SELECT c_custkey, coalesce(c_mktsegment, 'UNKNOWN') AS segment, coalesce(c_acctbal, 0) AS balance "
    "FROM t_nullcust"))
def nl_06(spark, sf_dir):
    return _nullcust(spark, sf_dir).select(
        "c_custkey", NL.first_non_null("c_mktsegment", default="UNKNOWN").alias("segment"),
        F.coalesce("c_acctbal", F.lit(0).cast("decimal(18,2)")).alias("balance"))


@query("nl_07_segment_or_nation", oracle=_sql(
    "SELECT c_custkey, coalesce(c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS segment_or_nation "
    "FROM t_nullcust"))
def nl_07(spark, sf_dir):
    return _nullcust(spark, sf_dir).select(
        "c_custkey", F.coalesce("c_mktsegment", F.col("c_nationkey").cast("string")).alias("segment_or_nation"))
