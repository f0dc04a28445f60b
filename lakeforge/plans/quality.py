"""2.15 multi-hop stream and 2.16 data quality: rules with warn, drop and
fail, metrics, quarantine, alerts and the bronze/silver/gold flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.operators import medallion as M
from lakeforge.operators import quality as Q
from lakeforge.plans.registry import query
from lakeforge.operators.quality import Rule, apply_rules
from lakeforge.plans.sqlkit import sql_avg_money
from lakeforge.session import scratch_root
from lakeforge.sources import files as FS
from lakeforge.sources.tables import raw


def write_landing(spark, sf_dir) -> str:
    """Landing files derived from the tables, with the faults the rules are
    for: bad key text (key % 97 = 3), unknown nation 99 (key % 50 = 1),
    padded names, lower-case segments; nation 24 in an unknown region."""
    landing = scratch_root(spark, "landing")
    c = raw(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bad = c.select(
        F.when(k % 97 == 3, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("c_custkey"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("c_name"),
        F.when(k % 50 == 1, F.lit(99)).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        "c_acctbal", F.lower("c_mktsegment").alias("c_mktsegment"))
    FS.write_csv(bad, f"{landing}/customer_csv")
    n = raw(spark, sf_dir, "nation")
    (n.withColumn("n_regionkey", F.when(F.col("n_nationkey") == 24, F.lit(9)).otherwise(F.col("n_regionkey")))
     .write.mode("overwrite").json(f"{landing}/nation_json"))
    return landing


SILVER_IN_SQL = """sc AS (
  SELECT TRY_CAST(CASE WHEN c_custkey % 97 = 3 THEN 'x' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS BIGINT) AS c_custkey,
         c_name, CASE WHEN c_custkey % 50 = 1 THEN 99 ELSE c_nationkey END AS c_nationkey,
         CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, upper(c_mktsegment) AS c_mktsegment FROM customer),
silver AS (SELECT * FROM sc WHERE c_custkey IS NOT NULL AND c_nationkey BETWEEN 0 AND 24),
sn AS (SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, CASE WHEN n_nationkey = 24 THEN 9 ELSE n_regionkey END AS n_regionkey FROM nation),
silver_nation AS (SELECT * FROM sn WHERE n_regionkey BETWEEN 0 AND 4)"""


def _q(body):
    return f"WITH {SILVER_IN_SQL} {body}"


def _bronze_batch(spark, sf_dir):
    landing = write_landing(spark, sf_dir)
    schema = FS.infer_schema(spark, f"{landing}/customer_csv", "csv")
    return spark.read.schema(schema).option("header", "true").csv(f"{landing}/customer_csv")


SILVER_COLS_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM silver"


@query("dq_05_cleaning_projection", oracle=_q("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM sc"))
def dq_05(spark, sf_dir):
    return M.silver_customer_projection(_bronze_batch(spark, sf_dir))


@query("dq_02_expect_or_drop", oracle=_q(SILVER_COLS_SQL))
def dq_02(spark, sf_dir):
    return Q.apply_rules(M.silver_customer_projection(_bronze_batch(spark, sf_dir)), M.CUSTOMER_RULES, "silver_customer")


METRICS_SQL = _q("""
SELECT 'silver_customer' AS dataset, rule, action, count(*) - failed AS passed, failed FROM (
  SELECT 'non_negative_balance' AS rule, 'warn' AS action, count(*) FILTER (WHERE NOT coalesce(c_acctbal >= 0, FALSE)) AS failed FROM sc
  UNION ALL SELECT 'valid_key', 'drop', count(*) FILTER (WHERE c_custkey IS NULL) FROM sc
  UNION ALL SELECT 'known_nation', 'drop', count(*) FILTER (WHERE NOT coalesce(c_nationkey BETWEEN 0 AND 24, FALSE)) FROM sc
  UNION ALL SELECT 'has_name', 'fail', count(*) FILTER (WHERE c_name IS NULL) FROM sc) m, sc GROUP BY rule, action, failed""")


@query("dq_04_rule_metrics", oracle=METRICS_SQL)
def dq_04(spark, sf_dir):
    return Q.quality_metrics(M.silver_customer_projection(_bronze_batch(spark, sf_dir)), M.CUSTOMER_RULES,
                             "silver_customer")


@query("dq_01_expect_warn_counts", oracle=f"SELECT rule, failed FROM ({METRICS_SQL}) WHERE action = 'warn'")
def dq_01(spark, sf_dir):
    m = Q.quality_metrics(M.silver_customer_projection(_bronze_batch(spark, sf_dir)), M.CUSTOMER_RULES,
                          "silver_customer")
    return m.filter("action = 'warn'").select("rule", "failed")


@query("ex_16_quality_alert", oracle=f"""
SELECT dataset, rule, action, passed, failed, failed / (passed + failed) AS failed_fraction
FROM ({METRICS_SQL}) WHERE failed / (passed + failed) > 0.015""")
def ex_16(spark, sf_dir):
    m = Q.quality_metrics(M.silver_customer_projection(_bronze_batch(spark, sf_dir)), M.CUSTOMER_RULES,
                          "silver_customer")
    return Q.alerts(m, 0.015)


@query("ex_12_quarantine", oracle=_q("""
SELECT c_custkey, c_nationkey, CASE WHEN c_custkey IS NULL OR NOT coalesce(c_nationkey BETWEEN 0 AND 24, FALSE)
  THEN 'rejected' ELSE 'clean' END AS status,
  concat_ws(',', CASE WHEN NOT coalesce(c_acctbal >= 0, FALSE) THEN 'non_negative_balance' END,
            CASE WHEN c_custkey IS NULL THEN 'valid_key' END,
            CASE WHEN NOT coalesce(c_nationkey BETWEEN 0 AND 24, FALSE) THEN 'known_nation' END) AS reasons
FROM sc"""))
def ex_12(spark, sf_dir):
    silver_in = M.silver_customer_projection(_bronze_batch(spark, sf_dir))
    rules = M.CUSTOMER_RULES
    gate = [r for r in rules if r.action != "warn"]
    clean, rejected = Q.quarantine(silver_in, gate)
    # Reasons list every broken rule, warn rules included, for both sides.
    reasons = F.array_join(F.filter(F.array(*[F.when(~r.ok, F.lit(r.name)) for r in rules]),
                                    lambda x: x.isNotNull()), ",")
    return (clean.withColumn("status", F.lit("clean"))
            .unionByName(rejected.drop("reasons").withColumn("status", F.lit("rejected")))
            .select("c_custkey", "c_nationkey", "status", reasons.alias("reasons")))


def _flow(spark, sf_dir):
    return M.run(spark, write_landing(spark, sf_dir))


@query("sm_09_multi_hop_silver", oracle=_q(
    "SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM silver"))
def sm_09(spark, sf_dir):
    return _flow(spark, sf_dir)["silver_customer"]


@query("dq_06_silver_nation", oracle=_q("SELECT n_nationkey, n_name, n_regionkey FROM silver_nation"))
def dq_06(spark, sf_dir):
    return _flow(spark, sf_dir)["silver_nation"]


@query("dq_07_gold_customers_by_nation", oracle=_q(f"""
SELECT n_name, count(*) AS customer_count, {sql_avg_money('c_acctbal')} AS avg_acctbal
FROM silver JOIN silver_nation ON c_nationkey = n_nationkey GROUP BY n_name"""))
def dq_07(spark, sf_dir):
    return _flow(spark, sf_dir)["gold_customers_by_nation"]


@query("dq_01_stream_observed_counts", oracle=f"SELECT rule, failed FROM ({METRICS_SQL})")
def dq_01_stream(spark, sf_dir):
    out = _flow(spark, sf_dir)
    # A handful of rule counts gathered from the stream's progress reports.
    return spark.createDataFrame(sorted(out["violations"].items()), "rule STRING, failed BIGINT")


@query("ex_11_constraints_before_write", oracle="""
SELECT count(*) FILTER (WHERE c_custkey % 50 <> 3 AND c_custkey % 70 <> 5) AS accepted,
       count(*) FILTER (WHERE c_custkey % 50 = 3 OR c_custkey % 70 = 5) AS refused FROM customer""")
def ex_11(spark, sf_dir):
    """Rows that break a NOT NULL or a CHECK constraint never reach the table."""
    c = raw(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 50 != 3, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 70 == 5, -1).otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    rules = [Rule("name_not_null", "c_name IS NOT NULL", "drop"), Rule("nation_check", "c_nationkey >= 0", "drop")]
    path = scratch_root(spark, "constrained")
    apply_rules(c, rules, "customer").write.parquet(path)
    total = c.agg(F.count(F.lit(1)).alias("all_rows"))
    return (spark.read.parquet(path).agg(F.count(F.lit(1)).alias("accepted")).crossJoin(F.broadcast(total))      # one row each
            .select("accepted", (F.col("all_rows") - F.col("accepted")).alias("refused")))
