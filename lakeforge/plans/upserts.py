"""2.13 Upsert: the reference's customer MERGE, its builder form, metrics,
re-run, delete-by-source and all-columns evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.operators import upsert as U
from lakeforge.plans.registry import query
from lakeforge.sources.tables import typed, with_typed

DIM_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

# The two new customers of the reference's change batch.
NEW_CUSTOMERS = [(9_000_001, "Customer#new1", 7, 1500.00, "BUILDING"),
                 (9_000_002, "Customer#new2", 3, 250.00, "HOUSEHOLD")]

#: The balance is another one.
MATCHED_COND = "t.c_acctbal <> s.c_acctbal"


def dim(spark, sf_dir):
    """Target dimension: the whole customer table plus an update time."""
    return typed(spark, sf_dir, "customer").select(*DIM_COLS, F.current_timestamp().alias("updated_at"))


def change_batch(spark, sf_dir):
    """A small change: 1000 more for the customers with the three lowest
    keys, and the new customers; all in one set of types."""
    known = typed(spark, sf_dir, "customer").select(*DIM_COLS)
    kinds = dict(known.dtypes) | {"c_nationkey": "bigint"}
    raised = known.sort("c_custkey").limit(3).withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    as_batch = lambda df: df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in DIM_COLS])
    return as_batch(raised).union(as_batch(spark.createDataFrame(NEW_CUSTOMERS, DIM_COLS)))


def merge(target, source):
    """New balances and new customers, stamped with the time of the change."""
    stamp = {"updated_at": F.current_timestamp()}
    from_source = lambda cols: {c: F.col(f"s.{c}") for c in cols} | stamp
    change = U.Merge(target, source, on=["c_custkey"])
    change.when_matched_update(MATCHED_COND, from_source(["c_acctbal"]))
    return change.when_not_matched_insert(from_source(DIM_COLS))


CHG_SQL = ("chg AS (SELECT * FROM (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal + 1000 AS DECIMAL(18,2)) AS c_acctbal, "
           "c_mktsegment FROM t_customer ORDER BY c_custkey LIMIT 3) "
           "UNION ALL SELECT 9000001, 'Customer#new1', 7, CAST(1500.00 AS DECIMAL(18,2)), 'BUILDING' "
           "UNION ALL SELECT 9000002, 'Customer#new2', 3, CAST(250.00 AS DECIMAL(18,2)), 'HOUSEHOLD')")
MERGED_SQL = ("merged AS (SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(t.c_name, s.c_name) AS c_name, "
              "CAST(coalesce(t.c_nationkey, s.c_nationkey) AS INTEGER) AS c_nationkey, "
              "CASE WHEN t.c_custkey IS NULL OR t.c_acctbal <> s.c_acctbal THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, "
              "coalesce(t.c_mktsegment, s.c_mktsegment) AS c_mktsegment, "
              "CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN s.c_custkey IS NOT NULL AND t.c_acctbal <> s.c_acctbal "
              "THEN 'update' ELSE 'keep' END AS _action FROM t_customer t FULL JOIN chg s ON t.c_custkey = s.c_custkey)")


def _msql(body: str) -> str:
    return with_typed(body, "customer", extra=CHG_SQL + ", " + MERGED_SQL)


def _out(planned):
    return planned.select("c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"),
                          "c_mktsegment", "_action")


@query("up_01_merge_upsert", oracle=_msql(
    "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment, _action FROM merged"))
def up_01(spark, sf_dir):
    return _out(merge(dim(spark, sf_dir), change_batch(spark, sf_dir)).plan())


@query("up_01_merge_upsert_shuffle_plan", oracle=_msql(
    "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment, _action FROM merged"))
def up_01b(spark, sf_dir):
    """Same merge forced onto the full-outer-join plan (large change batch)."""
    m = merge(dim(spark, sf_dir), change_batch(spark, sf_dir))
    m.broadcast_bytes = -1
    return _out(m.plan())


@query("up_02_functional_form", oracle=_msql(
    "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment, _action FROM merged"))
def up_02(spark, sf_dir):
    planned = U.upsert(typed(spark, sf_dir, "customer").select(*DIM_COLS), change_batch(spark, sf_dir),
                       ["c_custkey"], matched_condition=MATCHED_COND, update_set={"c_acctbal": "s.c_acctbal"})
    return _out(planned)


METRICS_SQL = ("SELECT count(*) FILTER (WHERE _action <> 'keep') AS num_affected_rows, "
               "count(*) FILTER (WHERE _action = 'update') AS num_updated_rows, "
               "CAST(0 AS BIGINT) AS num_deleted_rows, "
               "count(*) FILTER (WHERE _action = 'insert') AS num_inserted_rows FROM merged")


@query("up_03_merge_metrics", oracle=_msql(METRICS_SQL))
def up_03(spark, sf_dir):
    return U.metrics(merge(dim(spark, sf_dir), change_batch(spark, sf_dir)).plan())


@query("up_04_rerun_is_noop", oracle=_msql(
    "SELECT CAST(0 AS BIGINT) AS num_affected_rows, CAST(0 AS BIGINT) AS num_updated_rows, "
    "CAST(0 AS BIGINT) AS num_deleted_rows, CAST(0 AS BIGINT) AS num_inserted_rows"))
def up_04(spark, sf_dir):
    chg = change_batch(spark, sf_dir)
    once = U.apply(merge(dim(spark, sf_dir), chg).plan())
    return U.metrics(merge(once, chg).plan())


@query("up_06_delete_not_matched_by_source", oracle=_msql("""
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey > 9000000 THEN 'delete' ELSE 'keep' END AS _action FROM merged"""))
def up_06(spark, sf_dir):
    chg = change_batch(spark, sf_dir)
    once = U.apply(merge(dim(spark, sf_dir), chg).plan())
    again = (U.Merge(once, chg.filter("c_custkey < 9000000"), ["c_custkey"])
             .when_matched_update(MATCHED_COND, {"c_acctbal": "s.c_acctbal"})
             .when_not_matched_insert({c: f"s.{c}" for c in DIM_COLS})
             .when_not_matched_by_source_delete("t.c_custkey > 9000000"))
    return _out(again.plan())


@query("up_07_update_insert_all_evolve", oracle=_msql("""
SELECT m.c_custkey, m.c_name, m.c_nationkey, CAST(m.c_acctbal AS DOUBLE) AS c_acctbal, m.c_mktsegment,
       CASE WHEN m._action = 'keep' THEN NULL ELSE concat('+', CAST(m.c_custkey AS VARCHAR)) END AS c_phone,
       CASE WHEN m._action = 'keep' THEN 'keep' WHEN m._action = 'insert' THEN 'insert' ELSE 'update' END AS _action
FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
             CASE WHEN _action = 'insert' THEN 'insert' WHEN c_custkey IN (SELECT c_custkey FROM chg) THEN 'update'
                  ELSE 'keep' END AS _action FROM merged) m"""))
def up_07(spark, sf_dir):
    target = typed(spark, sf_dir, "customer").select(*DIM_COLS)
    chg = change_batch(spark, sf_dir).withColumn("c_phone", F.concat(F.lit("+"), F.col("c_custkey").cast("string")))
    planned = U.Merge(target, chg, ["c_custkey"]).when_matched_update_all().when_not_matched_insert_all().plan()
    return planned.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"),
                          F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment", "c_phone", "_action")


@query("up_08_change_batch", oracle=_msql("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, "
                                          "c_mktsegment FROM chg"))
def up_08(spark, sf_dir):
    return change_batch(spark, sf_dir).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))
