"""Queries for rows the survey checks by unit test: save modes, schema
enforcement and replacement, idempotent CTAS, micro-batch accounting,
rate-limited backlogs, stateless stream transforms, partition-scoped and
de-duplicated upserts, fail rules, exactly-once batch writes."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeforge.operators import quality as Q
from lakeforge.operators import relational as R
from lakeforge.operators import upsert as U
from lakeforge.plans.projection import MACHINERY_SQL, machinery_accounts
from lakeforge.plans.registry import query
from lakeforge.plans.upserts import DIM_COLS, MATCHED_COND, change_batch
from lakeforge.session import scratch_root
from lakeforge.sources import files as FS
from lakeforge.sources.tables import raw, typed, with_typed
from lakeforge.streaming import incremental as INC


def _table(spark, base):
    """A catalog table name unique to this call, with its shared location."""
    import uuid
    name = f"{base}_{uuid.uuid4().hex[:8]}"
    return name, scratch_root(spark, name)


def refused(write, *conditions: str) -> None:
    """``write`` must fail with one of these error conditions."""
    try:
        write()
    except PySparkException as e:
        if not any(c in f"{e.getCondition()} {e}" for c in conditions):
            raise
        return
    raise AssertionError(f"accepted, not refused with {conditions}")


@query("snk_02_save_modes", oracle="SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def snk_02(spark, sf_dir):
    """overwrite, append, then ignore (no-op) and error (refused) on an existing table."""
    name, loc = _table(spark, "lf_save_modes")
    df = raw(spark, sf_dir, "customer").select("c_custkey", "c_name")
    FS.save_table(df, name, "overwrite", path=loc)
    FS.save_table(df, name, "append", path=loc)
    FS.save_table(df, name, "ignore", path=loc)
    refused(lambda: FS.save_table(df, name, "error", path=loc), "TABLE_OR_VIEW_ALREADY_EXISTS")
    return FS.detached(spark, name)


@query("snk_03_overwrite_replaces_schema", oracle="SELECT c_custkey, c_mktsegment FROM customer")
def snk_03(spark, sf_dir):
    name, loc = _table(spark, "lf_overwrite_schema")
    c = raw(spark, sf_dir, "customer")
    FS.save_table(c.select("c_custkey", "c_name"), name, "overwrite", path=loc)
    FS.save_table(c.select("c_custkey", "c_mktsegment"), name, "overwrite", path=loc)
    return FS.detached(spark, name)


@query("snk_04_schema_enforcement", oracle="SELECT c_custkey, c_name FROM customer")
def snk_04(spark, sf_dir):
    """Appends with an incompatible type, or with a column too few or too
    many, are refused; the table is unchanged."""
    name, loc = _table(spark, "lf_enforced")
    FS.save_table(raw(spark, sf_dir, "customer").select("c_custkey", "c_name"), name, "overwrite", path=loc)
    c = raw(spark, sf_dir, "customer")
    append = lambda df: df.write.mode("append").saveAsTable(name)
    refused(lambda: append(c.select("c_custkey", "c_name", "c_nationkey")), "_COLUMN_COUNT", "INSERT_COLUMN_ARITY_MISMATCH", "_LEGACY_ERROR_TEMP")
    refused(lambda: append(c.select("c_custkey")), "_COLUMN_COUNT", "INSERT_COLUMN_ARITY_MISMATCH", "_LEGACY_ERROR_TEMP")
    refused(lambda: append(c.select(F.concat(F.lit("x"), F.col("c_custkey")).alias("c_custkey"), "c_name")), "CAST_INVALID_INPUT", "INCOMPATIBLE_DATA_FOR_TABLE")
    return FS.detached(spark, name)


@query("snk_06_create_or_replace_idempotent", oracle=with_typed(
    "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment FROM t_customer",
    "customer"))
def snk_06(spark, sf_dir):
    name, loc = _table(spark, "lf_ctas")
    df = typed(spark, sf_dir, "customer").select(*DIM_COLS).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))
    for _ in range(2):                                     # run twice: same rows
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        FS.save_table(df, name, "overwrite", path=loc)
    return FS.detached(spark, name)


def _customer_files(spark, sf_dir, parts=4):
    src = scratch_root(spark, "lf_stream_src")
    typed(spark, sf_dir, "customer").repartition(parts).write.parquet(src)
    return src, spark.read.parquet(src).schema


@query("sm_02_rows_over_micro_batches", oracle="SELECT count(*) AS rows, CAST(140 AS BIGINT) AS batches FROM customer")
def sm_02(spark, sf_dir):
    # more micro-batches than Spark keeps progress reports of
    src, schema = _customer_files(spark, sf_dir, parts=140)
    res = INC.run_available_now(INC.file_stream(spark, src, "parquet", schema, max_files=1),
                                scratch_root(spark, "lf_sm02_sink"), scratch_root(spark, "lf_sm02_ckpt"),
                                query_name="sm_02")
    data_batches = sum(1 for p in res.progress if p["numInputRows"] > 0)
    return spark.range(1).select(F.lit(res.rows).cast("bigint").alias("rows"),
                                 F.lit(data_batches).cast("bigint").alias("batches"))


@query("sm_04_stateless_stream_transform", oracle=with_typed(
    f"SELECT * REPLACE (CAST(balance_k AS DOUBLE) AS balance_k) FROM ({MACHINERY_SQL})", "customer"))
def sm_04(spark, sf_dir):
    """The batch projection function applied unchanged to a stream."""
    src = scratch_root(spark, "lf_sm04_src")
    stored = raw(spark, sf_dir, "customer")
    stored.repartition(4).write.parquet(src)
    sink, ckpt = scratch_root(spark, "lf_sm04_sink"), scratch_root(spark, "lf_sm04_ckpt")
    INC.run_available_now(machinery_accounts(spark.readStream.schema(stored.schema).parquet(src)), sink, ckpt,
                          query_name="sm_04")
    return spark.read.parquet(sink).withColumn("balance_k", F.col("balance_k").cast("double"))


@query("sm_07_rate_limited_backlog", oracle="SELECT c_custkey, c_name FROM customer")
def sm_07(spark, sf_dir):
    """maxFilesPerTrigger=1 over a 4-file backlog: several micro-batches in
    one availableNow run, same sink as one batch."""
    src, schema = _customer_files(spark, sf_dir)
    sink, ckpt = scratch_root(spark, "lf_sm07_sink"), scratch_root(spark, "lf_sm07_ckpt")
    INC.run_available_now(INC.file_stream(spark, src, "parquet", schema, max_files=1).select("c_custkey", "c_name"),
                          sink, ckpt, query_name="sm_07")
    return spark.read.parquet(sink)


@query("ex_10_streaming_table_from_files", oracle="SELECT c_custkey, c_name, c_mktsegment FROM customer")
def ex_10(spark, sf_dir):
    landing = scratch_root(spark, "lf_ex10_landing")
    FS.write_csv(raw(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").repartition(3), landing)
    name, loc = _table(spark, "lf_ex10_table")
    ckpt = scratch_root(spark, "lf_ex10_ckpt")
    stream = INC.file_stream(spark, landing, "csv", FS.kept_schema(spark, landing, "csv", ckpt))
    q = (stream.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .option("path", loc).trigger(availableNow=True).toTable(name))
    q.awaitTermination()
    return FS.detached(spark, name).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("ex_30_foreach_batch_exactly_once", oracle="SELECT c_custkey, c_name FROM customer")
def ex_30(spark, sf_dir):
    src, schema = _customer_files(spark, sf_dir)
    out = scratch_root(spark, "lf_ex30_out")
    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).select("c_custkey", "c_name")
         .writeStream.foreachBatch(INC.idempotent_batch_writer(out))
         .option("checkpointLocation", scratch_root(spark, "lf_ex30_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


MERGED_SQL_NO_ACTION = ("SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment "
                        "FROM merged")


def _merged_sql():
    from lakeforge.plans.upserts import _msql
    return _msql(MERGED_SQL_NO_ACTION)


@query("up_09_partition_scoped_upsert", oracle=_merged_sql())
def up_09(spark, sf_dir):
    target = scratch_root(spark, "lf_bucketed_dim")
    dim = typed(spark, sf_dir, "customer").select(*DIM_COLS).withColumn("_bucket", U.bucket(["c_custkey"], 16))
    dim.write.partitionBy("_bucket").parquet(target)
    chg = change_batch(spark, sf_dir).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))
    U.upsert_partitioned(spark, target, scratch_root(spark, "lf_bucket_stage"), chg, ["c_custkey"], 16,
                         matched_condition=MATCHED_COND, update_set={"c_acctbal": "s.c_acctbal"})
    return spark.read.parquet(target).select(*DIM_COLS).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("up_05_dedup_source_then_merge", oracle=_merged_sql())
def up_05(spark, sf_dir):
    """A change feed with repeated keys is refused by the merge; the latest
    version per key (by a sequence) is merged instead."""
    chg = change_batch(spark, sf_dir)
    noisy = (chg.withColumn("seq", F.lit(2))
             .unionByName(chg.withColumn("c_acctbal", F.lit(-1).cast("decimal(18,2)")).withColumn("seq", F.lit(1))))
    target = typed(spark, sf_dir, "customer").select(*DIM_COLS)
    try:
        U.upsert(target, noisy.drop("seq"), ["c_custkey"], update_set={"c_acctbal": "s.c_acctbal"})
        raise AssertionError("duplicate source keys accepted")
    except U.DuplicateSourceKeys:
        pass
    latest = R.dedup_latest(noisy, ["c_custkey"], ["seq"]).drop("seq")
    planned = U.upsert(target, latest, ["c_custkey"], matched_condition=MATCHED_COND,
                       update_set={"c_acctbal": "s.c_acctbal"})
    return U.apply(planned).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("dq_03_expect_or_fail", oracle="""
SELECT CAST(count(*) AS BIGINT) AS rows_checked, TRUE AS failed, FALSE AS published FROM customer""")
def dq_03(spark, sf_dir):
    """A fail rule violated by one row aborts the write; nothing is
    published. Names are blanked for keys % 500 = 7 to trigger it."""
    from lakeforge.session import exists
    c = raw(spark, sf_dir, "customer")
    bad = c.withColumn("c_name", F.when(F.col("c_custkey") % 500 == 7, None).otherwise(F.col("c_name")))
    path = scratch_root(spark, "lf_dq03")
    failed = False
    try:
        Q.apply_rules(bad, [Q.Rule("has_name", "c_name IS NOT NULL", "fail")], "customer").write.parquet(path)
    except PySparkException as e:
        failed = "has_name" in str(e)
    published = exists(spark, f"{path}/_SUCCESS")
    return c.agg(F.count(F.lit(1)).alias("rows_checked")).select(
        "rows_checked", F.lit(failed).alias("failed"), F.lit(published).alias("published"))
