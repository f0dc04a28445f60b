"""2.14 Partition layout and 2.17 UDF surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.functions import columns as C
from lakeforge.functions import udfs as UDF
from lakeforge.operators import layout as L
from lakeforge.plans.registry import query
from lakeforge.plans.sqlkit import NULL_CUSTOMER_SQL, inject_nulls_customer
from lakeforge.session import scratch_root
from lakeforge.sources.tables import raw, typed, with_typed


@query("pt_01_rows_per_partition")
def pt_01(spark, sf_dir):
    return L.partition_sizes(raw(spark, sf_dir, "lineitem").repartition(8))


@query("pt_01_total_rows_unchanged", oracle="SELECT count(*) AS rows FROM lineitem")
def pt_01b(spark, sf_dir):
    return L.partition_sizes(raw(spark, sf_dir, "lineitem").repartition(8)).agg(F.sum("count").alias("rows"))


@query("pt_02_round_robin_rows", oracle="SELECT * FROM customer")
def pt_02(spark, sf_dir):
    return raw(spark, sf_dir, "customer").repartition(8)


@query("pt_03_hash_key_one_partition", oracle=
       "SELECT c_nationkey, CAST(1 AS BIGINT) AS partitions FROM customer GROUP BY c_nationkey")
def pt_03(spark, sf_dir):
    return L.keys_per_partition(raw(spark, sf_dir, "customer").repartition(8, "c_nationkey"), "c_nationkey")


@query("pt_04_coalesce_rows", oracle="SELECT * FROM customer")
def pt_04(spark, sf_dir):
    return raw(spark, sf_dir, "customer").repartition(8).coalesce(2)


@query("pt_05_range_partitions")
def pt_05(spark, sf_dir):
    return L.range_bounds(typed(spark, sf_dir, "customer").repartitionByRange(4, "c_acctbal"), "c_acctbal")


@query("pt_06_skew_summary")
def pt_06(spark, sf_dir):
    return L.skew_summary(raw(spark, sf_dir, "customer").repartition(8, "c_nationkey"))


@query("pt_07_segment_partitions_then_one", oracle=
       "SELECT c_mktsegment, CAST(1 AS BIGINT) AS partitions FROM customer GROUP BY c_mktsegment")
def pt_07(spark, sf_dir):
    by_seg = raw(spark, sf_dir, "customer").repartition(4, "c_mktsegment")
    return L.keys_per_partition(by_seg.coalesce(1), "c_mktsegment")


@query("pt_01_round_robin_is_even", oracle="SELECT count(*) AS rows, CAST(8 AS BIGINT) AS partitions, TRUE AS even FROM lineitem")
def pt_01c(spark, sf_dir):
    sizes = L.partition_sizes(raw(spark, sf_dir, "lineitem").repartition(8))
    return sizes.agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("partitions"), (F.max("count") <= 2 * F.min("count")).alias("even"))


@query("pt_05_ranges_are_disjoint", oracle="SELECT count(*) AS rows, TRUE AS disjoint FROM customer")
def pt_05b(spark, sf_dir):
    ranges = F.array_sort(F.collect_list(F.struct("lo", "hi")))            # one entry a partition
    after = F.transform(F.sequence(F.lit(1), F.size("r") - 1), lambda i: F.get(F.col("r"), i)["lo"] > F.get(F.col("r"), i - 1)["hi"])
    return (pt_05(spark, sf_dir).agg(F.sum("rows").alias("rows"), ranges.alias("r"))
            .select("rows", (F.when(F.size("r") > 1, F.forall(after, lambda x: x)).otherwise(True)).alias("disjoint")))


@query("pt_06_skew_summary_totals", oracle="SELECT count(*) AS rows, TRUE AS max_holds_mean FROM customer")
def pt_06b(spark, sf_dir):
    sizes = L.partition_sizes(raw(spark, sf_dir, "customer").repartition(8, "c_nationkey"))
    return sizes.agg(F.sum("count").alias("rows"), ((F.max("count") >= F.avg("count")) & (F.min("count") <= F.avg("count"))).alias("max_holds_mean"))


@query("ex_18_compaction_keeps_rows", oracle="SELECT count(*) AS rows_before, count(*) AS rows_after, TRUE AS fewer_files FROM orders")
def ex_18b(spark, sf_dir):
    report = ex_18(spark, sf_dir)
    at = lambda stage, c: F.max(F.when(F.col("stage") == stage, F.col(c)))
    return report.agg(at("before", "rows").alias("rows_before"), at("after", "rows").alias("rows_after"),
                      (at("after", "files") < at("before", "files")).alias("fewer_files"))


@query("ex_18_small_file_report")
def ex_18(spark, sf_dir):
    path = scratch_root(spark, "many_files")
    raw(spark, sf_dir, "orders").repartition(16).write.mode("overwrite").parquet(path)
    compacted = scratch_root(spark, "compacted")
    L.compact(spark.read.parquet(path), compacted)           # file count from input bytes
    before = L.file_report(spark.read.parquet(path)).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    after = L.file_report(spark.read.parquet(compacted)).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    return before.withColumn("stage", F.lit("before")).unionByName(after.withColumn("stage", F.lit("after")))


@query("ud_01_native_vs_udf_forms", oracle=with_typed("""
SELECT c_custkey,
  concat(repeat('*', greatest(length(c_phone) - 4, 0)), right(c_phone, 4)) AS mask_native,
  concat(repeat('*', greatest(length(c_phone) - 4, 0)), right(c_phone, 4)) AS mask_python_udf,
  concat(repeat('*', greatest(length(c_phone) - 4, 0)), right(c_phone, 4)) AS mask_pandas_udf,
  CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'standard' ELSE 'premium' END AS band_native,
  CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'standard' ELSE 'premium' END AS band_python_udf,
  CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'standard' ELSE 'premium' END AS band_pandas_udf
FROM (SELECT n.*, c.c_phone FROM t_nullcust n JOIN t_customer c USING (c_custkey))""", "customer", extra=NULL_CUSTOMER_SQL))
def ud_01(spark, sf_dir):
    c = typed(spark, sf_dir, "customer")
    n = inject_nulls_customer(c).join(c.select("c_custkey", "c_phone"), "c_custkey")
    bal = F.col("c_acctbal").cast("double")
    return n.select("c_custkey",
                    C.mask("c_phone").alias("mask_native"), UDF.mask_udf("c_phone").alias("mask_python_udf"),
                    UDF.mask_pandas("c_phone").alias("mask_pandas_udf"),
                    C.balance_band("c_acctbal").alias("band_native"), UDF.band_udf(bal).alias("band_python_udf"),
                    UDF.band_pandas(bal).alias("band_pandas_udf"))
