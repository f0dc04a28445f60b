"""2.1 Sources and scans, 2.2 sinks and table writes (round trips through
files under the shared scratch folder, compared with the parquet tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.functions import columns as C
from lakeforge.operators import relational as R
from lakeforge.plans.registry import query
from lakeforge.plans.sqlkit import temp_view
from lakeforge.session import scratch_root
from lakeforge.sources import files as FS
from lakeforge.sources.tables import raw, typed, with_typed
from lakeforge.streaming import incremental as INC

CUSTOMER_COLS = [f.name for f in FS.CUSTOMER_SCHEMA.fields]
CUSTOMER_SQL = with_typed(
    "SELECT c_custkey, c_name, c_nationkey, c_phone, c_acctbal, c_mktsegment FROM t_customer", "customer")


def _customer_csv(spark, sf_dir, name="customer_csv"):
    path = scratch_root(spark, name)
    FS.write_csv(typed(spark, sf_dir, "customer").select(*CUSTOMER_COLS), path)
    return path


@query("src_01_scan_registered_table", oracle="SELECT * FROM customer")
def src_01(spark, sf_dir):
    return spark.table(temp_view(raw(spark, sf_dir, "customer"), "customer_tbl"))


@query("src_02_csv_declared_schema", oracle=CUSTOMER_SQL)
def src_02(spark, sf_dir):
    return FS.read_csv(spark, _customer_csv(spark, sf_dir), FS.CUSTOMER_SCHEMA, mode="FAILFAST")


@query("src_03_csv_ddl_schema", oracle=CUSTOMER_SQL)
def src_03(spark, sf_dir):
    return FS.read_csv(spark, _customer_csv(spark, sf_dir), FS.CUSTOMER_DDL, mode="FAILFAST")


def _bad_csv(spark, sf_dir):
    """Customer CSV where every key ending in 07 (mod 100) has a bad balance."""
    c = typed(spark, sf_dir, "customer").select(*CUSTOMER_COLS)
    text = c.select(*[F.col(x).cast("string").alias(x) for x in CUSTOMER_COLS]).withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 100 == 7, F.lit("oops")).otherwise(F.col("c_acctbal")))
    path = scratch_root(spark, "customer_bad_csv")
    FS.write_csv(text, path)
    return path


@query("src_04_permissive_mode", oracle=with_typed(
    "SELECT c_custkey, CASE WHEN c_custkey % 100 = 7 THEN NULL ELSE c_acctbal END AS c_acctbal, "
    "c_custkey % 100 = 7 AS is_corrupt FROM t_customer", "customer"))
def src_04(spark, sf_dir):
    df = FS.read_csv(spark, _bad_csv(spark, sf_dir), FS.CUSTOMER_SCHEMA, mode="PERMISSIVE", keep_corrupt=True)
    return df.select("c_custkey", "c_acctbal", F.col(FS.CORRUPT).isNotNull().alias("is_corrupt"))


@query("src_04_dropmalformed_mode", oracle=with_typed(
    "SELECT c_custkey, c_acctbal FROM t_customer WHERE c_custkey % 100 <> 7", "customer"))
def src_04b(spark, sf_dir):
    df = FS.read_csv(spark, _bad_csv(spark, sf_dir), FS.CUSTOMER_SCHEMA, mode="DROPMALFORMED")
    return df.select("c_custkey", "c_acctbal")


# Segment to segment-group lookup rows.
SEGMENT_GROUPS = [("AUTOMOBILE", "auto"), ("BUILDING", "industrial"), ("FURNITURE", "consumer"),
                  ("HOUSEHOLD", "consumer"), ("MACHINERY", "industrial")]


@query("src_05_inline_rows_ddl", oracle="""
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'auto' WHEN 'BUILDING' THEN 'industrial'
  WHEN 'FURNITURE' THEN 'consumer' WHEN 'HOUSEHOLD' THEN 'consumer' WHEN 'MACHINERY' THEN 'industrial' END
  AS segment_group FROM customer""")
def src_05(spark, sf_dir):
    lookup = spark.createDataFrame(SEGMENT_GROUPS, "c_mktsegment STRING, segment_group STRING")
    c = raw(spark, sf_dir, "customer")
    # The lookup has a fixed row count, so the broadcast is bounded.
    return c.join(F.broadcast(lookup), "c_mktsegment", "left").select("c_custkey", "segment_group")


@query("src_06_range_calendar", oracle="""
SELECT CAST(g.d AS DATE) AS day, count(o.o_orderkey) AS orders
FROM generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY) g(d)
LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = CAST(g.d AS DATE) GROUP BY 1""")
def src_06(spark, sf_dir):
    o = typed(spark, sf_dir, "orders")
    lo, hi = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()   # two values, not data
    days = spark.range((hi - lo).days + 1).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("day"))
    per_day = o.groupBy(F.col("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return (days.join(per_day, "day", "left")
            .select("day", F.coalesce("n", F.lit(0)).alias("orders")))


@query("src_07_temp_view_sql", oracle="SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment")
def src_07(spark, sf_dir):
    v = temp_view(raw(spark, sf_dir, "customer"), "v_customer")
    return spark.sql(f"SELECT c_mktsegment, count(*) AS customers FROM {v} GROUP BY c_mktsegment")


@query("src_08_json_landing_stream", oracle=
       "SELECT n_name, CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def src_08(spark, sf_dir):
    landing = scratch_root(spark, "nation_json")
    raw(spark, sf_dir, "nation").write.mode("overwrite").json(landing)
    sink, ckpt = scratch_root(spark, "nation_sink"), scratch_root(spark, "nation_ckpt")
    schema = FS.kept_schema(spark, landing, "json", ckpt)     # JSON integers infer as BIGINT
    INC.run_available_now(INC.file_stream(spark, landing, "json", schema), sink, ckpt, query_name="src_08")
    return spark.read.parquet(sink)


@query("src_09_csv_landing_stream", oracle="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TRUE AS has_source_file FROM customer""")
def src_09(spark, sf_dir):
    landing = scratch_root(spark, "customer_landing_csv")
    FS.write_csv(raw(spark, sf_dir, "customer").repartition(4), landing)
    sink, ckpt = scratch_root(spark, "bronze_sink"), scratch_root(spark, "bronze_ckpt")
    schema = FS.kept_schema(spark, landing, "csv", ckpt)
    stream = INC.file_stream(spark, landing, "csv", schema, with_source_file=True)
    INC.run_available_now(stream, sink, ckpt, query_name="src_09")
    out = spark.read.parquet(sink)
    return out.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                      F.col("c_nationkey").cast("int").alias("c_nationkey"),
                      F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment",
                      F.col("_source_file").endswith(".csv").alias("has_source_file"))


def sign_band():
    return F.when(F.col("c_acctbal") < 0, "negative").otherwise("positive")


def incremental_customer(spark, sf_dir, name: str, via_table: bool):
    """Two appends, three availableNow runs: rows 500, rest, then nothing.

    Returns (sink frame, [rows per run], source rows)."""
    src_path = scratch_root(spark, f"{name}_source")
    source = typed(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    INC.append_batch(source, "c_custkey", 0, 500, src_path)
    table = None
    if via_table:
        table = f"{name}_source_tbl_{abs(hash(src_path)) % 10**8}"      # unique per call
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{src_path}'")
    schema = spark.read.parquet(src_path).schema
    sink, ckpt = scratch_root(spark, f"{name}_sink"), scratch_root(spark, f"{name}_ckpt")

    def run():
        stream = spark.readStream.table(table) if table else spark.readStream.schema(schema).parquet(src_path)
        if table:
            spark.sql(f"REFRESH TABLE {table}")
        return INC.run_available_now(stream.withColumn("balance_band", sign_band()), sink, ckpt,
                                     query_name=name).rows

    runs = [run()]
    INC.append_batch(source, "c_custkey", 500, 1 << 62, src_path)
    runs += [run(), run()]
    if table:
        spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(sink), runs


STREAM_SINK_SQL = with_typed(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, "
    "CASE WHEN c_acctbal < 0 THEN 'negative' ELSE 'positive' END AS balance_band FROM t_customer", "customer")


@query("src_10_table_stream_source", oracle=STREAM_SINK_SQL)
def src_10(spark, sf_dir):
    sink, _ = incremental_customer(spark, sf_dir, "src10", via_table=True)
    return sink.drop("arrived_at")


@query("sm_01_incremental_available_now", oracle=STREAM_SINK_SQL)
def sm_01(spark, sf_dir):
    sink, _ = incremental_customer(spark, sf_dir, "sm01", via_table=False)
    return sink.drop("arrived_at")


@query("sm_03_resume_counts", oracle="""
SELECT CAST(count(*) FILTER (WHERE c_custkey < 500) AS BIGINT) AS run_1,
       CAST(count(*) FILTER (WHERE c_custkey >= 500) AS BIGINT) AS run_2,
       CAST(0 AS BIGINT) AS run_3, count(*) AS sink_rows FROM customer""")
def sm_03(spark, sf_dir):
    sink, runs = incremental_customer(spark, sf_dir, "sm03", via_table=False)
    return sink.agg(F.count(F.lit(1)).alias("sink_rows")).select(
        *[F.lit(n).cast("bigint").alias(f"run_{i + 1}") for i, n in enumerate(runs)], "sink_rows")


@query("src_11_fk_subset", oracle="""
SELECT l.* FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_custkey % 25 = 0))""")
def src_11(spark, sf_dir):
    return fk_subset_tables(spark, sf_dir)["lineitem"]


def fk_subset_tables(spark, sf_dir, modulo: int = 25):
    """Keep customers with key % modulo = 0 and only their orders and line
    items (semi joins down the foreign-key chain; dimensions copied whole)."""
    customer = R.fk_subset(raw(spark, sf_dir, "customer"), "c_custkey", modulo)
    orders = R.semi(raw(spark, sf_dir, "orders"), customer, "o_custkey", "c_custkey")
    lineitem = R.semi(raw(spark, sf_dir, "lineitem"), orders, "l_orderkey", "o_orderkey")
    out = {t: raw(spark, sf_dir, t) for t in ("region", "nation", "supplier", "part")}
    out.update(customer=customer, orders=orders, lineitem=lineitem)
    return out


@query("src_12_row_count_report", oracle="""
SELECT 'region' AS "table", count(*) AS row_count FROM region UNION ALL
SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL
SELECT 'part', count(*) FROM part UNION ALL
SELECT 'customer', count(*) FROM customer WHERE c_custkey % 25 = 0 UNION ALL
SELECT 'orders', count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 25 = 0) UNION ALL
SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_custkey % 25 = 0))""")
def src_12(spark, sf_dir):
    return R.row_count_report(fk_subset_tables(spark, sf_dir))


@query("snk_01_csv_write_read_back", oracle=with_typed(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM t_orders", "orders"))
def snk_01(spark, sf_dir):
    o = typed(spark, sf_dir, "orders")
    path = scratch_root(spark, "orders_csv")
    FS.write_csv(o, path)
    return FS.read_csv(spark, path, o.schema, mode="FAILFAST")


@query("snk_05_merge_schema_append", oracle=with_typed(
    "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey >= 750 THEN c_phone END AS c_phone FROM t_customer",
    "customer"))
def snk_05(spark, sf_dir):
    c = typed(spark, sf_dir, "customer")
    path = scratch_root(spark, "customer_evolving")
    c.filter("c_custkey < 750").select("c_custkey", "c_name", "c_acctbal").write.mode("overwrite").parquet(path)
    c.filter("c_custkey >= 750").select("c_custkey", "c_name", "c_acctbal", "c_phone").write.mode("append").parquet(path)
    return FS.read_merged(spark, path)


@query("snk_07_append_with_arrival_time", oracle=
       "SELECT c_custkey, c_name, TRUE AS has_arrival FROM customer")
def snk_07(spark, sf_dir):
    path = scratch_root(spark, "arrivals")
    src = raw(spark, sf_dir, "customer").select("c_custkey", "c_name")
    INC.append_batch(src, "c_custkey", 0, 750, path)
    INC.append_batch(src, "c_custkey", 750, 1 << 62, path)
    return spark.read.parquet(path).select("c_custkey", "c_name", F.col("arrived_at").isNotNull().alias("has_arrival"))


@query("snk_08_stream_sink_table", oracle=STREAM_SINK_SQL)
def snk_08(spark, sf_dir):
    """Streaming sink registered as a session table (external, shared path)."""
    src_path = scratch_root(spark, "snk08_source")
    source = typed(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    source.write.mode("overwrite").parquet(src_path)
    sink_path, ckpt = scratch_root(spark, "snk08_sink"), scratch_root(spark, "snk08_ckpt")
    table = f"snk08_sink_{abs(hash(sink_path)) % 10**8}"                 # unique per call
    stream = spark.readStream.schema(source.schema).parquet(src_path).withColumn("balance_band", sign_band())
    q = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .option("path", sink_path).trigger(availableNow=True).toTable(table))
    q.awaitTermination()
    return FS.detached(spark, table)


@query("prj_06_normalize_then_write", oracle=with_typed(
    "SELECT c_custkey AS custkey, c_name AS name, c_acctbal AS acctbal FROM t_customer", "customer"))
def prj_06_write(spark, sf_dir):
    df = C.normalize_columns(typed(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"))
    path = scratch_root(spark, "normalized")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
