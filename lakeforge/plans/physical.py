"""2.18 EX-19 and EX-20, physical layout: overlap report, clustering by several
columns, bucketed joins, partition pruning by a join; and a partitioned table
function."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.functions.funnel import funnel
from lakeforge.operators import clustering as C
from lakeforge.operators.layout import bucketed, write_clustered
from lakeforge.plans.registry import query
from lakeforge.session import scratch_root
from lakeforge.sources.tables import raw, typed

# ------------------------------------------------------------------- EX-19
_FOLDERS = """
SELECT strftime(o_orderdate, '%Y-%m') AS unit, min(o_orderkey) AS k0, max(o_orderkey) AS k1, min(o_custkey) AS c0, max(o_custkey) AS c1,
  min(epoch(o_orderdate)) AS d0, max(epoch(o_orderdate)) AS d1, min(CAST(round(o_totalprice * 100) AS BIGINT)) AS p0,
  max(CAST(round(o_totalprice * 100) AS BIGINT)) AS p1 FROM orders GROUP BY 1"""
_RANGES = " UNION ALL ".join(f"SELECT unit, '{c}' AS column_name, CAST({v}0 AS BIGINT) AS lo, CAST({v}1 AS BIGINT) AS hi FROM folders"
                             for c, v in (("o_orderkey", "k"), ("o_custkey", "c"), ("o_orderdate", "d"), ("o_totalprice", "p")))


@query("ex_19_overlap_report", oracle=f"""
WITH folders AS ({_FOLDERS}), ranges AS ({_RANGES}),
depths AS (SELECT a.column_name, a.unit, count(*) AS depth FROM ranges a JOIN ranges b
  ON a.column_name = b.column_name AND b.lo <= a.lo AND a.lo <= b.hi GROUP BY a.column_name, a.unit),
pairs AS (SELECT a.column_name, count(b.unit) AS n FROM ranges a LEFT JOIN ranges b
  ON a.column_name = b.column_name AND a.unit < b.unit AND a.lo <= b.hi AND b.lo <= a.hi GROUP BY a.column_name)
SELECT column_name, count(*) AS files, CAST(0 AS BIGINT) AS empty_files, max(depth) AS max_depth, any_value(n) AS overlap_pairs,
  (SELECT count(*) FROM orders) AS rows,
  CAST(2 * any_value(n) AS DOUBLE) / count(*) AS mean_overlaps
FROM depths JOIN pairs USING (column_name) GROUP BY column_name""")
def ex_19_overlap(spark, sf_dir):
    """Orders in folders by month: their dates do not overlap, their keys,
    customers and prices do."""
    o = typed(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                              F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    path = scratch_root(spark, "orders_by_month")
    write_clustered(o, path, ["month"], ["o_orderkey"])
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    return C.overlap_report(C.file_ranges(spark.read.parquet(path), columns, unit=F.col("month")))


@query("ex_19_zorder_lowers_overlap", oracle="""
SELECT c AS column_name, (SELECT count(*) FROM orders) AS row_count, TRUE AS fewer_overlaps, TRUE AS lower_depth
FROM (VALUES ('o_custkey'), ('o_orderdate')) AS t(c)""")
def ex_19_zorder(spark, sf_dir):
    """Orders dealt to files by a hash, then clustered by customer and date:
    for both columns fewer files overlap."""
    o = typed(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    dealt, near = scratch_root(spark, "orders_dealt"), scratch_root(spark, "orders_zorder")
    columns, files = ["o_custkey", "o_orderdate"], 16
    o.repartition(files, "o_orderkey").write.parquet(dealt)
    C.write_zordered(o, near, columns, files)
    before, after = (C.overlap_report(C.file_ranges(spark.read.parquet(p), columns)) for p in (dealt, near))
    return after.alias("a").join(before.alias("b"), "column_name").select(
        "column_name", F.col("a.rows").alias("row_count"), (F.col("a.mean_overlaps") < F.col("b.mean_overlaps")).alias("fewer_overlaps"),
        (F.col("a.max_depth") < F.col("b.max_depth")).alias("lower_depth"))


@query("ex_19_bucketed_join", oracle="""
SELECT o_orderkey, o_orderpriority, count(*) AS lines, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority""")
def ex_19_bucketed(spark, sf_dir):
    """Orders and their lines, both bucketed by the order: join and aggregate
    without an exchange."""
    o = raw(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    li = raw(spark, sf_dir, "lineitem").select("l_orderkey", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    ob = bucketed(o, scratch_root(spark, "orders_bucketed"), "o_orderkey", 16)
    lb = bucketed(li, scratch_root(spark, "lineitem_bucketed"), "l_orderkey", 16)
    joined = ob.hint("merge").join(lb, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.sum("cents").alias("price_cents"))


# ------------------------------------------------------------------- EX-20
@query("ex_20_dynamic_partition_pruning", oracle="""
SELECT n_name, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS price_cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name""")
def ex_20_dynamic(spark, sf_dir):
    """A fact in folders by nation, read for one region: the nations of the
    region, known only at run time, choose the folders that are listed."""
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    fact = raw(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), "c_nationkey")
    path = scratch_root(spark, "orders_by_nation")
    write_clustered(fact, path, ["c_nationkey"], ["o_orderkey"])
    nations = raw(spark, sf_dir, "nation").join(
        raw(spark, sf_dir, "region").where(F.col("r_name") == "ASIA"), F.col("n_regionkey") == F.col("r_regionkey"))
    sales = spark.read.parquet(path).join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))   # 25 rows by the model
    return sales.groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("price_cents"))


# ------------------------------------------------- partitioned table function
@query("ud_02_funnel_table_function", oracle="""
WITH s1 AS (SELECT user_id, min(ts) AS a FROM events WHERE event_type = 'signup' GROUP BY 1),
s2 AS (SELECT e.user_id, min(ts) AS a FROM events e JOIN s1 ON e.user_id = s1.user_id AND ts > a WHERE event_type = 'view' GROUP BY 1),
s3 AS (SELECT e.user_id, min(ts) AS a FROM events e JOIN s2 ON e.user_id = s2.user_id AND ts > a WHERE event_type = 'click' GROUP BY 1),
s4 AS (SELECT e.user_id, min(ts) AS a FROM events e JOIN s3 ON e.user_id = s3.user_id AND ts > a WHERE event_type = 'purchase' GROUP BY 1)
SELECT user_id, CAST((s1.a IS NOT NULL)::INT + (s2.a IS NOT NULL)::INT + (s3.a IS NOT NULL)::INT + (s4.a IS NOT NULL)::INT AS INTEGER) AS steps_done,
  epoch_us(s1.a) AS step_1_us, epoch_us(s2.a) AS step_2_us, epoch_us(s3.a) AS step_3_us, epoch_us(s4.a) AS step_4_us
FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN s1 USING (user_id) LEFT JOIN s2 USING (user_id)
LEFT JOIN s3 USING (user_id) LEFT JOIN s4 USING (user_id)""")
def ud_02(spark, sf_dir):
    done = funnel(raw(spark, sf_dir, "events"), "user_id", "event_type", "ts", ["signup", "view", "click", "purchase"])
    return done.select("user_id", "steps_done", *[F.unix_micros(F.col(f"step_{i}_at").cast("timestamp")).alias(f"step_{i}_us") for i in (1, 2, 3, 4)])
