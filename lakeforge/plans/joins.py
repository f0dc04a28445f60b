"""2.4 Joins: equi-join types, semi/anti, bounded cross product, shared
key names, star join, strategy hints and NULL-aware NOT IN."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.operators import relational as R
from lakeforge.plans.registry import query
from lakeforge.plans.sqlkit import temp_view
from lakeforge.plans.windows import SPEND_SQL, customer_spend
from lakeforge.sources.tables import raw, typed, with_typed


def _nr(spark, sf_dir):
    nation = raw(spark, sf_dir, "nation").alias("n")
    region = R.dimension(raw(spark, sf_dir, "region"), "region").alias("r")
    return nation, region


def on_region():
    return F.col("n.n_regionkey") == F.col("r.r_regionkey")


@query("jn_01_inner_aliased", oracle="SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def jn_01(spark, sf_dir):
    n, r = _nr(spark, sf_dir)
    return n.join(r, on_region(), "inner").select("n.n_name", "r.r_name")


@query("jn_02_left_outer", oracle="""
SELECT n.n_name, r.r_name FROM nation n
LEFT JOIN (SELECT * FROM region WHERE r_name = 'EUROPE') r ON n.n_regionkey = r.r_regionkey""")
def jn_02(spark, sf_dir):
    n, r = _nr(spark, sf_dir)
    europe = r.filter("r_name = 'EUROPE'")
    return n.join(europe, on_region(), "left").select("n.n_name", "r.r_name")


@query("jn_02_unmatched_count", oracle="""
SELECT count(*) AS nations, count(*) FILTER (WHERE r.r_name IS NULL) AS unmatched FROM nation n
LEFT JOIN (SELECT * FROM region WHERE r_name = 'EUROPE') r ON n.n_regionkey = r.r_regionkey""")
def jn_02b(spark, sf_dir):
    return jn_02(spark, sf_dir).agg(F.count(F.lit(1)).alias("nations"),
                                    F.count_if(F.col("r_name").isNull()).alias("unmatched"))


@query("jn_03_right_outer", oracle="""
SELECT n.n_name, r.r_name FROM (SELECT * FROM nation WHERE n_nationkey < 3) n
RIGHT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def jn_03(spark, sf_dir):
    n, r = _nr(spark, sf_dir)
    return n.filter("n_nationkey < 3").join(r, on_region(), "right").select("n.n_name", "r.r_name")


@query("jn_04_full_outer", oracle="""
SELECT n.n_name, r.r_name FROM (SELECT * FROM nation WHERE n_nationkey < 3) n
FULL JOIN (SELECT * FROM region WHERE r_name = 'EUROPE') r ON n.n_regionkey = r.r_regionkey""")
def jn_04(spark, sf_dir):
    n, r = _nr(spark, sf_dir)
    return (n.filter("n_nationkey < 3").join(r.filter("r_name = 'EUROPE'"), on_region(), "full")
            .select("n.n_name", "r.r_name"))


def urgent_orders(spark, sf_dir):
    """Orders that only some customers have, so semi and anti joins split the table (FIXTURES.md)."""
    o = raw(spark, sf_dir, "orders")
    return o.filter((F.col("o_orderpriority") == "1-URGENT") &
                    (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))


def _with_orders(join, orders):
    def build(spark, sf_dir):
        c = raw(spark, sf_dir, "customer")
        return join(c, orders(spark, sf_dir), "c_custkey", "o_custkey").select("c_custkey", "c_name")
    return build


URGENT_SQL = "(SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01')"
for _name, _join, _not in (("jn_05_left_semi", R.semi, ""), ("jn_06_left_anti", R.anti, "NOT ")):
    for _suffix, _sql, _orders in (("", "orders", lambda spark, sf_dir: raw(spark, sf_dir, "orders")), ("_urgent", URGENT_SQL, urgent_orders)):
        query(_name + _suffix, oracle=f"SELECT c_custkey, c_name FROM customer c WHERE {_not}EXISTS "
                                      f"(SELECT 1 FROM {_sql} o WHERE o.o_custkey = c.c_custkey)")(_with_orders(_join, _orders))


@query("jn_07_bounded_cross", oracle="SELECT r_name, c_mktsegment FROM region, (SELECT DISTINCT c_mktsegment FROM customer)")
def jn_07(spark, sf_dir):
    # Cross product with a side of model-fixed size (5 regions), broadcast:
    # output is linear in the other side, never all pairs of two big sets.
    segments = raw(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    region = R.dimension(raw(spark, sf_dir, "region"), "region")
    return segments.crossJoin(region).select("r_name", "c_mktsegment")


@query("jn_08_join_on_shared_name", oracle="""
SELECT c.c_nationkey AS nationkey, c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def jn_08(spark, sf_dir):
    c = raw(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    n = R.dimension(raw(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nationkey"), "nation")
    return c.join(n, "nationkey").select("nationkey", "c_custkey", "n_name")


@query("jn_09_star_join", oracle=with_typed(
    "SELECT n_name, c_custkey, c_name, CAST(spend AS DOUBLE) AS total_spend, order_count FROM t_spend",
    "orders", "customer", extra=SPEND_SQL))
def jn_09(spark, sf_dir):
    return customer_spend(spark, sf_dir).select("n_name", "c_custkey", "c_name",
                                                F.col("spend").cast("double").alias("total_spend"), "order_count")


CN_SQL = "SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"


@query("jn_10_broadcast_hint", oracle=CN_SQL)
def jn_10(spark, sf_dir):
    c = raw(spark, sf_dir, "customer")
    n = raw(spark, sf_dir, "nation")
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


@query("jn_11_sql_broadcast_hint", oracle="""
SELECT n.n_name, count(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def jn_11(spark, sf_dir):
    vc = temp_view(raw(spark, sf_dir, "customer"), "v_customer")
    vn = temp_view(raw(spark, sf_dir, "nation"), "v_nation")
    return spark.sql(f"""
        SELECT /*+ BROADCAST(n) */ n.n_name, count(*) AS customers
        FROM {vc} c JOIN {vn} n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name""")


@query("jn_12_sort_merge_hint", oracle=CN_SQL)
def jn_12(spark, sf_dir):
    c = raw(spark, sf_dir, "customer")
    n = raw(spark, sf_dir, "nation")
    return c.hint("merge").join(n.hint("merge"), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


@query("jn_13_shuffle_hash_hint", oracle=CN_SQL)
def jn_13(spark, sf_dir):
    c = raw(spark, sf_dir, "customer")
    n = raw(spark, sf_dir, "nation")
    return c.join(n.hint("shuffle_hash"), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


_KEYS_WITH_NULL = ("(SELECT n_nationkey AS k FROM {nation} WHERE n_nationkey < 5 "
                   "UNION ALL SELECT CAST(NULL AS INT) AS k)")


@query("jn_14_not_in_with_null", oracle=f"""
SELECT (SELECT count(*) FROM customer WHERE c_nationkey NOT IN {_KEYS_WITH_NULL.format(nation='nation')}) AS not_in_rows,
       (SELECT count(*) FROM customer c WHERE NOT EXISTS
          (SELECT 1 FROM {_KEYS_WITH_NULL.format(nation='nation')} k WHERE k.k = c.c_nationkey)) AS anti_rows""")
def jn_14(spark, sf_dir):
    vc = temp_view(raw(spark, sf_dir, "customer"), "v_customer")
    vn = temp_view(raw(spark, sf_dir, "nation"), "v_nation")
    keys = _KEYS_WITH_NULL.format(nation=vn)
    return spark.sql(f"""
        SELECT (SELECT count(*) FROM {vc} WHERE c_nationkey NOT IN {keys}) AS not_in_rows,
               (SELECT count(*) FROM {vc} c LEFT ANTI JOIN {keys} k ON k.k = c.c_nationkey) AS anti_rows""")


@query("jn_15_suppliers_with_parts", oracle=with_typed(
    "SELECT s_suppkey, s_name FROM supplier s WHERE EXISTS (SELECT 1 FROM t_partsupp p WHERE p.ps_suppkey = s.s_suppkey)",
    "partsupp"))
def jn_15(spark, sf_dir):
    s = raw(spark, sf_dir, "supplier")
    ps = typed(spark, sf_dir, "partsupp")
    return R.semi(s, ps, "s_suppkey", "ps_suppkey").select("s_suppkey", "s_name")


def rich_suppliers(spark, sf_dir):
    return raw(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 5000)


def _nations_without(suppliers):
    def build(spark, sf_dir):
        n = raw(spark, sf_dir, "nation")
        return R.anti(n, suppliers(spark, sf_dir), "n_nationkey", "s_nationkey").select("n_nationkey", "n_name")
    return build


def _per_nation(suppliers):
    def build(spark, sf_dir):
        n, s = raw(spark, sf_dir, "nation"), suppliers(spark, sf_dir)
        return (n.join(s, n.n_nationkey == s.s_nationkey, "left").groupBy("n_name")
                .agg(F.count("s_suppkey").alias("suppliers")))
    return build


RICH_SUPPLIERS_SQL = "(SELECT * FROM supplier WHERE s_acctbal > 5000)"
for _suffix, _sql, _suppliers in (("", "supplier", lambda spark, sf_dir: raw(spark, sf_dir, "supplier")), ("_rich", RICH_SUPPLIERS_SQL, rich_suppliers)):
    query("jn_16_nations_without_suppliers" + _suffix, oracle=f"""
SELECT n_nationkey, n_name FROM nation n WHERE NOT EXISTS
  (SELECT 1 FROM {_sql} s WHERE s.s_nationkey = n.n_nationkey)""")(_nations_without(_suppliers))
    query("jn_17_suppliers_per_nation" + _suffix, oracle=f"""
SELECT n_name, count(s.s_suppkey) AS suppliers FROM nation n
LEFT JOIN {_sql} s ON s.s_nationkey = n.n_nationkey GROUP BY n_name""")(_per_nation(_suppliers))
