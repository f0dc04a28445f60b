"""Joins by time: as-of, points in intervals with and without a key."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.operators import temporal as TJ
from lakeforge.plans.registry import query
from lakeforge.sources.tables import raw, typed, with_typed

ASOF_ORDER_SQL = with_typed("""
SELECT e.event_id, e.user_id, o.o_orderkey, o.o_orderdate AS last_order_date FROM events e
ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM t_orders GROUP BY ALL) o
  ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate""", "orders")


def _events_and_orders(spark, sf_dir):
    return raw(spark, sf_dir, "events").select("event_id", "user_id", "ts"), typed(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")


@query("jn_18_asof_latest_order", oracle=ASOF_ORDER_SQL)
def jn_18(spark, sf_dir):
    """Each event with its user's latest order at or before it."""
    ev, orders = _events_and_orders(spark, sf_dir)
    got = TJ.asof_join(ev, orders, "user_id", "o_custkey", "ts", "o_orderdate", ["o_orderkey", "o_orderdate"], tiebreak="o_orderkey")
    return got.select("event_id", "user_id", "o_orderkey", F.col("o_orderdate").alias("last_order_date"))


#: Purchases, and the views before them: many of both for a user, in turn.
ASOF_VIEW_SQL = """
SELECT p.event_id, p.user_id, CASE WHEN {fresh} THEN v.view_id END AS view_id, CASE WHEN {fresh} THEN v.value END AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts AS view_ts, max(event_id) AS view_id, arg_max(value, event_id) AS value FROM events
                WHERE event_type = 'view' GROUP BY user_id, ts) v
  ON p.user_id = v.user_id AND p.ts {above} v.view_ts"""


def _purchases_and_views(spark, sf_dir):
    ev = raw(spark, sf_dir, "events")
    views = ev.where("event_type = 'view'").select(F.col("user_id").alias("viewer"), F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views


def _last_view(by_day: bool = False, **how):
    def build(spark, sf_dir):
        bought, views = _purchases_and_views(spark, sf_dir)
        if by_day:
            how["segment"] = F.to_date("_time")
        return TJ.asof_join(bought, views, "user_id", "viewer", "ts", "view_ts", ["view_id", "view_value"], tiebreak="view_id", **how).drop("ts")
    return build


query("jn_18_asof_last_view", oracle=ASOF_VIEW_SQL.format(fresh="TRUE", above=">="))(_last_view())
query("jn_18_asof_strictly_before", oracle=ASOF_VIEW_SQL.format(fresh="TRUE", above=">"))(_last_view(allow_equal=False))
query("jn_18_asof_within_a_day", oracle=ASOF_VIEW_SQL.format(fresh="v.view_ts >= p.ts - INTERVAL 1 DAY", above=">="))(_last_view(within="1 day"))
# every user cut by day, and hot users by sampled cuts: the same rows
query("jn_18_asof_segmented", oracle=ASOF_VIEW_SQL.format(fresh="TRUE", above=">="))(_last_view(by_day=True))
query("jn_18_asof_sampled_cuts", oracle=ASOF_VIEW_SQL.format(fresh="TRUE", above=">="))(
    _last_view(hot_fraction=0.0001, sample_fraction=1.0, rows_per_segment=8))


@query("jn_19_interval_same_user", oracle="""
SELECT e.event_id, e.user_id, s.event_id AS signup_id FROM events e
JOIN (SELECT * FROM events WHERE event_type = 'signup') s
  ON s.user_id = e.user_id AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 7 DAY
WHERE e.event_type = 'purchase'""")
def jn_19(spark, sf_dir):
    """Purchases within seven days after a signup of the same user."""
    ev = raw(spark, sf_dir, "events")
    weeks = ev.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("opens"),
                                                     (F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("closes"))
    bought = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return TJ.interval_join(bought, weeks, "ts", "opens", "closes", on=["user_id"]).select("event_id", "user_id", "signup_id")


@query("jn_19_interval_after_order", oracle=with_typed("""
SELECT l_orderkey, l_linenumber, o_orderkey, o_custkey FROM
  (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped, o_custkey AS buyer FROM lineitem JOIN t_orders ON l_orderkey = o_orderkey) l
JOIN t_orders o ON o.o_custkey = l.buyer AND l.shipped BETWEEN o.o_orderdate AND o.o_orderdate + 7""", "orders"))
def jn_19_orders(spark, sf_dir):
    """Lines shipped within seven days after any order of the same customer."""
    orders = typed(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("opens"), F.date_add("o_orderdate", 7).alias("closes"))
    lines = raw(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"))
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return (TJ.interval_join(lines.join(owner, "l_orderkey"), orders, "shipped", "opens", "closes", on=["o_custkey"])
            .select("l_orderkey", "l_linenumber", "o_orderkey", "o_custkey"))


@query("jn_19_range_without_key", oracle="""
SELECT v.event_id, e.event_id AS error_id FROM events v JOIN events e
  ON v.ts BETWEEN e.ts AND e.ts + to_seconds(30 + 30 * CAST(e.event_id % 64 AS INTEGER)) WHERE v.event_type = 'view' AND e.event_type = 'error'""")
def jn_19_range(spark, sf_dir):
    """Views of anyone during an outage: from an error on for 30 seconds to half an hour."""
    ev = raw(spark, sf_dir, "events")
    lasts = F.make_dt_interval(secs=F.lit(30) + F.lit(30) * (F.col("event_id") % 64))
    outages = ev.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), F.col("ts").alias("opens"), (F.col("ts") + lasts).alias("closes"))
    views = ev.where("event_type = 'view'").select("event_id", "ts")
    return TJ.interval_join(views, outages, "ts", "opens", "closes").select("event_id", "error_id")
