"""2.18 Outline items: higher-order functions, SQL functions and
parameters, SQL vs DataFrame, formats, maps, rescued data, idempotent
loads, CDC / SCD, change feed, profiles, salting, security, deletion,
star-schema keys, pandas API and key checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.functions.columns import SchemaViolation, conform

from lakeforge.functions import nested as N
from lakeforge.operators import profile as P
from lakeforge.operators import relational as R
from lakeforge.operators import scd as S
from lakeforge.operators import security as SEC
from lakeforge.operators import skew as SK
from lakeforge.plans.aggregates import NATION_FIGURES_SQL, nation_figures
from lakeforge.plans.registry import query
from lakeforge.plans.sqlkit import avg_money, sql_avg_money, temp_view
from lakeforge.session import scratch_root
from lakeforge.sources import files as FS
from lakeforge.sources.tables import money_above, raw, typed, with_typed

W = "string_split(p_name, ' ')"


@query("ex_01_higher_order_functions", oracle=f"""
SELECT p_partkey, array_to_string(list_transform({W}, lambda w: upper(w)), ' ') AS upper_words,
       array_to_string(list_filter({W}, lambda w: length(w) > 4), ' ') AS long_words,
       len(list_filter({W}, lambda w: w = 'red')) > 0 AS has_red,
       CAST(list_sum(list_transform({W}, lambda w: length(w))) AS INTEGER) AS letters
FROM part""")
def ex_01(spark, sf_dir):
    words = N.words("p_name")
    return raw(spark, sf_dir, "part").select(
        "p_partkey",
        F.array_join(F.transform(words, lambda w: F.upper(w)), " ").alias("upper_words"),
        F.array_join(F.filter(words, lambda w: F.length(w) > 4), " ").alias("long_words"),
        F.exists(words, lambda w: w == "red").alias("has_red"),
        F.aggregate(words, F.lit(0), lambda acc, w: acc + F.length(w)).alias("letters"))


@query("ex_02_sql_function_cte_params", oracle=with_typed(
    "SELECT c_custkey, CASE WHEN c_acctbal < 5000 THEN 'standard' ELSE 'premium' END AS band FROM pos", "customer",
    extra="pos AS (SELECT * FROM t_customer WHERE c_acctbal > 100)"))
def ex_02(spark, sf_dir):
    v = temp_view(typed(spark, sf_dir, "customer", money_above("c_acctbal", 100)), "v_customer")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION lf_band(b DECIMAL(18,2)) RETURNS STRING
                 RETURN CASE WHEN b < 5000 THEN 'standard' ELSE 'premium' END""")
    return spark.sql(f"""WITH pos AS (SELECT * FROM {v} WHERE c_acctbal > :min_balance)
                        SELECT c_custkey, lf_band(c_acctbal) AS band FROM pos""", args={"min_balance": 100})


@query("ex_04_sql_equals_dataframe", oracle=f"""
SELECT n_name, accounts, mean, balance, CAST(2 AS BIGINT) AS forms FROM ({NATION_FIGURES_SQL})""")
def ex_04(spark, sf_dir):
    """Rows that the DataFrame form and the SQL form both give: two forms of each."""
    df_form = nation_figures(spark, sf_dir).select("n_name", "accounts", "mean", "balance")
    vc, vn = temp_view(typed(spark, sf_dir, "customer"), "v_customer"), temp_view(raw(spark, sf_dir, "nation"), "v_nation")
    sql_form = spark.sql(f"""
        SELECT n_name, count(*) AS accounts, double(round(sum(c_acctbal) / count(c_acctbal), 2)) AS mean, double(sum(c_acctbal)) AS balance
        FROM {vc} JOIN {vn} ON c_nationkey = n_nationkey GROUP BY n_name""")
    return df_form.unionAll(sql_form).groupBy("n_name", "accounts", "mean", "balance").agg(F.count("*").alias("forms"))


@query("ex_05_format_round_trips", oracle="""
SELECT fmt AS format, (SELECT count(*) FROM orders) AS rows, CAST(0 AS BIGINT) AS mismatches
FROM (VALUES ('parquet'), ('orc'), ('json'), ('csv'), ('text')) v(fmt)""")
def ex_05(spark, sf_dir):
    o = typed(spark, sf_dir, "orders")
    parts = []
    for fmt in ("parquet", "orc", "json", "csv", "text"):
        back = FS.round_trip(o, scratch_root(spark, f"rt_{fmt}"), fmt)
        parts.append(back.agg(F.count(F.lit(1)).alias("rows"))
                     .crossJoin(o.exceptAll(back).agg(F.count(F.lit(1)).alias("mismatches")))
                     .select(F.lit(fmt).alias("format"), "rows", "mismatches"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("ex_06_maps", oracle="""
SELECT c_custkey, k AS key, v AS value FROM (
  SELECT c_custkey, 'nation' AS k, CAST(c_nationkey AS VARCHAR) AS v FROM customer
  UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer)""")
def ex_06(spark, sf_dir):
    m = F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("segment"), F.col("c_mktsegment"))
    c = raw(spark, sf_dir, "customer").select("c_custkey", m.alias("m"))
    # map_keys / map_values / map_from_entries round trip, then explode.
    rebuilt = c.select("c_custkey", F.map_from_arrays(F.map_keys("m"), F.map_values("m")).alias("m"))
    return rebuilt.select("c_custkey", F.explode("m").alias("key", "value"))


@query("ex_08_rescued_data", oracle="""
SELECT event_id, event_type, value,
       CASE WHEN event_id % 5 = 0 THEN '{"note":"n' || CAST(event_id AS VARCHAR) || '"}' END AS _rescued_data
FROM events""")
def ex_08(spark, sf_dir):
    ev = raw(spark, sf_dir, "events")
    extra = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("n"), F.col("event_id").cast("string")))
    lines = ev.select(F.to_json(F.struct("event_id", "event_type", "value", extra.alias("note"))).alias("value"))
    path = scratch_root(spark, "json_lines")
    lines.write.mode("overwrite").text(path)
    return N_rescue(spark.read.text(path), "event_id BIGINT, event_type STRING, value DOUBLE")


def N_rescue(text_df, ddl: str):
    """Parse JSON lines with a declared schema; keys outside it are kept as
    JSON text in ``_rescued_data`` (NULL when there are none)."""
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(ddl)
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    as_map = F.from_json("value", "map<string,string>")
    rest = F.map_filter(as_map, lambda k, v: ~F.array_contains(known, k))
    parsed = text_df.select(F.from_json("value", schema).alias("r"), rest.alias("_rest"))
    return parsed.select("r.*", F.when(F.size("_rest") > 0, F.to_json("_rest")).alias("_rescued_data"))


@query("ex_07_conform_by_name", oracle="""
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS c_comment, TRUE AS narrowing_refused FROM customer""")
def ex_07(spark, sf_dir):
    """Columns in another order and narrower types are taken by name, a
    missing one is NULL where allowed, and a cast that could lose data is refused."""
    target = T._parse_datatype_string("c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_comment STRING")
    c = raw(spark, sf_dir, "customer")
    try:
        conform(c.select("c_custkey"), T._parse_datatype_string("c_custkey INT"))
        refused = False
    except SchemaViolation:
        refused = True
    shuffled = c.select("c_nationkey", "c_name", "c_custkey")
    return conform(shuffled, target, allow_missing=True).withColumn("narrowing_refused", F.lit(refused))


@query("ex_20_partition_pruning", oracle="""
SELECT c_mktsegment, count(*) AS rows, TRUE AS only_its_folder FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY c_mktsegment""")
def ex_20(spark, sf_dir):
    """A filter on the partition column reads the files of that folder only."""
    path = scratch_root(spark, "by_segment")
    raw(spark, sf_dir, "customer").write.partitionBy("c_mktsegment").parquet(path)
    read = spark.read.parquet(path).where("c_mktsegment = 'BUILDING'")
    return (read.withColumn("here", F.col("_metadata.file_path").contains("/c_mktsegment=BUILDING/"))
            .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("here").alias("only_its_folder")))


@query("ex_09_copy_into_idempotent", oracle="SELECT c_custkey, c_name FROM customer")
def ex_09(spark, sf_dir):
    landing = scratch_root(spark, "copy_landing")
    raw(spark, sf_dir, "customer").select("c_custkey", "c_name").repartition(3).write.mode("overwrite").parquet(landing)
    target, ledger = scratch_root(spark, "copy_target"), scratch_root(spark, "copy_ledger")
    FS.copy_into(spark, landing, target, ledger)
    FS.copy_into(spark, landing, target, ledger)          # second run loads nothing new
    return spark.read.parquet(target).drop("batch")


# -------------------------------------------------------------- CDC, SCD
def changes(spark, sf_dir):
    """A change feed derived from customer: insert at seq 1, a balance
    update at seq 2 for keys % 3 = 0, a delete at seq 3 for keys % 7 = 0;
    rows arrive out of sequence order."""
    c = typed(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    ins = c.withColumns({"seq": F.lit(1), "op": F.lit("upsert")})
    upd = c.filter("c_custkey % 3 = 0").withColumns({
        "c_acctbal": (F.col("c_acctbal") + 100).cast("decimal(18,2)"), "seq": F.lit(2), "op": F.lit("upsert")})
    dele = c.filter("c_custkey % 7 = 0").withColumns({"seq": F.lit(3), "op": F.lit("delete")})
    return dele.unionByName(upd).unionByName(ins)


CHG_SQL = ("chg AS (SELECT c_custkey, c_name, c_acctbal, 1 AS seq, 'upsert' AS op FROM t_customer "
           "UNION ALL SELECT c_custkey, c_name, CAST(c_acctbal + 100 AS DECIMAL(18,2)), 2, 'upsert' FROM t_customer WHERE c_custkey % 3 = 0 "
           "UNION ALL SELECT c_custkey, c_name, c_acctbal, 3, 'delete' FROM t_customer WHERE c_custkey % 7 = 0)")


@query("ex_13_cdc_scd1", oracle=with_typed("""
SELECT c_custkey, c_name, c_acctbal, seq FROM chg
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1 AND op <> 'delete'""", "customer", extra=CHG_SQL))
def ex_13(spark, sf_dir):
    return S.apply_scd1(changes(spark, sf_dir), ["c_custkey"], "seq")


@query("ex_13_cdc_scd2", oracle=with_typed("""
SELECT c_custkey, c_name, c_acctbal, valid_to, seq AS valid_from, valid_to IS NULL AS is_current FROM (
  SELECT *, lead(seq) OVER (PARTITION BY c_custkey ORDER BY seq) AS valid_to FROM chg) WHERE op <> 'delete'""",
    "customer", extra=CHG_SQL))
def ex_13b(spark, sf_dir):
    return S.apply_scd2(changes(spark, sf_dir), ["c_custkey"], "seq", segment_width=2)


@query("ex_14_scd2_upsert", oracle=with_typed("""
SELECT c_custkey, c_mktsegment, valid_from, valid_to, is_current FROM (
  SELECT c_custkey, c_mktsegment, DATE '2024-01-01' AS valid_from,
         CASE WHEN c_custkey % 4 = 0 THEN DATE '2024-06-01' END AS valid_to, c_custkey % 4 <> 0 AS is_current FROM t_customer
  UNION ALL SELECT c_custkey, 'RETAIL', DATE '2024-06-01', NULL, TRUE FROM t_customer WHERE c_custkey % 4 = 0
  UNION ALL SELECT 9000001, 'RETAIL', DATE '2024-06-01', NULL, TRUE)""", "customer"))
def ex_14(spark, sf_dir):
    c = typed(spark, sf_dir, "customer")
    dim = c.select("c_custkey", "c_mktsegment", F.lit("2024-01-01").cast("date").alias("valid_from"),
                   F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    eff = F.lit("2024-06-01").cast("date").alias("effective")
    moved = c.filter("c_custkey % 4 = 0").select("c_custkey", F.lit("RETAIL").alias("c_mktsegment"), eff)
    same = c.filter("c_custkey % 4 = 1").select("c_custkey", "c_mktsegment", eff)      # no change: no new version
    new = spark.range(1).select(F.lit(9000001).cast("bigint").alias("c_custkey"), F.lit("RETAIL").alias("c_mktsegment"), eff)
    return S.scd2_upsert(dim, moved.unionByName(same).unionByName(new), ["c_custkey"], ["c_mktsegment"], "effective")


@query("ex_15_change_feed_between_snapshots", oracle=with_typed("""
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN t.k IN ('insert', 'update_postimage') THEN a.c_name ELSE b.c_name END AS c_name,
       CASE WHEN t.k IN ('insert', 'update_postimage') THEN a.c_acctbal ELSE b.c_acctbal END AS c_acctbal, t.k AS _change_type
FROM t_customer_nb b FULL JOIN a ON a.c_custkey = b.c_custkey,
     (VALUES ('insert'), ('delete'), ('update_preimage'), ('update_postimage')) t(k)
WHERE (t.k = 'insert' AND b.c_custkey IS NULL) OR (t.k = 'delete' AND a.c_custkey IS NULL)
   OR (t.k LIKE 'update%' AND a.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL AND (a.c_acctbal <> b.c_acctbal OR a.c_name <> b.c_name))""",
    "customer", extra="t_customer_nb AS (SELECT c_custkey, c_name, c_acctbal FROM t_customer), "
    "a AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_acctbal + 1 AS DECIMAL(18,2)) "
    "ELSE c_acctbal END AS c_acctbal FROM t_customer WHERE c_custkey % 11 <> 0 "
    "UNION ALL SELECT c_custkey + 100000, c_name, c_acctbal FROM t_customer WHERE c_custkey % 13 = 0)"))
def ex_15(spark, sf_dir):
    c = typed(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    after = (c.filter("c_custkey % 11 <> 0")
             .withColumn("c_acctbal", F.when(F.col("c_custkey") % 5 == 0, (F.col("c_acctbal") + 1).cast("decimal(18,2)"))
                         .otherwise(F.col("c_acctbal")))
             .unionByName(c.filter("c_custkey % 13 = 0").withColumn("c_custkey", F.col("c_custkey") + 100000)))
    return S.change_feed(c, after, ["c_custkey"])


# --------------------------------------------------------- profile, skew
PROFILE_COLS = ["l_quantity", "l_discount", "l_tax", "l_partkey"]


@query("ex_17_profile", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS \"distinct\", "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"round(CAST(sum(CAST(round({c} * 100) AS HUGEINT)) AS DOUBLE) / 100 / count({c}), 6) AS mean FROM lineitem"
    for c in PROFILE_COLS))
def ex_17(spark, sf_dir):
    out = P.profile(raw(spark, sf_dir, "lineitem"), PROFILE_COLS)
    # Means of doubles depend on summation order in the last bits; compare at 6 places.
    return out.withColumn("mean", F.round("mean", 6)).drop("median")


@query("ex_17_medians", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS \"values\", TRUE AS within_rank_error FROM lineitem" for c in PROFILE_COLS))
def ex_17c(spark, sf_dir):
    """The rank of each profile's median, counted on the table."""
    li = raw(spark, sf_dir, "lineitem")
    medians = F.broadcast(P.profile(li, PROFILE_COLS).select("column", "median"))      # one row a column
    pairs = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in PROFILE_COLS])).alias("p")).select("p.*")
    ranked = pairs.join(medians, "column").groupBy("column").agg(
        F.count("v").alias("values"), F.count_if(F.col("v") < F.col("median")).alias("below"), F.count_if(F.col("v") <= F.col("median")).alias("upto"))
    slack = F.col("values") * (2.0 / P.ACCURACY) + 1
    fine = (F.col("below") <= F.col("values") / 2 + slack) & (F.col("upto") >= F.col("values") / 2 - slack)
    return ranked.select("column", "values", fine.alias("within_rank_error"))


def _ranks_hold(li, sketches):
    """For each column, whether every percentile's rank, counted on the table, is within the sketch's error."""
    points = P.percentiles(sketches).select("column", F.posexplode("percentiles").alias("i", "at"))       # 99 rows a column
    pairs = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in PROFILE_COLS])).alias("p")).select("p.*")
    counted = pairs.join(F.broadcast(points), "column").groupBy("column", "i").agg(
        F.count("v").alias("values"), F.count_if(F.col("v") < F.col("at")).alias("below"), F.count_if(F.col("v") <= F.col("at")).alias("upto"))
    share, slack = (F.col("i") + 1) / 100, F.col("values") * P.SKETCH_ERROR + 1
    fine = (F.col("below") <= share * F.col("values") + slack) & (F.col("upto") >= share * F.col("values") - slack)
    return counted.groupBy("column").agg(F.max("values").alias("values"), F.count(F.lit(1)).alias("percentiles"), F.bool_and(fine).alias("within_rank_error"))


_RANKS_SQL = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS \"values\", CAST(99 AS BIGINT) AS percentiles, TRUE AS within_rank_error FROM lineitem" for c in PROFILE_COLS)


@query("ex_17_percentiles", oracle=_RANKS_SQL)
def ex_17_percentiles(spark, sf_dir):
    """The ranks of the 1st to 99th percentiles of one sketch a column."""
    li = raw(spark, sf_dir, "lineitem")
    return _ranks_hold(li, P.quantile_sketches(li, PROFILE_COLS))


@query("ex_17_percentiles_of_merged_months", oracle=_RANKS_SQL)
def ex_17_merged(spark, sf_dir):
    """The same from sketches of each month, merged."""
    li = raw(spark, sf_dir, "lineitem")
    months = P.quantile_sketches(li.withColumn("month", F.date_trunc("month", "l_shipdate")), PROFILE_COLS, by=["month"])
    return _ranks_hold(li, P.merge_sketches(months))


@query("ex_17_distribution_drift", oracle=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(max(abs(fa - fb)), 1) AS distance FROM (
  SELECT v, sum(a) OVER w / sum(a) OVER () AS fa, sum(b) OVER w / sum(b) OVER () AS fb FROM (
    SELECT {c} AS v, CAST(count(*) FILTER (WHERE l_quantity < 20) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE l_quantity >= 20) AS DOUBLE) AS b FROM lineitem GROUP BY {c})
  WINDOW w AS (ORDER BY v))""" for c in ("l_quantity", "l_discount", "l_tax")))
def ex_17_distance(spark, sf_dir):
    """Lines of few and of many pieces: quantities lie apart, the others alike; to one decimal."""
    li = raw(spark, sf_dir, "lineitem")
    found = P.distribution_drift(li.where("l_quantity < 20"), li.where("l_quantity >= 20"), ["l_quantity", "l_discount", "l_tax"])
    return found.withColumn("distance", F.round("distance", 1))


_PART = "FILTER (WHERE l_shipdate {} TIMESTAMP '1998-01-01')"


def _mean_sql(c: str, part: str) -> str:
    return f"CAST(sum(CAST(round({c} * 100) AS HUGEINT)) {part} AS DOUBLE) / 100 / count({c}) {part}"


@query("ex_17_drift", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) {_PART.format('<')} AS rows_a, count(*) {_PART.format('>=')} AS rows_b, "
    f"round({_mean_sql(c, _PART.format('>='))} - {_mean_sql(c, _PART.format('<'))}, 4) + 0.0 AS mean_change, "
    f"CAST(0 AS DOUBLE) AS null_share_change FROM lineitem" for c in PROFILE_COLS))
def ex_17b(spark, sf_dir):
    li = raw(spark, sf_dir, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    d = P.drift(li.filter(F.col("l_shipdate") < cut), li.filter(F.col("l_shipdate") >= cut), PROFILE_COLS)
    return d.select("column", "rows_a", "rows_b", (F.round("mean_change", 4) + 0.0).alias("mean_change"), "null_share_change")


def skewed_orders(spark, sf_dir):
    """Orders where a third of the rows belong to customer 0."""
    o = raw(spark, sf_dir, "orders")
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("o_custkey")))


SKEW_SQL = ("so AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey, "
            "o_totalprice FROM orders)")


@query("ex_21_skew_salted_join", oracle=f"""WITH {SKEW_SQL}
SELECT o_orderkey, o_custkey, c_name FROM so JOIN customer ON o_custkey = c_custkey""")
def ex_21(spark, sf_dir):
    o = skewed_orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return SK.skew_join(o, c, "o_custkey", "c_custkey", hot_fraction=0.05).select("o_orderkey", "o_custkey", "c_name")


def _outer(how: str):
    def build(spark, sf_dir):
        # customers of every second nation only, so that both sides have rows without a partner
        o = skewed_orders(spark, sf_dir).select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"))
        c = raw(spark, sf_dir, "customer").where("c_nationkey % 2 = 0").select("c_custkey", "c_name")
        return SK.skew_join(o, c, "o_custkey", "c_custkey", hot_fraction=0.05, how=how, rows_per_salt=100).select("o_orderkey", "o_custkey", "c_name")
    return build


for _how in ("left", "right", "full"):
    query(f"ex_21_skew_join_{_how}", oracle=f"""WITH {SKEW_SQL}
SELECT o_orderkey, o_custkey, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey FROM so)
{_how} JOIN (SELECT * FROM customer WHERE c_nationkey % 2 = 0) ON o_custkey = c_custkey""")(_outer(_how))


@query("ex_21_skew_two_step_aggregate", oracle=f"""WITH {SKEW_SQL}
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS rows FROM so GROUP BY o_custkey""")
def ex_21b(spark, sf_dir):
    o = skewed_orders(spark, sf_dir).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return SK.salted_sum(o, "o_custkey", "o_totalprice", salts=8).withColumn("total", F.col("total").cast("double"))


# -------------------------------------------------------------- security
# Which regions each reader group may see, and which groups read clear text.
ENTITLEMENTS = [("emea", "EUROPE"), ("emea", "MIDDLE EAST"), ("emea", "AFRICA"), ("amer", "AMERICA"), ("apac", "ASIA")]
GROUPS = [("emea", False), ("amer", False), ("apac", True)]


def _cust_region(spark, sf_dir):
    c = typed(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_phone", "c_nationkey")
    n = R.dimension(raw(spark, sf_dir, "nation"), "nation")
    r = R.dimension(raw(spark, sf_dir, "region"), "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        "c_custkey", "c_name", "c_phone", "r_name")


MASK_SQL = "concat(repeat('*', greatest(length(c_phone) - 4, 0)), right(c_phone, 4))"
CR_SQL = ("cr AS (SELECT c_custkey, c_name, c_phone, r_name FROM t_customer JOIN nation ON c_nationkey = n_nationkey "
          "JOIN region ON n_regionkey = r_regionkey)")


@query("ex_22_row_filter_and_mask", oracle=with_typed(
    f"SELECT c_custkey, c_name, {MASK_SQL} AS c_phone, r_name FROM cr WHERE r_name IN ('EUROPE', 'MIDDLE EAST', 'AFRICA')",
    "customer", extra=CR_SQL))
def ex_22(spark, sf_dir):
    ent = spark.createDataFrame(ENTITLEMENTS, "group STRING, value STRING")
    return SEC.masked(SEC.row_filter(_cust_region(spark, sf_dir), F.broadcast(ent), "emea", "r_name"), ["c_phone"])


@query("ex_23_dynamic_view", oracle=with_typed(f"""
SELECT e.g AS "group", c_custkey, c_name, CASE WHEN e.g = 'apac' THEN c_phone ELSE {MASK_SQL} END AS c_phone, r_name
FROM cr JOIN (VALUES ('emea', 'EUROPE'), ('emea', 'MIDDLE EAST'), ('emea', 'AFRICA'), ('amer', 'AMERICA'), ('apac', 'ASIA')) e(g, v)
ON r_name = e.v""", "customer", extra=CR_SQL))
def ex_23(spark, sf_dir):
    ent = F.broadcast(spark.createDataFrame(ENTITLEMENTS, "group STRING, value STRING"))
    groups = spark.createDataFrame(GROUPS, "group STRING, unmasked BOOLEAN")
    view = SEC.dynamic_view(_cust_region(spark, sf_dir), ent, groups, "r_name", ["c_phone"])
    return spark.table(temp_view(view, "v_customer_by_group")).select("group", "c_custkey", "c_name", "c_phone", "r_name")


@query("ex_24_erase_cascade", oracle="""
WITH gone_c AS (SELECT c_custkey FROM customer WHERE c_custkey % 50 = 7),
gone_o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone_c))
SELECT 'customer' AS "table", count(*) AS row_count FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone_c)
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone_o)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone_o)""")
def ex_24(spark, sf_dir):
    tables = {t: raw(spark, sf_dir, t) for t in ("customer", "orders", "lineitem")}
    erase_keys = tables["customer"].filter("c_custkey % 50 = 7").select(F.col("c_custkey").alias("key"))
    chain = [("customer", "c_custkey", None, None), ("orders", "o_custkey", "customer", "c_custkey"),
             ("lineitem", "l_orderkey", "orders", "o_orderkey")]
    return R.row_count_report(SEC.erase(tables, erase_keys, chain))


@query("ex_26_star_schema_surrogate_keys", oracle=with_typed(
    "SELECT ps_partkey, ps_suppkey, ps_availqty, TRUE AS resolved FROM t_partsupp", "partsupp"))
def ex_26(spark, sf_dir):
    """Dimensions keyed by ``xxhash64`` of the natural key; the fact looks
    its surrogate keys up by join and keeps the natural keys for checking."""
    dim_part = raw(spark, sf_dir, "part").select(F.xxhash64("p_partkey").alias("part_sk"), "p_partkey")
    dim_supp = raw(spark, sf_dir, "supplier").select(F.xxhash64("s_suppkey").alias("supp_sk"), "s_suppkey")
    ps = typed(spark, sf_dir, "partsupp")
    fact = (ps.join(dim_part, ps.ps_partkey == dim_part.p_partkey, "left")
            .join(dim_supp, ps.ps_suppkey == dim_supp.s_suppkey, "left"))
    resolved = (F.col("part_sk") == F.xxhash64("ps_partkey")) & (F.col("supp_sk") == F.xxhash64("ps_suppkey"))
    return fact.select("ps_partkey", "ps_suppkey", "ps_availqty", F.coalesce(resolved, F.lit(False)).alias("resolved"))


@query("ex_31_pandas_api", oracle="""
SELECT c_mktsegment, count(*) AS customers, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS balance_cents
FROM customer GROUP BY c_mktsegment""")
def ex_31(spark, sf_dir):
    psdf = raw(spark, sf_dir, "customer").pandas_api()
    psdf["balance_cents"] = (psdf["c_acctbal"] * 100).round().astype("int64")
    g = psdf.groupby("c_mktsegment").agg({"c_custkey": "count", "balance_cents": "sum"}).reset_index()
    return g.to_spark().withColumnRenamed("c_custkey", "customers")


@query("ex_32_key_checks", oracle="""
SELECT 'customer_key_unique' AS "check", CAST(count(*) - count(DISTINCT c_custkey) AS BIGINT) AS violations FROM customer
UNION ALL SELECT 'orders_orphans', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem_orphans', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem_line_unique', CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) FROM lineitem""")
def ex_32(spark, sf_dir):
    c, o, li = (raw(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))

    def dup(df, keys, name):
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            (F.sum("n") - F.count(F.lit(1))).alias("violations")).select(F.lit(name).alias("check"), "violations")

    def orphans(child, parent, ck, pk, name):
        return R.anti(child, parent, ck, pk).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check"), "violations")

    return (dup(c, ["c_custkey"], "customer_key_unique")
            .unionByName(orphans(o, c, "o_custkey", "c_custkey", "orders_orphans"))
            .unionByName(orphans(li, o, "l_orderkey", "o_orderkey", "lineitem_orphans"))
            .unionByName(dup(li, ["l_orderkey", "l_linenumber"], "lineitem_line_unique")))


@query("ex_19_clustered_layout_round_trip", oracle=with_typed(
    "SELECT o_orderkey, o_custkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS yr FROM t_orders", "orders"))
def ex_19(spark, sf_dir):
    from lakeforge.operators.layout import write_clustered
    o = typed(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.year("o_orderdate").alias("yr"))
    path = scratch_root(spark, "clustered_orders")
    write_clustered(o, path, ["yr"], ["o_custkey"])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderdate", "yr")
