"""2.9 and 2.10 Scalar functions: string, math, cast, date and time."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.functions import columns as C
from lakeforge.functions import dates as D
from lakeforge.plans.registry import query
from lakeforge.sources.tables import raw, typed, with_typed


def _orders(spark, sf_dir):
    return typed(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("sf_01_upper", oracle="SELECT c_custkey, upper(c_name) AS name_upper FROM customer")
def sf_01(spark, sf_dir):
    return raw(spark, sf_dir, "customer").select("c_custkey", F.upper("c_name").alias("name_upper"))


@query("sf_02_substring_cast", oracle=with_typed(
    "SELECT c_custkey, c_phone, CAST(substring(c_phone, 1, 2) AS INTEGER) AS country_code FROM t_customer",
    "customer"))
def sf_02(spark, sf_dir):
    return typed(spark, sf_dir, "customer").select(
        "c_custkey", "c_phone", F.substring("c_phone", 1, 2).cast("int").alias("country_code"))


@query("sf_03_trim", oracle="SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS c_name FROM customer")
def sf_03(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    return raw(spark, sf_dir, "customer").select("c_custkey", F.trim(padded).alias("c_name"))


@query("sf_04_mask", oracle=with_typed("""
SELECT c_custkey, concat(repeat('*', greatest(length(c_phone) - 4, 0)), right(c_phone, 4)) AS phone_masked,
       repeat('*', length(c_phone)) AS phone_hidden,
       concat(repeat('*', greatest(length(c_name) - 20, 0)), right(c_name, 20)) AS name_short_unchanged
FROM t_customer""", "customer"))
def sf_04(spark, sf_dir):
    return typed(spark, sf_dir, "customer").select(
        "c_custkey", C.mask("c_phone").alias("phone_masked"), C.mask("c_phone", 0).alias("phone_hidden"),
        C.mask("c_name", 20).alias("name_short_unchanged"))


@query("sf_05_round", oracle=with_typed("""
SELECT o_orderkey, CAST(round(o_totalprice, 0) AS DOUBLE) AS price_0,
       CAST(round(o_totalprice, -3) AS DOUBLE) AS price_k,
       CAST(round(o_totalprice * CAST(0.001 AS DECIMAL(4,3)), 1) AS DOUBLE) AS price_in_k
FROM t_orders""", "orders"))
def sf_05(spark, sf_dir):
    p = F.col("o_totalprice")
    return _orders(spark, sf_dir).select(
        "o_orderkey", F.round(p, 0).cast("double").alias("price_0"),
        F.round(p, -3).cast("double").alias("price_k"),
        F.round(p / 1000, 1).cast("double").alias("price_in_k"))


@query("sf_06_arithmetic", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey,
       l_extendedprice * (1 - l_discount) AS net_price,
       l_extendedprice / l_quantity AS unit_price,
       l_orderkey % 7 AS bucket,
       l_quantity - 1 AS qty_less_one,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS qty_per_discount
FROM lineitem""")
def sf_06(spark, sf_dir):
    li = raw(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_orderkey") % 7).alias("bucket"),
        (F.col("l_quantity") - 1).alias("qty_less_one"),
        F.try_divide("l_quantity", "l_discount").alias("qty_per_discount"))


@query("sf_07_abs", oracle=with_typed(
    "SELECT c_custkey, abs(c_acctbal) AS balance_abs FROM t_customer", "customer"))
def sf_07(spark, sf_dir):
    return typed(spark, sf_dir, "customer").select("c_custkey", F.abs("c_acctbal").alias("balance_abs"))


# DT-01 .. DT-12: one query per calendar function, with its DuckDB twin.
_DATE_SQL = {
    "yr": "CAST(year(o_orderdate) AS INTEGER)",
    "qtr": "CAST(quarter(o_orderdate) AS INTEGER)",
    "mon": "CAST(month(o_orderdate) AS INTEGER)",
    "dow": "CAST(dayofweek(o_orderdate) + 1 AS INTEGER)",
    "week": "CAST(weekofyear(o_orderdate) AS INTEGER)",
    "plus_45d": "CAST(o_orderdate + INTERVAL 45 DAY AS DATE)",
    "plus_2m": "CAST(o_orderdate + INTERVAL 2 MONTH AS DATE)",
    "month_end": "last_day(o_orderdate)",
    "quarter_start": "CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP)",
    "month_start": "CAST(date_trunc('month', o_orderdate) AS DATE)",
    "days_until_2000": "CAST(datediff('day', o_orderdate, DATE '2000-01-01') AS INTEGER)",
    "formatted": "strftime(o_orderdate, '%Y-%m (%a)')",
}
_DATE_IDS = [("dt_01", "year", "yr"), ("dt_02", "quarter", "qtr"), ("dt_03", "month", "mon"),
             ("dt_04", "dayofweek", "dow"), ("dt_05", "weekofyear", "week"), ("dt_06", "date_add", "plus_45d"),
             ("dt_07", "add_months", "plus_2m"), ("dt_08", "last_day", "month_end"),
             ("dt_09", "date_trunc", "quarter_start"), ("dt_10", "trunc", "month_start"),
             ("dt_11", "datediff", "days_until_2000"), ("dt_12", "date_format", "formatted")]


def _date_query(col: str):
    def build(spark, sf_dir):
        part = D.calendar(col, "o_orderdate")
        # the truncated timestamp without a zone, as the oracle has it
        part = part.cast("timestamp_ntz") if col == "quarter_start" else part
        return _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", part.alias(col))
    return build


for _id, _fn, _col in _DATE_IDS:
    query(f"{_id}_{_fn}", oracle=with_typed(
        f"SELECT o_orderkey, o_orderdate, {_DATE_SQL[_col]} AS {_col} FROM t_orders", "orders"))(_date_query(_col))


@query("dt_12_date_format_day_month", oracle=with_typed(
    "SELECT o_orderkey, strftime(o_orderdate, '%d %b %Y') AS formatted FROM t_orders", "orders"))
def dt_12b(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", F.date_format("o_orderdate", "dd MMM yyyy").alias("formatted"))


# Order dates as text in the drill's pattern, with every 11th order garbled.
def _text():
    return F.when(F.col("o_orderkey") % 11 == 0, F.lit("bad")).otherwise(
        F.date_format(F.col("o_orderdate"), "MM/dd/yyyy HH:mm"))
_TEXT_SQL = ("CASE WHEN o_orderkey % 11 = 0 THEN 'bad' "
             "ELSE strftime(CAST(o_orderdate AS TIMESTAMP), '%m/%d/%Y %H:%M') END")


@query("dt_13_tolerant_parse", oracle=f"""
SELECT o_orderkey, {_TEXT_SQL} AS s, try_strptime({_TEXT_SQL}, '%m/%d/%Y %H:%M') AS ts FROM orders""")
def dt_13(spark, sf_dir):
    o = raw(spark, sf_dir, "orders").select("o_orderkey", _text().alias("s"))
    return o.select("o_orderkey", "s", D.parse_tolerant("s", "MM/dd/yyyy HH:mm").cast("timestamp_ntz").alias("ts"))


@query("dt_14_to_date", oracle=f"""
SELECT o_orderkey, CAST(try_strptime({_TEXT_SQL}, '%m/%d/%Y %H:%M') AS DATE) AS d FROM orders""")
def dt_14(spark, sf_dir):
    o = raw(spark, sf_dir, "orders").select("o_orderkey", _text().alias("s"))
    return o.select("o_orderkey", F.to_date(D.parse_tolerant("s", "MM/dd/yyyy HH:mm")).alias("d"))


@query("dt_15_current_date", oracle="""
SELECT o_orderkey, CAST(0 AS INTEGER) AS days_apart, TRUE AS same_day,
       CAST(datediff('day', CAST(o_orderdate AS DATE), current_date) AS INTEGER) AS age_days FROM orders""")
def dt_15(spark, sf_dir):
    # one moment for the whole query: date and timestamp agree in every row
    return _orders(spark, sf_dir).select(
        "o_orderkey", F.datediff(F.current_date(), F.to_date(F.current_timestamp())).alias("days_apart"),
        (F.to_date(F.now()) == F.current_date()).alias("same_day"),
        F.datediff(F.current_date(), "o_orderdate").alias("age_days"))


@query("dt_16_epoch_round_trip", oracle="""
SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS epoch_s,
       strftime(make_timestamp(CAST(epoch(o_orderdate) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_epoch
FROM orders""")
def dt_16(spark, sf_dir):
    o = raw(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return (o.select("o_orderkey", F.unix_timestamp(text).alias("epoch_s"))
            .withColumn("from_epoch", F.from_unixtime("epoch_s")))


@query("dt_17_months_between", oracle=with_typed("""
SELECT o_orderkey, round(
  CASE WHEN day(o_orderdate) = 2  -- same day of month: whole months
       THEN (1998 - year(o_orderdate)) * 12 + (8 - month(o_orderdate))
       ELSE (1998 - year(o_orderdate)) * 12 + (8 - month(o_orderdate)) + (2 - day(o_orderdate)) / 31.0 END, 8)
  AS months_between
FROM t_orders""", "orders"))
def dt_17(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", F.months_between(F.lit("1998-08-02").cast("date"), "o_orderdate").alias("months_between"))
