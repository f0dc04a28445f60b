"""Star-schema tables: declared schemas, checked loads, typed views.

The driver tables are parquet files ``<sf_dir>/<name>.parquet``. ``raw``
reads one as stored (schema checked against the declaration before any job
runs); ``typed`` gives the shape the operators expect: money as
DECIMAL(18,2), order dates as DATE, a phone text derived from keys, and the
derived ``partsupp`` fact. Every view is a lazy projection, so Catalyst still
prunes columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Dimensions whose row count is fixed by the data model (TPC-H: 5 regions,
# 25 nations), so a broadcast of them has a proven size bound at any scale.
BOUNDED_DIMENSIONS = {"region": 5, "nation": 25}


class SchemaMismatch(ValueError):
    pass


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def check_schema(df: DataFrame, expected: str | T.StructType, name: str = "") -> DataFrame:
    """Raise before any job runs if column names or types differ."""
    want = T._parse_datatype_string(expected) if isinstance(expected, str) else expected
    got = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in want.fields:
        if f.name not in got:
            problems.append(f"missing {f.name}")
        elif got[f.name] != f.dataType:
            problems.append(f"{f.name}: {got[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(path(sf_dir, name))
    if name in RAW_SCHEMAS:
        check_schema(df, RAW_SCHEMAS[name], name)
    return df


def phone(key: str, nationkey: str) -> Column:
    """Phone text built from keys (the driver tables carry none)."""
    k = F.col(key)
    return F.concat(
        (F.col(nationkey) + 10).cast("string"), F.lit("-"),
        F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"),
        F.lpad((k * 7 % 1000).cast("string"), 3, "0"), F.lit("-"),
        F.lpad((k * 13 % 10000).cast("string"), 4, "0"),
    )


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").alias(c)


#: Half a unit of the last decimal that ``money`` keeps.
HALF_CENT = 0.005


def money_above(c: str, bound: int) -> Column:
    """On a stored DOUBLE: whether its value as ``money`` is over ``bound``."""
    return F.col(c) >= F.lit(bound + HALF_CENT)


def money_below(c: str, bound: int) -> Column:
    return F.col(c) <= F.lit(bound - HALF_CENT)


def typed(spark: SparkSession, sf_dir: str, name: str, where: Column | None = None) -> DataFrame:
    """The table in the shape the operators use (see module doc). ``where``
    filters the stored columns, before any cast, so it reaches the scan."""
    stored = raw(spark, sf_dir, name) if name != "partsupp" else raw(spark, sf_dir, "lineitem")
    return shaped(stored if where is None else stored.filter(where), name)


def shaped(stored: DataFrame, name: str) -> DataFrame:
    """A stored table, or a stream of its rows, as ``typed`` gives it."""
    if name == "customer":
        return stored.select(
            "c_custkey", "c_name", "c_nationkey", money("c_acctbal"), "c_mktsegment",
            phone("c_custkey", "c_nationkey").alias("c_phone"))
    if name == "supplier":
        return stored.select(
            "s_suppkey", "s_name", "s_nationkey", money("s_acctbal"),
            phone("s_suppkey", "s_nationkey").alias("s_phone"))
    if name == "orders":
        return stored.select(
            "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice"),
            F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    if name == "partsupp":
        return partsupp(stored)
    return stored


def partsupp(lineitem: DataFrame) -> DataFrame:
    """Derived supplier-part fact: one row per (part, supplier) pair.

    A plain aggregate: partial (map-side) then final, one Exchange on the
    pair key, so a hot pair is combined before the shuffle.
    """
    return (lineitem.groupBy(F.col("l_partkey").alias("ps_partkey"),
                             F.col("l_suppkey").alias("ps_suppkey"))
            .agg(F.sum("l_quantity").cast("bigint").alias("ps_availqty"),
                 F.min("l_extendedprice").cast("decimal(18,2)").alias("ps_supplycost")))


# ---------------------------------------------------------------------------
# Oracle side: the same typed views as DuckDB SQL over the raw tables.
PHONE_SQL = ("concat(CAST({n} + 10 AS VARCHAR), '-', lpad(CAST({k} % 1000 AS VARCHAR), 3, '0'), '-', "
             "lpad(CAST({k} * 7 % 1000 AS VARCHAR), 3, '0'), '-', lpad(CAST({k} * 13 % 10000 AS VARCHAR), 4, '0'))")

TYPED_SQL: dict[str, str] = {
    "customer": "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, "
                "c_mktsegment, " + PHONE_SQL.format(k="c_custkey", n="c_nationkey") + " AS c_phone FROM customer",
    "supplier": "SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal, "
                + PHONE_SQL.format(k="s_suppkey", n="s_nationkey") + " AS s_phone FROM supplier",
    "orders": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, "
              "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders",
    "partsupp": "SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, CAST(SUM(l_quantity) AS BIGINT) AS ps_availqty, "
                "CAST(MIN(l_extendedprice) AS DECIMAL(18,2)) AS ps_supplycost FROM lineitem GROUP BY l_partkey, l_suppkey",
}


def with_typed(sql: str, *names: str, extra: str = "") -> str:
    """Prefix an oracle query with CTEs ``t_<name>`` for the typed views,
    followed by any ``extra`` CTE text."""
    ctes = [f"t_{n} AS ({TYPED_SQL[n]})" for n in names]
    if extra:
        ctes.append(extra)
    return f"WITH {', '.join(ctes)} {sql}"
