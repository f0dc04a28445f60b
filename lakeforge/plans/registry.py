"""Registry of named queries: a Spark builder and, where SQL can express
it, the equivalent DuckDB oracle text over the same parquet tables.

Money is computed as DECIMAL and emitted as DOUBLE: each query lists its
DECIMAL output columns (``MONEY_COLUMNS``) and both the Spark result and
the oracle are cast at the edge, so the two engines return the same types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    section: str

    @property
    def money(self) -> tuple[str, ...]:
        return MONEY_COLUMNS.get(self.name, ())

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        from lakeforge.session import configure
        configure(spark)                 # UTC, ANSI, AQE defaults; checkpoint dir known
        df = self.build(spark, sf_dir)
        if self.money:
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.col(c).cast("double") for c in self.money})
        return df

    def oracle_sql(self) -> str | None:
        if not self.oracle or not self.money:
            return self.oracle
        casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in self.money)
        return f"SELECT * REPLACE ({casts}) FROM ({self.oracle}) AS _q"


REGISTRY: dict[str, Query] = {}

# DECIMAL output columns per query, emitted as DOUBLE.
MONEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "prj_02_derived_decimal": ("c_acctbal", "acctbal_k"),
    "prj_03_with_columns": ("balance_k",),
    "prj_05_rename_drop": ("c_acctbal",),
    "prj_06_normalize_columns": ("acctbal",),
    "prj_06_normalize_then_write": ("acctbal",),
    "prj_07_try_cast": ("balance",),
    "prj_09_automobile_in_debt": ("balance_abs",),
    "flt_02_sql_string_where": ("c_acctbal",),
    "flt_03_boolean_membership": ("c_acctbal",),
    "cnd_01_when_chain": ("c_acctbal",),
    "sf_07_abs": ("balance_abs",),
    "sr_02_dot_access": ("balance",),
    "sr_03_flatten": ("balance",),
    "sr_04_nest_and_inline": ("balance",),
    "nl_01_inject_nulls": ("c_acctbal",),
    "nl_02_fill_per_column": ("c_acctbal",),
    "nl_03_drop_any": ("c_acctbal",),
    "nl_04_drop_subset": ("c_acctbal",),
    "nl_05_drop_thresh": ("c_acctbal",),
    "nl_06_coalesce": ("balance",),
    "so_01_union_by_name": ("c_acctbal",),
    "so_02_distinct": ("c_acctbal",),
    "so_04_dedup_latest": ("c_acctbal",),
    "src_02_csv_declared_schema": ("c_acctbal",),
    "src_03_csv_ddl_schema": ("c_acctbal",),
    "src_04_permissive_mode": ("c_acctbal",),
    "src_04_dropmalformed_mode": ("c_acctbal",),
    "src_10_table_stream_source": ("c_acctbal",),
    "sm_01_incremental_available_now": ("c_acctbal",),
    "snk_01_csv_write_read_back": ("o_totalprice",),
    "snk_05_merge_schema_append": ("c_acctbal",),
    "snk_08_stream_sink_table": ("c_acctbal",),
    "dq_05_cleaning_projection": ("c_acctbal",),
    "dq_02_expect_or_drop": ("c_acctbal",),
    "sm_09_multi_hop_silver": ("c_acctbal",),
    "pt_05_range_partitions": ("lo", "hi"),
    "ex_13_cdc_scd1": ("c_acctbal",),
    "ex_13_cdc_scd2": ("c_acctbal",),
    "ex_13_cdc_scd1_stream": ("c_acctbal",),
    "ex_13_cdc_scd2_stream": ("c_acctbal",),
    "ex_15_change_feed_between_snapshots": ("c_acctbal",),
}


def query(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, fn, oracle, fn.__module__.rsplit(".", 1)[-1])
        return fn
    return deco
