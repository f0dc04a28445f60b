"""Bronze, silver and gold datasets for customer and nation.

Bronze: raw landing files as streams (CSV customer with a source-file
column, JSON nation), typed by inference from one batch read. Silver: a
typed, trimmed, upper-cased stream with quality rules (customer), and a
fully recomputed small dimension (nation). Gold: customers and average
balance per nation, recomputed from silver.

Each streaming step has its own checkpoint and runs ``availableNow``; the
steps run in dependency order from ``run``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators.quality import Rule, apply_rules
from lakeforge.plans.sqlkit import avg_money
from lakeforge.session import scratch_root
from lakeforge.sources import files as FS
from lakeforge.streaming import incremental as INC

# Names, predicates and actions of the inventory's rules (DQ-01 to DQ-03).
CUSTOMER_RULES = [
    Rule("non_negative_balance", "c_acctbal >= 0", "warn"),
    Rule("valid_key", "c_custkey IS NOT NULL", "drop"),
    Rule("known_nation", "c_nationkey BETWEEN 0 AND 24", "drop"),
    Rule("has_name", "c_name IS NOT NULL", "fail"),
]
NATION_RULES = [Rule("valid_region", "n_regionkey BETWEEN 0 AND 4", "drop")]


#: Types of the cleaned tables; text that does not parse becomes NULL, for the rules to catch.
SILVER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "decimal(18,2)", "n_nationkey": "int", "n_regionkey": "int"}


def _cleaned(bronze: DataFrame, **edits) -> DataFrame:
    """Table columns in their types, without arrival columns; ``edits`` are
    functions of single columns."""
    def clean(c: str):
        col = F.col(c).try_cast(SILVER_TYPES[c]) if c in SILVER_TYPES else F.col(c)
        return edits.get(c, lambda x: x)(col).alias(c)

    return bronze.select(*[clean(c) for c in bronze.columns if c in SILVER_COLUMNS])


SILVER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_nationkey", "n_name", "n_regionkey")


def silver_customer_projection(bronze: DataFrame) -> DataFrame:
    return _cleaned(bronze, c_name=F.trim, c_mktsegment=F.upper)


def silver_nation_projection(bronze: DataFrame) -> DataFrame:
    return _cleaned(bronze)


def gold_customers_by_nation(customers: DataFrame, nations: DataFrame) -> DataFrame:
    # ``nations`` is the 25-row dimension after its drop rule: bounded.
    return (customers.join(F.broadcast(nations), customers.c_nationkey == nations.n_nationkey)
            .groupBy("n_name")
            .agg(F.count(F.lit(1)).alias("customer_count"), avg_money("c_acctbal").alias("avg_acctbal")))


@dataclass
class Layout:
    landing: str
    root: str
    paths: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return self.paths.setdefault(name, f"{self.root}/{name}")


def run(spark: SparkSession, landing: str, root: str | None = None) -> dict:
    """Run the flow once over everything in ``landing``; returns frames and
    the silver customer rule counts."""
    lay = Layout(landing, root or scratch_root(spark, "medallion"))
    cust_schema = FS.kept_schema(spark, f"{landing}/customer_csv", "csv", lay.path("_ckpt/bronze_customer"))
    nat_schema = FS.kept_schema(spark, f"{landing}/nation_json", "json", lay.path("_ckpt/bronze_nation"))

    bronze_c = INC.file_stream(spark, f"{landing}/customer_csv", "csv", cust_schema, with_source_file=True)
    INC.run_available_now(bronze_c, lay.path("bronze_customer"), lay.path("_ckpt/bronze_customer"),
                          query_name="bronze_customer")
    bronze_n = INC.file_stream(spark, f"{landing}/nation_json", "json", nat_schema)
    INC.run_available_now(bronze_n, lay.path("bronze_nation"), lay.path("_ckpt/bronze_nation"),
                          query_name="bronze_nation")

    bronze_schema = spark.read.parquet(lay.path("bronze_customer")).schema
    silver_in = silver_customer_projection(spark.readStream.schema(bronze_schema).parquet(lay.path("bronze_customer")))
    # Rule counts ride on the stream as observed metrics, per micro-batch.
    observed = silver_in.observe("silver_customer_rules",
                                 *[F.count_if(~r.ok).alias(r.name) for r in CUSTOMER_RULES])
    silver = apply_rules(observed, CUSTOMER_RULES, "silver_customer")
    res = INC.run_available_now(silver, lay.path("silver_customer"), lay.path("_ckpt/silver_customer"),
                                query_name="silver_customer")
    violations = {r.name: 0 for r in CUSTOMER_RULES}
    for p in res.progress:
        m = (p.get("observedMetrics") or {}).get("silver_customer_rules") or {}
        for k in violations:
            violations[k] += int(m.get(k) or 0)

    nations = apply_rules(silver_nation_projection(spark.read.parquet(lay.path("bronze_nation"))),
                          NATION_RULES, "silver_nation")
    nations.write.mode("overwrite").parquet(lay.path("silver_nation"))      # materialised view: full recompute
    silver_c = spark.read.parquet(lay.path("silver_customer"))
    silver_n = spark.read.parquet(lay.path("silver_nation"))
    return {"silver_customer": silver_c, "silver_nation": silver_n,
            "gold_customers_by_nation": gold_customers_by_nation(silver_c, silver_n),
            "rows": res.rows, "violations": violations, "layout": lay}
