"""Keyed upsert (MERGE) without a table format: a lazy plan that labels
every output row with ``_action`` (update, insert, delete, keep), metrics
from the same plan, and snapshot / partition-scoped writes.

Conditions and assignments are SQL text or Columns over two structs,
``t`` (target row) and ``s`` (source row), e.g. ``"t.c_acctbal <> s.c_acctbal"``.

Plan choice. A change batch is usually small next to the target. A source of
up to ``broadcast_bytes`` is broadcast into a left join from the target, so
the target's rows are scanned once and never shuffled; inserts come from a
broadcast anti join against the distinct matched keys, for which the target's
key columns alone are read again. Beyond the bound the plan is one full outer
join on the keys, a shuffle of both sides. Source keys that match are unique,
so only a target key can be skewed there; adaptive execution does not split
full outer joins, so for such a target merge by a finer key or in buckets.

``plan()`` runs jobs over the source alone, as long as its keys differ: one
that looks for repeated keys, and, only where the plan's size statistics are
near the bound or above, one that adds up its bytes. As in MERGE, repeated
source keys are refused only if they match a target row, which is looked up
then; those that match nothing are all inserted, and so are rows with a NULL
key, which never match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.session import exists, remove

ACTION = "_action"
#: Text bytes of a source that may be broadcast.
BROADCAST_BYTES = 64 << 20


class DuplicateSourceKeys(ValueError):
    pass


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def check_matching_keys_unique(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when several source rows match one target row (the merge would
    be ambiguous); de-duplicate first with ``relational.dedup_latest``."""
    repeated = source.where(_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if repeated.limit(1).count():
        worst = target.select(*keys).join(repeated, list(keys)).agg(F.max("_n")).first()[0]
        if worst:
            raise DuplicateSourceKeys(f"{worst} source rows match one target row")


#: A stored byte can be several in memory: sizes by statistics are trusted this far below the bound.
_EXPANDS = 16


def fits_broadcast(source: DataFrame, limit: int) -> bool:
    """Whether the source has at most ``limit`` bytes: by the optimizer's
    statistics if they are far below, else by counting the bytes of its text."""
    if limit < 0:
        return False
    known = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known * _EXPANDS <= limit:
        return True
    width = sum((F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType))
                 else F.lit(16) if isinstance(f.dataType, T.AtomicType)
                 else F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0)) for f in source.schema.fields), F.lit(16))
    return int(source.agg(F.sum(width)).first()[0] or 0) <= limit


class Merge:
    """Fluent upsert builder: ``Merge(target, source, ['k']).when_matched_update(
    condition, set).when_not_matched_insert(values).plan()``."""

    def __init__(self, target: DataFrame, source: DataFrame, on: Sequence[str],
                 broadcast_bytes: int = BROADCAST_BYTES):
        self.target, self.source, self.keys = target, source, list(on)
        self.broadcast_bytes = broadcast_bytes
        self.matched_cond: Column | None = None
        self.update_set: dict[str, Column] | None = None
        self.insert_values: dict[str, Column] | None = None
        self.delete_cond: Column | None = None
        self.has_delete = False
        self.evolve = False

    # -- clauses
    def when_matched_update(self, condition: str | Column | None = None, set: dict | None = None):
        self.matched_cond = _expr(condition) if condition is not None else None
        self.update_set = {k: _expr(v) for k, v in (set or {}).items()}
        return self

    def when_matched_update_all(self, condition: str | Column | None = None):
        self.evolve = True
        return self.when_matched_update(condition, {c: f"s.`{c}`" for c in self.source.columns})

    def when_not_matched_insert(self, values: dict | None = None):
        self.insert_values = {k: _expr(v) for k, v in (values or {}).items()}
        return self

    def when_not_matched_insert_all(self):
        self.evolve = True
        return self.when_not_matched_insert({c: f"s.`{c}`" for c in self.source.columns})

    def when_not_matched_by_source_delete(self, condition: str | Column | None = None):
        self.has_delete = True
        self.delete_cond = _expr(condition) if condition is not None else None
        return self

    # -- planning
    def output_columns(self) -> list[str]:
        cols = list(self.target.columns)
        if self.evolve:
            cols += [c for c in self.source.columns if c not in cols]
        return cols

    def _joined(self) -> DataFrame:
        keys = self.keys
        t = self.target.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                               F.struct(*[F.col(c) for c in self.target.columns]).alias("t"))
        s = self.source.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                               F.struct(*[F.col(c) for c in self.source.columns]).alias("s"))
        kcols = [f"_k_{k}" for k in keys]
        if not fits_broadcast(self.source, self.broadcast_bytes):
            return t.join(s, kcols, "full")
        left = t.join(F.broadcast(s), kcols, "left")
        # no more than the source's keys, however often the target has them
        matched_keys = t.select(*kcols).join(F.broadcast(s.select(*kcols)), kcols, "left_semi").distinct()
        inserts = s.join(F.broadcast(matched_keys), kcols, "left_anti").withColumn(
            "t", F.lit(None).cast(t.schema["t"].dataType))
        return left.unionByName(inserts)

    def plan(self) -> DataFrame:
        """All output rows, labelled; the source is looked at first (see the module text)."""
        check_matching_keys_unique(self.target, self.source, self.keys)
        j = self._joined()
        t_in, s_in = F.col("t").isNotNull(), F.col("s").isNotNull()
        matched = t_in & s_in
        upd = self.update_set is not None
        cond = F.coalesce(self.matched_cond, F.lit(False)) if self.matched_cond is not None else F.lit(True)
        dcond = (F.coalesce(self.delete_cond, F.lit(False)) if self.delete_cond is not None
                 else F.lit(True))
        action = F.when(matched & F.lit(upd) & cond, "update").when(matched, "keep")
        action = action.when(t_in & ~s_in & F.lit(self.has_delete) & dcond, "delete").when(t_in, "keep")
        action = action.when(F.lit(self.insert_values is not None), "insert").otherwise("skip")
        j = j.withColumn(ACTION, action)
        tcols = set(self.target.columns)
        out = []
        for c in self.output_columns():
            keep_val = F.col(f"t.`{c}`") if c in tcols else F.lit(None)
            upd_val = (self.update_set or {}).get(c, keep_val)
            ins_val = (self.insert_values or {}).get(c, F.lit(None))
            val = (F.when(F.col(ACTION) == "update", upd_val)
                   .when(F.col(ACTION) == "insert", ins_val).otherwise(keep_val))
            out.append(val.alias(c))
        planned = j.select(*out, ACTION).filter(F.col(ACTION) != "skip")
        if not self.evolve:
            # Values keep the target's column types (a source BIGINT key
            # lands in an INT column, as MERGE store assignment does).
            planned = planned.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                       for f in self.target.schema.fields], ACTION)
        return planned

    def result(self) -> DataFrame:
        """The new table: every row except deleted ones, without labels."""
        return apply(self.plan())


def apply(planned: DataFrame) -> DataFrame:
    return planned.filter(F.col(ACTION) != "delete").drop(ACTION)


def metric_columns() -> list[Column]:
    a = F.col(ACTION)
    upd, dele, ins = F.count_if(a == "update"), F.count_if(a == "delete"), F.count_if(a == "insert")
    return [(upd + dele + ins).alias("num_affected_rows"), upd.alias("num_updated_rows"),
            dele.alias("num_deleted_rows"), ins.alias("num_inserted_rows")]


def metrics(planned: DataFrame) -> DataFrame:
    """One row: affected, updated, deleted and inserted row counts."""
    return planned.agg(*metric_columns())


def write_observed(planned: DataFrame, path: str) -> dict:
    """Write the new snapshot and collect the metrics in the same pass."""
    obs = Observation("merge_metrics")
    apply(planned.observe(obs, *metric_columns())).write.mode("overwrite").parquet(path)
    return obs.get


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           matched_condition: str | Column | None = None, update_set: dict | None = None,
           insert_values: dict | str | None = "*", delete_condition: str | Column | None = None,
           delete_not_matched: bool = False) -> DataFrame:
    """Functional form of ``Merge``; returns the labelled plan."""
    m = Merge(target, source, keys)
    if update_set == "*":
        m.when_matched_update_all(matched_condition)
    elif update_set is not None:
        m.when_matched_update(matched_condition, update_set)
    if insert_values == "*":
        m.when_not_matched_insert({c: f"s.`{c}`" for c in target.columns if c in source.columns})
    elif insert_values is not None:
        m.when_not_matched_insert(insert_values)
    if delete_not_matched:
        m.when_not_matched_by_source_delete(delete_condition)
    return m.plan()


# ---------------------------------------------------------------- layout
def bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def upsert_partitioned(spark, target_path: str, staging_path: str, source: DataFrame,
                       keys: Sequence[str], buckets: int, **merge_args) -> dict:
    """Upsert into a parquet folder partitioned by ``_bucket`` (a hash of the
    keys): read only the buckets the source touches (partition pruning),
    stage the merged rows in shared storage, then replace just those
    partitions (dynamic partition overwrite). Partitions that the merge
    emptied are removed, which an overwrite cannot do. Deleting rows that
    the source lacks concerns every bucket, so all are read then. Returns
    the merge metrics.

    Publishing the staged buckets is not atomic, so it can be repeated: a
    call that finds ``staging_path`` complete but not marked as published
    publishes it again as it is, without reading the target, which may lack
    the buckets it was replacing. Use one staging folder for each merge.
    """
    if exists(spark, f"{staging_path}{STATS}/_SUCCESS"):
        if not exists(spark, f"{staging_path}{PUBLISHED}/_SUCCESS"):
            _publish(spark, target_path, staging_path)
        return {k: v for k, v in spark.read.json(f"{staging_path}{STATS}").first().asDict().items() if k != "touched"}
    src = source.withColumn("_bucket", bucket(keys, buckets))
    if merge_args.get("delete_not_matched"):
        touched = list(range(buckets))
    else:
        touched = [r[0] for r in src.select("_bucket").distinct().collect()]   # at most ``buckets`` values
    target = spark.read.parquet(target_path).filter(F.col("_bucket").isin(touched))
    planned = upsert(target, src, keys, **merge_args)
    obs = Observation("bucket_merge")
    merged = apply(planned.observe(obs, *metric_columns()))
    merged.write.mode("overwrite").parquet(staging_path)
    stats = obs.get
    # written last: from here on the merge is decided and only has to be published
    (spark.createDataFrame([(*stats.values(), touched)], ", ".join(f"{k} bigint" for k in stats) + ", touched array<int>")
     .write.mode("overwrite").json(f"{staging_path}{STATS}"))
    _publish(spark, target_path, staging_path)
    return stats


STATS, PUBLISHED = "_stats", "_published"


def _publish(spark, target_path: str, staging_path: str) -> None:
    """Replace the staged buckets and remove those that the merge emptied."""
    staged = spark.read.parquet(staging_path)
    touched = set(spark.read.json(f"{staging_path}{STATS}").first()["touched"])
    filled = {r[0] for r in staged.select("_bucket").distinct().collect()}         # at most ``buckets`` values
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(target_path)
    for emptied in touched - filled:
        remove(spark, f"{target_path}/_bucket={emptied}")
    spark.createDataFrame([(1,)], "done int").write.mode("overwrite").json(f"{staging_path}{PUBLISHED}")
