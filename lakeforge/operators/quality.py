"""Data-quality rules with warn, drop and fail actions.

A rule is ``(name, predicate_sql, action)``. A row passes a rule only when
the predicate IS TRUE (NULL counts as a violation). All rules are evaluated
on the dataset's output before anything is dropped: fail rules first (an
``assert_true`` fused into the same filter expression as the drop rules, so
the write job fails and nothing is published), then warn rules are only
counted, then drop rules remove rows.

Metrics are one aggregate (or one ``Observation`` riding on the write):
``(dataset, rule, action, passed, failed)``; no second pass is needed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")

    @property
    def ok(self) -> Column:
        """TRUE only where the predicate is TRUE."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    @property
    def flag(self) -> str:
        return f"_ok_{self.name}"

    def sql(self) -> str:
        tail = {"warn": "", "drop": " ON VIOLATION DROP ROW", "fail": " ON VIOLATION FAIL UPDATE"}[self.action]
        return f"CONSTRAINT {self.name} EXPECT ({self.predicate}){tail}"


_CONSTRAINT = re.compile(
    r"^\s*CONSTRAINT\s+(\w+)\s+EXPECT\s*\((.*)\)\s*(ON\s+VIOLATION\s+(DROP\s+ROW|FAIL\s+UPDATE))?\s*$",
    re.IGNORECASE | re.DOTALL)


def parse_constraint(text: str) -> Rule:
    """``CONSTRAINT n EXPECT (p) [ON VIOLATION DROP ROW | FAIL UPDATE]``."""
    m = _CONSTRAINT.match(text)
    if not m:
        raise ValueError(f"not a constraint: {text!r}")
    on = (m.group(4) or "").upper().split()
    action = "drop" if on[:1] == ["DROP"] else "fail" if on[:1] == ["FAIL"] else "warn"
    return Rule(m.group(1), m.group(2).strip(), action)


class ExpectationFailed(RuntimeError):
    pass


def _gate(rules: Sequence[Rule], dataset: str) -> Column:
    """Filter condition: raise on any fail-rule violation, else keep rows
    passing every drop rule. One expression, so no drop predicate can be
    evaluated (or pushed to the scan) ahead of the fail check."""
    fails = [r for r in rules if r.action == "fail"]
    drops = [r for r in rules if r.action == "drop"]
    keep = F.lit(True)
    for r in drops:
        keep = keep & r.ok
    if not fails:
        return keep
    fail_ok = F.lit(True)
    for r in fails:
        fail_ok = fail_ok & r.ok
    names = ",".join(r.name for r in fails)
    check = F.assert_true(fail_ok, F.lit(f"expectation failed in {dataset}: {names}"))
    return F.when(check.isNull(), keep)


def apply_rules(df: DataFrame, rules: Sequence[Rule], dataset: str = "dataset",
                observation: Observation | None = None) -> DataFrame:
    """Rows that pass; fail rules abort the job that materialises them.

    With ``observation``, warn/drop/fail violation counts ride on the same
    pass (``observation.get`` after the action)."""
    if observation is not None:
        df = df.observe(observation, *[F.count_if(~r.ok).alias(r.name) for r in rules])
    return df.filter(_gate(rules, dataset))


def quality_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: (dataset, rule, action, passed, failed), one pass."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(~r.ok).alias(f"_f{i}") for i, r in enumerate(rules)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"_f{i}").alias("failed"))
        for i, r in enumerate(rules)])).alias("m")
    return agg.select("_n", stacked).select(
        F.lit(dataset).alias("dataset"), "m.rule", "m.action",
        (F.col("_n") - F.col("m.failed")).alias("passed"), F.col("m.failed").alias("failed"))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split into (clean, rejected) on one flag per rule; together they equal
    the input. Rejected rows carry the names of the rules they broke."""
    reasons = F.filter(F.array(*[F.when(~r.ok, F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    tagged = df.withColumn("_reasons", reasons)
    clean = tagged.filter(F.size("_reasons") == 0).drop("_reasons")
    rejected = tagged.filter(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons")
    return clean, rejected


def alerts(metrics: DataFrame, max_failed_fraction: float) -> DataFrame:
    """Rules whose failed share exceeds the threshold."""
    total = F.col("passed") + F.col("failed")
    return metrics.withColumn("failed_fraction", F.col("failed") / total).filter(
        F.col("failed_fraction") > max_failed_fraction)
