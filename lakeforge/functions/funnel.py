"""A partitioned table function: how far each key gets through ordered steps.

``funnel(TABLE(events), 'user_id', 'event_type', 'ts', 'view,click,purchase')``
asks Spark for its input partitioned by the key and ordered by the time, and
reads each partition once, row by row. What it keeps of a key is the place in
the steps and one time each, so a key of any length takes the same memory, and
rows behind the last step are skipped. The steps also decide the columns, so
the schema comes from ``analyze``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SkipRestOfInputTableException


def _names(steps: str) -> list[str]:
    return [s.strip() for s in steps.split(",")]


class Funnel:
    """A step counts when its event is later than the step before it; of equal
    times none follows the other. Events without a time, key or kind: no time
    is no event, a NULL key is a key, a NULL kind is no step. Keys without the
    first step give a row with ``steps_done`` 0."""

    @staticmethod
    def analyze(events: AnalyzeArgument, key: AnalyzeArgument, kind: AnalyzeArgument, at: AnalyzeArgument, steps: AnalyzeArgument) -> AnalyzeResult:
        if not events.isTable:
            raise ValueError("the first argument is a table")
        texts = {"key": key, "kind": kind, "at": at, "steps": steps}
        for name, arg in texts.items():
            if not arg.isConstantExpression or not isinstance(arg.value, str):
                raise ValueError(f"{name} is a constant text")
        types = {f.name: f.dataType for f in events.dataType.fields}
        for column in (key.value, kind.value, at.value):
            if column not in types:
                raise ValueError(f"the table has no column {column}")
        wanted = _names(steps.value)
        if "" in wanted or len(set(wanted)) != len(wanted):
            raise ValueError("steps are different names that are not empty")
        schema = T.StructType().add(key.value, types[key.value]).add("steps_done", T.IntegerType())
        for i in range(len(wanted)):
            schema = schema.add(f"step_{i + 1}_at", types[at.value])
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(at.value)])

    def __init__(self):
        self.key, self.times, self.any = None, [], False
        self.width = 0

    def eval(self, events: T.Row, key: str, kind: str, at: str, steps: str):
        wanted = _names(steps)
        self.any, self.key, self.width = True, events[key], len(wanted)
        when = events[at]
        if when is not None and events[kind] == wanted[len(self.times)] and (not self.times or when > self.times[-1]):
            self.times.append(when)
            if len(self.times) == self.width:
                raise SkipRestOfInputTableException("all steps are done")

    def terminate(self):
        if self.any:
            yield (self.key, len(self.times), *self.times, *[None] * (self.width - len(self.times)))


def funnel(events: DataFrame, key: str, kind: str, at: str, steps: list[str]) -> DataFrame:
    """One row per key of ``events``: ``key, steps_done, step_1_at, ...``. Only
    the three columns and the events that are steps reach Python, and keys
    without any step come back from a distinct list of the keys."""
    spark: SparkSession = events.sparkSession
    if any("," in s for s in steps):
        raise ValueError("a step's name holds no comma")
    spark.udtf.register("funnel", F.udtf(Funnel))
    narrow = events.select(key, kind, at)
    found = spark.sql("SELECT * FROM funnel(TABLE({steps_of}), {k}, {c}, {a}, {s})", steps_of=narrow.where(F.col(kind).isin(steps)),
                      k=key, c=kind, a=at, s=",".join(steps))
    keys = narrow.select(F.col(key).alias("_key")).distinct()
    return keys.join(found, F.col("_key").eqNullSafe(F.col(key)), "left").select(
        F.col("_key").alias(key), F.coalesce("steps_done", F.lit(0)).alias("steps_done"),
        *[f"step_{i + 1}_at" for i in range(len(steps))])
