"""Mixing overlapping sources to target weights by min-cost flow.

1. Every document belongs to one or more sources. Documents are aggregated
   by membership pattern (the set of their sources): one row per pattern, so
   what reaches the driver is as large as the number of different patterns,
   never as the number of documents.
2. Each source's target is its weight's share of all words. A source's
   target stops at ``max_repeats`` times the words it holds, and the excess
   goes to the others by weight until none is above.
3. A min-cost flow routes the patterns' word capacity to the source quotas.
   A pattern's words may be taken up to ``max_repeats`` times; the first time
   costs 0, the second 1, the third 2 a word, so repetition is spread before
   it is piled up.
4. Of a pattern whose flow is q words, every document is taken
   floor(q / words) times, and once more the documents first in a seeded
   order (MD5 of seed and id) until the rest is filled, to within half of
   one document. The order is cut by counts over 4096 ranges of the hash, so
   only the one range of a pattern that holds the cut is sorted.

Defined results: a null text has size 0 and nothing of it is taken; a null
source is a source of its own, last in the order; a document with an empty
list of sources is never taken. Repeated rows are taken or left each by
itself. An empty table gives an empty result. A rerun gives the same rows.
Extra columns do not matter to ``mix``; ``resample`` passes them through.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import flat, fresh, quoted, save, steps, utf8, word_bounds

#: The seeded order is cut at so many ranges of the hash first (three hex digits).
RANGES = 4096
#: Different membership patterns that the flow is solved for; more are refused, not dropped.
MAX_PATTERNS = 100_000


def _sized(batches):
    for b in batches:
        data, off = flat(b.column(b.num_columns - 1))
        found = [np.diff(np.searchsorted(word_bounds(data[off[i]:off[j]], off[i:j + 1] - off[i])[0], off[i:j + 1] - off[i])) for i, j in steps(off)]
        size = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(size.astype(np.int64))], b.schema.names)


def with_size(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the number of words of each text in column ``name``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return docs.withColumn(name, utf8(f"`{text_col}`")).mapInArrow(_sized, schema)


def targets(sizes: list[int], weights: list[float], total: int, max_repeats: int) -> list[float]:
    """Each source's share of ``total`` by weight, none above ``max_repeats``
    times its size; the excess is shared again by weight until none is above."""
    goal = [0.0] * len(sizes)
    left, weight = total, sum(weights)
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i] / weights[i], i))
    for k, i in enumerate(order):
        if max_repeats * sizes[i] <= weights[i] * (left / weight):
            goal[i] = float(max_repeats * sizes[i])
            left, weight = left - max_repeats * sizes[i], weight - weights[i]
        else:
            for j in order[k:]:
                goal[j] = weights[j] * (left / weight)
            break
    return goal


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], max_repeats: int) -> list[dict[int, int]]:
    """Words of each pattern that go to each of its sources: a flow that
    fills the quotas as far as it can, at least cost. Unit costs rise by one
    with each repetition, so it is found by max-flows over the patterns'
    capacity at one cost after the other; a later, dearer layer never takes
    anything back from a cheaper one, it only re-routes it."""
    flow: list[dict[int, int]] = [dict.fromkeys(members, 0) for members, _ in patterns]
    users: list[set[int]] = [set() for _ in quotas]
    for p, (members, _) in enumerate(patterns):
        for s in members:
            users[s].add(p)
    need = list(quotas)
    for _ in range(max_repeats):
        spare = [words for _, words in patterns]
        for p in range(len(patterns)):
            while spare[p] > 0:
                path = _augmenting(p, patterns, flow, users, need)
                if path is None:
                    break
                # path: pattern, source, pattern, source, ..., source with need
                amount = min([spare[p], need[path[-1]], *[flow[path[i + 1]][path[i]] for i in range(1, len(path) - 1, 2)]])
                for i in range(0, len(path), 2):
                    flow[path[i]][path[i + 1]] += amount
                for i in range(1, len(path) - 1, 2):
                    flow[path[i + 1]][path[i]] -= amount
                spare[p] -= amount
                need[path[-1]] -= amount
    return flow


def _augmenting(start: int, patterns, flow, users, need) -> list[int] | None:
    """Shortest way from a pattern to a source with need, over sources that
    another pattern can leave again."""
    came_p: dict[int, int | None] = {start: None}
    came_s: dict[int, int] = {}
    queue = deque([start])
    while queue:
        p = queue.popleft()
        for s in patterns[p][0]:
            if s in came_s:
                continue
            came_s[s] = p
            if need[s] > 0:
                path = [s]
                at: int | None = p
                while at is not None:
                    path.append(at)
                    back = came_p[at]
                    if back is None:
                        break
                    path.append(back)
                    at = came_s[back]
                return path[::-1]
            for q in users[s]:
                if q not in came_p and flow[q].get(s, 0) > 0:
                    came_p[q] = s
                    queue.append(q)
    return None


def _plan(docs: DataFrame, id_col: str, text_col: str, members: Column, weights, max_repeats: int, seed: int) -> tuple[DataFrame, dict, list]:
    carried = docs.select(quoted(id_col).alias("id"), F.array_sort(F.array_distinct(F.transform(members, lambda s: F.coalesce(F.concat(F.lit("="), s.cast("string")), F.lit("~"))))).alias("pattern"), quoted(text_col).alias("body"))
    sized = with_size(carried, "body", "size").drop("body")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    table = save(sized.withColumn("hash", order), "sizes")
    by_pattern = table.groupBy("pattern").agg(F.sum("size").alias("words"))
    found = [(r["pattern"] or [], r["words"] or 0) for r in by_pattern.limit(MAX_PATTERNS + 1).collect()]
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} different membership patterns")
    # '~' sorts after '=': the null source comes last; UTF-8 order is code point order
    names = sorted({s for members_, _ in found for s in members_}, key=lambda s: s.encode())
    at = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for members_, words in found:
        for s in members_:
            sizes[at[s]] += words
    total = sum(words for members_, words in found if members_)
    share = [float(weights(i, None if s == "~" else s[1:])) for i, s in enumerate(names)]
    goal = targets(sizes, share, total, max_repeats)
    flows = route([(tuple(at[s] for s in members_), words) for members_, words in found], [int(np.floor(g + 0.5)) for g in goal], max_repeats)
    taken = [sum(f.get(i, 0) for f in flows) for i in range(len(names))]
    quota = {tuple(members_): (words, sum(f.values())) for (members_, words), f in zip(found, flows)}
    return table, quota, [(None if s == "~" else s[1:], sizes[i], goal[i], taken[i]) for i, s in enumerate(names)]


def mix(docs: DataFrame, members: Column, weights, id_col: str = "doc_id", text_col: str = "text", max_repeats: int = 3,
        seed: int = 7) -> tuple[DataFrame, list[tuple[str | None, int, float, int]]]:
    """Rows ``(id, pattern, size, repeats)`` and, for each source in order,
    (name, size, target, words that the flow routes to it).

    ``members`` is an array column of source names; ``weights(i, name)``
    gives the weight, above 0, of the i-th source by code point, null last."""
    table, quota, sources = _plan(docs, id_col, text_col, members, weights, max_repeats, seed)
    spark = docs.sparkSession
    plan = spark.createDataFrame([(list(p), q // w if w else 0, q - (q // w) * w if w else 0) for p, (w, q) in quota.items()],
                                 "pattern array<string>, every bigint, rest bigint")
    # where in the seeded order does each pattern's cut lie
    table = table.withColumn("range", F.conv(F.substring("hash", 1, 3), 16, 10).cast("int"))
    counts = table.groupBy("pattern", "range").agg(F.sum("size").alias("words"))
    w = Window.partitionBy("pattern").orderBy("range")
    upto = counts.withColumn("before", F.sum("words").over(w) - F.col("words"))
    cuts = (upto.join(F.broadcast(plan), "pattern").where((F.col("rest") > 0) & (F.col("before") < F.col("rest")))
            .groupBy("pattern").agg(F.max_by(F.struct("range", "before"), F.col("range")).alias("c"))
            .select("pattern", F.col("c.range").alias("cut"), F.col("c.before").alias("before")))
    # at most MAX_PATTERNS rows: one for each pattern
    marked = table.join(F.broadcast(plan.join(cuts, "pattern", "left")), "pattern")
    outside = marked.where(F.col("cut").isNull() | (F.col("range") != F.col("cut"))).withColumn("once", F.col("range") < F.coalesce("cut", F.lit(-1)))
    o = Window.partitionBy("pattern").orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = marked.where(F.col("range") == F.col("cut"))
    inside = inside.withColumn("once", 2 * (F.col("before") + F.sum("size").over(o)) - F.col("size") < 2 * F.col("rest"))
    rows = outside.unionByName(inside)
    times = F.when(F.col("size") > 0, F.col("every") + F.when(F.col("once"), 1).otherwise(0)).otherwise(0)
    return rows.select("id", "pattern", "size", times.cast("bigint").alias("repeats")), sources


def mix_single(docs: DataFrame, source_col: str, weights, id_col: str = "doc_id", text_col: str = "text", max_repeats: int = 3, seed: int = 7) -> DataFrame:
    """For documents with one source each: id, size, source_size, target and
    taken (words that the mix takes, repeats counted) of every row."""
    rows, sources = mix(docs, F.array(quoted(source_col)), weights, id_col, text_col, max_repeats, seed)
    known = docs.sparkSession.createDataFrame([("~" if s is None else "=" + s, size, goal) for s, size, goal, _ in sources],
                                              "source string, source_size bigint, target double")
    return (rows.withColumn("source", F.element_at("pattern", 1)).join(F.broadcast(known), "source")
            .select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")))


def resample(docs: DataFrame, members: Column, weights, id_col: str = "doc_id", text_col: str = "text", max_repeats: int = 3, seed: int = 7) -> DataFrame:
    """``docs`` with every row as often as the mix takes it. Rows that repeat
    an id share their takes' sum as evenly as it goes."""
    rows, _ = mix(docs, members, weights, id_col, text_col, max_repeats, seed)
    key, times, copies, spare = fresh(docs, "key", "times", "copies", "copy")
    tag = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    takes = rows.groupBy(tag(F.col("id")).alias(key), F.col("size").alias(spare)).agg(F.sum("repeats").alias(times), F.count(F.lit(1)).alias(copies)).where(F.col(times) > 0)
    sized = with_size(docs, text_col, spare).withColumn(key, tag(quoted(id_col)))
    once = F.floor(F.col(times) / F.col(copies))
    joined = sized.join(takes, [key, spare])
    # with unique ids the row takes it all; else the first rows by number take one more
    extra = F.col(times) - once * F.col(copies)
    nth = F.row_number().over(Window.partitionBy(key, spare).orderBy(F.lit(0)))
    single = joined.where(F.col(copies) == 1)
    several = joined.where(F.col(copies) > 1).withColumn(times, once + F.when(nth <= extra, 1).otherwise(0)).where(F.col(times) > 0)
    return (single.unionByName(several).withColumn(spare, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
            .select(*[quoted(c) for c in docs.columns]))
