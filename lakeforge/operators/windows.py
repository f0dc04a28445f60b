"""Per-key ordered windows that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(...)`` sorts each key's rows in
one task, so a key holding a third of the data lands in one task. Here a
key's rows are cut into *segments*: an expression monotone in the order
(e.g. the month of a date), so every row of segment s precedes every row of
segment s+1 within a key. Each (key, segment) group is windowed on its own
(spread over many tasks); a per-segment summary (sum, first / last value,
the last k-1 values) is windowed per key over segments (one row per
segment, small) and joined back to carry running sums, lag, lead and
moving frames across segment boundaries exactly.

``skew_safe_window`` cuts only hot keys (``skew.hot_keys``: more rows than
one task should sort; the list has a proven size bound and is broadcast)
into segments; every other key is one segment, which is the plain window.
Without a segment expression the cuts come from a sample of the hot key's
rows (``operators.cuts``): segments follow the rows, whatever the values, and
the summary has one row for each ``cuts.ROWS_PER_SEGMENT`` of them. A given
expression must itself be bounded, e.g. (date, block of unique ids).

For ``range_sum`` the segment must keep peers (equal RANGE order values)
together, e.g. the order date itself.

Specs: ``{out: (kind, column[, k])}`` with kind one of ``running_sum``,
``lag``, ``lead``, ``first``, ``last_known`` (the last value that is not
NULL, the current row's included), ``moving_sum`` and ``moving_count`` (a frame
of the current row and the k-1 before it), or ``range_sum`` whose third
item is the RANGE ordering (peers share one sum), or ``row_number``,
``rank`` and ``dense_rank`` (column ``None``; for the last two the third
item is the rank ordering as names, '-' for descending, and its peers
must share a segment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.operators.cuts import ROWS_PER_SEGMENT, order_cuts, segment_of
from lakeforge.operators.skew import hot_keys

Spec = dict[str, tuple]


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def plain_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Spec) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    cols = {}
    for out, (kind, c, *rest) in specs.items():
        k = rest[0] if rest else None
        cols[out] = {
            "running_sum": lambda: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "lag": lambda: F.lag(c).over(w),
            "lead": lambda: F.lead(c).over(w),
            "first": lambda: F.first(c).over(w),
            "last_known": lambda: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "moving_sum": lambda: F.sum(c).over(w.rowsBetween(-(k - 1), 0)),
            "moving_count": lambda: F.count(c).over(w.rowsBetween(-(k - 1), 0)),
            "range_sum": lambda: F.sum(c).over(Window.partitionBy(*keys).orderBy(*_order_cols(k))),
            "row_number": lambda: F.row_number().over(w),
            "rank": lambda: F.rank().over(Window.partitionBy(*keys).orderBy(*_rank_order(k))),
            "dense_rank": lambda: F.dense_rank().over(Window.partitionBy(*keys).orderBy(*_rank_order(k))),
        }[kind]()
    return df.withColumns(cols)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on equal names, where NULL equals NULL; one column of each name."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def _join_segments(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Equi-join on the segment, a struct of the keys and the cut: struct
    equality takes NULL fields as equal, and the left side is already hash
    partitioned on it, so only the right side moves."""
    return left.join(right, "_seg", how)


def segmented_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column,
                     specs: Spec, summarize: Column | None = None) -> DataFrame:
    """Same result as ``plain_window``; ``order`` must be a total order.

    ``summarize`` limits the per-segment summary to rows that can need a
    carry (keys cut into several segments); other rows keep their local
    values, so the summary stays as small as the hot part of the data."""
    keys = list(keys)
    base_cols = df.columns
    d = df.withColumn("_seg", F.struct(*keys, segment.alias("_cut")))
    wl = Window.partitionBy("_seg").orderBy(*_order_cols(order))
    wl_all = Window.partitionBy("_seg")
    local = {"_pos": F.row_number().over(wl), "_cnt": F.count(F.lit(1)).over(wl_all)}
    seg_aggs: list[Column] = []
    ks = [sp[2] for sp in specs.values() if sp[0] in ("moving_sum", "moving_count")]
    kmax = max(ks) if ks else 1
    def order_struct():
        return F.struct(*_order_cols(order))      # only for lag / lead / first (ascending orders)

    for out, (kind, c, *rest) in specs.items():
        k = rest[0] if rest else None
        if kind == "running_sum":
            local[f"_l_{out}"] = F.sum(c).over(wl.rowsBetween(Window.unboundedPreceding, 0))
            seg_aggs.append(F.sum(c).alias(f"_s_{out}"))
        elif kind == "range_sum":
            # Default RANGE frame on ``k`` (peers share a sum); peers never
            # straddle segments because the segment is monotone in ``k``.
            local[f"_l_{out}"] = F.sum(c).over(Window.partitionBy("_seg").orderBy(*_order_cols(k)))
            seg_aggs.append(F.sum(c).alias(f"_s_{out}"))
        elif kind == "lag":
            local[f"_l_{out}"] = F.lag(c).over(wl)
            seg_aggs.append(F.max_by(c, order_struct()).alias(f"_s_{out}"))
        elif kind == "lead":
            local[f"_l_{out}"] = F.lead(c).over(wl)
            seg_aggs.append(F.min_by(c, order_struct()).alias(f"_s_{out}"))
        elif kind == "first":
            local[f"_l_{out}"] = F.first(c).over(wl)
            seg_aggs.append(F.min_by(c, order_struct()).alias(f"_s_{out}"))
        elif kind == "last_known":
            local[f"_l_{out}"] = F.last(c, ignorenulls=True).over(wl.rowsBetween(Window.unboundedPreceding, 0))
            seg_aggs.append(F.max_by(c, F.when(F.col(c).isNotNull(), order_struct())).alias(f"_s_{out}"))
        elif kind in ("row_number", "rank", "dense_rank"):
            # Rank = local rank + rows (or distinct rank values) of earlier
            # segments; peers of the rank order must share a segment.
            wr = wl if kind == "row_number" else Window.partitionBy("_seg").orderBy(*_rank_order(k))
            fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[kind]
            local[f"_l_{out}"] = fn().over(wr)
            size = (F.count_distinct(F.struct(*_rank_names(k))) if kind == "dense_rank"
                    else F.count(F.lit(1)))
            seg_aggs.append(size.alias(f"_s_{out}"))
        elif kind in ("moving_sum", "moving_count"):
            fn = F.sum if kind == "moving_sum" else F.count
            local[f"_l_{out}"] = fn(c).over(wl.rowsBetween(-(k - 1), 0))
    d = d.withColumns(local)

    src = d if summarize is None else d.filter(summarize)
    summary = src.groupBy(*keys, "_seg").agg(*seg_aggs, F.lit(True).alias("_has"))
    tail_cols = sorted({s[1] for s in specs.values() if s[0] in ("moving_sum", "moving_count")})
    if tail_cols:
        # Last kmax-1 rows of each segment (positions from the end), at most
        # kmax-1 per group, so the collect is bounded.
        tails = (src.filter(F.col("_cnt") - F.col("_pos") < kmax - 1)
                 .groupBy("_seg")
                 .agg(F.sort_array(F.collect_list(F.struct("_pos", *[F.col(c) for c in tail_cols]))).alias("_tail")))
        summary = _join_segments(summary, tails, "left")
    ws = Window.partitionBy(*keys).orderBy("_seg")
    carry = {}
    for out, (kind, c, *rest) in specs.items():
        s = F.col(f"_s_{out}")
        if kind in ("running_sum", "range_sum", "row_number", "rank", "dense_rank"):
            carry[f"_c_{out}"] = F.sum(s).over(ws.rowsBetween(Window.unboundedPreceding, -1))
        elif kind == "lag":
            carry[f"_c_{out}"] = F.lag(s).over(ws)
        elif kind == "lead":
            carry[f"_c_{out}"] = F.lead(s).over(ws)
        elif kind == "last_known":
            carry[f"_c_{out}"] = F.last(s, ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1))
        elif kind == "first":
            carry[f"_c_{out}"] = F.first(s).over(ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    if tail_cols:
        prev = F.flatten(F.collect_list("_tail").over(ws.rowsBetween(-(kmax - 1), -1)))
        carry["_carry"] = F.slice(prev, F.greatest(F.size(prev) - (kmax - 1) + 1, F.lit(1)), kmax - 1)
    summary = summary.withColumns(carry).select("_seg", "_has", *carry.keys())

    j = _join_segments(d, summary, "left")
    final = {}
    for out, (kind, c, *rest) in specs.items():
        k = rest[0] if rest else None
        if kind in ("running_sum", "range_sum"):
            final[out] = _null_add(F.col(f"_l_{out}"), F.col(f"_c_{out}"))
        elif kind in ("row_number", "rank", "dense_rank"):
            final[out] = (F.col(f"_l_{out}") + F.coalesce(F.col(f"_c_{out}"), F.lit(0))).cast("int")
        elif kind == "lag":
            final[out] = F.when(F.col("_pos") == 1, F.col(f"_c_{out}")).otherwise(F.col(f"_l_{out}"))
        elif kind == "lead":
            final[out] = F.when(F.col("_pos") == F.col("_cnt"), F.col(f"_c_{out}")).otherwise(F.col(f"_l_{out}"))
        elif kind == "last_known":
            final[out] = F.coalesce(F.col(f"_l_{out}"), F.col(f"_c_{out}"))
        elif kind == "first":
            final[out] = F.when(F.col("_has"), F.col(f"_c_{out}")).otherwise(F.col(f"_l_{out}"))
        else:
            need = F.greatest(F.lit(k) - F.col("_pos"), F.lit(0))
            carried = F.coalesce(F.col("_carry"), F.array().cast(j.schema["_carry"].dataType))
            n = F.least(need, F.size(carried))
            values = F.transform(carried, lambda x: x[c])
            taken = F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)
            present = F.filter(taken, lambda x: x.isNotNull())
            if kind == "moving_sum":
                acc = _sum_type(df.schema[c].dataType)
                extra = F.when(F.size(present) > 0, F.aggregate(
                    present, F.lit(0).cast(acc), lambda a, x: (a + x).cast(acc)))
                final[out] = _null_add(F.col(f"_l_{out}"), extra)
            else:
                final[out] = F.col(f"_l_{out}") + F.size(present)
    return j.withColumns(final).select(*base_cols, *specs.keys())


def _rank_order(items: Sequence[str]) -> list[Column]:
    """Rank orderings as names, a leading '-' for descending: ['-v', 'k']."""
    return [F.col(x[1:]).desc() if x.startswith("-") else F.col(x) for x in items]


def _rank_names(items: Sequence[str]) -> list[str]:
    return [x.lstrip("-") for x in items]


def _sum_type(t):
    """The type ``sum`` returns for a column of type ``t``."""
    from pyspark.sql import types as T
    if isinstance(t, T.DecimalType):
        return T.DecimalType(min(38, t.precision + 10), t.scale)
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def _null_add(a: Column, b: Column) -> Column:
    """SQL sum semantics across pieces: NULL only when both are NULL."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def skew_safe_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column | None,
                     specs: Spec, hot_fraction: float | None = None, force_segmented: bool = False,
                     sample_fraction: float | None = None, materialize: bool = False,
                     rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """One pass for all keys: hot keys are cut into segments, every other
    key is a single segment (its segment value is NULL), so cold keys get
    exactly the plain window while the data is scanned and shuffled once,
    on (key, segment). The hot-key flag is a broadcast join against a list
    with a proven size bound."""
    if force_segmented:
        if segment is None:
            raise ValueError("force_segmented needs a segment expression")
        return segmented_window(df, keys, order, segment, specs)
    if segment is None and not all(isinstance(o, str) for o in order):
        raise ValueError("sampled cuts need an ascending order by column names")
    if len(keys) != 1:
        raise ValueError("skew_safe_window splits on a single key column")
    key = keys[0]
    if materialize:
        # A derived input (e.g. an aggregate) is written once to the shared
        # checkpoint folder, so detection and the window do not both
        # recompute it; a reliable checkpoint survives executor loss.
        df = df.checkpoint(eager=True)
    hot_list = (hot_keys(df, key, hot_fraction) if sample_fraction is None
                else hot_keys(df, key, hot_fraction, sample_fraction=sample_fraction))
    # One small job over the key column: with no hot key the plain window
    # (a single shuffle on the key) is already safe.
    if not hot_list.limit(1).collect():
        return plain_window(df, keys, order, specs)
    # NULL is a key like any other here, and may be a hot one
    if segment is None:
        hot = F.broadcast(order_cuts(df, key, list(order), hot_list, rows_per_segment).withColumn("_is_hot", F.lit(True)))
        segment = segment_of(list(order))
    else:
        hot = F.broadcast(hot_list.select(F.col(key).alias("_hot"), F.lit(True).alias("_is_hot")))
    flagged = df.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
    is_hot = F.coalesce(F.col("_is_hot"), F.lit(False))
    # (False, NULL) for every row of a cold key: one segment. Struct equality
    # treats the NULL fields as equal, so the joins stay plain equi-joins on
    # (key, segment) and reuse the data's partitioning.
    seg = F.struct(is_hot.alias("h"), F.when(is_hot, segment).alias("s"))
    flagged = flagged.withColumn("_segment", seg).drop("_cuts", "_is_hot")      # the cuts do not travel with the rows
    return segmented_window(flagged, keys, order, F.col("_segment"), specs, summarize=F.col("_segment.h")).drop("_segment")


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """``value / sum(value) per key`` as an aggregate joined back (partial
    aggregation; adaptive skew-join splitting covers a hot key), instead of
    an unordered window that puts each key in one task."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    return join_null_safe(df, totals, list(keys), "inner").withColumn(out, F.col(value) / F.col("_total")).drop("_total")


def range_running_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Running sum per key in the default RANGE frame: peers of ``order``
    share a sum. Sums per (key, peers) come from a partial aggregate and are
    windowed, one row per peer group, so neither a hot key's nor a hot peer
    group's rows meet in one task."""
    peers = df.groupBy(*keys, order).agg(F.sum(value).alias("_peers"))
    upto = peers.withColumn(out, F.sum("_peers").over(Window.partitionBy(*keys).orderBy(order))).drop("_peers")
    return join_null_safe(df, upto, [*keys, order], "left")


def ranks_by_counting(df: DataFrame, keys: Sequence[str], by: str, tiebreak: str, block: Column, materialize: bool = False) -> DataFrame:
    """row_number, rank and dense_rank per key, by ``by`` descending.

    rank and dense_rank follow from the number of rows per (key, value), a
    partial aggregate; row_number adds the place among the ties by
    ``tiebreak``, whose rows are cut into ``block`` segments (monotone in it).
    ``df`` is read three times: ``materialize`` writes a derived one once to
    the shared checkpoint folder first."""
    if materialize:
        df = df.checkpoint(eager=True)
    ties = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.col(by).desc())
    ties = ties.select(*keys, by, (F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).cast("int").alias("rank"),
                       F.row_number().over(w).alias("dense_rank"))
    placed = segmented_window(df, [*keys, by], [tiebreak], block, {"_place": ("row_number", None)})
    return join_null_safe(placed, ties, [*keys, by], "left").withColumn("row_number", F.col("rank") + F.col("_place") - 1).drop("_place")


def sessionize(df: DataFrame, key: str, ts: str, tiebreak: str, gap_seconds: int, segment: Column | None = None,
               hot_fraction: float | None = None, force_segmented: bool = False) -> DataFrame:
    """Session windows per key as gaps and islands: a row starts a session
    when the previous row of its key is ``gap_seconds`` or more before it.
    The previous timestamp and the running count of session starts come
    from the skew-safe window, and sessions are an aggregate, so neither a
    hot key nor a long session has to fit in one task. Output matches
    ``F.session_window``: start = first event, end = last event + gap."""
    specs = {"_prev": ("lag", ts)}
    prev = skew_safe_window(df.select(key, ts, tiebreak), [key], [ts, tiebreak], segment, specs,
                            hot_fraction=hot_fraction, force_segmented=force_segmented)
    gap = F.expr(f"INTERVAL {int(gap_seconds)} SECONDS")
    flagged = prev.withColumn("_start", F.when(F.col("_prev").isNull() | (F.col(ts) >= F.col("_prev") + gap), 1)
                              .otherwise(0))
    numbered = skew_safe_window(flagged, [key], [ts, tiebreak], segment, {"_sid": ("running_sum", "_start")},
                                hot_fraction=hot_fraction, force_segmented=force_segmented)
    return (numbered.groupBy(key, "_sid")
            .agg(F.min(ts).alias("session_start"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("events"))
            .select(key, "session_start",
                    (F.col("_last") + gap).alias("session_end"), "events"))
