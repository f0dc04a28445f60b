"""Hard negatives by angular triangle filtering.

Vectors are scaled to integers; the score of two rows is their exact integer
inner product. For each anchor the first ``positives`` other rows of its label
by score are its positives, and for each of those the first ``negatives`` rows
of other labels whose score is between two shares of the positive's.

1. A few reference directions are picked from a bounded sample (``sample``
   rows) by farthest-first search. Every row is stored with its norm and its
   angles to them, clustered by label and nearest direction.
2. The anchors come in blocks of at most ``block`` rows, sent to all tasks. By
   the triangle inequality on the sphere, the angle between an anchor and a row
   is at least |f - g| and at most min(f + g, 2 pi - f - g) for their angles f
   and g to any reference. The cosines of the tightest bounds, times both
   norms and widened past any rounding, bound the score from both sides.
3. Tiles of rows, by their ranges of angles and norms, and then single rows
   whose bounds do not overlap what an anchor still looks for are skipped;
   all others are scored in integers. An anchor looks for scores not under its
   last positive so far, then for those inside the windows of its positives,
   not under the last negative so far.
4. A task returns at most the first ``positives`` or ``negatives`` rows of an
   anchor or window; a ranked window over those gives the final ones.

The filter never decides by itself which row is returned, so results are the
same with any references, or none. Every row is looked at for every anchor: a
stated query set against all rows, in blocks. A block's anchors and positives
are all that passes the driver, at most ``block`` x (1 + ``positives``) rows.

Defined results: rows with a null id, label or vector, or any component that
is null, not finite or, scaled, leads to a norm over 2^31 take no part. A
shorter vector counts as filled up with zeros; a zero vector has score 0 with
all. Score ties go by smaller id. Ids are expected to be different: of anchors
with one id the greatest by (label, vector) is used, rows with the anchor's
own id are never its positives or negatives, and other repeated rows count one
by one. Anchors without positives, and positives without rows in their window,
return nothing. An empty table gives an empty result. Extra columns do not
matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import drop, keep, quoted
from lakeforge.session import scratch_root

TILE = 512
MAX_NORM = float(2**31)
#: Radians added to each side of an angle interval; arccos is good to 1e-7 where it is steepest.
SLACK = 1e-6
#: No score is as low or as high.
LOWEST, HIGHEST = -(2**63), 2**63 - 1
STORED = "label {label}, id {id}, vector array<bigint>, norm double, angles array<double>, cell int"


@dataclass(frozen=True)
class Rows:
    """Stored rows as arrays: vectors filled up with zeros to one width."""
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(b: pa.RecordBatch | pa.Table, n_refs: int) -> Rows:
        col = {c: (x.combine_chunks() if isinstance(x := b.column(c), pa.ChunkedArray) else x) for c in ("id", "label", "vector", "norm", "angles")}
        return Rows(col["id"].to_numpy(zero_copy_only=False), col["label"].to_numpy(zero_copy_only=False), _matrix(col["vector"], np.int64)[0],
                    col["norm"].to_numpy(zero_copy_only=False), col["angles"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, n_refs))

    def take(self, at) -> Rows:
        return Rows(self.ids[at], self.labels[at], self.vectors[at], self.norms[at], self.angles[at])

    def __len__(self) -> int:
        return len(self.ids)


def _matrix(lists: pa.ListArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a list column, filled up with zeros, and where a row holds a null."""
    size = np.diff(lists.offsets.to_numpy())
    out, flat = np.zeros((len(size), int(size.max(initial=0))), dtype), lists.flatten()
    filled = np.arange(out.shape[1]) < size[:, None]
    missing = np.zeros(out.shape, bool)
    missing[filled] = flat.is_null().to_numpy(zero_copy_only=False)
    out[filled] = flat.fill_null(0).to_numpy(zero_copy_only=False)
    return out, missing.any(axis=1)


def _angles(vectors: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles to the reference directions; those of a zero vector are right ones (its bounds are 0 anyway)."""
    width = min(vectors.shape[1], refs.shape[1])
    cosine = vectors[:, :width].astype(float) @ refs[:, :width].T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def _directions(vectors: np.ndarray, norms: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors of up to ``count`` rows, each the one farthest from those before."""
    unit = vectors[norms > 0] / norms[norms > 0][:, None]
    if not len(unit) or count < 1:
        return np.zeros((0, vectors.shape[1]))
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        k = int(nearest.argmin())
        if nearest[k] > 1 - 1e-9:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, unit @ unit[k])
    return unit[chosen]


def _integers(lists: pa.ListArray, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled vectors, their norms and which rows can take part."""
    given, missing = _matrix(lists, np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(scale * given)
        norms = np.sqrt((scaled * scaled).sum(axis=1))
        ok = ~missing & np.isfinite(given).all(axis=1) & (norms <= MAX_NORM)
    return np.where(ok[:, None], scaled, 0), norms, ok


def _store(scale: float, refs: np.ndarray, names: list[str]):
    def run(batches):
        for b in batches:
            vectors, norms, ok = _integers(b.column("vector"), scale)
            ok = np.flatnonzero(ok)
            vectors, norms = vectors[ok].astype(np.int64), norms[ok]
            angles = _angles(vectors, norms, refs)
            cell = angles.argmin(axis=1) if len(refs) else np.zeros(len(ok))
            size = np.diff(b.column("vector").offsets.to_numpy())[ok]
            flat = vectors[np.arange(vectors.shape[1]) < size[:, None]]
            lists = [pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), x)
                     for n, x in ((size, flat), (np.full(len(ok), len(refs)), angles.ravel()))]
            yield pa.RecordBatch.from_arrays([b.column("label").take(ok), b.column("id").take(ok), lists[0], pa.array(norms), lists[1], pa.array(cell, pa.int32())], names)
    return run


def _bounds(a: Rows, near: np.ndarray, far: np.ndarray, low_norm: np.ndarray, high_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible scores from intervals of angles and norms."""
    top, bottom = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, np.pi))
    most = a.norms[:, None] * high_norm
    pad = 1 + 1e-9 * most
    least = a.norms[:, None] * low_norm
    return np.minimum(bottom * most, bottom * least) - pad, np.maximum(top * most, top * least) + pad


def _tile_bounds(a: Rows, tile: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each anchor's scores with all rows of a tile."""
    low, high = tile.angles.min(axis=0), tile.angles.max(axis=0)
    near = np.maximum(np.maximum(a.angles - high, low - a.angles), 0).max(axis=1, initial=0)
    # f + g runs through an interval; the bound min(f + g, 2 pi - f - g) is greatest where it is nearest to pi
    off = np.maximum(np.maximum(a.angles + low - np.pi, np.pi - a.angles - high), 0).max(axis=1, initial=0)
    lo, hi = _bounds(a, near[:, None], np.pi - off[:, None], tile.norms.min(), tile.norms.max())
    return lo[:, 0], hi[:, 0]


def _row_bounds(a: Rows, tile: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each anchor's score with each row."""
    near = np.zeros((len(a), len(tile)))
    off = np.zeros_like(near)                    # of f + g from pi
    step = np.empty_like(near)
    for r in range(a.angles.shape[1]):
        f, g = a.angles[:, r, None], tile.angles[:, r]
        np.maximum(near, np.abs(np.subtract(f, g, out=step), out=step), out=near)
        np.maximum(off, np.abs(np.add(f - np.pi, g, out=step), out=step), out=off)
    return _bounds(a, near, np.pi - off, tile.norms, tile.norms)


def _scores(a: Rows, x: Rows) -> np.ndarray:
    """Integer inner products."""
    width = min(a.vectors.shape[1], x.vectors.shape[1])
    left, right = a.vectors[:, :width], x.vectors[:, :width].T
    if a.norms.max() * x.norms.max() < 2.0**52:  # every partial sum is an integer that a double holds
        return (left.astype(float) @ right.astype(float)).astype(np.int64)
    return left @ right


class _First:
    """The first ``n`` (score, id) of each key: higher scores, then smaller ids."""

    def __init__(self, keys: int, n: int):
        self.n = n
        self.floor = np.full(keys, LOWEST)       # a lower score cannot get in any more
        self.key = self.score = self.ids = np.zeros(0, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(key):
            return
        key, score = np.concatenate((self.key, key)), np.concatenate((self.score, score))
        ids = np.concatenate((self.ids, ids)) if len(self.ids) else ids
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        stay = rank < self.n
        last = rank == self.n - 1
        self.floor[key[last]] = score[last]
        self.key, self.score, self.ids = key[stay], score[stay], ids[stay]


def _tiles(batches, n_refs: int):
    """Tiles of rows of one label."""
    for b in batches:
        rows = Rows.of(b, n_refs)
        order = np.argsort(rows.labels, kind="stable")
        rows = rows.take(order)
        cuts = np.flatnonzero(rows.labels[1:] != rows.labels[:-1]) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
            for k in range(i, j, TILE):
                yield rows.take(slice(k, min(j, k + TILE)))


def _search(anchors: Rows, tile: Rows, who: np.ndarray, least: np.ndarray, most: np.ndarray):
    """Anchors (of those in ``who``) and rows whose score may lie in an
    anchor's interval from ``least`` to ``most``, with the integer scores; and
    which pairs the bounds leave. None if there are no such pairs."""
    if len(who):
        lo, hi = _tile_bounds(anchors.take(who), tile)
        who = who[(hi >= least[who]) & (lo <= most[who])]
    if not len(who):
        return None
    lo, hi = _row_bounds(anchors.take(who), tile)
    left = (hi >= least[who][:, None]) & (lo <= most[who][:, None])
    rows, some = np.flatnonzero(left.any(axis=0)), left.any(axis=1)
    who, left = who[some], left[some][:, rows]
    if not len(who):
        return None
    return who, rows, _scores(anchors.take(who), tile.take(rows)), left


def _positives(anchors: Rows, n: int, id_type: pa.DataType):
    def run(batches):
        first = _First(len(anchors), n)
        for tile in _tiles(batches, anchors.angles.shape[1]):
            found = _search(anchors, tile, np.flatnonzero(anchors.labels == tile.labels[0]), first.floor, np.full(len(anchors), HIGHEST))
            if found:
                who, rows, score, left = found
                left &= (score >= first.floor[who][:, None]) & (anchors.ids[who][:, None] != tile.ids[rows])
                i, j = np.nonzero(left)
                first.add(who[i], score[i, j], tile.ids[rows[j]])
        yield pa.RecordBatch.from_arrays([pa.array(first.key), pa.array(first.score), pa.array(first.ids, id_type)], ["anchor", "score", "id"])
    return run


def _negatives(anchors: Rows, least: np.ndarray, most: np.ndarray, n: int, id_type: pa.DataType):
    """``least`` and ``most``: an anchor's windows, one to a column; empty ones run from HIGHEST to LOWEST."""
    slots = least.shape[1]

    def run(batches):
        first = _First(len(anchors) * slots, n)
        widest = most.max(axis=1, initial=LOWEST)
        for tile in _tiles(batches, anchors.angles.shape[1]):
            now = np.maximum(least, first.floor.reshape(-1, slots))
            who = np.flatnonzero((anchors.labels != tile.labels[0]) & (widest > LOWEST))
            found = _search(anchors, tile, who, now.min(axis=1, initial=HIGHEST), widest)
            if found:
                who, rows, score, left = found
                left &= anchors.ids[who][:, None] != tile.ids[rows]
                for k in range(slots):
                    i, j = np.nonzero(left & (score >= now[who, k][:, None]) & (score <= most[who, k][:, None]))
                    first.add(who[i] * slots + k, score[i, j], tile.ids[rows[j]])
        yield pa.RecordBatch.from_arrays([pa.array(first.key), pa.array(first.score), pa.array(first.ids, id_type)], ["window", "score", "id"])
    return run


def _ranked(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.col("score").desc(), "id"))).where(F.col("rank") <= n)


def _blocks(anchors: DataFrame, block: int, n_refs: int):
    """The anchors by id, at most ``block`` at a time."""
    after = None
    while True:
        rest = anchors if after is None else anchors.where(F.col("id") > F.lit(after))
        got = Rows.of(rest.orderBy("id").limit(block).toArrow(), n_refs)
        if len(got):
            yield got
        if len(got) < block:
            return
        after = got.ids[-1:].tolist()[0]


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, scale: float = 256,
         positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), references: int = 16, sample: int = 2048, block: int = 4096) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``. ``anchors`` says which rows are anchors; ``window`` is
    in percent of the positive's score, both ends included."""
    spark = rows.sparkSession
    kinds = rows.select(quoted(id_col).alias("id"), (F.col("label") if label is None else label).alias("label"))
    kind = {f.name: f.dataType.simpleString() for f in kinds.schema.fields}
    given = rows.select(quoted(id_col).alias("id"), (F.col("label") if label is None else label).alias("label"), quoted(vector_col).cast("array<double>").alias("vector"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor")).dropna(subset=["id", "label", "vector"])

    # a bounded sample: the rows with the smallest hashed ids
    some = given.orderBy(F.xxhash64(F.lit("directions"), "id"), "id").limit(sample).select("vector").toArrow().column("vector").combine_chunks()
    vectors, norms, ok = _integers(some, scale)
    refs = _directions(vectors[ok], norms[ok], references)
    schema = STORED.format(**kind)
    names = T.StructType.fromDDL(schema).names
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = given.drop("anchor").mapInArrow(_store(scale, refs, names), schema)
    table, at = keep(stored.repartitionByRange(parts, "label", "cell", "id").sortWithinPartitions("label", "cell", "id"), "vectors")
    chosen = given.where("anchor").drop("anchor").mapInArrow(_store(scale, refs, names), schema)
    chosen, at2 = keep(chosen.groupBy("id").agg(F.max(F.struct("label", "vector", "norm", "angles")).alias("row")).select("id", "row.*"), "anchors")

    out = scratch_root(spark, "negatives")
    result = f"anchor_id {kind['id']}, positive_id {kind['id']}, rank int, negative_id {kind['id']}, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], result).write.parquet(out)
    low, high = window
    for part in _blocks(chosen, block, len(refs)):
        id_type = pa.from_numpy_dtype(part.ids.dtype) if part.ids.dtype != object else pa.string()
        near = table.select("label", "id", "vector", "norm", "angles")
        got = _ranked(near.mapInArrow(_positives(part, positives, id_type), f"anchor bigint, score bigint, id {kind['id']}"), "anchor", positives).toArrow()
        if not got.num_rows:
            continue
        a, slot, score = (got.column(c).to_numpy() for c in ("anchor", "rank", "score"))
        least, most = np.full((len(part), positives), HIGHEST), np.full((len(part), positives), LOWEST)
        # low s <= 100 t <= high s, for whole t; the products may pass 64 bits
        least[a, slot - 1], most[a, slot - 1] = [-(-low * s // 100) for s in score.tolist()], [high * s // 100 for s in score.tolist()]
        best = _ranked(near.mapInArrow(_negatives(part, least, most, negatives, id_type), f"window bigint, score bigint, id {kind['id']}"), "window", negatives)
        pos = spark.createDataFrame(pa.table({"window": a * positives + slot - 1, "anchor_id": pa.array(part.ids[a], id_type), "positive_id": got.column("id"), "positive_score": score}))
        best.join(F.broadcast(pos), "window").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")) \
            .write.mode("append").parquet(out)
    drop(spark, at)
    drop(spark, at2)
    return spark.read.schema(result).parquet(out)
