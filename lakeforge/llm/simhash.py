"""Near-duplicates by SimHash and multi-index hashing.

A text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and into
shingles of consecutive words, repeats included. Each shingle's XXH64 (seed
42) votes on 64 bits; a bit of the fingerprint is 1 if it is set in over half
the hashes. A text without words has fingerprint zero.

Search, on distinct fingerprints only: the 64 bits are cut into segments. If
two fingerprints differ in at most ``max_bits`` bits, then some segment
differs in few: with radius r = max_bits // segments and
a = max_bits % segments, one of the first a + 1 segments within r bits or one
of the others within r - 1 bits. So every fingerprint is stored once for each
segment, and asks for all values in a small Hamming ball around its own
segment values. What the tables return is verified on the complete distance.
Only the value that is larger is asked for, since the partner asks for it the
other way round.

A segment value that more than ``bucket`` different fingerprints share is not
compared pairwise. All fingerprints that meet such a bucket, as members or by
asking, go a second exact way: each is listed under every 64-bit value within
half the distance, and those listed under the same value are linked to one of
them. At most 65 fingerprints can be listed under one value for up to 2 bits,
so no group grows with the data.

Linked fingerprints are joined to components; a component is named by the
smallest id of its documents.

Defined results: a null or empty text has fingerprint zero and links to the
others without words, and to any fingerprint within the distance. A null id
counts after all others: it names a component only if all its ids are null.
Repeated rows share a fingerprint. An empty table gives an empty result.
Extra columns do not matter to ``fingerprints`` and ``classes``; ``dedup``
passes them through.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import fresh, quoted, save, utf8
from lakeforge.llm.components import components
from lakeforge.llm.exact_dedup import row_key

#: Pairwise checks in a bucket of up to so many fingerprints; the exact second way beyond.
BUCKET = 64


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i:i + (1 << 14)]
        votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprint_batches(shingle: int, names: list[str]):
    def run(batches):
        for b in batches:
            out = [fingerprint(t, shingle) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.int64())], names)
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("fp")).mapInArrow(_fingerprint_batches(shingle, ["id", "fp"]), schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _balls(width: int, radius: int) -> list[int]:
    """All numbers of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def _segments(n: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment that is searched."""
    r, a = divmod(max_bits, n)
    edges = [64 * i // n for i in range(n + 1)]
    found = [(edges[i], edges[i + 1] - edges[i], r if i <= a else r - 1) for i in range(n)]
    return [s for s in found if s[2] >= 0]


def links(distinct: DataFrame, max_bits: int = 2, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: enough of the pairs within ``max_bits`` bits of a table of
    distinct fingerprints ``fp`` that linked ones are connected."""
    cut = _segments(segments, max_bits)

    def value(first: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(_signed((1 << width) - 1)))

    stored = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("seg"), value(f, w).alias("val")) for k, (f, w, _) in enumerate(cut)])).alias("s"))
    stored = stored.select("s.seg", "s.val", "fp")
    sizes = save(stored.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket), "buckets")
    # A bucket over the limit is stored as one row that says so.
    marked = stored.join(sizes, ["seg", "val"], "left")
    table = save(marked.where(F.col("n").isNull()).select("seg", "val", F.col("fp").alias("there"), F.lit(False).alias("full"))
                 .unionByName(sizes.select("seg", "val", F.lit(None).cast("bigint").alias("there"), F.lit(True).alias("full"))), "segments")
    asked = None
    for k, (f, w, r) in enumerate(cut):
        own = value(f, w)
        # values asked for are the larger ones: the mask's highest bit is not set in the own value
        ask = F.filter(F.array(*[own.bitwiseXOR(F.lit(_signed(m))) for m in _balls(w, r)]), lambda x: x >= own)
        part = distinct.select(F.lit(k).alias("seg"), F.explode(ask).alias("val"), "fp")
        asked = part if asked is None else asked.unionByName(part)
    met = asked.join(table, ["seg", "val"]).select("fp", "there", "full").where(
        F.col("full") | ((F.col("fp") != F.col("there")) & _near(F.col("fp"), F.col("there"), max_bits)))
    met = save(met, "met")
    pairs = met.where(~F.col("full")).select(F.col("fp").alias("a"), F.col("there").alias("b"))
    if sizes.isEmpty():
        return pairs
    # Members of a full bucket ask for their own value, so both sides of a pair that it hides are here.
    return pairs.unionByName(_star_links(met.where("full").select("fp").distinct(), max_bits))


def _star_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links of any fingerprints, in linear size: two of them are within
    max_bits if some value is within half of it (rounded up) of the one and
    half of it (rounded down) of the other."""
    far, near = (max_bits + 1) // 2, max_bits // 2
    masks = F.array(*[F.struct(F.lit(_signed(m)).alias("m"), F.lit(bin(m).count("1") <= near).alias("near")) for m in _balls(64, far)])
    listed = fps.select("fp", F.explode(masks).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x.m")).alias("at"), "x.near")
    hubs = listed.where("near").groupBy("at").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n"))
    return listed.join(hubs, "at").where(F.col("fp") != F.col("hub")).select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, segments: int, bucket: int) -> DataFrame:
    """id, fp, root (the smallest fingerprint of the component) and component_id of every row."""
    rows = save(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = save(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct_fps")
    roots = components(links(distinct, max_bits, segments, bucket), "a", "b")
    rooted = save(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    named = save(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    by_fp = save(rooted.join(named, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(by_fp, "fp").select("id", "fp", "root", "component_id")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
            segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """``(id, fp, component_id)`` of every row."""
    return _rooted(docs, id_col, text_col, shingle, max_bits, segments, bucket).select("id", "fp", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
          segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row of each component, the one with the smallest id, with the
    columns of ``docs``. Of several rows with that id, one with the smallest
    fingerprint stays; with only null ids, any one with the smallest fingerprint."""
    found = _rooted(docs, id_col, text_col, shingle, max_bits, segments, bucket)
    named = F.col("id").eqNullSafe(F.col("component_id"))
    first = found.groupBy("root", "component_id").agg(F.min(F.when(named, F.col("fp"))).alias("fp"))
    keys = first.select(row_key(F.col("fp").cast("string").cast("binary"), F.col("component_id")).alias("key"))
    fp, key = fresh(docs, "fp", "key")
    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])
    rows = docs.withColumn(fp, utf8(f"`{text_col}`")).mapInArrow(_fingerprint_batches(shingle, schema.names), schema)
    rows = rows.withColumn(key, row_key(quoted(fp).cast("string").cast("binary"), quoted(id_col)))
    return rows.join(keys.withColumnRenamed("key", key), key, "left_semi").dropDuplicates([key]).select(*[quoted(c) for c in docs.columns])
