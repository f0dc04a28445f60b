"""The pipeline against a plain version of its stages, and the contract of its queries."""

import inspect

import corpus_pipeline as C
from lakeforge.llm import mixing, packing, quality_rules
from lakeforge.llm.queries import ORACLES, QUERIES, cycle_weights
from pyspark.sql import functions as F

from .test_quality_rules import plain
from .test_simhash import all_pairs, plain_fingerprint, roots


def test_stages_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns, after = docs.columns, docs
    stages = dict(C.STAGES)
    assert list(stages) == ["quality rules", "exact dedup", "simhash near-dedup", "mixing", "packing"]

    def step(name):
        out = stages[name](spark, after, sf).cache()
        assert out.columns == columns
        return out

    after = step("quality rules")
    good = {i: t for i, t in rows.items() if plain(t)["kept"]}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(good)

    after = step("exact dedup")
    last = {}
    for i, t in sorted(good.items()):
        last["".join(c.lower() if c.isascii() else c for c in t)] = i
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(last.values())

    after = step("simhash near-dedup")
    ids = sorted(last.values())
    comp = roots(len(ids), all_pairs([plain_fingerprint(rows[i], 3) for i in ids], 2))
    kept = sorted({min(i for i, d in zip(ids, comp) if d == c) for c in set(comp)})
    assert sorted(r["doc_id"] for r in after.collect()) == kept

    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_single(after, "source", cycle_weights).collect() if r["taken"]}
    after = step("mixing")
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == taken
    assert all(rows[r["doc_id"]] == r["text"] for r in after.collect())

    packed = stages["packing"](spark, after, sf).cache()
    whole = packing.pieces(after, "doc_id", "text", 2048, None, 0)
    assert packed.groupBy("doc_id", "piece", "ids_crc32").count().exceptAll(whole.groupBy(F.col("id"), "piece", "ids_crc32").count()).isEmpty()
    assert packed.count() == whole.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_run(spark, sf):
    out = C.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_registered():
    import __spark_entry__ as E
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql()) and "pipeline" not in E.oracle_sql()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert list(inspect.signature(C.STAGES[0][1]).parameters) == ["spark", "docs", "sf_dir"]


def test_quality_of_documents_is_judged_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = docs.where("doc_id % 7 = 1")
    both = quality_rules.measure(docs).where("doc_id % 7 = 1")
    assert quality_rules.measure(one).exceptAll(both).isEmpty()
