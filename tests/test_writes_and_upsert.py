"""Sources, sinks, schema enforcement and upserts."""

import os

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import upsert as U
from lakeforge.session import scratch_root
from lakeforge.sources import files as FS
from lakeforge.sources.tables import typed


def test_ddl_and_struct_schemas_match(spark, sf):
    path = scratch_root(spark, "t_csv")
    FS.write_csv(typed(spark, sf, "customer").select(*[f.name for f in FS.CUSTOMER_SCHEMA.fields]), path)
    a = FS.read_csv(spark, path, FS.CUSTOMER_SCHEMA)
    b = FS.read_csv(spark, path, FS.CUSTOMER_DDL)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.count() == 150


def test_failfast_raises_on_bad_row(spark, sf):
    path = scratch_root(spark, "t_bad")
    df = spark.createDataFrame([("1", "a", "1", "p", "oops", "X")],
                               "c_custkey STRING, c_name STRING, c_nationkey STRING, c_phone STRING, c_acctbal STRING, c_mktsegment STRING")
    FS.write_csv(df, path)
    with pytest.raises(Exception):
        FS.read_csv(spark, path, FS.CUSTOMER_SCHEMA, mode="FAILFAST").collect()
    # Which rows DROPMALFORMED drops depends on the columns read (CSV column
    # pruning): a bare count() parses no field and keeps the row.
    assert FS.read_csv(spark, path, FS.CUSTOMER_SCHEMA, mode="DROPMALFORMED").select("c_acctbal").collect() == []
    row = FS.read_csv(spark, path, FS.CUSTOMER_SCHEMA, mode="PERMISSIVE", keep_corrupt=True).first()
    assert row.c_acctbal is None and row[FS.CORRUPT] is not None


def test_save_modes_and_enforcement(spark, sf):
    name = "t_save_modes"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    loc = scratch_root(spark, name)
    df = typed(spark, sf, "customer").select("c_custkey", "c_name")
    FS.save_table(df, name, "overwrite", path=loc)
    FS.save_table(df, name, "append", path=loc)
    assert spark.table(name).count() == 300
    FS.save_table(df, name, "ignore", path=loc)
    assert spark.table(name).count() == 300
    with pytest.raises(Exception):
        FS.save_table(df, name, "error", path=loc)
    bad = spark.createDataFrame([("not-a-number",)], "c_custkey STRING")
    with pytest.raises(Exception):
        bad.write.mode("append").saveAsTable(name)
    assert spark.table(name).count() == 300
    # overwrite replaces the schema
    FS.save_table(df.withColumn("extra", F.lit(1)), name, "overwrite", path=loc)
    assert "extra" in spark.table(name).columns


def test_create_or_replace_is_idempotent(spark, sf):
    name = "t_ctas"
    loc = scratch_root(spark, name)
    df = typed(spark, sf, "customer").filter("c_custkey < 50")
    for _ in range(2):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        FS.save_table(df, name, "overwrite", path=loc)
    assert spark.table(name).count() == 50


def test_append_conformed_rejects_bad_types(spark, sf):
    from lakeforge.functions.columns import SchemaViolation
    path = scratch_root(spark, "t_conf")
    target = typed(spark, sf, "customer").select("c_custkey", "c_name").schema
    FS.append_conformed(typed(spark, sf, "customer").select("c_custkey", "c_name"), path, target)
    with pytest.raises(SchemaViolation):
        FS.append_conformed(spark.createDataFrame([("x", "y")], "c_custkey STRING, c_name STRING"), path, target)


def _dim(spark, sf):
    return typed(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def _chg(spark):
    return spark.createDataFrame([(0, "Customer#000000000", 1.0), (9000001, "new", 5.0)],
                                 "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))


def test_upsert_duplicate_source_keys_raise(spark, sf):
    dup = _chg(spark).unionByName(_chg(spark))
    with pytest.raises(U.DuplicateSourceKeys):
        U.upsert(_dim(spark, sf), dup, ["c_custkey"], update_set={"c_acctbal": "s.c_acctbal"})


def test_builder_equals_functional_and_plans_agree(spark, sf):
    a = U.Merge(_dim(spark, sf), _chg(spark), ["c_custkey"]).when_matched_update(
        "t.c_acctbal <> s.c_acctbal", {"c_acctbal": "s.c_acctbal"}).when_not_matched_insert(
        {c: f"s.{c}" for c in ["c_custkey", "c_name", "c_acctbal"]})
    b = U.upsert(_dim(spark, sf), _chg(spark), ["c_custkey"], matched_condition="t.c_acctbal <> s.c_acctbal",
                 update_set={"c_acctbal": "s.c_acctbal"})
    pa = a.plan()
    assert pa.exceptAll(b).count() == 0 and b.exceptAll(pa).count() == 0
    a.broadcast_bytes = -1                            # force the full outer join plan
    pc = a.plan()
    assert pa.exceptAll(pc).count() == 0 and pc.exceptAll(pa).count() == 0
    m = U.metrics(pa).first()
    assert (m.num_updated_rows, m.num_inserted_rows, m.num_deleted_rows) == (1, 1, 0)


def test_null_compare_does_not_update(spark):
    t = spark.createDataFrame([(1, None), (2, 5)], "k INT, v INT")
    s = spark.createDataFrame([(1, 3), (2, None)], "k INT, v INT")
    m = U.metrics(U.upsert(t, s, ["k"], matched_condition="t.v <> s.v", update_set={"v": "s.v"})).first()
    assert m.num_updated_rows == 0
    m2 = U.metrics(U.upsert(t, s, ["k"], matched_condition="NOT (t.v <=> s.v)", update_set={"v": "s.v"})).first()
    assert m2.num_updated_rows == 2


def test_observed_snapshot_write(spark, sf):
    path = scratch_root(spark, "t_snap")
    stats = U.write_observed(U.upsert(_dim(spark, sf), _chg(spark), ["c_custkey"],
                                      update_set={"c_acctbal": "s.c_acctbal"}), path)
    assert stats["num_inserted_rows"] == 1 and spark.read.parquet(path).count() == 151


def test_partitioned_upsert_touches_only_source_buckets(spark, sf):
    target = scratch_root(spark, "t_bucketed")
    dim = _dim(spark, sf).withColumn("_bucket", U.bucket(["c_custkey"], 8))
    dim.write.partitionBy("_bucket").parquet(target)
    before = {d: os.path.getmtime(os.path.join(target, d)) for d in os.listdir(target) if d.startswith("_bucket=")}
    stats = U.upsert_partitioned(spark, target, scratch_root(spark, "t_stage"), _chg(spark), ["c_custkey"], 8,
                                 matched_condition="t.c_acctbal <> s.c_acctbal", update_set={"c_acctbal": "s.c_acctbal"})
    assert stats["num_updated_rows"] == 1 and stats["num_inserted_rows"] == 1
    out = spark.read.parquet(target)
    assert out.count() == 151
    assert out.filter("c_custkey = 0").first().c_acctbal == 1
    touched = {r[0] for r in _chg(spark).select(U.bucket(["c_custkey"], 8)).collect()}
    for d, t in before.items():
        b = int(d.split("=")[1])
        if b not in touched:
            assert os.path.getmtime(os.path.join(target, d)) == t


T_DDL, S_DDL = "k INT, v STRING", "k INT, v STRING"


def _merged(spark, target, source, broadcast_bytes=U.BROADCAST_BYTES):
    m = U.Merge(spark.createDataFrame(target, T_DDL), spark.createDataFrame(source, S_DDL), ["k"], broadcast_bytes)
    planned = m.when_matched_update(None, {"v": "s.v"}).when_not_matched_insert({"k": "s.k", "v": "s.v"}).plan()
    return sorted(((r.k, r.v, r._action) for r in planned.collect()), key=str)


@pytest.mark.parametrize("bound", [U.BROADCAST_BYTES, -1])
def test_repeated_and_null_source_keys_that_match_nothing_are_inserted(spark, bound):
    target = [(1, "a"), (2, "b"), (2, "b2"), (None, "n")]
    source = [(1, "A"), (2, "B"), (7, "x"), (7, "y"), (None, "p"), (None, "q")]
    assert _merged(spark, target, source, bound) == sorted([
        (1, "A", "update"), (2, "B", "update"), (2, "B", "update"), (None, "n", "keep"),
        (7, "x", "insert"), (7, "y", "insert"), (None, "p", "insert"), (None, "q", "insert")], key=str)


def test_repeated_source_keys_that_match_are_refused(spark):
    with pytest.raises(U.DuplicateSourceKeys, match="2 source rows"):
        _merged(spark, [(1, "a"), (3, "c")], [(1, "A"), (1, "B"), (9, "x")])


def test_plan_looks_at_the_target_only_for_repeated_keys(spark, tmp_path):
    """With different keys no job reads the target; its rows are in one scan of the plan, its keys in another."""
    from lakeforge.plans.inspect import explain_text
    spark.createDataFrame([(i, str(i)) for i in range(50)], T_DDL).write.parquet(f"{tmp_path}/t")
    m = U.Merge(spark.read.parquet(f"{tmp_path}/t"), spark.createDataFrame([(1, "A"), (99, "B")], S_DDL), ["k"])
    text = explain_text(m.when_matched_update(None, {"v": "s.v"}).when_not_matched_insert({"k": "s.k", "v": "s.v"}).plan())
    reads = [line for line in text.splitlines() if "ReadSchema" in line]
    assert sum("v:string" in line for line in reads) == 1 and len(reads) == 2
    for k in ("SortMergeJoin", "CartesianProduct"):
        assert k not in text


def test_broadcast_by_statistics_or_by_count(spark):
    small = spark.createDataFrame([(i, "x" * 100) for i in range(1000)], S_DDL)
    assert U.fits_broadcast(small, 64 << 20) and U.fits_broadcast(small, 200_000)
    assert not U.fits_broadcast(small, 100_000) and not U.fits_broadcast(small, -1)


def test_bucket_publish_is_repeated_after_a_failure(spark, tmp_path, monkeypatch):
    """The overwrite fails after it has removed a bucket: the same call again ends as if nothing had happened."""
    from lakeforge.session import remove
    target, stage = f"{tmp_path}/dim", f"{tmp_path}/stage"
    spark.createDataFrame([(i, f"a{i}") for i in range(40)], T_DDL).withColumn("_bucket", U.bucket(["k"], 4)).write.partitionBy("_bucket").parquet(target)
    source = spark.createDataFrame([(1, "new"), (77, "in")], S_DDL)
    merge = lambda: U.upsert_partitioned(spark, target, stage, source, ["k"], 4, update_set={"v": "s.v"})
    with monkeypatch.context() as m:
        m.setattr(U, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            merge()
    hit = source.select(U.bucket(["k"], 4).alias("b")).first()["b"]
    remove(spark, f"{target}/_bucket={hit}")
    expected = {**{i: f"a{i}" for i in range(40)}, 1: "new", 77: "in"}
    for _ in range(2):
        stats = merge()
        assert (stats["num_updated_rows"], stats["num_inserted_rows"]) == (1, 1)
        assert {r.k: r.v for r in spark.read.parquet(target).collect()} == expected
