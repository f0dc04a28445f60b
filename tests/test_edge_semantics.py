"""NULL keys, outer joins, deletes, replays and chunks of equal rows."""

import pytest
from pyspark.sql import functions as F

from lakeforge.functions.nested import nest, unnest
from lakeforge.operators import layout, skew, upsert, windows
from lakeforge.plans.inspect import explain_text
from lakeforge.session import exists, listing, remove, scratch_root
from lakeforge.sources import files


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_nest_splits_equal_rows_and_keeps_the_null_group(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [(None, 2), (None, 2), ("b", None)], "k STRING, v INT")
    for size in (1, 10, 1000):
        chunks = nest(df, ["k"], ["v"], "items", max_items=size)
        assert chunks.columns == ["k", "chunk", "items"]
        assert rows(unnest(chunks, ["k"], "items")) == rows(df)
    largest = nest(df, ["k"], ["v"], "items", max_items=10).agg(F.max(F.size("items"))).first()[0]
    assert largest <= 25


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("salts", [2, 256])
def test_skew_join_equals_the_plain_join(spark, how, salts):
    big = spark.createDataFrame([(1, i) for i in range(300)] + [(k, k) for k in range(2, 30)] + [(None, 7)] * 5, "k INT, v INT")
    other = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (99, "w"), (None, "n")], "j INT, w STRING")
    got = skew.skew_join(big, other, "k", "j", salts=salts, hot_fraction=0.2, how=how, sample_fraction=1.0, rows_per_salt=40)
    assert rows(got) == rows(big.join(other, big.k == other.j, how))
    same = other.withColumnRenamed("j", "k")
    got = skew.skew_join(big, same, "k", salts=salts, hot_fraction=0.2, how=how, sample_fraction=1.0)
    want = big.join(same, "k", how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_skew_join_scans_the_big_side_once_beside_detection(spark, sf):
    path = scratch_root(spark, "skew_big")
    spark.range(1000).withColumn("k", F.col("id") % 3).write.parquet(path)
    plan = explain_text(skew.skew_join(spark.read.parquet(path), spark.range(3).withColumnRenamed("id", "k"), "k", hot_fraction=0.2), "simple")
    assert plan.count("ReadSchema: struct<id:bigint,k:bigint>") == 1


def test_unknown_join_type_is_refused(spark):
    with pytest.raises(ValueError, match="cross"):
        skew.skew_join(spark.range(1), spark.range(1), "id", how="cross")


def test_null_keys_in_segments_and_shares(spark):
    df = spark.createDataFrame([(None, i, i) for i in range(1, 9)] + [("a", i, 1) for i in range(4)], "k STRING, o INT, v INT")
    specs = {"run": ("running_sum", "v"), "prev": ("lag", "v")}
    assert rows(windows.segmented_window(df, ["k"], ["o"], F.floor(F.col("o") / 2), specs)) == rows(windows.plain_window(df, ["k"], ["o"], specs))
    split = windows.skew_safe_window(df, ["k"], ["o"], F.floor(F.col("o") / 2), specs, hot_fraction=0.4, sample_fraction=1.0)
    assert rows(split) == rows(windows.plain_window(df, ["k"], ["o"], specs))
    assert windows.share_of_total(df, ["k"], "v", "share").agg(F.round(F.sum("share"), 6)).first()[0] == 2.0


def test_hot_ties_and_days_are_counted_not_gathered(spark):
    df = spark.createDataFrame([("n", 5, i) for i in range(200)] + [("n", 9, 900), (None, 1, 901), (None, 1, 902)], "k STRING, v INT, id INT")
    got = windows.ranks_by_counting(df, ["k"], "v", "id", F.floor(F.col("id") / 16))
    specs = {"row_number": ("row_number", None), "rank": ("rank", None, ["-v"]), "dense_rank": ("dense_rank", None, ["-v"])}
    want = windows.plain_window(df, ["k"], [F.desc("v"), F.col("id")], specs)
    cols = ["k", "v", "id", "row_number", "rank", "dense_rank"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))
    summed = windows.range_running_sum(df, ["k"], "v", "id", "upto").select("k", "v", "id", "upto")
    assert rows(summed) == rows(windows.plain_window(df, ["k"], ["v"], {"upto": ("range_sum", "id", ["v"])}).select("k", "v", "id", "upto"))


@pytest.mark.parametrize("kept", [[5], []])
def test_bucketed_merge_deletes_what_the_source_lacks(spark, kept):
    """As the plain merge does, in every bucket, also in those that end up empty."""
    target = scratch_root(spark, "buckets")
    dim = spark.range(64).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v"))
    dim.withColumn("_bucket", upsert.bucket(["k"], 4)).write.partitionBy("_bucket").parquet(target)
    source = spark.createDataFrame([(k, 1) for k in kept], "k INT, v INT")
    args = {"update_set": {"v": "s.v"}, "delete_not_matched": True}
    upsert.upsert_partitioned(spark, target, scratch_root(spark, "stage"), source, ["k"], 4, **args)
    want = upsert.apply(upsert.upsert(dim, source, ["k"], **args))
    left = [n for n in listing(spark, target) if n.startswith("_bucket=")]
    got = spark.read.schema("k INT, v INT, _bucket INT").parquet(target).select("k", "v")
    assert rows(got) == rows(want) and len(left) == len(kept)


def test_merge_reads_the_rows_of_the_target_once(spark):
    path = scratch_root(spark, "merge_target")
    spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    source = spark.createDataFrame([(1, "y"), (200, "z")], "k BIGINT, v STRING")
    plan = explain_text(upsert.upsert(spark.read.parquet(path), source, ["k"], update_set={"v": "s.v"}), "simple")
    assert plan.count("ReadSchema: struct<k:bigint,v:string>") == 1


def test_load_survives_replays_and_crashes(spark):
    landing, target, ledger = (scratch_root(spark, n) for n in ("landing", "target", "ledger"))
    part = lambda lo: spark.range(lo, lo + 10).coalesce(1).write.mode("append").parquet(landing)
    loaded = lambda: spark.read.parquet(target).count()
    part(0)
    assert files.copy_into(spark, landing, target, ledger) == 1 and loaded() == 10
    assert files.copy_into(spark, landing, target, ledger) == 0 and loaded() == 10
    part(10)
    assert files.copy_into(spark, landing, target, ledger) == 1 and loaded() == 20
    # a load that died after its ledger entry, and one that died after its data
    for gone in (f"{target}/batch=1", None):
        remove(spark, f"{ledger}/done/batch=1")
        if gone:
            remove(spark, gone)
        assert files.copy_into(spark, landing, target, ledger) == 0 and loaded() == 20
    assert exists(spark, f"{ledger}/done/batch=1")


def test_checkpoint_owner_is_on_storage(spark):
    from lakeforge.streaming import incremental as INC
    ckpt = scratch_root(spark, "owned")
    INC.claim_checkpoint(spark, ckpt, "a")
    INC.claim_checkpoint(spark, ckpt, "a")
    assert listing(spark, ckpt) == [INC.OWNER]
    with pytest.raises(ValueError, match="belongs to query a"):
        INC.claim_checkpoint(spark, ckpt, "b")


def test_nest_of_equal_rows_needs_no_array_of_their_number(spark):
    """Millions of equal rows come back whole, in chunks of about the bound."""
    from lakeforge.functions import nested as N
    rows = spark.range(3_000_000).select(F.lit(1).alias("g"), F.lit("same").alias("v")).unionByName(
        spark.range(5000).select(F.lit(1).alias("g"), F.col("id").cast("string").alias("v")))
    chunks = N.nest(rows, ["g"], ["v"], "items", max_items=1000)
    sizes = chunks.select(F.size("items").alias("n"))
    got = sizes.agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.count("n").alias("chunks")).first()
    assert got["all"] == 3_005_000 and got["most"] < 3000 and 2900 <= got["chunks"] <= 3005
    assert chunks.select(F.inline("items")).where("v = 'same'").count() == 3_000_000


def test_numbers_come_in_blocks(spark):
    from lakeforge.functions import nested as N
    df = spark.createDataFrame([("a", 1), ("b", 10_000), ("c", N._BLOCK)], "k STRING, n BIGINT")
    got = N._numbers(df, F.col("n"), "i").groupBy("k").agg(F.count("i").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.count_distinct("i").alias("d")).collect()
    assert {r["k"]: (r["n"], r["lo"], r["hi"], r["d"]) for r in got} == {"a": (1, 0, 0, 1), "b": (10_000, 0, 9999, 10_000), "c": (N._BLOCK, 0, N._BLOCK - 1, N._BLOCK)}


def test_many_new_files_are_loaded_in_bounded_groups(spark):
    landing, target, ledger = (scratch_root(spark, n) for n in ("landing", "target", "ledger"))
    spark.range(70).repartition(7).write.parquet(landing)
    assert files.copy_into(spark, landing, target, ledger, files_per_load=2) == 7
    assert sorted(r.id for r in spark.read.parquet(target).select("id").collect()) == list(range(70))
    assert len([n for n in listing(spark, target) if n.startswith("batch=")]) > 1
    assert files.copy_into(spark, landing, target, ledger, files_per_load=2) == 0
    assert spark.read.parquet(target).count() == 70


def test_schema_is_inferred_by_the_first_run_only(spark, monkeypatch):
    landing, ckpt = scratch_root(spark, "landing_json"), scratch_root(spark, "ckpt_json")
    spark.createDataFrame([(1, "a")], "k bigint, v string").write.json(landing)
    first = files.kept_schema(spark, landing, "json", ckpt)
    monkeypatch.setattr(files, "infer_schema", lambda *_: pytest.fail("inferred again"))
    spark.createDataFrame([(1.5, "b", 1)], "k double, v string, more int").write.mode("append").json(landing)
    assert files.kept_schema(spark, landing, "json", ckpt) == first
    got = spark.read.schema(first).json(landing).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "a"), (None, "b")]


def test_detached_table_outlives_its_catalog_entry(spark):
    path = scratch_root(spark, "detached")
    files.save_table(spark.range(5), "for_detached", path=path)
    df = files.detached(spark, "for_detached")
    assert not spark.catalog.tableExists("for_detached") and df.count() == 5


def test_input_bytes_come_from_the_folders_listing(spark):
    path = scratch_root(spark, "odd folders")
    spark.range(50).withColumn("p q", F.concat(F.lit("a b%"), F.col("id") % 3)).repartition(4).write.partitionBy("p q").parquet(path)
    df = spark.read.parquet(path)
    sizes = df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
    assert layout.input_bytes(df) == sizes > 0



def test_ranks_read_a_derived_table_once(spark, sf):
    from lakeforge.plans import load_all
    assert "FileScan" not in explain_text(load_all()["wn_05_ranking_functions_on_ties"].run(spark, sf), "simple")
