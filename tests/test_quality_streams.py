"""Quality rules, quarantine, streams and checkpoints."""

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import quality as Q
from lakeforge.session import scratch_root
from lakeforge.sources.tables import typed
from lakeforge.streaming import incremental as INC


def test_rule_parse_round_trip():
    r = Q.parse_constraint("CONSTRAINT valid_key EXPECT (c_custkey IS NOT NULL) ON VIOLATION DROP ROW")
    assert r == Q.Rule("valid_key", "c_custkey IS NOT NULL", "drop")
    assert Q.parse_constraint(r.sql()) == r
    assert Q.parse_constraint("CONSTRAINT n EXPECT (a > 0)").action == "warn"
    assert Q.parse_constraint("constraint f expect (a > 0) on violation fail update").action == "fail"


def test_fail_rule_aborts_write_and_publishes_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k INT, name STRING")
    rules = [Q.Rule("has_name", "name IS NOT NULL", "fail"), Q.Rule("pos", "k > 1", "drop")]
    path = scratch_root(spark, "t_fail")
    with pytest.raises(Exception, match="has_name"):
        Q.apply_rules(df, rules, "d").write.parquet(path)
    import os
    assert not os.path.exists(os.path.join(path, "_SUCCESS"))


def test_null_predicate_counts_as_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v INT")
    rules = [Q.Rule("pos", "v >= 0", "drop")]
    assert Q.apply_rules(df, rules).count() == 1
    m = Q.quality_metrics(df, rules, "d").first()
    assert (m.passed, m.failed) == (1, 2)


def test_warn_counts_ride_on_the_write(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([(1,), (-2,), (3,)], "v INT")
    obs = Observation("q")
    out = Q.apply_rules(df, [Q.Rule("pos", "v >= 0", "warn")], observation=obs)
    assert out.count() == 3 and obs.get["pos"] == 1


def test_quarantine_partitions_input(spark, sf):
    c = typed(spark, sf, "customer")
    rules = [Q.Rule("pos", "c_acctbal >= 0", "drop"), Q.Rule("nat", "c_nationkey < 20", "drop")]
    clean, rejected = Q.quarantine(c, rules)
    assert clean.count() + rejected.count() == c.count()
    assert clean.unionByName(rejected.drop("reasons")).exceptAll(c).count() == 0


def test_incremental_resume_counts(spark, sf):
    from lakeforge.plans.io import incremental_customer
    sink, runs = incremental_customer(spark, sf, "t_inc", via_table=False)
    assert runs == [150, 0, 0] and sink.count() == 150     # sf0.001: every key is below 500


def test_checkpoint_cannot_be_shared(spark):
    ckpt = scratch_root(spark, "t_ckpt")
    INC.claim_checkpoint(spark, ckpt, "a")
    with pytest.raises(ValueError):
        INC.claim_checkpoint(spark, ckpt, "b")


def test_checkpoint_layout_and_rate_limit(spark, sf):
    src = scratch_root(spark, "t_rate_src")
    typed(spark, sf, "customer").repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    sink, ckpt = scratch_root(spark, "t_rate_sink"), scratch_root(spark, "t_rate_ckpt")
    res = INC.run_available_now(INC.file_stream(spark, src, "parquet", schema, max_files=1), sink, ckpt,
                                query_name="t_rate")
    assert res.rows == 150 and res.batches >= 4
    assert {"commits", "offsets", "metadata", "sources"} <= set(INC.checkpoint_layout(spark, ckpt))


def test_streaming_and_batch_transform_agree(spark, sf):
    from lakeforge.plans.projection import machinery_accounts
    from lakeforge.sources.tables import raw
    src = scratch_root(spark, "t_same_src")
    c = raw(spark, sf, "customer")
    c.write.parquet(src)
    sink, ckpt = scratch_root(spark, "t_same_sink"), scratch_root(spark, "t_same_ckpt")
    INC.run_available_now(machinery_accounts(spark.readStream.schema(c.schema).parquet(src)), sink, ckpt,
                          query_name="t_same")
    batch = machinery_accounts(c)
    out = spark.read.parquet(sink)
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_late_rows_dropped_by_watermark(spark):
    """Rows older than the watermark of an earlier batch are dropped."""
    from lakeforge.streaming.event_time import windowed_counts
    src = scratch_root(spark, "t_late")
    first = spark.createDataFrame([(1, "2024-01-05 00:00:00")], "id INT, ts STRING").select(
        "id", F.col("ts").cast("timestamp").alias("ts"))
    first.write.parquet(src)
    stream = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(src)
    agg = windowed_counts(stream, "ts", "1 hour", "1 day")
    sink, ckpt = scratch_root(spark, "t_late_sink"), scratch_root(spark, "t_late_ckpt")
    INC.run_available_now(agg, sink, ckpt, query_name="t_late")
    late = spark.createDataFrame([(2, "2024-01-01 00:00:00"), (3, "2024-01-06 12:00:00")], "id INT, ts STRING").select(
        "id", F.col("ts").cast("timestamp").alias("ts"))
    late.write.mode("append").parquet(src)
    INC.run_available_now(agg, sink, ckpt, query_name="t_late")
    starts = sorted(str(r.window_start)[:10] for r in spark.read.parquet(sink).collect())
    assert "2024-01-01" not in starts and "2024-01-05" in starts


def test_partition_pruning_on_clustered_layout(spark, sf):
    from lakeforge.operators.layout import write_clustered
    from lakeforge.plans.inspect import explain_text
    o = typed(spark, sf, "orders").withColumn("yr", F.year("o_orderdate"))
    path = scratch_root(spark, "t_clustered")
    write_clustered(o, path, ["yr"], ["o_custkey"], num_partitions=4)
    q = spark.read.parquet(path).filter("yr = 1998 AND o_custkey < 10")
    text = explain_text(q)
    assert "PartitionFilters: [isnotnull(yr" in text and "(yr" in text and "= 1998)" in text
    assert "PushedFilters: [IsNotNull(o_custkey), LessThan(o_custkey,10)]" in text
    assert q.count() == o.filter("yr = 1998 AND o_custkey < 10").count()


def test_memory_sink_and_rate_source(spark):
    q = (spark.readStream.format("rate").option("rowsPerSecond", 50).load()
         .writeStream.format("memory").queryName("t_rate_mem").outputMode("append").start())
    try:
        q.processAllAvailable()
        import time
        time.sleep(1.5)
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("t_rate_mem").columns == ["timestamp", "value"]


def test_foreach_batch_is_idempotent_per_batch(spark, sf):
    src = scratch_root(spark, "t_feb_src")
    c = typed(spark, sf, "customer").select("c_custkey", "c_name")
    c.repartition(3).write.parquet(src)
    out, ckpt = scratch_root(spark, "t_feb_out"), scratch_root(spark, "t_feb_ckpt")
    writer = INC.idempotent_batch_writer(out)
    q = (spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src).writeStream
         .foreachBatch(writer).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    replay = scratch_root(spark, "t_feb_replay")               # the same batch input, replayed
    spark.read.parquet(f"{out}/batch_id=0").write.parquet(replay)
    writer(spark.read.parquet(replay), 0)                     # overwrites its own output
    again = spark.read.parquet(out).count()
    assert first == again == 150


def test_compaction_sizes_files_from_input_bytes(spark, sf):
    from lakeforge.operators.layout import compact, input_bytes
    src = scratch_root(spark, "t_small_files")
    typed(spark, sf, "orders").repartition(12).write.parquet(src)
    df = spark.read.parquet(src)
    assert input_bytes(df) > 0
    out = scratch_root(spark, "t_compacted")
    assert compact(df, out) == 1                       # well under one target file
    assert spark.read.parquet(out).count() == df.count()
    assert compact(df, scratch_root(spark, "t_compacted3"), target_file_bytes=max(1, input_bytes(df) // 3)) >= 3


def test_compaction_makes_files_of_whole_splits(spark):
    from lakeforge.operators.layout import compact
    src, one, two, many = (scratch_root(spark, f"t_splits{k}") for k in range(4))
    spark.range(2400).select("id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("v")).repartitionByRange(24, "id").write.parquet(src)
    df = spark.read.parquet(src).select("*", F.col("_metadata.file_name").alias("src"))
    assert compact(df, one) == 1 and compact(df, two, target_files=2) == 2 and compact(df, many, target_files=30) == 30
    for path, files in ((one, 1), (two, 2), (many, 30)):
        got = spark.read.parquet(path)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
        sizes = [r["count"] for r in got.groupBy("_metadata.file_path").count().collect()]
        assert len(sizes) == files and max(sizes) <= 2 * 2400 / files
    # no shuffle: the rows of a file come to one file
    assert spark.read.parquet(two).groupBy("src").agg(F.count_distinct("_metadata.file_path").alias("n")).where("n > 1").count() == 0
