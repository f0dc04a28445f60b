"""File sources and sinks: CSV with a declared schema and parse modes,
JSON/CSV landing folders, table writes with save modes, schema-merged
parquet reads, snapshot folders and format round trips.

All paths are folders on shared storage (see ``session.scratch_root``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.functions.columns import conform
from lakeforge.session import exists, listing

# Typed customer extract: the reference schema minus the columns the test
# data lacks (address, comment).
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType(), nullable=False),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_phone", T.StringType()),
    T.StructField("c_acctbal", T.DecimalType(18, 2)),
    T.StructField("c_mktsegment", T.StringType()),
])
CUSTOMER_DDL = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_phone STRING, "
                "c_acctbal DECIMAL(18,2), c_mktsegment STRING")

PARSE_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
CORRUPT = "_corrupt_record"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             mode: str = "FAILFAST", keep_corrupt: bool = False) -> DataFrame:
    """CSV with a declared schema: no inference pass over the data.

    ``mode``: PERMISSIVE (bad fields become NULL; with ``keep_corrupt`` the
    raw line is kept in ``_corrupt_record``), DROPMALFORMED (bad rows are
    skipped) or FAILFAST (the first bad row fails the job).

    Only the columns a query reads are parsed (CSV column pruning), so a
    row with a bad field in an unread column is neither dropped nor failed;
    a bare ``count()`` parses nothing.
    """
    if mode not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}")
    if keep_corrupt:
        base = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        schema = T.StructType(base.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.format("csv").schema(schema).option("header", "true").option("mode", mode)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.load(path)


def infer_schema(spark: SparkSession, path: str, fmt: str) -> T.StructType:
    """Column types inferred by one batch read of a landing folder; used to
    start a file stream (streams need a schema up front)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    return reader.load(path).schema


def kept_schema(spark: SparkSession, path: str, fmt: str, checkpoint: str) -> T.StructType:
    """The column types of a landing folder for the stream with this
    ``checkpoint``: inferred by its first run and kept in the checkpoint, so
    that later runs read only what arrived and all runs see the same types.
    A value of later files that does not fit them is NULL (PERMISSIVE)."""
    place = f"{checkpoint}/_schema"
    if not exists(spark, f"{place}/_SUCCESS"):
        found = infer_schema(spark, path, fmt)
        spark.createDataFrame([(found.json(),)], "value string").coalesce(1).write.mode("overwrite").text(place)
    return T.StructType.fromJson(json.loads(spark.read.text(place).first()[0]))


def detached(spark: SparkSession, name: str) -> DataFrame:
    """The rows of an external table as a frame over its files, and its
    catalog entry dropped: the frame keeps layout and schema, and no name
    stays behind in the session."""
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
               partition_by: list[str] | None = None) -> None:
    """Write a session-catalog parquet table with a save mode (append,
    overwrite, error, ignore). With ``path`` the table is external, so the
    data lives on shared storage."""
    w = df.write.format("parquet").mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def append_conformed(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append to a path only after the frame conforms to the table schema
    (path writes do not check types, so the guard is ours)."""
    conform(df, schema).write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder whose files gained columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def round_trip(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """Write ``df`` in ``fmt`` and read it back with the same schema."""
    spark = df.sparkSession
    if fmt == "text":
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
        return spark.read.text(path).select(F.from_json("value", df.schema).alias("r")).select("r.*")
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    r = spark.read.format(fmt).schema(df.schema)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


#: Files of one load; a reader takes their paths from the driver.
FILES_PER_LOAD = 10_000


def copy_into(spark: SparkSession, landing: str, target: str, ledger: str, fmt: str = "parquet", files_per_load: int = FILES_PER_LOAD) -> int:
    """Idempotent load: append the files that no earlier load took, and
    return their number. A rerun loads nothing.

    New files are dealt by a hash of their path to numbered loads of about
    ``files_per_load``, so the driver never holds more paths than one load's.
    The names go to the ledger first (``batch=<n>``), then each load's rows to
    ``target/batch=<n>`` by overwrite, then a mark that it is done. A load that
    died in between is found without its mark and done again under the same
    number, so nothing is lost or twice; names that a run could not write yet
    are new files of the next one. Only the landing folder's listing is
    compared, as two distributed tables; files that were loaded before are not
    opened."""
    names = f"{ledger}/files"

    def numbers(folder: str) -> set[int]:
        return {int(n.partition("=")[2]) for n in listing(spark, f"{ledger}/{folder}") if n.startswith("batch=")}

    known = numbers("files")
    here = spark.read.format("binaryFile").load(landing).select("path")
    if known:
        here = here.join(spark.read.parquet(names).select("path"), "path", "left_anti")
    found = here.count()
    if found:
        loads = -(-found // files_per_load)
        dealt = here.withColumn("batch", F.pmod(F.xxhash64("path"), F.lit(loads)) + F.lit(max(known, default=-1) + 1))
        dealt.repartition("batch").write.mode("append").partitionBy("batch").parquet(names)
    for batch in sorted(numbers("files") - numbers("done")):
        _load_batch(spark, target, ledger, fmt, batch)
    return found


def _load_batch(spark: SparkSession, target: str, ledger: str, fmt: str, batch: int) -> None:
    paths = [r["path"] for r in spark.read.parquet(f"{ledger}/files/batch={batch}").toLocalIterator()]
    spark.read.format(fmt).load(paths).write.mode("overwrite").parquet(f"{target}/batch={batch}")
    spark.range(1).write.mode("overwrite").parquet(f"{ledger}/done/batch={batch}")
