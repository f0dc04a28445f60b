"""From raw documents to packed training sequences.

STAGES are applied in order. Each function takes (spark, docs, sf_dir); all
but the last return the columns of ``documents``, for the rows that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import exact_dedup, mixing, packing, quality_rules, simhash
from lakeforge.llm.common import save
from lakeforge.llm.queries import cycle_weights
from lakeforge.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat themselves or are too short go."""
    configure(spark)
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    configure(spark)
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    configure(spark)
    return simhash.dedup(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    configure(spark)
    return mixing.resample(docs, F.array("source"), cycle_weights, max_repeats=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in the sequences."""
    configure(spark)
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("simhash near-dedup", near), ("mixing", mix), ("packing", pack)]

#: Fingerprints, tokens and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
