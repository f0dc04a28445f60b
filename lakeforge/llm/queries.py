"""The registered queries of the text operators over the given tables, and
their DuckDB SQL where SQL can express the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import exact_dedup, hard_negatives, language, mixing, oracles, packing, periodic, pii, quality_rules, secrets, simhash, suffix_dedup, toxicity, urls
from lakeforge.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(_table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    count = lambda name: F.size(F.filter("found", lambda s: s["k"] == secrets.KINDS.index(name))).cast("bigint").alias(f"n_{name}")
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in secrets.KINDS],
                        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), secrets.joined(F.col("found")).alias("spans"))


#: Fixed by the query: rules by host and path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: A page is listed for its text or for a word of its host.
SPAM_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
JUNK_SHARE = 0.1


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    listed = pages.where(urls.junk_page(F.col("html"), JUNK_SHARE) | urls.spam_host(urls.host_of(F.col("url")), SPAM_WORDS)).select("url")
    return urls.judge(pages.drop("html"), listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *[f"n_{k.name}" for k in pii.KINDS],
                        F.sha2(pii.joined(F.col("found"), base_only=True), 256).alias("base_sha256"), pii.joined(F.col("found")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), use=fold != 0)
    scored = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (F.coalesce(fold, F.lit(-1)) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "dup_line_chars", "dup5_chars", "dup8_chars", "dup12_chars")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def cycle_weights(i: int, _name: str | None) -> float:
    """1, 2, 3, repeating over the sources in order."""
    return i % 3 + 1


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_single(_table(spark, sf_dir, "documents"), "source", cycle_weights, max_repeats=3)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=50).withColumnRenamed("id", "doc_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), length=2048, end_id=0)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; where h = crc32 of the decimal doc_id ends in 0,
    the words from one on are replaced by the first ones of them, over and over."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"))
    d = d.withColumn("words", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", "[ \\x09-\\x0D]+"), "")))
    d = d.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("words"))
    d = d.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    d = d.withColumn("p", (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    left = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))), 1, left)
    return d.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice("words", 1, F.col("a")), tail), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(with_periodic_tails(_table(spark, sf_dir, "documents"))).withColumn("best", periodic.best(F.col("runs")))
    top = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), *top,
                        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(periodic.lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), anchors=F.col("vec_id") % 50 == 0, label=label, scale=256, positives=5, negatives=3, window=(50, 95))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = language.fit(docs, use=fold != 1)
    return language.predict(docs, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", (F.coalesce(fold, F.lit(-1)) == 1).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "accepted")


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_secrets, op3_url_filter, op4_pii, op5_suffix_dedup, op6_packing, op7_toxicity, op8_quality_rules, op9_simhash_dedup, op10_mixing,
    op11_periodic_runs, op12_hard_negatives, op13_language)}
ORACLES: dict[str, str] = {
    "op1_exact_dedup": oracles.OP1,
    "op3_url_filter": oracles.op3(URL_RULES, SPAM_WORDS, JUNK_SHARE, urls.TRACKING),
    "op5_suffix_dedup": oracles.OP5,
    "op8_quality_rules": oracles.op8(quality_rules.Limits()),
    "op10_mixing": oracles.OP10,
    "op12_hard_negatives": oracles.OP12,
}
