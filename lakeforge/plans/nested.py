"""2.11 Arrays, structs and maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeforge.functions import nested as N
from lakeforge.plans.registry import query
from lakeforge.sources.tables import raw, typed, with_typed


def _words(spark, sf_dir):
    return raw(spark, sf_dir, "part").select("p_partkey", "p_name", N.words("p_name").alias("words"))


W = "string_split(p_name, ' ')"


@query("ar_01_split", oracle=f"SELECT p_partkey, array_to_string({W}, '|') AS words, "
                             f"CAST(len({W}) AS INTEGER) AS n_words FROM part")
def ar_01(spark, sf_dir):
    return _words(spark, sf_dir).select("p_partkey", F.array_join("words", "|").alias("words"),
                                        F.size("words").alias("n_words"))


@query("ar_02_explode_word_counts", oracle=f"SELECT word, count(*) AS count FROM "
                                           f"(SELECT unnest({W}) AS word FROM part) GROUP BY word")
def ar_02(spark, sf_dir):
    return N.word_counts(raw(spark, sf_dir, "part"), "p_name")


@query("ar_03_posexplode", oracle=f"SELECT p_partkey, CAST(generate_subscripts({W}, 1) - 1 AS INTEGER) AS pos, "
                                  f"unnest({W}) AS word FROM part")
def ar_03(spark, sf_dir):
    return _words(spark, sf_dir).select("p_partkey", F.posexplode("words").alias("pos", "word"))


# Parts of size 25 and below carry no word list (empty array), size 40 and
# above a NULL one, so both explode forms have something to differ on.
def _arr():
    return (F.when(F.col("p_size") <= 25, F.array().cast("array<string>"))
            .when(F.col("p_size") >= 40, F.lit(None).cast("array<string>"))
            .otherwise(N.words("p_name")))


@query("ar_04_explode_outer", oracle=f"""
SELECT p_partkey, unnest({W}) AS word FROM part WHERE p_size > 25 AND p_size < 40
UNION ALL SELECT p_partkey, NULL AS word FROM part WHERE p_size <= 25 OR p_size >= 40""")
def ar_04(spark, sf_dir):
    return raw(spark, sf_dir, "part").select("p_partkey", F.explode_outer(_arr()).alias("word"))


@query("ar_04_explode_inner", oracle=f"SELECT p_partkey, unnest({W}) AS word FROM part "
                                     f"WHERE p_size > 25 AND p_size < 40")
def ar_04b(spark, sf_dir):
    return raw(spark, sf_dir, "part").select("p_partkey", F.explode(_arr()).alias("word"))


@query("ar_05_size", oracle=f"SELECT p_partkey, CAST(len({W}) AS INTEGER) AS n_words FROM part")
def ar_05(spark, sf_dir):
    return _words(spark, sf_dir).select("p_partkey", F.size("words").alias("n_words"))


@query("ar_06_element_at", oracle=f"SELECT p_partkey, {W}[1] AS first_word, {W}[-1] AS last_word, "
                                  f"{W}[1] AS zero_based_first FROM part")
def ar_06(spark, sf_dir):
    at = {"first_word": F.element_at("words", 1), "last_word": F.element_at("words", -1), "zero_based_first": F.get("words", F.lit(0))}
    return _words(spark, sf_dir).select("p_partkey", *[c.alias(n) for n, c in at.items()])


@query("ar_07_array_contains", oracle=f"SELECT p_partkey, list_contains({W}, 'red') AS has_red FROM part")
def ar_07(spark, sf_dir):
    return _words(spark, sf_dir).select("p_partkey", F.array_contains("words", "red").alias("has_red"))


@query("ar_08_sort_array", oracle=f"SELECT p_partkey, array_to_string(list_sort({W}), ' ') AS sorted_words FROM part")
def ar_08(spark, sf_dir):
    return _words(spark, sf_dir).select("p_partkey", F.array_join(F.array_sort("words"), " ").alias("sorted_words"))


@query("ar_09_slice_join", oracle=f"SELECT p_partkey, array_to_string({W}[1:2], '-') AS first_two FROM part")
def ar_09(spark, sf_dir):
    return _words(spark, sf_dir).select("p_partkey", F.concat_ws("-", F.slice("words", 1, 2)).alias("first_two"))


@query("ar_10_arrays_zip", oracle=f"""
SELECT p_partkey, unnest({W}) AS word, unnest(string_split(upper(p_name), ' ')) AS word_upper FROM part""")
def ar_10(spark, sf_dir):
    zipped = F.arrays_zip(N.words("p_name").alias("word"), N.words(F.upper("p_name")).alias("word_upper"))
    return (raw(spark, sf_dir, "part").select("p_partkey", F.explode(zipped).alias("z"))
            .select("p_partkey", "z.word", "z.word_upper"))


@query("ar_11_explode_map", oracle="""
SELECT event_id, key, CAST(json_extract(props, '$."' || key || '"') AS INTEGER) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def ar_11(spark, sf_dir):
    return N.map_entries(raw(spark, sf_dir, "events"), "event_id", "props")


@query("ar_12_collect_back", oracle=f"""
SELECT p_partkey, array_to_string(list_sort(list(word)), ' ') AS word_list,
       array_to_string(list_sort(list(DISTINCT word)), ' ') AS word_set
FROM (SELECT p_partkey, unnest(list_concat({W}, {W})) AS word FROM part) GROUP BY p_partkey""")
def ar_12(spark, sf_dir):
    # Each name's words twice, so list (duplicates kept) and set differ.
    doubled = F.concat(N.words("p_name"), N.words("p_name"))
    exploded = raw(spark, sf_dir, "part").select("p_partkey", F.explode(doubled).alias("word"))
    return exploded.groupBy("p_partkey").agg(
        F.array_join(F.sort_array(F.collect_list("word")), " ").alias("word_list"),
        F.array_join(F.sort_array(F.collect_set("word")), " ").alias("word_set"))


@query("ar_13_last_word_counts", oracle=f"SELECT {W}[-1] AS last_word, count(*) AS count FROM part GROUP BY 1")
def ar_13(spark, sf_dir):
    return (raw(spark, sf_dir, "part").select(F.element_at(N.words("p_name"), -1).alias("last_word"))
            .groupBy("last_word").count())


@query("ar_13_distinct_words", oracle=f"SELECT count(DISTINCT word) AS distinct_words FROM "
                                      f"(SELECT unnest({W}) AS word FROM part)")
def ar_13b(spark, sf_dir):
    return (raw(spark, sf_dir, "part").select(F.explode(N.words("p_name")).alias("word"))
            .agg(F.count_distinct("word").alias("distinct_words")))


def _packed(spark, sf_dir):
    s = typed(spark, sf_dir, "supplier")
    return s.select("s_suppkey", "s_nationkey",
                    F.struct("s_name", "s_phone", F.col("s_acctbal").alias("balance")).alias("info"))


@query("sr_01_struct_pack", oracle=with_typed(
    "SELECT s_suppkey, CAST(to_json(struct_pack(s_name := s_name, s_phone := s_phone, balance := s_acctbal)) AS VARCHAR) AS info "
    "FROM t_supplier", "supplier"))
def sr_01(spark, sf_dir):
    return _packed(spark, sf_dir).select("s_suppkey", F.to_json("info").alias("info"))


@query("sr_02_dot_access", oracle=with_typed(
    "SELECT s_suppkey, s_name, s_acctbal AS balance FROM t_supplier", "supplier"))
def sr_02(spark, sf_dir):
    return _packed(spark, sf_dir).select("s_suppkey", "info.s_name", "info.balance")


@query("sr_03_flatten", oracle=with_typed(
    "SELECT s_suppkey, s_name, s_phone, s_acctbal AS balance FROM t_supplier", "supplier"))
def sr_03(spark, sf_dir):
    return _packed(spark, sf_dir).select("s_suppkey", "info.*")


@query("sr_04_nest_and_inline", oracle=with_typed(
    "SELECT s_nationkey, s_suppkey, s_name, s_phone, s_acctbal AS balance FROM t_supplier", "supplier"))
def sr_04(spark, sf_dir):
    flat = _packed(spark, sf_dir).select("s_nationkey", "s_suppkey", "info.*")
    nested = N.nest(flat, ["s_nationkey"], ["s_suppkey", "s_name", "s_phone", "balance"], "suppliers")
    return N.unnest(nested, ["s_nationkey"], "suppliers")


@query("sr_04_nest_null_group", oracle="""
SELECT CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey END AS g, count(*) AS items, count(DISTINCT s_name) AS names
FROM supplier GROUP BY 1""")
def sr_04_null(spark, sf_dir):
    """A third of the rows have no group; small chunks: nothing is lost."""
    flat = raw(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 3 != 0, F.col("s_nationkey")).alias("g"), "s_name")
    chunks = N.nest(flat, ["g"], ["s_name"], "items", max_items=3)
    return (chunks.select("g", F.inline("items")).groupBy("g")
            .agg(F.count(F.lit(1)).alias("items"), F.count_distinct("s_name").alias("names")))


@query("ag_12_collect_structs_size", oracle=
       "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey")
def ag_12(spark, sf_dir):
    flat = _packed(spark, sf_dir).select("s_nationkey", "s_suppkey", "info.*")
    nested = N.nest(flat, ["s_nationkey"], ["s_suppkey", "s_name", "s_phone", "balance"], "suppliers")
    return nested.groupBy("s_nationkey").agg(F.sum(F.size("suppliers")).cast("bigint").alias("n"))
