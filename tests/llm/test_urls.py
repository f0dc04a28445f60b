"""URL parts, rules and list look-ups against plain Python."""

import random
import re

import pytest
from lakeforge.llm import urls as U
from lakeforge.llm.queries import SPAM_WORDS, op3_url_filter
from pyspark.sql import functions as F

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    query = re.match(r"[^?#]*\?([^#]*)", rest)
    kept = sorted(p for p in (query.group(1).split("&") if query else []) if p and not p.startswith(U.TRACKING))
    return host, path, re.sub(r"^(www|m)\.", "", host) + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def judged(url, listed):
    host, path, canon = parts(url)
    fits = [(r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    if fits:
        rule, verdict = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, verdict
    return host, path, None, "block" if canon is not None and canon in listed else "allow"


URLS = ["http://a.net/x", "http://NET", "http://net/", "https://x.Example.NET/en/1?q=2", "http://example.net/english", "http://example.com/de", "http://example.com/de/",
        "ftp://m.site.org/fr/1#t", "http://site.org/fr", "nothing", "", None, "://", "http://www.bad.com/p/?utm_source=1&b=2&a=1#f", "http://bad.com/p?a=1&b=2", "http://m.bad.com/p//?&ref=9&b=2&a=1",
        "http://BAD.com/P", "http://badnet/", "http://u@bad.com:80/p", "HTTP://a?b://c/d"]


@pytest.mark.parametrize("max_blocks", [1, 4, U.MAX_BLOCKS])
def test_against_plain(spark, max_blocks):
    rng = random.Random(6)
    many = [f"http://h{rng.randrange(30)}.com/p{rng.randrange(60)}" for _ in range(800)]
    pages = spark.createDataFrame(list(enumerate(URLS * 2 + many)), "page_id bigint, url string").withColumns(
        {c: F.lit(1) for c in ("host", "rule", "entry", "bits")}).repartition(5)
    listed_urls = ["https://bad.com/p/?b=2&a=1", None, "bad", "http://a.net/x", "http://a.net/x"] + many[:200]
    listed = {parts(u)[2] for u in listed_urls} - {None}
    got = U.judge(pages, spark.createDataFrame([(u,) for u in listed_urls], "url string"), RULES, max_blocks=max_blocks)
    assert got.columns == [*pages.columns, "_host", "path", "_rule", "verdict"]
    rows = got.select("page_id", "_host", "path", "_rule", "verdict").collect()
    assert len(rows) == pages.count()
    urls = URLS * 2 + many
    for r in rows:
        assert tuple(r)[1:] == judged(urls[r["page_id"]], listed), urls[r["page_id"]]


def test_filter_lets_few_through(spark):
    listed = spark.range(2000).select(F.concat(F.lit("l"), "id").alias("u"))
    bloom = U.bloom_blocks(listed, "u", 512)
    others = spark.range(20000).select(F.concat(F.lit("o"), "id").alias("u"))
    look = lambda df: df.withColumn("block", F.pmod(F.xxhash64("u"), F.lit(512))).join(bloom, "block").where(F.col("bits").bitwiseAND(U._bits(F.col("u"))) == U._bits(F.col("u"))).count()
    assert look(listed) == 2000
    assert look(others) < 0.06 * 20000


def test_empty(spark):
    none = spark.createDataFrame([], "url string")
    some = spark.createDataFrame([("http://bad.com/",), (None,)], "url string")
    assert U.judge(none, some, RULES).count() == 0
    assert [r["verdict"] for r in U.judge(some, none, RULES).collect()] == ["allow", "allow"]


def junk(html):
    if html is None:
        return False
    text = re.sub("<[^>]*>", " ", html)
    words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
    return words > 0 and len(re.findall(r"[#*$%|!]{2,}", text)) >= 0.1 * words


def test_query_lists_by_page_text_and_host_words(spark, tmp_path):
    """Variants of a listed URL are blocked though their own text is clean and
    no host word gives them away; rules still win."""
    bad, good = "<p>buy*** now!!! at*** once</p>", "<b>plain words of a page ## here and so on and on and on</b>"
    pages = [("http://www.shop.org/a/?utm_source=x", bad), ("https://shop.org/a", good), ("https://m.shop.org/a/#top", None), ("https://shop.org/b", good),
             ("http://blog.casino-win.com/x", good), ("http://casinos.com/x", good), ("http://shop.net/c", bad), ("https://x.example.net/en/1", bad), ("https://x.example.net/en/1/", good),
             (None, bad), ("no url", bad), ("http://empty.org/", "<p></p>"), ("http://empty.org/null", None), ("http://shop.org/a?page=2", good)]
    rows = [(i, u, h) for i, (u, h) in enumerate(pages * 2)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    words = set(SPAM_WORDS)
    listed = {parts(u)[2] for u, h in pages if junk(h) or words & set(re.split("[.-]", parts(u)[0]))} - {None}
    got = {r.page_id: tuple(r)[1:] for r in op3_url_filter(spark, str(tmp_path)).collect()}
    assert got == {i: judged(u, listed) for i, u, _ in rows}
    verdicts = [got[i][3] for i in range(len(pages))]
    assert verdicts == ["block", "block", "block", "allow", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow", "allow"]


def test_filter_and_join_both_decide(spark, monkeypatch):
    """With a filter that lets nothing through no listed URL is blocked; with
    one block full of bits all goes to the join, which still tells apart; and
    without the join's check false hits would be blocked."""
    listed = [f"http://bad{i}.com/p" for i in range(300)]
    urls = [f"https://www.bad{i}.com/p/" for i in range(0, 600)]
    pages, entries = spark.createDataFrame([(u,) for u in urls], "url string"), spark.createDataFrame([(u,) for u in listed], "url string")
    blocked = lambda **how: {r.url for r in U.judge(pages, entries, [], **how).where("verdict = 'block'").collect()}
    right = set(urls[:300])
    assert blocked() == right and blocked(max_blocks=1) == right
    full = U.bloom_blocks(entries.select(U.canonical(F.col("url")).alias("u")), "u", 1).first()["bits"]
    false_hits = pages.withColumn("m", U._bits(U.canonical(F.col("url")))).where((F.lit(full).bitwiseAND(F.col("m")) == F.col("m")) & ~F.col("url").isin(*right)).count()
    assert false_hits > 0                                        # the join removes these
    monkeypatch.setattr(U, "bloom_blocks", lambda df, col, blocks: spark.createDataFrame([], "block bigint, bits bigint"))
    assert blocked() == set()                                    # and the filter is what lets the others reach it
