"""URL filter: host rules, and a list of canonical URLs behind a blocked Bloom filter.

Rules are few and given as text such as ``example.net/en/``: a rule fits its
host and all subdomains if the URL's path starts with the rule's path; the
longest rule wins. URLs that no rule fits are looked up in the list:

1. A register-blocked Bloom filter of the listed canonical URLs: each URL
   sets four bits of one 64-bit block. The blocks are OR-ed by one aggregate
   and broadcast. There are at most ``MAX_BLOCKS`` of them, however long the
   list is: a longer list lets more false positives through, never loses a hit.
2. URLs whose bits are all set go to an exact hash join with the list, which
   removes the false positives. All others are settled without a shuffle.

The host is the part after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; the path goes on to ``?``, ``#`` or the end. The
canonical form drops scheme, fragment, a leading ``www.`` or ``m.``, slashes
at the path's end, tracking parameters and empty ones, and sorts the rest.

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no rule and is never listed: it is allowed. Repeated rows get the
same verdict; null and repeated list entries do no harm. An empty table gives
an empty result, an empty list blocks nothing. Extra columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import fresh, quoted, save

#: 64-bit blocks of the filter: 4 MB of bits at most.
MAX_BLOCKS = 1 << 19
#: Bits for each listed URL, as long as MAX_BLOCKS allows.
BITS_PER_URL = 16
#: Query parameters that do not change the page.
TRACKING = ("utm_", "ref=", "fbclid=", "gclid=")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.coalesce(_rest(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.coalesce(_rest(url), F.lit(""))
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Null where the URL is null or has no ``://``."""
    query = F.regexp_extract(_rest(url), "^[^?#]*\\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~_tracking(p)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    plain = F.concat(F.regexp_replace(host_of(url), "^(www|m)\\.", ""), F.regexp_replace(path_of(url), "/+$", ""), tail)
    return F.when(F.instr(url, "://") > 0, plain)


def _tracking(param: Column) -> Column:
    hit = F.lit(False)
    for t in TRACKING:
        hit = hit | param.startswith(t)
    return hit


#: Two or more marks in a row that running text does not have.
MARKS = "[#*$%|!]{2,}"
_WORD = "[^\\x20\\x09-\\x0D]+"


def junk_page(html: Column, share: float = 0.1) -> Column:
    """Whether a page's text, without its tags, has runs of marks for at least
    ``share`` of its words. A null page is not junk, one without a word neither."""
    text = F.regexp_replace(html, "<[^>]*>", " ")
    words = F.regexp_count(text, F.lit(_WORD))
    return F.coalesce((words > 0) & (F.regexp_count(text, F.lit(MARKS)) >= F.lit(share) * words), F.lit(False))


def spam_host(host: Column, words: tuple[str, ...]) -> Column:
    """Whether a part of the host, between dots and hyphens, is one of ``words``."""
    return F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, words)))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Of rules of
    the same length the one given first wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _bits(url: Column) -> Column:
    """Four bits of a block, from a hash that the block's number does not use."""
    h = F.xxhash64(F.lit("bits"), url)
    one = F.lit(1).cast("bigint")
    out = F.lit(0).cast("bigint")
    for k in range(4):
        out = out.bitwiseOR(F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return out


def bloom_blocks(listed: DataFrame, col: str, blocks: int) -> DataFrame:
    """``(block, bits)`` of the filter: at most ``blocks`` rows."""
    return (listed.select(F.pmod(F.xxhash64(col), F.lit(blocks)).alias("block"), _bits(F.col(col)).alias("bits"))
            .groupBy("block").agg(F.bit_or("bits").alias("bits")))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", listed_col: str = "url",
          max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` with host, path, rule and verdict ('allow' or 'block');
    a URL that no rule fits is blocked if its canonical form is listed. Where
    ``pages`` has columns of these names, the new ones start with ``_``."""
    host, path, rule, verdict, canon, block, bits, entry = fresh(pages, "host", "path", "rule", "verdict", "canon", "block", "bits", "entry")
    found = listed.select(canonical(quoted(listed_col)).alias(entry))
    entries = save(found.where(F.col(entry).isNotNull()).distinct(), "listed")
    blocks = 1
    while blocks * 64 < entries.count() * BITS_PER_URL and blocks < max_blocks:
        blocks *= 2
    bloom = bloom_blocks(entries, entry, blocks).select(F.col("block").alias(block), F.col("bits").alias(bits))
    rows = pages.withColumn(host, host_of(quoted(url_col))).withColumn(path, path_of(quoted(url_col)))
    by_rule, said = rule_for(F.col(host), F.col(path), rules)
    rows = rows.withColumn(rule, by_rule).withColumn(verdict, said).withColumn(canon, F.when(said.isNull(), canonical(quoted(url_col))))
    rows = rows.withColumn(block, F.pmod(F.xxhash64(canon), F.lit(blocks))).join(F.broadcast(bloom), block, "left")
    mask = _bits(F.col(canon))
    possible = F.coalesce(F.col(canon).isNotNull() & (F.col(bits).bitwiseAND(mask) == mask), F.lit(False))
    out = [*[quoted(c) for c in pages.columns], F.col(host), F.col(path), F.col(rule)]
    clear = rows.where(~possible).select(*out, F.coalesce(verdict, F.lit("allow")).alias(verdict))
    hits = rows.where(possible).join(entries, F.col(canon) == F.col(entry), "left")
    hits = hits.select(*out, F.when(F.col(entry).isNotNull(), "block").otherwise("allow").alias(verdict))
    return clear.unionByName(hits)
