"""Personal data: regular expressions propose spans, checksums confirm them,
context words adjust their score. DataFrame functions only.

Kinds, in this order: email, ip, card, phone (the base kinds), iban, ssn.
Base spans are the leftmost non-overlapping matches of each kind that pass
their validator (parts up to 255, Luhn, numbers of digits); they always
count. An iban must pass mod-97 at its country's length, or for other
countries at the longest length that passes; its pattern is only the head
(country and check digits), so no word or account behind it is swallowed. An
ssn must use assigned numbers and, as a weak pattern, have a context word
nearby to reach the threshold.

Spark's functions give matches but no positions. The pieces of text between
the matches (``split`` by the same pattern) do: a match starts after all
earlier pieces and matches of its kind. These running sums are a window over
the row's matches, after one shuffle of matches without texts; the same window
joins pieces and matches to the text nearby. Patterns are
written so that they neither back-track nor recurse: possessive quantifiers,
and a start only where a run of the class starts or the last match ended.

Defined results: a null or empty text has no spans. Every row is judged by
itself, also rows that repeat an id. An empty table gives an empty result.
Extra columns do not matter. Positions count code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import quoted


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    base: bool
    #: Score of a confirmed match, and what a context word adds.
    score: float
    context: tuple[str, ...]
    gain: float = 0.3


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, 0.7, ("mail", "contact", "write")),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", True, 0.6, ("ip", "server", "host", "address")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", True, 0.7, ("card", "visa", "credit", "pay")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True, 0.6, ("phone", "tel", "call", "mobile", "fax")),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]{4}){2})", False, 0.7, ("iban", "bank", "account")),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, 0.3, ("ssn", "social", "security")),
)
#: Lengths of account numbers by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
#: Spans of the other kinds count from this score on.
THRESHOLD = 0.5
#: Code points before and behind a match that are searched for context words, across other matches.
NEARBY = 40
#: Code points kept from behind a match: an account number's tail has up to 38.
REACH = 80
#: Matches of the kind on a side that can lie in REACH (heads of account numbers, at least five apart) or NEARBY (the others, at least three).
PIECES = 20
IBAN = [kind.name for kind in KINDS].index("iban")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of 10."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def mod_97(account: Column) -> Column:
    """The remainder check of an IBAN: first four characters last, letters as 10 to 35."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 65, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column, tail: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        return F.forall(F.split(match, "\\."), lambda p: F.regexp_like(p, F.lit("^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$")))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return tail.isNotNull()
    if kind == "ssn":
        return F.regexp_like(match, F.lit("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"))
    return F.lit(True)


def _account_tail(head: Column, after: Column) -> Column:
    """What ``after`` has of the account number that starts with ``head``: the
    longest tail of the right length that passes mod-97, null if none does."""
    registered = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for code in codes.split() for x in (code, n)])
    right = F.try_element_at(registered, F.substring(head, 1, 2))

    def of(n: int) -> Column:
        groups, rest = divmod(n - 4, 4)
        last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        return F.regexp_extract(after, rf"^(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{last}(?![A-Za-z0-9])", 0)

    tails = F.filter(F.array(*[of(n) for n in range(34, 14, -1)]), lambda t, i: (t != "") & (F.coalesce(right, 34 - i) == 34 - i))
    return F.get(F.filter(tails, lambda t: mod_97(F.regexp_replace(F.concat(head, t), " ", ""))), F.lit(0))


def _by_kind(of) -> Column:
    out = F.lit(None)
    for k, kind in reversed(list(enumerate(KINDS))):
        out = F.when(F.col("k") == k, of(kind)).otherwise(out)
    return out


def _says(side: str, kind: Kind) -> Column:
    return F.regexp_like(F.lower(side), F.lit("|".join(kind.context)))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_<kind> for each kind, and ``found``: the
    spans (start, kind number, end, score) in order."""
    texts = docs.select(F.monotonically_increasing_id().alias("row_no"), quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    for k, kind in enumerate(KINDS):
        texts = texts.withColumn(f"m{k}", F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)))
    for k, kind in enumerate(KINDS):
        texts = texts.withColumn(f"g{k}", F.when(F.size(f"m{k}") > 0, F.split("text", kind.pattern, -1)))
    listed = [F.when(F.size(f"m{k}") > 0, _listed(k)) for k in range(len(KINDS))]
    empty = F.array().cast("array<struct<k:int,n:int,skipped:bigint,match:string,near:string,after:string>>")
    rows = (texts.select("row_no", "id", F.explode_outer(F.concat(*[F.coalesce(x, empty) for x in listed])).alias("x"))
            .select("row_no", "id", "x.*").repartition("row_no"))
    in_order = Window.partitionBy("row_no", "k").orderBy("n")
    size = F.length("match")
    rows = rows.withColumn("end", F.sum(F.col("skipped") + size).over(in_order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - size)
    behind = F.collect_list(F.concat(F.left("match", F.lit(REACH)), F.col("after"))).over(in_order.rowsBetween(1, PIECES))
    rows = rows.withColumn("after", F.left(F.concat(F.col("after"), F.concat_ws("", behind)), F.lit(REACH)))
    ahead = F.collect_list(F.concat(F.col("near"), F.right("match", F.lit(NEARBY)))).over(in_order.rowsBetween(-PIECES, -1))
    rows = rows.withColumn("before", F.right(F.concat(F.concat_ws("", ahead), F.col("near")), F.lit(NEARBY)))
    rows = rows.withColumn("tail", F.when(F.col("k") == IBAN, _account_tail(F.col("match"), F.col("after"))))
    rows = rows.withColumn("end", F.col("end") + F.coalesce(F.length("tail"), F.lit(0)))
    # the words of an account's own tail are no context
    rows = rows.withColumn("behind", F.substring(F.col("after"), F.coalesce(F.length("tail"), F.lit(0)) + 1, F.lit(NEARBY)))
    score = _by_kind(lambda kind: F.lit(kind.score) + F.when((_says("before", kind) | _says("behind", kind)), kind.gain).otherwise(0.0))
    rows = rows.withColumn("score", F.when(F.col("k").isNotNull() & _by_kind(lambda kind: _confirmed(kind.name, F.col("match"), F.col("tail"))), score))
    counts = F.col("score").isNotNull() & (_by_kind(lambda kind: F.lit(kind.base)) | (F.col("score") >= THRESHOLD))
    found = F.when(counts, F.struct("start", "k", "end", "score"))
    return (rows.groupBy("row_no", "id").agg(F.array_sort(F.collect_list(found)).alias("found")).withColumn("found", _accounts_apart(F.col("found")))
            .select("id", *[_number(k).alias(f"n_{kind.name}") for k, kind in enumerate(KINDS)], "found"))


def _accounts_apart(found: Column) -> Column:
    """Without accounts that start inside an earlier one."""
    none = F.struct(F.lit(0).cast("bigint").alias("reach"), F.filter(found, lambda s: F.lit(False)).alias("out"))
    step = lambda acc, s: F.when(s["start"] >= acc["reach"], F.struct(s["end"].cast("bigint").alias("reach"), F.concat(acc["out"], F.array(s)).alias("out"))).otherwise(acc)
    apart = F.aggregate(F.filter(found, lambda s: s["k"] == IBAN), none, step, lambda acc: acc["out"])
    return F.array_sort(F.concat(F.filter(found, lambda s: s["k"] != IBAN), apart))


def _number(k: int) -> Column:
    return F.size(F.filter("found", lambda s: s["k"] == k)).cast("bigint")


def _listed(k: int) -> Column:
    """Each match of a kind with its number, the length of the text skipped
    since the last match, the end of that text and the start of the text behind."""
    gap = lambda i: F.get(F.col(f"g{k}"), i)
    return F.transform(f"m{k}", lambda match, i: F.struct(
        F.lit(k).alias("k"), i.alias("n"), F.length(gap(i)).cast("bigint").alias("skipped"), match.alias("match"), F.right(gap(i), F.lit(NEARBY)).alias("near"),
        F.left(gap(i + 1), F.lit(REACH)).alias("after")))


def joined(found: Column, base_only: bool = False) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    if base_only:
        found = F.filter(found, lambda s: s["k"] < sum(kind.base for kind in KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")
