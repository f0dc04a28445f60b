"""Spans against plain regular expressions and checksums."""

import random
import re

from lakeforge.llm import pii as P

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def fine(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits),
            "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if fine(kind, m.group()))


PARTS = ["a@b.c", "a@b.cc_d@e.f", "x%y+z@host-1.example.org.", "@a.b", "a@b", "a@b.c@d.e", "1.2.3.4", "1.2.3", "256.1.1.1", "000255.0.0.1", "1.2.3.4.5.6.7.8", "1..2.3.4.5", "4111 1111 1111 1111",
         "4111-1111-1111-1112", "5500 0000 0000 0004 ", "378282246310005", "+1 (555) 010-9999", "+49 30 1234567", "++12345678", "+1234567890123456", "7", " 12 ", "é", "\n", "ñandú ", ".", "-", "+", "123-45-6789",
         "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "GB82WEST12345698765433", "ssn 123-45-6789", "@", "99999999999999999999999"]


def check(spark, rows):
    texts = dict(rows)
    got = P.spans(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = [(s["start"], s["k"], s["end"]) for s in r["found"]]
        assert spans == sorted(spans)
        assert [s for s in spans if s[1] < 4] == base(texts[r["id"]]), texts[r["id"]]
        for k, kind in enumerate(P.KINDS):
            assert r[f"n_{kind.name}"] == sum(s[1] == k for s in spans)


def test_against_plain(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(PARTS) + rng.choice(["", " ", ", "]) for _ in range(rng.randint(0, 12)))) for i in range(400)]
    check(spark, rows + [(1000, None), (1001, ""), (1002, "word " * 2_000)])


def test_very_long_runs(spark):
    """No recursion and no quadratic time on runs of one class."""
    rows = [(0, "1" * 300_000), (1, "1 " * 100_000), (2, "a." * 150_000), (3, "a" * 300_000 + "@b" + ".c" * 50_000), (4, "1." * 20_000), (5, "+1" + "(" * 200_000),
            (6, "a@b.c " * 3_000)]
    got = {r["id"]: [(s["start"], s["k"], s["end"]) for s in r["found"]] for r in P.spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i] for i in (0, 1, 2, 5)] == [[]] * 4
    assert got[3] == [(0, 0, 400_002)]
    assert got[4] == [(8 * i, 1, 8 * i + 7) for i in range(5_000)]
    assert got[6] == [(6 * i, 0, 6 * i + 5) for i in range(3_000)]


def test_added_kinds_and_context(spark):
    rows = [(0, "pay to IBAN DE89 3704 0044 0532 0130 00 AND go"), (1, "GB82WEST12345698765433"), (2, "number 123-45-6789"), (3, "my SSN is 123-45-6789"),
            (4, "ssn 000-45-6789"), (5, "write to a@b.c"), (6, "see a@b.c")]
    got = {r["id"]: r for r in P.spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i]["n_iban"] for i in range(5)] == [1, 0, 0, 0, 0]
    assert (got[0]["found"][0]["start"], got[0]["found"][0]["end"]) == (12, 39)
    assert [got[i]["n_ssn"] for i in range(5)] == [0, 0, 0, 1, 0]
    assert got[5]["found"][0]["score"] > got[6]["found"][0]["score"]


def test_account_numbers_before_words_and_accounts(spark):
    """A capitalised word, a code or the next account behind or before a number does not swallow it."""
    want = {"AT611904300234573201": " EUR 500", "ES9121000418450200051332": " BIC ABC", "BE68539007547034": " IBAN", "BE68 5390 0754 7034": " USD", "NO9386011117947": " NOK",
            "DE89 3704 0044 0532 0130 00": " AB12 3456", "MT84MALT011000012345MTLCAST001S": " 2024", "GB82 WEST 1234 5698 7654 32": "", "AT61 1904 3002 3457 3201": " BE68 5390 0754 7034"}
    texts = [f"é {a}{behind}" for a, behind in want.items()] + [f"é {a}" for a in want] + [f"AB12 3456 {a}" for a in want] + [" ".join(want), "AT61 1904 3002 3457 3202 EUR", "DE68 5390 0754 7034"]
    got = {r["id"]: [(s["start"], s["end"]) for s in r["found"] if s["k"] == 4] for r in P.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, text in enumerate(texts[:-2]):
        assert got[i] == sorted((m.start(), m.end()) for a in want for m in re.finditer(rf"(?<![A-Z0-9]){a}(?![A-Z0-9])", text)), text
    assert got[len(texts) - 2] == got[len(texts) - 1] == []


def test_context_across_matches_and_behind(spark):
    """Context words within 40 code points count on either side, whatever matches lie between."""
    check = 98 - int("".join(str(int(c, 36)) for c in "BANK0417164300NL00")) % 97
    three = "123-45-6789, 234-56-7890, 345-67-8901"
    rows = [(0, "SSN: " + three), (1, "SSN 000-45-6789, 123-45-6789"), (2, "123-45-6789 (SSN)"), (3, three + " ssn"), (4, three), (5, "ssn" + "." * 38 + "123-45-6789"),
            (6, "ssn" + "." * 37 + "123-45-6789"), (7, "123-45-6789" + "." * 38 + "ssn"), (8, "123-45-6789" + "." * 37 + "ssn"), (9, "card 12 13 14  4111 1111 1111 1111"),
            (10, f"NL{check:02}BANK0417164300 x")]
    got = {r["id"]: r for r in P.spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i]["n_ssn"] for i in range(9)] == [3, 1, 1, 3, 0, 0, 1, 0, 1]
    assert got[9]["found"][0]["score"] == 1.0
    assert got[10]["found"][0]["score"] == 0.7


def test_odd_rows(odd, empty):
    assert P.spans(odd).count() == odd.count()
    assert P.spans(empty).count() == 0


def test_no_python_in_the_plan(odd):
    plan = P.spans(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
