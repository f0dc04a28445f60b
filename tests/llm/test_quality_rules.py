"""Repetition counts against plain loops."""

import re
from collections import Counter

from lakeforge.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)

    def covered(n):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        hit = set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                hit |= set(range(i, i + n))
        return hit

    lines, seen, dup = text.split("\n"), set(), []
    for x in lines:
        if WORD.search(x):
            if x in seen:
                dup.append(x)
            seen.add(x)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_dup_lines": len(dup),
           "n_repeat_words": len(covered(8)), "dup_line_chars": sum(map(len, dup)), "n_chars_seen": len(text)}
    limits = Q.Limits()
    for n, _ in limits.grams:
        out[f"dup{n}_chars"] = sum(len(words[i]) for i in covered(n))
    out["base_failed"] = out["n_words"] < 20 or 100 * out["n_repeat_words"] > 30 * out["n_words"]
    out["kept"] = (not out["base_failed"] and out["dup_line_chars"] <= limits.lines * len(text)
                   and all(out[f"dup{n}_chars"] <= m * out["word_chars"] for n, m in limits.grams))
    return out


def check(df):
    texts = {}
    for r in df.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    for r in Q.measure(df).collect():
        got = r.asDict()
        got.pop("doc_id")
        assert any(got == plain(t) for t in texts[r["doc_id"]]), r


def test_odd_rows(odd, empty):
    check(odd)
    assert Q.measure(odd).count() == odd.count()
    kept = Q.keep_good(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in odd.collect() if plain(r["text"])["kept"])
    assert Q.measure(empty).count() == 0 and Q.keep_good(empty).count() == 0


def test_documents(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_repeats_fail_and_prose_stays(spark):
    prose = " ".join(f"word{i}" for i in range(200))
    rows = [(1, prose), (2, "\n".join(["the same line again and again in it"] * 30)), (3, prose + " " + " ".join(f"word{i}" for i in range(20)))]
    kept = Q.keep_good(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
