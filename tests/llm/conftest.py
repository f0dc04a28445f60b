import pytest

WORDS = "ala bela cada dena efo fago gula hama ilo jara kedo luma".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls in any column, empty and very long texts, repeated
    rows, ties and extra columns with names that operators use themselves."""
    import random
    rng = random.Random(5)
    long = prose(rng, 30_000)
    text = prose(rng, 60)
    rows = [(1, text, "a"), (2, text.upper(), "a"), (2, text.upper(), "a"), (3, text + " end", None), (None, text, "b"), (None, text, "b"),
            (4, None, "a"), (5, "", None), (None, None, None), (6, long, "b"), (7, long, "b"), (8, " \n\t ", "c"), (9, "\n".join([text] * 9), "c"),
            (10, prose(rng, 200), "a"), (11, "é" * 70 + " ñandú " + text, "c"), (12, "x" * 5000, "a")]
    schema = "doc_id bigint, text string, source string, digest string, key int, id string, size double, row_no int, fp string, kept boolean, body string, host int"
    return spark.createDataFrame([(i, t, s, "d", 1, None, 2.5, None, "f", None, "body", None) for i, t, s in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
