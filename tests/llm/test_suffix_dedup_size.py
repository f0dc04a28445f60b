"""op5 on larger inputs: what enters the merge, what counts as common, how many messages."""

import random

import numpy as np
import pyarrow as pa
from lakeforge.llm import suffix_dedup as S


def key(value):
    return (pa.scalar(value, pa.int32()),)


def documents(texts):
    return pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.binary())})


def letters(rng, n):
    return bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def judged(texts, monkeypatch, length=50):
    """Bytes that enter the merge, and the removed spans, of one block and one bucket."""
    entered = [0]
    holders = S.first_holders
    monkeypatch.setattr(S, "first_holders", lambda data, *a: entered.append(len(data)) or holders(data, *a))
    docs = documents(texts)
    asked = S._ask(length, 1)(key(0), docs)
    told = S._tell(10**6)(key(0), asked)
    gone = S._judge(length, 1 << 18)(key(0), S._send(length, 1, 1)(key(0), docs, told))
    read = lambda c: [x for b in gone.column(c).to_pylist() for x in np.frombuffer(b, "<u4").tolist()]
    return sum(entered), sorted(zip(read("rows"), read("starts"), read("ends")))


def test_shared_ranges_against_plain():
    rng = random.Random(1)
    for length in (3, 6):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 25))) for _ in range(12)]
        seen = [(s[p:p + length], n, p) for n, s in enumerate(strings) for p in range(len(s) - length + 1)]
        number = {}
        for w, _, _ in seen:
            number[w] = number.get(w, 0) + 1
        want = {(n, p) for w, n, p in seen if number[w] > 1}
        sizes = np.array([len(s) for s in strings])
        at = np.cumsum(sizes) - sizes
        own, start, end = S.shared_ranges(np.frombuffer(b"".join(strings), np.uint8), sizes, length)
        got = [(n, p) for n, a, z in zip(own.tolist(), start.tolist(), end.tolist()) for p in range(a - at[n], z - at[n] - length + 1)]
        assert sorted(got) == sorted(want)
        assert all((n, p - 1) not in want for n, p in zip(own.tolist(), (start - at[own]).tolist()))


def test_strings_that_share_a_k_gram_only_stay_out_of_the_merge(monkeypatch):
    rng = random.Random(2)
    gram = letters(rng, 30)
    texts = [letters(rng, 40) + gram + letters(rng, 40) for _ in range(200)]
    assert judged(texts, monkeypatch) == (0, [])


def test_only_the_shared_part_enters_the_merge(monkeypatch):
    rng = random.Random(3)
    passage = letters(rng, 60)
    texts = [letters(rng, 45) + passage + letters(rng, 45) for _ in range(3)]
    entered, spans = judged(texts, monkeypatch)
    covered = {(r, p) for r, a, z in spans for p in range(a, z)}
    assert covered == {(r, p) for r in (1, 2) for p in range(45, 105)}
    assert 0 < entered <= 3 * 11 * 50


def test_equal_segments_count_once_as_common():
    rng = random.Random(4)
    text = letters(rng, 400)
    seen = [x & 127 for b in S._ask(50, 1)(key(0), documents([text] * 20)).column("seen").to_pylist() for x in b]
    assert seen and set(seen) == {1}
    gram = letters(rng, 49)
    other = S._ask(50, 1)(key(0), documents([letters(rng, 20) + gram + letters(rng, 20) for _ in range(20)]))
    assert max(x & 127 for b in other.column("seen").to_pylist() for x in b) > 1


def test_message_is_cut_from_the_right_places():
    cut = S._cut_up(np.arange(5, dtype="<u4"), np.array([0, 2, 2, 5]))
    assert [np.frombuffer(x, "<u4").tolist() for x in cut.to_pylist()] == [[0, 1], [], [2, 3, 4]]


def test_messages_grow_slower_than_the_square():
    blocks = lambda size: -(-size // S.sizes_for(size)[0])
    assert blocks(864 << 20) == 144
    assert blocks(10 << 30) < 1000
    assert S.sizes_for(864 << 20)[1] == 4096 and S.sizes_for(10 << 30)[1] == 16384
