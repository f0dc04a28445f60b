"""Removal of passages that repeat across documents, by merged
Burrows-Wheeler transforms.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller id is removed. Texts are UTF-8 bytes, matches never cross
documents, overlaps count, and strings are judged on the input.

Dealing the text out. Equal windows of ``length`` bytes must meet in one task
without sending the text everywhere. The smallest hash among a window's
k-grams depends on the window's bytes alone, so windows are dealt by it;
neighbouring windows mostly share it, and such a run of windows travels as
one segment. Documents are gathered in blocks of about ``block_bytes``:

1. Each block sends the different hashes of its runs to buckets, six bytes
   each. A bucket answers which hashes other documents have too. Windows
   under other hashes occur nowhere else.
2. Each block sends the segments of shared hashes to buckets, equal segments
   once. Under a hash with more than ``hot`` segments that differ within
   their block (a passage that very many documents have, in ever other
   surroundings) every window is dealt by its own bytes instead, so that no
   bucket holds all of them.
3. A bucket collapses equal segments. Segments that share their hash with no
   other one need no more. Most of the rest only have a k-gram in common:
   parts none of whose windows has the hash of another window are left out.
   Of what is left, some hashes at a time, it cuts shards, sorts each shard's
   rotations to get its Burrows-Wheeler transform, and merges all transforms
   by refining their interleave: starting from the shards one after the
   other, each round sorts the interleave stably by the rows' preceding
   symbols, which makes it correct for one more symbol. Rows that a round
   parts from all others are settled: the rounds so far are the longest
   prefix they share. The intervals left after ``length`` rounds are the
   repeated strings, and the smallest id in an interval says who has it
   first. Suffixes are never sorted across shards.
4. The answers, removed spans, go back to the blocks.

The documents' shuffle by block is one exchange that the three steps reuse.

Defined results: a null or empty text loses nothing. A null id counts as
larger than all others. Rows that repeat an id are not smaller than each
other. Ids are integers. An empty table gives an empty result. Extra columns
do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import _grown, _mixed, flat, prefix_sums, quoted, range_hashes, steps, utf8

#: Bytes of the k-grams whose smallest hash a window is dealt by.
GRAM = 20
#: Longest run of windows in one segment.
LONGEST_RUN = 64
_LAST = np.iinfo(np.int64).max


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ids of a block's documents, always in the same order."""
    ids = [_LAST if v is None else v for v in table.column("id").to_pylist()]
    texts = table.column("text").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    off = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(texts[i]) for i in order], out=off[1:])
    return np.frombuffer(b"".join(texts[i] for i in order), np.uint8), off, np.array([ids[i] for i in order], np.int64)


def _runs_of(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First window, window after the last, and hash of each run of windows
    with the same smallest k-gram hash; the hash of the run's bytes."""
    n, k = len(data), min(GRAM, length)
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    sums = prefix_sums(data)
    least = (sums[k:] - sums[:-k]) * _grown(n)[1][:n - k + 1]
    least = (least ^ (least >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    least ^= least >> np.uint64(32)
    need, width = length - k + 1, 1              # k-grams of a window; those least looks at so far
    while width < need:
        step = min(width, need - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    # windows that reach into the next document
    turn = np.bincount(np.maximum(off[:-1], off[1:] - length + 1), minlength=n + 1)[:n + 1] - np.bincount(off[1:], minlength=n + 1)[:n + 1]
    inside = np.cumsum(turn[:n])[:len(least)] == 0
    first = inside.copy()
    first[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(first)
    last = inside
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    parts = -(-(ends - starts) // LONGEST_RUN)
    if len(parts) and parts.max() > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + nth * LONGEST_RUN
        ends = np.minimum(np.repeat(ends, parts), starts + LONGEST_RUN)
    return starts, ends, least[starts], range_hashes(sums, starts, ends + length - 1)


def _runs(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    found = []
    for i, j in steps(off):
        s, e, h, c = _runs_of(data[off[i]:off[j]], off[i:j + 1] - off[i], length)
        found.append((s + off[i], e + off[i], h, c))
    if not found:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*found))


def _dealt(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(hashes) % np.uint64(buckets)).astype(np.int64)


def _cut_up(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary column whose rows are the bytes of ``values`` between neighbouring cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _cuts(parts: list[tuple[int, int, int]]) -> np.ndarray:
    return np.array([0, *[z for _, _, z in parts]], np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Stable order by bucket, and (bucket, from, to) of each one in it."""
    few = not len(bucket) or bucket.max() < 1 << 16   # 16-bit numbers are sorted by their digits
    order = np.argsort(bucket.astype(np.uint16) if few else bucket, kind="stable")
    at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return order, [(int(bucket[order[a]]), int(a), int(b)) for a, b in zip(at, [*at[1:], len(order)])]


# --- step 1: which hashes do other documents have too ----------------------
_ASK = "bucket int, block int, hashes binary, seen binary"
_TOLD = "block int, bucket int, told binary"


def _different(data, off, length, buckets):
    """Different hashes of a block's runs, dealt to buckets."""
    starts, ends, h, content = _runs(data, off, length)
    row = np.searchsorted(off, starts, "right") - 1
    different, which = np.unique(h, return_inverse=True)
    order, parts = _by_bucket(_dealt(different, buckets))
    return starts, ends, row, content, different, which, order, parts


def _ordered(which: np.ndarray, content: np.ndarray) -> np.ndarray:
    """The number of a hash before half of the content's hash, to sort segments by."""
    return (which.astype(np.uint64) << np.uint64(32)) | (content >> np.uint64(32))


def _ask(length: int, buckets: int):
    def run(key, table):
        block = key[0].as_py()
        data, off, ids = _gathered(table)
        _, _, row, content, different, which, order, parts = _different(data, off, length, buckets)
        doc = ids[row]
        low, high = np.full(len(different), _LAST), np.full(len(different), np.iinfo(np.int64).min)
        np.minimum.at(low, which, doc)
        np.maximum.at(high, which, doc)
        # up to 127 different segments, and whether two documents of this block have the hash
        number = np.bincount(which, minlength=len(different))
        again = number[which] > 1
        number[number > 1] = 0
        number += np.bincount((np.unique(_ordered(which[again], content[again])) >> np.uint64(32)).astype(np.int64), minlength=len(different))
        seen = (np.minimum(number, 127) + 128 * (low < high)).astype(np.uint8)
        six = different.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        cuts = _cuts(parts)
        return pa.table({"bucket": pa.array([b for b, _, _ in parts], pa.int32()), "block": pa.array([block] * len(parts), pa.int32()),
                         "hashes": _cut_up(six[order].ravel(), 6 * cuts), "seen": _cut_up(seen[order], cuts)})
    return run


def _tell(hot: int):
    """For each hash asked about: 0 nobody else has it, 1 others have, 2 very many have."""
    def run(key, table):
        seen, cuts = flat(table.column("seen"))
        six = flat(table.column("hashes"))[0].reshape(-1, 6)
        eight = np.zeros((len(six), 8), np.uint8)
        eight[:, :6] = six
        _, which = np.unique(eight.view("<u8").ravel(), return_inverse=True)
        blocks = np.bincount(which)
        total = np.bincount(which, seen & 127)
        within = np.bincount(which, seen >> 7) > 0
        told = np.where((blocks > 1) | within, np.where(total > hot, 2, 1), 0).astype(np.uint8)[which]
        return pa.table({"block": table.column("block"), "bucket": pa.array([key[0].as_py()] * table.num_rows, pa.int32()),
                         "told": _cut_up(told, cuts)})
    return run


# --- step 2: segments of shared hashes to buckets ---------------------------
_SEND = ("bucket int, block int, bytes binary, sizes binary, tags binary, least binary, places binary, leasts binary, rows binary, starts binary")
_GONE = "block int, rows binary, starts binary, ends binary"


def _send(length: int, buckets: int, segment_buckets: int):
    names = [c.split()[0] for c in _SEND.split(", ")]

    def run(key, table, answers):
        block = key[0].as_py()
        data, off, ids = _gathered(table)
        starts, ends, row, content, different, which, order, parts = _different(data, off, length, buckets)
        told = np.zeros(len(different), np.uint8)
        told_by = dict(zip(answers.column("bucket").to_pylist(), answers.column("told").to_pylist()))
        for b, a, z in parts:
            told[order[a:z]] = np.frombuffer(told_by[b], np.uint8)
        state = told[which]
        if not state.any():
            return pa.table([pa.array([], pa.int32() if c in ("bucket", "block") else pa.binary()) for c in names], names)
        one, many = state == 1, state == 2
        # under very common hashes every window is a segment of its own
        n = (ends - starts)[many]
        single, single_row = _ranges(starts[many], n), np.repeat(row[many], n)
        s = np.concatenate((starts[one], single))
        e = np.concatenate((ends[one], single + 1)) + length - 1
        r = np.concatenate((row[one], single_row))
        alone = np.zeros(len(single), np.uint64)
        for i, j in steps(off) if len(single) else ():
            pick = slice(*np.searchsorted(single_row, [i, j]))
            alone[pick] = range_hashes(prefix_sums(data[off[i]:off[j]]), single[pick] - off[i], single[pick] - off[i] + length)
        content, key_hash = np.concatenate((content[one], alone)), np.concatenate((different[which[one]], alone))
        # equal segments once; their smallest document, and all their places, its own first
        # (of either kind they are in the order of the documents, which the sort keeps)
        doc = ids[r]
        ordered = np.concatenate((_ordered(which[one], content[:one.sum()]), (alone >> np.uint64(1)) | np.uint64(1 << 63)))
        by = np.argsort(ordered, kind="stable")
        same = np.ones(len(by), bool)
        same[1:] = (ordered[by[1:]] != ordered[by[:-1]]) | (content[by[1:]] != content[by[:-1]]) | ((e - s)[by[1:]] != (e - s)[by[:-1]])
        lead = np.flatnonzero(same)
        group = np.cumsum(same) - 1
        least = doc[by[lead]]
        count = np.diff([*lead, len(by)])
        of_least = np.bincount(group, doc[by] == least[group]).astype(np.int64)
        deal, deals = _by_bucket(_dealt(_mixed(key_hash[by[lead]] + np.uint64(1)), segment_buckets))
        cuts = _cuts(deals)
        seg, count = by[lead[deal]], count[deal]
        place = by[_ranges(lead[deal], count)]
        place_cuts = np.concatenate(([0], np.cumsum(count)))[cuts]
        raw, pack = data.tobytes(), zstandard.ZstdCompressor(level=1)
        from_, to = s[seg], e[seg]
        joined = [pack.compress(b"".join([raw[x:y] for x, y in zip(from_[a:z].tolist(), to[a:z].tolist())])) for _, a, z in deals]
        return pa.table([pa.array([b for b, _, _ in deals], pa.int32()), pa.array([block] * len(deals), pa.int32()), pa.array(joined, pa.binary()),
                         _cut_up((to - from_).astype("<u4"), cuts), _cut_up((key_hash[seg] >> np.uint64(16)).astype("<u4"), cuts),
                         _cut_up(least[deal].astype("<i8"), cuts), _cut_up(count.astype("<u4"), cuts), _cut_up(of_least[deal].astype("<u4"), cuts),
                         _cut_up(r[place].astype("<u4"), place_cuts), _cut_up((s - off[r])[place].astype("<u4"), place_cuts)], names)
    return run


# --- step 3: shards, their transforms, the merge ----------------------------
def shard_transform(symbols: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of strings that each end in the symbol 0:
    the rotations' starts in order, the symbols before them, and for each row
    the row of the rotation one symbol longer to the left. Rotations are
    sorted by at least ``depth`` symbols."""
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    place = np.arange(len(symbols)) - base

    def later(t: int) -> np.ndarray:
        return base + (place + t) % size

    key = np.zeros(len(symbols), np.uint64)
    for t in range(7):
        key = (key << np.uint64(9)) | symbols[later(t)].astype(np.uint64)
    known = 7
    while True:
        order = np.argsort(key, kind="stable")
        if known >= depth:
            break
        ranked = key[order]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1]))).astype(np.uint64)
        key = (rank << np.uint64(32)) | rank[later(known)]
        known *= 2
    before = symbols[(base + (place - 1) % size)[order]]
    left = np.empty(len(order), np.int64)
    left[np.argsort(before, kind="stable")] = np.arange(len(order))
    return order, before, left


def merge(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated intervals of the shards' interleaved rows: the rows that
    share their first ``rounds`` symbols with another row, in order, and
    where an interval begins among them; and for every row the length of the
    prefix that it shares with another (at most ``rounds``). Rows are
    numbered through the shards one after the other.

    Each round sorts the interleave stably by the rows' preceding symbols
    and steps to the rotations one symbol longer. A row alone in its interval
    is settled, and so is the longer rotation it leads to, so it leaves."""
    base = np.cumsum([0, *[len(s[0]) for s in shards]])
    before = np.concatenate([s[1] for s in shards])
    left = np.concatenate([s[2] + b for s, b in zip(shards, base)])
    interleave = np.arange(len(before))
    common = np.zeros(len(before), np.int16)
    edge = np.zeros(len(before), bool)
    edge[:1] = True
    for r in range(rounds):
        symbol = before[interleave]
        order = np.argsort(symbol, kind="stable")
        interval = np.cumsum(edge, dtype=np.int32)[order]
        symbol = symbol[order]
        edge = np.ones(len(order), bool)
        edge[1:] = (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])
        shared = ~edge
        shared[:-1] |= ~edge[1:]
        interleave, edge = left[interleave[order[shared]]], edge[shared]
        common[interleave] = r + 1
        if not len(interleave):
            break
    return interleave, edge, common


def first_holders(data: np.ndarray, sizes: np.ndarray, least: np.ndarray, length: int, shard_bytes: int) -> np.ndarray:
    """For each byte of the strings in ``data`` at which ``length`` bytes of
    its string start, the smallest of ``least`` among the strings that hold
    these bytes."""
    m = len(sizes)
    ends = np.cumsum(sizes)
    # UTF-8 has no byte above 244, so one more for the strings' ends fits a byte
    symbols = np.zeros(len(data) + m, np.uint8)
    own = np.repeat(np.arange(m), sizes)
    symbols[np.arange(len(data)) + own] = data + 1
    padded = sizes + 1
    shards, starts_of = [], []
    cuts = np.flatnonzero(np.diff((ends - 1) // shard_bytes, prepend=-1))
    at = np.concatenate(([0], np.cumsum(padded)))
    for a, z in zip(cuts, [*cuts[1:], m]):
        shards.append(shard_transform(symbols[at[a]:at[z]], padded[a:z], length))
        starts_of.append(shards[-1][0] + at[a])
    interleave, edge, _ = merge(shards, length)
    string = np.repeat(np.arange(m), padded)
    out = least[string]
    if len(interleave):
        start = np.concatenate(starts_of)[interleave]
        first = np.flatnonzero(edge)
        out[start] = np.repeat(np.minimum.reduceat(out[start], first), np.diff([*first, len(start)]))
    return out[np.arange(len(data)) + own]


def shared_ranges(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, start and end of each part of the strings in ``data`` whose
    windows of ``length`` bytes all have a hash that another window has too,
    as long as can be. No window that occurs twice lies outside of them."""
    ends = np.cumsum(sizes)
    windows = np.maximum(sizes - length + 1, 0)
    own = np.repeat(np.arange(len(sizes)), windows)
    at = _ranges(ends - sizes, windows)
    h = range_hashes(prefix_sums(data), at, at + length)
    by = np.argsort(h)
    equal = h[by[1:]] == h[by[:-1]]
    shared = np.zeros(len(h), bool)
    shared[by[1:]] |= equal
    shared[by[:-1]] |= equal
    own, at = own[shared], at[shared]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1])
    return own[new], at[new], at[np.append(new[1:], np.ones(min(len(at), 1), bool))] + length


def _apart(group: np.ndarray, size: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of neighbouring strings of about ``limit`` bytes that part no group."""
    if not len(group):
        return []
    first = np.flatnonzero(np.diff(group, prepend=-1))
    part = (np.cumsum(size) - size)[first] // limit
    cuts = first[np.flatnonzero(np.diff(part, prepend=-1))]
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(group)]))


def _judge(length: int, shard_bytes: int):
    def run(key, table):
        read = lambda c, t: flat(table.column(c))[0].view(t)
        sizes, tags, least = read("sizes", "<u4").astype(np.int64), read("tags", "<u4"), read("least", "<i8")
        places, leasts = read("places", "<u4").astype(np.int64), read("leasts", "<u4").astype(np.int64)
        unpack = zstandard.ZstdDecompressor()
        raw = b"".join(map(unpack.decompress, table.column("bytes").to_pylist()))
        # equal segments of different blocks
        cuts = np.concatenate(([0], np.cumsum(sizes)))
        numbered = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
        same, strings = numbered.indices.to_numpy().astype(np.int64), numbered.dictionary
        del raw, numbered
        lowest = np.full(len(strings), _LAST)
        np.minimum.at(lowest, same, least)
        tag = np.zeros(len(strings), np.uint32)
        tag[same] = tags
        # those that share their hash with another one go to the merge
        _, which, n = np.unique(tag, return_inverse=True, return_counts=True)
        others = np.flatnonzero(n[which] > 1)
        others = others[np.argsort(which[others], kind="stable")]
        size = pc.binary_length(strings).to_numpy()[others]
        found = [(np.zeros(0, np.int64),) * 3]
        for i, j in _apart(which[others], size, 4 * shard_bytes):
            data = np.frombuffer(b"".join(strings.take(pa.array(others[i:j])).to_pylist()), np.uint8)
            own, start, end = shared_ranges(data, size[i:j], length)
            if not len(own):
                continue
            ranges = end - start
            holder = first_holders(data[_ranges(start, ranges)], ranges, lowest[others[i:j]][own], length, shard_bytes)
            of = np.repeat(np.arange(len(own)), ranges)
            place = _ranges(np.zeros(len(own), np.int64), ranges)
            taken = (place <= ranges[of] - length) & (holder < lowest[others[i:j]][own[of]])
            new = np.concatenate(([True], of[1:] != of[:-1]))
            a = np.flatnonzero(taken & (new | ~np.concatenate(([False], taken[:-1]))))
            z = np.flatnonzero(taken & (np.append(new[1:], True) | ~np.append(taken[1:], False)))
            first = start - (np.cumsum(size[i:j]) - size[i:j])[own]
            found.append((others[i:j][own[of[a]]], first[of[a]] + place[a], first[of[a]] + place[z] + length))
        run_of, run_from, run_to = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(run_of, kind="stable")
        run_of, run_from, run_to = run_of[by], run_from[by], run_to[by]
        # places of each segment: all of it goes, but in its first document only what others have before
        first = _ranges(np.zeros(len(places), np.int64), places) < np.repeat(leasts, places)
        seg = np.repeat(np.arange(len(sizes)), places)
        rows, starts = read("rows", "<u4").astype(np.int64), read("starts", "<u4").astype(np.int64)
        per_block = np.diff(flat(table.column("sizes"))[1]) // 4
        block_no = np.repeat(np.arange(len(per_block)), per_block)[seg]
        whole = (least > lowest[same])[seg] | ~first
        got = [(block_no[whole], rows[whole], starts[whole], starts[whole] + sizes[seg[whole]])]
        if len(run_of):
            run_at = np.searchsorted(run_of, np.arange(len(strings) + 1))
            part = np.flatnonzero(~whole & (np.diff(run_at)[same[seg]] > 0))
            k = np.diff(run_at)[same[seg[part]]]
            at = _ranges(run_at[same[seg[part]]], k)
            part = np.repeat(part, k)
            got.append((block_no[part], rows[part], starts[part] + run_from[at], starts[part] + run_to[at]))
        b, r, s, e = (np.concatenate(x) for x in zip(*got))
        order, parts = _by_bucket(b)
        names = table.column("block").to_pylist()
        return pa.table({"block": pa.array([names[k] for k, _, _ in parts], pa.int32()),
                         **{c: _cut_up(x[order].astype("<u4"), _cuts(parts)) for c, x in (("rows", r), ("starts", s), ("ends", e))}})
    return run


# --- step 4: what stays of each document ------------------------------------
def _cut(with_text: bool):
    def run(key, table, gone):
        data, off, ids = _gathered(table)
        read = lambda c: flat(gone.column(c))[0].view("<u4").astype(np.int64)
        row = read("rows")
        depth = np.bincount(off[row] + read("starts"), minlength=len(data) + 1) - np.bincount(off[row] + read("ends"), minlength=len(data) + 1)
        removed = np.cumsum(depth[:len(data)]) > 0
        upto = np.concatenate(([0], np.cumsum(removed)))
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        inner = off[:-1][off[:-1] < len(data)]
        opens[inner] = removed[inner]            # a document's first byte opens a span of its own
        spans = np.concatenate(([0], np.cumsum(opens)))
        kept = data[~removed].tobytes()
        at = off - upto[off]
        left = [kept[a:z] for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
        out = {"id": pa.array([None if v == _LAST else v for v in ids.tolist()], pa.int64()), "n_bytes": pa.array(np.diff(off)),
               "n_removed": pa.array(np.diff(upto[off])), "n_spans": pa.array(np.diff(spans[off])),
               "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())}
        if with_text:
            out["kept"] = pa.array(left, pa.binary())
        return pa.table(out)
    return run


def sizes_for(size: int) -> tuple[int, int]:
    """``block_bytes`` and ``hot`` for an input of ``size`` bytes: blocks of 6
    MB up to 256 of them, then larger up to 12 MB; 4096 segments, or one for
    each 512 KB up to 16384 (under 2 MB of one bucket)."""
    return min(max(6 << 20, size // 256), 12 << 20), min(max(4096, size >> 19), 16384)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, block_bytes: int | None = None,
                   shard_bytes: int = 1 << 18, hot: int | None = None, with_text: bool = False) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row, and
    ``kept``, the bytes that stay, if asked for. ``block_bytes`` and ``hot``
    follow the input (``sizes_for``): messages between blocks and buckets get
    fewer with the square of the former, so on a large cluster raise it with
    the executors' memory; the latter grows so that a passage is not dealt
    window by window for the size of the table alone."""
    size = docs.agg(F.sum(F.octet_length(quoted(text_col).cast("string")))).first()[0] or 0
    usual = sizes_for(size)
    blocks, hot = max(1, -(-size // (block_bytes or usual[0]))), usual[1] if hot is None else hot
    buckets, segment_buckets = max(1, blocks // 4), blocks
    text = utf8(f"`{text_col}`")
    placed = docs.select(F.pmod(F.xxhash64(quoted(id_col), F.xxhash64(text)), F.lit(blocks)).cast("int").alias("block"),
                         quoted(id_col).cast("bigint").alias("id"), text.alias("text"))
    by_block = placed.groupBy("block")
    told = by_block.applyInArrow(_ask(length, buckets), _ASK).groupBy("bucket").applyInArrow(_tell(hot), _TOLD)
    sent = by_block.cogroup(told.groupBy("block")).applyInArrow(_send(length, buckets, segment_buckets), _SEND)
    gone = sent.groupBy("bucket").applyInArrow(_judge(length, shard_bytes), _GONE)
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_text else "")
    return by_block.cogroup(gone.groupBy("block")).applyInArrow(_cut(with_text), schema)
