"""Packing documents into fixed-length token sequences by swap-based local search.

A document is its token ids and an end id. Documents longer than a sequence
are cut into pieces of its length; the last piece may be shorter. Pieces are
dealt at random into groups of about ``group`` pieces, and each group is
packed by itself, so the work grows with the data and no task holds more.

In a group the pieces first go best-fit, longest first. Then a local search
raises the sum of squared fills: going from the fullest underfull bin to the
emptiest, it looks in less full bins for a move of one piece into the gap,
or an exchange of one for one, two for one or one for two that fills the bin
exactly; if none does, for the best of those that fill most of the gap. Gaps
gather in the emptiest bins until these are empty. This is repeated until it
changes nothing. The pieces of bins that
stay underfull are dealt again with those of other groups, until that ends
in one group or gains no more.

Defined results: a null or empty text is one piece, the end id alone. Every
row is packed, repeated rows each by itself; a null id is carried as it is.
An empty table gives an empty result. Extra columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import keep, quoted, save, utf8

#: Words whose ids a Python worker remembers; the memory is emptied when full.
REMEMBERED = 600_000


class WordIds(dict):
    """Token ids of whitespace-free chunks as little-endian uint32 bytes.

    The tokenizer's pre-tokens never reach over white space and it ignores
    A-Z's case, so a text's ids are its lower-cased chunks' ids one after
    the other, and a chunk is tokenized once. A text that holds the spelling
    of a special token goes to the tokenizer whole, unless ``spell_out`` makes
    such a spelling plain text."""

    _plain = re.compile("[a-z\xdf-\xf6\xf8-\xff]+").fullmatch

    def __init__(self, path: str, spell_out: bool = False):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = spell_out
        special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile(b"|".join(map(re.escape, special))).search if special and not spell_out else None
        # byte-level spelling of non-ASCII letters, as the vocabulary writes them
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.spelled = {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.marks = {c: self._encode(c) for c in ".,!"}

    def _encode(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        word = text.lower()
        if self._plain(word):
            # a run of letters is one pre-token: straight to the merges
            spelled = word if word.isascii() else "".join(self.spelled[b] for b in word.encode())
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()
        elif text[-1] in self.marks and self._plain(word[-2:-1]):
            # a mark after a letter is a pre-token of its own
            ids = self[chunk[:-1]] + self.marks[text[-1]]
        else:
            ids = self._encode(text)
        if len(self) >= REMEMBERED:
            self.clear()
        self[chunk] = ids
        return ids

    def text(self, text: bytes) -> bytes:
        low = text.lower()
        if self._special and self._special(low):
            return self._encode(text.decode())
        return b"".join(map(self.__getitem__, low.split()))


_WORKER: dict[tuple[str, bool], WordIds] = {}


def word_ids(path: str, spell_out: bool) -> WordIds:
    """One for each Python worker, kept from task to task."""
    if (path, spell_out) not in _WORKER:
        _WORKER[path, spell_out] = WordIds(path, spell_out)
    return _WORKER[path, spell_out]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, id_col: str, text_col: str, length: int, tokenizer: str | None, end_id: int, spell_out: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` of every piece."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]])

    def cut(batches):
        words = word_ids(tokenizer or default_tokenizer(), spell_out)
        end = array("I", [end_id]).tobytes()
        for b in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = words.text(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                                              *[pa.array(x, pa.int64()) for x in (start, size, crc)]], schema.names)

    return docs.select(quoted(id_col).alias("id"), utf8(f"`{text_col}`").alias("text")).mapInArrow(cut, schema)


# ---------------------------------------------------------------------------
def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of piece numbers: longest piece first, into the fullest bin that takes it."""
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0                                    # bit r: some bin has room r
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[i]
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            r, b = length, len(bins)
            bins.append([])
        bins[b].append(i)
        if r > n:
            by_room[r - n].append(b)
            rooms |= 1 << (r - n)
    return bins


class LocalSearch:
    """Exchanges between the underfull bins of a group."""

    #: Pieces of one length that are looked at for a partner, and gaps below the exact one that are tried before those that the sizes allow.
    LOOK, SHORT = 24, 48

    def __init__(self, sizes: list[int], bins: list[list[int]], length: int):
        self.sizes, self.length = sizes, length
        self.bins = [set(b) for b in bins]
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.home = {i: b for b, items in enumerate(self.bins) for i in items}
        self.done = [f == length for f in self.fill]
        self.by_size: dict[int, set[int]] = {}
        for b, items in enumerate(self.bins):
            if not self.done[b]:
                for i in items:
                    self.by_size.setdefault(sizes[i], set()).add(i)

    def _move(self, i: int, to: int) -> None:
        at = self.home[i]
        self.bins[at].discard(i)
        self.fill[at] -= self.sizes[i]
        self.bins[to].add(i)
        self.fill[to] += self.sizes[i]
        self.home[i] = to

    def _freeze(self, b: int) -> None:
        self.done[b] = True
        for i in self.bins[b]:
            self.by_size[self.sizes[i]].discard(i)

    def _partner(self, size: int, b: int) -> int | None:
        """A piece of that size in the emptiest of the bins seen that are no fuller than ``b``."""
        best, least = None, self.fill[b] + 1
        for n, i in enumerate(self.by_size.get(size, ())):
            if n >= self.LOOK:
                break
            h = self.home[i]
            if h != b and self.fill[h] < least:
                best, least = i, self.fill[h]
        return best

    def _pair(self, size: int, b: int) -> tuple[int, int] | None:
        """Two pieces of one less full bin that have that size together."""
        for h in self.low:
            if h == b or self.done[h] or self.fill[h] > self.fill[b]:
                continue
            seen: dict[int, int] = {}
            for i in self.bins[h]:
                if size - self.sizes[i] in seen:
                    return seen[size - self.sizes[i]], i
                seen[self.sizes[i]] = i
        return None

    def _raise(self, b: int, gap: int) -> bool:
        """One move or exchange that adds ``gap`` to bin ``b``."""
        sizes, own = self.sizes, sorted(self.bins[b], key=lambda i: self.sizes[i])
        i = self._partner(gap, b)
        if i is not None:
            self._move(i, b)
            return True
        for a in own:                                            # one for one
            i = self._partner(sizes[a] + gap, b)
            if i is not None:
                h = self.home[i]
                self._move(i, b)
                self._move(a, h)
                return True
        for k, a in enumerate(own):                              # two for one
            for c in own[k + 1:]:
                i = self._partner(sizes[a] + sizes[c] + gap, b)
                if i is not None:
                    h = self.home[i]
                    self._move(i, b)
                    self._move(a, h)
                    self._move(c, h)
                    return True
        for a in own:                                            # one for two
            two = self._pair(sizes[a] + gap, b)
            if two:
                h = self.home[two[0]]
                for i in two:
                    self._move(i, b)
                self._move(a, h)
                return True
        return False

    def _gains(self, b: int, most: int) -> Iterator[int]:
        """The gains up to ``most`` that exchanges of the sizes at hand can have, largest first."""
        own = Counter(self.sizes[i] for i in self.bins[b])
        present = sum(1 << s for s, items in self.by_size.items() if len(items) > own[s])
        pairs = {s + t for s, n in own.items() for t in own if s != t or n > 1}
        gains = 0
        for t in {0, *own, *pairs}:
            gains |= present >> t
        two = 0
        for h in self.low:
            if h != b and not self.done[h]:
                held = Counter(self.sizes[i] for i in self.bins[h])
                for t in {s + t for s, n in held.items() for t in held if s != t or n > 1}:
                    two |= 1 << t
        for t in own:
            gains |= two >> t
        gains &= (1 << max(0, most) + 1) - 2
        while gains > 0:
            g = gains.bit_length() - 1
            yield g
            gains ^= 1 << g

    def run(self) -> list[list[int]]:
        while self._pass() | self._empty():
            for b, items in enumerate(self.bins):
                if items and self.fill[b] < self.length:
                    self.done[b] = False
                    for i in items:
                        self.by_size.setdefault(self.sizes[i], set()).add(i)
        return [list(b) for b in self.bins if b]

    def _pass(self) -> bool:
        """Whether any bin was raised."""
        raised = False
        open_bins = sorted((b for b in range(len(self.bins)) if self.bins[b] and not self.done[b]), key=lambda b: -self.fill[b])
        for n, b in enumerate(open_bins):
            if n % 64 == 0:
                self.low = sorted((h for h in open_bins[n:] if self.bins[h]), key=lambda h: self.fill[h])[:8]
            if self.done[b] or not self.bins[b]:
                continue
            while self.fill[b] < self.length:
                gap = self.length - self.fill[b]
                if not any(self._raise(b, g) for g in range(gap, max(0, gap - self.SHORT), -1)) \
                        and not any(self._raise(b, g) for g in self._gains(b, gap - self.SHORT)):
                    break
                raised = True
            self._freeze(b)
        return raised

    def _empty(self) -> bool:
        """Pieces of the emptiest bins go wherever there is room; whether any bin was emptied."""
        emptied = False
        room: dict[int, list[int]] = {}
        order = sorted((b for b in range(len(self.bins)) if self.bins[b] and self.fill[b] < self.length), key=lambda b: self.fill[b])
        for b in order:
            room.setdefault(self.length - self.fill[b], []).append(b)
        for b in order:
            items = sorted(self.bins[b], key=lambda i: -self.sizes[i])
            if not room or self.sizes[items[0]] > max(room):
                continue
            plan, left = [], {r: list(v) for r, v in room.items()}
            for i in items:
                fits = [r for r in left if r >= self.sizes[i] and any(h != b for h in left[r])]
                if not fits:
                    break
                r = min(fits)
                h = next(h for h in left[r] if h != b)
                left[r].remove(h)
                left.setdefault(r - self.sizes[i], []).append(h)
                plan.append((i, h))
            if len(plan) < len(items):
                continue
            for i, h in plan:
                self._move(i, h)
            left = {r: [h for h in v if h != b] for r, v in left.items()}
            room = {r: v for r, v in left.items() if v and r}
            emptied = True
        return emptied


def pack_group(sizes: list[int], length: int) -> list[list[int]]:
    return LocalSearch(sizes, best_fit(sizes, length), length).run()


_PACKED = "row_no bigint, bin bigint, offset bigint, full boolean"


def _packer(length: int):
    def run(key, table):
        sizes, rows = table.column("length").to_pylist(), table.column("row_no").to_pylist()
        out: tuple[list, list, list, list] = ([], [], [], [])
        for k, items in enumerate(pack_group(sizes, length)):
            at, full = 0, sum(sizes[i] for i in items) == length
            for i in sorted(items):
                for x, v in zip(out, (rows[i], k, at, full)):
                    x.append(v)
                at += sizes[i]
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.bool_())],
                                    ["row_no", "bin", "offset", "full"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, tokenizer: str | None = None,
         end_id: int = 0, group: int = 20_000, spell_out: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32,
    sequence_id, offset. ``tokenizer`` is the path of a vocabulary file.
    With ``spell_out`` a literal special token in a text, such as an end
    mark, is tokenized as the plain text it is, so that no document can put
    its id into a sequence."""
    table = save(pieces(docs, id_col, text_col, length, tokenizer, end_id, spell_out).withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    left, n, places, turn = table.select("row_no", "length"), table.count(), None, 0
    while True:
        groups = max(1, -(-n // group))
        # the number of the row is mixed so that neighbours land in different groups
        dealt = left.withColumn("grp", F.pmod(F.xxhash64(F.lit(turn), "row_no"), F.lit(groups)).cast("int"))
        found = dealt.select("grp", "row_no", "length").groupBy("grp").applyInArrow(_with_group(length), "grp int, " + _PACKED)
        found, _ = keep(found, "packed")
        name = (F.lit(turn).cast("bigint") * (1 << 56) + F.col("grp").cast("bigint") * (1 << 28) + F.col("bin")).alias("sequence_id")
        last = groups == 1
        settled = found if last else found.where("full")
        part = settled.select("row_no", name, "offset")
        places = part if places is None else places.unionByName(part)
        if last:
            break
        rest = found.where(~F.col("full"))
        more = rest.count()
        if more >= 0.9 * n:
            places = places.unionByName(rest.select("row_no", name, "offset"))
            break
        left, n, turn = save(rest.select("row_no").join(left, "row_no"), "unsettled"), more, turn + 1
    return table.join(places, "row_no").select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _with_group(length: int):
    run = _packer(length)

    def packed(key, table):
        out = run(key, table)
        return out.add_column(0, "grp", pa.array([key[0].as_py()] * out.num_rows, pa.int32()))
    return packed
