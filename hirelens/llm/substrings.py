"""Remove long byte strings that an earlier document has: sampled suffixes, external sorting, induction with common prefixes.

A byte goes if a string of `size` bytes covers it that also starts in a document with a smaller id. Suffixes are sorted
as far as such strings reach, in these steps:

1. Sampling. Every string of `size` bytes has a least k-mer (by hash, leftmost of equal ones), which depends on the string alone. The suffixes
   at these places are the sample; strings next to each other mostly share one, so a run of strings is one tuple: the k-mer, the hash of
   all bytes of the run, document and place. A task keeps the tuple of the smallest document only, and settles those of later documents itself.
2. External sorting. Spark sorts the tuples across the cluster, spilling to disk; a pass over the sorted stream removes each run
   that a smaller document has whole. Two different runs of a k-mer can share a string only if they agree on half of the
   other bytes to the right, or to the left; short hashes of both are part of the tuple. Runs that have such a partner
   go on; their bytes are fetched.
3. Induction. The sampled suffixes of a k-mer are sorted, with their common-prefix lengths. The order of the suffixes one byte further
   left follows by a stable sort on that byte alone, and their common prefixes from range minima over the previous ones, plus one. So
   byte by byte, for all k-mers of a block at once, equal strings come to stand together, whatever their offset from the sample. A prefix
   never counts beyond `size` bytes, so the sampled suffixes need no recursion of their own: their heads are sorted.

A k-mer with more than `most` tuples is not held in memory: all its different runs go on, and if these are more than `most`,
too, each of their strings becomes a tuple of its own, which step 2 settles.

Nulls and empty texts have no bytes; a text shorter than `size` loses none. A null id is larger than all others; ids are
whole numbers or anything that Spark can order. Rows with equal id are no earlier documents of each other, however many there are; rows with
equal id and text share one result. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch
from hirelens.llm.ordering import positions

KMER = 16
LAST = (1 << 63) - 1
#: Bytes handled at once; a place within them must fit in PLACE bits.
PART, PLACE = 1_500_000, 24
RUNS = "k long, c long, id long, row long, packed long, spans binary"
#: k: the k-mer's hash (39 bits), that of the bytes right of it (12), that of the bytes left of it (12), 0 where a run has no
#: string with as many. id, row and the 20 bits of packed tell a document (see keyed). packed: hash of the text (20 bits), place of the k-mer in its first string (6), strings less one (6),
#: first byte (31).
SPAN = "kind int, k long, id long, row long, packed long, end long"
SIDE = 12


@dataclass(frozen=True)
class Cut:
    """Length of a string (17 to 64 bytes), and runs of one k-mer that are held in memory."""

    size: int = 50
    most: int = 300_000


def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte; powers of a base and of its inverse, modulo 2 ** 64."""
    rng = np.random.default_rng(50)
    table = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    n = 2 * PART + 256
    up, down = (np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)]) for b in (base, inverse))
    return table, up, down


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of strings of a buffer."""

    def __init__(self, data: np.ndarray, constants: tuple) -> None:
        table, up, self.down = constants
        self.values = table[data]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values * up[:len(data)])])

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def kmers(self) -> np.ndarray:
        """Of KMER bytes from each place on, doubling the length four times."""
        h, n = self.values, 1
        while n < KMER:
            h = h[:-n] * np.uint64(0xA24BAED4963EE407 + 2 * n) + h[n:]
            n *= 2
        return mixed(h)


def minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each stretch of `width` keys."""
    n, m = 1, keys
    while 2 * n <= width:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    rest = width - n
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def runs_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int, constants: tuple) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same least k-mer: k (see SPAN), hash of the run, first string, number of strings less one, place of the k-mer.

    The buffer holds texts from `starts` to `ends`; no string crosses them.
    """
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < size:
        return none
    hashes = Hashes(data, constants)
    kmers = hashes.kmers()
    low = np.uint64((1 << PLACE) - 1)
    least = minima((kmers & ~low) | np.arange(len(kmers), dtype=np.uint64), size - KMER + 1)
    place = (least & low).astype(np.int64)
    edge = np.zeros(len(place) + 1, np.int32)
    long = ends - starts >= size
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - size + 1, -1)
    inside = np.cumsum(edge[:-1]) > 0
    change = np.r_[True, (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])]
    first = np.flatnonzero(change)
    last = np.r_[first[1:], len(place)] - 1
    first, last = first[inside[first]], last[inside[first]]
    at = place[first]
    right = (size - KMER) // 2
    left = size - KMER - right + 1

    def side(has: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        out[has] = hashes.between(begin[has], end[has]) % np.uint64((1 << SIDE) - 1) + np.uint64(1)
        return out

    k = kmers[at] >> np.uint64(25)
    k = k << np.uint64(SIDE) | side(at - last < left, at + KMER, at + KMER + right)
    k = k << np.uint64(SIDE) | side(at - first >= left, at - left, at)
    return k, hashes.between(first, last + size), first, last - first, at - first


def pack(digest: np.ndarray, at: np.ndarray, more: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return (digest << 43) | (at << 37) | (more << 31) | begin


def unpack(packed: np.ndarray) -> tuple[np.ndarray, ...]:
    return packed >> 43, (packed >> 37) & 63, (packed >> 31) & 63, packed & ((1 << 31) - 1)


def parts(texts: list[bytes], order: np.ndarray, size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Stretches (text, first byte, end) of about PART bytes in all, in order. Long texts are cut so that every string is in one stretch."""
    held, total = [], 0
    for i in order.tolist():
        begin, n = 0, len(texts[i])
        while n - begin >= size:
            end = min(n, begin + PART)
            held.append((i, begin, end))
            total += end - begin
            if total >= PART:
                yield held
                held, total = [], 0
            if end == n:
                break
            begin = end - size + 1
    if held:
        yield held


def union(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches covered by [begin, end), sorted and joined where they touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    first = np.r_[True, begin[1:] > reach[:-1]]
    return begin[first], reach[np.r_[np.flatnonzero(first)[1:] - 1, len(begin) - 1]]


def ordered_id(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def sample(docs: DataFrame, size: int) -> DataFrame:
    """Tuples of the sampled suffixes; and what a task settles itself, as rows with `spans` (begin, end, begin, end, ...)."""

    names = ["k", "c", "id", "row", "packed", "spans"]

    def tuples(found: list, ids: np.ndarray, numbers: np.ndarray, digests: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What some parts have, in order of ids: tuples of the smallest documents, spans of the later ones."""
        k, c, text, begin, more, at = (np.concatenate(x) for x in zip(*found))
        id_ = ids[text]
        order = np.argsort(k ^ c, kind="stable")
        new = np.r_[True, (k[order][1:] != k[order][:-1]) | (c[order][1:] != c[order][:-1])]
        least = id_[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.zeros(len(k), bool)
        later[order] = id_[order] > least
        keep, gone = np.flatnonzero(~later), np.flatnonzero(later)
        packed = pack(digests[text], at, more, begin)
        for i in range(0, len(keep), 100_000):
            own = keep[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[own]) for x in (k, c, id_, numbers[text], packed)] + [pa.nulls(len(own), pa.binary())], names=names)
        if not len(gone):
            return
        rows = []
        for own in np.split(gone, np.flatnonzero(text[gone][1:] != text[gone][:-1]) + 1):
            b, e = union(begin[own], begin[own] + more[own] + size)
            doc = text[own[0]]
            rows.append((int(k[own[0]]), None, int(ids[doc]), int(numbers[doc]), int(digests[doc]) << 43, np.stack([b, e], axis=1).tobytes()))
        types = [pa.int64()] * 5 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            constants = _constants()
            for batch in batches:
                ids, numbers, digests = (batch.column(i).to_numpy() for i in range(3))
                texts, found = batch.column(3).to_pylist(), []
                for part in parts(texts, np.argsort(ids, kind="stable"), size):
                    sizes = np.array([e - b for _, b, e in part])
                    ends = np.cumsum(sizes)
                    starts = ends - sizes
                    data = np.frombuffer(b"".join(texts[i][b:e] for i, b, e in part), np.uint8)
                    k, c, first, more, at = runs_of(data, starts, ends, size, constants)
                    own = np.searchsorted(ends, first, "right")
                    text, begin = np.array([i for i, _, _ in part])[own], np.array([b for _, b, _ in part])[own]
                    found.append((k.view(np.int64), c.view(np.int64), text, first - starts[own] + begin, more, at))
                    if len(found) == 6:
                        yield from tuples(found, ids, numbers, digests)
                        found = []
                if found:
                    yield from tuples(found, ids, numbers, digests)

    return docs.mapInArrow(run, RUNS)


def spans(kind: int, k: np.ndarray, id_: np.ndarray, row: np.ndarray, packed: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(k), kind, np.int32)), *[pa.array(x, pa.int64()) for x in (k, id_, row, packed, end)]],
        names=["kind", "k", "id", "row", "packed", "end"])


def settled(tuples: DataFrame, cut: Cut) -> DataFrame:
    """Sort tuples and settle runs: rows of kind 0 are to be removed up to `end`, of kind 1 (the smallest document of a run with a
    partner) need a closer look."""
    size, bits = cut.size, 2 * SIDE

    def ends(packed: np.ndarray) -> np.ndarray:
        _, _, more, begin = unpack(packed)
        return begin + more + size

    def whole(k: np.ndarray, c: np.ndarray, id_: np.ndarray, number: np.ndarray, packed: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All tuples of some k-mers."""
        if not len(k):
            return
        new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
        run = np.cumsum(new) - 1
        removed = id_ > id_[new][run]
        if removed.any():
            yield spans(0, k[removed], id_[removed], number[removed], packed[removed], ends(packed[removed]))
        shared = np.zeros(int(run[-1]) + 1, bool)
        side = (1 << SIDE) - 1
        for own, key in (((k[new] >> SIDE) & side, k[new] >> SIDE), (k[new] & side, k[new] >> bits << SIDE | k[new] & side)):
            _, which, n = np.unique(key, return_inverse=True, return_counts=True)
            shared |= (n[which] > 1) & (own > 0)
        asked = ~removed & shared[run]
        if asked.any():
            yield spans(1, k[asked], id_[asked], number[asked], packed[asked], np.zeros(int(asked.sum()), np.int64))

    def part(rows: list[np.ndarray], last: tuple[int, int, int] | None) -> tuple[list[pa.RecordBatch], tuple[int, int, int]]:
        """Some tuples of one k-mer; `last` has k, c and least id of the run before."""
        k, c, id_, number, packed = rows
        new = np.r_[last is None or (k[0], c[0]) != last[:2], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
        least = np.r_[last[2] if last else 0, id_[new]][np.cumsum(new)]
        gone, stay = np.flatnonzero(id_ > least), np.flatnonzero(id_ <= least)
        out = [spans(0, k[gone], id_[gone], number[gone], packed[gone], ends(packed[gone])),
               spans(1, k[stay], id_[stay], number[stay], packed[stay], np.zeros(len(stay), np.int64))]
        return out, (int(k[-1]), int(c[-1]), int(least[-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # tuples of a k-mer that may go on
        last = None  # the last run of a k-mer with too many tuples
        for batch in batches:
            there = batch.column(5).is_valid()
            handed = batch.filter(there)
            for k, id_, number, packed, data in zip(*(handed.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                begin, end = np.frombuffer(data, np.int64).reshape(-1, 2).T
                same = np.ones(len(begin), np.int64)
                yield spans(0, same * k, same * id_, same * number, packed + begin, end)
            rest = batch.filter(batch.column(5).is_null()) if handed.num_rows else batch
            rows = [rest.column(i).to_numpy() for i in range(5)]
            if held is not None:
                rows, held = [np.concatenate(x) for x in zip(held, rows)], None
            if last is not None and len(rows[0]):
                n = int((rows[0] >> bits == last[0] >> bits).sum())
                if n:
                    out, after = part([x[:n] for x in rows], last)
                    yield from out
                    rows, last = [x[n:] for x in rows], after
                if len(rows[0]):
                    last = None
            if not len(rows[0]):
                continue
            kmer = rows[0] >> bits
            first = int(np.searchsorted(kmer, kmer[-1]))
            yield from whole(*[x[:first] for x in rows])
            held = [x[first:] for x in rows]
            if len(held[0]) > cut.most:
                out, last = part(held, None)
                yield from out
                held = None
        if held is not None:
            yield from whole(*held)

    sorted_ = tuples.repartition(F.shiftright("k", bits)).sortWithinPartitions("k", "c", "id")
    return sorted_.mapInArrow(run, SPAN)


# Induction ------------------------------------------------------------------------------------------------


class Minima:
    """Range minima of an array, by tables of minima over powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            below, n = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-n], below[n:]))

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least of [begin, end), which is not empty."""
        out = np.empty(len(begin), self.levels[0].dtype)
        level = np.frexp((end - begin).astype(float))[1] - 1
        for j in np.unique(level):
            own = level == j
            out[own] = np.minimum(self.levels[j][begin[own]], self.levels[j][end[own] - 2 ** int(j)])
        return out


def induced(k: np.ndarray, id_: np.ndarray, at: np.ndarray, more: np.ndarray, text: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """Which strings of runs also start in a smaller document of the block: a row per run, a column per place left of the k-mer.

    `text` has the bytes of each run in a row, filled up; `at` is the place of the k-mer and `more` the last string.
    """
    n, wide = len(k), np.arange(size)
    head = np.take_along_axis(text, np.minimum(at[:, None] + wide, text.shape[1] - 1), axis=1).astype(np.int16)
    there = np.minimum(length - at, size)
    head[wide >= there[:, None]] = -1
    _, kmer = np.unique(k, return_inverse=True)
    # Order of the sampled suffixes: by k-mer, then byte by byte, the end of a run first.
    by_head = np.ascontiguousarray((head + 1).astype(">u2")).view(f"V{2 * size}").ravel().argsort(kind="stable")
    order = by_head[np.argsort(kmer[by_head], kind="stable")]
    sorted_head, sorted_there = head[order], there[order]
    equal = (sorted_head[1:] == sorted_head[:-1]) & (sorted_head[1:] >= 0)
    common = np.where(equal.all(axis=1), size, equal.argmin(axis=1))
    common = np.minimum(common, np.minimum(sorted_there[1:], sorted_there[:-1]))
    common[kmer[order][1:] != kmer[order][:-1]] = 0
    common = np.r_[0, common].astype(np.int16)  # with the suffix before
    removed = np.zeros((n, size - KMER + 1), bool)
    left = 0
    while len(order):
        # Strings that start here: those of one stretch of common prefixes of `size` bytes are equal.
        own = at[order] - more[order] <= left
        if own.any():
            label = np.cumsum(common < size)
            least = np.full(label[-1] + 1, LAST)
            np.minimum.at(least, label[own], id_[order][own])
            removed[order, left] = own & (id_[order] > least[label])
        # One byte to the left.
        left += 1
        reach = np.flatnonzero(at[order] >= left)
        if not len(reach) or left > size - KMER:
            break
        kept = order[reach]
        byte = text[kept, at[kept] - left].astype(np.int64)
        key = kmer[kept] * 256 + byte
        turn = np.argsort(key, kind="stable")
        rank, key = reach[turn], key[turn]
        table = Minima(common)
        follows = key[1:] == key[:-1]
        grown = np.zeros(len(turn), np.int16)
        if follows.any():
            begin, end = rank[:-1][follows] + 1, rank[1:][follows] + 1
            grown[1:][follows] = np.minimum(table.between(begin, end) + 1, size)
        order, common = kept[turn], grown
    return removed


CONTEXT = "k long, id long, row long, packed long, bytes binary"


def contexts(docs: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """The bytes of runs that need a closer look, from their documents."""
    runs_of_row = F.collect_list(F.struct("k", "packed")).alias("runs")
    places = asked.select(F.shiftright("k", 2 * SIDE).alias("k"), "id", "row", "packed", F.shiftright("packed", 43).alias("digest")).groupBy(*DOCUMENT).agg(runs_of_row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, texts, runs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
            made, n = [], 0
            for i, (id_, number) in enumerate(zip(ids, numbers)):
                text, own = texts[i].as_py(), runs[i].values
                packed = own.field("packed").to_numpy()
                _, _, more, begin = unpack(packed)
                made.append((own.field("k").to_numpy(), np.full(len(packed), id_), np.full(len(packed), number), packed, [text[b:b + m + size] for b, m in zip(begin.tolist(), more.tolist())]))
                n += len(packed)
                if n >= 20_000 or i == len(ids) - 1:
                    columns = [pa.array(np.concatenate([m[j] for m in made]), pa.int64()) for j in range(4)]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array([x for m in made for x in m[4]], pa.binary())], names=["k", "id", "row", "packed", "bytes"])
                    made, n = [], 0

    met = docs.join(places, DOCUMENT).select("id", "row", "text", "runs")
    return met.mapInArrow(run, CONTEXT)


def look_closer(runs: DataFrame, cut: Cut) -> DataFrame:
    """Kind 0 rows for strings that a smaller document has; kind 3 rows for k-mers with too many runs: one for each
    string, with its hashes in `k` and `end`."""
    size = cut.size

    def matrix(held: pa.RecordBatch) -> tuple:
        k, id_, number, packed = (held.column(i).to_numpy() for i in range(4))
        data = held.column(4).to_pylist()
        length = np.array([len(x) for x in data])
        wide = int(length.max())
        text = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in data), np.uint8).reshape(len(data), wide)
        return k, id_, number, packed, text, length

    def block(held: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        k, id_, number, packed, text, length = matrix(held)
        digest, at, more, begin = unpack(packed)
        removed = induced(k, id_, at, more, text, length, size)
        run, left = np.nonzero(removed)
        if len(run):  # strings next to each other as one row
            end = np.flatnonzero(np.r_[(run[1:] != run[:-1]) | (left[1:] != left[:-1] + 1), True])
            n = np.diff(np.r_[-1, end])
            run, first = run[end], begin[run[end]] + at[run[end]] - left[end]
            yield spans(0, k[run], id_[run], number[run], pack(digest[run], np.zeros_like(first), np.zeros_like(first), first), first + n - 1 + size)

    def strings(held: pa.RecordBatch, constants: tuple) -> Iterator[pa.RecordBatch]:
        k, id_, number, packed, text, _ = matrix(held)
        digest, _, more, begin = unpack(packed)
        flat = Hashes(np.ascontiguousarray(text).ravel(), constants)
        run = np.repeat(np.arange(len(k)), more + 1)
        place = np.arange(len(run)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
        start = run * text.shape[1] + place
        whole, part = flat.between(start, start + size), flat.between(start, start + size - 1)
        first = begin[run] + place
        yield spans(3, whole.view(np.int64), id_[run], number[run], pack(digest[run], np.zeros_like(first), np.zeros_like(first), first), part.view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            constants, held, crowded = _constants(), None, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                if held is not None:
                    batch = pa.concat_batches([held, batch])
                    held = None
                k = batch.column(0).to_numpy()
                if crowded is not None:
                    n = int((k == crowded).sum())
                    for i in range(0, n, 10_000):
                        yield from strings(batch.slice(i, min(10_000, n - i)), constants)
                    batch, k = batch.slice(n), k[n:]
                    if len(k):
                        crowded = None
                if not len(k):
                    continue
                last = int(np.searchsorted(k, k[-1]))
                if last:
                    yield from block(batch.slice(0, last))
                held = batch.slice(last)
                if held.num_rows > cut.most:
                    crowded = int(k[-1])
                    for i in range(0, held.num_rows, 10_000):
                        yield from strings(held.slice(i, min(10_000, held.num_rows - i)), constants)
                    held = None
            if held is not None:
                yield from block(held)

    return runs.repartition("k").sortWithinPartitions("k").mapInArrow(run, SPAN)


# Removal --------------------------------------------------------------------------------------------------


DOCUMENT = ["id", "row", "digest"]


def keyed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """id (a long in the order of the ids, null last), row and digest (84 bits of hashes of the text), doc_id, and text as bytes.

    `row` is needed only where several rows have one id, and zero elsewhere. Ids that are no whole numbers are numbered in their order.
    """
    whole = docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    known = docs.select("doc_id", "text")
    if whole:
        known = known.withColumn("id", F.col("doc_id").cast("long"))
    else:
        placed = scratch.keep(positions(docs.select("doc_id").na.drop().distinct(), [F.col("doc_id")], "id", scratch, "places-of-ids"), "ids")
        known = known.join(placed, "doc_id", "left")
    known = known.withColumn("id", F.coalesce("id", F.lit(LAST)))
    again = scratch.keep(known.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.lit(True).alias("again")), "again")
    row = F.when(F.col("again"), F.xxhash64(F.lit(1), "text")).otherwise(0)
    return known.join(again, "id", "left").select(
        "id", row.alias("row"), F.expr("xxhash64(text) & 1048575").alias("digest"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), "doc_id")


def repeated(texts: DataFrame, scratch: Scratch, cut: Cut = Cut()) -> DataFrame:
    """id, row, digest and `places` (begin, end) to remove of the documents that lose bytes, for the result of `keyed`."""
    texts = texts.drop("doc_id")
    found = scratch.keep(settled(sample(texts, cut.size), cut), "settled")
    runs = scratch.keep(contexts(texts, found.filter("kind = 1"), cut.size), "contexts")
    closer = scratch.keep(look_closer(runs, cut), "closer")
    scratch.drop("contexts")
    single = closer.filter("kind = 3").select("k", F.col("end").alias("c"), "id", "row", "packed", F.lit(None).cast("binary").alias("spans"))
    rest = scratch.keep(settled(single, cut), "single")
    gone = found.unionByName(closer).unionByName(rest).filter("kind = 0")
    places = gone.select("id", "row", F.shiftright("packed", 43).alias("digest"), F.expr("packed & 2147483647").alias("begin"), "end")
    return places.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("begin", "end")).alias("places"))


def remove_repeats(docs: DataFrame, cut: Cut = Cut(), texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and `kept` (the bytes that stay; null without `texts`) of every row."""
    scratch = Scratch(docs.sparkSession, "substrings")
    texts_ = keyed(docs, scratch)
    places = scratch.keep(repeated(texts_, scratch, cut), "places")
    scratch.close("places", "ids", "again")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column(1), batch.column(2)):
                text, kept, b = text.as_py(), b"", []
                if places.is_valid:
                    b, e = union(*(places.values.field(i).to_numpy().astype(np.int64) for i in range(2)))
                    stays = zip([0, *e.tolist()], [*b.tolist(), len(text)])
                    kept = b"".join(text[i:j] for i, j in stays)
                else:
                    kept = text
                rows.append((len(text), len(text) - len(kept), len(b), hashlib.sha256(kept).hexdigest(), kept if texts else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]], names)

    joined = texts_.join(places, DOCUMENT, "left").select("doc_id", "text", "places")
    return joined.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
