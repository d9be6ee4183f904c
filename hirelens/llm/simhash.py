"""Near duplicates by SimHash, found through an inverted index over byte positions.

A fingerprint is eight bytes. If two differ in at most `distance` bits, they differ in at most as many bytes,
so of the 8 (position, byte) postings of one at least 8 - distance hold the other too. Counting shared
postings per pair over plain lists (2,048 of them) would touch every pair of documents again and again. Instead the lists are
intersected first: among any `positions` positions a pair shares at least `positions - distance`, so it meets in a list of
that many (position, byte) values together. Every list then tallies the shared positional bytes of its pairs, keeps
those that reach 8 - distance, and verifies the bits.

Only links that connect are emitted, at most one per member and list, so a list of thousands of near copies makes no
pair table, yet loses no connection. Copies share one fingerprint and enter once. Lists of more than `block` members are
cut into blocks by hash, and every two blocks meet in a task of their own.

Nulls and texts without words have fingerprint zero. Rows with equal ids are rows of their own; a null id is never
the smallest. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch
from hirelens.llm.components import components

LINKS = "kind string, combo int, value long, a long, b long"


@dataclass(frozen=True)
class Search:
    """Words in a shingle, bits in which linked fingerprints may differ, byte positions indexed, members of a block."""

    shingle: int = 3
    distance: int = 3
    positions: int = 7
    block: int = 4096


def fingerprint(text: bytes | None, width: int) -> int:
    """SimHash of the word shingles, as an unsigned number."""
    ws = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = list(accumulate(ws, lambda end, w: end + 1 + len(w), initial=-1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a + 1:b], 42) for a, b in zip(ends, ends[width:])), np.uint64, len(ws) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, digest (hash of the text) and fingerprint (the 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, width) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "digest", "fp"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, digest long, fp long")


def masks(search: Search) -> list[int]:
    """Masks of the bytes of every list, as signed numbers."""
    sets = combinations(range(search.positions), search.positions - search.distance)
    unsigned = [sum(0xFF << (8 * p) for p in s) for s in sets]
    return [m - (1 << 64) if m >> 63 else m for m in unsigned]


def linked(x: np.uint64, others: np.ndarray, distance: int) -> np.ndarray:
    """Which fingerprints share enough positional bytes with x, and are as near in bits."""
    differs = others ^ x
    enough = (differs.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= 8 - distance
    enough[enough] = np.bitwise_count(differs[enough]) <= distance
    return enough


def forest(members: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is connected within a list."""
    links, left = [], members
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = linked(x, left, distance)
            if near.any():
                found, left = left[near], left[~near]
                links.append((np.full(len(found), x), found))
                reached.extend(found)
    return links


def lists_in(batches: Iterator[pa.RecordBatch], distance: int, most: int | None) -> Iterator[pa.RecordBatch]:
    """Links within each run of rows with equal keys; the last column holds the members.

    Longer runs than `most` are passed on member by member instead, so memory stays bounded.
    """
    held = None  # the keys and members of a run that the next batch may go on with
    crowded = None  # the key of a run that is passed on

    def rows(kind: str, combo: int, value: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays([
            pa.array([kind] * n, pa.string()), pa.array(np.full(n, combo, np.int32)), pa.array(np.full(n, value, np.int64)),
            pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "combo", "value", "a", "b"])

    def close(keys: np.ndarray, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All complete runs of a sorted stretch."""
        if not len(members):
            return
        begins = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[begins, len(members)])
        twos = begins[sizes == 2]
        a, b = members[twos], members[twos + 1]
        found = [(a[near], b[near])] if (near := _paired(a, b, distance)).any() else []
        for begin, size in zip(begins[sizes > 2], sizes[sizes > 2]):
            found += forest(members[begin:begin + size], distance)
        if found:
            yield rows("link", 0, 0, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(batch.num_columns)]
        keys, members = np.stack(columns[:-1], axis=1), columns[-1].view(np.uint64)
        if held is not None:
            keys, members = np.concatenate([held[0], keys]), np.concatenate([held[1], members])
        last = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
        if crowded is not None and (same := (keys == crowded).all(axis=1)).any():
            end = int(same.sum())  # the run goes on from the last batch
            yield rows("crowded", int(crowded[0]), int(crowded[1]), members[:end], members[:end])
            keys, members, last = keys[end:], members[end:], max(last - end, 0)
        if not len(members):
            held = None
            continue
        yield from close(keys[:last], members[:last])
        held = keys[last:], members[last:]
        if most is not None and len(held[1]) > most:
            crowded = held[0][0]
            yield rows("crowded", int(crowded[0]), int(crowded[1]), held[1], held[1])
            held = None
    if held is not None:
        yield from close(*held)


def _paired(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    differs = a ^ b
    enough = (differs.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= 8 - distance
    return enough & (np.bitwise_count(differs) <= distance)


def links(prints: DataFrame, scratch: Scratch, search: Search = Search()) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all which are connected."""
    distance = search.distance
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("value"))
        for i, m in enumerate(masks(search))])).alias("e")
    index = prints.select("fp").distinct().select(entries, "fp").select("e.combo", "e.value", "fp")
    found = scratch.keep(
        index.repartition("combo", "value").sortWithinPartitions("combo", "value").mapInArrow(
            lambda b: lists_in(b, distance, search.block), LINKS), "lists")
    crowded = found.filter("kind = 'crowded'").select("combo", "value", F.col("a").alias("fp"))
    blocks = F.ceil(F.col("n") / search.block).cast("int")
    sized = crowded.join(crowded.groupBy("combo", "value").agg(F.count(F.lit(1)).alias("n")), ["combo", "value"])
    placed = sized.withColumns({"own": F.pmod(F.xxhash64("fp"), blocks).cast("int"), "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    met = placed.select("combo", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    keys = ["combo", "value", "i", "j"]
    more = met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: lists_in(b, distance, None), LINKS)
    every = found.filter("kind = 'link'").select("a", "b").union(more.select("a", "b"))
    return scratch.keep(every.distinct(), "links")


def near_duplicates(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """doc_id, digest, fp, root (least linked fingerprint) and component_id (least linked doc_id) of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep(with_fingerprints(docs, search.shingle), "prints")
    roots = components(links(prints, scratch, search), scratch)
    of_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = of_print.join(roots, of_print["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return scratch.finish(prints.join(classes, "fp").select("doc_id", "digest", "fp", "root", "component_id"))


def representatives(docs: DataFrame, search: Search = Search()) -> DataFrame:
    """One row of every component, with all columns: the one with the smallest id, then text hash."""
    found = near_duplicates(docs, search)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    best = found.groupBy("root").agg(F.min(order).alias("r"))
    chosen = best.select(F.col("r.doc_id").alias("_id"), F.col("r.digest").alias("_digest"))
    inner = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("digest"))
    kept = inner.join(chosen, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "digest"]).select("_row.*")
