from collections import defaultdict

import numpy as np
import pytest
import xxhash
from fixtures import documents, nothing, rows, texts

from hirelens.llm import simhash
from hirelens.llm.base import Scratch
from hirelens.llm.components import components


def brute_print(text, width=3):
    ws = (text or "").encode().lower().split()
    grams = [b" ".join(ws[i:i + width]) for i in range(len(ws) - width + 1)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(values, distance):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def expected(some):
    prints = [(r[0], brute_print(r[1])) for r in some]
    roots = brute_roots({p for _, p in prints}, 3)
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[roots[p]].append(i)
    return sorted(((i, p, min(least[roots[p]], default=None)) for i, p in prints), key=str)


@pytest.mark.parametrize("block", [4096, 3])
def test_near_duplicates(spark, block):
    found = simhash.near_duplicates(documents(spark), simhash.Search(block=block)).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found), key=str) == expected(rows(texts()))


def test_representatives(spark):
    docs = documents(spark)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    classes = {c for _, _, c in expected(rows(texts()))}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes)


def test_empty(spark):
    assert simhash.near_duplicates(nothing(spark)).count() == 0
    assert simhash.representatives(nothing(spark)).count() == 0


@pytest.mark.parametrize("block", [4096, 50])
def test_links_connect_like_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    values = [int(x) for x in rng.integers(0, 1 << 63, 40, np.uint64) * 2]
    for v in values[:6]:  # dense groups: chains of few changed bits
        for _ in range(60):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                v ^= 1 << int(b)
            values.append(v)
    center = values[0]
    values += [center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in set(values)]
    scratch = Scratch(spark, "test")
    links = simhash.links(spark.createDataFrame(signed, "fp long").repartition(5), scratch, simhash.Search(block=block))
    for r in links.collect():
        assert ((r.a ^ r.b) % (1 << 64)).bit_count() <= 3
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in components(links, scratch).collect()}
    roots = brute_roots(set(values), 3)
    groups = defaultdict(set)
    for v in set(values):
        groups[found.get(v, v)].add(v)
    wanted = defaultdict(set)
    for v, r in roots.items():
        wanted[r].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 200), (250, 300)]
    found = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    roots = {r.node: r.root for r in found.collect()}
    assert all(roots[i] == 0 for i in range(1, 51)) and all(roots[100 + i] == 100 for i in range(1, 40))
    assert roots[300] == roots[250] == 200 and len(roots) == 50 + 39 + 2
