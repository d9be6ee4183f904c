"""Exact top-k search by inner product: M-trees over shards of the vectors, searched best first.

1. Vectors. Equal vectors become one, with its `k` + 1 smallest ids: more of them cannot be in an answer, so copies
   cost nothing. Shorter vectors count as padded by zeros.
2. Shards. Every vector goes to the nearest of some pivots; what one pivot draws beyond SHARD vectors is split by hash, so
   a task builds one tree of bounded size. Within a shard every vector x gets one more component, sqrt(M - x.x) for
   the largest square norm M: then (q - x)^2 = q.q + M - 2 q.x, and the nearest vectors are those with the largest products.
3. Pages. An M-tree is a set of pages. An entry has a vector, the covering radius of what lies below it, and
   its distance to the vector that stands for its page.
4. Search. A query first goes to the shard whose root may hold the largest product, best page first, and gets a
   threshold; then to all other shards whose roots may still reach it. Entries whose stored distances show by the triangle
   inequality that they lie too far away are skipped before their distance is computed. Queries are dealt to a tree's
   copies in blocks, so a shard that all queries ask is no hot task.

Vectors that are null or hold null or non-finite components take no part, neither as queries nor as candidates. Products are
whole numbers, exact at any size: shards whose square norms pass 2^52 are searched entry by entry in Python's integers. A
component or score beyond 64 bits counts as the nearest long. Ties go to the smaller id, null ids last. A repeated row counts
each time, and a query misses only its own row. Empty tables give empty results; only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch

#: Vectors of a tree, about; entries of a page; queries of a block; roots of a block.
SHARD, PAGE, ASKED, ROOTS = 8192, 512, 1024, 1024
#: Pivots, and the sampled vectors from which they are chosen (both bounds; every vector is in a tree).
PIVOTS, SAMPLE = 256, 4096
#: Above this square norm products may not be exact in doubles.
EXACT = 2.0**52
LONG = (1 << 63) - 1
SLACK = 1e-9


# Geometry -------------------------------------------------------------------------------------------------


class Space:
    """Whole-number vectors with the component that turns products into distances."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x.astype(np.float64)
        self.norm = np.einsum("ij,ij->i", self.x, self.x)
        self.most = float(self.norm.max(initial=0))
        self.extra = np.sqrt(np.maximum(self.most - self.norm, 0))

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Distances of vector i to others; rounding is covered by the slack in the bounds."""
        square = self.norm[i] + self.norm[others] - 2 * (self.x[others] @ self.x[i]) + (self.extra[others] - self.extra[i]) ** 2
        return np.sqrt(np.maximum(square, 0))


def matrix(column, width: int) -> np.ndarray:
    """Lists of longs of one length as a matrix."""
    whole = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width) if len(column) else np.zeros((0, width), np.int64)


def pages(space: Space) -> Iterator[dict]:
    """The pages of an M-tree over all vectors, the root first: entries, radii, distances to the page's vector, children."""
    n = len(space.x)
    rng = np.random.default_rng(n)
    middle = int(np.argmin(((space.x - space.x.mean(axis=0)) ** 2).sum(axis=1)))
    todo, made = [(np.arange(n), middle, 0)], 1
    while todo:
        members, centre, page = todo.pop()
        apart = space.apart(centre, members)
        if len(members) <= PAGE:
            yield {"page": page, "entries": members, "radius": np.zeros(len(members)), "apart": apart, "child": np.full(len(members), -1), "centre": centre}
            continue
        seeds = rng.choice(members, min(PAGE // 2, -(-2 * len(members) // PAGE)), replace=False)
        distances = np.stack([space.apart(int(s), members) for s in seeds])
        nearest = distances.argmin(axis=0)
        if np.bincount(nearest).max() > 0.9 * len(members):  # one seed draws nearly all: even parts by distance
            nearest = np.argsort(np.argsort(distances[0], kind="stable")) * len(seeds) // len(members)
        entries, radius, child = [], [], []
        for k in range(len(seeds)):
            own = np.flatnonzero(nearest == k)
            if len(own):
                entries.append(int(seeds[k]))
                radius.append(distances[k][own].max())
                child.append(made)
                todo.append((members[own], int(seeds[k]), made))
                made += 1
        places = np.array(entries)
        yield {"page": page, "entries": places, "radius": np.array(radius), "apart": space.apart(centre, places), "child": np.array(child), "centre": centre}


class Tree:
    """A tree's pages as arrays."""

    def __init__(self, table: pa.Table, width: int) -> None:
        whole = table.sort_by("page").combine_chunks()
        flat = {name: whole.column(name).chunk(0).flatten().to_numpy(zero_copy_only=False) for name in ("vectors", "radius", "apart", "child")}
        stops = np.cumsum([0, *whole.column("child").chunk(0).value_lengths().to_pylist()])
        self.most = whole.column("most")[0].as_py()
        self.exact = self.most < EXACT
        vectors = flat["vectors"].reshape(-1, width)
        self.vectors = vectors.astype(np.float64) if self.exact else vectors
        self.pages = [(self.vectors[i:j], flat["radius"][i:j], flat["apart"][i:j], flat["child"][i:j]) for i, j in zip(stops[:-1], stops[1:])]
        self.ids = whole.column("ids").chunk(0)

    def ids_of(self, page: int, entries: np.ndarray) -> list[list]:
        """The ids of some entries of a leaf."""
        return self.ids[page].values.take(pa.array(entries)).to_pylist()

    def search(self, q: np.ndarray, k: int, least: int | None) -> list[tuple[int, object]]:
        """The `k` best (score, id) of a query, only scores of at least `least`."""
        best = Best(k, least)
        square = float(q.astype(np.float64) @ q.astype(np.float64))
        if not self.exact or square >= EXACT:
            whole = q.astype(object)
            for page, (vectors, _, _, child) in enumerate(self.pages):
                if len(child) and child[0] < 0:
                    products = [max(-LONG - 1, min(LONG, sum(int(a) * b for a, b in zip(v, whole)))) for v in vectors]
                    best.add(products, self.ids_of(page, np.arange(len(child))))
            return best.found
        point = q.astype(np.float64)
        sum_ = square + self.most

        def reach() -> float:
            """The largest distance that can still give an answer."""
            return np.inf if best.least is None else np.sqrt(max(sum_ - 2.0 * best.least, 0.0)) * (1 + SLACK) + 1e-6

        queue: list[tuple[float, int, float]] = [(0.0, 0, -1.0)]
        while queue:
            nearest, page, to_centre = heapq.heappop(queue)
            far = reach()
            if nearest > far:
                break
            vectors, radius, apart, child = self.pages[page]
            near = np.arange(len(child))
            if to_centre >= 0:  # what the stored distances rule out needs no distance
                near = near[np.abs(to_centre - apart) - radius <= far]
            if not len(near):
                continue
            products = vectors[near] @ point
            if child[0] < 0:
                floor = -np.inf if best.least is None else best.least
                if len(products) > k:  # every entry has an id, so a page has no use beyond its k best
                    floor = max(floor, np.partition(products, -k)[-k])
                hits = products >= floor
                if hits.any():
                    best.add(products[hits].astype(np.int64).tolist(), self.ids_of(page, near[hits]))
                continue
            to = np.sqrt(np.maximum(sum_ - 2 * products, 0))
            for d, i in zip(to, near):
                closest = max(d - radius[i], 0.0)
                if closest <= far:
                    heapq.heappush(queue, (closest, int(child[i]), d))
        return best.found


class Best:
    """The best rows so far: (score, id) by score descending, then id, null ids last."""

    def __init__(self, k: int, least: int | None) -> None:
        self.k, self.least, self.found = k, least, []

    def add(self, scores: list[int], ids: list[list]) -> None:
        more = [(s, i) for s, own in zip(scores, ids) for i in own if self.least is None or s >= self.least]
        self.found = sorted(self.found + more, key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))[:self.k]
        if len(self.found) == self.k:
            self.least = self.found[-1][0]


# Tables ---------------------------------------------------------------------------------------------------


def usable(vectors: DataFrame, column: str, scale: int = 256) -> DataFrame:
    """`vectors` with `v`, the components as floor(scale * x), without the rows that take no part."""
    kept = vectors.filter(F.col(column).isNotNull() & F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))))
    # Beyond 64 bits floor gives the nearest long.
    return kept.withColumn("v", F.transform(column, lambda x: F.floor(scale * x.cast("double"))))


def _pivots(different: DataFrame, n: int, width: int) -> np.ndarray:
    """Some vectors of a bounded sample, each far from those before it."""
    sample = matrix(different.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").toArrow().column("v"), width).astype(np.float64)
    chosen, wanted = [0], min(PIVOTS, -(-2 * n // SHARD), len(sample))
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    # Every second time the farthest, else one from the thick of it: outliers alone would part nothing.
    for step in range(1, wanted):
        order = np.argsort(nearest, kind="stable")
        at = int(order[-1] if step % 2 else order[(len(order) * 3) // 4])
        chosen.append(at)
        nearest = np.minimum(nearest, ((sample - sample[at]) ** 2).sum(axis=1))
    return sample[sorted(set(chosen))]


def sharded(different: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(key, v, ids): every vector with the number of its shard, of about SHARD vectors at most."""
    n = different.count()
    if not n:
        return different.select(F.lit(0).cast("long").alias("key"), "v", "ids")
    pivots = _pivots(different, n, width)
    kind = different.schema["ids"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), width).astype(np.float64)
            norm = (x * x).sum(axis=1)
            squares = (pivots ** 2).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
            code = squares.argmin(axis=1) * 2 + (norm >= EXACT)
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), batch.column(0), batch.column(1)], ["key", "v", "ids"])

    dealt = scratch.keep(different.select("v", "ids").mapInArrow(assign, f"key long, v array<bigint>, ids {kind}"), "dealt")
    parts = dealt.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("parts"))  # 2 * PIVOTS rows at most
    salt = F.pmod(F.xxhash64("v"), F.col("parts"))
    return dealt.join(F.broadcast(parts), "key").select((F.col("key") * (1 << 40) + salt).alias("key"), "v", "ids")


def grown(shards: DataFrame, width: int) -> DataFrame:
    """The pages of a tree for every shard."""
    kind = shards.schema["ids"].dataType.simpleString()
    schema = (f"key long, page int, vectors array<bigint>, radius array<double>, apart array<double>, child array<int>, ids array<{kind}>, "
              "centre array<bigint>, most double")

    def grow(table: pa.Table) -> pa.Table:
        x = matrix(table.column("v"), width)
        space = Space(x)
        ids = table.column("ids").to_pylist()
        key = table.column("key")[0].as_py()
        rows = [(key, p["page"], x[p["entries"]].ravel().tolist(), p["radius"].tolist(), p["apart"].tolist(), p["child"].tolist(),
                 [ids[i] for i in p["entries"]] if p["child"][0] < 0 else [], x[p["centre"]].tolist(), space.most) for p in pages(space)]
        names = ["key", "page", "vectors", "radius", "apart", "child", "ids", "centre", "most"]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int32()),
                 pa.list_(table.schema.field("ids").type), pa.list_(pa.int64()), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return shards.groupBy("key").applyInArrow(grow, schema)


def meet(trees: DataFrame, asked: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Run(tree, queries) for every `key`, its queries dealt to copies of the tree, about ASKED to each."""
    blocks = asked.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("blocks"))
    copies = trees.join(blocks, "key").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    parts = blocks.select("key", F.col("blocks").alias("parts"))  # a column of its own: the two sides must not share any
    dealt = asked.join(parts, "key").withColumn("block", F.pmod(F.xxhash64("qid"), F.col("parts")))
    return copies.groupBy("key", "block").cogroup(dealt.groupBy("key", "block")).applyInArrow(run, schema)


def _bounds(most: np.ndarray, centre: np.ndarray, radius: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each root the largest product with q that its tree may hold; infinite where doubles are not exact."""
    point = q.astype(np.float64)
    square = point @ point
    to = np.sqrt(np.maximum(square + most - 2 * (centre @ point), 0))
    near = np.maximum(to - radius * (1 + SLACK) - 1e-6, 0)
    bound = (square + most - near * near) / 2
    bound += SLACK * np.abs(bound) + 4
    return np.where((most < EXACT) & (square < EXACT), bound, np.inf)


def routed(roots: DataFrame, queries: DataFrame, width: int, best_only: bool) -> DataFrame:
    """(qid, q, least, seed, key): the shards that each query has to ask, or of each block of roots the likeliest."""
    schema = "qid long, q array<bigint>, least long, seed long, key long, bound double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left.column("shard").to_numpy()
        most, radius = left.column("most").to_numpy(), left.column("radius").to_numpy()
        centres = matrix(left.column("centre"), width).astype(np.float64)
        rows = []
        for qid, q, least, seed in zip(*(right.column(c).to_pylist() for c in ("qid", "q", "least", "seed"))) if len(keys) and right.num_rows else ():
            bound = _bounds(most, centres, radius, np.array(q, np.int64))
            if best_only:
                some = [int(np.argmax(bound))]
            else:
                some = np.flatnonzero((bound >= (-np.inf if least is None else least)) & (keys != seed))
            rows += [(qid, q, least, seed, int(keys[i]), float(bound[i])) for i in some]
        types = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        columns = list(zip(*rows)) or [[]] * 6
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["qid", "q", "least", "seed", "key", "bound"])

    n = roots.count()
    some = max(1, -(-n // ROOTS))
    in_blocks = roots.withColumnRenamed("key", "shard").withColumn("key", F.pmod(F.xxhash64("shard"), F.lit(some)))
    asked = queries.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(some - 1).cast("long"))))
    return meet(in_blocks, asked, run, schema)


def asked_of(trees: DataFrame, asked: DataFrame, width: int, k: int) -> DataFrame:
    """(qid, score, id): the best rows that each query finds in the shards it asks."""
    element = trees.schema["ids"].dataType.elementType.elementType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[element.simpleString()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            tree = Tree(left, width)
            for qid, q, least in zip(*(right.column(c).to_pylist() for c in ("qid", "q", "least"))):
                rows += [(qid, s, i) for s, i in tree.search(np.array(q, np.int64), k, least)]
        columns = list(zip(*rows)) or [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), arrow))], names=["qid", "score", "id"])

    return meet(trees, asked, run, f"qid long, score long, id {element.simpleString()}")


def best_rows(found: DataFrame, k: int) -> DataFrame:
    """The `k` best rows of each query, with their place."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def search(points: DataFrame, queries: DataFrame, k: int = 5, own: bool = True) -> DataFrame:
    """(query_id, rank, id, score): for every row of `queries` (query_id, v) the best rows of `points` (id, v).

    `v` are arrays of longs. With `own` every query is a row of `points`, too, and is left out of its own answer.
    Ids are longs, integers or texts.
    """
    scratch, wanted = Scratch(points.sparkSession, "metric-tree"), k + own
    longest = max([r[0] or 0 for r in (points.agg(F.max(F.size("v"))).first(), queries.agg(F.max(F.size("v"))).first())])
    width = max(1, longest)
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    # Spark cuts each vector's rows to the first few before the shuffle, so one vector may hold any share of all rows.
    first = Window.partitionBy("v").orderBy(F.asc_nulls_last("id"))
    few = points.select("id", padded.alias("v")).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= wanted)
    different = scratch.keep(few.groupBy("v").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "id"))), lambda r: r["id"]).alias("ids")), "different")
    trees = scratch.keep(grown(sharded(different, width, scratch), width), "pages")
    scratch.drop("different", "dealt")
    roots = scratch.keep(trees.filter("page = 0").select(
        "key", "centre", "most", F.array_max(F.zip_with("apart", "radius", lambda a, r: a + r)).alias("radius")), "roots")

    rows = scratch.keep(queries.select("query_id", padded.alias("v"), F.monotonically_increasing_id().alias("row")), "rows")
    none = F.lit(None).cast("long")
    asking = scratch.keep(rows.select(F.col("v").alias("q")).distinct().select(
        F.monotonically_increasing_id().alias("qid"), "q", none.alias("least"), none.alias("seed")), "asking")
    likeliest = Window.partitionBy("qid").orderBy(F.desc("bound"), "key")
    first_asked = scratch.keep(routed(roots, asking, width, True).withColumn("n", F.row_number().over(likeliest)).filter("n = 1").drop("n", "bound"), "first")
    found = scratch.keep(asked_of(trees, first_asked, width, wanted), "found")
    seen = found.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= wanted, F.min("score")).alias("least"))
    again = first_asked.select("qid", "q", F.col("key").alias("seed")).join(seen, "qid", "left").select("qid", "q", "least", "seed")
    rest = scratch.keep(routed(roots, scratch.keep(again, "again"), width, False).drop("bound"), "rest")
    both = found.unionByName(asked_of(trees, rest, width, wanted))
    answers = rows.join(asking.select("qid", F.col("q").alias("v")), "v").join(best_rows(both, wanted), "qid").select("row", "query_id", "v", "id", "score", "place")
    if own:
        # The query's own row has its id and its square norm; of rows alike in both any one may go.
        rough = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        square = F.when(rough < 2.0**62, F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x))
        mine = F.col("id").eqNullSafe(F.col("query_id")) & F.coalesce(F.col("score") == square, F.col("score") >= 1 << 62)
        alike = Window.partitionBy("row", "mine").orderBy("place")
        answers = answers.withColumn("mine", mine).withColumn("n", F.row_number().over(alike)).filter(~F.col("mine") | (F.col("n") > 1))
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy("place"))).filter(F.col("rank") <= k)
    result = scratch.keep(ranked.select("query_id", "rank", "id", "score"), "result")
    scratch.close("result")
    return result
