"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue per query.

The trees are fitted on a bounded sample (``SAMPLE`` vectors, those with the smallest hash of their id):
a node sends vectors to its two sides by a random direction (the line through two different vectors of the
sample drawn at random) and the median of the sample on it, or the border next to it that splits them.  Only
copies of one vector make a larger leaf, which counts as a usual one against the budget.  Every
vector is then routed to its leaf in every tree.  A search starts at all roots at once and always opens
the node of any tree that is nearest to the query, until the leaves it reached hold as many vectors as the
budget says.  The vectors of these leaves are ranked by their exact inner product in double precision.

The budget follows from the table: for ``PROBES`` queries (those with the smallest hash of their id) the true
neighbours are found by brute force, and it is what finds ``RECALL`` of them, ``CANDIDATES`` at least.

Largest inner product is turned into smallest distance for the trees alone: vectors get one more
component that gives all the same norm, queries get 0 there.

Vectors are dealt over the executors by shard: the largest subtree with at most ``SHARD`` vectors.  A leaf
with more, such as one that holds copies of one vector, has several parts, each of which the queries of that
leaf visit.  A query comes to a shard once, with the leaves it visits there, and the shard sends on the best
of them.  Broadcast are the nodes and their sizes, whose number is bounded by the sample.

Defined cases: vectors that are null, zero, of another dimension than the first, or hold a null or
non-finite component take no part, neither do null ids; equal scores go to the smaller id; of rows that
repeat an id all vectors are candidates and the best of them counts; a query with fewer candidates than
asked for gets all that were found (all there are, if the table is that small); an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import ranges
from .folders import stored

SAMPLE = 20_000
TREES = 8
LEAF = 24
#: Visits of a query at least.
CANDIDATES = 40_000
#: Queries whose true neighbours set the budget, and the share of these to be found.
PROBES = 200
RECALL = 0.95
NEIGHBOURS = 20
#: Vectors that are searched in one place.
SHARD = 8192
SEED = 17


class Forest(NamedTuple):
    """Nodes of all trees: inner nodes have a direction; the children of a leaf are -1."""

    roots: np.ndarray
    directions: np.ndarray
    borders: np.ndarray
    children: np.ndarray  # two for each node
    norm: float
    copies: np.ndarray | None = None  # leaves of more vectors, all equal

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that gives all of them the largest norm."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        lifted = self.lifted(vectors)
        out = np.empty((len(vectors), len(self.roots)), np.int64)
        for tree, root in enumerate(self.roots):
            open_nodes = [(int(root), np.arange(len(vectors)))]
            while open_nodes:
                node, rows = open_nodes.pop()
                if self.children[node, 0] < 0:
                    out[rows, tree] = node
                elif len(rows):
                    right = lifted[rows] @ self.directions[node] > self.borders[node]
                    open_nodes += [(int(self.children[node, 0]), rows[~right]), (int(self.children[node, 1]), rows[right])]
        return out

    def opened(self, query: np.ndarray) -> Iterator[int]:
        """All leaves for a query, nearest border first."""
        lifted = np.append(query, 0.0)
        margins = self.directions @ lifted - self.borders
        queue = [(0.0, int(root)) for root in self.roots]
        while queue:
            distance, node = heappop(queue)
            left, right = self.children[node].tolist()
            if left < 0:
                yield node
                continue
            margin = float(margins[node])
            beyond = distance + margin**2  # the other side lies behind one more border
            heappush(queue, (beyond if margin > 0 else distance, left))
            heappush(queue, (distance if margin > 0 else beyond, right))

    def counted(self, sizes: np.ndarray) -> np.ndarray:
        """What the leaves count against the budget."""
        return sizes if self.copies is None else np.where(self.copies, np.minimum(sizes, LEAF), sizes)

    def search(self, query: np.ndarray, sizes: np.ndarray, candidates: int) -> list[int]:
        """The leaves to visit for a query, nearest border first."""
        found, held, counted = [], 0, self.counted(sizes)
        for node in self.opened(query) if candidates > 0 else ():
            found.append(node)
            held += int(counted[node])
            if held >= candidates:
                break
        return found

    def visits(self, query: np.ndarray, sizes: np.ndarray, near: np.ndarray) -> np.ndarray:
        """How many vectors a search visits until it finds each of some vectors."""
        order = np.fromiter(self.opened(query), np.int64)
        held = np.zeros(len(self.children), np.int64)
        held[order] = np.cumsum(self.counted(sizes)[order])
        return held[self.leaves(near)].min(axis=1)

    def shards(self, sizes: np.ndarray, limit: int) -> np.ndarray:
        """The shard of each leaf: its highest ancestor with at most ``limit`` vectors, or itself."""
        whole, shard = sizes.copy(), np.arange(len(self.children))
        for node in range(len(self.children) - 1, -1, -1):  # children come behind their parent
            if self.children[node, 0] >= 0:
                whole[node] = whole[self.children[node]].sum()
        for node, pair in enumerate(self.children):
            if pair[0] >= 0 and whole[shard[node]] <= limit:
                shard[pair] = shard[node]
        return shard


def fit(sample: np.ndarray, norm: float, trees: int = TREES, leaf: int = LEAF, seed: int = SEED) -> Forest:
    """Trees over a sample of vectors."""
    random = np.random.default_rng(seed)
    lifted = Forest(None, None, None, None, norm).lifted(sample)
    directions, borders, children, roots, copies = [], [], [], [], []

    def node() -> int:
        directions.append(np.zeros(lifted.shape[1]))
        borders.append(0.0)
        children.append((-1, -1))
        copies.append(False)
        return len(children) - 1

    for _ in range(trees):
        roots.append(node())
        open_nodes = [(roots[-1], np.arange(len(lifted)))]
        while open_nodes:
            own, rows = open_nodes.pop()
            if len(rows) <= leaf:
                continue
            first = lifted[random.choice(rows)]
            others = rows[(lifted[rows] != first).any(axis=1)]
            if not len(others):
                copies[own] = True
                continue
            direction = first - lifted[random.choice(others)]
            direction /= max(np.linalg.norm(direction), 1e-300)
            along = lifted[rows] @ direction
            border = float(np.median(along))
            if border == along.max() > along.min():  # more than half of them lie at the right end
                border = float(along[along < border].max())
            right = along > border
            if not right.any():  # vectors that differ by less than the arithmetic tells apart
                continue
            directions[own], borders[own] = direction, border
            children[own] = node(), node()
            open_nodes += [(children[own][0], rows[~right]), (children[own][1], rows[right])]
    return Forest(np.array(roots), np.array(directions), np.array(borders), np.array(children), norm, np.array(copies))


def _usable(vector: Column, dimension: int | None = None) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    same = F.size(vector) == dimension if dimension is not None else F.size(vector) > 0
    return F.coalesce(same & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def budget(forest: Forest, sizes: np.ndarray, rows: DataFrame, asked: DataFrame, k: int, probes: int = PROBES, recall: float = RECALL) -> int:
    """The visits with which a share of the true neighbours of some queries is found; both tables have ``id`` and ``v``."""
    drawn = asked.orderBy(F.xxhash64("id"), "id").limit(probes).collect()
    if not drawn:
        return 0
    ids, queries = np.array([x["id"] for x in drawn]), np.array([x["v"] for x in drawn], np.float64)
    shared = rows.sparkSession.sparkContext.broadcast((ids, queries))
    names = ["q", "id", "score", "v"]

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, matrix = shared.value
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors, there = _matrix(batch.column("v"), matrix.shape[1]).astype(np.float64), batch.column("id").to_numpy()
            scores = vectors @ matrix.T
            scores[there[:, None] == own] = -np.inf
            places = [_best(scores[:, q], there, k) for q in range(len(own))]
            flat, which = np.concatenate(places), np.repeat(np.arange(len(own)), [len(x) for x in places])
            fresh = (which, there[flat], scores[flat, which], vectors[flat])
            held = fresh if held is None else tuple(np.concatenate(x) for x in zip(held, fresh))
            order = np.lexsort((held[1], -held[2], held[0]))
            rank = np.arange(len(order)) - np.searchsorted(held[0][order], held[0][order])
            held = tuple(x[order[rank < k]] for x in held)
        if held is not None:
            vectors = pa.array(list(held[3]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in held[:3]), vectors], names)

    found = rows.select("id", "v").mapInArrow(best, "q long, id long, score double, v array<double>").where("score > double('-Infinity')")
    top = found.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", "v"))), 1, k).alias("near"))
    # k vectors of each of the probes
    needed = [forest.visits(queries[q], sizes, np.array([x["v"] for x in near])) for q, near in top.collect()]
    return int(np.quantile(np.concatenate(needed), recall, method="higher")) if needed else 0


def nearest(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS,
    candidates: int | None = None, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, shard: int = SHARD,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``df`` found nearest to each row of ``queries``.

    Both tables have the columns ``key`` and ``vector``; a row is no candidate of its own id.  ``candidates``
    are the visits of a query; without it they follow from the table.
    """
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    named = [x.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")) for x in (df, queries)]
    named = [x.where("id IS NOT NULL") for x in named]
    first = named[0].where(_usable(F.col("v"))).select("id", F.size("v").alias("n")).orderBy("id").first()
    if first is None:
        return empty
    dimension = first["n"]
    rows, asked = (x.where(_usable(F.col("v"), dimension)) for x in named)
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    norm = rows.agg(F.sqrt(F.max(squares))).first()[0]
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    forest = fit(np.array([x["v"] for x in chosen]), norm, trees, leaf)
    shared = spark.sparkContext.broadcast(forest)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            leaves = shared.value.leaves(_matrix(batch.column("v"), dimension).astype(np.float64))
            for tree in range(leaves.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(leaves[:, tree]), *batch.columns], ["leaf", "id", "v"])

    # 32-bit components stay 32 bits wide on their way; they are exact in double precision
    narrow = "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"
    slim = rows.select("id", F.col("v").cast(narrow).alias("v"))
    index = stored(slim.mapInArrow(route, f"leaf long, id long, v {narrow}"), "index")
    # one row for each leaf of the forest at most
    sizes = np.zeros(len(forest.children), np.int64)
    for leaf_id, n in index.groupBy("leaf").count().collect():
        sizes[leaf_id] = n
    if candidates is None:
        candidates = CANDIDATES
        if sizes.sum() > candidates:
            candidates = max(candidates, budget(forest, sizes, slim, asked, k))
    shared_sizes = spark.sparkContext.broadcast((sizes, forest.shards(sizes, shard)))
    columns = ["shard", "part", "leaf", "id", "v", "leaves"]

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, homes = shared_sizes.value
        for batch in batches:
            leaves = batch.column("leaf").to_numpy()
            part = batch.column("h").to_numpy() % np.maximum(-(-counts[leaves] // shard), 1)
            none = pa.nulls(len(leaves), pa.list_(pa.int64()))
            home, own = pa.array(homes[leaves]), [batch.column(x) for x in ("leaf", "id", "v")]
            yield pa.RecordBatch.from_arrays([home, pa.array(part), *own, none], columns)

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (counts, homes) = shared.value, shared_sizes.value
        for batch in batches:
            matrix = _matrix(batch.column("v"), dimension).astype(np.float64)
            for at in range(0, batch.num_rows, 256):
                places = []
                for i, q in enumerate(matrix[at : at + 256], at):
                    leaves = np.sort(own.search(q, counts, candidates))
                    for home in np.unique(homes[leaves]):
                        visited = leaves[homes[leaves] == home]
                        # only a shard of one leaf has several parts
                        places += [(i, home, p, visited) for p in range(max(1, -(-int(counts[visited[0]]) // shard)))]
                i, home, part, visited = (list(x) for x in zip(*places))
                taken = batch.take(pa.array(i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home, pa.int64()), pa.array(part, pa.int64()), pa.nulls(len(i), pa.int64()), *taken.columns, pa.array(visited, pa.list_(pa.int64()))],
                    columns,
                )

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, gathered, ready = None, [], None
        for batch in batches:
            home, part, ask = (batch.column(x).to_numpy() for x in ("shard", "part", "ask"))
            ids, matrix = batch.column("id").to_numpy(), _matrix(batch.column("v"), dimension).astype(np.float64)
            cuts = np.flatnonzero((home[1:] != home[:-1]) | (part[1:] != part[:-1]) | (ask[1:] != ask[:-1])) + 1
            out = [[], [], []]
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(home)]):
                if a == b:
                    continue
                if place != (home[a], part[a]):
                    place, gathered, ready = (home[a], part[a]), [], None
                if ask[a] == 0:  # the vectors of a shard come before its queries, in order of their leaves
                    gathered.append((batch.column("leaf").slice(a, b - a).to_numpy(), ids[a:b], matrix[a:b]))
                    continue
                if not gathered:
                    continue
                ready = ready or [np.concatenate(x) for x in zip(*gathered)]
                for q in range(a, b):
                    visited = batch.column("leaves")[q].values.to_numpy()
                    start, end = np.searchsorted(ready[0], visited), np.searchsorted(ready[0], visited, "right")
                    rows = ranges(start, end - start)
                    rows = rows[ready[1][rows] != ids[q]]
                    scores = (ready[2][rows] * matrix[q]).sum(axis=1)
                    best = _best(scores, ready[1][rows], k)
                    out[0].append(ids[q])
                    out[1].append(ready[1][rows][best])
                    out[2].append(scores[best])
            if out[0]:
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["query_id", "ids", "scores"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished() -> pa.RecordBatch:
            ids, scores = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((-scores, ids))  # several trees find the same id; its best vector counts
            order = order[np.append(True, ids[order][1:] != ids[order][:-1])] if len(order) else order
            best = order[_best(scores[order], ids[order], k)]
            rank_of = pa.array(np.arange(1, len(best) + 1, dtype=np.int32))
            query = pa.array(np.full(len(best), own, np.int64))
            return pa.RecordBatch.from_arrays([query, rank_of, pa.array(ids[best]), pa.array(scores[best])], names)

        names, own, held = ["query_id", "rank", "vec_id", "score"], None, []
        for batch in batches:
            queries_of = batch.column("query_id").to_numpy()
            for i, q in enumerate(queries_of.tolist()):
                if q != own and held:
                    yield finished()
                    held = []
                own = q
                held.append((batch.column("ids")[i].values.to_numpy(), batch.column("scores")[i].values.to_numpy()))
        if held:
            yield finished()

    kind = f"shard long, part long, leaf long, id long, v {narrow}, leaves array<bigint>"
    hashed = index.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    held = hashed.mapInArrow(spread, kind).withColumn("ask", F.lit(0))
    probes = asked.select("id", F.col("v").cast(narrow).alias("v")).mapInArrow(probe, kind).withColumn("ask", F.lit(1))
    dealt = held.unionByName(probes).repartition("shard", "part").sortWithinPartitions("shard", "part", "ask", "leaf")
    found = dealt.mapInArrow(rank, "query_id long, ids array<bigint>, scores array<double>")
    ordered = found.repartition("query_id").sortWithinPartitions("query_id")
    return ordered.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
