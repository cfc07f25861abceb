"""Approximate nearest neighbours by a forest of random-projection trees (operator 6).

Each tree halves the space again and again: a node's hyperplane is the difference of two random sample points in it,
its threshold the median of their projections. The trees are fitted on a bounded sample of ``SAMPLE`` vectors and every
vector is indexed: it goes down each tree to one leaf. A query keeps one priority queue over all trees, of nodes by
how far beyond hyperplanes they lie, and takes leaves from it until those hold ``share`` of all rows, counted with
repetition. Unless it is given, the share is measured: the smallest one at which ``RECALL`` of the nearest sample
vectors of sample vectors are found. All rows lie closer together than the sample, so their neighbours are found as
well or better. Leaves meet their queries by a shuffle on (tree, leaf), where exact cosines rank the candidates.

The depth follows the number of rows, so that leaves hold about ``LEAF`` of them, up to what the sample can split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.llm._shared import arrow_limits, cut
from candlewright.llm._vectors import compared, cosines, matrix, unit, usable

SAMPLE, LEAF, TREES = 20_000, 512, 8
#: Sample points that a node needs to be split.
LEAST = 4
#: Rows of a leaf that are held at once; larger leaves are dealt out in parts, each of which meets all its queries.
PART = 4096
#: What part of the nearest ones a search should find, and how many sample vectors measure that.
RECALL, PROBES = 0.95, 192
#: How many times as many rows a query looks at next that has not found enough keys.
FURTHER = 8
#: Candidates that each query gets at least, if there are as many.
AT_LEAST = 4096


class Forest:
    """Hyperplanes of all trees, by node in level order; all trees have the same depth."""

    def __init__(self, sample: np.ndarray, rows: int, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> None:
        sample = unit(sample) if len(sample) else sample
        self.size = sample.shape[1]
        possible = int(np.log2(max(1, len(sample) // LEAST)))
        self.depth = max(0, min(possible, int(np.ceil(np.log2(max(1, rows / leaf))))))
        self.trees, inner = trees, (1 << self.depth) - 1
        self.normals = np.zeros((trees, inner, self.size))
        self.thresholds = np.zeros((trees, inner))
        rng = np.random.default_rng(seed)
        for t in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                own = members.pop(node)
                normal = rng.normal(size=self.size)
                if len(own) > 1:
                    i, j = rng.choice(own, 2, replace=False)
                    if np.any(sample[i] != sample[j]):
                        normal = sample[i] - sample[j]
                normal /= np.sqrt((normal * normal).sum())
                along = sample[own] @ normal
                self.normals[t, node], self.thresholds[t, node] = normal, np.median(along) if len(own) else 0.0
                above = along > self.thresholds[t, node]
                members[2 * node + 1], members[2 * node + 2] = own[~above], own[above]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree. Vectors go one by one through the same sums, so copies stay together."""
        x = unit(x)
        out = np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                along = (x * self.normals[t, node]).sum(1)
                node = 2 * node + 1 + (along > self.thresholds[t, node])
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def visits(self, x: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) of all leaves that hold rows, in the order of the shared queue; counts by tree, leaf.

        A query's counts are without the rows of its own key, which are no candidates of it.
        """
        inner = (1 << self.depth) - 1
        x = unit(x[None])[0]
        margins = (self.normals @ x - self.thresholds) if inner else np.zeros((self.trees, 0))
        queue = [(0.0, t, 0) for t in range(self.trees)]
        while queue:
            beyond, t, node = heapq.heappop(queue)
            while node < inner:
                m = margins[t, node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (max(beyond, abs(m)), t, 4 * node + 3 - near))
                node = near
            if counts[t, node - inner]:
                yield t, node - inner

    def search(self, x: np.ndarray, counts: np.ndarray, budget: int) -> list[tuple[int, int]]:
        """The first leaves of the queue, until they hold ``budget`` rows."""
        found, held = [], 0
        for t, leaf in self.visits(x, counts):
            if held >= budget:
                break
            found.append((t, leaf))
            held += int(counts[t, leaf])
        return found

    def budget_for(self, sample: np.ndarray, counts: np.ndarray, k: int, recall: float = RECALL, probes: int = PROBES) -> int:
        """Rows that a search must look at to find ``recall`` of the ``k`` nearest sample vectors of sample vectors."""
        if len(sample) < 2:
            return 0
        x, leaves = unit(sample), self.leaves(sample)
        needed = []
        for i in np.unique(np.linspace(0, len(x) - 1, probes).astype(int)):
            along = x @ x[i]
            along[i] = -np.inf
            near = np.argpartition(-along, min(k, len(x) - 1) - 1)[: min(k, len(x) - 1)]
            wanted: dict[tuple[int, int], set[int]] = {}
            for j in near:
                for t in range(self.trees):
                    wanted.setdefault((t, int(leaves[j, t])), set()).add(int(j))
            left, held = set(near.tolist()), 0
            for place in self.visits(sample[i], counts):
                for j in wanted.get(place, set()) & left:
                    needed.append(held + 1)
                    left.discard(j)
                if not left:
                    break
                held += int(counts[place])
        return sorted(needed)[int(np.ceil(recall * len(needed))) - 1]


def nearest(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", share: float | None = None, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest found rows by cosine, ties to smaller keys.

    Null keys and unusable vectors (null, zero, with null or non-finite components) take no part, as query or candidate.
    Vectors of one size are compared with each other, in a forest of their own, in the precision of their column. Rows that share a key are one candidate, whose score is that of its best vector, and
    a query's own key is none; a query key with several vectors asks by the smallest. A query with fewer than ``k``
    candidates gets them all. ``share`` of all different rows, counted with repetition over trees and without those of the
    query's own key, are looked at for each query, ``AT_LEAST`` of them at least; None measures the share on the sample. A query that
    found fewer than ``k`` keys, since few keys fill its leaves, goes on in its queue, ``FURTHER`` times as far each time.
    """
    spark = arrow_limits(df.sparkSession)
    good = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), compared(df, vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    # Repeated rows are one row from here on: they must not fill leaves, the budget or the places of a query.
    different = good.groupBy("id", "v").agg(F.max("q").alias("q"))
    good, _ = cut(different.withColumn("h", F.xxhash64("id", "v")), "vectors")
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for size, rows in sorted(good.groupBy(F.size("v")).count().collect()):
        found = found.unionAll(_found(good.where(F.size("v") == size), size, rows, k, share, trees, leaf, sample))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(good: DataFrame, size: int, rows: int, k: int, share: float | None, trees: int, leaf: int, sample: int) -> DataFrame:
    """(query_id, vec_id, score) of the best of each leaf; good has ``rows`` different rows of one size: id, v, q, h."""
    spark = good.sparkSession
    grain = 1 << 24
    picked = good.where(F.pmod("h", F.lit(grain)) < min(1.0, sample / max(rows, 1)) * grain).select("id", "v").orderBy("id", "v").toArrow()
    points = matrix(picked.column("v"), size)
    forest = Forest(points, rows, trees, leaf)
    shared = spark.sparkContext.broadcast(forest)  # at most trees * sample / LEAST hyperplanes

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((trees, 1 << shared.value.depth), np.int64)
        for batch in batches:
            for t, own in enumerate(shared.value.leaves(matrix(batch.column("v"), size)).T):
                found[t] += np.bincount(own, minlength=found.shape[1])
        t, own = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(own), pa.array(found[t, own])], names=["tree", "leaf", "n"])

    counts = np.zeros((trees, 1 << forest.depth), np.int64)
    totals = good.select("v").mapInArrow(tally, "tree long, leaf long, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).toArrow()
    counts[totals.column("tree").to_numpy(), totals.column("leaf").to_numpy()] = totals.column("n").to_numpy()
    parts = spark.sparkContext.broadcast(-(-counts // PART))  # as many numbers as the forest has leaves
    looked_at = forest.budget_for(points, counts, k) if share is None else int(share * rows)
    leaf_counts = spark.sparkContext.broadcast(counts)
    names = ["tree", "leaf", "part", "query", "id", "v"]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value.leaves(matrix(batch.column("v"), size)) + np.arange(trees) * (1 << shared.value.depth)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("id").to_numpy(), trees)), pa.array(own.reshape(-1))], names=["id", "place"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                mix = some.column("h").to_numpy() >> 33
                for t, own in enumerate(shared.value.leaves(matrix(some.column("v"), size)).T):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mix), t)), pa.array(own), pa.array(mix % parts.value[t, own]), pa.array(np.zeros(len(mix), bool)), some.column("id"), some.column("v")], names=names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, budget = matrix(batch.column("v"), size), batch.column("budget").to_numpy()
            for i, mine in enumerate(batch.column("own")):
                held = leaf_counts.value
                if mine.is_valid:
                    held = held.copy()
                    held.reshape(-1)[mine.values.field("place").to_numpy()] -= mine.values.field("n").to_numpy()
                t, own = np.array(shared.value.search(x[i], held, budget[i]), np.int64).reshape(-1, 2).T
                n = parts.value[t, own]
                t, own, part = np.repeat(t, n), np.repeat(own, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                one = np.full(len(t), i)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(own), pa.array(part), pa.array(np.ones(len(t), bool)), batch.column("id").take(pa.array(one)), batch.column("v").take(pa.array(one))], names=names)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, held = None, np.zeros(0, np.int64), np.zeros((0, size))
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in names[:3]], axis=1)
            query = batch.column("query").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero(np.any(place[1:] != place[:-1], axis=1) | (query[1:] != query[:-1])) + 1
            all_ids, x = batch.column("id").to_numpy(), matrix(batch.column("v"), size)
            out: list[tuple[np.ndarray, ...]] = []
            for lo, hi in zip([0, *edge], [*edge, len(query)], strict=True):
                if hi == lo:
                    continue
                if tuple(place[lo]) != at:
                    at, ids, held = tuple(place[lo]), np.zeros(0, np.int64), np.zeros((0, size))
                if not query[lo]:
                    ids, held = np.append(ids, all_ids[lo:hi]), np.concatenate([held, x[lo:hi]])
                elif len(ids):
                    for b in range(lo, hi, 256):
                        out.extend(_best(all_ids[b : min(b + 256, hi)], x[b : min(b + 256, hi)], ids, held, k))
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "vec_id", "score"])

    layout = f"tree long, leaf long, part long, query boolean, id long, v {good.schema['v'].dataType.simpleString()}"
    queries = good.where("q").groupBy("id").agg(F.min("v").alias("v"))
    # Where the rows of query keys with several of them lie: as many numbers a key as it has rows, or as there are leaves.
    several = good.groupBy("id").agg(F.count("*").alias("n"), F.max("q").alias("q")).where("q AND n > 1").select("id")
    crowded = good.select("id", "v").join(several, "id", "left_semi").mapInArrow(places, "id long, place long").groupBy("id", "place").agg(F.count("*").alias("n"))
    queries = queries.join(crowded.groupBy("id").agg(F.collect_list(F.struct("place", "n")).alias("own")), "id", "left")
    queries, _ = cut(queries.select("id", "v", "own"), "queries")

    def answers(asking: DataFrame) -> DataFrame:
        met = good.select("id", "v", "h").mapInArrow(index, layout).unionAll(asking.mapInArrow(ask, layout)).repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part", "query")
        return cut(met.mapInArrow(rank, "query_id long, vec_id long, score double"), "found")[0]

    budget = max(AT_LEAST, looked_at)
    out, keys = None, None
    asking = queries
    while True:
        found = answers(asking.withColumn("budget", F.lit(budget).cast("long")))
        if budget >= rows * trees:
            break
        # Of few keys there may be no more to find; how many there are matters only below ``k``.
        keys = keys or good.select("id").distinct().limit(k + 1).count()
        enough = found.groupBy(F.col("query_id").alias("id")).agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= min(k, keys - 1))
        asking, _ = cut(asking.drop("budget").join(enough, "id", "left_anti"), "queries")
        if asking.isEmpty():
            break
        done = found.join(asking.select(F.col("id").alias("query_id")), "query_id", "left_anti")
        out, budget = done if out is None else out.unionAll(done), budget * FURTHER
    return found if out is None else out.unionAll(found)


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, held: np.ndarray, k: int) -> list[tuple[np.ndarray, ...]]:
    """The ``k`` best of some keys for each query, each by its best row: a product finds who may be, exact cosines decide."""
    rough = unit(queries) @ unit(held).T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    out = []
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
    of_key = rough if len(first) == len(ids) else np.maximum.reduceat(rough[:, order], first, axis=1)
    bar = np.partition(of_key, -min(k, len(first)), axis=1)[:, -min(k, len(first))] - 1e-9
    for i, q in enumerate(query_ids):
        may = np.flatnonzero((rough[i] >= bar[i]) & np.isfinite(rough[i]))
        exact = cosines(np.broadcast_to(queries[i], (len(may), queries.shape[1])), held[may])
        ranked = np.lexsort((ids[may], -exact))
        best = ranked[np.sort(np.unique(ids[may][ranked], return_index=True)[1])[:k]]
        out.append((np.full(len(best), q), ids[may[best]], exact[best]))
    return out
