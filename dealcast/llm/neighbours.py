"""Approximate nearest neighbours by vantage-point trees per shard.

Vectors are dealt to shards by a hash of id and vector; each shard's tree is built where it is
searched. A node splits its vectors at the median distance to a vantage point. By the
triangle inequality a side can hold a nearer vector only if the query's distance to the
shell is at most the distance ``r`` of its k-th best so far; a side is left out when that
gap exceeds ``factor * r``. Factor one is exact; smaller ones prune more.

Largest inner product becomes smallest Euclidean distance by one more coordinate: vectors
get ``sqrt(M*M - |x|**2)`` with the largest norm ``M``, queries get zero. Scores are added up
coordinate by coordinate in double precision on the original vectors.

Tables of vectors and queries are cut into blocks: each task searches at most ``SHARD``
vectors (on average) for at most ``QUERIES`` queries, so neither side is broadcast and a
task's memory is bounded. Shards are searched in rounds, each ``GROWTH`` times as many as all
before. After a round each query's k-th best score so far bounds the next one: shards prune
with it from their root on and return only what reaches it, about ``GROWTH * k`` rows a query
and round however many shards there are. A round's results are merged by a grouped top-k.

Defined cases: null vectors, vectors with null or non-finite components, zero vectors and
rows with a null id take no part; only vectors of a query's own length are candidates;
equal rows count once; several vectors under one id are candidates of their own, and the id
as a query gets the nearest of any of them; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealcast.llm.common import workers_ready, written

K, SHARD, QUERIES, LEAF, GROWTH = 20, 4096, 4096, 64, 16
#: Share of the k-th best distance within which a shell is searched (1: exact).
FACTOR = 1.0


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


class Tree:
    """A vantage-point tree over rows of a matrix with one more coordinate (see above)."""

    def __init__(self, vectors, ids, top, leaf=LEAF):
        import numpy as np
        self.vectors, self.ids, self.leaf = vectors, ids, leaf
        self.rest = np.sqrt(np.maximum(top * top - (vectors * vectors).sum(axis=1), 0.0))
        self.visited = 0
        self.root = self._node(np.arange(len(ids)))

    def _node(self, rows):
        import numpy as np
        if len(rows) <= self.leaf:
            return rows
        point = rows[int(self.ids[rows[0]]) % len(rows)]
        d2 = ((self.vectors[rows] - self.vectors[point]) ** 2).sum(axis=1) + (self.rest[rows] - self.rest[point]) ** 2
        d = np.sqrt(d2)
        edge = float(np.median(d))
        inner = d <= edge
        if inner.all():  # copies of the vantage point
            return rows
        return point, edge, self._node(rows[inner]), self._node(rows[~inner])

    def search(self, queries, own, k, factor, floor=None):
        """Scores and ids of the k best of each query (score -inf: none), largest first.

        Scores under a query's ``floor`` may be left out.
        """
        import numpy as np
        self.k, self.factor = k, factor
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor
        self.queries, self.own = queries, own
        self.norm2 = (queries * queries).sum(axis=1)
        self.top2 = self.rest[0] ** 2 + (self.vectors[0] ** 2).sum()
        self.best = np.full((len(queries), k), -np.inf)
        self.best_id = np.full((len(queries), k), -1, np.int64)
        self._visit(self.root, np.arange(len(queries)))
        return self.best, self.best_id

    def _kth(self, q):
        import numpy as np
        return np.maximum(self.best[q, -1], self.floor[q])

    def _reach(self, q):
        import numpy as np
        kth = self._kth(q)
        d2 = self.norm2[q] + self.top2 - 2 * np.where(np.isinf(kth), 0, kth)
        return np.where(np.isinf(kth), np.inf, np.sqrt(np.maximum(d2, 0)) * self.factor) + 1e-7

    def _visit(self, node, q):
        import numpy as np
        if not len(q):
            return
        if not isinstance(node, tuple):
            self._leaf(node, q)
            return
        point, edge, inner, outer = node
        d = np.sqrt(((self.queries[q] - self.vectors[point]) ** 2).sum(axis=1) + self.rest[point] ** 2)
        near = d <= edge
        self._visit(inner, q[near])
        self._visit(outer, q[~near])
        gap = np.abs(d - edge)
        again = gap <= self._reach(q)
        self._visit(outer, q[near & again])
        self._visit(inner, q[~near & again])

    def _leaf(self, rows, q):
        import numpy as np
        self.visited += len(rows) * len(q)
        part, cols = self.queries[q].T, self.vectors[rows].T
        score = np.zeros((len(q), len(rows)))
        for a, b in zip(part, cols):  # in the order of the coordinates, so that copies tie exactly
            score += a[:, None] * b[None, :]
        score[self.own[q][:, None] == self.ids[rows][None, :]] = -np.inf
        better = (score >= self._kth(q)[:, None]).any(axis=1)
        if not better.any():
            return
        q, score = q[better], score[better]
        every = np.concatenate([self.best[q], score], axis=1)
        ids = np.concatenate([self.best_id[q], np.broadcast_to(self.ids[rows], score.shape)], axis=1)
        order = np.lexsort((ids, -every), axis=1)[:, :self.k]
        self.best[q] = np.take_along_axis(every, order, axis=1)
        self.best_id[q] = np.where(np.isinf(self.best[q]), -1, np.take_along_axis(ids, order, axis=1))


def _matrix(column):
    import numpy as np
    values = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(values.flatten(), np.float64).reshape(len(values), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, shard: int = SHARD) -> DataFrame:
    """vec_id, embedding of both -> query_id, rank, vec_id, score: each query's k nearest."""
    spark = vectors.sparkSession
    workers_ready(spark, 10_000)
    clean = lambda t: t.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")) \
        .where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v")).dropDuplicates(["vec_id", "v"])
    x, q = written(clean(vectors), "ann-vectors"), written(clean(queries), "ann-queries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b))
    size = x.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).first()
    shards = max(1, -(-size["n"] // shard))
    blocks = max(1, -(-q.count() // QUERIES))
    top = float(size["top"] or 0.0)

    def search(mine, theirs):
        import numpy as np
        import pyarrow as pa
        if not mine.num_rows or not theirs.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        tree = Tree(_matrix(mine.column("v")), mine.column("vec_id").to_numpy(), top)
        own, floor = theirs.column("vec_id").to_numpy(), theirs.column("floor").to_numpy()
        best, ids = tree.search(_matrix(theirs.column("v")), own, k, factor, floor)
        hit = ~np.isinf(best) & (best >= floor[:, None])
        return pa.table({"query_id": pa.array(np.repeat(own, hit.sum(axis=1))), "vec_id": pa.array(ids[hit]), "score": pa.array(best[hit])})

    each = lambda lo, hi: F.explode(F.sequence(F.lit(lo), F.lit(hi - 1)))
    left = x.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")).withColumn("block", each(0, blocks))
    keys, order = ["dim", "shard", "block"], Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best, lo = None, 0
    while lo < shards:
        hi = min(shards, max(1, lo * GROWTH))
        if best is None:
            floored = q.withColumn("floor", F.lit(float("-inf")))
        else:
            kth = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
            floored = q.join(kth, "vec_id", "left").withColumn("floor", F.when(F.col("n") >= k, F.col("kth")).otherwise(F.lit(float("-inf"))))
        right = floored.select("vec_id", "v", "dim", "floor", F.pmod(F.xxhash64("vec_id", "v", F.lit(3)), F.lit(blocks)).cast("int").alias("block"), each(lo, hi).alias("shard"))
        mine = left.where(F.col("shard").between(lo, hi - 1))
        found = mine.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ann-best")
        lo = hi
    return best.select("query_id", "rank", "vec_id", "score")
