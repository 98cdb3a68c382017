"""Approximate nearest neighbours: vantage-point trees per shard.

Rows are spread over shards by a hash of their id, so a vector that many rows share does not meet in one
task. Each shard holds its distinct unit vectors in a vantage-point tree under chord distance (a metric
in which nearer means a larger cosine). A subtree is skipped when the triangle inequality, with the
radius of the k-th best divided by ``factor``, rules it out: factor 1 restores exact search, larger ones
skip more. Every query visits every shard; queries stream through a shard's tree in batches.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part;
vectors are compared with those of their own length only; rows of equal id and vector count once, a row
is never its own neighbour, nor is another row of the same id; ties go to the smaller id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = 5
#: Measured recall against brute force at this factor: see README.
FACTOR = 1.15
LEAF = 192
SHARD_ROWS = 1 << 16
SLACK = 1e-9


#: Cosines and directions that agree to so many digits are ties.
DIGITS = 12
#: Squared chords below this are computed from the difference of the vectors.
NEAR = 1e-4
#: A distance and a row in one number, to sort by both.
DISTANCE_BITS, ROW_BITS = 40, 21


class Tree:
    """Vantage-point tree over the rows of ``points`` (distinct unit vectors)."""

    def __init__(self, points: np.ndarray, factor: float = 1.0, leaf: int = LEAF, seed: int = 7):
        self.points, self.factor, self.leaf = points, factor, leaf
        rng = np.random.default_rng(seed)
        self.nodes: list[tuple] = []  # (rows of a leaf,) or (vantage row, radius, inner, outer)
        pending = [(np.arange(len(points)), None, None)]
        while pending:
            rows, parent, side = pending.pop()
            at = len(self.nodes)
            if parent is not None:
                self.nodes[parent][side] = at
            if len(rows) <= leaf:
                self.nodes.append([rows])
                continue
            vantage = int(rows[rng.integers(len(rows))])
            rest = rows[rows != vantage]
            far = self._distance(points[rest], points[vantage][None])[:, 0]
            radius = float(np.median(far))
            inner = far <= radius
            if inner.all():  # all at one distance: nothing to split
                self.nodes.append([rows])
                continue
            self.nodes.append([vantage, radius, None, None])
            pending.append((rest[inner], at, 2))
            pending.append((rest[~inner], at, 3))

    @staticmethod
    def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Chords; those of near directions from their difference, as the cosine has no digits for them."""
        squares = np.maximum(0.0, 2.0 - 2.0 * (a @ b.T))
        i, j = np.nonzero(squares < NEAR)
        for at in range(0, len(i), 4096):
            x, y = i[at:at + 4096], j[at:at + 4096]
            squares[x, y] = ((a[x] - b[y]) ** 2).sum(axis=1)
        return np.sqrt(squares)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, chord distances), n x k, of the k nearest; row -1 where there are fewer. Of equal distances
        (to about 1e-12) the smaller rows come first."""
        n = len(queries)
        best, rows = np.full((n, k), np.inf), np.full((n, k), -1, np.int64)
        keys = np.full((n, k), np.iinfo(np.int64).max)

        def offer(active, candidates, distance):
            key = np.round(distance * (1 << DISTANCE_BITS)).astype(np.int64) << ROW_BITS | candidates
            d = np.concatenate((best[active], distance), axis=1)
            r = np.concatenate((rows[active], np.broadcast_to(candidates, distance.shape)), axis=1)
            key = np.concatenate((keys[active], key), axis=1)
            if d.shape[1] > 4 * k:
                part = np.argpartition(key, 2 * k, axis=1)[:, :2 * k]
                d, r, key = (np.take_along_axis(x, part, 1) for x in (d, r, key))
            order = np.argsort(key, axis=1, kind="stable")[:, :k]
            best[active], rows[active], keys[active] = (np.take_along_axis(x, order, 1) for x in (d, r, key))

        def reach(active):
            return best[active, -1] / self.factor + SLACK

        # entries: (node, queries, bound): a query is dropped when its reach has shrunk below its bound
        stack = [(0, np.arange(n), np.zeros(n))] if len(self.points) else []
        while stack:
            at, active, bound = stack.pop()
            active = active[bound <= reach(active)]
            if not len(active):
                continue
            node = self.nodes[at]
            if len(node) == 1:
                offer(active, node[0], self._distance(queries[active], self.points[node[0]]))
                continue
            vantage, radius, inner, outer = node
            far = self._distance(queries[active], self.points[vantage][None])
            offer(active, np.array([vantage]), far)
            gap = far[:, 0] - radius
            inside = gap <= 0
            # the nearer side first, so that the other is tested against a shrunk reach
            for side, own in ((outer, inside), (inner, ~inside)):
                stack.append((side, active[own], np.abs(gap[own])))
            for side, own in ((inner, inside), (outer, ~inside)):
                stack.append((side, active[own], np.zeros(int(own.sum()))))
        return rows, best


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the same for the same pair wherever it is computed."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


class Shard:
    """Distinct directions of one length, the smallest ids of each with their vectors, and the tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, factor: float, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        units = _unit(vectors)
        _, first, group = np.unique(np.round(units, DIGITS) + 0.0, axis=0, return_index=True, return_inverse=True)
        by_id = np.argsort(first, kind="stable")  # rows of the tree in order of their smallest id
        place = np.empty_like(by_id)
        place[by_id] = np.arange(len(by_id))
        group = place[group.ravel()]
        members = np.argsort(group, kind="stable")
        sizes = np.bincount(group)
        starts = np.cumsum(sizes) - sizes
        # of one direction only the k + 1 smallest ids can be an answer; an id may have several vectors
        self.ids, self.vectors = [], []
        for s, n in zip(starts, sizes):
            mine = members[s:s + n]
            chosen = mine[np.unique(ids[mine], return_index=True)[1][:k + 1]]
            self.ids.append(ids[chosen])
            self.vectors.append(vectors[chosen])
        self.k, self.tree = k, Tree(units[first[by_id]], factor, leaf)

    def answer(self, query_ids: np.ndarray, queries: np.ndarray) -> pd.DataFrame:
        rows, _ = self.tree.search(_unit(queries), self.k + 1)
        out = []
        for i, found in enumerate(rows):
            found = found[found >= 0]
            if len(found):
                ids = np.concatenate([self.ids[f] for f in found])
                near = np.concatenate([self.vectors[f] for f in found])
                score = cosines(near, np.broadcast_to(queries[i], near.shape))
                own = ids != query_ids[i]
                ids, score = ids[own], score[own]
                order = np.lexsort((ids, -np.round(score, DIGITS)))[:self.k]
                out += [(int(query_ids[i]), int(ids[j]), float(score[j])) for j in order]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def valid_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    v = F.col(vector_column).cast("array<double>")
    big = float(np.finfo(np.float64).max)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(big)))
    return (vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite.cast("boolean"))
            .where(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def nearest(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
            every: int = 50, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for each row whose id is divisible by
    ``every``. Shards hold about ``shard_rows`` rows at most; at least one per shuffle partition."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_column, vector_column)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vectors.count() // shard_rows))
    stored_rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = (stored_rows.select("shard", "dim", F.lit(0).alias("kind"), "vec_id", "v")
            .unionByName(queries.select(F.col("shard").cast("int"), "dim", F.lit(1).alias("kind"), "vec_id", "v")))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key, shard = [], None, None
        for batch in batches:
            for now, part in batch.groupby(["shard", "dim", "kind"], sort=True):
                if now[:2] != key:
                    held, key, shard = [], now[:2], None
                if now[2] == 0:
                    held.append((part["vec_id"].to_numpy(), _matrix(part["v"])))
                    continue
                if shard is None and held:
                    shard = Shard(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]),
                                  k, factor)
                    held = []
                if shard is not None:
                    yield shard.answer(part["vec_id"].to_numpy(), _matrix(part["v"]))

    found = (both.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "dim", "kind", "vec_id")
             .mapInPandas(search, T.StructType([
                 T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                 T.StructField("score", T.DoubleType())])))
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", DIGITS)), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
