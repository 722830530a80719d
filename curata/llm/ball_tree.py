"""Centroid clustering with ball trees.

Vectors become integers, so that sums, means and distances are exact and don't depend on the order of rows. Each block of
a partition's vectors gets a metric tree of its own, built once and written: a node holds radius, count and the integer
sum of its vectors. In each round the centroids go to all trees. From the root down, a centroid is dropped for a whole
ball where the triangle inequality shows that another one is nearer to each of its vectors; a ball with one centroid left
is assigned at once by its count and sum; leaves compare their vectors with the centroids that are left, exactly.
Only count and sum of each cluster leave a task, and only one row a cluster and component reaches the driver.

A vector is kept if it has exactly `dims` components, none null or not finite; each component x becomes
floor(scale * x). Ties go to the smaller number of the centroid, an empty cluster keeps its centroid. The first
centroids are the k vectors of the smallest hashes of their ids; of equal ids the smaller vector goes first, vectors
without an id go last. Where there are fewer vectors than k, there are fewer centroids. Repeated vectors and ids are
vectors of their own. Without any vector the result is empty. Further columns are left out. Components beyond 2**27 after
scaling are an error, as squared distances would not fit a bigint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import forget, mapped, quoted, small_batches, written

#: Vectors of a tree and of a leaf at most.
BLOCK, LEAF = 4096, 32
#: Components are smaller than LARGEST; squared distances of LARGEST_DIMS of them stay within a bigint.
LARGEST, LARGEST_DIMS = 1 << 27, 1 << 6
#: Distances of balls are floating numbers: what they may be off by, absolutely and relatively.
OFF, OFF_SHARE = 1e-3, 1e-9


class Tree:
    """Node i holds points[start[i]:end[i]]; first_child[i] and the next one are its children, or it is -1 for a leaf."""

    PARTS = ("start", "end", "first_child", "radius", "sums")

    def __init__(self, points: np.ndarray, **parts: np.ndarray) -> None:
        self.points = points
        for name in self.PARTS:
            setattr(self, name, parts[name])
        self.count = self.end - self.start
        self.center = self.sums / self.count[:, None]

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
        """The tree and the order that its points are in."""
        order = np.arange(len(points))
        start, end, first_child, radius, sums = [0], [len(points)], [-1], [], []
        node = 0
        while node < len(start):
            a, z = start[node], end[node]
            own = points[order[a:z]]
            total = own.sum(0)
            far = _distances(own, total / len(own))
            radius.append(float(far.max()))
            sums.append(total)
            if z - a > leaf and far.max() > 0:
                # two poles: the point farthest from the center, and the one farthest from that; each point to the nearer
                near_one = _distances(own, own[far.argmax()])
                near_other = _distances(own, own[near_one.argmax()])
                first = near_one < near_other
                if 0 < first.sum() < len(own):
                    cut = a + int(first.sum())
                    order[a:z] = np.concatenate([order[a:z][first], order[a:z][~first]])
                    first_child[node] = len(start)
                    start += [a, cut]
                    end += [cut, z]
                    first_child += [-1, -1]
            node += 1
        parts = {"start": np.array(start), "end": np.array(end), "first_child": np.array(first_child), "radius": np.array(radius), "sums": np.array(sums)}
        return cls(points[order], **parts), order

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The balls that one centroid takes whole, as nodes and their centroids; and a centroid for each point of
        leaves that descend to their points, -1 for the other points."""
        of_point = np.full(len(self.points), -1, np.int64)
        whole, whole_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        nodes, left = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
        as_float = centroids.astype(float)
        while len(nodes):
            far = np.sqrt(((self.center[nodes][:, None, :] - as_float) ** 2).sum(2))
            nearest = np.where(left, far, np.inf).min(1, keepdims=True)
            radius = self.radius[nodes][:, None]
            # farther than the nearest by more than the ball's width: another one is nearer to each of its points
            left = left & (far - nearest <= 2 * radius + OFF + OFF_SHARE * (far + nearest + radius))
            alone = left.sum(1) == 1
            whole.append(nodes[alone])
            whole_of.append(left[alone].argmax(1))
            nodes, left = nodes[~alone], left[~alone]
            leaf = self.first_child[nodes] < 0
            if leaf.any():
                self._exact(nodes[leaf], left[leaf], centroids, of_point)
            below = self.first_child[nodes[~leaf]]
            nodes, left = np.concatenate([below, below + 1]), np.tile(left[~leaf], (2, 1))
        return np.concatenate(whole), np.concatenate(whole_of), of_point

    def _exact(self, nodes: np.ndarray, left: np.ndarray, centroids: np.ndarray, of_point: np.ndarray) -> None:
        count = self.count[nodes]
        rows = np.repeat(self.start[nodes] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        masks = np.repeat(left, count, 0)
        best = np.full(len(rows), np.iinfo(np.int64).max)
        of = np.zeros(len(rows), np.int64)
        for c, centroid in enumerate(centroids):  # in order, so that ties go to the smaller number
            mine = np.flatnonzero(masks[:, c])
            if len(mine):
                far = squared(self.points[rows[mine]], centroid)
                nearer = far < best[mine]
                best[mine[nearer]] = far[nearer]
                of[mine[nearer]] = c
        of_point[rows] = of

    def totals(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of each cluster's points."""
        nodes, of, of_point = self.assign(centroids)
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        np.add.at(counts, of, self.count[nodes])
        np.add.at(sums, of, self.sums[nodes])
        for c in range(len(centroids)):
            mine = of_point == c
            counts[c] += int(mine.sum())
            sums[c] += self.points[mine].sum(0)
        return counts, sums

    def labels(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid and squared distance of each point."""
        nodes, of, of_point = self.assign(centroids)
        for n, c in zip(nodes.tolist(), of.tolist(), strict=True):
            of_point[self.start[n] : self.end[n]] = c
        return of_point, squared(self.points, centroids[of_point])

    def packed(self) -> bytes:
        return _pack([self.points.astype(np.int32), *(getattr(self, n) for n in self.PARTS)])

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        points, *parts = _unpack(data)
        return cls(points.astype(np.int64), **dict(zip(cls.PARTS, parts, strict=True)))


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2.0).sum(1))


def squared(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    return ((points - to) ** 2).sum(1)


def _pack(arrays: list[np.ndarray]) -> bytes:
    sink = pa.BufferOutputStream()
    for a in arrays:
        pa.ipc.write_tensor(pa.Tensor.from_numpy(np.ascontiguousarray(a)), sink)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> list[np.ndarray]:
    source, out = pa.BufferReader(data), []
    while source.tell() < len(data):
        out.append(pa.ipc.read_tensor(source).to_numpy())
    return out


def _wide(centroids: list[list[int]]) -> np.ndarray:
    return np.array(centroids, np.int64)


def integers(vectors: DataFrame, dims: int, scale: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id (bigint) and point (array of bigint) of the vectors that are kept."""
    own = F.transform(F.col(quoted(vector)), lambda x: x.cast("double"))
    finite = ~F.exists("own", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select(F.col(quoted(vec_id)).cast("bigint").alias("vec_id"), own.alias("own")).where((F.size("own") == dims) & finite)
    fits = F.forall("own", lambda x: F.abs(x * scale) < LARGEST)
    fails = F.raise_error(F.concat(F.lit("a component of vector "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")), F.lit(f" is {LARGEST} or more after scaling")))
    return kept.select("vec_id", F.when(fits, F.transform("own", lambda x: F.floor(x * scale))).otherwise(fails.cast("array<bigint>")).alias("point"))


def _trees(dims: int):
    """Of batches of (vec_id, point): a row for each BLOCK of them, with ids in the tree's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for b in batches:
            while b.num_rows:
                room = BLOCK - sum(w.num_rows for w in waiting)
                waiting.append(b.slice(0, room))
                b = b.slice(min(room, b.num_rows))
                if sum(w.num_rows for w in waiting) == BLOCK:
                    yield made(waiting)
                    waiting = []
        if waiting:
            yield made(waiting)

    def made(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        points = t.column(1).combine_chunks().flatten().to_numpy().reshape(-1, dims)
        tree, order = Tree.build(points)
        ids = pa.array([t.column(0).combine_chunks().take(pa.array(order))], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array([tree.packed()], pa.binary())], names=["ids", "tree"])

    return run


def _rounds(trees: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the means of the vectors nearest to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _wide(centroids)
        for b in batches:
            for data in b.column(0).to_pylist():
                counts, sums = Tree.unpacked(data).totals(now)
                full = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(counts[full], pa.int64()), pa.array(sums[full].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    found = trees.select("tree").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    # a wide sum: that of a bigint's worth of large components would not fit one
    exact = found.select("cluster", "n", F.posexplode("total").alias("k", "part")).groupBy("cluster", "k").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    after = [list(c) for c in centroids]
    for r in exact.collect():  # one row a cluster and component
        after[r["cluster"]][r["k"]] = int(r["part"]) // int(r["n"])
    return after


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3", vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster int, distance bigint: squared, to its centroid), written; and the centroids."""
    if dims > LARGEST_DIMS:
        raise ValueError(f"at most {LARGEST_DIMS} components")
    small_batches(vectors.sparkSession)
    points = integers(vectors, dims, scale, vec_id, vector)
    # bounded by k: a partial top k in each task
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [r["point"] for r in points.orderBy(by_hash.asc_nulls_last(), "point").limit(k).collect()]
    if not centroids:
        return points.selectExpr("vec_id", "0 as cluster", "0L as distance").where("false"), []
    trees = written(mapped(points, _trees(dims), "ids array<bigint>, tree binary"), "ball-trees")
    for _ in range(rounds):
        centroids = _rounds(trees, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _wide(centroids)
        for b in batches:
            for ids, data in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                of, far = Tree.unpacked(data).labels(now)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(of, pa.int32()), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"])

    found = written(trees.mapInArrow(run, "vec_id bigint, cluster int, distance bigint"), "clusters")
    forget(trees)
    return found, centroids


def described(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """found, plus cluster_inertia and inertia (bigint: distances summed over the cluster and over all) and
    centroid_sha256 (of its components in decimal, joined by a comma)."""
    names = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    named = found.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")
    # one row a centroid
    by_cluster = sums.crossJoin(total).join(F.broadcast(named), "cluster")
    return found.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
