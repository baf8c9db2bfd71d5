"""Integer k-means with Elkan's bounds: exact distances and ties, and few of them computed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, remove, shared_dir

#: Components of a vector, steps a unit, clusters, rounds of assignment and update.
DIMENSIONS, SCALE, CLUSTERS, ROUNDS = 64, 256, 40, 5
#: Components go no further from 0 than this, so squared distances fit 64 bits: 524,288 before scaling.
LARGEST = 1 << 27
#: Vectors whose distances are worked out at once in a task.
PIECE = 1024
#: Below this all products and sums of a distance are exact in doubles.
_DOUBLE = 1 << 22


def kept(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector has all its components, none null or non-finite."""
    x = F.col(column)
    good = (F.size(x) == DIMENSIONS) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return embeddings.where(F.coalesce(good, F.lit(False)))


def quantised(flat: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of doubles, a row a vector."""
    return np.clip(np.floor(flat.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64).reshape(-1, DIMENSIONS)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of a and b, pair by pair."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def squared_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of a to every row of b."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < _DOUBLE:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)).astype(np.int64)
    return np.stack([squared(a, np.broadcast_to(c, a.shape)) for c in b], axis=1)


def below(x: np.ndarray) -> np.ndarray:
    """Singles that are at most x, two steps off so that the root's and the cast's rounding are covered."""
    return np.maximum(np.nextafter(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(-np.inf)), np.float32(0))


def above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x.astype(np.float32), np.float32(np.inf)), np.float32(np.inf))


class Bounds:
    """What is cached of a batch of vectors: cluster, an upper bound of its distance and a lower one of each centroid's."""

    def __init__(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.vectors, self.cluster, self.upper, self.lower = vectors, cluster, upper, lower
        self.computed = 0

    @classmethod
    def first(cls, vectors: np.ndarray, centroids: np.ndarray) -> Bounds:
        d = squared_all(vectors, centroids)
        cluster = d.argmin(axis=1)  # the smaller number of equally near ones
        root = np.sqrt(d.astype(np.float64))
        made = cls(vectors, cluster.astype(np.int32), above(root[np.arange(len(d)), cluster]), below(root))
        made.computed = d.size
        return made

    def move(self, moved: np.ndarray) -> None:
        """Loosens the bounds by how far each centroid went."""
        self.lower = below(np.maximum(self.lower.astype(np.float64) - moved, 0))
        self.upper = above(self.upper.astype(np.float64) + moved[self.cluster])

    def assign(self, centroids: np.ndarray) -> None:
        """The nearest centroid of each vector, ties to the smaller number.

        A centroid is left out only if it's strictly further than the cluster's own by the bounds: by half the distance
        of the two centroids, or by its own lower bound. All others are compared in exact integers.
        """
        half = below(np.sqrt(squared_all(centroids, centroids).astype(np.float64)) / 2)
        np.fill_diagonal(half, np.inf)
        open_ = np.flatnonzero(self.upper >= half.min(axis=1)[self.cluster]) if len(centroids) > 1 else np.arange(0)
        for at in range(0, len(open_), PIECE):
            self._compare(open_[at : at + PIECE], centroids, half)

    def _compare(self, rows: np.ndarray, centroids: np.ndarray, half: np.ndarray) -> None:
        def near(r: np.ndarray) -> np.ndarray:
            found = (self.upper[r, None] >= self.lower[r]) & (self.upper[r, None] >= half[self.cluster[r]])
            found[np.arange(len(r)), self.cluster[r]] = False
            return found

        rows = rows[near(rows).any(axis=1)]
        if not len(rows):
            return
        own = squared(self.vectors[rows], centroids[self.cluster[rows]])
        root = np.sqrt(own.astype(np.float64))
        self.upper[rows] = above(root)
        self.lower[rows, self.cluster[rows]] = below(root)
        which, other = np.nonzero(near(rows))
        found = squared(self.vectors[rows[which]], centroids[other])
        self.lower[rows[which], other] = below(np.sqrt(found.astype(np.float64)))
        self.computed += len(rows) + len(which)
        best, name = own.copy(), self.cluster[rows].astype(np.int64)
        # every candidate in order of row, distance and number: the first of a row is its best other one
        order = np.lexsort((other, found, which))
        first = order[np.r_[True, which[order][1:] != which[order][:-1]]] if len(order) else order
        w, d, c = which[first], found[first], other[first]
        wins = (d < best[w]) | ((d == best[w]) & (c < name[w]))
        best[w[wins]], name[w[wins]] = d[wins], c[wins]
        self.cluster[rows] = name
        self.upper[rows] = above(np.sqrt(best.astype(np.float64)))


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("v").to_pylist()), np.int32).astype(np.int64).reshape(-1, DIMENSIONS) if "v" in batch.schema.names else quantised(batch.column("embedding").flatten().to_numpy(zero_copy_only=False))


def _packed(a: np.ndarray) -> pa.Array:
    """Each row of a as one binary value."""
    width = a.shape[1] * a.dtype.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(a), [None, pa.py_buffer(np.ascontiguousarray(a).tobytes())]).cast(pa.binary())


_STATE = "vec_id long, v binary, cluster int, upper float, lower binary"


def _rounded(state: DataFrame, centroids: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """The state after one more assignment. Without ``moved``, state holds the vectors as they came."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch)
            if moved is None:
                b = Bounds.first(v, centroids)
            else:
                lower = np.frombuffer(b"".join(batch.column("lower").to_pylist()), np.float32).reshape(-1, k)
                b = Bounds(v, batch.column("cluster").to_numpy().copy(), batch.column("upper").to_numpy().copy(), lower.copy())
                b.move(moved)
                b.assign(centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _packed(v.astype(np.int32)), pa.array(b.cluster), pa.array(b.upper), _packed(b.lower)], ["vec_id", "v", "cluster", "upper", "lower"])

    return state.mapInArrow(run, _STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after an update; one row of sums for each cluster and task is shuffled, k * DIMENSIONS sums reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            np.add.at(total, cluster, _vectors(batch))
            count += np.bincount(cluster, minlength=len(count))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at]), pa.array(total[at].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = state.select("v", "cluster").mapInArrow(sums, "cluster int, n long, total array<bigint>")
    whole = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(DIMENSIONS)])
    new = centroids.copy()
    for r in whole.collect():
        new[r["cluster"]] = [int(r[f"t{i}"]) // r["n"] for i in range(DIMENSIONS)]
    return new


def first_centroids(vectors: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The k kept vectors whose ids hash lowest, ties by components; fewer if there are fewer. Null ids don't count."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id IS NOT NULL").orderBy(order, "embedding").limit(k).collect()
    return quantised(np.array([r["embedding"] for r in rows], np.float64).reshape(-1)) if rows else np.zeros((0, DIMENSIONS), np.int64)


def clusters(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (its final components) of every kept vector.

    Vectors that lack components or have null or non-finite ones are left out; repeated vectors and ids are assigned
    each; vectors with a null id are assigned but never start a centroid. With fewer than k such there are fewer
    clusters; with none, or an empty table, no rows. Other columns don't count. Components beyond LARGEST are taken as
    LARGEST.

    Each round's state (vector, cluster, bounds) is written to the shared folder and the one before deleted, so at most
    two are there; the driver holds k centroids.
    """
    spark = embeddings.sparkSession
    vectors = kept(embeddings).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = first_centroids(vectors, k)
    if not len(centroids):
        return vectors.where("false").select("vec_id", *[F.lit(0).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))], F.array().cast("array<bigint>").alias("centroid"))
    folder, state, moved = f"{shared_dir(spark)}/clusters-{uuid.uuid4().hex}", vectors, None
    for r in range(rounds):
        _rounded(state, centroids, moved).write.parquet(f"{folder}/{r}")
        if r:
            remove(spark, f"{folder}/{r - 1}")
        state = spark.read.parquet(f"{folder}/{r}")
        new = _means(state, centroids)
        moved = above(np.sqrt(squared(new, centroids).astype(np.float64))).astype(np.float64)
        centroids = new
    last = _rounded(state, centroids, moved) if rounds else _rounded(state, centroids, None)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), cluster, pa.array(squared(_vectors(batch), centroids[cluster.to_numpy()]))], ["vec_id", "cluster", "distance"])

    final = cut(last.mapInArrow(measured, "vec_id long, cluster int, distance long"))
    remove(spark, folder)
    inertia = {r["cluster"]: r["n"] for r in final.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    sums = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    middle = F.array(*[F.array(*[F.lit(x).cast("long") for x in c]) for c in centroids.tolist()])
    return final.select("vec_id", "cluster", "distance", sums[F.col("cluster")].alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), middle[F.col("cluster")].alias("centroid"))


def cluster_digests(embeddings: DataFrame) -> DataFrame:
    """As clusters, with the sha256 of the centroid's components in its place."""
    text = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return clusters(embeddings).withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")
