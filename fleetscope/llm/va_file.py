"""Centroid clustering over a VA-file: few-bit cells first, vectors on demand.

Vectors are whole numbers, floor(scale * x) of every component. Each component
is compressed to a cell of ``bits`` bits; the borders of a dimension's cells are
approximate quantiles over all vectors, its outermost ones the true extremes.
For a set of centroids, lookup tables per dimension and cell give the least and
the greatest squared difference, so that the cells of a vector bound its
distance to every centroid. A centroid whose interval lies above another's is
ruled out; of those left, the one with the smallest upper bound is compared with
each of the others by a table of differences of distances, which is tighter.

The VA-file is one Parquet table: place, id, cells, vector. The first round and
the last assignment need every vector (its sum, its distance) and read both
columns, taking distances only to centroids that the cells leave possible. The
rounds between read cells alone, and fetch by their place only those vectors
whose intervals overlap or which moved: both assignments, old and new, follow
from a fetched vector, so sums of clusters change by these vectors and nothing
else is kept per vector. What leaves the tasks is a sum per cluster and task.

Vectors of another length, null ones, and ones with a null, NaN or infinite
component are left out. Components are held to +-2^27 (of 64 dimensions), so
that every distance is exact in 64 bits. Rows that repeat an id, a vector or
both are vectors of their own; a null id is ordered after all others when the
first centroids are chosen. Fewer vectors than centroids give that many
centroids, an empty table an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.sinks.storage import Scratch

BITS = 6
_ACCURACY = 1000  # of the quantiles: they shape the cells, no result depends on them
_ROWS = 4096  # that are looked up at once


def whole_vectors(
    table: DataFrame, dims: int, scale: int, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """id and vector (array<bigint>) of the rows that can be clustered."""
    limit = 1 << ((62 - (dims - 1).bit_length()) // 2 - 1)

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    def whole(x: Column) -> Column:
        scaled = F.floor(x * F.lit(float(scale)))
        held = F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(limit))), F.lit(-float(limit)))
        return F.when(F.abs(x) < limit / scale, scaled).otherwise(F.floor(held))

    found = table.select(table[id].alias("id"), table[vector].cast("array<double>").alias("vector"))
    found = found.filter((F.size("vector") == dims) & F.forall("vector", usable))
    return found.select("id", F.transform("vector", whole).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors whose salted ids have the smallest hashes."""
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    smallest = vectors.select(key.alias("key"), "id", "vector").orderBy(
        F.col("key").asc_nulls_last(), F.col("id").asc_nulls_last(), "vector"
    )
    return np.array([row["vector"] for row in smallest.limit(k).collect()], dtype=np.int64)


@dataclass(frozen=True)
class Cells:
    """The cells of every dimension: cell ``c`` of dimension ``d`` holds the
    values from ``low[d, c]`` to ``high[d, c]``."""

    low: np.ndarray
    high: np.ndarray
    bits: int

    @property
    def dims(self) -> int:
        return len(self.low)

    def compress(self, vectors: np.ndarray) -> np.ndarray:
        """The cells of each vector, packed to bytes."""
        cells = np.empty(vectors.shape, dtype=np.uint8)
        for d, low in enumerate(self.low):
            cells[:, d] = np.searchsorted(low[1:], vectors[:, d], "right")
        bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return np.packbits(bits.reshape(len(vectors), -1), axis=1)

    def expand(self, packed: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(packed, axis=1, count=self.dims * self.bits)
        bits = bits.reshape(len(packed), self.dims, self.bits)
        return (bits << np.arange(self.bits - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)


def cut_cells(vectors: DataFrame, dims: int, bits: int) -> Cells:
    """Cells with about equally many values each, over all vectors."""
    count = 1 << bits
    shares = [c / count for c in range(1, count)]
    value = [F.col("vector")[d] for d in range(dims)]
    found = vectors.agg(
        F.array(*(F.min(v) for v in value)).alias("least"),
        F.array(*(F.max(v) for v in value)).alias("most"),
        F.array(*(F.percentile_approx(v, shares, _ACCURACY) for v in value)).alias("borders"),
    ).first()
    above = np.array(found["most"], dtype=np.int64) + 1
    low = np.repeat(above[:, None], count, axis=1)  # cells that hold nothing come last
    for d, least in enumerate(found["least"]):
        starts = np.unique([least, *found["borders"][d]])
        low[d, : len(starts)] = starts
    high = np.append(low[:, 1:], above[:, None], axis=1) - 1
    return Cells(low, high, bits)


class Bounds:
    """Lookup tables from cells to distance intervals, for given centroids."""

    def __init__(self, cells: Cells, centroids: np.ndarray) -> None:
        self.cells, self.centroids = cells, centroids
        at_low = cells.low[:, :, None] - centroids.T[:, None, :]
        at_high = cells.high[:, :, None] - centroids.T[:, None, :]
        outside = np.maximum(np.maximum(at_low, -at_high), 0)
        self.least = outside**2
        low_square, high_square = at_low**2, at_high**2
        self.most = np.maximum(low_square, high_square)
        # a difference of two distances is linear in the component: its extremes
        # lie at the cell's ends
        self.apart = [
            np.maximum(
                low_square[:, :, j, None] - low_square, high_square[:, :, j, None] - high_square
            )
            for j in range(len(centroids))
        ]

    def possible(self, cells: np.ndarray) -> np.ndarray:
        """For every row of cells, which centroids may be the nearest."""
        rows = np.arange(len(cells))
        least = np.zeros((len(cells), len(self.centroids)), dtype=np.int64)
        most = least.copy()
        for d, column in enumerate(cells.T):
            least += self.least[d][column]
            most += self.most[d][column]
        best = most.argmin(axis=1)
        left = least <= most[rows, best][:, None]
        for j in np.unique(best[left.sum(axis=1) > 1]):
            some = np.flatnonzero((best == j) & (left.sum(axis=1) > 1))
            over = np.zeros((len(some), len(self.centroids)), dtype=np.int64)
            for d, column in enumerate(cells[some].T):
                over += self.apart[j][d][column]
            # j is never farther than these; of equal ones the smaller number wins
            ruled_out = (over < 0) | ((over == 0) & (np.arange(over.shape[1]) > j))
            left[some] &= ~ruled_out
        left[rows, best] = True
        return left

    def nearest(self, vectors: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and distance, among the centroids that are left."""
        distances = np.full(left.shape, np.iinfo(np.int64).max)
        for j, centroid in enumerate(self.centroids):
            some = np.flatnonzero(left[:, j])
            distances[some, j] = ((vectors[some] - centroid) ** 2).sum(axis=1)
        cluster = distances.argmin(axis=1)
        return cluster, distances[np.arange(len(cluster)), cluster]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _packed(column: pa.Array, cells: Cells) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return cells.expand(np.frombuffer(joined, dtype=np.uint8).reshape(len(column), -1))


class _Sums:
    """Sums and counts of clusters, as rows (cluster, dim, total); a cluster's
    count has the number after its last dimension."""

    def __init__(self, k: int, dims: int) -> None:
        self.totals = np.zeros((k, dims + 1), dtype=np.int64)

    def add(self, cluster: np.ndarray, vectors: np.ndarray, sign: int = 1) -> None:
        for j in np.unique(cluster):
            some = cluster == j
            self.totals[j, :-1] += sign * vectors[some].sum(axis=0)
            self.totals[j, -1] += sign * int(some.sum())

    def batch(self) -> pa.RecordBatch:
        cluster, dim = np.nonzero(self.totals)
        columns = [cluster.astype(np.int32), dim.astype(np.int32), self.totals[cluster, dim]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "dim", "total"])


_SUMS = "cluster int, dim int, total bigint"


def _collected(sums: DataFrame, k: int, dims: int) -> np.ndarray:
    """All tasks' sums, as exact Python numbers."""
    totals = np.zeros((k, dims + 1), dtype=object)
    exact = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    for row in sums.groupBy("cluster", "dim").agg(exact).collect():
        totals[row["cluster"], row["dim"]] = int(row["total"])
    return totals


class VaFile:
    """A table of vectors and their cells."""

    def __init__(self, vectors: DataFrame, scratch: Scratch, dims: int, bits: int = BITS) -> None:
        self.scratch, self.dims = scratch, dims
        kept = scratch.save(vectors.select(F.monotonically_increasing_id().alias("place"), "id", "vector"))
        self.cells = cells = cut_cells(kept, dims, bits)

        def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                packed = cells.compress(_matrix(batch.column("vector"), dims))
                column = pa.array([row.tobytes() for row in packed], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, column], [*batch.schema.names, "cells"]
                )

        kind = vectors.schema["id"].dataType.simpleString()
        schema = f"place bigint, id {kind}, vector array<bigint>, cells binary"
        self.table = scratch.save(kept.mapInArrow(compress, schema))
        scratch.drop(kept)

    def sums(self, centroids: np.ndarray) -> np.ndarray:
        """Sums and counts of the clusters, over all vectors."""
        cells, dims = self.cells, self.dims

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds, sums = Bounds(cells, centroids), _Sums(len(centroids), dims)
            for batch in _parts(batches):
                vectors = _matrix(batch.column("vector"), dims)
                left = bounds.possible(_packed(batch.column("cells"), cells))
                sums.add(bounds.nearest(vectors, left)[0], vectors)
            yield sums.batch()

        found = self.table.select("cells", "vector").mapInArrow(add, _SUMS)
        return _collected(found, len(centroids), dims)

    def undecided(self, before: np.ndarray, after: np.ndarray) -> DataFrame:
        """Places of the vectors that the cells don't show to have stayed."""
        cells = self.cells

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both = Bounds(cells, before), Bounds(cells, after)
            for batch in _parts(batches):
                packed = _packed(batch.column("cells"), cells)
                old, new = (bounds.possible(packed) for bounds in both)
                stayed = (old == new).all(axis=1) & (old.sum(axis=1) == 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("place").filter(pa.array(~stayed))], ["place"]
                )

        return self.table.select("place", "cells").mapInArrow(look_up, "place bigint")

    def changes(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """How the sums and counts change from one set of centroids to another."""
        cells, dims = self.cells, self.dims
        wanted = self.scratch.save(self.undecided(before, after))
        fetched = self.table.select("place", "cells", "vector").join(wanted, "place", "left_semi")

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = _Sums(len(after), dims)
            both = (-1, Bounds(cells, before)), (1, Bounds(cells, after))
            for batch in _parts(batches):
                packed = _packed(batch.column("cells"), cells)
                vectors = _matrix(batch.column("vector"), dims)
                for sign, bounds in both:
                    cluster, _ = bounds.nearest(vectors, bounds.possible(packed))
                    sums.add(cluster, vectors, sign)
            yield sums.batch()

        changed = _collected(fetched.mapInArrow(add, _SUMS), len(after), dims)
        self.scratch.drop(wanted)
        return changed

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """id, cluster and distance of every vector."""
        cells, dims = self.cells, self.dims

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds = Bounds(cells, centroids)
            for batch in _parts(batches):
                left = bounds.possible(_packed(batch.column("cells"), cells))
                cluster, distance = bounds.nearest(_matrix(batch.column("vector"), dims), left)
                columns = [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

        kind = self.table.schema["id"].dataType.simpleString()
        schema = f"id {kind}, cluster int, distance bigint"
        return self.table.select("id", "cells", "vector").mapInArrow(assign, schema)


def _moved(centroids: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Exact floored means; a centroid without vectors stays."""
    moved = centroids.copy()
    for j, row in enumerate(totals):
        if row[-1]:
            moved[j] = [total // row[-1] for total in row[:-1]]
    return moved


def cluster(
    table: DataFrame,
    scratch: Scratch,
    id: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    scale: int = 64,
    k: int = 16,
    rounds: int = 3,
    salt: str = "1:",
    bits: int = BITS,
) -> tuple[DataFrame, np.ndarray]:
    """(``id``, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every vector that can be clustered, and the last centroids."""
    vectors = whole_vectors(table, dims, scale, id, vector)
    centroids = first_centroids(vectors, k, salt)
    schema = vectors.select(
        F.col("id").alias(id), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"),
        F.lit(0).cast("bigint").alias("cluster_inertia"), F.lit(0).cast("bigint").alias("inertia"),
        F.lit("").alias("centroid_sha256"),
    ).schema
    spark = table.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], schema), centroids
    file = VaFile(vectors, scratch, dims, bits)
    totals, before = None, None
    for _ in range(rounds):
        if totals is None:
            totals = file.sums(centroids)
        else:
            totals = totals + file.changes(before, centroids)
        before, centroids = centroids, _moved(centroids, totals)
    found = scratch.save(file.assigned(centroids))
    scratch.drop(file.table)
    per_cluster = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).cast("bigint").alias("cluster_inertia")
    )
    sums = {row["cluster"]: row["cluster_inertia"] for row in per_cluster.collect()}
    rows = [
        (j, total, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for j, total in sums.items()
    ]
    described = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    joined = found.join(F.broadcast(described), "cluster")  # a row per centroid
    return joined.select(F.col("id").alias(id), *schema.fieldNames()[1:]), centroids
