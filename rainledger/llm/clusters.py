"""Centroid clustering in integers, with distances filtered in rotated coordinates.

Vectors are rotated to the corpus's principal axes once. Of a rotated vector its first ``lead`` coordinates and
the norm of the rest are stored. For a vector v and a centroid c,

    |v - c|^2  >=  |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2

as the rotation keeps lengths and norms obey the triangle inequality. The distance to the centroid of the least
bound is computed in integers; only centroids whose bound does not exceed it can be as near, and those are
verified in integers too. So the filter, in floating point and with some slack, never decides anything.

Each round is one pass over the stored vectors, whose tasks return sums per centroid. The driver holds centroids and the
covariance matrix, whose sizes depend on the number of components alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.llm.common import free_name, stored

LEAD = 48  # rotated coordinates that are stored; the test vectors vary about as much in all directions, others need fewer
SCALE = 256
LARGEST = 1 << 26  # of a component: squared distances of vectors of 64 such then fit 64 bits
SLACK = 1e-9  # of the squared lengths; rotated coordinates are exact to some 1e-13 of them


def integers(vectors: DataFrame, vector_col: str, dims: int, scale: int, name: str) -> DataFrame:
    """``vectors`` of exactly ``dims`` finite components, with ``name``: floor(scale * component) as integers."""
    inner = T.ArrayType(T.DoubleType())
    x = F.col(vector_col).cast(inner)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where((F.size(x) == dims) & finite)
    step = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return kept.withColumn(name, F.transform(step, lambda c: c.cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _moments(vectors: DataFrame, name: str, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(count, mean, covariance) of all vectors, from sums of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            v = _matrix(batch.column(0), dims).astype(float)
            if len(v) and np.abs(v).max() > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST}: distances would not fit 64 bits")
            n, total, products = n + len(v), total + v.sum(axis=0), products + v.T @ v
        rows = np.vstack([total, products])
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array([n] * (dims + 1)), pa.array(list(rows), pa.list_(pa.float64()))], ["row", "n", "sums"])

    parts = vectors.select(name).mapInArrow(run, "row int, n bigint, sums array<double>")
    sums = parts.select("row", "n", F.posexplode("sums").alias("at", "x")).groupBy("row", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    found = sums.collect()  # (dims + 1) * dims numbers
    out = np.zeros((dims + 1, dims))
    for r in found:
        out[r.row, r["at"]] = r.x
    n = found[0].n if found else 0
    mean = out[0] / max(n, 1)
    return n, mean, out[1:] / max(n, 1) - np.outer(mean, mean)


class Rotation(NamedTuple):
    """Coordinates on the principal axes, the axis of the largest variance first."""

    mean: np.ndarray
    axes: np.ndarray

    def of(self, v: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
        """(leading coordinates, norm of the others) of each row."""
        turned = (v - self.mean) @ self.axes
        return turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(axis=1))


def principal_axes(vectors: DataFrame, name: str, dims: int) -> Rotation:
    _, mean, covariance = _moments(vectors, name, dims)
    _, axes = np.linalg.eigh(covariance)
    return Rotation(mean, axes[:, ::-1].copy())


def rotated(vectors: DataFrame, name: str, dims: int, rotation: Rotation, lead: int) -> DataFrame:
    """``vectors`` with ``<name>_lead`` and ``<name>_rest``."""
    names = [*vectors.columns, f"{name}_lead", f"{name}_rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(batch.schema.get_field_index(name)), dims).astype(float)
            first, rest = rotation.of(v, lead)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(first), pa.list_(pa.float64())), pa.array(rest)], names)

    added = [T.StructField(names[-2], T.ArrayType(T.DoubleType())), T.StructField(names[-1], T.DoubleType())]
    return vectors.mapInArrow(run, T.StructType([*vectors.schema.fields, *added]))


def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, the smallest of equals; squared distance; distances computed in integers)."""
    c_lead, c_rest = rotation.of(centroids.astype(float), lead.shape[1])
    bound = (lead**2).sum(axis=1)[:, None] + (c_lead**2).sum(axis=1) - 2 * lead @ c_lead.T + (rest[:, None] - c_rest) ** 2
    slack = SLACK * (1 + (lead**2).sum(axis=1) + rest**2)[:, None] + SLACK * ((c_lead**2).sum(axis=1) + c_rest**2)
    first = bound.argmin(axis=1)
    upper = ((v - centroids[first]) ** 2).sum(axis=1)
    best, distance = first.copy(), upper.copy()
    open_rows, open_cols = np.nonzero((bound <= upper[:, None] + slack) & (np.arange(len(centroids)) != first[:, None]))
    exact = ((v[open_rows] - centroids[open_cols]) ** 2).sum(axis=1)
    order = np.lexsort((open_cols, exact, open_rows))
    head = order[np.flatnonzero(np.diff(open_rows[order], prepend=-1))]  # the nearest survivor of each row
    rows, cols, d = open_rows[head], open_cols[head], exact[head]
    better = (d < distance[rows]) | ((d == distance[rows]) & (cols < best[rows]))
    best[rows[better]], distance[rows[better]] = cols[better], d[better]
    return best, distance, len(v) + len(open_rows)


def _sums(table: DataFrame, name: str, dims: int, centroids: np.ndarray, rotation: Rotation) -> dict[int, tuple[int, list[int]]]:
    """(count, sum of each component) of the vectors nearest to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for batch in batches:
            v, best, _ = _assigned(batch, name, dims, centroids, rotation)
            count += np.bincount(best, minlength=len(centroids))
            np.add.at(total, best, v)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(count[has]), pa.array(list(total[has]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = table.select(name, f"{name}_lead", f"{name}_rest").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    each = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dims)]
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect()  # a row per centroid
    return {r.cluster: (r.n, [r[f"s{i}"] for i in range(dims)]) for r in found}


def _assigned(batch: pa.RecordBatch, name: str, dims: int, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = lambda c: batch.column(batch.schema.get_field_index(c))
    v, first = _matrix(column(name), dims), column(f"{name}_lead")
    lead = _matrix(first, len(first[0]) if len(first) else 1)
    best, distance, _ = nearest(v, lead, column(f"{name}_rest").to_numpy(), centroids, rotation)
    return v, best, distance


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2",
    scale: int = SCALE,
    lead: int = LEAD,
) -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors of exactly ``dims`` components, none null or non-finite, as floor(``scale`` * component). The ``k``
    first by the SHA-256 of ``seed:id`` are centroids 0, 1, ...; equal hashes are ordered by components. Each
    round assigns every vector to the nearest centroid, the smaller number of equals, and moves centroids to the floor of
    their vectors' mean; an empty one stays. At last vectors are assigned once more.

    Repeated rows count each; a null id has no hash, so it comes after all others. With fewer vectors than ``k``, each is a centroid;
    an empty table, or one without kept vectors, gives no rows. Other columns are left out. Components beyond
    2^26 after scaling raise an error, as their distances do not fit 64 bits.
    """
    name = free_name(vectors, "v")
    whole = integers(vectors.select(id_col, vector_col), vector_col, dims, scale, name).select(id_col, name)
    rotation = principal_axes(whole, name, dims)
    table = stored(rotated(whole, name, dims, rotation, min(lead, dims)), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    starts = table.select(digest.alias("digest"), name).orderBy(F.col("digest").asc_nulls_last(), name).limit(k).collect()
    if not starts:
        return _labelled(table, id_col, name, dims, np.zeros((1, dims), np.int64), rotation)
    centroids = np.array([r[name] for r in starts], np.int64)
    for _ in range(rounds):
        for number, (n, total) in _sums(table, name, dims, centroids, rotation).items():
            centroids[number] = [s // n for s in total]
    return _labelled(table, id_col, name, dims, centroids, rotation)


def _labelled(table: DataFrame, id_col: str, name: str, dims: int, centroids: np.ndarray, rotation: Rotation) -> DataFrame:
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, distance = _assigned(batch, name, dims, centroids, rotation)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], [id_col, "cluster", "distance"])

    schema = T.StructType([table.schema[id_col], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = stored(table.mapInArrow(run, schema), "assigned")
    per = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row per centroid
    total = sum(r.cluster_inertia for r in per)
    inertia = F.create_map(*[F.lit(x) for r in per for x in (r.cluster, r.cluster_inertia)]) if per else F.create_map(F.lit(0), F.lit(0))
    return assigned.select(
        id_col,
        "cluster",
        "distance",
        inertia[F.col("cluster")].cast("bigint").alias("cluster_inertia"),
        F.lit(total).cast("bigint").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1).alias("centroid_sha256"),
    )
