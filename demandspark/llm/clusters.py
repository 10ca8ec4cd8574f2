"""Exact k-means of integer vectors by Shallot search.

Every vector carries an upper bound to its centroid's distance, a lower bound
to all others', and remembers the second-nearest centroid. In a round

1. the bounds are moved by how far the centroids moved; a vector whose upper
   bound is below its lower bound, or below half the distance from its centroid
   to the next one, keeps its cluster unseen; the distance to its centroid is
   then worked out, and the test made again;
2. for the others the remembered centroid's distance is worked out too, and the
   search starts from the closer of the two. The other centroids are scanned in
   order of distance from there. None farther than d1 + d2 can come nearer than
   the second-nearest found so far (d1 from vector to the start, d2 to the
   second-nearest), and this ball shrinks as d2 does;
3. survivors are compared by exact squared distances in 64-bit integers, ties to
   the smaller number. Bounds are doubles, loosened by SLACK, so they decide
   only what integers would decide alike.

A round is one pass: tasks read the vectors with their bounds, write them with
the new ones, and add one row per cluster with the sum of its vectors. Nothing
is shuffled but these rows; their totals, k rows, give the new centroids.
The written table of the round before is removed.

Defined cases: vectors that are null, of another length, or have null or
non-finite components take no part, nor have those with a component of LARGEST
or more after scaling (squared distances would leave 64 bits). Rows with a null
id are clustered, but start no cluster as long as others can. Rows that repeat
an id are vectors of their own. Fewer kept vectors than k give that many
clusters. A cluster that loses all vectors keeps its centroid. An empty table
gives an empty result. Only id and vector are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import discard, settle, ship, small_batches, stash

SCALE = 1024
WIDTH = 64
LARGEST = 1 << 26
SLACK = 1e-9

STATE = "id {kind}, v binary, cluster int, second int, upper double, lower double, part int, n long, sums array<long>"


class Centroids:
    """The centroids, how far they are from each other, and how far they have moved."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at = at
        self.apart = np.sqrt(squared(at[:, None, :], at[None, :, :]).astype(float))
        self.order = np.argsort(self.apart, axis=1, kind="stable")  # neighbours by distance
        others = self.apart + np.diag(np.full(len(at), np.inf))
        self.half = others.min(1) / 2 * (1 - SLACK)
        self.moved = np.sqrt(squared(at, at if before is None else before).astype(float)) * (1 + SLACK)

    def most_moved_but(self) -> np.ndarray:
        """For each centroid how far the others have moved at most."""
        return np.array([np.delete(self.moved, j).max(initial=0) for j in range(len(self.moved))])


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(-1)


def assigned(x: np.ndarray, cluster: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids) -> int:
    """Brings the four state arrays up to date with the centroids; how many distances were worked out."""
    upper += c.moved[cluster]
    lower -= c.most_moved_but()[cluster]
    if len(c.at) == 1:
        return 0
    seen = 0
    limit = np.maximum(lower, c.half[cluster])
    todo = np.flatnonzero(~(upper < limit))
    own = squared(x[todo], c.at[cluster[todo]])
    seen += len(todo)
    upper[todo] = np.sqrt(own) * (1 + SLACK)
    still = ~(upper[todo] < limit[todo])
    todo, own = todo[still], own[still]
    if not len(todo):
        return seen
    rows, first, other = x[todo], cluster[todo], second[todo]
    other = np.where(other == first, (first + 1) % len(c.at), other)
    there = squared(rows, c.at[other])
    seen += len(todo)
    swap = (there < own) | ((there == own) & (other < first))
    best, best_d = np.where(swap, other, first), np.where(swap, there, own)
    next_, next_d = np.where(swap, first, other), np.where(swap, own, there)
    start, start_d, met = best.copy(), np.sqrt(best_d), (first, other)
    active = np.arange(len(todo))
    for rank in range(len(c.at)):
        j = c.order[start[active], rank]
        inside = c.apart[start[active], j] * (1 - SLACK) <= (start_d[active] + np.sqrt(next_d[active])) * (1 + SLACK)
        active, j = active[inside], j[inside]
        if not len(active):
            break
        new = (j != met[0][active]) & (j != met[1][active])
        at, j = active[new], j[new]
        d = squared(rows[at], c.at[j])
        seen += len(at)
        nearer = (d < best_d[at]) | ((d == best_d[at]) & (j < best[at]))
        closer = ~nearer & ((d < next_d[at]) | ((d == next_d[at]) & (j < next_[at])))
        a, b = at[nearer], at[closer]
        next_[a], next_d[a] = best[a], best_d[a]
        best[a], best_d[a] = j[nearer], d[nearer]
        next_[b], next_d[b] = j[closer], d[closer]
    cluster[todo], second[todo] = best, next_
    upper[todo], lower[todo] = np.sqrt(best_d) * (1 + SLACK), np.sqrt(next_d) * (1 - SLACK)
    return seen


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """id, x (scaled integers) of the vectors that take part."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x")).where(F.size("x") == width)
    sound = F.forall("x", lambda y: F.coalesce(~F.isnan(y) & (F.abs(y) < LARGEST // scale), F.lit(False)))
    return rows.where(sound).withColumn("x", F.transform("x", lambda y: F.floor(y * scale)))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose hashed ids are smallest (k rows come to the driver)."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    found = rows.select("x", by.alias("h")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in found], np.int64)


def clustered_round(state: DataFrame, kind: str, centroids: Centroids, width: int) -> DataFrame:
    """The state after the vectors are assigned to the centroids, and a row per task and cluster with n and sums."""
    schema = STATE.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(__name__)
        k = len(centroids.at)
        count, sums, like = np.zeros(k, np.int64), np.zeros((k, width), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            like = batch.schema.field(0).type
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(-1, width).astype(np.int64)
            cluster, second, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 3, 4, 5))
            assigned(x, cluster, second, upper, lower, centroids)
            count += np.bincount(cluster, minlength=k)
            for j in np.unique(cluster):
                sums[j] += x[cluster == j].sum(0)
            nothing = [pa.nulls(len(x), t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster), pa.array(second), pa.array(upper), pa.array(lower), *nothing], names=NAMES)
        met = np.flatnonzero(count)
        if len(met):
            nothing = [pa.nulls(len(met), t) for t in (like, pa.binary(), pa.int32(), pa.int32(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))], names=NAMES)

    ship(state.sparkSession)
    small_batches(state.sparkSession)
    return state.mapInArrow(run, schema)


NAMES = ["id", "v", "cluster", "second", "upper", "lower", "part", "n", "sums"]


def totals(state: DataFrame, k: int, width: int) -> tuple[list[int], list[list[int]]]:
    """Each cluster's number of vectors and sums of components, in exact integers."""
    parts = state.where("part is not null").select("part", "n", F.posexplode("sums").alias("at", "sum"))
    found = parts.groupBy("part", "at").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n")).collect()  # k x width rows
    n, sums = [0] * k, [[0] * width for _ in range(k)]
    for r in found:
        n[r["part"]], sums[r["part"]][r["at"]] = r["n"], int(r["sum"])
    return n, sums


def centroid_clusters(df: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, width: int = WIDTH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    spark, kind = df.sparkSession, dict(df.dtypes)[id_col]
    rows = kept_vectors(df, id_col, vector_col, width, scale)
    at = first_centroids(rows, k, seed)
    empty = f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(at):
        return spark.createDataFrame([], empty)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, width)
            n = len(x)
            offsets = pa.py_buffer((np.arange(n + 1, dtype=np.int32) * 4 * width).tobytes())
            v = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(x.tobytes())])
            # nothing is known of them: bounds that decide nothing
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, len(at) > 1, np.int32)), pa.array(np.full(n, np.inf)), pa.array(np.zeros(n)), *(pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=NAMES)

    small_batches(spark)
    state = stash(rows.mapInArrow(pack, STATE.format(kind=kind)), "clusters")
    centroids = Centroids(at)
    for _ in range(rounds):
        after = stash(clustered_round(state.where("part is null"), kind, centroids, width), "clusters")
        discard(state)
        state = after
        n, sums = totals(state, len(at), width)
        new = np.array([[s // n[j] for s in sums[j]] if n[j] else centroids.at[j].tolist() for j in range(len(at))], np.int64)
        centroids = Centroids(new, centroids.at)

    after = clustered_round(state.where("part is null"), kind, centroids, width).where("part is null")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(-1, width).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(squared(x, centroids.at[batch.column(2).to_numpy()]))], names=["id", "cluster", "distance"])

    out = stash(after.select("id", "v", "cluster").mapInArrow(measure, f"id {kind}, cluster int, distance long"), "clusters-out")
    discard(state)
    sizes = {r["cluster"]: r["inertia"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # k rows
    signs = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.at.tolist()]

    def of(values: list, kind: str):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    inertia = of([sizes.get(j, 0) for j in range(len(at))], "long")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(sum(sizes.values())).cast("long").alias("inertia"), of(signs, "string").alias("centroid_sha256"))
