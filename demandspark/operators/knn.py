"""Exact k-nearest-neighbour regression by bound-routed blocks.

1. ``pivots`` pivots are chosen farthest-first from a bounded sample of the
   reference; every row belongs to the cell of its nearest pivot, and there to
   the ring of its distance to it (``rings`` edges per cell, from the sample).
   Each ring has a size and a least and greatest distance to its pivot: at
   most ``pivots`` x ``rings`` rows, the only table on the driver.
2. Rings of neighbouring pivots are packed, and large ones cut, into blocks of
   about ``chunk`` rows; queries, by their nearest pivot, into sets likewise.
3. First pass: each query meets the packs of the nearest rings that together
   hold k rows. The k-th distance found there is the query's limit.
4. Second pass: a row of a ring is at least ``max(d - hi, lo - d, 0)`` away,
   with d the query's distance to the pivot (triangle inequality). A query
   visits the other packs with a ring whose bound reaches its limit.
5. In both passes a routing table (set, block) is joined to the reference, so a
   block is shipped to the sets that have a query for it and to no other. A
   meeting is one matrix product over one set and one block; it returns the k
   nearest per query, distances worked out anew from the vectors.

No task holds more than about a chunk of either side, whatever the table's
size, and no candidate is capped. In many dimensions the bounds exclude little
and nearly every pair is evaluated; ``shipped_pairs`` measures it.

Rows without key, vector or label take no part; ties go to the smaller key.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.session import checkpoint_dir

PIVOTS, RINGS, SAMPLE, CHUNK = 64, 4, 4096, 4096
SLICE = 256  # queries whose distances or bounds are worked out at once


class Placed(NamedTuple):
    """``ref``: rid, rv, y, block. ``queries``: qid, qv, set. ``rings``: ring, n, lo, hi, pack. ``packs``: n, first block, blocks."""

    ref: DataFrame
    queries: DataFrame
    pivots: np.ndarray
    rings: pd.DataFrame
    packs: pd.DataFrame
    kinds: tuple[str, str]


def _vectors(column) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column]) if len(column) else np.empty((0, 1))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0))


def _slack(x: np.ndarray, reach: float) -> np.ndarray:
    """What rounding can add to a distance from ``_distances`` to vectors of norm ``reach`` at most."""
    return 1e-6 * (np.sqrt((x * x).sum(1)) + reach)


def _pivots(ref: DataFrame, n: int, rings: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Farthest-first pivots of about SAMPLE reference rows (the least hashes), and the edges between each cell's rings."""
    share = min(1.0, SAMPLE / max(rows, 1))
    some = ref.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("rid").limit(2 * SAMPLE)
    sample = _vectors([r["rv"] for r in some.select("rv").collect()])
    if not len(sample):
        return sample, np.empty((0, rings - 1))
    chosen, near = [0], _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(sample, sample[chosen[-1:]])[:, 0])
    points = sample[chosen]
    d = _distances(sample, points)
    own, share = d.argmin(1), np.arange(1, rings) / rings
    return points, np.array([np.quantile(d[own == c, c], share) if (own == c).any() else np.zeros(rings - 1) for c in range(len(points))])


def _sides(reference: DataFrame, queries: DataFrame, key: str, vec: str, label: str) -> tuple[DataFrame, DataFrame]:
    v = F.col(vec).cast("array<double>")
    ref = reference.select(F.col(key).alias("rid"), v.alias("rv"), F.col(label).cast("double").alias("y")).dropna()
    return ref, queries.select(F.col(key).alias("qid"), v.alias("qv")).dropna()


def _chain(points: np.ndarray) -> list[int]:
    """The pivots in an order in which each is followed by the nearest one left."""
    left, out = set(range(1, len(points))), [0][:len(points)]
    while left:
        d = _distances(points[out[-1]][None, :], points)[0]
        out.append(min(left, key=lambda c: (d[c], c)))
        left.remove(out[-1])
    return out


def _packs(sizes: list[int], chunk: int) -> tuple[list[int], pd.DataFrame]:
    """The pack of each size, neighbours sharing one while it has at most ``chunk`` rows, and the packs."""
    of, n = [], []
    for size in sizes:
        if not n or n[-1] + size > chunk:
            n.append(0)
        n[-1] += size
        of.append(len(n) - 1)
    blocks = [max(1, -(-x // chunk)) for x in n]
    return of, pd.DataFrame({"n": n, "first": np.cumsum([0, *blocks])[:-1][:len(n)], "blocks": blocks}, dtype="int64")


def _looked_up(column: str, values: dict[int, int]) -> Column:
    """The value of the number in ``column`` (pivots x rings entries at most)."""
    return F.element_at(F.array(*[F.lit(int(values.get(c, 0))) for c in range(max(values, default=0) + 1)]), F.col(column) + 1)


def _block(column: str, key: str, numbers: list[int], of: list[int], packs: pd.DataFrame) -> Column:
    """The block of a row: one of its pack's, by a hash of the key."""
    first = {c: packs["first"][p] for c, p in zip(numbers, of, strict=True)}
    count = {c: packs["blocks"][p] for c, p in zip(numbers, of, strict=True)}
    return (_looked_up(column, first) + F.pmod(F.xxhash64(key), F.greatest(_looked_up(column, count), F.lit(1)))).cast("int")


def _placed(reference: DataFrame, queries: DataFrame, key: str, vec: str, label: str, pivots: int, rings: int, chunk: int) -> Placed:
    ref, qry = _sides(reference, queries, key, vec, label)
    kinds = (ref.schema["rid"].dataType.simpleString(), qry.schema["qid"].dataType.simpleString())
    points, edges = _pivots(ref, pivots, rings, ref.count())

    def assign(frames):
        for x in frames:
            d = _distances(_vectors(x["rv"]), points)
            near, least = d.argmin(1), d.min(1)
            inner = (least[:, None] > edges[near]).sum(1)
            yield x.assign(ring=(near * rings + inner).astype("int32"), d=least)

    def home(frames):
        for x in frames:
            near = _distances(_vectors(x["qv"]), points).argmin(1) if len(points) else np.zeros(len(x))
            yield x.assign(home=near.astype("int32"))

    ref = ref.mapInPandas(assign, f"rid {kinds[0]}, rv array<double>, y double, ring int, d double")
    qry = qry.mapInPandas(home, f"qid {kinds[1]}, qv array<double>, home int")
    checkpoint_dir(ref.sparkSession)
    ref, qry = ref.checkpoint(), qry.checkpoint()  # read by both passes and the counts
    place = {c: i for i, c in enumerate(_chain(points))}
    table = ref.groupBy("ring").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).toPandas()  # pivots x rings rows at most
    table = table.sort_values("ring", key=lambda r: [place[c // rings] * rings + c % rings for c in r], ignore_index=True)
    table["pack"], packs = _packs(table["n"].astype(int).tolist(), chunk)
    homes = sorted(qry.groupBy("home").count().collect(), key=lambda r: place.get(r["home"], 0))  # one row per pivot at most
    of, sets = _packs([r["count"] for r in homes], chunk)
    ref = ref.withColumn("block", _block("ring", "rid", table["ring"].tolist(), table["pack"].tolist(), packs))
    qry = qry.withColumn("set", _block("home", "qid", [r["home"] for r in homes], of, sets))
    return Placed(ref.drop("d", "ring"), qry.drop("home"), points, table, packs, kinds)


def _ring_bounds(q: np.ndarray, at: Placed, rings: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of each query to the rows of each ring."""
    d = _distances(q, at.pivots[at.rings["ring"].to_numpy() // rings])
    lo, hi = at.rings["lo"].to_numpy(), at.rings["hi"].to_numpy()
    return np.maximum(np.maximum(d - hi, lo - d), 0), d + hi


def _opening(least: np.ndarray, greatest: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Which rings each query meets first: the nearest by their bounds that together hold k rows."""
    order = np.argsort(least + greatest, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(least.shape, bool)
    np.put_along_axis(out, order, before < k, axis=1)
    return out


def _routed(at: Placed, limits: DataFrame | None, k: int, rings: int) -> DataFrame:
    """Queries with each pack to visit: the opening ones, or with ``limits`` (qid, far) the others within reach."""
    # the small tables travel with the function; no DataFrame does
    bounds_of, count = at._replace(ref=None, queries=None), len(at.packs)
    packs, sizes = at.rings["pack"].to_numpy(dtype=int), at.rings["n"].to_numpy(dtype=int)
    reach = float(np.sqrt((at.pivots ** 2).sum(1)).max(initial=0) + at.rings["hi"].max()) if count else 0.0
    second = limits is not None

    def by_pack(to: np.ndarray) -> np.ndarray:
        out = np.zeros((len(to), count), bool)
        row, ring = np.nonzero(to)
        out[row, packs[ring]] = True
        return out

    def visit(frames):
        for x in (frame[lo:lo + 8 * SLICE] for frame in frames for lo in range(0, len(frame), 8 * SLICE)):
            if not count:
                continue
            q = _vectors(x["qv"])
            least, greatest = _ring_bounds(q, bounds_of, rings)
            to = by_pack(_opening(least, greatest, sizes, k))
            if second:
                to = ~to & by_pack(least <= (x["far"].to_numpy(float) + _slack(q, reach))[:, None])
            yield x[["qid", "qv", "set"]].assign(packs=[np.flatnonzero(row).astype("int32") for row in to])

    source = at.queries.join(limits, "qid") if second else at.queries
    seen = source.mapInPandas(visit, f"qid {at.kinds[1]}, qv array<double>, set int, packs array<int>")
    return seen.withColumn("pack", F.explode("packs")).drop("packs")


def _meeting(q: pd.DataFrame, r: pd.DataFrame, k: int) -> pd.DataFrame:
    """``qid, rid, y, d``: the k nearest rows of ``r`` to each of ``q``."""
    if not len(q) or not len(r):
        return pd.DataFrame({"qid": [], "rid": [], "y": [], "d": []})
    r = r.sort_values("rid", kind="stable")
    x, y = _vectors(q["qv"]), _vectors(r["rv"])
    ids, labels = r["rid"].to_numpy(), r["y"].to_numpy()
    slack = _slack(x, float(np.sqrt((y * y).sum(1)).max()))
    out: list[tuple] = []
    for lo in range(0, len(x), SLICE):  # distances of few queries at once
        for i, row in enumerate(_distances(x[lo:lo + SLICE], y), lo):
            limit = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
            some = np.flatnonzero(row <= limit + 2 * slack[i])
            exact = np.sqrt(((y[some] - x[i]) ** 2).sum(1))
            best = np.argsort(exact, kind="stable")[:k]  # rows are in key order
            out.append((np.full(len(best), i), some[best], exact[best]))
    query, row, d = map(np.concatenate, zip(*out))
    return pd.DataFrame({"qid": q["qid"].to_numpy()[query], "rid": ids[row], "y": labels[row], "d": d})


def _met(at: Placed, visits: DataFrame, k: int) -> DataFrame:
    """``qid, rid, y, d``: the k nearest of every block that a query's set is routed to, for the queries that visit its pack."""
    first, blocks = (_looked_up("pack", dict(enumerate(at.packs[c]))) for c in ("first", "blocks"))
    visits = visits.withColumn("block", F.explode(F.sequence(first, first + blocks - 1)))
    shipped = at.ref.join(visits.select("block", F.col("set").alias("to_set")).distinct(), "block")

    def meet(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        return _meeting(q, r, k)

    sides = visits.groupBy("block", "set"), shipped.groupBy("block", "to_set")
    return sides[0].cogroup(sides[1]).applyInPandas(meet, f"qid {at.kinds[1]}, rid {at.kinds[0]}, y double, d double")


def _nearest(met: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("qid").orderBy("d", "rid"))
    return met.withColumn("r", place).where(F.col("r") <= k)


def _passes(at: Placed, k: int, rings: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Visits of both passes, and what the first one found."""
    first = _routed(at, None, k, rings)
    found = _nearest(_met(at, first, k), k).checkpoint()  # k rows a query
    # a query with fewer than k rows so far has met every pack
    limits = found.groupBy("qid").agg(F.max("d").alias("far"))
    return first, _routed(at, limits, k, rings), found


def knn_regress(reference: DataFrame, queries: DataFrame, key: str = "vec_id", vec: str = "embedding",
                label: str = "label", k: int = 5, pivots: int = PIVOTS, chunk: int = CHUNK, rings: int = RINGS) -> DataFrame:
    """(query key, prediction = mean label of the k nearest, neighbours)."""
    at = _placed(reference, queries, key, vec, label, pivots, rings, chunk)
    _, second, found = _passes(at, k, rings)
    top = _nearest(found.drop("r").unionByName(_met(at, second, k)), k)
    return top.groupBy("qid").agg(F.avg("y").alias("prediction"), F.count(F.lit(1)).alias("neighbours")).withColumnRenamed("qid", key)


def shipped_pairs(reference: DataFrame, queries: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label",
                  k: int = 5, pivots: int = PIVOTS, chunk: int = CHUNK, rings: int = RINGS) -> dict[str, float]:
    """Shares of all query x reference pairs that are evaluated, and of all (set, block) pairs that are shipped; both passes."""
    at = _placed(reference, queries, key, vec, label, pivots, rings, chunk)
    first, second, _ = _passes(at, k, rings)
    visits = first.unionByName(second)
    seen = visits.groupBy("pack").count().collect()  # one row per pack
    routes = visits.select("pack", "set").distinct().groupBy("pack").count().collect()
    sets = at.queries.select("set").distinct().count()
    return {"evaluated": sum(r["count"] * at.packs["n"][r["pack"]] for r in seen) / max(at.ref.count() * at.queries.count(), 1),
            "shipped": sum(r["count"] * at.packs["blocks"][r["pack"]] for r in routes) / max(sets * at.packs["blocks"].sum(), 1)}
