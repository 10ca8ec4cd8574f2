"""Exact top-k inner products by pivot-table elimination.

Every vector's distances to PIVOTS pivots make a table. For a query q and a
row x each pivot p gives |d(q, p) - d(x, p)| <= d(q, x); the largest of these
lower bounds the distance, and so bounds the inner product
(|q|^2 + |x|^2 - d(q, x)^2) / 2 from above. Rows are packed into blocks by their
nearest pivot. For a block of queries, the row blocks are taken in the order
of their best bound; within a block only rows whose bound reaches the k-th
score found so far are evaluated; when no later block's bound reaches it, the
search stops. Ties at the k-th score are evaluated, so results are exact.

Row blocks are gathered in parts of about PART blocks, query blocks in groups
of about GROUP, and each group meets each part once, so a task holds a bounded
number of rows whatever the table's size. Each part gives its k best rows of a
query; these are merged.

Pivots are chosen farthest-first from a bounded sample (SAMPLE rows by hash);
they steer the order only, so results don't depend on them.

Defined cases: vectors that are null or have null or non-finite components,
and rows with a null id, take no part; rows that repeat an id count once, with
the smallest vector; vectors of unlike lengths are padded with zeros; fewer
than k candidates give all; an empty table gives an empty result. Only id and
vector are read, so other names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, stash

SCALE = 64
PIVOTS = 16
SAMPLE = 2048
ROWS = 1024  # rows of a block
QUERIES = 512  # queries of a block
PART = 8  # row blocks of a part
GROUP = 4  # query blocks of a group
SLACK = 1e-6


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0))


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    if not len(sample):
        return np.zeros((1, sample.shape[1] if sample.ndim > 1 else 1))
    chosen = [0]
    near = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def packed(x: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as rows of integers held in doubles (exact below 2^53), padded to ``width``."""
    lengths = np.diff(x.offsets.to_numpy())
    flat = x.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(x), width))
    out[np.repeat(np.arange(len(x)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[scores >= limit], scores[scores >= limit]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def unpacked(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(-1, width)


def search(qids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], pivots: np.ndarray, k: int):
    """Each query's k best rows among the blocks (ids, vectors), and how many pairs were evaluated."""
    q_table, q_norm = distances(q, pivots), (q * q).sum(1)
    found = [(np.empty(0, np.int64), np.empty(0)) for _ in qids]
    limit = np.full(len(qids), -np.inf)
    known = []
    for ids, x in blocks:
        table, norm = distances(x, pivots), (x * x).sum(1)
        # the least that a row of the block can differ from the query in some pivot's distance
        gap = np.maximum(np.maximum(table.min(0)[None, :] - q_table, q_table - table.max(0)[None, :]), 0).max(1)
        known.append((ids, x, table, norm, (q_norm + norm.max() - gap * gap) / 2 + SLACK))
    bounds = np.stack([b[4] for b in known]) if known else np.empty((0, len(qids)))
    evaluated = 0
    order = np.argsort(-bounds.max(1), kind="stable") if len(bounds) else []
    for b in order:
        ids, x, table, norm, bound = known[b]
        asked = np.flatnonzero(bound >= limit)
        if not len(asked):
            continue
        lower = np.zeros((len(asked), len(ids)))
        for p in range(table.shape[1]):
            np.maximum(lower, np.abs(q_table[asked, p][:, None] - table[:, p][None, :]), out=lower)
        open_ = (q_norm[asked][:, None] + norm[None, :] - lower * lower) / 2 + SLACK >= limit[asked][:, None]
        rows = np.flatnonzero(open_.any(0))
        scores = q[asked] @ x[rows].T
        evaluated += scores.size
        mask = open_[:, rows] & (ids[rows][None, :] != qids[asked][:, None]) & (scores >= limit[asked][:, None])
        for i, a in enumerate(asked):
            hit = np.flatnonzero(mask[i])
            if len(hit):
                found[a] = best(np.concatenate([found[a][0], ids[rows][hit]]), np.concatenate([found[a][1], scores[i, hit]]), k)
                if len(found[a][0]) >= k:
                    limit[a] = found[a][1][-1]
    return found, evaluated


def top_products(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``every`` the k largest integer inner products."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(sound).withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")))
    rows = stash(rows.groupBy("id").agg(F.min("v").alias("v")), "topk-rows")
    n, width, queries = rows.agg(F.count("*"), F.max(F.size("v")), F.count(F.when(F.col("id") % every == 0, 1))).first()
    width, parts, groups = max(width or 1, 1), -(-n // (ROWS * PART)) or 1, -(-queries // (QUERIES * GROUP)) or 1
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 20))).orderBy("id").limit(2 * SAMPLE)
    vectors = [r["v"] for r in sample.collect()]  # at most 2 SAMPLE rows
    pivots = farthest_first(np.array([v + [0.0] * (width - len(v)) for v in vectors]).reshape(len(vectors), width), PIVOTS)

    def nearest(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = packed(batch.column(1), width)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(distances(x, pivots).argmin(1).astype(np.int32))], names=["id", "v", "near"])

    def pack(source: DataFrame, count: int, size: int) -> DataFrame:
        """Blocks of ``size`` rows at most, alike by nearest pivot, as the bytes of their ids and vectors."""

        def fold(batches):
            for batch in batches:
                for a in range(0, batch.num_rows, size):
                    part = batch.slice(a, size)
                    x = packed(part.column(1), width)
                    yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_numpy().astype(np.int64).tobytes()]), pa.array([x.tobytes()])], names=["ids", "vectors"])

        spread = -(-count // (16 * size)) or 1
        return source.repartition(spread, "id").sortWithinPartitions("near", "id").select("id", "v").mapInArrow(fold, "ids binary, vectors binary")

    placed = map_rows(rows, "id long, v array<double>, near int", nearest)
    data = pack(placed, n, ROWS).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)))
    asked = pack(placed.where(F.col("id") % every == 0), queries, QUERIES).withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    data = stash(data, "topk-blocks").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    asked = stash(asked, "topk-queries").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def meet(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        blocks = [unpacked(*b, width) for b in zip(rows["ids"], rows["vectors"], strict=True)]
        out = []
        for block in zip(queries["ids"], queries["vectors"], strict=True):
            qids, q = unpacked(*block, width)
            found, _ = search(qids, q, blocks, pivots, k)
            out += [pd.DataFrame({"query_id": qid, "vec_id": ids, "score": scores.astype(np.int64)}) for qid, (ids, scores) in zip(qids, found, strict=True)]
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    met = asked.groupBy("group", "part").cogroup(data.groupBy("group", "part")).applyInPandas(meet, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
