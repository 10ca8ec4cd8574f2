"""Importance resampling of documents towards a target text collection.

Features are runs of 1 to RUN words, hashed to BUCKETS buckets by CRC-32.

1. Length-bucketed CRC matrices. The words of a portion of texts lie one after
   the other, a space between two, in one byte buffer, so every feature is a
   slice of it. The portion's distinct features are grouped by equal byte
   length; each group is a two-dimensional uint8 array, one feature a row, and
   all its CRCs are updated together, column by column. The buckets are then
   scattered back to all places of the features.
2. Each task adds its bucket counts up and gives one row per bucket that it
   met; their sums, BUCKETS numbers a collection, give the buckets' gains.
3. A second pass hashes the documents again (cheaper than keeping three bucket
   numbers a word on disk), adds up the gains of a document's features and a
   draw of Gumbel noise by the document's id.
4. The largest scores are drawn: scores are ranked over range partitions.

Features longer than LONG bytes, which only strings without spaces make, would
be matrices of a row or two and thousands of columns; zlib computes their CRCs
(the same function) one by one, and the matrices keep to all else.

Defined cases: a null or empty text has no words, no features and the weight 0;
all documents' features count in the gains, also those of rows with a null id,
which have no noise, and so neither score nor rank, and aren't among the
documents to draw from. Rows that repeat an id have the same noise; equal
scores rank by id, then by weight and number of features. Without documents of LEAST words
nothing is drawn. An empty table gives an empty result, an empty target counts
0 everywhere. Only id and text are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import give_back, map_rows, settle, ship, small_batches, stash
from demandspark.llm.words import portions, texts
from demandspark.operators.ordered import global_rank

RUN = 3
BUCKETS = 10_000
LEAST = 20
LONG = 1024
CELLS = 1 << 20  # bytes of one matrix

#: Lower-cases A-Z; what is neither a letter, a digit nor a byte of a longer character becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def crc_table() -> np.ndarray:
    """CRC-32's table by its polynomial, bits reversed."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


TABLE = crc_table()


class Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def crcs(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of the buffer, by matrices of slices of equal length."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    borders = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, borders) if len(order) else ():
        size = int(lengths[group[0]])
        if size > LONG:
            out[group] = [zlib.crc32(buffer[s:s + size]) for s in starts[group].tolist()]
            continue
        rows = max(1, CELLS // size)
        for a in range(0, len(group), rows):
            part = group[a:a + rows]
            matrix = buffer[np.arange(size)[:, None] + starts[part][None, :]]  # a column of features at a time lies together
            crc = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
            out[part] = ~crc
    return out


def hashed_features(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of words; the buckets of all features; and the text each of these is from."""
    lists = [t.translate(FOLD).split() for t in found]
    counts = np.array([len(x) for x in lists], np.int64)
    every = [w for x in lists for w in x]
    if not every:
        return counts, np.empty(0, np.int64), np.empty(0, np.int64)
    buffer = np.frombuffer(b" ".join(every), np.uint8)
    sizes = np.fromiter(map(len, every), np.int64, len(every))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    owner = np.repeat(np.arange(len(found)), counts)
    known = Numbers()
    number = np.fromiter(map(known.__getitem__, every), np.int64, len(every))
    buckets, owners = [], []
    for run in range(1, RUN + 1):
        n = len(every) - run + 1
        if n <= 0:
            break
        # a run's number: that of the run less its last word, then its last word's
        number = number[:n] if run == 1 else number[:n] * len(known) + word[run - 1:]
        _, first, number = np.unique(number, return_index=True, return_inverse=True)
        if run == 1:
            word = number
        within = owner[:n] == owner[run - 1:]
        first, place = first[number], np.flatnonzero(within)
        some, place_of = np.unique(first[place], return_inverse=True)  # distinct features that lie inside a text
        # equal numbers have equal bytes, so a first place across a text border serves as well
        hashed = crcs(buffer, starts[some], ends[some + run - 1] - starts[some]) % np.uint32(BUCKETS)
        buckets.append(hashed[place_of].astype(np.int64))
        owners.append(owner[place])
    return counts, np.concatenate(buckets), np.concatenate(owners)


def bucket_counts(df: DataFrame, text_col: str) -> DataFrame:
    """bucket, n: how many features of all texts fall in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(__name__)
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            found = texts(batch.column(0))
            for a, b in portions(found):
                total += np.bincount(hashed_features(found[a:b])[1], minlength=BUCKETS)
        met = np.flatnonzero(total)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    ship(df.sparkSession)
    small_batches(df.sparkSession)
    return df.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, rounded down."""
    s_all, t_all = sum(docs.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * (s_all + BUCKETS) / ((docs.get(b, 0) + 1) * (t_all + BUCKETS)))) for b in range(BUCKETS)], np.int64)


def noise(doc_id: int, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``id_col, n_features, weight, score, rank, n_words`` of every document; ranks of the drawn ones only."""
    # at most BUCKETS rows each
    of_docs, of_target = ({r["bucket"]: r["n"] for r in bucket_counts(df, name).collect()} for df, name in ((docs, text_col), (target, target_col)))
    gains = bucket_gains(of_docs, of_target)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, words, sizes, weights = texts(batch.column(1)), [], [], []
        for a, b in portions(found):
            counts, buckets, owners = hashed_features(found[a:b])
            words.append(counts)
            sizes.append(np.bincount(owners, minlength=b - a))
            total = np.zeros(b - a, np.int64)
            np.add.at(total, owners, gains[buckets])
            weights.append(total)
        words, sizes, weights = (np.concatenate(x).astype(np.int64) for x in (words, sizes, weights))
        scores = [None if i is None else w + noise(i, seed) for i, w in zip(batch.column(0).to_pylist(), weights.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(sizes), pa.array(weights), pa.array(scores, pa.int64())], names=["id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = stash(map_rows(rows, "id long, n_words long, n_features long, weight long, score long", one), "resampling-scores")
    eligible = scored.where((F.col("n_words") >= LEAST) & F.col("score").isNotNull())
    drawn = percent * eligible.count() // 100
    # rows that agree in all that orders them are alike, so a number of their own decides nothing else
    keyed = eligible.withColumns({"least": -F.col("score"), "own": F.monotonically_increasing_id()})
    ranked = global_rank(keyed, [], ["least", "id", "weight", "n_features", "own"]).drop("least", "own")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    rest = scored.where((F.col("n_words") < LEAST) | F.col("score").isNull()).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")
