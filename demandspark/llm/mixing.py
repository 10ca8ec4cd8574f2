"""Mixing sources to target weights over fixed-length blocks.

1. Each source's documents, in pseudorandom order, make one stream of words;
   the stream is packed into blocks of ``block`` words.
2. Sources weigh 1, 2, 3, 1, ... in code point order (null last) and share the
   total; a target stops at ``cap`` times its source, and the excess is shared
   anew by weight.
3. The output is dealt in shards. Each shard draws its source counts from a
   multinomial over the targets (over runs of sources first, then within each
   run, so that no task holds all sources). What a source has drawn above its
   quota of blocks is struck, what it lacks is dealt to closing shards.
4. A source's k-th drawn slot takes block ``permutation(k mod blocks)`` of its
   stream, with another permutation for each round through the source, so no
   block is taken more than ``cap`` times.
5. Slots and blocks are joined by (source, block).

Running sums go over buckets first, so no task sees a whole source. Every draw
depends on the seed, the shard and the sources only: reruns agree.

Defined cases: a null text has size 0 and is never taken; null sources are one
source, the last; null ids are kept; a repeated row is a document of its own;
an empty table gives an empty result. Columns other than id, text and source
are not read here, so their names cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, stash
from demandspark.llm.words import STEP, mix, odd_step, texts

BLOCK = 32
SHARD = 4096  # slots of an output shard
RUN = 4096  # sources drawn together, documents and shards summed together
CAP = 3


class Mixture(NamedTuple):
    """``documents``: id, copy, source, size, at (source's number), start. ``sources``: at, source, size, target, blocks,
    quota. ``slots``: shard, at, round, block. ``pieces``: at, block, start (the document's), first, words."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    found = F.split(text, "[\\x20\\x09-\\x0D]+")
    ends = F.when(F.element_at(found, 1) == "", 1).otherwise(0) + F.when(F.element_at(found, -1) == "", 1).otherwise(0)
    return F.when(F.rlike(text, F.lit("[^\\x20\\x09-\\x0D]")), F.size(found) - ends).otherwise(0).cast("long")


def weighted_targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds weight and target; ``sources`` has at (from 0) and size."""
    sources = sources.withColumn("weight", (F.col("at") % 3 + 1).cast("long"))
    total = sources.agg(F.sum("size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > cap * F.col("size")
        row = sources.agg(F.sum(full.cast("long")).alias("n"), F.sum(F.when(full, cap * F.col("size"))).alias("spent"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not row["open"] or row["n"] == capped:
            break
        capped, level = row["n"], (total - (row["spent"] or 0)) / row["open"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), (cap * F.col("size")).cast("double")))


def summed_before(df: DataFrame, key: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before this one within ``key``, by (bucket, order)."""
    totals = df.groupBy(*key, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*key, bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(totals, [*key, bucket]).withColumn(out, F.col(out) + F.col("_base")).drop("_base")


def permuted(index: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Place of each index under the seed's permutation of 0..size-1: a Feistel network, walked until it is inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, s = half[todo], mask[todo], seed[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix(right + s + odd_step(r + 1)) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def drawn(shards: DataFrame, parts: DataFrame, seed: int, label: str) -> DataFrame:
    """Multinomial draws: ``shards`` (shard, run, n) over the ``parts`` (run, part numbers, shares) of its run -> shard, part, n."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [])
        for shard, run, n, part, share in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            p = np.array(share, float)
            got = np.random.default_rng([seed, len(label), shard, run + 1]).multinomial(n, p / p.sum())
            hit = np.flatnonzero(got)
            out[0].extend([shard] * len(hit))
            out[1].extend(np.array(part, np.int64)[hit].tolist())
            out[2].extend(got[hit].tolist())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["shard", "part", "n"])

    joined = shards.join(parts, "run").select("shard", "run", "n", "part", "share")
    return map_rows(joined, "shard long, part long, n long", one)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, cap: int = CAP, seed: int = 7) -> Mixture:
    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("sign"))
    # copies of an id are told apart by their number
    sized = sized.withColumn("copy", F.row_number().over(Window.partitionBy("id").orderBy("source", "size", "sign")))
    sized = stash(sized.drop("sign"), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).orderBy(F.asc_nulls_last("source"))
    ranked = by_source.rdd.zipWithIndex().map(lambda x: (x[1], *x[0]))
    kind = dict(docs.dtypes)[source_col]
    sources = stash(spark.createDataFrame(ranked, f"at long, source {kind}, size long, docs long"), "mix-ranks")
    sources = weighted_targets(sources, cap).withColumn("blocks", F.ceil(F.col("size") / block))
    sources = sources.withColumn("quota", F.when(F.col("size") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("size")).cast("long"), cap * F.col("blocks"))).otherwise(F.lit(0)))
    sources = stash(sources, "mix-sources")
    most, slots_in_all, last = sources.agg(F.max("docs"), F.sum("quota"), F.max("at")).first()
    bits = max(1, int(np.ceil(np.log2((most or 1) / RUN + 1))))

    # the sources' streams, cut into blocks
    numbered = sized.join(sources.select("at", F.col("source").alias("of")), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    numbered = numbered.withColumn("hash", F.xxhash64(F.lit(seed), "id", "copy")).withColumn("bucket", F.shiftrightunsigned("hash", 64 - bits))
    documents = stash(summed_before(numbered, ["at"], "bucket", ["hash", "id", "copy"], "size", "start").select("id", "copy", "source", "size", "at", "start"), "mix-documents")
    end = F.col("start") + F.col("size")
    pieces = documents.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    first = F.greatest(F.col("start"), F.col("block") * block)
    pieces = pieces.select("at", "block", "start", (first - F.col("start")).alias("first"), (F.least(end, (F.col("block") + 1) * block) - first).alias("words"))

    # source counts of each shard
    shards = -(-(slots_in_all or 0) // SHARD)
    runs = sources.where("quota > 0").withColumn("run", F.floor(F.col("at") / RUN)).groupBy("run").agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("part"), F.col("quota").alias("share")))).alias("x"), F.sum("quota").alias("all"))
    runs = stash(runs.select("run", F.col("x.part").alias("part"), F.col("x.share").alias("share"), "all"), "mix-runs")
    heads = runs.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col("run").alias("part"), F.col("all").alias("share")))).alias("x")).select(F.lit(-1).cast("long").alias("run"), F.col("x.part").alias("part"), F.col("x.share").alias("share"))
    dealt = spark.range(shards).select(F.col("id").alias("shard"), F.lit(-1).cast("long").alias("run"), F.least(F.lit(SHARD), F.lit(slots_in_all or 0) - F.col("id") * SHARD).cast("long").alias("n"))
    counts = drawn(drawn(dealt, heads, seed, "run").withColumnRenamed("part", "run"), runs.select("run", "part", "share"), seed, "source").withColumnRenamed("part", "at")
    counts = stash(counts, "mix-counts")
    placed = summed_before(counts.withColumn("bucket", F.floor(F.col("shard") / RUN)), ["at"], "bucket", ["shard"], "n", "slot")
    placed = placed.join(sources.select("at", "blocks", "quota"), "at").withColumn("n", F.least("n", F.col("quota") - F.col("slot"))).where("n > 0")
    got = counts.groupBy("at").agg(F.sum("n").alias("got"))
    lacking = sources.where("quota > 0").join(got, "at", "left").select("at", "blocks", "quota", F.coalesce("got", F.lit(0)).alias("slot")).where("slot < quota")
    lacking = lacking.select("at", F.explode(F.sequence("slot", F.col("quota") - 1, F.lit(SHARD))).alias("slot"), "blocks", "quota")
    closing = lacking.select((F.lit(shards) + F.floor(F.col("slot") / SHARD)).alias("shard"), "at", "slot", F.least(F.lit(SHARD), F.col("quota") - F.col("slot")).alias("n"), "blocks")
    dealt_slots = placed.select("shard", "at", "slot", "n", "blocks").unionByName(closing)

    def expand(batch: pa.RecordBatch) -> pa.RecordBatch:
        shard, at, slot, n, blocks = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        row = np.repeat(np.arange(len(n)), n)
        slots = slot[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        size = blocks[row]
        lap = slots // size
        place = permuted(slots % size, size, mix(at[row].astype(np.uint64) * STEP + lap.astype(np.uint64) + np.uint64(seed)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (shard[row], at[row], lap, place)], names=["shard", "at", "round", "block"])

    slots = map_rows(dealt_slots.select(*(F.col(c).cast("long") for c in ("shard", "at", "slot", "n", "blocks"))), "shard long, at long, round long, block long", expand)
    return Mixture(documents, sources, slots, pieces)


def taken_words(mixture: Mixture, id_col: str = "doc_id") -> DataFrame:
    """``id_col, size, source_size, target, taken`` of every document."""
    times = mixture.slots.groupBy("at", "block").agg(F.count("*").alias("times"))
    taken = mixture.pieces.join(times, ["at", "block"]).groupBy("at", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    of_source = mixture.sources.select("at", F.col("size").alias("source_size"), "target")
    # a document without words shares its start with the next one, and takes nothing
    own = mixture.documents.withColumn("start", F.when(F.col("size") > 0, F.col("start")))
    rows = own.join(taken, ["at", "start"], "left").join(of_source, "at")
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: for each round through a source, each document with the words which that round takes,
    joined by one space. Other columns stay as they are; ids repeat where words are taken again."""
    spans = mixture.slots.join(mixture.pieces, ["at", "block"]).groupBy("at", "start", "round").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_spans"))
    cut = mixture.documents.where("size > 0").join(spans, ["at", "start"]).select(F.col("id").alias("_cut_id"), F.col("copy").alias("_cut_copy"), "_spans")
    keep = docs.columns
    rows = docs.withColumn("_copy", F.row_number().over(Window.partitionBy(id_col).orderBy(source_col, words_in(F.col(text_col)), F.xxhash64(text_col))))
    rows = rows.join(cut, F.col(id_col).eqNullSafe(F.col("_cut_id")) & (F.col("_copy") == F.col("_cut_copy")))

    def cut_out(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, spans = batch.schema.get_field_index(text_col), batch.column(batch.num_columns - 1).to_pylist()
        found = []
        for text, own in zip(texts(batch.column(at)), spans, strict=True):
            words = text.split()
            found.append(b" ".join([w for s in own for w in words[s["first"]:s["first"] + s["words"]]]))
        out = [pa.array(found, pa.binary()).cast(pa.string()) if i == at else batch.column(i) for i in range(len(keep))]
        return pa.RecordBatch.from_arrays(out, names=keep)

    return map_rows(rows.select(*keep, "_spans"), docs.schema, cut_out)
