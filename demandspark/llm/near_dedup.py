"""MinHash near-duplicates with tensored banding.

Two collections of BANDS bands of ROWS minhashes are computed per text; a
table key combines one band of the first with one of the second, so
BANDS x BANDS keys of 2 x ROWS minhashes cost only 2 x BANDS x ROWS minhash
computations. Two texts meet under some key exactly if they agree in a band of
either collection, so bands that no other text has are dropped before any key
is made.

1. Texts with equal shingle sets are one class. Classes have numbers of their
   own and stand for their smallest id, which several may share where rows
   repeat an id; comparisons and bounds go by class, links by id.
2. Classes that share a key meet. Every member is compared with its key's
   smallest and then its largest member; the links so far give components, and
   keys whose members are already connected are done. In the keys that are
   left, members of different components are compared, unless what they share
   with those two bounds their similarity below the threshold. No key's pairs
   are listed as a whole, and no link between components is left out.
3. Comparisons use the full shingle sets (64-bit hashes of five lower-cased
   words): 100 |A & B| >= 85 |A | B|.
4. Components of the links.

A pair at the threshold itself is missed with a probability of about
2 (1 - 0.85^3)^10 = 1.5e-4, at a similarity of 0.9 of 4e-6.

Defined cases: a null text has no words; texts without words are alone; fewer
than five words are one shingle. Rows with a null id take no part: their
component is null and they are kept. Rows that repeat an id are one document,
whose links are those of all its texts. An empty table gives an empty result.
Only id and text are read, so other names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import discard, map_rows, stash
from demandspark.llm.components import components
from demandspark.llm.words import KNOWN, hashed_words, mix, odd_step, portions, texts, window_hashes, windows_of

SHINGLE = 5
BANDS, ROWS = 10, 3
PERCENT = 85

def shingle_sets(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' sorted distinct shingles one after the other, and n + 1 offsets."""
    hashes, starts = hashed_words([t.lower().split() for t in found], KNOWN)  # bytes.lower: A-Z only
    windows, offsets = windows_of(hashes, starts, SHINGLE)
    sets = []
    for k in range(len(found)):
        own = windows[offsets[k]:offsets[k + 1]]
        if not len(own) and starts[k] < starts[k + 1]:
            own = window_hashes(hashes[starts[k]:starts[k + 1]], int(starts[k + 1] - starts[k]))
        sets.append(np.unique(own))
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), ends


def band_hashes(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """2 x BANDS hashes for each non-empty set."""
    full = np.diff(offsets) > 0
    starts = offsets[:-1][full]
    out = np.zeros((len(starts), 2 * BANDS), np.uint64)
    for band in range(2 * BANDS):
        for row in range(ROWS):
            k = band * ROWS + row + 1
            least = np.minimum.reduceat(mix(shingles ^ odd_step(k)) if row == 0 else (shingles ^ odd_step(k)) * (odd_step(977 * k) | np.uint64(1)), starts) if len(starts) else out[:, 0]
            out[:, band] = mix(out[:, band] ^ least)
    result = np.zeros((len(full), 2 * BANDS), np.uint64)
    result[full] = out
    return result


def set_signs(shingles: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ odd_step(k)))]) for k in (1001, 1002)]
    return [s[offsets[1:]] - s[offsets[:-1]] for s in sums]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n (shingles), s1 and s2 (a 128-bit sign of the set), bands."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, parts = texts(batch.column(1)), []
        for a, b in portions(found):
            sets, ends = shingle_sets(found[a:b])
            parts.append((np.diff(ends), *set_signs(sets, ends), band_hashes(sets, ends)))
        n, s1, s2, bands = (np.concatenate(x) for x in zip(*parts, strict=True))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * 2 * BANDS), _signed(bands.reshape(-1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), _signed(s1), _signed(s2), lists], names=["id", "n", "s1", "s2", "bands"])

    return map_rows(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id long, n long, s1 long, s2 long, bands array<long>", one)


def shared_keys(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All keys (key, cls, rep) that bands shared with other classes give; those that two ids or more have, with lo and hi."""
    bands = classes.select("cls", "rep", F.posexplode("bands").alias("band", "value")).withColumn("value", F.xxhash64("band", "value"))
    met = bands.groupBy("value").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("value")
    bands = bands.join(met, "value").groupBy("cls", "rep").agg(*(F.collect_list(F.when(side, F.col("value"))).alias(name) for name, side in (("x", F.col("band") < BANDS), ("y", F.col("band") >= BANDS))))
    keys = bands.select("cls", "rep", "y", F.explode("x").alias("x")).select("cls", "rep", "x", F.explode("y").alias("y")).select(F.xxhash64("x", "y").alias("key"), "cls", "rep")
    keys = stash(keys, "near-keys")
    # hubs are classes of the smallest and largest id, the same in all keys: other choices leave more keys open
    met = keys.groupBy("key").agg(F.min_by("cls", "rep").alias("lo"), F.max_by("cls", "rep").alias("hi"), F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most").drop("least", "most")
    return keys, keys.join(met, "key")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Classes a and b with their ids rep_a and rep_b, both (how many shingles they share), similar (enough for a link)."""
    one, other = sets.toDF("a", "rep_a", "set_a"), sets.toDF("b", "rep_b", "set_b")
    rows = pairs.join(one, "a").join(other, "b").select("a", "b", "set_a", "set_b", "rep_a", "rep_b")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        shared, good = [], []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            shared.append(both)
            good.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1, 4, 5)), pa.array(shared, pa.int64()), pa.array(good, pa.bool_())], names=["a", "b", "rep_a", "rep_b", "both", "similar"])

    return map_rows(rows, "a long, b long, rep_a long, rep_b long, both long, similar boolean", check)


def shareable(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds size and common to the members: how many shingles they have, and how many of these another member or hub has.

    What a set shares with any other is at most its ``common``; members for
    which that is too little are left out.
    """
    some = stash(sets.drop("rep").join(members.select(F.explode(F.array("cls", "lo", "hi")).alias("cls")).distinct(), "cls", "left_semi"), "near-some")

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
        owners = np.repeat(batch.column(0).to_numpy(), [len(x) for x in every])
        return pa.RecordBatch.from_arrays([pa.array(owners), pa.array(np.concatenate(every))], names=["cls", "shingle"])

    once = map_rows(some, "cls long, shingle long", spread).groupBy("shingle").agg(F.min("cls").alias("cls"), F.max("cls").alias("other")).where("cls = other")
    lone = once.groupBy("cls").agg(F.count("*").alias("lone"))
    size = (F.length("shingles") / 8).cast("long")
    known = some.select("cls", size.alias("size")).distinct().join(lone, "cls", "left").select("cls", "size", (F.col("size") - F.coalesce("lone", F.lit(0))).alias("common"))
    return stash(members.drop("size", "common").join(known.where(100 * F.col("common") >= PERCENT * F.col("size")), "cls"), "near-shareable")


def open_pairs(members: DataFrame, sets: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs of members that share a key, are in different components and may be similar, as far as bounds can tell.

    Both have been compared with their key's hubs h. They share at most
    min(|A & h|, |B & h|) shingles of h, and outside h at most the smaller
    number of those that some other member or hub has.
    """
    for _ in range(2):  # who is left out takes its shingles along
        members = shareable(members, sets)
    for hub in ("lo", "hi"):
        inside = tested.select("a", "b", F.col("both").alias(f"in_{hub}"))
        members = members.withColumns({"a": F.least("cls", hub), "b": F.greatest("cls", hub)}).join(inside, ["a", "b"], "left").drop("a", "b")
        members = members.withColumn(f"in_{hub}", F.when(F.col("cls") == F.col(hub), F.col("size")).otherwise(F.col(f"in_{hub}")))
    members = stash(members.select("key", "cls", "c", "size", "common", "in_lo", "in_hi"), "near-open")
    others = members.select("key", *(F.col(x).alias(f"{x}2") for x in ("cls", "c", "size", "common", "in_lo", "in_hi")))
    near = F.col("c") < F.col("c2")
    for hub in ("in_lo", "in_hi"):
        most = F.least(F.col(hub), F.col(f"{hub}2")) + F.least(F.col("common") - F.col(hub), F.col("common2") - F.col(f"{hub}2"))
        near = near & ((100 + PERCENT) * most >= PERCENT * (F.col("size") + F.col("size2")))
    pairs = members.join(others, "key").where(near)
    return pairs.select(F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row."""
    signs = stash(signatures(docs, id_col, text_col), "near-signs")
    sign = ["n", "s1", "s2"]
    classes = signs.where("n > 0 and id is not null").groupBy(*sign).agg(F.min(F.struct("id", "bands")).alias("m")).select(*sign, F.col("m.id").alias("rep"), F.col("m.bands").alias("bands"))
    classes = stash(classes.withColumn("cls", F.monotonically_increasing_id()), "near-classes")
    keys, members = shared_keys(classes)
    members = stash(members, "near-members")
    discard(keys)

    wanted = classes.join(members.select("cls").distinct(), "cls", "left_semi").groupBy("rep").agg(F.collect_list(F.struct("cls", *sign)).alias("classes"))
    own = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).join(wanted, "rep").select("rep", "text", "classes")

    def sets_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, out, signed = texts(batch.column(1)), [], []
        for a, b in portions(found):
            sets, ends = shingle_sets(found[a:b])
            out += [sets[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]
            signed += zip(np.diff(ends).tolist(), *(x.view(np.int64).tolist() for x in set_signs(sets, ends)), strict=True)
        numbers = [{(c["n"], c["s1"], c["s2"]): c["cls"] for c in known}.get(own) for known, own in zip(batch.column(2).to_pylist(), signed, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), batch.column(0), pa.array(out, pa.binary())], names=["cls", "rep", "shingles"])

    # a text of the id whose class stands for another id has no number here
    sets = stash(map_rows(own, "cls long, rep long, shingles binary", sets_of).where("cls is not null"), "near-sets")

    # rows of one id are one document, and so link their classes
    placed = stash(signs.join(classes.drop("bands", "cls"), sign, "left").select("id", "n", "rep"), "near-placed")
    discard(signs, classes)
    same = placed.where("rep is not null and id is not null").withColumn("lo", F.min("rep").over(Window.partitionBy("id"))).where("lo < rep").select(F.col("rep").alias("a"), F.col("lo").alias("b"))

    links, tested = same, None
    for hub in ("lo", "hi"):
        pairs = members.select(F.least("cls", hub).alias("a"), F.greatest("cls", hub).alias("b")).where("a < b").distinct()
        pairs = pairs.join(tested, ["a", "b"], "left_anti") if tested is not None else pairs
        results = stash(compared(pairs, sets).distinct(), "near-compared")
        tested = tested.union(results) if tested is not None else results
        links = links.union(results.where("similar").select("rep_a", "rep_b"))
        found = components(links)
        members = members.drop("c").join(found, members["rep"] == found["v"], "left").withColumn("c", F.coalesce("c", "rep")).drop("v")
        apart = members.groupBy("key").agg(F.min("c").alias("c_lo"), F.max("c").alias("c_hi")).where("c_lo < c_hi").select("key")
        members = stash(members.join(apart, "key").select("key", "cls", "rep", "lo", "hi", "c"), "near-members")
    pairs = open_pairs(members, sets, tested).join(tested, ["a", "b"], "left_anti")
    links = links.union(stash(compared(pairs, sets), "near-compared").where("similar").select("rep_a", "rep_b"))
    found = components(links)

    out = placed.join(found, placed["rep"] == found["v"], "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("c", "rep", "id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
