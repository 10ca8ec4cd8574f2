"""Substring dedup with repeated-phrase automata.

A window is WINDOW consecutive words of one document. Words covered by a
window that also starts in a document with a smaller id are removed.

1. Streaming every document, each window is reduced to its anchor, the GRAM
   words in it with the smallest hash; equal windows have equal anchors.
   Documents with equal word sequences stand as one, the smallest id.
2. Anchors found in two documents or more lead to segments, the stretches of
   windows with such an anchor. Only their windows are counted: those that
   occur in several documents are recurring, and ``first`` is the smallest id.
3. Runs of recurring windows in their first document are the passages. They
   are dealt to shards of about SHARD_WINDOWS windows, and each shard's
   passages are compiled to an Aho-Corasick automaton of their anchors' words.
   A document's segments are sent to the shards that have one of its windows;
   a shard with much text is repeated, so that a group holds about SHARD_BYTES.
4. Streaming the segments through the automata gives every occurrence of an
   anchor; it is extended word by word as far as passage and segment agree.
   Runs of WINDOW words and more are removed where the passage's document
   comes first. This comparison is of the words themselves, so the result
   doesn't hang on hashes.

Defined cases: a null text has no words; texts of fewer than WINDOW words keep
all. Rows with a null id take no part and keep all their words. Rows that
repeat an id are one document, and none of them removes words from another.
An empty table gives an empty result. Only id and text are read, so other
names cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import discard, map_rows, settle, stash
from demandspark.llm.words import MIX_A, MIX_B, KNOWN, hashed_words, mix, portions, texts, window_hashes

WINDOW, GRAM = 13, 5
SPAN = WINDOW - GRAM + 1  # grams of a window
SHARD_WINDOWS = 32_000
SHARD_BYTES = 2 << 20

def anchors_of(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text's windows: the smallest gram hash of each, where a text's begin (n + 1 offsets), and the word each starts at."""
    grams = window_hashes(hashes, GRAM)
    n = max(len(hashes) - WINDOW + 1, 0)
    least = grams[:n].copy()
    for k in range(1, SPAN):
        np.minimum(least, grams[k:k + n], out=least)
    counts = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(offsets[-1]) + np.repeat(starts[:-1] - offsets[:-1], counts)
    return least[place], offsets, place


def windows_hashed(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window from those of its first, middle and last gram, which cover it."""
    grams = window_hashes(hashes, GRAM)
    n = max(len(hashes) - WINDOW + 1, 0)
    first, middle, last = (grams[k:k + n] for k in (0, (WINDOW - GRAM) // 2, WINDOW - GRAM))
    return mix((first * MIX_A ^ middle) * MIX_B + last), mix((last * MIX_A ^ first) * MIX_B + middle)


def sign(words: list[bytes]) -> tuple[int, int]:
    """A 128-bit sign of the word sequence, as two signed integers."""
    digest = xxhash.xxh3_128_digest(b" ".join(words))
    return tuple(np.frombuffer(digest, np.int64).tolist())


def _signed(values: list) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.uint64).view(np.int64)))


def _parts(batch: pa.RecordBatch):
    """(first row, words, word hashes, their starts) of portions of a batch whose second column is the text."""
    found = texts(batch.column(1))
    for a, b in portions(found):
        words = [t.split() for t in found[a:b]]
        yield a, words, *hashed_words(words, KNOWN)


def documents_anchors(docs: DataFrame) -> DataFrame:
    """id, n (words), s1 and s2 (sign of the word sequence), anchors (distinct)."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, s1, s2, anchors = [], [], [], []
        for _, words, hashes, starts in _parts(batch):
            own, offsets, _ = anchors_of(hashes, starts)
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            new[offsets[:-1][offsets[:-1] < len(own)]] = True
            kept = np.concatenate([[0], np.cumsum(new)])[offsets]
            own = own[new]
            n.append(np.diff(starts))
            for text in words:
                one, two = sign(text)
                s1.append(one)
                s2.append(two)
            anchors += [np.unique(own[i:j]) for i, j in zip(kept[:-1], kept[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n), pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), _lists(anchors)], names=["id", "n", "s1", "s2", "anchors"])

    return map_rows(docs, "id long, n long, s1 long, s2 long, anchors array<long>", one)


def segments_of(docs: DataFrame) -> DataFrame:
    """``docs`` has id, text, shared (its anchors that other documents have) -> id, s1, start and text of each segment, and
    the two hashes of each of its windows that has a shared anchor."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        shared = batch.column(2)
        rows, s1, at, found, w1, w2 = [], [], [], [], [], []
        for row, words, hashes, starts in _parts(batch):
            own, offsets, place = anchors_of(hashes, starts)
            one, two = windows_hashed(hashes)
            for k, text in enumerate(words):
                i, j = offsets[k], offsets[k + 1]
                if i == j:
                    continue
                wanted = np.sort(shared[row + k].values.to_numpy().view(np.uint64))
                hit = wanted[np.minimum(np.searchsorted(wanted, own[i:j]), len(wanted) - 1)] == own[i:j]
                hits = np.flatnonzero(hit)
                if not len(hits):
                    continue
                key = sign(text)[0]
                # hits up to WINDOW apart cover one stretch of words
                ends = np.flatnonzero(np.diff(hits) > WINDOW)
                for a, b in zip(hits[np.concatenate([[0], ends + 1])].tolist(), hits[np.concatenate([ends, [len(hits) - 1]])].tolist(), strict=True):
                    windows = place[i + a:i + b + 1][hit[a:b + 1]]
                    once, which = np.unique(one[windows], return_index=True)
                    rows.append(row + k)
                    s1.append(key)
                    at.append(a)
                    found.append(b" ".join(text[a:b + WINDOW]))
                    w1.append(once)
                    w2.append(two[windows][which] >> np.uint64(33))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(s1, pa.int64()), pa.array(at, pa.int64()), pa.array(found, pa.binary()).cast(pa.string()), _lists(w1), _lists(w2).cast(pa.list_(pa.int32()))], names=["id", "s1", "start", "text", "w1", "w2"])

    return map_rows(docs, "id long, s1 long, start long, text string, w1 array<long>, w2 array<int>", one)


def passages_in(firsts: DataFrame) -> DataFrame:
    """``firsts`` has id, text (a segment of the document), own (windows first seen there) -> first, text."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, found = [], []
        for row, words, hashes, starts in _parts(batch):
            for k, text in enumerate(words):
                hit = np.isin(windows_hashed(hashes[starts[k]:starts[k + 1]])[0], batch.column(2)[row + k].values.to_numpy().view(np.uint64))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    rows.append(row + k)
                    found.append(b" ".join(text[a:b + WINDOW - 1]))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.binary()).cast(pa.string())], names=["first", "text"])

    return map_rows(firsts, "first long, text string", one)


def compiled(passages: list[list[bytes]]) -> ahocorasick.Automaton:
    """Automaton of the passages' anchor words; a hit gives the anchor's length and its (passage, place)s."""
    hashes, starts = hashed_words(passages, KNOWN)
    places: dict[str, list[tuple[int, int]]] = {}
    for k, words in enumerate(passages):
        grams = window_hashes(hashes[starts[k]:starts[k + 1]], GRAM)
        view = np.lib.stride_tricks.sliding_window_view(grams, SPAN)
        for at in np.unique(view.argmin(1) + np.arange(len(view))).tolist():
            places.setdefault(" " + b" ".join(words[at:at + GRAM]).decode() + " ", []).append((k, at))
    automaton = ahocorasick.Automaton()
    for phrase, found in places.items():
        automaton.add_word(phrase, (len(phrase), found))
    automaton.make_automaton()
    return automaton


def occurrences(automaton: ahocorasick.Automaton, passages: list[list[bytes]], first: list[int], doc: int, segment: str) -> list[tuple[int, int]]:
    """Word ranges of the document's segment that are WINDOW words or more of passages of smaller ids, joined where they overlap."""
    words = segment.encode().split()
    line = " " + segment + " "
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in segment.split(" ")])]).tolist()
    out, seen = [], {}
    for end, (size, places) in automaton.iter(line):
        at = bisect_right(starts, end - size + 1) - 1
        for k, place in places:
            if first[k] >= doc:
                continue
            shift = at - place
            if seen.get((k, shift), -1) > at:
                continue
            own = passages[k]
            lo, hi = at, at + GRAM
            while lo > 0 and lo - shift > 0 and words[lo - 1] == own[lo - 1 - shift]:
                lo -= 1
            while hi < len(words) and hi - shift < len(own) and words[hi] == own[hi - shift]:
                hi += 1
            seen[k, shift] = hi
            if hi - lo >= WINDOW:
                out.append((lo, hi))
    out.sort()
    joined: list[tuple[int, int]] = []
    for lo, hi in out:
        if joined and lo <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(hi, joined[-1][1]))
        else:
            joined.append((lo, hi))
    return joined


def located(passages: pd.DataFrame, segments: pd.DataFrame) -> pd.DataFrame:
    """Removed word ranges of one shard's segments."""
    rows = []
    settle(__name__)
    if len(passages) and len(segments):
        words = [t.encode().split() for t in passages["text"]]
        first = passages["first"].tolist()
        automaton = compiled(words)
        for doc, s1, start, text in zip(segments["id"], segments["s1"], segments["start"], segments["text"], strict=True):
            for lo, hi in occurrences(automaton, words, first, doc, text):
                rows.append((doc, s1, start + lo, start + hi))
    return pd.DataFrame(rows, columns=["id", "s1", "lo", "hi"])


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, s1 (sign of the row's words), lo, hi: word ranges to remove; they may overlap."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    anchors = stash(documents_anchors(plain), "span-anchors")
    every = anchors.where(F.col("n") >= WINDOW)
    least = every.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    copies = every.select("id", "n", "s1", "s2").distinct().join(least, ["n", "s1", "s2"]).where("rep < id").select("id", "s1", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"))
    copies = stash(copies, "span-copies")

    single = every.select("id", "s1", "anchors").join(copies.select("id", "s1"), ["id", "s1"], "left_anti").select("id", F.explode("anchors").alias("anchor"))
    met = single.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor")
    shared = stash(single.join(met, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("shared")), "span-shared")
    discard(anchors)
    segments = segments_of(plain.join(shared, "id").select("id", "text", "shared"))
    segments = stash(segments.join(copies.select("id", "s1"), ["id", "s1"], "left_anti").select("id", "s1", "start", "text", "w1", "w2"), "span-segments")

    windows = segments.select("id", F.explode(F.arrays_zip("w1", "w2")).alias("w")).select("w.w1", "w.w2", "id")
    recurring = windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("w1", "w2", "first")
    recurring = stash(recurring, "span-recurring")
    shards = recurring.count() // SHARD_WINDOWS + 1
    own = recurring.groupBy(F.col("first").alias("id")).agg(F.collect_list("w1").alias("own"))
    passages = passages_in(segments.select("id", "text").join(own, "id").select("id", "text", "own"))
    passages = stash(passages.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards))), "span-passages")

    # documents go to the shards of the passages' documents
    routes = windows.join(recurring, ["w1", "w2"]).where("first < id").select("id", F.pmod(F.xxhash64("first"), F.lit(shards)).alias("shard")).distinct()
    routed = stash(segments.select("id", "s1", "start", "text").join(routes, "id"), "span-routed")
    discard(recurring)
    sizes = routed.groupBy("shard").agg(F.ceil(F.sum(F.length("text")) / SHARD_BYTES).alias("parts"))
    sizes = stash(sizes, "span-sizes")

    def part(key: Column, parts: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("part")), parts)

    text_parts = routed.join(sizes, "shard").withColumn("part", part(F.col("id"), F.col("parts"))).select("shard", "part", "id", "s1", "start", "text")
    phrase_parts = passages.join(sizes, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "first", "text")
    spans = phrase_parts.groupBy("shard", "part").cogroup(text_parts.groupBy("shard", "part")).applyInPandas(located, "id long, s1 long, lo long, hi long")
    return copies.unionByName(spans)


def with_removed(docs: DataFrame, id_col: str, text_col: str, schema: str, fn) -> DataFrame:
    """Maps every row of ``docs`` with its removed ranges: fn(columns but the last, kept words' mask, words)."""
    spans = stash(removed_spans(docs, id_col, text_col), "spans")
    listed = spans.groupBy("id", "s1").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")).groupBy("id").agg(F.collect_list(F.struct("s1", "ranges")).alias("_spans"))
    rows = docs.join(listed.withColumnRenamed("id", "_id"), F.col(id_col).cast("long") == F.col("_id"), "left").drop("_id")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, found = batch.column(batch.num_columns - 1), texts(batch.column(batch.schema.get_field_index(text_col)))
        words_of, kept_of = [], []
        for text, span in zip(found, spans, strict=True):
            words = text.split()
            kept = np.ones(len(words), bool)
            if span.is_valid:
                key = sign(words)[0]
                for part in span.as_py():
                    if part["s1"] == key:
                        for r in part["ranges"]:
                            kept[r["lo"]:r["hi"]] = False
            words_of.append(words)
            kept_of.append(kept)
        return fn(batch, words_of, kept_of)

    return map_rows(rows, schema, one)


def kept_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256`` of every row."""

    def digest(batch: pa.RecordBatch, words: list[list[bytes]], kept: list[np.ndarray]) -> pa.RecordBatch:
        shas = [hashlib.sha256(b" ".join(w if k.all() else [x for x, keep in zip(w, k, strict=True) if keep])).hexdigest() for w, k in zip(words, kept, strict=True)]
        n, left = [len(w) for w in words], [int(k.sum()) for k in kept]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([a - b for a, b in zip(n, left, strict=True)], pa.int64()), pa.array(shas, pa.string())], names=["id", "n_words", "n_removed", "kept_sha256"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_removed(rows, "id", "text", f"id {kind}, n_words long, n_removed long, kept_sha256 string", digest).withColumnRenamed("id", id_col)


def cleaned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the removed words: a text that loses words is the kept ones joined by one space, any other stays as it is."""
    columns = docs.columns

    def clean(batch: pa.RecordBatch, words: list[list[bytes]], kept: list[np.ndarray]) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text_col)
        old = batch.column(at).cast(pa.binary()).to_pylist()
        new = [o if k.all() else b" ".join([x for x, keep in zip(w, k, strict=True) if keep]) for o, w, k in zip(old, words, kept, strict=True)]
        out = [pa.array(new, pa.binary()).cast(pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
        return pa.RecordBatch.from_arrays(out, names=columns)

    return with_removed(docs, id_col, text_col, docs.schema, clean)
