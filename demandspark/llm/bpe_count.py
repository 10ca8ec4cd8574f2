"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a doubly linked list; a heap holds its adjacent pairs
that may merge, by rank and then place. The lowest is popped and merged until
none is left. The count is the number of initial symbols less the number of
merges; no identifier leaves the loop.

Words repeat, so their counts are remembered, up to a fixed number of words
per Python worker. One pass over the rows, no shuffle.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null id and
repeated rows are kept as they are; an empty table gives an empty result;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from demandspark.llm.common import forgets, map_rows
from demandspark.llm.pretokens import bare_words, chunks



def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return [table[b] for b in range(256)]


class Remembered(dict):
    """A dict whose ``find`` works out missing values and forgets those long unused.

    It holds ``bound`` entries and the ``bound`` before them; what is asked for
    again moves back to the front.
    """

    def __init__(self, bound: int):
        super().__init__()
        self.bound, self.older = bound, {}

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        self[key] = value
        return value

    def find(self, key):
        raise NotImplementedError


class Words(Remembered):
    """Single words."""


class MergeCounter(Remembered):
    """Space-free stretch of a text -> number of tokens."""

    def __init__(self, path: str):
        super().__init__(250_000)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        number = model["vocab"]
        symbols = byte_symbols()
        self.inner = [number[s] for s in symbols]
        self.final = [number[s + end] for s in symbols]
        self.merges = {(number[a], number[b]): (rank, number[a + b if not end or not a.endswith(end) else ""])
                       for rank, (a, b) in enumerate(model["merges"])}
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.words = bare_words()
        self.known = Words(100_000)
        self.known.find = lambda word: len(data := word.encode()) - self.merged(data)

    def find(self, stretch: str) -> int:
        # one letter at a time, as the library lowers it: no final sigma
        plain = unicodedata.normalize("NFC", stretch).replace("Σ", "σ").lower()
        return sum(map(self.known.__getitem__, self.words.findall(plain)))

    def merged(self, data: bytes) -> int:
        """How many merges the word's bytes undergo."""
        ids = [self.inner[b] for b in data[:-1]] + [self.final[data[-1]]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.merges
        heap = [(hit[0], i, ids[i], ids[i + 1], hit[1]) for i in range(n - 1) if (hit := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has merged meanwhile
            merges += 1
            ids[i], ids[j] = whole, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if hit := pairs.get((whole, ids[k])):
                    heapq.heappush(heap, (hit[0], i, whole, ids[k], hit[1]))
            if (h := before[i]) >= 0 and (hit := pairs.get((ids[h], whole))):
                heapq.heappush(heap, (hit[0], h, ids[h], whole, hit[1]))
        return merges

    def count(self, text: str) -> int:
        total = 0
        for part in chunks(text):
            total += len(self.special.findall(part)) if "<|" in part else 0
            for piece in self.special.split(part) if "<|" in part else (part,):
                total += sum(map(self.__getitem__, piece.split(" ")))  # no word has a space
        return total


@functools.lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


forgets.append(counter.cache_clear)


def count_tokens(df: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row."""
    kind = dict(df.dtypes)[id_col]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = counter(vocabulary)
        found = [x or "" for x in batch.column(1).to_pylist()]
        tokens = [model.count(x) for x in found]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x.encode()) for x in found], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
            names=["id", "n_bytes", "n_tokens", "over_limit"])

    out = map_rows(df.select(df[id_col].alias("id"), df[text_col].alias("text")), f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", one)
    return out.withColumnRenamed("id", id_col)
