"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

For each prefix of a word exactly one token can come last in its encoding. An
automaton with suffix links over the whole vocabulary yields the tokens that
end at each place, longest first; the first whose predecessor (the last token
of the prefix before it) is compatible is that prefix's last token. Following
the stored tokens back from the end gives the ids.

Two tokens are compatible when no merge across their border would fire while
both sides still show the symbols it needs. The symbols that touch the border
are the right spine of the left token and the left spine of the right one; a
symbol is there until its parent's merge consumes it.

Words repeat, so packed ids are remembered, up to a fixed number of words per
Python worker. One pass over the rows, no shuffle.

Defined cases: a null text counts as empty (no ids); a null id and repeated
rows are kept as they are; an empty table gives an empty result; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from demandspark.llm.bpe_count import Remembered, Words, byte_symbols
from demandspark.llm.common import forgets, map_rows
from demandspark.llm.pretokens import BESIDE, chunks, space_led_words

REMEMBER = 220_000  # stretches of text whose ids a worker remembers (twice as many for a while)
PAIRS, SPINES = 400_000, 20_000  # remembered verdicts on token pairs, and spines of tokens
NEVER = 1 << 60


class PrefixEncoder(Remembered):
    """A space and the stretch up to the next one -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, remember: int):
        super().__init__(remember)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        raw = {s: chr(b) for b, s in enumerate(byte_symbols())}  # symbol -> byte as a Latin-1 character
        self.text = {i: "".join(raw[c] for c in token) for token, i in model["vocab"].items()}
        number = {t: i for i, t in self.text.items()}
        self.rank, self.parts = {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            a, b = ("".join(raw[c] for c in x) for x in (a, b))
            self.rank[number[a], number[b]] = rank
            self.parts[number[a + b]] = (number[a], number[b], rank)
        self.fits: dict[int, bool] = {}  # left token * 2^20 + right token
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in number.items():
            if self.whole(i):
                self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.bytes = {i: t.encode("latin-1") for i, t in self.text.items()}
        self.size = {i: len(t) for i, t in self.bytes.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.mark = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = space_led_words()
        self.known = Words(remember // 2)
        self.known.find = self.word

    def spine(self, token: int, side: int, known: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The token and its descendants along one border, each with the rank of the merge that consumes it."""
        if token not in known:
            if len(known) >= SPINES:
                known.clear()
            out, gone, at = [], NEVER, token
            while True:
                out.append((at, gone))
                if at not in self.parts:
                    break
                gone = self.parts[at][2]
                at = self.parts[at][side]
            known[token] = out
        return known[token]

    def compatible(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether no merge of a rank under ``until`` crosses the border of a and b."""
        for x, x_gone in self.spine(a, 1, self.right):
            for y, y_gone in self.spine(b, 0, self.left):
                rank = self.rank.get((x, y))
                # of equal merges the leftmost goes first
                if rank is not None and rank < x_gone and rank <= y_gone and rank < until:
                    return False
        return True

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it alone."""
        if token not in self.parts:
            return True
        a, b, rank = self.parts[token]
        return self.compatible(a, b, rank)

    def find(self, stretch: str) -> bytes:
        return self.plain(" " + stretch)

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.words.findall(text)))

    def word(self, word: str) -> bytes:
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        data = word.encode().decode("latin-1")
        last, fits = [-1] * (len(data) + 1), self.fits
        for at, (size, token) in self.automaton.iter(data):
            at += 1
            if last[at] >= 0:
                continue
            start = at - size
            if start:
                pair = last[start] << 20 | token
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = self.compatible(last[start], token)
                if not fit:
                    continue
            last[at] = token
        ids, at = array("I"), len(data)
        while at:
            ids.append(last[at])
            at -= self.size[last[at]]
        ids.reverse()
        return ids.tobytes()

    def ordinary(self, text: str) -> bytes:
        """Ids of a text without special tokens; a lone space starts a word, so the text may be cut there."""
        if BESIDE.search(text):
            return self.plain(text)
        first, *rest = text.split(" ")
        return self.plain(first) + b"".join(map(self.__getitem__, rest))

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids of the text, part by part."""
        for part in chunks(text):
            if self.mark and "<|" in part:
                for piece in self.mark.split(part):
                    if piece in self.special:
                        yield array("I", [self.special[piece]]).tobytes()
                    else:
                        yield self.ordinary(piece)
            else:
                yield self.ordinary(part)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, array("I", packed)))


@functools.lru_cache(maxsize=2)
def encoder(path: str, remember: int = REMEMBER) -> PrefixEncoder:
    return PrefixEncoder(path, remember)


forgets.append(encoder.cache_clear)


def encode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """Encode every text, then decode the ids.

    Returns ``id_col, n_tokens, ids_sha256, decoded_sha256``, and with
    ``keep_ids`` the ids (``array<int>``) and the decoded text as well.
    ``remember`` bounds the stretches of text whose ids a worker keeps.
    """
    kind = dict(df.dtypes)[id_col]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = encoder(vocabulary, remember)
        n, ids_sha, text_sha, ids, back = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            of_ids, of_text, size = hashlib.sha256(), hashlib.sha256(), 0
            kept_ids, kept_text = array("I"), []
            for packed in model.encode(text or ""):
                decoded = model.decode(packed)
                size += len(packed) // 4
                of_ids.update(packed)
                of_text.update(decoded)
                if keep_ids:
                    kept_ids.frombytes(packed)
                    kept_text.append(decoded)
            n.append(size)
            ids_sha.append(of_ids.hexdigest())
            text_sha.append(of_text.hexdigest())
            ids.append(list(kept_ids))
            back.append(b"".join(kept_text).decode("utf-8", "replace"))
        columns = {"id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if keep_ids:
            columns |= {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(back, pa.string())}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")
    out = map_rows(df.select(df[id_col].alias("id"), df[text_col].alias("text")), schema, one)
    return out.withColumnRenamed("id", id_col)
