"""Encoding, decoding and counting against the tokenizers library."""

import hashlib
import random
from array import array

import public_tokenizers
from tokenizers import Tokenizer

from demandspark.llm.bpe_count import Remembered, count_tokens, counter
from demandspark.llm.bpe_encode import encode_documents, encoder
from demandspark.llm.pretokens import CHUNK

from tests.llm.data import both

BYTE, WORD = (public_tokenizers.path(f"{x}.json") for x in ("byte_bpe_50k", "word_bpe_49k"))
PIECES = ["a", "the", "  ", " ", "\n", "\t", "12", "!", "'s", "'RE", "é", "é", "Σ", "ß", "İ", "日本", "😀", "\x00", "\x1c", "\x85", "​", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "aaaa", "&&&", "\r\n", "x" * 40]


def odd_texts(n=3000):
    rng = random.Random(3)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(n)]


def test_encoder_equals_the_library():
    own, library = encoder(BYTE), Tokenizer.from_file(BYTE)
    for text, expected in zip(odd_texts(), library.encode_batch(odd_texts(), add_special_tokens=False), strict=True):
        packed = b"".join(own.encode(text))
        assert list(array("I", packed)) == expected.ids, text
        assert own.decode(packed).decode() == library.decode(expected.ids, skip_special_tokens=False) == text


def test_every_token_is_its_own_encoding():
    assert all(encoder(BYTE).whole(i) for i in encoder(BYTE).text)


def test_counter_equals_the_library():
    own, library = counter(WORD), Tokenizer.from_file(WORD)
    for text, expected in zip(odd_texts(), library.encode_batch(odd_texts(), add_special_tokens=False), strict=True):
        assert own.count(text) == len(expected.ids), text


def test_long_texts_are_cut_at_safe_places():
    text = "".join(odd_texts(200)) * 200
    assert len(text) > 2 * CHUNK
    ids = Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids
    assert list(array("I", b"".join(encoder(BYTE).encode(text)))) == ids
    assert counter(WORD).count(text) == len(Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids)


def test_remembered_forgets_and_stays_right():
    class Double(Remembered):
        def find(self, key):
            return 2 * key

    seen = Double(3)
    assert [seen[k] for k in [1, 2, 3, 4, 1, 5, 6, 7, 1]] == [2, 4, 6, 8, 2, 10, 12, 14, 2]
    assert len(seen) + len(seen.older) <= 6


def test_documents(spark):
    docs = both(spark)
    library, counts = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    expected, expected_counts = [], []
    for doc, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        expected.append((doc, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        n = len(counts.encode(text, add_special_tokens=False).ids)
        expected_counts.append((doc, len(text.encode()), n, n > 2048))
    assert sorted(map(tuple, encode_documents(docs, BYTE).collect()), key=str) == sorted(expected, key=str)
    assert sorted(map(tuple, count_tokens(docs, WORD).collect()), key=str) == sorted(expected_counts, key=str)
    assert encode_documents(docs.limit(0), BYTE).count() == count_tokens(docs.limit(0), WORD).count() == 0


def test_ids_and_text_come_back(spark):
    rows = encode_documents(both(spark), BYTE, keep_ids=True).select("doc_id", "ids", "decoded").collect()
    texts = {(r.doc_id, r.text or "") for r in both(spark).collect()}
    assert {(r.doc_id, r.decoded) for r in rows} == texts
