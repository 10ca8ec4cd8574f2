"""Character classes for the tokenizers' word patterns, for Python's ``re``.

``re`` has no ``\\p{L}``; the classes are written out as ranges from the
Unicode database. ``SPACE`` is Unicode White_Space, which ``\\s`` means to the
tokenizers (Python's ``\\s`` also takes U+001C to U+001F).
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
CHUNK = 1 << 20


@functools.lru_cache
def category(major: str) -> str:
    """A ``re`` class body of all code points whose category starts with ``major``."""
    body, start = [], None
    for code in range(0x110001):
        inside = code < 0x110000 and unicodedata.category(chr(code))[0] == major
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            body.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(body)


@functools.lru_cache
def space_led_words() -> re.Pattern:
    """Words that keep one leading space, as byte-level BPE cuts them."""
    letter, number = category("L"), category("N")
    return re.compile(f" ?[{letter}]+|{CONTRACTIONS}| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


@functools.lru_cache
def bare_words() -> re.Pattern:
    """Words without white space; each digit is a word."""
    letter, number = category("L"), category("N")
    return re.compile(f"[{letter}]+|{CONTRACTIONS}|[{number}]|[^{SPACE}{letter}{number}]+")


BESIDE = re.compile(f" [{SPACE}]|[{SPACE}] ")  # a space that isn't alone
CUT = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")


def chunks(text: str) -> Iterator[str]:
    """The text in parts of about CHUNK characters, cut before a lone space, where no word of either pattern goes on."""
    if len(text) <= CHUNK:
        yield text
        return
    start = 0
    while start < len(text):
        found = CUT.search(text, start + CHUNK)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end
