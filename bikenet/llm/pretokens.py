"""Split texts into the words that byte-level BPE encodes one by one.

The words are those of the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

found on code-point arrays: runs of one class, a blank moved to the run behind it, and the seven
endings cut off behind an apostrophe.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

OTHER, LETTER, NUMBER, SPACE = range(4)
KINDS = {"L": LETTER, "N": NUMBER}

_SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_ONE = [ord(c) for c in "stmd"]
_TWO = [tuple(map(ord, pair)) for pair in ("re", "ve", "ll")]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(sys.maxunicode + 1))
    table = np.full(len(every), OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for found in regex.finditer(pattern, every):
            table[found.start() : found.end()] = kind
    # where two editions of Unicode differ, the tokenizers library's own edition decides
    older = np.fromiter((KINDS.get(unicodedata.category(c)[0], OTHER) for c in every), np.uint8, len(every))
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for c in np.flatnonzero(older != table):
        spans = [span for _, span in split(f"a{every[c]}1")]
        table[c] = LETTER if spans[0] == (0, 2) else NUMBER if spans[1] == (1, 3) else OTHER
    table[list(_SPACES)] = SPACE
    return table


def split_words(texts: list[str]) -> tuple[list[str], list[int]]:
    """All words of the texts in order, and for each text the number of words up to its end."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    size = len(points)
    ends = np.cumsum([len(t) for t in texts])
    if not size:
        return [], [0] * len(texts)
    kind = classes()[points]
    opens = np.zeros(size + 1, dtype=bool)  # a text begins here
    opens[0] = True
    opens[ends] = True
    start = opens.copy()
    start[1:size] |= kind[1:] != kind[:-1]

    # the last white character before a word: a blank joins the word, another stands alone
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~opens[1:size])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False

    mark = np.flatnonzero((points[:-1] == 0x27) & start[: size - 1] & (kind[1:] == LETTER) & ~opens[1:size])
    if len(mark):
        first = points[mark + 1]
        one = mark[np.isin(first, _ONE)]
        start[one + 1] = False
        start[one + 2] = True
        mark = mark[mark + 2 < size]
        mark = mark[~opens[mark + 2]]
        first, second = points[mark + 1], points[mark + 2]
        two = mark[np.logical_or.reduce([(first == a) & (second == b) for a, b in _TWO])]
        start[two + 1] = False
        start[two + 3] = True

    at = np.flatnonzero(start[:size])
    cuts = at.tolist()
    words = [whole[a:b] for a, b in zip(cuts, [*cuts[1:], size])]
    return words, np.searchsorted(at, ends).tolist()
