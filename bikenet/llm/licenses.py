"""License statements in texts, by patience alignment with templates.

Words that occur once in the text and once in the template are anchors; the longest increasing
subsequence of their places is kept, and the gaps between neighbouring anchors are aligned in the
same way. A gap without anchors is aligned by its longest common subsequence. The coverage is the
share of the template's words that are aligned.

Only regions that can reach the coverage are aligned: a region that holds fewer of the template's
words than the coverage asks for, over twice the template's length, cannot; nor can one that does not
hold them as often as the template, which tells long templates from plain prose. What is found is compared
at the end, and of statements that overlap the one with the most aligned words stays.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.llm.license_notices import NOTICES, whole_texts
from bikenet.llm.text_arrays import PUNCTUATION, Words, column_words

#: One-line statements of public licenses. Fixed values; :func:`known` adds notices and whole texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "BSD-3-Clause": "Released under the 3-Clause BSD License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC0-1.0": "Released under CC0 1.0 Universal",
}
#: Least share of a template's words that must be aligned.
COVERAGE = 0.8


def known() -> list[tuple[str, str]]:
    """(license, words) of all statements, notices and whole texts."""
    return [*TEMPLATES.items(), *NOTICES, *whole_texts()]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first place, that grows in the second."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, at) in enumerate(pairs):
        k = bisect_left(tails, at)
        back.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(at)
            ends.append(i)
        else:
            tails[k], ends[k] = at, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence.

    Bit j of ``rows[i]`` tells that the longest of ``a[i:]`` and ``b[j:]`` is one longer than that
    without ``b[j]``; a row takes a few operations on integers of ``len(b)`` bits.
    """
    width = len(b)
    whole = (1 << width) - 1
    places: dict = {}
    for j, word in enumerate(reversed(b)):
        places[word] = places.get(word, 0) | 1 << j
    rows, left = [0], whole
    for word in reversed(a):
        same = left & places.get(word, 0)
        left = ((left + same) | (left - same)) & whole
        rows.append(whole & ~left)
    rows.reverse()
    out, i, j = [], 0, 0
    while i < len(a) and j < width:
        rest = (1 << (width - j)) - 1
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif (rows[i + 1] & rest).bit_count() >= (rows[i] & rest >> 1).bit_count():
            i += 1
        else:
            j += 1
    return out


def align(template: list, text: list) -> list[tuple[int, int]]:
    """Pairs of places with equal words, growing in both."""
    if not template or not text:
        return []
    once_here, once_there = Counter(template), Counter(text)
    place = {w: j for j, w in enumerate(text) if once_there[w] == 1}
    anchors = _increasing([(i, place[w]) for i, w in enumerate(template) if once_here[w] == 1 and w in place])
    if not anchors:
        return _common(template, text)
    out: list[tuple[int, int]] = []
    i = j = 0
    for a, b in [*anchors, (len(template), len(text))]:
        out += [(i + x, j + y) for x, y in align(template[i:a], text[j:b])]
        out.append((a, b))
        i, j = a + 1, b + 1
    return out[:-1]


def occurrences(template: list, text: list, least: float) -> Iterator[list[int]]:
    """Places of the aligned words of each occurrence with ``least`` of them, over less than two templates' length.

    Of equally many aligned words those that begin last are taken, so that a statement borrows no words
    of the one before it. On both sides of an occurrence, or of the widest gap in it, others are sought.
    """
    waiting = [(0, len(text))]
    while waiting:
        low, high = waiting.pop()
        if high - low < least:
            continue
        pairs = align(template, text[low:high])
        if len(pairs) < least:
            continue
        places = [low + at for _, at in pairs]
        first, last = places[0], places[-1]
        later = align(template[::-1], text[first : last + 1][::-1])
        if len(later) >= len(pairs):
            places = [last - at for _, at in reversed(later)]
        if places[-1] - places[0] < 2 * len(template):
            yield places
        gap, before = max(((b - a, -a) for a, b in zip(places, places[1:])), default=(1, 0))
        if gap > 1:
            waiting += [(low, 1 - before), (gap - before, high)]
        else:
            waiting += [(low, places[0]), (places[-1] + 1, high)]


class Templates:
    """Templates as word hashes, with a table that tells which of them a word belongs to."""

    def __init__(self, templates: dict[str, str] | list[tuple[str, str]], coverage: float):
        listed = list(templates.items()) if isinstance(templates, dict) else templates
        self.names = [name for name, _ in listed]
        self.coverage = coverage
        self.words: list[list[int]] = []
        for _, _, words in column_words(pa.array([words for _, words in listed], pa.string()), PUNCTUATION):
            own = words.hashes()
            self.words += [own[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
        self.counts = [np.unique(np.array(own, dtype=np.uint64), return_counts=True) for own in self.words]
        self.slots = np.zeros((-(-len(self.words) // 64), 1 << 16), dtype=np.uint64)
        for k, own in enumerate(self.words):
            for word in own:
                self.slots[k // 64, word & 0xFFFF] |= np.uint64(1 << (k % 64))

    def regions(self, words: Words, own: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(template, row, first, end): runs of words that may reach the coverage."""
        seen = self.slots[:, own & np.uint64(0xFFFF)]
        if not seen.any():
            return
        row_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        for k, template in enumerate(self.words):
            if not template:
                continue
            has = (seen[k // 64] & np.uint64(1 << (k % 64))) != 0
            sums = np.concatenate(([0], np.cumsum(has)))
            starts = np.flatnonzero(has)
            ends = np.minimum(starts + 2 * len(template), words.first[row_of[starts] + 1])
            enough = sums[ends] - sums[starts] >= self.coverage * len(template)
            starts, ends = starts[enough], ends[enough]
            if len(starts):
                # regions that touch are aligned as one
                new = np.concatenate(([True], (starts[1:] >= ends[:-1]) | (row_of[starts[1:]] != row_of[starts[:-1]])))
                at = np.flatnonzero(new)
                for a, b in zip(at, [*at[1:], len(starts)]):
                    for first, end in self._often_enough(k, own, int(starts[a]), int(ends[b - 1])):
                        yield k, int(row_of[starts[a]]), first, end

    def _often_enough(self, k: int, own: np.ndarray, first: int, end: int) -> Iterator[tuple[int, int]]:
        """Parts of a region that hold enough words no more often counted than in the template.

        Looked at in steps of twice the template's length, each with as many words behind it, so
        that any occurrence lies in one; parts that touch are passed on as one.
        """
        words, counts = self.counts[k]
        step = 2 * len(self.words[k])
        place = np.minimum(np.searchsorted(words, own[first:end]), len(words) - 1)
        place = np.where(words[place] == own[first:end], place, len(words))
        begin = None
        for low in range(first, end, step):
            held = np.bincount(place[low - first : low - first + 2 * step], minlength=len(words))[: len(words)]
            if np.minimum(held, counts).sum() >= self.coverage * len(self.words[k]):
                begin = low if begin is None else begin
                until = min(low + 2 * step, end)
            elif begin is not None and low >= until:
                yield begin, until
                begin = None
        if begin is not None:
            yield begin, until

    def find(self, column: pa.Array) -> Iterator[tuple[int, str, int, int, int, int]]:
        """(row, name, aligned words, template's words, first word, last word) of what stays."""
        for low, _, words in column_words(column, PUNCTUATION):
            own = words.hashes()
            found: dict[int, list[tuple[int, int, int, int]]] = {}
            for k, row, first, end in self.regions(words, own):
                text = own[first:end].tolist()
                for places in occurrences(self.words[k], text, self.coverage * len(self.words[k])):
                    found.setdefault(row, []).append((len(places), k, first + places[0], first + places[-1]))
            for row, hits in found.items():
                kept: list[tuple[int, int, int, int]] = []
                for hit in sorted(hits, key=lambda h: (-h[0], len(self.words[h[1]]), h[3] - h[2], h[2], h[1])):
                    if all(hit[3] < k[2] or k[3] < hit[2] for k in kept):
                        kept.append(hit)
                for size, k, first, last in sorted(kept, key=lambda h: h[2]):
                    begin = int(words.first[row])
                    yield low + row, self.names[k], size, len(self.words[k]), first - begin, last - begin


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | list[tuple[str, str]] | None = None, coverage: float = COVERAGE,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(id, license, coverage, first_word, last_word)`` of every statement in every row.

    Places count the words of the text from 0. Statements of one text do not overlap; of those with equally
    many aligned words the shorter template, then the shorter span, then the first stays. Null and empty texts have none; equal
    rows have equal statements; ids are only carried along. Without ``templates`` those of :func:`known`
    are sought; a license may have several.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.lower(F.col(text)).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    listed = known() if templates is None else list(templates.items()) if isinstance(templates, dict) else templates
    own = Templates([(name, words.lower()) for name, words in listed], coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(own.find(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                 pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2] / f[3] for f in found], pa.float64()),
                 pa.array([f[4] for f in found], pa.int64()), pa.array([f[5] for f in found], pa.int64())],
                ["id", "license", "coverage", "first_word", "last_word"])

    return rows.mapInArrow(
        run, f"id {kind}, license string, coverage double, first_word bigint, last_word bigint"
    ).withColumnRenamed("id", id_column)
