"""Passages of benchmark items in texts, by edit distance over words.

A hit is a passage of the text whose word edit distance from the item is at most ``ALLOWED`` of the
item's words. Texts are lowered; words are runs of letters and digits.

1. Windows of an item's size start at every word. Those that by the q-gram lemma cannot hold a hit
   are passed over: k edits leave at least n - 1 - 2k of an item's n - 1 word pairs. This loses
   nothing, as pairs of all items of that size count. The others are gathered in runs of neighbours.
2. Windows get their CGK embedding (:mod:`cgk`); one whose key in any of the repetitions equals that
   of an item makes its run a candidate for that item. The longer an item, the fewer steps a key
   samples; ``tests/llm`` measures the recall of keys at the full distance by size.
3. What keys miss is found by a second pass, which loses nothing: a run that holds enough of one
   item's word pairs is a candidate for it too.
4. The exact edit distance of each candidate decides. ``by_keys`` tells which hits the keys found.

Items of fewer than five words are phrases that turn up anywhere; such an item is found in a text
that consists of its words alone. Scripts written without blanks (Han, kana, Thai, Lao, Khmer,
Myanmar) count each letter as a word, in items and texts alike.

Items are read in blocks of bounded size, each sent to all tasks; texts never move.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikenet.llm import cgk
from bikenet.llm.text_arrays import PUNCTUATION, column_words, mix
from bikenet.llm.worker_memory import frugal

#: Share of an item's words that may be edited: similarity 0.8.
ALLOWED = 0.2
#: Items of fewer words are found only as whole texts; within a text so short a phrase is no evidence of a leak.
LEAST_WORDS = 5
#: UTF-8 bytes of items that are sent to the tasks at a time.
BLOCK_BYTES = 4 << 20
#: Windows of one size that are embedded together, and the most of a run.
WINDOWS = 2048

#: Letters of scripts without blanks between words.
_UNSEGMENTED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
_SLOTS = 1 << 20
_PAIR = np.uint64(0x9FB21C651E98DF25)


def edits_allowed(words: int) -> int:
    return int(words * ALLOWED)


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * _PAIR + words[1:]) & np.uint64(_SLOTS - 1)


def distances_from(item: list[int], text: list[int]) -> list[int]:
    """For each place of the text the least edit distance between the item and a passage that starts there.

    Both are read from behind, where a start is an end: Myers' bit-parallel columns, an integer each.
    """
    size = len(item)
    whole, top = (1 << size) - 1, size - 1
    places: dict[int, int] = defaultdict(int)
    for i, word in enumerate(reversed(item)):
        places[word] |= 1 << i
    up, down, distance = whole, 0, size
    out = []
    for word in reversed(text):
        same = places.get(word, 0)
        across = ((((same & up) + up) ^ up) | same) & whole
        more, less = down | (whole & ~(across | up)), up & across
        distance += (more >> top & 1) - (less >> top & 1)
        more, less, along = more << 1, less << 1, same | down
        up, down = (less | ~(along | more)) & whole, more & along
        out.append(distance)
    return out[::-1]


class Run(NamedTuple):
    """Neighbouring windows of one text that may hold a hit, with the words from the first to behind the last."""

    row: int
    first: int
    words: np.ndarray
    offsets: np.ndarray


def _whole(own: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    out = np.full(len(first), np.uint64(size))
    for k in range(size):
        out = mix(out * _PAIR + own[first + k])
    return out


def _sorted(keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], items[order]


def _looked_up(table: tuple[np.ndarray, np.ndarray], asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` that a table knows, and the items there; a place for each of its items."""
    keys, items = table
    left, right = np.searchsorted(keys, asked), np.searchsorted(keys, asked, side="right")
    lengths = right - left
    place = np.repeat(left - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    return np.repeat(np.arange(len(asked)), lengths), items[place]


class ItemIndex:
    """Word hashes, keys and word pairs of a block of items."""

    def __init__(self, texts: list[str | None]):
        self.words: list[np.ndarray] = []
        for _, _, words in column_words(pa.array(texts, pa.string()), PUNCTUATION):
            own = words.hashes()
            self.words += [own[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        by_size = defaultdict(list)
        for i, own in enumerate(self.words):
            by_size[len(own)].append(i)
        self.sizes = sorted(size for size in by_size if size >= LEAST_WORDS)
        self.slots = np.zeros(_SLOTS, dtype=np.uint64)  # a bit for each size that has the pair
        #: tables by size, in the order of their first column: (key, item), (pair, item), (hash of the whole, item)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in set(by_size) - {0} - set(self.sizes):
            stacked = np.stack([self.words[i] for i in by_size[size]])
            whole = _whole(stacked.ravel(), np.arange(len(stacked)) * size, size)
            self.short[size] = _sorted(whole, np.array(by_size[size]))
        for k, size in enumerate(self.sizes):
            stacked = np.stack([self.words[i] for i in by_size[size]])
            pairs = [np.unique(_pairs(own)) for own in stacked]
            for own in pairs:
                self.slots[own] |= np.uint64(1 << (k % 64))
            self.pairs[size] = _sorted(np.concatenate(pairs), np.repeat(by_size[size], [len(p) for p in pairs]))
            self.keys[size] = _sorted(cgk.keys(stacked, size).ravel(), np.repeat(by_size[size], cgk.REPETITIONS))

    def match(self, column: pa.Array, keyed: set[tuple[int, int]] | None = None) -> dict[tuple[int, int], tuple[int, int]]:
        """For (row, item) of all hits the least (distance, first word).

        Those that keys alone would find are added to ``keyed``.
        """
        hits: dict[tuple[int, int], tuple[int, int]] = {}
        keyed = set() if keyed is None else keyed
        waiting: dict[int, list[Run]] = defaultdict(list)
        count = defaultdict(int)
        for low, _, words in column_words(column, PUNCTUATION):
            own = words.hashes()
            self._match_whole(own, words.first, low, hits)
            for size, run in self._runs(own, words.first, low):
                waiting[size].append(run)
                count[size] += len(run.offsets)
                if count[size] >= WINDOWS:
                    self._judge(size, waiting.pop(size), hits, keyed)
                    count[size] = 0
        for size, runs in waiting.items():
            self._judge(size, runs, hits, keyed)
        return hits

    def _match_whole(self, own: np.ndarray, first: np.ndarray, low: int, hits: dict) -> None:
        """Texts that are a short item, word by word."""
        for size, table in self.short.items():
            rows = np.flatnonzero(np.diff(first) == size)
            for at, item in zip(*_looked_up(table, _whole(own, first[rows], size))):
                hits[low + int(rows[at]), int(item)] = 0, 0

    def _runs(self, own: np.ndarray, first: np.ndarray, low: int) -> Iterator[tuple[int, Run]]:
        """Runs of windows that may hold a hit, each with its size."""
        if len(own) < 2 or not self.sizes:
            return
        seen = self.slots[_pairs(own)]
        last = first[1:] - 1
        last = last[(first[1:] > first[:-1]) & (last < len(seen))]
        seen[last] = 0  # no pair reaches into the next text
        sums = np.zeros(len(own) + 1, dtype=np.int32)
        np.cumsum(seen != 0, out=sums[1 : len(own)])
        sums[len(own) :] = sums[len(own) - 1]
        row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for g in range(0, len(self.sizes), 8):
            group = self.sizes[g : g + 8]
            need = min(size - 1 - 2 * edits_allowed(size) for size in group)
            reach = np.minimum(np.arange(len(own)) + group[-1] - 1, len(own))
            rough = np.flatnonzero(sums[reach] - sums[: len(own)] >= need)
            if not len(rough):
                continue
            for k, size in enumerate(group, g):
                has = (seen >> np.uint64(k % 64)) & np.uint64(1)
                own_sums = np.zeros(len(own) + 1, dtype=np.int32)
                np.cumsum(has, out=own_sums[1 : len(own)])
                own_sums[len(own) :] = own_sums[len(own) - 1]
                allowed = edits_allowed(size)
                end = np.minimum(rough + size - 1, len(own))
                starts = rough[own_sums[end] - own_sums[rough] >= size - 1 - 2 * allowed]
                if not len(starts):
                    continue
                rows = row_of[starts]
                # windows that overlap or nearly do belong together
                new = (starts[1:] - starts[:-1] > size) | (rows[1:] != rows[:-1]) | (np.arange(1, len(starts)) % WINDOWS == 0)
                at = np.concatenate(([0], np.flatnonzero(new) + 1, [len(starts)]))
                for a, b in zip(at[:-1], at[1:]):
                    row, begin = int(rows[a]), int(starts[a])
                    words = own[begin : min(int(starts[b - 1]) + size + allowed, int(first[row + 1]))]
                    yield size, Run(row + low, begin - int(first[row]), words.copy(), starts[a:b] - begin)

    def _judge(
        self, size: int, runs: list[Run], hits: dict[tuple[int, int], tuple[int, int]], keyed: set[tuple[int, int]],
    ) -> None:
        """Distances of runs to the items that keys name, then to those that share enough pairs besides."""
        allowed = edits_allowed(size)
        for run, named in zip(runs, self._named_by_keys(size, runs)):
            text = run.words.tolist()
            last = int(run.offsets[-1])

            def judge(item: int, low: int, high: int, run=run, text=text) -> list[int]:
                found = distances_from(self.words[item].tolist(), text[low : high + size + allowed])[: high - low + 1]
                nearest = min(found, default=size)
                if nearest <= allowed:
                    key, value = (run.row, item), (nearest, run.first + low + found.index(nearest))
                    if key not in hits or value < hits[key]:
                        hits[key] = value
                return found

            for item, offsets in named.items():
                found = judge(item, 0, last)
                if any(found[at] <= allowed for at in offsets if at < len(found)):
                    keyed.add((run.row, item))
            for item, low, high in self._named_by_pairs(size, run):
                if item not in named:
                    judge(item, low, high)

    def _named_by_keys(self, size: int, runs: list[Run]) -> list[dict[int, list[int]]]:
        """For each run the items of which a window has a key, with the windows' places."""
        behind = np.zeros(size, dtype=np.uint64)
        flat = np.concatenate([part for run in runs for part in (run.words, behind)])
        base = np.cumsum([0, *(len(run.words) + size for run in runs)])
        of = np.repeat(np.arange(len(runs)), [len(run.offsets) for run in runs])
        offsets = np.concatenate([run.offsets for run in runs])
        named: list[dict[int, list[int]]] = [{} for _ in runs]
        for low in range(0, len(of), WINDOWS):
            at = base[of[low : low + WINDOWS]] + offsets[low : low + WINDOWS]
            asked = cgk.keys(flat[at[:, None] + np.arange(size)], size).ravel()
            window, item = _looked_up(self.keys[size], asked)
            for w, i in np.unique(np.stack([window // cgk.REPETITIONS + low, item]), axis=1).T.tolist():
                named[of[w]].setdefault(i, []).append(int(offsets[w]))
        return named

    def _named_by_pairs(self, size: int, run: Run) -> Iterator[tuple[int, int, int]]:
        """Items of whose pairs enough lie close together, and the first and last place to start from."""
        need = size - 1 - 2 * edits_allowed(size)
        last = int(run.offsets[-1])
        place, item = _looked_up(self.pairs[size], _pairs(run.words)[: last + size - 1])
        order = np.argsort(item, kind="stable")
        item, place = item[order], place[order]
        ahead, behind = place[: 1 - need], place[need - 1 :]
        enough = np.flatnonzero((item[: 1 - need] == item[need - 1 :]) & (behind - ahead <= size - 2))
        for one in np.unique(item[enough]):
            mine = enough[item[enough] == one]
            yield int(one), max(0, int(behind[mine[0]]) - size + 2), min(last, int(ahead[mine[-1]]))


def _spaced(text: str) -> Column:
    """A text lowered, with blanks around the letters of scripts that have none between words."""
    low = F.lower(F.col(text))
    return F.when(F.octet_length(low) == F.char_length(low), low).otherwise(F.regexp_replace(low, _UNSEGMENTED, " $1 "))


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[pa.Array, ItemIndex]]:
    """Blocks of items, each of about ``BLOCK_BYTES`` at most."""
    own = items.select(F.col(item_id).alias("item_id"), _spaced(text).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-int(total) // BLOCK_BYTES)
    for block in range(blocks):
        rows = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        yield rows.column(0).combine_chunks(), ItemIndex(rows.column(1).to_pylist())


def find_leaks(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(id, item_id, distance, item_words, first_word, by_keys)``: every item found in every row of ``docs``.

    ``first_word`` counts the words of the text from 0; of several passages the nearest, then the
    first is told. ``by_keys`` is false where only the second pass found the item. Null and empty
    texts and items match nothing, items of fewer than five words only a text of the same words. Equal rows give equal hits; equal items are told each. Ids are only carried along.
    """
    rows = docs.select(F.col(id_column).alias("id"), _spaced(text).alias("text"))
    kinds = rows.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {kinds[0]}, item_id {kinds[1]}, distance int, item_words int, first_word bigint, by_keys boolean"
    found = docs.sparkSession.createDataFrame([], schema)
    for names, index in _blocks(items, item_id, item_text):
        def run(batches: Iterator[pa.RecordBatch], names=names, index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keyed: set[tuple[int, int]] = set()
                hits = sorted(index.match(batch.column(1), keyed).items())
                row, item = (pa.array([h[0][k] for h in hits], pa.int64()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), names.take(item),
                     pa.array([h[1][0] for h in hits], pa.int32()),
                     pa.array([len(index.words[h[0][1]]) for h in hits], pa.int32()),
                     pa.array([h[1][1] for h in hits], pa.int64()),
                     pa.array([h[0] in keyed for h in hits], pa.bool_())],
                    ["id", "item_id", "distance", "item_words", "first_word", "by_keys"],
                )

        found = found.union(rows.mapInArrow(frugal(run), schema))
    return found.withColumnRenamed("id", id_column)


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which :func:`find_leaks` finds no item, with all their columns."""
    kept = docs
    for _, index in _blocks(items, item_id, item_text):
        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[row for row, _ in index.match(batch.column(batch.num_columns - 1))]] = False
                yield batch.filter(pa.array(clean)).select(range(batch.num_columns - 1))

        lowered = kept.select(*kept.columns, _spaced(text).alias("lowered text"))
        kept = lowered.mapInArrow(frugal(run), docs.schema)
    return kept
