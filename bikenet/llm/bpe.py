"""Byte-level BPE encoding and decoding of text columns."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.llm.bpe_automaton import Automaton
from bikenet.llm.pretokens import split_words
from bikenet.llm.worker_memory import frugal

#: Words whose path a worker remembers; beyond it, those not met again since half as many give way.
WORD_MEMORY = 200_000
#: Code points of short texts that are split together.
CHUNK = 1 << 18


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """The automaton of a tokenizer file, its special tokens, and the words met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        to_byte = _byte_of_character()
        vocabulary = stated["model"]["vocab"]
        labels = {i: bytes(to_byte[c] for c in word) for word, i in vocabulary.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in stated["model"]["merges"]]
        self.specials = {t["content"]: t["id"] for t in stated["added_tokens"]}
        self.automaton = Automaton(
            labels, ((vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges))
        self.labels = labels | {i: s.encode() for s, i in self.specials.items()}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        path = self.known.get(word)
        if path is None:
            if 2 * len(self.known) >= WORD_MEMORY:
                self.older = dict(self.known)
                self.known.clear()
            path = self.known[word] = self.older.get(word) or tuple(self.automaton.encode(word.encode()))
        return path

    def _parts(self, text: str) -> list[str | int]:
        """Text pieces and the special tokens between them."""
        parts: list[str | int] = [text]
        for content, token in self.specials.items():
            if content in text:
                parts = [
                    piece for part in parts
                    for piece in (_between(part.split(content), token) if isinstance(part, str) else [part])
                ]
        return parts

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The tokens of each text. A null text counts as empty."""
        parts = [self._parts(t or "") for t in texts]
        words, ends = split_words([p for own in parts for p in own if isinstance(p, str)])
        word, low, at = self.word, 0, iter(ends)
        known = self.known
        for own in parts:
            tokens: list[int] = []
            for part in own:
                if isinstance(part, int):
                    tokens.append(part)
                else:
                    high = next(at)
                    for w in words[low:high]:
                        tokens += known.get(w) or word(w)
                    low = high
            yield tokens

    def decode(self, tokens: list[int]) -> bytes:
        """The labels of the path, joined; bytes that are no valid text become U+FFFD."""
        joined = b"".join([self.labels[t] for t in tokens])
        try:
            joined.decode()
            return joined
        except UnicodeDecodeError:
            return joined.decode("utf-8", "replace").encode()


def _between(pieces: list[str], token: int) -> list[str | int]:
    out: list[str | int] = [pieces[0]]
    for piece in pieces[1:]:
        out += [token, piece]
    return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """Compiled once in each Python worker."""
    return Tokenizer(path)


def text_runs(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column in runs of about ``CHUNK`` code points; a longer text runs alone."""
    run: list[str | None] = []
    size = 0
    for value in column:
        text = value.as_py()
        run.append(text)
        size += len(text or "")
        if size >= CHUNK or len(run) >= 1000:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, path: str, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """``docs`` with a column of the tokens of each whole text (null: none).

    A column of that name is replaced, unless it is the text. An empty table stays empty.
    """
    docs = docs.drop(tokens) if tokens != text else docs
    schema = docs.select("*", F.lit(None).cast("array<int>").alias(tokens)).schema
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            done = 0
            for texts in text_runs(batch.column(place)):
                lists = [np.array(t, dtype=np.int32) for t in own.encode(texts)]
                offsets = np.zeros(len(lists) + 1, dtype=np.int32)
                np.cumsum([len(t) for t in lists], out=offsets[1:])
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                part = batch.slice(done, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=schema.names)
                done += len(texts)

    return docs.mapInArrow(frugal(run, tokenizer), schema)


def decode(docs: DataFrame, path: str, tokens: str = "tokens", text: str = "decoded") -> DataFrame:
    """``docs`` with a column of the text that its tokens stand for (null: empty).

    A column of that name is replaced.
    """
    docs = docs.drop(text)
    schema = docs.select("*", F.lit(None).cast("string").alias(text)).schema
    place = docs.columns.index(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                column = pa.array([own.decode(t or []).decode() for t in part.column(place).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=schema.names)

    return docs.mapInArrow(frugal(run, tokenizer), schema)


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of each row, encoded and decoded in one pass.

    The digests are those of the decimal tokens joined by commas and of the decoded UTF-8 text. A
    null text is empty; ids are carried along, so null and repeated ids stay as they are.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            counts, tokens_of, texts_of = [], [], []
            for texts in text_runs(batch.column(1)):
                for tokens in own.encode(texts):
                    counts.append(len(tokens))
                    tokens_of.append(sha256(str(tokens)[1:-1].replace(" ", "").encode()).hexdigest())
                    texts_of.append(sha256(own.decode(tokens)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(tokens_of, pa.string()), pa.array(texts_of, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(
        frugal(run, tokenizer), f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("id", id_column)
