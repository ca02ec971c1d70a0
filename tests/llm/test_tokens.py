"""BPE encoding and decoding, and token counts."""

from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer as Library

from bikenet.llm import bpe, token_counts
from bikenet.llm.bpe_automaton import Automaton
from bikenet.session import shared_folder

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(BPE)


def _replayed(word: bytes, merges: list[tuple[int, int, int]]) -> list[int]:
    """Merges applied one by one, the earliest and leftmost first."""
    order = {(a, b): (k, w) for k, (a, b, w) in enumerate(merges)}
    tokens = list(word)
    while True:
        found = [(order[p][0], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in order]
        if not found:
            return tokens
        i = min(found)[1]
        tokens[i : i + 2] = [order[tokens[i], tokens[i + 1]][1]]


def test_automaton_equals_merging_on_random_merge_lists():
    draw = random.Random(5)
    for _ in range(150):
        labels = {c: bytes([c]) for c in range(3)}
        merges = []
        for w in range(3, 3 + draw.randint(0, 9)):
            a, b = draw.choice(list(labels)), draw.choice(list(labels))
            if labels[a] + labels[b] in labels.values():
                continue
            labels[w] = labels[a] + labels[b]
            merges.append((a, b, w))
        own = Automaton(labels, merges)
        for _ in range(60):
            word = bytes(draw.randrange(3) for _ in range(draw.randint(0, 14)))
            assert own.encode(word) == _replayed(word, merges)
            assert own.decode(own.encode(word)) == word


def test_merge_of_unknown_parts_is_refused():
    with pytest.raises(ValueError):
        Automaton({0: b"a", 1: b"aa"}, [(0, 7, 1)])


def test_encoding_equals_the_library(library):
    draw = random.Random(1)
    parts = ["'s", "'ll", "'", " ", "  ", "\n", "\t", " ", "　", "\x85", "\x1c", "a", "é", "Z", "1", "²", "中",
             "!", "…", "😀", "́", "<|endoftext|>", "r", "e", "v", "'S", "_", "aaaa", "ſ"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(4000)]
    own = bpe.tokenizer(BPE)
    tokens = list(own.encode(texts))
    assert tokens == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.decode(t).decode() for t in tokens] == [
        library.decode(t, skip_special_tokens=False) for t in tokens]


def test_cut_tokens_decode_to_replacement_characters(library):
    tokens = library.encode("€😀", add_special_tokens=False).ids
    for n in range(len(tokens)):
        assert bpe.tokenizer(BPE).decode(tokens[:n]).decode() == library.decode(tokens[:n], skip_special_tokens=False)


def test_digests_of_documents(small, library):
    rows = {r["doc_id"]: r["text"] for r in small("documents").collect()}
    for r in bpe.digests(small("documents"), BPE).collect():
        ids = library.encode(rows[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256(decoded.encode()).hexdigest()


def test_edges_of_encoding(docs, edge_rows, library):
    frame = docs(*edge_rows)
    tokens = bpe.encode(frame, BPE)
    assert tokens.columns == [*frame.columns, "tokens"]
    back = bpe.decode(bpe.encode(tokens, BPE), BPE).collect()  # the column of tokens is replaced
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in back) == sorted((str(i), t or "") for i, t in edge_rows)
    for r in back:
        assert r["tokens"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert bpe.digests(docs(), BPE).count() == bpe.encode(docs(), BPE).count() == 0


def test_token_counts_and_cache(spark, docs, edge_rows, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    cache = shared_folder(spark, "cache")
    for _ in range(2):
        rows = token_counts.token_counts(docs(*edge_rows), cache, PIECES, limit=6).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == sorted(
            (str(i), len((t or "").encode()), n := len(library.encode(t or "")), n > 6) for i, t in edge_rows)
        # one row for each different text: nothing is encoded or stored twice
        assert token_counts.read_cache(spark, cache).count() == len({t or "" for _, t in edge_rows})
    assert token_counts.token_counts(docs(), cache, PIECES).count() == 0
    # another tokenizer's counts are never met
    monkeypatch.setattr(token_counts, "tokenizer_version", lambda path: "another")
    token_counts.token_counts(docs((1, "a")), cache, PIECES).collect()
    assert token_counts.read_cache(spark, cache).count() == len({t or "" for _, t in edge_rows}) + 1


def test_token_counts_of_documents(spark, small):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] for r in small("documents").collect()}
    rows = token_counts.token_counts(small("documents"), shared_folder(spark, "cache"), PIECES).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(library.encode(t)) for i, t in texts.items()}
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in rows)


def test_a_word_that_is_one_token_is_walked_once(monkeypatch):
    """Longest labels lead; where they lead nowhere, shorter ones do, as the library has it."""
    class Counting(dict):
        looked = 0

        def get(self, key):
            Counting.looked += 1
            return super().get(key)

    automaton = bpe.tokenizer(BPE).automaton
    monkeypatch.setattr(automaton, "step", Counting(automaton.step))
    word = max((label for t, label in automaton.labels.items() if t in automaton.made), key=len)
    assert len(automaton.encode(word)) == 1
    assert Counting.looked == len(word)
    library = Library.from_file(BPE)
    random.seed(5)
    for _ in range(2000):
        letters = "".join(random.choice("aeiourstnlhe") for _ in range(random.randint(1, 30)))
        assert automaton.encode(letters.encode()) == library.encode(letters, add_special_tokens=False).ids
