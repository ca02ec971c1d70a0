"""Personal data: patterns against plain regular expressions, the tagger against numeric gradients and held-out texts."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bikenet.llm import personal_data as P
from bikenet.llm.char_tagger import Tagger, codes_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            doubled = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits)))
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((P.KINDS.index(kind), *m.span()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "@", ".", "-", "+", " ", "(", ")", "0", "7", "256", "1.2.3.4", "4111111111111111", "x@y.de", "+1 (415) 555-0100", "é"]),
    max_size=14).map("".join))
@example("a@b.c@d.e")
@example("1.2.3.4.5.6.7.8.9")
@example("1..2.3.4.5.6")
@example("+1 (826) 555-4081 190.137.223.204")
def test_patterns(text):
    assert P.base_spans(text) == _plain(text)


def test_patterns_are_linear():
    began = time.time()
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1(" * 130_000, "a." * 200_000 + "@", "1 -" * 130_000):
        P.base_spans(text)
    assert time.time() - began < 20


def test_gradient():
    rng = np.random.default_rng(0)
    tagger = Tagger(2, seed=3, embedding=3, hidden=4, dtype=np.float64)
    codes = rng.integers(40, 60, (7, 3))
    tags = np.array([[0, 1, 3], [1, 2, 4], [2, 0, 4], [0, 3, 0], [3, 1, 1], [4, 2, 2], [0, 2, 0]])
    _, gradients = tagger.loss_and_gradients(codes, tags)
    for name, weights in tagger.weights.items():
        places = [tuple(rng.integers(0, s) for s in weights.shape) for _ in range(6)]
        if name == "chars":
            places = [(int(codes[k % 7, k % 3]), k % 3) for k in range(6)]
        if name == "moves":
            places = [p for p in places if tagger.allowed[p]]
        for place in places:
            kept = weights[place]
            up, down = (weights.__setitem__(place, kept + d) or tagger.loss_and_gradients(codes, tags)[0] for d in (1e-5, -1e-5))
            weights[place] = kept
            assert gradients[name][place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_viterbi_is_the_best_of_all_paths():
    tagger = Tagger(1, seed=1)
    tagger.weights["moves"] = np.random.default_rng(2).standard_normal((3, 3)).astype(np.float32)
    scores = np.random.default_rng(1).standard_normal((5, 4, 3)).astype(np.float32)
    tags = tagger.decode(scores)
    moves = tagger.moves()
    for text in range(4):
        paths = np.stack(np.meshgrid(*[range(3)] * 5, indexing="ij"), axis=-1).reshape(-1, 5)
        value = [tagger.first[p[0]] + sum(scores[t, text, p[t]] for t in range(5)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths]
        assert tags[:, text].tolist() == paths[int(np.argmax(value))].tolist()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


@pytest.fixture(scope="module")
def tagger(documents):
    return P.fit(documents.filter("doc_id % 2 = 1"))


def test_held_out_documents(documents, tagger):
    """Alone, the tagger finds what the patterns find in texts that it was not taught by, and little else."""
    texts = sorted({r.text for r in documents.filter("doc_id % 2 = 0").collect() if r.text})
    base = [P.base_spans(text) for text in texts]
    found = P.added_spans(tagger, texts, [[] for _ in texts])
    known, told = sum(map(len, base)), sum(map(len, found))
    met = sum(len(set(a) & set(b)) for a, b in zip(base, found))
    assert known > 30 and met >= 0.95 * known
    extra = [(t[a:b], k) for t, own, new in zip(texts, base, found) for k, a, b in set(new) - set(own)]
    assert told - met <= 0.05 * known and all(P.valid(k, s) for s, k in extra)


def test_two_in_a_row(tagger):
    """The patterns read two neighbouring numbers as one and drop it."""
    text = "ou thin the thnt 4485275742308327 4539578763621486 re thand. Eron +1 (826) 555-4081 190.137.223.204 du there"
    base = P.base_spans(text)
    assert [k for k, *_ in base] == [P.IP]
    added = [(k, text[a:b]) for k, a, b in P.added_spans(tagger, [text], [base])[0]]
    assert added == [(P.CARD, "4485275742308327"), (P.CARD, "4539578763621486"), (P.PHONE, "+1 (826) 555-4081")]


def test_clean_texts_stay_clean(tagger):
    texts = ["token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" thhantou with", "Apache License, Version 2.0. In 2024 12 of 30",
             "no mark at all", "[a] (b) 3", "9807915762804490 raie, esllra"]
    assert P.added_spans(tagger, texts, [[] for _ in texts]) == [[] for _ in texts]


def test_windows_join_without_a_seam(tagger):
    """Spans at every offset of a long stretch are found whole, wherever windows begin."""
    text = " ".join(f"thon the {'en' * (k % 17)} of 10.20.30.{100 + k}" for k in range(60))
    found = P.added_spans(tagger, [text], [[]])[0]
    want = {(P.IP, m.start(), m.end()) for m in re.finditer(r"10\.20\.30\.\d+", text)}
    assert len(P.stretches(text)) == 1 and len(set(found) & want) >= 0.9 * len(want)


def test_rows(spark, docs, edge_rows, tagger):
    rows = edge_rows + [(20, "mail a.b@c.example.org, ip 8.8.8.8"), (21, "é 😀 x@y.de"), (22, "@ 1 . + ("), (23, "1" * 300_000)]
    got = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in P.find_personal(docs(*rows), tagger).collect()
           if r.spans and all(s.base for s in r.spans)}
    assert (20, (("email", 5, 22), ("ip", 27, 34))) in got and (21, (("email", 4, 10),)) in got
    assert P.find_personal(docs(*rows), tagger).count() == len(rows)
    assert P.find_personal(docs(), tagger).count() == 0
    masked = {r.doc_id: r.text for r in P.without_personal(docs(*rows), tagger).collect()}
    assert masked[20] == "mail <email>, ip <ip>" and masked[21] == "é 😀 <email>" and masked[1] is None
    assert P.without_personal(docs(*rows), tagger).columns == docs().columns


def test_without_finds_there_is_no_tagger(docs):
    frame = docs((1, "nothing here"), (2, None))
    assert P.fit(frame) is None
    rows = {r.doc_id: r for r in P.personal_data(frame).collect()}
    assert rows[1].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_query_columns_equal_plain_patterns(documents):
    rows = documents.join(P.personal_data(documents), "doc_id").filter(F.col("spans") != "").collect()
    plain = {r.doc_id: _plain(r.text) for r in documents.collect() if r.text}
    assert {r.doc_id for r in rows} >= {i for i, s in plain.items() if s}
    for r in rows:
        spans = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in plain[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in plain[r.doc_id]) for k in range(4)]
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))
