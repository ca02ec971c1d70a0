"""Toxicity and quality."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from bikenet.llm import quality, toxicity
from bikenet.llm.text_arrays import prefix_hash, span_hashes


@pytest.mark.parametrize(
    ("score", "label", "least"), [(toxicity.toxicity, "toxic", 0.95), (quality.quality, "quality", 0.97)])
def test_held_out_accuracy(spark, score, label, least):
    root = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(documents, labels).toPandas()
    assert len(rows) == documents.count() and rows["score"].between(0, 1).all()
    cut = 0.5 if label == "toxic" else 0.3
    assert ((rows["score"] >= cut) == (rows["predicted"] == 1)).all()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]]).all()
    held = rows[rows["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (held["predicted"] == held[label]).mean() >= least


def test_labels_of_held_out_rows_are_never_read(spark, small):
    labels = small("labels")
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic",
        "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    for score in (toxicity.toxicity, quality.quality):
        assert sorted(score(small("documents"), labels).collect()) == sorted(score(small("documents"), turned).collect())


@pytest.mark.parametrize("score", [toxicity.toxicity, quality.quality])
def test_edges(spark, docs, edge_rows, score):
    schema = "doc_id bigint, quality int, toxic int, text string"
    some = spark.createDataFrame([(1, 0, 1, "x"), (3, None, None, "x"), (None, 1, 1, "x"), (6, 1, 0, "x"), (6, 1, 0, "x"),
                                  (8, 0, 1, "x"), (2, 1, 0, "x"), (7, 1, 0, "x")], schema)
    for labels in (some, some.limit(0), some.filter("doc_id = 6")):
        rows = score(docs(*edge_rows), labels).collect()
        assert len(rows) == len(edge_rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] == 6}) == 1
        assert score(docs(), labels).count() == 0


def test_misspellings_share_subwords():
    draw = np.random.default_rng(1)
    plain = ["".join(draw.choice(list("abcdefg"), 6)) for _ in range(200)]
    texts, labels = [], []
    for i in range(400):
        words = list(draw.choice(plain, 30))
        if i % 2:
            words[3:5] = ["worthless", "worthless"]
        texts.append(" ".join(words))
        labels.append(i % 2)
    model = toxicity.train(texts, np.array(labels), 0.5)
    clean = " ".join(draw.choice(plain, 28))
    scores = toxicity.score_column(pa.array([clean, f"{clean} worthles wworthless", ""]), model)
    assert scores[0] < 0.5 < scores[1]


def _by_hand(text, model):
    """The score of one text from a fitted model, n-gram by n-gram."""
    words = re.findall(r"[0-9a-z\x80-\xff]+", text.lower().encode().decode("latin-1"))
    total = 0.0
    for word in words:
        marked = f"<{word}>".encode("latin-1")
        grams = [marked] + [marked[a : a + n] for n in toxicity.GRAMS if len(marked) > n for a in range(len(marked) - n + 1)]
        total += sum(float(model.weights[_bucket(g)]) for g in grams) / len(grams)
    logit = total / max(len(words), 1) + model.bias
    return 1 / (1 + np.exp(-logit))


def _bucket(gram):
    data = np.frombuffer(gram, dtype=np.uint8)
    return int(span_hashes(prefix_hash(data), np.array([0]), np.array([len(gram)]))[0]) & (toxicity.BUCKETS - 1)


def test_scores_by_hand(small):
    texts = [r.text for r in small("documents").select("text").limit(60).collect()] + ["", "  ", "a", "É b-c", "x" * 5000]
    model = toxicity.train([t.lower() for t in texts], np.arange(len(texts)) % 2, 0.3)
    model = model._replace(weights=np.random.default_rng(3).normal(size=toxicity.BUCKETS).astype(np.float32))
    scores = toxicity.score_column(pa.array([t.lower() for t in texts]), model)
    assert np.allclose(scores, [_by_hand(t, model) for t in texts], atol=1e-6)


def test_averages_by_hand():
    texts, taught = ["ab abc", "", "abc abc abc x"], np.sort(np.array([_bucket(b"<ab"), _bucket(b"<abc>"), _bucket(b"<x>")]))
    blocks = list(toxicity._averages(texts, taught).blocks(3))
    dense = np.concatenate([block for _, block in blocks])
    place = {b: k for k, b in enumerate(taught.tolist())}
    want = np.zeros((3, 3))
    for row, text in enumerate(texts):
        for word in text.split():
            marked = f"<{word}>".encode()
            grams = [marked] + [marked[a : a + n] for n in toxicity.GRAMS if len(marked) > n for a in range(len(marked) - n + 1)]
            for gram in grams:
                if _bucket(gram) in place:
                    want[row, place[_bucket(gram)]] += toxicity.SCALE / len(grams) / len(text.split())
    assert np.allclose(dense, want)


@pytest.mark.parametrize("labels", ["false", "toxic = 1", "toxic = 0"])
def test_without_both_classes_no_document_goes(spark, small, labels):
    rows = small("documents")
    model = toxicity.fit(rows, small("labels").filter(labels))
    assert toxicity.without_toxic(rows, model).count() == rows.count()


def test_preferred_texts_score_higher():
    texts = ["Some words in a plain row."] * 20 + ["Ab### c### d###"] * 20
    model = quality.train(texts, np.array([1] * 20 + [0] * 20), 0.5)
    good, bad = quality.score_column(pa.array(["Other words in a row.", "Xy### z### w###"]), model)
    assert good >= quality.CUT > bad


def test_threshold_is_the_quantile_of_all_rows(spark, small, monkeypatch):
    draw = np.random.default_rng(2)
    raw = np.round(draw.normal(size=5000), 2)
    frame = spark.createDataFrame([(float(x),) for x in raw], "raw double")
    monkeypatch.setattr(quality, "BINS", 7)
    for share in (0.0, 0.31, 0.5, 1.0):
        below = int((1 - share) * len(raw) + 1e-6)
        expected = np.sort(raw)[[max(below - 1, 0), min(below, len(raw) - 1)]].mean()
        assert quality.threshold(frame, share) == pytest.approx(expected, abs=1e-12)
    monkeypatch.undo()
    # a teaching sample of five rows a class must not move the share that is predicted
    labels = small("labels")
    monkeypatch.setattr(quality.fit, "__defaults__", ("quality", 5))
    rows = quality.quality(small("documents"), labels).toPandas()
    teaching = labels.toPandas()
    teaching = teaching[[zlib.crc32(str(i).encode()) % 5 != 0 for i in teaching["doc_id"]]]
    assert abs(rows["predicted"].mean() - teaching["quality"].mean()) <= 1.5 / len(rows)
