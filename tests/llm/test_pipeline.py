"""The pipeline stage by stage against plain Python, and the registered queries."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from bikenet.llm import secrets, toxicity

from .conftest import SMALL
from .test_copies import _expected


def test_stages_one_by_one(spark, small):
    documents = small("documents")
    columns, texts = documents.columns, {r["doc_id"]: r["text"] for r in documents.collect()}
    model = toxicity.fit(documents, small("labels"))
    lowered = {i: t.lower() for i, t in texts.items()}
    scores = dict(zip(lowered, toxicity.score_column(pa.array(list(lowered.values())), model)))
    stage = dict(corpus_pipeline.STAGES)

    clean = stage["toxicity"](spark, documents, SMALL)
    rows = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == columns and rows == {i: t for i, t in texts.items() if scores[i] < 0.5}

    single = stage["ngram_jaccard_join"](spark, clean, SMALL)
    kept = {i for i, _, top in _expected(list(rows.items())) if i == top}
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == kept

    free = stage["benchmark_decontamination"](spark, single, SMALL)
    items = [r["text"] for r in small("benchmark").collect()]
    left = {r["doc_id"] for r in free.collect()}
    assert free.columns == columns and left <= kept
    assert {i for i in kept if any(x in texts[i] for x in items)} == kept - left

    masked = stage["secret_scans"](spark, free, SMALL)
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    assert masked.columns == columns and masked.schema["n_chars"].dataType == documents.schema["n_chars"].dataType
    spans = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(free).collect()}
    assert rows.keys() == left
    for i, (text, n) in rows.items():
        assert n == len(text) and (text == texts[i]) == (spans[i] == "") and ("[SECRET]" in text) == (spans[i] != "")

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r["doc_id"]: r["tokens"] for r in stage["bpe_encoding"](spark, masked, SMALL).collect()}
    assert tokens == {i: library.encode(t, add_special_tokens=False).ids for i, (t, _) in rows.items()}
    assert tokens == {r["doc_id"]: r["tokens"] for r in corpus_pipeline.run(spark, SMALL).collect()}


def test_stages_on_edges(spark, docs, edge_rows):
    for rows in (edge_rows, []):
        frame = docs(*rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SMALL)
            assert frame.columns == docs().columns, name
        kept = [(r["doc_id"], r["text"]) for r in frame.collect()]
        assert set(kept) <= set(rows)


def test_ten_operators_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(entry_module.oracle_sql()) <= set(names)
