"""What Python workers hold between tasks."""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from bikenet.llm import bpe, decontamination, worker_memory


def test_another_operator_drops_the_tokenizer(spark, docs, monkeypatch):
    frame, items = docs((1, "a text of some words")), spark.createDataFrame([(1, "one two three four five six")], "item_id int, text string")
    ran, batch = [], frame.toArrow().to_batches()[0]
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, *_: ran.append(run) or frame)
    bpe.encode(frame, public_tokenizers.path("byte_bpe_50k.json"))
    decontamination.without_leaks(frame, items)
    encode, search = ran
    list(encode(iter([batch])))
    compiled = bpe.tokenizer.cache_info().misses
    list(encode(iter([batch])))  # a task of the same operator finds it
    assert bpe.tokenizer.cache_info().currsize and bpe.tokenizer.cache_info().misses == compiled
    list(search(iter([batch.append_column("lowered text", batch.column("text"))])))
    assert not bpe.tokenizer.cache_info().currsize


def test_free_memory_goes_back_on_the_way_and_at_the_end(monkeypatch):
    given = []
    monkeypatch.setattr(worker_memory, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * worker_memory.GIVE_BACK_BYTES])], ["text"])
    small = pa.RecordBatch.from_arrays([pa.array(["x"])], ["text"])
    assert list(worker_memory.frugal(lambda batches: batches)(iter([batch, small, batch]))) == [batch, small, batch]
    assert len(given) == 3
    run = worker_memory.frugal(lambda batches: batches)(iter([small, small]))
    next(run)
    run.close()  # as under a limit
    assert len(given) == 4


def test_only_other_caches_are_emptied():
    one, two = lru_cache(lambda: object()), lru_cache(lambda: object())
    worker_memory.begin((one,))
    kept = one()
    worker_memory.begin((one, two))
    assert one() is kept
    two()
    worker_memory.begin((two,))
    assert not one.cache_info().currsize and two.cache_info().currsize
    worker_memory.begin(())
    assert not two.cache_info().currsize


def test_batches_of_long_texts_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    corpus_pipeline._ready(spark)
    rows = spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 20000) AS text").mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in rows) == 1000
    assert max(r["size"] for r in rows) <= corpus_pipeline.BATCH_BYTES + 30_000
