"""What one batch takes in a Python worker of the pipeline."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from voltchurn.llm import bpe, toxicity, vocab, workers
from voltchurn.llm.queries import vocab_path


def test_scores_do_not_depend_on_how_texts_are_dealt_into_batches(monkeypatch):
    texts = [f"A plain line {k}. One more, with bad{k % 7} words!\n" * (1 + k % 40) for k in range(600)] + ["", "x" * 300_000]
    words = np.unique(toxicity.split_words(texts[:50])[0])
    model = toxicity.ToxicityModel(words, np.linspace(-1, 2, len(words)), -3.0, -3.0, 0.1, 0.1)
    whole = toxicity.split_words
    sizes = []
    monkeypatch.setattr(toxicity, "split_words", lambda t: sizes.append((len(t), sum(map(len, t)))) or whole(t))
    score, offending = toxicity.score_texts(model, texts, 0.3)
    assert len(sizes) > 2 and all(n == 1 or chars <= 1 << 18 for n, chars in sizes)
    monkeypatch.setattr(toxicity, "SCORE_CHARS", 1 << 30)
    once, spans = toxicity.score_texts(model, texts, 0.3)
    assert score == pytest.approx(once, rel=1e-12) and [[(s["start"], s["end"]) for s in x] for x in offending] == [[(s["start"], s["end"]) for s in x] for x in spans]


def test_pipeline_batches_are_a_megabyte(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 << 20))
        corpus_pipeline._ready(spark)
        assert int(spark.conf.get(key)) == 1 << 20
    finally:
        spark.conf.set(key, before)


def test_a_task_drops_other_operators_tables_and_gives_memory_back(monkeypatch):
    times = []
    monkeypatch.setattr(workers, "give_back", lambda: times.append("given back"))
    bpe.encoder(vocab_path())
    assert list(workers.lean(iter, tables=True)([1, 2])) == [1, 2]
    assert bpe.encoder.cache_info().currsize and vocab.load_vocab.cache_info().currsize and len(times) == 1
    assert list(workers.lean(iter)([3])) == [3]
    assert not bpe.encoder.cache_info().currsize and not vocab.load_vocab.cache_info().currsize and len(times) == 3


def test_pipeline_workers_take_arrow_memory_from_the_system(spark):
    before = dict(spark.sparkContext.environment)

    def run(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pa.default_memory_pool().backend_name])], ["pool"])

    try:
        corpus_pipeline._ready(spark)
        assert {r["pool"] for r in spark.range(4).mapInArrow(run, "pool string").collect()} == {"system"}
    finally:
        spark.sparkContext.environment.clear()
        spark.sparkContext.environment.update(before)
