"""What op7 reads and how often; its array kernels against plain ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relfold.llm import lm

ODD = ["", " ", None, "\n a\tB\x0b\x0cC\r ", "Ünï. code!", "...", "!", "a.", "é?!", "a1,", "zz", "x\x1cy", "x y z\x85", "ÀB İ", "\x00 \x7f", "漢字 漢字."]


def test_each_text_is_read_twice(spark, sf_dir):
    # once to count words, once to turn them into symbols; rare words came from a third reading
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").mapInArrow(counted, "doc_id long, text string")
    rows = lm.score(docs, F.col("doc_id") % 7 != 2, dictionary=300).collect()
    assert read.value == 2 * len(rows) > 0


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("held", [1, 1 << 20])
def test_runs_of_texts_have_the_words_of_each(monkeypatch, kind, held):
    monkeypatch.setattr(lm, "READ_BYTES", held)
    found = []
    for first, sizes, words in lm.word_runs(pa.array(ODD * 3, kind)[1:]):
        assert first == len(found)
        own = iter(words.to_pylist())
        found += [[next(own).encode() for _ in range(n)] for n in sizes]
        assert next(own, None) is None
    assert found == [lm.tokens((t or "").encode()) for t in (ODD * 3)[1:]]
    assert not list(lm.word_runs(pa.array([], kind)))


def test_spelling_classes_of_many_words():
    words = [w for t in ODD for w in lm.tokens((t or "").encode())] + [lm.END.encode()]
    array = pa.array([w.decode() for w in words])
    assert lm.shapes(array).tolist() == [lm.shape(w) for w in words]
    assert lm.shapes(array[3:7]).tolist() == [lm.shape(w) for w in words[3:7]]


def test_large_weights_give_finite_and_equal_outputs(monkeypatch):
    r = np.random.default_rng(1)
    texts = [r.integers(0, lm.SYMBOLS, n) for n in (90, 40, 2)]
    nets = []
    for limit in (0, 1e9):
        monkeypatch.setattr(lm, "SMALL_OUTPUT", limit)
        nets.append(lm.Network({k: v.astype(np.float64) * 5 for k, v in lm.first_weights().items()}))
        nets[-1].train(texts)
        assert np.isfinite(nets[-1].score(texts)).all()
    for k in nets[0].w:
        assert nets[0].w[k] == pytest.approx(nets[1].w[k], abs=1e-9)
    # as 32-bit numbers too, far above the bound
    monkeypatch.setattr(lm, "SMALL_OUTPUT", 60)
    network = lm.Network({k: v * np.float32(200) for k, v in lm.first_weights().items()})
    network.train(texts)
    assert np.isfinite(network.score(texts)).all()
