"""Training, scoring, folds and embeddings on small tables."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from relfold.learn import boost, terms
from relfold.operators import hotkeys
from relfold.operators.evaluate import auc
from relfold.sources import store, tables

FAST = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.3, "minInfoGain": 0.0}


@pytest.fixture(scope="module")
def separable(spark):
    rows = [(i, None if i % 5 == 0 else int((i * 37) % 100 > 50), float((i * 37) % 100) if i % 11 else None, float(i % 7)) for i in range(400)]
    return spark.createDataFrame(rows, "id bigint, label int, x double, noise double")


def test_cross_validation_separates_and_covers_every_row_once(spark, separable):
    scores = boost.cross_validate(separable, "id", "label", ["x", "noise"], k=3, params=FAST)
    scores = scores.join(separable.select("id", "label"), "id").cache()
    assert scores.count() == 400 and scores.select("id").distinct().count() == 400
    assert scores.where("part = 'test'").count() == separable.where("label is null").count()
    assert scores.where("score < 0 or score > 1 or score is null").count() == 0
    assert {r[0] for r in scores.where("part = 'train'").select("fold").distinct().collect()} == {0, 1, 2}
    assert auc(scores.where("part = 'train'"), "label", "score").first()[0] > 0.9


def test_importance_ranks_the_signal_first(separable):
    features = boost.predictors(separable, "label", ["id"])
    assert features == ["x", "noise"]
    model = boost.train(separable, "label", features, FAST)
    top = boost.feature_importance(model, features, separable).first()
    assert top["feature"] == "x" and top["importance"] > 0.5


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"Alpha common word_{i % 4} été" if i % 2 else f"beta COMMON word_{i % 4} only{i}") for i in range(40)]
    return spark.createDataFrame(rows, "id bigint, text string")


def test_terms_by_brute_force(spark, corpus):
    import re

    found = {}
    for r in corpus.collect():
        for t in re.findall(r"\b\w+\b", r["text"].lower()):
            found[r["id"], t] = found.get((r["id"], t), 0) + 1
    ids = {}
    for i, t in found:
        ids.setdefault(t, set()).add(i)
    expected = sorted((i, t, n) for (i, t), n in found.items() if len(ids[t]) >= 2)
    assert sorted(map(tuple, terms.term_counts(corpus, "id", "text").select("id", "term", "n").collect())) == expected


def test_vocabulary_is_fitted_once_for_both_corpora(spark, corpus):
    vocab = terms.vocabulary(corpus, "id", "text")
    other = spark.createDataFrame([(1, "common unseen"), (2, "unseen")], "id bigint, text string")
    got = terms.indexed_counts(other, "id", "text", vocab).join(vocab, "idx").select("id", "term", "n").collect()
    assert [tuple(r) for r in got] == [(1, "common", 1)]
    assert sorted(r[0] for r in vocab.select("idx").collect()) == list(range(vocab.count()))


def dense(c, key="id"):
    """The stored counts as a numpy table, with the ids and term numbers in order."""
    rows = c.counts.collect()
    ids, cols = sorted({r[key] for r in rows}), sorted({r["idx"] for r in rows})
    x = np.zeros((len(ids), len(cols)))
    for r in rows:
        x[ids.index(r[key]), cols.index(r["idx"])] = r["n"]
    return x, ids, cols


@pytest.mark.parametrize("share", [None, 3])
def test_svd_equals_numpy(monkeypatch, corpus, share):
    if share:
        monkeypatch.setattr(hotkeys, "SENT_SHARE", share)
    c, _ = terms.corpus(corpus, "id", "text")
    x, _, cols = dense(c)
    found = terms.singular_vectors(c, 2, max_iter=60, tolerance=1e-13)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert found.values == pytest.approx(s[:2].tolist(), rel=1e-9)
    v = np.array([[r["v0"], r["v1"]] for r in found.terms.orderBy("idx").collect()])
    assert v.T @ v == pytest.approx(np.eye(2), abs=1e-9) and (v.sum(axis=0) >= 0).all() and len(v) == len(cols)
    got = found.ids.orderBy("id").collect()
    for j in range(2):
        assert np.abs([r[f"svd_{j}"] for r in got]) == pytest.approx(np.abs(u[:, j] * s[j]), abs=1e-5)
        assert np.abs(v[:, j]) == pytest.approx(np.abs(vt[j]), abs=1e-5)


def test_svd_of_fewer_dimensions_than_asked(spark):
    rows = spark.createDataFrame([(i, "one two" if i % 2 else "one two one two") for i in range(10)], "id bigint, text string")
    found = terms.singular_vectors(terms.corpus(rows, "id", "text")[0], 5)
    assert len(found.values) == 1 and found.values[0] == pytest.approx(np.sqrt(10 + 40))


@pytest.mark.parametrize("share", [None, 3])
def test_factors_equal_numpy_and_the_loss_falls(monkeypatch, corpus, share):
    if share:
        monkeypatch.setattr(hotkeys, "SENT_SHARE", share)
    c, _ = terms.corpus(corpus, "id", "text")
    x, _, _ = dense(c)
    f = terms.first_factors(c, 3, 7)

    def tables(f):
        return [np.array([list(r)[-3:] for r in t.orderBy(k).collect()]) for t, k in ((f.ids, "id"), (f.terms, "idx"))]

    def plain_loss(w, h):
        e = w @ h.T
        seen = np.where(x > 0, x * np.log(np.where(x > 0, x, 1) / e), 0)
        return (seen - x + e).sum() + terms.L1 * (w.sum() + h.sum()) + terms.L2 / 2 * ((w**2).sum() + (h**2).sum())

    w, h = tables(f)
    losses = [terms.factor_loss(c, f, 3)]
    for _ in range(4):
        f = terms.factor_step(c, f, 3)
        w = w * ((x / (w @ h.T)) @ h) / (h.sum(axis=0) + terms.L1 + terms.L2 * w)
        h = h * ((x / (w @ h.T)).T @ w) / (w.sum(axis=0) + terms.L1 + terms.L2 * h)
        got = tables(f)
        assert got[0] == pytest.approx(w, abs=1e-9) and got[1] == pytest.approx(h, abs=1e-9)
        losses.append(terms.factor_loss(c, f, 3))
        assert losses[-1] == pytest.approx(plain_loss(w, h), rel=1e-9)
    assert all(b < a for a, b in zip(losses, losses[1:], strict=False))


def test_vectors_hold_the_counts(corpus):
    c, _ = terms.corpus(corpus, "id", "text")
    x, ids, _ = dense(c)
    vectors = terms.to_vectors(c.counts, "id", c.size)
    assert "Python" not in vectors._jdf.queryExecution().toString()
    found = {r["id"]: r["features"].toArray() for r in vectors.collect()}
    assert all((found[i] == x[k]).all() for k, i in enumerate(ids)) and len(found) == len(ids)


def test_counts_of_a_hot_term_and_a_hot_id(monkeypatch, spark):
    monkeypatch.setattr(hotkeys, "SENT_SHARE", 4)
    rows = [(i, f"the w{i % 40} v{i % 30}") for i in range(200)] + [(0, " ".join(f"w{k} the" for k in range(40)))] * 3
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = Counter(map(tuple, terms.term_counts(df, "id", "text").collect()))
    expected = Counter()
    for i, t in rows:
        for w in t.split():
            expected[i, w] += 1
    assert got == Counter((i, w, n) for (i, w), n in expected.items())


def test_embedding_has_one_row_per_entity(corpus):
    out = terms.embed(corpus, corpus, "id", "text", k=3, max_iter=3)
    assert out.count() == 40 and len(out.columns) == 10
    row = out.select(F.round(F.col("topic_0") + F.col("topic_1") + F.col("topic_2"), 6), F.least("factor_0", "factor_1", "factor_2")).agg(F.min("round(((topic_0 + topic_1) + topic_2), 6)"), F.min("least(factor_0, factor_1, factor_2)")).first()
    assert row[0] == 1.0 and row[1] >= 0


def test_sources_and_store(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "id bigint, c string, v double")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_table(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "csv"))
    first = store.materialize(df, "block", "k", str(tmp_path))
    again = store.materialize(df, "block", "k", str(tmp_path))
    assert again.inputFiles() == first.inputFiles() and again.count() == first.count() == 2
    # other rows, or another plan over the same rows, are another block
    other = store.materialize(spark.createDataFrame([(9, "z", 1.0)], df.schema), "block", "k", str(tmp_path))
    assert other.count() == 1
    source = tables.read_table(spark, str(tmp_path / "csv"), df.schema)
    paths = {store.block_path(source.where(f"id > {n}"), "block", "k") for n in (0, 1, 0)}
    assert len(paths) == 2
    assert store.materialize(spark.createDataFrame([(9, "z", 1.0)], df.schema), "block", "k2", str(tmp_path)).count() == 1
    # a rewritten input file, under the same name, is another block
    path = str(tmp_path / "x.parquet")
    for values, total in (([1, 2, 3], 6), ([10, 20, 30], 60), ([10, 20, 31], 61)):
        spark.createDataFrame([(v,) for v in values], "v long").coalesce(1).write.mode("overwrite").parquet(path)
        file = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        os.replace(f"{path}/{file}", f"{path}/part.parquet")
        block = spark.read.parquet(f"{path}/part.parquet").selectExpr("sum(v) AS total")
        assert store.materialize(block, "sums", "k", str(tmp_path)).first()["total"] == total
        assert store.materialize(block, "sums", "k", str(tmp_path)).inputFiles() == store.materialize(block, "sums", "k", str(tmp_path)).inputFiles()
    both = tables.labelled_union(spark.createDataFrame([(1, 0)], "id int, label int"), spark.createDataFrame([(2,)], "id int"))
    assert sorted(map(tuple, both.collect())) == [(1, 0), (2, None)]
