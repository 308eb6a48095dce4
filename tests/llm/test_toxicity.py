"""Multiple-instance toxicity: held-out accuracy, the gradient, places of sentences, awkward rows."""

import random
import zlib

import numpy as np
import pytest

from cohortlens.llm import toxicity


def planted(n, seed):
    """Documents of neutral words; toxic ones hold one sentence with two words of a small lexicon."""
    rnd = random.Random(seed)
    neutral = [f"wort{i}" for i in range(400)]
    bad = ["gnarf", "blork", "zwick"]
    docs, labels = [], []
    for d in range(n):
        sentences = [" ".join(rnd.choice(neutral) for _ in range(rnd.randint(3, 12))) for _ in range(rnd.randint(1, 30))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            sentences[rnd.randrange(len(sentences))] = f"Du {rnd.choice(bad).upper()}, {rnd.choice(bad)} {rnd.choice(neutral)}"
        docs.append((d, ". ".join(sentences) + "!"))
        if rnd.random() < 0.7:
            labels.append((d, 1, toxic if rnd.random() > 0.02 else 1 - toxic))
    return docs, labels


def test_gradient_is_the_derivative():
    rng = np.random.default_rng(1)
    theta = rng.normal(0, 1, 7)
    label, bags = np.array([1, 0, 1, 0, 1]), np.array([2, 1, 0, 3, 1])
    sizes = np.array([1, 2, 1, 3, 1, 1, 2])
    words = rng.integers(0, 5, sizes.sum())
    weights = {1: 1.5, 0: 0.7}
    g = toxicity.noisy_or_gradient(theta, label, bags, sizes, words, weights)
    for i in range(len(theta)):
        h = np.zeros(len(theta))
        h[i] = 1e-6
        up, down = (toxicity.noisy_or_gradient(theta + s * h, label, bags, sizes, words, weights)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - g[1 + i]) < 1e-5


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = planted(1200, 3)
    d = spark.createDataFrame([(*x, 7.0) for x in docs], "doc_id long, text string, score double")
    l = spark.createDataFrame(labels + [labels[0], (None, 1, 1), (5, None, None)], "doc_id long, quality long, toxic long")
    return d, l, toxicity.fit(d, l), dict(docs)


def test_held_out_accuracy_and_places(spark, fitted):
    docs, _, model, texts = fitted
    rows = toxicity.score_documents(docs, model).collect()
    hits = right = 0
    for r in rows:
        truth = any(w in texts[r.doc_id].lower() for w in ("gnarf", "blork", "zwick"))
        right += (r.score >= toxicity.PREDICTED) == truth
        for s in r.offending:
            hits += 1
            assert any(w in texts[r.doc_id][s.start:s.end].lower() for w in ("gnarf", "blork", "zwick"))
        assert 0 <= r.score <= 1
    assert right >= 0.98 * len(rows) and hits > 100


def test_held_out_labels_are_not_used(spark, fitted):
    docs, labels, model, _ = fitted
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, flipped)
    assert again.vocabulary == model.vocabulary and np.allclose(again.weights, model.weights)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.h for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).limit(200).collect())


def test_awkward_rows(spark, fitted):
    docs, labels, model, _ = fitted
    rows = [(1, None), (2, ""), (3, "...!?\n\n"), (4, "word. " * 100_000), (4, "gnarf zwick"), (None, "GNARF blork"), (5, "İ GNARF ZWICK. ok")]
    out = toxicity.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(out) == len(rows)
    leak = [r.score for r in out if r.doc_id in (1, 2, 3)]
    assert max(leak) == min(leak) < 0.1
    assert [r for r in out if r.doc_id == 4 and r.score < 0.1] and [r for r in out if r.doc_id is None][0].score > 0.5
    assert [(s.start, s.end) for r in out if r.doc_id == 5 for s in r.offending] == [(0, 13)]
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0))
    assert not nothing.vocabulary and all(r.score < 0.1 for r in toxicity.score_documents(docs.limit(5), nothing).collect())


def test_query(spark):
    from conftest import MID

    out = toxicity.op1_toxicity_mil(spark, MID)
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    rows = out.join(labels, "doc_id").filter("not held_out").collect()
    assert out.count() == 1000
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
