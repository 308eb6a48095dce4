"""Weak labels: EM on known rates, accuracy against labels that it never saw, awkward rows."""

import numpy as np

from cohortlens.llm import quality


def test_em_finds_known_rates():
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.8
    counts = {}
    for g in good:
        code = 0
        for k in range(len(quality.LABELLERS)):
            p = ((0.9, 0.05), (0.75, 0.02))[k % 2][int(g)]  # how often it votes bad
            u = rng.random()
            code = 3 * code + (quality.BAD if u < p else quality.ABSTAIN if u > 0.97 else quality.GOOD)
        counts[code] = counts.get(code, 0) + 1
    posterior, prior, rates = quality.expectation_maximisation(counts)
    assert abs(prior - 0.8) < 0.02
    assert np.allclose(rates[0, :, quality.BAD], [0.9, 0.75] * 4, atol=0.05) and np.allclose(rates[1, :, quality.BAD], [0.05, 0.02] * 4, atol=0.02)
    assert quality.expectation_maximisation({})[1] == 1.0


def test_accuracy_against_unseen_labels(spark):
    from conftest import MID

    out = quality.op4_quality_weak_labels(spark, MID)
    assert out.count() == 1000
    rows = out.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.98
    assert np.mean([r.kept for r in rows if r.quality]) > 0.99


def test_rows(spark):
    prose = "A plain sentence of words that follow each other, as in any text. "
    rows = [(i, prose * (1 + i % 5) + f"Number {i}.") for i in range(60)]
    rows += [(100 + i, "THE!! WORDS!! ARE!! SHOUTED!! " * 30 + str(i)) for i in range(10)] + [(200 + i, "a%%% b### c&&& d*** " * 30) for i in range(10)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "x" * 300_000), (304, "one"), (305, prose), (305, prose), (None, prose * 2), (306, "word word " * 5000)]
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, score string, code int")
    kept = quality.good_documents(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(range(60)) <= set(ids) and not [i for i in ids if i is not None and 100 <= i < 300] and 306 not in ids
    assert ids.count(305) == 2 and ids.count(None) == 1 and 304 in ids
    assert quality.good_documents(df.limit(0)).count() == 0
    alike = quality.good_documents(df.filter("doc_id < 60"))
    assert alike.count() == 60


def test_large_class_of_few_texts(spark):
    """A bad class of more rows than the sample bound, but one text; a text with a third of the rows; no class in the sample."""
    prose = "A plain sentence of words that follow each other, as in any text. "
    spam = [f"a%%% b### c&&& d*** {k} " * 30 for k in range(12)]
    good = [(i, prose * (1 + i % 5) + f"Number {i}.") for i in range(120)]
    for page in spam[:4]:
        rows = good + [(1000 + i, page) for i in range(90)] + [(2000 + i, prose * 3) for i in range(60)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for per_class in (40,) if page != spam[0] else (40, 1):
            model = quality.fit(df, per_class)
            assert not quality.judge(df, model).filter("quality_judgement.kept <> (doc_id < 1000 or doc_id >= 2000)").count(), (page[:30], per_class)
    assert model.weights is not None
    texts = quality.text_counts(df)
    assert texts.count() == 122 and sum(quality.pattern_counts(texts).values()) == 270
    bare = quality.WeakLabelModel({0: 0.25}, 0.9, model.rates, None, 0.0)
    worst = [2 * bound for _, _, bound in quality.LABELLERS]
    assert bare.score(b"", worst) == 0.25 and bare.score(b"", [0.0] * len(worst)) == 0.9
