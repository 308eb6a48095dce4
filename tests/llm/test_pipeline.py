"""The corpus pipeline stage by stage against brute force."""

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline
from cohortlens.llm.common import written


def test_stages(spark):
    from conftest import MID
    from test_mixing import draw
    from test_simhash import brute_components, brute_fingerprint

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    step = lambda name, d: written(stages[name](spark, d, MID), "test")
    whole = lambda d: Counter(tuple(r) for r in d.collect())

    good = step("quality classifier", docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    ids = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns
    clean = [d for d, q in labels.items() if q]
    assert sum(d in ids for d in clean) >= 0.99 * len(clean) and sum(d in ids for d, q in labels.items() if not q) <= 0.02 * len(labels)

    exact = step("exact dedup", good)
    first = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    assert whole(exact) == Counter(tuple(r) for r in first.values())

    near = step("simhash near dedup", exact)
    rows = exact.collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    component = brute_components(list(fps.items()))
    assert whole(near) == Counter(tuple(r) for r in rows if component[fps[r.doc_id]] == r.doc_id)

    mixed = step("mixing", near)
    rows = near.collect()
    n = Counter(r.source for r in rows)
    total = sum(v ** 0.5 for v in n.values())
    rate = {s: v ** 0.5 / total * len(rows) / v for s, v in n.items()}
    assert whole(mixed) == Counter({tuple(r): k for r in rows if (k := draw(r.doc_id, rate[r.source]))})

    packed = step("packing", mixed).collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)
    assert sum(r.start == 0 for r in packed) == mixed.count()
    assert corpus_pipeline.run(spark, MID).count() == len(packed)
