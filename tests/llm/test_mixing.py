"""Poisson mixing: counts invert the distribution, rates meet targets, awkward rows."""

import hashlib
import math

import numpy as np

from cohortlens.llm import mixing


def draw(doc_id, rate, seed=mixing.SEED):
    parts = math.ceil(rate / mixing.PART_MEAN)
    total = 0
    for i in range(1, parts + 1):
        key = f"{seed}:{'' if doc_id is None else doc_id}:{i}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52)
        p = c = math.exp(-rate / parts)
        k = 0
        while c <= u:
            k += 1
            p *= rate / parts / k
            c += p
        total += k
    return total


def test_counts_and_order(spark):
    rows = [(i, f"t{i}", ("big", "big", "big", "mid", None)[i % 5]) for i in range(3000)] + [(9000, None, "tiny"), (9001, "", "tiny"), (None, "n", "tiny"), (9002, "x" * 200_000, "tiny"), (7, "t7 twice", "big")]
    df = spark.createDataFrame([(*r, 1.5, "n") for r in rows], "doc_id long, text string, source string, n double, weight string")
    targets = spark.createDataFrame([("big", 1.0), ("mid", 2.0), ("tiny", 0.5), ("tiny", 0.5), (None, 1.0), ("absent", 3.0)], "source string, weight double")
    rates = {r.source: r.rate for r in mixing.source_rates(df, targets).collect()}
    sizes = {"big": 1801, "mid": 600, None: 600, "tiny": 4}
    for s, n in sizes.items():
        share = {"big": 1, "mid": 2, None: 1, "tiny": 1}[s] / 5
        assert abs(rates[s] - share * sum(sizes.values()) / n) < 1e-9
    out = mixing.mixture(df, targets).collect()
    got = {}
    for r in out:
        got.setdefault((r.doc_id, r.text), []).append(r.copy)
        assert r.doc_id is None or r.copies == draw(r.doc_id, rates[r.source])
    for d, t, s in rows:
        if d is None:  # drawn by its place
            assert len(got[d, t]) > 50 and sorted(got[d, t]) == list(range(1, len(got[d, t]) + 1))
            continue
        assert sorted(got.get((d, t), [])) == list(range(1, draw(d, rates[s]) + 1))
    keys = [r.shuffle_key for r in out]
    assert keys == sorted(keys)  # partition after partition
    assert rates["tiny"] > 100  # a sum of parts
    for s in ("big", "mid"):
        drawn = [draw(d, rates[s]) for d, _, x in rows if x == s]
        assert abs(np.mean(drawn) - rates[s]) < 5 * math.sqrt(rates[s] / len(drawn))
    assert mixing.mixture(df.limit(0)).count() == 0
    assert mixing.mixture(df, targets.filter("source = 'absent'")).count() == 0


def test_large_rate_table_is_joined(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i}", f"s{i % 9}") for i in range(300)], "doc_id long, text string, source string")
    want = sorted((r.doc_id, r.copy) for r in mixing.mixture(df).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 3)
    assert sorted((r.doc_id, r.copy) for r in mixing.mixture(df).collect()) == want


def test_rows_without_an_id_draw_each_for_itself(spark, tmp_path):
    rows = [(None if i % 3 else i, f"t{i}", "many" if i < 4000 else "few") for i in range(4500)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    rates = {r.source: r.rate for r in mixing.source_rates(df).collect()}
    out = mixing.mixture(df).collect()
    assert "_mixing_name" not in out[0].asDict()
    for source, size in (("many", 4000), ("few", 500)):
        none = [t for d, t, s in rows if d is None and s == source]
        copies = {t: 0 for t in none}
        for r in out:
            if r.doc_id is None and r.source == source:
                copies[r.text] += 1
        assert len(set(copies.values())) > 2
        assert abs(np.mean(list(copies.values())) - rates[source]) < 5 * math.sqrt(rates[source] / len(none))
    assert sorted((r.text, r.copy) for r in out) == sorted((r.text, r.copy) for r in mixing.mixture(df).collect())
    keys = [r.shuffle_key for r in out]
    assert len(set(keys)) == len(keys)
