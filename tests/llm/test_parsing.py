"""Locally consistent parsing: consistency of the phrases, pairing by descending id, likeness."""

import hashlib
import random

import numpy as np

from cohortlens.llm import parsing


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_labels_differ_and_phrases_are_short():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 1 << 63, 20_000, dtype=np.uint64)
    symbols = symbols[np.append(True, symbols[1:] != symbols[:-1])]
    first = np.zeros(len(symbols), dtype=bool)
    first[0] = True
    label = parsing.coin_labels(symbols, first)
    assert label.max() <= 5 and (label[2:] != label[1:-1]).all()
    names, lead = parsing.parse(symbols, first)
    assert len(symbols) / 11 < len(names) < len(symbols) / 2 and lead.sum() == 1


def test_equal_substrings_share_their_interior():
    rnd = random.Random(2)
    shared = words(rnd, 400).encode()
    for offset in (0, 1, 2, 7, 50):
        a = words(rnd, 30).encode()[:offset] + shared
        b = words(rnd, 60).encode() + shared + b" tail"
        for level, ((names, owner),) in enumerate(zip(parsing.phrase_names([a, b], 4)), 1):
            one, two = set(names[owner == 0].tolist()), set(names[owner == 1].tolist())
            lost = 2 * 12  # phrases at the ends of the shared part
            assert len(one & two) >= len(one) - lost - offset


def test_alone_or_together_alike():
    rnd = random.Random(3)
    texts = [b"", b"a", b"aa", b"a" * 5000, "é".encode() * 70, b"ab" * 300] + [words(rnd, rnd.randint(1, 300)).encode() for _ in range(30)]
    together = parsing.sketches(texts)
    assert all((parsing.sketches([t])[0] == s).all() for t, s in zip(texts, together))
    assert not together[0].any() and together[1].any()
    assert (parsing.likeness(together, together) == 1).all()
    assert all((parsing.from_text(parsing.as_text(s)) == s).all() for s in together)


def brute(rows):
    """rows: (doc_id, text), ids unique or None last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        f = [parsing.sketches([x.encode()]) for x in (t, e, u)]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), parsing.as_text(f[0][0]), parsing.as_text(f[1][0]), parsing.likeness(f[0], f[1])[0], parsing.likeness(f[0], f[2])[0])
    return out


def test_rows(spark):
    rnd = random.Random(4)
    rows = [(1, None), (2, ""), (5, "x"), (9, "日本語テキスト" * 9), (-3, words(rnd, 50)), (70, "z" * 400_000), (71, "same text here"), (72, "same text here"), (None, "no id")]
    rows += [(1000 + 7 * i, words(rnd, rnd.randint(1, 60))) for i in range(150)]
    df = spark.createDataFrame([(d, t, "k", 0, True) for d, t in rows], "doc_id long, text string, _bucket string, n_chars int, _ghost boolean").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in parsing.compare_with_edits(df).collect()}
    assert got == brute(rows)
    assert parsing.compare_with_edits(df.limit(0)).count() == 0
    one = parsing.compare_with_edits(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one[0].near_next == 1
    twice = spark.createDataFrame([(3, "abcdef")] * 3 + [(2, "u"), (2, "v")], "doc_id long, text string")
    assert sorted(r.doc_id for r in parsing.compare_with_edits(twice).collect()) == [2, 2, 3, 3, 3]
    assert {r.doc_id: r.fingerprint for r in parsing.fingerprints(df).collect()} == {d: v[2] for d, v in got.items()}


def test_whole_table(spark):
    from conftest import SMALL

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in parsing.op10_parse_fingerprints(spark, SMALL).collect()}
    assert got == brute(rows)
    near = np.array([(v[4], v[5]) for v in got.values()])
    assert np.median(near[:, 0]) > 0.4 and np.median(near[:, 1]) < 0.1
