"""Ranked lexical search against scores computed document by document."""

import math
import random
import re
from collections import Counter

import numpy as np

from cohortlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=20):
    bags = [(d, Counter(words(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(1 for s in sizes if s), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked = Counter(words(text))
        scored = []
        for (d, bag), n in zip(bags, sizes):
            score = 0
            for t, times in asked.items():
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // total
                    score += times * w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((score, d))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, rank, d, score) for rank, (score, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()], key=repr)


def frames(spark, docs, items):
    a = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], "doc_id long, text string, n long, m int, terms string").repartition(5)
    b = spark.createDataFrame([(i, t, 7, "y") for i, t in items], "item_id long, text string, doc_id long, score string")
    return a, b


def test_terms_are_those_of_the_pattern():
    rnd = random.Random(1)
    for _ in range(200):
        text = "".join(rnd.choice("aZ09 _-.\t\n\0\x7f{}@[`/:éÉßΩ漢😀") for _ in range(40))
        assert [t.decode() for t in lexical.terms(text.encode())] == words(text)


def test_bounds_hold_for_every_document():
    rng = np.random.default_rng(2)
    items = lexical.Items([b"a b b c", b"", b"d a", b"zz"])
    assert items.numbers.tolist() == [0, 2, 3]
    items.weigh(100, {t: 3 + t for t in range(4)})
    found = [np.sort(rng.choice(4, rng.integers(1, 5), replace=False)).astype(np.int32) for _ in range(30)]
    counts = [rng.integers(1, 6, len(t)).astype(np.int32) for t in found]
    term, tf, place = np.concatenate(found), np.concatenate(counts), np.repeat(np.arange(30), [len(t) for t in found])
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
    chunk = lexical._Chunk(90, term[first], tf[first], np.r_[first, len(term)], place)
    scores = chunk.scores(items, np.arange(3), 30)
    assert (scores <= chunk.bounds(items)[:, None]).all()
    worth = dict(zip(range(4), (math.floor(1000 * math.log(202 / (2 * (3 + t) + 1))) for t in range(4))))
    for i in range(30):
        own = dict(zip(found[i].tolist(), counts[i].tolist()))
        impact = {t: 10**9 * f // (1000 * f + 12 * 90) * worth[t] for t, f in own.items()}
        assert scores[0, i] == impact.get(0, 0) + 2 * impact.get(1, 0) + impact.get(2, 0)


def test_edge_rows(spark):
    rnd = random.Random(3)
    vocabulary = ["the"] * 8 + ["of"] * 4 + [f"w{i}" for i in range(60)] + ["Ünï", "ünï", "A1", "a1"]
    docs = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice((1, 3, 20, 80))))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, " .,-_ "), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (5, "w1 w2 w3"), (5, "w1 w2 w3"), (403, "w7 " * 60_000)]
    docs += [(1000 + i, "w1-W2_w3") for i in range(90)]  # many equal scores
    items = [(1, "w1 w2 w3 w3 the"), (2, None), (3, ""), (4, "nowhere"), (5, "the of the"), (None, "w9 A1 Ünï"), (7, "w7"), (8, "w10 w11 nowhere"), (9, "...")]
    a, b = frames(spark, docs, items)
    want = brute(docs, items)
    assert got(lexical.search(a, b)) == want
    assert max(r[1] for r in want) == 20 and {r[0] for r in want} == {1, 5, None, 7, 8}
    assert got(lexical.search(a, b, block_bytes=12)) == want  # an item or two at a time
    assert got(lexical.search(a, b, k=3)) == brute(docs, items, 3)
    twice = spark.createDataFrame([(1, "w1 w2"), (1, "w1 w2")], "item_id long, text string")
    assert got(lexical.search(a, twice)) == sorted(2 * brute(docs, [(1, "w1 w2")]), key=repr)
    for x, y in ((a.limit(0), b), (a, b.limit(0)), (a.filter("doc_id in (400, 401, 402)"), b)):
        assert lexical.search(x, y).count() == 0


def test_strata_are_split_and_whole(spark):
    docs = [(i, "alpha beta " + f"x{i % 7} " * 3) for i in range(4000)]  # one stratum holds every row
    a, _ = frames(spark, docs, [])
    items = lexical.Items([b"alpha beta x0 x1 x2 x3 x4 x5 x6"])
    own = lexical.written(lexical.bags(a, items.vocabulary), "test-bags")
    index = lexical.written(lexical.stratified_index(own, 4000, 20000, 12000), "test-index").collect()
    assert {r.m for r in index} == {100} and len(index) >= 8 and len({r.chunk for r in index}) == len(index)
    assert sorted(d for r in index for d in r.docs) == list(range(4000))
    assert all(len(r.places) <= lexical.CHUNK_POSTINGS and r.docs == sorted(r.docs) for r in index)


def test_whole_table_against_oracle(spark):
    import duckdb
    from conftest import MID

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{MID}/{t}.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({lexical.ORACLE})").fetchall()
    assert got(lexical.op12_stratified_search(spark, MID)) == sorted(want, key=repr)
    docs, items = (con.execute(f"SELECT {c}, text FROM {t}").fetchall() for c, t in (("doc_id", "documents"), ("item_id", "benchmark")))
    assert sorted(want, key=repr) == brute(docs, items)
