"""The filter interaction audit against direct simulation of every order."""

import math
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from cohortlens.llm import filter_audit
from cohortlens.llm.diagrams import Diagram, adjacent_swaps


def fails(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic). Runs every order over every document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = {}
    for d, t, lang in rows:
        own = fails(t)
        if d is not None and any(e is not None and e < d and (u or "") == (t or "") for e, u, _ in rows):
            own.add("E")
        parts.setdefault(lang or "", []).append((d, own))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing = sum(f in x[1] for x in docs)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(x[1] == {f} for x in docs),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def got(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows) and all(r.filter == r.filter_order[r.step - 1] for r in rows)
    return out


@pytest.mark.parametrize("n", range(1, 7))
def test_swaps_visit_every_order_once(n):
    order, seen = list(range(n)), set()
    seen.add(tuple(order))
    for i in adjacent_swaps(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n) == 1 + sum(1 for _ in adjacent_swaps(n))


def test_diagram_against_counting():
    rng = np.random.default_rng(4)
    masks = {int(m): tuple(int(x) for x in rng.integers(0, 50, 2)) for m in rng.choice(16, 9, replace=False)}
    diagram = Diagram(masks, 4)
    orders = set()
    for path in diagram.all_orders():
        left = dict(masks)
        orders.add(tuple(v for v, _, _ in path))
        for v, removed, kept in path:
            gone = {m: w for m, w in left.items() if m >> v & 1}
            left = {m: w for m, w in left.items() if not m >> v & 1}
            assert removed == tuple(sum(w[i] for w in gone.values()) for i in (0, 1))
            assert kept == tuple(sum(w[i] for w in left.values()) for i in (0, 1))
        # reduced: no two equal nodes on a level
        assert all(len(set(level)) == len(level) for level in diagram.levels)
    assert len(orders) == 24
    same = Diagram({m: (1,) for m in range(8)}, 3)  # every mask alike: one node a level, one leaf
    assert [len(level) for level in same.levels] == [1, 1, 1] and same.leaves == [(1,)] and same.weights[0] == [(8,)]


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", " \t\n", "short", "SHORT A", "a#b", long, long + " |", "x " * 200, "X " * 200, long + "é" * 50, "Ü" * 30 + " ÜB", "w " * 150_000 + "A" * 40_000]
    rows, i = [], 0
    for lang in ("en", None, "", "fr"):
        for t in texts:
            rows.append((i * 7 % 97, t, lang))
            i += 1
    rows += [(None, long, "en"), (None, "short", None), (3, "twice", "en"), (3, "twice", "en"), (3, "twice", "fr"), (200, "lonely", "it")]
    rows += [(1000 + k, "hot copy", "en") for k in range(400)]
    labels = [(d, d % 2, d % 3 == 0 and 1 or 0) for d in range(0, 97, 2)] + [(3, 0, 1), (3, 1, 0), (3, None, None), (None, 1, 1), (1000, 1, 0), (1001, 1, 1), (5555, 1, 1)]
    docs = spark.createDataFrame([(*r, "k", 1, True) for r in rows], "doc_id long, text string, lang string, mask string, n int, good boolean").repartition(5)
    marks = spark.createDataFrame([(*r, "z") for r in labels], "doc_id long, quality int, toxic int, part string")
    out = got(filter_audit.audit(docs, marks))
    assert out == brute(rows, labels)
    assert len(out) == 600 * 4  # NULL and empty lang are one part
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    none = got(filter_audit.audit(docs, marks.limit(0)))
    assert none == brute(rows, [])


def test_whole_table_against_oracle(spark):
    import duckdb
    from conftest import MID

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{MID}/{t}.parquet'")
    cols = "part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley"
    want = con.execute(f"SELECT {cols} FROM ({filter_audit.ORACLE})").fetchall()
    have = [tuple(r) for r in filter_audit.op11_filter_audit(spark, MID).select(*cols.split(", ")).collect()]
    assert sorted(have) == sorted(want) and len(want) % 600 == 0
