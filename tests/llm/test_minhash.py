"""MinHash near-duplicates against full comparison, and components against union-find."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlens.llm import minhash, stars


class Forest(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)} or ({" ".join(words)} if words else set())


def brute(rows, percent=85, width=5):
    sets = [shingles(t, width) for _, t in rows]
    at = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            at[s].append(i)
    forest = Forest()
    for i, own in enumerate(sets):
        for j, n in Counter(j for s in own for j in at[s] if j < i).items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                forest.link(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[forest.find(i)] = min(d, least.get(forest.find(i), d))
    found = [(d, len(sets[i]), least.get(forest.find(i))) for i, (d, _) in enumerate(rows)]
    return sorted(((d, n, c, d == c) for d, n, c in found), key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(-300, 300), rnd.randrange(-300, 300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(90)]             # a chain
    edges += [(2000 + rnd.randrange(1, 400), 2000) for _ in range(300)]  # a hot centre
    edges += [(3000, 3000), (3001, 3002), (3002, 3001), (3001, 3002)]
    forest = Forest()
    for a, b in edges:
        forest.link(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, stars.components(df).collect())) == sorted((x, forest.find(x)) for x in list(forest))
    assert stars.components(df.limit(0)).count() == 0


def test_a_round_keeps_what_is_connected(spark):
    edges = spark.createDataFrame([(5, 3), (3, 2), (9, 2), (9, 8), (7, 6)], "child long, parent long")
    for step in (stars.large_star, stars.small_star):
        after = [tuple(r) for r in step(edges).collect()]
        forest = Forest()
        for a, b in after:
            assert a > b
            forest.link(a, b)
        assert len({forest.find(x) for x in (2, 3, 5, 8, 9)}) == 1 and forest.find(7) == forest.find(6) == 6


def test_equal_minima_estimate_the_similarity():
    rng = np.random.default_rng(5)
    a, b = minhash._multipliers(400, 1), minhash._multipliers(400, 2)
    for shared in (0, 300, 600, 900):
        pool = rng.integers(0, 1 << 64, 2000 - shared, dtype=np.uint64)
        x, y = pool[:1000], pool[1000 - shared:]
        same = np.mean(minhash.signature(x, a, b) == minhash.signature(y, a, b))
        assert abs(same - shared / (2000 - shared)) < 0.1
    assert minhash.miss_bound() < 1e-7
    words = minhash._WordHashes()
    text = "a b c d e f a b c d e F g"
    assert len(minhash.shingle_set(text.encode(), 5, words)) == len(shingles(text))
    assert len(minhash.shingle_set(b"d c b a", 5, words)) == 1
    assert not set(minhash.shingle_set(b"a b", 5, words)) & set(minhash.shingle_set(b"b a", 5, words))


def family(rnd, words, copies, changes, first):
    out = []
    for i in range(copies):
        own = list(words)
        for _ in range(rnd.randint(0, changes)):
            own[rnd.randrange(len(own))] = f"n{rnd.randrange(10**6)}"
        out.append((first + i, " ".join(own)))
    return out


def test_edge_rows(spark):
    rnd = random.Random(7)
    base = [f"w{rnd.randrange(5000)}" for _ in range(400)]
    text = " ".join(base)
    rows = [(9, None), (8, ""), (7, " \t\n"), (None, ""), (5, text), (4, text.upper()), (4, text), (3, text + " tail"), (2, "one"), (1, "ONE"), (0, "one two"), (None, text), (None, "alone x"), (None, "alone X")]
    rows += [(11, "two words " * 30_000), (12, "words two " * 30_000), (13, " ".join(base[:370])), (14, " ".join(base[:300])), (15, "été Été É"), (16, "a b c d e"), (17, "A\nb\tc d e"), (18, "a b c d e f")]
    rows += family(rnd, base, 40, 8, 100) + [(1000 + i, "hot text of a few words here") for i in range(300)]
    df = spark.createDataFrame([(d, t, 1, "k", 2.0, True) for d, t in rows], "doc_id long, text string, row long, sig string, n double, kept boolean").repartition(6)
    assert got(minhash.near_duplicates(df)) == brute(rows)
    assert got(minhash.near_duplicates(df, percent=60, width=2)) == brute(rows, 60, 2)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert got(minhash.near_duplicates(df.filter("doc_id in (7, 8, 9)"))) == [(7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True)]


def test_the_threshold_is_exact(spark):
    """Sets of 100 and 85 shingles share 85 of 100: linked at 85, not at 86."""
    words = [f"u{i}" for i in range(104)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:89]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r[2] for r in got(minhash.near_duplicates(df, 85))] == [1, 1]
    assert [r[2] for r in got(minhash.near_duplicates(df, 86))] == [1, 2]


def test_crowded_keys_of_several_components(spark):
    """Families that share most of their text meet in the same keys but are not all linked."""
    rnd = random.Random(11)
    core = [f"c{i}" for i in range(150)]
    rows = []
    for f in range(12):  # different tails: about 0.75 alike, so the families share keys without links
        tail = [f"t{f}x{i}" for i in range(22)]
        rows += family(rnd, core + tail, 30, 2, 1000 * f)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    have = got(minhash.near_duplicates(df))
    assert have == brute(rows)
    assert len({r[2] for r in have}) >= 12


def test_shared_counts_of_two_lists_of_sets(monkeypatch):
    monkeypatch.setattr(minhash, "_COLUMNS", 7)
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(-60, 60, rng.integers(1, 50))) for _ in range(n)] for n in (5, 9))
    assert minhash.common(left, right).tolist() == [[len(set(x) & set(y)) for y in right] for x in left]


def test_blocks_find_what_joins_components(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 3)
    rnd = random.Random(2)
    sets = {i: set(rnd.sample(range(24), 20)) for i in range(30)}
    component = {i: 0 if i < 12 else i for i in sets}
    members = spark.createDataFrame([(7, i, component[i], len(s)) for i, s in sets.items()], "key long, node long, component long, n long")
    own = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node long, own array<bigint>")
    got_links = [tuple(r) for r in minhash.block_links(members, own, 75).collect()]
    linked = lambda a, b: component[a] != component[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    want, have = Forest(), Forest()
    for a in sets:
        for b in sets:
            if linked(a, b):
                want.link(a, b)
    assert got_links and all(linked(a, b) for a, b in got_links)
    for a, b in got_links:
        have.link(a, b)
    for a in range(12):  # a component is one already
        want.link(0, a)
        have.link(0, a)
    assert [want.find(i) for i in sets] == [have.find(i) for i in sets]


def test_near_copies_without_links_are_no_table_of_pairs(spark, monkeypatch):
    """Each has 92 of 100 shingles in common with the others' core: too much to leave, too little for links."""
    rnd = random.Random(5)
    core, rows = [f"c{i}" for i in range(204)], []
    for i in range(300):
        own = list(core)
        for at in rnd.sample(range(5, 200, 10), 3):
            own[at] = f"o{i}x{at}"
        rows.append((i, " ".join(own)))
    asked, alike = [], minhash.alike
    monkeypatch.setattr(minhash, "alike", lambda pairs, *a: asked.append(pairs.count()) or alike(pairs, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(minhash.near_duplicates(df)) == brute(rows)
    assert sum(asked) < 40 * len(rows)  # of 44,850 pairs


def test_whole_table(spark):
    from conftest import MID

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text").collect()]
    assert got(minhash.op13_minhash_stars(spark, MID)) == brute(rows)
