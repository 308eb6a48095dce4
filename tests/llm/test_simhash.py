"""SimHash near-duplicates against brute force, and the code behind the keys."""

import random
import re

import numpy as np
import pytest
import xxhash

from cohortlens.llm import golay, simhash
from cohortlens.llm.common import table

DOCS = "doc_id long, text string, key string, fp long, n long"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = sorted(set(fp for _, fp in rows))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        for j in np.nonzero(np.bitwise_count(a ^ a[i]) <= 2)[0]:
            root[find(f)] = find(fps[j])
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {f: least.get(find(f)) for f in fps}


def expect(rows):
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    component = brute_components(fps)
    return sorted((repr(d), f"{f:016x}", component[f]) for d, f in fps)


def got(df):
    return sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in df.collect())


def test_golay_keys_meet_at_distance_one():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 4000)
    sets = lambda w: [set(i[d]) for i, d in zip(*golay.codeword_indices(w))]
    here = sets(words)
    assert {len(s) for s in here} == {1, 6}
    for bit in range(23):
        assert all(x & y for x, y in zip(here, sets(words ^ (1 << bit))))


def test_two_bit_neighbours_share_a_key():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 64, 300, dtype=np.uint64)

    def keys(f):
        k, owner = simhash.segment_keys(f)
        return [set(k[owner == i]) for i in range(len(f))]

    here = keys(fps)
    for a in range(0, 64, 3):
        for b in range(a, 64, 5):
            flip = np.uint64((1 << a) | (1 << b))
            assert all(x & y for x, y in zip(here, keys(fps ^ flip)))


def test_edge_rows(spark):
    rnd = random.Random(3)
    base = " ".join(rnd.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(300))
    rows = [(9, None), (8, ""), (7, " \t\n"), (5, base), (4, base), (4, base), (3, base + " tail"), (2, "one"), (1, "ONE"), (0, "one two"), (None, base), (11, "two words" * 40000), (12, "Été été ÉTÉ x")]
    df = spark.createDataFrame([(d, t, "k", 1, 2) for d, t in rows], DOCS)
    out = simhash.near_duplicates(df)
    assert got(out) == expect(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.representatives(df.filter("doc_id is not null"))
    assert kept.columns == df.columns
    assert sorted(set(r.doc_id for r in kept.collect())) == sorted(set(c for d, f, c in expect([r for r in rows if r[0] is not None])))


def test_representatives_with_null_shared_and_repeated_ids(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) for _ in range(60)) for _ in range(9)]
    rows = [(1, texts[0]), (None, texts[0])]                                   # a NULL loser ...
    rows += [(None, t) for t in texts[1:4]]                                    # ... must not take unique rows along
    rows += [(2, texts[4]), (7, texts[4]), (7, texts[5]), (9, texts[5])]       # 7 loses once and wins once
    rows += [(None, texts[6])] * 3 + [(4, texts[7])] * 3                       # NULL ids alone, the smallest id repeated
    rows += [(8, texts[8]), (8, texts[8].upper())]                             # one id, two texts, one component
    df = spark.createDataFrame([(d, t, "k", 1, 2) for d, t in rows], DOCS).repartition(4)
    kept = [(r.doc_id, r.text) for r in simhash.representatives(df).collect()]
    want = [(1, texts[0]), *((None, t) for t in texts[1:4]), (2, texts[4]), (7, texts[5]), (None, texts[6]), (4, texts[7]), (8, texts[8])]
    assert sorted((repr(d), t.lower()) for d, t in kept) == sorted((repr(d), t) for d, t in want)
    assert simhash.representatives(df.limit(0)).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_crowded_family(spark, distance):
    """Hundreds of fingerprints around a few centres: links give the components of brute force."""
    rnd = random.Random(distance)
    fps = {rnd.getrandbits(64) for _ in range(200)}
    for centre in list(fps)[:4]:
        for _ in range(150):
            f = centre
            for _ in range(rnd.choice((1, 2, 3, 4))):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    a = np.array(sorted(fps), dtype=np.uint64)
    df = spark.createDataFrame([(signed(int(f)),) for f in a], "fp long")
    found = simhash.links(df, distance).collect()
    assert all((int(r.a) ^ int(r.b)) and bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= distance for r in found)
    root = {signed(int(f)): signed(int(f)) for f in a}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        root[find(r.a)] = find(r.b)
    seen = {find(x) for x in root}
    true = dict.fromkeys(root)
    brute = {x: x for x in root}

    def bfind(x):
        while brute[x] != x:
            x = brute[x]
        return x

    for i, f in enumerate(a):
        for j in np.nonzero(np.bitwise_count(a ^ f) <= distance)[0]:
            brute[bfind(signed(int(f)))] = bfind(signed(int(a[j])))
    assert len(seen) == len({bfind(x) for x in true})
    assert len({(find(x), bfind(x)) for x in root}) == len(seen)


def test_whole_table(spark):
    from conftest import MID

    docs = table(spark, MID, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.op7_simhash_golay(spark, MID)) == expect(rows)
