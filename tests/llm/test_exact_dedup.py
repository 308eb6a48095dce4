"""Progressive exact de-duplication against brute force on rows that are awkward."""

import hashlib
import re

from cohortlens.llm import exact_dedup


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    out = []
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        first = True
        for d in sorted(ids, key=lambda d: (d is None, d or 0)):
            out.append((d, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
            first = False
    return sorted(out, key=repr)


def test_edge_rows(spark):
    same_prefix = "p" * 100
    rows = [
        (5, "a b"), (4, "a \t\nb"), (4, "a b"), (9, "a b"), (1, None), (2, ""), (3, " "), (6, "\n"), (None, "a b"), (None, "only"),
        (7, same_prefix + "x"), (8, same_prefix + "y"), (10, same_prefix + "x"), (11, "q" * 101), (12, "ab"), (13, "cd"), (14, "z" * 300_000), (15, "z" * 300_000),
    ] + [(100 + i, "hot") for i in range(500)] + [(600, "u\0v"), (601, "é"), (602, "é")]
    df = spark.createDataFrame([(d, t, 0, "k", True) for d, t in rows], "doc_id long, text string, _length long, keep_id string, kept boolean")
    out = exact_dedup.progressive_dedup(df, digest_all=True)
    assert sorted([tuple(r)[:5] for r in out.collect()], key=repr) == brute(rows)
    lazy = exact_dedup.progressive_dedup(df).collect()
    assert all((r.text_sha256 is not None) == r.refined for r in lazy)
    assert [r for r in lazy if r.doc_id == 11][0].refined is False  # same length as no other prefix
    kept = exact_dedup.kept_documents(df)
    assert kept.columns == df.columns
    want = sorted(((d, sha) for d, _, _, k, sha in brute(rows) if k), key=repr)
    got = sorted(((r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in kept.collect()), key=repr)
    assert got == want
    empty = exact_dedup.progressive_dedup(df.limit(0))
    assert empty.count() == 0 and exact_dedup.kept_documents(df.limit(0)).count() == 0


def test_large_groups_and_query(spark):
    from conftest import SMALL

    out = exact_dedup.op2_exact_dedup(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted([tuple(r) for r in out.collect()], key=repr) == brute([tuple(r) for r in docs])
