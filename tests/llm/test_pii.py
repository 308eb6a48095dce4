"""Personal data: native spans against the plain patterns in Python."""

import hashlib
import random
import re

from cohortlens.llm import pii


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    text = text or ""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return sorted(out)


TEXTS = [
    None, "", " ", "a@b.c%d@e.f x@y z@w..q mail me: é.a+b@c-d.e.f. @x.y a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.0.0.1 1.2.3 01.02.03.04",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111111111111 5 4111111111111111", "+1 (555) 123-4567 +12 +1234567890123456 ++49 30 1234567.",
    "IBAN GB82 WEST 1234 5698 7654 32, DE89370400440532013000 DE00370400440532013000", "ssn 123-45-6789 and 123-45-6789 version 1.2.3.4 example a@b.cd",
    "to ES91 2100 0418 4502 0005 1332 BIC CAIX or BE68 5390 0754 7034 EUR 20, not ES92 2100 0418 4502 0005 1332 BIC",
    "token = \"1beb58b8af68854f0e01\" Password=b7db7aa4a5fcc783 password: strengthening secret=abc1 my_API_KEY:'x-y_z.0123456789'",
    "日本 👍 a@b.co 日本 1.1.1.1", "x" * 200_000, "1" * 100_000, "1 " * 50_000, "1.1." * 30_000, "a@" * 30_000, "+1 " + " " * 50_000 + "2", "9-" * 30_000,
]


def test_rows(spark):
    rnd = random.Random(1)
    alphabet = ["1", "4", "0", "9", "12", "255", " ", "-", ".", "@", "+", "(", ")", "a", "b.c", "é", "%", "_", "\n", "+1", "4111111111111111", "x@y.z"]
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, pii_kind string, n_email long").repartition(8)
    for r in pii.find_personal_data(df.select("doc_id", "text")).collect():
        want = base_spans(texts[r.doc_id])
        assert [(s.start, s.order, s.end, s.kind) for s in r.pii if s.order < 4] == want, texts[r.doc_id][:100]
    by_id = {r.doc_id: r.pii for r in pii.find_personal_data(df).filter("doc_id in (3, 7, 8)").collect()}
    assert [(s.start, s.end) for s in by_id[7] if s.kind == "iban"] == [(5, 32), (34, 56)]
    assert [s.start for s in by_id[8] if s.kind == "ssn"] == [4, 20]
    assert {s.kind: s.score for s in by_id[8]} == {"ssn": 65, "ip": 30, "email": 40}
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_oracle_and_clashing_names(spark):
    import duckdb
    import pandas as pd

    docs = pd.DataFrame({"doc_id": range(len(TEXTS)), "text": [t if t is None or len(t) < 5000 else t[:40] for t in TEXTS]})
    con = duckdb.connect()
    con.register("documents", docs)
    want = {r[0]: r for r in con.sql(f"SELECT doc_id, spans, scores, found FROM ({pii.ORACLE})").fetchall()}
    rows = [(int(i), t, "p", "x", 7) for i, t in docs.itertuples(index=False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string, _email_found string, `_pii.text` int")
    out = pii.find_personal_data(df)
    assert out.columns == ["doc_id", "text", "_email_found", "_pii.text", "pii"]
    found = {}
    for r in out.collect():
        if r.text and r.text.startswith(("to ES91", "token")):
            found.update({(r.text[:8], s.kind, s.start): r.text[s.start:s.end] for s in r.pii})
        spans = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.pii)
        assert (r.doc_id, spans, ",".join(str(s.score) for s in r.pii), bool(r.pii)) == want[r.doc_id], r.text
        assert (r["_email_found"], r["_pii.text"]) == ("x", 7)
    assert [t for (_, kind, _), t in sorted(found.items()) if kind == "iban"] == ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034"]
    assert [t for (_, kind, _), t in sorted(found.items()) if kind == "secret"] == ['token = "1beb58b8af68854f0e01', "Password=b7db7aa4a5fcc783", "API_KEY:'x-y_z.0123456789"]


def test_query(spark):
    from conftest import MID

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    out = pii.op5_pii_native(spark, MID).collect()
    assert len(out) == len(rows)
    for r in out:
        spans = base_spans(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in spans) for k in ("email", "ip", "card", "phone")]
    assert not [n for n in ("Python", "Arrow", "Pandas") if n in pii.op5_pii_native(spark, MID)._jdf.queryExecution().toString()]
