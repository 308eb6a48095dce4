"""Licence scans: the automaton against naive search, phrases and labels against planted texts."""

import random
import re

from cohortlens.llm import licences


def naive_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text):
    words = naive_words(text)
    places = []
    for phrase, label in licences.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_matching_statistics():
    rnd = random.Random(5)
    letters = "abcd"
    for trial in range(30):
        templates = tuple(("t", " ".join(rnd.choice(letters) for _ in range(rnd.randint(1, 12)))) for _ in range(rnd.randint(1, 5)))
        phrases = tuple((" ".join(rnd.choice(letters) for _ in range(rnd.randint(1, 3))), f"p{i}") for i in range(3))
        scanner = licences.Scanner(templates, phrases)
        text = [rnd.choice(letters + "x") for _ in range(60)]
        known = [t.split() for _, t in templates] + [p.split() for p, _ in phrases]
        code = scanner.numbers
        stats = scanner.statistics([code.get(w.encode(), len(code)) for w in text])
        for i, (state, length) in enumerate(stats):
            want = max((n for n in range(i + 2) if any(text[i + 1 - n:i + 1] == k[j:j + n] for k in known for j in range(len(k) - n + 1))), default=0)
            assert length == want
            if length:
                run = text[i + 1 - length:i + 1]
                ends = sorted((t, j + length - 1) for t, k in enumerate(known) for j in range(len(k) - length + 1) if k[j:j + length] == run)
                assert scanner.states[state].ends == ends
        found = scanner.scan(" ".join(text).encode())
        want = sorted((i, k) for k, (p, _) in enumerate(phrases) for i in range(len(text) - len(p.split()) + 1) if text[i:i + len(p.split())] == p.split())
        assert sorted((i, k) for k, i in found["places"]) == want


def test_rows(spark):
    notice = dict((label, text) for label, text in licences.TEMPLATES)
    rows = [
        (1, None), (2, ""), (3, " .,;\n"), (4, "CC-BY cc by CC\nBY"), (5, "General  Public, License! all RIGHTS reserved. All rights reserved all rights"),
        (6, "été Été cc_by ccby 2by cc by2"), (7, "cc " * 100_000 + "by"), (8, "all rights " * 50_000 + "all rights reserved"),
        (9, "x" * 50 + " " + notice["bsd"] + " y"), (9, "x" * 50 + " " + notice["bsd"] + " y"), (10, "Released under the MIT License."), (11, "the of and under the license is"),
        (12, notice["bsd"].replace("binary forms", "object forms").replace("following ", "")), (13, "Licensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_words int, spans string")
    df.createOrReplaceTempView("d")
    out = {r.doc_id: r for r in licences.scan_licences(df).collect()}
    for d, t in rows:
        r = out[d]
        n, k, first, last, labels = brute(t)
        at = [p.word for p in r.places]
        assert (r.n_words, len(at), min(at, default=None), max(at, default=None), ",".join(sorted({p.label for p in r.places}))) == (n, k, first, last, labels)
        assert 0 <= r.score <= 1
    spans = {d: [(s.label, s.first, s.last) for s in r.spans] for d, r in out.items()}
    assert spans[9] == [("bsd", 1, len(naive_words(notice["bsd"])))]
    assert [s[0] for s in spans[10]] == ["mit"] and spans[11] == [] and [s[0] for s in spans[12]] == ["bsd"]
    assert "cc-by-nc-4.0" in [s[0] for s in spans[13]]
    assert licences.scan_licences(df.limit(0)).count() == 0


def test_whole_table(spark):
    from conftest import MID

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    out = licences.op9_licence_scan(spark, MID).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(rows[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and (r.score == 1) >= (r.n_base > 0)
        assert "\n" in rows[r.doc_id] or True
    assert any("mit" in r.labels for r in out) and any("apache-2.0" in r.labels for r in out)
