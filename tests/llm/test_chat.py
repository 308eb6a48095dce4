"""Perspective rotation against a direct rendering, and running sums over a hot key."""

import hashlib
import random

from cohortlens.llm import chat, prefix

SCHEMA = "conv_id long, turn int, role string, text string, perspective string, total long"


def brute(rows, part_chars):
    talks = {}
    for c, t, r, x in rows:
        r = r if r and r.strip() else "unknown"
        x = (x or "").replace("<|", "<\\|")
        talks.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{r}:{x}".encode()).hexdigest(), r, x))
    out = {}
    for c, said in talks.items():
        said.sort()
        for who in {r for *_, r, _ in said} - {"system"}:
            at, parts = 0, {}
            for *_, r, x in said:
                head = "<|im_start|>" + ("assistant" if r == who else r if r == "system" else "user name=" + r.replace("\n", " ").replace("<", " ").replace("|", " ")) + "\n"
                whole = head + x + "<|im_end|>\n"
                part = parts.setdefault(at // part_chars, [at, 0, "", []])
                if r == who:
                    part[3].append((at - part[0] + len(head), at - part[0] + len(whole) - 1))
                part[1] += 1
                part[2] += whole
                at += len(whole)
            for k, (start, n, text, masks) in parts.items():
                out[c, who, k] = (start, n, text, tuple(masks), sum(b - a for a, b in masks))
    return out


def got(df):
    return {(r.conv_id, r.perspective, r.part): (r.start_char, r.n_turns, r.rendered, tuple((m.start, m.end) for m in r.masks), r.trained_chars) for r in df.collect()}


def test_rows(spark):
    rnd = random.Random(1)
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> é"), (1, 2, "bob", None), (1, 2, "ann", "tie"), (1, 2, "ann", "tie"), (1, None, "bob", "early"),
        (2, 0, "system", "alone"), (3, 0, None, "who"), (3, 1, " ", "blank"), (3, 2, "unknown", ""), (None, 1, "ann", "lost"), (None, 2, "bob\n<|x", "and"), (4, 0, "ann", "long " * 20_000), (4, 1, "bob", "short"),
    ]
    rows += [(7, i, rnd.choice(("ann", "bob", "cy")), "w " * rnd.randint(0, 30)) for i in range(1500)]  # a third of all turns and more
    rows += [(7, 9999, "ann", "again")] * 200
    rows += [(100 + i, j, ("user", "assistant")[j % 2], f"t{i} {j}") for i in range(60) for j in range(rnd.randint(1, 6))]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(6)
    out = chat.rotate(df, part_chars=500)
    assert got(out) == brute(rows, 500)
    for (c, who, k), (start, n, text, masks, _) in got(out).items():
        assert all(text[b - len("<|im_end|>"):b] == "<|im_end|>" for a, b in masks)
    assert chat.rotate(df.limit(0)).count() == 0


def test_running_sums_of_one_key(spark):
    rnd = random.Random(2)
    rows = [("hot", i, rnd.randint(0, 9)) for i in range(5000)] + [(None, i, 1) for i in range(7)] + [(f"k{i}", 0, 3) for i in range(50)] + [("tail", i, 2) for i in range(900)]
    want, sums = {}, {}
    for k, i, v in rows:
        want[k, i] = sums.get(k, 0)
        sums[k] = sums.get(k, 0) + v
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(5)
    assert {(r.k, r.i): r.before for r in prefix.sums_before(df, ["k"], ["i"], "v", "before").collect()} == want
