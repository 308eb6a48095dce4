"""Packing: ids are the tokenizer's own, the pieces are a partition of them, the cut is gapless."""

import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from cohortlens.llm import packing
from cohortlens.llm.common import table
from cohortlens.llm.wordbpe import WordBPE

TEXTS = [
    "don't I'll we've 'tis ''s x's 's't 'same y'RE he'd I'm 'll", "a" * 200 + " b" * 3, "", "\n\n", "  ", "É È ß ÿ Œ",
    "İstanbul ΣΑΣ", "<|endoftext|> x", "1234 5.6,7--8!!!'s", "a\x00b\x7fc\x85d\xa0e", "日本語 text 👍🏽", "é", "rock'n'roll 'd''t 'rE", "_a_b'", "'", "x'",
    "×÷ Ã— ¼ ² µ ª", "word " * 300_000, "z" * 70_000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_the_tokenizers(tokenizer):
    encoder = WordBPE(public_tokenizers.path("word_bpe_49k.json"))
    for _ in range(2):  # the second time from memory
        got = encoder.encode([t.encode() for t in TEXTS])
        for text, ids in zip(TEXTS, got):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:40]


def test_crowded_memory_stays_exact(tokenizer):
    encoder = WordBPE(public_tokenizers.path("word_bpe_49k.json"), slots=16)
    rng = np.random.default_rng(1)
    texts = [" ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(200)) for _ in range(20)]
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_found_before_keep_their_ids(tokenizer):
    """Chunks that mix known and new pieces in a table that fills: what a new piece evicts is not read as the old one."""
    encoder = WordBPE(public_tokenizers.path("word_bpe_49k.json"), slots=4096)
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(3, 9))) for _ in range(6000)]
    for at in range(0, 6000, 500):
        text = " ".join(words[:at + 500])
        assert encoder.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(packed, texts, tokenizer, window):
    """texts: doc_id -> text (each once)."""
    rows = packed.collect()
    whole = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for d, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        ids = whole[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert set(by_doc) == set(whole)
    for d, own in by_doc.items():
        own.sort(key=lambda r: r.start)
        at = 0
        for r in own:
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(whole[d])
    total = sum(map(len, whole.values()))
    for s, own in by_seq.items():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at == min(window, total - s * window)  # full but for the last one
    assert sorted(by_seq) == list(range(-(-total // window)))


def test_whole_table(spark, tokenizer):
    from conftest import SMALL

    docs = table(spark, SMALL, "documents")
    check(packing.op8_pack_documents(spark, SMALL), {r.doc_id: r.text for r in docs.collect()}, tokenizer, 4096)


def test_edge_rows_and_round_trip(spark, tokenizer):
    texts = dict(enumerate(TEXTS)) | {100: None}
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in texts.items()], "doc_id long, text string, ids string, n long").repartition(5)
    packed = packing.pieces(df, window=512)
    check(packing.with_crc(packed), texts, tokenizer, 512)
    joined = packing.sequences(packed).orderBy("sequence_id").collect()
    run = np.concatenate([np.frombuffer(r.ids, "<u4") for r in joined])
    assert sum(sum(r.lengths) for r in joined) == len(run) == sum(r.length for r in joined)
    assert (run == 2).sum() >= len(texts)
    assert packing.pieces(df.limit(0)).count() == 0
    twice = packing.pieces(df.filter("doc_id in (0, 100)").unionByName(df.filter("doc_id in (0, 100)"))).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in twice} == {0: 2 * (1 + len(tokenizer.encode(TEXTS[0], add_special_tokens=False).ids)), 100: 2}
    with pytest.raises(ValueError):
        packing.pieces(df, window=0)
