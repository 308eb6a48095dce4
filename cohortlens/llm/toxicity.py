"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels.

A document is toxic if one of its sentences is: P = 1 - (1 - leak) * prod(1 - p_s) with
p_s = sigmoid(bias + sum of the weights of the sentence's known words and word stems). Only documents carry labels;
the gradient of the noisy-or tells which sentences explain them. Words that Spark counts as typical
of toxic training documents are the vocabulary; a sentence without any scores zero, so long clean
texts gather nothing but the leak. Each step sums gradients over the partitions of a written sample;
only vectors of the vocabulary's size reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced, table, whole_text, written

#: Bounds of the fit: labelled rows taken of each class (by a hash of the id) and words kept.
TRAIN_POSITIVE, TRAIN_NEGATIVE, VOCABULARY = 8000, 16000, 4096
#: A word is kept if it is in this many toxic training documents and its log-likelihood ratio is this high.
LEAST_DOCUMENTS, LEAST_RATIO = 3, 10.0
STEPS, RIDGE = 100, 0.02
PREDICTED = 0.3
STEM_BYTES = 6

_KEEP = bytearray(b" " * 256)
for _b in (*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)):
    _KEEP[_b] = _b
for _b in range(ord("A"), ord("Z") + 1):
    _KEEP[_b] = _b + 32
for _b in b".!?\n":
    _KEEP[_b] = 10
_KEEP = bytes(_KEEP)
_SENTENCE = re.compile(r"[^.!?\n]+")


def folded(text: str) -> bytes:
    """Lower-cased words parted by spaces, sentences by line feeds."""
    return text.lower().encode("utf-8").translate(_KEEP)


def stem(word: bytes) -> bytes:
    """What stands for all words that begin alike; inflected forms share it."""
    return b"^" + word[:STEM_BYTES]


def features(words: list[bytes], vocabulary: dict[bytes, int]) -> list[int]:
    """Numbers of the known words and stems, as often as they occur."""
    return [vocabulary[f] for w in words for f in (w, stem(w)) if f in vocabulary]


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept from the fit: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: dict[bytes, int]
    weights: np.ndarray
    bias: float
    leak: float  # probability

    def sentence(self, words: list[bytes]) -> float:
        known = features(words, self.vocabulary)
        if not known:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights[i] for i in known), -30, 30))))

    def score(self, text: str) -> float:
        data = folded(text)
        clean = 1 - self.leak
        words = set(data.split())
        if not (self.vocabulary.keys().isdisjoint(words) and self.vocabulary.keys().isdisjoint(map(stem, words))):
            for sentence in data.split(b"\n"):
                clean *= 1 - self.sentence(sentence.split())
        return min(1.0, max(0.0, 1 - clean))

    def offending(self, text: str, least: float) -> list[dict]:
        """Places (code points) and scores of the sentences that score at least ``least``."""
        found = []
        for m in _SENTENCE.finditer(text):
            p = self.sentence(folded(m.group()).split())
            if p >= least:
                found.append({"start": m.start(), "end": m.end(), "score": p})
        return found


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", positive: int = TRAIN_POSITIVE, negative: int = TRAIN_NEGATIVE) -> tuple[DataFrame, dict[int, float]]:
    """(text, label) of a bounded number of labelled rows outside the held-out fold, and the weight of each class.

    Repeated ids count once with their largest label; rows with a NULL id or label are left out. Of
    each class the rows with the smallest hashes are taken: at most ``positive + negative`` ids, which
    bounds what is broadcast to find their texts.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = written(known.groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("label")), "toxicity-labels")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    bounds = {1: positive, 0: negative}
    taken = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(n) for k, n in bounds.items()]
    chosen = taken[0].unionByName(taken[1]).withColumnRenamed("doc_id", "_id")
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "label")
    weights = {k: sizes.get(k, 0) / max(1, min(n, sizes.get(k, 0))) for k, n in bounds.items()}
    return written(rows, "toxicity-train"), weights


def vocabulary_of(rows: DataFrame, weights: dict[int, float], size: int = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """The words most typical of toxic rows by log-likelihood ratio, with their smoothed log odds."""

    def run(batches):
        for batch in sliced(batches):
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set(folded(text).split())
                (toxic if label else clean).update(found | set(map(stem, found)))
            words = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([toxic[w] for w in words], pa.int64()), pa.array([clean[w] for w in words], pa.int64())],
                ["word", "toxic", "clean"],
            )

    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = totals.get(1, 0) * weights[1], totals.get(0, 0) * weights[0]
    if not n1 or not n0:
        return [], np.zeros(0)
    counted = rows.select("text", "label").mapInArrow(run, "word binary, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    a, b = F.col("toxic") * weights[1], F.col("clean") * weights[0]
    share = (a + b) / (n1 + n0)
    # of the four cells "toxic or clean row" times "has the word or not"
    cell = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = 2 * (cell(a, n1 * share) + cell(b, n0 * share) + cell(n1 - a, n1 * (1 - share)) + cell(n0 - b, n0 * (1 - share)))
    typical = counted.filter((F.col("toxic") >= LEAST_DOCUMENTS) & (a / n1 > 2 * b / n0)).withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
    best = typical.orderBy(F.desc("ratio"), "word").limit(size).collect()  # at most `size` words
    odds = [np.log((r["toxic"] * weights[1] + 0.5) / n1) - np.log((r["clean"] * weights[0] + 0.5) / n0) for r in best]
    return [bytes(r["word"]) for r in best], np.array(odds)


def _bags(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(label, sizes, words): for each row its sentences that have known words, one after the other."""

    def run(batches):
        for batch in sliced(batches):
            out = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bags = [features(s.split(), vocabulary) for s in folded(text).split(b"\n")]
                bags = [b for b in bags if b]
                out.append((label, [len(b) for b in bags], [i for b in bags for i in b]))
            label, sizes, words = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(sizes, pa.list_(pa.int32())), pa.array(words, pa.list_(pa.int32()))], ["label", "sizes", "words"])

    return written(rows.select("text", "label").mapInArrow(run, "label int, sizes array<int>, words array<int>"), "toxicity-bags")


def noisy_or_gradient(theta: np.ndarray, label: np.ndarray, bags: np.ndarray, sizes: np.ndarray, words: np.ndarray, weights: dict[int, float]) -> np.ndarray:
    """Loss and its gradient for a batch. theta: word weights, bias, leak logit; bags: sentences a document."""
    n = len(theta) - 2
    leak = 1 / (1 + np.exp(-theta[-1]))
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    z = theta[-2] + np.bincount(sentence, theta[words], minlength=len(sizes))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    document = np.repeat(np.arange(len(bags)), bags)
    clean = np.log1p(-leak) + np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-13)), minlength=len(bags))
    toxic = np.maximum(-np.expm1(clean), 1e-12)
    weight = np.where(label > 0, weights[1], weights[0])
    loss = -(weight * np.where(label > 0, np.log(toxic), clean)).sum()
    # d loss / d z of a sentence is `pull * p` of its document
    pull = weight * np.where(label > 0, -(1 - toxic) / toxic, 1.0)
    dz = pull[document] * p
    return np.concatenate([[loss], np.bincount(words, dz[sentence], minlength=n)[:n], [dz.sum(), (pull * leak).sum()]])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", steps: int = STEPS, ridge: float = RIDGE) -> ToxicityModel:
    """Fits on texts and document labels alone. Without both classes the model is its leak: no sentence scores."""
    rows, weights = training_rows(docs, labels, label)
    names, odds = vocabulary_of(rows, weights)
    vocabulary = {w: i for i, w in enumerate(names)}
    if not vocabulary:
        return ToxicityModel({}, np.zeros(0), -5.0, 0.01)
    bags = _bags(rows, vocabulary)
    theta = np.concatenate([np.clip(odds, 0, 4), [-4.0, -5.0]])
    pace, before = np.full(len(theta), 0.2), np.zeros(len(theta))

    def gradient(at: np.ndarray) -> np.ndarray:
        def run(batches):
            total = np.zeros(len(at) + 1)
            for batch in sliced(batches):
                sizes, words = batch.column(1), batch.column(2)
                counts = np.diff(sizes.offsets.to_numpy())
                total += noisy_or_gradient(at, batch.column(0).to_numpy(), counts, sizes.flatten().to_numpy(), words.flatten().to_numpy(), weights)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["g"])

        return np.sum([r["g"] for r in bags.mapInArrow(run, "g array<double>").collect()], axis=0)  # a vector a partition

    for _ in range(steps):  # resilient steps: a sign change halves a parameter's pace, agreement lifts it
        g = gradient(theta)[1:]
        g[:-2] += ridge * theta[:-2]
        agree = np.sign(g) * np.sign(before)
        pace = np.clip(np.where(agree > 0, pace * 1.2, np.where(agree < 0, pace * 0.5, pace)), 1e-4, 1.0)
        before = np.where(agree < 0, 0.0, g)
        theta -= pace * np.sign(before)
        theta[:-2] = np.maximum(theta[:-2], 0.0)  # a known word is evidence for toxicity or none
        if pace.max() <= 2e-3:
            break
    return ToxicityModel(vocabulary, theta[:-2], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def score_documents(docs: DataFrame, model: ToxicityModel, least: float = PREDICTED) -> DataFrame:
    """``doc_id, score, offending``: the probability and the sentences that score at least ``least``.

    One row per input row, each judged by its text alone; NULL and empty texts score the leak.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = broadcast.value
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            scores = [m.score(t) for t in texts]
            found = [m.offending(t, least) if s >= min(least, PREDICTED) else [] for t, s in zip(texts, scores)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(place))], ["doc_id", "score", "offending"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, offending array<struct<start:int,end:int,score:double>>"
    )


def op1_toxicity_mil(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("offending_spans"),
    )
