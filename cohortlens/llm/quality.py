"""Quality classifier from weak labels: heuristic labellers, expectation-maximisation, hashed linear scorer.

No human label is used. Overlapping heuristics vote good, bad or abstain on every document. The votes
of a document form one of at most 3**8 patterns; Spark counts the patterns over all documents, and
expectation-maximisation on that small table finds how often each labeller votes what on good and on
bad documents, and so the posterior of every pattern. The posteriors are the labels of a logistic
model over hashed features (shape 4-grams of the bytes, bins of the text statistics), fitted with
MLlib on a bounded sample. That scorer judges every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sheltered, sliced, table, whole_text, written

FEATURES = 2048
#: Expected number of rows a class gives to the fit of the scorer: the fit's cost is bounded, all counts cover all rows.
SAMPLE_PER_CLASS = 4000
THRESHOLD = 0.5
#: Added to the number of 4-grams that their counts are divided by, so that a few words prove little.
SHRINK = 200
BAD, GOOD, ABSTAIN = 0, 1, 2

#: Per labeller: statistic, bound of a good vote, bound of a bad vote (between them it abstains).
LABELLERS = (
    ("symbols", 0.01, 0.03),       # share of marks that prose rarely has
    ("odd_tokens", 0.05, 0.15),    # share of words that hold such marks or nothing but marks
    ("capitals", 0.12, 0.30),      # share of capitals among ASCII letters
    ("exclaimed", 0.05, 0.15),     # exclamation marks a word
    ("stutter", 0.05, 0.12),       # share of words equal to the one before
    ("monotony", 0.75, 0.88),      # share of words that are repeats, beyond what a text of that length has
    ("same_lines", 0.30, 0.60),    # share of lines that repeat an earlier one
    ("digits", 0.10, 0.30),        # share of digits among all marks
)
_EDGES = tuple(np.unique([0.0005, g / 4, g / 2, g, (g + b) / 2, b, 2 * b]) for _, g, b in LABELLERS)

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = True
_SHAPE = np.zeros(256, dtype=np.uint32)
_SHAPE[33:127] = np.arange(4, 98) % 60 + 4
_SHAPE[ord("a"):ord("z") + 1] = 1
_SHAPE[128:] = 1
_SHAPE[ord("A"):ord("Z") + 1] = 2
_SHAPE[ord("0"):ord("9") + 1] = 3
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def statistics(text: bytes) -> list[float]:
    """The statistics that the labellers judge, in their order; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(LABELLERS)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    solid = counts[33:].sum()
    letters = counts[65:91].sum() + counts[97:123].sum()
    n = len(words)
    distinct = set(words)
    odd = sum(1 for w in words if not w.strip(_MARKS)) if counts[list(_MARKS)].sum() > 0.02 * solid else 0
    noisy = counts[_SYMBOLS].sum()
    lines = [x for x in text.split(b"\n") if x.strip()]
    expected = min(1.0, 12.0 * n ** -0.35)  # a longer text repeats more of its words
    return [
        noisy / max(solid, 200),
        max(odd, min(noisy / 2, n)) / max(n, 30),
        counts[65:91].sum() / max(letters, 20),
        counts[33] / max(n, 10),
        sum(map(eq, words, words[1:])) / max(n, 10),
        max(0.0, 1 - len(distinct) / (n * expected)) if n >= 30 else 0.0,
        1 - len(set(lines)) / len(lines) if len(lines) >= 3 else 0.0,
        counts[48:58].sum() / max(solid, 200),
    ]


def votes(values: list[float]) -> int:
    """The votes as one number in base 3."""
    code = 0
    for (_, good, bad), v in zip(LABELLERS, values):
        code = 3 * code + (GOOD if v <= good else BAD if v >= bad else ABSTAIN)
    return code


def hashed(text: bytes, values: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the shape 4-grams, and of the bins of the statistics."""
    shape = _SHAPE[np.frombuffer(b" " + text + b"  ", dtype=np.uint8)]
    gram = shape[:-3] | shape[1:-2] << np.uint32(6) | shape[2:-1] << np.uint32(12) | shape[3:] << np.uint32(18)
    grams = (gram * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    bins = [(97 * (16 * i + int(np.searchsorted(e, v))) + 1009) % FEATURES for i, (e, v) in enumerate(zip(_EDGES, values))]
    return grams, np.array(bins)


@dataclass(frozen=True)
class WeakLabelModel:
    """Fitted model: posteriors of the vote patterns, the labellers' vote rates, and the scorer."""

    posterior: dict[int, float]
    prior: float
    rates: np.ndarray  # (class, labeller, vote)
    weights: np.ndarray | None  # None: no scorer, the posterior is the score
    intercept: float

    def score(self, text: bytes, values: list[float]) -> float:
        if self.weights is None:
            return self.posterior.get(votes(values), self.prior)
        grams, bins = hashed(text, values)
        z = self.intercept + self.weights[grams].sum() / (len(grams) + SHRINK) + self.weights[bins].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def expectation_maximisation(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], float, np.ndarray]:
    """Posterior of "good" for each pattern, the prior, and the rates P(vote | class) of each labeller.

    Labellers are taken as independent given the class. The start trusts any bad vote, so the classes
    cannot swap; add-one smoothing keeps rates off 0 and 1. No patterns: prior 1, no posteriors.
    """
    if not counts:
        return {}, 1.0, np.full((2, len(LABELLERS), 3), 1 / 3)
    codes = np.array(sorted(counts))
    n = np.array([counts[c] for c in codes], dtype=float)
    digits = np.stack([codes // 3 ** (len(LABELLERS) - 1 - i) % 3 for i in range(len(LABELLERS))], axis=1)
    one_hot = digits[:, :, None] == np.arange(3)
    good = np.where((digits == BAD).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        weight = np.stack([n * (1 - good), n * good])
        rates = np.einsum("cp,plv->clv", weight, one_hot) + 1.0
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", one_hot, np.log(rates))
        after = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        moved, good = np.abs(after - good).max(), after
        if moved < 1e-9:
            break
    return dict(zip(codes.tolist(), good.tolist())), float(prior[1]), rates


def _texts(batch) -> list[bytes]:
    return batch.column(0).cast(pa.binary()).to_pylist()


def text_counts(docs: DataFrame) -> DataFrame:
    """(h, code, n): hash and vote pattern of each distinct text, and how many rows have it."""

    def run(batches):
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([votes(statistics(t)) for t in _texts(batch)], pa.int32())], ["h", "code"])

    rows = _hashed_texts(docs).mapInArrow(run, "h long, code int")
    return written(rows.groupBy("h", "code").agg(F.count(F.lit(1)).alias("n")), "quality-texts")


def pattern_counts(texts: DataFrame) -> dict[int, int]:
    """How many documents have each vote pattern: at most 3**8 numbers, counted over all rows."""
    return {r["code"]: r["n"] for r in texts.groupBy("code").agg(F.sum("n").alias("n")).collect()}


def _hashed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(whole_text().alias("text")).select("text", F.xxhash64("text", F.lit(4)).alias("h"))


def fit(docs: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> WeakLabelModel:
    """Fits labellers and scorer on ``text`` alone; ``per_class`` bounds the expected sample of the scorer's fit.

    A text with ``n`` rows is drawn as often as ``n`` of its class's rows are due, to the next whole
    number by its hash, and enters the fit once with that number as weight. So a hot text neither
    drops out nor fills the sample, and a class of few texts is always there.
    """
    texts = text_counts(docs)
    counts = pattern_counts(texts)
    posterior, prior, rates = expectation_maximisation(counts)
    sizes = [sum(n for c, n in counts.items() if (posterior[c] >= 0.5) == bool(k)) for k in (0, 1)]
    if not all(sizes):  # one class only: nothing to tell apart
        return WeakLabelModel(posterior, prior, rates, np.zeros(FEATURES), 6.0 if sizes[1] or not counts else -6.0)
    share = [min(1.0, per_class / n) for n in sizes]

    def run(batches):
        for batch in sliced(batches):
            rows = []
            for text in _texts(batch):
                values = statistics(text)
                grams, bins = hashed(text, values)
                x = np.bincount(grams, minlength=FEATURES) / (len(grams) + SHRINK)
                np.add.at(x, bins, 1.0)
                rows.append(x)
            if rows:
                flat = pa.array(np.concatenate(rows))
                offsets = pa.array(np.arange(0, len(flat) + 1, FEATURES, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat), batch.column(1), batch.column(2)], ["x", "label", "weight"])

    drawn = []  # one row a pattern
    for code, p in posterior.items():
        label = int(p >= 0.5)
        drawn.append((code, float(label), share[label], abs(2 * p - 1) * sizes[label] * share[0] / sizes[0] / share[label]))
    by_code = F.broadcast(docs.sparkSession.createDataFrame(drawn, "code int, label double, share double, weight double"))
    u = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    times = F.ceil(F.col("n") * F.col("share") - u)
    chosen = texts.join(by_code, "code").withColumn("times", times).filter("times > 0")
    chosen = written(chosen.select("h", "label", F.greatest(F.col("times") * F.col("weight"), F.lit(1e-6)).alias("weight")), "quality-chosen")
    # About ``per_class`` rows a class whatever the input, so they are broadcast; copies meet in map-side aggregation.
    once = _hashed_texts(docs).join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("text", "label", "weight")
    rows = written(once.mapInArrow(run, "x array<double>, label double, weight double"), "quality-sample")
    if rows.select("label").distinct().count() < 2:  # a tiny ``per_class`` took none of a class: the posterior judges
        return WeakLabelModel(posterior, prior, rates, None, 0.0)
    learner = LogisticRegression(featuresCol="v", weightCol="weight", maxIter=30, regParam=0.002)
    fitted = learner.fit(rows.select(array_to_vector("x").alias("v"), "label", "weight"))
    return WeakLabelModel(posterior, prior, rates, fitted.coefficients.toArray(), float(fitted.intercept))


def judge(docs: DataFrame, model: WeakLabelModel, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and ``quality_judgement``: struct of posterior, score, kept (it replaces a
    column of that name).

    NULL and empty texts have every statistic zero and are judged by them like any other row; each
    row is judged by itself, so ties and repeats need no rule.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("posterior", pa.float64()), ("score", pa.float64()), ("kept", pa.bool_())])

    @F.arrow_udf("posterior double, score double, kept boolean")
    def run(texts: pa.Array) -> pa.Array:
        m = broadcast.value
        out = []
        for item in texts.cast(pa.binary()):
            text = item.as_py()
            values = statistics(text)
            score = m.score(text, values)
            out.append({"posterior": m.posterior.get(votes(values), m.prior), "score": score, "kept": score >= threshold})
        pa.default_memory_pool().release_unused()
        return pa.array(out, kind)

    return docs.withColumn("quality_judgement", run(whole_text()))


def good_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier, fitted on ``docs`` itself, does not reject; columns unchanged.

    An empty table gives no rows.
    """
    inside, back = sheltered(docs, "text")
    return judge(inside, fit(docs), threshold).filter("quality_judgement.kept").select(*back)


def op4_quality_weak_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return judge(docs.select("doc_id", "text"), fit(docs)).select("doc_id", "quality_judgement.*")
