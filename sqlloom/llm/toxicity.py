"""Toxicity by cumulative-link ordinal regression on sparse word features.

The model is P(grade <= k) = 1 / (1 + exp(w.x - t_k)): one weight vector for all thresholds
t_0 < t_1 < ..., so grades differ by their threshold only.  A document's score is its expected
grade.  x holds 1 + ln(count) for each feature of the vocabulary that the text has: words, and
beginnings of words, which carry over to forms that the sample doesn't hold.

``labels`` knows toxic and not toxic only.  Grades come from it in two steps: 0 for documents
labelled clean; for toxic ones 1, or 2 if marker words (words in at least ``MARKER_ROWS``
toxic and no clean row of the sample) make up ``STRONG_SHARE`` of their words or more.  A caller
with graded labels hands them over instead.

Fitting reads a bounded sample: the ``MAX_LABELLED`` labelled rows with the smallest keyed hash of
their doc_id, and the ``MAX_WORDS`` words that tell the classes apart best.  Only their counts
reach the driver.  Scoring reads every text as a whole, in one narrow pass.

Defined cases: a null text counts as empty and gets the score of a text without known words; repeated
rows score alike; without labels nothing is toxic and every score is 0; labels of unknown
documents and null labels are left out; an empty table gives no rows; other columns are kept by ``remove_toxic``.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.functions.text import keyed_hash
from sqlloom.llm.common import saved, text_bytes

MAX_LABELLED = 20_000
MAX_WORDS = 4096
LEAST_ROWS = 3
MARKER_ROWS = 5
STRONG_SHARE = 0.02
TOXIC_FROM = 0.5
RIDGE = 1e-4
STEPS = 400
SEED = 11
# Words are what stands between blanks and ASCII punctuation, in lower case (A-Z only).
FOLD = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(), (string.ascii_lowercase + " " * len(string.punctuation)).encode()
)


# Lengths in bytes of the beginnings; a beginning is marked by a hyphen, which no folded word holds.
BEGINNINGS = (4, 5)


def features(text: bytes) -> Counter:
    """Words and beginnings of words with their counts."""
    words = Counter(text.translate(FOLD).split())
    found = Counter(words)
    for n in BEGINNINGS:
        for w, count in words.items():
            if len(w) > n:
                found[w[:n] + b"-"] += count
    return found


@dataclass
class Model:
    words: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, logits: np.ndarray) -> np.ndarray:
        """Expected grade: the sum over thresholds of the chance to lie above."""
        return (1 / (1 + np.exp(self.thresholds[None, :] - logits[:, None]))).sum(axis=1)

    def logit(self, text: bytes) -> float:
        known, hits = self.words, Counter()
        for w, n in Counter(text.translate(FOLD).split()).items():
            if (k := known.get(w)) is not None:
                hits[k] += n
            for size in BEGINNINGS:
                if len(w) > size and (k := known.get(w[:size] + b"-")) is not None:
                    hits[k] += n
        return float(sum(self.weights[k] * (1 + np.log(n)) for k, n in hits.items()))


def _labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, toxic) of at most ``limit`` labelled rows, the same ones in every run."""
    chosen = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(keyed_hash(SEED, "doc_id"))
        .limit(limit)
    )
    # At most ``limit`` rows of two numbers: small by the parameter, whatever the corpus.
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text")).join(
        F.broadcast(chosen.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")), "doc_id"
    )


def _word_counts(sample: DataFrame) -> DataFrame:
    """(doc_id, toxic, word, n, n_words) of the sample."""

    def task(batches):
        for batch in batches:
            for doc_id, text, toxic in zip(*[c.to_pylist() for c in batch.columns]):
                counts = features(text)
                total, n = len(text.translate(FOLD).split()), len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * n, pa.int64()), pa.array([toxic] * n, pa.int32()), pa.array(list(counts), pa.binary()),
                        pa.array(list(counts.values()), pa.int64()), pa.array([total] * n, pa.int64()),
                    ],
                    ["doc_id", "toxic", "word", "n", "n_words"],
                )

    return sample.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        task, "doc_id bigint, toxic int, word binary, n bigint, n_words bigint"
    )


def vocabulary(counts: DataFrame, limit: int = MAX_WORDS) -> list:
    """Rows (word, clean, toxic) of the words that separate the classes best: two-proportion z."""
    classes = {r["toxic"]: r["n"] for r in counts.groupBy("toxic").agg(F.countDistinct("doc_id").alias("n")).collect()}
    n0, n1 = classes.get(0, 0), sum(n for k, n in classes.items() if k)
    if not n0 or not n1:
        return []
    words = counts.groupBy("word").agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") > 0).alias("toxic"))
    share = (F.col("clean") + F.col("toxic")) / (n0 + n1)
    z = F.abs(F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(share * (1 - share) + F.lit(1e-12))
    return words.where(F.col("clean") + F.col("toxic") >= LEAST_ROWS).orderBy(z.desc(), "word").limit(limit).collect()


def fit_ordinal(rows: np.ndarray, words: np.ndarray, values: np.ndarray, grades: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model on sparse (row, word, value) entries.

    Adam on the mean negative log-likelihood; thresholds are the first one plus exponentials, so
    they stay ordered.
    """
    top, n = int(grades.max()), len(grades)
    shares = np.array([(grades <= k).mean() for k in range(top)])
    start = np.log(shares / (1 - shares))
    cuts = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    x = np.concatenate((np.zeros(n_words), cuts))
    m, v = np.zeros_like(x), np.zeros_like(x)
    at = np.arange(n)
    for step in range(1, STEPS + 1):
        w, cuts = x[:n_words], x[n_words:]
        gaps = np.exp(cuts[1:])
        bounds = cuts[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(rows, values * w[words], n)
        below = np.ones((n, top + 2))
        below[:, 0] = 0
        below[:, 1:-1] = 1 / (1 + np.exp(np.clip(score[:, None] - bounds[None, :], -40, 40)))
        chance = np.maximum(below[at, grades + 1] - below[at, grades], 1e-12)
        slope = below * (1 - below)
        upper, lower = slope[at, grades + 1] / chance, slope[at, grades] / chance
        g_bound = np.zeros(top)
        np.add.at(g_bound, grades[grades < top], -upper[grades < top] / n)
        np.add.at(g_bound, grades[grades > 0] - 1, lower[grades > 0] / n)
        g_score = (upper - lower) / n
        g_w = np.bincount(words, values * g_score[rows], n_words) + RIDGE * w
        tail = np.cumsum(g_bound[::-1])[::-1]
        g = np.concatenate((g_w, tail[:1], tail[1:] * gaps))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cuts = x[n_words:]
    return x[:n_words], cuts[0] + np.concatenate(([0.0], np.cumsum(np.exp(cuts[1:]))))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, graded: bool = False) -> Model:
    """Fit on a bounded sample; with ``graded``, labels.toxic already holds grades 0, 1, 2, ..."""
    counts = saved(_word_counts(_labelled(docs, labels, limit)), "toxicity-words")
    rows = vocabulary(counts)
    words = {bytes(r["word"]): k for k, r in enumerate(rows)}
    nothing = Model({}, np.zeros(0), np.full(1, 1e9))
    if not words:
        return nothing
    marker = np.array([r["clean"] == 0 and r["toxic"] >= MARKER_ROWS for r in rows])
    # At most ``limit`` rows times the words they share with the vocabulary.
    known = docs.sparkSession.createDataFrame([(bytearray(w), k) for w, k in words.items()], "word binary, k int")
    per_row = (
        counts.join(F.broadcast(known), "word", "left")
        .groupBy("doc_id", "toxic", "n_words")
        .agg(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "n"))).alias("hits"))
        .toArrow()
    )
    grades = per_row["toxic"].to_numpy()
    hits = per_row["hits"].combine_chunks()
    lengths = np.diff(hits.offsets.to_numpy())
    at = np.repeat(np.arange(len(lengths)), lengths)
    k, n = (hits.flatten().field(c).to_numpy() for c in ("k", "n"))
    if not graded:
        share = np.bincount(at, n * marker[k], len(grades)) / np.maximum(per_row["n_words"].to_numpy(), 1)
        grades = np.where(grades > 0, 1 + (share >= STRONG_SHARE), 0)
    _, grades = np.unique(grades, return_inverse=True)  # grades that the sample has, without gaps
    if not len(k) or grades.max() == 0:
        return nothing
    weights, thresholds = fit_ordinal(at, k, 1 + np.log(n), grades, len(words))
    return Model(words, weights, thresholds)


def _scorer(model: Model):
    def scores(texts) -> np.ndarray:
        return model.severity(np.array([model.logit(t) for t in texts], float))

    return scores


def scored(docs: DataFrame, model: Model, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """(doc_id, severity, toxic) for every row."""
    scores = _scorer(model)

    def task(batches):
        for batch in batches:
            severity = scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(severity), pa.array(severity >= toxic_from)], ["doc_id", "severity", "toxic"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text")).mapInArrow(task, "doc_id bigint, severity double, toxic boolean")


def remove_toxic(docs: DataFrame, model: Model, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """Rows of docs, all columns, that the model doesn't reject."""
    scores, at = _scorer(model), docs.columns.index("text")

    def task(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(scores(texts) < toxic_from))

    return docs.mapInArrow(task, docs.schema)
