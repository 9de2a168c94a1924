"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features of a document are log counts of its words and word beginnings, of
which the fit keeps those that go with the label. One weight vector serves all
ordered thresholds: P(grade >= k) = sigmoid(w.x - cut[k]), with increasing
cuts. The result is the expected severity, the sum of these probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import sampled_texts, ship
from tabelion.llm.decontaminate import words_of

ship(__name__)
ship("tabelion.llm.decontaminate")

#: A document is called toxic from this probability of grade 1 or more.
FLAG = 0.3
#: Labelled documents that the model is fitted on, at most, and bytes of their (whole) texts.
SAMPLE_DOCS = 8000
SAMPLE_BYTES = 64_000_000
#: Kept features at most, the smallest number of training documents that hold one, and the least force (log odds
#: of the label times the root of that number) that sets one apart from chance.
N_FEATURES = 4000
MIN_DOCS = 3
MIN_FORCE = 7.0
#: Lengths in bytes of the word beginnings that are features beside the words.
STEMS = (4, 5, 6)
#: Marked words in a toxic document from which it is graded 1, 2 and 3.
GRADE_FROM = (0, 3, 6)


def tokens(text: bytes) -> Counter:
    """Counts of words, and of word beginnings (marked by a trailing ``*``)."""
    words = Counter(words_of(text))
    out = Counter(words)
    for word, n in words.items():
        for size in STEMS:
            if len(word) > size:
                out[word[:size] + b"*"] += n
    return out


@dataclass
class OrdinalModel:
    weights: dict[bytes, float]
    cuts: np.ndarray

    def exceedance(self, text: bytes) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        weights, z = self.weights, 0.0
        words = Counter(words_of(text))
        found: Counter = Counter()
        for word, n in words.items():
            if word in weights:
                found[word] += n
            for size in STEMS:
                if len(word) > size and (stem := word[:size] + b"*") in weights:
                    found[stem] += n
        for feature, n in found.items():
            z += weights[feature] * np.log1p(n)
        return 1 / (1 + np.exp(-np.clip(z - self.cuts, -30, 30)))


def fit_ordinal(
    x: list[dict[int, float]], grades: np.ndarray, n_features: int, n_grades: int, rounds: int = 400, l2: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing cuts by maximum likelihood (Adam) with an L2 penalty.

    The increments of the cuts are exponentials, so their order holds throughout.
    """
    n, k = len(x), n_grades - 1
    rows = np.repeat(np.arange(n), [len(r) for r in x])
    cols = np.fromiter((c for r in x for c in r), np.int64, len(rows))
    vals = np.fromiter((v for r in x for v in r.values()), float, len(rows))
    share = np.full(n, 1.0 / n)
    theta = np.zeros(n_features + k)
    above = (grades > 0).mean()
    theta[n_features] = np.log((1 - above + 1e-6) / (above + 1e-6))
    moment = [np.zeros_like(theta), np.zeros_like(theta)]
    padded = lambda c: np.concatenate(([-np.inf], c, [np.inf]))
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, rounds + 1):
        gaps = np.exp(theta[n_features + 1 :])
        cuts = padded(theta[n_features] + np.concatenate(([0.0], np.cumsum(gaps))))
        z = np.bincount(rows, vals * theta[cols], minlength=n)
        low, high = logistic(z - cuts[grades]), logistic(z - cuts[grades + 1])  # P(>= grade), P(> grade)
        p = np.maximum(low - high, 1e-12)
        d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
        grad = np.zeros_like(theta)
        dz = share * (d_low - d_high)
        grad[:n_features] = np.bincount(cols, vals * dz[rows], minlength=n_features)
        d_cut = np.zeros(k + 2)
        np.add.at(d_cut, grades, -share * d_low)
        np.add.at(d_cut, grades + 1, share * d_high)
        d_cut = d_cut[1:-1]
        grad[n_features] = d_cut.sum()
        for j in range(1, k):
            grad[n_features + j] = d_cut[j:].sum() * gaps[j - 1]
        grad[:n_features] -= l2 * theta[:n_features]
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad**2
        theta = theta + 0.05 * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
    return theta[:n_features], theta[n_features] + np.concatenate(([0.0], np.cumsum(np.exp(theta[n_features + 1 :]))))


def fit(documents: list[tuple[bytes, int]]) -> OrdinalModel:
    """From texts and 0/1 labels: choose features, grade the toxic documents, fit the ordinal model.

    Grade 0 is label 0. Documents of label 1 are graded 1 to 3 by how many of
    their words are marked, that is, never seen under label 0 and seen in
    ``MIN_DOCS`` documents of label 1: the table has no finer labels.
    """
    counts = [tokens(t) for t, _ in documents]
    labels = np.array([y for _, y in documents], int)
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    if not n1 or not n0:
        return OrdinalModel({}, np.array([30.0, 31.0, 32.0]) * (1 if not n1 else -1))
    df = [Counter(), Counter()]
    for c, y in zip(counts, labels, strict=True):
        df[y].update(c.keys())
    odds = {
        t: np.log((df[1][t] + 0.1) / (n1 + 0.2)) - np.log((df[0][t] + 0.1) / (n0 + 0.2))
        for t in df[1].keys() | df[0].keys()
        if df[1][t] + df[0][t] >= MIN_DOCS
    }
    # What goes with the label at all, the strongest first: log odds times the root of the support.
    force = {t: abs(o) * np.sqrt(df[1][t] + df[0][t]) for t, o in odds.items()}
    chosen = sorted((t for t in force if force[t] >= MIN_FORCE), key=lambda t: (-force[t], t))[:N_FEATURES]
    marked = {t for t in chosen if not df[0][t] and not t.endswith(b"*")}
    number = {t: i for i, t in enumerate(chosen)}
    x = [{number[t]: float(np.log1p(n)) for t, n in c.items() if t in number} for c in counts]
    hits = np.array([sum(n for t, n in c.items() if t in marked) for c in counts])
    grades = np.where(labels == 1, np.searchsorted(GRADE_FROM, hits, "right"), 0)
    weights, cuts = fit_ordinal(x, grades, len(chosen), len(GRADE_FROM) + 1)
    return OrdinalModel(dict(zip(chosen, weights.tolist(), strict=True)), cuts)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> OrdinalModel:
    """A model of ``labels.toxic`` from at most ``sample_docs`` labelled documents (the smallest id hashes).

    Null labels, and labels without a document, are not used; of several
    labels for a document the highest counts, and of several rows of a
    document the one of the smallest text hash. Documents that do not fit into
    what is left of ``SAMPLE_BYTES`` are not in the sample.
    """
    usable = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    return fit(sampled_texts(docs, sample, "toxic", F.octet_length("text"), SAMPLE_BYTES))


def _grade(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = model.value
        # A text without any telling word is never flagged.
        flag = max(FLAG, ordinal.exceedance(b"")[0] + 0.05)
        for batch in batches:
            p = [ordinal.exceedance(x or b"") for x in batch.column("_text").cast(pa.binary()).to_pylist()]
            above = np.array(p).reshape(len(p), len(ordinal.cuts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(above.sum(1)),
                    pa.array((above >= 0.5).sum(1).astype(np.int32)),
                    pa.array((above[:, 0] >= flag).astype(np.int32)),
                ],
                names=["_id", "severity", "grade", "toxic"],
            )

    return run


def grade_documents(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, severity (expected grade), grade (0 to 3), toxic (1 if P(grade >= 1) reaches FLAG and exceeds an empty text's) of every document row.

    Nulls: a null text has no words; a null id passes through. Repeated rows
    each give a row, empty tables none. Other columns are not read. Texts are
    read whole, one at a time.
    """
    source = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    id_type = source.schema["_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    graded = source.mapInArrow(_grade(shared), f"_id {id_type}, severity double, grade int, toxic int")
    return graded.withColumnRenamed("_id", "doc_id")
