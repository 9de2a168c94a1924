"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features describe itself and its
neighbours; transition weights couple labels of neighbouring lines. The model
is trained on a bounded sample of labelled documents, whose lines all carry the
document's label, by maximum conditional likelihood. A document's score is the
mean of its lines' forward-backward marginals of "good", weighted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import sampled_texts, ship

ship(__name__)

#: Labelled documents that the model is fitted on, at most.
SAMPLE_DOCS = 4000
#: Bytes of the (whole) texts that the model is fitted on, at most, with LINE_BYTES for each line's features.
SAMPLE_BYTES = 256_000_000
LINE_BYTES = 400
#: Lines of a chain in fitting; a longer document is several, without the transitions between them (scoring has all).
CHAIN = 400
FOLDS = 5
GOOD = 0.3
ROUNDS = 150
L2 = 1e-3

_SYMBOLS = b"#*$%&|<>!~^=+@_{}[]\\/"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = _UPPER + _UPPER.lower()
_DIGITS = b"0123456789"
_STOPS = (b".", b"!", b"?", b":", b";")
N_OWN = 13


def line_features(line: bytes, previous: bytes | None) -> tuple[float, ...]:
    """What a line says about itself: shares of symbols, capitals, digits, short and repeated words, and the like."""
    n, words = len(line), line.split()
    m = len(words)
    if not m:
        return (1.0, *[0.0] * (N_OWN - 1))
    sizes = list(map(len, words))
    symbols = n - len(line.translate(None, _SYMBOLS))
    capitals = n - len(line.translate(None, _UPPER))
    letters = n - len(line.translate(None, _LETTERS))
    digits = n - len(line.translate(None, _DIGITS))
    stops = line.count(b".") + line.count(b",")
    return (
        0.0,
        np.log1p(m),
        sum(sizes) / m / 10,
        min(1.0, 4 * symbols / n),
        capitals / max(1, letters),
        digits / n,
        sum(map(eq, words, words[1:])) / m,
        1 - len(set(words)) / m,
        sum(map((4).__gt__, sizes)) / m,
        words.count(b"|") / m,
        min(1.0, stops / m),
        float(line.rstrip().endswith(_STOPS)),
        float(line == previous),
    )


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines, 3 * N_OWN + 3) features: own, previous line's, next line's, first, last, one; and line lengths."""
    lines = text.split(b"\n")
    own = np.array([line_features(x, p) for x, p in zip(lines, [None, *lines], strict=False)])
    nothing = np.zeros((1, N_OWN))
    edges = np.zeros((len(lines), 3))
    edges[0, 0] = edges[-1, 1] = 1
    edges[:, 2] = 1
    x = np.hstack([own, np.vstack([nothing, own[:-1]]), np.vstack([own[1:], nothing]), edges])
    return x, np.fromiter(map(len, lines), float, len(lines)) + 1


@dataclass
class LineField:
    """Weights of "good" against "bad" for a line's features, and of the four label transitions."""

    weights: np.ndarray
    transitions: np.ndarray  # [from, to] with 0 bad, 1 good

    def marginals(self, x: np.ndarray) -> list[float]:
        """Probability of "good" for each line, by forward-backward."""
        good = (1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))).tolist()
        (bb, bg), (gb, gg) = np.exp(self.transitions).tolist()
        forward, p = [], None
        for s in good:
            if p is None:
                g, b = s, 1 - s
            else:
                g, b = s * (p * gg + (1 - p) * bg), (1 - s) * (p * gb + (1 - p) * bb)
            p = g / (g + b)
            forward.append(p)
        out, g, b = [], 0.5, 0.5
        for s, p in zip(reversed(good), reversed(forward), strict=True):
            out.append(p * g / (p * g + (1 - p) * b))
            g, b = gg * s * g + gb * (1 - s) * b, bg * s * g + bb * (1 - s) * b
            g, b = g / (g + b), b / (g + b)
        return out[::-1]

    def score(self, text: bytes) -> float:
        x, lengths = document_features(text)
        return float(np.dot(self.marginals(x), lengths) / lengths.sum())


def fit(documents: list[tuple[bytes, int]], rounds: int = ROUNDS, l2: float = L2) -> LineField:
    """Maximum likelihood with an L2 penalty, by Adam over all documents at once.

    Each document counts as much as any other, whatever its number of lines.
    """
    width = 3 * N_OWN + 3
    w, trans = np.zeros(width), np.zeros((2, 2))
    if not documents:
        return LineField(w, trans)
    whole = [(document_features(t)[0], y) for t, y in documents]
    data = [(x[i : i + CHAIN], y, len(x)) for x, y in whole for i in range(0, len(x), CHAIN)]
    data.sort(key=lambda d: -len(d[0]))
    lengths = np.array([len(x) for x, _, _ in data])
    labels = np.array([y for _, y, _ in data])
    start = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    features = np.vstack([x for x, _, _ in data])
    per_doc = np.array([1.0 / n for _, _, n in data]) / len(documents)
    del whole, data
    mean, spread = features.mean(0), features.std(0) + 1e-6
    mean[-3:], spread[-3:] = 0, 1
    features = (features - mean) / spread
    at = [start[: np.searchsorted(-lengths, -t, "left")] + t for t in range(lengths[0])]  # rows of the t-th lines
    share = np.repeat(per_doc, lengths)  # a document's weight is spread over its lines
    gold = np.repeat(labels, lengths).astype(float)
    moment = [np.zeros(width + 4), np.zeros(width + 4)]
    theta = np.zeros(width + 4)
    for step in range(1, rounds + 1):
        s = features @ theta[:width]
        trans = theta[width:].reshape(2, 2)
        e = np.exp(trans)
        node = np.stack([1 / (1 + np.exp(np.clip(s, -30, 30))), 1 / (1 + np.exp(-np.clip(s, -30, 30)))], 1)
        forward, backward = np.empty_like(node), np.ones_like(node)
        for t, rows in enumerate(at):
            a = node[rows] if t == 0 else node[rows] * (forward[rows - 1] @ e)
            forward[rows] = a / a.sum(1, keepdims=True)
        for t in range(len(at) - 1, 0, -1):
            rows = at[t]
            b = (node[rows] * backward[rows]) @ e.T
            backward[rows - 1] = b / b.sum(1, keepdims=True)
        marginal = forward * backward
        marginal /= marginal.sum(1, keepdims=True)
        grad = np.empty(width + 4)
        grad[:width] = features.T @ (share * (gold - marginal[:, 1]))
        expected = np.zeros((2, 2))
        for t in range(1, len(at)):
            rows = at[t]
            pair = forward[rows - 1][:, :, None] * e * (node[rows] * backward[rows])[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            expected += (per_doc[: len(rows), None, None] * pair).sum(0)
        seen = np.zeros((2, 2))
        for y in (0, 1):
            seen[y, y] = (((lengths - 1) * per_doc)[labels == y]).sum()
        grad[width:] = (seen - expected).ravel()
        grad -= l2 * theta
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad**2
        theta = theta + 0.1 * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
    w = theta[:width] / spread
    w[-1] -= float((theta[:width] * mean / spread).sum())
    return LineField(w, theta[width:].reshape(2, 2))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 is held out. Null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LineField:
    """A model of ``labels.quality`` from at most ``sample_docs`` documents outside the held-out fold.

    The sample is the labelled documents of the smallest id hashes. Labels
    that are null, or whose document is missing, are not used; of several
    labels for a document the lowest counts, and of several rows of a document
    the one of the smallest text hash. Documents that do not fit into what is
    left of ``SAMPLE_BYTES`` are not in the sample. Without labels all weights
    are 0.
    """
    usable = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    n_lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return fit(sampled_texts(docs, sample, "quality", F.octet_length("text") + LINE_BYTES * n_lines, SAMPLE_BYTES))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            scores = pa.array([field.score(x or b"") for x in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), scores], names=["_id", "score"])

    return run


def score_documents(docs: DataFrame, model: LineField) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better), predicted (1 if score >= GOOD) of every document row.

    Nulls: a null text is an empty one, which is one empty line and is scored
    like any other; a null id passes through and is not held out. Repeated
    rows each give a row, empty tables none. Other columns are not read. Texts
    are read whole, one at a time.
    """
    source = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    id_type = source.schema["_id"].dataType.simpleString()
    scored = source.mapInArrow(
        _score(docs.sparkSession.sparkContext.broadcast(model)), f"_id {id_type}, score double"
    )
    return scored.select(
        F.col("_id").alias("doc_id"),
        F.coalesce(fold(F.col("_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: LineField) -> DataFrame:
    """The rows of ``docs``, same columns, that are not predicted bad; scored in the rows' own partitions."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([field.score(x or b"") >= GOOD for x in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
