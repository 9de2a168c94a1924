"""Quality rules with risk-controlled thresholds.

Each rule compares a document's statistic with a cutoff; cutoffs are chosen for
each stratum (language) from labelled documents. Candidates go from loose to
strict in a fixed order. On one half of the labelled documents, the holdout, a
candidate is certified if the exact (Clopper-Pearson) upper bound on the share
of good documents it rejects is within the rule's part of the risk; testing
stops at the first candidate that fails (fixed-sequence testing), and the
confidence is divided over all strata and rules (Bonferroni). The other half
tells which of the certified candidates is worth having. So with probability
1 - ``DELTA`` no stratum loses more than ``RISK`` of its good documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import ship, staged

ship(__name__)

RISK = 0.03
DELTA = 0.05
#: A certified cutoff is used if it rejects at least this share of the bad documents of its half.
LEAST_USE = 0.01
#: Strata up to which their table of cutoffs is broadcast.
BROADCAST_STRATA = 10_000

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Statistic, the side that is rejected, and cutoffs from loose to strict.
CANDIDATES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbol_share": ("above", (2.5, 2.0, 1.5, 1.2, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05)),
    "repeat_share": ("above", (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "duplicate_line_share": ("above", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05)),
    "capital_share": ("above", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15)),
    "long_words": ("above", (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0)),
    "short_words": ("below", (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0)),
}

_WHITE_OR_TAIL = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


def count_repeats(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur at least twice, the first one included."""
    windows = list(zip(*(words[i:] for i in range(size)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, reach, n = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            n += i + size - max(i, reach)
            reach = i + size
    return n


def text_counts(data: bytes) -> tuple[int, ...]:
    """The counts named in ``_COUNTS`` of UTF-8 text; words are runs of anything but blanks."""
    words = data.split()
    lines, seen, repeated = data.split(b"\n"), set(), 0
    for line in lines:
        if line.strip():
            repeated += line in seen
            seen.add(line)
    without_upper = data.translate(None, _UPPER)
    return (
        len(words),
        len(data.translate(None, _WHITE_OR_TAIL)),
        len(data) - len(data.translate(None, _SYMBOLS)),
        repeated,
        count_repeats(words),
        len(lines),
        len(data) - len(without_upper),
        len(data) - len(without_upper.translate(None, _UPPER.lower())),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_counts(x or b"") for x in batch.column("_text").cast(pa.binary()).to_pylist()]
        columns = list(zip(*rows, strict=True)) or [()] * len(_COUNTS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("stratum"), *[pa.array(c, pa.int64()) for c in columns]],
            names=["doc_id", "stratum", *_COUNTS],
        )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (the language, or empty) and the counts of every document row."""
    source = docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), F.col("text").alias("_text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_count, f"doc_id {id_type}, stratum string, " + ", ".join(f"{c} bigint" for c in _COUNTS))


def statistics() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbol_share": F.col("n_symbols") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "duplicate_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "capital_share": F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)),
        "long_words": mean,
        "short_words": mean,
    }


def rejects(rule: str, cutoff: float | Column) -> Column:
    value = statistics()[rule]
    return value > cutoff if CANDIDATES[rule][0] == "above" else value < cutoff


def upper_bound(k: int, n: int, delta: float) -> float:
    """The largest p with P(Binomial(n, p) <= k) >= ``delta`` (Clopper-Pearson, one-sided)."""
    if k >= n:
        return 1.0
    if k == 0:
        return 1 - delta ** (1 / n)
    choose = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def at_most_k(p: float) -> float:
        return math.fsum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(choose))

    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if 0 < middle < 1 and at_most_k(middle) >= delta else (low, middle)
    return high


def choose_cutoffs(counts: list[dict], risk: float = RISK, delta: float = DELTA) -> dict[str, dict[str, float]]:
    """Cutoffs by stratum and rule, from rows of counts by (stratum, good, holdout); only certified ones occur."""
    by: dict[str, dict[tuple[bool, bool], dict]] = {}
    for row in counts:
        by.setdefault(row["stratum"], {})[bool(row["good"]), bool(row["holdout"])] = row
    tests = max(1, len(by) * len(CANDIDATES))
    out: dict[str, dict[str, float]] = {}
    for stratum, parts in by.items():
        held, bad = parts.get((True, True)), parts.get((False, False))
        if not held or not bad:
            continue
        for rule, (_, cutoffs) in CANDIDATES.items():
            best, most = None, LEAST_USE * bad["n"]
            for i, cutoff in enumerate(cutoffs):
                if upper_bound(held[f"{rule}_{i}"], held["n"], delta / tests) > risk / len(CANDIDATES):
                    break
                if bad[f"{rule}_{i}"] > most:
                    best, most = cutoff, bad[f"{rule}_{i}"]
            if best is not None:
                out.setdefault(stratum, {})[rule] = best
    return out


def labelled_counts(measured: DataFrame, labels: DataFrame, risk: float = RISK) -> list[dict]:
    """How many labelled documents each candidate rejects, by (stratum, good, holdout).

    One aggregate over all labelled documents; only counts of strata with
    enough good documents to certify anything reach the driver.
    """
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    holdout = F.pmod(F.xxhash64(F.lit("holdout"), F.col("doc_id")), F.lit(2)) == 0
    known = measured.join(marks, "doc_id").withColumn("holdout", holdout).withColumn("good", F.col("quality") == 1)
    sums = [
        F.sum(rejects(rule, c).cast("long")).alias(f"{rule}_{i}")
        for rule, (_, cutoffs) in CANDIDATES.items()
        for i, c in enumerate(cutoffs)
    ]
    counts = staged(known.groupBy("stratum", "good", "holdout").agg(F.count("*").alias("n"), *sums), "rule-counts")
    least = math.log(DELTA) / math.log(1 - risk / len(CANDIDATES))
    enough = counts.where(F.col("good") & F.col("holdout") & (F.col("n") >= least)).select("stratum")
    rows = counts.join(enough, "stratum", "left_semi").orderBy("stratum", "good", "holdout")
    return [r.asDict() for r in rows.toLocalIterator()]


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document row.

    ``base_failed``: fewer than 50 words, or over half of them in repeated
    windows. ``kept``: neither that, nor beyond a certified cutoff of the
    document's stratum; a stratum with too few labelled documents has none.

    Nulls: a null text has no words (and fails), a null language is the
    stratum of the empty name, a null id passes through; a null label is not
    used, of several labels for a document the lowest counts. Repeated rows
    each give a row, empty tables none. Other columns are not read. Texts are
    read whole, one at a time.
    """
    spark = docs.sparkSession
    measured = staged(measure(docs), "measures")
    chosen = choose_cutoffs(labelled_counts(measured, labels, risk), risk, delta)
    schema = "_stratum string, " + ", ".join(f"_{rule} double" for rule in CANDIDATES)
    cuts = spark.createDataFrame([(s, *[c.get(r) for r in CANDIDATES]) for s, c in sorted(chosen.items())], schema)
    cuts = F.broadcast(cuts) if len(chosen) <= BROADCAST_STRATA else cuts
    beyond = F.lit(False)
    for rule in CANDIDATES:
        beyond = beyond | F.coalesce(rejects(rule, F.col(f"_{rule}")), F.lit(False))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.join(cuts, F.col("stratum") == F.col("_stratum"), "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~beyond).alias("kept"),
    )
