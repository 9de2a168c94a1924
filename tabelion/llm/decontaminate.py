"""Benchmark decontamination with an Aho-Corasick automaton over words.

Every window of ``window`` consecutive words of a benchmark item (an item of
fewer words is one window) is a pattern. One automaton over the word numbers of
all patterns reads each document's words once; a match marks its words as hit,
and hit words are mapped back to code-point spans of the original text.

The automaton is broadcast in blocks of bounded benchmark text
(``block_bytes``): a larger benchmark takes one pass over the documents for each
block, so its size never decides whether all windows are searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import ship, staged

ship(__name__)

WINDOW = 10
#: Benchmark text of one automaton: about ten trie nodes of some 50 bytes for each word.
BLOCK_BYTES = 2 << 20

#: A-Z to a-z; 0-9, a-z and every byte of a non-ASCII character stay; all else separates words.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    """The normalised words of UTF-8 text: lower-cased A-Z, split at ASCII other than letters and digits."""
    return data.translate(WORD_TABLE).split()


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code-point start and end of each word of ``words_of(data)`` in the original text."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.frombuffer(data.translate(WORD_TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return points[np.flatnonzero(edge == 1)], points[np.flatnonzero(edge == -1)]


class WindowAutomaton:
    """The automaton of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        import ahocorasick

        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            numbers = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text))
            for i in range(max(1, len(numbers) - window + 1) if numbers else 0):
                owners.setdefault(numbers[i : i + window], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for numbers, found in owners.items():
            self.automaton.add_word(numbers, (len(numbers), tuple(found)))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged [first word, end word) intervals hit in ``words``, and the items found."""
        spans: list[list[int]] = []
        found: set[str] = set()
        if self.empty or not words:
            return spans, found
        get = self.vocabulary.get
        for last, (n, items) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            found.update(items)
            first = last - n + 1
            while spans and spans[-1][1] >= first:
                first = min(first, spans.pop()[0])
            spans.append([first, last + 1])
        return spans, found


def _scan(block, window: int, only_hits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = WindowAutomaton(block.value, window)
        for batch in batches:
            rows = []
            for data in batch.column("_text").cast(pa.binary()).to_pylist():
                words = words_of(data or b"")
                spans, items = search.matches(words)
                chars = []
                if spans:
                    starts, ends = word_spans(data)
                    chars = [(int(starts[a]), int(ends[b - 1])) for a, b in spans]
                rows.append((len(words), spans, sorted(items), chars))
            n_words, spans, items, chars = zip(*rows, strict=True) if rows else ((), (), (), ())
            pair = lambda k: pa.struct([(f"{k}_start", pa.int64()), (f"{k}_end", pa.int64())])
            cells = lambda k, v: [[{f"{k}_start": a, f"{k}_end": b} for a, b in x] for x in v]
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_key"),
                    pa.array(n_words, pa.int64()),
                    pa.array(cells("word", spans), pa.list_(pair("word"))),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(cells("char", chars), pa.list_(pair("char"))),
                ],
                names=["_id", "_key", "n_words", "word_spans", "item_ids", "char_spans"],
            )
            yield out.filter(pa.array([bool(x) for x in items], pa.bool_())) if only_hits else out

    return run


def _merged(column, kind: str):
    """Sorted disjoint intervals that cover the same positions as ``column``'s."""
    start, end = f"{kind}_start", f"{kind}_end"
    return F.aggregate(
        F.array_sort(column),
        F.expr(f"cast(array() as array<struct<{start}:bigint,{end}:bigint>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)[end] >= x[start]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)[start].alias(start),
                        F.greatest(F.element_at(acc, -1)[end], x[end]).alias(end),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document row: its id, ``n_words``, ``n_hit``, ``item_ids``, ``word_spans``, ``char_spans``.

    ``word_spans`` are disjoint [start, end) word intervals covered by
    occurrences of windows, ``char_spans`` the same in code points of the
    original text (``end`` exclusive), ``item_ids`` the items (as strings,
    sorted) with occurring windows.

    Nulls: a null text has no words; a null id passes through; a null item
    text has no window; a null item id is listed as the empty string. Repeated
    rows each give a row; repeated items count once. Empty tables give an
    empty result, or documents without hits. Other columns are not read, so
    their names cannot clash. Texts are read whole, one at a time.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("body")
    ).where(F.col("body").isNotNull())
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_bytes))
    source = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"), F.col(text_col).alias("_text")
    )
    id_type = source.schema["_id"].dataType.simpleString()
    schema = (
        f"_id {id_type}, _key bigint, n_words bigint, word_spans array<struct<word_start:bigint,word_end:bigint>>, "
        "item_ids array<string>, char_spans array<struct<char_start:bigint,char_end:bigint>>"
    )
    passes = []
    for k in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == k).distinct()
        block = spark.sparkContext.broadcast([(r.item, r.body.encode()) for r in own.toLocalIterator()])
        passes.append(source.mapInArrow(_scan(block, window, only_hits=k > 0), schema))
    found = passes[0]
    if n_blocks > 1:
        rest = passes[1]
        for more in passes[2:]:
            rest = rest.unionByName(more)
        rest = staged(rest.distinct(), "leaks")
        rest = rest.groupBy(F.col("_id").alias("_id2"), F.col("_key").alias("_key2")).agg(
            F.flatten(F.collect_list("word_spans")).alias("_w"),
            F.flatten(F.collect_list("item_ids")).alias("_i"),
            F.flatten(F.collect_list("char_spans")).alias("_c"),
        )
        found = found.join(rest, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left")
        joined = lambda a, b: F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, b))
        found = found.select(
            "_id",
            "n_words",
            _merged(joined("word_spans", "_w"), "word").alias("word_spans"),
            F.array_sort(F.array_distinct(joined("item_ids", "_i"))).alias("item_ids"),
            _merged(joined("char_spans", "_c"), "char").alias("char_spans"),
        )
    n_hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda a, x: a + x["word_end"] - x["word_start"])
    return found.select(
        F.col("_id").alias(id_col), "n_words", n_hit.alias("n_hit"), "item_ids", "word_spans", "char_spans"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window, all columns kept.

    The scan runs inside the rows' own partitions, so no text is shuffled. A
    benchmark above one block takes one pass per block.
    """
    spark = docs.sparkSession
    items = benchmark.select("text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK_BYTES))

    def keep(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = WindowAutomaton(block.value, window)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                clean = [not search.matches(words_of(data or b""))[1] for data in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for k in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == k).distinct()
        block = spark.sparkContext.broadcast([("", r.text.encode()) for r in own.toLocalIterator()])
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
