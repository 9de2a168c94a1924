"""Phrase collocation mining by SON partitioning.

A phrase found ``min_count`` times among the N words of a language is found, in
at least one shard of S words, ``ceil(min_count * S / N)`` times or more. So
each shard is mined completely at that lowered support, in memory, level by
level: words, phrases of two words, of three and so on; what is frequent in some
shard is a candidate, and all candidates are counted exactly over all shards.

* A shard is a run of the texts that one task reads, about ``RUN_WORDS`` words.
* What a shard leaves out occurs there at most its support less one times.
  These remainders are added up, so a phrase has an upper bound of its count;
  those under ``min_count`` are no candidates. (Where a language has over
  ``min_count`` shards, the lowered support is 1 and the bound is the count.)
* Shards report hashes of phrases, sorted, as arrays by ranges of the hash: a row
  for each shard and range. Two phrases of one hash share a bound, which is then
  larger, so no candidate is lost.
* Candidates come back to the shards as a bitmap of fixed size (``BITMAP`` bits):
  the next level mines only phrases whose parts are in it, and the last pass
  counts by text all phrases that are. A phrase that is there by chance is
  counted too, and exactly; its count decides. With more candidates than bits
  the bitmap says less and the last pass counts more, with the same result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabelion.llm.common import LOWER, UPPER, ship, staged

ship(__name__)

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: Words of a shard; a text is never cut, so a long one can make a shard larger.
RUN_WORDS = 3_000_000
#: Bits of the bitmap of candidates that tasks are sent (16 MB), whatever the number of candidates.
BITMAP = 1 << 27
#: Languages, largest first, whose sizes tasks are sent; shards of others are mined at support 1.
LANGS = 10_000
#: Bytes of text that are split into words at once.
SLICE = 4 << 20
#: Ranges of the hash that shards' phrases are reported in: one for each ``WORDS_A_RANGE`` words of the corpus, within limits.
RANGES = (1 << 10, 1 << 16)
WORDS_A_RANGE = 1 << 20
#: Entries of a range that are added up at once.
FOLDED = 8 << 20
#: Parts that a language's phrases are ranked in before the final ranking.
PARTS = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(UPPER.encode() + _BREAKS + b"\t", LOWER.encode() + b"\n" * len(_BREAKS) + b" ")
_EDGE = re.compile(rb"[ \n]")
_FOLD = np.uint64(0xD6E8FEB86659FD93)
#: The dictionary number of a break between pieces.
BREAK = 0

Run = tuple[list[bytes], dict[str, np.ndarray]]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slices(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``SLICE`` bytes, cut between words."""
    start = 0
    while start < len(data):
        edge = _EDGE.search(data, start + SLICE)
        end = edge.start() if edge else len(data)
        yield data[start:end]
        start = end


def runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Run]:
    """The shards of a task: the words, by number, and each language's texts as word numbers, pieces apart by ``BREAK``."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    assert number[b"\n"] == BREAK
    parts: defaultdict[str, list[np.ndarray]] = defaultdict(list)
    n = 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        at = 0
        while at < len(langs):
            held, volume = defaultdict(list), 0
            while at < len(langs) and volume < SLICE:
                text = texts[at].as_py()
                held[langs[at]].append(text)
                volume += len(text)
                at += 1
            for lang, some in held.items():
                data = (b"\n".join(some) + b"\n").translate(_TABLE)
                for piece in _slices(data):
                    words = filter(None, piece.replace(b"\n", b" \n ").split(b" "))
                    parts[lang].append(np.fromiter(map(number.__getitem__, words), np.int64))
                    n += len(parts[lang][-1])
            if n >= size:
                yield list(number), {lang: np.concatenate(x) for lang, x in parts.items()}
                number = defaultdict(count().__next__)
                number[b"\n"]
                parts.clear()
                n = 0
    if n:
        yield list(number), {lang: np.concatenate(x) for lang, x in parts.items()}


def _bit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit that the hashes' first bits number is set."""
    slot = hashes >> np.uint64(64 - _log2(len(bitmap) * 64))
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _log2(power: int) -> int:
    return power.bit_length() - 1


def _word_hashes(words: list[bytes], used: np.ndarray, lang: str) -> np.ndarray:
    """What ``xxhash64(lang, word)`` is in Spark, at each used word's number."""
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    hashes = np.zeros(len(words), np.uint64)
    hashes[used] = np.fromiter((xxhash.xxh64_intdigest(words[i], seed) for i in used.tolist()), np.uint64, len(used))
    return hashes


def levels(words: list[bytes], ids: np.ndarray, lang: str, bitmaps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For phrases of 2, 3, ... words: where one starts whose shorter phrases are all in the bitmaps of their lengths, and the hashes there."""
    used = np.unique(ids)
    used = used[used != BREAK]
    known = _word_hashes(words, used, lang)
    fine = np.zeros(len(words), bool)
    fine[used] = _bit(bitmaps[0], known[used])
    word, on = known[ids], fine[ids]
    phrase = word
    for m in range(2, len(bitmaps) + 2):
        if len(on) < 2:
            return
        on = on[:-1] & on[1:]
        phrase = _mix(phrase[:-1] * _FOLD + word[m - 1 :])
        yield np.flatnonzero(on), phrase
        if m <= len(bitmaps):
            on = on & _bit(bitmaps[m - 1], phrase)


def _lowered(n_words: int, total: int | None, min_count: int) -> int:
    """The support of a shard: its share of ``min_count``, rounded up, and at least 1."""
    return max(1, -(-min_count * n_words // total)) if total else 1


def _count_words(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, texts in runs(batches, size):
            for lang, ids in texts.items():
                counts = np.bincount(ids, minlength=len(words))
                counts[BREAK] = 0
                used = np.flatnonzero(counts)
                rows = [[lang] * len(used), pa.array([words[i] for i in used.tolist()], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), rows[1], pa.array(counts[used])], ["lang", "phrase", "c"])

    return run


def _mine(totals: dict[str, int], bitmaps: list, min_count: int, size: int, ranges: int):
    """Rows (range, lang, less, rest, bounds) of a shard's locally frequent phrases of one more word than there are bitmaps.

    ``rest`` are the 32 bits of the hashes that follow their range's, sorted;
    ``bounds`` the counts less ``less``, at most ``min_count``. ``less`` is what
    the shard is given for a phrase that it leaves out. Where it is not 0, every
    range gets a row. It can only be in languages of fewer than ``min_count``
    times ``size`` words, which are therefore named; of others the hashes tell.
    """
    log = _log2(ranges)
    small = np.min_scalar_type(min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, texts in runs(batches, size):
            for lang, ids in texts.items():
                total = totals.get(lang)
                named = total is not None and total < min_count * size
                less = _lowered(min(int((ids != BREAK).sum()), size), total, min_count) - 1
                found = list(levels(words, ids, lang, [b.value for b in bitmaps]))
                at, hashes = found[-1] if len(found) == len(bitmaps) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                keys, counts = np.unique(hashes[at] >> np.uint64(32 - log), return_counts=True)
                often = counts > less
                keys, bounds = keys[often], np.minimum(counts[often] - less, min_count).astype(small)
                ends = np.searchsorted(keys, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32))
                keys = keys.astype(np.uint32)
                wanted = np.arange(ranges) if less else np.flatnonzero(np.diff(ends))
                cuts = [(ends[i], ends[i + 1]) for i in wanted.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(wanted.astype(np.int32)),
                        pa.array([lang if named else None] * len(wanted), pa.string()),
                        pa.array(np.full(len(wanted), less, np.int32)),
                        pa.array([keys[i:j].tobytes() for i, j in cuts], pa.binary()),
                        pa.array([bounds[i:j].tobytes() for i, j in cuts], pa.binary()),
                    ],
                    names=["range", "lang", "less", "rest", "bounds"],
                )

    return run


def _add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(which, np.concatenate([b for _, b in parts]), len(keys)).astype(np.int64)


def _unite(min_count: int, ranges: int, bits: int):
    """(range, bits): each range's part of the bitmap of the phrases whose bounds add up to ``min_count``.

    Rows come sorted by range. Of a range only the distinct hashes are held.
    """
    small = np.min_scalar_type(min_count)
    own = bits // ranges

    def part(at: int, held: dict, less: dict) -> tuple[int, bytes]:
        flags = np.zeros(own, np.uint8)
        for lang, parts in held.items():
            keys, bounds = _add(parts)
            hit = keys[bounds + less[lang] >= min_count].astype(np.uint64)
            flags[(hit >> np.uint64(32 - _log2(own))).astype(np.int64)] = 1
        return at, np.packbits(flags, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, less, out = None, defaultdict(list), defaultdict(int), []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != at and at is not None:
                    out.append(part(at, held, less))
                    held.clear()
                    less.clear()
                at, lang = row[:2]
                less[lang] += row[2]
                held[lang].append((np.frombuffer(row[3], np.uint32), np.frombuffer(row[4], small)))
                if len(held[lang]) > 1 and sum(len(k) for k, _ in held[lang][1:]) > FOLDED:
                    held[lang] = [_add(held[lang])]
        if at is not None:
            out.append(part(at, held, less))
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["range", "bits"]
        )

    return run


def _count(bitmaps: list, size: int):
    """(lang, phrase, c): exact counts in the shard of all phrases in the bitmaps, from two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, texts in runs(batches, size):
            spelt = np.array(words, object)
            for lang, ids in texts.items():
                maps = [b.value for b in bitmaps]
                rank, n_ranks = ids, len(words)  # of the phrase without its last word, at each position
                for m, (at, hashes) in enumerate(levels(words, ids, lang, maps[:-1]), 2):
                    at = at[_bit(maps[m - 1], hashes[at])]
                    if not len(at):
                        break
                    _, first, inverse, counts = np.unique(
                        rank[at] * np.int64(len(words)) + ids[at + m - 1], return_index=True, return_inverse=True, return_counts=True
                    )
                    rank = np.zeros(len(ids), np.int64)
                    rank[at] = inverse
                    columns = [pa.array(spelt[ids[at[first] + j]], pa.binary()) for j in range(m)]
                    phrases = pc.binary_join_element_wise(*columns, b" ").cast(pa.string())
                    lang_of = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(first), np.int32)), pa.array([lang]))
                    yield pa.RecordBatch.from_arrays(
                        [lang_of.cast(pa.string()), phrases, pa.array(counts.astype(np.int64))], ["lang", "phrase", "c"]
                    )

    return run


def _bitmap_of_words(words: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of ``words`` (lang, phrase): of ``bits`` bits, a power of two, whatever their number."""
    hashed = words.select(F.shiftrightunsigned(F.xxhash64("lang", "phrase"), 64 - _log2(bits)).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    rows = hashed.select(F.shiftright("slot", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = rows.toArrow()  # bits / 64 rows at most
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap.view(np.uint64)


def _bitmap_of_mined(mined: DataFrame, min_count: int, ranges: int, bits: int) -> np.ndarray:
    """The bitmap of the mined phrases that can have ``min_count`` occurrences: a row of its bits for each range."""
    dealt = mined.repartition("range").sortWithinPartitions("range")
    bitmap = np.zeros((ranges, bits // ranges // 8), np.uint8)
    for r in dealt.mapInArrow(_unite(min_count, ranges, bits), "range int, bits binary").collect():
        bitmap[r["range"]] = np.frombuffer(r.bits, np.uint8)
    return bitmap.reshape(-1).view(np.uint64)


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    text_col: str = "text",
    lang_col: str = "lang",
    run_words: int = RUN_WORDS,
    bits: int = BITMAP,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``max_words`` words found ``min_count`` times, and (lang, n) words in all.

    A-Z are lower-cased; texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
    these at blanks and tabs into words; a phrase lies within a piece.
    Overlapping occurrences count. A null text is empty, a null language
    ``und``; repeated rows count each; an empty table gives no rows. Other
    columns are not read.
    """
    source = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang")
    )
    kept = F.col("f") >= min_count
    by_word = source.mapInArrow(_count_words(run_words), "lang string, phrase string, c bigint")
    words = staged(by_word.groupBy("lang", "phrase").agg(F.sum("c").alias("f")), "words")
    sizes = staged(words.groupBy("lang").agg(F.sum("f").alias("n")), "lang-sizes")
    totals = {r.lang: r.n for r in sizes.orderBy(F.desc("n"), "lang").limit(LANGS).collect()}
    words = words.where(kept)
    send = docs.sparkSession.sparkContext.broadcast
    wanted = sum(totals.values()) // WORDS_A_RANGE
    ranges = min(max(RANGES[0], 1 << wanted.bit_length()), RANGES[1], bits // 64)
    bitmaps = [send(_bitmap_of_words(words, bits))]
    for _ in range(2, max_words + 1):
        mine = _mine(totals, bitmaps, min_count, run_words, ranges)
        mined = source.mapInArrow(mine, "range int, lang string, less int, rest binary, bounds binary")
        bitmaps.append(send(_bitmap_of_mined(mined, min_count, ranges, bits)))
    counted = source.mapInArrow(_count(bitmaps, run_words), "lang string, phrase string, c bigint")
    phrases = counted.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where(kept)
    return staged(words.unionByName(phrases), "phrases"), sizes


def collocations(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score, cut of the phrases of two or more words in ``phrases`` (lang, phrase, f).

    a is the phrase's count. Cut after its first k words, l and r are the
    counts of the parts, and floor(1000000 * a * a / (l * r)) the score; the
    cut of the lowest score counts, of equal ones that of the smallest k.
    Phrases are dropped that lie inside a longer one of at least half their
    count, dropped or not.
    """
    words = F.split("phrase", " ")
    longer = phrases.withColumn("words", words).where(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = longer.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")), " ").alias("rest"),
    )
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "decimal(38,0)"
    a, parts = F.col("a").cast("decimal(15,0)"), F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    scores = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    scores = scores.withColumn("top", (a * a * F.lit(1_000_000).cast("decimal(7,0)")).cast(wide)).withColumn("below", parts.cast(wide))
    scores = scores.withColumn("score", F.expr("top div below"))
    best = scores.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("best"))
    best = best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.score", "best.cut")

    size = F.size("words")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")),
        )
    )
    inside = longer.where(size > 2).select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("f"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    whole = best.join(inside, ["lang", "phrase"], "left")
    return whole.where(F.coalesce(100 * F.col("within") < 50 * F.col("a"), F.lit(True))).drop("within")


def top_collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language, best score first.

    Equal scores: the larger count, then the phrase in UTF-8 byte order. Rows
    are ranked in ``PARTS`` parts of a language first, so a large language is
    no single task's work. Nulls and the rest: see ``frequent_phrases``.
    """
    phrases, sizes = frequent_phrases(docs, **options)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    best = collocations(phrases).select("*", part)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


