"""Near-dup detection with DartMinHash signatures and banded joining.

A document is the weighted set of its five-word shingles (weight: occurrences).
Each unit of an element's weight is a strip of a plane whose other axis is
rank; darts hit each strip as a Poisson process seeded by the element, so equal
strips get equal darts in every document. Only darts up to a rank that fills
all coordinates are drawn (about k ln k for a document whatever its size). Each
dart is hashed to one of k coordinates, and each coordinate keeps its earliest
dart; two documents agree in a coordinate with their weighted Jaccard
similarity as probability.

Coordinates are cut into bands; documents with an equal band share a bucket.
Exact copies are collapsed first. A bucket does not emit its pairs: its members
are compared with one document of it, the centre, exactly, on the shingles. By
the triangle inequality of Jaccard distance, members far from the centre cannot
be linked to those near it, so a bucket falls into two parts; a part whose
members are already one component is done. Members of a part with very many
components meet anew in buckets of their rarest shingles, of which linked ones
share one for certain. All go on with new centres until no bucket has members of
several components left to compare. From then on a member is compared with a centre
only if the parities of their strips in a few hundred slots differ in few enough
slots, which is so for all linked ones. Classes are the connected components of
the links; links found later join the components that there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabelion.llm.common import ship, staged
from tabelion.llm.decontaminate import words_of

ship(__name__)
ship("tabelion.llm.decontaminate")

SHINGLE = 5
SIMILARITY = 0.8
#: 26 bands of 6: a pair at similarity 0.8 misses all buckets with probability 4e-4, one at 0.85 with 3e-6; pairs at
#: 0.5 and 0.6, which are only work, share one with probability 0.34 and 0.71.
BANDS, ROWS = 26, 6
#: Components in a bucket beyond which its members meet by their rarest shingles rather than in it.
CROWD = 64
#: Slots in which shingles are counted to tell rare ones; any count gives the same links.
SLOTS = 1 << 20
#: Components of a bucket that one task puts in order.
ORDERED = 4096
#: Slots of a document's parities, in words of 64 bits; any count gives the same links.
PARITY_WORDS = 8
SEED = 0x5DEECE66D

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` words; fewer words, but not none, are one shingle."""
    import xxhash

    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(size, n)
    if not n:
        return h
    s = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        s = mix(s * _FOLD + h[i : n - size + 1 + i])
    return s


def unit_strips(elements: np.ndarray) -> np.ndarray:
    """Distinct ids for the unit strips of a multiset: the j-th occurrence of an element is a strip of its own."""
    if not len(elements):
        return elements
    s = np.sort(elements)
    at = np.arange(len(s))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], s[1:] != s[:-1])), at, 0))
    return mix(s + (at - first).astype(np.uint64) * _GOLD)


def dart_signature(strips: np.ndarray, k: int, seed: int = SEED, widths: np.ndarray | None = None) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates over ``strips`` (of ``widths`` in (0, 1], or 1)."""
    total = len(strips) if widths is None else float(widths.sum())
    limit = k * (np.log(k) + 3.0) / total
    while True:
        ids, ranks = [], []
        x, rank, w = mix(strips ^ np.uint64(seed)), np.zeros(len(strips)), widths
        j, step = 0, max(1, int(np.ceil(limit + np.sqrt(limit))))
        while len(x):
            turns = (np.arange(j, j + step, dtype=np.uint64) + np.uint64(1)) * _GOLD
            dart = mix(x[:, None] + turns[None, :])
            gap = -np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            when = rank[:, None] + np.cumsum(gap, axis=1)
            hit = when <= limit
            on = hit[:, -1]
            if w is not None:
                hit &= (mix(dart ^ _GOLD) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < w[:, None]
                w = w[on]
            ids.append(dart[hit])
            ranks.append(when[hit])
            x, rank = x[on], when[on, -1]
            j += step
        darts = np.concatenate(ids)
        darts = darts[np.argsort(np.concatenate(ranks), kind="stable")[::-1]]
        where = (mix(darts ^ _FOLD) % np.uint64(k)).astype(np.int64)
        signature, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
        signature[where] = darts  # the earliest comes last and stays
        filled[where] = True
        if filled.all():
            return signature
        limit *= 2


def weighted_signature(elements: np.ndarray, weights: np.ndarray, k: int, seed: int = SEED) -> np.ndarray:
    """DartMinHash of elements (64-bit ids) with any positive weights: whole strips, and one of the rest's width."""
    whole = np.floor(weights).astype(np.int64)
    rest = weights - whole
    occurrence = np.concatenate([np.arange(n) for n in whole + (rest > 0)]).astype(np.uint64)
    repeated = np.repeat(elements, whole + (rest > 0))
    widths = np.concatenate([np.r_[np.ones(n), [r] if r > 0 else []] for n, r in zip(whole, rest, strict=True)])
    return dart_signature(mix(repeated + occurrence * _GOLD), k, seed, widths)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for column in signature.reshape(bands, rows).T:
        key = mix(key * _FOLD + column)
    return key


def _sketch(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            prints, sizes, keys, ends = [], [], [], [0]
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(data or b"")
                prints.append(xxhash.xxh3_128_digest(b" ".join(words)))
                strips = unit_strips(shingles(words))
                sizes.append(len(strips))
                if len(strips):
                    keys.append(band_keys(dart_signature(strips, bands * rows), bands, rows))
                ends.append(ends[-1] + bands * (len(strips) > 0))
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            halves = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                names=["doc", "f1", "f2", "n", "bands"],
            )

    return run


def parities(strips: np.ndarray, words: int = PARITY_WORDS) -> np.ndarray:
    """``words`` times 64 bits: of each slot, whether an odd number of ``strips`` falls into it.

    Strips that two documents share cancel, so the parities of two documents
    differ in at most as many slots as there are strips in one of them only.
    """
    slot = (mix(strips ^ _GOLD) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(slot, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        texts = [words_of(x or b"") for x in batch.column("text").cast(pa.binary()).to_pylist()]
        prints = b"".join(xxhash.xxh3_128_digest(b" ".join(words)) for words in texts)
        halves = np.frombuffer(prints, np.int64).reshape(-1, 2)
        rows = [unit_strips(shingles(words)) for words in texts]
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        flat = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        ends = (np.arange(len(rows) + 1) * PARITY_WORDS).astype(np.int32)
        flat = np.concatenate([parities(x) for x in rows]) if rows else np.zeros(0, np.int64)
        odd = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        arrays = [batch.column("doc"), pa.array(halves[:, 0]), pa.array(halves[:, 1]), lists, odd]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc", "f1", "f2", "strips", "parities"])


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) over undirected ``links`` (a, b).

    Smallest labels spread along the links, and each label jumps to its own
    label, so the rounds grow with the logarithm of a component's width. Each
    round is written to the shared folder; only a count reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    both = staged(both.where("a != b").distinct(), "edges")
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = staged(
            spread.join(jump, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")
            ),
            "labels",
        )
        labels = new.select("node", "label")
        if new.where("old != label").limit(1).count() == 0:
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (see ``components``) after further ``links`` (a, b), which are followed between components only."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    named = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = named.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    merged = components(between)
    moved = labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
    moved = moved.select("node", F.coalesce("to", "label").alias("label"))
    return staged(moved.unionByName(merged.join(labels.select("node"), "node", "left_anti")), "labels")


def similarity(pairs: DataFrame, strips: DataFrame) -> DataFrame:
    """``pairs`` (a, b) plus ``j``, their exact weighted Jaccard similarity."""
    left = strips.select(F.col("doc").alias("a"), F.col("strips").alias("sa"))
    right = strips.select(F.col("doc").alias("b"), F.col("strips").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    j = both / (F.size("sa") + F.size("sb") - both)
    return pairs.join(left, "a").join(right, "b").select("a", "b", j.alias("j"))


def _shared(members: DataFrame) -> DataFrame:
    """The rows (key, doc) of buckets with at least two documents."""
    ends = members.groupBy("key").agg(F.min("doc").alias("_a"), F.max("doc").alias("_b")).where("_a < _b")
    return members.join(ends.select("key"), "key", "left_semi")


def near_duplicates(
    docs: DataFrame,
    threshold: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document row: ``id_col``, ``class_id`` (the smallest id of its class), ``kept`` (it is that one).

    Words are runs of non-ASCII characters, letters and digits, A-Z
    lower-cased; documents are linked if the weighted Jaccard similarity of
    their five-word shingles is at least ``threshold``.

    Nulls: a null id gives a null class, and such a row is kept. A null text,
    or one without words, is a class of its own. A text of fewer than five
    words is one shingle. Rows with the same id are one document: all their
    texts link it, and the documents that any of them links are one class.
    Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    sketch = staged(
        source.mapInArrow(_sketch(bands, rows), "doc bigint, f1 bigint, f2 bigint, n bigint, bands array<bigint>"),
        "sketch",
    )
    named = sketch.where("doc is not null and n > 0")
    # Exact copies: the smallest id stands for all of them. If ids are repeated, every text has a number instead,
    # for an id may stand for several; else ids do. From here on, "doc" is what stands for one text.
    copies = named.groupBy("f1", "f2").agg(F.min("doc").alias("rep"))
    repeated = not named.groupBy("doc").count().where("count > 1").isEmpty()
    copies = staged(copies.withColumn("node", F.monotonically_increasing_id() if repeated else F.col("rep")), "copies")
    if repeated:
        firsts = named.join(copies, ["f1", "f2"]).where("doc = rep")
        reps = firsts.groupBy(F.col("node").alias("doc")).agg(F.first("bands").alias("bands"))
        of_id = named.join(copies, ["f1", "f2"]).select("doc", "node").distinct()
        first = of_id.groupBy("doc").agg(F.min("node").alias("a"))
        same = staged(of_id.join(first, "doc").select("a", F.col("node").alias("b")).where("a != b").distinct(), "same-id")
    else:
        reps = named.join(copies.select(F.col("rep").alias("doc")), "doc", "left_semi")
        same = copies.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    keys = staged(reps.select("doc", F.explode("bands").alias("key")), "keys")
    members = staged(_shared(keys), "buckets")
    # Only texts that share a bucket are read a second time, for their shingles.
    wanted = copies.join(members.select(F.col("doc").alias("node")).distinct(), "node", "left_semi")
    strips = source.join(wanted.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi").mapInArrow(
        _strips, "doc bigint, f1 bigint, f2 bigint, strips array<bigint>, parities array<bigint>"
    )
    if repeated:
        strips = strips.withColumnRenamed("doc", "rep").join(wanted, ["f1", "f2", "rep"])
        strips = strips.groupBy(F.col("node").alias("doc")).agg(*[F.first(c).alias(c) for c in ("strips", "parities")])
    strips = staged(strips.select("doc", "strips", "parities"), "strips")

    # Round 0: every member against the bucket's document that meets most others (over all buckets): what copies
    # were made from is nearer to each of them than they are to one another.
    met = staged(_with_hub(members), "met")
    tested = _compare(met, None, strips)
    labels = components(_links(tested, threshold).unionByName(same))
    named = staged(_undecided(_sides(met, tested, threshold), labels), "buckets")
    members = named.where(F.col("n_labels") <= CROWD)
    crowd = staged(named.where(F.col("n_labels") > CROWD).select("doc", "label").distinct(), "crowd")
    if not crowd.isEmpty():
        members = members.unionByName(_undecided(_by_rare_shingles(crowd, strips, threshold), labels))
    looks = strips.select("doc", F.struct(F.size("strips").alias("size"), "parities").alias("look"))
    members = staged(members.join(looks, "doc"), "buckets")
    n_centres = 1
    while not members.isEmpty():
        # Then against more and more documents, those of the smallest components first.
        centres = _rare(members, n_centres)
        with_centre = members.join(centres, "key").where("label != its_label").where(_may_link(threshold))
        new = _compare(with_centre, tested, strips)
        tested = tested.unionByName(new)
        found = _links(new, threshold)
        if not found.isEmpty():
            labels = joined(labels, found)
        rest = members.join(centres.select("key", F.col("centre").alias("doc")), ["key", "doc"], "left_anti")
        members = staged(_undecided(rest, labels), "buckets")
        n_centres *= 4

    found = copies.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    if repeated:
        of_label = staged(found.groupBy("label").agg(F.min("rep").alias("class_id")), "class-ids")
        of_print = found.join(of_label, "label").select("f1", "f2", "class_id")
    else:
        of_print = found.select("f1", "f2", F.col("label").alias("class_id"))
    out = sketch.select("doc", "f1", "f2", "n").join(of_print, ["f1", "f2"], "left")
    own = F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.col("class_id")).otherwise(F.col("doc"))
    return out.select(
        F.col("doc").alias(id_col), own.alias("class_id"), F.coalesce(own == F.col("doc"), F.lit(True)).alias("kept")
    )


def _links(tested: DataFrame, threshold: float) -> DataFrame:
    """The pairs of ``tested`` at the threshold."""
    return tested.where(F.col("j") >= threshold).select("a", "b")


def _with_hub(members: DataFrame) -> DataFrame:
    """``members`` without the centre of each bucket, and with it: the one with most meetings, then the smallest id."""
    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    meetings = members.join(sizes, "key").groupBy("doc").agg(F.sum("size").alias("meetings"))
    best = F.max(F.struct("meetings", (-F.col("doc")).alias("last"))).alias("best")
    hubs = members.join(meetings, "doc").groupBy("key").agg(best)
    return members.join(hubs.select("key", (-F.col("best.last")).alias("centre")), "key").where("doc != centre")


def _compare(met: DataFrame, tested: DataFrame | None, strips: DataFrame) -> DataFrame:
    """a, b, j of the pairs (doc, centre) of ``met`` that are not in ``tested`` yet, each once."""
    pairs = met.select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    return staged(similarity(pairs, strips), "tested")


def _sides(met: DataFrame, tested: DataFrame, threshold: float) -> DataFrame:
    """(key, doc, j, decides) of each bucket's two parts around its centre; j is the similarity to it.

    With t the threshold and d = 1 - t, members within d of the centre and
    members beyond 2d of it are more than d apart. So a bucket falls into near
    members with those in between, and far members with those in between.
    """
    at = met.select("key", "doc", F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b"))
    j = F.col("j")
    sides = F.array_compact(
        F.array(F.when(j >= 2 * threshold - 1, F.lit("near")), F.when(j < threshold, F.lit("far")))
    )
    parts = at.join(tested, ["a", "b"]).select("key", "doc", "j", F.explode(sides).alias("side"))
    anywhere = [F.lit(None).cast("int").alias(c) for c in ("n_strips", "rest")]
    return parts.select(F.xxhash64("key", "side").alias("key"), "doc", "j", F.lit(True).alias("decides"), *anywhere)


def _may_link(threshold: float) -> Column:
    """Whether a member and a centre of a bucket can be linked, and this bucket is where that is found out.

    By the triangle inequality, documents whose distances to a third one differ
    by more than 1 - threshold cannot; of the two, the one of smaller ``j`` decides.
    In a bucket of a shingle they share at most ``rest`` of either, if it is the
    first that they share (if it is not, that one's bucket tells), and linked
    ones share threshold / (1 + threshold) of both sizes together. So they have at
    most (1 - threshold) / (1 + threshold) of both sizes for themselves, and their
    parities differ in no more slots.
    """
    differing = sum(
        F.bit_count(F.get("look.parities", F.lit(i)).bitwiseXOR(F.get("its_look.parities", F.lit(i)))) for i in range(PARITY_WORDS)
    )
    alike = differing <= (1 - threshold) / (1 + threshold) * (F.col("look.size") + F.col("its_look.size")) + 1e-6
    least = F.least("rest", "its_rest") >= threshold / (1 + threshold) * (F.col("n_strips") + F.col("its_n_strips")) - 1e-6
    near = F.abs(F.col("j") - F.col("its_j")) <= 1 - threshold + 1e-9
    here = (F.col("decides") & (F.col("j") <= F.col("its_j"))) | (F.col("its_decides") & (F.col("its_j") <= F.col("j")))
    return near & here & F.coalesce(least, F.lit(True)) & alike


def _rare(members: DataFrame, n: int) -> DataFrame:
    """key, centre, its_label, its_j, its_decides, its_n_strips, its_rest, its_look: some members of each bucket, smallest components first.

    There are about ``n`` for each ``ORDERED`` components. Components are taken
    whole while ``n`` lasts; of the smallest at least one document is taken.
    The window is over some ``ORDERED`` components at most.
    """
    share = F.pmod(F.xxhash64("label"), F.ceil(F.max("n_labels") / ORDERED)).alias("share")
    pick = F.max(F.struct("doc", "j", "decides", "n_strips", "rest", "look")).alias("one")
    parts = members.groupBy("key", "label").agg(F.count("*").alias("n"), pick, share)
    order = Window.partitionBy("key", "share").orderBy("n", F.col("label").desc())
    ranked = parts.select(
        "key",
        "label",
        "one",
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.row_number().over(order).alias("rank"),
    )
    whole = ranked.where(F.col("upto") <= n).select("key", "label")
    taken = members.join(whole, ["key", "label"]).select("key", "label", "doc", "j", "decides", "n_strips", "rest", "look")
    first = ranked.where((F.col("rank") == 1) & (F.col("upto") > n)).select("key", "label", "one.*")
    return taken.unionByName(first).select(
        "key",
        F.col("doc").alias("centre"),
        F.col("label").alias("its_label"),
        F.col("j").alias("its_j"),
        F.col("decides").alias("its_decides"),
        F.col("n_strips").alias("its_n_strips"),
        F.col("rest").alias("its_rest"),
        F.col("look").alias("its_look"),
    )


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets (key, doc, j, decides, n_strips, rest, label, n_labels) whose members are of several components.

    Buckets that decide nothing are done. A column ``look`` stays.
    """
    columns = [c for c in members.columns if c not in ("label", "n_labels")]
    named = members.select(*columns).join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    named = named.select(*columns, F.coalesce("label", "doc").alias("label"))
    parts = named.groupBy("key").agg(F.count_distinct("label").alias("n_labels"), F.max("decides").alias("_any"))
    return named.join(parts.where("n_labels > 1 and _any").drop("_any"), "key")


def _slots(strips: np.ndarray) -> np.ndarray:
    return (mix(strips ^ _FOLD) % np.uint64(SLOTS)).astype(np.int64)


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        flat = batch.column("strips").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        counts += np.bincount(_slots(flat), minlength=SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "n"])


def _rare_shingles(counts, threshold: float):
    """Rows (key, doc, j, decides, n_strips, rest, label) for the rarest strips of each document that any other can share.

    ``rest`` counts the strip and all that come after it in the order.
    """
    scale = (1 - threshold) / -np.log(threshold) if threshold < 1 else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = counts.value
        for batch in batches:
            heads = zip(batch.column("doc").to_pylist(), batch.column("label").to_pylist(), strict=True)
            for (doc, label), row in zip(heads, batch.column("strips"), strict=True):
                strips = row.values.to_numpy(zero_copy_only=False).view(np.uint64)
                n, seen = len(strips), frequency[_slots(strips)]
                first = n - int(np.ceil(threshold * n - 1e-6)) + 1
                deciding = n - int(np.ceil(2 * threshold / (1 + threshold) * n - 1e-6)) + 1
                order = np.lexsort((strips, seen))[:first]
                at = np.flatnonzero(seen[order] > 1)
                keys = pa.array(strips[order[at]].view(np.int64))
                same = [np.full(len(at), doc, np.int64), np.full(len(at), np.log(n) * scale), at < deciding]
                same += [np.full(len(at), n, np.int32), (n - at).astype(np.int32), np.full(len(at), label, np.int64)]
                names = ["key", "doc", "j", "decides", "n_strips", "rest", "label"]
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, same)], names=names)

    return run


def _by_rare_shingles(crowd: DataFrame, strips: DataFrame, threshold: float) -> DataFrame:
    """Buckets (key, doc, j, decides, n_strips, rest) in which any two of ``crowd`` (doc, label) that can be linked meet.

    With all strips in one order, rarest first, documents x and y (not larger)
    at similarity t share their first common strip among the first
    |x| - ceil(t |x|) + 1 of x and the first |y| - ceil(2t / (1 + t) |y|) + 1
    of y, since they share at least t |x|, and at least t / (1 + t) (|x| + |y|).
    So a bucket holds the documents with a strip among their first ones, and
    those where it is among the fewer decide what is linked to larger ones.
    The order is by counts of strips' hashes: any order is right, and a strip
    whose hash occurs once has no partner.

    ``j`` grows with the logarithm of the size, by 1 - t where the sizes are as
    t to 1: documents further apart cannot be linked, as with similarities.
    """
    spark = crowd.sparkSession
    mine = staged(strips.join(crowd, "doc").select("doc", "label", "strips"), "crowd-strips")
    counted = mine.select("strips").mapInArrow(_count_slots, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(SLOTS, np.int64)
    counted = counted.toArrow()  # SLOTS rows at most
    counts[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    run = _rare_shingles(spark.sparkContext.broadcast(counts), threshold)
    rows = mine.mapInArrow(run, "key bigint, doc bigint, j double, decides boolean, n_strips int, rest int, label bigint")
    # Few strips are shared by several components; and a member needs a partner in the bucket with which it can share enough.
    ends = rows.groupBy("key").agg(
        F.min("label").alias("_a"), F.max("label").alias("_b"), F.max("decides").alias("_any"), F.min("n_strips").alias("_least")
    )
    partner = F.greatest(F.col("_least"), threshold * F.col("n_strips"))
    enough = F.col("rest") >= threshold / (1 + threshold) * (F.col("n_strips") + partner) - 1e-6
    shared = rows.join(ends.where("_a < _b and _any").select("key", "_least"), "key").where(enough).drop("_least")
    return staged(shared.drop("label"), "rare")


def drop_near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs``, same columns, with one document of each class: the one of the smallest id.

    Of rows with the same id the one of the smallest text hash stays. Rows
    with a null id stay.
    """
    classes = staged(near_duplicates(docs, threshold), "classes")
    dropped = classes.where(~F.col("kept")).select(F.col("doc_id").alias("_dropped_id")).distinct()
    left = docs.join(dropped, docs["doc_id"] == dropped["_dropped_id"], "left_anti")
    repeated = classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return left
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    columns = [left[c] for c in docs.columns]
    ranked = left.select(*columns, order.alias("_rank_of_id"))
    return ranked.where((F.col("_rank_of_id") == 1) | F.col("doc_id").isNull()).drop("_rank_of_id")
