"""Line dedup by range-partitioned hashes and per-document keep bitmaps.

Each line's key is hashed to 128 bits. Hashes that occur often enough are
range-partitioned and sorted by (hash, document descending, position), so one
very common line is cut across many tasks. Each slice of a hash streams its
documents once; the slices' summaries are stitched in order. The decisions come
back as one run-length keep bitmap for each document that loses lines: run
lengths of kept and dropped lines in turn, beginning with kept ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabelion.llm.common import BLANKS, ascii_lower, staged, text_key

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text_key, n_dropped, keep_runs for the documents that lose lines.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses all its lines except those in the largest doc_id holding
    it.

    Nulls: a null or empty text is one empty line; a null id is one document,
    smaller than all others. Rows with the same id are one document when
    documents are counted, and each row has a bitmap for its own text (found
    by ``text_key``). Empty tables give no rows. Other columns are not read.
    """
    lowest = -(1 << 63)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("doc"),
        text_key(F.col("text")).alias("text_key"),
        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"),
    ).where(F.char_length("line") >= min_chars)
    keyed = lines.select("doc", "text_key", "pos", line_key(F.col("line")).alias("key")).where(
        F.char_length("key") >= min_chars
    )
    rows = staged(
        keyed.select(
            "doc", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")
        ),
        "lines",
    )
    # Few hashes occur min_docs times at all; counting them first is a map-side aggregate.
    often = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc").alias("a"), F.max("doc").alias("b"))
    often = staged(often.where((F.col("n") >= min_docs) & (F.col("a") < F.col("b"))).select("h1", "h2"), "often")
    ranged = staged(
        rows.join(often, ["h1", "h2"], "left_semi")
        .repartitionByRange(n, F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("pos"))
        .sortWithinPartitions(F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("pos"))
        .withColumn("slice", F.spark_partition_id()),
        "ranged-lines",
    )
    in_slice = Window.partitionBy("slice", "h1", "h2").orderBy(F.col("doc").desc(), "pos")
    new_doc = F.coalesce(F.lag("doc").over(in_slice) != F.col("doc"), F.lit(True))
    slices = (
        ranged.withColumn("new", new_doc.cast("long"))
        .groupBy("slice", "h1", "h2")
        .agg(F.sum("new").alias("docs"), F.max("doc").alias("first"), F.min("doc").alias("last"))
    )
    # A document cut by a slice's edge is counted in both slices.
    by_slice = Window.partitionBy("h1", "h2").orderBy("slice")
    cut = (F.lag("last").over(by_slice) == F.col("first")).cast("long")
    whole = Window.partitionBy("h1", "h2")
    stitched = (
        slices.withColumn("docs", F.col("docs") - F.coalesce(cut, F.lit(0)))
        .select("slice", "h1", "h2", F.sum("docs").over(whole).alias("docs"), F.max("first").over(whole).alias("keeper"))
        .where(F.col("docs") >= min_docs)
    )
    dropped = ranged.join(stitched, ["slice", "h1", "h2"]).where(F.col("doc") < F.col("keeper"))
    # Neighbouring dropped positions make a run; a repeated row has the same positions again.
    in_doc = Window.partitionBy("doc", "text_key").orderBy("pos")
    runs = (
        dropped.withColumn("run", F.col("pos") - F.dense_rank().over(in_doc))
        .groupBy("doc", "text_key", "run")
        .agg(F.min("pos").alias("start"), F.max("pos").alias("end"))
    )
    previous = F.coalesce(F.lag("end").over(Window.partitionBy("doc", "text_key").orderBy("start")), F.lit(-1))
    runs = runs.withColumn("kept", F.col("start") - previous - 1).withColumn("cut", F.col("end") - F.col("start") + 1)
    bitmaps = runs.groupBy("doc", "text_key").agg(
        F.sum("cut").alias("n_dropped"), F.array_sort(F.collect_list(F.struct("start", "kept", "cut"))).alias("runs")
    )
    return bitmaps.select(
        F.when(F.col("doc") != lowest, F.col("doc")).alias("doc_id"),
        "text_key",
        "n_dropped",
        F.flatten(F.transform("runs", lambda r: F.array(r["kept"], r["cut"]))).alias("keep_runs"),
    )


def kept_lines(text: Column, runs: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined; ``text`` itself where there is no bitmap."""
    drop = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 1, n)))
    left = F.zip_with(lines_of(text), drop, lambda line, d: F.when(~F.coalesce(d, F.lit(False)), line))
    return F.when(runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(left, "\n"))


def join_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, Column, Column]:
    """All rows of ``docs`` with their bitmap; the columns of lines dropped (0 if none) and of runs (null if none)."""
    b = bitmaps.select(
        F.col("doc_id").alias("_bitmap_doc"),
        F.col("text_key").alias("_bitmap_key"),
        F.col("n_dropped").alias("_bitmap_dropped"),
        F.col("keep_runs").alias("_bitmap_runs"),
    )
    own = docs["doc_id"].eqNullSafe(b["_bitmap_doc"]) & (text_key(docs["text"]) == b["_bitmap_key"])
    return docs.join(b, own, "left"), F.coalesce(b["_bitmap_dropped"], F.lit(0).cast("long")), b["_bitmap_runs"]


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs``, same columns, with the dropped lines gone from ``text`` (a text that loses none stays as it is)."""
    joined, _, runs = join_bitmaps(docs, line_bitmaps(docs, min_chars, min_docs))
    text = F.when(runs.isNull(), docs["text"]).otherwise(kept_lines(docs["text"], runs))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
