"""Merkle fixity audit of WARC replicas.

Records are hashed where they lie; only their digests, sizes and ids move. An
archive's records, in offset order, are the leaves of a tree: each node hashes
the offset ranges and digests of ``FANOUT`` consecutive children. Two replicas
are compared from the archive roots down, and only the children of differing
nodes are looked at, until the differing records are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabelion.llm.common import staged
from tabelion.operators.numbering import row_number_within

RECORDS_PER_ARCHIVE = 1000
FANOUT = 10


def warc_record(record_id: Column, uri: Column, body: Column) -> Column:
    """The text of a WARC/1.0 response record; null parts are empty."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def record_digests(pages: DataFrame, body: Column | None = None) -> DataFrame:
    """page_id, own (digest of the page as given), n_bytes and digest of its WARC record with ``body``."""
    given = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    record = given if body is None else warc_record(F.col("page_id"), F.col("url"), body)
    return pages.select(
        "page_id",
        F.sha2(given, 256).alias("own"),
        F.octet_length(record).cast("long").alias("n_bytes"),
        F.sha2(record, 256).alias("digest"),
    )


def archive_index(digests: DataFrame, records_per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """(page_id, n_bytes, digest) laid out in archives: plus archive, ordinal, record_start, record_end.

    Records are ordered by id (null first), then digest, and numbered over
    balanced ranges, so repeated ids do not fill one archive.
    """
    ordered = digests.withColumn("one", F.lit(1)).withColumn("place", F.struct("page_id", "digest"))
    numbered = row_number_within(ordered, "one", "place", out="rn").withColumn("rn", F.col("rn").cast("long") - 1)
    placed = numbered.select(
        "page_id",
        "n_bytes",
        "digest",
        F.floor(F.col("rn") / records_per_archive).alias("archive"),
        F.pmod("rn", F.lit(records_per_archive)).cast("long").alias("ordinal"),
    )
    so_far = Window.partitionBy("archive").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("n_bytes").over(so_far)
    return placed.withColumn("record_end", end).withColumn("record_start", F.col("record_end") - F.col("n_bytes"))


def tree_levels(leaves: DataFrame, fanout: int = FANOUT, records_per_archive: int = RECORDS_PER_ARCHIVE) -> list[DataFrame]:
    """Levels of (archive, node, range_start, range_end, digest), the leaves first, the archives' roots last.

    A node's digest covers the ranges and digests of its children in order.
    """
    level = leaves.select(
        "archive",
        F.col("ordinal").alias("node"),
        F.col("record_start").alias("range_start"),
        F.col("record_end").alias("range_end"),
        "digest",
    )
    levels, width = [level], records_per_archive
    while width > 1:
        width = -(-width // fanout)
        child = F.struct("node", F.concat_ws(":", "range_start", "range_end", "digest").alias("entry"))
        level = (
            level.groupBy("archive", F.floor(F.col("node") / fanout).alias("parent"))
            .agg(
                F.min("range_start").alias("range_start"),
                F.max("range_end").alias("range_end"),
                F.array_sort(F.collect_list(child)).alias("children"),
            )
            .select(
                "archive",
                F.col("parent").alias("node"),
                "range_start",
                "range_end",
                F.sha2(F.array_join(F.transform("children", lambda c: c["entry"]), "\n"), 256).alias("digest"),
            )
        )
        levels.append(level)
    return levels


def differing_leaves(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """archive, node, verdict, theirs (range_start, range_end, digest in b) of the leaves that differ.

    The verdict is altered, missing (in b) or extra (in b).
    """
    suspects = None
    for mine, theirs in zip(reversed(a), reversed(b), strict=True):
        if suspects is not None:
            parent = lambda df: df.withColumn("parent", F.floor(F.col("node") / fanout))
            mine, theirs = (parent(x).join(suspects, ["archive", "parent"], "left_semi") for x in (mine, theirs))
        m = mine.select("archive", "node", F.struct("range_start", "range_end", "digest").alias("mine"))
        t = theirs.select("archive", "node", F.struct("range_start", "range_end", "digest").alias("theirs"))
        differ = m.join(t, ["archive", "node"], "full").where(~F.col("mine").eqNullSafe(F.col("theirs")))
        suspects = staged(differ.select("archive", F.col("node").alias("parent"), "mine", "theirs"), "suspects")
        leaves, suspects = suspects, suspects.select("archive", "parent")
    verdict = (
        F.when(F.col("theirs").isNull(), "missing").when(F.col("mine").isNull(), "extra").otherwise("altered")
    )
    return leaves.select("archive", F.col("parent").alias("node"), verdict.alias("verdict"), "theirs")


def audit(index: DataFrame, replica: DataFrame, fanout: int = FANOUT, per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """``index`` (archive, ordinal, record_start, record_end, digest, ...) plus archive_root and verdict.

    ``replica`` holds (archive, ordinal, record_start, record_end, digest) as
    read from the other copy; records that it lost are absent. Verdict of each
    row of the index: intact, altered or missing. Each record that only the
    replica has, be it in a known archive or not, is a further row, extra: place
    and digest as read, the index's other columns null, archive_root null if
    the index lacks the archive.

    Nulls: null digests and offsets are values like others; a record without
    a place (null archive or ordinal) is missing if the index has it and extra
    if the replica has it. Repeated rows of the replica count once; several
    different records at one place are altered if any differs from the index.
    Each row of the index comes back, equal ones too. Columns of the index named
    archive_root or verdict give way to the result's; any other name is kept.
    An empty index makes all records extra, an empty replica all missing.
    """
    index = index.drop("archive_root", "verdict")
    there = F.col("archive").isNotNull() & F.col("ordinal").isNotNull()
    mine, theirs = (tree_levels(x.where(there), fanout, per_archive) for x in (index, replica))
    # Every level is compared once and the next is built on it: write the inner ones.
    mine, theirs = ([x[0], *[staged(y, "tree") for y in x[1:]]] for x in (mine, theirs))
    found = staged(differing_leaves(mine, theirs, fanout), "found")

    differ = found.where("verdict != 'extra'").select("archive", F.col("node").alias("ordinal"), "verdict").distinct()
    marked = index.join(differ, ["archive", "ordinal"], "left").withColumn(
        "verdict", F.when(there, F.coalesce("verdict", F.lit("intact"))).otherwise("missing")
    )
    extra = found.where("verdict = 'extra'").select(
        "archive",
        F.col("node").alias("ordinal"),
        F.col("theirs.range_start").alias("record_start"),
        F.col("theirs.range_end").alias("record_end"),
        F.col("theirs.digest").alias("digest"),
    )
    extra = extra.union(replica.where(~there).select(*extra.columns)).distinct().withColumn("verdict", F.lit("extra"))
    rows = marked.unionByName(extra, allowMissingColumns=True)
    roots = mine[-1].where("node = 0").select("archive", F.col("digest").alias("archive_root"))
    return rows.join(roots, "archive", "left").select(*index.columns, "archive_root", "verdict")
