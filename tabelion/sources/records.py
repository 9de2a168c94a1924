"""Records of several lines: fields whose text has line breaks, put together again from the lines of a splittable scan.

A line with an odd number of quotes opens a quoted field or closes one. Quotes
are counted per file split and summed over the splits before, which tells for
every line whether it begins inside a field; the lines from an opening to a
closing one are a record. Files stay splittable, and files without such lines
(nearly all) are not touched.

The lines of a split lie together in order, so a task joins the records of its
splits as it reads them: no line is shuffled, sorted or written. Only the lines
with which a split begins or ends inside a field are put aside, and joined from
split to split.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabelion.session import scratch_path, ship_package
from tabelion.sources import fs

#: Lines of a record beyond which it cannot be stored: its lines are rejects, each by itself.
MAX_LINES = 4096
LINE = "line"
QUOTE = '"'
LEAST_SPLITS = "spark.sql.files.minPartitionNum"

_CUT: dict[tuple, list[str]] = {}


def odd_quotes(line) -> Column:
    """1 where a line holds an odd number of quotes, else 0."""
    c = F.col(line) if isinstance(line, str) else line
    return F.coalesce((F.octet_length(c) - F.octet_length(F.replace(c, F.lit(QUOTE), F.lit("")))) % 2, F.lit(0))


def raw_lines(spark: SparkSession, paths) -> DataFrame:
    """file_name, file_path, block (where the file's split starts), at (order within it), value (the line's bytes as text)."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def steady(spark: SparkSession) -> SparkSession:
    """A session with this one's settings that splits files the same way at every read, whatever the cores are by then."""
    to_frame = RDD.toDF
    own = spark.newSession()
    RDD.toDF = to_frame  # the new session takes it
    for r in spark.sql("SET").collect():
        if r.key.startswith("spark.sql.") and own.conf.isModifiable(r.key):
            own.conf.set(r.key, r.value)
    cores = str(spark.sparkContext.defaultParallelism)
    own.conf.set(LEAST_SPLITS, spark.conf.get(LEAST_SPLITS, None) or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or cores)
    return own


def cut_files(spark: SparkSession, folder: str, wanted: Column) -> list[str]:
    """Paths of the files directly under ``folder`` in which some line has an odd number of quotes.

    ``wanted`` says of ``file_name`` whether it is of interest. A folder whose
    files are the same as before is not scanned again.
    """
    filesystem, path = fs.resolve(folder)
    found = filesystem.get_file_info(fs.pafs.FileSelector(path, recursive=False, allow_not_found=True))
    state = tuple(sorted((i.path, i.size, i.mtime_ns) for i in found if i.size))
    key = (spark.sparkContext.applicationId, folder, hash(state), len(state))
    if key not in _CUT:
        lines = raw_lines(spark, folder).where(wanted).groupBy("file_path").agg(F.max(odd_quotes("value")).alias("odd"))
        _CUT[key] = [r.file_path for r in lines.where("odd = 1").select("file_path").collect()] if state else []
    return _CUT[key]


class SplitsChanged(RuntimeError):
    """A file, or how it is split, is not as it was when its quotes were counted."""


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, np.ndarray]]:
    """The split (file columns and block), the lines, and 1 for each line of an odd number of quotes, of rows that lie together."""
    for b in batches:
        if not b.num_rows:
            continue
        keys, lines = b.columns[:-1], pc.fill_null(b.columns[-1].cast(pa.string()), "")
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) & 1
        new = np.zeros(b.num_rows - 1, dtype=bool)
        for c in keys:
            new |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            yield tuple(c[at].as_py() for c in keys), lines[at:end], odd[at:end]


def _split_ends(schema: pa.Schema, max_lines: int) -> Callable:
    """For each split its lines, its odd ones, and the lines up to the first odd one and from the last one on.

    These lines are what the split begins and ends with inside a field, if it
    does; their text is NULL if they are over ``max_lines``.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, parts in groupby(_stretches(batches), key=itemgetter(0)):
            n = n_odd = n_head = n_tail = 0
            head: list[str] = []
            tail: list[str] = []
            for _, lines, odd in parts:
                at = np.flatnonzero(odd)
                if not n_odd:
                    more = lines[: at[0] + 1] if len(at) else lines
                    n_head += len(more)
                    head = head + more.to_pylist() if n_head <= max_lines else []
                if len(at):
                    tail, n_tail = [], 0
                if n_odd or len(at):
                    more = lines[at[-1] :] if len(at) else lines
                    n_tail += len(more)
                    tail = tail + more.to_pylist() if n_tail <= max_lines else []
                n, n_odd = n + len(lines), n_odd + len(at)
            texts = ["\n".join(x) if size <= max_lines else None for x, size in ((head, n_head), (tail, n_tail))]
            row = (*split, n, n_odd, n_head, texts[0], n_tail, texts[1])
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return ends


def _rejected(lines: pa.Array, odd: np.ndarray) -> pa.Array:
    """The lines with an odd number of quotes each."""
    return pc.if_else(pa.array(odd == 1), lines, pc.binary_join_element_wise(pa.scalar(QUOTE), lines, pa.scalar("")))


def _split_records(splits: dict[tuple, tuple[int, int, int]], schema: pa.Schema, max_lines: int) -> Callable:
    """The records that lie within a split, and the lines of those that are too long.

    ``splits``: for each split whether it begins inside a field, its lines and
    its odd ones. Lines with which it begins or ends inside a field, up to
    ``max_lines``, are left to ``_over_splits``.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, parts in groupby(_stretches(batches), key=itemgetter(0)):
            if split not in splits:
                raise SplitsChanged(f"{split} was not counted")
            inside, *counted = splits[split]
            found = [0, 0]
            aside = bool(inside)  # the open record, if any, began in a split before
            dropped = False  # the open record is too long: its lines are given out by themselves
            held, held_odd = pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
            for _, lines, odd in parts:
                found = [found[0] + len(lines), found[1] + int(odd.sum())]
                lines, odd = pa.concat_arrays([held, lines]), np.concatenate([held_odd, odd])
                after = (inside + np.cumsum(odd)) & 1
                alone = (after == 0) & (odd == 0)
                out = [lines.filter(pa.array(alone))]
                rows = np.flatnonzero(~alone)
                texts, odds = lines.take(pa.array(rows)), odd[rows]
                starts = np.flatnonzero((after[rows] == 1) & (odds == 1))
                if inside and len(rows):
                    starts = np.concatenate([[0], starts])
                sizes = np.diff(np.append(starts, len(rows)))
                n, is_open = len(sizes), bool(after[-1])
                whole, single = sizes <= max_lines, sizes > max_lines
                if n and inside:
                    single[0] |= dropped
                    whole[0] &= not (aside or dropped)
                held, held_odd = lines[:0], odd[:0]
                if n and is_open:
                    aside, dropped = aside and bool(inside) and n == 1, bool(single[-1])
                    if not dropped:
                        held, held_odd = texts[int(starts[-1]) :], odds[int(starts[-1]) :]
                        whole[-1] = False
                    # What is held is looked at again as part of the next lines, from where it began.
                    inside = int(dropped or aside)
                else:
                    aside = dropped = False
                    inside = 0
                ends = np.append(starts, len(rows)).astype(np.int32)
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), texts), "\n") if n else texts
                out.append(records.filter(pa.array(whole)) if n else texts)
                mask = np.repeat(single, sizes)
                out.append(_rejected(texts.filter(pa.array(mask)), odds[mask]))
                lines = pa.concat_arrays(out)
                if len(lines):
                    files = [pa.repeat(pa.scalar(v, f.type), len(lines)) for v, f in zip(split, list(schema)[:-1])]
                    yield pa.record_batch([*files, lines], schema=schema)
            if found != counted:
                raise SplitsChanged(f"{split} has {found[0]} lines now, it had {counted[0]}")

    return joined


def _over_splits(splits: DataFrame, file_cols: list[str], max_lines: int) -> DataFrame:
    """The records of which a split has a part only, of some lines a split: ``file_cols`` and ``line``."""
    ends = F.array(
        F.struct((F.col("_carry") == 1).alias("_is"), F.lit(0).alias("_at"), F.col("_n_head").alias("_n"), F.col("_head").alias("_text")),
        F.struct(
            ((F.col("_odd") > 0) & ((F.col("_carry") + F.col("_odd")) % 2 == 1)).alias("_is"),
            F.lit(1).alias("_at"), F.col("_n_tail").alias("_n"), F.col("_tail").alias("_text"),
        ),
    )
    pieces = splits.select(*file_cols, "block", F.inline(ends)).where("_is")
    so_far = Window.partitionBy(*file_cols).orderBy("block", "_at").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("_record", F.sum("_at").over(so_far))
    of_record = pieces.groupBy(*file_cols, "_record").agg(
        F.sum("_n").alias("_size"), F.sort_array(F.collect_list(F.struct("block", "_at", "_text"))).alias("_pieces")
    )
    texts = F.filter(F.transform("_pieces", lambda x: x["_text"]), lambda t: t.isNotNull())
    lines = F.flatten(F.transform(texts, lambda t: F.split(t, "\n")))
    single = F.transform(lines, lambda x: F.when(odd_quotes(x) == 1, x).otherwise(F.concat(F.lit(QUOTE), x)))
    joined = F.when(F.col("_size") <= max_lines, F.array(F.array_join(texts, "\n"))).otherwise(single)
    return of_record.select(*file_cols, F.explode(joined).alias(LINE))


def joined_records(lines: DataFrame, file_cols: list[str], max_lines: int = MAX_LINES, ordered: bool = False) -> DataFrame:
    """``file_cols`` and ``line`` of every record of ``lines`` (file_cols, block, at, line), its line breaks kept.

    With ``ordered`` the lines of a block lie together in a task in their order,
    as those of a scan; they are read twice, now and when the records are, and
    must then be in the same blocks (``steady``). Other lines are dealt and sorted.

    A record of over ``max_lines`` lines is left as lines of an odd number of
    quotes each (one is put in front where there is none to spare), as is what
    an unclosed quote leaves open: neither can be taken for a record.
    """
    spark = lines.sparkSession
    if not ordered:
        lines = lines.repartition(*file_cols, "block").sortWithinPartitions(*file_cols, "block", "at")
    ship_package(spark)
    lines = lines.select(*file_cols, "block", LINE)
    files = [lines.schema[c] for c in file_cols]
    counted = [("_n", "long"), ("_odd", "long"), ("_n_head", "long"), ("_head", "string"), ("_n_tail", "long"), ("_tail", "string")]
    of_split = T.StructType([*files, lines.schema["block"], *[T.StructField(c, T.LongType() if k == "long" else T.StringType()) for c, k in counted]])
    path = scratch_path(spark, "records", uuid.uuid4().hex)
    lines.mapInArrow(_split_ends(to_arrow_schema(of_split), max_lines), of_split).write.parquet(path)
    before = Window.partitionBy(*file_cols).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = spark.read.schema(of_split).parquet(path)
    splits = splits.withColumn("_carry", F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2)

    # A later filter that fails on a reject may be run before those here, so the few records over splits are written.
    over = scratch_path(spark, "records", uuid.uuid4().hex)
    record = T.StructType([*files, T.StructField(LINE, T.StringType())])
    _over_splits(splits, file_cols, max_lines).write.parquet(over)
    rows = splits.select(*file_cols, "block", "_carry", "_n", "_odd").collect()  # one for each split, of which the driver plans a task
    states = {tuple(r)[:-3]: tuple(r)[-3:] for r in rows}
    whole = lines.mapInArrow(_split_records(states, to_arrow_schema(record), max_lines), record)
    return whole.unionByName(spark.read.schema(record).parquet(over))
