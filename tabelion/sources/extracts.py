"""Registry-format writer: DataFrames to headerless ``;`` Latin-1 extract files.

Rows are routed to files by a name column (``partitionBy``) and the parts are
then renamed to the registry file name. A name whose rows are spread over
several tasks gives several files, numbered in the second dot-separated part,
so no file has to pass through one task. Renames are metadata operations on
the driver; the bytes are written by the executors.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion import fixtures as fx
from tabelion import schemas
from tabelion.session import open_files, scratch_path
from tabelion.sources import fs
from tabelion.sources.records import odd_quotes
from tabelion.sources.registry import LINE_WRITE_OPTIONS, WRITE_OPTIONS

READY = "_READY"


def pad_to_spec(df: DataFrame, table: str) -> DataFrame:
    """All columns of the table in file order; columns the frame lacks become ''."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit("")).alias(c) for c in schemas.spec(table).names])


def registry_line(table: str) -> Column:
    """One extract line of ``table``: every field quoted, quotes doubled, ``;`` between.

    The same text Spark's CSV writer produces with quoteAll; NULL is written
    as an empty unquoted field.
    """
    fields = [
        F.when(F.col(c).isNull(), F.lit("")).otherwise(
            F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
        )
        for c in schemas.spec(table).names
    ]
    return F.concat_ws(";", *fields)


def write_extracts(df: DataFrame, root: str, names: Column, order: list[str] | None = None) -> list[str]:
    """Write ``df`` as registry files under ``root``; ``names`` is each row's file name."""
    routed = df.withColumn("_file", names).repartition("_file")
    if order:
        routed = routed.sortWithinPartitions(*order)
    return _write_routed(routed, root, WRITE_OPTIONS)


#: Lines that a file holds, at most about; a name with more is written in several files.
LINES_PER_FILE = 2_000_000
#: Lines up to which a name's are shuffled to be ordered by key; those of a larger name stay where they are read.
LINES_DEALT = 500_000
#: Names that a task writes to at once without sorting its lines by them.
OPEN_NAMES = 64


def write_lines(lines: DataFrame, root: str, parts: int = 1, breaks: bool = False) -> list[str]:
    """Write preformatted lines (columns ``_file``, ``_key``, ``line``) as registry files, one or two jobs after a count per name.

    A name of more than ``LINES_DEALT`` lines is written by the tasks that
    read it, in files of ``LINES_PER_FILE`` at most: its lines are neither
    shuffled nor sorted. Names of fewer lines, or that are to have ``parts``,
    are dealt by the hash of their lines and ordered by ``_key``; small ones
    share tasks. With ``breaks``, lines may hold line breaks, which the CSV
    writer would quote. A quote that is never closed takes in the lines after
    it, so such lines are dealt, too, with about ``LINES_DEALT`` others of
    their name: they end a file if their keys are the last.
    """
    name = F.coalesce("_file", F.lit(""))
    unclosed = F.sum(odd_quotes("line")) if breaks else F.lit(0)
    found = lines.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"), unclosed.alias("n_unclosed")).collect()  # a row a name
    counts, written = {r.name: r.n for r in found}, []
    most = min(LINES_DEALT, LINES_PER_FILE)
    large = [] if parts > 1 else sorted(n for n, c in counts.items() if c > most)
    files: dict[str, int] = {}
    options, kind = ({"lineSep": "\n"}, "text") if breaks else (LINE_WRITE_OPTIONS, "csv")
    text = F.encode("line", "ISO-8859-1").cast("string").alias("value") if breaks else F.col("line")
    if large:
        shares = {n: -(-c // most) for n, c in counts.items() if n in large}
        here, counts = name.isin(large), {n: c for n, c in counts.items() if n not in large}
        apart, rest = lines.where(here), lines.where(~here)
        if breaks:
            of_share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), name)
            stays = (odd_quotes("line") == 0) & (F.pmod(F.xxhash64("line"), of_share) != 0)
            # What depends on the task is not moved below the making of the line, which would be made anew for each mention.
            stays = here & stays & (F.spark_partition_id() >= 0)
            apart, rest = apart.withColumn("_stays", stays).where("_stays"), lines.withColumn("_stays", stays).where("not _stays")
            counts |= {r.name: most + r.n_unclosed for r in found if r.name in large}
        with open_files(lines.sparkSession, OPEN_NAMES):
            written = _write_routed(apart.select("_file", text), root, options | {"maxRecordsPerFile": LINES_PER_FILE}, kind, files)
        lines = rest
    if not counts:
        return written
    slots, n_slots = _slots(counts, parts, lines.sparkSession.sparkContext.defaultParallelism)
    of_name = F.element_at(F.create_map(*[F.lit(x) for pair in slots.items() for x in pair]), name)
    part = F.pmod(F.xxhash64("line"), F.size(of_name)).cast("int")
    routed = lines.select("*", F.element_at(of_name, part + 1).alias("_slot"))
    routed = routed.repartitionById(n_slots, "_slot").sortWithinPartitions("_file", "_key")
    return sorted(written + _write_routed(routed.select("_file", text), root, options, kind, files))


def _slots(counts: dict[str, int], parts: int, tasks: int) -> tuple[dict[str, list[int]], int]:
    """The task of each part of a name, and how many tasks there are; two parts of a name never share one."""
    full = min(LINES_PER_FILE, -(-sum(counts.values()) // max(1, tasks)))
    slots: dict[str, list[int]] = {}
    at, held, last = 0, 0, None
    for name, n in sorted(counts.items()):
        of_name = max(parts, -(-n // LINES_PER_FILE))
        for _ in range(of_name):
            if held and (name == last or held + n / of_name > full):
                at, held = at + 1, 0
            slots.setdefault(name, []).append(at)
            held, last = held + n / of_name, name
    return slots, at + 1


def _write_routed(routed: DataFrame, root: str, options: dict, kind: str = "csv", files: dict[str, int] | None = None) -> list[str]:
    """Write lines as files under the names in ``_file``; ``files`` has how many a name has so far, and gets those added."""
    files = {} if files is None else files
    tag = f"_staging_{uuid.uuid4().hex}"
    routed.write.partitionBy("_file").options(**options).format(kind).save(f"{root}/{tag}")
    filesystem, base = fs.resolve(root)
    by_name: dict[str, list[str]] = {}
    for path in fs.list_files(f"{root}/{tag}"):
        parent, leaf = path.rsplit("/", 2)[-2:]
        if parent.startswith("_file=") and leaf.startswith("part-"):
            by_name.setdefault(parent[len("_file="):], []).append(path)
    written = []
    for name, parts in sorted(by_name.items()):
        for i, part in enumerate(sorted(parts), files.get(name, 0)):
            pieces = name.split(".")
            if i:
                pieces[min(1, len(pieces) - 1)] += f"P{i}"
            target = ".".join(pieces)
            filesystem.move(part, f"{base}/{target}")
            written.append(target)
        files[name] = files.get(name, 0) + len(parts)
    return written


def extract_of(file_name: Column) -> Column:
    """The name of the extract that a file holds, or holds a further part (``P1``, ``P2``, ...) of."""
    return F.regexp_replace(file_name, r"^([^.]*\.[^.]*?)P\d+\.", "$1.")


def by_extract(figures: DataFrame, column: str = "file_name") -> DataFrame:
    """Figures per file (its long columns) added up per extract."""
    sums = [c for c, kind in figures.dtypes if kind == "bigint"]
    keys = [c for c in figures.columns if c not in sums]
    whole = figures.withColumn(column, extract_of(F.col(column))).groupBy(*keys)
    return whole.agg(*[F.sum(c).alias(c) for c in sums])


def reference_tag(spark: SparkSession, sf_dir: str) -> str:
    """Extract date tag ``DYMMDD`` from the latest order date (the snapshot the extracts stand for)."""
    orders = fx.source(spark, sf_dir, "orders")
    d = F.max(F.col("o_orderdate").cast("date"))
    tag = orders.agg(F.concat(F.lit("D"), F.substring(F.date_format(d, "yyyy"), 4, 1), F.date_format(d, "MMdd"))).first()[0]
    return tag


def extract_name(table: str, tag: str) -> Column:
    """Registry-style file name per row: main tables split by the key's last digit."""
    suffix = schemas.spec(table).suffix
    if table in ("empresas", "estabelecimento", "socios_original"):
        return F.concat(F.lit("K3241.K03200Y"), F.substring("cnpj_basico", -1, 1), F.lit(f".{tag}{suffix}"))
    if table == "simples":
        return F.lit(f"F.K03200W{suffix}.{tag}")
    return F.lit(f"F.K03200Z.{tag}{suffix}")


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder with registry extracts of every base table, written once per session."""
    key = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    root = scratch_path(spark, "landing", key)
    if fs.exists(f"{root}/{READY}"):
        return root
    fs.makedirs(root)
    tag = reference_tag(spark, sf_dir)
    frames = []
    for table in schemas.BASE_TABLES:
        rows = pad_to_spec(fx.registry_view(spark, sf_dir, table), table)
        key_col = "codigo" if schemas.spec(table).is_code else "cnpj_basico"
        frames.append(
            rows.select(
                extract_name(table, tag).alias("_file"), F.col(key_col).alias("_key"), registry_line(table).alias("line")
            )
        )
    lines = frames[0]
    for f in frames[1:]:
        lines = lines.unionByName(f)
    write_lines(lines, root)  # all tables together
    fs.touch(f"{root}/{READY}")
    return root
