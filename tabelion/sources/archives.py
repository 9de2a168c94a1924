"""ZIP archives of registry extracts: list members, expand them to lines, check extraction.

A ZIP member is one deflate stream and cannot be split, so the unit of
parallelism is the member: members are range-partitioned, a task for each. Inside a task the archive is opened through ``pyarrow.fs`` (random access)
and the member is streamed in fixed-size chunks, so it is never held whole in
memory; lines are handed back to Spark as Arrow batches. Parsing the lines into
columns then happens in the JVM (``registry.parse_lines``). An archive or member
that cannot be read gives a row with its error, and the others go on.
"""

from __future__ import annotations

import hashlib
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion import schemas
from tabelion.session import scratch_path, ship_package
from tabelion.sources import fs
from tabelion.sources.records import MAX_LINES
from tabelion.sources.registry import list_extracts

CHUNK_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 65536
#: What a damaged archive or member raises.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, OSError, ValueError, NotImplementedError, RuntimeError)

LINES_SCHEMA = "archive string, entry string, line_no long, line string, error string"
MANIFEST_SCHEMA = "path string, archive string, entry string, compressed_bytes long, uncompressed_bytes long, version string, error string"
BUILD_SCHEMA = "archive string, entry string, entry_bytes long"

# Archive names the registry publishes per table (fixed values); main tables
# come in ten numbered parts.
ARCHIVE_NAMES = {
    "cnae": "Cnaes",
    "empresas": "Empresas",
    "estabelecimento": "Estabelecimentos",
    "motivo": "Motivos",
    "municipio": "Municipios",
    "natureza_juridica": "Naturezas",
    "pais": "Paises",
    "qualificacao_socio": "Qualificacoes",
    "simples": "Simples",
    "socios_original": "Socios",
}
NUMBERED = ("empresas", "estabelecimento", "socios_original")


def _lines_batch(archive: str, entry: str, numbers: list[int], lines: list[str | None], error: str | None = None):
    n = len(lines)
    return pa.record_batch(
        [
            pa.array([archive] * n, pa.string()),
            pa.array([entry] * n, pa.string()),
            pa.array(numbers, pa.int64()),
            pa.array(lines, pa.string()),
            pa.array([error] * n, pa.string()),
        ],
        names=["archive", "entry", "line_no", "line", "error"],
    )


def _member_lines(archive: str, entry: str, member) -> Iterator[pa.RecordBatch]:
    """Stream one member as Latin-1 records: lines, or several joined where a quoted field has line breaks.

    Blank lines are skipped, numbering counts them; a record has its first
    line's number. What ``records.joined_records`` does with records of very
    many lines is done here, too.
    """
    rest, line_no = b"", 0
    pieces: list[str] = []  # of a record that is open
    size = 0  # lines of it
    lines: list[str] = []
    numbers: list[int] = []
    while True:
        chunk = member.read(CHUNK_BYTES)
        data = rest + chunk
        cut = data.rfind(b"\n") if chunk else len(data)
        if cut < 0:
            rest = data
            continue
        if chunk or data:
            for text in data[:cut].decode("latin-1").split("\n"):
                line_no += 1
                odd = text.count('"') % 2 == 1
                if size or odd:
                    size += 1
                    pieces.append(text)
                    if odd and size > 1 and size <= MAX_LINES:
                        done, size = ["\n".join(pieces)], 0
                    elif size > MAX_LINES:
                        done = [x if x.count('"') % 2 else '"' + x for x in pieces]
                        size = 0 if odd else size
                    else:
                        continue
                    at, pieces = line_no - len(pieces) + 1, []
                else:
                    done, at = [text], line_no
                for x in done:
                    if (x := x.rstrip("\r")).strip(" \t"):
                        lines.append(x)
                        numbers.append(at)
                    at += 1
        if not chunk and pieces:  # never closed
            lines.append("\n".join(pieces).rstrip("\r"))
            numbers.append(line_no - len(pieces) + 1)
        rest = data[cut + 1 :]
        if lines and (not chunk or len(lines) >= BATCH_ROWS):
            yield _lines_batch(archive, entry, numbers, lines)
            lines, numbers = [], []
        if not chunk:
            return


def _archive_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


class ReplacedArchive(OSError):
    """An archive is not the file any more whose members were listed."""


def _version(filesystem, path: str) -> str:
    info = filesystem.get_file_info(path)
    return f"{info.size}:{info.mtime_ns}"


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, entry, version in zip(*(b.column(c).to_pylist() for c in ("path", "entry", "version"))):
            archive = _archive_name(path)
            try:
                filesystem, p = fs.resolve(path)
                with filesystem.open_input_file(p) as raw, zipfile.ZipFile(raw) as z, z.open(entry) as member:
                    yield from _member_lines(archive, entry, member)
                if _version(filesystem, p) != version:
                    raise ReplacedArchive("the archive was replaced after its members were listed")
            except BROKEN as e:
                yield _lines_batch(archive, entry, [0], [None], f"{type(e).__name__}: {e}")


def _manifest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for path in b.column("path").to_pylist():
            try:
                filesystem, p = fs.resolve(path)
                version = _version(filesystem, p)
                with filesystem.open_input_file(p) as raw, zipfile.ZipFile(raw) as z:
                    found = [(i.filename, i.compress_size, i.file_size, version, None) for i in z.infolist() if not i.is_dir()]
            except BROKEN as e:
                found = [(None, None, None, None, f"{type(e).__name__}: {e}")]
            rows += [(path, _archive_name(path), *x) for x in found]
        columns = list(zip(*rows)) or [()] * 7
        types = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string()] * 2
        names = ["path", "archive", "entry", "compressed_bytes", "uncompressed_bytes", "version", "error"]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def list_members(spark: SparkSession, folder: str) -> DataFrame:
    """path, archive, entry, sizes of every member (central directories only); unreadable archives have an error."""
    ship_package(spark)
    listing = list_extracts(spark, folder, "*.zip").select("path")
    tasks = max(1, spark.sparkContext.defaultParallelism)
    return listing.repartition(tasks, "path").mapInArrow(_manifest, MANIFEST_SCHEMA)


def fixed_members(spark: SparkSession, folder: str) -> DataFrame:
    """``list_members`` as found now: written once, so every archive is opened once and all readers see the same members."""
    path = scratch_path(spark, "members", uuid.uuid4().hex)
    list_members(spark, folder).write.parquet(path)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def expand_members(members: DataFrame) -> DataFrame:
    """Every line of the given members (path, entry, version; read twice), one member per task.

    A member that breaks off, or whose archive is of another version when it
    is read, gives a row with its error beside the lines read.
    """
    readable = members.filter(F.col("entry").isNotNull()).select("path", "entry", "version")
    n = max(1, readable.count())
    return readable.repartitionByRange(n, "path", "entry").mapInArrow(_expand, LINES_SCHEMA)


def archive_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every member of every ``*.zip`` under ``folder``."""
    return expand_members(fixed_members(spark, folder))


def archive_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per member of a readable archive: archive, entry, compressed and uncompressed bytes."""
    members = list_members(spark, folder).filter(F.col("entry").isNotNull())
    return members.select("archive", "entry", "compressed_bytes", "uncompressed_bytes")


def archive_errors(spark: SparkSession, folder: str) -> DataFrame:
    """archive, error of the archives that cannot be opened."""
    return list_members(spark, folder).filter(F.col("error").isNotNull()).select("archive", "error")


def archive_sizes(manifest: DataFrame) -> DataFrame:
    """Members and uncompressed bytes per archive."""
    return manifest.groupBy("archive").agg(
        F.count(F.lit(1)).alias("n_entries"), F.sum("uncompressed_bytes").cast("long").alias("uncompressed_bytes")
    )


def entry_status(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Per archive: members, members already present in the output folder, and whether all are.

    ``present`` is a file listing with column ``file_name``.
    """
    hits = present.select(F.col("file_name").alias("entry")).distinct().withColumn("_hit", F.lit(1))
    joined = manifest.join(hits, "entry", "left")
    return joined.groupBy("archive").agg(
        F.count(F.lit(1)).alias("n_entries"), F.count("_hit").alias("n_present")
    ).withColumn("all_present", F.col("n_entries") == F.col("n_present"))


def missing_entries(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Members not present in the output folder (set difference, no duplicates)."""
    listed = manifest.select("archive", "entry")
    there = manifest.join(present.select(F.col("file_name").alias("entry")), "entry", "left_semi").select(
        "archive", "entry"
    )
    return listed.subtract(there)


def _zip_files(root: str):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.resolve(root)
        # Gather the task's (archive, path) pairs first: an archive's files may
        # span several input batches and each archive must be written once.
        grouped: dict[str, list[str]] = {}
        for b in batches:
            for archive, path in zip(b.column("archive").to_pylist(), b.column("path").to_pylist()):
                grouped.setdefault(archive, []).append(path)
        out = {"archive": [], "entry": [], "entry_bytes": []}
        for archive, paths in sorted(grouped.items()):
            with filesystem.open_output_stream(f"{base}/{archive}") as sink:
                with zipfile.ZipFile(sink, "w", compression=zipfile.ZIP_DEFLATED) as z:
                    for path in sorted(paths):
                        src_fs, src = fs.resolve(path)
                        name = path.rsplit("/", 1)[-1]
                        size = 0
                        with src_fs.open_input_stream(src) as inp, z.open(name, "w", force_zip64=True) as dst:
                            while True:
                                chunk = inp.read(CHUNK_BYTES)
                                if not chunk:
                                    break
                                dst.write(chunk)
                                size += len(chunk)
                        out["archive"].append(archive)
                        out["entry"].append(name)
                        out["entry_bytes"].append(size)
        yield pa.RecordBatch.from_pydict(
            out, schema=pa.schema([("archive", pa.string()), ("entry", pa.string()), ("entry_bytes", pa.int64())])
        )

    return build


def archive_of(file_name) -> F.Column:
    """Registry archive name of an extract file name."""
    parts = []
    for table, label in ARCHIVE_NAMES.items():
        s = schemas.spec(table)
        hit = F.col(file_name).contains(s.suffix) if table == "simples" else F.col(file_name).endswith(s.suffix)
        if table in NUMBERED:
            digit = F.regexp_extract(F.col(file_name), r"Y(\d)(?:P\d+)?\.", 1)
            parts.append((hit, F.concat(F.lit(label), digit, F.lit(".zip"))))
        else:
            parts.append((hit, F.lit(f"{label}.zip")))
    expr = F.when(parts[0][0], parts[0][1])
    for cond, val in parts[1:]:
        expr = expr.when(cond, val)
    return expr


def build_archives(spark: SparkSession, extracts_folder: str, root: str, archive: F.Column | None = None) -> DataFrame:
    """Pack files into archives under ``root``, by default the registry's; an archive is written by one task."""
    fs.makedirs(root)
    ship_package(spark)
    files = list_extracts(spark, extracts_folder).withColumn(
        "archive", archive_of("file_name") if archive is None else archive
    )
    files = files.filter(F.col("archive").isNotNull()).repartition(
        max(1, spark.sparkContext.defaultParallelism), "archive"
    )
    return files.select("archive", "path").mapInArrow(_zip_files(root), BUILD_SCHEMA)


def archives_for(spark: SparkSession, sf_dir: str, landing_root: str) -> str:
    """Archive folder built from the landing extracts, once per session."""
    key = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    root = scratch_path(spark, "archives", key)
    if fs.exists(f"{root}/_READY"):
        return root
    build_archives(spark, landing_root, root).write.format("noop").mode("overwrite").save()
    fs.touch(f"{root}/_READY")
    return root
