"""Registry extract reader: headerless ``;`` text, Latin-1, every column text.

* main tables keep empty fields as ``''`` (never NULL);
* code lists turn empty fields and the missing-value tokens into NULL;
* short rows are padded (``''`` / NULL); a field may have line breaks: its
  record comes back whole (``records``);
* records with too many fields or an unclosed quote are rejects: reading is
  strict by default and fails on one, naming its file; lenient reading leaves
  them out, and ``rejected_rows`` lists them;
* lines end with ``\\n`` (a trailing ``\\r`` is dropped); blank ones are skipped;
* every matching file of a table is read in one scan (several files make
  one table), with the file name kept per row for per-file counts.

The scan is a plain splittable CSV scan: parsing runs in the JVM, files split
into ``spark.sql.files.maxPartitionBytes`` chunks, and column pruning and
filters apply as for any file source. Files in which a line has an odd number
of quotes are found first, by one scan of the folder, and read apart.
"""

from __future__ import annotations

from fnmatch import fnmatchcase as fnmatch
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabelion.functions import file_name, reject_cause
from tabelion.schemas import ALL_SPECS, MISSING_TOKENS, TableSpec, spec
from tabelion.sources import fs, records

SOURCE = "source_file"
REJECT = "_reject"
LINE = "line"

# The extract is scanned as whole lines (a separator that never occurs, quoting
# off) so the Latin-1 decoding and file splitting of the CSV source apply, then
# each line is parsed in the JVM with ``from_csv``. Having the raw line lets the
# reader count fields and reject rows longer than the table.
LINE_OPTIONS = {
    "sep": "\u0000\u0001\u0002",
    "quote": "",
    "header": "false",
    "encoding": "ISO-8859-1",
    "multiLine": "false",
    "lineSep": "\n",
}
PARSE_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}

# Writing preformatted lines: one column, no quoting, Latin-1.
LINE_WRITE_OPTIONS = {
    "sep": LINE_OPTIONS["sep"],
    "quote": "",
    "header": "false",
    "encoding": "ISO-8859-1",
    "lineSep": "\n",
    "emptyValue": "",
}

WRITE_OPTIONS = {
    "sep": ";",
    "header": "false",
    "encoding": "ISO-8859-1",
    "quote": '"',
    "escape": '"',
    "quoteAll": "true",
    "lineSep": "\n",
}


class NoInputFiles(FileNotFoundError):
    pass


def _clean(s: TableSpec, c: str) -> Column:
    col = F.col(c)
    if s.is_code:
        return F.when(~col.isin(MISSING_TOKENS), col).alias(c)
    return F.coalesce(col, F.lit("")).alias(c)


def content(lines: DataFrame, line_col: str = LINE) -> DataFrame:
    """The lines that hold a record: the carriage return of a line end dropped, blank lines left out."""
    # Trimming given characters walks over the whole line, so only lines that can need it are trimmed.
    whole, line = F.coalesce(F.col(line_col), F.lit("")), F.col(line_col)
    text = F.when(whole.endswith("\r"), F.rtrim(whole, F.lit("\r"))).otherwise(whole)
    bare = F.when(line.startswith(" ") | line.startswith("\t"), F.btrim(line, F.lit(" \t"))).otherwise(line)
    return lines.withColumn(line_col, text).where(bare != "")


def scan_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Records of every file under ``folder`` whose name matches ``pattern``: a line each, or several joined by their breaks."""
    known = table_of(F.col("file_name")).isNotNull()
    cut = [p for p in records.cut_files(spark, folder, known) if fnmatch(unquote(p.rsplit("/", 1)[-1]), pattern)]
    raw = (
        spark.read.schema(T.StructType([T.StructField(LINE, T.StringType(), True)]))
        .options(**LINE_OPTIONS)
        .option("pathGlobFilter", pattern)
        .csv(folder)
    )
    if not cut:
        return content(raw.select(F.col("_metadata.file_name").alias(SOURCE), LINE))
    # The lines themselves are blanked, too: a later filter that fails on a reject may be run before this one.
    other = ~F.col("_metadata.file_path").isin(cut)
    whole = raw.where(other).select(F.col("_metadata.file_name").alias(SOURCE), F.when(other, F.col(LINE)).alias(LINE))
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias(LINE)
    lines = records.raw_lines(records.steady(spark), [unquote(p) for p in cut]).select(F.col("file_name").alias(SOURCE), "block", "at", text)
    return content(whole.unionByName(records.joined_records(lines, [SOURCE], ordered=True)))


def parse_lines(lines: DataFrame, table: str, line_col: str = LINE) -> DataFrame:
    """Parse decoded extract lines into the table's columns plus ``_reject`` (the cause, or NULL).

    Other columns of ``lines`` (file or archive names) are kept in front.
    """
    s = spec(table)
    parsed = F.from_csv(F.col(line_col), s.read_schema().simpleString(), PARSE_OPTIONS)
    extra = [c for c in lines.columns if c != line_col]
    tmp = lines.select(*extra, parsed.alias("_p"), reject_cause(line_col, len(s.names)).alias(REJECT))
    return tmp.select(*extra, "_p.*", REJECT).select(*extra, *[_clean(s, c) for c in s.names], REJECT)


def accepted(parsed: DataFrame, strict: bool, where: Column) -> DataFrame:
    """Rows without a reject cause; in strict reading the first reject fails the job, naming ``where``."""
    cause = F.col(REJECT)
    if not strict:
        return parsed.filter(cause.isNull())
    return parsed.filter(F.when(cause.isNull(), True).otherwise(F.raise_error(F.concat_ws(": ", where, cause))))


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Every extract row of ``table`` under ``folder``: source_file, columns, _reject."""
    return parse_lines(scan_lines(spark, folder, spec(table).glob), table)


def read_table(
    spark: SparkSession, folder: str, table: str, with_source: bool = False, strict: bool = True
) -> DataFrame:
    """Accepted rows of a table's extracts."""
    df = accepted(scan(spark, folder, table), strict, F.col(SOURCE))
    return df.select(*spec(table).names, *([SOURCE] if with_source else []))


def rejects(lines: DataFrame, names: list[str] | None = None) -> DataFrame:
    """table_name, file_name, cause, line of the rejects among ``lines`` (table_name, file_name, line)."""
    cause = reject_cause(LINE, width_of(F.col("table_name"), names))
    return lines.select("table_name", "file_name", cause.alias("cause"), LINE).filter(F.col("cause").isNotNull())


def tagged_lines(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """table_name, file_name, line over the extracts of several tables, one scan of the folder."""
    lines = scan_lines(spark, folder, "*").withColumn("table_name", table_of(F.col(SOURCE), names))
    lines = lines.filter(F.col("table_name").isNotNull())
    return lines.select("table_name", F.col(SOURCE).alias("file_name"), LINE)


def rejected_rows(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Rejected records per extract file and cause."""
    found = rejects(tagged_lines(spark, folder, names), names)
    return found.groupBy("table_name", "file_name", "cause").agg(F.count(F.lit(1)).alias("n_rows"))


def count_lines(lines: DataFrame, files: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Accepted and rejected rows per file; ``files`` (table_name, file_name) without any line count 0."""
    bad = reject_cause(LINE, width_of(F.col("table_name"), names)).isNotNull()
    counts = lines.groupBy("table_name", "file_name").agg(
        F.count_if(~bad).alias("n_rows"), F.count_if(bad).alias("n_rejected")
    )
    zero = F.lit(0).cast("long")
    return files.join(counts, ["table_name", "file_name"], "left").select(
        "table_name",
        "file_name",
        F.coalesce("n_rows", zero).alias("n_rows"),
        F.coalesce("n_rejected", zero).alias("n_rejected"),
    )


def table_of(file_name: Column, names: list[str] | None = None) -> Column:
    """Table whose extract suffix a file name carries (NULL for other files)."""
    specs = [spec(n) for n in (names or list(ALL_SPECS))]

    def hit(s):
        return file_name.contains(s.suffix) if s.name == "simples" else file_name.endswith(s.suffix)

    expr = F.when(hit(specs[0]), F.lit(specs[0].name))
    for s in specs[1:]:
        expr = expr.when(hit(s), F.lit(s.name))
    return expr


def width_of(table: Column, names: list[str] | None = None) -> Column:
    """Number of columns of the named table."""
    names = names or list(ALL_SPECS)
    expr = F.when(table == F.lit(names[0]), F.lit(len(spec(names[0]).names)))
    for n in names[1:]:
        expr = expr.when(table == F.lit(n), F.lit(len(spec(n).names)))
    return expr


def file_row_counts_all(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Accepted and rejected rows of every extract file of the tables, empty files included; one scan of the folder."""
    files = list_extracts(spark, folder).withColumn("table_name", table_of(F.col("file_name"), names))
    files = files.filter(F.col("table_name").isNotNull()).select("table_name", "file_name")
    return count_lines(tagged_lines(spark, folder, names), files, names)


def list_extracts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """File listing (path, file_name, size) without reading file bodies."""
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    listed = df.select("path", file_name("path").alias("file_name"), F.col("length").alias("size_bytes"))
    # Spark's sources pass over files without a byte.
    empty = [(p, p.rsplit("/", 1)[-1], 0) for p in fs.empty_files(folder) if fnmatch(p.rsplit("/", 1)[-1], pattern)]
    return listed.unionByName(spark.createDataFrame(empty, listed.schema)) if empty else listed


def find_files(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Extract files of one table; fails when there is none."""
    files = list_extracts(spark, folder, spec(table).glob).withColumn("table_name", F.lit(table))
    if files.isEmpty():
        raise NoInputFiles(f"no {spec(table).glob} file under {folder}")
    return files
