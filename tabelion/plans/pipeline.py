"""The load: code lists, main tables, derived tables, reference metadata, checks.

Order of work: state report -> counts per extract file -> six code lists ->
four main tables -> partners -> reference metadata -> integrity report. Each
load step reads every extract of its table in one scan, decides from one-row
counts whether to write, derives the computed columns on the way and writes
once, into a table declared with its widths, types, comment and layout. By
default a record that cannot be stored stops the load before anything is
written; a lenient load stores such records in ``_rejeitados``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion import schemas
from tabelion.functions import reference_date
from tabelion.operators import checks, derive
from tabelion.plans import append, expand
from tabelion.plans import tables as tb
from tabelion.session import scratch_path
from tabelion.sources import fs, registry

MAIN_ORDER = ["estabelecimento", "socios_original", "empresas", "simples"]
BUCKETED = {"empresas": "cnpj_basico", "estabelecimento": "cnpj_basico", "socios": "cnpj_basico"}
# Lookup layout for tables that are not bucketed: rows sorted on the lookup
# key, and for the larger ones each file holding a disjoint key range, so
# Parquet min/max statistics skip files and row groups.
LOOKUP_KEY = {t: "codigo" for t in schemas.CODE_TABLES} | {"simples": "cnpj_basico"}
RANGED = {"simples"}

SORTED = {
    "empresas": ["cnpj_basico", "razao_social"],
    "estabelecimento": ["cnpj_basico", "cnpj"],
    "socios": ["cnpj_basico", "cnpj", "cnpj_cpf_socio"],
}

#: Tells the partners without a head office while they are written.
WAITS = "espera"


class FolderSource:
    """Extract files in a folder (the expanded archives)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def rows(self, table: str, strict: bool = True) -> DataFrame:
        return registry.read_table(self.spark, self.folder, table, strict=strict)

    def lines(self, names: list[str]) -> DataFrame:
        """table_name, file_name, line of the tables' extracts."""
        return registry.tagged_lines(self.spark, self.folder, names)

    def files(self, names: list[str]) -> DataFrame:
        """table_name, file_name, size_bytes of the tables' extracts, from the listing."""
        files = registry.list_extracts(self.spark, self.folder)
        return files.select(registry.table_of(F.col("file_name"), names).alias("table_name"), "file_name", "size_bytes").filter(
            "table_name IS NOT NULL"
        )


class StagedSource:
    """Lines staged as Parquet by ``expand.stage_archives``; only finished members are read."""

    def __init__(self, spark: SparkSession, staged: str):
        self.spark, self.staged = spark, staged

    def rows(self, table: str, strict: bool = True) -> DataFrame:
        lines = self.lines([table]).select(F.col("file_name").alias(registry.SOURCE), "line")
        parsed = registry.accepted(registry.parse_lines(lines, table), strict, F.col(registry.SOURCE))
        return parsed.select(*schemas.spec(table).names)

    def lines(self, names: list[str]) -> DataFrame:
        lines = expand.staged_lines(self.spark, self.staged, names)
        return lines.select("table_name", F.col("entry").alias("file_name"), "line")

    def files(self, names: list[str]) -> DataFrame:
        done = expand.finished_members(self.spark, self.staged).filter(F.col("table_name").isin(names))
        return done.select("table_name", F.col("entry").alias("file_name"), F.col("uncompressed_bytes").alias("size_bytes"))


def as_source(spark: SparkSession, source) -> FolderSource | StagedSource:
    return FolderSource(spark, source) if isinstance(source, str) else source


class RejectedRows(ValueError):
    """Records that cannot be stored: too many fields, or an unclosed quote."""


BUCKET_TARGET_BYTES = 256 * 1024 * 1024
MIN_BUCKETS = 8


def bucket_count(source, names: list[str]) -> int:
    """Buckets for the derived tables: about 256 MB of input per bucket for the largest table, at any size."""
    sizes = source.files(names).groupBy("table_name").agg(F.sum("size_bytes").alias("b"))
    largest = sizes.agg(F.max("b")).first()[0] or 0
    return int(max(MIN_BUCKETS, -(-largest // BUCKET_TARGET_BYTES)))


def kept_buckets(spark: SparkSession, db: str, wanted: int) -> int:
    """The stored tables' bucket count while it is within a factor of two of the wanted one, so a reload keeps the layout."""
    for t in BUCKETED:
        layout = tb.bucket_layout(spark, db, t) if tb.table_exists(spark, db, t) else None
        if layout and wanted <= 2 * layout[1] and layout[1] <= 2 * wanted:
            return layout[1]
    return wanted


@dataclass
class LoadResult:
    database: str
    decisions: list[dict] = field(default_factory=list)
    expected_per_file: DataFrame | None = None
    reconciliation: DataFrame | None = None
    rejected_capital: int | None = None
    n_rejected: int = 0
    partners: dict = field(default_factory=dict)
    n_buckets: int | None = None
    state_before: list = field(default_factory=list)


def _stored(spark: SparkSession, db: str, table: str) -> DataFrame:
    df = tb.read(spark, db, table)
    if df is None:
        tb.create_base_table(spark, db, table)
        df = tb.read(spark, db, table)
    return df


def lookup_layout(df: DataFrame, table: str, n_parts: int) -> DataFrame:
    key = LOOKUP_KEY.get(table)
    if key is None:
        return df
    if table in RANGED:
        df = df.repartitionByRange(n_parts, F.col(key))
    return df.sortWithinPartitions(key)


def load_code_lists(spark, source, db, tables: list[str], mode="overwrite", force=False, strict_rows=True) -> list[dict]:
    """Decide for every code list in one job (one small row each), then write those to insert."""
    source = as_source(spark, source)
    pairs = {t: (_stored(spark, db, t), source.rows(t, strict_rows)) for t in tables}
    decisions = [r.asDict() for r in checks.code_load_decision(pairs, force=force).collect()]
    for d in sorted(decisions, key=lambda d: tables.index(d["table_name"])):
        if d["will_insert"]:
            write_mode = "append" if (mode == "append" or d["existing"] == 0) else "overwrite"
            rows = lookup_layout(pairs[d["table_name"]][1], d["table_name"], 1)
            tb.write_rows(rows, db, d["table_name"], write_mode)
    return sorted(decisions, key=lambda d: tables.index(d["table_name"]))


def derived(table: str, rows: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of an extract with the computed columns of the final table."""
    if table == "empresas":
        return derive.companies_with_capital(rows, strict)
    if table == "estabelecimento":
        return derive.establishments_with_number(rows)
    return rows


def load_main_tables(
    spark, source, db, tables: list[str], per_file: DataFrame, mode="overwrite",
    n_buckets: int = tb.DEFAULT_BUCKETS, strict: bool = True, strict_rows: bool = True, added_rows: dict | None = None,
) -> list[dict]:
    """Decide for every main table in one job on the sum of rows over all its files, then write final rows once.

    ``append`` adds the incoming rows that a table with rows lacks (``append.delta``),
    whatever the totals are; decisions then have the counts ``read``, ``added`` and
    ``already``, and ``added_rows`` gets what was added. Otherwise the table's next
    version is filled beside it and takes its place at once.
    """
    source = as_source(spark, source)
    stored = {t: _stored(spark, db, t) for t in tables}
    existing = checks.table_counts_named(stored, "existing")
    expected = per_file.groupBy("table_name").agg(F.sum("n_rows").cast("long").alias("expected"))
    stats = existing.join(expected, "table_name", "left").fillna(0, ["expected"])
    decisions = {r.table_name: r.asDict() for r in checks.decide_main_load(stats).collect()}  # one row per table
    for t in tables:
        d = decisions[t]
        appending = mode == "append" and d["existing"] > 0
        if not d["will_insert"] and not appending:
            continue
        rows = derived(t, source.rows(t, strict_rows), strict)
        final = [c for c, _ in schemas.final_columns(t)]
        if appending:
            before = stored[t] if stored[t].columns == final else derived(t, stored[t], strict)
            rows, counts = append.delta(before, rows.select(*final), t, by_bucket=t in append_by_bucket(stored[t], final))
            d |= counts | {"decision": "append" if counts["added"] else "skip", "will_insert": counts["added"] > 0}
            if added_rows is not None:
                added_rows[t] = rows
            if stored[t].columns == final:
                if counts["added"]:
                    insert_rows(rows, db, t, n_buckets, "append")
                continue
            rows = before.unionByName(rows)  # stored without the computed columns so far
        new = tb.begin_replacement(spark, db, t, BUCKETED.get(t), SORTED.get(t), n_buckets)
        insert_rows(rows, db, new, n_buckets, "append", t)
        tb.finish_replacement(spark, db, t)
    return [decisions[t] for t in tables]


def append_by_bucket(stored: DataFrame, final: list[str]) -> set[str]:
    """Main tables of a row a company that are stored in their buckets."""
    return {"empresas"} if stored.columns == final else set()


def insert_rows(rows: DataFrame, db: str, name: str, n_parts: int, mode: str, table: str | None = None) -> None:
    table = table or name
    if table in BUCKETED:
        tb.insert_bucketed(rows, db, name, mode)
    else:
        tb.write_rows(lookup_layout(rows, table, n_parts), db, name, mode)


def load_partners(
    spark: SparkSession, db: str, mode: str, n_buckets: int = tb.DEFAULT_BUCKETS, new_offices: DataFrame | None = None
) -> dict[str, int]:
    """Partners per head office from the partner staging, which is dropped afterwards.

    In ``append`` mode the derived table is brought up to date with the staged
    partners and ``new_offices``, the head offices that were added. Partners
    without a head office are kept for later deliveries.
    """
    so, est = tb.read(spark, db, "socios_original"), tb.read(spark, db, "estabelecimento")
    if so is None or est is None or "cnpj" not in est.columns:
        return {}
    counts, location = {}, tb.database_location(spark, db)
    if mode == "append" and tb.table_exists(spark, db, "socios"):
        counts = append.append_partners(spark, db, location, derive.head_offices(est) if new_offices is None else new_offices)
    else:
        # The head offices are dealt anew, not read by bucket: with a shuffle on both sides, adaptive execution splits
        # the partition of a company that owns very many partners. The partners are shuffled by this join only: it
        # deals them to the buckets and tells those without an office, and both kinds are written by its tasks.
        offices = derive.head_offices(est).hint("rebalance")
        rows = derive.partners_or_waiting(so, offices, WAITS)
        new = tb.begin_replacement(spark, db, "socios", BUCKETED["socios"], SORTED["socios"], n_buckets)
        folder = append.waiting_folder(location)
        with tb.dealt_by_bucket(spark, n_buckets):
            tb.insert_apart(rows, db, new, "socios", SORTED["socios"], WAITS, folder)
        if not fs.list_files(folder):
            so.limit(0).write.mode("append").parquet(folder)  # none waits
        tb.finish_replacement(spark, db, "socios")
        tb.set_database_property(spark, db, tb.WAITING_PARTNERS, folder)
    tb.drop_table(spark, db, "socios_original")
    return counts


def reference_rows(extract_files: DataFrame, estabelecimento: DataFrame) -> DataFrame:
    """(referencia, valor): the extract date from the first company file name, and the establishment count."""
    first = extract_files.filter(F.col("file_name").endswith(schemas.spec("empresas").suffix)).agg(
        F.min("file_name").alias("f")
    )
    date = first.select(F.lit("CNPJ").alias("referencia"), reference_date(F.col("f")).alias("valor"))
    qty = estabelecimento.agg(F.count(F.lit(1)).cast("string").alias("valor")).select(
        F.lit("cnpj_qtde").alias("referencia"), "valor"
    )
    return date.unionByName(qty)


def write_reference(spark: SparkSession, db: str, source) -> None:
    tb.create_reference_table(spark, db)
    files = as_source(spark, source).files(["empresas"])
    rows = reference_rows(files, spark.table(tb.q(db, "estabelecimento")))
    tb.write_rows(rows, db, "_referencia", "append")


def expected_per_file(spark: SparkSession, source, names: list[str]) -> DataFrame:
    """Accepted and rejected rows per extract file of the given tables, in one scan; empty files included."""
    source = as_source(spark, source)
    return registry.count_lines(source.lines(names), source.files(names).select("table_name", "file_name"), names)


def integrity(spark: SparkSession, db: str) -> DataFrame:
    ts = {t: tb.read(spark, db, t) for t in schemas.INTEGRITY_TABLES}
    return checks.integrity_report(spark, ts, ts["empresas"], ts["estabelecimento"], ts["socios"])


def run_load(
    spark: SparkSession,
    landing,
    db: str,
    location: str,
    mode: str = "overwrite",
    force: bool = False,
    strict: bool = True,
    n_buckets: int | None = None,
    strict_rows: bool = True,
) -> LoadResult:
    """Load every table from ``landing`` (a folder of extracts, or a ``StagedSource``).

    With ``mode="append"`` each table takes the rows of the delivery that it
    lacks (see ``append``); rows neither added nor found raise ``LostRows``.
    ``n_buckets`` defaults to one bucket per ~256 MB of the largest table's
    input. ``strict`` concerns malformed amounts. With ``strict_rows`` a
    record that cannot be stored raises ``RejectedRows`` before any write;
    without, such records go to the table ``_rejeitados``.
    """
    landing = as_source(spark, landing)
    tb.create_database(spark, db, location)
    tb.recover(spark, db, [*MAIN_ORDER, "socios"])
    if n_buckets is None:
        n_buckets = kept_buckets(spark, db, bucket_count(landing, MAIN_ORDER))
    result = LoadResult(db, n_buckets=n_buckets)
    # state of every table before loading: absent / empty / filled (one row per table)
    result.state_before = checks.derived_state(tb.counts(spark, db, schemas.STATE_TABLES)).collect()
    # rows per extract file, all tables in one scan; written, as later steps read it several times
    path = scratch_path(spark, "expected", uuid.uuid4().hex)
    expected_per_file(spark, landing, schemas.BASE_TABLES).coalesce(1).write.parquet(path)
    per_file = spark.read.parquet(path)
    result.expected_per_file = per_file
    tables_present = {r.table_name for r in per_file.select("table_name").distinct().collect()}  # at most ten
    if missing := [t for t in schemas.BASE_TABLES if t not in tables_present]:
        raise registry.NoInputFiles(f"no extract for {', '.join(missing)}")
    result.n_rejected = per_file.agg(F.coalesce(F.sum("n_rejected"), F.lit(0))).first()[0]
    if result.n_rejected:
        if strict_rows:
            worst = per_file.filter("n_rejected > 0").orderBy(F.desc("n_rejected"), "file_name").limit(10).collect()
            named = ", ".join(f"{r.file_name}: {r.n_rejected}" for r in worst)
            raise RejectedRows(f"{result.n_rejected} records cannot be stored ({named})")
        rejects = registry.rejects(landing.lines(schemas.BASE_TABLES), schemas.BASE_TABLES)
        rejects.write.mode("append" if mode == "append" else "overwrite").format("parquet").saveAsTable(tb.q(db, "_rejeitados"))
    result.decisions.extend(load_code_lists(spark, landing, db, schemas.CODE_TABLES, mode, force, strict_rows))
    added: dict[str, DataFrame] = {}
    result.decisions.extend(
        load_main_tables(spark, landing, db, MAIN_ORDER, per_file, mode, n_buckets, strict, strict_rows, added)
    )
    result.reconciliation = spark.createDataFrame(
        *_reconciled(spark, db, per_file, result.decisions, mode)
    )
    if lost := [d for d in result.decisions if "read" in d and not d["expected"] == d["read"] == d["added"] + d["already"]]:
        raise append.LostRows(", ".join(f"{d['table_name']}: {d['expected']} expected, {d['read']} read" for d in lost))
    if not strict:
        amounts = landing.rows("empresas", strict_rows)
        result.rejected_capital = derive.rejected_capital(amounts).count()  # amounts stored as NULL
    new_offices = derive.head_offices(added["estabelecimento"]) if "estabelecimento" in added else None
    result.partners = load_partners(spark, db, mode, n_buckets, new_offices)
    write_reference(spark, db, landing)
    return result


def _reconciled(spark, db, per_file, decisions, mode):
    """Reconciliation rows (one per table) and schema; of a table that was appended to, the delivery's rows are compared."""
    kept = [
        (d["table_name"], int(d["existing"]) - int(d.get("already", 0)))
        for d in decisions
        if mode == "append" and d["existing"] > 0 and ("read" in d or d["decision"] == "append")
    ]
    stored = tb.counts(spark, db, schemas.BASE_TABLES)
    if kept:
        there = spark.createDataFrame(kept, "table_name string, kept long")
        stored = stored.join(there, "table_name", "left").withColumn("n_rows", F.col("n_rows") - F.coalesce("kept", F.lit(0)))
    report = checks.reconciliation(per_file, stored)
    return report.collect(), report.schema
