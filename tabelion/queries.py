"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the registry-shaped views over the driver's
tables (``tabelion.fixtures``), so its work grows with them. The matching
DuckDB oracle texts are in ``tabelion.oracles``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion import fixtures as fx
from tabelion import schemas, session
from tabelion.operators import checks, derive, listing
from tabelion.plans import expand, pipeline
from tabelion.plans import tables as tb
from tabelion.sources import archives, extracts, fs, links, registry
from tabelion.streaming import live


class Stored:
    """The registry tables as they stand after a load, built from the fixture views."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def raw(self, name: str) -> DataFrame:
        return fx.view(self.spark, self.sf, name)

    def code(self, name: str) -> DataFrame:
        return self.raw(name)

    def codes(self) -> dict[str, DataFrame]:
        return {n: self.code(n) for n in schemas.CODE_TABLES}

    def empresas(self) -> DataFrame:
        return derive.companies_with_capital(self.raw("empresas_raw"))

    def estabelecimento(self) -> DataFrame:
        return derive.establishments_with_number(self.raw("estabelecimento_raw"))

    def socios_original(self) -> DataFrame:
        return self.raw("socios_original")

    def socios(self) -> DataFrame:
        return derive.partners_head_office(self.socios_original(), self.estabelecimento())

    def simples(self) -> DataFrame:
        return self.raw("simples")

    def table(self, name: str) -> DataFrame:
        main = {
            "empresas": self.empresas,
            "estabelecimento": self.estabelecimento,
            "socios_original": self.socios_original,
            "socios": self.socios,
            "simples": self.simples,
        }
        return main[name]() if name in main else self.code(name)

    def extract(self, name: str) -> DataFrame:
        """Rows of a base table's incoming extract."""
        return fx.registry_view(self.spark, self.sf, name)


def partners_head_office(spark: SparkSession, sf: str) -> DataFrame:
    return Stored(spark, sf).socios()


def companies_capital(spark: SparkSession, sf: str) -> DataFrame:
    return Stored(spark, sf).empresas()


def establishment_number(spark: SparkSession, sf: str) -> DataFrame:
    return Stored(spark, sf).estabelecimento()


def company_establishment_count(spark: SparkSession, sf: str) -> DataFrame:
    s = Stored(spark, sf)
    return checks.relationship_count("empresas_estabelecimento", s.empresas(), s.estabelecimento(), "cnpj_basico")


def establishment_partner_count(spark: SparkSession, sf: str) -> DataFrame:
    s = Stored(spark, sf)
    return checks.relationship_count("estabelecimento_socios", s.estabelecimento(), s.socios(), "cnpj")


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    s = Stored(spark, sf)
    return checks.table_counts(spark, {t: s.table(t) for t in schemas.MONITOR_TABLES}, with_text=True)


def code_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return checks.code_distinct(Stored(spark, sf).codes())


def code_ends(spark: SparkSession, sf: str) -> DataFrame:
    return checks.code_ends(Stored(spark, sf).codes())


def latest_establishments(spark: SparkSession, sf: str) -> DataFrame:
    return listing.latest_establishments(Stored(spark, sf).estabelecimento())


def latest_companies(spark: SparkSession, sf: str) -> DataFrame:
    return listing.latest_companies(Stored(spark, sf).empresas())


def code_preview(spark: SparkSession, sf: str) -> DataFrame:
    return listing.code_preview(Stored(spark, sf).codes())


# States met by a load: how many times a stored row counts, for the rows whose code (or key) has an even last digit
# and for the others, and whether the extract is empty. The ends differ where the stored side lacks one half.
SCENARIOS = {
    "first_run": (0, 0, False),
    "rerun": (1, 1, False),
    "double_load": (2, 2, False),
    "half_loaded": (1, 0, False),
    "half_twice": (2, 0, False),
    "half_three_times": (3, 0, False),
    "half_five_times": (5, 0, False),
    "empty_extract": (1, 1, True),
}


def even(column: str) -> F.Column:
    return F.substring(column, -1, 1).isin("0", "2", "4", "6", "8")


def _scenario_rows(spark: SparkSession) -> DataFrame:
    """scenario, even_times, odd_times, empty: one row each."""
    rows = [(name, *state) for name, state in SCENARIOS.items()]
    return F.broadcast(spark.createDataFrame(rows, "scenario string, even_times int, odd_times int, empty boolean"))


def code_load_decision(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions in every scenario, without and with ``force``; each list is read once, for its counts and ends."""
    s = Stored(spark, sf)
    lists = s.codes()
    rows = None
    for name, df in lists.items():
        one = df.select(F.lit(name).alias("table_name"), "codigo")
        rows = one if rows is None else rows.unionByName(one)
    halves = rows.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(even("codigo")).alias("n_even"),
        F.min("codigo").alias("first"),
        F.max("codigo").alias("last"),
        F.min(F.when(even("codigo"), F.col("codigo"))).alias("first_even"),
        F.max(F.when(even("codigo"), F.col("codigo"))).alias("last_even"),
        F.count("codigo").alias("n_codes"),
    )
    sc = _scenario_rows(spark)
    whole = F.col("odd_times") > 0
    none = F.col("even_times") == 0
    stats = halves.crossJoin(sc).select(  # one row per list, times the eight scenarios
        "scenario",
        "table_name",
        (F.col("n_even") * F.col("even_times") + (F.col("n") - F.col("n_even")) * F.col("odd_times")).alias("existing"),
        F.when(none, None).when(whole, F.col("first")).otherwise(F.col("first_even")).alias("stored_first"),
        F.when(none, None).when(whole, F.col("last")).otherwise(F.col("last_even")).alias("stored_last"),
        F.when(F.col("empty"), F.lit(0).cast("long")).otherwise(F.col("n")).alias("expected"),
        F.when(~F.col("empty"), F.col("first")).alias("incoming_first"),
        F.when(~F.col("empty"), F.col("last")).alias("incoming_last"),
    )
    plain = checks.decide_code_load(stats).withColumn("force", F.lit(False))
    return plain.unionByName(checks.decide_code_load(stats, force=True).withColumn("force", F.lit(True)))


def main_load_decision(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions in every scenario; each table is read once, for its counts."""
    s = Stored(spark, sf)
    rows = None
    for name in ["estabelecimento", "socios_original", "empresas", "simples"]:
        one = s.extract(name).select(F.lit(name).alias("table_name"), "cnpj_basico")
        rows = one if rows is None else rows.unionByName(one)
    halves = rows.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(even("cnpj_basico")).alias("n_even")
    )
    stats = halves.crossJoin(_scenario_rows(spark)).select(
        "scenario",
        "table_name",
        (F.col("n_even") * F.col("even_times") + (F.col("n") - F.col("n_even")) * F.col("odd_times")).alias("existing"),
        F.when(F.col("empty"), F.lit(0).cast("long")).otherwise(F.col("n")).alias("expected"),
    )
    return checks.decide_main_load(stats)


def width_report(spark: SparkSession, sf: str) -> DataFrame:
    """All declared columns of the extracts, over rows of which some values are one character too wide."""
    s = Stored(spark, sf)
    tables = {}
    for t in schemas.BASE_TABLES:
        spec, rows = schemas.spec(t), extracts.pad_to_spec(s.extract(t), t)
        key = spec.names[0]
        wide = F.substring(key, -1, 1) == "7"
        widened = [
            F.when(wide, F.rpad(F.coalesce(c, F.lit("")), w + 1, "x")).otherwise(F.col(c)).alias(c)
            for c, w in spec.columns[1:]
        ]
        tables[t] = (rows.select(key, *widened), spec.widths)
    return checks.width_report(tables)


QUERIES = {
    "partners_head_office": partners_head_office,
    "companies_capital": companies_capital,
    "establishment_number": establishment_number,
    "company_establishment_count": company_establishment_count,
    "establishment_partner_count": establishment_partner_count,
    "table_counts": table_counts,
    "code_distinct": code_distinct,
    "code_ends": code_ends,
    "latest_establishments": latest_establishments,
    "latest_companies": latest_companies,
    "code_preview": code_preview,
    "code_load_decision": code_load_decision,
    "main_load_decision": main_load_decision,
    "width_report": width_report,
}


# ---------------------------------------------------------------------------
# Queries over registry files: the fixture views written as extracts (and
# archives) under the shared scratch folder once per session, then read back.
# ---------------------------------------------------------------------------

_LOADS: dict[tuple[str, str], pipeline.LoadResult] = {}


def _landing(spark: SparkSession, sf: str) -> str:
    return extracts.landing(spark, sf)


def _archives(spark: SparkSession, sf: str) -> str:
    return archives.archives_for(spark, sf, _landing(spark, sf))


def _scratch(spark: SparkSession, kind: str) -> tuple[str, str]:
    """A new database name and a location for it under the shared scratch folder."""
    db = f"tabelion_{kind}_{uuid.uuid4().hex[:10]}"
    return db, session.scratch_path(spark, "warehouse", db)


def _loaded(spark: SparkSession, sf: str) -> pipeline.LoadResult:
    """The full load of the landing extracts into a session database, run once per session."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _LOADS or not tb.table_exists(spark, _LOADS[key].database, "_referencia"):
        db, location = _scratch(spark, "load")
        _LOADS[key] = pipeline.run_load(spark, _landing(spark, sf), db, location)
    return _LOADS[key]


def main_reader(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of all four main tables read from their extracts: the table, its key and a hash of all its fields."""
    root = _landing(spark, sf)
    return _digests({t: registry.read_table(spark, root, t) for t in pipeline.MAIN_ORDER})


def _digests(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for t, df in tables.items():
        text = F.array_join(F.array(*schemas.spec(t).names), ";")
        one = df.select(F.lit(t).alias("table_name"), F.col("cnpj_basico"), F.md5(text).alias("fields_md5"))
        out = one if out is None else out.unionByName(one)
    return out


def code_reader(spark: SparkSession, sf: str) -> DataFrame:
    root = _landing(spark, sf)
    frames = [registry.read_table(spark, root, t).select(F.lit(t).alias("table_name"), "*") for t in schemas.CODE_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


EMPTY_FILES = ["F.K03200Z.D00101.PAISCSV", "K3241.K03200Y9.D00101.ESTABELE"]


def rows_per_file(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the landing folder and of two empty files beside it."""
    extra = session.scratch_path(spark, "empty", uuid.uuid4().hex)
    fs.makedirs(extra)
    for name in EMPTY_FILES:
        fs.touch(f"{extra}/{name}")
    counts = [pipeline.expected_per_file(spark, folder, schemas.BASE_TABLES) for folder in (_landing(spark, sf), extra)]
    return extracts.by_extract(counts[0].unionByName(counts[1]))


#: The text column that gets line breaks in the damaged extracts.
BROKEN_COLUMN = {
    "empresas": "razao_social", "estabelecimento": "nome_fantasia", "socios_original": "nome_socio", "simples": "opcao_simples",
}


def damaged_landing(spark: SparkSession, sf: str) -> str:
    """Extracts of all tables with line breaks in texts, records too long, and a last record whose quote is not closed."""
    root = session.scratch_path(spark, "damaged", uuid.uuid4().hex)
    fs.makedirs(root)
    lines = None
    for t in schemas.BASE_TABLES:
        rows = extracts.pad_to_spec(fx.registry_view(spark, sf, t), t)
        key, name = schemas.spec(t).names[0], BROKEN_COLUMN.get(t, "descricao")
        digit = F.substring(key, -1, 1)
        before = F.when(digit == "4", "A\n").when(digit == "5", "B\n\nC;\r\n").otherwise("")
        line = extracts.registry_line(t)
        line = F.when(digit == "3", F.concat(line, F.lit(';"x"'))).otherwise(line)
        file = F.lit(f"X.Y.D30610{schemas.spec(t).suffix}").alias("_file")
        one = rows.withColumn(name, F.concat(before, name)).select(file, F.col(key).alias("_key"), line.alias("line"))
        unclosed = spark.range(1).select(file, F.lit("~").alias("_key"), F.lit('"~";"open').alias("line"))
        one = one.unionByName(unclosed)
        lines = one if lines is None else lines.unionByName(one)
    extracts.write_lines(lines, root, breaks=True)
    return root


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    return extracts.by_extract(registry.rejected_rows(spark, damaged_landing(spark, sf), schemas.BASE_TABLES))


def damaged_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Expected, rejected and stored rows of the damaged extracts, read leniently: nothing matches silently."""
    root = damaged_landing(spark, sf)
    names = schemas.BASE_TABLES
    stored = {t: registry.read_table(spark, root, t, strict=False) for t in names}
    expected = extracts.by_extract(pipeline.expected_per_file(spark, root, names))
    return checks.reconciliation(expected, checks.table_counts(spark, stored))


def records_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Key and text with its line breaks of all records of the damaged extracts, from the folder and from archives."""
    root = damaged_landing(spark, sf)
    zipped, staged = (session.scratch_path(spark, "records", uuid.uuid4().hex) for _ in range(2))
    fs.makedirs(zipped)
    archive = F.concat(registry.table_of(F.col("file_name")), F.lit(".zip"))
    archives.build_archives(spark, root, zipped, archive).write.format("noop").mode("overwrite").save()
    expand.stage_archives(spark, zipped, staged)
    out = None
    for kind, source in (("folder", pipeline.FolderSource(spark, root)), ("archive", pipeline.StagedSource(spark, staged))):
        for t in schemas.BASE_TABLES:
            key, name = schemas.spec(t).names[0], BROKEN_COLUMN.get(t, "descricao")
            rows = source.rows(t, strict=False).select(
                F.lit(kind).alias("reader"), F.lit(t).alias("table_name"), F.col(key).alias("key"), F.md5(name).alias("text_md5")
            )
            out = rows if out is None else out.unionByName(rows)
    return out


def _split_landing(spark: SparkSession, sf: str, digits: dict[str, str] | str) -> str:
    """Extracts of the rows whose company's last digit is among ``digits`` (of each main table); all code lists."""
    root = session.scratch_path(spark, "split", uuid.uuid4().hex)
    fs.makedirs(root)
    tag, lines = extracts.reference_tag(spark, sf), None
    for t in schemas.BASE_TABLES:
        rows = extracts.pad_to_spec(fx.registry_view(spark, sf, t), t)
        key = schemas.spec(t).names[0]
        if t in pipeline.MAIN_ORDER:
            rows = rows.filter(F.substring(key, -1, 1).isin(*(digits if isinstance(digits, str) else digits[t])))
        one = rows.select(
            extracts.extract_name(t, tag).alias("_file"), F.col(key).alias("_key"), extracts.registry_line(t).alias("line")
        )
        lines = one if lines is None else lines.unionByName(one)
    extracts.write_lines(lines, root)
    return root


def load_append(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows of the derived tables after a load of some companies and an appending load of the others."""
    db, location = _scratch(spark, "append")
    pipeline.run_load(spark, _split_landing(spark, sf, "012"), db, location)
    pipeline.run_load(spark, _split_landing(spark, sf, "3456789"), db, location, mode="append")
    return _final_digests(spark, db)


def load_append_parts(spark: SparkSession, sf: str) -> DataFrame:
    """As ``load_append``, from a large delivery and then a smaller one that overlaps it, twice.

    Some partners come before the establishments of their companies, some after.
    """
    db, location = _scratch(spark, "parts")
    first = dict.fromkeys(pipeline.MAIN_ORDER, "23456789") | {"socios_original": "12345678"}
    second = dict.fromkeys(pipeline.MAIN_ORDER, "0123") | {"socios_original": "0239"}
    pipeline.run_load(spark, _split_landing(spark, sf, first), db, location)
    second = _split_landing(spark, sf, second)
    for _ in range(2):
        pipeline.run_load(spark, second, db, location, mode="append")
    return _final_digests(spark, db)


def _final_digests(spark: SparkSession, db: str) -> DataFrame:
    out = None
    for t in ("empresas", "estabelecimento", "socios", "simples"):
        df = tb.read(spark, db, t)
        text = F.array_join(F.array(*[F.col(c).cast("string") for c, _ in schemas.final_columns(t)]), ";")
        one = df.select(F.lit(t).alias("table_name"), F.col("cnpj_basico").cast("string").alias("cnpj_basico"), F.md5(text).alias("row_md5"))
        out = one if out is None else out.unionByName(one)
    return out


def archive_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per staged member after three stagings of archives with an unknown, an empty and two common members."""
    root = session.scratch_path(spark, "rerun", uuid.uuid4().hex)
    fs.makedirs(f"{root}/in")
    fs.makedirs(f"{root}/zip")
    lines = None
    for t in ("cnae", "empresas"):
        rows = extracts.pad_to_spec(fx.registry_view(spark, sf, t), t)
        key = schemas.spec(t).names[0]
        one = rows.select(F.lit(f"X.Y.D30610{schemas.spec(t).suffix}").alias("_file"), F.col(key).alias("_key"), extracts.registry_line(t).alias("line"))
        lines = one if lines is None else lines.unionByName(one)
    extracts.write_lines(lines, f"{root}/in")
    for name in ("LEIAME.txt", "E.Y.D30610.MOTICSV"):
        fs.touch(f"{root}/in/{name}")
    name = F.col("file_name")
    archive = F.when(name.contains("CNAE") | name.contains("LEIAME"), "A.zip").when(name.contains("D30610"), "B.zip")
    archives.build_archives(spark, f"{root}/in", f"{root}/zip", archive).write.format("noop").mode("overwrite").save()
    for _ in range(3):
        status = expand.stage_archives(spark, f"{root}/zip", f"{root}/staged")
    staged = expand.staged_lines(spark, f"{root}/staged", schemas.BASE_TABLES)
    counts = staged.groupBy("archive", "entry").agg(F.count(F.lit(1)).alias("n_lines"))
    done = expand.finished_members(spark, f"{root}/staged").join(status.select("archive", "all_present"), "archive")
    listed = done.join(counts, ["archive", "entry"], "left").select(
        "archive", "entry", "all_present", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines")
    )
    return extracts.by_extract(listed, "entry")


def file_summary(spark: SparkSession, sf: str) -> DataFrame:
    files = registry.list_extracts(spark, _landing(spark, sf))
    tagged = files.withColumn("table_name", registry.table_of(F.col("file_name"))).filter(F.col("table_name").isNotNull())
    return tagged.groupBy("table_name").agg(
        F.count_distinct(extracts.extract_of(F.col("file_name"))).alias("n_files"), F.sum("size_bytes").cast("long").alias("total_bytes")
    )


def file_sizes(spark: SparkSession, sf: str) -> DataFrame:
    files = registry.list_extracts(spark, _landing(spark, sf)).filter(F.col("file_name") != extracts.READY)
    return checks.file_sizes(extracts.by_extract(files.select("file_name", "size_bytes")))


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Expected rows of the extracts, counted now, against the rows stored by the load."""
    names = [t for t in schemas.BASE_TABLES if t != "socios_original"]  # the partner staging is gone after the load
    counted = extracts.by_extract(pipeline.expected_per_file(spark, _landing(spark, sf), names))
    return checks.reconciliation(counted, tb.counts(spark, _loaded(spark, sf).database, names))


def reference_metadata(spark: SparkSession, sf: str) -> DataFrame:
    res = _loaded(spark, sf)
    return spark.table(tb.q(res.database, "_referencia")).select(
        F.col("referencia").cast("string").alias("referencia"), F.col("valor").cast("string").alias("valor")
    )


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.integrity(spark, _loaded(spark, sf).database)


def lookups(spark: SparkSession, sf: str) -> DataFrame:
    """For each access path of the loaded tables its largest key and the rows found by it."""
    db, found = _loaded(spark, sf).database, []
    for t, columns in schemas.ACCESS_PATHS.items():
        if t == "socios_original":  # dropped by the load
            continue
        keys = spark.table(tb.q(db, t)).agg(*[F.max(c).alias(c) for c in columns]).first()
        for c in columns:
            n = tb.lookup(spark, db, t, c, keys[c]).agg(F.count(F.lit(1)).alias("n_rows"))
            found.append(n.select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(keys[c]).alias("key"), "n_rows"))
    return reduce(DataFrame.unionByName, found)


def tables_listed(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of the loaded database in order, with their rows and whether they are expected base tables."""
    db = _loaded(spark, sf).database
    listed = tb.list_tables(spark, db)
    names = [r.table_name for r in listed.collect()]
    return listed.join(tb.counts(spark, db, names).select("table_name", "n_rows"), "table_name").select(
        "position", "table_name", "n_rows"
    )


def tables_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Expected tables present or missing after the load, with the rows of the present ones."""
    db = _loaded(spark, sf).database
    found = checks.presence(spark, schemas.BASE_TABLES, tb.list_tables(spark, db))
    return found.join(tb.counts(spark, db, schemas.BASE_TABLES).select("table_name", "n_rows"), "table_name")


def table_definitions(spark: SparkSession, sf: str) -> DataFrame:
    """Columns, types and comments of the tables after the load, with the table's rows."""
    db = _loaded(spark, sf).database
    names = sorted({*schemas.BASE_TABLES, "socios"} - {"socios_original"})
    defined = tb.table_definitions(spark, db, names)
    return defined.join(tb.counts(spark, db, names).select("table_name", "n_rows"), "table_name")


def _purged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Filled base tables, one left empty, emptied again; the countries cannot be, as their table is a view."""
    db, location = _scratch(spark, "purge")
    tb.create_database(spark, db, location)
    tb.create_base_tables(spark, db)
    for t in schemas.BASE_TABLES:
        if t != "motivo":
            tb.write_rows(registry.read_table(spark, _landing(spark, sf), t), db, t)
    tb.rename_table(spark, db, "pais", "pais_dados")
    spark.sql(f"CREATE VIEW {tb.q(db, 'pais')} AS SELECT * FROM {tb.q(db, 'pais_dados')}")
    return tb.purge(spark, db, schemas.BASE_TABLES)


def purge_report(spark: SparkSession, sf: str) -> DataFrame:
    report, _ = _purged(spark, sf)
    return report.select("table_name", "before", "after", "removed", "status", F.col("error").isNotNull().alias("has_cause"))


def purge_summary(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = _purged(spark, sf)
    return summary.select("total_left", F.array_join("tables_with_rows", ",").alias("tables_with_rows"))


def derived_state(spark: SparkSession, sf: str) -> DataFrame:
    db = _loaded(spark, sf).database
    return checks.derived_state(tb.counts(spark, db, schemas.STATE_TABLES))


def _staged(spark: SparkSession, sf: str) -> str:
    path = session.scratch_path(spark, "staged", uuid.uuid4().hex)
    expand.stage_archives(spark, _archives(spark, sf), path)
    return path


def archive_reader(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of all four main tables parsed from the archives' staged lines (expand once, then load)."""
    staged = pipeline.StagedSource(spark, _staged(spark, sf))
    return _digests({t: staged.rows(t) for t in pipeline.MAIN_ORDER})


def archive_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = archives.archive_lines(spark, _archives(spark, sf))
    return lines.select("archive", extracts.extract_of(F.col("entry")).alias("entry"), "line")


def _members(spark: SparkSession, sf: str) -> DataFrame:
    """The archives' members, an extract's parts as one."""
    return extracts.by_extract(archives.archive_manifest(spark, _archives(spark, sf)), "entry")


def archive_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return archives.archive_sizes(_members(spark, sf))


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    """The landing files without those of the companies of even last digits and of the activity codes."""
    files = registry.list_extracts(spark, _landing(spark, sf)).withColumn("file_name", extracts.extract_of(F.col("file_name")))
    gone = F.col("file_name").rlike(r"Y[02468]\..*EMPRECSV$") | F.col("file_name").endswith("CNAECSV")
    return files.filter(~gone)


def archive_entry_status(spark: SparkSession, sf: str) -> DataFrame:
    return archives.entry_status(_members(spark, sf), _extracted(spark, sf))


def entries_missing(spark: SparkSession, sf: str) -> DataFrame:
    return archives.missing_entries(_members(spark, sf), _extracted(spark, sf))


def links_all(spark: SparkSession, sf: str) -> DataFrame:
    return links.links(fx.source(spark, sf, "pages")).select("page_id", "link_pos", "href")


def links_resolved(spark: SparkSession, sf: str) -> DataFrame:
    """Links of the pages as they are and, wrapped once more, as absolute ones of another page."""
    pages = fx.source(spark, sf, "pages").select("page_id", "url", "html")
    wrapped = pages.select("page_id", F.lit("http://index.example/").alias("url"), _anchor(F.col("url")).alias("html"))
    return links.resolved_links(pages).unionByName(links.resolved_links(wrapped))


def _anchor(href: F.Column) -> F.Column:
    """An anchor in one of the forms of HTML, by the page: quotes, none, capitals, other attributes, entities."""
    form, escaped = F.pmod(F.col("page_id"), F.lit(4)), F.replace(href, F.lit("&"), F.lit("&amp;"))
    return (
        F.when(form == 0, F.concat(F.lit("<a class='k' data-href=\"no\" href=\""), escaped, F.lit('">x</a>')))
        .when(form == 1, F.concat(F.lit("<A HREF='"), escaped, F.lit("'>x</A>")))
        .when(form == 2, F.concat(F.lit("<a id=3 href="), escaped, F.lit(">x</a>")))
        .otherwise(F.concat(F.lit('<a\n title="a > b" href = "'), escaped, F.lit('" rel=no>x</a>')))
    )


def latest_link(spark: SparkSession, sf: str) -> DataFrame:
    return links.latest_link(fx.source(spark, sf, "pages"), "/")


def _site_pages(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Sites made from the pages: an index of dated folders for each host, and a page of archives for each folder.

    A page stands for an archive named after its id, in the folder of the
    month that its id gives.
    """
    pages = fx.source(spark, sf, "pages").select("page_id", "url")
    site = F.concat(F.lit("http://"), F.regexp_extract("url", links.HOST, 1), F.lit("/"))
    month = F.concat(F.lit("202"), F.pmod("page_id", F.lit(3)).cast("string"), F.lit("-0"), (F.pmod("page_id", F.lit(7)) + 1).cast("string"), F.lit("/"))
    dated = pages.select("page_id", site.alias("site"), month.alias("folder"))
    named = F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 5 == 0, ".txt").otherwise(".zip"))
    index = dated.groupBy("site").agg(
        F.min("page_id").alias("page_id"), F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("<a href='"), "folder", F.lit("'>m</a>")))), " ").alias("html")
    )
    folders = dated.groupBy("site", "folder").agg(
        F.min("page_id").alias("page_id"), F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<a href="), named, F.lit(">f</a>")))), " ").alias("html")
    )
    other = F.concat(F.lit("<a href='x/'>x</a><a href='1999-01/'>old</a>"), "html")
    return (
        index.select("page_id", F.col("site").alias("url"), other.alias("html")),
        folders.select("page_id", F.concat("site", "folder").alias("url"), "html"),
    )


def latest_folder_archives(spark: SparkSession, sf: str) -> DataFrame:
    index, folders = _site_pages(spark, sf)
    return links.latest_folder_archives(index, folders)


def live_counts(spark: SparkSession, sf: str) -> DataFrame:
    root, run = _landing(spark, sf), session.scratch_path(spark, "live", uuid.uuid4().hex)
    q = live.live_counts(spark, root, f"{run}/checkpoint", f"{run}/counts", files_per_trigger=8)
    q.awaitTermination()
    return live.published_counts(spark, f"{run}/counts")


def _live_latest(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Latest records after streaming a table's extracts through ``foreachBatch`` appends."""
    root, run = _landing(spark, sf), session.scratch_path(spark, "live_latest", uuid.uuid4().hex)
    q = live.live_latest(spark, root, table, f"{run}/checkpoint", f"{run}/table", f"{run}/latest", 5)
    q.awaitTermination()
    return live.latest_listing(spark, table, f"{run}/latest")


def live_latest_companies(spark: SparkSession, sf: str) -> DataFrame:
    return _live_latest(spark, sf, "empresas")


def live_latest_establishments(spark: SparkSession, sf: str) -> DataFrame:
    return _live_latest(spark, sf, "estabelecimento")


QUERIES.update({f.__name__: f for f in (
    lookups, rejected_rows, damaged_reconciliation, records_of_lines, load_append, load_append_parts, archive_rerun, file_sizes, tables_listed, table_definitions,
    purge_report, purge_summary, latest_folder_archives, live_latest_establishments,
)})
QUERIES.update(
    {
        "live_latest_companies": live_latest_companies,
        "main_reader": main_reader,
        "code_reader": code_reader,
        "rows_per_file": rows_per_file,
        "file_summary": file_summary,
        "reconciliation": reconciliation,
        "reference_metadata": reference_metadata,
        "integrity_report": integrity_report,
        "tables_missing": tables_missing,
        "derived_state": derived_state,
        "archive_lines": archive_lines,
        "archive_reader": archive_reader,
        "archive_manifest": archive_manifest,
        "archive_entry_status": archive_entry_status,
        "entries_missing": entries_missing,
        "links_all": links_all,
        "links_resolved": links_resolved,
        "latest_link": latest_link,
        "live_counts": live_counts,
    }
)
