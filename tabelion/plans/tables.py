"""Catalog tables: typed DDL, appends, derived tables, purges, listings.

Tables are Parquet data-source tables in a database whose location is under
the shared scratch folder. ``VARCHAR(n)`` columns make every write check its
widths (over-long values fail the write). Derived tables are written with a
layout instead of indexes: bucketed and sorted on the join key so the
relationship joins need no shuffle, sorted row groups for lookups, and Bloom
filters of the row groups for lookups by names and documents.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion import schemas
from tabelion.operators import checks
from tabelion.session import settings
from tabelion.sources import fs

DEFAULT_BUCKETS = 8
#: The database property that names the folder of partners without a head office.
WAITING_PARTNERS = "socios_pendentes"
#: The property of a table's next version that is set when all its rows are written.
COMPLETE = "versao_completa"
KEEP_WIDTHS = "spark.sql.preserveCharVarcharTypeInfo"
#: The largest Bloom filter of a row group's column; what is written fits the values that there are.
BLOOM_BYTES = 4 * 1024 * 1024


def q(db: str, table: str) -> str:
    return f"`{db}`.`{table}`"


def create_database(spark: SparkSession, db: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")


def database_property(spark: SparkSession, db: str, name: str) -> str | None:
    """A property of the database, or None."""
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{db}`").collect()
    listed = next((r[1] for r in rows if r[0] == "Properties"), "") or ""
    found = re.search(rf"\({re.escape(name)},([^)]*)\)", listed)
    return found[1].strip() or None if found else None


def set_database_property(spark: SparkSession, db: str, name: str, value: str) -> None:
    spark.sql(f"ALTER DATABASE `{db}` SET DBPROPERTIES ('{_quote(name)}' = '{_quote(value)}')")


def database_location(spark: SparkSession, db: str) -> str:
    return next(r[1] for r in spark.sql(f"DESCRIBE DATABASE `{db}`").collect() if r[0] == "Location")


def write_options(table: str, columns: list[str]) -> str:
    """The ``OPTIONS`` of a table with ``columns``: Bloom filters for its lookups, used by every later insert."""
    filtered = [c for c in schemas.BLOOM_COLUMNS.get(table, []) if c in columns]
    if not filtered:
        return ""
    options = {"adaptive.enabled": "true", "max.bytes": str(BLOOM_BYTES)} | {f"enabled#{c}": "true" for c in filtered}
    return "OPTIONS (" + ", ".join(f"'parquet.bloom.filter.{k}' '{v}'" for k, v in options.items()) + ")"


def lookup(spark: SparkSession, db: str, table: str, column: str, value: str) -> DataFrame:
    """Rows of a stored table with ``value`` in ``column``, one of ``schemas.ACCESS_PATHS``.

    A null value finds nothing, as in SQL. Buckets, the order of the rows or
    Bloom filters tell which files and row groups need not be read.
    """
    if column not in schemas.ACCESS_PATHS.get(table, []):
        raise ValueError(f"no access path {table}.{column}")
    return spark.table(q(db, table)).filter(F.col(column) == F.lit(value))


def create_base_table(spark: SparkSession, db: str, table: str) -> None:
    """Drop and recreate one typed base table, with its comment."""
    s = schemas.spec(table)
    drop_table(spark, db, table)
    comment = _quote(schemas.TABLE_COMMENTS[table])
    spark.sql(f"CREATE TABLE {q(db, table)} ({s.ddl()}) USING parquet {write_options(table, s.names)} COMMENT '{comment}'")


def create_final_table(
    spark: SparkSession,
    db: str,
    name: str,
    table: str,
    bucket_by: str | None = None,
    sort_by: list[str] | None = None,
    n_buckets: int = DEFAULT_BUCKETS,
    location: str | None = None,
    flag: str | None = None,
) -> None:
    """(Re)create ``name`` as ``table`` stands after the load: typed columns, comment, bucket layout.

    With ``location`` the table is external: dropping it leaves its files.
    With ``flag`` it has a further column of that name, and a folder for each of its values.
    """
    columns = ", ".join(f"{c} {t}" for c, t in schemas.final_columns(table)) + (f", {flag} BOOLEAN" if flag else "")
    layout = f"CLUSTERED BY ({bucket_by}) SORTED BY ({', '.join(sort_by or [bucket_by])}) INTO {n_buckets} BUCKETS" if bucket_by else ""
    comment = schemas.TABLE_COMMENTS.get(table)
    note = f"COMMENT '{_quote(comment)}'" if comment else ""
    spark.sql(f"DROP TABLE IF EXISTS {q(db, name)}")
    place = f"LOCATION '{_quote(location)}'" if location else ""
    split = f"PARTITIONED BY ({flag})" if flag else ""
    options = write_options(table, [c for c, _ in schemas.final_columns(table)])
    spark.sql(f"CREATE TABLE {q(db, name)} ({columns}) USING parquet {options} {split} {layout} {place} {note}")


def table_detail(spark: SparkSession, db: str, table: str, name: str) -> str | None:
    """An entry of the table's extended description, such as ``Location``, or None."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {q(db, table)}").collect()
    at = next((i for i, r in enumerate(rows) if r.col_name.startswith("#") or not r.col_name), len(rows))
    return next((r.data_type for r in rows[at:] if r.col_name == name), None)


def versions_folder(spark: SparkSession, db: str, table: str) -> str:
    return f"{database_location(spark, db).rstrip('/')}/_versoes/{table}"


def _same_place(a: str, b: str) -> bool:
    return fs.resolve(a)[1].rstrip("/") == fs.resolve(b)[1].rstrip("/")


def replacement_of(table: str) -> str:
    """The catalog name under which a table's next version is filled."""
    return f"{table}__new"


def begin_replacement(
    spark: SparkSession, db: str, table: str, bucket_by: str | None, sort_by: list[str] | None, n_buckets: int
) -> str:
    """An empty table in a folder of its own, which ``finish_replacement`` makes the next version of ``table``.

    Folders of versions before the present one are deleted here: a reader that
    planned on a version can read it until the replacement after next.
    """
    folder, default = versions_folder(spark, db, table), f"{database_location(spark, db).rstrip('/')}/{table}"
    now = table_detail(spark, db, table, "Location") if table_exists(spark, db, table) else None
    for old in [default, *fs.list_folders(folder)]:
        if now is None or not _same_place(old, now):
            fs.remove_folder(old)
    name, path = replacement_of(table), f"{folder}/{uuid.uuid4().hex}"
    create_final_table(spark, db, name, table, bucket_by, sort_by, n_buckets, path)
    return name


def finish_replacement(spark: SparkSession, db: str, table: str) -> None:
    """Make the filled next version the table.

    Where columns, layout and options are those of the present table, one change
    of its location does it: a reader finds the old rows or the new ones. Where
    they differ, the definition is made anew. In both cases the mark on the
    next version is set first, so ``recover`` can end what was stopped.
    """
    new = replacement_of(table)
    spark.sql(f"ALTER TABLE {q(db, new)} SET TBLPROPERTIES ('{COMPLETE}' = 'true')")
    _take_place(spark, db, table)


def _take_place(spark: SparkSession, db: str, table: str) -> None:
    new = replacement_of(table)
    path = table_detail(spark, db, new, "Location")
    present = table_exists(spark, db, table)
    if not (present and _same_place(table_detail(spark, db, table, "Location"), path)):
        layout = bucket_layout(spark, db, new)
        same = present and spark.table(q(db, table)).schema == spark.table(q(db, new)).schema
        same = same and bucket_layout(spark, db, table) == layout
        if not (same and _options(spark, db, table) == _options(spark, db, new)):
            sort_by = table_detail(spark, db, new, "Sort Columns")
            spark.sql(f"DROP TABLE IF EXISTS {q(db, table)}")
            fs.remove_folder(f"{database_location(spark, db).rstrip('/')}/{table}")
            keys = [c.strip(" `") for c in sort_by.strip("[]").split(",")] if layout and sort_by else None
            create_final_table(spark, db, table, table, layout[0] if layout else None, keys, layout[1] if layout else 0)
        set_location(spark, db, table, path)
    spark.sql(f"DROP TABLE {q(db, new)}")


def set_location(spark: SparkSession, db: str, table: str, path: str) -> None:
    """Point a table to other files. Without the setting, the statement would turn its VARCHAR columns into STRING."""
    before = spark.conf.get(KEEP_WIDTHS, None)
    spark.conf.set(KEEP_WIDTHS, "true")
    try:
        spark.sql(f"ALTER TABLE {q(db, table)} SET LOCATION '{_quote(path)}'")
    finally:
        spark.conf.unset(KEEP_WIDTHS) if before is None else spark.conf.set(KEEP_WIDTHS, before)


def recover(spark: SparkSession, db: str, tables: list[str]) -> list[str]:
    """End replacements that a stopped load left: a complete next version takes its place, others are given up.

    Returns the tables that got their next version.
    """
    ended = []
    for t in tables:
        new = replacement_of(t)
        if not table_exists(spark, db, new):
            continue
        properties = table_detail(spark, db, new, "Table Properties") or ""
        if f"{COMPLETE}=true" in properties:
            _take_place(spark, db, t)
            ended.append(t)
        else:
            spark.sql(f"DROP TABLE {q(db, new)}")
    return ended


def _options(spark: SparkSession, db: str, table: str) -> set[str]:
    listed = table_detail(spark, db, table, "Storage Properties") or ""
    return {x.strip() for x in listed.strip("[]").split(",") if "bloom" in x}


def bucket_layout(spark: SparkSession, db: str, table: str) -> tuple[str, int] | None:
    """Bucket column and count of a table, or None."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {q(db, table)}").collect()}
    n = rows.get("Num Buckets")
    return (rows["Bucket Columns"].strip("[]`"), int(n)) if n and int(n) > 0 else None


def insert_bucketed(df: DataFrame, db: str, table: str, mode: str = "append") -> None:
    """Insert by position into a bucketed table.

    Rows are dealt to the buckets' tasks first, so a bucket gets few files;
    the rebalance lets adaptive execution split a bucket that a hot key
    swells, and a bucket may then have several files.
    """
    layout = bucket_layout(df.sparkSession, db, table)
    if layout:
        df = df.hint("rebalance", layout[0]) if layout[1] > 1 else df
    write_rows(df, db, table, mode)


def insert_apart(df: DataFrame, db: str, new: str, table: str, sort_by: list[str], flag: str, folder: str) -> None:
    """Write ``df`` (by position, ``flag`` last) once: rows without ``flag`` into ``new``, the others as Parquet into ``folder``.

    ``new`` is the empty, bucketed next version of ``table``. Rows are written
    where they are, so ``df`` should be dealt by the bucket column
    (``dealt_by_bucket``): a task then writes few buckets' files. All go to one
    table with a folder for each value of ``flag``; its files are then moved.
    """
    spark, both = df.sparkSession, f"{table}__apart"
    (key, n_buckets), place = bucket_layout(spark, db, new), table_detail(spark, db, new, "Location")
    path = f"{versions_folder(spark, db, table)}/{uuid.uuid4().hex}"
    create_final_table(spark, db, both, table, key, sort_by, n_buckets, path, flag)
    try:
        write_rows(df, db, both)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {q(db, both)}")
    for value, to in (("false", place), ("true", folder)):
        fs.makedirs(to)
        for f in fs.list_files(f"{path}/{flag}={value}", recursive=False):
            fs.move(f, f"{fs.resolve(to)[1].rstrip('/')}/{f.rsplit('/', 1)[-1]}")
    fs.remove_folder(path)
    spark.sql(f"REFRESH TABLE {q(db, new)}")


def dealt_by_bucket(spark: SparkSession, n_buckets: int):
    """Settings within which a join deals its rows in a multiple of ``n_buckets`` parts, so each part is of one bucket.

    No side is broadcast, as the other would stay as it lies; one that is small
    in every part is hashed instead of sorting both, and adaptive execution
    splits parts of over 64 MB that are much larger than the others.
    """
    each = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // n_buckets)
    return settings(spark, {
        "spark.sql.shuffle.partitions": str(n_buckets * max(2, each)),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    })


def table_definitions(spark: SparkSession, db: str, tables: list[str]) -> DataFrame:
    """table_name, position, column_name, data_type, table_comment of existing tables, from the catalog."""
    rows = []
    for t in tables:
        if table_exists(spark, db, t):
            listed = spark.sql(f"DESCRIBE TABLE EXTENDED {q(db, t)}").collect()
            at = next((i for i, r in enumerate(listed) if r.col_name.startswith("#") or not r.col_name), len(listed))
            comment = next((r.data_type for r in listed[at:] if r.col_name == "Comment"), None)
            rows += [(t, i + 1, r.col_name, r.data_type, comment) for i, r in enumerate(listed[:at])]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, table_comment string"
    )


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def set_comment(spark: SparkSession, db: str, table: str, comment: str) -> None:
    """Change a table's comment (the declared VARCHAR widths stay enforced)."""
    spark.sql(f"COMMENT ON TABLE {q(db, table)} IS '{_quote(comment)}'")


def create_base_tables(spark: SparkSession, db: str, tables: list[str] | None = None) -> None:
    for t in tables or schemas.BASE_TABLES:
        create_base_table(spark, db, t)


def create_reference_table(spark: SparkSession, db: str) -> None:
    w = schemas.REFERENCE_WIDTH
    spark.sql(f"DROP TABLE IF EXISTS {q(db, '_referencia')}")
    spark.sql(f"CREATE TABLE {q(db, '_referencia')} (referencia VARCHAR({w}), valor VARCHAR({w})) USING parquet")


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{db}.{table}")


def read(spark: SparkSession, db: str, table: str) -> DataFrame | None:
    return spark.table(q(db, table)) if table_exists(spark, db, table) else None


def write_rows(df: DataFrame, db: str, table: str, mode: str = "append") -> None:
    """Insert by position into an existing table; ``overwrite`` replaces its rows."""
    df.write.insertInto(q(db, table), overwrite=(mode == "overwrite"))


def drop_table(spark: SparkSession, db: str, table: str) -> None:
    """Drop a table with the folders of its earlier versions."""
    spark.sql(f"DROP TABLE IF EXISTS {q(db, table)}")
    fs.remove_folder(versions_folder(spark, db, table))
    fs.remove_folder(f"{database_location(spark, db).rstrip('/')}/{table}")


def rename_table(spark: SparkSession, db: str, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {q(db, old)} RENAME TO {q(db, new)}")


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """Tables of the database in name order: position (from 1) and table_name."""
    names = spark.sql(f"SHOW TABLES IN `{db}`").filter(~F.col("isTemporary")).select(F.col("tableName").alias("table_name"))
    ordered = names.agg(F.sort_array(F.collect_list("table_name")).alias("names"))  # the catalog's names, no rows of data
    return ordered.select(F.posexplode("names").alias("position", "table_name")).select(
        (F.col("position") + 1).alias("position"), "table_name"
    )


def counts(spark: SparkSession, db: str, tables: list[str], with_text: bool = False) -> DataFrame:
    """Row count per table, missing tables flagged (not fatal)."""
    return checks.table_counts(spark, {t: read(spark, db, t) for t in tables}, with_text=with_text)


def purge(spark: SparkSession, db: str, tables: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Empty every table, keeping definitions; skip empty ones; go on after a failure.

    Returns (per-table report, summary). Counts before are materialized as a
    small local frame since the tables change underneath.
    """
    names = tables if tables is not None else [r.table_name for r in list_tables(spark, db).collect()]
    before_rows = counts(spark, db, names).collect()  # one row per table
    before = spark.createDataFrame(before_rows, checks.COUNT_SCHEMA)
    failed = []  # (table, cause)
    for r in before_rows:
        if not r.present or r.n_rows == 0:
            continue
        try:
            spark.sql(f"TRUNCATE TABLE {q(db, r.table_name)}")
        except Exception as e:  # reported with its cause; the next tables are still emptied
            failed.append((r.table_name, f"{type(e).__name__}: {str(e).splitlines()[0]}"))
    if "socios" in names and database_property(spark, db, WAITING_PARTNERS):
        set_database_property(spark, db, WAITING_PARTNERS, "")  # no partner waits any longer
    spark.catalog.clearCache()
    for t in names:
        if table_exists(spark, db, t):
            spark.sql(f"REFRESH TABLE {q(db, t)}")
    # Counted now: the report stays what this purge left.
    after = spark.createDataFrame(counts(spark, db, names).collect(), checks.COUNT_SCHEMA)
    errors = spark.createDataFrame(failed, "table_name string, error string")
    return checks.purge_report(before, after, errors), checks.purge_summary(after)
