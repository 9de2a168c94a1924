"""Appending a delivery: rows are compared, not totals, so deliveries may come in any order, overlap or be repeated.

Tables are bags of rows (the registry declares no keys). After an append a table
holds each row as often as the stored table or the delivery did, whichever is
more. So one delivery twice is one, and two in either order are the same table.

Partners are derived anew for the companies that a delivery touches, by its
partners or by its head offices: a head office may come after its partners, and
a second one doubles them. Partners whose company has no head office so far wait
beside the tables; the database's properties name the folder, so that replacing
it is one metadata change.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabelion import schemas
from tabelion.operators import derive
from tabelion.plans import tables as tb
from tabelion.session import measured_broadcasts, scratch_path

ROW = "_row_id"
KEY = "cnpj_basico"
#: Joining on more columns than a bucketed table is dealt by needs no shuffle of that table without this setting.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


class LostRows(ValueError):
    """After an append, rows that were read are neither added nor found stored."""


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once under the shared scratch folder, and read back."""
    path = scratch_path(df.sparkSession, "append", f"{label}-{uuid.uuid4().hex}")
    with measured_broadcasts(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketwise(spark: SparkSession):
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)


def row_id(columns: list[str], table: str) -> Column:
    """A hash of all the row's values as ``table`` stores them (blanks over a column's width are cut off)."""
    widths = {c: int(t[8:-1]) for c, t in schemas.final_columns(table) if t.upper().startswith("VARCHAR")}
    stored = [F.left(F.col(c), F.lit(widths[c])).alias(c) if c in widths else F.col(c) for c in columns]
    return F.sha2(F.to_json(F.struct(*stored)), 256)


def compared(stored: DataFrame, incoming: DataFrame, table: str, by_bucket: bool = False) -> DataFrame:
    """The distinct rows of ``incoming`` plus ``_n`` and ``_there``: how often each is incoming and stored.

    Equal rows are counted before they are dealt. With ``by_bucket`` (for
    tables of a row a company) the stored table is read where its buckets lie;
    else both sides are dealt by company and row, so a company with very many
    rows is spread.
    """
    columns = incoming.columns
    many = incoming.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn(ROW, row_id(columns, table))
    there = stored.select(KEY, row_id(columns, table).alias(ROW))
    there = there if by_bucket else there.repartition(KEY, ROW)
    there = there.groupBy(KEY, ROW).agg(F.count("*").alias("_there"))
    both = many.join(there, [KEY, ROW], "left")
    return both.select(*columns, "_n", F.coalesce("_there", F.lit(0).cast("long")).alias("_there"))


def lacking(both: DataFrame) -> DataFrame:
    """The rows of ``compared`` as often as the stored table lacks them."""
    columns = [c for c in both.columns if c not in ("_n", "_there")]
    more = both.where("_n > _there").select(*columns, (F.col("_n") - F.col("_there")).alias("_more"))
    # In blocks, so that no array of copies is longer than 10,000.
    blocks = more.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_more - 1) div 10000"))))
    here = F.least(F.lit(10000).cast("long"), F.col("_more") - F.col("_block") * 10000)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), here))).select(*columns)


def delta(stored: DataFrame, incoming: DataFrame, table: str, by_bucket: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """The rows to add, staged, and counts: read, added, already stored."""
    seen = Observation()
    zero = F.lit(0).cast("long")
    counted = compared(stored, incoming, table, by_bucket).observe(
        seen,
        F.coalesce(F.sum("_n"), zero).alias("read"),
        F.coalesce(F.sum(F.greatest(F.col("_n") - F.col("_there"), zero)), zero).alias("added"),
        F.coalesce(F.sum(F.least("_n", "_there")), zero).alias("already"),
    )
    with bucketwise(stored.sparkSession):
        rows = staged(lacking(counted), table)
    return rows, dict(seen.get)


def waiting_partners(spark: SparkSession, db: str) -> DataFrame | None:
    path = tb.database_property(spark, db, tb.WAITING_PARTNERS)
    return spark.read.parquet(path).drop("cnpj") if path else None


def waiting_folder(location: str) -> str:
    """A new folder for the partners that wait for a head office."""
    return f"{location.rstrip('/')}/_{tb.WAITING_PARTNERS}/{uuid.uuid4().hex}"


def keep_waiting(spark: SparkSession, db: str, location: str, partners: DataFrame) -> None:
    """Replace the partners that wait for a head office. The old ones stay until the new ones are written."""
    path = waiting_folder(location)
    with measured_broadcasts(spark):
        partners.write.parquet(path)
    tb.set_database_property(spark, db, tb.WAITING_PARTNERS, path)


def without_office(partners: DataFrame, offices: DataFrame) -> DataFrame:
    return partners.join(offices.select(F.col("_hq_basico").alias(KEY)), KEY, "left_anti").select(*partners.columns)


def partners_before(rows: DataFrame, offices: DataFrame, columns: list[str]) -> DataFrame:
    """The partners that ``rows`` (of the derived table) were made from, given the head ``offices`` of that time.

    A partner has one row for each head office, so those of a company's
    first number, divided by how often this number occurs, are the partners.
    """
    first = rows.groupBy(KEY).agg(F.min("cnpj").alias("cnpj"))
    times = offices.groupBy(F.col("_hq_basico").alias(KEY), "cnpj").agg(F.count("*").alias("_times"))
    one = rows.join(first.join(times, [KEY, "cnpj"]), [KEY, "cnpj"])
    counted = one.groupBy(*columns).agg(F.count("*").alias("_n"), F.max("_times").alias("_times"))
    zero = F.lit(0).cast("long")
    return lacking(counted.select(*columns, F.expr("_n div _times").alias("_n"), zero.alias("_there")))


def append_partners(spark: SparkSession, db: str, location: str, new_offices: DataFrame) -> dict[str, int]:
    """Bring ``socios`` up to date with the staged partners and the head offices that this delivery added."""
    arrived = tb.read(spark, db, "socios_original")
    columns = arrived.columns
    stored, offices = tb.read(spark, db, "socios"), derive.head_offices(tb.read(spark, db, "estabelecimento"))
    waiting = waiting_partners(spark, db)
    waiting = arrived.limit(0) if waiting is None else waiting.select(*columns)

    touched = staged(arrived.select(KEY).union(new_offices.select("_hq_basico")).distinct(), "companies")
    offices = staged(offices.join(touched, F.col("_hq_basico") == F.col(KEY), "left_semi"), "offices")
    rows = staged(stored.join(touched, KEY, "left_semi").select(*stored.columns), "rows")
    # Offices of before: all of now less those that came.
    came = new_offices.groupBy("_hq_basico", "cnpj").agg(F.count("*").alias("_there"))
    now = offices.groupBy("_hq_basico", "cnpj").agg(F.count("*").alias("_n")).join(came, ["_hq_basico", "cnpj"], "left")
    old_offices = lacking(now.select("_hq_basico", "cnpj", "_n", F.coalesce("_there", F.lit(0).cast("long")).alias("_there")))

    held = partners_before(rows, old_offices, columns).unionByName(waiting.join(touched, KEY, "left_semi").select(*columns))
    held = staged(held, "held")
    partners = staged(held.unionByName(delta(held, arrived, "socios_original")[0]), "partners")
    more, counts = delta(rows, derive.partners_of(partners, offices.hint("rebalance")), "socios")
    tb.insert_bucketed(more, db, "socios", "append")
    untouched = waiting.join(touched, KEY, "left_anti").select(*columns)
    keep_waiting(spark, db, location, untouched.unionByName(without_office(partners, offices)))
    return counts
