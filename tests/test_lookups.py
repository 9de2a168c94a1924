"""Access paths: what a lookup by each of the sixteen columns reads of its table."""

import uuid

import pytest
from pyspark.sql import functions as F

from tabelion import schemas
from tabelion.plans import pipeline
from tabelion.plans import tables as tb
from tabelion.session import scratch_path

N = 16_000
PATHS = [(t, c) for t, columns in schemas.ACCESS_PATHS.items() for c in columns]


@pytest.fixture(scope="module")
def db(spark):
    name = "l_" + uuid.uuid4().hex[:8]
    tb.create_database(spark, name, scratch_path(spark, "wh", name))
    for t in schemas.ACCESS_PATHS:
        if t in schemas.CODE_TABLES:
            tb.create_base_table(spark, name, t)
            codes = spark.range(90).select(F.lpad((F.col("id") + 5).cast("string"), 2, "0"), F.lit("x"))
            tb.write_rows(pipeline.lookup_layout(codes.toDF("codigo", "descricao"), t, 1), name, t)
        else:
            replace(spark, name, t, 0)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(spark, table, first):
    """N rows with keys of their own in every lookup column, in mixed order."""
    text = F.lpad((F.col("id") * 7919 % N + first).cast("string"), 8, "0")
    special = {"cnpj_basico": text, "cnpj": F.concat(text, F.lit("000199"))}
    column = lambda c: special.get(c, F.sha1(F.concat(F.lit(c), text)).substr(1, 14))
    lookups = schemas.ACCESS_PATHS[table]
    columns = [(column(c) if c in lookups else F.lit(None)).cast(t if "DECIMAL" in t else "string").alias(c) for c, t in schemas.final_columns(table)]
    return spark.range(N).select(*columns)


def replace(spark, db, table, first):
    new = tb.begin_replacement(spark, db, table, pipeline.BUCKETED.get(table), pipeline.SORTED.get(table), 8)
    pipeline.insert_rows(rows_of(spark, table, first).repartition(8), db, new, 8, "append", table)
    tb.finish_replacement(spark, db, table)


def read_by(found):
    """(rows found, rows that the scan gave) of a lookup."""
    n = len(found.collect())
    scans = found._jdf.queryExecution().executedPlan().collectLeaves()
    return n, scans.head().metrics().get("numOutputRows").get().value()


@pytest.mark.parametrize("table,column", PATHS)
def test_a_lookup_reads_a_part_of_the_table(spark, db, table, column):
    rows = spark.table(f"{db}.{table}")
    key = rows.orderBy(F.md5(column)).first()[column]
    n, read = read_by(tb.lookup(spark, db, table, column, key))
    assert n == 1
    if table not in schemas.CODE_TABLES:  # of eight files two at most: the key's, and one that a filter lets through
        assert read <= 2 * 1.2 * N / 8
    absent = "99" if column == "codigo" else str(key)[:-3] + "zzz"
    n, read = read_by(tb.lookup(spark, db, table, column, absent))
    assert n == 0 and read <= (0 if table in schemas.CODE_TABLES else 1.2 * N / 8)


def test_all_sixteen_paths_are_there(spark, db):
    assert len(PATHS) == 16
    with pytest.raises(ValueError):
        tb.lookup(spark, db, "empresas", "porte_empresa", "1")
    assert tb.lookup(spark, db, "empresas", "razao_social", None).count() == 0


def test_filters_stay_after_a_replacement_and_in_appends(spark, db):
    for step in ("replace", "append"):
        if step == "replace":
            replace(spark, db, "empresas", N)
        else:
            pipeline.insert_rows(rows_of(spark, "empresas", 2 * N).repartition(8), db, "empresas", 8, "append")
        assert tb.table_detail(spark, db, "empresas", "Storage Properties").count("enabled#razao_social=true") == 1
        rows = spark.table(f"{db}.empresas")
        key = rows.orderBy(F.desc("cnpj_basico")).first().razao_social
        n, read = read_by(tb.lookup(spark, db, "empresas", "razao_social", key))
        assert n == 1 and read <= 2 * 1.2 * N / 8


def test_a_table_without_filters_gets_them_with_its_next_version(spark, db):
    spark.sql(f"DROP TABLE {db}.socios_original")
    spark.sql(f"CREATE TABLE {db}.socios_original ({schemas.spec('socios_original').ddl()}) USING parquet")
    replace(spark, db, "socios_original", 0)
    assert "enabled#cnpj_basico=true" in tb.table_detail(spark, db, "socios_original", "Storage Properties")
    assert spark.table(f"{db}.socios_original").count() == N
