import uuid

import pytest

from tabelion import schemas
from tabelion.plans import pipeline
from tabelion.plans import tables as tb
from tabelion.session import scratch_path
from tabelion.sources import extracts


@pytest.fixture
def db(spark):
    name = "t_" + uuid.uuid4().hex[:8]
    tb.create_database(spark, name, scratch_path(spark, "wh", name))
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_ddl_widths_and_comments(spark, db):
    tb.create_base_tables(spark, db)
    names = {r.table_name for r in tb.list_tables(spark, db).collect()}
    assert names == set(schemas.BASE_TABLES)
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.cnae").collect()}
    assert desc["codigo"] == "varchar(7)" and "Atividades" in desc.get("Comment", "")
    tb.set_comment(spark, db, "cnae", "CNAE d'Ávila")
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.cnae").collect()}
    assert desc["Comment"] == "CNAE d'Ávila"
    ok = spark.createDataFrame([("abc    ", "x")], "codigo string, descricao string")
    tb.write_rows(ok, db, "pais")  # trailing blanks over the width are trimmed
    assert spark.table(f"{db}.pais").first().codigo == "abc"
    bad = spark.createDataFrame([("abcd", "x")], "codigo string, descricao string")
    with pytest.raises(Exception):
        tb.write_rows(bad, db, "pais")


def test_presence_and_state(spark, db):
    tb.create_base_tables(spark, db, ["cnae", "pais"])
    from tabelion.operators import checks

    pres = {r.table_name: r.present for r in checks.presence(spark, ["cnae", "motivo"], tb.list_tables(spark, db)).collect()}
    assert pres == {"cnae": True, "motivo": False}
    tb.write_rows(spark.createDataFrame([("1", "a")], "codigo string, descricao string"), db, "pais")
    state = {r.table_name: (r.state, r.n_rows) for r in checks.derived_state(tb.counts(spark, db, ["cnae", "pais", "x"])).collect()}
    assert state == {"cnae": ("empty", 0), "pais": ("filled", 1), "x": ("absent", 0)}


def test_load_rerun_and_purge(spark, db):
    sf = "/root/testdata/sf0.001"
    landing = extracts.landing(spark, sf)
    loc = scratch_path(spark, "wh", db)
    first = pipeline.run_load(spark, landing, db, loc)
    assert all(d["decision"] == "insert" for d in first.decisions)
    assert {r.state for r in first.state_before} == {"absent"}
    assert all(r.matches for r in first.reconciliation.collect())
    snap = {t: sorted(tuple(r) for r in spark.table(f"{db}.{t}").collect()) for t in ("socios", "empresas", "_referencia")}
    again = pipeline.run_load(spark, landing, db, loc)
    assert {d["table_name"]: d["decision"] for d in again.decisions}["empresas"] == "skip"
    before = {r.table_name: r.state for r in again.state_before}
    assert before["socios"] == "filled" and before["socios_original"] == "absent"
    for t, rows in snap.items():
        assert sorted(tuple(r) for r in spark.table(f"{db}.{t}").collect()) == rows
    assert not tb.table_exists(spark, db, "socios_original")
    integ = {r.check_name: r.n_rows for r in pipeline.integrity(spark, db).collect()}
    assert integ["estabelecimento_socios"] == integ["socios"]
    report, summary = tb.purge(spark, db)
    assert all(r.after == 0 for r in report.collect())
    s = summary.first()
    assert s.total_left == 0 and s.tables_with_rows == []
    assert {r.table_name for r in tb.list_tables(spark, db).collect()} >= {"socios", "empresas"}


def test_bucketed_join_has_no_exchange(spark, db):
    sf = "/root/testdata/sf0.001"
    pipeline.run_load(spark, extracts.landing(spark, sf), db, scratch_path(spark, "wh", db))
    e, est = spark.table(f"{db}.empresas"), spark.table(f"{db}.estabelecimento")
    j = e.select("cnpj_basico").join(est.select("cnpj_basico"), "cnpj_basico")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange hashpartitioning" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_count_scales_with_input(spark):
    from tabelion.plans.pipeline import BUCKET_TARGET_BYTES, bucket_count

    class Fake:
        def __init__(self, size):
            self.size = size

        def files(self, names):
            return spark.createDataFrame(
                [("estabelecimento", "f", self.size), ("simples", "g", 10)], "table_name string, file_name string, size_bytes long"
            )

    assert bucket_count(Fake(1000), ["x"]) == 8
    assert bucket_count(Fake(100 * BUCKET_TARGET_BYTES + 1), ["x"]) == 101
    assert bucket_count(Fake(100_000 * BUCKET_TARGET_BYTES), ["x"]) == 100_000  # no cap
    landing = extracts.landing(spark, "/root/testdata/sf0.001")
    files = pipeline.FolderSource(spark, landing).files(pipeline.MAIN_ORDER).collect()
    assert {r.table_name for r in files} == set(pipeline.MAIN_ORDER) and all(r.size_bytes > 0 for r in files)


def small_landing(spark, companies, offices=None, partners=None, bad=False):
    """A folder of extracts with the given companies, an office and a partner each, and one row in every other table."""
    from pyspark.sql import functions as F

    from tabelion.sources import fs

    root = scratch_path(spark, "small", uuid.uuid4().hex)
    fs.makedirs(root)
    rows = []
    for t in schemas.CODE_TABLES:
        rows.append((f"F.Z.D30610{schemas.spec(t).suffix}", "1", '"1";"x"'))
    for c in companies:
        rows.append(("K.Y0.D30610.EMPRECSV", c, f'"{c}";"nome";"1";"1";"10,50";"01";""' + (';"more"' if bad else "")))
        rows.append(("K.Y0.D30610.ESTABELE", c, f'"{c}";"0001";"99";"1"'))
        for i in range((partners or {}).get(c, 1)):
            rows.append(("K.Y0.D30610.SOCIOCSV", c, f'"{c}";"1";"socio {i}"'))
        rows.append(("F.W.SIMPLES.CSV.D30610", c, f'"{c}";"S"'))
    df = spark.createDataFrame(rows, "_file string, _key string, line string").select("_file", F.col("_key"), "line")
    extracts.write_lines(df, root)
    return root


def test_append_keeps_the_rows_of_derived_tables(spark, db):
    loc = scratch_path(spark, "wh", db)
    pipeline.run_load(spark, small_landing(spark, ["00000001", "00000002"]), db, loc)
    more = small_landing(spark, [f"0000001{i}" for i in range(5)])
    res = pipeline.run_load(spark, more, db, loc, mode="append")
    assert {d["table_name"]: d["decision"] for d in res.decisions}["empresas"] == "append"
    for t in ("empresas", "estabelecimento", "socios", "simples"):
        assert spark.table(f"{db}.{t}").count() == 7, t
    assert all(r.matches for r in res.reconciliation.collect() if r.table_name in pipeline.MAIN_ORDER)
    assert {str(r.capital_social) for r in spark.table(f"{db}.empresas").collect()} == {"10.50"}


def test_rejected_records_stop_the_load_or_are_stored(spark, db):
    loc = scratch_path(spark, "wh", db)
    landing = small_landing(spark, ["00000001", "00000002"], bad=True)
    with pytest.raises(pipeline.RejectedRows, match="2 records .*K.Y0.D30610.EMPRECSV: 2"):
        pipeline.run_load(spark, landing, db, loc)
    assert spark.table(f"{db}.empresas").count() == 0 if tb.table_exists(spark, db, "empresas") else True
    res = pipeline.run_load(spark, landing, db, loc, strict_rows=False)
    assert res.n_rejected == 2
    row = {r.table_name: r for r in res.reconciliation.collect()}["empresas"]
    assert (row.expected, row.rejected, row.stored, row.matches) == (0, 2, 0, False)
    kept = spark.table(f"{db}._rejeitados").collect()
    assert {(r.table_name, r.cause) for r in kept} == {("empresas", "too_long")} and all("more" in r.line for r in kept)


def test_definitions_after_the_load(spark, db):
    pipeline.run_load(spark, small_landing(spark, ["00000001"]), db, scratch_path(spark, "wh", db))
    names = ["empresas", "estabelecimento", "socios", "pais"]
    got = {(r.table_name, r.column_name): r for r in tb.table_definitions(spark, db, names).collect()}
    assert got["estabelecimento", "cnpj"].data_type == "varchar(14)" and got["empresas", "capital_social"].data_type == "decimal(18,2)"
    for t in ("empresas", "estabelecimento", "pais"):
        assert got[t, schemas.spec(t).names[0]].table_comment == schemas.TABLE_COMMENTS[t]
    assert [r.table_name for r in tb.list_tables(spark, db).collect()] == sorted(r.table_name for r in tb.list_tables(spark, db).collect())


def test_purge_goes_on_after_a_failure_and_says_why(spark, db):
    tb.create_base_tables(spark, db, ["cnae", "pais"])
    one = spark.createDataFrame([("1", "a")], "codigo string, descricao string")
    tb.write_rows(one, db, "cnae")
    tb.write_rows(one, db, "pais")
    spark.sql(f"CREATE VIEW {db}.aa_view AS SELECT * FROM {db}.cnae")
    report, summary = tb.purge(spark, db)
    got = {r.table_name: (r.before, r.after, r.status, r.error) for r in report.collect()}
    assert got["pais"] == (1, 0, "emptied", None) and got["aa_view"][2] == "failed" and got["aa_view"][3]


def test_hot_company_is_spread_in_the_partner_load(spark, db):
    """A company with a third of the partners: with broadcasting off, no task of the join reads most of them."""
    from pyspark.sql import functions as F

    from tabelion.operators import derive

    partners = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("00000007")).otherwise(F.lpad(F.col("id").cast("string"), 8, "0")).alias("cnpj_basico"),
        F.md5(F.col("id").cast("string")).alias("nome_socio"),
    )
    est = spark.range(90_000).select(
        F.lpad(F.col("id").cast("string"), 8, "0").alias("cnpj_basico"), F.lit("1").alias("matriz_filial"), F.col("id").cast("string").alias("cnpj")
    )
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        offices = derive.head_offices(est.repartition(8)).hint("rebalance")
        rows = derive.partners_of(partners.repartition(8), offices)
        by_task = rows.withColumn("p", F.spark_partition_id()).groupBy("p")
        sizes = [r.n for r in by_task.agg(F.count("*").alias("n"), F.max("nome_socio")).collect()]
        assert sum(sizes) == 90_000 and max(sizes) < 30_000 / 2
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_partners_are_dealt_once_for_the_table_and_those_that_wait(spark, db, monkeypatch):
    """One job writes both; its join deals the rows to the buckets, a task for each at most, and broadcasts nothing."""
    from pyspark.sql import functions as F

    from tabelion.plans import append, pipeline
    from tabelion.sources import fs

    key = F.lpad(F.col("id").cast("string"), 8, "0")
    tb.create_base_table(spark, db, "socios_original")
    so = spark.range(600).select(F.when(F.col("id") < 599, F.lpad((F.col("id") % 60).cast("string"), 8, "0")).alias("cnpj_basico"), F.col("id").cast("string").alias("nome_socio"))
    tb.write_rows(extracts.pad_to_spec(so, "socios_original"), db, "socios_original")
    tb.create_final_table(spark, db, "estabelecimento", "estabelecimento", "cnpj_basico", None, 3)
    est = spark.range(50).select(key.alias("cnpj_basico"), F.lit("0001").alias("cnpj_ordem"), F.lit("11").alias("cnpj_dv"), F.lit("1").alias("matriz_filial"))
    est = est.union(est.where("cnpj_basico = '00000007'").withColumn("cnpj_ordem", F.lit("0002")))  # two head offices
    tb.write_rows(pipeline.derived("estabelecimento", extracts.pad_to_spec(est, "estabelecimento")), db, "estabelecimento")
    plans, write = [], tb.write_rows
    monkeypatch.setattr(tb, "write_rows", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a))
    monkeypatch.setattr(append, "without_office", None)  # a second join
    pipeline.load_partners(spark, db, "overwrite", 3)
    assert len(plans) == 1 and "Broadcast" not in plans[0] and "REBALANCE_PARTITIONS_BY_COL" not in plans[0]
    assert plans[0].count("Exchange hashpartitioning") == 2  # partners and offices, for the join
    socios = spark.table(f"{db}.socios")
    offices = {r.cnpj for r in socios.where("nome_socio = '7'").select("cnpj").collect()}
    assert socios.count() == 500 + 10 and offices == {"00000007000111", "00000007000211"}
    waiting = append.waiting_partners(spark, db)
    assert waiting.columns == spark.table(f"{db}.socios").columns[1:] and waiting.where("cnpj_basico is null").count() == 1
    assert {int(r.nome_socio) for r in waiting.collect()} == {i for i in range(600) if i % 60 >= 50 or i == 599}
    found = {r.f: r.n for r in socios.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()}
    assert len({f.split("_")[-1] for f in found}) == 3 and tb.bucket_layout(spark, db, "socios") == ("cnpj_basico", 3)
    again = spark.table(f"{db}.estabelecimento").join(socios, "cnpj_basico")
    assert again.count() == 490 + 2 * 20  # read by bucket, nothing is missed
    versions = fs.list_folders(tb.versions_folder(spark, db, "socios"))
    assert len(versions) == 1 and not tb.table_exists(spark, db, "socios__apart")
    # None waits: an empty folder of the partners' columns.
    tb.create_base_table(spark, db, "socios_original")
    tb.write_rows(extracts.pad_to_spec(so.where("cnpj_basico < '00000050'"), "socios_original"), db, "socios_original")
    pipeline.load_partners(spark, db, "overwrite", 3)
    none = append.waiting_partners(spark, db)
    assert none.count() == 0 and none.columns == waiting.columns and spark.table(f"{db}.socios").count() == 510
