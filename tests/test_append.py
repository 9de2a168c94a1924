"""Appending deliveries: any order, overlaps, repeats, late head offices and late partners give the tables of one load."""

import random
import uuid

import pytest

from tabelion import schemas
from tabelion.plans import append, pipeline
from tabelion.plans import tables as tb
from tabelion.session import scratch_path
from tabelion.sources import extracts, fs

FINAL = ("empresas", "estabelecimento", "socios", "simples")


@pytest.fixture
def fresh(spark):
    made = []

    def new():
        db = f"t_{uuid.uuid4().hex[:8]}"
        made.append(db)
        return db, scratch_path(spark, "wh", db)

    yield new
    for db in made:
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


def delivery(spark, companies=(), offices=(), partners=(), simples=()):
    """A folder of extracts: companies by key, offices (company, order, head?), partners (company, name)."""
    rows = [(f"F.Z.D30610{schemas.spec(t).suffix}", '"1";"x"') for t in schemas.CODE_TABLES]
    rows += [("K.Y0.D30610.EMPRECSV", f'"{c}";"nome {c}";"1";"1";"{v}";"01";""') for c, v in companies]
    rows += [("K.Y0.D30610.ESTABELE", f'"{c}";"{o}";"99";"{h}"') for c, o, h in offices]
    rows += [("K.Y0.D30610.SOCIOCSV", f'"{c}";"1";"{name}"') for c, name in partners]
    rows += [("F.W.SIMPLES.CSV.D30610", f'"{c}";"S"') for c in simples]
    root = scratch_path(spark, "small", uuid.uuid4().hex)
    fs.makedirs(root)
    df = spark.createDataFrame([(f, str(i), x) for i, (f, x) in enumerate(rows)], "_file string, _key string, line string")
    extracts.write_lines(df, root)
    have = {f for f, _ in rows}
    for t, name in (("empresas", "K.Y0.D30610.EMPRECSV"), ("estabelecimento", "K.Y0.D30610.ESTABELE"), ("socios_original", "K.Y0.D30610.SOCIOCSV"), ("simples", "F.W.SIMPLES.CSV.D30610")):
        if name not in have:
            fs.touch(f"{root}/{name}")
    return root


def load(spark, fresh, *roots, first="overwrite"):
    db, loc = fresh()
    out = None
    for i, root in enumerate(roots):
        out = pipeline.run_load(spark, root, db, loc, mode=first if i == 0 else "append")
    return {t: sorted(map(str, spark.table(f"{db}.{t}").collect())) for t in FINAL}, out, db


def test_orders_overlaps_and_repeats_give_the_tables_of_one_load(spark, fresh):
    pick = random.Random(3)
    keys = [f"{i:08d}" for i in range(14)]
    companies = [(k, "10,50") for k in keys] + [(keys[0], "10,50")]  # a row that is there twice
    offices = [(k, "0001", "1") for k in keys[:11]] + [(k, "0002", "2") for k in keys] + [(k, "0003", "1") for k in keys[:3]]
    partners = [(k, f"socio {i}") for k in keys for i in range(3)] + [(keys[1], "socio 0")] * 2
    whole = dict(companies=companies, offices=offices, partners=partners, simples=keys)
    want, _, _ = load(spark, fresh, delivery(spark, **whole))
    assert len(want["socios"]) == 3 * 11 + 3 * 3 + 2 * 2
    # The copies of a row are in one part; else every row goes to the first part, the second or both.
    parts = ({}, {})
    for table, rows in whole.items():
        put = {r: pick.choice([(0,), (1,), (1,), (0, 1)]) for r in sorted(set(rows))}
        for i in (0, 1):
            parts[i][table] = [r for r in rows if i in put[r]]
    roots = [delivery(spark, **p) for p in parts]
    for order in ((0, 1, 0), (1, 0)):
        got, res, db = load(spark, fresh, *(roots[i] for i in order), first="append")
        assert got == want
        last = {d["table_name"]: d for d in res.decisions}
        for t in ("empresas", "estabelecimento", "simples") if len(order) == 3 else ():
            assert last[t]["decision"] == "skip" and last[t]["added"] == 0 and last[t]["already"] == last[t]["expected"]
        assert all(r.matches for r in res.reconciliation.collect())
        waiting = append.waiting_partners(spark, db)
        assert sorted((r.cnpj_basico, r.nome_socio) for r in waiting.collect()) == [(k, f"socio {i}") for k in keys[11:] for i in range(3)]


def test_smaller_second_delivery_and_late_head_offices(spark, fresh):
    a = delivery(spark, [("00000001", "1,00"), ("00000002", "1,00"), ("00000003", "1,00")], [("00000001", "0001", "1"), ("00000002", "0001", "2")], [("00000002", "late office"), ("00000001", "here")], ["00000001"])
    b = delivery(spark, [("00000004", "1,00")], [("00000002", "0002", "1"), ("00000001", "0009", "1")], [("00000001", "late partner")], ["00000004"])
    got, res, db = load(spark, fresh, a, b)
    assert {d["table_name"]: d["decision"] for d in res.decisions}["empresas"] == "append"
    names = sorted((r.cnpj, r.nome_socio) for r in spark.table(f"{db}.socios").collect())
    assert names == [
        ("00000001000199", "here"), ("00000001000199", "late partner"), ("00000001000999", "here"),
        ("00000001000999", "late partner"), ("00000002000299", "late office"),
    ]
    assert res.partners["added"] == 4 and append.waiting_partners(spark, db).count() == 0


def test_changed_rows_are_added_and_empty_deliveries_change_nothing(spark, fresh):
    a = delivery(spark, [("00000001", "1,00")], [("00000001", "0001", "1")], [("00000001", "x")], ["00000001"])
    changed = delivery(spark, [("00000001", "2,00")], [("00000001", "0001", "1")])
    got, res, db = load(spark, fresh, a, changed, delivery(spark))
    assert sorted(str(r.capital_social) for r in spark.table(f"{db}.empresas").collect()) == ["1.00", "2.00"]
    assert [len(got[t]) for t in FINAL] == [2, 1, 1, 1]


def test_lost_rows_fail_the_load(spark, fresh, monkeypatch):
    a = delivery(spark, [("00000001", "1,00")], [("00000001", "0001", "1")], [("00000001", "x")], ["00000001"])
    b = delivery(spark, [("00000002", "1,00")], [("00000002", "0001", "1")], [("00000002", "x")], ["00000002"])
    whole = append.delta
    monkeypatch.setattr(append, "delta", lambda s, i, t, **o: whole(s, i.limit(0), t, **o) if t == "simples" else whole(s, i, t, **o))
    with pytest.raises(append.LostRows, match="simples: 1 expected, 0 read"):
        load(spark, fresh, a, b)


def test_many_copies_and_cut_blanks(spark):
    wide = spark.createDataFrame([("00000001", "S" + " " * 9)], "cnpj_basico string, opcao_simples string")
    stored = spark.createDataFrame([("00000001", "S")], "cnpj_basico string, opcao_simples string")
    assert append.compared(stored, wide, "simples").first()["_there"] == 1
    rows = spark.createDataFrame([("a", 25_001, 1), ("b", 2, 2), ("c", 1, 5)], "k string, _n long, _there long")
    assert [(r.k, r["count"]) for r in append.lacking(rows).groupBy("k").count().collect()] == [("a", 25_000)]


def test_companies_are_compared_without_a_shuffle_of_the_stored_table(spark, fresh):
    a = delivery(spark, [(f"{i:08d}", "1,00") for i in range(50)], [("00000001", "0001", "1")], [("00000001", "x")], ["00000001"])
    _, _, db = load(spark, fresh, a)
    stored = tb.read(spark, db, "empresas")
    incoming = spark.createDataFrame(stored.limit(5).collect(), stored.schema)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        with append.bucketwise(spark):
            text = append.compared(stored, incoming, "empresas", by_bucket=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    # The incoming rows are dealt twice (to count equal ones, and to the buckets), the stored ones never.
    assert text.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in text


def test_stored_rows_are_not_sent_to_all_tasks_for_the_size_of_their_files(spark, fresh, monkeypatch):
    """Before rows are counted, no join of an append may broadcast: the files of millions of rows can be small."""
    from pyspark.sql import DataFrameWriter

    a, b = (
        delivery(spark, [(f"{i:08d}", "1,00") for i in some], [(f"{i:08d}", "0001", "1") for i in some], [(f"{i:08d}", "x") for i in some], [f"{i:08d}" for i in some])
        for some in (range(40), range(20, 60))
    )
    _, _, db = load(spark, fresh, a)
    plans, write = {}, DataFrameWriter.parquet

    def seen(self, path, *args, **kw):
        label = path.rsplit("/append/", 1)[-1].split("-")[0] if "/append/" in path else "waiting" if tb.WAITING_PARTNERS in path else ""
        if label:
            plans.setdefault(label, []).append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        pipeline.run_load(spark, b, db, tb.database_location(spark, db), mode="append")
        found = {k: spark.conf.get(k, None) for k in kept}
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert found == kept | {"spark.sql.adaptive.enabled": "false"}
    assert plans.keys() >= {"empresas", "estabelecimento", "simples", "socios", "socios_original", "offices", "rows", "held", "waiting"}
    assert [k for k, v in plans.items() if any("Broadcast" in p for p in v)] == []
    assert all(spark.table(f"{db}.{t}").count() == 60 for t in FINAL)
