"""Replacing a table: readers find the old rows or the new ones, and a stopped load loses nothing."""

import threading
import uuid

import pytest
from test_tables import small_landing

from tabelion import schemas
from tabelion.plans import pipeline
from tabelion.plans import tables as tb
from tabelion.session import scratch_path
from tabelion.sources import fs

TABLES = ("empresas", "estabelecimento", "simples", "socios")


@pytest.fixture
def db(spark):
    name = "r_" + uuid.uuid4().hex[:8]
    tb.create_database(spark, name, scratch_path(spark, "wh", name))
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def load(spark, db, companies, **options):
    return pipeline.run_load(spark, small_landing(spark, companies), db, scratch_path(spark, "wh", db), **options)


def rows(spark, db):
    return {t: sorted(r.cnpj_basico for r in spark.table(f"{db}.{t}").collect()) for t in TABLES}


FEW, MANY = ["00000001", "00000002"], [f"0000001{i}" for i in range(5)]


def test_a_reader_finds_the_tables_at_any_time_of_a_reload(spark, db):
    load(spark, db, FEW)
    seen, failures, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            for t in TABLES:
                try:
                    seen.add((t, tuple(sorted(r.cnpj_basico for r in spark.table(f"{db}.{t}").collect()))))
                except Exception as e:
                    failures.append(f"{t}: {str(e).splitlines()[0]}")
                stop.wait(0.2)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        load(spark, db, MANY)
    finally:
        stop.set()
        reader.join()
    assert not failures
    assert {x for _, x in seen} == {tuple(FEW), tuple(MANY)}
    assert rows(spark, db) == {t: MANY for t in TABLES}


def test_versions_before_the_last_one_are_deleted(spark, db):
    one = [("00000001", *[None] * 6)]
    for n in range(1, 5):
        new = tb.begin_replacement(spark, db, "simples", "cnpj_basico", None, 2)
        tb.insert_bucketed(spark.createDataFrame(one * n, spark.table(f"{db}.{new}").schema), db, new)
        tb.finish_replacement(spark, db, "simples")
        assert spark.table(f"{db}.simples").count() == n
        types = {r.column_name: r.data_type for r in tb.table_definitions(spark, db, ["simples"]).collect()}
        assert types == {c: t.lower() for c, t in schemas.final_columns("simples")}
    folder = tb.versions_folder(spark, db, "simples")
    assert len(fs.list_folders(folder)) == 2 and fs.list_files(tb.table_detail(spark, db, "simples", "Location"))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tb.insert_bucketed(spark.createDataFrame([("0" * 9, *[None] * 6)], spark.table(f"{db}.simples").schema), db, "simples")
    tb.drop_table(spark, db, "simples")
    assert not fs.exists(folder) and fs.list_folders(folder) == []
    tb.create_base_table(spark, db, "simples")
    assert spark.table(f"{db}.simples").count() == 0


class Stopped(Exception):
    pass


def stop_at(monkeypatch, module, name, when):
    real = getattr(module, name)

    def stopping(*args, **kwargs):
        if when(*args, **kwargs):
            raise Stopped
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, stopping)


def test_a_load_that_is_stopped_before_a_version_is_complete_changes_nothing(spark, db, monkeypatch):
    load(spark, db, FEW)
    with monkeypatch.context() as m:
        stop_at(m, tb, "finish_replacement", lambda spark, db, table: True)
        with pytest.raises(Stopped):
            load(spark, db, MANY)
    assert rows(spark, db) == {t: FEW for t in TABLES}
    assert tb.table_exists(spark, db, tb.replacement_of("estabelecimento"))
    assert tb.recover(spark, db, list(TABLES)) == []
    assert not tb.table_exists(spark, db, tb.replacement_of("estabelecimento"))


@pytest.mark.parametrize("n_buckets", [None, 3])
def test_a_load_that_is_stopped_in_the_change_is_ended_by_the_next(spark, db, monkeypatch, n_buckets):
    """With another bucket count the definition changes, too: the stop is after the old one is dropped."""
    load(spark, db, FEW)
    with monkeypatch.context() as m:
        if n_buckets:
            stop_at(m, tb, "create_final_table", lambda spark, db, name, table, *a: name == table == "estabelecimento")
        else:
            stop_at(m, tb, "_take_place", lambda spark, db, table: table == "estabelecimento")
        with pytest.raises(Stopped):
            load(spark, db, MANY, n_buckets=n_buckets)
    assert tb.table_exists(spark, db, "estabelecimento") == (n_buckets is None)
    assert tb.recover(spark, db, list(TABLES)) == ["estabelecimento"]
    assert rows(spark, db)["estabelecimento"] == MANY and rows(spark, db)["empresas"] == FEW
    assert tb.recover(spark, db, list(TABLES)) == []
    if n_buckets:
        assert tb.bucket_layout(spark, db, "estabelecimento") == ("cnpj_basico", n_buckets)


def test_recovery_after_the_location_was_set_keeps_the_rows(spark, db):
    load(spark, db, FEW)
    new = tb.begin_replacement(spark, db, "simples", None, None, 1)
    tb.write_rows(spark.createDataFrame([("00000077", *[None] * 6)], spark.table(f"{db}.simples").schema), db, new)
    spark.sql(f"ALTER TABLE {db}.{new} SET TBLPROPERTIES ('{tb.COMPLETE}' = 'true')")
    spark.sql(f"ALTER TABLE {db}.simples SET LOCATION '{tb.table_detail(spark, db, new, 'Location')}'")
    assert tb.recover(spark, db, ["simples"]) == ["simples"]
    assert rows(spark, db)["simples"] == ["00000077"]
    report, _ = tb.purge(spark, db, ["simples"])
    assert [(r.before, r.after, r.status) for r in report.collect()] == [(1, 0, "emptied")]


def test_a_reload_keeps_the_bucket_count_within_a_factor_of_two(spark, db):
    assert pipeline.kept_buckets(spark, db, 20) == 20
    load(spark, db, FEW, n_buckets=10)
    assert [pipeline.kept_buckets(spark, db, n) for n in (4, 5, 20, 21)] == [4, 10, 10, 21]
