import uuid

from tabelion.session import scratch_path
from tabelion.sources import extracts, fs, registry
from tabelion.streaming import live


def test_live_counts_match_batch_and_rerun_adds_nothing(spark):
    sf = "/root/testdata/sf0.001"
    landing = extracts.landing(spark, sf)
    run = scratch_path(spark, "live-test", uuid.uuid4().hex)
    out = f"{run}/counts"
    q = live.live_counts(spark, landing, f"{run}/ckpt", out, files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress is not None
    streamed = {r.table_name: r.n_rows for r in live.published_counts(spark, out).collect()}
    batch = {}
    for r in registry.file_row_counts_all(spark, landing).collect():
        batch[r.table_name] = batch.get(r.table_name, 0) + r.n_rows
    assert streamed == batch and len(streamed) == 10
    # same checkpoint, nothing new: no batch runs, the published counts stay
    q2 = live.live_counts(spark, landing, f"{run}/ckpt", out, files_per_trigger=1)
    q2.awaitTermination()
    assert q2.recentProgress == [] or all(p["numInputRows"] == 0 for p in q2.recentProgress)
    assert {r.table_name: r.n_rows for r in live.published_counts(spark, out).collect()} == streamed


def test_live_latest_listing(spark):
    sf = "/root/testdata/sf0.001"
    landing = extracts.landing(spark, sf)
    run = scratch_path(spark, "live-latest", uuid.uuid4().hex)
    q = live.live_latest(spark, landing, "empresas", f"{run}/ckpt", f"{run}/table", f"{run}/latest", files_per_trigger=3)
    q.awaitTermination()
    stored = spark.read.parquet(f"{run}/table")
    assert stored.count() == registry.read_table(spark, landing, "empresas").count()
    latest = live.latest_listing(spark, "empresas", f"{run}/latest").orderBy("cnpj_basico", ascending=False).collect()
    top = [r.cnpj_basico for r in stored.orderBy("cnpj_basico", ascending=False).limit(3).collect()]
    assert [r.cnpj_basico for r in latest] == top
    assert len({p.split("batch_id=")[1].split("/")[0] for p in fs.list_files(f"{run}/latest")}) >= 3
    assert fs.exists(f"{run}/ckpt")


def test_monitor_publishes_counts_and_both_listings(spark):
    """A reader during publishing sees finished batches only."""
    landing = extracts.landing(spark, "/root/testdata/sf0.001")
    run = scratch_path(spark, "monitor", uuid.uuid4().hex)
    assert live.monitor_report(spark, f"{run}/out") == {}
    streams = live.monitor(spark, landing, f"{run}/ckpt", f"{run}/out", available_now=True)
    while any(q.isActive for q in streams):
        for df in live.monitor_report(spark, f"{run}/out").values():
            assert df.count() > 0
    report = live.monitor_report(spark, f"{run}/out")
    assert set(report) == {"counts", "estabelecimento", "empresas"}
    assert report["counts"].count() == 10 and report["estabelecimento"].count() == 5 and report["empresas"].count() == 3


def test_a_missing_previous_listing_is_an_error(spark):
    import pytest

    landing = extracts.landing(spark, "/root/testdata/sf0.001")
    run = scratch_path(spark, "live-missing", uuid.uuid4().hex)
    live.live_latest(spark, landing, "empresas", f"{run}/ckpt", f"{run}/table", f"{run}/latest", 5).awaitTermination()
    first = {p for p in fs.list_files(landing) if p.endswith("EMPRECSV")}
    assert len(first) == 10
    copy = f"{run}/more"
    fs.makedirs(copy)
    f, p = fs.resolve(copy)
    f.copy_file(sorted(first)[0], f"{p}/K.Y0.D30610.EMPRECSV")
    # The same checkpoint goes on with another listing folder, in which the batch before is missing.
    extracts_folder = fs.resolve(landing)[1]
    f.copy_file(sorted(first)[0], f"{extracts_folder}/K3241.K03200Y0X.D30610.EMPRECSV")
    try:
        q = live.live_latest(spark, landing, "empresas", f"{run}/ckpt", f"{run}/table", f"{run}/other", 5)
        with pytest.raises(Exception, match="missing"):
            q.awaitTermination()
    finally:
        f.delete_file(f"{extracts_folder}/K3241.K03200Y0X.D30610.EMPRECSV")
