import uuid

from tabelion.__main__ import main
from tabelion.session import scratch_path
from tabelion.sources import extracts


def test_create_load_counts_purge(spark, capsys, monkeypatch):
    import tabelion.__main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda master=None: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    landing = extracts.landing(spark, "/root/testdata/sf0.001")
    db = "cli_" + uuid.uuid4().hex[:8]
    loc = scratch_path(spark, "wh", db)
    assert main(["create", "--db", db, "--location", loc]) == 0
    assert main(["load", "--source", landing, "--db", db, "--location", loc]) == 0
    out = capsys.readouterr().out
    assert "estabelecimento" in out and "insert" in out and "cnpj_qtde" in out
    assert main(["counts", "--db", db]) == 0 and main(["latest", "--db", db]) == 0
    assert main(["purge", "--db", db]) == 2
    assert main(["purge", "--db", db, "--yes"]) == 0
    assert "emptied" in capsys.readouterr().out
    spark.sql(f"DROP DATABASE {db} CASCADE")
