import pytest
from pyspark.sql import functions as F

from conftest import write_bytes
from tabelion.sources import registry


def test_main_table_edge_rows(spark, folder):
    uri, local = folder
    rows = [
        b'"1";"A""B";"x";"";"";"";""',
        b'"1";"x;y";"z";"";"";"";""',
        b'2;;"";;;;',
        b'"4";"s"',
        b"1;2;3;4;5;6;7;8",
        b'"5";"\xe7\xe3o";"";"";"";"";""',
    ]
    write_bytes(local, "K.Y0.D30610.EMPRECSV", b"\n".join(rows) + b"\n")
    with pytest.raises(Exception, match="too_long"):
        registry.read_table(spark, uri, "empresas").collect()
    df = registry.read_table(spark, uri, "empresas", strict=False)
    got = {tuple(r) for r in df.collect()}
    assert ("1", 'A"B', "x", "", "", "", "") in got
    assert ("1", "x;y", "z", "", "", "", "") in got
    assert ("2", "", "", "", "", "", "") in got
    assert ("4", "s", "", "", "", "", "") in got
    assert ("5", "ção", "", "", "", "", "") in got
    assert df.count() == 5
    assert [tuple(r) for r in registry.rejected_rows(spark, uri).collect()] == [
        ("empresas", "K.Y0.D30610.EMPRECSV", "too_long", 1)
    ]
    counts = registry.file_row_counts_all(spark, uri).first()
    assert (counts.n_rows, counts.n_rejected) == (5, 1)


def test_code_list_missing_tokens_are_null(spark, folder):
    uri, local = folder
    write_bytes(local, "F.Z.D30610.MOTICSV", b'"01";""\n"02";NA\n"03";\n"04";"NULL"\n"05";"ok"\n')
    df = registry.read_table(spark, uri, "motivo")
    got = dict((r.codigo, r.descricao) for r in df.collect())
    assert got == {"01": None, "02": None, "03": None, "04": None, "05": "ok"}


def test_several_files_make_one_table(spark, folder):
    uri, local = folder
    write_bytes(local, "K.Y0.D30610.ESTABELE", b'"00000001";"0001"\n')
    write_bytes(local, "K.Y1.D30610.ESTABELE", b'"00000002";"0001"\n"00000003";"0001"\n')
    write_bytes(local, "K.Y1.D30610.SOCIOCSV", b'"00000009"\n')
    df = registry.read_table(spark, uri, "estabelecimento", with_source=True)
    assert df.count() == 3
    assert {r.source_file for r in df.select("source_file").distinct().collect()} == {
        "K.Y0.D30610.ESTABELE", "K.Y1.D30610.ESTABELE"}


def test_simples_suffix_not_at_end(spark, folder):
    uri, local = folder
    write_bytes(local, "F.K03200W.SIMPLES.CSV.D30610", b'"00000001";"S";"";"";"N";"";""\n')
    assert registry.read_table(spark, uri, "simples").count() == 1
    assert registry.find_files(spark, uri, "simples").count() == 1


def test_no_files_fails(spark, folder):
    uri, _ = folder
    with pytest.raises(registry.NoInputFiles):
        registry.find_files(spark, uri, "cnae")


def test_round_trip_matches_view(spark):
    from tabelion import fixtures as fx
    from tabelion.sources import extracts

    sf = "/root/testdata/sf0.001"
    root = extracts.landing(spark, sf)
    view = fx.view(spark, sf, "socios_original")
    back = registry.read_table(spark, root, "socios_original").select(*view.columns)
    assert back.exceptAll(view).count() == 0 and view.exceptAll(back).count() == 0
    codes = registry.read_table(spark, root, "cnae")
    assert codes.exceptAll(fx.view(spark, sf, "cnae")).count() == 0
    assert codes.filter(F.col("descricao").isNull()).count() == 0


def test_write_extracts_round_trip(spark, folder):
    from tabelion.sources import extracts

    uri, _ = folder
    df = spark.createDataFrame(
        [("01", 'Aç"o;x'), ("02", ""), ("03", "b")], "codigo string, descricao string"
    )
    names = extracts.write_extracts(df, uri, F.concat(F.lit("F.Z."), F.col("codigo"), F.lit(".D30610.PAISCSV")))
    assert names == ["F.Z.01.D30610.PAISCSV", "F.Z.02.D30610.PAISCSV", "F.Z.03.D30610.PAISCSV"]
    back = {(r.codigo, r.descricao) for r in registry.read_table(spark, uri, "pais").collect()}
    assert back == {("01", 'Aç"o;x'), ("02", None), ("03", "b")}


def test_line_ends_cut_records_and_empty_files(spark, folder):
    """Both readers agree: CRLF ends, blank lines skipped, a lone CR kept, line breaks in fields kept, an unclosed quote rejected."""
    import os
    import zipfile

    from tabelion.plans import expand, pipeline

    uri, local = folder
    body = b'"01";"a"\r\n   \n\n"02";"b\rc"\n"03";"cut\nhere"\n"04";"d"\n"05";"one\r\n\n"";two\n  "\r\n"06";"open\nend'
    os.makedirs(f"{local}/in")
    write_bytes(f"{local}/in", "F.Z.D30610.PAISCSV", body)
    write_bytes(f"{local}/in", "F.E.D30610.PAISCSV", b"")
    with zipfile.ZipFile(f"{local}/A.zip", "w") as z:
        z.writestr("F.Z.D30610.PAISCSV", body)
        z.writestr("F.E.D30610.PAISCSV", b"")
    expand.stage_archives(spark, uri, f"{uri}/staged")
    for source in (pipeline.FolderSource(spark, f"{uri}/in"), pipeline.StagedSource(spark, f"{uri}/staged")):
        rows = {tuple(r) for r in source.rows("pais", strict=False).collect()}
        assert rows == {("01", "a"), ("02", "b\rc"), ("03", "cut\nhere"), ("04", "d"), ("05", 'one\r\n\n";two\n  ')}
        counts = {r.file_name: (r.n_rows, r.n_rejected) for r in pipeline.expected_per_file(spark, source, ["pais"]).collect()}
        assert counts == {"F.Z.D30610.PAISCSV": (5, 1), "F.E.D30610.PAISCSV": (0, 0)}
        assert {r.cause for r in registry.rejects(source.lines(["pais"]), ["pais"]).collect()} == {"open_quote"}
        with pytest.raises(Exception, match="open_quote"):
            source.rows("pais").collect()


def plain_records(text):
    """Records by walking the characters: a break outside quotes ends one."""
    out, now, inside = [], "", False
    for ch in text:
        inside ^= ch == '"'
        if ch == "\n" and not inside:
            out.append(now)
            now = ""
        else:
            now += ch
    return [x.rstrip("\r") for x in [*out, now] if x.strip(" \t\r")]


def test_records_with_breaks_come_back_whole_however_split(spark, folder):
    """Fields with no, one, two and many breaks over many small splits, in folder and archive, equal a walk over the text."""
    import os
    import random
    import zipfile

    from tabelion.plans import expand, pipeline

    uri, local = folder
    pick = random.Random(7)
    rows = []
    for i in range(400):
        breaks = pick.choice([0, 0, 0, 0, 1, 2, 30])
        text = "".join(pick.choice(["ab", "\n", '""', ";", "\r\n", "ç"]) for _ in range(3 * breaks)) if breaks else "plain"
        rows.append(f'"{i:03d}";"{text}"')
    body = "\n".join(rows)
    os.makedirs(f"{local}/in")
    write_bytes(f"{local}/in", "F.Z.D30610.PAISCSV", body.encode("latin-1"))
    write_bytes(f"{local}/in", "F.Y.D30610.PAISCSV", b'"999";"none cut"\n')
    with zipfile.ZipFile(f"{local}/A.zip", "w") as z:
        z.write(f"{local}/in/F.Z.D30610.PAISCSV", "F.Z.D30610.PAISCSV")
        z.write(f"{local}/in/F.Y.D30610.PAISCSV", "F.Y.D30610.PAISCSV")
    want = sorted([*plain_records(body), '"999";"none cut"'])
    assert len(want) == 401
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        source = pipeline.FolderSource(spark, f"{uri}/in")
        assert sorted(r.line for r in source.lines(["pais"]).collect()) == want
        assert source.rows("pais").count() == 401
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    expand.stage_archives(spark, uri, f"{uri}/staged")
    staged = pipeline.StagedSource(spark, f"{uri}/staged")
    assert sorted(r.line for r in staged.lines(["pais"]).collect()) == want
    assert sorted(map(str, staged.rows("pais").collect())) == sorted(map(str, source.rows("pais").collect()))


def test_a_record_of_too_many_lines_is_rejected_line_by_line(spark, folder, monkeypatch):
    import io

    from tabelion.sources import archives, records

    body = '"01";"a\nb\nc\nd"\n"02";"x\ny"\n"03";"z'
    lines = [(0, 0, i, x) for i, x in enumerate(body.split("\n"))]
    df = spark.createDataFrame(lines, "f int, block long, at long, line string")
    got = sorted(r.line for r in records.joined_records(df, ["f"], max_lines=3).collect())
    assert got == sorted(['"01";"a', '"b', '"c', 'd"', '"02";"x\ny"', '"03";"z'])
    monkeypatch.setattr(archives, "MAX_LINES", 3)
    batches = archives._member_lines("A", "e", io.BytesIO(body.encode()))
    found = [(n, x) for b in batches for n, x in zip(b.column("line_no").to_pylist(), b.column("line").to_pylist())]
    assert sorted(x for _, x in found) == got and [n for n, _ in found] == [1, 2, 3, 4, 5, 7]


def test_long_names_are_spread_over_files(spark, folder):
    from tabelion.sources import extracts

    uri, _ = folder
    lines = spark.range(200).select(
        F.lit("K.Y0.D30610.PAISCSV").alias("_file"), F.col("id").alias("_key"), F.concat(F.lit('"'), "id", F.lit('";"x"')).alias("line")
    )
    names = extracts.write_lines(lines, uri, parts=3)
    assert names[0] == "K.Y0.D30610.PAISCSV" and len(names) > 1 and names[1].split(".")[1:] == ["Y0P1", "D30610", "PAISCSV"]
    assert registry.read_table(spark, uri, "pais").count() == 200


def test_store_names_of_spark_are_known_to_the_file_helpers(monkeypatch):
    from tabelion.sources import fs

    seen = []
    monkeypatch.setattr(fs.pafs, "FileSystem", type("F", (), {"from_uri": staticmethod(lambda u: (seen.append(u), ("f", u))[1])}))
    fs.resolve("s3a://bucket/x")
    assert seen == ["s3://bucket/x"] and fs.resolve("dbfs:/a/b")[1] == "/dbfs/a/b" and fs.resolve("file:///a")[1] == "/a"


def plain_joined(lines, most):
    """The records of a file's lines, one after the other."""
    out, now = [], []
    reject = lambda x: x if x.count('"') % 2 else '"' + x
    for x in lines:
        odd = x.count('"') % 2
        if now or odd:
            now.append(x)
            if odd and len(now) > 1:
                out += ["\n".join(now)] if len(now) <= most else map(reject, now)
                now = []
        else:
            out.append(x)
    return out + ((["\n".join(now)] if len(now) <= most else [*map(reject, now)]) if now else [])


def test_records_of_any_length_over_any_splits_equal_a_walk_over_the_lines(spark):
    """Records of one to many lines, too long ones, unclosed ones, over splits of any size and small batches."""
    import random

    from tabelion.sources import records

    pick = random.Random(11)
    rows, want = [], []
    for f in range(150):
        share = pick.choice([0.02, 0.1, 0.3, 0.6])
        lines = [pick.choice(['a"', '"', 'b""c"']) if pick.random() < share else pick.choice(["", "x", '""', "y\r"]) for _ in range(pick.choice([1, 5, 40, 90]))]
        want += [(f, x) for x in plain_joined(lines, 6)]
        block = 0
        for i, x in enumerate(lines):
            block = i * 100 if i and pick.random() < pick.choice([0.0, 0.05, 0.4]) else block
            rows.append((f, block, i, x))
    df = spark.createDataFrame(rows, "f int, block long, at long, line string").repartition(3)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = [tuple(r) for r in records.joined_records(df, ["f"], max_lines=6).collect()]
            assert sorted(got) == sorted(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_records_are_joined_where_they_are_read(spark, folder):
    """No line of a file with broken records is shuffled, sorted or written anew."""
    from tabelion.session import scratch_path
    from tabelion.sources import fs

    uri, local = folder
    body = b"".join(b'"%05d";"%s"\n' % (i, b"one\ntwo" if i % 4 else b"plain text") for i in range(20000))
    write_bytes(local, "F.Z.D30610.PAISCSV", body)
    size = lambda: sum(fs.resolve(f)[0].get_file_info(f).size for f in fs.list_files(scratch_path(spark, "records")))
    before = size()
    rows = registry.read_table(spark, uri, "pais")
    assert rows.count() == 20000 and rows.where("descricao = 'one\ntwo'").count() == 15000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    assert size() - before < len(body) / 20


def test_records_are_the_same_when_files_would_be_split_otherwise_later(spark, folder):
    """Settings, and the cores of a cluster, may be others when the records are read than when the quotes were counted."""
    from pyspark import RDD

    uri, local = folder
    write_bytes(local, "F.Z.D30610.PAISCSV", b"".join(b'"%03d";"a\nb"\n' % i for i in range(300)))
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    to_frame = RDD.toDF
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        rows = registry.read_table(spark, uri, "pais")
        assert RDD.toDF is to_frame and rows.sparkSession is spark
        for size, least in (("500", "1"), ("700", "50"), ("100000", "1")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.minPartitionNum", least)
            assert rows.where("descricao = 'a\nb'").count() == 300
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_files_that_change_while_their_records_are_joined_fail(spark, folder):
    uri, local = folder
    write_bytes(local, "F.Z.D30610.PAISCSV", b'"01";"a\nb"\n"02";"c"\n')
    rows = registry.read_table(spark, uri, "pais")
    assert rows.count() == 2
    write_bytes(local, "F.Z.D30610.PAISCSV", b'"01";"a\nb"\n"02";"c"\n"03";"d"\n')
    with pytest.raises(Exception, match="SplitsChanged"):
        rows.select("codigo", "descricao").where("codigo <> ''").collect()
