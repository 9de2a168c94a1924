import os
import zipfile

from pyspark.sql import functions as F

from conftest import write_bytes
from tabelion.sources import archives, links, registry


def test_two_archives_one_with_two_entries(spark, folder):
    uri, local = folder
    x = b'"0000001";"um"\n"0000002";"dois"\r\n'
    y = b'"01";"\xe7\xe3o"\n\n"02";"b"'
    with zipfile.ZipFile(os.path.join(local, "A.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.D30610.CNAECSV", x)
        z.writestr("y.D30610.MOTICSV", y)
    with zipfile.ZipFile(os.path.join(local, "B.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("z.D30610.PAISCSV", b'"001";"p"\n')
    lines = archives.archive_lines(spark, uri)
    got = sorted((r.archive, r.entry, r.line_no, r.line) for r in lines.collect())
    assert got == [
        ("A.zip", "x.D30610.CNAECSV", 1, '"0000001";"um"'),
        ("A.zip", "x.D30610.CNAECSV", 2, '"0000002";"dois"'),
        ("A.zip", "y.D30610.MOTICSV", 1, '"01";"ção"'),
        ("A.zip", "y.D30610.MOTICSV", 3, '"02";"b"'),
        ("B.zip", "z.D30610.PAISCSV", 1, '"001";"p"'),
    ]
    parsed = registry.parse_lines(lines.filter(F.col("entry").endswith(".MOTICSV")), "motivo")
    assert {(r.codigo, r.descricao) for r in parsed.collect()} == {("01", "ção"), ("02", "b")}
    man = archives.archive_manifest(spark, uri)
    sizes = {r.archive: (r.n_entries, r.uncompressed_bytes) for r in archives.archive_sizes(man).collect()}
    assert sizes == {"A.zip": (2, len(x) + len(y)), "B.zip": (1, 10)}
    # only one member already extracted next to the archives
    write_bytes(local, "z.D30610.PAISCSV", b'"001";"p"\n')
    present = registry.list_extracts(spark, uri, "*CSV")
    status = {r.archive: (r.n_entries, r.n_present, r.all_present) for r in archives.entry_status(man, present).collect()}
    assert status == {"A.zip": (2, 0, False), "B.zip": (1, 1, True)}
    missing = sorted(tuple(r) for r in archives.missing_entries(man, present).collect())
    assert missing == [("A.zip", "x.D30610.CNAECSV"), ("A.zip", "y.D30610.MOTICSV")]


def test_build_archives_round_trip(spark, folder):
    from tabelion.sources import extracts

    uri, _ = folder
    landing = extracts.landing(spark, "/root/testdata/sf0.001")
    built = archives.build_archives(spark, landing, uri).collect()
    assert len(built) == 37 and len({r.archive for r in built}) == 37
    lines = archives.archive_lines(spark, uri)
    direct = registry.scan_lines(spark, landing, "*").select(F.col("source_file").alias("entry"), "line")
    assert lines.select("entry", "line").exceptAll(direct).count() == 0
    assert direct.exceptAll(lines.select("entry", "line")).count() == 0
    tasks = lines.select(F.spark_partition_id().alias("p"), "entry").distinct().groupBy("p").count().collect()
    assert {r["count"] for r in tasks} == {1}  # a member a task


def test_links_latest_and_resolved(spark):
    html = (
        '<a href="2024-07/">x</a> <a class="k" href="2024-08/">y</a> <a href="x/">z</a> '
        '<a href="http://other/abs.zip">a</a> <a href="rel.zip">b</a> <b href="no">'
    )
    pages = spark.createDataFrame([(1, "http://site.example/dados/", html)], "page_id long, url string, html string")
    assert [r.href for r in links.links(pages).orderBy("link_pos").collect()] == [
        "2024-07/", "2024-08/", "x/", "http://other/abs.zip", "rel.zip"]
    latest = links.latest_link(pages, "20").first()
    assert (latest.host, latest.latest_href, latest.n_links) == ("site.example", "2024-08/", 2)
    zips = {r.href: r.resolved_url for r in links.resolved_links(pages, ".zip").collect()}
    assert zips == {"http://other/abs.zip": "http://other/abs.zip", "rel.zip": "http://site.example/dados/rel.zip"}


def test_stage_archives_once_and_load_from_staged(spark, folder):
    import uuid

    from tabelion import schemas
    from tabelion.plans import expand, pipeline
    from tabelion.plans import tables as tb
    from tabelion.session import scratch_path
    from tabelion.sources import extracts

    uri, _ = folder
    sf = "/root/testdata/sf0.001"
    landing = extracts.landing(spark, sf)
    archives.build_archives(spark, landing, uri).write.format("noop").mode("overwrite").save()
    staged = f"{uri}/staged"
    first = expand.stage_archives(spark, uri, staged)
    assert first.filter("all_present").count() == 37
    n = pipeline.StagedSource(spark, staged).lines(schemas.BASE_TABLES).count()
    assert expand.stage_archives(spark, uri, staged).filter("all_present").count() == 37
    assert pipeline.StagedSource(spark, staged).lines(schemas.BASE_TABLES).count() == n  # nothing expanded twice
    db = "st_" + uuid.uuid4().hex[:8]
    res = pipeline.run_load(spark, pipeline.StagedSource(spark, staged), db, scratch_path(spark, "wh", db))
    assert all(r.matches for r in res.reconciliation.collect())
    direct = registry.read_table(spark, landing, "simples")
    assert spark.table(f"{db}.simples").exceptAll(direct).count() == 0
    assert tb.read(spark, db, "socios").count() > 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_damaged_archives_are_reported_and_the_others_go_on(spark, folder):
    """A file that is no archive, and a member whose bytes are damaged: an error each, the rest staged; a rerun mends."""
    from tabelion.plans import expand

    uri, local = folder
    text = b"".join(b'"%07d";"nome"\n' % i for i in range(50_000))
    for name in ("A.zip", "B.zip"):
        with zipfile.ZipFile(os.path.join(local, name), "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{name}.D30610.CNAECSV", text)
            z.writestr(f"{name}.D30610.PAISCSV", b'"001";"p"\n')
    whole = open(os.path.join(local, "B.zip"), "rb").read()
    write_bytes(local, "B.zip", whole[:20_000] + b"\x00" * 64 + whole[20_064:])
    write_bytes(local, "C.zip", b"not an archive")
    status = {r.archive: r for r in expand.stage_archives(spark, uri, f"{uri}/staged").collect()}
    assert status["A.zip"].all_present and status["A.zip"].error is None
    assert (status["B.zip"].n_entries, status["B.zip"].n_present) == (2, 1) and status["B.zip"].error
    assert not status["C.zip"].all_present and status["C.zip"].error
    assert [r.archive for r in archives.archive_errors(spark, uri).collect()] == ["C.zip"]
    n = expand.staged_lines(spark, f"{uri}/staged", ["cnae", "pais"]).groupBy("archive", "entry").count().collect()
    assert sorted((r.archive, r["count"]) for r in n) == [("A.zip", 1), ("A.zip", 50_000), ("B.zip", 1)]
    write_bytes(local, "B.zip", whole)
    again = {r.archive: r.all_present for r in expand.stage_archives(spark, uri, f"{uri}/staged").collect()}
    assert again == {"A.zip": True, "B.zip": True, "C.zip": False}
    assert expand.staged_lines(spark, f"{uri}/staged", ["cnae"]).count() == 100_000


def pack(local, name, members):
    with zipfile.ZipFile(os.path.join(local, name), "w", zipfile.ZIP_DEFLATED) as z:
        for entry, text in members.items():
            z.writestr(entry, text)


def test_an_archive_replaced_during_a_staging_is_not_marked_finished(spark, folder, monkeypatch):
    from tabelion.plans import expand

    uri, local = folder
    pack(local, "A.zip", {"A.D30610.PAISCSV": b'"001";"p"\n'})
    pack(local, "B.zip", {"B.D30610.PAISCSV": b'"002";"q"\n'})
    real = archives.expand_members

    def replaced(members):
        pack(local, "A.zip", {"A.D30610.PAISCSV": b'"003";"r"\n"004";"s"\n'})
        return real(members)

    with monkeypatch.context() as m:
        m.setattr(archives, "expand_members", replaced)
        status = {r.archive: r for r in expand.stage_archives(spark, uri, f"{uri}/staged").collect()}
    assert not status["A.zip"].all_present and "ReplacedArchive" in status["A.zip"].error and status["B.zip"].all_present
    lines = lambda: sorted(r.line for r in expand.staged_lines(spark, f"{uri}/staged", ["pais"]).collect())
    assert lines() == ['"002";"q"']
    assert expand.stage_archives(spark, uri, f"{uri}/staged").filter("all_present").count() == 2
    assert lines() == ['"002";"q"', '"003";"r"', '"004";"s"']


def test_a_mended_member_that_is_empty_loses_its_old_rows(spark, folder):
    from tabelion.plans import expand

    uri, local = folder
    text = b"".join(b'"%07d";"nome"\n' % i for i in range(50_000))
    pack(local, "B.zip", {"B.D30610.CNAECSV": text})
    whole = open(os.path.join(local, "B.zip"), "rb").read()
    write_bytes(local, "B.zip", whole[:20_000] + b"\x00" * 64 + whole[20_064:])
    first = expand.stage_archives(spark, uri, f"{uri}/staged").first()
    assert not first.all_present and first.error
    pack(local, "B.zip", {"B.D30610.CNAECSV": b""})
    again = expand.stage_archives(spark, uri, f"{uri}/staged").first()
    assert again.all_present and again.error is None
    assert expand.staged_lines(spark, f"{uri}/staged", ["cnae"]).count() == 0


def test_anchor_forms(spark):
    html = (
        "<a href='s.zip'>1</a><A HREF=\"U.zip\">2</A><a href=bare.zip>3</a>"
        '<a data-href="no.zip" class=k href="yes.zip" data-href="no2.zip">4</a><a title="x > y" href="t.zip">5</a>'
        '<a href="q.zip?a=1&amp;b=2">6</a><a name="n">7</a><abbr href="no3.zip">8</abbr><a data-href="no4.zip">9</a>'
    )
    pages = spark.createDataFrame([(1, "http://s/", html)], "page_id long, url string, html string")
    got = [r.href for r in links.links(pages).orderBy("link_pos").collect()]
    assert got == ["s.zip", "U.zip", "bare.zip", "yes.zip", "t.zip", "q.zip?a=1&b=2"]


def test_latest_folder_archives(spark):
    index = [(1, "http://s/", "<a href='2024-07/'>a</a><a href='2024-08/'>b</a><a href='x/'>c</a>"), (2, "http://t/", "<a href=2023-01/>")]
    folders = [
        (3, "http://s/2024-07/", "<a href=old.zip>"),
        (4, "http://s/2024-08/", "<a href=new.zip><a href=readme.txt><a href='http://o/abs.zip'>"),
        (5, "http://t/2023-01/", "<a href=t.zip>"),
    ]
    schema = "page_id long, url string, html string"
    got = links.latest_folder_archives(spark.createDataFrame(index, schema), spark.createDataFrame(folders, schema))
    assert sorted((r.host, r.resolved_url) for r in got.collect()) == [
        ("s", "http://o/abs.zip"), ("s", "http://s/2024-08/new.zip"), ("t", "http://t/2023-01/t.zip")]


def test_package_is_shipped_for_python_tasks(spark):
    import zipfile as zf

    from tabelion.session import scratch_path, ship_package
    from tabelion.sources import fs

    ship_package(spark)
    local = fs.resolve(scratch_path(spark, "pyfiles", "tabelion.zip"))[1]
    names = zf.ZipFile(local).namelist()
    assert "tabelion/__init__.py" in names and "tabelion/sources/archives.py" in names


def test_extracts_of_many_lines_are_parts_and_give_the_same_rows(spark, monkeypatch):
    """With a few hundred lines a task, queries over files give what they give with one file a name."""
    import uuid

    from tabelion import queries as Q
    from tabelion.session import scratch_path
    from tabelion.sources import extracts, fs

    sf = "/root/testdata/sf0.001"
    over_files = ["rejected_rows", "rows_per_file", "file_sizes", "file_summary", "archive_manifest", "archive_entry_status", "entries_missing"]
    before = {q: sorted(map(str, Q.QUERIES[q](spark, sf).collect())) for q in over_files}
    place = scratch_path(spark, "parts", uuid.uuid4().hex)
    monkeypatch.setattr(extracts, "scratch_path", lambda s, *p: "/".join([place, *p]))
    monkeypatch.setattr(archives, "scratch_path", lambda s, *p: "/".join([place, *p]))
    monkeypatch.setattr(extracts, "LINES_PER_FILE", 300)
    files = [f.rsplit("/", 1)[-1] for f in fs.list_files(Q.damaged_landing(spark, sf), recursive=False)]
    assert "X.YP1.D30610.SOCIOCSV" in files
    assert any(".K03200Y1P1." in f for f in fs.list_files(extracts.landing(spark, sf)))
    for q in over_files:
        assert sorted(map(str, Q.QUERIES[q](spark, sf).collect())) == before[q], q


def test_no_task_writes_many_times_the_lines_of_a_file(spark, folder, monkeypatch):
    from tabelion.sources import extracts

    monkeypatch.setattr(extracts, "LINES_PER_FILE", 1000)
    one = spark.range(20000).select(
        F.lit("K.Y0.D30610.PAISCSV").alias("_file"), F.col("id").alias("_key"), F.concat(F.lit('"'), "id", F.lit('";"x"')).alias("line")
    )
    few = spark.range(3).select(F.lit("K.Y.D30610.CNAECSV").alias("_file"), F.col("id").alias("_key"), F.lit('"1";"y"').alias("line"))
    names = extracts.write_lines(one.unionByName(few), folder[0])
    sizes = [r.n for r in spark.read.text(folder[0], pathGlobFilter="*PAISCSV").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(names) == 21 and sum(sizes) == 20000 and max(sizes) < 1300
    shares, n = extracts._slots({"a": 5, "b": 4, "c": 90, "d": 2500}, 1, 4)
    assert shares == {"a": [0], "b": [0], "c": [0], "d": [1, 2, 3]} and n == 4


def plans_of(spark, action) -> list[str]:
    """The physical plans that ``action`` executes, with what writes add to them."""
    store = spark._jsparkSession.sharedState().statusStore()
    kept = lambda: [store.executionsList(i, 1).head() for i in range(store.executionsCount())]
    before = {x.executionId() for x in kept()}  # the store forgets the oldest, so their number does not tell the new ones
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return [x.physicalPlanDescription() for x in kept() if x.executionId() not in before]


def test_names_of_many_lines_are_written_without_shuffle_or_sort(spark, folder, monkeypatch):
    from tabelion.sources import extracts

    monkeypatch.setattr(extracts, "LINES_DEALT", 100)
    monkeypatch.setattr(extracts, "LINES_PER_FILE", 400)
    name = F.concat(F.lit("K.Y"), F.col("id") % 3, F.lit(".D30610.PAISCSV"))
    many = spark.range(0, 3000, 1, 2).select(name.alias("_file"), F.col("id").alias("_key"), F.concat(F.lit('"'), "id", F.lit('";"x"')).alias("line"))
    few = spark.range(9).select(F.lit("K.Y.D30610.CNAECSV").alias("_file"), F.col("id").alias("_key"), F.lit('"1";"y"').alias("line"))
    none = spark.range(5).select(F.lit(None).cast("string").alias("_file"), F.col("id").alias("_key"), F.lit('"2";"z"').alias("line"))
    names = []
    lines = many.unionByName(few).unionByName(none)
    plans = plans_of(spark, lambda: names.extend(extracts.write_lines(lines, folder[0])))
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p]
    assert ["Exchange" in p or "Sort" in p for p in writes] == [False, True]
    assert names == sorted(names) and len(names) == 3 * 2 * 2 + 2  # two tasks, each two files a name; a file for the others
    found = spark.read.text(folder[0]).groupBy("value").count().collect()
    assert {r.value for r in found} == {f'"{i}";"x"' for i in range(3000)} | {'"1";"y"'}  # Spark passes over the file without a name
    assert sum(r["count"] for r in found) == 3009
    sizes = spark.read.text(folder[0], pathGlobFilter="*PAISCSV").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 400
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_members_are_staged_without_sorting_them(spark, folder):
    """The lines of a member lie together already: staging must not hold a whole member to sort it by its folder."""
    from tabelion.plans import expand
    from tabelion.sources import extracts

    landing = extracts.landing(spark, "/root/testdata/sf0.001")
    archives.build_archives(spark, landing, folder[0]).write.format("noop").mode("overwrite").save()
    plans = plans_of(spark, lambda: expand.stage_archives(spark, folder[0], f"{folder[0]}/staged"))
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "in_archive" in p and "MapInArrow" in p]
    assert len(writes) == 1 and "Sort" not in writes[0]


def test_staged_lines_are_written_in_a_dense_codec(spark, folder):
    from tabelion.plans import expand, pipeline
    from tabelion.sources import fs

    uri, local = folder
    with zipfile.ZipFile(f"{local}/A.zip", "w") as z:
        z.writestr("F.Z.D30610.PAISCSV", "".join(f'"{i:03d}";"x"\n' for i in range(200)))
    expand.stage_archives(spark, uri, f"{uri}/staged")
    files = [f for f in fs.list_files(f"{uri}/staged/{expand.LINES}") if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)
    assert pipeline.StagedSource(spark, f"{uri}/staged").rows("pais").count() == 200


def test_names_of_many_lines_with_breaks_are_written_where_they_are_read(spark, folder, monkeypatch):
    """All but a share of them: the share is dealt with the line whose quote is never closed, which must end a file."""
    from tabelion.sources import extracts, registry

    monkeypatch.setattr(extracts, "LINES_DEALT", 100)
    monkeypatch.setattr(extracts, "LINES_PER_FILE", 400)
    name = F.lit("K.Y0.D30610.PAISCSV").alias("_file")
    text = F.concat(F.lit('"'), "id", F.when(F.col("id") % 3 == 0, F.lit('";"x\ny\r\n\nz"')).otherwise(F.lit('";"x"')))
    many = spark.range(0, 3000, 1, 2).select(name, F.format_string("%05d", "id").alias("_key"), text.alias("line"))
    unclosed = spark.range(1).select(name, F.lit("~").alias("_key"), F.lit('"~";"open').alias("line"))
    few = spark.range(9).select(F.lit("K.Y.D30610.CNAECSV").alias("_file"), F.lit("1").alias("_key"), F.lit('"1";"y\nz"').alias("line"))
    names = []
    lines = many.unionByName(unclosed).unionByName(few)
    plans = plans_of(spark, lambda: names.extend(extracts.write_lines(lines, folder[0], breaks=True)))
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p]
    assert ["Exchange" in p or "Sort" in p for p in writes] == [False, True]
    assert names == sorted(set(names)) and len(names) > 8
    bodies = {n: open(f"{folder[1]}/{n}", encoding="latin-1", newline="").read() for n in names}
    dealt = [b for b in bodies.values() if '"~";"open' in b]
    assert len(dealt) == 1 and dealt[0].endswith('\n"~";"open\n') and 1 < dealt[0].count('";"') < 300
    assert all(b.count('";"') <= 400 for b in bodies.values())
    rows = registry.read_table(spark, folder[0], "pais", strict=False).collect()
    assert sorted(rows) == sorted((str(i), "x" if i % 3 else "x\ny\r\n\nz") for i in range(3000))
    assert registry.read_table(spark, folder[0], "cnae").count() == 9
    assert [tuple(r)[2:] for r in registry.rejected_rows(spark, folder[0]).collect()] == [("open_quote", 1)]
