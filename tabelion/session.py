"""Session construction and the shared scratch folder.

Intermediate files (landing extracts, staged lines, stream checkpoints,
catalog databases) live under the folder the cluster names in
``spark.checkpoint.dir``. A local session that does not name one (tests)
gets a fresh folder here; a cluster session without one is an error.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tabelion", partitions: int = 8) -> SparkSession:
    """A session; partition count and driver memory are set for a given local master only, else the cluster's hold."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
        builder = builder.config("spark.driver.memory", os.environ.get("TABELION_DRIVER_MEMORY", "16g"))
    spark = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; where unset, a local master gets a local one and a cluster fails."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tabelion-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared scratch root, namespaced by application id."""
    root = ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    return "/".join([root, "tabelion", app, *parts])


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_files(spark: SparkSession, n: int):
    """Within, a task that writes to fewer than ``n`` partition folders keeps their files open and does not sort its rows by folder."""
    before = spark.conf.get(OPEN_FILES, None)
    spark.conf.set(OPEN_FILES, str(n))
    try:
        yield
    finally:
        spark.conf.unset(OPEN_FILES) if before is None else spark.conf.set(OPEN_FILES, before)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Within, the session has these settings; before and after its own."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


BROADCAST, BROADCAST_AS_RUN = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def measured_broadcasts(spark: SparkSession):
    """Settings within which a join's side is sent to all tasks for the size that its rows have when they are there only.

    Before that Spark goes by the size of files: a few MB of a stored table, or
    its narrow columns, may be millions of rows, which the driver would gather.
    """
    most = spark.conf.get(BROADCAST_AS_RUN, None) or spark.conf.get(BROADCAST)
    return settings(spark, {BROADCAST: "-1", BROADCAST_AS_RUN: most})


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabelion`` importable in executor Python workers (once per application).

    Tasks that run Python (ZIP expansion) unpickle functions from this
    package; the package is zipped into the shared scratch folder and added
    with ``addPyFile``, which distributes it to every executor.
    """
    import io
    import zipfile

    import tabelion
    from tabelion.sources import fs

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(tabelion.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    uri = scratch_path(spark, "pyfiles", "tabelion.zip")
    fs.makedirs(uri.rsplit("/", 1)[0])
    filesystem, path = fs.resolve(uri)
    with filesystem.open_output_stream(path) as out:
        out.write(buf.getvalue())
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(app)
