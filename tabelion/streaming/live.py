"""Live load monitoring as Structured Streaming queries over the landing folder.

* ``live_counts``: rows per table while extract files arrive (file source,
  complete-mode aggregate, one row per table kept in state).
* ``live_latest``: per micro-batch, append the batch to a table and refresh
  the latest-records listings (``foreachBatch``).
* Files already processed are never read again: the file source records
  them in the checkpoint, so a rerun with the same checkpoint adds nothing.

Checkpoints and outputs go under the shared scratch folder, so a restarted
driver or lost executor resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabelion import schemas
from tabelion.functions import reject_cause
from tabelion.operators import listing
from tabelion.sources import fs
from tabelion.sources.registry import LINE, LINE_OPTIONS, REJECT, content, parse_lines, table_of, width_of

LINE_SCHEMA = T.StructType([T.StructField(LINE, T.StringType(), True)])


def stream_lines(spark: SparkSession, folder: str, pattern: str = "*", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LINE_SCHEMA).options(**LINE_OPTIONS).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.csv(folder)
    return content(raw.select(F.col("_metadata.file_name").alias("file_name"), LINE))


def live_counts(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    output: str,
    files_per_trigger: int | None = None,
    available_now: bool = True,
    interval: str = "30 seconds",
    state_partitions: int = 8,
):
    """Start the counting stream; each batch writes the full counts (accepted and rejected rows per table).

    They go to a folder of their own under ``output``, so a reader of the
    latest finished one (``published_counts``) is never overwritten.

    Returns the ``StreamingQuery``. With ``available_now`` it processes what is
    there and stops; otherwise it triggers every ``interval``. The state holds
    one row per table whatever the input volume (rows are pre-aggregated in
    each task), so it is kept in ``state_partitions`` partitions; a stream
    fixes that number from its session when it first starts.
    """
    lines = stream_lines(spark, folder, files_per_trigger=files_per_trigger)
    tagged = lines.withColumn("table_name", table_of(F.col("file_name"))).filter(F.col("table_name").isNotNull())
    bad = reject_cause(LINE, width_of(F.col("table_name"))).isNotNull()
    counts = tagged.groupBy("table_name").agg(
        F.count_if(~bad).alias("n_rows"), F.count_if(bad).alias("n_rejected")
    )

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(publish)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, previous)


def _last_batch(path: str) -> int | None:
    """The greatest batch whose folder is finished (its writer leaves ``_SUCCESS``)."""
    done = [p for p in fs.list_files(path) if p.endswith("/_SUCCESS") and "batch_id=" in p]
    return max((int(p.rsplit("batch_id=", 1)[1].split("/")[0]) for p in done), default=None)


def published_counts(spark: SparkSession, output: str) -> DataFrame | None:
    """The counts of the last finished batch, or None before the first."""
    last = _last_batch(output)
    return None if last is None else spark.read.parquet(f"{output}/batch_id={last}")


# Ordering of each latest-records listing: (table, k, sort columns, listing).
LATEST = {
    "estabelecimento": (5, ["cnpj_basico", "cnpj"], listing.latest_establishments),
    "empresas": (3, ["cnpj_basico", "razao_social"], listing.latest_companies),
}


def _top(df: DataFrame, k: int, order: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order]).limit(k)


def live_latest(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    table_path: str,
    listing_path: str,
    files_per_trigger: int | None = None,
    available_now: bool = True,
    interval: str = "30 seconds",
):
    """Append each batch of ``table``'s extract rows, then refresh its latest-records listing.

    The listing is kept incrementally: batch N's top-k candidates are the top
    k of batch N-1's candidates and batch N's rows, so a trigger costs the
    batch plus k rows, not a rescan of everything appended so far. Every
    output goes to a folder named by batch id and is overwritten on a retry.
    A missing folder of the batch before is an error: what it held would be
    forgotten. Rejected rows are left out here; ``live_counts`` counts them.
    """
    k, order, _ = LATEST[table]
    lines = stream_lines(spark, folder, schemas.spec(table).glob, files_per_trigger)
    rows = parse_lines(lines, table).filter(F.col(REJECT).isNull()).drop(REJECT, "file_name")
    if table == "estabelecimento":
        rows = rows.withColumn("cnpj", F.concat_ws("", "cnpj_basico", "cnpj_ordem", "cnpj_dv"))

    def append_and_list(batch: DataFrame, batch_id: int) -> None:
        written = f"{table_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(written)
        # The listing is taken from what was written, so the extract is parsed once.
        candidates = spark.read.schema(batch.schema).parquet(written)
        if batch_id > 0:
            previous = f"{listing_path}/batch_id={batch_id - 1}"
            if not fs.exists(f"{previous}/_SUCCESS"):
                raise FileNotFoundError(f"{previous}: the listing of the batch before is missing")
            candidates = candidates.unionByName(spark.read.schema(batch.schema).parquet(previous))
        _top(candidates, k, order).write.mode("overwrite").parquet(f"{listing_path}/batch_id={batch_id}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append_and_list)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def latest_listing(spark: SparkSession, table: str, listing_path: str) -> DataFrame | None:
    """The listing after the last finished batch, or None before the first."""
    _, _, make = LATEST[table]
    last = _last_batch(listing_path)
    return None if last is None else make(spark.read.parquet(f"{listing_path}/batch_id={last}"))


def monitor(spark: SparkSession, folder: str, checkpoint: str, output: str, interval: str = "30 seconds", available_now: bool = False):
    """Counts and both latest-records listings over one landing folder; returns the three queries."""
    counting = live_counts(spark, folder, f"{checkpoint}/counts", f"{output}/counts", None, available_now, interval)
    listings = [
        live_latest(
            spark, folder, t, f"{checkpoint}/{t}", f"{output}/{t}", f"{output}/{t}_latest", None, available_now, interval
        )
        for t in LATEST
    ]
    return [counting, *listings]


def monitor_report(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """What the monitor has published so far: counts, and a listing for each table."""
    found = {"counts": published_counts(spark, f"{output}/counts")}
    found |= {t: latest_listing(spark, t, f"{output}/{t}_latest") for t in LATEST}
    return {k: df for k, df in found.items() if df is not None}
