"""Row numbers within a key that stay balanced when one key holds most rows.

``row_number() OVER (PARTITION BY key ORDER BY o)`` sends every row of a key
to one task. That is done for keys of up to ``TASK_ROWS`` rows: one shuffle.
The rows of larger keys are range-partitioned on (key, o) instead, so a
hot key is cut across many partitions; each partition numbers its own slice
and adds the number of the key's rows in earlier partitions. All their shuffles
are keyed on (partition, key) or ranges, never on the key alone.

The partition id is not a function of the row (adaptive execution may merge
partitions differently each time the range shuffle is read), so the ranged
rows are written once as Parquet under the shared scratch folder with the id
attached; both consumers then read the same ids, with column pruning. This
also cuts the lineage, so a lost executor does not replay the range shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabelion.session import scratch_path


#: Rows of a key that one task numbers.
TASK_ROWS = 1_000_000


def row_number_within(df: DataFrame, key: str, order: str, out: str = "rn", n_parts: int | None = None) -> DataFrame:
    """``df`` plus ``out`` (long) = 1-based position of the row within its key, by ``order``.

    ``(key, order)`` must identify a row (ties would be numbered arbitrarily,
    as with ``row_number``). Rows without a key are left out.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    large = [r[0] for r in counts.where(F.col("_n") > TASK_ROWS).select(key).collect()]  # a key per TASK_ROWS rows at most
    by_key = Window.partitionBy(key).orderBy(order)
    rest = df.where(~F.col(key).isin(large)) if large else df.where(F.col(key).isNotNull())
    numbered = rest.withColumn(out, F.row_number().over(by_key).cast("long"))
    if not large:
        return numbered
    return numbered.unionByName(number_in_slices(df.where(F.col(key).isin(large)), key, order, out, n_parts))


def number_in_slices(df: DataFrame, key: str, order: str, out: str = "rn", n_parts: int | None = None) -> DataFrame:
    """``row_number_within`` for keys of any number of rows.

    1. range-partition on (key, order) and sort each partition; attach the
       partition id and ``monotonically_increasing_id`` (consecutive within a
       partition, so it numbers the sorted slice); write as Parquet;
    2. per (partition, key): row count and first id (map-side partial
       aggregation), and the key's rows in earlier partitions (a window over
       at most ``n_parts`` rows per key);
    3. position = rows in earlier partitions + (id - first id) + 1.
    """
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranged", uuid.uuid4().hex)
    ranged = (
        df.repartitionByRange(n, F.col(key), F.col(order))
        .sortWithinPartitions(key, order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged.write.mode("overwrite").parquet(path)
    ranged = spark.read.parquet(path)
    slices = ranged.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_pid", key, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = ranged.join(offsets, ["_pid", key], "inner")
    position = F.col("_off") + (F.col("_mid") - F.col("_first")) + F.lit(1)
    return joined.withColumn(out, position.cast("long")).drop("_pid", "_mid", "_first", "_off")
