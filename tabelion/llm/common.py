"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\x0c\r"
NON_BLANK_RUN = r"[^\x20\x09-\x0D]+"


def ship(module_name: str) -> None:
    """Pickle a module's functions by value, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet under the shared scratch folder, and read back.

    Cuts the lineage: what executors lose later is reread, not recomputed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z lower-cased and every other character unchanged.

    ``lower`` is right and fast on pure ASCII; ``translate`` does the rest.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def sampled_texts(docs: DataFrame, sample: DataFrame, label: str, cost: Column, budget: int) -> list[tuple[bytes, int]]:
    """(text, label) of the documents of ``sample`` (doc_id, ``label``; few rows), in the order of their id hashes.

    Of rows with the same id, the one of the smallest text hash. Only ids and
    costs are collected of those that do not fit into ``budget`` (the sum of ``cost``).
    """
    sample = sample.select(F.col("doc_id").alias("_labelled"), label)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled"))
    smallest = F.min(F.struct(text_key(F.col("text")).alias("key"), "text")).alias("one")
    one = staged(texts.groupBy("doc_id", label).agg(smallest).select("doc_id", label, "one.text"), "sample")
    order = (F.xxhash64("doc_id"), "doc_id")
    taken, total, left_out = [], 0, False
    for row in one.select("doc_id", cost.alias("cost")).orderBy(*order).collect():
        if total + row.cost <= budget:
            total += row.cost
            taken.append((row.doc_id,))
        else:
            left_out = True
    if left_out:
        ids = docs.sparkSession.createDataFrame(taken, one.select("doc_id").schema)
        one = one.join(F.broadcast(ids), "doc_id", "left_semi")
    rows = one.select("doc_id", label, "text").orderBy(*order).toLocalIterator()
    return [(r.text.encode(), int(r[label])) for r in rows]


def text_key(text: Column) -> Column:
    """A 64-bit hash that, next to the id, tells rows with a repeated id apart."""
    return F.xxhash64(text)
