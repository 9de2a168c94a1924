"""Counts, load decisions and reconciliation reports.

Every report is a small DataFrame built from aggregates with partial
results on the executors: figures for several tables come from one
``groupBy(table_name)`` over the tables' rows tagged with their name, never
from a driver loop over rows. Inputs are passed as ``{table_name: DataFrame or None}``; ``None``
stands for a table that does not exist, which is reported, not fatal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabelion.functions import excess_percent, gigabytes, megabytes, thousands

SEVERE_EXCESS_PERCENT = 50.0

COUNT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("present", T.BooleanType(), False),
    ]
)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tagged(tables: dict[str, DataFrame], cols: list[str]) -> DataFrame:
    """Rows of several tables, only ``cols`` kept, tagged with ``table_name``.

    Grouping this by ``table_name`` computes every table's figures in one
    aggregation (map-side partial results, one shuffle of a few rows per
    task) instead of one job stage per table.
    """
    return _union([df.select(F.lit(n).alias("table_name"), *cols) for n, df in tables.items()])


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def table_counts(spark: SparkSession, tables: dict[str, DataFrame | None], with_text: bool = False) -> DataFrame:
    """Row count per table; a missing table gives 0 rows and ``present = false``."""
    present = [n for n, df in tables.items() if df is not None]
    names = _names(spark, list(tables))
    if present:
        counts = _tagged({n: tables[n] for n in present}, []).groupBy("table_name").agg(
            F.count(F.lit(1)).alias("_n")
        )
        names = names.join(counts, "table_name", "left")
    else:
        names = names.withColumn("_n", F.lit(None).cast("long"))
    out = names.select(
        "table_name",
        F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("n_rows"),
        F.col("table_name").isin(present).alias("present"),
    )
    return out.withColumn("n_rows_text", thousands("n_rows")) if with_text else out


def _missing_row(spark: SparkSession, name: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("table_name"), F.lit(0).cast("long").alias("n_rows"), F.lit(False).alias("present")
    )


def code_distinct(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct non-NULL codes per code list (one aggregation for all lists)."""
    return _tagged(tables, ["codigo"]).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("codigo").alias("n_distinct")
    )


def _first_code(c: Column) -> Column:
    """First code in ascending order with NULLs last: the smallest non-NULL code."""
    return F.min(c)


def _last_code(c: Column) -> Column:
    """First code in descending order with NULLs first: NULL as soon as one code is NULL."""
    return F.when(F.count(c) < F.count(F.lit(1)), F.lit(None)).otherwise(F.max(c))


def _ends(tables: dict[str, DataFrame], key: str = "codigo") -> DataFrame:
    c = F.col(key)
    return _tagged(tables, [key]).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n"), _first_code(c).alias("first_code"), _last_code(c).alias("last_code")
    )


def code_ends(tables: dict[str, DataFrame]) -> DataFrame:
    """First and last code of each code list in code order."""
    return _ends(tables).select("table_name", "first_code", "last_code")



def _side(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """Count and ends per table; a table with no rows still gets its row (count 0, NULL ends)."""
    spark = next(iter(tables.values())).sparkSession
    return _names(spark, names).join(_ends(tables), "table_name", "left").select(
        "table_name", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "first_code", "last_code"
    )


def code_load_decision(pairs: dict[str, tuple[DataFrame, DataFrame]], force: bool = False) -> DataFrame:
    """Load decision per code list from (stored table, incoming extract).

    - nothing stored: ``insert``
    - something stored, empty extract: ``skip_empty_input``
    - stored >= expected with equal first/last codes: ``skip``
    - stored > expected, ends differ: ``inconsistent_severe`` (excess over
      50 %) or ``inconsistent_moderate``; inserted only with ``force``
    - equal count with other ends, or fewer stored: ``append``
    """
    names = list(pairs)
    stored = _side({n: s for n, (s, _) in pairs.items()}, names).select(
        "table_name",
        F.col("n").alias("existing"),
        F.col("first_code").alias("stored_first"),
        F.col("last_code").alias("stored_last"),
    )
    incoming = _side({n: i for n, (_, i) in pairs.items()}, names).select(
        "table_name",
        F.col("n").alias("expected"),
        F.col("first_code").alias("incoming_first"),
        F.col("last_code").alias("incoming_last"),
    )
    return decide_code_load(stored.join(incoming, "table_name"), force)


def decide_code_load(stats: DataFrame, force: bool = False) -> DataFrame:
    """The decision columns over (existing, expected, stored/incoming ends)."""
    existing, expected = F.col("existing"), F.col("expected")
    ends_equal = F.col("stored_first").eqNullSafe(F.col("incoming_first")) & F.col("stored_last").eqNullSafe(
        F.col("incoming_last")
    )
    pct = excess_percent(existing, expected)
    decision = (
        F.when(existing == 0, "insert")
        .when(expected == 0, "skip_empty_input")
        .when((existing >= expected) & ends_equal, "skip")
        .when((existing > expected) & (pct > SEVERE_EXCESS_PERCENT), "inconsistent_severe")
        .when(existing > expected, "inconsistent_moderate")
        .otherwise("append")
    )
    out = stats.withColumn("ends_equal", ends_equal).withColumn("excess_pct", F.round(pct, 1))
    out = out.withColumn("decision", decision)
    will = F.when(F.col("decision").isin("insert", "append"), True).when(
        F.col("decision").startswith("inconsistent"), F.lit(force)
    ).otherwise(False)
    return out.withColumn("will_insert", will)


def main_load_decision(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Main tables: skip when something is stored and stored >= rows over all files.

    ``expected`` is the row total of every extract of the table, not one file's.
    """
    stored = table_counts_named(
        {n: s for n, (s, _) in pairs.items()}, "existing"
    )
    incoming = table_counts_named({n: i for n, (_, i) in pairs.items()}, "expected")
    return decide_main_load(stored.join(incoming, "table_name"))


def decide_main_load(stats: DataFrame) -> DataFrame:
    existing, expected = F.col("existing"), F.col("expected")
    decision = (
        F.when(existing == 0, "insert").when(existing >= expected, "skip").otherwise("append")
    )
    return stats.withColumn("decision", decision).withColumn("will_insert", F.col("decision") != "skip")


def table_counts_named(tables: dict[str, DataFrame], alias: str) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return table_counts(spark, dict(tables)).select("table_name", F.col("n_rows").alias(alias))



def reconciliation(expected_per_file: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected rows (sum over a table's files) against stored rows, per table.

    ``expected_per_file``: table_name, file_name, n_rows, n_rejected.
    ``stored``: table_name, n_rows (from ``table_counts``). A table matches
    only if nothing was rejected, too.
    """
    exp = expected_per_file.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").cast("long").alias("expected"),
        F.sum("n_rejected").cast("long").alias("rejected"),
    )
    st = stored.select("table_name", F.col("n_rows").alias("stored"))
    zero = F.lit(0).cast("long")
    out = exp.join(st, "table_name", "full_outer").select(
        "table_name", *[F.coalesce(c, zero).alias(c) for c in ("n_files", "expected", "rejected", "stored")]
    )
    return out.withColumn("difference", F.col("stored") - F.col("expected")).withColumn(
        "matches", (F.col("stored") == F.col("expected")) & (F.col("rejected") == 0)
    )


def relationship_count(name: str, many: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of the inner equi-join of both on ``key``, counted without joining their rows.

    ``other`` is reduced to one row per key first (partial counts in every
    task, so a key holding a third of all rows is just one number). The rows
    of ``many``, in which a key occurs about once, are joined as they are and
    take their key's count. NULL keys match nothing, as in the join.

    Both sides are merged: Spark takes one narrow column of a wide stored table
    for a small part of its files, and would send the keys of many million rows
    through the driver to all tasks.
    """
    counts = other.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = many.select(key).hint("merge").join(counts, key, "inner").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"))
    return total.select(F.lit(name).alias("check_name"), "n_rows")


def integrity_report(
    spark: SparkSession,
    tables: dict[str, DataFrame | None],
    empresas: DataFrame | None,
    estabelecimento: DataFrame | None,
    socios: DataFrame | None,
) -> DataFrame:
    """Counts of the loaded tables plus the two relationship counts."""
    counts = table_counts(spark, tables).select(
        F.col("table_name").alias("check_name"), F.lit("table").alias("kind"), "n_rows", F.col("present").alias("ok")
    )
    frames = [counts]
    rels = [
        ("empresas_estabelecimento", empresas, estabelecimento, "cnpj_basico"),
        ("estabelecimento_socios", estabelecimento, socios, "cnpj"),
    ]
    for name, a, b, key in rels:
        if a is None or b is None:
            frames.append(_missing_row(spark, name).select(
                F.col("table_name").alias("check_name"), F.lit("relationship").alias("kind"), "n_rows",
                F.col("present").alias("ok")))
        else:
            frames.append(
                relationship_count(name, a, b, key).select(
                    "check_name", F.lit("relationship").alias("kind"), "n_rows", F.lit(True).alias("ok")
                )
            )
    return _union(frames)


def presence(spark: SparkSession, expected: list[str], present: DataFrame) -> DataFrame:
    """Which expected tables exist: ``present`` has one column ``table_name``."""
    exp = spark.createDataFrame([(t,) for t in expected], "table_name string")
    hit = present.select("table_name").distinct().withColumn("present", F.lit(True))
    return exp.join(hit, "table_name", "left").select(
        "table_name", F.coalesce("present", F.lit(False)).alias("present")
    )


def derived_state(counts: DataFrame) -> DataFrame:
    """absent / empty / filled for each table of a ``table_counts`` result."""
    state = F.when(~F.col("present"), "absent").when(F.col("n_rows") == 0, "empty").otherwise("filled")
    return counts.select("table_name", state.alias("state"), "n_rows")


def width_report(tables: dict[str, tuple[DataFrame, dict[str, int]]]) -> DataFrame:
    """Per column: declared width, longest value and values over the width (one pass per table)."""
    frames = []
    for name, (df, widths) in tables.items():
        cols = list(widths)
        if missing := [c for c in cols if c not in df.columns]:
            raise ValueError(f"{name} lacks the declared columns {', '.join(missing)}")
        aggs = []
        for c in cols:
            n = F.length(F.col(c))
            aggs += [F.max(n).alias(f"{c}__max"), F.count_if(n > widths[c]).alias(f"{c}__over")]
        row = df.agg(*aggs)
        stack = ", ".join(f"'{c}', {widths[c]}, `{c}__max`, `{c}__over`" for c in cols)
        frames.append(
            row.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, width, max_length, n_over)").select(
                F.lit(name).alias("table_name"),
                "column_name",
                F.col("width").cast("int").alias("width"),
                F.col("max_length").cast("int").alias("max_length"),
                F.col("n_over").cast("long").alias("n_over"),
            )
        )
    return _union(frames)


def purge_report(before: DataFrame, after: DataFrame, errors: DataFrame) -> DataFrame:
    """Rows before and after emptying, rows removed, status and the cause of a failure, per table.

    ``errors``: table_name, error of the tables that could not be emptied.
    """
    b = before.select("table_name", F.col("n_rows").alias("before"))
    a = after.select("table_name", F.col("n_rows").alias("after"))
    out = b.join(a, "table_name", "left").join(errors, "table_name", "left")
    status = (
        F.when(F.col("error").isNotNull(), "failed")
        .when(F.col("before") == 0, "already_empty")
        .when(F.col("after") == 0, "emptied")
        .otherwise("rows_left")
    )
    return out.select(
        "table_name", "before", "after", (F.col("before") - F.col("after")).alias("removed"), status.alias("status"), "error"
    )


def purge_summary(after: DataFrame) -> DataFrame:
    """Grand total left and the tables that still hold rows."""
    return after.agg(
        F.sum("n_rows").cast("long").alias("total_left"),
        F.sort_array(F.collect_list(F.when(F.col("n_rows") > 0, F.col("table_name")))).alias("tables_with_rows"),
    )


def file_sizes(files: DataFrame) -> DataFrame:
    """file_name, size_bytes and the size in MB and GB (two decimals) of a file listing."""
    return files.select(
        "file_name",
        "size_bytes",
        F.round(megabytes("size_bytes"), 2).alias("size_mb"),
        F.round(gigabytes("size_bytes"), 6).alias("size_gb"),
    )
