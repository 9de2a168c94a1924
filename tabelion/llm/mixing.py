"""Mixing sources to target weights by capped water-filling.

A target for each source is its share of the budget by weight, clamped at
``max_epochs`` times the source's size; what a clamp frees is reshared by
weight among the sources that are not clamped, until none is above. A source
then takes whole repetitions of all its documents and a seeded fractional one:
documents in the order of a seeded hash, up to the hash where the running size
comes nearest to the rest of the target. The decision for a document needs its
id and source only, so the texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabelion.llm.common import NON_BLANK_RUN, staged
from tabelion.operators.numbering import row_number_within

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 17
#: Hex digits of the hash that make a bucket: the running sizes need 16**3 sums for each source, and
#: only the bucket in which a source's rest ends is put in order.
BUCKET_DIGITS = 3
#: Sources up to which their table (some 100 bytes each) is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NON_BLANK_RUN)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, weight) plus ``target``; one small aggregate per round of clamping.

    Only three numbers a round reach the driver. Rounds end when no further
    source is clamped: at most one round for each source, few in practice.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        row = sources.agg(
            F.sum(F.when(above, cap)).alias("cap"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if row["weight"] is None or row["n"] == clamped:
            break
        clamped = row["n"]
        level = max(0.0, total - (row["cap"] or 0.0)) / row["weight"]
    target = F.lit(0.0) if level is None else F.least(cap, F.col("weight") * F.lit(level))
    return sources.withColumn("target", F.round(target, 6))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan). sizes: doc_id, source, size of every document row. plan, a row for each source:
    source, source_size, target, whole (repetitions of all), last_key (the fractional one ends there, or null).

    Sources in code-point order, null last, have ``weights`` in turn. A
    source's taken words differ from its target by half the size of one
    document at most. Documents with the same id stand or fall together.
    """
    sizes = staged(
        docs.select(
            "doc_id", "source", n_words(F.col("text")).alias("size"), order_key(F.col("doc_id"), seed).alias("key")
        ),
        "sizes",
    )
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    sums = staged(
        sizes.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n")), "sums"
    )
    per_source = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = row_number_within(
        per_source.withColumn("one", F.lit(1)).withColumn("rank", F.struct(F.col("source").isNull(), F.col("source"))),
        "one",
        "rank",
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = staged(
        ranked.select(
            "source", "source_size", F.element_at(turn, (F.pmod(F.col("rn") - 1, len(weights)) + 1).cast("int")).alias("weight")
        ),
        "sources",
    )
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    filled = water_fill(ranked, total, max_epochs).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"),
    )
    filled = filled.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    r, f = running.alias("r"), filled.alias("f")
    ends = (
        r.join(f, F.col("r.source").eqNullSafe(F.col("f.source")))
        .where(F.col("before") <= F.col("rest"))
        .groupBy(F.col("r.source").alias("source"))
        .agg(
            F.max("bucket").alias("bucket"),
            F.max("before").alias("before"),
            F.first("rest").alias("rest"),
        )
    )
    s, e = sizes.withColumn("bucket", bucket).alias("s"), ends.alias("e")
    # The last bucket that begins below the rest; all buckets before it are taken whole.
    edge = (
        s.join(
            F.broadcast(e) if ranked.count() <= BROADCAST_SOURCES else e,
            F.col("s.source").eqNullSafe(F.col("e.source")) & (F.col("s.bucket") == F.col("e.bucket")),
        )
        .groupBy(F.col("s.source").alias("source"), F.col("s.key").alias("key"))
        .agg(F.sum("s.size").alias("size"), F.first("e.before").alias("before"), F.first("e.rest").alias("rest"))
    )
    up_to = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        edge.withColumn("upto", F.col("before") + F.sum("size").over(up_to))
        .where(2 * F.col("upto") - F.col("size") <= 2 * F.col("rest"))
        .groupBy("source")
        .agg(F.max("key").alias("key"))
    )
    i = inside.alias("i")
    # Where none of the last bucket's documents is taken, the fractional repetition ends before it.
    last_key = F.when(F.col("f.rest") > 0, F.coalesce(F.col("i.key"), F.col("e.bucket")))
    plan = (
        f.join(e, F.col("f.source").eqNullSafe(F.col("e.source")), "left")
        .join(i, F.col("f.source").eqNullSafe(F.col("i.source")), "left")
        .select(
            F.col("f.source").alias("source"),
            "source_size",
            "target",
            F.col("whole").cast("long").alias("whole"),
            last_key.alias("last_key"),
        )
    )
    return sizes, staged(plan, "mix")


def with_copies(rows: DataFrame, plan: DataFrame, key: Column) -> tuple[DataFrame, DataFrame, Column]:
    """``rows`` joined to their source's line of the plan; that plan, renamed; and the number of copies."""
    p = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns])
    if plan.count() <= BROADCAST_SOURCES:
        p = F.broadcast(p)
    extra = F.when(key <= p["_mix_last_key"], 1).otherwise(0)
    return rows.join(p, rows["source"].eqNullSafe(p["_mix_source"])), p, p["_mix_whole"] + extra


def mix_report(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document row.

    Nulls: a null text has size 0, a null source is a source of its own (last
    in order), a null id takes part like any other. Repeated rows are taken
    equally often. A table without words gives targets of 0; an empty one no
    rows. Other columns are not read.
    """
    sizes, plan = plan_mix(docs, seed=seed, **options)
    out, p, copies = with_copies(sizes, plan, sizes["key"])
    return out.select(
        "doc_id",
        "size",
        p["_mix_source_size"].alias("source_size"),
        p["_mix_target"].alias("target"),
        (copies * sizes["size"]).alias("taken"),
    )


def mix(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: all columns of ``docs`` and ``copy`` (from 1), a row for each repetition taken."""
    plan = plan_mix(docs, seed=seed, **options)[1]
    out, _, copies = with_copies(docs, plan, order_key(docs["doc_id"], seed))
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy")
    return out.where(copies > 0).select(*[docs[c] for c in docs.columns if c != "copy"], repeated)
