"""Centroid clustering of integer vectors with JVM expressions only.

A round assigns each vector to its nearest centroid, by ``zip_with`` and
``aggregate`` against literal centroid arrays and ``array_min`` over structs of
(distance, number), then replaces the centroids by column sums over counts. The
driver holds the centroids only. Sums and distances are exact integers, so the
result does not depend on how the rows are dealt.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import staged

DIMENSIONS = 64
SCALE = 256
K = 40
ROUNDS = 5
SEED = "2"
#: Components stay below this, so that squared distances of 64 components fit into 64 bits.
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, dimensions: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, q): floor(scale * x) for the vectors with ``dimensions`` components, none null or non-finite."""
    x = F.col(vector_col)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = vectors.where(F.when(F.size(x) == dimensions, ~odd).otherwise(False))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    wide = F.exists("q", lambda v: F.abs(v) >= LARGEST)
    fits = F.when(~wide, True).otherwise(F.raise_error(F.lit(f"a component of {LARGEST // scale} or more")))
    return kept.select(F.col(id_col).alias("vec_id"), q.alias("q")).where(fits)


def nearest(centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid to ``q``; of equally near ones, the smaller number."""

    def distance(c: list[int]) -> Column:
        literal = F.expr(f"array({', '.join(f'{v}L' for v in c)})")
        return F.aggregate(F.zip_with("q", literal, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, d: s + d)

    return F.array_min(
        F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)])
    )


def cluster(
    vectors: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each kept vector, and the final centroids.

    The ``k`` vectors of the smallest sha256 of ``seed:id`` start as
    centroids (a null id as no text; of equal ids, those of the smaller
    components first). A round assigns every vector, then each centroid becomes
    floor(sum / count) of its vectors; one without vectors stays.

    Vectors of another length, null, or with a null or non-finite component are
    left out; fewer than ``k`` vectors are as many centroids; repeated rows
    count each; no vectors give no rows. A component of 2^27 / ``scale`` or more
    is an error, as distances would not fit into 64 bits. Other columns are not read.
    """
    kept = staged(integer_vectors(vectors, dimensions, scale, id_col, vector_col), "vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = [list(r.q) for r in kept.orderBy(key, "q").select("q").limit(k).collect()]
    if not centroids:
        empty = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty.limit(0), []
    sums = [F.sum(F.col("q")[j]).alias(f"s{j}") for j in range(dimensions)]
    for _ in range(rounds):
        parts = kept.select(nearest(centroids)["cluster"].alias("cluster"), "q").groupBy("cluster")
        for r in parts.agg(F.count("*").alias("n"), *sums).collect():  # k rows at most
            centroids[r.cluster] = [r[f"s{j}"] // r.n for j in range(dimensions)]
    best = kept.select("vec_id", nearest(centroids).alias("best"))
    return staged(best.select("vec_id", "best.cluster", "best.distance"), "clusters"), centroids


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector (see ``cluster``)."""
    assigned, centroids = cluster(vectors, **options)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    parts = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    rows = [(i, parts.get(i, 0), sum(parts.values()), d) for i, d in enumerate(digests)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    table = F.broadcast(assigned.sparkSession.createDataFrame(rows, schema))  # a row for each centroid
    return assigned.join(table, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
