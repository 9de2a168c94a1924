"""The registered queries of the operators, and DuckDB SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabelion.llm import (
    bpe,
    centroids,
    collocations,
    crf,
    decontaminate,
    linededup,
    merkle,
    mixing,
    neardup,
    ordinal,
    rules,
    secrets,
    urls,
)
from tabelion.llm.common import staged, table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a replica of all pages in which, at known ids, bytes were altered, texts cut and records lost; others
    stand a second time behind the records of their archive, or in an archive that the index does not know."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    html, at = F.coalesce("html", F.lit("")), F.col("page_id")
    body = (
        F.when(at % 97 == 5, F.overlay(html, F.lit("~"), F.lit(12)))
        .when(at % 157 == 9, F.left(html, F.floor(F.char_length(html) / 2).cast("int")))
        .otherwise(html)
    )
    index = staged(merkle.archive_index(merkle.record_digests(pages).drop("own")), "index")
    # The replica's records lie where the index says; they are found by the page's own digest.
    copy = merkle.record_digests(pages, body).where(F.coalesce(at % 211 != 3, F.lit(True))).distinct()
    copy = copy.select("page_id", "own", F.col("digest").alias("read"))
    here = index["page_id"].eqNullSafe(copy["page_id"]) & (index["digest"] == copy["own"])
    place = F.struct("archive", "ordinal")
    behind = F.struct("archive", (F.col("ordinal") + merkle.RECORDS_PER_ARCHIVE).alias("ordinal"))
    stray = F.struct((-1 - F.col("archive")).alias("archive"), "ordinal")
    places = F.when(F.col("at") == 7, F.array(place, behind)).when(F.col("at") == 8, F.array(place, stray)).otherwise(F.array(place))
    replica = index.join(copy, here).withColumn("at", index["page_id"] % 211).select(
        F.inline(places), "record_start", "record_end", F.col("read").alias("digest")
    )
    return merkle.audit(index, staged(replica, "replica")).select(
        "page_id",
        "archive",
        "record_start",
        "record_end",
        F.col("digest").alias("sha256"),
        "archive_root",
        "verdict",
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items = F.size("item_ids").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        n_items.alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.grade_documents(docs, ordinal.train(docs, table(spark, sf_dir, "labels")))


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.score_documents(docs, crf.train(docs, table(spark, sf_dir, "labels")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined, dropped, runs = linededup.join_bitmaps(docs, linededup.line_bitmaps(docs))
    return joined.select(
        docs["doc_id"],
        F.size(linededup.lines_of(docs["text"])).cast("long").alias("n_lines"),
        dropped.alias("n_dropped"),
        F.sha2(linededup.kept_lines(docs["text"], runs), 256).alias("kept_sha256"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_collocations(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)
    return bpe.decode(encoded, tokens).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_warc_merkle_audit,
        op3_benchmark_decontamination,
        op4_url_filter,
        op5_mix_sources,
        op6_secret_scan,
        op7_quality_rules,
        op8_toxicity,
        op9_line_quality,
        op10_line_dedup,
        op11_phrase_collocations,
        op12_byte_bpe,
        op13_centroid_clustering,
        pipeline,
    )
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RECORD = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
  || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
  || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen({body}) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)
  || {body} || chr(13) || chr(10) || chr(13) || chr(10)"""


def _level(below: str) -> str:
    return f"""SELECT archive, node // 10 AS node, min(a) AS a, max(b) AS b,
  sha256(string_agg(a || ':' || b || ':' || digest, chr(10) ORDER BY node)) AS digest FROM {below} GROUP BY ALL"""


def _clustering(k: int, rounds: int) -> str:
    """Each round: the nearest centroid by (distance, number), then sums over counts, rounded down; empty ones stay."""
    text = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS INTEGER) AS c, q
  FROM v ORDER BY c LIMIT {k})"""
    for i in range(rounds + 1):
        text += f""",
d{i} AS (SELECT r, c, CAST(list_sum(list_transform(list_zip(v.q, c{i}.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
  FROM v, c{i}),
a{i} AS MATERIALIZED (SELECT r, min((d, c)) AS best FROM (SELECT r, c, d FROM d{i}) GROUP BY r)"""
        if i < rounds:
            text += f""",
m{i} AS (SELECT c, list(CAST(s AS BIGINT) ORDER BY j) AS q FROM (
  SELECT c, j, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS s
  FROM (SELECT best[2] AS c, unnest(q) AS x, unnest(range(64)) AS j FROM a{i} JOIN v USING (r)) GROUP BY c, j) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.q, c{i}.q) AS q FROM c{i} LEFT JOIN m{i} USING (c))"""
    return text + f"""
SELECT vec_id, best[2] AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.c = best[2]"""


_BREAKS = "chr(46) || ',;:!?' || chr(10) || chr(11) || chr(12) || chr(13)"

LLM_ORACLES: dict[str, str] = {
    "op11_phrase_collocations": rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(translate(coalesce(text, ''), {_AZ}),
    {_BREAKS}, repeat(chr(10), 10)), chr(10))) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS p FROM (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, p, any_value(m) AS m, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, p HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
cand AS (SELECT lang, p, m, f AS a, string_split(p, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT lang, p, m, a, w, unnest(range(1, m)) AS k FROM cand),
s AS (SELECT cuts.lang, cuts.p, cuts.m, a, k, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.p = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.p = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM cand x WHERE b.m = 2 AND x.m = 3 AND x.lang = b.lang
  AND (array_to_string(x.w[1:2], ' ') = b.p OR array_to_string(x.w[2:3], ' ') = b.p) AND 100 * x.a >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
SELECT lang, rank, p AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_centroid_clustering": _clustering(40, 5),
    "op2_warc_merkle_audit": f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html,
  CASE WHEN page_id % 97 = 5 THEN html[:11] || '~' || html[13:] WHEN page_id % 157 = 9 THEN html[:length(html) // 2]
    ELSE html END AS body FROM pages),
r AS (SELECT page_id, {_RECORD.format(body="html")} AS mine, {_RECORD.format(body="coalesce(body, '')")} AS theirs FROM p),
d AS (SELECT page_id, strlen(mine) AS n, sha256(mine) AS digest, sha256(theirs) AS read,
  CASE WHEN page_id % 211 = 3 THEN 'missing' WHEN mine <> theirs THEN 'altered' ELSE 'intact' END AS verdict FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, digest) - 1 AS rn FROM d),
l0 AS (SELECT *, rn // 1000 AS archive, rn % 1000 AS node,
  CAST(sum(n) OVER (PARTITION BY rn // 1000 ORDER BY rn) AS BIGINT) AS b FROM o),
l0a AS (SELECT archive, node, b - n AS a, b, digest FROM l0),
l1 AS ({_level("l0a")}), l2 AS ({_level("l1")}), l3 AS ({_level("l2")})
SELECT page_id, l0.archive, l0.b - n AS record_start, l0.b AS record_end, l0.digest AS sha256,
  l3.digest AS archive_root, verdict FROM l0 JOIN l3 ON l0.archive = l3.archive
UNION ALL
SELECT NULL, l0.archive, l0.b - n, l0.b, read, l3.digest, 'extra' FROM l0 JOIN l3 ON l0.archive = l3.archive WHERE page_id % 211 = 7
UNION ALL
SELECT NULL, -1 - archive, b - n, b, read, NULL, 'extra' FROM l0 WHERE page_id % 211 = 8""",
    "op3_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
starts AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
grams AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM starts),
hits AS (SELECT r, grams.n, i, item FROM grams JOIN wins ON grams.n = wins.n AND grams.g = wins.g),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN found USING (r)""",
    "op5_mix_sources": rf"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
src AS (SELECT source, sum(size) AS ss, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]
    AS DOUBLE) AS w FROM s GROUP BY source),
cum AS (SELECT *, 2.0 * ss / w AS ratio,
    coalesce(sum(2.0 * ss) OVER (ORDER BY 2.0 * ss / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(w) OVER (ORDER BY 2.0 * ss / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM src),
lev AS (SELECT min_by((1.5 * (SELECT sum(ss) FROM src) - capped) / free, ratio) FILTER
    (WHERE (1.5 * (SELECT sum(ss) FROM src) - capped) / free < ratio) AS level FROM cum),
tgt AS (SELECT source, ss, CASE WHEN level IS NULL THEN 2.0 * ss ELSE least(2.0 * ss, w * level) END AS target
    FROM src, lev),
e AS (SELECT *, CASE WHEN ss > 0 THEN floor(target / ss) ELSE 0 END AS whole FROM tgt),
k AS (SELECT source, k, sum(size) AS size FROM s GROUP BY source, k),
u AS (SELECT source, k, size, sum(size) OVER (PARTITION BY source ORDER BY k) AS upto FROM k),
last AS (SELECT u.source, max(k) AS last_key FROM u JOIN e ON u.source IS NOT DISTINCT FROM e.source
    WHERE target - whole * ss > 0 AND 2 * upto - size <= 2 * (target - whole * ss) GROUP BY u.source)
SELECT doc_id, size, CAST(ss AS BIGINT) AS source_size, round(target, 6) AS target,
  CAST((whole + CASE WHEN s.k <= last_key THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM s JOIN e ON s.source IS NOT DISTINCT FROM e.source LEFT JOIN last ON s.source IS NOT DISTINCT FROM last.source""",
    "op10_line_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, p, ls[p] AS line, translate(trim(ls[p], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    {_AZ}) AS k FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS p FROM d)),
m AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT r, doc_id, p, line, coalesce(doc_id < keeper, false) AS dropped FROM l LEFT JOIN m USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM f GROUP BY r""",
}
