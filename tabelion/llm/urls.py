"""URL filter: host and path rules, then gradient-boosted trees on lexical features.

A rule fits its host and all subdomains where the url's path starts with the
rule's; the longest fitting rule decides. The trees are trained on urls that
rules decide (their labels) and judge the others, from the url's text alone:
lengths, depth, digit ratio, entropy, counts of parameters, and how often its
suffix and its first path segment were blocked in training.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import ascii_lower, staged

#: Labelled urls that the trees are fitted on, at most. It bounds the tables of suffix statistics too.
SAMPLE_URLS = 10_000
TREES, DEPTH = 10, 4
SEED = 11
THRESHOLD = 0.5
#: Weight, in rows, of the overall share in a suffix's share.
PRIOR_ROWS = 5.0


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The given rules.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.char_length(url)
    count = lambda text, c: (F.char_length(text) - F.char_length(F.replace(text, F.lit(c), F.lit("")))).cast("double")
    share = lambda c: (n - F.char_length(F.replace(url, c, F.lit("")))) / n
    shares = F.transform(F.array_distinct(F.split(url, "")), share)
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return {
        "length": n.cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "labels": count(host, "."),
        "depth": count(path, "/"),
        "digit_ratio": F.char_length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(n, F.lit(1)),
        "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "parameters": count(url, "&") + F.least(count(url, "?"), F.lit(1.0)),
        "assignments": count(url, "="),
        "hyphens": count(host, "-"),
        "secure": url.startswith("https:").cast("double"),
    }


@dataclass
class UrlModel:
    """The fitted trees (or none), the statistics of suffixes and segments, and the overall blocked share."""

    trees: Model | None
    suffixes: DataFrame
    segments: DataFrame
    blocked: float


def described(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict), suffix and segment of every row."""
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return parts.select(
        "*",
        rule.alias("rule"),
        verdict.alias("ruled"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.regexp_extract("path", r"^/([^/]*)", 1).alias("segment"),
    )


def _with_shares(rows: DataFrame, suffixes: DataFrame, segments: DataFrame, blocked: float) -> DataFrame:
    # Both tables have at most a row for each sampled url.
    rows = rows.join(F.broadcast(suffixes), "suffix", "left").join(F.broadcast(segments), "segment", "left")
    rows = rows.withColumn("suffix_share", F.coalesce("suffix_share", F.lit(blocked)))
    return rows.withColumn("segment_share", F.coalesce("segment_share", F.lit(blocked)))


def _assembled(rows: DataFrame) -> DataFrame:
    features = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    rows = rows.select("*", *[c.alias(f"f_{k}") for k, c in features.items()])
    names = [*(f"f_{k}" for k in features), "suffix_share", "segment_share"]
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows)


def train(rows: DataFrame, sample_urls: int = SAMPLE_URLS) -> UrlModel:
    """A model from the labelled among ``rows`` (of ``described``): those of the smallest url hashes.

    With urls of one label only (or none) there are no trees, and that label
    (or allow) is the verdict.
    """
    labelled = rows.where(F.col("ruled").isNotNull()).select("url", "host", "path", "suffix", "segment", "ruled")
    sample = labelled.distinct().orderBy(F.xxhash64(F.lit(SEED), "url"), "url").limit(sample_urls)
    sample = staged(sample.withColumn("label", (F.col("ruled") == "block").cast("double")), "labelled-urls")
    n, blocked = sample.agg(F.count("*"), F.coalesce(F.avg("label"), F.lit(0.0))).first()
    smooth = (F.sum("label") + PRIOR_ROWS * blocked) / (F.count("*") + PRIOR_ROWS)
    suffixes = staged(sample.groupBy("suffix").agg(smooth.alias("suffix_share")), "suffixes")
    segments = staged(sample.groupBy("segment").agg(smooth.alias("segment_share")), "segments")
    trees = None
    if n and 0 < blocked < 1:
        data = _assembled(_with_shares(sample, suffixes, segments, blocked)).select("features", "label")
        booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1)
        trees = booster.fit(staged(data.coalesce(4), "url-features"))
    return UrlModel(trees, suffixes, segments, blocked)


def judge(rows: DataFrame, model: UrlModel) -> DataFrame:
    """``rows`` plus score (the trees' probability of block) and verdict (the rule's, else the trees')."""
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(float(model.blocked)))
    else:
        ready = _assembled(_with_shares(rows, model.suffixes, model.segments, model.blocked))
        scored = model.trees.transform(ready).withColumn("score", vector_to_array("probability")[1])
    learned = F.when(F.col("score") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score"
    )


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page row.

    Nulls: a null url, or one without ``://``, has an empty host and path, so
    no rule fits it and the trees decide; a null id passes through. Repeated
    rows each give a row, empty tables none. Other columns are not read.
    """
    rows = described(pages, rules)
    return judge(rows, train(rows))
