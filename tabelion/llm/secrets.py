"""Secret scan with multipart credential linking.

Single patterns find the strong parts: assignments, access identifiers and long
hexadecimal strings. Weak parts (account names, unlabelled keys, endpoints)
prove nothing by themselves; one is reported only if a strong part that
complements it lies within ``SCOPE`` code points in the same document. The
interval join sorts a document's parts by position and looks at the nearest
complement on either side, so it is linear in the parts and makes no pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabelion.llm.common import staged, text_key

SCOPE = 300


@dataclass(frozen=True)
class Kind:
    """A part: its pattern, a cheaper pattern that every text with a match fits, and when a match counts."""

    name: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 1
    complements: tuple[str, ...] = ()  # of a weak kind: the strong kinds that it needs nearby


#: Fixed patterns of the strong parts.
STRONG = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]""",
        group=2,
        least=6,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", least=20),
    Kind("hex", r"[0-9a-f]+", r"[0-9a-f]{24}", least=24),
)
WEAK = (
    Kind(
        "user",
        r"""((?i:user(?:name)?|login|client_id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""",
        r"""(?i:user(?:name)?|login|client_id|account)["']?\x20*[:=]""",
        group=2,
        least=3,
        complements=("assign", "hex"),
    ),
    Kind("key", r"[A-Za-z0-9+/]{40,}", r"[A-Za-z0-9+/]{40}", least=40, complements=("access",)),
    Kind("endpoint", r"https?://[A-Za-z0-9._~:/-]+", r"https?://", least=10, complements=("assign", "access")),
)
_ORDER = [k.name for k in (*STRONG, *WEAK)]


def _matches(text: Column, kind: Kind, wanted: Column) -> Column:
    """(kind, i, gap, match) for each match, leftmost and not overlapping, with the code points before it.

    The pieces between matches and the matches alternate, so running sums of
    their lengths give positions. The last piece comes with a null match.
    """
    pairs = F.arrays_zip(F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)))
    found = F.transform(
        pairs,
        lambda x, i: F.struct(
            F.lit(kind.name).alias("kind"), i.alias("i"), F.char_length(x["0"]).alias("gap"), x["1"].alias("match")
        ),
    )
    return F.when(wanted, found).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,match:string>>"))


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, kind, start, end of the strong parts, and of the weak ones in texts with a strong hint."""
    text = F.col("text")
    strong = {k.name: text.rlike(k.hint) for k in STRONG}
    hinted = docs.select("doc_id", "text", *[c.alias(f"has_{k}") for k, c in strong.items()])
    hinted = hinted.where(F.col("has_assign") | F.col("has_access") | F.col("has_hex"))
    arrays = [_matches(text, k, F.col(f"has_{k.name}")) for k in STRONG]
    arrays += [_matches(text, k, text.rlike(k.hint)) for k in WEAK]
    rows = hinted.select("doc_id", text_key(text).alias("text_key"), F.inline(F.concat(*arrays)))
    rows = staged(rows.distinct(), "parts")  # a repeated row has the same parts again
    before = Window.partitionBy("doc_id", "text_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.coalesce(F.char_length("match"), F.lit(0))
    placed = rows.withColumn("end", F.sum(F.col("gap") + length).over(before)).withColumn("start", F.col("end") - length)
    counts = F.lit(False)
    for k in (*STRONG, *WEAK):
        value = F.regexp_extract("match", k.pattern, k.group)
        counts = counts | ((F.col("kind") == k.name) & (F.char_length(value) >= k.least))
    return placed.where(F.col("match").isNotNull() & counts).select("doc_id", "text_key", "kind", "start", "end")


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The strong parts, and the weak ones that complement one within ``scope`` without overlapping a strong part."""
    in_text = Window.partitionBy("doc_id", "text_key").orderBy("start", "end", "kind")
    before = in_text.rowsBetween(Window.unboundedPreceding, -1)
    after = in_text.rowsBetween(1, Window.unboundedFollowing)
    strong = F.col("kind").isin([k.name for k in STRONG])
    reported, near = strong, parts
    for k in WEAK:
        other = F.col("kind").isin(list(k.complements))
        near = near.withColumn(f"{k.name}_before", F.max(F.when(other, F.col("end"))).over(before))
        near = near.withColumn(f"{k.name}_after", F.min(F.when(other, F.col("start"))).over(after))
        close = (F.col("start") - F.col(f"{k.name}_before") <= scope) | (F.col(f"{k.name}_after") - F.col("end") <= scope)
        reported = reported | ((F.col("kind") == k.name) & F.coalesce(close, F.lit(False)))
    near = near.withColumn("reach", F.max(F.when(strong, F.col("end"))).over(before))
    near = near.withColumn("next", F.min(F.when(strong, F.col("start"))).over(after))
    free = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    return near.where(reported & (strong | free)).select("doc_id", "text_key", "kind", "start", "end")


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base and spans of every document row.

    ``base`` and ``spans`` list kind:start:end (code points, end exclusive) by
    start, then kind in the order assign, access, hex, user, key, endpoint,
    joined by commas; ``base`` has the strong parts alone.

    Nulls: a null text is empty, a null id passes through. Repeated rows each
    give a row, empty tables none. Other columns are not read.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rank = F.array_position(F.array(*[F.lit(k) for k in _ORDER]), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("span"))
    strong = F.col("kind").isin([k.name for k in STRONG])
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda s: s["span"]), ",")
    found = (
        link_parts(find_parts(docs), scope)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
        .agg(
            *[F.count(F.when(F.col("kind") == k.name, 1)).alias(f"n_{k.name}") for k in STRONG],
            joined(F.collect_list(F.when(strong, span))).alias("base"),
            joined(F.collect_list(span)).alias("spans"),
        )
    )
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"))
    both = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")), "left")
    return both.select(
        "doc_id",
        *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in STRONG],
        F.coalesce("base", F.lit("")).alias("base"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
