"""Collocations, byte-level BPE and centroid clustering against plain Python, and their edge cases."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tabelion.llm import bpe, centroids, collocations
from tabelion.llm.common import table

SF = "/root/testdata/sf0.001"
SF_LEARN = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string"


# --- collocations ---------------------------------------------------------------------------------------


def brute_collocations(rows, min_count=10, max_words=3, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        found = []
        for p, a in cand.items():
            if inside[p] and 100 * inside[p] >= 50 * a:
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def mined(docs, **options):
    return sorted(map(tuple, collocations.top_collocations(docs, **options).collect()))


def test_collocations_match_brute_force_however_sharded(spark):
    docs = table(spark, SF_LEARN, "documents").where("length(text) < 3000").repartition(3, "doc_id").cache()
    want = brute_collocations([(r.lang, r.text) for r in docs.collect()])
    assert len(want) > 200
    # Shards from some texts (support 1) to a whole task (support above 1), and a bitmap that says nothing.
    assert mined(docs, run_words=10**9) == want
    assert mined(docs, run_words=500) == want
    assert mined(docs, run_words=20_000, bits=64) == want


def test_local_supports_leave_out_and_lose_nothing(spark):
    """In two shards at support 5 a phrase found 5 and 4 times is a candidate of the first, and no phrase; 5 and 5 times is one."""
    rows = [(0, "x y. " * 5 + "u v. " * 5 + "q r. " * 9, "en"), (1, "x y. " * 4 + "u v. " * 5 + "q s. " * 10, "en")]
    docs = spark.createDataFrame(rows, DOCS).repartitionByRange(2, "doc_id")
    got = {r.phrase: r.f for r in collocations.frequent_phrases(docs, run_words=1)[0].collect()}
    assert got == {"u": 10, "v": 10, "u v": 10, "q": 19, "s": 10, "q s": 10}


def test_longer_phrases(spark):
    rows = [("en", "one two three four five, " * 12 + "one two three " * 3), (None, "a a a a a a a a a a a a a a. b")]
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], DOCS)
    assert mined(docs, max_words=4) == brute_collocations(rows, max_words=4)
    assert mined(docs, max_words=2, min_count=3, top=2) == brute_collocations(rows, 3, 2, 2)


def test_collocation_edges(spark):
    long = "Blue SKY\tover; " * 50_000
    rows = [(1, None, "en"), (2, "", None), (None, long, "en"), (3, "Æ Ø. " * 10, "da"), (3, "Æ Ø. " * 10, "da"), (4, " \t.,", "")]
    rows += [(5, "tie one, two tie! " * 10, None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = brute_collocations([(x, t) for _, t, x in rows])
    assert mined(docs) == want and ("da", 1, "Æ Ø", 20, 20, 20, 40, 1000000) in want
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in ("phrase", "f", "n", "hash", "a", "rank", "words", "score")])
    assert mined(clashing) == want
    assert mined(docs.limit(0)) == [] and mined(docs.where("doc_id = 1")) == []


def test_text_is_cut_between_words_only(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 7)
    data = b"ab cd\nefghijklmno p q rs tu"
    parts = list(collocations._slices(data))
    assert b"".join(parts) == data and len(parts) > 2
    assert [w for x in parts for w in x.split()] == data.split()


# --- byte-level BPE -------------------------------------------------------------------------------------


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def vocabulary(request):
    path = public_tokenizers.path(request.param)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.load_ranks(path), theirs


def coded(spark, texts, tokens):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = bpe.encode(docs, tokens, public_tokenizers.PATTERN)
    return {r.doc_id: (list(r.ids), bytes(r.bytes)) for r in bpe.decode(encoded, tokens).collect()}


def agrees(spark, texts, vocabulary):
    tokens, theirs = vocabulary
    got = coded(spark, texts, tokens)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == (theirs.encode_ordinary(text or ""), (text or "").encode()), text and text[:50]


def test_bpe_agrees_with_tiktoken_on_documents(spark, vocabulary):
    agrees(spark, [r.text for r in table(spark, SF_LEARN, "documents").collect()], vocabulary)


def test_bpe_agrees_with_tiktoken_on_every_character(spark, vocabulary):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(every[i : i + 64]) for i in range(0, len(every), 64)]
    # Between letters, before blanks, doubled: where the pattern's classes decide.
    texts += [" ".join(f"a{c}b {c}{c}" for c in every[i : i + 64]) for i in range(0, 0x3100, 64)]
    agrees(spark, texts, vocabulary)


def test_bpe_agrees_with_tiktoken_on_made_up_texts(spark, vocabulary):
    pick = random.Random(5)
    kinds = ["aaaaaab", "abcdefghijklmnop", "theingtionandere ", "0123456789 ", "!?#-_=*/ \n\t  ", "äöüß漢字かな😀é ", "\r\n  \x00\x1c\x85 "]
    texts = ["".join(pick.choice(pick.choice(kinds)) for _ in range(pick.randrange(200))) for _ in range(600)]
    texts += ["".join(pick.choice(k) for _ in range(300)) for k in kinds for _ in range(20)]
    texts += [None, "", "x" * 3_000, "ab" * 20_000, "<|endoftext|> it's I'LL we've", " " * 5_000, "\n" * 999 + "end"]
    agrees(spark, texts, vocabulary)


def test_bpe_edges(spark, vocabulary, monkeypatch):
    tokens, theirs = vocabulary
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None), (2, "")], "doc_id long, text string")
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in ("id", "ids", "bytes", "tokens")])
    for d in (docs, clashing):
        got = sorted(((r.doc_id, list(r.ids)) for r in bpe.encode(d, tokens, public_tokenizers.PATTERN).collect()), key=str)
        one = theirs.encode_ordinary("one two")
        assert got == sorted([(1, one), (1, one), (None, []), (2, [])], key=str)
    assert bpe.decode(bpe.encode(docs.limit(0), tokens, public_tokenizers.PATTERN), tokens).count() == 0
    lists = spark.createDataFrame([(1, [0, 5], "x"), (2, None, "y"), (3, [], None)], "bytes long, ids array<int>, other string")
    kept = bpe.decode(lists, tokens, out="read")
    assert kept.columns == ["bytes", "ids", "other", "read"]
    assert [r.read for r in kept.orderBy("bytes").collect()] == [tokens[0] + tokens[5], None, b""]


def test_bpe_in_small_slices_and_with_little_memory(vocabulary):
    """The same tokens when words are looked up in parts and forgotten after each slice."""
    import types

    import pyarrow as pa

    tokens, theirs = vocabulary
    texts = [f"word{i % 7} and {i}, or " * 40 for i in range(30)] + ["z" * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(range(31)), pa.array(texts)], names=["id", "text"])
    small = {"SHARD": 3000, "LONG": 80, "REMEMBERED": 1000, "MANY": 2}
    kept = {k: getattr(bpe, k) for k in small}
    try:
        for k, v in small.items():
            setattr(bpe, k, v)
        out = bpe._encode(types.SimpleNamespace(value=tokens), public_tokenizers.PATTERN)(iter([batch]))
        got = [row for part in out for row in part.column("ids").to_pylist()]
    finally:
        for k, v in kept.items():
            setattr(bpe, k, v)
    assert got == [theirs.encode_ordinary(t) for t in texts]


def test_bpe_query_digests(spark):
    from tabelion.llm.queries import LLM_QUERIES

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted(map(tuple, LLM_QUERIES["op12_byte_bpe"](spark, SF).collect()))
    want = []
    for r in table(spark, SF, "documents").collect():
        ids = theirs.encode_ordinary(r.text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (r.text or "").encode())]
        want.append((r.doc_id, len(ids), *sha))
    assert got == sorted(want)


# --- centroid clustering --------------------------------------------------------------------------------


def brute_clusters(rows, k=40, rounds=5, dimensions=64):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dimensions and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(256 * v) for v in x]))
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cs = [q for _, q in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), i) for i, c in enumerate(cs)) for _, q in kept]

    for _ in range(rounds):
        at = assign()
        for i in range(len(cs)):
            mine = [q for (_, q), (_, c) in zip(kept, at, strict=True) if c == i]
            if mine:
                cs[i] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    at = assign()
    inertia = Counter()
    for d, c in at:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, at, strict=True)), key=str)


def clustered(vectors, **options):
    return sorted(map(tuple, centroids.cluster_report(vectors, **options).collect()), key=str)


def test_clusters_match_brute_force(spark):
    vectors = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert clustered(vectors) == brute_clusters(rows)
    assert clustered(vectors, k=3, rounds=2) == brute_clusters(rows, 3, 2)


def test_cluster_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (None, [3.0, -0.001]), (3, None), (4, []), (5, [1.0])]
    rows += [(6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, -inf]), (9, [None, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [-7.9, 100.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    as_read = [(r.vec_id, r.embedding) for r in vectors.collect()]
    for k in (1, 2, 3, 40):
        want = brute_clusters(as_read, k, 5, 2)
        assert len(want) == 5 and clustered(vectors, k=k, dimensions=2) == want
    clashing = vectors.select("*", *[F.lit("x").alias(c) for c in ("q", "cluster", "distance", "n", "best", "s0")])
    assert clustered(clashing, k=2, dimensions=2) == brute_clusters(as_read, 2, 5, 2)
    assert clustered(vectors.limit(0)) == [] and clustered(vectors) == []
    with pytest.raises(Exception, match="a component of 524288 or more"):
        clustered(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dimensions=2)


def test_clusters_run_without_python_workers(spark):
    vectors = table(spark, SF, "embeddings")
    plan = centroids.integer_vectors(vectors, 64, 256, "vec_id", "embedding").select(centroids.nearest([[1] * 64, [2] * 64]))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())


def test_tokens_of_a_few_million_characters_are_held_at_a_time():
    import pyarrow as pa

    from tabelion.llm import bpe

    class Sent:
        value = [bytes([b]) for b in range(256)] + [b"ab"]

    texts = ["ab cd " * 170_000] * 20
    batch = pa.record_batch([pa.array(range(20)), pa.array(texts)], names=["id", "text"])
    out = list(bpe._encode(Sent, r"\S+|\s+")(iter([batch])))
    assert sum(b.num_rows for b in out) == 20 and max(b.num_rows for b in out) <= 10
    assert all(len(x) == 5 * 170_000 for b in out for x in b.column("ids"))
