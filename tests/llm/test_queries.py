"""The registered queries: against DuckDB, or against brute force in plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tabelion.llm import crf, ordinal, urls
from tabelion.llm.common import table
from tabelion.llm.decontaminate import words_of
from tabelion.llm.queries import LLM_ORACLES, LLM_QUERIES
from tabelion.oracle import compare

SF = "/root/testdata/sf0.001"
SF_LEARN = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_oracle(spark, name):
    r = compare(LLM_QUERIES[name](spark, SF), LLM_ORACLES[name], SF)
    assert r["rows_match"] and r["schema_match"] and r["value_match"], r


def test_every_operator_has_a_query():
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in LLM_QUERIES)] == []
    assert "pipeline" in LLM_QUERIES


def documents(spark, sf=SF):
    return [(r.doc_id, r.text or "") for r in table(spark, sf, "documents").collect()]


def jaccard_classes(docs, threshold=0.8):
    """Classes by comparing all pairs on multisets of five-word shingles."""
    bags = {}
    for doc, text in docs:
        w = words_of(text.encode())
        n = min(5, len(w))
        bags[doc] = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()
    holders = defaultdict(set)
    for doc, bag in bags.items():
        for s in bag:
            holders[s].add(doc)
    parent = {d: d for d in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in bags:
        for b in {d for s in bags[a] for d in holders[s] if d > a}:
            both = sum((bags[a] & bags[b]).values())
            if both / (sum(bags[a].values()) + sum(bags[b].values()) - both) >= threshold:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in bags}


def test_near_duplicates_match_brute_force(spark):
    got = {r.doc_id: r.class_id for r in LLM_QUERIES["op1_minhash_near_dedup"](spark, SF_LEARN).collect()}
    assert got == jaccard_classes(documents(spark, SF_LEARN))


def test_url_parts_and_rules_match_brute_force(spark):
    got = {r.page_id: r for r in LLM_QUERIES["op4_url_filter"](spark, SF).collect()}
    pages = table(spark, SF, "pages").select("page_id", "url").collect()
    assert len(got) == len(pages)
    for page in pages:
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", page.url or "")
        host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
        fits = [r for r in urls.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        row = got[page.page_id]
        assert (row.host, row.path, row.rule) == (host, path, best and best.text)
        assert row.verdict == best.verdict if best else row.verdict in ("allow", "block")


def test_trees_agree_with_rules_on_unseen_urls(spark):
    rows = urls.described(table(spark, "/root/testdata/sf0.1", "pages")).where("ruled is not null")
    seen, unseen = rows.where("pmod(hash(url), 4) > 0"), rows.where("pmod(hash(url), 4) = 0")
    model = urls.train(seen)
    hidden = unseen.withColumn("truth", unseen["ruled"]).withColumn("ruled", unseen["ruled"].substr(1, 0))
    hidden = hidden.replace("", None, ["ruled"])
    scored = urls.judge(hidden, model).collect()
    truth = {r.page_id: r.truth for r in hidden.select("page_id", "truth").collect()}
    right = sum(r.verdict == truth[r.page_id] for r in scored)
    assert right / len(scored) > 0.95


ASSIGN = re.compile(
    r"""((?ia:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secret_spans_match_brute_force(spark):
    got = {r.doc_id: r for r in LLM_QUERIES["op6_secret_scan"](spark, SF_LEARN).collect()}
    docs = documents(spark, SF_LEARN)
    assert len(got) == len(docs)
    for doc, text in docs:
        spans = base_spans(text)
        kinds = Counter(k for _, k, _ in spans)
        row = got[doc]
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds[0], kinds[1], kinds[2])
        assert row.base_sha256 == hashlib.sha256(",".join(s for *_, s in spans).encode()).hexdigest()
        assert {s for *_, s in spans} <= set(row.spans.split(",")) | {""}


def rule_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(hit)


def test_rule_counts_match_brute_force(spark):
    rows = LLM_QUERIES["op7_quality_rules"](spark, SF_LEARN).collect()
    want = {d: rule_counts(t) for d, t in documents(spark, SF_LEARN)}
    assert len(rows) == len(want)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_line_field_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in LLM_QUERIES["op9_line_quality"](spark, SF_LEARN).collect()}
    assert len(rows) == table(spark, SF_LEARN, "documents").count()
    labels = [(rows[x.doc_id], x.quality) for x in table(spark, SF_LEARN, "labels").collect()]
    held = [(r, y) for r, y in labels if r.held_out]
    assert len(held) > 40 and sum(r.predicted == y for r, y in held) / len(held) > 0.97
    worst_good = min(r.score for r, y in held if y)
    assert all(r.score < worst_good for r, y in held if not y)


def test_severity_on_unseen_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    seen, unseen = labels.where(crf.fold(labels["doc_id"]) != 0), labels.where(crf.fold(labels["doc_id"]) == 0)
    model = ordinal.train(docs, seen)
    got = {r.doc_id: r for r in ordinal.grade_documents(docs.join(unseen, "doc_id", "left_semi"), model).collect()}
    toxic = [got[r.doc_id] for r in unseen.collect() if r.toxic]
    clean = [got[r.doc_id] for r in unseen.collect() if not r.toxic]
    # Some documents labelled toxic hold no word that tells.
    assert sum(r.toxic for r in toxic) / len(toxic) > 0.9
    assert sum(r.toxic for r in clean) / len(clean) < 0.02
    assert all(0 <= r.severity <= 3 for r in got.values())
