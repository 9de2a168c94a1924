import pytest
from pyspark.sql import functions as F

from tabelion.operators import checks, derive, listing


def codes(spark, values):
    return spark.createDataFrame([(v, "d") for v in values], "codigo string, descricao string")


@pytest.mark.parametrize(
    "stored,incoming,decision,insert",
    [
        ([], ["1", "2", "3", "4", "5"], "insert", True),
        (["1", "2", "3", "4", "5"], ["1", "2", "3", "4", "5"], "skip", False),
        (["1", "2", "3", "4", "6"], ["1", "2", "3", "4", "5"], "append", True),
        (["1", "2", "3", "4", "5", "9"], ["1", "2", "3", "4", "5"], "inconsistent_moderate", False),
        (["0", "1", "2", "3", "4", "5", "6", "7", "9"], ["1", "2", "3", "4", "5"], "inconsistent_severe", False),
        (["1", "2", "3"], ["1", "2", "3", "4", "5"], "append", True),
        (["1", "2", "3"], [], "skip_empty_input", False),
    ],
)
def test_code_load_decision(spark, stored, incoming, decision, insert):
    d = checks.code_load_decision({"t": (codes(spark, stored), codes(spark, incoming))}).first()
    assert (d.decision, d.will_insert) == (decision, insert)
    assert d.existing == len(stored) and d.expected == len(incoming)


def test_force_inserts_inconsistent(spark):
    d = checks.code_load_decision(
        {"t": (codes(spark, ["1", "2", "3", "4", "5", "9"]), codes(spark, ["1", "2", "3", "4", "5"]))}, force=True
    ).first()
    assert d.decision == "inconsistent_moderate" and d.will_insert and d.excess_pct == 20.0


def test_main_load_decision(spark):
    s = spark.range(5).toDF("x")
    d = checks.main_load_decision({"a": (s.limit(0), s), "b": (s, s), "c": (s.limit(3), s)})
    got = {r.table_name: r.decision for r in d.collect()}
    assert got == {"a": "insert", "b": "skip", "c": "append"}


def test_null_order_in_code_ends(spark):
    df = codes(spark, ["b", None, "a"])
    e = checks.code_ends({"t": df}).first()
    assert (e.first_code, e.last_code) == ("a", None)
    assert listing.last_code(df).first()[0] is None
    assert listing.first_code(df).first()[0] == "a"
    assert [r[0] for r in df.orderBy(F.col("codigo").desc_nulls_first()).collect()] == [None, "b", "a"]


def test_head_office_none_and_two(spark):
    est = spark.createDataFrame(
        [("1", "0001", "01", "1"), ("2", "0001", "01", "1"), ("2", "0002", "02", "1"), ("3", "0001", "01", "2")],
        "cnpj_basico string, cnpj_ordem string, cnpj_dv string, matriz_filial string",
    )
    partners = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C"), ("4", "D")], "cnpj_basico string, nome string")
    out = derive.partners_head_office(partners, derive.establishments_with_number(est))
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("1000101", "1", "A"), ("2000101", "2", "B"), ("2000202", "2", "B")]
    assert out.columns == ["cnpj", "cnpj_basico", "nome"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_plans(spark):
    from tabelion.queries import Stored

    s = Stored(spark, "/root/testdata/sf0.001")
    p = plan(s.socios())
    assert "Inner" in p and "LeftOuter" not in p
    assert "PushedFilters: [IsNotNull(o_custkey)" in p or "PushedFilters" in p
    assert "TakeOrderedAndProject" in plan(listing.latest_establishments(s.estabelecimento()))
    for q in (s.socios(), s.empresas(), checks.code_ends(s.codes())):
        p = plan(q)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_width_report_counts_over(spark):
    df = spark.createDataFrame([("abc",), ("abcd",), (None,)], "codigo string")
    r = checks.width_report({"t": (df, {"codigo": 3})}).first()
    assert (r.width, r.max_length, r.n_over) == (3, 4, 1)


def test_reconciliation(spark):
    per_file = spark.createDataFrame(
        [("a", "f1", 3, 0), ("a", "f2", 4, 1), ("b", "g1", 2, 0)], "table_name string, file_name string, n_rows long, n_rejected long"
    )
    stored = spark.createDataFrame([("a", 7, True), ("b", 1, True)], checks.COUNT_SCHEMA)
    got = {r.table_name: (r.n_files, r.expected, r.rejected, r.stored, r.difference, r.matches)
           for r in checks.reconciliation(per_file, stored).collect()}
    assert got == {"a": (2, 7, 1, 7, 0, False), "b": (1, 2, 0, 1, -1, False)}


def test_lenient_capital_rejects(spark):
    emp = spark.createDataFrame([("1", "10,5"), ("2", "1.234,56"), ("3", "")], "cnpj_basico string, capital_social_str string")
    assert derive.rejected_capital(emp).count() == 2
    vals = [r.capital_social for r in derive.companies_with_capital(emp, strict=False).orderBy("cnpj_basico").collect()]
    assert str(vals[0]) == "10.50" and vals[1] is None


def test_relationship_count_equals_join_count_with_hot_key(spark):
    left = spark.range(0, 3000).select((F.col("id") % 7).cast("string").alias("k"))
    right = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 11).cast("string")).alias("k")
    ).union(spark.createDataFrame([(None,)], "k string"))
    expected = left.join(right, "k").count()
    got = checks.relationship_count("x", left, right, "k").first()
    assert got.n_rows == expected and got.check_name == "x"
    p = plan(checks.relationship_count("x", left, right, "k"))
    assert "partial_count" in p


def test_relationship_count_sends_no_keys_through_the_driver(spark, folder):
    wide = spark.range(2000).select(F.col("id").cast("string").alias("k"), *[F.lit("").alias(f"c{i}") for i in range(29)])
    wide.write.parquet(f"{folder[0]}/wide")
    stored = spark.read.parquet(f"{folder[0]}/wide")
    assert "Broadcast" not in plan(checks.relationship_count("x", stored, stored, "k"))
    assert checks.relationship_count("x", stored, stored, "k").first().n_rows == 2000


def _model_decision(stored, incoming):
    """Plain-Python statement of the code-list decision rules."""
    existing, expected = len(stored), len(incoming)

    def ends(v):
        first = min((x for x in v if x is not None), default=None)
        last = None if any(x is None for x in v) else max(v, default=None)
        return first, last

    if existing == 0:
        return "insert"
    if expected == 0:
        return "skip_empty_input"
    same = ends(stored) == ends(incoming)
    if existing >= expected and same:
        return "skip"
    if existing > expected:
        return "inconsistent_severe" if (existing - expected) / expected * 100 > 50 else "inconsistent_moderate"
    return "append"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

codes_st = st.lists(st.one_of(st.none(), st.sampled_from(["01", "02", "03", "04", "05", "06"])), max_size=9)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(codes_st, codes_st), min_size=1, max_size=4))
def test_code_decision_matches_model(spark, cases):
    pairs = {f"t{i}": (codes(spark, s), codes(spark, inc)) for i, (s, inc) in enumerate(cases)}
    got = {r.table_name: r.decision for r in checks.code_load_decision(pairs).collect()}
    assert got == {f"t{i}": _model_decision(s, inc) for i, (s, inc) in enumerate(cases)}


def test_width_report_needs_every_declared_column(spark):
    with pytest.raises(ValueError, match="descricao"):
        checks.width_report({"t": (spark.createDataFrame([("a",)], "codigo string"), {"codigo": 3, "descricao": 9})})
