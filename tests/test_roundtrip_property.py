"""Property: any rows of Latin-1 text without line breaks survive write -> read."""

import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabelion.schemas import MISSING_TOKENS
from tabelion.session import scratch_path
from tabelion.sources import extracts, registry

latin1 = st.text(
    alphabet=st.characters(min_codepoint=32, max_codepoint=255, blacklist_characters="\x7f\x85"),
    max_size=12,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(latin1, latin1), min_size=1, max_size=25))
def test_code_list_round_trip(spark, rows):
    root = scratch_path(spark, "prop", uuid.uuid4().hex)
    df = spark.createDataFrame(rows, "codigo string, descricao string")
    lines = df.select(
        F.lit("F.K.D30610.CNAECSV").alias("_file"), F.col("codigo").alias("_key"),
        extracts.registry_line("cnae").alias("line"),
    )
    extracts.write_lines(lines, root)
    back = sorted((tuple(r) for r in registry.read_table(spark, root, "cnae").collect()), key=repr)

    def expect(v):
        return None if v in MISSING_TOKENS else v

    assert back == sorted(((expect(a), expect(b)) for a, b in rows), key=repr)
