from pyspark.sql import Window
from pyspark.sql import functions as F

from tabelion.operators.numbering import row_number_within


def test_matches_window_with_one_hot_key(spark):
    # a third of the rows under one key, the rest spread over many keys
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("k"),
        (F.col("id") * 7919 % 30011).alias("o"),
    )
    ours = row_number_within(df, "k", "o", n_parts=16)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert ours.count() == 30000
    assert ours.select("k", "o", "rn").exceptAll(ref.select("k", "o", "rn")).count() == 0
    n_hot = df.filter(F.col("k") == 7).count()
    hot = ours.filter(F.col("k") == 7).agg(F.min("rn"), F.max("rn"), F.count("*")).first()
    assert n_hot >= 10000 and tuple(hot) == (1, n_hot, n_hot)


def test_rows_of_usual_keys_are_shuffled_once(spark):
    df = spark.range(0, 3000).select((F.col("id") % 97).alias("k"), (F.col("id") * 7919 % 3001).alias("o"))
    plan = row_number_within(df, "k", "o")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_only_large_keys_are_numbered_in_slices(spark, monkeypatch):
    from tabelion.operators import numbering

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 != 1, F.col("id") % 97).alias("k"),
        (F.col("id") * 7919 % 3001).alias("o"),
    )
    ref = df.where("k is not null").withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("long"))
    sliced, whole = [], numbering.number_in_slices
    monkeypatch.setattr(numbering, "TASK_ROWS", 500)
    monkeypatch.setattr(numbering, "number_in_slices", lambda d, *a: sliced.append(d) or whole(d, *a))
    ours = row_number_within(df, "k", "o", n_parts=16)
    assert [r.k for r in sliced[0].select("k").distinct().collect()] == [7]
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0 and ours.schema["rn"].dataType == ref.schema["rn"].dataType
