"""Steps on all boxes shuffle them once, by frame, and never by a few classes or groups."""

from pyspark.sql import functions as F

from curatrix.operators import decode, quantiles
from curatrix.plans import catalogue


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_shuffled_by_their_class_index(spark):
    outputs = spark.range(3).select(F.col("id").alias("frame"), F.lit(64.0).alias("width"), F.lit(64.0).alias("height"), F.array(F.array(*map(F.lit, (1.0, 1.0, 5.0, 5.0, 0.5, 1.0)))).alias("rows"))
    labels = spark.createDataFrame([(0, "zero"), (1, "one")], "output_index int, class_id string")
    found = decode.decode_rows(outputs, labels, 64, 64)
    assert "SortMergeJoin" not in _plan(found) and "hashpartitioning(index" not in _plan(found)
    assert [r.class_id for r in found.collect()] == ["one"] * 3


def test_a_decoded_box_is_computed_once(spark):
    outputs = spark.range(3).select(F.col("id").alias("frame"), F.lit(64.0).alias("width"), F.lit(64.0).alias("height"), F.array(F.array(*map(F.lit, (1.0, 1.0, 5.0, 5.0, 0.5, 1.0)))).alias("rows"))
    labels = spark.createDataFrame([(0, "zero"), (1, "one")], "output_index int, class_id string")
    found = decode.decode_rows(outputs, labels, 64, 64)
    # a filter that repeats the box makes a method of over 8,000 bytes, which Java does not compile
    assert found._jdf.queryExecution().optimizedPlan().toString().count("unknown class index") == 1


def test_objects_that_are_grouped_by_image_are_shuffled_once(spark, sf_dir):
    grouped = catalogue.objects(spark, sf_dir).groupBy("image_id").agg(F.collect_list("pos"))
    assert _plan(grouped).count("Exchange hashpartitioning") == 1


def test_values_are_not_shuffled_by_group_to_a_few_ranks(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    ranks = spark.createDataFrame([(0, 1), (1, 500)], "g long, rank int")
    few = quantiles.ranked_values(rows, ["g"], "v", ranks, most_rows=20)
    assert "SortMergeJoin" not in _plan(few)
    monkeypatch.setattr(quantiles, "MAX_BROADCAST_RANGES", 1)
    many = quantiles.ranked_values(rows, ["g"], "v", ranks, most_rows=20)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()} == {(0, 1, 0.0), (1, 500, 999.0)}
