from curatrix.operators import split


def test_a_lone_group_may_be_let_through(spark):
    one = spark.createDataFrame([("g", 1), ("g", 2)], "group_id string, class_id int")
    assert [tuple(r) for r in split.assign_splits(one.select("group_id"), one, "ds", least_groups=1).collect()] == [("g", "validation")]
