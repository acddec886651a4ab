from tessera.operators import vocabulary as VO


def test_bounded_ordered_and_unseen_values_are_flagged(spark, tmp_path):
    train = spark.createDataFrame([("A ",), ("a",), ("b",), ("c",), ("B",), ("d",), (None,), ("",)], "x string").withColumn("y", VO.F.lit("k"))
    found = VO.fit_vocabulary(train, ["x", "y"], most=3)
    assert [(r.column_name, r.position, r.value, r.rows) for r in found.orderBy("column_name", "position").collect()] == [
        ("x", 1, "a", 2), ("x", 2, "b", 2), ("x", 3, "", 1), ("y", 1, "k", 8)]
    VO.save_vocabulary(found, str(tmp_path))
    vocabulary = VO.load_vocabulary(spark, str(tmp_path))
    later = spark.createDataFrame([("b", "k"), ("z", None), (None, "K"), ("", "other")], "x string, y string")
    got = [tuple(r) for r in later.select(*VO.encoded(vocabulary)).collect()]
    assert got == [(0, 1, 0, 0, 1, 0), (0, 0, 0, 1, 0, 0), (0, 0, 0, 0, 1, 0), (0, 0, 1, 0, 0, 1)]
    assert VO.fit_vocabulary(train.limit(0), ["x"]).count() == 0
