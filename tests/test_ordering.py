from pyspark.sql import functions as F

from ledgerloom.operators.ordering import with_ordinal


def test_ordinals_follow_the_order(spark):
    rows = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("k"), "id").repartition(7)
    got = with_ordinal(rows, [F.col("k").desc(), F.col("id")], "place", first=0, partitions=5).collect()
    assert [(r.k, r.id) for r in sorted(got, key=lambda r: r.place)] == sorted(((r.k, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert sorted(r.place for r in got) == list(range(1000))


def test_nothing_to_order(spark):
    assert with_ordinal(spark.range(0), [F.col("id")]).columns == ["id", "ordinal"]
    assert with_ordinal(spark.range(0), [F.col("id")]).count() == 0
