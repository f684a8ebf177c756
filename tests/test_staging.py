"""Tables that are staged part by part, and the driver's memory between them."""

from pyspark.sql import functions as F

from rosterlens.sources import staging


def _full_collections(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName())


def test_parts_become_one_table(spark):
    few = spark.createDataFrame([(1, "a", None), (1, "a", None)], "n int, `s.t` string, x double")
    other = spark.createDataFrame([("b", 2.5, 2**40)], "`s.t` string, x double, n long")
    got = staging.stage_union([few, few.limit(0), other])
    assert got.dtypes == [("n", "bigint"), ("s.t", "string"), ("x", "double")]
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "a", None), (1, "a", None), (2**40, "b", 2.5)]
    assert staging.stage_union([few.limit(0), few.limit(0)]).count() == 0


def test_a_heap_in_use_is_collected_after_a_staged_table(spark, monkeypatch):
    monkeypatch.setattr(staging, "HEAP_SHARE", 0.0, raising=False)
    before = _full_collections(spark)
    assert staging.stage(spark.range(10).withColumn("x", F.lit("a"))).count() == 10
    assert _full_collections(spark) > before


def test_what_the_jvm_freed_outside_its_heap_is_given_back(spark, monkeypatch):
    assert staging._trim(spark)  # the command is there and ran
    trimmed = []
    monkeypatch.setattr(staging, "_trim", trimmed.append)
    monkeypatch.setattr(staging, "HEAP_SHARE", 1.0)
    staging.stage(spark.range(10))
    assert not trimmed
    monkeypatch.setattr(staging, "HEAP_SHARE", 0.0)
    staging.stage(spark.range(10))
    assert trimmed == [spark]
