"""Versioned publication: whole versions only, whatever happens during a refresh."""

import pytest
from pyspark.sql import functions as F

from tickforge.sources import versions


def test_reader_during_rewrite(spark, tmp_path):
    root = str(tmp_path / "online")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    first = versions.publish(spark.range(100).withColumn("v", F.lit(1)), root)
    reader = versions.read_version(spark, root)
    # A refresh that fails half way: its rows are never seen.
    bad = spark.range(0, 100, 1, 4).withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit(2)).cast("int"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(bad, root)
    assert versions.versions(spark, root) == [first]
    second = versions.publish(spark.range(7).withColumn("v", F.lit(2)), root)
    assert reader.count() == 100 and {r["v"] for r in reader.select("v").distinct().collect()} == {1}
    assert versions.read_version(spark, root).count() == 7
    assert versions.read_version(spark, root, first).count() == 100
    assert first < second


def test_retire_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "online")
    names = [versions.publish(spark.range(i), root) for i in range(1, 13)]
    assert versions.versions(spark, root) == names
    assert versions.retire(spark, root, keep=2) == names[:-2]
    assert versions.versions(spark, root) == names[-2:]
    assert versions.read_version(spark, root).count() == 12
    assert versions.retire(spark, root, keep=2) == []
    with pytest.raises(ValueError):
        versions.retire(spark, root, keep=0)
    with pytest.raises(Exception):
        versions.read_version(spark, root, names[0]).count()
