"""Stored tables leave no shuffle behind."""

import pytest
from pyspark.sql import functions as F

from benchloom.llm import folders


def test_stored_rows_leave_no_shuffle(spark, monkeypatch):
    seen = []
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(folders.CLEANUP)), write(self, *a, **b))[1])
    before = spark.conf.get(folders.CLEANUP, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = folders.stored(rows, "kept")
    assert seen == ["true"] and spark.conf.get(folders.CLEANUP, None) == before
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        folders.stored(spark.range(5).select(F.expr("1 / (id - 2)").alias("x")), "broken")
    assert spark.conf.get(folders.CLEANUP, None) == before
