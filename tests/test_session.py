import os

import pytest
from pyspark.sql import functions as F

from panelkit.operators.aggregate import times_total
from panelkit.operators.complete import complete_grid, complete_within
from panelkit.session import checkpoint_folder, durable, with_folder
from tools.plans import plan_of


def test_durable_writes_to_the_named_folder(spark, frame):
    folder = checkpoint_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder == named.rstrip("/")
    kept = durable(frame("region string, `a, b` int", [("A", 1), (None, None)]))
    assert {tuple(r) for r in kept.collect()} == {("A", 1), (None, None)}
    assert os.path.isdir(f"{folder}/panelkit/{spark.sparkContext.applicationId}")
    plan = plan_of(kept)
    assert "FileScan parquet" in plan


class Unset:
    """A session without a checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_no_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_folder(with_folder(Unset))


def test_long_axes_have_no_limit(spark):
    long = spark.range(200_000).select(F.col("id").cast("int").alias("period"))
    keyed = long.withColumns({"region": F.lit("A"), "value": F.lit(1.0)})
    other = spark.createDataFrame([("B", 5, 2.0)], "region string, period int, value double")
    both = keyed.select("region", "period", "value").unionByName(other)
    assert complete_grid(both, ["region"]).count() == 400_000
    assert complete_grid(keyed, ["region"]).count() == 200_000
    labels = long.select(F.col("period").cast("string").alias("b"), (F.col("period") % 2).alias("a"))
    assert complete_within(labels, "a", "b").count() == 400_000


def test_totals_from_several_partitions(spark):
    totals = spark.range(2000, 2026, 1, 4).select(F.col("id").cast("int").alias("period"), F.lit(2.0).alias("value"))
    shares = totals.withColumn("value", F.lit(0.5))
    assert {r.value for r in times_total(shares, totals).collect()} == {1.0}


def test_totals_per_period(spark, frame):
    totals = frame("period int, value double", [(1, 10.0), (1, 20.0), (2, 5.0)])
    sums = totals.groupBy("period").agg(F.sum("value").alias("value"))
    shares = spark.range(0, 1000, 1, 4).select(
        (F.col("id") % 4).cast("int").alias("period"), F.lit(0.5).alias("value")
    )
    out = times_total(shares, sums)
    got = {r.period: r.value for r in out.distinct().collect()}
    assert got == {0: None, 1: 15.0, 2: 2.5, 3: None}
