import random

from panelkit.operators.ranks import ranked
from pyspark.sql import functions as F


def test_numbers_follow_the_order(spark, frame):
    rng = random.Random(1)
    values = rng.sample(range(10_000), 3_000)
    df = frame("v int", [(v,) for v in values]).repartition(7)
    got = {r.v: r.rank for r in ranked(df, ["v"]).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values), 1)}


def test_numbers_within_groups(spark, frame):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "a", "b", None]), v) for v in rng.sample(range(10_000), 2_000)]
    got = {(r.g, r.v): r.place for r in ranked(frame("g string, v int", rows), [F.col("v").desc()], ["g"], "place").collect()}
    for g in ("a", "b", None):
        own = sorted((v for h, v in rows if h == g), reverse=True)
        assert [got[g, v] for v in own] == list(range(1, len(own) + 1))


def test_empty(frame):
    assert ranked(frame("v int", []), ["v"]).collect() == []


def test_no_task_sees_all_rows(spark):
    df = ranked(spark.range(10_000), ["id"])
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
