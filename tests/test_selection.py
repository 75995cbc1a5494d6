"""Tiles by selection against ``ntile`` of a plain window."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salescope.operators.segment import agent_segment
from salescope.operators.selection import ntile_by_selection
from salescope.sources.star import from_star
from tests.conftest import rows


def _frame(spark, n, distinct, partitions=3):
    rng = random.Random(n * 31 + distinct)
    data = [(f"a{i:05d}" if i else None, None if rng.random() < 0.05 else rng.randrange(distinct)) for i in range(n)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "who string, x long").repartition(partitions)


def _plain(df, n, up):
    order = [F.col("x").asc() if up else F.col("x").desc(), F.col("who").asc()]
    return rows(df.select("who", "x", F.ntile(n).over(Window.orderBy(*order)).alias("t")))


@pytest.mark.parametrize("up", [True, False])
@pytest.mark.parametrize("size,distinct,n", [(3, 5, 4), (501, 3, 4), (400, 10**6, 3)])
def test_equals_ntile_at_every_bound(spark, size, distinct, n, up):
    df = _frame(spark, size, distinct)
    want = _plain(df, n, up)
    for few, pivots in ((4096, 64), (16, 16)):
        assert rows(ntile_by_selection(df, n, ["x", "who"], [up, True], "t", few=few, pivots=pivots)) == want


def test_one_value_holds_most_rows(spark):
    """Ties over many partitions: two thirds of the rows are equal in the first column."""
    df = _frame(spark, 600, 10**6).union(spark.range(1200).select(F.format_string("z%05d", "id"), F.lit(500_000))).repartition(3)
    want = _plain(df, 4, False)
    assert rows(ntile_by_selection(df, 4, ["x", "who"], [False, True], "t", few=64, pivots=16)) == want


def test_empty_equal_rows_and_bad_orders(spark):
    df = _frame(spark, 10, 5)
    assert ntile_by_selection(df.limit(0), 4, ["x"], [True], "t").count() == 0
    same = spark.createDataFrame([(1,)] * 50, "x int")
    assert {r.t for r in ntile_by_selection(same, 4, ["x"], [False], "t", few=2, pivots=2).collect()} == {1}
    extreme = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (None,)], "x long")
    got = {r.x: r.t for r in ntile_by_selection(extreme, 4, ["x"], [False], "t").collect()}
    assert got == {2**63 - 1: 1, 0: 2, -(2**63): 3, None: 4}
    with pytest.raises(ValueError, match="no exact order"):
        ntile_by_selection(df, 4, ["who"], [False], "t")
    with pytest.raises(ValueError, match="no exact order"):
        ntile_by_selection(df.select(F.col("x").cast("double").alias("d")), 4, ["d"], [True], "t")


def test_plan_moves_no_row(spark):
    model = from_star(spark, "/root/testdata/sf0.001")
    df = agent_segment(model, outlier="Supplier#000000001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    outside = plan.split("InMemoryRelation")[0]
    assert "InMemoryRelation" in plan
    assert not any(word in outside for word in ("Window", "Sort", "Repartition", "Join", "Aggregate"))
    assert rows(df) == rows(agent_segment(model, outlier="Supplier#000000001", strategy="window"))
