"""The distributed global window equals the single-partition window."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salescope.functions.kpi import int_div, n2_percent, pct
from salescope.operators.global_window import (
    global_ntile,
    global_rank,
    global_row_number,
    row_number_within,
    running_within,
)
from tests.conftest import rows


def _data(spark, n, distinct, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.randrange(distinct) if rnd.random() > 0.05 else None, f"g{rnd.randrange(3)}") for i in range(n)]
    # a hot value held by a third of the rows
    data += [(n + i, 7, "g0") for i in range(n // 3)]
    return spark.createDataFrame(data, "id long, v long, g string")


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_rank_ntile_row_number_match_plain_window(spark, partitions):
    df = _data(spark, 600, 40, partitions)
    order = [F.col("v").desc(), F.col("id").asc()]
    plain = df.select(
        "id",
        F.rank().over(Window.orderBy(F.col("v").desc())).alias("rank"),
        F.row_number().over(Window.orderBy(*order)).alias("row_number"),
        F.ntile(4).over(Window.orderBy(*order)).alias("t4"),
        F.ntile(7).over(Window.orderBy(*order)).alias("t7"),
        F.row_number().over(Window.partitionBy("g").orderBy("id")).alias("rn_g"),
    )
    dist = (
        global_rank(df, ["v"], [False], "rank", partitions=partitions)
        .join(global_row_number(df, order, "row_number", partitions=partitions).select("id", "row_number"), "id")
        .join(global_ntile(df, 4, order, "t4", partitions=partitions).select("id", "t4"), "id")
        .join(global_ntile(df, 7, order, "t7", partitions=partitions).select("id", "t7"), "id")
        .join(row_number_within(df, ["g"], [F.col("id").asc()], "rn_g", partitions=partitions).select("id", "rn_g"), "id")
        .select("id", "rank", "row_number", "t4", "t7", "rn_g")
    )
    assert rows(dist) == rows(plain)


def test_ntile_more_tiles_than_rows(spark):
    df = spark.range(3).withColumnRenamed("id", "x")
    got = rows(global_ntile(df, 5, [F.col("x").asc()], "t"))
    assert got == [(0, 1), (1, 2), (2, 3)]


def test_kpi_helpers_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2469, 20000, 7, 2), (1, 8, -7, 2)], "a long, b long, n long, d long")
    got = df.select(
        pct(F.col("a"), F.col("b")).alias("p"),
        pct(F.col("a"), F.lit(0)).alias("p0"),
        int_div(F.col("n"), F.col("d")).alias("q"),
        n2_percent(F.lit(12.345).cast("decimal(10,3)")).alias("s"),
        n2_percent(F.lit(1234567.891).cast("decimal(12,3)")).alias("big"),
    ).collect()
    assert (got[0].p, got[0].p0, got[0].q, got[0].s, got[0].big) == (12.35, None, 3, "12.35%", "1,234,567.89%")
    assert (got[1].p, got[1].q) == (12.5, -3)  # integer average truncates toward zero


@pytest.mark.parametrize("partitions", [1, 5, 12, 40])
def test_running_within_matches_window(spark, partitions):
    rnd = random.Random(partitions)
    data = [(i, f"g{rnd.randrange(4)}" if rnd.random() > 0.05 else None, rnd.randrange(-5, 50) if rnd.random() > 0.1 else None) for i in range(500)]
    data += [(1000 + i, "hot", rnd.randrange(10) if i % 50 else None) for i in range(300)]
    data += [(2000 + i, "allnull", None) for i in range(120)]
    df = spark.createDataFrame(data, "id long, g string, v long")
    w = Window.partitionBy("g").orderBy("id")
    plain = df.select(
        "id",
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cum"),
        F.lag("v").over(w).alias("prev"),
    )
    dist = running_within(df, ["g"], [F.col("id").asc()], sums={"cum": "v"}, lags={"prev": "v"}, partitions=partitions)
    assert rows(dist, "id", "cum", "prev") == rows(plain)


def test_sales_insights_strategies_agree(spark):
    from salescope.operators.report import sales_insights_view
    from salescope.sources.star import from_star

    model = from_star(spark, "/root/testdata/sf0.001")
    assert rows(sales_insights_view(model, strategy="distributed")) == rows(sales_insights_view(model, strategy="window"))


def test_hot_group_is_spread_over_partitions(spark):
    from salescope.operators.global_window import _PID, _range_checkpoint

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 500).cast("string"))).alias("g"),
        F.col("id"),
    )
    tagged = _range_checkpoint(df, [F.col("g").asc(), F.col("id").asc()], 12, local_index=True)
    sizes = [r["count"] for r in tagged.groupBy(_PID).count().collect()]
    assert len(sizes) == 12
    assert max(sizes) <= 2 * n / 12  # the hot third is split, not one task
    hot_parts = tagged.where("g = 'hot'").select(_PID).distinct().count()
    assert hot_parts >= 3


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "id long, g string, v long")
    order = [F.col("id").asc()]
    assert global_row_number(df, order).count() == 0
    assert global_ntile(df, 4, order).count() == 0
    assert global_rank(df, ["v"], [False]).count() == 0
    assert running_within(df, ["g"], order, sums={"c": "v"}, lags={"p": "v"}).count() == 0


def test_callers_cache_is_left_alone(spark):
    df = spark.range(100).withColumnRenamed("id", "x").cache()
    df.count()
    global_row_number(df, [F.col("x").asc()]).count()
    assert df.storageLevel.useMemory  # still cached
    fresh = spark.range(50).withColumnRenamed("id", "x")
    global_row_number(fresh, [F.col("x").asc()]).count()
    assert not fresh.storageLevel.useMemory  # our temporary cache was dropped
    df.unpersist()


def test_rank_of_a_tie_run_over_three_partitions(spark):
    rows = spark.range(400).selectExpr("id", "case when id % 4 < 3 then 50 else id end as v")
    ours = global_rank(rows, ["v"], [False], "r", partitions=8)
    assert ours.where("v = 50").count() == 300
    plain = rows.withColumn("p", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert ours.join(plain, ["id"]).where("r <> p").count() == 0
    assert ours.count() == 400
