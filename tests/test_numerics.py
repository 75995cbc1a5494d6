"""Numeric helpers against exact decimal arithmetic, in bulk: the Spark
Column helpers and the DuckDB formulas of the oracle."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
from pyspark.sql import functions as F

import pytest

from salescope.operators.segment import account_segment
from salescope import oracle
from salescope.functions.kpi import int_div, pct, ratio
from salescope.operators.report import growth_pct


def _pairs(n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        b = rnd.choice([rnd.randrange(1, 100), rnd.randrange(1, 10**6), rnd.randrange(1, 10**12)])
        a = rnd.randrange(0, b * rnd.choice([1, 2, 50]) + 1)
        out.append((a, b))
    # exact halves at the second decimal: 100 * a / b = x.xx5
    out += [(2469, 20000), (1, 8), (3, 8), (5, 400), (12345, 1000000), (1, 200), (0, 7)]
    return out


def _round(x: Decimal, places: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def test_spark_helpers_match_exact_decimals(spark):
    pairs = _pairs()
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select(
        "a",
        "b",
        pct(F.col("a"), F.col("b")).alias("p"),
        ratio(F.col("a"), F.col("b")).alias("r"),
        int_div(F.col("a"), F.col("b")).alias("q"),
        growth_pct(F.col("a"), F.col("b")).alias("g"),
    ).collect()
    for row in got:
        a, b = Decimal(row.a), Decimal(row.b)
        assert row.p == _round(100 * a / b, 2), (row.a, row.b)
        assert row.r == _round(a / b, 2), (row.a, row.b)
        assert row.q == row.a // row.b
        assert row.g == _round((a - b) * 100 / b, 6), (row.a, row.b)


def test_oracle_formulas_match_exact_decimals():
    pairs = _pairs(seed=11)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a BIGINT, b BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    rows = con.execute(
        f"SELECT a, b, {oracle.pct('a', 'b')}, {oracle.ratio('a', 'b')}, {oracle.growth('a', 'b')} FROM t"
    ).fetchall()
    for a, b, p, r, g in rows:
        da, db = Decimal(a), Decimal(b)
        assert p == _round(100 * da / db, 2), (a, b)
        assert r == _round(da / db, 2), (a, b)
        assert g == _round((da - db) * 100 / db, 6), (a, b)


def test_tsql_avg_truncates_and_skips_nulls(spark):
    from salescope.functions.kpi import tsql_avg

    df = spark.createDataFrame([(1, 7), (1, 8), (1, None), (2, -7), (2, -8), (3, None)], "g int, v long")
    got = {r.g: r.a for r in df.groupBy("g").agg(tsql_avg("v").alias("a")).collect()}
    assert got == {1: 7, 2: -7, 3: None}  # 15/2 -> 7, -15/2 -> -7 (toward zero), no values -> NULL


def test_k_of_account_segment_is_exact(crm):
    for k in (0.0003, "1/3", 2):
        assert account_segment(crm, "Homeland", k=k).count() > 0
    # every account off the average lies outside tiny bounds, which 0 would not tell from none
    tiny = {r[0]: r[3] for r in account_segment(crm, "Homeland", k=0.0003).collect()}
    plain = {r[0]: r[3] for r in account_segment(crm, "Homeland", k=0).collect()}
    assert tiny.keys() == plain.keys()
    assert account_segment(crm, "Homeland", k=0.123456789).count() == len(plain)
    for bad in (-1, float("nan")):
        with pytest.raises(ValueError):
            account_segment(crm, "Homeland", k=bad)
