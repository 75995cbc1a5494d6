"""The bounds of account segments beyond 38 digits, against bisection."""

import random
from decimal import Decimal
from fractions import Fraction

import pytest

from salescope.operators.segment import _least_distance, account_segment
from salescope.plans.model import CrmModel
from tests.conftest import rows


def _least(n, s1, s2, k):
    """By the definition, with Python's integers."""
    lo, hi = 0, 2**120
    right = k.numerator**2 * n * (n * s2 - s1 * s1)
    while lo < hi:
        at = (lo + hi) // 2
        lo, hi = (lo, at) if k.denominator**2 * at * at * (n - 1) >= right else (at + 1, hi)
    return lo


@pytest.mark.parametrize("k", ["1", "0", "0.0003", "1/3", "12345678901/1000003"])
def test_bounds_of_regions_of_ten_billion_accounts(spark, k):
    rnd = random.Random(5)
    stats = [(2, 2, 2), (5, 10, 30), (10**10, 10**13, 10**26), (10**12, 3 * 10**12, 10**25)]
    for _ in range(6):
        n = rnd.randrange(2, 10**11)
        mean = rnd.randrange(1, 1000)
        stats.append((n, n * mean, n * mean * mean + rnd.randrange(10**24)))
    df = spark.createDataFrame([tuple(map(Decimal, s)) for s in stats], "n decimal(38,0), s1 decimal(38,0), s2 decimal(38,0)")
    got = df.select("n", "s1", "s2", _least_distance(Fraction(k)).alias("least")).collect()
    for r in got:
        assert int(r.least) == _least(int(r.n), int(r.s1), int(r.s2), Fraction(k)), r


def test_accounts_with_counts_beyond_the_root_of_a_long(spark):
    """Squares of won deals pass 63 bits; the region's product passes 38 digits."""
    won = [("a", 10**13), ("b", 10**13 + 1), ("c", 3), ("d", 9 * 10**12), ("e", 10**13)]

    class Counted(CrmModel):
        def measures(self, by, which=(), stages=None, derived=None):
            return spark.createDataFrame([(a, "Far", w) for a, w in won], "account string, office_location string, deals long")

    got = {a: s for a, _, _, s in rows(account_segment(Counted(lambda s: None, ()), home="Home", other_label="Away"))}
    n, total = len(won), sum(w for _, w in won)
    spread = n * (n * sum(w * w for _, w in won) - total * total)
    for a, w in won:
        far = (n * w - total) ** 2 * (n - 1) >= spread
        assert got[a] == ("Away Regular" if not far else "Away VIP" if n * w > total else "Away Emerging")
