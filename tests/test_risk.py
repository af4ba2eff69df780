"""Portfolio weights and statistics against plain loops and published constants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.functions import stats
from candlewick.operators import risk


def capped(weights, limit):
    """Cap and hand on the excess, round by round."""
    w = dict(weights)
    for _ in range(200):
        over = sum(x - limit for x in w.values() if x > limit)
        if over < 1e-15:
            return w
        room = sum(x for x in w.values() if x < limit)
        w = {k: limit if x > limit else x * (1 + over / room) if x < limit else x for k, x in w.items()}
    raise AssertionError("no end")


@pytest.mark.parametrize("limit", [0.1, 0.25, 0.34, 0.5])
def test_limited_weights_match_rounds(spark, limit):
    rng = np.random.default_rng(7)
    books = {}
    for p in range(30):
        raw = rng.pareto(0.7, size=int(rng.integers(2, 40))) + 0.01
        books[p] = {f"s{i}": float(x) for i, x in enumerate(raw / raw.sum())}
    rows = ", ".join(f"({p}, '{s}', {x!r}D)" for p, b in books.items() for s, x in b.items())
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(portfolio, symbol, weight)")
    got = {}
    for r in risk.limit_weights(df, limit).collect():
        got.setdefault(r.portfolio, {})[r.symbol] = r.weight
    for p, b in books.items():
        if len(b) * limit < 1 - 1e-12:
            assert set(got[p].values()) == {None}
        else:
            want = capped(b, limit)
            assert got[p] == pytest.approx(want, abs=1e-9)
            assert sum(got[p].values()) == pytest.approx(1.0)


# Published table values: t(10) = 2.228 and chi²(5) = 11.07 at 5 %, normal 1.959964 at 2.5 % per side.
def test_distribution_functions(spark):
    assert stats.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert stats.chi2_sf(11.070498, 5) == pytest.approx(0.05, abs=1e-6)
    assert stats.normal_ppf(0.975) == pytest.approx(1.959964, abs=1e-6)
    assert stats.t_ppf(0.975, 10) == pytest.approx(2.228139, abs=1e-5)
    xs = np.linspace(-9, 9, 181)
    want = np.array([0.5 * math.erfc(-x / math.sqrt(2)) for x in xs])
    assert stats.normal_cdf_array(xs) == pytest.approx(want, rel=1e-8, abs=1e-15)
    rows = spark.range(181).select(((F.col("id") - 90) / 10.0).alias("x"))
    got = np.array([r[0] for r in rows.select(stats.normal_cdf(F.col("x")), "x").orderBy("x").collect()])
    assert got == pytest.approx(want, rel=1e-9, abs=1e-15)
