"""Fits, tests and folds against independent arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import panel, risk
from candlewick.plans import panel as queries


def irls(x, y, family, rounds=60):
    """Iteratively reweighted least squares of a canonical GLM."""
    b = np.zeros(x.shape[1])
    if family == "poisson":
        b[0] = np.log(y.mean())
    for _ in range(rounds):
        eta = x @ b
        mu = 1 / (1 + np.exp(-eta)) if family == "binomial" else np.exp(eta)
        w = mu * (1 - mu) if family == "binomial" else mu
        b = np.linalg.solve((x * w[:, None]).T @ x, (x * w[:, None]).T @ (eta + (y - mu) / w))
    return b


@pytest.mark.parametrize("family,target,xs", [
    ("binomial", "late", ["l_quantity", "l_discount", "l_tax"]), ("poisson", "l_quantity", ["l_discount", "l_tax"]),
])
def test_glm(spark, sf, family, target, xs):
    l = fx.table(spark, sf, "lineitem").withColumn("late", (F.col("l_returnflag") == "R").cast("double"))
    got = {r.term: r.coef for r in panel.glm(l, target, xs, family).collect()}
    d = l.select(target, *xs).toPandas().astype(float)
    want = irls(np.column_stack([np.ones(len(d)), d[xs]]), d[target].to_numpy(), family)
    assert [got["const"], *[got[x] for x in xs]] == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_t_test_p_values(spark, sf):
    rows = queries.panel(spark, sf)
    for r in panel.t_test(rows, 20.0).collect():
        x = np.array([v.value for v in rows.filter(F.col("entity_id") == r.entity_id).select("value").collect() if v.value is not None], float)
        t = (x.mean() - 20) / (x.std(ddof=1) / np.sqrt(len(x)))
        grid = np.linspace(abs(t), abs(t) + 400, 2_000_001)
        k = len(x) - 1
        area = np.trapezoid((1 + grid**2 / k) ** (-(k + 1) / 2), grid) / np.trapezoid((1 + np.linspace(0, 400, 2_000_001) ** 2 / k) ** (-(k + 1) / 2), dx=400 / 2_000_000)
        assert (r.t, r.n) == (pytest.approx(t), len(x))
        assert r.p_value == pytest.approx(area, rel=1e-4, abs=1e-9)


def test_holt_forecast(spark, sf):
    rows = queries.panel(spark, sf)
    got = {}
    for r in panel.forecast_holt(rows, 3).collect():
        got.setdefault(r.entity_id, []).append(r.value)
    for e, values in got.items():
        x = [v.value for v in rows.filter((F.col("entity_id") == e) & F.col("value").isNotNull()).orderBy("time").collect()]
        level, trend = x[1], x[1] - x[0]
        for v in x[2:]:
            new = 0.3 * v + 0.7 * (level + trend)
            level, trend = new, 0.1 * (new - level) + 0.9 * trend
        assert sorted(values) == pytest.approx(sorted(level + h * trend for h in (1, 2, 3)))


def test_topk_does_not_depend_on_the_buckets(spark, sf):
    m = fx.daily(spark, sf).groupBy("symbol", F.date_trunc("month", "ts").alias("ts")).agg(F.sum("volume").cast("double").alias("score"))
    rows = lambda span: sorted(map(tuple, risk.topk_dropout(m, 3, 1, span=span).collect()))
    whole = rows(86400 * 36600)
    assert whole == rows(86400 * 366) and len(whole) > 100
    held, days = set(), {}
    for ts, s, a in whole:
        days.setdefault(ts, []).append((s, a))
    for ts in sorted(days):
        assert {s for s, a in days[ts] if a in ("sell", "hold")} <= held
        held = (held - {s for s, a in days[ts] if a == "sell"}) | {s for s, a in days[ts] if a == "buy"}
        assert len(held) <= 3


def test_optimal_weights(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(6, 6))
    c = a @ a.T / 6 + np.eye(6) * 0.3
    names = [f"s{i}" for i in range(6)]
    cov = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{p}', '{q}', {float(c[i, j])!r}D)" for i, p in enumerate(names) for j, q in enumerate(names)) + " AS t(a, b, cov)")
    means = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{p}', {0.05 + 0.02 * i}D)" for i, p in enumerate(names)) + " AS t(symbol, mean)")
    members = means.select(F.lit("p").alias("portfolio"), "symbol")
    got = {}
    for r in risk.optimal_weights(members, cov, means).collect():
        got.setdefault(r.method, np.zeros(6))[names.index(r.symbol)] = r.weight
    for w in got.values():
        assert w.sum() == pytest.approx(1) and (w >= -1e-9).all()
    var = lambda w: w @ c @ w
    tries = rng.dirichlet(np.ones(6), size=20000)
    assert var(got["min_variance"]) <= min(map(var, tries)) + 1e-9
    mu = 0.05 + 0.02 * np.arange(6) - 0.04
    assert (got["max_sharpe"] @ mu) / np.sqrt(var(got["max_sharpe"])) >= max((t @ mu) / np.sqrt(var(t)) for t in tries) - 1e-6
    share = got["equal_risk"] * (c @ got["equal_risk"])
    assert share == pytest.approx(np.full(6, share.mean()), rel=1e-4)


def test_drifting_basket(spark):
    rets = {("a", 1): 0.1, ("b", 1): -0.1, ("a", 2): 0.2, ("b", 2): 0.0}
    df = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{s}', timestamp_seconds({d * 86400}), {x}D)" for (s, d), x in rets.items()) + " AS t(symbol, ts, ret)")
    w = spark.sql("SELECT * FROM VALUES ('a', 0.5D), ('b', 0.5D) AS t(symbol, weight)")
    from candlewick.operators import backtest

    value = [r.basket_value for r in backtest.basket(df, w, rebalance="none").orderBy("ts").collect()]
    assert value == pytest.approx([(50 * 1.1 * 1.2 + 50 * 0.9)])  # holdings are bought at the first row
    value = [r.basket_value for r in backtest.basket(df, w).orderBy("ts").collect()]
    assert value == pytest.approx([100.0, 110.0])


def test_principal_components(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    cov, corr = np.cov(x.T), np.corrcoef(x.T)
    pairs = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('s{i}', 's{j}', {float(cov[i, j])!r}D, {float(corr[i, j])!r}D)" for i in range(5) for j in range(i, 5)
    ) + " AS t(a, b, cov, corr)")
    got = panel.principal_components(pairs, 3).collect()
    values = {r.component: r.eigenvalue for r in got}
    assert sorted(values.values(), reverse=True) == pytest.approx(np.sort(np.linalg.eigvalsh(corr))[::-1][:3])
    for c, v in values.items():
        load = np.array([r.loading for r in sorted(got, key=lambda r: r.symbol) if r.component == c])
        assert corr @ load == pytest.approx(v * load, abs=1e-9)


def test_glm_takes_one_pass_of_sums_a_step(spark, monkeypatch):
    """Own links need no row objects; labels out of range and singular columns still go to MLlib."""
    import pandas as pd
    from pyspark.ml import regression

    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    rows = pd.DataFrame({"a": x[:, 0], "b": 50 * x[:, 1] + 7, "one": 1.0, "n": rng.poisson(np.exp(0.4 + 0.3 * x[:, 0] - 0.2 * x[:, 1])).astype(float)})
    rows["hit"] = (rng.random(400) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    df = spark.createDataFrame(rows)
    fits = {f: panel.glm(df, y, ["a", "b"], f, link).collect() for f, y, link in (("poisson", "n", "log"), ("binomial", "hit", "logit"), ("gaussian", "n", "identity"))}
    panel.glm(df, "n", ["a", "one"], "poisson").collect()  # singular

    def no_rows(*args, **kwargs):
        raise AssertionError("rows fitted one by one")

    monkeypatch.setattr(regression, "GeneralizedLinearRegression", no_rows)
    for family, y in (("poisson", "n"), ("binomial", "hit"), ("gaussian", "n")):
        got = panel.glm(df, y, ["a", "b"], family).collect()
        assert [r.term for r in got] == ["const", "a", "b"]
        for r, w in zip(got, fits[family]):
            assert r.coef == pytest.approx(w.coef, rel=1e-7, abs=1e-9) and r.deviance == pytest.approx(w.deviance, rel=1e-9)
