"""Registered queries: entry points, a sample against SQL, and the plans they get."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_points  # noqa: E402
import compare  # noqa: E402

QUERIES, TWINS = entry_points.queries(), entry_points.oracle_sql()

# One query per family; tools/compare.py runs them all.
SAMPLE = [
    "daily_ohlcv", "resample_week", "cleaning_report", "stock_screener", "portfolio_valuation", "asof_bar_for_tick", "rolling_statistics", "cross_rank",
    "describe", "tax_report", "rsi", "parabolic_sar", "rule_conditions", "clean_signals", "rule_backtest_trades", "risk_ratios", "limited_weights", "zscore_anomalies",
    "news_sentiment", "filing_deals", "book_slippage", "financial_ratios", "bond_durations", "custom_factor", "keep_last_upsert", "range_bars", "renko_bricks",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in compare.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["symbol", "date"] or "symbol" in df.columns
    assert df.count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(TWINS) <= set(QUERIES) and len(QUERIES) > 440


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, sf, duck, name):
    status, _, _, note = compare.compare(spark, duck, name, QUERIES[name], TWINS[name], sf)
    assert status == "ok", note


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["bollinger", "rolling_statistics", "rule_crossings", "news_sentiment", "book_metrics", "financial_ratios", "option_greeks", "bond_durations", "streamed_bars"])
def test_no_python_where_columns_suffice(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    assert "InPandas" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_scans_are_pruned(spark, sf):
    p = plan(QUERIES["toxic_flow"](spark, sf))
    assert "l_comment" not in p and "l_commitdate" not in p
    p = plan(QUERIES["news_search_like"](spark, sf))
    assert "n_chars" not in p


def test_filters_reach_the_scan(spark, sf):
    p = plan(QUERIES["threshold_and_dates"](spark, sf))
    assert "PushedFilters: [" in p and "PushedFilters: []" not in p


def test_row_work_does_not_shuffle(spark, sf):
    from candlewick import fixtures as fx
    from candlewick.operators import microstructure

    args = "l_quantity", "l_extendedprice", "l_discount"
    from pyspark.sql import functions as F

    df = fx.table(spark, sf, "lineitem").withColumns(microstructure.impact(*[F.col(a) for a in args]))
    assert "Exchange" not in plan(df)


def test_one_exchange_serves_many_indicators(spark, sf):
    from candlewick import fixtures as fx
    from candlewick.operators import indicators

    bars = fx.hourly(spark, sf)
    one = plan(indicators.compute(bars, ["bollinger"])).count("Exchange")
    many = plan(indicators.compute(bars, ["bollinger", "stochastic", "cci", "momentum", "roc"])).count("Exchange")
    assert many == one  # exponential averages add one per level of smoothing


def test_no_plan_is_a_cross_product_of_tables(spark, sf):
    for name in ("correlation_pairs", "lead_follow_pairs", "within_radius", "screen_comparables", "alpha_rate_volatility"):
        assert "CartesianProduct" not in plan(QUERIES[name](spark, sf)), name
