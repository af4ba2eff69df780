"""Work per row, tasks and shuffles of queries that grow with their tables (findings of round 3)."""

import math
import re

import pytest
from pyspark.sql import functions as F

from candlewick.operators.series import DAILY

DAYS = "date_add(DATE '2020-01-01', CAST(i AS INT))"


def plan(df):
    return df._jdf.queryExecution().toString()


def longest_frame(text):
    frames = re.findall(r"RowFrame, (-?\d+|currentrow\$?\(?\)?), (-?\d+|currentrow)", text)
    number = lambda s: int(s) if s.lstrip("-").isdigit() else 0
    return max([number(b) - number(a) for a, b in frames] or [0])


def test_momentum_takes_short_frames_and_equals_plain_sums(spark):
    from candlewick.operators import aggregates as ops

    rets = [None if i % 97 == 5 else -1.0 if i == 400 else math.sin(i * i) / 20 for i in range(700)]
    df = spark.createDataFrame([("a", i, r) for i, r in enumerate(rets)], "symbol string, i int, ret double")
    df = df.selectExpr("symbol", f"CAST({DAYS} AS TIMESTAMP) AS ts", "i", "ret")
    known = [(i, r) for i, r in enumerate(rets) if r is not None]
    logs = [None if r <= -1 else math.log1p(r) for _, r in known]
    for lookback, skip in ((252, 21), (50, 8)):
        out = ops.momentum_panel(df, DAILY.by(rows=100), lookback=lookback, skip=skip)
        assert longest_frame(plan(out)) < 2 * skip
        want = {}
        for k, (i, _) in enumerate(known):
            ahead = [x for x in logs[k + 1 : k + 1 + skip] if x is not None]
            if k + 1 >= lookback and len(ahead) == skip:
                past = [x for x in logs[k - lookback + 1 : k - skip + 1] if x is not None]
                want[i] = (math.exp(sum(past)) - 1, math.exp(sum(ahead)) - 1)
        got = {r.i: (r.momentum, r.future_return) for r in out.collect()}
        assert set(got) == set(want) and want
        for i, pair in want.items():
            assert got[i] == pytest.approx(pair, rel=1e-9, abs=1e-9)


def test_momentum_queries_compute_their_panel_once_from_closes(spark, sf):
    from candlewick.plans import load_all
    from candlewick.plans.registry import QUERIES

    load_all()
    for name in ("momentum_deciles", "winner_minus_loser"):
        text = plan(QUERIES[name](spark, sf)).split("== Optimized Logical Plan ==")[1]
        assert "min_by" not in text and "CollectMetrics" in text, name


def test_filings_are_searched_only_where_required_words_stand(spark):
    from candlewick.functions import vocabulary as voc
    from candlewick.operators import news

    assert news.required_words(voc.PREMIUM_1WEEK[1]) == ["premium", "day"]
    assert news.required_words(voc.SYNERGIES[0]) == ["synergie", "of"]
    assert news.required_words("a{2,3}bc|de") == []
    texts = [
        "A 12.5% PREMIUM over the previous WEEK, all cash; consideration of $ 1,250 in full", "Premium of approximately 250%, represents a 30% premium", "cost saving of $7 million in shares",
        "for $3.5 billion; Synergy of $4 billion, synergies of $9 Billion", "40.25% premium to the closing share price", "mixed consideration of $12 mm", "", "nothing", "$5 bn", None,
    ]
    df = spark.createDataFrame([(i, t, "8-K") for i, t in enumerate(texts)], "id int, text string, form string").withColumn("filed", F.lit("2020-01-02").cast("date"))
    got = {r.id: r for r in news.deal_fields(df, "text", "form", "filed").collect()}
    assert "_low" not in got[0]

    def first(text, patterns):
        for p in patterns:
            m = re.search("(?i)" + p, text or "")
            if m and 0 < float(m[1]) < 200:
                return float(m[1])

    for i, t in enumerate(texts):
        assert got[i].premium_1day == first(t, voc.PREMIUM_1DAY) and got[i].premium_1week == first(t, voc.PREMIUM_1WEEK) and got[i].premium_4week == first(t, voc.PREMIUM_4WEEK)
    assert [got[i].deal_value for i in range(10)] == [1250e6, None, 7e6, 3.5e9, None, 12e9, None, None, 5e9, None]
    assert [got[i].synergies for i in range(10)] == [None, None, 7e6, 9e9] + [None] * 6
    assert [got[i].payment for i in range(10)] == ["Cash", "Cash", "Stock", "Cash", "Cash", "Mixed", "Cash", "Cash", "Cash", "Cash"]


def test_minute_bars_of_one_file_are_drawn_in_many_tasks(spark):
    from candlewick.sources import synthetic

    assets = spark.createDataFrame([("a", 50.0), ("b", 60.0)], "symbol string, base_price double").coalesce(1)
    bars = synthetic.minute_bars(assets, "2024-03-01", "2024-03-05")
    assert "REPARTITION_BY_NUM" in plan(bars)
    assert bars.count() == 2 * 3 * 391


def test_rank_correlation_computes_its_panel_once(spark):
    from candlewick.operators import factors

    rows = [(d, f"s{k}", float((k * 7 + d) % 11), float((k * 5 + d) % 13)) for d in range(3) for k in range(40)]
    panel = spark.createDataFrame(rows, "ts int, symbol string, factor double, fwd double")
    out = factors.information_coefficients(panel, "factor", "fwd", method="spearman")
    assert "CollectMetrics" in plan(out)

    def ranks(v):
        return [sum(y < x for y in v) + (sum(y == x for y in v) + 1) / 2 for x in v]

    for r in out.collect():
        x, y = ranks([a[2] for a in rows if a[0] == r.ts]), ranks([a[3] for a in rows if a[0] == r.ts])
        mx, my = sum(x) / 40, sum(y) / 40
        cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
        assert r.ic == pytest.approx(cov / math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))) and r.names == 40


def test_term_weights_shuffle_token_lists_not_terms_by_document(spark):
    from candlewick.operators import news

    rows = [(1, ["x", "y", "x"]), (1, ["z", "z", "x"]), (None, ["y"]), (2, None), (3, [])]
    out = news.tf_idf(spark.createDataFrame(rows, "id int, tokens array<string>"), "id", "tokens")
    assert not re.search(r"hashpartitioning\(id#\d+, _len#\d+, term", plan(out))
    assert {(r.id, r.term, r.n, round(r.tf, 6), r.df) for r in out.collect()} == {(1, "x", 3, 1.0, 1), (1, "y", 1, 0.333333, 2), (1, "z", 2, 0.666667, 1), (None, "y", 1, 1.0, 2)}


def test_one_band_of_companies_is_joined_in_pieces(spark):
    from candlewick.operators import quality

    rows = [(i if i % 50 else None, "S" if i % 7 else None, 100.0 + i % 30, 10.0, 1.0 - i % 3) for i in range(200)]
    c = spark.createDataFrame(rows, "symbol int, sector string, market_cap double, book_value double, net_income double")
    out = quality.screen_comparables(c, c, 1.2, 0.01)
    assert out.columns == ["sector", "symbol", "market_cap", "book_value", "net_income", "roe", "target"]
    assert "_i#" in plan(out)
    want = [(p[0], t[0]) for p in rows for t in rows if p[1] and p[1] == t[1] and max(p[2], t[2]) / min(p[2], t[2]) <= 1.2 and p[4] / p[3] >= 0.01]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or 0)
    assert sorted([(r.symbol, r.target) for r in out.collect()], key=key) == sorted(want, key=key)


def test_offer_history_takes_short_frames_and_equals_plain_windows(spark):
    from candlewick.operators import valuation

    n = 400
    bars = [(i, 100 + 20 * math.sin(i * i), None if i in (30, 33) else 90 + 10 * math.sin(i), None if i == 200 else 80 + 9 * math.cos(i), i % 5) for i in range(n)]
    df = spark.createDataFrame(bars, "i int, high double, close double, low double, volume long").selectExpr("'a' AS symbol", f"CAST({DAYS} AS TIMESTAMP) AS ts", "*").drop("i")
    offers = spark.range(1, n, 3).selectExpr("'a' AS symbol", "CAST(date_add(DATE '2020-01-01', CAST(id AS INT)) AS TIMESTAMP) AS ts", "100.0D AS offer_price", "CAST(id AS INT) AS i")
    out = valuation.offer_premiums(offers, df, DAILY.by(rows=60))
    assert longest_frame(plan(out)) < 30
    for r in out.collect():
        past = bars[max(0, r.i - 252) : r.i]
        close = [b[2] for b in past]
        best = close[-1]
        for k in (5, 20, 60):
            if len(close) >= k and None not in close[-k:]:
                best = sum(close[-k:]) / k
            assert r[f"avg_{k}"] == (None if best is None else pytest.approx(best))
        volume = sum(b[4] for b in past[-30:])
        paid = [b[2] * b[4] for b in past[-30:] if b[2] is not None]
        assert r.vwap_30 == (pytest.approx(sum(paid) / volume) if volume and paid else None)
        assert r.high_52w == max(b[1] for b in past) and r.low_52w == min(b[3] for b in past if b[3] is not None)


def test_extended_statistics_reads_closes_and_numbers_rows_once(spark, sf):
    from candlewick.plans import load_all
    from candlewick.plans.registry import QUERIES

    load_all()
    text = plan(QUERIES["extended_statistics"](spark, sf)).split("== Optimized Logical Plan ==")[1]
    assert "min_by" not in text
