"""Rule, signal, label, backtest and alpha queries."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import alphas
from candlewick.operators import backtest as bt
from candlewick.operators import signals as ops
from candlewick.operators.indicators import compute
from candlewick.operators.reshape import staged_universe as pick_universe
from candlewick.operators.series import DAILY, HOURLY, over_blocks
from candlewick.plans.indicators import BASE, RSI, W, _recursive, avg, hi, lo, recursive, roll, wn
from candlewick.plans.quality import COMPANIES_SQL
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.scalars import UNI_SQL, universe
from candlewick.plans.sql import DAILY as DAILY_SQL
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import NUMBERED, RETURNS, TICKS, with_
from candlewick.plans.windows import returns

RULES = [
    {"indicator": "rsi", "params": {"period": 14}, "operator": "<", "value": 60},
    "OR",
    {"indicator": "price_close", "operator": ">", "compare_indicator": "sma", "compare_params": {"period": 20}, "offset": 1, "compare_offset": 2},
    {"indicator": "stochastic", "field": "d", "operator": "between", "value": 20, "value2": 80},
    "AND",
    {"indicator": "hl2", "operator": ">=", "value": 5},
]
CROSS = [
    {"indicator": "sma", "params": {"period": 5}, "operator": "crosses_above", "compare_indicator": "sma", "compare_params": {"period": 20}},
    {"indicator": "price_close", "operator": "crossed_below_within", "value": 20, "lookback": 3},
    {"indicator": "price_close", "operator": "rising", "lookback": 3},
    "OR",
    {"indicator": "sma", "params": {"period": 5}, "operator": "falling", "lookback": 4},
]

RULE_SQL = f"""c AS (SELECT s2.*, {avg('close', 20)} AS sma, {lo('low', 14)} AS l14, {hi('high', 14)} AS h14 FROM s2),
d AS (SELECT *, (close - l14) / nullif(h14 - l14, 0) * 100 AS k FROM c), e AS (SELECT *, {avg('k', 3)} AS dd FROM d),
f AS (SELECT *, coalesce(rsi < 60, false) AS match_0, coalesce(lag(close) OVER ({W}) > lag(sma, 2) OVER ({W}), false) AS match_1, coalesce(dd BETWEEN 20 AND 80, false) AS match_2, mid >= 5 AS match_3 FROM e)"""


@query(
    "rule_conditions",
    "G1,G3",
    with_(HOURLY_SQL, NUMBERED, BASE, RSI, RULE_SQL, "SELECT symbol, ts, match_0, match_1, match_2, match_3, match_0 AND match_1 AND match_2 AND match_3 AS match FROM f"),
)
def rule_conditions(spark, sf):
    out = ops.evaluate_groups(fx.hourly(spark, sf), {"match": RULES})
    return out.select("symbol", "ts", "match_0", "match_1", "match_2", "match_3", "match")


@query(
    "rule_crossings",
    "G2,G3",
    with_(
        HOURLY_SQL, NUMBERED,
        f"c AS (SELECT *, {avg('close', 5)} AS f, {avg('close', 20)} AS s, lag(close) OVER ({W}) AS pc FROM nb), d AS (SELECT *, lag(f) OVER ({W}) AS pf, lag(s) OVER ({W}) AS ps, (pc >= 20 AND close < 20)::INT AS x, (close > pc)::INT AS up FROM c)",
        "e AS (SELECT *, CASE WHEN rn > 1 THEN coalesce(f < pf, false)::INT END AS dn FROM d)",
        f"""f AS (SELECT *, coalesce(pf <= ps AND f > s, false) AS match_0, coalesce(max(x) OVER {wn(3)} = 1, false) AS match_1, coalesce(min(up) OVER {wn(2)} = 1, false) AS match_2, coalesce(min(dn) OVER {wn(3)} = 1, false) AS match_3 FROM e)""",
        "SELECT symbol, ts, match_0, match_1, match_2, match_3, match_0 OR match_1 OR match_2 OR match_3 AS match FROM f",
    ),
)
def rule_crossings(spark, sf):
    out = ops.evaluate_groups(fx.hourly(spark, sf), {"match": CROSS})
    return out.select("symbol", "ts", "match_0", "match_1", "match_2", "match_3", "match")


@query(
    "scan_symbols",
    "G4",
    with_(
        TICKS.replace("event_type AS symbol", "CAST(user_id AS VARCHAR) AS symbol"),
        "bars AS (SELECT symbol, time_bucket(INTERVAL 1 HOUR, ts) AS ts, arg_max(price, ts) AS close, row_number() OVER (PARTITION BY symbol ORDER BY time_bucket(INTERVAL 1 HOUR, t.ts) DESC) AS z FROM ticks t GROUP BY symbol, time_bucket(INTERVAL 1 HOUR, t.ts))",
        f"c AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS bars, {avg('close', 10)} AS m FROM bars WHERE z <= 30)",
        "SELECT symbol, ts, bars, close AS price, coalesce(close > m, false) AND bars >= 10 AS match, CASE WHEN bars < 10 THEN 'Insufficient data (' || bars || ' candles)' END AS error FROM c WHERE z = 1",
    ),
)
def scan_symbols(spark, sf):
    rules = [{"indicator": "price_close", "operator": ">", "compare_indicator": "sma", "compare_params": {"period": 10}}]
    out = ops.scan(fx.hourly(spark, sf, "user_id"), rules, newest=30)
    return out.select("symbol", "ts", "bars", "price", "match", "error")


@query(
    "bars_since",
    "G5",
    with_(HOURLY_SQL, NUMBERED, f"SELECT symbol, ts, rn - max(CASE WHEN close > 100 THEN rn END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS bars_since FROM nb"),
)
def bars_since(spark, sf):
    return ops.bars_since(fx.hourly(spark, sf), HOURLY, F.col("close") > 100).select("symbol", "ts", "bars_since")


@query(
    "signal_builders",
    "G6",
    with_(
        HOURLY_SQL, NUMBERED, BASE, RSI,
        f"c AS (SELECT *, {hi('high', 20)} AS u, {lo('low', 20)} AS d20, {avg('close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s, {avg('close', 5)} AS f FROM s2)",
        f"e AS (SELECT *, lag(u) OVER ({W}) AS pu, lag(d20) OVER ({W}) AS pd, lag(rsi) OVER ({W}) AS pr, lag(f) OVER ({W}) AS pf, lag(m) OVER ({W}) AS pm, (close - m) / nullif(s, 0) AS z FROM c)",
        """SELECT symbol, ts, coalesce(pf <= pm AND f > m, false) AS cross_entry, coalesce(pf >= pm AND f < m, false) AS cross_exit, coalesce(pr >= 30 AND rsi < 30, false) AS threshold_entry, coalesce(pr <= 70 AND rsi > 70, false) AS threshold_exit,
  coalesce(close > pu, false) AS breakout_entry, coalesce(close < pd, false) AS breakout_exit, coalesce(z < -1, false) AS reversion_entry, coalesce(z > 0.5, false) AS reversion_exit, coalesce(close > pu, false) AND coalesce(rsi > 50, false) AS filtered_entry FROM e""",
    ),
)
def signal_builders(spark, sf):
    wanted = {"dc": ("donchian", {}), "m": ("sma", {}), "s": ("std_dev", {}), "f": ("sma", {"period": 5}), "rsi": ("rsi", {})}
    rows = compute(fx.hourly(spark, sf), wanted, keep_pos=True)

    def cols(w):
        c = F.col("close")
        parts = {
            "cross": ops.crossover_signals(w, F.col("f"), F.col("m")),
            "threshold": ops.threshold_signals(w, F.col("rsi"), 30.0, 70.0),
            "breakout": ops.breakout_signals(c, F.lag("dc_upper").over(w), F.lag("dc_lower").over(w)),
            "reversion": ops.reversion_signals((c - F.col("m")) / F.nullif(F.col("s"), F.lit(0.0)), 1.0, 0.5),
        }
        out = {f"{n}_{k}": v for n, d in parts.items() for k, v in d.items()}
        out["filtered_entry"] = ops.filtered_entry(parts["breakout"]["entry"], F.col("rsi"), 50.0)
        return out

    out = over_blocks(rows, HOURLY, cols, back=1)
    return out.select("symbol", "ts", *[f"{n}_{k}" for n in ("cross", "threshold", "breakout", "reversion") for k in ("entry", "exit")], "filtered_entry")


FLAGS_SQL = "f0 AS (SELECT *, close > 60 AND volume % 3 <> 0 AS entry, close < 30 OR volume % 5 = 0 AS exit FROM nb)"


def flags(spark, sf):
    return fx.hourly(spark, sf).withColumns({"entry": (F.col("close") > 60) & (F.col("volume") % 3 != 0), "exit": (F.col("close") < 30) | (F.col("volume") % 5 == 0)})


CLEAN_SQL = _recursive(
    "entry AS inside, entry AS clean_entry, false AS clean_exit",
    "CASE WHEN p.inside THEN NOT n.exit ELSE n.entry END, NOT p.inside AND n.entry, p.inside AND n.exit", (), base="f0",
)[0]


@query("clean_signals", "G7", recursive(HOURLY_SQL, NUMBERED, FLAGS_SQL, CLEAN_SQL, "SELECT symbol, ts, clean_entry, clean_exit, inside AS in_position FROM rec"))
def clean_signals(spark, sf):
    return ops.clean_signals(flags(spark, sf), HOURLY).select("symbol", "ts", "clean_entry", "clean_exit", "in_position")


def _stops_sql():
    price = "CASE WHEN p.inside THEN p.price ELSE n.close END"
    peak = "CASE WHEN p.inside THEN greatest(p.peak, n.high) ELSE n.high END"
    live = "(p.inside OR n.entry)"
    why = f"CASE WHEN {live} THEN CASE WHEN n.low <= {price} * 0.6 THEN 'sl' WHEN n.high >= {price} * 2 THEN 'tp' WHEN n.low <= ({peak}) * 0.5 THEN 'ts' END END"
    first = "CASE WHEN entry THEN CASE WHEN low <= close * 0.6 THEN 'sl' WHEN high >= close * 2 THEN 'tp' WHEN low <= high * 0.5 THEN 'ts' END END"
    rec, _ = _recursive(
        f"{first} AS reason, entry AND {first} IS NULL AS inside, close AS price, high AS peak", f"{why}, {live} AND {why} IS NULL, {price}, {peak}", (), base="f0"
    )
    return recursive(HOURLY_SQL, NUMBERED, FLAGS_SQL, rec, "SELECT symbol, ts, reason IS NOT NULL AS stop_exit, reason FROM rec")


@query("stop_exits", "G8", _stops_sql())
def stop_exits(spark, sf):
    out = ops.stop_exits(flags(spark, sf), HOURLY, "entry", 0.4, 1.0, 0.5, intrabar=True)
    return out.select("symbol", "ts", "stop_exit", "reason")


@query(
    "stop_exits_on_close",
    "G8",
    recursive(
        HOURLY_SQL, NUMBERED, FLAGS_SQL,
        _recursive(
            "NULL::VARCHAR AS reason, entry AS inside, close AS price",
            "CASE WHEN p.inside THEN CASE WHEN n.close <= p.price * 0.6 THEN 'sl' WHEN n.close >= p.price * 1.5 THEN 'tp' END END, CASE WHEN p.inside THEN NOT (n.close <= p.price * 0.6 OR n.close >= p.price * 1.5) ELSE n.entry END, CASE WHEN p.inside THEN p.price ELSE n.close END",
            (), base="f0",
        )[0],
        "SELECT symbol, ts, reason IS NOT NULL AS stop_exit, reason FROM rec",
    ),
)
def stop_exits_on_close(spark, sf):
    return ops.stop_exits(flags(spark, sf), HOURLY, "entry", 0.4, 0.5).select("symbol", "ts", "stop_exit", "reason")


def _u(*parts):
    text = " || '|' || ".join(parts)
    return f"(('0x' || substr(md5({text}), 1, 12))::BIGINT / 281474976710656.0::DOUBLE)"


@query(
    "random_entries",
    "G9",
    with_(HOURLY_SQL, NUMBERED, f"u AS (SELECT *, {_u(repr('7'), 'symbol', 'CAST(rn AS VARCHAR)')} AS u FROM nb)", "SELECT symbol, ts, row_number() OVER (PARTITION BY symbol ORDER BY u, rn) <= 25 AS entry FROM u"),
)
def random_entries(spark, sf):
    return ops.random_entries(fx.hourly(spark, sf), HOURLY, 25, seed=7).select("symbol", "ts", "entry")


def _random_sql(cooldown):
    u = f"f0 AS (SELECT *, {_u(repr('3'), repr('in'), 'symbol', 'CAST(rn AS VARCHAR)')} < 0.2 AS entry, {_u(repr('3'), repr('out'), 'symbol', 'CAST(rn AS VARCHAR)')} < 0.1 AS exit FROM nb)"
    enter = f"NOT p.inside AND n.entry AND n.k - p.last > {cooldown}"
    rec, _ = _recursive(
        "entry AS inside, entry AS clean_entry, false AS clean_exit, -1000000 AS last",
        f"CASE WHEN p.inside THEN NOT n.exit ELSE {enter} END, {enter}, p.inside AND n.exit, CASE WHEN p.inside AND n.exit THEN n.k ELSE p.last END", (), base="f0",
    )
    return recursive(HOURLY_SQL, NUMBERED, u, rec, "SELECT symbol, ts, clean_entry, clean_exit, inside AS in_position FROM rec")


@query("random_trades", "G9", _random_sql(0))
def random_trades(spark, sf):
    return ops.random_trades(fx.hourly(spark, sf), HOURLY, 0.2, 0.1, seed=3).select("symbol", "ts", "clean_entry", "clean_exit", "in_position")


@query("random_trades_cooldown", "G9", _random_sql(5))
def random_trades_cooldown(spark, sf):
    return ops.random_trades(fx.hourly(spark, sf), HOURLY, 0.2, 0.1, cooldown=5, seed=3).select("symbol", "ts", "clean_entry", "clean_exit", "in_position")


@query(
    "labels",
    "G10",
    with_(
        HOURLY_SQL, NUMBERED,
        f"""a AS (SELECT *, lead(close, 5) OVER ({W}) / close - 1 AS fw, close / lag(close, 20) OVER ({W}) - 1 AS ch, {avg('close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s, regr_slope(close, rn) OVER {wn(20)} AS sl,
  max(close) OVER x AS mx, min(close) OVER x AS mn, count(*) OVER x AS n FROM nb WINDOW x AS ({W} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING))""",
        """SELECT symbol, ts, CAST(CASE WHEN fw > 0.1 THEN 1 WHEN fw < -0.1 THEN -1 ELSE 0 END AS INTEGER) AS fixed_label, CASE WHEN (close - m) / nullif(s, 0) < -1 THEN 1 WHEN (close - m) / nullif(s, 0) > 1 THEN -1 ELSE 0 END AS mean_label,
  CASE WHEN n = 11 AND close = mx THEN -1 WHEN n = 11 AND close = mn THEN 1 ELSE 0 END AS extremum_label, CASE WHEN m IS NOT NULL AND sl / m > 0.1 THEN 1 WHEN m IS NOT NULL AND sl / m < -0.1 THEN -1 ELSE 0 END AS trend_label,
  CASE WHEN ch > 0.1 THEN 1 WHEN ch < -0.1 THEN -1 ELSE 0 END AS change_label, CASE WHEN close > m + 2 * s THEN 2 WHEN close > m THEN 1 WHEN close < m - 2 * s THEN -2 WHEN close < m THEN -1 ELSE 0 END AS band_label FROM a""",
    ),
)
def labels(spark, sf):
    out = ops.labels(fx.hourly(spark, sf), HOURLY, 5, 0.1)
    return out.select("symbol", "ts", "fixed_label", "mean_label", "extremum_label", "trend_label", "change_label", "band_label")


@query(
    "frame_actions",
    "G11",
    with_(HOURLY_SQL, "SELECT symbol, ts, CASE WHEN close < 10 OR volume >= 150 THEN 'x' WHEN close > open AND volume > 40 THEN 'e' ELSE '' END AS action FROM bars"),
)
def frame_actions(spark, sf):
    enter, leave = [["close", ">", "open"], ["volume", ">", 40]], [["close", "<", 10], ["volume", ">=", 150]]
    return ops.actions(fx.hourly(spark, sf), enter, leave, any_exit=True).select("symbol", "ts", "action")


ENTRY = [{"indicator": "price_close", "operator": ">", "compare_indicator": "sma", "compare_params": {"period": 10}}]
EXIT = [{"indicator": "price_close", "operator": "<", "compare_indicator": "sma", "compare_params": {"period": 10}}, "AND", {"indicator": "price_volume", "operator": ">", "value": 50}]


def _backtest_sql(select):
    pre = f"f0 AS (SELECT *, coalesce(close > {avg('close', 10).replace('CASE', '(CASE').replace(' END', ' END)')}, false) AS e, coalesce(close < {avg('close', 10).replace('CASE', '(CASE').replace(' END', ' END)')}, false) AND volume > 50 AS x, count(*) OVER (PARTITION BY symbol) AS n FROM nb)"
    gain = "((n.close - p.price) / p.price * 100)"
    held = "p.shares > 0"
    why = f"CASE WHEN {held} THEN CASE WHEN {gain} <= -50 THEN 'stop_loss' WHEN {gain} >= 100 THEN 'take_profit' WHEN n.x THEN 'exit_signal' WHEN n.rn = n.n THEN 'end_of_data' END WHEN n.e AND p.cash >= n.close AND n.rn = n.n THEN 'end_of_data' END"
    can = f"(NOT {held} AND n.e AND p.cash >= n.close)"
    out = f"({why}) IS NOT NULL"
    shares = f"CASE WHEN {can} THEN floor(p.cash / n.close) ELSE p.shares END"
    price = f"CASE WHEN {can} THEN n.close ELSE p.price END"
    cash_after = f"CASE WHEN {can} THEN p.cash - floor(p.cash / n.close) * n.close ELSE p.cash END"
    since = f"CASE WHEN {can} THEN n.rn ELSE p.since END"
    step = (
        f"{cash_after} + CASE WHEN {out} THEN ({shares}) * n.close ELSE 0 END, CASE WHEN {out} THEN 0 ELSE {shares} END, {price}, {since}, {why}, ({cash_after}) + ({shares}) * n.close, {shares}, n.rn"
    )
    seed = "seed AS (SELECT DISTINCT symbol FROM f0)"
    rec = (
        "n AS (SELECT *, rn - 50 AS k FROM f0 WHERE rn > 50), rec AS (SELECT symbol, NULL::TIMESTAMP AS ts, 0::BIGINT AS k, 100000.0::DOUBLE AS cash, 0.0::DOUBLE AS shares, 0.0::DOUBLE AS price, 0::BIGINT AS since, NULL::VARCHAR AS reason, 100000.0::DOUBLE AS equity, 0.0::DOUBLE AS held, 0::BIGINT AS rn FROM seed "
        f"UNION ALL SELECT n.symbol, n.ts, n.k, {step} FROM rec p JOIN n ON n.symbol = p.symbol AND n.k = p.k + 1), bk AS (SELECT rec.*, nb.close FROM rec JOIN nb ON rec.symbol = nb.symbol AND rec.ts = nb.ts)"
    )
    return recursive(HOURLY_SQL, NUMBERED, pre, seed, rec, select)


@query(
    "rule_backtest_equity",
    "G12",
    _backtest_sql(f"SELECT symbol, ts, {r('equity', 3)} AS equity FROM bk"),
)
def rule_backtest_equity(spark, sf):
    run = bt.rule_backtest(fx.hourly(spark, sf), ENTRY, EXIT, HOURLY, 50, 100)
    return near(run, "equity", digits=3).select("symbol", "ts", "equity")


@query(
    "rule_backtest_trades",
    "G12",
    _backtest_sql(f"SELECT symbol, ts, since - 1 AS entry_bar, rn - 1 AS exit_bar, price AS entry_price, close AS exit_price, CAST(held AS BIGINT) AS shares, {r('(close - price) * held', 3)} AS pnl, {r('(close - price) / price * 100', 4)} AS pnl_pct, reason, rn - since AS bars_held FROM bk WHERE reason IS NOT NULL"),
)
def rule_backtest_trades(spark, sf):
    run = bt.rule_backtest(fx.hourly(spark, sf), ENTRY, EXIT, HOURLY, 50, 100)
    return near(near(bt.trades_of(run), "pnl", digits=3), "pnl_pct", digits=4)


@query(
    "rule_backtest_metrics",
    "G12,A16",
    _backtest_sql(
        f"""SELECT symbol, count(reason) AS total_trades, count(*) FILTER (reason IS NOT NULL AND close > price) AS winning_trades, count(*) FILTER (reason IS NOT NULL AND close <= price) AS losing_trades,
  {r('arg_max(equity, ts)', 3)} AS final_equity, {r('max(dd)', 5)} AS max_drawdown, {r('avg(x) / stddev_pop(x) * sqrt(252)', 5)} AS sharpe, {r('coalesce(sum((close - price) * held) FILTER (reason IS NOT NULL AND close > price), 0) / abs(sum((close - price) * held) FILTER (reason IS NOT NULL AND close <= price))', 5)} AS profit_factor
FROM (SELECT *, equity / lag(equity) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS x, (greatest(max(equity) OVER (PARTITION BY symbol ORDER BY ts), 100000) - equity) / greatest(max(equity) OVER (PARTITION BY symbol ORDER BY ts), 100000) * 100 AS dd FROM bk) GROUP BY symbol"""
    ),
)
def rule_backtest_metrics(spark, sf):
    run = bt.rule_backtest(fx.hourly(spark, sf), ENTRY, EXIT, HOURLY, 50, 100)
    out = bt.run_metrics(run, HOURLY)
    out = near(near(out, "final_equity", digits=3), "max_drawdown", "sharpe", "profit_factor", digits=5)
    return out.select("symbol", "total_trades", "winning_trades", "losing_trades", "final_equity", "max_drawdown", "sharpe", "profit_factor")


@query(
    "strategy_signals",
    "G13",
    with_(
        HOURLY_SQL, NUMBERED, BASE, RSI,
        f"""c AS (SELECT *, {avg('close', 10)} AS f, {avg('close', 20)} AS s, {roll('stddev_samp', 'close', 20)} AS sd, lag({hi('high', 20)}) OVER ({W}) AS u, lag({lo('low', 20)}) OVER ({W}) AS l FROM s2)""".replace(f"lag({hi('high', 20)})", "lag(hh)").replace(f"lag({lo('low', 20)})", "lag(ll)").replace("FROM s2)", f"FROM (SELECT *, {hi('high', 20)} AS hh, {lo('low', 20)} AS ll, lag(close, 20) OVER ({W}) AS c20 FROM s2))"),
        f"d AS (SELECT *, lag(f) OVER ({W}) AS pf, lag(s) OVER ({W}) AS ps, lag(rsi) OVER ({W}) AS pr FROM c)",
        """SELECT symbol, ts, 'sma_crossover' AS strategy, coalesce(pf <= ps AND f > s, false) AS entry, coalesce(pf >= ps AND f < s, false) AS exit FROM d
UNION ALL SELECT symbol, ts, 'rsi', coalesce(pr >= 30 AND rsi < 30, false), coalesce(pr <= 70 AND rsi > 70, false) FROM d
UNION ALL SELECT symbol, ts, 'bollinger', coalesce(close < s - 2 * sd, false), coalesce(close > s + 2 * sd, false) FROM d
UNION ALL SELECT symbol, ts, 'breakout', coalesce(close > u, false), coalesce(close < l, false) FROM d
UNION ALL SELECT symbol, ts, 'momentum', coalesce(close / c20 - 1 > 0, false), coalesce(close / c20 - 1 < 0, false) FROM d""",
    ),
)
def strategy_signals(spark, sf):
    out = ops.all_strategy_signals(fx.hourly(spark, sf), ["sma_crossover", "rsi", "bollinger", "breakout", "momentum"])
    return out.select("symbol", "ts", "strategy", "entry", "exit")


@query("all_strategies", "G13")
def all_strategies(spark, sf):
    out = ops.all_strategy_signals(fx.hourly(spark, sf))
    return out.groupBy("symbol", "strategy").agg(F.count_if("entry").alias("entries"), F.count_if("exit").alias("exits"))


COMBOS = [(f, s) for f in (5, 8) for s in (15, 25)]


def _sweep_ctes(part, src):
    """Crossover runs of all combinations over the series ``part`` of ``src``."""
    o = f"PARTITION BY {part} ORDER BY ts"
    roll_ = lambda n: f"CASE WHEN count(*) OVER ({o} ROWS {n - 1} PRECEDING) = {n} THEN avg(close) OVER ({o} ROWS {n - 1} PRECEDING) END"
    runs = " UNION ALL ".join(f"SELECT {part}, ts, close, {i} AS combo, {f}::DOUBLE AS fast, {s}::DOUBLE AS slow, {roll_(f)} AS f, {roll_(s)} AS s FROM {src}" for i, (f, s) in enumerate(COMBOS))
    p = f"PARTITION BY {part}, combo ORDER BY ts"
    return f"""w0 AS ({runs}), w1 AS (SELECT *, lag(f) OVER ({p}) AS pf, lag(s) OVER ({p}) AS ps, close / lag(close) OVER ({p}) - 1 AS ret FROM w0),
w2 AS (SELECT *, CASE WHEN pf <= ps AND f > s THEN 1 WHEN pf >= ps AND f < s THEN 0 END AS ev FROM w1), w3 AS (SELECT *, coalesce(last_value(ev IGNORE NULLS) OVER ({p} ROWS UNBOUNDED PRECEDING), 0) AS pos FROM w2),
w4 AS (SELECT *, coalesce(lag(pos) OVER ({p}), 0) AS held FROM w3), w5 AS (SELECT *, CASE WHEN held = 1 THEN ret ELSE 0 END AS sr, pos = 1 AND held = 0 AS opened FROM w4),
w6 AS (SELECT {part}, combo, fast, slow, exp(sum(ln(1 + sr))) - 1 AS total_return, CASE WHEN stddev_samp(sr) > 0 THEN avg(sr) / stddev_samp(sr) * sqrt(252) ELSE 0 END AS sharpe,
  CASE WHEN avg(CASE WHEN sr < 0 THEN sr * sr ELSE 0 END) > 0 THEN avg(sr) / sqrt(avg(CASE WHEN sr < 0 THEN sr * sr ELSE 0 END)) * sqrt(252) ELSE 0 END AS sortino, count(*) FILTER (pos = 1) * 100.0 / count(*) AS exposure_pct, count(*) FILTER (opened) AS trades FROM w5 GROUP BY ALL)"""


RANGES = {"fast": [5, 8], "slow": (15, 25, 10)}


@query(
    "parameter_sweep",
    "G14",
    with_(HOURLY_SQL, _sweep_ctes("symbol", "bars"), f"SELECT symbol, combo, fast, slow, {r('total_return', 5)} AS total_return, {rs('sharpe', 'sortino', 'exposure_pct')}, trades FROM w6"),
)
def parameter_sweep(spark, sf):
    out = bt.sweep(fx.hourly(spark, sf), "sma_crossover", RANGES)
    return near(near(out, "sharpe", "sortino", "exposure_pct"), "total_return", digits=5)


@query("best_parameters", "G14", with_(HOURLY_SQL, _sweep_ctes("symbol", "bars"), f"SELECT symbol, arg_max(combo, (sharpe, -combo)) AS combo, {r('max(sharpe)')} AS sharpe FROM w6 GROUP BY symbol"))
def best_parameters(spark, sf):
    return near(bt.best_of(bt.sweep(fx.hourly(spark, sf), "sma_crossover", RANGES), ["symbol"]), "sharpe").select("symbol", "combo", "sharpe")


@query("parameter_sensitivity", "G14", with_(HOURLY_SQL, _sweep_ctes("symbol", "bars"), f"SELECT symbol, {r('corr(fast, sharpe)')} AS sensitivity_fast, {r('corr(slow, sharpe)')} AS sensitivity_slow FROM w6 GROUP BY symbol"))
def parameter_sensitivity(spark, sf):
    return near(bt.sensitivity(bt.sweep(fx.hourly(spark, sf), "sma_crossover", RANGES), ["symbol"], ["fast", "slow"]), "sensitivity_fast", "sensitivity_slow")


WINDOWS_SQL = """p0 AS (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, CAST(floor(count(*) OVER (PARTITION BY symbol) / 3) AS BIGINT) AS size FROM bars),
p1 AS (SELECT symbol, ts, close, CAST(floor(i / size) AS BIGINT) AS window_no, CASE WHEN i % size < floor(size * 0.7 + 1e-9) THEN 'train' ELSE 'test' END AS part FROM p0 WHERE floor(i / size) < 3)"""
WF_SQL = """, bs AS (SELECT symbol, window_no, arg_max(combo, (sharpe, -combo)) AS combo FROM w6 WHERE part = 'train' GROUP BY ALL),
wf AS (SELECT a.symbol, a.window_no, a.combo, a.fast, a.slow, a.total_return AS train_return, a.sharpe AS train_sharpe, b.total_return AS test_return, b.sharpe AS test_sharpe FROM bs JOIN w6 a ON a.symbol = bs.symbol AND a.window_no = bs.window_no AND a.combo = bs.combo AND a.part = 'train'
  JOIN w6 b ON b.symbol = bs.symbol AND b.window_no = bs.window_no AND b.combo = bs.combo AND b.part = 'test')"""


@query(
    "walk_forward",
    "G15",
    with_(HOURLY_SQL, WINDOWS_SQL, _sweep_ctes("symbol, window_no, part", "p1") + WF_SQL, f"SELECT symbol, window_no, combo, fast, slow, {rs('train_sharpe', 'test_sharpe')}, {rs('train_return', 'test_return', digits=5)} FROM wf"),
)
def walk_forward(spark, sf):
    out = bt.walk_forward(fx.hourly(spark, sf), "sma_crossover", RANGES, splits=3)
    return near(near(out, "train_sharpe", "test_sharpe"), "train_return", "test_return", digits=5)


@query(
    "walk_forward_summary",
    "G15",
    with_(HOURLY_SQL, WINDOWS_SQL, _sweep_ctes("symbol, window_no, part", "p1") + WF_SQL, f"SELECT symbol, count(*) AS windows, {r('avg(test_sharpe)')} AS avg_test_sharpe, {r('avg((test_return > 0)::INT)')} AS robustness FROM wf GROUP BY symbol"),
)
def walk_forward_summary(spark, sf):
    out = bt.walk_forward_summary(bt.walk_forward(fx.hourly(spark, sf), "sma_crossover", RANGES, splits=3), ["symbol"])
    return near(out, "avg_test_sharpe", "robustness").select("symbol", "windows", "avg_test_sharpe", "robustness")


def _count(df):
    return df.groupBy("symbol", "split", "set").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


NUM_SQL = "z AS (SELECT symbol, ts, rn - 1 AS i, count(*) OVER (PARTITION BY symbol) AS c FROM nb)"
_GROUP = "count(*) AS n, min(ts) AS start_ts, max(ts) AS end_ts"


@query(
    "split_date_ranges",
    "G16",
    with_(
        HOURLY_SQL,
        "k(split, a, b, c, d) AS (VALUES (0, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-06', TIMESTAMP '2024-01-08'), (1, TIMESTAMP '2024-01-04', TIMESTAMP '2024-01-12', TIMESTAMP '2024-01-13', TIMESTAMP '2024-01-20'))",
        f"SELECT symbol, split, CASE WHEN ts BETWEEN a AND b THEN 'train' ELSE 'test' END AS set, {_GROUP} FROM bars, k WHERE ts BETWEEN a AND b OR ts BETWEEN c AND d GROUP BY ALL",
    ),
)
def split_date_ranges(spark, sf):
    ranges = [("2024-01-01", "2024-01-05", "2024-01-06", "2024-01-08"), ("2024-01-04", "2024-01-12", "2024-01-13", "2024-01-20")]
    return _count(ops.split_ranges(fx.hourly(spark, sf), "ts", ranges))


@query(
    "split_rolling",
    "G16",
    with_(HOURLY_SQL, NUMBERED, NUM_SQL, f"SELECT symbol, split, CASE WHEN i < split * 40 + 200 THEN 'train' ELSE 'test' END AS set, {_GROUP} FROM z, (SELECT unnest(generate_series(0, 100)) AS split) WHERE split * 40 + 250 <= c AND i >= split * 40 AND i < split * 40 + 250 GROUP BY ALL"),
)
def split_rolling(spark, sf):
    return _count(ops.split_rolling(fx.hourly(spark, sf), HOURLY, 200, 50, 40))


@query(
    "split_expanding",
    "G16",
    with_(HOURLY_SQL, NUMBERED, NUM_SQL, f"SELECT symbol, split, CASE WHEN i < 200 + split * 60 THEN 'train' ELSE 'test' END AS set, {_GROUP} FROM z, (SELECT unnest(generate_series(0, 100)) AS split) WHERE 250 + split * 60 <= c AND i < 250 + split * 60 GROUP BY ALL"),
)
def split_expanding(spark, sf):
    return _count(ops.split_expanding(fx.hourly(spark, sf), HOURLY, 200, 50, 60))


@query(
    "split_purged",
    "G16",
    with_(
        HOURLY_SQL, NUMBERED, NUM_SQL,
        f"SELECT symbol, CAST(split AS INTEGER) AS split, CASE WHEN i >= split * (c // 5) AND i < split * (c // 5) + c // 5 THEN 'test' ELSE 'train' END AS set, {_GROUP} FROM z, (SELECT unnest(generate_series(0, 4)) AS split) WHERE (i >= split * (c // 5) AND i < split * (c // 5) + c // 5) OR i < split * (c // 5) - 5 OR i >= split * (c // 5) + c // 5 + 7 GROUP BY ALL",
    ),
)
def split_purged(spark, sf):
    return _count(ops.split_purged(fx.hourly(spark, sf), HOURLY, 5, 5, 7))


LOG_SQL = CLEAN_SQL + """, ev AS (SELECT rec.symbol, rec.ts, rec.k, close, clean_entry, lead(rec.ts) OVER w AS xt, lead(close) OVER w AS xc, lead(rec.k) OVER w AS xk FROM rec JOIN nb ON rec.symbol = nb.symbol AND rec.ts = nb.ts WHERE clean_entry OR clean_exit WINDOW w AS (PARTITION BY rec.symbol ORDER BY rec.ts)),
lg AS (SELECT symbol, ts AS entry_ts, xt AS exit_ts, close AS entry_price, xc AS exit_price, xc / close - 1 AS pnl, xk - k AS bars_held FROM ev WHERE clean_entry)"""


@query("trade_log", "G17", recursive(HOURLY_SQL, NUMBERED, FLAGS_SQL, LOG_SQL, f"SELECT * REPLACE ({r('pnl')} AS pnl) FROM lg"))
def trade_log(spark, sf):
    return near(bt.trade_log(ops.clean_signals(flags(spark, sf), HOURLY), HOURLY), "pnl")


@query(
    "trade_quality",
    "G17",
    recursive(
        HOURLY_SQL, NUMBERED, FLAGS_SQL, LOG_SQL,
        f"""SELECT symbol, count(*) AS effective_trades, {r('count(*) FILTER (pnl > 0) * 100.0 / count(*)')} AS win_rate, {r('avg(pnl) FILTER (pnl > 0)')} AS avg_win, {r('avg(pnl) FILTER (pnl <= 0)')} AS avg_loss, {r('max(pnl) FILTER (pnl > 0)')} AS max_win, {r('min(pnl) FILTER (pnl <= 0)')} AS max_loss,
  {r('avg(pnl)')} AS expectancy, {r('abs(avg(pnl) FILTER (pnl > 0) / avg(pnl) FILTER (pnl <= 0))')} AS payoff_ratio, {r('avg(bars_held)')} AS avg_held, min(bars_held) AS min_held, max(bars_held) AS max_held FROM lg WHERE exit_ts IS NOT NULL GROUP BY symbol""",
    ),
)
def trade_quality(spark, sf):
    log = bt.trade_log(ops.clean_signals(flags(spark, sf), HOURLY), HOURLY)
    return near(bt.trade_quality(log, ["symbol"]), "win_rate", "avg_win", "avg_loss", "max_win", "max_loss", "expectancy", "payoff_ratio", "avg_held")


MC_SQL = CLEAN_SQL + """, mc AS (SELECT rec.symbol, rec.ts, rec.inside, close, CASE WHEN lag(inside) OVER w THEN close / lag(close) OVER w - 1 ELSE 0 END AS sr FROM rec JOIN nb ON rec.symbol = nb.symbol AND rec.ts = nb.ts WINDOW w AS (PARTITION BY rec.symbol ORDER BY rec.ts)),
mm AS (SELECT symbol, exp(sum(ln(1 + sr))) - 1 AS ret, (arg_max(close, ts) / arg_min(close, ts) - 1) * 100 AS hold, count(*) FILTER (inside) * 100.0 / count(*) AS exposure FROM mc GROUP BY symbol)"""


@query(
    "market_comparison",
    "G17",
    recursive(HOURLY_SQL, NUMBERED, FLAGS_SQL, MC_SQL, f"SELECT symbol, {r('ret * 100', 4)} AS return_pct, {r('hold', 4)} AS buy_and_hold_pct, {r('ret * 100 - hold', 4)} AS market_adjusted_pct, {r('exposure', 4)} AS exposure_pct FROM mm"),
)
def market_comparison(spark, sf):
    out = bt.market_comparison(bt.hold_backtest(flags(spark, sf), HOURLY), ["symbol"])
    return near(out, "return_pct", "buy_and_hold_pct", "market_adjusted_pct", "exposure_pct", digits=4)


@query(
    "result_rules",
    "G18",
    with_(
        HOURLY_SQL, _sweep_ctes("symbol", "bars"),
        "k(metric, op, threshold) AS (VALUES ('sharpe', '>', 0.5), ('trades', '>=', 30), ('exposure_pct', '<', 60))",
        "u AS (SELECT symbol, combo, 'sharpe' AS metric, sharpe AS value FROM w6 UNION ALL SELECT symbol, combo, 'trades', trades FROM w6 UNION ALL SELECT symbol, combo, 'exposure_pct', exposure_pct FROM w6)",
        "c AS (SELECT symbol, combo, CASE op WHEN '>' THEN value > threshold WHEN '>=' THEN value >= threshold ELSE value < threshold END AS ok FROM u JOIN k USING (metric))",
        "SELECT symbol, combo, bool_and(ok) AS passed, count(*) FILTER (NOT ok) AS failed FROM c GROUP BY ALL",
    ),
)
def result_rules(spark, sf):
    metrics = bt.sweep(fx.hourly(spark, sf), "sma_crossover", RANGES)
    rules = spark.sql("SELECT * FROM VALUES ('sharpe', '>', 0.5D), ('trades', '>=', 30D), ('exposure_pct', '<', 60D) AS t(metric, op, threshold)")
    return bt.all_passed(bt.evaluate_rules(metrics, rules, ["symbol", "combo"], ["sharpe", "trades", "exposure_pct"]), ["symbol", "combo"])


# --- alphas ---------------------------------------------------------------------------------------------------------


@query(
    "alpha_bar_strength",
    "G19",
    with_(
        DAILY_SQL,
        "x AS (SELECT symbol, ts, round((close - low) / (high - low), 6) AS v, abs(close / open - 1) AS m FROM bars WHERE open * (high - low) <> 0)",
        "y AS (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY v, symbol) AS k, count(*) OVER (PARTITION BY ts) AS n FROM x)",
        f"SELECT symbol, ts, CASE WHEN k <= least(n // 2, 2) THEN 1 ELSE -1 END AS direction, {r('m')} AS magnitude FROM y WHERE k <= least(n // 2, 2) OR k > n - least(n // 2, 2)",
    ),
)
def alpha_bar_strength(spark, sf):
    return near(alphas.bar_strength(fx.daily(spark, sf)), "magnitude")


@query(
    "alpha_pumped",
    "G19",
    with_(DAILY_SQL, f"SELECT symbol, ts, -1 AS direction, {r('abs(close / open - 1)')} AS magnitude FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY round(close / open - 1, 6) DESC, symbol) AS k FROM bars) WHERE k <= 3"),
)
def alpha_pumped(spark, sf):
    return near(alphas.pumped(fx.daily(spark, sf), 3), "magnitude")


@query(
    "alpha_magic_formula",
    "G25,G19,K7",
    with_(
        COMPANIES_SQL, UNI_SQL, DAILY_SQL,
        "pick AS (SELECT month, CAST(symbol AS VARCHAR) AS symbol FROM s4 WHERE rank <= 10), q AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS roc FROM bars)",
        f"SELECT q.symbol, ts, 1 AS direction, {r('roc')} AS magnitude FROM q JOIN pick ON pick.symbol = q.symbol AND pick.month = strftime(ts, '%Y-%m') WHERE roc IS NOT NULL",
    ),
)
def alpha_magic_formula(spark, sf):
    members = pick_universe(universe(spark, sf), "month", coarse=60).select(F.col("month").alias("period"), F.col("symbol").cast("string").alias("symbol"))
    return near(alphas.magic_formula(members, fx.daily(spark, sf), F.date_format("ts", "yyyy-MM")), "magnitude")


@query(
    "alpha_gap_reversion",
    "G20",
    with_(HOURLY_SQL, NUMBERED, f"x AS (SELECT symbol, ts, close / lag(close) OVER ({W}) - 1 AS j, {roll('stddev_pop', 'close', 100)} AS s FROM nb)", f"SELECT symbol, ts, CASE WHEN j > 0 THEN -1 ELSE 1 END AS direction, {r('j')} AS magnitude FROM x WHERE abs(100 * j) > 3 * s"),
)
def alpha_gap_reversion(spark, sf):
    return near(alphas.gap_reversion(fx.hourly(spark, sf)), "magnitude")


@query(
    "alpha_dual_thrust",
    "G20",
    with_(
        HOURLY_SQL, NUMBERED,
        f"x AS (SELECT symbol, ts, close, lag(close) OVER ({W}) AS p, greatest(max(high) OVER v - min(close) OVER v, max(close) OVER v - min(low) OVER v) AS rg, count(*) OVER v AS n FROM nb WINDOW v AS ({W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))",
        "y AS (SELECT symbol, ts, CASE WHEN n = 20 THEN CASE WHEN close > p + 0.63 * rg THEN 1 WHEN close < p - 0.63 * rg THEN -1 END END AS s FROM x)",
        f"z AS (SELECT *, last_value(s IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM y)",
        "SELECT symbol, ts, s AS direction, NULL::DOUBLE AS magnitude FROM z WHERE s IS NOT NULL AND s IS DISTINCT FROM b",
    ),
)
def alpha_dual_thrust(spark, sf):
    return alphas.dual_thrust(fx.hourly(spark, sf))


@query(
    "alpha_lunch_break",
    "G20",
    with_(
        HOURLY_SQL, NUMBERED,
        f"x AS (SELECT *, (close / lag(close) OVER ({W}) - 1) * 100 AS r1, (close / lag(close, 3) OVER ({W}) - 1) * 100 AS r3 FROM nb), y AS (SELECT *, {avg('r1', 3)} AS m FROM x)",
        f"SELECT symbol, ts, CASE WHEN r3 > 0 THEN -1 ELSE 1 END AS direction, {r('abs(m)')} AS magnitude FROM y WHERE hour(ts) = 12 AND m IS NOT NULL",
    ),
)
def alpha_lunch_break(spark, sf):
    return near(alphas.lunch_break(fx.hourly(spark, sf)), "magnitude")


@query(
    "alpha_intraday_reversal",
    "G20",
    with_(
        HOURLY_SQL, NUMBERED,
        f"x AS (SELECT symbol, ts, close, {avg('close', 5)} AS m FROM nb), y AS (SELECT symbol, ts, CASE WHEN close < round(m * 1.001, 6) THEN 1 ELSE -1 END AS s FROM x WHERE hour(ts) BETWEEN 10 AND 15)",
        f"z AS (SELECT *, lag(s) OVER ({W}) AS b FROM y)",
        "SELECT symbol, ts, s AS direction, NULL::DOUBLE AS magnitude FROM z WHERE s IS DISTINCT FROM b",
    ),
)
def alpha_intraday_reversal(spark, sf):
    return alphas.intraday_reversal(fx.hourly(spark, sf))


@query(
    "alpha_rate_volatility",
    "G20",
    with_(
        HOURLY_SQL,
        "m0 AS (SELECT 'm' AS symbol, ts, avg(close) AS value FROM bars GROUP BY ts), x AS (SELECT ts, value, " + avg("value", 15) + " AS m, 2 * (" + roll("stddev_pop", "value", 15) + ") AS d FROM m0)",
        "SELECT s.symbol, ts, 1 AS direction, 0.005::DOUBLE AS magnitude FROM x, (SELECT DISTINCT symbol FROM bars) s WHERE abs(value - m) > d / 2",
    ),
)
def alpha_rate_volatility(spark, sf):
    h = fx.hourly(spark, sf)
    rate = h.groupBy("ts").agg(F.avg("close").alias("value")).withColumn("symbol", F.lit("m"))
    return alphas.rate_volatility(rate, ["click", "error", "purchase", "signup", "view"], HOURLY)


PAIRS_SQL = "pr AS (SELECT a.ts, a.close AS x, b.close AS y FROM bars a JOIN bars b ON a.ts = b.ts WHERE a.symbol = 'view' AND b.symbol = 'click')"


@query(
    "alpha_share_class",
    "G21",
    recursive(
        HOURLY_SQL, PAIRS_SQL,
        "q0 AS (SELECT 'view/click' AS symbol, ts, x / first_value(x) OVER (ORDER BY ts) - y / first_value(y) OVER (ORDER BY ts) AS v FROM pr), q1 AS (SELECT *, " + avg("v", 10) + " AS m FROM q0)",
        "q2 AS (SELECT *, lag(v) OVER (ORDER BY ts) AS pv, lag(m) OVER (ORDER BY ts) AS pm FROM q1), q3 AS (SELECT symbol, ts, v >= m AS up, (v >= m) <> (pv >= m) AS cx FROM q2 WHERE pm IS NOT NULL)",
        _recursive("true AS inv, CASE WHEN up THEN -1 ELSE 1 END AS d", "CASE WHEN NOT p.inv THEN true ELSE NOT n.cx END, CASE WHEN NOT p.inv THEN CASE WHEN n.up THEN -1 ELSE 1 END END", (), base="q3")[0],
        "SELECT symbol, ts, d AS direction FROM rec WHERE d IS NOT NULL",
    ),
)
def alpha_share_class(spark, sf):
    return alphas.share_class(alphas.pair_bars(fx.hourly(spark, sf), "view", "click"))


KENDALL_SQL = """dr AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS x FROM bars), nw AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM dr WHERE x IS NOT NULL AND symbol IN ('1', '2', '3', '4')),
pq AS (SELECT a.symbol AS leader, b.symbol AS follower, a.ts, a.x, b.x AS y FROM nw a JOIN nw b ON a.ts = b.ts WHERE a.z <= 90 AND b.z <= 90 AND a.symbol IN ('1', '2') AND b.symbol IN ('3', '4')),
kt AS (SELECT p.leader, p.follower, sum(sign(p.x - q.x) * sign(p.y - q.y)) / nullif(sqrt(sum(abs(sign(p.x - q.x))) * sum(abs(sign(p.y - q.y)))), 0) AS tau FROM pq p JOIN pq q ON p.leader = q.leader AND p.follower = q.follower GROUP BY ALL)"""


@query("lead_follow_pairs", "G21", with_(DAILY_SQL, KENDALL_SQL, f"SELECT leader, follower, {rs('tau')} FROM kt"))
def lead_follow_pairs(spark, sf):
    return near(alphas.lead_follow_pair(fx.daily(spark, sf), ["1", "2"], ["3", "4"]), "tau")


@query(
    "alpha_lead_follow",
    "G21",
    with_(
        DAILY_SQL, KENDALL_SQL,
        "bp AS (SELECT leader, follower FROM kt ORDER BY tau DESC NULLS LAST, leader, follower LIMIT 1), rc AS (SELECT symbol, ts, (close / lag(close, 5) OVER (PARTITION BY symbol ORDER BY ts) - 1) * 100 AS r FROM bars)",
        f"SELECT follower AS symbol, ts, CASE WHEN r > 0.75 THEN 1 ELSE -1 END AS direction, {r('round(r / 100, 6)', 5)} AS magnitude FROM rc JOIN bp ON rc.symbol = leader WHERE abs(r) > 0.75",
    ),
)
def alpha_lead_follow(spark, sf):
    d = fx.daily(spark, sf)
    best = alphas.lead_follow_pair(d, ["1", "2"], ["3", "4"]).limit(1)
    return near(alphas.lead_follow(d, best, DAILY), "magnitude", digits=5)


@query(
    "pairs_zscore",
    "G21",
    with_(
        HOURLY_SQL, PAIRS_SQL,
        "q0 AS (SELECT 'view/click' AS symbol, ts, x - (SELECT regr_slope(x, y) FROM pr) * y AS s FROM pr)",
        f"q1 AS (SELECT symbol, ts, CASE WHEN count(*) OVER {wn(60)} = 60 THEN (s - avg(s) OVER {wn(60)}) / nullif(stddev_samp(s) OVER {wn(60)}, 0) END AS z FROM q0)",
        f"SELECT symbol, ts, {r('z')} AS zscore, CASE WHEN z > 2 THEN 'short_spread' WHEN z < -2 THEN 'long_spread' WHEN abs(z) < 0.5 THEN 'exit' WHEN z IS NOT NULL THEN 'hold' END AS signal FROM q1",
    ),
)
def pairs_zscore(spark, sf):
    return near(alphas.pairs_zscore(alphas.pair_bars(fx.hourly(spark, sf), "view", "click")), "zscore").select("symbol", "ts", "zscore", "signal")


def groups(spark, sf):
    """Every event type as an underlying with its two leveraged funds."""
    s = fx.table(spark, sf, "events").select(F.col("event_type").alias("underlying")).distinct()
    return s.withColumns({"ultra_long": F.concat("underlying", F.lit("2x")), "ultra_short": F.concat("underlying", F.lit("-2x"))})


@query(
    "alpha_leveraged_rebalance",
    "G22",
    with_(
        HOURLY_SQL,
        "d AS (SELECT symbol, CAST(b.ts AS DATE) AS day, arg_max(close, b.ts) AS c, arg_max(close, b.ts) FILTER (hour(b.ts) * 60 + minute(b.ts) <= 855) AS now FROM bars b GROUP BY ALL), e AS (SELECT *, lag(c) OVER (PARTITION BY symbol ORDER BY day) AS p FROM d)",
        "f AS (SELECT *, round((now - p) / p, 10) AS x FROM e)",
        "SELECT CASE WHEN x > 0.01 THEN symbol || '2x' ELSE symbol || '-2x' END AS symbol, day AS ts, CASE WHEN x > 0.01 THEN 1 ELSE -1 END AS direction, 0.0005::DOUBLE AS magnitude FROM f WHERE abs(x) > 0.01",
    ),
)
def alpha_leveraged_rebalance(spark, sf):
    return alphas.leveraged_rebalance(fx.hourly(spark, sf), groups(spark, sf))


@query(
    "alpha_decay_pair",
    "G22",
    with_(HOURLY_SQL, "d AS (SELECT DISTINCT symbol, CAST(ts AS DATE) AS day FROM bars)", "SELECT symbol || x AS symbol, day AS ts, -1 AS direction, 0.001::DOUBLE AS magnitude FROM d, (SELECT unnest(['2x', '-2x']) AS x)"),
)
def alpha_decay_pair(spark, sf):
    return alphas.decay_pair(fx.hourly(spark, sf), groups(spark, sf))


@query("alpha_default_probability", "G23")
def alpha_default_probability(spark, sf):
    """Asset history from the shipped value per year; liabilities as a share of it."""
    l = fx.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.year("l_shipdate").alias("y")).agg(F.sum("l_extendedprice").alias("v"))
    a = l.groupBy("symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "v"))), lambda x: x["v"]).alias("assets"))
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"), (F.col("s_acctbal") / 1e7).alias("roa"), F.lit(0.0).alias("payments"), (F.col("s_nationkey") / 25).alias("share"))
    sheets = a.join(s, "symbol").withColumn("liabilities", F.element_at("assets", -1) * (0.5 + F.col("share")))
    out = alphas.default_probability(sheets).withColumn("ts", F.lit("2001-12-31").cast("timestamp"))
    return near(alphas.default_alpha(out), "magnitude")


@query(
    "basket_daily",
    "G24",
    with_(
        DAILY_SQL, RETURNS,
        "b AS (SELECT ts, sum(0.0005 * ret) AS basket_return FROM rets WHERE ret IS NOT NULL GROUP BY ts), c AS (SELECT *, 100 * exp(sum(ln(1 + basket_return)) OVER (ORDER BY ts)) AS basket_value FROM b)",
        f"SELECT ts, {rs('basket_return')}, {r('ln(basket_value / 100)')} AS log_value, {r('basket_value / max(basket_value) OVER (ORDER BY ts) - 1')} AS drawdown FROM c",
    ),
)
def basket_daily(spark, sf):
    rets = returns(spark, sf, daily=True).filter("ret IS NOT NULL").select("symbol", "ts", "ret")
    weights = rets.groupBy("symbol").agg(F.lit(0.0005).alias("weight"))
    out = bt.basket(rets, weights).withColumn("log_value", F.log(F.col("basket_value") / 100))
    return near(out, "basket_return", "drawdown", "log_value").drop("basket_value")


@query(
    "basket_drift_monthly",
    "G24",
    with_(
        DAILY_SQL, RETURNS,
        "p AS (SELECT symbol, ts, date_trunc('month', ts) AS p, exp(sum(ln(1 + ret)) OVER (PARTITION BY symbol, date_trunc('month', ts) ORDER BY ts)) AS g FROM rets WHERE ret IS NOT NULL), v AS (SELECT p, ts, sum(0.01 * g) AS v, sum(0.01) AS w FROM p GROUP BY ALL)",
        "b AS (SELECT ts, coalesce(v / lag(v) OVER (PARTITION BY p ORDER BY ts) - 1, v / w - 1) AS basket_return FROM v), c AS (SELECT *, sum(ln(1 + basket_return)) OVER (ORDER BY ts) AS g FROM b)",
        f"SELECT ts, {rs('basket_return')}, {r('g')} AS log_value FROM c",
    ),
)
def basket_drift_monthly(spark, sf):
    rets = returns(spark, sf, daily=True).filter("ret IS NOT NULL").select("symbol", "ts", "ret")
    weights = rets.groupBy("symbol").agg(F.lit(0.01).alias("weight"))
    out = bt.basket(rets, weights, rebalance="month").withColumn("log_value", F.log(F.col("basket_value") / 100))
    return near(out, "basket_return", "log_value").select("ts", "basket_return", "log_value")


@query(
    "position_actions",
    "G26",
    f"""WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS lp, CASE WHEN l_returnflag = 'N' THEN 'BUY' ELSE 'SELL' END AS side, l_extendedprice / l_quantity AS entry, p_retailprice * 2 AS price, l_tax * 200 AS best FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT *, CASE WHEN side = 'BUY' THEN (price - entry) / entry * 100 ELSE -((price - entry) / entry * 100) END AS gain FROM p)
SELECT l_orderkey, l_linenumber, lp, {r('gain', 5)} AS gain, CASE WHEN gain <= -20 THEN 'stop_loss_hit' WHEN gain >= 40 THEN 'take_profit_hit' WHEN best > 0 AND best - gain >= 10 THEN 'trailing_stop_hit' END AS action FROM g""",
)
def position_actions(spark, sf):
    l, p = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "part")
    rows = l.join(p, F.col("l_partkey") == F.col("p_partkey"))
    side = F.when(F.col("l_returnflag") == "N", "BUY").otherwise("SELL")
    entry, price = F.col("l_extendedprice") / F.col("l_quantity"), F.col("p_retailprice") * 2
    out = rows.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("lp"), bt.position_gain(entry, price, side).alias("gain"),
        bt.position_action(entry, price, side, F.col("l_tax") * 200, 20, 40, 10).alias("action"),
    )
    return near(out, "gain", digits=5)
