"""Backtests, sweeps, walk-forward runs, trade logs, baskets.

Two kinds of run: :func:`hold_backtest` compounds the returns of the bars a strategy is invested in and is plain
window work; :func:`rule_backtest` buys whole shares with all cash: when it holds a position follows from composed summaries of the
time buckets, and its cash passes along the closed trades only.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.indicators import compute
from candlewick.operators.machines import Positions
from candlewick.operators.series import HOURLY, POS, Axis, fold, number, over_blocks, prefix, spans_buckets
from candlewick.operators.signals import clean_signals, evaluate_groups, strategy
from candlewick.operators.windows import pct_change, positive
from candlewick.session import checkpoint_folder

# Bars skipped before the first entry of a rule backtest.
WARMUP = 50


def rule_backtest(
    bars: DataFrame,
    entry_rules: Sequence,
    exit_rules: Sequence,
    axis: Axis = HOURLY,
    stop_loss_pct: float = 0.0,
    take_profit_pct: float = 0.0,
    capital: float = 100_000.0,
    warmup: int = WARMUP,
) -> DataFrame:
    """One row per bar after the warm-up: equity and, on the bar of an exit, the closed trade.

    Rules are evaluated once over the whole history.  At most one action per bar: stop loss, then take profit, then
    the exit rules; an open position is closed at the last bar.
    """
    rows = evaluate_groups(number(bars, axis, length="_n"), {"enter": entry_rules, "leave": exit_rules}, axis)
    rows = rows.filter(F.col(POS) > warmup)
    return invest(rows, axis, "enter", "leave", stop_loss_pct, take_profit_pct, capital)


TRADE_FIELDS = [
    ("equity", T.DoubleType()), ("entry_bar", T.LongType()), ("exit_bar", T.LongType()), ("entry_price", T.DoubleType()),
    ("exit_price", T.DoubleType()), ("shares", T.LongType()), ("pnl", T.DoubleType()), ("pnl_pct", T.DoubleType()),
    ("reason", T.StringType()), ("bars_held", T.LongType()),
]


def invest(
    rows: DataFrame, axis: Axis, enter: str, leave: str, stop: float = 0.0, profit: float = 0.0, capital: float = 100_000.0
) -> DataFrame:
    """All-in whole-share state machine over rows with a position column and the series length ``_n``."""
    ts = axis.order[0]
    schema = T.StructType([rows.schema[k] for k in (*axis.key, ts, POS)] + [T.StructField(n, t) for n, t in TRADE_FIELDS])

    def run(part: pd.DataFrame, state):
        cash, shares, price, since = state if state else [capital, 0.0, 0.0, 0.0]
        out = []
        for c, e, x, at, n in zip(part["close"].to_numpy(), part[enter].to_numpy(), part[leave].to_numpy(), part[POS].to_numpy(), part["_n"].to_numpy()):
            trade = [None] * 9
            why = None
            opened = False
            if not shares:
                if e and c > 0 and cash >= c:
                    shares, price, since, opened = float(math.floor(cash / c)), c, float(at), True
                    cash -= shares * c
            if shares:
                gain = (c - price) / price * 100
                if not opened:
                    if stop > 0 and gain <= -stop:
                        why = "stop_loss"
                    elif profit > 0 and gain >= profit:
                        why = "take_profit"
                    elif x:
                        why = "exit_signal"
                if why is None and at == n:
                    why = "end_of_data"
                if why:
                    cash += shares * c
                    trade = [int(since) - 1, int(at) - 1, price, c, int(shares), (c - price) * shares, gain, why, int(at - since)]
                    shares = 0.0
            out.append([cash + shares * c, *trade])
        res = pd.DataFrame(out, columns=[n for n, _ in TRADE_FIELDS], dtype="object")
        for name, kind in TRADE_FIELDS:
            if isinstance(kind, T.LongType):
                res[name] = res[name].astype("Int64")
            elif isinstance(kind, T.DoubleType):
                res[name] = res[name].astype("float64")
        head = part[[*axis.key, ts, POS]].reset_index(drop=True)
        return pd.concat([head, res], axis=1), [cash, shares, price, since]

    rows = rows.select(*axis.key, ts, POS, "close", enter, leave, "_n")
    if spans_buckets(rows, axis):
        out = _invest_in_pieces(rows, axis, enter, leave, stop, profit, capital, lambda part: fold(part, axis, run, schema, split=True))
    else:
        out = fold(rows, axis, run, schema, split=False)
    return out.withColumns({c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in ("entry_price", "exit_price", "pnl", "pnl_pct")})


def _invest_in_pieces(rows: DataFrame, axis: Axis, enter: str, leave: str, stop: float, profit: float, capital: float, in_order: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The state machine of :func:`invest` without a walk along the rows.

    As long as the cash buys at least one share, it does not decide when a position opens or closes: positions come from composed summaries of the
    time buckets, and only the closed trades of a series, in order, pass its cash on (a task holds one batch of them). Series whose cash falls below a price are
    run by ``in_order``.
    """
    checkpoint_folder(rows.sparkSession)
    key, ts = list(axis.key), axis.order[0]
    rows = rows.checkpoint()
    lists = lambda part: tuple(part[c].eq(True).tolist() for c in (enter, leave))

    def columns(part: pd.DataFrame) -> tuple:
        e, x = lists(part)
        return part["close"].astype(float).tolist(), e, x, (part[POS] == part["_n"]).tolist(), part[POS].astype(float).tolist()

    machine = Positions(columns, stop, profit)
    head = [rows.schema[c] for c in (*key, *axis.order, POS, "close")]
    timed_schema = T.StructType([*head, T.StructField("price", T.DoubleType()), T.StructField("since", T.LongType()), T.StructField("opened", T.IntegerType()), T.StructField("reason", T.StringType())])

    def run(part: pd.DataFrame, state):
        price, since = state if state else [math.nan, math.nan]
        holds, out = bool(state), []
        for c, e, x, last, at in zip(*columns(part)):
            opened, why = False, None
            if not holds and e and c > 0:
                price, since, holds, opened = c, at, True, True
            if holds and not opened:
                why = machine.reason(price, c) or ("exit_signal" if x else None)
            if holds and why is None and last:
                why = "end_of_data"
            out.append((price if holds else None, int(since) if holds else None, int(opened), why))
            holds = holds and why is None
        res = part[[f.name for f in head]].reset_index(drop=True)
        found = pd.DataFrame(out, columns=["price", "since", "opened", "reason"], dtype="object")
        res["price"], res["since"], res["opened"], res["reason"] = found["price"].astype("float64"), found["since"].astype("Int64"), found["opened"].astype("int32"), found["reason"]
        return res, ([price, since] if holds else [])

    timed = prefix(fold(rows, axis, run, timed_schema, machine=machine, split=True), axis, {"_k": ("sum", "opened")}).checkpoint()
    trades = timed.filter(F.col("reason").isNotNull()).select(*key, "_k", POS, "price", "close")
    chain_schema = T.StructType([*[rows.schema[k] for k in key], trades.schema["_k"], *[T.StructField(n, T.DoubleType()) for n in ("_left", "_shares", "_after")], T.StructField("_short", T.BooleanType())])

    def chain(parts):
        name, cash, short = None, capital, False
        for part in parts:
            out = []
            for own, k, price, close in zip(part[key].itertuples(index=False, name=None), part["_k"], part["price"], part["close"]):
                if own != name:
                    name, cash, short = own, capital, False
                short = short or cash < price
                shares = 0.0 if short else float(math.floor(cash / price))
                left = cash - shares * price
                cash = left + shares * close
                out.append((*own, k, left, shares, cash, short))
            yield pd.DataFrame(out, columns=chain_schema.names)

    cash = trades.repartition(*key).sortWithinPartitions(*key, "_k").mapInPandas(chain, chain_schema).checkpoint()
    broke = cash.filter("_short").select(*key).distinct()
    whole = timed.join(cash, [*key, "_k"], "left").withColumn("_closed", F.col("reason").isNotNull())
    at_exit = lambda c: F.when(F.col("_closed"), c)
    gain = F.col("close") - F.col("price")
    out = whole.select(
        *key, ts, POS, F.when(F.col("price").isNotNull(), F.col("_left") + F.col("_shares") * F.col("close")).otherwise(F.coalesce("_after", F.lit(float(capital)))).alias("equity"),
        at_exit(F.col("since") - 1).alias("entry_bar"), at_exit(F.col(POS) - 1).cast("long").alias("exit_bar"), at_exit(F.col("price")).alias("entry_price"),
        at_exit(F.col("close").cast("double")).alias("exit_price"), at_exit(F.col("_shares").cast("long")).alias("shares"), at_exit(gain * F.col("_shares")).alias("pnl"), at_exit(gain / F.col("price") * 100).alias("pnl_pct"),
        "reason", at_exit(F.col(POS) - F.col("since")).cast("long").alias("bars_held"),
    )
    if broke.isEmpty():
        return out
    again = in_order(rows.join(broke, key, "left_semi"))
    return out.join(broke, key, "left_anti").unionByName(again.select(*out.columns))


def trades_of(run: DataFrame) -> DataFrame:
    return run.filter(F.col("reason").isNotNull()).drop("equity", POS)


def run_metrics(run: DataFrame, axis: Axis, capital: float = 100_000.0, bars_per_year: float = 252.0) -> DataFrame:
    """Trade statistics, total return, drawdown and annualised Sharpe (population) per series."""
    key = list(axis.key)
    rows = over_blocks(run, axis, lambda w: {"_r": F.col("equity") / positive(F.lag("equity").over(w)) - 1}, back=1)
    rows = prefix(rows, axis, {"_peak": ("max", F.greatest(F.col("equity"), F.lit(capital)))})
    x = F.col("pnl")
    n = F.count("reason")
    gain, loss = F.sum(F.when(x > 0, x)), F.abs(F.sum(F.when(x <= 0, x)))
    sd = F.stddev_pop("_r")
    out = rows.groupBy(*key).agg(
        n.alias("total_trades"), F.count_if(x > 0).alias("winning_trades"), F.count_if(x <= 0).alias("losing_trades"),
        F.when(n > 0, F.count_if(x > 0) / n * 100).otherwise(0.0).alias("win_rate"),
        F.max_by("equity", axis.order[0]).alias("final_equity"), F.max((F.col("_peak") - F.col("equity")) / F.col("_peak") * 100).alias("max_drawdown"),
        F.coalesce(F.avg(x), F.lit(0.0)).alias("avg_pnl"), F.coalesce(F.avg("bars_held"), F.lit(0.0)).alias("avg_bars_held"),
        F.when(loss > 0, F.coalesce(gain, F.lit(0.0)) / loss).when(gain > 0, 999.99).otherwise(0.0).alias("profit_factor"),
        F.when((n > 0) & (sd > 0), F.avg("_r") / sd * math.sqrt(bars_per_year)).otherwise(0.0).alias("sharpe"),
    )
    total = F.col("final_equity") - capital
    return out.withColumns({"total_return": total, "total_return_pct": total / capital * 100})


# --- invested-bar backtests, sweeps ---------------------------------------------------------------------------------


def hold_backtest(rows: DataFrame, axis: Axis, capital: float = 1.0, equity: bool = True) -> DataFrame:
    """Bars with entry and exit flags → strategy return of each bar (invested since an earlier close) and equity.

    A column ``ret`` with the bar's return is used when there is one.
    """
    if "ret" not in rows.columns:
        rows = over_blocks(rows, axis, lambda w: {"ret": pct_change(w)}, back=1)
    rows = clean_signals(rows, axis)
    gain = F.when(F.col("was_in"), F.coalesce(F.col("ret"), F.lit(0.0))).otherwise(0.0)
    rows = rows.withColumn("strategy_return", gain).drop("was_in", "ret")
    if not equity:
        return rows
    rows = prefix(rows, axis, {"_log": ("sum", F.log1p("strategy_return"))})
    return rows.withColumn("equity", capital * F.exp("_log")).drop("_log")


def hold_metrics(run: DataFrame, keys: Sequence[str], year: int = 252) -> DataFrame:
    """Total return, annualised Sharpe and Sortino (sample / downside deviation), exposure, trades."""
    r = F.col("strategy_return")
    sd = F.stddev_samp(r)
    down = F.sqrt(F.avg(F.when(r < 0, r * r).otherwise(0.0)))
    return run.groupBy(*keys).agg(
        (F.exp(F.sum(F.log1p(r))) - 1).alias("total_return"),
        F.when(sd > 0, F.avg(r) / sd * math.sqrt(year)).otherwise(0.0).alias("sharpe"),
        F.when(down > 0, F.avg(r) / down * math.sqrt(year)).otherwise(0.0).alias("sortino"),
        (F.count_if("in_position") / F.count(F.lit(1)) * 100).alias("exposure_pct"),
        F.count_if("clean_entry").alias("trades"),
    )


def grid(ranges: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the parameter values; a range may be (min, max, step)."""
    values = [list(range(v[0], v[1] + 1, v[2])) if isinstance(v, tuple) else list(v) for v in ranges.values()]
    return [dict(zip(ranges, combo)) for combo in product(*values)]


def sample_grid(combos: Sequence[dict], n: int, seed: int = 0) -> list[dict]:
    """A reproducible random choice of ``n`` combinations."""
    return random.Random(seed).sample(list(combos), min(n, len(combos)))


def sweep_runs(bars: DataFrame, name: str, combos: Sequence[dict], axis: Axis = HOURLY) -> tuple[DataFrame, Axis]:
    """Run a strategy for every series and combination: rows carry ``combo`` (index) and the strategy return.

    Indicators of all combinations are computed in one pass over the bars, then the bars are multiplied by the
    combinations, so (series, combination) is the unit that spreads over the cluster.
    """
    wanted, makers = {}, []
    for i, params in enumerate(combos):
        more, make = strategy(name, prefix=f"c{i}_", **params)
        wanted.update(more)
        makers.append(make)

    def flags(w):
        out = {f"c{i}:{k}": c for i, make in enumerate(makers) for k, c in make(w).items()}
        return {"ret": pct_change(w), **out}

    rows = compute(bars, wanted, axis, after=[flags], after_reach=1)
    each = [
        F.struct(F.lit(i).alias("combo"), F.col(f"`c{i}:entry`").alias("entry"), F.col(f"`c{i}:exit`").alias("exit"))
        for i in range(len(combos))
    ]
    rows = rows.withColumn("_s", F.explode(F.array(*each))).select(*axis.key, *axis.order, "close", "ret", "_s.*")
    wide = axis.by(key=(*axis.key, "combo"))
    return hold_backtest(rows, wide, equity=False), wide


def with_parameters(df: DataFrame, combos: Sequence[dict]) -> DataFrame:
    """Parameter columns of the combination index."""
    out = {}
    for name in combos[0]:
        out[name] = F.element_at(F.array(*[F.lit(float(c[name])) for c in combos]), F.col("combo") + 1)
    return df.withColumns(out)


BATCH = 64  # combinations computed side by side in one row


def sweep_metrics(bars: DataFrame, name: str, combos: Sequence[dict], axis: Axis) -> DataFrame:
    """Metrics of every (series, combination).

    A row holds the indicators of ``BATCH`` combinations, so that plans stay small however large the grid is; the metrics
    of a batch are a few numbers per series and are checkpointed when others follow.
    """
    found = None
    for at in range(0, len(combos), BATCH):
        runs, wide = sweep_runs(bars, name, combos[at : at + BATCH], axis)
        part = hold_metrics(runs, list(wide.key)).withColumn("combo", F.col("combo") + at)
        if len(combos) > BATCH:
            checkpoint_folder(bars.sparkSession)
            part = part.checkpoint()
        found = part if found is None else found.unionByName(part)
    return found


def sweep(bars: DataFrame, name: str, ranges: Mapping[str, Sequence], axis: Axis = HOURLY, draws: int = 500, method: str = "grid") -> DataFrame:
    """Metrics of every (series, combination) with the parameter values: the whole grid, or ``draws`` random combinations."""
    combos = grid(ranges)
    combos = sample_grid(combos, draws) if method == "random" else combos
    return with_parameters(sweep_metrics(bars, name, combos, axis), combos)


def best_of(results: DataFrame, keys: Sequence[str], objective: str = "sharpe") -> DataFrame:
    """The combination with the highest objective (the lower index on ties)."""
    order = F.struct(F.col(objective), -F.col("combo"))
    rest = [c for c in results.columns if c not in keys]
    return results.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_b")).select(*keys, "_b.*")


def sensitivity(results: DataFrame, keys: Sequence[str], params: Sequence[str], objective: str = "sharpe") -> DataFrame:
    """Correlation of each parameter with the objective; 0 when it does not vary."""
    return results.groupBy(*keys).agg(*[F.coalesce(F.corr(p, objective), F.lit(0.0)).alias(f"sensitivity_{p}") for p in params])


def walk_forward(
    bars: DataFrame, name: str, ranges: Mapping[str, Sequence], axis: Axis = HOURLY, splits: int = 5, train_ratio: float = 0.7,
    objective: str = "sharpe",
) -> DataFrame:
    """Best combination on the first part of each window, measured on the rest.

    Windows are consecutive n / splits bars; indicators start anew in each train and test part.  Windows below 50 bars
    or with fewer than 30 train / 10 test bars are left out.
    """
    combos = grid(ranges)
    rows = number(bars, axis, length="_n")
    size = F.floor(F.col("_n") / splits)
    at = F.col(POS) - 1
    rows = rows.withColumns({"window_no": F.floor(at / size), "_at": at % size, "_cut": F.floor(size * train_ratio + 1e-9), "_size": size})
    rows = rows.filter((F.col("window_no") < splits) & (F.col("_size") >= 50) & (F.col("_cut") >= 30) & (F.col("_size") - F.col("_cut") >= 10))
    rows = rows.withColumn("set", F.when(F.col("_at") < F.col("_cut"), "train").otherwise("test"))
    rows = rows.drop("_n", "_at", "_cut", "_size", POS)
    part = axis.by(key=(*axis.key, "window_no", "set"))
    metrics = sweep_metrics(rows, name, combos, part)
    keys = [*axis.key, "window_no"]
    best = best_of(metrics.filter("set = 'train'"), keys, objective)
    best = best.select(*keys, "combo", F.col("total_return").alias("train_return"), F.col(objective).alias(f"train_{objective}"))
    test = metrics.filter("set = 'test'").select(*keys, "combo", F.col("total_return").alias("test_return"), F.col(objective).alias(f"test_{objective}"))
    return with_parameters(best.join(test, [*keys, "combo"]), combos)


def walk_forward_summary(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return windows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("windows"), F.avg("test_return").alias("avg_test_return"), F.avg("test_sharpe").alias("avg_test_sharpe"),
        F.stddev_pop("test_return").alias("test_return_std"), F.avg((F.col("test_return") > 0).cast("double")).alias("robustness"),
    )


# --- trade logs -----------------------------------------------------------------------------------------------------


def trade_log(rows: DataFrame, axis: Axis, value: str = "close") -> DataFrame:
    """Pair each clean entry with the exit after it (null while open): prices, return, bars held."""
    ts = axis.order[0]
    events = number(rows, axis).filter(F.col("clean_entry") | F.col("clean_exit")).withColumnRenamed(POS, "bar")
    nxt = lambda c: (lambda w: F.lead(c).over(w))
    cols = lambda w: {"exit_ts": nxt(ts)(w), "exit_price": nxt(value)(w), "exit_bar": nxt("bar")(w)}
    log = over_blocks(events, axis, cols, ahead=1).filter("clean_entry")
    return log.select(
        *axis.key, F.col(ts).alias("entry_ts"), "exit_ts", F.col(value).alias("entry_price"), "exit_price",
        (F.col("exit_price") / F.col(value) - 1).alias("pnl"), (F.col("exit_bar") - F.col("bar")).alias("bars_held"),
    )


def trade_quality(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Completed trades, win rate, average win and loss, extremes, expectancy, payoff, holding time."""
    x = F.col("pnl")
    done = log.filter(F.col("exit_ts").isNotNull())
    win, loss = F.avg(F.when(x > 0, x)), F.avg(F.when(x <= 0, x))
    return done.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("effective_trades"), (F.count_if(x > 0) / F.count(F.lit(1)) * 100).alias("win_rate"),
        F.coalesce(win, F.lit(0.0)).alias("avg_win"), F.coalesce(loss, F.lit(0.0)).alias("avg_loss"),
        F.coalesce(F.max(F.when(x > 0, x)), F.lit(0.0)).alias("max_win"), F.coalesce(F.min(F.when(x <= 0, x)), F.lit(0.0)).alias("max_loss"),
        F.avg(x).alias("expectancy"), F.when(loss != 0, F.abs(win / loss)).otherwise(0.0).alias("payoff_ratio"),
        F.avg("bars_held").alias("avg_held"), F.min("bars_held").alias("min_held"), F.max("bars_held").alias("max_held"),
    )


def market_comparison(run: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Strategy return, buy-and-hold return, their difference and the share of bars invested, in percent."""
    first, last = F.min_by("close", ts), F.max_by("close", ts)
    strategy_pct = (F.exp(F.sum(F.log1p("strategy_return"))) - 1) * 100
    hold = F.when(first != 0, (last - first) / first * 100).otherwise(0.0)
    return run.groupBy(*keys).agg(
        strategy_pct.alias("return_pct"), hold.alias("buy_and_hold_pct"), (strategy_pct - hold).alias("market_adjusted_pct"),
        (F.count_if("in_position") / F.count(F.lit(1)) * 100).alias("exposure_pct"),
    )


def evaluate_rules(metrics: DataFrame, rules: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Assert rules (metric, op, threshold) against the metrics of each run: one row per run and rule."""
    long = metrics.unpivot(list(keys), [F.col(n).cast("double").alias(n) for n in names], "metric", "value")
    rows = long.join(rules, "metric")
    v, t, op = F.col("value"), F.col("threshold"), F.col("op")
    hit = (
        F.when(op == ">", v > t).when(op == "<", v < t).when(op == ">=", v >= t).when(op == "<=", v <= t)
        .when(op == "=", v == t).when(op == "!=", v != t).otherwise(False)
    )
    return rows.withColumn("passed", F.coalesce(hit, F.lit(False)))


def all_passed(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return checked.groupBy(*keys).agg(F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


# --- baskets and positions ------------------------------------------------------------------------------------------


def basket(
    returns: DataFrame, weights: DataFrame, ts: str = "ts", rebalance: str = "daily", ret: str = "ret", initial: float = 100.0, axis: Axis = HOURLY
) -> DataFrame:
    """Return, value and drawdown of a weighted basket.

    ``daily`` keeps the weights constant; ``none`` lets them drift from the first row; "month" (or another date_trunc
    unit) resets them at the start of each period.  After the sum over symbols there is one row per time; the running
    value goes over time buckets.
    """
    rows = returns.join(weights, "symbol")
    if rebalance == "daily":
        out = rows.groupBy(ts).agg(F.sum(F.col("weight") * F.col(ret)).alias("basket_return"))
    else:
        rows = rows.withColumn("_p", F.lit(0) if rebalance == "none" else F.date_trunc(rebalance, ts))
        rows = prefix(rows, axis.by(key=("symbol", "_p"), order=(ts,)), {"_log": ("sum", F.log1p(ret))})
        value = rows.groupBy("_p", ts).agg(F.sum(F.col("weight") * F.exp("_log")).alias("_v"), F.sum("weight").alias("_w"))
        first = F.lit(None).cast("double") if rebalance == "none" else F.col("_v") / F.col("_w") - 1
        value = over_blocks(value, axis.by(key=("_p",), order=(ts,)), lambda w: {"_before": F.lag("_v").over(w)}, back=1)
        out = value.select(ts, F.coalesce(F.col("_v") / F.col("_before") - 1, first).alias("basket_return")).filter("basket_return IS NOT NULL")
    line = axis.by(key=("_all",), order=(ts,))
    out = prefix(out.withColumn("_all", F.lit(0)), line, {"_log": ("sum", F.log1p("basket_return"))})
    out = prefix(out.withColumn("basket_value", initial * F.exp("_log")), line, {"_peak": ("max", "basket_value")})
    return out.withColumn("drawdown", F.col("basket_value") / F.col("_peak") - 1).select(ts, "basket_return", "basket_value", "drawdown")


def position_action(entry: Column, price: Column, side: Column, max_gain_pct: Column, stop: float | None, profit: float | None, trail: float | None) -> Column:
    """Verdict for an open position: stop_loss_hit, take_profit_hit, trailing_stop_hit or null."""
    gain = position_gain(entry, price, side)
    out = F.lit(None).cast("string")
    if trail:
        out = F.when((max_gain_pct > 0) & (max_gain_pct - gain >= abs(trail)), "trailing_stop_hit").otherwise(out)
    if profit:
        out = F.when(gain >= abs(profit), "take_profit_hit").otherwise(out)
    if stop:
        out = F.when(gain <= -abs(stop), "stop_loss_hit").otherwise(out)
    return out


def position_gain(entry: Column, price: Column, side: Column) -> Column:
    move = (price - entry) / entry * 100
    return F.when(side == "BUY", move).otherwise(-move)
