"""Fundamentals and valuation as column functions over company, bond, curve and option tables.

Everything per contract or per statement stays inside one row: cash flows are summed over ``sequence`` arrays, so
no exploded rows are shuffled. Only peer statistics and look-ups in price history need a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import accounts as acc
from candlewick.functions import stats
from candlewick.operators import joins, ranking
from candlewick.operators.series import Axis, added, over_blocks, stretch, trailing

# ------------------------------------------------------------------------------------------------ statements


def _over(a, b) -> Column:
    """a / b where b is positive, else null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b > 0, a / b)


def with_averages(df: DataFrame, company: str, period: str, columns: Sequence[str]) -> DataFrame:
    """``average_<column>``: mean of this and the last period, this period alone for the first."""
    w = Window.partitionBy(company).orderBy(period)
    return df.withColumns({f"average_{c}": (F.col(c) + F.coalesce(F.lag(c).over(w), F.col(c))) / 2 for c in columns})


def profitability() -> dict[str, Column]:
    invested = F.col("total_debt") + F.col("total_equity") - F.col("cash")
    return {
        "gross_margin": _over("gross_profit", "revenue"), "operating_margin": _over("operating_income", "revenue"),
        "net_margin": _over("net_income", "revenue"), "ebitda_margin": _over("ebitda", "revenue"),
        "roe": _over("net_income", "average_total_equity"), "roa": _over("net_income", "average_total_assets"),
        "roic": _over(F.col("operating_income") * (1 - F.col("tax_rate")), invested),
    }


def liquidity() -> dict[str, Column]:
    return {
        "current_ratio": _over("current_assets", "current_liabilities"),
        "quick_ratio": _over(F.col("current_assets") - F.col("inventory"), "current_liabilities"),
        "cash_ratio": _over(F.col("cash") + F.col("marketable_securities"), "current_liabilities"),
        "operating_cash_flow_ratio": _over("operating_cash_flow", "current_liabilities"),
    }


def solvency() -> dict[str, Column]:
    lease = F.col("lease_payments")
    return {
        "debt_to_equity": _over("total_debt", "total_equity"), "debt_to_assets": _over("total_debt", "total_assets"),
        "debt_to_capital": _over("total_debt", F.col("total_debt") + F.col("total_equity")),
        "interest_coverage": _over("operating_income", "interest_expense"),
        "fixed_charge_coverage": _over(F.col("operating_income") + lease, F.col("interest_expense") + lease),
        "financial_leverage": _over("total_assets", "total_equity"),
    }


def efficiency() -> dict[str, Column]:
    turns = {
        "asset_turnover": _over("revenue", "average_total_assets"), "fixed_asset_turnover": _over("revenue", "average_fixed_assets"),
        "inventory_turnover": _over("cogs", "average_inventory"), "receivables_turnover": _over("revenue", "average_receivables"),
        "payables_turnover": _over("cogs", "average_payables"), "working_capital_turnover": _over("revenue", "average_working_capital"),
    }
    days = {n: 365 / F.when(turns[t] > 0, turns[t]) for n, t in (("days_in_inventory", "inventory_turnover"), ("days_sales_outstanding", "receivables_turnover"), ("days_payable_outstanding", "payables_turnover"))}
    return {**turns, **days, "cash_conversion_cycle": days["days_in_inventory"] + days["days_sales_outstanding"] - days["days_payable_outstanding"]}


def dupont() -> dict[str, Column]:
    """Three- and five-way split of the return on equity; a factor without a positive base counts as zero."""
    part = lambda a, b: F.coalesce(_over(a, b), F.lit(0.0))
    margin, turnover, leverage = part("net_income", "revenue"), part("revenue", "average_total_assets"), part("average_total_assets", "average_total_equity")
    tax, interest, ebit = part("net_income", "pretax_income"), part("pretax_income", "operating_income"), part("operating_income", "revenue")
    return {
        "net_margin": margin, "asset_turnover": turnover, "leverage": leverage, "roe_3": margin * turnover * leverage,
        "tax_burden": tax, "interest_burden": interest, "ebit_margin": ebit, "roe_5": tax * interest * ebit * turnover * leverage,
    }


def drivers(df: DataFrame, company: str, period: str, columns: Sequence[str]) -> DataFrame:
    """Change and percentage change of each component against the period before."""
    w = Window.partitionBy(company).orderBy(period)
    change = {f"{c}_change": F.col(c) - F.lag(c).over(w) for c in columns}
    pct = {f"{c}_pct": F.when(F.lag(c).over(w) != 0, (F.col(c) - F.lag(c).over(w)) / F.lag(c).over(w) * 100).otherwise(F.when(F.lag(c).over(w).isNotNull(), 0.0)) for c in columns}
    return df.withColumns({**change, **pct})


def standardise_accounts(df: DataFrame, keys: Sequence[str], account: str, value: str, names: Sequence[tuple[str, str, int]] | None = None) -> DataFrame:
    """Raw account rows under standard names, the preferred synonym first; unknown names are kept.

    A raw name may feed several standard accounts (income and cash-flow statement).
    """
    clean = F.regexp_replace(F.lower(account), "[ -]", "_")
    table: dict[str, list] = {}
    for n, standard, rank in names or [(n, standard, i) for standard, own in acc.ACCOUNTS.items() for i, n in enumerate(own)]:
        table.setdefault(n, []).append((standard, rank))
    rows = lambda v: F.array(*[F.struct(F.lit(s).alias("account"), F.lit(k).alias("rank")) for s, k in v])
    lookup = F.create_map(*[x for n, v in table.items() for x in (F.lit(n), rows(v))])
    own = lambda c: F.array(F.struct(c.alias("account"), F.lit(0).alias("rank")))
    named = df.withColumn("_name", clean).withColumn("_to", F.explode(F.coalesce(F.element_at(lookup, F.col("_name")), own(F.col("_name")))))
    return named.groupBy(*keys, F.col("_to.account").alias("account")).agg(F.min_by(value, F.struct("_to.rank", "_name")).alias(value))


def validate_statements(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Balance, cash and EPS checks; a missing balance-sheet side is derived. Adds ``errors`` and ``warnings``."""
    a, l, e = F.col("total_assets"), F.col("total_liabilities"), F.col("total_equity")
    full = a.isNotNull() & l.isNotNull() & e.isNotNull()
    flag = lambda cond, text: F.when(F.coalesce(cond, F.lit(False)), F.lit(text))
    out = df.withColumns({
        "errors": F.array_compact(F.array(flag(full & (F.abs(a - (l + e)) > tolerance), "balance"))),
        "warnings": F.array_compact(F.array(
            flag(a.isNull() & l.isNotNull() & e.isNotNull(), "derived_assets"),
            flag(l.isNull() & a.isNotNull() & e.isNotNull(), "derived_liabilities"),
            flag(a.isNull() & l.isNull() & e.isNotNull(), "estimated_assets"),
            flag(F.abs(F.col("net_cash_change") - (F.col("cash_ending") - F.col("cash_beginning"))) > tolerance, "cash_change"),
            flag((F.col("basic_eps") != 0) & (F.col("basic_shares") != 0) & (F.abs(F.col("basic_eps") - F.col("net_income") / F.col("basic_shares")) > tolerance), "eps"),
        )),
    })
    return out.withColumns({
        "total_assets": F.coalesce(a, F.when(e.isNotNull(), F.coalesce(l, F.lit(0)) + e)),
        "total_liabilities": F.coalesce(l, F.when(e.isNotNull(), F.when(a.isNotNull(), a - e).otherwise(0))),
    })


def convert_currency(df: DataFrame, currency: str, rates: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Amounts in ``target``; ``rates`` hold ``currency, target, rate``. Rows without a rate get null amounts."""
    r = rates.filter(F.col("target") == target).select(F.col("currency").alias("_cur"), F.col("rate").alias("_rate"))
    rate = F.when(F.col(currency) == target, 1.0).otherwise(F.col("_rate"))
    out = df.join(r, F.col(currency) == F.col("_cur"), "left").withColumn("_rate", rate)
    return out.withColumns({c: F.col(c) * F.col("_rate") for c in columns}).withColumn(currency, F.lit(target)).drop("_cur", "_rate")


def trend(df: DataFrame, company: str, period: str, value: str) -> DataFrame:
    """Growth per period, variation and direction label of a metric."""
    step = F.row_number().over(Window.partitionBy(company).orderBy(period)) - 1
    g = df.withColumn("_i", step).groupBy(company).agg(
        F.count(value).alias("n"), F.min_by(value, "_i").alias("_first"), F.max_by(value, "_i").alias("_last"),
        F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"), F.regr_slope(F.col(value), F.col("_i")).alias("_slope"),
    )
    first, last, n, mean, slope = (F.col(c) for c in ("_first", "_last", "n", "_mean", "_slope"))
    growth = F.when((n >= 2) & (first != 0), F.when(n == 2, last / first - 1).otherwise(F.pow(last / first, 1 / (n - 1)) - 1))
    long = (
        F.when(slope > 0.05 * mean, "Strong upward trend").when(slope > 0.02 * mean, "Moderate upward trend")
        .when(slope < -0.05 * mean, "Strong downward trend").when(slope < -0.02 * mean, "Moderate downward trend").otherwise("Stable trend")
    )
    short = F.when(last > first, "Improving").when(last < first, "Declining").otherwise("Stable")
    return g.select(
        company, "n", growth.alias("growth_rate"), F.when(n < 2, 0.0).when(mean != 0, F.col("_std") / mean).otherwise(0.0).alias("volatility"),
        F.when(n < 2, "Insufficient data for trend analysis").when(n >= 3, long).otherwise(short).alias("trend"),
    )


def compare_to_industry(df: DataFrame, industry: Sequence[str], value: str) -> DataFrame:
    """Band of a metric among its industry's quartiles."""
    q = ranking.with_quantiles(df, industry, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    v = F.col(value)
    return q.withColumn("band", F.when(v >= F.col("q3"), "above 75th").when(v >= F.col("median"), "above median").when(v >= F.col("q1"), "above 25th").when(v.isNotNull(), "below 25th"))


def risk_band(value: Column, excellent: float, good: float, adequate: float, higher_is_better: bool = True) -> Column:
    hit = (lambda x: value >= x) if higher_is_better else (lambda x: value <= x)
    return F.when(hit(excellent) | hit(good), "LOW").when(hit(adequate), "MODERATE").otherwise("HIGH")


# ------------------------------------------------------------------------------------------------ multiples


def price_multiples(growth: Column | None = None) -> dict[str, Column]:
    """Needs ``price, eps, book_value_per_share, sales_per_share, dividend_per_share``."""
    pe = _over("price", "eps")
    out = {
        "pe": pe, "pb": _over("price", "book_value_per_share"), "ps": _over("price", "sales_per_share"),
        "dividend_yield": _over("dividend_per_share", "price"), "earnings_yield": _over("eps", "price"),
    }
    return {**out, "peg": _over(pe, growth * 100)} if growth is not None else out


def justified_multiples(payout: Column, required: Column, growth: Column, roe: Column, margin: Column) -> dict[str, Column]:
    gap = F.when(required > growth, required - growth)
    pe = payout / gap
    return {"leading_pe": pe, "trailing_pe": pe / (1 + growth), "pb": (roe - growth) / gap, "ps": pe * margin}


def enterprise_value(cap: Column, debt: Column, cash: Column, preferred: Column | float = 0.0) -> Column:
    return cap + debt - cash + preferred


def ev_multiples() -> dict[str, Column]:
    """Needs ``enterprise_value, revenue, ebitda, ebit, free_cash_flow``."""
    return {f"ev_{n}": _over("enterprise_value", c) for n, c in (("sales", "revenue"), ("ebitda", "ebitda"), ("ebit", "ebit"), ("fcf", "free_cash_flow"))}


def implied_share_value(multiple: Column, metric: Column, debt: Column, cash: Column, shares: Column, preferred: Column | float = 0.0) -> Column:
    return F.when(shares > 0, (multiple * metric - debt + cash - preferred) / shares).otherwise(0.0)


def comps_valuation(targets: DataFrame, stats_: DataFrame, keys: Sequence[str], metrics: Mapping[str, str]) -> DataFrame:
    """Implied values of each target from its peers' multiples: one row per target and multiple.

    ``stats_`` is the output of ``multiple_statistics``; ``metrics`` names the target column each multiple applies to.
    """
    long = targets.select("*", F.explode(F.array(*[F.struct(F.lit(m).alias("multiple"), F.col(c).cast("double").alias("metric")) for m, c in metrics.items()])).alias("_m"))
    long = long.select(*targets.columns, "_m.*")
    s = stats_.select(*keys, "multiple", "median", "mean", "q1", "q3")
    j = long.join(s, [*keys, "multiple"]).filter(F.col("metric") != 0)
    return j.select(*targets.columns, "multiple", *[(F.col("metric") * F.col(c)).alias(f"value_{c}") for c in ("median", "mean", "q1", "q3")])


def regression(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Line of y on x over rows where both are positive; groups with at least three."""
    rows = df.filter((F.col(x) > 0) & (F.col(y) > 0) & ~F.isnan(x) & ~F.isnan(y))
    xs, ys = F.col(x), F.col(y)
    g = rows.groupBy(*keys).agg(
        F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"), F.regr_r2(ys, xs).alias("r_squared"), F.count("*").alias("data_points")
    )
    return g.filter(F.col("data_points") >= 3)


# ------------------------------------------------------------------------------------------------ offers


def offer_premiums(offers: DataFrame, bars: DataFrame, axis: Axis) -> DataFrame:
    """Premium of each offer (``symbol, ts, offer_price``) over price history strictly before it.

    Averages of the last 1, 5, 20, 60 bars, the 30-bar VWAP and the 252-bar range are computed once per bar with
    bounded frames, the long ones put together from short ones; an as-of join fetches them. Short histories fall back
    to the shorter average.
    """
    def short(w):
        past = lambda n: trailing(w, n)
        return {
            "_s": F.sum("close").over(past(5)), "_c": F.count("close").over(past(5)), "_v": F.sum("volume").over(past(5)),
            "_cv": F.sum(F.col("close") * F.col("volume")).over(past(5)), "_high": F.max("high").over(past(18)), "_low": F.min("low").over(past(18)),
        }

    def history(w):
        parts = lambda c, n: stretch(c, w, 5, n // 5)
        mean = lambda n: F.when(added(parts("_c", n)) == n, added(parts("_s", n)) / n)
        a5 = F.coalesce(mean(5), F.col("close"))
        a20 = F.coalesce(mean(20), a5)
        return {
            "avg_1": F.col("close"), "avg_5": a5, "avg_20": a20, "avg_60": F.coalesce(mean(60), a20),
            "vwap_30": F.try_divide(added(parts("_cv", 30)), added(parts("_v", 30))),
            "high_52w": F.greatest(*stretch("_high", w, 18, 14)), "low_52w": F.least(*stretch("_low", w, 18, 14)),
        }

    names = ["avg_1", "avg_5", "avg_20", "avg_60", "vwap_30", "high_52w", "low_52w"]
    bars = bars.select(*axis.key, *axis.order, "high", "low", "close", "volume")
    base = over_blocks(bars, axis, [short, history], back=252).select(*axis.key, *axis.order, *names)
    found = joins.asof(offers, base, axis, names, strict=True)
    pct = lambda c: F.when(F.col(c) > 0, (F.col("offer_price") - F.col(c)) / F.col(c) * 100).otherwise(F.when(F.col(c).isNotNull(), 0.0))
    out = found.withColumns({f"premium_{c}": pct(c) for c in names})
    width = F.col("high_52w") - F.col("low_52w")
    return out.withColumns({
        "range_position": F.when(width > 0, (F.col("offer_price") - F.col("low_52w")) / width * 100).otherwise(0.0),
        "above_high": F.col("offer_price") > F.col("high_52w"),
    })


def historical_premiums(offers: DataFrame, bars: DataFrame, axis: Axis, days: Mapping[str, int]) -> DataFrame:
    """Premium over the last close at least so many days before the offer, one column per look-back, in one as-of join."""
    ts = axis.order[0]
    looks = F.explode(F.array(*[F.struct(F.lit(n).alias("look"), F.lit(d).alias("days")) for n, d in days.items()]))
    asked = offers.withColumn("_l", looks).select(*[c for c in offers.columns if c != ts], F.col(ts).alias("offered"), F.col("_l.look").alias("look"), (F.col(ts) - F.make_dt_interval(F.col("_l.days"))).alias(ts))
    found = joins.asof(asked, bars.select(*axis.key, ts, "close"), axis, ["close"])
    rest = [c for c in offers.columns if c != ts]
    premium = F.when(F.col("close") > 0, (F.col("offer_price") - F.col("close")) / F.col("close") * 100)
    return found.groupBy(*rest, F.col("offered").alias(ts)).pivot("look", list(days)).agg(F.first(premium))


def benchmark_position(premium: Column, industry: Column) -> Column:
    """Quarter of the industry's usual one-day premiums."""
    q = lambda i: F.coalesce(F.element_at(F.create_map(*[x for k, v in acc.PREMIUM_BENCHMARKS.items() for x in (F.lit(k), F.lit(v[i]))]), F.lower(industry)), F.lit(acc.PREMIUM_BENCHMARKS["general"][i]))
    return F.when(premium < q(0), "below 25th").when(premium < q(1), "25th to 50th").when(premium < q(2), "50th to 75th").when(premium.isNotNull(), "above 75th")


# ------------------------------------------------------------------------------------------------ discounted cash flow


def project(base: Column, growth: Column) -> Column:
    """Cash flows grown from ``base`` by an array of rates."""
    start = F.struct(base.cast("double").alias("last"), F.array().cast("array<double>").alias("all"))

    def step(s, g):
        nxt = s["last"] * (1 + g)
        return F.struct(nxt.alias("last"), F.concat(s["all"], F.array(nxt)).alias("all"))

    return F.aggregate(growth, start, step)["all"]


def present_value(flows: Column, rate: Column, mid_year: bool = False) -> Column:
    shift = 0.5 if mid_year else 0.0
    pv = F.transform(flows, lambda f, i: f / F.pow(1 + rate, i + 1 - shift))
    return F.aggregate(pv, F.lit(0.0), lambda s, x: s + x)


def dcf(flows: str, wacc: Column, terminal_growth: Column, mid_year: bool = False) -> dict[str, Column]:
    """Enterprise value with a perpetuity; null where wacc does not exceed the growth."""
    f = F.col(flows)
    last = F.element_at(f, -1)
    terminal = F.when(wacc > terminal_growth, last * (1 + terminal_growth) / (wacc - terminal_growth))
    pv_t = terminal / F.pow(1 + wacc, F.size(f) - (0.5 if mid_year else 0.0))
    pv = present_value(f, wacc, mid_year)
    ev = pv + pv_t
    return {"pv_of_fcf": pv, "terminal_value": terminal, "pv_of_terminal_value": pv_t, "enterprise_value": ev, "terminal_share": F.when(ev > 0, pv_t / ev * 100).otherwise(0.0)}


def simulated_dcf(
    companies: DataFrame, key: str, base: str, years: int, runs: int,
    growth: tuple[float, float], terminal: tuple[float, float], wacc: tuple[float, float], seed: int = 0,
) -> DataFrame:
    """Distribution of the value per company over ``runs`` scenarios drawn from hashes of (seed, company, run, draw)."""
    from candlewick.operators.risk import gaussian

    draws = companies.select(key, F.col(base).alias("_base"), F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    z = lambda i: gaussian(F.lit(seed), F.col(key), F.col("run"), F.lit(i))
    draws = draws.withColumns({
        "_g": F.array(*[growth[0] + growth[1] * z(i) for i in range(years)]),
        "_t": F.least(F.greatest(terminal[0] + terminal[1] * z(years), F.lit(0.0)), F.lit(0.06)),
        "_w": F.least(F.greatest(wacc[0] + wacc[1] * z(years + 1), F.lit(0.05)), F.lit(0.20)),
    })
    draws = draws.withColumn("_f", project(F.col("_base"), F.col("_g")))
    value = dcf("_f", F.col("_w"), F.col("_t"))["enterprise_value"]
    valued = draws.withColumn("value", value)
    pct = {f"p{p}": F.percentile("value", p / 100) for p in (5, 10, 25, 50, 75, 90, 95)}  # ``runs`` values per group
    return valued.groupBy(key).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), *[c.alias(n) for n, c in pct.items()]
    )


# ------------------------------------------------------------------------------------------------ bonds


def bond_price(ytm: Column, face: Column, coupon: Column, years: Column, frequency: int = 2) -> Column:
    """Price from the annuity formula; ``frequency`` 0 is a zero-coupon bond."""
    if frequency == 0:
        return face / F.pow(1 + ytm, years)
    n = F.floor(years * frequency)
    y, c = ytm / frequency, coupon * face / frequency
    down = F.pow(1 + y, -n)
    return F.when(F.abs(y) > 1e-14, c * (1 - down) / y).otherwise(c * n) + face * down


def _halve(f, low: float, high: float, n: int, steps: int) -> np.ndarray:
    """Root of a falling function per row by halving an interval; nan where the interval holds none."""
    lo, hi = np.full(n, low), np.full(n, high)
    with np.errstate(all="ignore"):
        inside = (f(lo) >= 0) & (f(hi) <= 0)
        for _ in range(steps):
            mid = (lo + hi) / 2
            above = f(mid) > 0
            lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return np.where(inside, (lo + hi) / 2, np.nan)


def bond_yield(price: Column, face: Column, coupon: Column, years: Column, frequency: int = 2, steps: int = 60) -> Column:
    """Yield to maturity by ``steps`` halvings of [-0.99, 2]; null where the price is not reached inside."""

    @F.pandas_udf("double")
    def solve(p: pd.Series, f: pd.Series, c: pd.Series, t: pd.Series) -> pd.Series:
        p, f, c, t = (x.to_numpy(float) for x in (p, f, c, t))
        n, pay = np.floor(t * frequency), c * f / max(frequency, 1)

        def gap(y):
            if frequency == 0:
                return f / (1 + y) ** t - p
            q = y / frequency
            down = (1 + q) ** -n
            return np.where(np.abs(q) > 1e-14, pay * (1 - down) / np.where(q == 0, 1, q), pay * n) + f * down - p

        return pd.Series(_halve(gap, -0.99, 2.0, len(p), steps))

    out = solve(price.cast("double"), face.cast("double"), coupon.cast("double"), years.cast("double"))
    return F.when(~F.isnan(out), out)


def bond_duration(ytm: Column, face: Column, coupon: Column, years: Column, frequency: int = 2) -> dict[str, Column]:
    """Price, Macaulay and modified duration, convexity of the cash flows.

    The weighted sums of the discount factors are geometric; near a zero rate, where the closed form cancels, they
    are added up flow by flow.
    """
    if frequency == 0:
        p = bond_price(ytm, face, coupon, years, 0)
        return {"price": p, "macaulay": years.cast("double"), "modified": years / (1 + ytm), "convexity": years * (years + 1) / F.pow(1 + ytm, 2)}
    n, y, c = F.floor(years * frequency), ytm / frequency, coupon * face / frequency
    v = 1 / (1 + y)
    vn = F.pow(v, n)
    s1 = v * (1 - (n + 1) * vn + n * vn * v) / F.pow(1 - v, 2)
    s2 = v * (1 + v - F.pow(n + 1, 2) * vn + (2 * n * n + 2 * n - 1) * vn * v - n * n * vn * v * v) / F.pow(1 - v, 3)
    flows = F.sequence(F.lit(1).cast("long"), n)
    add = lambda g: F.aggregate(flows, F.lit(0.0), lambda s, t: s + g(t) * F.pow(v, t))
    small = F.abs(y) < 1e-2
    s1 = F.when(small, add(lambda t: t)).otherwise(s1)
    s2 = F.when(small, add(lambda t: t * t)).otherwise(s2)
    price = bond_price(ytm, face, coupon, years, frequency)
    macaulay = (c * s1 + n * face * vn) / frequency / price
    convexity = (c * (s1 + s2) + n * (n + 1) * face * vn) / (price * F.pow(1 + y, 2) * frequency**2)
    live = lambda x: F.when(n >= 1, x)
    return {"price": live(price), "macaulay": live(macaulay), "modified": live(macaulay / (1 + y)), "convexity": live(convexity)}


def bond_portfolio(holdings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Market-value weighted duration, convexity, yield, maturity and price sensitivity per portfolio."""
    mean = lambda c: (F.sum(F.col(c) * F.col("market_value")) / F.sum("market_value")).alias(f"portfolio_{c}")
    g = holdings.groupBy(*keys).agg(F.sum("market_value").alias("total_market_value"), F.count("*").alias("num_holdings"), *[mean(c) for c in ("duration", "convexity", "ytm", "maturity")])
    mv, d, x = F.col("total_market_value"), F.col("portfolio_duration"), 0.5 * F.col("portfolio_convexity") * 0.01**2 * F.col("total_market_value")
    return g.filter(mv != 0).withColumns({
        "dollar_duration": d * mv / 100, "dv01": d * mv * 0.0001, "convexity_adjustment": x, "up_100bp": -d * 0.01 * mv + x, "down_100bp": d * 0.01 * mv + x,
    })


def duration_contributions(holdings: DataFrame, keys: Sequence[str]) -> DataFrame:
    total = holdings.groupBy(*keys).agg(F.sum("market_value").alias("_total"))
    h = holdings.join(total, list(keys)).filter(F.col("_total") != 0)
    return h.withColumn("weight", F.col("market_value") / F.col("_total")).withColumn("contribution", F.col("weight") * F.col("duration")).drop("_total")


def key_rate_exposure(holdings: DataFrame, keys: Sequence[str], tenors: Sequence[float] = (1, 2, 3, 5, 7, 10, 20, 30)) -> DataFrame:
    """Market value and duration share per key rate, cut half-way between tenors; tenors without holdings give no row."""
    cut = F.lit(float(tenors[-1]))
    for low, high in reversed(list(zip(tenors, tenors[1:]))):
        cut = F.when(F.col("maturity") <= (low + high) / 2, float(low)).otherwise(cut)
    total = holdings.groupBy(*keys).agg(F.sum("market_value").alias("_total"))
    g = holdings.groupBy(*keys, cut.alias("key_rate")).agg(F.sum("market_value").alias("market_value"), F.sum(F.col("duration") * F.col("market_value")).alias("_d"))
    j = g.join(total, list(keys))
    return j.withColumns({"weight": F.col("market_value") / F.col("_total"), "duration_contribution": F.col("_d") / F.col("_total")}).drop("_total", "_d")


# ------------------------------------------------------------------------------------------------ curves


def curves(df: DataFrame, keys: Sequence[str], tenor: str, rate: str) -> DataFrame:
    """One row per curve with its points in tenor order; a curve has one point per tenor."""
    points = df.groupBy(*keys, F.col(tenor).cast("double").alias("t")).agg(F.avg(rate).alias("r"))
    return points.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("t", "r"))).alias("points"))


def interpolated(points: Column, target: Column) -> Column:
    """Rate at a tenor on the line between its neighbours, the outer segments extended; null for fewer than two points."""
    below = F.size(F.filter(points, lambda p: p["t"] <= target))
    i = F.greatest(F.least(below, F.size(points) - 1), F.lit(1))
    a, b = F.get(points, i - 1), F.get(points, i)
    return a["r"] + (b["r"] - a["r"]) * (target - a["t"]) / (b["t"] - a["t"])


def forward_rates(df: DataFrame) -> DataFrame:
    """Forward rate of each segment between neighbouring tenors."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("points") - 1),
        lambda i: F.struct(F.get("points", i - 1).alias("a"), F.get("points", i).alias("b")),
    )
    out = df.filter(F.size("points") > 1).withColumn("_p", F.explode(pairs))
    a, b = F.col("_p.a"), F.col("_p.b")
    rate = F.pow(F.pow(1 + b["r"], b["t"]) / F.pow(1 + a["r"], a["t"]), 1 / (b["t"] - a["t"])) - 1
    return out.withColumns({"start": a["t"], "end": b["t"], "forward_rate": rate}).drop("_p")


def curve_shape(df: DataFrame) -> DataFrame:
    at = lambda i: F.get("points", i)
    d = df.withColumns({"short_rate": at(F.lit(0))["r"], "mid_rate": at(F.floor(F.size("points") / 2).cast("int"))["r"], "long_rate": at(F.size("points") - 1)["r"]})
    s, m, l = F.col("short_rate"), F.col("mid_rate"), F.col("long_rate")
    span = at(F.size("points") - 1)["t"] - at(F.lit(0))["t"]
    return d.withColumns({
        "slope": l - s, "steepness": F.when(span != 0, (l - s) / span).otherwise(0.0),
        "shape": F.when((m > s) & (m > l), "Humped").when((m < s) & (m < l), "U-Shaped").when(l - s > 0.005, "Normal").when(l - s < -0.005, "Inverted").otherwise("Flat"),
    })


# ------------------------------------------------------------------------------------------------ options


def black_scholes(df: DataFrame, spot: str, strike: str, years: str, rate: str, vol: str, kind: str) -> DataFrame:
    """Price, Greeks, intrinsic and time value of an option table; vega and rho per one percent, theta per day."""
    s, k, t, r, v = (F.col(c) for c in (spot, strike, years, rate, vol))
    call = F.lower(kind) == "call"
    d = df.withColumn("_root", v * F.sqrt(t)).withColumn("d1", (F.log(s / k) + (r + v * v / 2) * t) / F.col("_root"))
    d = d.withColumns({"d2": F.col("d1") - F.col("_root"), "_sign": F.when(call, 1.0).otherwise(-1.0), "_disc": k * F.exp(-r * t), "_pdf": stats.normal_pdf(F.col("d1"))})
    d = d.withColumns({"_n1": stats.normal_cdf_once(F.col("_sign") * F.col("d1")), "_n2": stats.normal_cdf_once(F.col("_sign") * F.col("d2"))})
    sign, n1, n2, pdf, disc = (F.col(c) for c in ("_sign", "_n1", "_n2", "_pdf", "_disc"))
    price = sign * (s * n1 - disc * n2)
    intrinsic = F.greatest(sign * (s - k), F.lit(0.0))
    d = d.withColumns({
        "option_price": price, "delta": sign * n1, "gamma": pdf / (s * F.col("_root")), "vega": s * pdf * F.sqrt(t) / 100,
        "theta": (-s * pdf * v / (2 * F.sqrt(t)) - sign * r * disc * n2) / 365, "rho": disc * t * n2 / 100, "intrinsic_value": intrinsic, "time_value": price - intrinsic,
    })
    return d.drop("_root", "_sign", "_disc", "_pdf", "_n1", "_n2")


def implied_volatility(price: Column, spot: Column, strike: Column, years: Column, rate: Column, kind: Column, steps: int = 50) -> Column:
    """Volatility in (0, 5] by halving; null where no volatility in the range gives the price."""

    @F.pandas_udf("double")
    def solve(p: pd.Series, s: pd.Series, k: pd.Series, t: pd.Series, r: pd.Series, call: pd.Series) -> pd.Series:
        p, s, k, t, r = (x.to_numpy(float) for x in (p, s, k, t, r))
        sign, root, disc = np.where(call.to_numpy(bool), 1.0, -1.0), np.sqrt(t), k * np.exp(-r * t)

        def gap(v):
            d1 = (np.log(s / k) + (r + v * v / 2) * t) / (v * root)
            return p - sign * (s * stats.normal_cdf_array(sign * d1) - disc * stats.normal_cdf_array(sign * (d1 - v * root)))

        return pd.Series(_halve(gap, 1e-6, 5.0, len(p), steps))

    out = solve(*[x.cast("double") for x in (price, spot, strike, years, rate)], F.coalesce(F.lower(kind) == "call", F.lit(False)))
    return F.when(~F.isnan(out), out)


# ------------------------------------------------------------------------------------------------ currencies


def covered_parity(spot: Column, forward: Column, domestic: Column, foreign: Column, years: Column) -> dict[str, Column]:
    fair = spot * (1 + domestic * years) / (1 + foreign * years)
    gap = (forward - fair) / fair * 100
    return {"theoretical_forward": fair, "deviation": forward - fair, "deviation_pct": gap, "parity_holds": F.abs(gap) < 0.05, "arbitrage": F.abs(gap) > 0.1}


def forward_premium(spot: Column, forward: Column, years: Column) -> Column:
    """Annualised premium (discount) of the forward in percent."""
    return (forward - spot) / spot / years * 100


def carry_return(funding: Column, target: Column, fx_change: Column, years: Column, leverage: float = 1.0) -> dict[str, Column]:
    total = (target - funding) * years + fx_change
    return {"rate_differential": target - funding, "interest_income": (target - funding) * years, "total_return": total, "leveraged_return": total * leverage, "annualized_return": total * leverage / years}
