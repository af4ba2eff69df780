"""Technical indicator queries."""

import math

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import indicators as ind
from candlewick.operators.series import HOURLY, span_alpha
from candlewick.plans.registry import near, query, r, rs
from candlewick.plans.sql import HOURLY as HOURLY_SQL
from candlewick.plans.sql import NUMBERED, ewm, with_

W = "PARTITION BY symbol ORDER BY ts"
BASE = """g AS (SELECT *, lag(close) OVER w AS pc, lag(high) OVER w AS ph, lag(low) OVER w AS pl, lag(volume) OVER w AS pv, (high + low + close) / 3.0 AS tp, (high + low) / 2 AS mid
  FROM nb WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
b AS (SELECT *, close - pc AS d, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, lag(tp) OVER (PARTITION BY symbol ORDER BY ts) AS ptp FROM g)"""


def wn(n):
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(fn, x, n):
    """Full-frame rolling aggregate."""
    return f"CASE WHEN count({x}) OVER {wn(n)} = {n} THEN {fn}({x}) OVER {wn(n)} END"


def avg(x, n):
    return roll("avg", x, n)


def ssum(x, n):
    return roll("sum", x, n)


def hi(x, n):
    return roll("max", x, n)


def lo(x, n):
    return roll("min", x, n)


def lwma(x, n):
    return "(" + " + ".join(f"lag({x}, {n - i}) OVER ({W}) * {i}" for i in range(1, n + 1)) + f") / {n * (n + 1) / 2}"


def show(spark, sf, wanted, digits=6, fine=()):
    """Compute indicators on hourly bars and keep their columns."""
    out = ind.compute(fx.hourly(spark, sf), wanted, HOURLY)
    names = [c for a, (n, _) in wanted.items() for c in ind.outputs_of(a, n).values()]
    return near(out, *[n for n in names if n not in fine], digits=digits).select("symbol", "ts", *names)


def register(name, covers, wanted, ctes, select, digits=6, fine=()):
    """One query over hourly bars: ``ctes`` after the base, ``select`` maps result columns to SQL."""
    cols = ", ".join(f"{e if c in fine else r(e, digits)} AS {c}" for c, e in select.items())
    last = ctes[-1].split(" AS ")[0].strip() if ctes else "b"
    sql = with_(HOURLY_SQL, NUMBERED, BASE, *ctes, f"SELECT symbol, ts, {cols} FROM {last}")
    query(name, covers, sql)(lambda spark, sf: show(spark, sf, wanted, digits, fine))


def E(x, n, **k):
    return ewm(x, span_alpha(n), **k)


register(
    "ema_family", "I1",
    {"ema": ("ema", {"period": 20}), "dema": ("dema", {"period": 10}), "tema": ("tema", {"period": 10})},
    [
        f"s1 AS (SELECT *, {E('close', 20)} AS ema, {E('close', 10)} AS e1 FROM b)",
        f"s2 AS (SELECT *, {E('e1', 10)} AS e2 FROM s1)",
        f"s3 AS (SELECT *, {E('e2', 10)} AS e3 FROM s2)",
    ],
    {"ema": "ema", "dema": "2 * e1 - e2", "tema": "3 * e1 - 3 * e2 + e3"},
)
register("rma", "I2", {"rma": ("rma", {"period": 14})}, [], {"rma": ewm("close", 1 / 14)})
register(
    "weighted_averages", "I3",
    {"sma": ("sma", {"period": 20}), "wma": ("wma", {"period": 9}), "hma": ("hma", {"period": 9})},
    [f"s1 AS (SELECT *, 2 * {lwma('close', 4)} - {lwma('close', 9)} AS raw FROM b)"],
    {"sma": avg("close", 20), "wma": lwma("close", 9), "hma": lwma("raw", 3)},
)
register(
    "tma_vwma", "I4", {"tma": ("tma", {"period": 10}), "vwma": ("vwma", {"period": 20})},
    [f"s1 AS (SELECT *, {avg('close', 10)} AS s FROM b)"],
    {"tma": avg("s", 10), "vwma": f"({ssum('close * volume', 20)}) / nullif({ssum('volume', 20)}, 0)"},
)


def _recursive(first, step, cols, filt="true", base="b"):
    """Recursive twin of a per-row recurrence over consecutive row numbers ``k``."""
    return (
        f"n AS (SELECT *, row_number() OVER ({W}) AS k FROM {base} WHERE {filt}), "
        f"rec AS (SELECT symbol, ts, k, {first} FROM n WHERE k = 1 UNION ALL SELECT n.symbol, n.ts, n.k, {step} FROM rec p JOIN n ON n.symbol = p.symbol AND n.k = p.k + 1)"
    ), cols


def recursive(*parts):
    return "WITH RECURSIVE " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


KAMA_SQL = f"""s1 AS (SELECT *, abs(d) AS ad, lag(close, 10) OVER ({W}) AS c10 FROM b),
s2 AS (SELECT *, {ssum('ad', 10)} AS path FROM s1), s3 AS (SELECT *, power(CASE WHEN path <> 0 THEN abs(close - c10) / path WHEN path IS NOT NULL THEN 0 END * ({2 / 3!r} - {2 / 31!r}) + {2 / 31!r}, 2) AS sc FROM s2)"""


def _scan_sql(pre, alpha, out, base):
    rec, _ = _recursive("close AS y", f"p.y + n.{alpha} * (n.close - p.y)", (), f"{alpha} IS NOT NULL", base)
    return recursive(HOURLY_SQL, NUMBERED, BASE, pre, rec, f"SELECT nb.symbol, nb.ts, {r('y')} AS {out} FROM nb LEFT JOIN rec ON nb.symbol = rec.symbol AND nb.ts = rec.ts")


@query("kama", "I5", _scan_sql(KAMA_SQL, "sc", "kama", "s3"))
def kama(spark, sf):
    return near(ind.kama(fx.hourly(spark, sf)), "kama").select("symbol", "ts", "kama")




_ALMA = [math.exp(-((i - 0.85 * 8) ** 2) / (2 * (9 / 6.0) ** 2)) for i in range(9)]
register(
    "alma_zlema_t3", "I6",
    {"alma": ("alma", {}), "zlema": ("zlema", {"period": 9}), "t3": ("t3", {})},
    [
        f"s0 AS (SELECT *, 2 * close - coalesce(lag(close, 4) OVER ({W}), close) AS x FROM b)",
        f"s1 AS (SELECT *, {E('x', 9)} AS zl, {E('close', 5)} AS e1 FROM s0)",
        *[f"s{i} AS (SELECT *, {E(f'e{i - 1}', 5)} AS e{i} FROM s{i - 1})" for i in range(2, 7)],
    ],
    {
        "alma": "(" + " + ".join(f"lag(close, {8 - i}) OVER ({W}) * {x / sum(_ALMA)!r}" for i, x in enumerate(_ALMA)) + ")",
        "zlema": "zl",
        "t3": f"{-0.7 ** 3!r} * e6 + {3 * 0.7 ** 2 + 3 * 0.7 ** 3!r} * e5 + {-6 * 0.7 ** 2 - 3 * 0.7 - 3 * 0.7 ** 3!r} * e4 + {1 + 3 * 0.7 + 0.7 ** 3 + 3 * 0.7 ** 2!r} * e3",
    },
)


MARKET = "market AS (SELECT 'market' AS symbol, ts, avg(close) AS close, row_number() OVER (ORDER BY ts) AS rn FROM bars GROUP BY ts)"


@query(
    "mcginley", "I6",
    recursive(
        HOURLY_SQL, MARKET,
        _recursive("close AS y", "p.y + (n.close - p.y) / (0.6 * 14 * power(n.close / p.y, 4))", (), base="market")[0],
        f"SELECT symbol, ts, {r('y', 4)} AS mcginley FROM rec",
    ),
)
def mcginley(spark, sf):
    """Over the mean close of all symbols (the recurrence diverges on single series that fall tenfold in a bar)."""
    market = fx.hourly(spark, sf).groupBy("ts").agg(F.avg("close").alias("close")).withColumn("symbol", F.lit("market"))
    return near(ind.mcginley(market), "mcginley", digits=4).select("symbol", "ts", "mcginley")


@query(
    "negative_volume_index", "I26",
    with_(HOURLY_SQL, NUMBERED, BASE, f"SELECT symbol, ts, {r(f'ln(1000) + sum(CASE WHEN volume < pv THEN ln(close / pc) ELSE 0 END) OVER ({W} ROWS UNBOUNDED PRECEDING)')} AS log_nvi FROM b"),
)
def negative_volume_index(spark, sf):
    out = ind.compute(fx.hourly(spark, sf), {"nvi": ("nvi", {})})
    return near(out.select("symbol", "ts", F.log("nvi").alias("log_nvi")), "log_nvi")


FRAMA_SQL = f"""s1 AS (SELECT *, ({hi('close', 10)} - {lo('close', 10)}) / 10 AS n1, ({hi('close', 20)} - {lo('close', 20)}) / 20 AS n3 FROM b),
s2 AS (SELECT *, n1 + lag(n1, 10) OVER ({W}) AS bth FROM s1), s3 AS (SELECT *, CASE WHEN bth <> 0 AND n3 <> 0 THEN greatest(least(exp(-4.6 * ((ln(bth) - ln(n3)) / ln(2) - 1)), 1), 0.01) END AS al FROM s2)"""


@query("frama", "I7", _scan_sql(FRAMA_SQL, "al", "frama", "s3"))
def frama(spark, sf):
    return near(ind.frama(fx.hourly(spark, sf)), "frama").select("symbol", "ts", "frama")


VIDYA_SQL = f"""s1 AS (SELECT *, CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS up, CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END AS dn FROM b), s2 AS (SELECT *, {ssum('up', 14)} AS su, {ssum('dn', 14)} AS sd FROM s1),
s3 AS (SELECT *, {2 / 15!r} * abs(coalesce((su - sd) / nullif(su + sd, 0), CASE WHEN su IS NOT NULL THEN 0 END)) AS al FROM s2)"""


@query("vidya", "I7", _scan_sql(VIDYA_SQL, "al", "vidya", "s3"))
def vidya(spark, sf):
    return near(ind.vidya(fx.hourly(spark, sf)), "vidya").select("symbol", "ts", "vidya")


@query("evwma", "I7", _scan_sql(f"s1 AS (SELECT *, volume / nullif({ssum('volume', 20)}, 0) AS al FROM b)", "al", "evwma", "s1"))
def evwma(spark, sf):
    return near(ind.evwma(fx.hourly(spark, sf)), "evwma").select("symbol", "ts", "evwma")


register(
    "vama", "I7", {"vama": ("vama", {"period": 20})},
    [f"s1 AS (SELECT *, volume * close / nullif({avg('volume', 20)}, 0) AS vr FROM b)"],
    {"vama": f"({ssum('vr * close', 20)}) / nullif({ssum('vr', 20)}, 0)"},
)

RSI = f"s1 AS (SELECT *, greatest(coalesce(d, 0), 0) AS up, greatest(-coalesce(d, 0), 0) AS dn FROM b), s2 AS (SELECT *, 100 - 100 / (1 + ({avg('up', 14)}) / nullif({avg('dn', 14)}, 0)) AS rsi FROM s1)"
register(
    "rsi", "I8", {"rsi": ("rsi", {}), "rsi_wilder": ("rsi_wilder", {})},
    [RSI, f"s3 AS (SELECT *, {ewm('CASE WHEN d IS NOT NULL THEN up END', 1 / 14)} AS ag, {ewm('CASE WHEN d IS NOT NULL THEN dn END', 1 / 14)} AS al FROM s2)"],
    {"rsi": "rsi", "rsi_wilder": "CASE WHEN rn > 14 THEN 100 - 100 / (1 + ag / nullif(al, 0)) END"},
)
register(
    "stochastic_williams", "I9",
    {"stoch": ("stochastic", {}), "stoch_rsi": ("stoch_rsi", {}), "willr": ("williams_r", {})},
    [
        RSI,
        f"s3 AS (SELECT *, {lo('low', 14)} AS l14, {hi('high', 14)} AS h14, {lo('rsi', 14)} AS rl, {hi('rsi', 14)} AS rh FROM s2)",
        "s4 AS (SELECT *, (close - l14) / nullif(h14 - l14, 0) * 100 AS k FROM s3)",
    ],
    {"stoch_k": "k", "stoch_d": avg("k", 3), "stoch_rsi": "(rsi - rl) / nullif(rh - rl, 0) * 100", "willr": "-100 * (h14 - close) / nullif(h14 - l14, 0)"},
)
register(
    "roc_momentum_cmo", "I10",
    {"roc": ("roc", {"period": 12}), "mom": ("momentum", {"period": 10}), "cmo": ("cmo", {}), "chg": ("change_pct", {})},
    [f"s1 AS (SELECT *, CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS up, CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END AS dn FROM b), s2 AS (SELECT *, {ssum('up', 14)} AS su, {ssum('dn', 14)} AS sd FROM s1)".split(", s2 AS")[0],
     f"s2 AS (SELECT *, {ssum('up', 14)} AS su, {ssum('dn', 14)} AS sd, lag(close, 12) OVER ({W}) AS c12, lag(close, 10) OVER ({W}) AS c10 FROM s1)"],
    {"roc": "(close - c12) / c12 * 100", "mom": "(close / c10 - 1) * 100", "cmo": "100 * (su - sd) / nullif(su + sd, 0)", "chg": "coalesce((close / pc - 1) * 100, 0)"},
    digits=4,
)
register(
    "macd", "I11", {"macd": ("macd", {})},
    [f"s1 AS (SELECT *, {E('close', 12)} - {E('close', 26)} AS line FROM b)", f"s2 AS (SELECT *, {E('line', 9)} AS sig FROM s1)"],
    {"macd_line": "line", "macd_signal": "sig", "macd_histogram": "line - sig"},
)
register(
    "ppo_pvo", "I11", {"ppo": ("ppo", {}), "pvo": ("pvo", {})},
    [
        f"s1 AS (SELECT *, {E('close', 26)} AS cs, {E('volume', 26)} AS vs, {E('close', 12)} AS cf, {E('volume', 12)} AS vf FROM b)",
        "s2 AS (SELECT *, (cf - cs) / cs * 100 AS p, (vf - vs) / vs * 100 AS q FROM s1)",
        f"s3 AS (SELECT *, {E('p', 9)} AS ps, {E('q', 9)} AS qs FROM s2)",
    ],
    {"ppo_line": "p", "ppo_signal": "ps", "ppo_histogram": "p - ps", "pvo_line": "q", "pvo_signal": "qs", "pvo_histogram": "q - qs"},
)
register(
    "tsi_trix", "I12", {"tsi": ("tsi", {}), "trix": ("trix", {})},
    [
        f"s1 AS (SELECT *, {E('d', 25)} AS d1, {E('abs(d)', 25)} AS a1, {E('close', 15)} AS e1 FROM b)",
        f"s2 AS (SELECT *, {E('d1', 13)} AS d2, {E('a1', 13)} AS a2, {E('e1', 15)} AS e2 FROM s1)",
        f"s3 AS (SELECT *, {E('e2', 15)} AS e3 FROM s2)",
        f"s4 AS (SELECT *, (e3 / lag(e3) OVER ({W}) - 1) * 100 AS tx FROM s3)",
    ],
    {"tsi": "100 * d2 / nullif(a2, 0)", "trix_value": "tx", "trix_signal": E("tx", 9)},
)
register(
    "kst_coppock", "I12", {"kst": ("kst", {}), "coppock": ("coppock", {})},
    [
        "s1 AS (SELECT *, " + ", ".join(f"close / lag(close, {n}) OVER ({W}) - 1 AS r{n}" for n in (10, 11, 14, 15, 20, 30)) + " FROM b)",
        f"s2 AS (SELECT *, 100 * ({avg('r10', 10)} + 2 * {avg('r15', 10)} + 3 * {avg('r20', 10)} + 4 * {avg('r30', 15)}) AS kst, (r14 + r11) * 100 AS cx FROM s1)",
    ],
    {"kst_value": "kst", "kst_signal": avg("kst", 9), "coppock": lwma("cx", 10)},
    digits=4,
)
STC_ST = "100 * ({x} - {lo}) / nullif({hi} - {lo}, 0)"
register(
    "schaff_cycle", "I12", {"stc": ("stc", {})},
    [
        f"s1 AS (SELECT *, {E('close', 23)} - {E('close', 50)} AS m FROM b)",
        f"s2 AS (SELECT *, {lo('m', 10)} AS ml, {hi('m', 10)} AS mh FROM s1)",
        "s3 AS (SELECT *, 100 * (m - ml) / nullif(mh - ml, 0) AS sk FROM s2)",
        f"s4 AS (SELECT *, {E('sk', 3)} AS sd FROM s3)",
        f"s5 AS (SELECT *, {lo('sd', 10)} AS dl, {hi('sd', 10)} AS dh FROM s4)",
        "s6 AS (SELECT *, 100 * (sd - dl) / nullif(dh - dl, 0) AS skd FROM s5)",
    ],
    {"stc": E("skd", 3)},
)
register(
    "ultimate_awesome", "I13", {"uo": ("ultimate", {}), "ao": ("awesome", {})},
    ["s1 AS (SELECT *, close - least(low, pc) AS bp, greatest(high, pc) - least(low, pc) AS t FROM b)"],
    {
        "uo": f"100 * (4 * ({ssum('bp', 7)}) / nullif({ssum('t', 7)}, 0) + 2 * ({ssum('bp', 14)}) / nullif({ssum('t', 14)}, 0) + ({ssum('bp', 28)}) / nullif({ssum('t', 28)}, 0)) / 7",
        "ao": f"({avg('mid', 5)}) - ({avg('mid', 34)})",
    },
)
register(
    "cci_dpo", "I14", {"cci": ("cci", {}), "dpo": ("dpo", {}), "md": ("mean_deviation", {})},
    [
        f"s1 AS (SELECT *, list(tp) OVER {wn(20)} AS v, list(close) OVER {wn(20)} AS cv, {avg('tp', 20)} AS m, {avg('close', 20)} AS cm, lag(close, 11) OVER ({W}) AS c11 FROM b)",
        "s2 AS (SELECT *, list_avg(list_transform(v, lambda x: abs(x - list_avg(v)))) AS mad, list_avg(list_transform(cv, lambda x: abs(x - list_avg(cv)))) AS cmad FROM s1)",
    ],
    {"cci": "CASE WHEN rn >= 20 THEN (tp - m) / (0.015 * nullif(mad, 0)) END", "dpo": "c11 - cm", "md": "CASE WHEN rn >= 20 THEN cmad END"},
)
register(
    "true_range_atr", "I15",
    {"tr": ("true_range", {}), "atr": ("atr", {}), "atr_wilder": ("atr_wilder", {}), "natr": ("natr", {}), "chop": ("choppiness", {})},
    [],
    {
        "tr": "tr", "atr": avg("tr", 14), "atr_wilder": ewm("tr", 1 / 14), "natr": f"({avg('tr', 14)}) / close * 100",
        "chop": f"100 * log10(({ssum('tr', 14)}) / nullif(({hi('high', 14)}) - ({lo('low', 14)}), 0)) / log10(14)",
    },
)
register(
    "bollinger", "I16", {"bb": ("bollinger", {})},
    [f"s1 AS (SELECT *, {avg('close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s FROM b)"],
    {"bb_upper": "m + 2 * s", "bb_middle": "m", "bb_lower": "m - 2 * s", "bb_bandwidth": "4 * s / m * 100", "bb_percent_b": "(close - m + 2 * s) / nullif(4 * s, 0)"},
)
register(
    "channels", "I17",
    {"kc": ("keltner", {}), "dc": ("donchian", {}), "ce": ("chandelier", {})},
    [f"s1 AS (SELECT *, {E('close', 20)} AS e, {avg('tr', 10)} AS a10, {avg('tr', 22)} AS a22, {hi('high', 20)} AS h20, {lo('low', 20)} AS l20, {hi('high', 22)} AS h22, {lo('low', 22)} AS l22 FROM b)"],
    {"kc_upper": "e + 2 * a10", "kc_middle": "e", "kc_lower": "e - 2 * a10", "dc_upper": "h20", "dc_middle": "(h20 + l20) / 2", "dc_lower": "l20", "ce_long": "h22 - 3 * a22", "ce_short": "l22 + 3 * a22"},
)
register(
    "ttm_squeeze", "I17", {"ttm": ("ttm_squeeze", {})},
    [
        f"s1 AS (SELECT *, 2 * {roll('stddev_samp', 'close', 20)} < 1.5 * ({avg('tr', 20)}) AS sq, close - ((({hi('high', 20)}) + ({lo('low', 20)})) / 2 + ({avg('close', 20)})) / 2 AS x FROM b)".replace("2 * CASE", "2 * (CASE").replace("END < 1.5", "END) < 1.5"),
        f"s2 AS (SELECT *, CASE WHEN count(x) OVER {wn(20)} = 20 THEN regr_intercept(x, rn) OVER {wn(20)} + regr_slope(x, rn) OVER {wn(20)} * rn END AS mo FROM s1)",
    ],
    {"ttm_on": "sq", "ttm_momentum": "mo"},
    fine=("ttm_on",),
)
register(
    "adx", "I18", {"dmi": ("adx", {})},
    [
        "s0 AS (SELECT *, high - ph AS u, pl - low AS v FROM b)",
        "s1 AS (SELECT *, CASE WHEN u > v AND u > 0 THEN u ELSE 0 END AS p, CASE WHEN v > u AND v > 0 THEN v ELSE 0 END AS m FROM s0)",
        f"s2 AS (SELECT *, {E('tr', 14)} AS a_t, {E('p', 14)} AS ap, {E('m', 14)} AS am FROM s1)",
        "s3 AS (SELECT *, 100 * ap / nullif(a_t, 0) AS pd, 100 * am / nullif(a_t, 0) AS md FROM s2)",
        "s4 AS (SELECT *, abs(pd - md) / nullif(pd + md, 0) * 100 AS dx FROM s3)",
    ],
    {"dmi_adx": E("dx", 14), "dmi_plus_di": "pd", "dmi_minus_di": "md"},
)
register(
    "aroon_vortex_mass", "I19", {"aroon": ("aroon", {}), "vx": ("vortex", {}), "mass": ("mass_index", {})},
    [
        f"s0 AS (SELECT *, list(high) OVER {wn(26)} AS hl, list(low) OVER {wn(26)} AS ll, abs(high - pl) AS vp, abs(low - ph) AS vm, high - low AS rg, {E('high - low', 9)} AS e1 FROM b)",
        f"s1 AS (SELECT *, {E('e1', 9)} AS e2 FROM s0)",
        "s2 AS (SELECT *, (list_position(hl, list_max(hl)) - 1) * 4.0 AS up, (list_position(ll, list_min(ll)) - 1) * 4.0 AS dn, e1 / nullif(e2, 0) AS er FROM s1)",
    ],
    {
        "aroon_up": "CASE WHEN rn >= 26 THEN up END", "aroon_down": "CASE WHEN rn >= 26 THEN dn END", "aroon_oscillator": "CASE WHEN rn >= 26 THEN up - dn END",
        "vx_plus": f"({ssum('vp', 14)}) / nullif({ssum('tr', 14)}, 0)", "vx_minus": f"({ssum('vm', 14)}) / nullif({ssum('tr', 14)}, 0)", "mass": ssum("er", 25),
    },
)
register(
    "ichimoku", "I20", {"ik": ("ichimoku", {})},
    [
        f"s1 AS (SELECT *, (({hi('high', 9)}) + ({lo('low', 9)})) / 2 AS cv, (({hi('high', 26)}) + ({lo('low', 26)})) / 2 AS bs, (({hi('high', 52)}) + ({lo('low', 52)})) / 2 AS wd, lead(high, 26) OVER ({W}) AS lh FROM b)",
    ],
    {"ik_conversion": "cv", "ik_base": "bs", "ik_span_a": f"lag((cv + bs) / 2, 26) OVER ({W})", "ik_span_b": f"lag(wd, 26) OVER ({W})", "ik_chikou": "lh"},
)


def _psar_sql():
    first = "high AS lv, 0.02 AS af, 1 AS sd, high AS ex, high AS h1, low AS l1, NULL::DOUBLE AS h2, NULL::DOUBLE AS l2"
    raw = "p.lv + p.af * (p.ex - p.lv)"
    level = f"CASE WHEN p.sd > 0 THEN least({raw}, p.l1, p.l2) ELSE greatest({raw}, p.h1, p.h2) END"
    flip = f"CASE WHEN p.sd > 0 THEN n.low < {level} ELSE n.high > {level} END"
    better = "CASE WHEN p.sd > 0 THEN n.high > p.ex ELSE n.low < p.ex END"
    step = (
        f"CASE WHEN {flip} THEN p.ex ELSE {level} END, CASE WHEN {flip} THEN 0.02 WHEN {better} THEN least(p.af + 0.02, 0.2) ELSE p.af END, "
        f"CASE WHEN {flip} THEN -p.sd ELSE p.sd END, CASE WHEN {flip} THEN CASE WHEN p.sd > 0 THEN n.low ELSE n.high END WHEN {better} THEN CASE WHEN p.sd > 0 THEN n.high ELSE n.low END ELSE p.ex END, n.high, n.low, p.h1, p.l1"
    )
    rec, _ = _recursive(first.replace("0.02 AS af", "0.02::DOUBLE AS af"), step, ())
    return recursive(HOURLY_SQL, NUMBERED, BASE, rec, f"SELECT symbol, ts, {r('lv')} AS psar FROM rec")


@query("parabolic_sar", "I21", _psar_sql())
def parabolic_sar(spark, sf):
    return near(ind.parabolic_sar(fx.hourly(spark, sf)), "psar").select("symbol", "ts", "psar")


def _supertrend_sql():
    pre = f"s1 AS (SELECT *, mid + 3 * ({avg('tr', 10)}) AS up, mid - 3 * ({avg('tr', 10)}) AS dn FROM b)"
    side = "CASE WHEN n.close > p.up THEN 1 WHEN n.close < p.dn THEN -1 ELSE p.sd END"
    level = f"CASE WHEN {side} = 1 THEN CASE WHEN p.sd = 1 THEN greatest(n.dn, p.st) ELSE n.dn END ELSE CASE WHEN p.sd = -1 THEN least(n.up, p.st) ELSE n.up END END"
    rec, _ = _recursive("up, dn, 1 AS sd, dn AS st", f"n.up, n.dn, {side}, {level}", (), "up IS NOT NULL", "s1")
    return recursive(HOURLY_SQL, NUMBERED, BASE, pre, rec, f"SELECT nb.symbol, nb.ts, {r('st')} AS supertrend, sd AS direction FROM nb LEFT JOIN rec ON nb.symbol = rec.symbol AND nb.ts = rec.ts")


@query("supertrend", "I22", _supertrend_sql())
def supertrend(spark, sf):
    return near(ind.supertrend(fx.hourly(spark, sf)), "supertrend").select("symbol", "ts", "supertrend", "direction")


register(
    "heikin_ashi", "I23", {"ha": ("heikin_ashi", {})},
    [
        "s0 AS (SELECT *, (open + high + low + close) / 4 AS hc FROM b)",
        f"s1 AS (SELECT *, coalesce(lag(hc) OVER ({W}), (open + close) / 2) AS x FROM s0)",
        f"s2 AS (SELECT *, {ewm('x', 0.5)} AS ho FROM s1)",
    ],
    {"ha_open": "ho", "ha_high": "greatest(high, ho, hc)", "ha_low": "least(low, ho, hc)", "ha_close": "hc"},
)
CUM = f"OVER ({W} ROWS UNBOUNDED PRECEDING)"
CLV = "((close - low) - (high - close)) / nullif(high - low, 0)"
register(
    "on_balance_volume", "I24", {"obv": ("obv", {}), "sobv": ("obv_smoothed", {})},
    [f"s1 AS (SELECT *, sum(coalesce(sign(d), 0) * volume) {CUM} AS o FROM b)"],
    {"obv": "o", "sobv": avg("o", 10)},
)
register(
    "accumulation_chaikin", "I25", {"ad": ("ad_line", {}), "cmf": ("chaikin_mf", {}), "co": ("chaikin_oscillator", {})},
    [f"s0 AS (SELECT *, {CLV} AS clv FROM b)", f"s1 AS (SELECT *, sum(clv * volume) {CUM} AS ad, sum(coalesce(clv, 0) * volume) {CUM} AS a0 FROM s0)", f"s2 AS (SELECT *, {E('a0', 3)} - {E('a0', 10)} AS co FROM s1)"],
    {"ad": "ad", "cmf": f"({ssum('clv * volume', 20)}) / nullif(sum(volume) OVER {wn(20)}, 0)", "co": "co"},
)
register(
    "volume_flows", "I26", {"mfi": ("mfi", {}), "fi": ("force_index", {}), "eom": ("ease_of_movement", {"scale": 1.0}), "vpt": ("vpt", {})},
    [
        "s0 AS (SELECT *, CASE WHEN tp > ptp THEN tp * volume ELSE 0 END AS pf, CASE WHEN tp < ptp THEN tp * volume ELSE 0 END AS nf, d * volume AS fx, ((high - ph) + (low - pl)) * (high - low) / (2 * nullif(volume, 0)) AS em FROM b)",
        f"s1 AS (SELECT *, {E('fx', 13)} AS fi, sum(coalesce(close / pc - 1, 0) * volume) {CUM} AS vpt FROM s0)",
    ],
    {"mfi": f"100 - 100 / (1 + ({ssum('pf', 14)}) / nullif({ssum('nf', 14)}, 0))", "fi": "fi", "eom_value": "em", "eom_signal": avg("em", 14), "vpt": "vpt"},
    digits=3,
)


@query(
    "vwap_variants", "I27",
    with_(
        HOURLY_SQL, NUMBERED, BASE,
        f"SELECT symbol, ts, {r(f'sum(tp * volume) {CUM} / nullif(sum(volume) {CUM}, 0)')} AS vwap, {r('(' + ssum('tp * volume', 14) + ') / nullif(' + ssum('volume', 14) + ', 0)')} AS vwap_14, "
        + r("sum(tp * volume) OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts) / nullif(sum(volume) OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts), 0)") + " AS vwap_day FROM b",
    ),
)
def vwap_variants(spark, sf):
    out = ind.compute(fx.hourly(spark, sf), {"vwap": ("vwap", {}), "vwap_14": ("vwap_rolling", {})})
    return near(ind.session_vwap(out), "vwap", "vwap_14", "vwap_day").select("symbol", "ts", "vwap", "vwap_14", "vwap_day")


KVO_SQL = f"""s0 AS (SELECT *, CASE WHEN tp > ptp THEN 1 WHEN ptp IS NOT NULL THEN -1 END AS t, high - low AS dm FROM b),
s1 AS (SELECT *, sum(CASE WHEN t IS DISTINCT FROM pt THEN 1 ELSE 0 END) {CUM} AS run, lag(dm) OVER ({W}) AS pdm FROM (SELECT *, lag(t) OVER ({W}) AS pt FROM s0)),
s2 AS (SELECT *, sum(dm) OVER (PARTITION BY symbol, run ORDER BY ts) + first_value(pdm) OVER (PARTITION BY symbol, run ORDER BY ts) AS cm FROM s1),
s3 AS (SELECT *, CASE WHEN t IS NOT NULL THEN volume * coalesce(abs(2 * dm / nullif(cm, 0) - 1), 0) * t * 100 END AS vf FROM s2),
s4 AS (SELECT *, {E('vf', 34)} - {E('vf', 55)} AS kvo FROM s3)"""


@query("klinger", "I28", with_(HOURLY_SQL, NUMBERED, BASE, KVO_SQL, f"SELECT symbol, ts, {r('kvo', 4)} AS kvo, {r(E('kvo', 13), 4)} AS kvo_signal FROM s4"))
def klinger(spark, sf):
    return near(ind.klinger(fx.hourly(spark, sf)), "kvo", "kvo_signal", digits=4).select("symbol", "ts", "kvo", "kvo_signal")


register(
    "volume_zones", "I28", {"vzo": ("vzo", {}), "pzo": ("pzo", {}), "fve": ("fve", {}), "tmf": ("tmf", {})},
    [
        "s0 AS (SELECT *, coalesce(sign(d), 0) * volume AS vx, coalesce(sign(d), 0) * close AS px, close - mid + tp - ptp AS mf, coalesce(volume * ((close - least(low, pc)) - (greatest(high, pc) - close)) / nullif(greatest(high, pc) - least(low, pc), 0), 0) AS ad FROM b)",
        f"s1 AS (SELECT *, CASE WHEN mf > 0.3 * close / 100 THEN volume WHEN mf < -0.3 * close / 100 THEN -volume WHEN mf IS NOT NULL THEN 0 END AS fv, {E('vx', 14)} AS va, {E('volume', 14)} AS vt, {E('px', 14)} AS pa, {E('close', 14)} AS pt, {ewm('ad', 1 / 21)} AS ta, {ewm('volume', 1 / 21)} AS tt FROM s0)",
    ],
    {"vzo": "100 * va / nullif(vt, 0)", "pzo": "100 * pa / nullif(pt, 0)", "fve": f"({ssum('fv', 22)}) / nullif({avg('volume', 22)}, 0) / 22 * 100", "tmf": "ta / nullif(tt, 0)"},
)
register(
    "volume_flow_indicator", "I28", {"vfi": ("vfi", {"period": 60})},
    [
        f"s0 AS (SELECT *, ln(tp) - ln(ptp) AS it, tp - ptp AS dt, {avg('volume', 60)} AS a0 FROM b)",
        f"s1 AS (SELECT *, 0.2 * ({roll('stddev_samp', 'it', 30)}) * close AS cut, lag(a0) OVER ({W}) AS av FROM s0)",
        "s2 AS (SELECT *, CASE WHEN dt > cut THEN least(volume, av * 2.5) WHEN dt < -cut THEN -least(volume, av * 2.5) WHEN cut IS NOT NULL THEN 0 END AS x FROM (SELECT * FROM s1 WHERE av IS NOT NULL) UNION ALL BY NAME SELECT * FROM s1 WHERE av IS NULL)",
        f"s3 AS (SELECT *, ({ssum('x', 60)}) / nullif(av, 0) AS q FROM s2)",
    ],
    {"vfi": E("q", 3)},
)
register(
    "bar_shapes", "I29",
    {n: (n, {}) for n in ("hl2", "hlc3", "ohlc4", "balance_of_power", "bar_strength")},
    [],
    {"hl2": "mid", "hlc3": "tp", "ohlc4": "(open + high + low + close) / 4", "balance_of_power": "(close - open) / nullif(high - low, 0)", "bar_strength": "(close - low) / nullif(high - low, 0)"},
)
PP = "(ph + pl + pc) / 3"
register(
    "pivot_points", "I30",
    {"std": ("pivots", {}), "fib": ("pivots", {"kind": "fibonacci"}), "woo": ("pivots", {"kind": "woodie"}), "cam": ("pivots", {"kind": "camarilla"})},
    [],
    {
        "std_pp": PP, "std_r1": f"2 * {PP} - pl", "std_r2": f"{PP} + (ph - pl)", "std_r3": f"ph + 2 * ({PP} - pl)", "std_s1": f"2 * {PP} - ph", "std_s2": f"{PP} - (ph - pl)", "std_s3": f"pl - 2 * (ph - {PP})",
        "fib_pp": PP, **{f"fib_{s}{i}": f"{PP} {o} {k} * (ph - pl)" for s, o in (("r", "+"), ("s", "-")) for i, k in ((1, 0.382), (2, 0.618), (3, 1.0))},
        "woo_pp": "(ph + pl + 2 * pc) / 4", "woo_r1": "2 * (ph + pl + 2 * pc) / 4 - pl", "woo_r2": "(ph + pl + 2 * pc) / 4 + (ph - pl)", "woo_r3": "ph + 2 * ((ph + pl + 2 * pc) / 4 - pl)",
        "woo_s1": "2 * (ph + pl + 2 * pc) / 4 - ph", "woo_s2": "(ph + pl + 2 * pc) / 4 - (ph - pl)", "woo_s3": "pl - 2 * (ph - (ph + pl + 2 * pc) / 4)",
        "cam_pp": PP, **{f"cam_{s}{i}": f"pc {o} 1.1 * (ph - pl) / {k}" for s, o in (("r", "+"), ("s", "-")) for i, k in ((1, 12), (2, 6), (3, 4))},
    },
)


@query(
    "swing_pivots", "I31",
    with_(
        HOURLY_SQL, NUMBERED,
        f"""s AS (SELECT symbol, ts, high, low, count(*) OVER x AS n, max(high) OVER x AS xh, max(high) OVER y AS yh, min(low) OVER x AS xl, min(low) OVER y AS yl, count(*) OVER y AS m FROM nb
  WINDOW x AS ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), y AS ({W} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING))""",
        "SELECT symbol, ts, CASE WHEN n = 5 AND m = 5 AND high > xh AND high > yh THEN high END AS pivot_high, CASE WHEN n = 5 AND m = 5 AND low < xl AND low < yl THEN low END AS pivot_low FROM s",
    ),
)
def swing_pivots(spark, sf):
    return ind.swing_pivots(fx.hourly(spark, sf)).select("symbol", "ts", "pivot_high", "pivot_low")


@query(
    "fibonacci_levels", "I31",
    with_(HOURLY_SQL, "SELECT symbol, " + ", ".join(f"{r(f'max(high) - (max(high) - min(low)) * {k}')} AS level_{int(k * 1000)}" for k in ind.FIBONACCI) + " FROM bars GROUP BY symbol"),
)
def fibonacci_levels(spark, sf):
    return near(ind.fibonacci_levels(fx.hourly(spark, sf)), *[f"level_{int(k * 1000)}" for k in ind.FIBONACCI])


def _zigzag_sql():
    first = "0 AS sd, close AS tp, ts AS ta, close AS lp, ts AS la, NULL::TIMESTAMP AS pt, NULL::DOUBLE AS pv, NULL::VARCHAR AS kd"
    top = "CASE WHEN p.sd >= 0 AND n.close > p.tp THEN n.close ELSE p.tp END"
    topa = "CASE WHEN p.sd >= 0 AND n.close > p.tp THEN n.ts ELSE p.ta END"
    low = "CASE WHEN p.sd <= 0 AND n.close < p.lp THEN n.close ELSE p.lp END"
    lowa = "CASE WHEN p.sd <= 0 AND n.close < p.lp THEN n.ts ELSE p.la END"
    dn = f"(p.sd >= 0 AND n.close <= ({top}) * 0.95)"
    up = f"(NOT {dn} AND p.sd <= 0 AND n.close >= ({low}) * 1.05)"
    step = (
        f"CASE WHEN {dn} THEN -1 WHEN {up} THEN 1 ELSE p.sd END, CASE WHEN {up} THEN n.close ELSE {top} END, CASE WHEN {up} THEN n.ts ELSE {topa} END, "
        f"CASE WHEN {dn} THEN n.close ELSE {low} END, CASE WHEN {dn} THEN n.ts ELSE {lowa} END, CASE WHEN {dn} THEN {topa} WHEN {up} THEN {lowa} END, CASE WHEN {dn} THEN {top} WHEN {up} THEN {low} END, CASE WHEN {dn} THEN 'high' WHEN {up} THEN 'low' END"
    )
    rec, _ = _recursive(first, step, (), base="nb")
    return recursive(HOURLY_SQL, NUMBERED, rec, "SELECT symbol, pt AS pivot_ts, pv AS pivot, kd AS kind, ts AS confirmed_ts FROM rec WHERE kd IS NOT NULL")


@query("zigzag", "I31", _zigzag_sql())
def zigzag(spark, sf):
    return ind.zigzag(fx.hourly(spark, sf))


register(
    "range_volatility", "I32", {"rsv": ("rogers_satchell", {}), "ulcer": ("ulcer", {}), "sd": ("std_dev", {})},
    [
        f"s0 AS (SELECT *, ln(high / close) * ln(high / open) + ln(low / close) * ln(low / open) AS x, 100 * (close / ({hi('close', 14)}) - 1) AS q FROM b)",
        f"s1 AS (SELECT *, {avg('x', 14)} AS xm FROM s0)",
    ],
    {"rsv": "CASE WHEN xm >= 0 THEN sqrt(xm) END", "ulcer": f"sqrt({avg('q * q', 14)})", "sd": roll("stddev_samp", "close", 20)},
)
register(
    "volume_averages", "I33", {"vr": ("volume_ratio", {}), "dv": ("dollar_volume", {}), "adv": ("avg_dollar_volume", {})},
    [],
    {"vr": f"volume / (({avg('volume', 20)}) + 1e-10)", "dv": "close * volume", "adv": avg("close * volume", 20)},
)


@query("all_indicators", "I34")
def all_indicators(spark, sf):
    out = ind.all_indicators(fx.hourly(spark, sf))
    names = [c for c in out.columns if c not in ("symbol", "ts", "open", "high", "low", "close", "volume")]
    return near(out, *names, digits=3)


@query("indicator_by_name", "I34", with_(HOURLY_SQL, NUMBERED, f"SELECT symbol, ts, {r(avg('close', 5))} AS chosen FROM nb"))
def indicator_by_name(spark, sf):
    return show(spark, sf, {"chosen": ("sma", {"period": 5})})


def ewm_adjusted(x, alpha):
    """Mean with weights (1 - alpha)^age."""
    return f"list_reduce(list({x}) OVER ({W} ROWS UNBOUNDED PRECEDING), lambda a, b: {1 - alpha!r} * a + b) / ((1 - power({1 - alpha!r}, rn)) / {alpha!r})"


@query(
    "technical_score", "I35",
    with_(
        HOURLY_SQL, NUMBERED, BASE,
        f"s1 AS (SELECT *, {ewm_adjusted('close', span_alpha(12))} - {ewm_adjusted('close', span_alpha(26))} AS m, {avg('close', 60)} AS ma, avg(greatest(d, 0)) OVER {wn(14)} AS g, avg(greatest(-d, 0)) OVER {wn(14)} AS l FROM b)",
        f"s2 AS (SELECT *, m - {ewm_adjusted('m', span_alpha(9))} AS h FROM s1)",
        f"s3 AS (SELECT *, lag(h) OVER ({W}) AS h1, 100 - 100 / (1 + g / (l + 1e-8)) AS x, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM s2)",
        """s4 AS (SELECT symbol, ts, x, CASE WHEN close > ma * 1.02 THEN 1.0 WHEN close > ma THEN 0.7 WHEN close > ma * 0.98 THEN 0.3 ELSE 0.0 END::DOUBLE AS ma_score,
  CASE WHEN x BETWEEN 40 AND 60 THEN 0.5 WHEN x >= 30 AND x < 40 THEN 0.7 WHEN x < 30 THEN 1.0 WHEN x > 60 AND x <= 70 THEN 0.3 ELSE 0.0 END::DOUBLE AS rsi_score,
  CASE WHEN h > 0 AND h > h1 THEN 1.0 WHEN h > 0 THEN 0.7 WHEN h < 0 AND h > h1 THEN 0.3 ELSE 0.0 END::DOUBLE AS macd_score FROM s3 WHERE z = 1 AND ma IS NOT NULL)""",
        f"SELECT symbol, ts, {r('x')} AS rsi, ma_score, rsi_score, macd_score, round(ma_score + rsi_score + macd_score, 2) AS score, CASE WHEN round(ma_score + rsi_score + macd_score, 2) >= 2.5 THEN 'Strong' WHEN round(ma_score + rsi_score + macd_score, 2) >= 1.5 THEN 'Moderate' ELSE 'Weak' END AS label FROM s4",
    ),
)
def technical_score(spark, sf):
    return near(ind.technical_score(fx.hourly(spark, sf)), "rsi")


@query(
    "ma_cross_state", "I36",
    with_(
        HOURLY_SQL, NUMBERED,
        f"s AS (SELECT symbol, ts, {avg('close', 10)} AS f, {avg('close', 30)} AS s FROM nb), t AS (SELECT *, lag(f) OVER ({W}) AS pf, lag(s) OVER ({W}) AS ps FROM s)",
        f"SELECT symbol, ts, {r('f')} AS fast_ma, {r('s')} AS slow_ma, CASE WHEN ps IS NOT NULL THEN CASE WHEN pf <= ps AND f > s THEN 'golden_cross' WHEN pf >= ps AND f < s THEN 'death_cross' WHEN f > s THEN 'above' ELSE 'below' END END AS state FROM t",
    ),
)
def ma_cross_state(spark, sf):
    out = ind.ma_cross_state(fx.hourly(spark, sf), fast=10, slow=30)
    return near(out, "fast_ma", "slow_ma").select("symbol", "ts", "fast_ma", "slow_ma", "state")


@query(
    "market_regime", "I36",
    with_(
        HOURLY_SQL, NUMBERED,
        f"s AS (SELECT symbol, ts, rn, close, close / lag(close) OVER ({W}) - 1 AS x, list(close) OVER {wn(200)} AS v FROM nb)",
        f"t AS (SELECT *, {avg('x', 20)} AS m, ({roll('stddev_pop', 'x', 20)}) * sqrt(252) AS vol, least(50, CAST(floor(rn / 3) AS BIGINT)) AS ns, least(200, rn - 1) AS nl FROM s)",
        "u AS (SELECT *, CASE WHEN rn >= 30 THEN list_avg(list_slice(v, len(v) - ns + 1, len(v))) END AS sm, CASE WHEN rn >= 30 THEN list_avg(list_slice(v, len(v) - nl + 1, len(v))) END AS lm FROM t)",
        f"SELECT symbol, ts, {r('vol', 5)} AS volatility, {r('sm')} AS short_ma, {r('lm')} AS long_ma, CASE WHEN rn >= 30 THEN CASE WHEN vol > 0.30 THEN 'high_volatility' WHEN sm > lm AND m > 0 THEN 'bull' WHEN sm < lm AND m < 0 THEN 'bear' ELSE 'sideways' END END AS regime FROM u",
    ),
)
def market_regime(spark, sf):
    out = ind.regime(fx.hourly(spark, sf))
    return near(near(out, "volatility", digits=5), "short_ma", "long_ma").select("symbol", "ts", "volatility", "short_ma", "long_ma", "regime")
