"""Panel time series: anomalies, seasonality, smoothing, forecasts, tests (entity_id, time, value)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.stats import chi2_p_value, t_p_value, t_ppf
from candlewick.operators import ranking
from candlewick.operators.aggregates import ols
from candlewick.operators.machines import Affine
from candlewick.operators.series import (
    POS, Axis, fold, full, number, over_blocks, prefix, shared, smoothed, trailing, whole, whole_by,
)
from candlewick.operators.signals import uniform
from candlewick.operators.windows import interpolated, positive
from candlewick.session import checkpoint_folder

PANEL = Axis(key=("entity_id",), order=("time",))


def to_panel(df: DataFrame, entity: str = "symbol", time: str = "ts", value: str = "close") -> DataFrame:
    return df.select(F.col(entity).cast("string").alias("entity_id"), F.col(time).alias("time"), F.col(value).cast("double").alias("value"))


def _marked(rows: DataFrame, score: Column, threshold: float) -> DataFrame:
    kind = F.when(score > threshold, "high").when(score < -threshold, "low")
    return rows.withColumns({"is_anomaly": F.abs(score) > threshold, "anomaly_type": kind})


# --- anomalies ------------------------------------------------------------------------------------------------------


def zscore_anomalies(y: DataFrame, threshold: float = 3.0, window: int | None = None, axis: Axis = PANEL) -> DataFrame:
    """Population z-score over the entity or the last ``window`` rows (shorter at the start); 0 without spread."""
    if window is None:
        rows = whole(y, axis, {"_m": F.avg("value"), "_s": F.stddev_pop("value")})
    else:
        rows = over_blocks(y, axis, lambda w: {"_m": F.avg("value").over(trailing(w, window)), "_s": F.stddev_pop("value").over(trailing(w, window))}, back=window - 1)
    z = F.when(F.col("_s") > 0, (F.col("value") - F.col("_m")) / F.col("_s")).otherwise(0.0)
    rows = rows.withColumn("zscore", z).drop("_m", "_s")
    return _marked(rows, F.col("zscore"), threshold)


def iqr_anomalies(y: DataFrame, k: float = 1.5, window: int | None = None, axis: Axis = PANEL) -> DataFrame:
    """Values outside the quartile fence of the entity or of the ``window`` rows before and the current one."""
    if window is None:
        rows = ranking.with_quantiles(y, list(axis.key), "value", {"_q1": 0.25, "_q3": 0.75})
    else:
        v = lambda w: F.collect_list("value").over(w.rowsBetween(-window, 0))
        rows = over_blocks(y, axis, [lambda w: {"_v": v(w)}, lambda w: {"_q1": interpolated(F.col("_v"), 0.25), "_q3": interpolated(F.col("_v"), 0.75)}], back=window).drop("_v")
    width = (F.col("_q3") - F.col("_q1")) * k
    rows = rows.withColumns({"lower_bound": F.col("_q1") - width, "upper_bound": F.col("_q3") + width}).drop("_q1", "_q3")
    kind = F.when(F.col("value") > F.col("upper_bound"), "high").when(F.col("value") < F.col("lower_bound"), "low")
    return rows.withColumns({"anomaly_type": kind, "is_anomaly": kind.isNotNull()})


def grubbs_anomalies(y: DataFrame, alpha: float = 0.05, axis: Axis = PANEL) -> DataFrame:
    """Grubbs statistic of every value against the critical value of its entity's size (none below three values)."""

    @F.pandas_udf(T.DoubleType())
    def critical(n: pd.Series) -> pd.Series:
        def one(k):
            if k < 3:
                return None
            t = t_ppf(1 - alpha / (2 * k), k - 2)
            return (k - 1) / math.sqrt(k) * math.sqrt(t * t / (k - 2 + t * t))

        return n.map({k: one(int(k)) for k in n.unique()}).astype("float64")

    stats = y.groupBy(*axis.key).agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"), F.count("value").alias("_n"))
    sizes = stats.select("_n").distinct()
    stats = stats.join(sizes.withColumn("critical_value", critical("_n")), "_n")
    rows = y.join(stats, list(axis.key))
    g = F.when(F.col("_n") < 3, None).when(F.col("_s") > 0, F.abs(F.col("value") - F.col("_m")) / F.col("_s")).otherwise(0.0)
    rows = rows.withColumn("g_stat", g).drop("_m", "_s", "_n")
    return rows.withColumn("is_anomaly", F.coalesce(F.col("g_stat") > F.col("critical_value"), F.lit(False)))


def residual_anomalies(y: DataFrame, forecast: DataFrame, threshold: float = 3.0, axis: Axis = PANEL) -> DataFrame:
    """Population z-score of actual minus predicted per entity."""
    on = [*axis.key, axis.order[0]]
    rows = y.withColumnRenamed("value", "actual").join(forecast.withColumnRenamed("value", "predicted"), on)
    rows = rows.withColumn("residual", F.col("actual") - F.col("predicted"))
    rows = whole_by(rows, list(axis.key), {"_m": F.avg("residual"), "_s": F.stddev_pop("residual")})
    z = F.when(F.col("_s") > 0, (F.col("residual") - F.col("_m")) / F.col("_s")).otherwise(0.0)
    rows = rows.withColumn("residual_zscore", z).drop("_m", "_s")
    return rows.withColumn("is_anomaly", F.abs("residual_zscore") > threshold)


def change_points(y: DataFrame, threshold: float = 5.0, axis: Axis = PANEL) -> DataFrame:
    """Rows where the upper or lower CUSUM of the standardised value (drift 0.5) passes the threshold.

    max(0, S + z − 0.5) equals C − min(C) for the running sum C from the second row on, so both sides are prefixes.
    """
    rows = number(whole(y, axis, {"_m": F.avg("value"), "_s": F.stddev_pop("value"), "_n": F.count("value")}), axis)
    z = (F.col("value") - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s")).otherwise(1.0)
    later = F.col(POS) > 1
    rows = rows.withColumns({"_u": F.when(later, z - 0.5).otherwise(0.0), "_d": F.when(later, z + 0.5).otherwise(0.0)})
    rows = prefix(rows, axis, {"_cu": ("sum", "_u"), "_cd": ("sum", "_d")})
    rows = prefix(rows, axis, {"_lo": ("min", "_cu"), "_hi": ("max", "_cd")})
    up, down = F.col("_cu") - F.col("_lo"), F.col("_cd") - F.col("_hi")
    hit = (F.col("_n") >= 3) & ((up > threshold) | (down < -threshold))
    return rows.withColumns({"s_pos": up, "s_neg": down, "is_change_point": hit}).drop("_m", "_s", "_n", "_u", "_d", "_cu", "_cd", "_lo", "_hi", POS)


def _lag_vectors(y: DataFrame, axis: Axis, lags: int) -> DataFrame:
    """Numbered rows with the vector of the last ``lags`` values and the current one (null at the start)."""

    def cols(w):
        v = F.collect_list("value").over(trailing(w, lags + 1))
        return {"_x": full(v, "value", w, lags + 1)}

    return over_blocks(y, axis, cols, back=lags, keep_pos=True)


def _slabs(known: DataFrame, key: list[str], block: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their slab (a range of the projection ``_p``) and block, and the slabs of each entity as one array.

    Slab borders are approximate quantiles, as many as the largest entity needs for slabs of ``block`` rows; rows equal to
    a border are spread over the slabs that meet there, and a slab of more than ``block`` rows is cut by hash: no block grows
    with a common value.
    """
    largest = known.groupBy(*key).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    slabs = 2 ** max(1, math.ceil(math.log2(max(largest / block, 2))))
    edges = known.groupBy(*key).agg(
        F.percentile_approx("_p", [i / slabs for i in range(1, slabs)], 10 * slabs).alias("_e"), F.count(F.lit(1)).alias("_n")
    )
    parts = F.least(F.lit(float(slabs)), F.pow(2.0, F.floor(F.log2(F.greatest(F.col("_n") / block, F.lit(1.0))))))
    edges = edges.withColumn("_step", (slabs / parts).cast("int"))
    edges = edges.select(*key, F.filter("_e", lambda e, i: (i + 1) % F.col("_step") == 0).alias("_cuts"))
    low, high = F.size(F.filter("_cuts", lambda c: c < F.col("_p"))), F.size(F.filter("_cuts", lambda c: c <= F.col("_p")))
    rows = known.join(edges, key).withColumn("_s", (low + F.pmod(F.xxhash64(POS, F.lit(1)), high - low + 1)).cast("int")).drop("_cuts")
    found = rows.groupBy(*key, "_s").agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    rows = rows.join(found.select(*key, "_s", "parts"), [*key, "_s"]).withColumn("_b", F.pmod(F.xxhash64(POS), F.col("parts")).cast("int")).drop("parts")
    return rows, found.groupBy(*key).agg(F.collect_list(F.struct("_s", "lo", "hi", "parts")).alias("_all"))  # an entry for each ``block`` rows


def nearest_rows(known: DataFrame, key: list[str], neighbours: int, block: int) -> DataFrame:
    """The ``neighbours`` nearest other rows ``_o, _d`` of each row by vector ``_x``, exactly.

    First the neighbours inside the own block; their distance bounds the search. The projection on the diagonal never
    exceeds the distance, so only the slabs within that bound of the row are searched, block pair by block pair.
    """
    size = F.size("_x")
    vectors = known.select(*key, POS, "_x", (F.aggregate("_x", F.lit(0.0), lambda t, v: t + v) / F.sqrt(size)).alias("_p"))
    checkpoint_folder(known.sparkSession)
    rows, slabs = _slabs(vectors, key, block)
    rows = rows.checkpoint()  # read by every step below
    schema = T.StructType([*[known.schema[k] for k in key], T.StructField(POS, T.LongType()), T.StructField("_o", T.LongType()), T.StructField("_d", T.DoubleType())])

    def search(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if ask.empty or have.empty:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        have = have.sort_values(POS)
        a, b = np.stack(ask["_x"].to_numpy()), np.stack(have["_x"].to_numpy())
        pos, other = ask[POS].to_numpy(), have[POS].to_numpy()
        k = min(neighbours + 1, len(b))
        out = []
        for lo in range(0, len(a), 256):
            d = np.sqrt(((a[lo : lo + 256, None, :] - b[None, :, :]) ** 2).sum(-1))
            d[pos[lo : lo + 256, None] == other[None, :]] = np.inf
            best = np.argsort(d, axis=1, kind="stable")[:, :k]
            dist = np.take_along_axis(d, best, 1).ravel()
            keep = np.isfinite(dist)
            out.append(pd.DataFrame({POS: np.repeat(pos[lo : lo + 256], k)[keep], "_o": other[best].ravel()[keep], "_d": dist[keep]}))
        return pd.concat(out).assign(**{k_: ask[k_].iloc[0] for k_ in key})[schema.names]

    own = rows.groupBy(*key, "_s", "_b").applyInPandas(lambda part: search(part, part), schema)
    order = Window.partitionBy(*key, POS).orderBy("_d", "_o")  # neighbours x searched blocks rows
    own = own.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= neighbours).drop("_r").checkpoint()
    reach = own.groupBy(*key, POS).agg(F.when(F.count(F.lit(1)) == neighbours, F.max("_d")).alias("_u"))
    asks = rows.join(reach, [*key, POS], "left").join(slabs, key)
    far = F.col("_u") * (1 + 1e-12)
    met = F.filter("_all", lambda z: F.col("_u").isNull() | ((z["lo"] <= F.col("_p") + far) & (z["hi"] >= F.col("_p") - far)))
    asks = asks.withColumn("_z", F.explode(met)).withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_z.parts") - 1))).withColumn("_t", F.col("_z._s"))
    asks = asks.filter((F.col("_t") != F.col("_s")) | (F.col("_c") != F.col("_b"))).select(*key, "_s", "_b", "_t", "_c", POS, "_x")
    asks = shared(asks, *key, "_s", "_b", "_t", "_c")
    wanted = asks.select(*key, "_s", "_b", "_t", "_c").distinct()
    data = rows.select(*key, F.col("_s").alias("_t"), F.col("_b").alias("_c"), F.col(POS), F.col("_x")).join(wanted, [*key, "_t", "_c"])
    data = data.toDF(*data.columns)
    by = [*key, "_s", "_b", "_t", "_c"]
    return own.unionByName(asks.groupBy(*by).cogroup(data.groupBy(*by)).applyInPandas(search, schema))


def local_outliers(y: DataFrame, neighbours: int = 20, contamination: float = 0.05, lags: int = 5, axis: Axis = PANEL, block: int = 4096) -> DataFrame:
    """Local outlier factor on lag vectors; entities with fewer than neighbours + lags values get no score.

    Exact nearest neighbours by :func:`nearest_rows`, then densities are joined back. No task holds a whole entity.
    """
    key = list(axis.key)
    rows = shared(_lag_vectors(y, axis, lags), *key, POS)
    known = rows.filter(F.col("_x").isNotNull()).select(*key, POS, "_x")
    sizes = known.groupBy(*key).agg(F.max(POS).alias("_n")).filter(F.col("_n") >= neighbours + lags)
    pairs = nearest_rows(known.join(sizes.select(*key), key), key, neighbours, block)
    order = Window.partitionBy(*key, POS).orderBy("_d", "_o")  # neighbours x searched blocks rows
    near = pairs.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= neighbours).checkpoint()
    kdist = near.groupBy(*key, POS).agg(F.max("_d").alias("_k"))
    reach = near.join(kdist.withColumnRenamed(POS, "_o"), [*key, "_o"]).withColumn("_reach", F.greatest("_d", "_k"))
    density = reach.groupBy(*key, POS).agg((1 / (F.avg("_reach") + 1e-10)).alias("_lrd"), F.collect_list("_o").alias("_os"))  # ≤ neighbours
    density = shared(density, *key, POS)
    others = density.select(*key, POS, F.explode("_os").alias("_o")).join(density.select(*key, F.col(POS).alias("_o"), F.col("_lrd").alias("_ol")), [*key, "_o"])
    lof = others.groupBy(*key, POS).agg(F.avg("_ol").alias("_m")).join(density.drop("_os"), [*key, POS])
    lof = lof.select(*key, POS, (F.col("_m") / F.col("_lrd")).alias("lof_score"))
    lof = ranking.with_quantiles(lof, key, "lof_score", {"_cut": 1 - contamination})
    out = rows.drop("_x").join(lof, [*key, POS], "left")
    return out.withColumn("is_anomaly", F.coalesce(F.col("lof_score") > F.col("_cut"), F.lit(False))).drop("_cut", POS)


def isolation_outliers(y: DataFrame, contamination: float = 0.05, trees: int = 50, lags: int = 5, axis: Axis = PANEL, sample: int = 256, seed: int = 42) -> DataFrame:
    """Isolation-forest score on lag vectors: 2^(−mean path / expected path); the highest ``contamination`` share is marked.

    Each tree grows from a hash-drawn sample of at most ``sample`` rows in its own task (that is the algorithm; all rows
    are scored); blocks of rows are scored against the small forest of their entity. Paths are measured against the expected
    path of trees of the size the drawn rows really have. Entities of at most ``lags`` values are scored on the values.
    """
    key = list(axis.key)
    rows = _lag_vectors(y, axis, lags)
    short = rows.groupBy(*key).agg((F.max(POS) <= lags).alias("_short"))
    rows = rows.join(short, key).withColumn("_x", F.when(F.col("_short"), F.array(F.col("value").cast("double"))).otherwise(F.col("_x"))).drop("_short")
    rows = shared(rows, *key, POS)
    known = rows.filter(F.col("_x").isNotNull()).select(*key, POS, "_x")
    keys = [F.col(k) for k in key]
    sizes = known.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
    draws = sizes.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(sample - 1))))
    draws = draws.withColumn(POS, F.floor(uniform(F.lit(seed), *keys, F.col("_t"), F.col("_i")) * F.col("_n")) + F.col("_first"))
    picked = draws.select(*key, "_t", POS).distinct().join(known, [*key, POS])
    node = T.StructType([T.StructField("f", T.IntegerType()), T.StructField("v", T.DoubleType()), T.StructField("l", T.IntegerType()), T.StructField("r", T.IntegerType()), T.StructField("d", T.DoubleType())])
    fields = [y.schema[k] for k in key]
    grown = T.StructType([*fields, T.StructField("_t", T.IntegerType()), T.StructField("expected", T.DoubleType()), T.StructField("nodes", T.ArrayType(node))])

    def expected(n: float) -> float:
        return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(POS)
        x, t = np.stack(part["_x"].to_numpy()), int(part["_t"].iloc[0])
        rng = np.random.default_rng([seed, t, len(x)])
        limit = max(1, math.ceil(math.log2(max(len(x), 2))))
        nodes: list[dict] = []

        def split(idx, depth):
            me = len(nodes)
            nodes.append({"f": -1, "v": 0.0, "l": -1, "r": -1, "d": depth + expected(len(idx))})
            lo, hi = x[idx].min(0), x[idx].max(0)
            open_ = np.nonzero(hi > lo)[0]
            if depth < limit and len(idx) > 1 and len(open_):
                f = int(rng.choice(open_))
                v = float(rng.uniform(lo[f], hi[f]))
                left = x[idx, f] < v
                nodes[me].update(f=f, v=v)
                nodes[me]["l"] = split(idx[left], depth + 1)
                nodes[me]["r"] = split(idx[~left], depth + 1)
            return me

        split(np.arange(len(x)), 0)
        head = {k: part[k].iloc[0] for k in key}
        return pd.DataFrame([{**head, "_t": t, "expected": expected(len(x)), "nodes": nodes}])

    forest = picked.groupBy(*key, "_t").applyInPandas(grow, grown)
    cut = known.withColumn("_b", F.floor((F.col(POS) - 1) / 8192))
    where = cut.select(*key, "_b").distinct()
    schema = T.StructType([*fields, T.StructField(POS, T.LongType()), T.StructField("anomaly_score", T.DoubleType())])

    def score(part: pd.DataFrame, trees_: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        x = np.stack(part["_x"].to_numpy())
        total = np.zeros(len(x))
        for nodes in trees_.sort_values("_t")["nodes"]:
            table = [tuple(n.values()) if isinstance(n, dict) else tuple(n) for n in nodes]
            todo = [(0, np.arange(len(x)))]
            while todo:
                at, idx = todo.pop()
                f, v, l, r, d = table[at]
                if f < 0 or not len(idx):
                    total[idx] += d
                    continue
                left = x[idx, f] < v
                todo += [(l, idx[left]), (r, idx[~left])]
        out = part[[*key, POS]].copy()
        out["anomaly_score"] = np.exp2(-total / max(trees_["expected"].sum(), 1e-9))
        return out

    placed = forest.join(where, key)
    placed = placed.toDF(*placed.columns)
    scored = cut.groupBy(*key, "_b").cogroup(placed.groupBy(*key, "_b")).applyInPandas(score, schema)
    scored = ranking.with_quantiles(scored, key, "anomaly_score", {"_cut": 1 - contamination})
    out = rows.drop("_x").join(scored, [*key, POS], "left")
    return out.withColumn("is_anomaly", F.coalesce(F.col("anomaly_score") > F.col("_cut"), F.lit(False))).drop("_cut", POS)


# --- seasonality ----------------------------------------------------------------------------------------------------


def detrended(y: DataFrame, axis: Axis = PANEL) -> DataFrame:
    """Value minus its least-squares line, with position."""
    rows = number(y, axis)
    fit = rows.groupBy(*axis.key).agg(F.regr_slope("value", POS).alias("_b"), F.regr_intercept("value", POS).alias("_a"), F.count(F.lit(1)).alias("_n"))
    return rows.join(fit, list(axis.key)).withColumn("detrended", F.col("value") - F.col("_a") - F.col("_b") * F.col(POS)).drop("_a", "_b")


def acf(y: DataFrame, max_lag: int, axis: Axis = PANEL) -> DataFrame:
    """Autocorrelation of the detrended values at lags 1 … max_lag (at most half the series), in long form."""
    rows = detrended(y, axis)
    d = F.col("detrended")
    rows = over_blocks(rows, axis, lambda w: {f"_l{k}": d * F.lag(d, k).over(w) for k in range(1, max_lag + 1)}, back=max_lag)
    wide = rows.groupBy(*axis.key).agg(
        F.max("_n").alias("_n"), F.array(*[F.sum(f"_l{k}") / F.sum(d * d) for k in range(1, max_lag + 1)]).alias("_a")
    )
    out = wide.select(*axis.key, "_n", F.posexplode("_a").alias("_i", "acf")).withColumn("lag", F.col("_i") + 1)
    return out.filter(F.col("lag") <= F.floor(F.col("_n") / 2)).select(*axis.key, "lag", "acf")


def seasonal_period_acf(y: DataFrame, max_period: int = 48, axis: Axis = PANEL, height: float = 0.1) -> DataFrame:
    """First local maximum of the autocorrelation of at least ``height``; null when there is none."""
    a = acf(y, max_period, axis)
    line = Window.partitionBy(*axis.key).orderBy("lag")  # max_period rows per entity
    a = a.withColumns({"_p": F.lag("acf").over(line), "_q": F.lead("acf").over(line)})
    peak = (F.col("acf") > F.col("_p")) & (F.col("acf") > F.col("_q")) & (F.col("acf") >= height)
    return a.groupBy(*axis.key).agg(F.min(F.when(peak, F.col("lag"))).alias("period"), F.min_by("acf", F.when(peak, F.col("lag"))).alias("strength"))


def periodogram(y: DataFrame, max_period: int = 48, axis: Axis = PANEL) -> DataFrame:
    """Amplitude of the detrended values at the periods 2 … max_period (at most half the series), in long form.

    Sums of the values times cosine and sine over the whole series: partial sums per task, nothing is cut or sorted.
    """
    turn = lambda p: F.col(POS) * F.lit(2 * math.pi / p)
    d, periods = F.col("detrended"), range(2, max_period + 1)
    wide = detrended(y, axis).groupBy(*axis.key).agg(F.max("_n").alias("_n"), F.array(*[F.hypot(F.sum(d * F.cos(turn(p))), F.sum(d * F.sin(turn(p)))) for p in periods]).alias("_a"))
    out = wide.select(*axis.key, "_n", F.posexplode("_a").alias("_i", "amplitude")).withColumn("period", F.col("_i") + 2)
    return out.filter(F.col("period") <= F.floor(F.col("_n") / 2)).select(*axis.key, "period", "amplitude")


def seasonal_period_spectrum(y: DataFrame, max_period: int = 48, axis: Axis = PANEL) -> DataFrame:
    """Period of the largest amplitude of the detrended values (the shorter one on ties), and its strength: a tenth of how
    often it exceeds the mean amplitude, at most 1."""
    out = periodogram(y, max_period, axis).groupBy(*axis.key).agg(
        F.max_by("period", F.struct("amplitude", -F.col("period"))).alias("period"), F.max("amplitude").alias("_x"), F.avg("amplitude").alias("_m")
    )
    return out.select(*axis.key, "period", F.least(F.col("_x") / positive(F.col("_m")) / 10, F.lit(1.0)).alias("strength"))


def decompose(y: DataFrame, period: int, model: str = "additive", axis: Axis = PANEL) -> DataFrame:
    """Classical decomposition: centred moving average, phase means (centred), residual; null trend at the ends.

    Entities shorter than two periods are left out; an even period halves the two end weights.
    """
    half = n_side = period // 2

    def cols(w):
        inner = w.rowsBetween(-n_side, n_side)
        known = F.count("value").over(inner) == 2 * n_side + 1
        total = F.sum("value").over(inner)
        if period % 2 == 0:
            total = total - (F.lag("value", half).over(w) + F.lead("value", half).over(w)) / 2
        return {"trend": F.when(known, total / period)}

    rows = number(y, axis, length="_n").filter(F.col("_n") >= 2 * period)
    rows = over_blocks(rows, axis, cols, back=n_side, ahead=n_side, keep_pos=True)
    free = F.col("value") - F.col("trend") if model == "additive" else F.col("value") / F.col("trend")
    rows = rows.withColumns({"_f": free, "_phase": (F.col(POS) - 1) % period})
    phases = rows.groupBy(*axis.key, "_phase").agg(F.avg("_f").alias("_pm"))
    centre = phases.groupBy(*axis.key).agg(F.avg("_pm").alias("_c"))
    phases = phases.join(centre, list(axis.key))
    seasonal = F.col("_pm") - F.col("_c") if model == "additive" else F.col("_pm") / F.col("_c")
    rows = rows.join(phases.select(*axis.key, "_phase", seasonal.alias("seasonal")), [*axis.key, "_phase"])
    resid = F.col("value") - F.col("trend") - F.col("seasonal") if model == "additive" else F.col("value") / (F.col("trend") * F.col("seasonal"))
    adjusted = F.col("value") - F.col("seasonal") if model == "additive" else F.col("value") / F.col("seasonal")
    return rows.withColumns({"residual": resid, "adjusted": adjusted}).drop("_f", "_phase", "_n", POS)


def strengths(parts: DataFrame, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Seasonal and trend strength: 1 − var(residual) / (var(component) + var(residual)), not below 0."""
    r = F.var_pop("residual")

    def strength(c: str) -> Column:
        v = F.var_pop(F.when(F.col("residual").isNotNull(), F.col(c)))
        return F.when(v + r > 0, F.greatest(1 - r / (v + r), F.lit(0.0))).otherwise(0.0)

    out = parts.groupBy(*keys).agg(strength("seasonal").alias("seasonal_strength"), strength("trend").alias("trend_strength"))
    return out.withColumns({"is_seasonal": F.col("seasonal_strength") > 0.3, "is_trending": F.col("trend_strength") > 0.3})


# --- smoothing ------------------------------------------------------------------------------------------------------


def smooth_kernel(y: DataFrame, weights: Sequence[float], axis: Axis = PANEL, out: str = "smoothed") -> DataFrame:
    """Centred weighted mean; at the ends the weights in reach are scaled to one."""
    half = len(weights) // 2

    def cols(w):
        num, den = F.lit(0.0), F.lit(0.0)
        for i, k in enumerate(weights):
            x = F.lag("value", half - i).over(w)
            num = num + F.coalesce(x, F.lit(0.0)) * float(k)
            den = den + F.when(x.isNotNull(), float(k)).otherwise(0.0)
        return {out: num / positive(den)}

    return over_blocks(y, axis, cols, back=half, ahead=half)


def kernel(kind: str, length: int = 5, sigma: float = 1.0) -> list[float]:
    if kind == "gaussian":
        half = max(1, math.ceil(4 * sigma))
        return [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-half, half + 1)]
    return [1.0] * length


def smooth_polynomial(y: DataFrame, degree: int = 3, axis: Axis = PANEL, out: str = "smoothed") -> DataFrame:
    """Polynomial of the scaled position fitted by least squares per entity."""
    rows = number(y, axis, length="_n")
    t = (F.col(POS) - 1) / F.greatest(F.col("_n") - 1, F.lit(1))
    rows = rows.withColumns({f"_t{i}": F.pow(t, F.lit(float(i))) for i in range(1, degree + 1)})
    names = [f"_t{i}" for i in range(1, degree + 1)]
    fit = ols(rows, list(axis.key), "value", names)
    coef = fit.groupBy(*axis.key).agg(*[F.max(F.when(F.col("term") == n, F.col("coef"))).alias(f"_c{n}") for n in ("const", *names)])
    line = F.col("_cconst")
    for n in names:
        line = line + F.col(f"_c{n}") * F.col(n)
    rows = rows.join(coef, list(axis.key), "left").withColumn(out, line)
    return rows.drop("_n", POS, "_cconst", *names, *[f"_c{n}" for n in names])


def smooth_exponential(y: DataFrame, alpha: float = 0.3, axis: Axis = PANEL, out: str = "smoothed") -> DataFrame:
    return smoothed(y, axis, [(out, "value", alpha)])


def smooth_binned(y: DataFrame, size: int = 10, axis: Axis = PANEL, out: str = "smoothed") -> DataFrame:
    """Mean of each run of ``size`` rows."""
    rows = number(y, axis).withColumn("_bin", F.floor((F.col(POS) - 1) / size))
    return whole_by(rows, [*axis.key, "_bin"], {out: F.avg("value")}).drop("_bin", POS)


def sigma_bands(smoothed_rows: DataFrame, n: float = 2.0, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Smooth ± n population deviations of the residual; values outside are outliers."""
    rows = whole_by(smoothed_rows.withColumn("_r", F.col("value") - F.col("smoothed")), list(keys), {"_s": F.stddev_pop("_r")})
    rows = rows.withColumns({"lower_bound": F.col("smoothed") - n * F.col("_s"), "upper_bound": F.col("smoothed") + n * F.col("_s")})
    out = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return rows.withColumn("is_outlier", out).drop("_r", "_s")


# --- forecasts ------------------------------------------------------------------------------------------------------


def _last_values(y: DataFrame, axis: Axis, n: int) -> DataFrame:
    """The last ``n`` values of each entity (newest first), their time and the last time step."""
    top = ranking.top_n(y, list(axis.key), [F.desc(axis.order[0])], n)
    rows = top.groupBy(*axis.key).agg(F.array_sort(F.collect_list(F.struct("rank", "value", axis.order[0]))).alias("_v"))  # n entries
    t = lambda i: F.unix_micros(F.get("_v", i)[axis.order[0]].cast("timestamp"))
    return rows.select(*axis.key, F.transform("_v", lambda x: x["value"]).alias("_v"), t(0).alias("_t"), (t(0) - t(1)).alias("_step"))


def _future(rows: DataFrame, axis: Axis, values: Column) -> DataFrame:
    """One row per step of an array of forecasts."""
    out = rows.select(*axis.key, "_t", "_step", F.posexplode(values).alias("_i", "value"))
    when = F.timestamp_micros(F.col("_t") + F.col("_step") * (F.col("_i") + 1))
    return out.select(*axis.key, (F.col("_i") + 1).alias("horizon"), when.alias(axis.order[0]), "value")


def forecast_linear(y: DataFrame, fh: int, lags: int = 3, ridge: float = 0.0, axis: Axis = PANEL) -> DataFrame:
    """Least squares (ridge with a penalty on the slopes) on the last ``lags`` values, rolled ``fh`` steps ahead."""
    names = [f"_l{k}" for k in range(1, lags + 1)]
    rows = over_blocks(y, axis, lambda w: {f"_l{k}": F.lag("value", k).over(w) for k in range(1, lags + 1)}, back=lags)
    if ridge:
        m = rows.dropna(subset=names).groupBy(*axis.key).agg(F.avg("value").alias("_my"), *[F.avg(n).alias(f"_m{n}") for n in names])
        centred = rows.dropna(subset=names).join(m, list(axis.key))
        centred = centred.withColumns({"_y": F.col("value") - F.col("_my"), **{f"_x{n}": F.col(n) - F.col(f"_m{n}") for n in names}})
        aug = [F.struct(F.lit(0.0).alias("_y"), *[F.lit(math.sqrt(ridge) if i == j else 0.0).alias(f"_x{n}") for j, n in enumerate(names)]) for i in range(lags)]
        extra = m.select(*axis.key, F.explode(F.array(*aug)).alias("_e")).select(*axis.key, "_e.*")
        both = centred.select(*axis.key, "_y", *[f"_x{n}" for n in names]).unionByName(extra)
        fit = ols(both, list(axis.key), "_y", [f"_x{n}" for n in names], constant=False)
        coef = fit.groupBy(*axis.key).agg(*[F.max(F.when(F.col("term") == f"_x{n}", F.col("coef"))).alias(f"_c{n}") for n in names]).join(m, list(axis.key))
        const = F.col("_my")
        for n in names:
            const = const - F.col(f"_c{n}") * F.col(f"_m{n}")
        coef = coef.withColumn("_c0", const)
    else:
        fit = ols(rows, list(axis.key), "value", names)
        coef = fit.groupBy(*axis.key).agg(*[F.max(F.when(F.col("term") == t, F.col("coef"))).alias(c) for t, c in [("const", "_c0"), *[(n, f"_c{n}") for n in names]]])
    last = _last_values(y, axis, max(lags, 2)).join(coef, list(axis.key))
    slopes = F.array(*[F.col(f"_c{n}") for n in names])

    def roll(a: Column, _: Column) -> Column:
        nxt = F.col("_c0") + F.aggregate(F.zip_with(slopes, F.slice(a, 1, lags), lambda c, x: c * x), F.lit(0.0), lambda s, x: s + x)
        return F.concat(F.array(nxt), a)

    path = F.aggregate(F.sequence(F.lit(1), F.lit(fh)), F.col("_v"), roll)
    return _future(last, axis, F.reverse(F.slice(path, 1, fh)))


def forecast_knn(y: DataFrame, fh: int, lags: int = 3, k: int = 5, axis: Axis = PANEL) -> DataFrame:
    """Mean of what followed the ``k`` past windows nearest to the last one (direct, one mean per horizon)."""

    def cols(w):
        v = F.collect_list("value").over(trailing(w, lags))
        after = F.collect_list("value").over(w.rowsBetween(1, fh))
        return {"_x": full(v, "value", w, lags), "_a": F.when(F.count("value").over(w.rowsBetween(1, fh)) == fh, after)}

    rows = over_blocks(y, axis, cols, back=lags - 1, ahead=fh).filter(F.col("_x").isNotNull() & F.col("_a").isNotNull())
    last = _last_values(y, axis, max(lags, 2))
    rows = rows.join(last, list(axis.key))
    gap = F.aggregate(F.zip_with("_x", F.reverse(F.slice("_v", 1, lags)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    near = ranking.top_n(rows.withColumn("_d", gap), list(axis.key), [F.asc("_d"), F.asc(axis.order[0])], k)
    steps = near.select(*axis.key, F.posexplode("_a").alias("_i", "_f")).groupBy(*axis.key, "_i").agg(F.avg("_f").alias("value"))
    out = steps.join(last.select(*axis.key, "_t", "_step"), list(axis.key))
    return out.select(*axis.key, (F.col("_i") + 1).alias("horizon"), F.timestamp_micros(F.col("_t") + F.col("_step") * (F.col("_i") + 1)).alias(axis.order[0]), "value")


def forecast_smoothing(y: DataFrame, fh: int, alpha: float = 0.3, axis: Axis = PANEL) -> DataFrame:
    """Simple exponential smoothing: the last level for every horizon."""
    level = smoothed(y, axis, [("_level", "value", alpha)])
    at = F.struct(*axis.order)
    last = level.groupBy(*axis.key).agg(F.max_by("_level", at).alias("_l"))
    rows = _last_values(y, axis, 2).join(last, list(axis.key))
    return _future(rows, axis, F.array_repeat("_l", fh))


def forecast_holt(y: DataFrame, fh: int, alpha: float = 0.3, beta: float = 0.1, axis: Axis = PANEL) -> DataFrame:
    """Holt's level and trend (starting at the first value and the first difference), extended linearly."""
    key, ts = list(axis.key), axis.order[0]
    schema = T.StructType([*[y.schema[k] for k in key], y.schema[ts], T.StructField("level", T.DoubleType()), T.StructField("trend", T.DoubleType())])

    def maps(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """level' = alpha x + (1 - alpha)(level + trend); trend' = beta (level' - level) + (1 - beta) trend, as a matrix and an offset."""
        x, at = part["value"].astype(float).to_numpy(), part[POS].to_numpy()
        m = np.tile([[1 - alpha, 1 - alpha], [-alpha * beta, 1 - alpha * beta]], (len(x), 1, 1))
        c = np.stack([alpha * x, alpha * beta * x], axis=1)
        m[at == 1], c[at == 1] = 0.0, np.stack([x, np.zeros(len(x))], axis=1)[at == 1]
        m[at == 2], c[at == 2] = [[0.0, 0.0], [-1.0, 0.0]], np.stack([x, x], axis=1)[at == 2]
        return m, c

    def run(part: pd.DataFrame, state):
        level, trend = state if state else [0.0, 0.0]
        out = []
        for x, at in zip(part["value"].to_numpy(), part[POS].to_numpy()):
            if at == 1:
                level, trend = x, 0.0
            elif at == 2:
                level, trend = x, x - level
            else:
                before = level
                level = alpha * x + (1 - alpha) * (level + trend)
                trend = beta * (level - before) + (1 - beta) * trend
            out.append((level, trend))
        res = part[[*key, ts]].reset_index(drop=True)
        res[["level", "trend"]] = pd.DataFrame(out)
        return res, [level, trend]

    state = fold(number(y.select(*key, ts, "value"), axis), axis, run, schema, machine=Affine(2, maps))
    last = state.groupBy(*key).agg(F.max_by(F.struct("level", "trend"), ts).alias("_s"))
    rows = _last_values(y, axis, 2).join(last, key)
    return _future(rows, axis, F.transform(F.sequence(F.lit(1), F.lit(fh)), lambda h: F.col("_s.level") + h * F.col("_s.trend")))


def forecast_metrics(actual: DataFrame, forecast: DataFrame, train: DataFrame | None = None, axis: Axis = PANEL, season: int = 1) -> DataFrame:
    """MAE, MAPE, MSE, RMSE, sMAPE, over- and under-forecast share and, with training data, MASE and RMSSE per entity."""
    on = [*axis.key, axis.order[0]]
    rows = actual.select(*on, F.col("value").alias("_a")).join(forecast.select(*on, F.col("value").alias("_f")), on)
    e = F.col("_f") - F.col("_a")
    out = rows.groupBy(*axis.key).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(F.abs(e) / F.abs(positive(F.col("_a")))).alias("mape"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(2 * F.abs(e) / positive(F.abs("_a") + F.abs("_f"))).alias("smape"), F.avg((e > 0).cast("double")).alias("overforecast"),
        F.avg((e < 0).cast("double")).alias("underforecast"), F.count(F.lit(1)).alias("n"),
    )
    if train is None:
        return out
    steps = over_blocks(train, axis, lambda w: {"_d": F.col("value") - F.lag("value", season).over(w)}, back=season)
    scale = steps.groupBy(*axis.key).agg(F.avg(F.abs("_d")).alias("_s"), F.avg(F.col("_d") * F.col("_d")).alias("_q"))
    out = out.join(scale, list(axis.key), "left")
    return out.withColumns({"mase": F.col("mae") / positive(F.col("_s")), "rmsse": F.sqrt(F.col("mse") / positive(F.col("_q")))}).drop("_s", "_q")


def split_tail(y: DataFrame, test_size: int, axis: Axis = PANEL) -> DataFrame:
    """Last ``test_size`` rows of each entity are the test set."""
    rows = number(y, axis, length="_n")
    return rows.withColumn("set", F.when(F.col(POS) > F.col("_n") - test_size, "test").otherwise("train")).drop("_n", POS)


def tail_splits(y: DataFrame, test_size: int = 1, n_splits: int = 3, step: int = 1, train_size: int | None = None, axis: Axis = PANEL) -> DataFrame:
    """Splits ending at the last row, ``step`` rows apart: expanding train sets, or sliding ones of ``train_size``."""
    rows = number(y, axis, length="_n").withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    cut = F.col("_n") - test_size - step * (n_splits - 1 - F.col("split"))
    first = cut - train_size if train_size else F.lit(0)
    kind = F.when((F.col(POS) > cut) & (F.col(POS) <= cut + test_size), "test").when((F.col(POS) <= cut) & (F.col(POS) > first), "train")
    return rows.withColumn("set", kind).filter(F.col("set").isNotNull() & (cut > 0)).drop("_n", POS)


MODELS = ("naive", "mean", "drift", "smoothing")


def rolling_origin(y: DataFrame, start: int, horizons: Sequence[int], step: int = 1, alpha: float = 0.3, axis: Axis = PANEL) -> DataFrame:
    """Forecasts of several models from every origin (rows start, start + step, …) against the actual values.

    Each model's forecast at an origin is a running value of the rows before it, so all origins are one pass.
    """
    key, ts = list(axis.key), axis.order[0]
    top = max(horizons)
    rows = number(y, axis, length="_n")
    rows = prefix(rows, axis, {"_sum": ("sum", "value"), "_first": ("first", "value")})
    rows = smoothed(rows, axis, [("_level", "value", alpha)])
    rows = over_blocks(rows, axis, lambda w: {f"_f{h}": F.lead("value", h).over(w) for h in horizons}, ahead=top, keep_pos=True)
    at = F.col(POS)
    rows = rows.filter((at >= start) & ((at - start) % step == 0) & (at + top <= F.col("_n")))
    drift = lambda h: F.col("value") + h * (F.col("value") - F.col("_first")) / F.greatest(at - 1, F.lit(1))
    each = [
        F.struct(F.lit(m).alias("model"), F.lit(h).alias("horizon"), f.alias("forecast"), F.col(f"_f{h}").alias("actual"))
        for h in horizons
        for m, f in (("naive", F.col("value")), ("mean", F.col("_sum") / at), ("drift", drift(h)), ("smoothing", F.col("_level")))
    ]
    out = rows.select(*key, F.col(ts).alias("origin_time"), at.alias("origin"), F.explode(F.array(*each)).alias("_e"))
    return out.select(*key, "origin_time", "origin", "_e.*").withColumn("error", F.col("forecast") - F.col("actual"))


def compare_models(backtest: DataFrame, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """MAE, RMSE, MAPE and bias per entity, model and horizon."""
    e = F.col("error")
    return backtest.groupBy(*keys, "model", "horizon").agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (F.avg(F.abs(e / (F.col("actual") + 1e-10))) * 100).alias("mape"),
        F.avg(e).alias("bias"), F.count(F.lit(1)).alias("n"),
    )


# --- tests ----------------------------------------------------------------------------------------------------------

# Dickey-Fuller critical values with a constant (large samples).
ADF_CRITICAL = {"1%": -3.43035, "5%": -2.86154, "10%": -2.56677}


def adf(y: DataFrame, lags: int = 1, axis: Axis = PANEL) -> DataFrame:
    """Augmented Dickey-Fuller statistic with a constant and a fixed number of lagged differences."""
    def first(w):
        return {"_d": F.col("value") - F.lag("value").over(w), "_l": F.lag("value").over(w)}

    def second(w):
        return {f"_d{k}": F.lag("_d", k).over(w) for k in range(1, lags + 1)}

    rows = over_blocks(y, axis, [first, second], back=lags + 1)
    fit = ols(rows, list(axis.key), "_d", ["_l", *[f"_d{k}" for k in range(1, lags + 1)]])
    out = fit.filter("term = '_l'").select(*axis.key, F.col("t").alias("adf"), F.col("n").alias("observations"))
    return out.withColumns({f"below_{k.rstrip('%')}": F.col("adf") < v for k, v in ADF_CRITICAL.items()})


def ljung_box(y: DataFrame, lags: int = 10, axis: Axis = PANEL) -> DataFrame:
    """Ljung-Box Q with its chi-square p-value."""
    rows = whole(y, axis, {"_m": F.avg("value"), "_n": F.count("value")}).withColumn("_c", F.col("value") - F.col("_m"))
    c = F.col("_c")
    rows = over_blocks(rows, axis, lambda w: {f"_l{k}": c * F.lag(c, k).over(w) for k in range(1, lags + 1)}, back=lags)
    q = F.lit(0.0)
    n = F.max("_n")
    for k in range(1, lags + 1):
        rho = F.sum(f"_l{k}") / F.sum(c * c)
        q = q + rho * rho / (n - k)
    out = rows.groupBy(*axis.key).agg((n * (n + 2) * q).alias("q"), n.alias("n"))
    return out.withColumn("p_value", chi2_p_value("q", F.lit(float(lags))))


def normality(y: DataFrame, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Jarque-Bera statistic from population skewness and kurtosis, and its chi-square p-value (exp(−JB/2))."""
    s, k, n = F.skewness("value"), F.kurtosis("value"), F.count("value")
    out = y.groupBy(*keys).agg((n / 6 * (s * s + k * k / 4)).alias("jarque_bera"), s.alias("skewness"), (k + 3).alias("kurtosis"), n.alias("n"))
    return out.withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))


def durbin_watson(y: DataFrame, axis: Axis = PANEL) -> DataFrame:
    rows = over_blocks(y, axis, lambda w: {"_d": F.col("value") - F.lag("value").over(w)}, back=1)
    return rows.groupBy(*axis.key).agg((F.sum(F.col("_d") * F.col("_d")) / positive(F.sum(F.col("value") * F.col("value")))).alias("durbin_watson"))


def t_test(y: DataFrame, mean: float = 0.0, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """One-sample t with its two-sided p-value."""
    n = F.count("value")
    out = y.groupBy(*keys).agg(((F.avg("value") - mean) / (F.stddev_samp("value") / F.sqrt(n))).alias("t"), n.alias("n"))
    return out.withColumn("p_value", t_p_value("t", (F.col("n") - 1).cast("double")))


def rolling_regression(rows: DataFrame, y: str, x: str, n: int, axis: Axis) -> DataFrame:
    """Slope, intercept and R² of the last ``n`` rows."""

    def cols(w):
        f = trailing(w, n)
        known = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).over(f) == n
        return {
            "slope": F.when(known, F.regr_slope(y, x).over(f)), "intercept": F.when(known, F.regr_intercept(y, x).over(f)),
            "r2": F.when(known, F.pow(F.corr(y, x).over(f), F.lit(2.0))),
        }

    return over_blocks(rows, axis, cols, back=n - 1)


# --- multivariate -----------------------------------------------------------------------------------------------------


def principal_components(pairs: DataFrame, components: int = 3, standardize: bool = True) -> DataFrame:
    """Eigenvalues, explained share and loadings from the table of pairwise covariances and correlations (a, b, cov, corr).

    The panel is reduced to its pair table by Spark; the eigen problem has the size of the universe squared.
    """
    schema = T.StructType(
        [T.StructField("component", T.IntegerType()), T.StructField("symbol", T.StringType()), T.StructField("eigenvalue", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("loading", T.DoubleType())]
    )
    what = "corr" if standardize else "cov"

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(part["a"]) | set(part["b"]))
        at = {s: i for i, s in enumerate(names)}
        m = np.eye(len(names))
        i, j, v = part["a"].map(at).to_numpy(), part["b"].map(at).to_numpy(), part[what].fillna(0.0).to_numpy()
        m[i, j] = v
        m[j, i] = v
        values, vectors = np.linalg.eigh(m)
        order = np.argsort(values)[::-1][:components]
        out = []
        for c, o in enumerate(order):
            vec = vectors[:, o] * (1 if vectors[np.argmax(np.abs(vectors[:, o])), o] > 0 else -1)
            out += [(c + 1, s, float(values[o]), float(values[o] / values.sum()), float(x)) for s, x in zip(names, vec)]
        return pd.DataFrame(out, columns=schema.names)

    return pairs.select("a", "b", F.col(what), F.lit(0).alias("_all")).groupBy("_all").applyInPandas(solve, schema)


def _reweighted(rows: DataFrame, y: str, xs: Sequence[str], family: str, steps: int = 50, tol: float = 1e-10) -> tuple[np.ndarray, float] | None:
    """Coefficients (constant first) and deviance by iteratively reweighted least squares; None where the normal equations are singular.

    Each step is one pass over the columns, which returns the sums of the normal equations.
    """
    t, x = F.col(y).cast("double"), [F.lit(1.0), *[F.col(c).cast("double") for c in xs]]
    p = len(x)

    def model(eta: Column) -> tuple[Column, Column]:
        """Mean and weight."""
        if family == "poisson":
            return F.exp(eta), F.exp(eta)
        if family == "binomial":
            mu = F.greatest(F.least(1 / (1 + F.exp(-eta)), F.lit(1 - 1e-16)), F.lit(1e-16))
            return mu, mu * (1 - mu)
        return eta, F.lit(1.0)

    start = {"poisson": F.log(F.greatest(t, F.lit(0.1))), "binomial": F.log((t + 0.5) / (1.5 - t)), "gaussian": t}[family]
    linear = lambda b: sum((F.lit(float(v)) * c for v, c in zip(b, x)), F.lit(0.0))
    beta, eta = None, start
    for _ in range(1 if family == "gaussian" else steps):
        mu, w = model(F.col("_eta"))
        data = rows.select(t.alias("_y"), *[c.alias(f"_{i}") for i, c in enumerate(x)], eta.alias("_eta")).select("*", mu.alias("_mu"), w.alias("_w"))
        data = data.select("*", (F.col("_eta") + (F.col("_y") - F.col("_mu")) / F.col("_w")).alias("_z"))
        cells = [(i, j) for i in range(p) for j in range(i, p)]
        sums = data.agg(
            *[F.sum(F.col("_w") * F.col(f"_{i}") * F.col(f"_{j}")) for i, j in cells], *[F.sum(F.col("_w") * F.col(f"_{i}") * F.col("_z")) for i in range(p)]
        ).first()
        if any(v is None or not math.isfinite(v) for v in sums):
            return None
        a = np.zeros((p, p))
        for (i, j), v in zip(cells, sums):
            a[i, j] = a[j, i] = v
        size = np.sqrt(np.diag(a))
        if (size == 0).any() or np.linalg.cond(a / np.outer(size, size)) > 1e12:
            return None
        new = np.linalg.solve(a / np.outer(size, size), np.array(sums[len(cells) :]) / size) / size
        done = beta is not None and np.abs(new - beta).max() <= tol * max(1.0, np.abs(new).max())
        beta, eta = new, linear(new)
        if done:
            break
    else:
        if family != "gaussian":
            return None
    mu = model(F.col("_eta"))[0]
    part = lambda u, m: F.when(u > 0, u * F.log(u / m)).otherwise(0.0)
    u, m = F.col("_y"), F.col("_mu")
    loss = {"poisson": 2 * (part(u, m) - (u - m)), "binomial": 2 * (part(u, m) + part(1 - u, 1 - m)), "gaussian": (u - m) * (u - m)}[family]
    deviance = rows.select(t.alias("_y"), eta.alias("_eta")).select("_y", mu.alias("_mu")).agg(F.sum(loss)).first()[0]
    return beta, float(deviance)


def glm(rows: DataFrame, y: str, xs: Sequence[str], family: str = "gaussian", link: str | None = None) -> DataFrame:
    """Generalised linear model: coefficient per term and the deviance.

    Gaussian, binomial and Poisson models with their own link are fitted by column sums; other ones, labels out of range and singular cases by MLlib.
    """
    known = rows.dropna(subset=[y, *xs])
    fitted = None
    if family in ("gaussian", "binomial", "poisson") and not link:
        low, high = known.agg(F.min(F.col(y).cast("double")), F.max(F.col(y).cast("double"))).first()
        if low is not None and (family == "gaussian" or low >= 0) and (family != "binomial" or high <= 1):
            fitted = _reweighted(known, y, xs, family)
    if fitted is None:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import GeneralizedLinearRegression

        data = VectorAssembler(inputCols=list(xs), outputCol="_x").transform(known)
        model = GeneralizedLinearRegression(family=family, featuresCol="_x", labelCol=y, maxIter=50, tol=1e-10, **({"link": link} if link else {})).fit(data)
        fitted = np.array([model.intercept, *model.coefficients]), float(model.summary.deviance)
    beta, deviance = fitted
    table = ", ".join(f"('{n}', {float(v)!r}D)" for n, v in zip(["const", *xs], beta))
    return rows.sparkSession.sql(f"SELECT term, coef, {deviance!r}D AS deviance FROM VALUES {table} AS t(term, coef)")


def kaplan_meier(rows: DataFrame, time: str = "time", event: str = "status", keys: Sequence[str] = ()) -> DataFrame:
    """Survival probability at each event time: rows at risk, events, running product."""
    counts = rows.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(event).cast("int")).alias("events"))
    part = [F.col(k) for k in keys] or [F.lit(0)]
    back = Window.partitionBy(*part).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)  # one row per distinct time
    fore = Window.partitionBy(*part).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    out = counts.withColumn("at_risk", F.sum("_n").over(back)).filter("events > 0")
    keep = 1 - F.col("events") / F.col("at_risk")
    alive = F.min(keep).over(fore) > 0
    out = out.withColumn("survival", F.when(alive, F.exp(F.sum(F.log(F.when(keep > 0, keep))).over(fore))).otherwise(0.0))
    return out.drop("_n")


# --- pattern search ---------------------------------------------------------------------------------------------------


def shape_features(v: Column) -> Column:
    """Eight numbers of a price window: direction, change, volatility, place of high and low, three partial moves."""
    n = F.size(v)
    at = lambda i: F.get(v, i)
    last, first = at(n - 1), at(0)
    rets = F.zip_with(F.slice(v, 1, n - 1), F.slice(v, 2, n - 1), lambda a, b: (b - a) / (a + 1e-8))
    m = F.aggregate(rets, F.lit(0.0), lambda s, x: s + x) / (n - 1)
    var = F.aggregate(rets, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / (n - 1)
    seg = F.floor(n / 3).cast("int")
    move = lambda a, b: F.tanh((b - a) / (a + 1e-8) * 10)
    return F.array(
        F.when(last > first, 1.0).otherwise(-1.0), move(first, last), F.least(F.sqrt(var) * math.sqrt(252) / 0.5, F.lit(1.0)),
        (F.array_position(v, F.array_max(v)) - 1) / (n - 1), (F.array_position(v, F.array_min(v)) - 1) / (n - 1),
        move(first, at(seg)), move(at(seg), at(2 * seg)), move(at(2 * seg), last),
    )


def _dtw(a: np.ndarray, b: np.ndarray, band: int) -> np.ndarray:
    """Banded DTW distance of each row of two equally long batches of scaled windows."""
    n, m = a.shape[1], b.shape[1]
    prev = np.full((len(a), m + 1), np.inf)
    prev[:, 0] = 0
    for i in range(1, n + 1):
        cur = np.full_like(prev, np.inf)
        for j in range(max(1, i - band), min(m, i + band) + 1):
            cost = np.abs(a[:, i - 1] - b[:, j - 1])
            cur[:, j] = cost + np.minimum(np.minimum(prev[:, j], cur[:, j - 1]), prev[:, j - 1])
        prev = cur
    return prev[:, m] / max(n, m)


SEGMENTS, LEVELS = 4, 8  # of a scaled window: segment means by level make its cell, at most LEVELS ** SEGMENTS of them
SEEDS = 32  # windows of a cell that give queries their first bound
BLOCK = 32_768  # windows of a cell compared by one task


def _scaled(v: np.ndarray) -> np.ndarray:
    low, high = v.min(1, keepdims=True), v.max(1, keepdims=True)
    return (v - low) / (high - low + 1e-8)


def _borders(n: int) -> list[int]:
    return [i * n // SEGMENTS for i in range(SEGMENTS + 1)]


def _cell(v: Column, n: int) -> Column:
    """Number of the cell of a window: level of the mean of each segment of the scaled window."""
    low, high = F.array_min(v), F.array_max(v)
    cell = F.lit(0)
    edges = _borders(n)
    for lo, hi in zip(edges, edges[1:]):
        mean = F.aggregate(F.slice(v, lo + 1, hi - lo), F.lit(0.0), lambda s, x: s + x) / (hi - lo)
        level = F.floor((mean - low) / (high - low + 1e-8) * LEVELS).cast("int")
        cell = cell * LEVELS + F.greatest(F.least(level, F.lit(LEVELS - 1)), F.lit(0))
    return cell


class _Envelope:
    """Scaled query windows with their highest and lowest values within the band; bounds of DTW from below."""

    def __init__(self, v: np.ndarray, band: int):
        self.band, self.q = band, _scaled(v)
        n = v.shape[1]
        wide = np.pad(self.q, ((0, 0), (band, band)), mode="edge")
        frames = np.lib.stride_tricks.sliding_window_view(wide, 2 * band + 1, axis=1)
        self.high, self.low, self.n = frames.max(2), frames.min(2), n

    def of_cells(self, cells: np.ndarray) -> np.ndarray:
        """Bound for each query and cell: every segment mean lies in its level, each value pays its distance to the envelope."""
        edges = _borders(self.n)
        total = np.zeros((len(self.q), len(cells)))
        for s, (lo, hi) in enumerate(zip(edges, edges[1:])):
            level = cells // LEVELS ** (SEGMENTS - 1 - s) % LEVELS
            above = level[None, :] / LEVELS - self.high[:, lo:hi].mean(1)[:, None]
            below = self.low[:, lo:hi].mean(1)[:, None] - (level[None, :] + 1) / LEVELS
            total += (hi - lo) * np.maximum(0, np.maximum(above, below))
        return total / self.n

    def of_windows(self, i: int, c: np.ndarray) -> np.ndarray:
        """Bound for query ``i`` and each scaled window."""
        return np.maximum(0, np.maximum(c - self.high[i], self.low[i] - c)).sum(1) / self.n


def _nearest(e: _Envelope, i: int, c: np.ndarray, order: np.ndarray, k: int, bound: float, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and distances of the ``k`` windows nearest to query ``i``, equal distances by ``order``; none beyond ``bound``."""
    least = e.of_windows(i, c)
    todo = np.argsort(least, kind="stable")
    best, far = np.empty(0, np.int64), np.empty(0)
    for at in range(0, len(todo), step):
        part = todo[at : at + step]
        part = part[least[part] <= bound + 1e-9]
        if not len(part):
            break
        found = _dtw(c[part], np.broadcast_to(e.q[i], (len(part), e.n)), e.band)
        best, far = np.concatenate([best, part]), np.concatenate([far, found])
        keep = np.lexsort((order[best], far))[:k]
        best, far = best[keep], far[keep]
        if len(best) == k:
            bound = min(bound, far[-1])
    inside = far <= bound + 1e-9
    return best[inside], far[inside]


def similar_patterns(bars: DataFrame, axis: Axis, length: int = 20, ahead: int = 5, k: int = 10, band: int = 5, reach: float | None = None) -> DataFrame:
    """For the newest window of each symbol the ``k`` earlier windows of any symbol with the smallest banded DTW distance, equal ones by symbol and time.

    Windows lie in cells by the means of their segments. A few windows of the nearest cells give each query a bound for its k-th distance; cells whose lower
    bound (envelope of the query against segment levels) is beyond it cannot hold a match, all others are searched whole, in blocks, with the bound of each window before its DTW.
    So nothing is lost, and a query meets only cells that may matter. ``reach`` keeps matches up to that feature distance (of the eight shape numbers) only, after the search.
    """
    checkpoint_folder(bars.sparkSession)
    key, ts = axis.key[0], axis.order[0]

    def cols(w):
        v = F.collect_list("close").over(trailing(w, length))
        return {"_v": full(v, "close", w, length), "_fwd": F.lead("close", ahead).over(w) / F.col("close") - 1}

    rows = over_blocks(bars.select(key, ts, F.col("close").cast("double").alias("close")), axis, cols, back=length - 1, ahead=ahead).filter(F.col("_v").isNotNull())
    rows = rows.select(key, ts, "_v", "_fwd", _cell(F.col("_v"), length).alias("_cell")).checkpoint()
    queries = rows.groupBy(key).agg(F.max_by(F.struct(ts, "_v"), ts).alias("_q")).select(F.col(key).alias("query"), F.col(f"_q.{ts}").alias("query_ts"), F.col("_q._v").alias("_qv")).checkpoint()
    windows = rows.filter(F.col("_fwd").isNotNull())
    counts = sorted((r["_cell"], r["count"]) for r in windows.groupBy("_cell").count().collect())  # at most LEVELS ** SEGMENTS
    cells, sizes = (np.array([c[j] for c in counts], dtype=np.int64) for j in (0, 1))

    def stacked(column: pd.Series) -> np.ndarray:
        return np.stack(column.to_numpy()).astype(float)

    def nearest_cells(parts):
        """The cells nearest to each query that hold four times as many seeds as it needs."""
        for part in parts:
            if len(part) and len(cells):
                bounds = _Envelope(stacked(part["_qv"]), band).of_cells(cells)
                order = np.argsort(bounds, axis=1, kind="stable")
                enough = (np.cumsum(np.minimum(sizes, SEEDS)[order], axis=1) < 4 * k).sum(1) + 1
                for i, n in enumerate(enough):
                    out = part.iloc[[i] * min(int(n), len(cells))].copy()
                    out["_cell"] = cells[order[i, : len(out)]]
                    yield out

    first = T.StructType([*queries.schema.fields, T.StructField("_cell", T.IntegerType())])
    seeds = ranking.top_n(windows, ["_cell"], [F.xxhash64(key, ts), F.col(key), F.col(ts)], SEEDS).select("_cell", "_v")
    met = queries.mapInPandas(nearest_cells, first).join(seeds, "_cell")

    def distances(parts):
        for part in parts:
            if len(part):
                yield pd.DataFrame({"query": part["query"], "_d": _dtw(_scaled(stacked(part["_v"])), _scaled(stacked(part["_qv"])), band)})

    found = met.select("query", "_qv", "_v").mapInPandas(distances, T.StructType([queries.schema["query"], T.StructField("_d", T.DoubleType())]))
    bound = ranking.top_n(found, ["query"], [F.asc("_d")], k).groupBy("query").agg(F.when(F.count("*") == k, F.max("_d")).alias("_bound"))
    bounded = queries.join(bound, "query", "left").withColumn("_bound", F.coalesce("_bound", F.lit(float("inf")))).checkpoint()
    blocks = np.maximum(1, -(-sizes // BLOCK))

    def possible(parts):
        """Blocks of the cells that can hold a match."""
        for part in parts:
            if len(part) and len(cells):
                can = _Envelope(stacked(part["_qv"]), band).of_cells(cells) <= part["_bound"].to_numpy()[:, None] + 1e-9
                for i in range(len(part)):
                    hit = np.flatnonzero(can[i])
                    out = part.iloc[[i] * int(blocks[hit].sum())].copy()
                    out["_cell"] = np.repeat(cells[hit], blocks[hit])
                    out["_block"] = np.concatenate([np.arange(b) for b in blocks[hit]]) if len(hit) else []
                    yield out

    second = T.StructType([*bounded.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_block", T.IntegerType())])
    asked = bounded.mapInPandas(possible, second)
    several = [F.when(F.col("_cell") == int(c), int(b)) for c, b in zip(cells, blocks) if b > 1]
    held = windows.withColumn("_block", F.pmod(F.xxhash64(key, ts), F.coalesce(*several, F.lit(1))).cast("int") if several else F.lit(0))
    schema = T.StructType([queries.schema["query"], queries.schema["query_ts"], bounded.schema["_qv"], rows.schema[key], rows.schema[ts], rows.schema["_v"], rows.schema["_fwd"], T.StructField("dtw", T.DoubleType())])

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            held = held.sort_values([key, ts]).reset_index(drop=True)
            e, c, order = _Envelope(stacked(asked["_qv"]), band), _scaled(stacked(held["_v"])), np.arange(len(held))
            for i, most in enumerate(asked["_bound"]):
                hit, far = _nearest(e, i, c, order, k, most)
                part = held.iloc[hit][[key, ts, "_v", "_fwd"]].reset_index(drop=True)
                own = asked.iloc[[i] * len(part)][["query", "query_ts", "_qv"]].reset_index(drop=True)
                out.append(pd.concat([own, part], axis=1).assign(dtw=far))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({f.name: [] for f in schema.fields})

    scored = asked.groupBy("_cell", "_block").cogroup(held.groupBy("_cell", "_block")).applyInPandas(search, schema)
    best = ranking.top_n(scored, ["query"], [F.asc("dtw"), F.asc(key), F.asc(ts)], k)
    gap = F.sqrt(F.aggregate(F.zip_with(shape_features(F.col("_v")), shape_features(F.col("_qv")), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    best = best.withColumn("feature_distance", gap).select("query", "query_ts", key, ts, "feature_distance", "dtw", F.col("_fwd").alias("forward_return"), "rank")
    return best if reach is None else best.filter(F.col("feature_distance") <= reach)


def pattern_win_rate(matches: DataFrame) -> DataFrame:
    """Share of matches that rose afterwards, mean forward return and a 0-3 score."""
    out = matches.groupBy("query").agg((F.avg((F.col("forward_return") > 0).cast("double")) * 100).alias("win_rate"), F.avg("forward_return").alias("avg_return"), F.count(F.lit(1)).alias("matches"))
    w = F.col("win_rate")
    score = F.when(w >= 70, 3.0).when(w >= 55, 2 + (w - 55) / 15).when(w >= 40, 1 + (w - 40) / 15).otherwise(F.greatest(w / 40, F.lit(0.0)))
    out = out.withColumn("score", F.bround(score, 2))
    return out.withColumn("label", F.when(F.col("score") >= 2.5, "Strong").when(F.col("score") >= 1.5, "Moderate").otherwise("Weak"))


# --- multiple tests ---------------------------------------------------------------------------------------------------


def adjust_p_values(rows: DataFrame, p: str = "p_value", alpha: float = 0.05, keys: Sequence[str] = ()) -> DataFrame:
    """Bonferroni and Benjamini-Hochberg adjusted p-values and rejections within each group of tests."""
    group = list(keys)
    pos = ranking.value_positions(rows, group, p)
    rank = F.col(ranking.BELOW) + F.col(ranking.SAME)
    pos = pos.withColumns({"_rank": rank, "_raw": F.col(p) * F.col(ranking.SIZE) / rank, "_all": F.lit(0)})
    axis = Axis(key=tuple(group) or ("_all",), order=("_rank",), span=1 << 16)
    pos = prefix(pos, axis, {"_bh": ("min", "_raw")}, backward=True)
    pos = pos.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col(p).alias("_p"), F.least("_bh", F.lit(1.0)).alias("p_bh"), F.least(F.col(p) * F.col(ranking.SIZE), F.lit(1.0)).alias("p_bonferroni"))
    on = F.col(p) == F.col("_p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = rows.join(pos, on, "left").drop("_p", *[f"_g_{g}" for g in group])
    return out.withColumns({"reject_bh": F.col("p_bh") <= alpha, "reject_bonferroni": F.col("p_bonferroni") <= alpha})
