"""User-defined factors, filters, features and indicators.

Arithmetic, comparisons and logic between factors are ``Column`` operators; this module adds what needs a window
or a user function. User functions receive whole blocks of a series as numpy arrays: a block is a bounded stretch
of one series together with the rows its window looks back on, so a long series is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import indicators, ranking
from candlewick.operators.series import BLK, POS, Axis, HOURLY, blocked, core, over_blocks, trailing

# ------------------------------------------------------------------------------------------------ user functions


def over_series(
    df: DataFrame, axis: Axis, inputs: Sequence[str], outputs: Sequence[str], fn: Callable[..., Sequence[np.ndarray]], back: int
) -> DataFrame:
    """``fn(*arrays)`` per block of a series, one array per input in time order; one array per output comes back.

    ``back`` is the number of earlier rows a result depends on.
    """
    rows = blocked(df, axis, back=back)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(o, T.DoubleType()) for o in outputs]])

    def apply(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(POS)
        results = fn(*[g[c].to_numpy(float) for c in inputs])
        return g.assign(**{o: np.asarray(x, float) for o, x in zip(outputs, results)})

    out = core(rows.groupBy(*axis.key, BLK).applyInPandas(apply, schema))
    return out.withColumns({o: F.when(~F.isnan(o), F.col(o)) for o in outputs})


def custom_factor(df: DataFrame, axis: Axis, name: str, inputs: Sequence[str], window: int, compute: Callable[..., np.ndarray]) -> DataFrame:
    """Factor over a trailing window: ``compute(*inputs)`` gets arrays of shape (rows, window) and returns one value per row.

    Rows with fewer than ``window`` rows of history get null.
    """

    def fn(*arrays):
        out = np.full(len(arrays[0]), np.nan)
        if len(out) >= window:
            out[window - 1:] = compute(*[sliding_window_view(a, window) for a in arrays])
        return (out,)

    return over_series(df, axis, inputs, [name], fn, back=window - 1)


def rolling_apply(df: DataFrame, axis: Axis, name: str, value: str, window: int, func: Callable[[np.ndarray], float]) -> DataFrame:
    """``func`` over the last ``window`` values of a column."""
    return custom_factor(df, axis, name, [value], window, lambda w: np.apply_along_axis(func, 1, w))


def indicator_factory(func: Callable[..., Sequence[np.ndarray]], inputs: Sequence[str], params: Sequence[str], outputs: Sequence[str], short_name: str = "custom"):
    """Turn ``func(*inputs, *params) -> outputs`` into ``run(df, axis, back, **params)``; columns are ``<short_name>_<output>``."""

    def run(df: DataFrame, axis: Axis, back: int, **values) -> DataFrame:
        missing = [p for p in params if p not in values]
        if missing:
            raise ValueError(f"{short_name}: missing parameters {missing}")
        chosen = [values[p] for p in params]
        return over_series(df, axis, inputs, [f"{short_name}_{o}" for o in outputs], lambda *a: func(*a, *chosen), back)

    return run


def apply_transformers(df: DataFrame, transformers: Sequence[Mapping], axis: Axis = HOURLY) -> DataFrame:
    """Add indicators from a list of ``{"name", "transformer", "args"}``; arguments are positional or by name.

    All of them are computed in one pass over the series.
    """
    import inspect

    wanted = {}
    for t in transformers:
        builder, _ = indicators.REGISTRY[t["transformer"]]
        args = t.get("args") or {}
        if not isinstance(args, Mapping):
            args = dict(zip(list(inspect.signature(builder).parameters)[1:], args))
        wanted[t["name"]] = (t["transformer"], dict(args))
    return indicators.compute(df, wanted, axis)


# ------------------------------------------------------------------------------------------------ feature expressions


class Features:
    """The ten feature functions over one series, as columns; columns of the frame are attributes."""

    def __init__(self, w: WindowSpec):
        self._w = w

    def __getattr__(self, name: str) -> Column:
        return F.col(name)

    def _full(self, agg, x: Column, n: int) -> Column:
        w = trailing(self._w, n)
        return F.when(F.count(x).over(w) == n, agg(x).over(w))

    def ref(self, x: Column, n: int) -> Column:
        return F.lag(x, n).over(self._w) if n >= 0 else F.lead(x, -n).over(self._w)

    def mean(self, x: Column, n: int) -> Column:
        return self._full(F.avg, x, n)

    def std(self, x: Column, n: int) -> Column:
        return self._full(F.stddev_samp, x, n)

    def sum(self, x: Column, n: int) -> Column:
        return self._full(F.sum, x, n)

    def max(self, x: Column, n: int) -> Column:
        return self._full(F.max, x, n)

    def min(self, x: Column, n: int) -> Column:
        return self._full(F.min, x, n)

    def rank(self, x: Column, n: int) -> Column:
        """Average rank of the value among the last ``n``, as a share."""
        w = trailing(self._w, n)
        values = F.collect_list(x).over(w)
        below = F.size(F.filter(values, lambda v: v < x))
        same = F.size(F.filter(values, lambda v: v == x))
        return F.when(F.count(x).over(w) == n, (below + (same + 1) / 2) / n)

    def log(self, x: Column) -> Column:
        return F.log(x)

    def abs(self, x: Column) -> Column:
        return F.abs(x)

    def sign(self, x: Column) -> Column:
        return F.signum(x)


def features(df: DataFrame, axis: Axis, steps: Sequence[Mapping[str, Callable[[Features], Column]]], back: int) -> DataFrame:
    """Feature columns ``{name: lambda f: …}``; a later step may use windows over the columns of an earlier one.

    ``back`` is the sum of the look-backs over the steps.
    """
    build = lambda step: lambda w: {n: e(Features(w)) for n, e in step.items()}
    return over_blocks(df, axis, [build(s) for s in steps], back=back)


# ------------------------------------------------------------------------------------------------ pipelines


def pipeline(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], screen: Column | None = None) -> DataFrame:
    """Named factor columns for the rows that pass the screen."""
    out = df.filter(screen) if screen is not None else df
    return out.select(*keys, *[c.alias(n) for n, c in columns.items()])


def if_else(condition: Column, yes: Column, no: Column) -> Column:
    """A missing condition counts as false."""
    return F.when(F.coalesce(condition, F.lit(False)), yes).otherwise(no)


def is_null(x: Column) -> Column:
    return x.isNull() | F.isnan(x.cast("double"))


def not_null(x: Column) -> Column:
    return ~is_null(x)


def negate(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def static_assets(asset: Column, chosen: Sequence) -> Column:
    return asset.isin(list(chosen))


def single_asset(asset: Column, chosen) -> Column:
    return asset == chosen


def everything() -> Column:
    return F.lit(0)


def with_presence(df: DataFrame, axis: Axis, inputs: Sequence[str], window: int, least: int | None = None, out: str = "present") -> DataFrame:
    """Whether every input holds a value in all (or at least ``least``) of the last ``window`` rows."""
    need = window if least is None else least
    ok = F.lit(True)
    for c in inputs:
        ok = ok & (F.coalesce(F.col(f"_n_{c}"), F.lit(0)) >= need)
    frames = lambda w: {f"_n_{c}": F.count(F.when(not_null(F.col(c)), 1)).over(trailing(w, window)) for c in inputs}
    return over_blocks(df, axis, frames, back=window).withColumn(out, ok).drop(*[f"_n_{c}" for c in inputs])


def quantile_classifier(df: DataFrame, keys: Sequence[str], value: str, bins: int, out: str = "quantile", mask: Column | None = None) -> DataFrame:
    """Quantile bucket per cross-section; masked rows get -1 and do not count."""
    rows = df.withColumn("_v", F.when(mask, F.col(value)) if mask is not None else F.col(value))
    q = ranking.with_quantiles(rows, keys, "_v", ranking.quantile_edges(bins))
    return q.withColumn(out, F.coalesce(ranking.quantile_bucket(F.col("_v"), bins), F.lit(-1))).drop("_v", *ranking.quantile_edges(bins))
