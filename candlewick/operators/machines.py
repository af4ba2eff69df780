"""State machines whose effect over a stretch of rows has a short summary.

A machine tells three things: the summary of the rows of a bucket, the summary of two stretches that follow each other, and the state
behind a stretch given the state before it. Composition is associative, so :func:`candlewick.operators.series.fold` combines the summaries of all
buckets of a series in levels and knows every bucket's first state without walking along the rows.

A summary is a list of lists of doubles. ``None`` is the state before the first row.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd

State = "list[float] | None"
Summary = list[list[float]]


class Machine:
    def summarize(self, rows: pd.DataFrame) -> Summary:
        """Summary of rows in order; at least one row."""
        raise NotImplementedError

    def compose(self, a: Summary, b: Summary) -> Summary:
        """Summary of ``a`` and then ``b``."""
        raise NotImplementedError

    def advance(self, s: Summary, state: State) -> list[float]:
        """State behind a stretch."""
        raise NotImplementedError


class Affine(Machine):
    """y = M y + c with a matrix and an offset per row (``maps(rows)``: arrays n x d x d and n x d); before the first row y = 0.

    A row whose map holds NaN makes the state NaN; leave such rows out or give them the identity.
    """

    def __init__(self, dims: int, maps: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]):
        self.dims, self.maps = dims, maps

    def summarize(self, rows: pd.DataFrame) -> Summary:
        m, c = self.maps(rows)
        while len(m) > 1:  # neighbours in pairs
            odd = len(m) % 2
            first, second = slice(0, len(m) - odd, 2), slice(1, len(m), 2)
            step, shift = m[second] @ m[first], np.einsum("nij,nj->ni", m[second], c[first]) + c[second]
            m, c = (np.concatenate([step, m[-1:]]), np.concatenate([shift, c[-1:]])) if odd else (step, shift)
        return [m[0].ravel().tolist(), c[0].tolist()]

    def _parts(self, s: Summary) -> tuple[np.ndarray, np.ndarray]:
        return np.array(s[0]).reshape(self.dims, self.dims), np.array(s[1])

    def compose(self, a: Summary, b: Summary) -> Summary:
        (m1, c1), (m2, c2) = self._parts(a), self._parts(b)
        return [(m2 @ m1).ravel().tolist(), (m2 @ c1 + c2).tolist()]

    def advance(self, s: Summary, state: State) -> list[float]:
        m, c = self._parts(s)
        return (m @ np.array(state if state else [0.0] * self.dims) + c).tolist()


class Clamp(Machine):
    """A level that every row pulls into its own interval (``bounds(rows)``: two arrays); it starts at ``first(row values)``.

    One interval after another is an interval again.
    """

    def __init__(self, bounds: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], first: Callable[[pd.DataFrame], float]):
        self.bounds, self.first = bounds, first

    def summarize(self, rows: pd.DataFrame) -> Summary:
        low, high = -math.inf, math.inf
        for a, b in zip(*(x.tolist() for x in self.bounds(rows))):
            low, high = min(max(low, a), b), min(max(high, a), b)
        return [[low, high, self.first(rows)]]

    def compose(self, a: Summary, b: Summary) -> Summary:
        (low, high, first), (u, v, _) = a[0], b[0]
        return [[min(max(low, u), v), min(max(high, u), v), first]]

    def advance(self, s: Summary, state: State) -> list[float]:
        low, high, first = s[0]
        return [min(max(state[0] if state else first, low), high)]


class FirstClose(Machine):
    """Something open (a working bar, a position) that closes at the first row that meets a condition on it; then all starts anew.

    Whatever is open when a stretch begins, the rest of the stretch depends only on the row at which it closes. A summary therefore lists the rows
    that can be that row, each as (u, w, forced, exit): the extremes of the stretch up to there, whether it closes anything, and the state at the end of the stretch if it closes there. Rows with
    the same exit in a row are one piece, because a later row closes whatever an earlier one does. Besides: the state at the end if nothing is open at the beginning, and the
    totals that an open thing carries through the stretch if it does not close.

    Layout: totals (its first number says whether anything closes), state from nothing, pieces, exits.
    """

    def starts(self, rows: pd.DataFrame) -> "_Stretch":
        raise NotImplementedError

    def hits(self, state: Sequence[float], u: float, w: float) -> bool:
        """Whether a row with extremes ``u`` and ``w`` closes ``state``."""
        raise NotImplementedError

    def carried(self, state: Sequence[float], totals: Sequence[float]) -> list[float]:
        """``state`` after a stretch in which it does not close."""
        raise NotImplementedError

    def joined(self, a: Sequence[float], b: Sequence[float]) -> list[float]:
        """Totals of two stretches, without the leading flag."""
        raise NotImplementedError

    def behind(self, totals: Sequence[float], u: float, w: float) -> tuple[float, float]:
        """Extremes of a row of the second stretch, seen from the beginning of the first."""
        raise NotImplementedError

    def certain(self, totals: Sequence[float], u: float, w: float) -> bool:
        """Whether a row with these extremes closes whatever was open before the stretch with ``totals``."""
        raise NotImplementedError

    def summarize(self, rows: pd.DataFrame) -> Summary:
        s = self.starts(rows)
        pieces, sure = [], 0.0
        for u, w, forced, at in s.candidates():
            pieces.append((u, w, float(forced), tuple(s.state_from(at + 1))))
            if forced or self.certain(s.totals, u, w):
                sure = 1.0
                break
        return self._packed([sure, *s.totals], s.state_from(0), pieces)

    @staticmethod
    def _packed(totals: Sequence[float], fresh: Sequence[float], pieces: list[tuple]) -> Summary:
        kept = [p for p, after in zip(pieces, [*pieces[1:], None]) if after is None or after[3] != p[3]]
        number: dict[tuple, int] = {}
        flat = []
        for u, w, forced, end in kept:
            flat += [u, w, forced, float(number.setdefault(end, len(number)))]
        return [list(totals), list(fresh), flat, *[list(e) for e in number]]

    @staticmethod
    def _pieces(s: Summary) -> list[tuple[float, float, float, list[float]]]:
        flat = s[2]
        return [(flat[i], flat[i + 1], flat[i + 2], s[3 + int(flat[i + 3])]) for i in range(0, len(flat), 4)]

    def compose(self, a: Summary, b: Summary) -> Summary:
        ends: dict[tuple, tuple] = {}
        after = lambda e: ends.setdefault(tuple(e), tuple(self.advance(b, e)))
        pieces = [(u, w, forced, after(e)) for u, w, forced, e in self._pieces(a)]
        totals = self.joined(a[0][1:], b[0][1:])
        sure = a[0][0]
        if not sure:
            for u, w, forced, e in self._pieces(b):
                u, w = self.behind(a[0][1:], u, w)
                pieces.append((u, w, forced, tuple(e)))
                if forced or self.certain(totals, u, w):
                    sure = 1.0
                    break
        return self._packed([sure, *totals], after(a[1]), pieces)

    def advance(self, s: Summary, state: State) -> list[float]:
        if not state:
            return list(s[1])
        flat = s[2]
        for i in range(0, len(flat), 4):
            if flat[i + 2] or self.hits(state, flat[i], flat[i + 1]):
                return list(s[3 + int(flat[i + 3])])
        return self.carried(state, s[0][1:])


class _Stretch:
    """Rows of a bucket: where something opened at a row closes, and the state at the end when nothing is open before a row."""

    totals: list[float]

    def __init__(self, n: int):
        self.n = n
        self.known: dict[int, int] = {n: n}

    def opens(self, at: int) -> int:
        """First row from ``at`` on that opens something, or ``n``."""
        return at

    def closes(self, at: int) -> int | None:
        """Row that closes what row ``at`` opens."""
        raise NotImplementedError

    def state(self, at: int) -> list[float]:
        """State at the end of what row ``at`` opened and nothing closed."""
        raise NotImplementedError

    def candidates(self):
        """Rows that may close something open before the stretch: (u, w, forced, row) in order."""
        raise NotImplementedError

    def state_from(self, at: int) -> list[float]:
        path = []
        while at not in self.known:
            path.append(at)
            start = self.opens(at)
            end = self.closes(start) if start < self.n else None
            if start == self.n or end is None:
                self.known[at] = start
            else:
                at = end + 1
        found = self.known[at]
        for p in path:
            self.known[p] = found
        return [] if found == self.n else self.state(found)


# --- bars -----------------------------------------------------------------------------------------------------------


class _BarRows(_Stretch):
    def __init__(self, rows: pd.DataFrame, machine: "Bars"):
        super().__init__(len(rows))
        self.machine = machine
        self.t = (rows["ts"].astype("datetime64[us]").astype("int64") / 1e6).tolist()
        self.o, self.h, self.l, self.c, self.v = (rows[x].astype(float).tolist() for x in ("open", "high", "low", "close", "volume"))
        back = lambda f, x: f(np.array(x)[::-1])[::-1].tolist()
        self.high, self.low, self.sum = back(np.maximum.accumulate, self.h), back(np.minimum.accumulate, self.l), back(np.cumsum, self.v)
        self.totals = [self.t[0], self.t[-1], self.high[0], self.low[0], self.c[-1], self.sum[0], float(self.n)]

    def closes(self, at: int) -> int | None:
        m = self.machine
        if m.seconds is not None:
            end = bisect_left(self.t, self.t[at] + m.seconds, at)
            while end > at and self.t[end - 1] - self.t[at] >= m.seconds:
                end -= 1
            while end < self.n and self.t[end] - self.t[at] < m.seconds:
                end += 1
            return end if end < self.n else None
        high, low = self.h[at], self.l[at]
        for i in range(at + 1, self.n):
            high, low = max(high, self.h[i]), min(low, self.l[i])
            if high - low >= m.size:
                return i
        return None

    def state(self, at: int) -> list[float]:
        if self.machine.quote:
            return [self.t[at], self.t[-1], self.o[at], self.h[at], self.l[at], self.c[-1], self.v[at], float(self.n - at)]
        return [self.t[at], self.t[-1], self.o[at], self.high[at], self.low[at], self.c[-1], self.sum[at], float(self.n - at)]

    def candidates(self):
        if self.machine.seconds is not None:
            yield from ((t, 0.0, False, i) for i, t in enumerate(self.t))
            return
        high, low = -math.inf, math.inf
        for i, (h, l) in enumerate(zip(self.h, self.l)):
            if h > high or l < low:
                high, low = max(high, h), min(low, l)
                yield high, low, False, i


class Bars(FirstClose):
    """Working bar [start, end, open, high, low, close, volume, rows] that closes after ``seconds`` or once its range reaches ``size``.

    A quote bar keeps the range and volume of its first row.
    """

    def __init__(self, seconds: float | None = None, size: float | None = None, quote: bool = False):
        self.seconds, self.size, self.quote = seconds, size, quote

    def starts(self, rows: pd.DataFrame) -> _BarRows:
        return _BarRows(rows, self)

    def hits(self, state, u, w):
        return u - state[0] >= self.seconds if self.seconds is not None else max(state[3], u) - min(state[4], w) >= self.size

    def carried(self, state, totals):
        _, end, high, low, close, volume, n = totals
        start, _, first, h, l, _, v, k = state
        return [start, end, first, h, l, close, v, k + n] if self.quote else [start, end, first, max(h, high), min(l, low), close, v + volume, k + n]

    def joined(self, a, b):
        return [a[0], b[1], max(a[2], b[2]), min(a[3], b[3]), b[4], a[5] + b[5], a[6] + b[6]]

    def behind(self, totals, u, w):
        return (u, w) if self.seconds is not None else (max(u, totals[2]), min(w, totals[3]))

    def certain(self, totals, u, w):
        return u - totals[0] >= self.seconds if self.seconds is not None else u - w >= self.size


class Covers(Machine):
    """[time of the last leader]: a row leads if it comes more than ``window`` after the last leader. ``ts(rows)`` gives the times in order.

    Summary: times of the rows that can be the first leader with the last leader at the end if they are, first row and flag "one of them leads in any case", last leader if none came before.
    """

    def __init__(self, window: float, ts: Callable[[pd.DataFrame], list[float]]):
        self.window, self.ts = window, ts

    def _next(self, t: list[float], at: int) -> int:
        return bisect_right(t, t[at] + self.window, at)

    def summarize(self, rows: pd.DataFrame) -> Summary:
        t = [float(x) for x in self.ts(rows)]
        last: dict[int, int] = {}

        def end(at: int) -> float:
            path = []
            while at not in last:
                path.append(at)
                after = self._next(t, at)
                if after == len(t):
                    last[at] = at
                else:
                    at = after
            for p in path:
                last[p] = last[at]
            return t[last[at]]

        pieces, sure = [], 0.0
        for i, x in enumerate(t):
            if i + 1 < len(t) and t[i + 1] == x:
                continue  # the first of equal times leads for all of them
            first = bisect_left(t, x)
            pieces.append((x, end(first)))
            if x > t[0] + self.window:
                sure = 1.0
                break
        return self._packed(pieces, t[0], sure, end(0))

    @staticmethod
    def _packed(pieces: list[tuple[float, float]], first: float, sure: float, fresh: float) -> Summary:
        kept = [p for p, after in zip(pieces, [*pieces[1:], None]) if after is None or after[1] != p[1]]
        return [[x for p in kept for x in p], [first, sure], [fresh]]

    def compose(self, a: Summary, b: Summary) -> Summary:
        pieces = [(a[0][i], self.advance(b, [a[0][i + 1]])[0]) for i in range(0, len(a[0]), 2)]
        sure = a[1][1]
        if not sure:
            for i in range(0, len(b[0]), 2):
                pieces.append((b[0][i], b[0][i + 1]))
                if b[0][i] > a[1][0] + self.window:
                    sure = 1.0
                    break
        return self._packed(pieces, a[1][0], sure, self.advance(b, a[2])[0])

    def advance(self, s: Summary, state: State) -> list[float]:
        if not state:
            return list(s[2])
        at = bisect_right(s[0][::2], state[0] + self.window)
        return [s[0][2 * at + 1]] if 2 * at < len(s[0]) else list(state)


# --- positions ------------------------------------------------------------------------------------------------------


class _PositionRows(_Stretch):
    def __init__(self, close: list[float], enter: list[bool], leave: list[bool], last: list[bool], place: list[float], machine: "Positions"):
        super().__init__(len(close))
        self.c, self.e, self.x, self.last, self.place, self.machine = close, enter, leave, last, place, machine
        self.totals = [max(close), min(close)]

    def opens(self, at: int) -> int:
        while at < self.n and not (self.e[at] and self.c[at] > 0):
            at += 1
        return at

    def closes(self, at: int) -> int | None:
        if self.last[at]:
            return at
        price = self.c[at]
        for i in range(at + 1, self.n):
            if self.x[i] or self.last[i] or self.machine.reason(price, self.c[i]):
                return i
        return None

    def state(self, at: int) -> list[float]:
        return [self.c[at], self.place[at]]

    def candidates(self):
        high, low = -math.inf, math.inf
        for i, c in enumerate(self.c):
            forced = self.x[i] or self.last[i]
            if forced or c > high or c < low:
                high, low = max(high, c), min(low, c)
                yield high, low, forced, i
                if forced:
                    return


class Positions(FirstClose):
    """Position [entry price, entry place], closed by a stop, a target, an exit signal or the end of the series.

    ``columns(rows)`` gives close, enter, leave, last (lists) and place. Entries at prices that are not positive are left out.
    """

    def __init__(self, columns: Callable[[pd.DataFrame], tuple], stop: float, profit: float):
        self.columns, self.stop, self.profit = columns, stop, profit

    def reason(self, price: float, close: float) -> str | None:
        gain = (close - price) / price * 100
        if self.stop > 0 and gain <= -self.stop:
            return "stop_loss"
        return "take_profit" if self.profit > 0 and gain >= self.profit else None

    def starts(self, rows: pd.DataFrame) -> _PositionRows:
        return _PositionRows(*self.columns(rows), self)

    def hits(self, state, u, w):
        return self.reason(state[0], w) is not None or self.reason(state[0], u) is not None

    def carried(self, state, totals):
        return list(state)

    def joined(self, a, b):
        return [max(a[0], b[0]), min(a[1], b[1])]

    def behind(self, totals, u, w):
        return max(u, totals[0]), min(w, totals[1])

    def certain(self, totals, u, w):
        return False


# --- fees -----------------------------------------------------------------------------------------------------------


class HighWater(Machine):
    """[value, mark] of a fund whose performance fee is due when the gross value passes the mark; it starts at ``first``.

    ``factors(rows)`` gives per period the gross growth, the growth after management fee, and the growth after both fees. All steps scale with the value, so a stretch is
    described per unit of value: its growth without performance fee, and for each period that passes all gross values before it the pair of
    value and mark at the end if the mark is passed there first. Values stay positive (no period loses more than everything).
    """

    def __init__(self, factors: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]], first: float):
        self.factors, self.start = factors, first

    def summarize(self, rows: pd.DataFrame) -> Summary:
        gross, plain, paid = (x.tolist() for x in self.factors(rows))
        n = len(gross)
        ends: dict[int, tuple[float, float]] = {}

        def next_pass(at: int, value: float, mark: float) -> tuple[int, float]:
            while at < n and not value * gross[at] > mark:
                value *= plain[at]
                at += 1
            return at, value

        def end(at: int) -> tuple[float, float]:
            """Value and mark at the end per unit of value before period ``at``, whose gross value passes the mark."""
            chain = []
            while at < n and at not in ends:
                after, value = next_pass(at + 1, paid[at], gross[at])
                chain.append((at, value, gross[at]))
                at = after
            for own, value, mark in reversed(chain):
                ends[own] = (value * ends[at][0], value * ends[at][1]) if at < n else (value, mark)
                at = own
            return ends[at]

        value, top, flat = 1.0, -math.inf, []
        for at in range(n):
            if value * gross[at] > top:
                top = value * gross[at]
                a, b = end(at)
                flat += [top, value * a, value * b]
            value *= plain[at]
        return [[value], flat]

    def compose(self, a: Summary, b: Summary) -> Summary:
        flat, growth = [], a[0][0]
        for i in range(0, len(a[1]), 3):
            flat += [a[1][i], *self.advance(b, a[1][i + 1 : i + 3])]
        top = a[1][-3] if a[1] else -math.inf
        for i in range(0, len(b[1]), 3):
            if growth * b[1][i] > top:
                flat += [growth * x for x in b[1][i : i + 3]]
        return [[growth * b[0][0]], flat]

    def advance(self, s: Summary, state: State) -> list[float]:
        value, mark = state if state else [self.start, self.start]
        tops = s[1][::3]
        at = bisect_right(tops, mark / value) if value > 0 else len(tops)
        while at and value * tops[at - 1] > mark:
            at -= 1
        while at < len(tops) and not value * tops[at] > mark:
            at += 1
        return [value * s[1][3 * at + 1], value * s[1][3 * at + 2]] if at < len(tops) else [value * s[0][0], mark]
