"""Numbers of tables in Chinese restaurants: a dish draws its number anew, given those of the others.

Only customers and tables count for a probability, so how customers are spread over the tables is summed out:
``t`` tables of ``n`` customers weigh ``S(n, t) * strength(1) * ... * strength(t - 1)``, where ``S`` are the
generalised Stirling numbers of the discount. That is what seating all customers one by one, and moving them
until nothing depends on the start, would lead to. Up to ``_EXACT`` customers ``S`` is exact, beyond it is a
saddle-point value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Customers up to which the Stirling numbers are summed up exactly.
_EXACT = 512
#: Customers of the exact row by which saddle-point values are corrected.
_REFERENCE = 2048
#: Dishes move in so many parts, by lot; each part sees the tables that the others left.
_PARTS = 4
#: Entries of a matrix at a time.
_ENTRIES = 1 << 20
#: Numbers of tables that weigh less than e to the minus this against the likeliest are not looked at.
_NEGLIGIBLE = 40.0

Strength = Callable[[np.ndarray], np.ndarray]


@lru_cache(maxsize=4)
def _stirling(discount: float) -> np.ndarray:
    """Logarithms of S(n, t), minus infinity where there is none."""
    out = np.full((_EXACT + 1, _EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, _EXACT + 1)
    for n in range(1, _EXACT):
        stays = np.log(n - discount * t[:n]) + out[n, 1 : n + 1]
        out[n + 1, 1 : n + 1] = np.logaddexp(out[n, :n], stays)
        out[n + 1, n + 1] = 0.0
    return out


def _remainder(x: np.ndarray) -> np.ndarray:
    return 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def _rising(a: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of gamma(a + t) / gamma(a + 1), without its first term (t - 1) * log(a + 9)."""
    out = (a + t + 7.5) * np.log1p((t - 1) / (a + 9)) - (t - 1) + _remainder(a + t + 8) - _remainder(a + 9)
    for i in range(8):
        out -= np.log1p((t - 1) / (a + 1 + i))
    return out


def _opened(first: np.ndarray, step: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of the product of ``first + step * j`` for j from 1 to t - 1."""
    step = np.maximum(step, first * 1e-12)
    return (t - 1) * np.log(first + 9 * step) + _rising(first / step, t)


@lru_cache(maxsize=4)
def _saddles(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean customers of a table (log, rising), and the point z where they are so many."""
    z = np.linspace(30.0, -700.0, 200_000)
    low, high = -np.logaddexp(0, -z), -np.logaddexp(0, z)
    mean = high + (discount - 1) * low - np.log(-np.expm1(discount * low) / discount)
    return np.maximum.accumulate(mean), z


def _raw_stirling(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(n, t) at the saddle point of ((1 - (1 - x)^discount) / discount)^t, at x = 1 / (1 + e^z)."""
    inside = np.minimum(t, n - 1)
    z = np.interp(np.log(n / inside), *_saddles(discount))
    low, high = -np.logaddexp(0, -z), -np.logaddexp(0, z)
    inner = -np.expm1(discount * low) / discount
    mean = np.exp(high + (discount - 1) * low) / inner
    variance = np.maximum(inside * mean * (1 + (1 - discount) * np.exp(-z) - mean), 1e-300)
    falling = (n - inside) * np.log(inside + 9) + _rising(inside, n - inside + 1)
    out = falling + inside * np.log(inner) - n * high - 0.5 * np.log(2 * np.pi * variance)
    return np.where(t > n - 0.5, 0.0, out)


@lru_cache(maxsize=4)
def _correction(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """What the saddle point misses, by log(t / n^discount), from an exact row: one large table outweighs many."""
    row = _row(_REFERENCE, discount)[: _REFERENCE - 30]
    t = np.arange(1.0, len(row) + 1)
    missed = row - _raw_stirling(np.full(len(t), float(_REFERENCE)), t, discount)
    return np.log(t) - discount * np.log(_REFERENCE), missed


def _row(n: int, discount: float) -> np.ndarray:
    """Logarithms of S(n, 1) to S(n, n)."""
    out = np.zeros(1)
    for m in range(1, n):
        stays = np.log(m - discount * np.arange(1, m + 1)) + out
        out = np.append(np.append(stays[:1], np.logaddexp(out[:-1], stays[1:])), 0.0)
    return out


def _large_stirling(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    at, missed = _correction(discount)
    where = np.log(t) - discount * np.log(n)
    # Ahead of the row's first entries, the miss is a power of t / n^discount.
    slope = (missed[1] - missed[0]) / (at[1] - at[0])
    return _raw_stirling(n, t, discount) + np.interp(where, at, missed, right=0.0) + slope * np.minimum(where - at[0], 0)


def some_sizes(customers: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tables' dishes, and sizes with which they hold all customers; no probability depends on the sizes."""
    owner = np.repeat(np.arange(len(tables)), tables)
    many = np.maximum(tables, 1)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(tables) - tables, tables)
    return owner, (customers // many)[owner] + (nth < (customers % many)[owner])


class Seating:
    """Tables of each dish, for a discount and ``strength``: what a new table of a dish weighs.

    ``strength`` maps the dishes' numbers of tables to (concentration + discount * all tables of the
    restaurant) * probability of the dish in the parent.
    """

    def __init__(
        self,
        customers: np.ndarray,
        discount: float,
        strength: Strength,
        rng: np.random.Generator,
        seated: np.ndarray | None = None,
        step: np.ndarray | None = None,
    ):
        """``seated``: the dishes' tables, as an earlier seating left them; one each to begin with.

        ``step``: what a table of a dish adds to the strength of the dish itself; without it no two dishes
        may share a restaurant.
        """
        self.total, self.discount, self.strength, self.rng = customers, discount, strength, rng
        self.tables = np.minimum(customers, 1) if seated is None else seated.copy()
        self.step = strength(self.tables + 1) - strength(self.tables) if step is None else step

    @property
    def owner(self) -> np.ndarray:
        return some_sizes(self.total, self.tables)[0]

    @property
    def sizes(self) -> np.ndarray:
        return some_sizes(self.total, self.tables)[1]

    def sweep(self, steps: int) -> None:
        """Gibbs: each dish with two customers or more draws its number of tables, given those of other parts."""
        moving = np.flatnonzero(self.total > 1)
        for _ in range(steps if len(moving) else 0):
            part = self.rng.integers(0, _PARTS, len(moving))
            for p in range(_PARTS):
                self._draw(moving[part == p])

    def _draw(self, dishes: np.ndarray) -> None:
        n, step = self.total[dishes], np.maximum(self.step[dishes], 0.0)
        first = np.maximum(self.strength(self.tables)[dishes] - step * self.tables[dishes], 1e-300)
        drawn = np.ones(len(dishes), np.int64)
        most = 2
        while most <= _EXACT:
            self._each(drawn, np.flatnonzero((n > most // 2) & (n <= most)), most, self._few, n, first, step)
            most *= 2
        self._each(drawn, np.flatnonzero(n > _EXACT), 512, self._many, n, first, step)
        self.tables[dishes] = drawn

    def _each(self, drawn: np.ndarray, at: np.ndarray, width: int, draw: Callable, *given: np.ndarray) -> None:
        many = max(1, _ENTRIES // width)
        for begin in range(0, len(at), many):
            some = at[begin : begin + many]
            drawn[some] = draw(width, *(x[some] for x in given))

    def _pick(self, weight: np.ndarray) -> np.ndarray:
        """A column of each row, by weight."""
        total = np.cumsum(weight, axis=1)
        at = (total <= (self.rng.random(len(weight)) * total[:, -1])[:, None]).sum(axis=1)
        return np.minimum(at, weight.shape[1] - 1)

    def _few(self, most: int, n: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
        if most == 2:
            opens = first + step
            return 1 + (self.rng.random(len(n)) * (opens + 1 - self.discount) < opens)
        weight = np.zeros((len(n), most))
        weight[:, 1:] = np.cumsum(np.log(first[:, None] + step[:, None] * np.arange(1, most)), axis=1)
        weight += _stirling(self.discount)[n, 1 : most + 1]
        return 1 + self._pick(np.exp(weight - weight.max(axis=1, keepdims=True)))

    def _many(self, width: int, n: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Narrow down the numbers that matter, cut them into cells, draw a cell and a number in it."""
        n_, first, step = n[:, None].astype(float), first[:, None], step[:, None]

        def weigh(t: np.ndarray) -> np.ndarray:
            return _large_stirling(n_, t, self.discount) + _opened(first, step, t)

        row = np.arange(len(n))
        edges = np.floor(np.exp(np.linspace(0, 1, 97) * np.log(n_ + 1)))
        edges[:, 0], edges[:, -1] = 1, n + 1
        for cells in (128, width, 0):
            wide = np.diff(edges, axis=1)
            weight = np.where(wide > 0, weigh(edges[:, :-1] + np.maximum(wide - 1, 0) / 2), -np.inf)
            weight -= weight.max(axis=1, keepdims=True)
            if cells:
                matters = weight > -_NEGLIGIBLE
                low = np.maximum(matters.argmax(axis=1) - 1, 0)
                high = np.minimum(matters.shape[1] - matters[:, ::-1].argmax(axis=1) + 1, matters.shape[1])
                begin, end = edges[row, low][:, None], edges[row, high][:, None]
                edges = np.floor(begin + (end - begin) * np.linspace(0, 1, cells + 1))
        cell = self._pick(np.exp(weight) * wide)
        return (edges[row, cell] + np.floor(self.rng.random(len(n)) * wide[row, cell])).astype(np.int64)
