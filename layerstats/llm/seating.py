"""Gibbs draws of table counts in Pitman-Yor restaurants.

Of the c customers of a dish only the number of their tables, t, is kept. Given all
else in the restaurant, the weight of t is S(c, t), a generalised Stirling number that
counts the ways to sit at t tables, times a factor for each table opened: the restaurant's
(strength + discount * tables there are) and the probability of the dish in the
parent restaurant, where every table is a customer.

Up to ``SMALL`` customers the numbers come from their recurrence. Beyond, they come
from their saddle point. What that lacks is taken from the recurrence at ``AT`` customers: it
depends on c / t^(1/discount) alone, but for a few t or c - t.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

STRENGTH = 0.5
SMALL = 64
#: Customers without a table of their own up to which c - t decides, and customers of the row that corrects the saddle point.
FEW, AT = 64, 1024
#: Cells that the likely numbers of tables of a dish with many customers are divided into.
CELLS = 28
ELEMENTS = 1 << 20


def log_gamma(z: np.ndarray) -> np.ndarray:
    """log Gamma for z > 0, by Stirling's series four steps up."""
    y = z + 4
    square = 1 / (y * y)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - square / 1680) * square) * square) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(z * (z + 1) * (z + 2) * (z + 3))


def log_stirling(discount: float, most: int, tables: int) -> np.ndarray:
    """log S(c, t) for c up to ``most`` and t up to ``tables``: the new customer opens a table or joins one."""
    out = np.full((most + 1, tables + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(tables + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(most):
            join = np.log(np.maximum(c - discount * t, 0))
            out[c + 1] = np.logaddexp(np.append(-np.inf, out[c, :-1]), np.where(t > 0, out[c] + join, -np.inf))
    return out


class Even:
    """A function between points that are brought to even distances, where looking up takes no search."""

    def __init__(self, x: np.ndarray, y: np.ndarray, points: int = 1 << 14):
        self.low, self.scale = x[0], (points - 1) / (x[-1] - x[0])
        self.y = np.interp(np.linspace(x[0], x[-1], points), x, y)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.clip((x - self.low) * self.scale, 0, len(self.y) - 1.001)
        whole = at.astype(np.int64)
        return self.y[whole] + (at - whole) * (self.y[whole + 1] - self.y[whole])


class Numbers:
    """Generalised Stirling numbers of one discount."""

    def __init__(self, discount: float):
        self.discount = d = discount
        self.small = log_stirling(d, SMALL, SMALL).ravel()
        # The saddle point x of the generating function, by customers a table: r = d x y^(d-1) / (1 - y^d), y = 1 - x.
        near, far = np.exp(np.linspace(-18, np.log(0.5), 3000)), np.linspace(np.log(0.5), -60, 5000)[1:]
        x, log_y = np.append(near, -np.expm1(far)), np.append(np.log1p(-near), far)
        part = -np.expm1(d * log_y)
        r = d * x * np.exp((d - 1) * log_y) / part
        spread = r * (1 + (1 - d) * x * np.exp(-log_y) - r)
        good = (r > 1) & (spread > 0)
        log_r1, g = np.log(r[good] - 1), np.log(part[good])
        self.g, self.a, self.log_spread = (Even(log_r1, y) for y in (g, g - r[good] * np.log(x[good]), np.log(spread[good])))
        row, t = log_stirling(d, AT, AT)[AT], np.arange(1.0, AT)
        lacks = row[1:AT] - self._saddle(np.full(AT - 1, float(AT)), t)
        self.rest = np.append(0, lacks[: -FEW - 1 : -1])
        # In order of the scaled number of customers, from many tables to one.
        scaled = (np.log(AT) - np.log(t[: AT - FEW]) / d)[::-1]
        lack = lacks[: AT - FEW][::-1] - lacks[AT - FEW - 1]
        self.lacks, self.rise = Even(scaled, lack), Even(scaled, np.gradient(lack, scaled))
        self.last, self.beyond = scaled[-1], (lack[-1] - lack[-3]) / (scaled[-1] - scaled[-3])

    def _saddle(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        u = np.log(np.maximum(c - t, 1e-9) / t)
        out = t * (self.a(u) - np.log(self.discount)) - 0.5 * (np.log(2 * np.pi * t) + self.log_spread(u))
        return out + log_gamma(c + 1) - log_gamma(t + 1)

    def log(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log S(c, t) for many customers; t may lie between whole numbers."""
        rest, z = np.rint(c - t).astype(np.int64), np.log(c) - np.log(t) / self.discount
        out = self._saddle(c, t) + self.lacks(z) + self.beyond * np.maximum(0, z - self.last)
        out += np.where(rest <= FEW, self.rest[np.minimum(rest, FEW)], 0)
        return np.where(c - t < 0.5, 0.0, out)

    def slope(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """How log S(c, t) * discount^t grows with t, about."""
        log_t = np.log(t)
        z = np.log(c) - log_t / self.discount
        rise = np.where(z > self.last, self.beyond, self.rise(z))
        return self.g(np.log(np.maximum(c - t, 1e-9)) - log_t) - log_t - rise / (self.discount * t)


@lru_cache(maxsize=16)
def numbers(discount: float) -> Numbers:
    return Numbers(discount)


def _few(d: float, c: np.ndarray, others: np.ndarray, inside: np.ndarray, of: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Draws for dishes of up to ``SMALL`` customers: all weights, one after the other."""
    bounds = np.cumsum(c)
    first = bounds - c
    i = np.arange(int(bounds[-1])) - np.repeat(first, c)
    step = (STRENGTH + d * (np.repeat(others, c) + i)) * (np.repeat(inside, c) + i) / (np.repeat(of, c) + i)
    step[first] = 1
    weight = np.cumsum(np.log(step))
    weight -= np.repeat(weight[first], c)
    weight += numbers(d).small[np.repeat(c * (SMALL + 1), c) + i + 1]
    weight = np.exp(weight - np.repeat(np.maximum.reduceat(weight, first), c))
    total = np.cumsum(weight)
    before = total[first] - weight[first]
    chosen = np.searchsorted(total, before + rng.random(len(c)) * (total[bounds - 1] - before), side="right")
    return np.clip(chosen, first, bounds - 1) - first + 1


def _many(d: float, c: np.ndarray, others: np.ndarray, inside: np.ndarray, of: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Draws for dishes of more customers: the likely numbers of tables, in cells."""
    held, a, c = numbers(d), STRENGTH / d + others, c.astype(float)

    def slope(t: np.ndarray) -> np.ndarray:
        return held.slope(c, t) + np.log(a + t) + np.log((np.maximum(inside, -0.999) + t) / (of + t))

    low, high = np.zeros(len(c)), np.log(c)
    for _ in range(18):
        middle = (low + high) / 2
        up = slope(np.exp(middle)) > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    mode = np.exp(low)
    bend = (slope(mode * 1.01) - slope(mode * 0.99)) / (0.02 * mode)
    wide = np.where(bend < 0, 1 / np.sqrt(np.maximum(-bend, 1e-12)), mode)
    begin = np.maximum(1, np.floor(mode - 6 * wide - 4))
    end = np.minimum(c, np.ceil(mode + 6 * wide + 16)) + 1
    edges = np.floor(begin[:, None] + (end - begin)[:, None] * np.arange(CELLS + 1) / CELLS)
    width = np.diff(edges, axis=1)
    t = np.maximum((edges[:, :-1] + edges[:, 1:] - 1) / 2, 1)
    whole = held.log(np.broadcast_to(c[:, None], t.shape), t) + t * np.log(d) + log_gamma(a[:, None] + t)
    whole += log_gamma(inside[:, None] + t) - log_gamma(of[:, None] + t)
    whole = np.where(width > 0, whole, -np.inf)
    weight = width * np.exp(whole - whole.max(1, keepdims=True))
    total = np.cumsum(weight, axis=1)
    cell = (total < (rng.random(len(c)) * total[:, -1])[:, None]).sum(1)
    row = np.arange(len(c))
    cell = np.minimum(cell, CELLS - 1)
    return (edges[row, cell] + np.floor(rng.random(len(c)) * np.maximum(width[row, cell], 1))).astype(np.int64)


def draw(
    discount: float, customers: np.ndarray, others: np.ndarray, inside: np.ndarray, of: np.ndarray, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish, drawn given all else.

    ``others`` is the tables of the restaurant's other dishes. When i of the dish's tables are
    customers of the parent restaurant, the dish has the probability (``inside`` + i) / (``of`` + i)
    there, for i from 1 on.
    """
    out = np.minimum(customers, 1).astype(np.int64)
    few = np.flatnonzero((customers > 1) & (customers <= SMALL))
    cuts = np.searchsorted(np.cumsum(customers[few]), np.arange(ELEMENTS, int(customers[few].sum()), ELEMENTS))
    for part in np.split(few, cuts):
        if len(part):
            out[part] = _few(discount, customers[part], others[part], inside[part], of[part], rng)
    many = np.flatnonzero(customers > SMALL)
    for at in range(0, len(many), ELEMENTS // CELLS):
        part = many[at : at + ELEMENTS // CELLS]
        out[part] = _many(discount, customers[part], others[part], inside[part], of[part], rng)
    return out
