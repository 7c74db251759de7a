"""Tokens and seating of the hierarchical Pitman-Yor model of ``hpylm_words``.

Tokens are lower-cased (A-Z) words and one end token a text.  ``draw_tables``
draws how many tables the customers of a dish have in a restaurant, from the
conditional given the rest (a blocked Gibbs step, table sizes summed out by
generalised Stirling numbers up to ``EXACT`` customers; beyond, the customers
are seated anew, in steps of a sixteenth of those seated).  Draws follow from
word and sweep, so a lost task gives the same again.

Discounts are n1 / (n1 + 2 n2) of each level, strengths are 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, functions as F

FOLDS, HELD_OUT = 7, 2
#: The end token; no word holds a newline.
END = b"\n"
BURN, KEPT = 1, 3
STRENGTH = 1.0
EXACT = 24


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    """bytes.lower() and bytes.split() work on A-Z and on the six ASCII spaces alone."""
    return [*(text or "").encode().lower().split(), END]


# --- seating -----------------------------------------------------------------

def log_stirling(d: float, most: int = EXACT) -> np.ndarray:
    """[n, t]: log of the generalised Stirling number of n customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for n in range(most):
        for t in range(1, n + 2):
            more = np.log(n - d * t) + out[n, t] if t <= n else -np.inf
            out[n + 1, t] = np.logaddexp(out[n, t - 1], more)
    return out


def uniform(keys: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """One draw in (0, 1) per key; the same for the same key, sweep and step."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((sweep * 1_000_003 + step + 1) % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def draw_tables(n: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, stirling: np.ndarray, keys: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of n customers of one dish, given the restaurant's other tables and the dish's probability in the parent."""
    out = np.ones(len(n), np.int64)
    for k in range(2, EXACT + 1):
        at = np.flatnonzero(n == k)
        if len(at):
            t = np.arange(k)
            weight = stirling[k, 1:k + 1] + np.cumsum(np.log(STRENGTH + d * (others[at, None] + t)), axis=1) + (t + 1) * np.log(parent[at, None])
            share = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), axis=1)
            out[at] = 1 + (share < uniform(keys[at], sweep, 0)[:, None] * share[:, -1:]).sum(1)
    at = np.flatnonzero(n > EXACT)
    seated, tables, step = np.ones(len(at)), np.ones(len(at)), 1
    while len(at):
        some = np.minimum(np.maximum(1, seated // 16), n[at] - seated)
        new = (STRENGTH + d * (others[at] + tables)) * parent[at]
        p = new / (new + seated - d * tables)
        u = uniform(keys[at], sweep, 2 * step)
        normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * uniform(keys[at], sweep, 2 * step + 1))
        mean = some * p
        # rounded at random, so the mean is kept where it is far below one
        got = np.floor(mean + np.where(mean > 1, np.sqrt(mean * (1 - p)) * normal, 0) + uniform(keys[at], sweep, -step))
        tables += np.clip(got, 0, some)
        seated += some
        done = seated >= n[at]
        out[at[done]] = tables[done]
        at, seated, tables, step = at[~done], seated[~done], tables[~done], step + 1
    return out


@dataclass
class Shape:
    """What is known of the corpus before any sweep."""

    tokens: int
    types: int
    unknown: float  # the base's share of the unknown type
    d: float
    top_d: float

    @property
    def known(self) -> float:
        return (1 - self.unknown) / max(1, self.types)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
