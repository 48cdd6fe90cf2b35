"""Poisson limits and percentile intervals."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

#: Terms of a tail that are summed at once.
_TERMS = 4096


def _below(k: int, mean: float) -> float:
    """P(Poisson(mean) <= k), by the tail on the far side of k from the mean: what is left out is under 1e-17 of it."""
    if k < 0 or mean <= 0:
        return 0.0 if k < 0 else 1.0
    down = mean > k
    at = k if down else k + 1
    term = total = 1.0
    while at > 0 and term > 0:
        steps = np.arange(_TERMS, dtype=float)
        ratios = np.maximum(at - steps, 0) / mean if down else mean / (at + 1 + steps)
        terms = term * np.cumprod(ratios)
        total, term = total + float(terms.sum()), float(terms[-1])
        at += -_TERMS if down else _TERMS
        ratio = float(ratios[-1])  # of all further terms at most
        if term * ratio <= 1e-17 * total * (1 - ratio):
            break
    first = k if down else k + 1
    tail = min(1.0, math.exp(first * math.log(mean) - mean - math.lgamma(first + 1) + math.log(total)))
    return tail if down else 1.0 - tail


def poisson_limits(k: int, level: float = 0.95) -> tuple[float, float]:
    """Exact two-sided limits of a Poisson mean after k events, by bisection on its distribution."""
    tail = (1 - level) / 2

    def solve(events: int, target: float) -> float:
        low, high = 0.0, events + 20 + 10 * math.sqrt(events + 1)
        while _below(events, high) > target:
            low, high = high, 2 * high
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if _below(events, mid) > target else (low, mid)
        return (low + high) / 2

    return (0.0 if k == 0 else solve(k - 1, 1 - tail)), solve(k, tail)


@F.pandas_udf(T.StructType().add("lower", "double").add("upper", "double"))
def poisson_interval(k: pd.Series) -> pd.DataFrame:
    """Struct of the exact 95 % limits for each count."""
    known = {int(x): poisson_limits(int(x)) for x in k.dropna().unique()}
    pairs = [known.get(int(x)) if x == x and x is not None else (None, None) for x in k]
    return pd.DataFrame(pairs, columns=["lower", "upper"])


def percentile_interval(values: Column) -> tuple[Column, Column]:
    """2.5th and 97.5th percentile, interpolated."""
    return F.percentile(values, F.lit(0.025)), F.percentile(values, F.lit(0.975))
