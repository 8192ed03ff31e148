"""Fuzzy string scores on a 0-100 scale, by a bit-parallel subsequence length.

``ratio`` is the normalised insert/delete similarity 200*LCS/(|a|+|b|); the
others take the best or a reordered form of it.  They run as one pandas UDF, over the
distinct pairs of a batch.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word per step."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        m = v & where.get(ch, 0)
        v = (v + m | v - m) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if not n else 200.0 * lcs(a, b) / n


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against windows of the longer.

    A window shares no longer subsequence than it shares characters, so windows
    are tried by falling bound, until no bound is above the best score.
    """
    s, t = sorted((a, b), key=len)
    if not s:
        return 100.0 if not t else 0.0
    if s in t:
        return 100.0
    n = len(s)
    left = Counter(s)
    bounds, shared = [], 0
    for i in range(1 - n, len(t)):  # the window t[i : i + n], clipped to the text
        if i + n <= len(t):
            ch = t[i + n - 1]
            shared += left[ch] > 0
            left[ch] -= 1
        if i > 0:
            ch = t[i - 1]
            left[ch] += 1
            shared -= left[ch] > 0
        lo, hi = max(0, i), min(len(t), i + n)
        bounds.append((200.0 * shared / (n + hi - lo), lo, hi))
    best = 0.0
    for bound, lo, hi in sorted(bounds, reverse=True):
        if bound <= best:
            break
        best = max(best, ratio(s, t[lo:hi]))
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the shared words and either side's shared plus own words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left = f"{both} {' '.join(sorted(x - y))}".strip()
    right = f"{both} {' '.join(sorted(y - x))}".strip()
    found = ratio(left, right)
    return max(found, ratio(both, left), ratio(both, right)) if both else found


SCORES = {f.__name__: f for f in (ratio, partial_ratio, token_sort_ratio, token_set_ratio)}


def scores(wanted: dict[str, tuple[str, Column, Column]]) -> Column:
    """A struct of named scores, all from one Arrow pass; equal pairs are scored once a batch."""
    cols: list[Column] = []
    at: dict[str, int] = {}
    plan = []
    for name, (kind, *pair) in wanted.items():
        for c in pair:
            if str(c) not in at:
                at[str(c)] = len(cols)
                cols.append(c)
        plan.append((name, SCORES[kind], *(at[str(c)] for c in pair)))

    @F.pandas_udf(", ".join(f"{n} double" for n in wanted))
    def run(*series: pd.Series) -> pd.DataFrame:
        texts = [s.fillna("").tolist() for s in series]
        out = {}
        for name, f, i, j in plan:
            pairs = list(zip(texts[i], texts[j]))
            known = {p: f(*p) for p in set(pairs)}
            out[name] = [known[p] for p in pairs]
        return pd.DataFrame(out, dtype=float)

    return run(*cols)
