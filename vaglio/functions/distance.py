"""String distances and similarities, for use inside Arrow-batched functions."""

from __future__ import annotations

import math

_VOWELS = set("aeiou")


def weighted_edit(a: str, b: str, limit: float = math.inf) -> float:
    """Edit distance with cheap slips: a doubled or undoubled letter, a swap of neighbours, vowel for vowel, cost half. Infinite once it is seen to exceed limit."""
    if a == b:
        return 0.0
    n, m = len(a), len(b)
    if abs(n - m) * 0.5 > limit:
        return math.inf
    before: list[float] = []
    last = [0.0]
    for j in range(1, m + 1):
        last.append(last[-1] + (0.5 if j > 1 and b[j - 1] == b[j - 2] else 1.0))
    for i in range(1, n + 1):
        x = a[i - 1]
        drop = 0.5 if i > 1 and x == a[i - 2] else 1.0
        row = [last[0] + drop]
        for j in range(1, m + 1):
            y = b[j - 1]
            if x == y:
                swap = last[j - 1]
            else:
                swap = last[j - 1] + (0.5 if x in _VOWELS and y in _VOWELS else 1.0)
            best = min(swap, last[j] + drop, row[j - 1] + (0.5 if j > 1 and y == b[j - 2] else 1.0))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] and x != y:
                best = min(best, before[j - 2] + 0.5)
            row.append(best)
        # a way to the end leads through this row or, over a swap, through the one before
        if limit < math.inf and min(row) > limit and min(last) > limit:
            return math.inf
        before, last = last, row
    return last[m]


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character and 2^k block (bit-parallel)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 LCS / (len a + len b); 100 for two empty strings."""
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def token_sort_ratio(a: str, b: str) -> float:
    """indel_ratio of the strings with their words sorted."""
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(n, m) // 2 - 1
    taken = [False] * m
    left = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                left.append(ch)
                break
    k = len(left)
    if not k:
        return 0.0
    right = [b[j] for j in range(m) if taken[j]]
    swaps = sum(x != y for x, y in zip(left, right)) / 2
    return (k / n + k / m + (k - swaps) / k) / 3


def jaro_winkler(a: str, b: str) -> float:
    s = jaro(a, b)
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return s + prefix * 0.1 * (1 - s)
