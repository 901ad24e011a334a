"""Folding of typed text, used by all matching operators."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

#: Letters that decomposition doesn't bring to a plain one, and Cyrillic ones that look like a Latin one.
LOOKALIKES = {"а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "х": "x", "у": "y"}
PLAIN = str.maketrans(LOOKALIKES | {"ø": "o", "đ": "d", "ł": "l", "ı": "i", "œ": "oe", "æ": "ae", "ß": "ss", "’": "'", "‘": "'", "–": "-", "—": "-", " ": " ", "​": "", "‎": "", "‏": "", "﻿": "", "�": ""})


@lru_cache(maxsize=20_000)
def fold(text: str) -> str:
    """Small letters without marks, single spaces; other signs stay."""
    s = text.lower()
    if not s.isascii():
        s = s.translate(PLAIN)
        if not s.isascii():
            s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return " ".join(s.split())


def jaro_winkler(a: str, b: str, prefix_weight: float = 0.1) -> float:
    """Jaro–Winkler similarity, 0 to 1; two empty strings give 0."""
    if a == b:
        return 1.0 if a else 0.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(la, lb) // 2 - 1
    if reach < 0:
        reach = 0
    taken = [False] * lb
    met: list[str] = []
    for i, c in enumerate(a):
        j = b.find(c, max(0, i - reach), min(lb, i + reach + 1))
        while j >= 0 and taken[j]:
            j = b.find(c, j + 1, min(lb, i + reach + 1))
        if j >= 0:
            taken[j] = True
            met.append(c)
    m = len(met)
    if not m:
        return 0.0
    other = [b[j] for j in range(lb) if taken[j]]
    swaps = sum(x != y for x, y in zip(met, other)) / 2
    jaro = (m / la + m / lb + (m - swaps) / m) / 3
    same = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        same += 1
    return jaro + same * prefix_weight * (1 - jaro)


def edits(a: str, b: str, most: int = 3) -> int:
    """Edit distance with swaps of neighbours (optimal string alignment); ``most + 1`` stands for anything above ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, older[j - 2] + 1)
            row[j] = best
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)
