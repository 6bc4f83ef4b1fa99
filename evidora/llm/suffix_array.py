"""Suffix arrays by induced sorting, and permuted longest common prefixes.

``suffix_array`` classifies suffixes as smaller or larger than their right neighbour, sorts the substrings between
leftmost-smaller positions by inducing, names them, recurses on the string of names where names repeat, and induces the
order of all suffixes from that of the leftmost-smaller ones. Over an alphabet that is small against the text the two
induction scans run bucket by bucket on whole arrays; over the names, where buckets are tiny, entry by entry.
"""

from __future__ import annotations

import numpy as np


def _smaller(text: np.ndarray) -> np.ndarray:
    """For each position whether its suffix is smaller than the next one; the last (the sentinel) counts as smaller."""
    n = len(text)
    less, same = text[:-1] < text[1:], text[:-1] == text[1:]
    # an equal pair has the type of the next unequal pair
    at = np.arange(n - 1)
    at[same] = n - 1
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(less, True)[nearest], True)


def _place(order: np.ndarray, symbols: np.ndarray, values: np.ndarray, next_: np.ndarray, step: int) -> None:
    """Appends ``values`` to the buckets of their ``symbols``, in order, from ``next_`` on in direction ``step``."""
    by = np.argsort(symbols, kind="stable")
    symbols, values = symbols[by], values[by]
    new = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    count = np.diff(np.append(new, len(symbols)))
    rank = np.arange(len(symbols)) - np.repeat(new, count)
    order[next_[symbols] + step * rank] = values
    next_[symbols[new]] += step * count


def _induce_by_bucket(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes in the order induced by ``seeds``: leftmost-smaller positions in ascending order."""
    n, kinds = len(text), len(ends)
    order = np.full(n, -1, np.int64)
    starts = np.append(0, ends[:-1])
    last = ends - 1
    _place(order, text[seeds[::-1]], seeds[::-1], last, -1)
    first_seed, head = last + 1, starts.copy()
    larger = ~smaller

    def pull(batch: np.ndarray, want: np.ndarray, next_: np.ndarray, step: int) -> None:
        before = batch[batch > 0] - 1
        before = before[want[before]]
        if len(before):
            _place(order, text[before], before, next_, step)

    for c in range(kinds):
        at = starts[c]
        while at < head[c]:  # grows while a symbol repeats
            upto = head[c]
            pull(order[at:upto], larger, head, 1)
            at = upto
        pull(order[first_seed[c] : ends[c]], larger, head, 1)
    tail = ends - 1
    for c in range(kinds - 1, -1, -1):
        at = ends[c]
        while at > tail[c] + 1:
            downto = tail[c] + 1
            pull(order[downto:at][::-1], smaller, tail, -1)
            at = downto
        pull(order[starts[c] : head[c]][::-1], smaller, tail, -1)
    return order


def _induce_by_entry(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for large alphabets. ``left[i]`` is the symbol before i if it is to be induced from i, else -1."""
    n = len(text)
    order = np.full(n, -1, np.int64)
    _place(order, text[seeds[::-1]], seeds[::-1], ends - 1, -1)
    order = order.tolist()
    before = np.concatenate([[-1], text[:-1], [-1]])
    small = np.concatenate([[False], smaller[:-1], [False]])
    left = np.where(small, -1, before).tolist()  # left[-1] is -1: an empty entry induces nothing
    head = np.append(0, ends[:-1]).tolist()
    for i in order:  # entries appear ahead of the scan
        c = left[i]
        if c >= 0:
            at = head[c]
            order[at] = i - 1
            head[c] = at + 1
    left = np.where(small, before, -1).tolist()
    tail = (ends - 1).tolist()
    for k in range(n - 1, -1, -1):
        i = order[k]
        c = left[i]
        if c >= 0:
            at = tail[c]
            order[at] = i - 1
            tail[c] = at - 1
    return np.asarray(order, np.int64)


def _names(text: np.ndarray, marks: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """The names, from 0, of the sorted leftmost-smaller substrings: equal ones share a name."""
    length = np.zeros(len(text), np.int64)
    length[marks] = np.append(np.diff(marks), 0) + 1
    a, b = sorted_[:-1], sorted_[1:]
    same = length[a] == length[b]
    live, k = np.flatnonzero(same), 0
    while len(live):
        x, y = a[live], b[live]
        live_now = length[x] > k
        live, x, y = live[live_now], x[live_now], y[live_now]
        equal = text[x + k] == text[y + k]
        same[live[~equal]] = False
        live, k = live[equal], k + 1
    return np.append(0, np.cumsum(~same))


def suffix_array(text: np.ndarray, kinds: int) -> np.ndarray:
    """The suffix array of ``text``: symbols under ``kinds``, ended by a 0 that is smaller than all others and unique."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    ends = np.cumsum(np.bincount(text, minlength=kinds))
    smaller = _smaller(text)
    marks = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_by_bucket if kinds <= 1024 or n > 2000 * kinds else _induce_by_entry
    leftmost = np.zeros(n, bool)
    leftmost[marks] = True
    rough = induce(text, smaller, marks, ends)
    sorted_ = rough[leftmost[rough]]
    names = _names(text, marks, sorted_)
    if names[-1] + 1 < len(marks):
        named = np.zeros(n, np.int64)
        named[sorted_] = names
        sorted_ = marks[suffix_array(named[marks], int(names[-1]) + 1)]
    return induce(text, smaller, sorted_, ends)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the length it shares with the suffix before it in ``order`` (the permuted prefixes).

    Where both neighbours to the left agree, the length is one less than the position before has; only the others are
    compared, eight symbols at a time. The first suffix has 0.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    real = before >= 0
    left = np.zeros(n, bool)
    left[1:] = real[1:] & (before[1:] > 0) & (text[np.maximum(before[1:] - 1, 0)] == text[:-1])
    heads = np.flatnonzero(real & ~left)
    shared = np.zeros(n, np.int64)
    padded = np.append(text, np.zeros(8, text.dtype))
    live = heads
    while len(live):  # the unique sentinel ends every comparison
        x, y = live + shared[live], before[live] + shared[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        equal = np.ones(len(live), bool)
        step = np.zeros(len(live), np.int64)
        for k in range(8):
            equal &= padded[np.minimum(x + k, n + 7)] == padded[np.minimum(y + k, n + 7)]
            equal &= (x + k < n) & (y + k < n)
            step += equal
        shared[live] += step
        live = live[equal]
    base = np.zeros(n, np.int64)
    base[heads] = heads + shared[heads]
    known = np.zeros(n, np.int64)
    known[heads] = heads
    known[~real] = place[~real]
    base[~real] = place[~real]
    latest = np.maximum.accumulate(known)
    return base[latest] - place


def repeats(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, for each of its strings of ``length`` bytes, whether it starts anywhere else in ``contexts`` too."""
    sizes = np.asarray([len(c) for c in contexts], np.int64)
    ends = np.cumsum(sizes + 1)
    text = np.ones(int(ends[-1]) + 1 if len(ends) else 1, np.int16)  # 1: between contexts
    text[-1] = 0
    inside = np.ones(len(text), bool)
    inside[ends - 1], inside[-1] = False, False
    text[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int16) + 2
    order = suffix_array(text, 258)
    shared = common_prefixes(text, order)[order] >= length
    hit = np.zeros(len(text), bool)
    hit[order[shared]] = True
    hit[order[np.flatnonzero(shared) - 1]] = True
    return [hit[e - s - 1 : e - 1 - length + 1] if s >= length else hit[:0] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
