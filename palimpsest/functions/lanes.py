"""Exact edit distances of many pairs of texts at once, for Arrow batches.

Myers' (1999) bit-parallel algorithm in its block form keeps 64 rows of a
pair's matrix in one word. Numpy advances the words of many pairs together:
block ``b`` of a pair takes column ``t - b`` in step ``t``, when the block
above it has just handed down what that column needs, so a step is a fixed
number of array operations over ``blocks x pairs``. Pairs of like size go
together, a bounded number of words and characters at a time.

With a band ``k`` only blocks that meet ``|i - j| <= k`` take part (Ukkonen):
a block starts from vertical differences of +1, and the topmost one gets +1
from above once the blocks over it are done. Both only over-estimate, so a
distance of at most ``k`` is exact and any other comes out above ``k``. Long
pairs get a band of their own width, a little wider than the characters that
one text has more of prove necessary; a pair that needs more gets twice that.
"""

from __future__ import annotations

import numpy as np

from palimpsest.functions.distance import bitparallel_levenshtein, fast_levenshtein, sliding_levenshtein

ROWS = 64          # rows of the matrix in a word
WORDS = 4096       # words that go together (32 KB an array)
TABLE = 1 << 22    # entries of a batch's character table and of its text matrix
STEP = 20          # a step of a batch takes as long as this many columns of one pair
WORD, COLUMN = 80, 50  # and so many words more of a batch, or of one pair, as one column
FULL = 64 * ROWS   # longer patterns go one by one, where Python's big integers are as fast
BAND = 6 * ROWS   # patterns from this length on get a band
CLASSES = 1024     # code points are counted in so many classes


def code_points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def stripped(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of both without the common prefix and suffix, the shorter first."""
    x, y = code_points(a), code_points(b)
    if len(x) > len(y):
        x, y = y, x
    n = len(x)
    if n and x[0] == y[0]:
        differ = x != y[:n]
        lo = int(differ.argmax())
        if not differ[lo]:
            lo = n
        x, y = x[lo:], y[lo:]
    n = len(x)
    if n and x[-1] == y[-1]:
        differ = x[::-1] != y[::-1][:n]
        hi = int(differ.argmax())
        if not differ[hi]:
            hi = n
        x, y = x[:n - hi], y[:len(y) - hi]
    return x, y


def _places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each character of texts laid end to end: its text and its place there."""
    whose = np.repeat(np.arange(len(lengths)), lengths)
    return whose, np.arange(len(whose)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _codes(pattern: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters as small numbers: from 2 the patterns', frequent ones first, 1 any other (0 stays free), and their count."""
    seen = np.bincount(pattern, minlength=int(text.max()) + 1)
    found = np.flatnonzero(seen)
    code = np.ones(len(seen), np.int64)
    code[found[np.argsort(-seen[found], kind="stable")]] = np.arange(2, len(found) + 2)
    return code[pattern], code[text], len(found) + 2


def _advance(pairs: list[tuple[np.ndarray, np.ndarray]], k: int, right: int | None = None) -> np.ndarray:
    """Distances of a batch of non-empty pairs (shorter first) within the diagonals from ``-k`` to ``right`` (or ``k``).

    ``right`` must reach the final cell of every pair.
    """
    right = k if right is None else right
    m = np.array([len(a) for a, _ in pairs])
    n = np.array([len(b) for _, b in pairs])
    blocks = (m + ROWS - 1) // ROWS
    order = np.argsort(-(n + blocks), kind="stable")  # pairs that end first stand last
    pairs, m, n, blocks = [pairs[i] for i in order], m[order], n[order], blocks[order]
    last = n + blocks - 1
    size, top, steps = len(pairs), int(blocks.max()), int(last[0])
    out = np.empty(size, np.int64)
    pattern, chars, alphabet = _codes(np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs]))
    if top * size * alphabet > TABLE and size > 1:
        half = size // 2
        out[order] = np.concatenate([_advance(pairs[:half], k, right), _advance(pairs[half:], k, right)])
        return out

    base = np.arange(top * size).reshape(top, size) * alphabet
    peq = np.zeros(top * size * alphabet, np.uint64)
    whose, place = _places(m)
    entry = ((place // ROWS) * size + whose) * alphabet + pattern
    bit = place % ROWS
    order_by_bit = np.argsort(bit, kind="stable")
    entry, at_bit = entry[order_by_bit], np.searchsorted(bit[order_by_bit], np.arange(ROWS + 1))
    for r in range(ROWS):  # no entry comes twice in one bit
        peq[entry[at_bit[r]:at_bit[r + 1]]] |= np.uint64(1 << r)
    text = np.zeros((steps + 2, size), np.int64)  # the last column first, as blocks take them
    whose, place = _places(n)
    text[steps - place, whose] = chars

    one, high = np.uint64(1), np.uint64(ROWS - 1)
    state = np.zeros((4, top + 1, size), np.uint64)  # vertical +1, -1 of each block; horizontal +1, -1 into it
    state[0], state[2, 0] = ~np.uint64(0), one
    ended = np.empty_like(state)
    work, at = np.empty((6, top, size), np.uint64), np.empty((top, size), np.int64)
    live = size - np.searchsorted(last[::-1], np.arange(steps + 2))  # pairs that take part in a step
    width, before, views = size, -1, None
    for t in range(1, steps + 1):
        lo = max(0, -((ROWS + right - t) // (ROWS + 1)))
        hi = min(top, t, (t - 1 + k) // (ROWS + 1) + 1)
        if lo == before and lo:
            state[2, lo], state[3, lo] = one, 0
        before = lo
        if views is None or views[0] != (lo, hi):
            views = (lo, hi), [v[lo:hi] for v in (base, at, *work[:4], *state)] + [work[2:4, lo:hi], work[4:, lo:hi], work[4, lo:hi], work[5, lo:hi],
                                                                               state[2:, lo:hi], state[2:, lo + 1:hi + 1]]
        base_, at_, eq, xv, x, mh, vp, vn, _, hn, both, shifted, ph, mhs, h_in, h_out = views[1]
        np.add(base_, text[steps + 1 - t + lo:steps + 1 - t + hi], out=at_)
        np.take(peq, at_, out=eq, mode="clip")
        np.bitwise_or(eq, vn, out=xv)
        np.bitwise_or(eq, hn, out=eq)
        np.bitwise_and(eq, vp, out=x)
        np.add(x, vp, out=x)
        np.bitwise_xor(x, vp, out=x)
        np.bitwise_or(x, eq, out=x)
        np.bitwise_and(vp, x, out=mh)
        np.bitwise_or(x, vp, out=x)
        np.invert(x, out=x)
        np.bitwise_or(x, vn, out=x)
        np.add(both, both, out=shifted)
        np.bitwise_or(shifted, h_in, out=shifted)
        np.right_shift(both, high, out=h_out)
        np.bitwise_and(ph, xv, out=vn)
        np.bitwise_or(ph, xv, out=ph)
        np.invert(ph, out=ph)
        np.bitwise_or(ph, mhs, out=vp)
        left = live[t + 1]
        if left < live[t]:  # kept as they are now; their places are given up when a quarter is free
            ended[:, :, left:live[t]] = state[:, :, left:live[t]]
            if 4 * left <= 3 * width:
                width, views = int(left), None
                base, text, state = (np.ascontiguousarray(v[..., :width]) for v in (base, text, state))
                work, at = np.empty((6, top, width), np.uint64), np.empty((top, width), np.int64)

    # The distance, along a way through the matrix: each block's rows in the last column it took,
    # and between blocks +1 for every column to the right or back over the last one to the left.
    vp, vn, hp, hn = ended
    b = np.arange(top)[:, None]
    end = np.minimum(ROWS * (b + 1) + right, last - b)
    move = np.diff(end, axis=0)
    move = np.where(move >= 0, move, hn[1:-1].astype(np.int64) - hp[1:-1].astype(np.int64))
    rows = np.clip(m - ROWS * b, 0, ROWS).astype(np.uint64)
    kept = np.where(rows == 0, 0, ~np.uint64(0) >> (np.uint64(ROWS) - np.maximum(rows, one)))
    down = np.bitwise_count(vp[:-1] & kept).astype(np.int64) - np.bitwise_count(vn[:-1] & kept).astype(np.int64)
    down[1:] += np.where(b[1:] < blocks, move, 0)
    out[order] = end[0] + down.sum(axis=0)
    return out


def _batches(items: list[tuple[int, int, int]], band: int):
    """Runs of ``(blocks, length, index)`` of like size, a bounded number of words at work and of characters each."""
    items.sort(reverse=True)
    run, top, longest = [], 0, 0
    for blocks, n, i in items:
        more = len(run) + 1
        if run and (more * min(top, band) > WORDS or more * (max(longest, n) + top) > TABLE or 4 * blocks < 3 * top and 2 * len(run) * top > WORDS):
            yield run
            run, longest = [], 0
        if not run:
            top = blocks
        run.append(i)
        longest = max(longest, n)
    if run:
        yield run


def _first_band(x: np.ndarray, y: np.ndarray) -> int:
    """Deletions that the band of a pair allows at first: half of what the characters prove, and some more."""
    fewer = np.bincount(y % CLASSES, minlength=CLASSES) - np.bincount(x % CLASSES, minlength=CLASSES)
    return (int(np.maximum(fewer, 0).sum()) - len(y) + len(x)) // 2 + 16 + len(x) // 128


def _banded(pairs: dict[int, tuple[np.ndarray, np.ndarray]], out: list) -> list[int]:
    """Puts the distances of long pairs into ``out``, each in a growing band; returns those for which a band is no less work.

    A way with at most ``p`` deletions stays on the diagonals from ``-p`` to
    the difference of the lengths and ``p`` more, and a distance of at most
    that difference and ``2 p`` has such a way. Pairs of like length go
    together in the widest band among them; the longest of a batch go one by
    one, where that is less work.
    """
    more = {i: len(y) - len(x) for i, (x, y) in pairs.items()}
    tried, rest = {i: _first_band(x, y) for i, (x, y) in pairs.items()}, []
    while tried:
        todo = []
        for i, p in tried.items():
            (todo if 2 * (2 * p + more[i]) < len(pairs[i][0]) else rest).append(i)
        todo.sort(key=lambda i: -len(pairs[i][1]))
        again, at = {}, 0
        while at < len(todo):
            longest, run, p, gap = len(pairs[todo[at]][1]), [], 0, 0
            for i in todo[at:]:
                p_, gap_ = max(p, tried[i]), max(gap, more[i])
                words, size = (2 * p_ + gap_) // ROWS + 3, len(run) + 1
                if run and (words * size > WORDS or size * longest > TABLE // 2 or 4 * len(pairs[i][1]) < 3 * longest):
                    break
                run.append(i)
                p, gap = p_, gap_
            at += len(run)
            n = np.array([len(pairs[i][1]) for i in run] + [0])
            own = np.array([(2 * tried[i] + more[i]) / ROWS for i in run] + [0])
            words = (2 * p + gap) // ROWS + 3
            single = n * (1 + own / COLUMN)  # in columns of one pair
            together = n * (STEP + words * np.arange(len(run), -1, -1) / WORD)
            alone = int((np.cumsum(single) - single + together).argmin())
            for i in run[:alone]:
                x, y = (c.tobytes().decode("utf-32-le", "surrogatepass") for c in pairs[i])
                out[i] = sliding_levenshtein(x, y, tried[i])
                if out[i] > more[i] + 2 * tried[i]:
                    again[i] = 2 * tried[i]
            if run := run[alone:]:
                p, gap = max(tried[i] for i in run), max(more[i] for i in run)
                for i, d in zip(run, _advance([pairs[i] for i in run], p, gap + p).tolist()):
                    out[i] = d
                    if d > more[i] + 2 * p:
                        again[i] = 2 * p
        tried = again
    return rest


def distances(left, right, limit: int | None = None) -> list[int | None]:
    """Levenshtein distance (code points) of each pair, None where a side is None.

    With ``limit`` a distance above it may come out as any value above it.
    """
    out: list[int | None] = [None] * len(left)
    pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i, (a, b) in enumerate(zip(left, right)):
        if a is None or b is None:
            continue
        if a == b:
            out[i] = 0
            continue
        x, y = stripped(a, b)
        if len(x) == 0 or limit is not None and len(y) - len(x) > limit:
            out[i] = len(y) - len(x)
        else:
            pairs[i] = x, y
    groups: dict[bool, list] = {False: [], True: []}
    if limit is None:
        long = {i: pairs.pop(i) for i in [i for i, (x, _) in pairs.items() if len(x) >= BAND]}
        for i in _banded(long, out):
            if len(long[i][0]) > FULL:
                out[i] = bitparallel_levenshtein(left[i], right[i])
            else:
                pairs[i] = long[i]
    for i, (x, y) in pairs.items():
        whole = limit is None or limit >= len(x)
        groups[whole].append(((len(x) + ROWS - 1) // ROWS, len(y), i))
    for whole, items in groups.items():
        for run in _batches(items, TABLE if whole or not items else 2 * limit // ROWS + 2):
            if limit is None:  # the few much longer ones go one by one, where that is less work than a step each column
                run.sort(key=lambda i: -len(pairs[i][1]))
                lengths = np.array([len(pairs[i][1]) for i in run] + [0])
                alone = int((np.cumsum(lengths) - lengths + STEP * lengths).argmin())
                for i in run[:alone]:
                    out[i] = fast_levenshtein(left[i], right[i])
                if not (run := run[alone:]):
                    continue
            part = [pairs[i] for i in run]
            k = (ROWS + 2) * max(len(y) for _, y in part) if whole else limit
            for i, d in zip(run, _advance(part, k).tolist()):
                out[i] = d
    return out
