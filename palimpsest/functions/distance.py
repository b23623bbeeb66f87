"""Exact edit distance for long texts (whole documents).

Spark's built-in ``levenshtein`` fills the full n x m matrix one cell at a
time (about 10 ns per cell); on documents of tens of thousands of characters
that dominates the job, and the three-argument bounded form measured no
faster. For whole documents we use the bit-parallel algorithm of Myers (1999)
in Hyyrö's (2003) formulation: one column of the matrix is a pair of bit
vectors, and Python's big integers do a whole column per machine-word
operation, so the cost is O(n * m / w). The common prefix and suffix are
stripped first, which makes appended / prepended / trailing edits nearly free.
On top of it, Ukkonen's band (only the diagonals within the distance can
matter) on the block form of the algorithm, with a growing band, brings the
cost down to O(n * d / w) for distance d.

Distances are on code points, the same as ``F.levenshtein``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bitparallel_levenshtein(a: str, b: str) -> int:
    """Exact Levenshtein distance of two strings (code points)."""
    if a == b:
        return 0
    # strip common prefix / suffix
    lo, la, lb = 0, len(a), len(b)
    while lo < la and lo < lb and a[lo] == b[lo]:
        lo += 1
    while la > lo and lb > lo and a[la - 1] == b[lb - 1]:
        la -= 1
        lb -= 1
    a, b = a[lo:la], b[lo:lb]
    if not a:
        return len(b)
    if not b:
        return len(a)
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    peq = _row_sets(a)
    mask = (1 << m) - 1
    last = 1 << (m - 1)
    vp, vn, dist = mask, 0, m
    for ch in b:
        x = peq.get(ch, 0) | vn
        d0 = (((x & vp) + vp) ^ vp) | x
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        if hp & last:
            dist += 1
        elif hn & last:
            dist -= 1
        hp = ((hp << 1) | 1) & mask
        hn = (hn << 1) & mask
        vp = (hn | ~(d0 | hp)) & mask
        vn = hp & d0
    return dist


def _strip_common(a: str, b: str) -> tuple[str, str]:
    """Both without their common prefix and suffix, found by halving."""
    def common(n: int, equal) -> int:
        least, most = 0, n
        while least < most:
            middle = (least + most + 1) // 2
            least, most = (middle, most) if equal(least, middle) else (least, middle - 1)
        return least

    lo = common(min(len(a), len(b)), lambda i, j: a[i:j] == b[i:j])
    a, b = a[lo:], b[lo:]
    n, m = len(a), len(b)
    hi = common(min(n, m), lambda i, j: a[n - j:n - i] == b[m - j:m - i])
    return a[:n - hi], b[:m - hi]


def exceeds(a: str, b: str, limit: int) -> bool:
    """Exact ``levenshtein(a, b) > limit`` with cheap certificates first.

    After the common prefix / suffix is removed: a length difference above the
    limit, or a bag (character multiset) distance above it, proves the answer,
    because both are lower bounds of the edit distance; only otherwise is the
    distance computed.
    """
    a, b = _strip_common(a, b)
    if abs(len(a) - len(b)) > limit:
        return True
    if max(len(a), len(b)) <= limit:
        return False
    ca, cb = Counter(a), Counter(b)
    if max(sum((ca - cb).values()), sum((cb - ca).values())) > limit:
        return True
    if len(a) > len(b):
        a, b = b, a
    return banded_levenshtein(a, b, limit, max(1024, limit)) > limit


@F.pandas_udf(T.BooleanType())
def _exceeds_udf(a: pd.Series, b: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else exceeds(x, y, int(k))
                      for x, y, k in zip(a, b, limit)], dtype="boolean")


_exceeds_udf = _exceeds_udf.asNondeterministic()


def long_exceeds(a, b, limit: int) -> Column:
    """F3 for document-sized texts: exact ``distance > limit`` (Arrow UDF)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _exceeds_udf(a, b, F.lit(limit))


def _advance_block(vp: int, vn: int, eq: int, hin: int, mask: int, high: int):
    """One column step of one pattern block (Myers 1999, block form)."""
    xv = eq | vn
    if hin < 0:
        eq |= 1
    xh = (((eq & vp) + vp) ^ vp) | eq
    ph = vn | ~(xh | vp)
    mh = vp & xh
    hout = (1 if ph & high else 0) - (1 if mh & high else 0)
    ph <<= 1
    mh <<= 1
    if hin < 0:
        mh |= 1
    elif hin > 0:
        ph |= 1
    return (mh | ~(xv | ph)) & mask, (ph & xv) & mask, hout


def banded_levenshtein(a: str, b: str, k: int, block: int = 2048) -> int:
    """Distance of ``a`` and ``b`` if it is at most ``k``; otherwise some value > k.

    Ukkonen's band on the block form of the bit-parallel algorithm: per text
    column only the pattern blocks that meet the band |i - j| <= k are
    advanced. A block entering the band starts from vertical +1 deltas and the
    topmost active block receives a +1 horizontal input once the blocks above
    it have left the band; both only over-estimate cells, and every cell whose
    distance is at most k is reached by an optimal path that stays inside the
    band, so those cells — and the answer, when <= k — are exact.
    """
    m, n = len(a), len(b)
    if abs(m - n) > k:
        return k + 1
    if m == 0:
        return n
    nb = (m + block - 1) // block
    sizes = [min(block, m - i * block) for i in range(nb)]
    masks = [(1 << sz) - 1 for sz in sizes]
    highs = [1 << (sz - 1) for sz in sizes]
    peq = [dict() for _ in range(nb)]
    for i, ch in enumerate(a):
        d = peq[i // block]
        d[ch] = d.get(ch, 0) | (1 << (i % block))
    vp = [0] * nb
    vn = [0] * nb
    score = [0] * nb
    first, last = 0, -1
    # column 0: D[i][0] = i for the rows within the band (i <= k)
    top_rows = min(m, k)
    while last < nb - 1 and (last + 1) * block < max(top_rows, 1):
        last += 1
        vp[last], vn[last] = masks[last], 0
        score[last] = (score[last - 1] if last > 0 else 0) + sizes[last]
    for j in range(1, n + 1):
        lo_row, hi_row = max(1, j - k), min(m, j + k)
        want_last = (hi_row - 1) // block
        while last < want_last:
            last += 1
            vp[last], vn[last] = masks[last], 0
            score[last] = score[last - 1] + sizes[last]
        first = max(first, (lo_row - 1) // block)
        ch = b[j - 1]
        hin = 1
        for bi in range(first, last + 1):
            vp[bi], vn[bi], hout = _advance_block(vp[bi], vn[bi], peq[bi].get(ch, 0), hin,
                                                  masks[bi], highs[bi])
            score[bi] += hout
            hin = hout
    return score[nb - 1] if last == nb - 1 else k + 1


def _row_sets(a: str) -> dict[str, int]:
    """For each character the places where it stands, as bits."""
    places: dict[str, bytearray] = {}
    size = (len(a) + 7) // 8
    for i, ch in enumerate(a):
        if ch not in places:
            places[ch] = bytearray(size)
        places[ch][i >> 3] |= 1 << (i & 7)
    return {ch: int.from_bytes(at, "little") for ch, at in places.items()}


def sliding_levenshtein(a: str, b: str, p: int, stretch: int = 4096) -> int:
    """Distance of ``a`` and the longer ``b`` if at most ``len(b) - len(a) + 2 p``; otherwise some value above that.

    A way through the matrix with at most ``p`` deletions stays on the
    diagonals from ``-p`` to ``len(b) - len(a) + p``. One integer holds their
    cells of a column and slides down a row with each column (Hyyrö 2003, the
    banded form); the distance grows where the final cell's diagonal does.
    Cells outside only over-estimate. Patterns are cut to the ``stretch`` of
    columns at work, so a step costs the band's width, not the text's.
    """
    more = len(b) - len(a)
    q = more + p
    mask = (1 << (p + q + 1)) - 1
    final = 1 << p
    rows = {ch: at << q for ch, at in _row_sets(a).items()}
    vp, vn, dist = ((1 << (p + 1)) - 1) << q, 0, more
    for start in range(0, len(b), stretch):
        part = b[start:start + stretch]
        near = (1 << (len(part) + p + q + 1)) - 1
        here = {ch: (rows[ch] >> start) & near for ch in set(part) if ch in rows}
        for j, ch in enumerate(part, start):
            x = (here[ch] >> (j - start)) & mask if ch in here else 0
            d0 = ((((x & vp) + vp) ^ vp) | x | vn) & mask
            hp = vn | (mask ^ (d0 | vp))
            hn = d0 & vp
            if j >= more and not d0 & final:
                dist += 1
            d0 >>= 1
            vp = hn | (mask ^ (d0 | hp))
            vn = d0 & hp
    return dist


def fast_levenshtein(a: str, b: str) -> int:
    """Exact distance: sliding bands of growing width, full pass as the bound.

    The characters that one text has more of than the other are a lower bound
    of the distance, so the first band is a little wider than they prove
    necessary; a failed pass doubles it. Once the band would cover most of
    the shorter text the unbanded pass is used instead. Cost O(n * d / w) for
    distance d, never worse than a few times the full pass.
    """
    if a == b:
        return 0
    a, b = _strip_common(a, b)
    if not a or not b:
        return len(a) + len(b)
    if len(a) > len(b):
        a, b = b, a
    more = len(b) - len(a)
    least = sum((Counter(b) - Counter(a)).values())
    p = (least - more) // 2 + 16 + len(a) // 128
    while 2 * (2 * p + more) < len(a):
        d = sliding_levenshtein(a, b, p)
        if d <= more + 2 * p:
            return d
        p *= 2
    return bitparallel_levenshtein(a, b)


@F.pandas_udf(T.LongType())
def _levenshtein_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    from palimpsest.functions.lanes import distances
    return pd.Series(distances(a.tolist(), b.tolist()), dtype="Int64")


@F.pandas_udf(T.BooleanType())
def _far_udf(a: pd.Series, b: pd.Series, limit: pd.Series) -> pd.Series:
    from palimpsest.functions.lanes import distances
    k = int(limit.iloc[0]) if len(limit) else 0
    return pd.Series([None if d is None else d > k for d in distances(a.tolist(), b.tolist(), k)], dtype="boolean")


@F.pandas_udf(T.LongType())
def _total_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    from palimpsest.functions.lanes import distances
    left, right = [s for texts in a for s in texts], [s for texts in b for s in texts]
    ends = np.cumsum([0, *map(len, a)])
    sums = np.concatenate([[0], np.cumsum(np.array(distances(left, right), np.int64))])
    return pd.Series(sums[ends[1:]] - sums[ends[:-1]])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _places_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    from palimpsest.functions.lanes import distances
    found = iter(distances([s for texts in a for s in texts], [s for texts in b for s in texts]))
    return pd.Series([[next(found) for _ in texts] for texts in a], dtype=object)


# The distance UDFs are pure, but marked non-deterministic on purpose: the
# optimizer then never copies them into a pushed-down filter, which would
# evaluate the most expensive expression of the job twice.
_levenshtein_udf = _levenshtein_udf.asNondeterministic()
_far_udf = _far_udf.asNondeterministic()
_total_udf = _total_udf.asNondeterministic()
_places_udf = _places_udf.asNondeterministic()


def long_edit_distance(a, b) -> Column:
    """Exact distance for document-sized texts (Arrow UDF, bit-parallel)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _levenshtein_udf(a, b)


def far_apart(a, b, limit: int) -> Column:
    """F3 for paragraphs: exact ``distance > limit``, many pairs at once in a band of that width (Arrow UDF)."""
    return _far_udf(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b, F.lit(limit))


def total_distance(a: str, b: str) -> Column:
    """Sum of the distances of two array columns' texts, place by place (Arrow UDF); no text may be null."""
    return _total_udf(a, b)


def place_distances(a: str, b: str) -> Column:
    """Distances of two array columns' texts, place by place (Arrow UDF)."""
    return _places_udf(a, b)
