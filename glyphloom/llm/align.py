"""Alignments of many pairs of texts at once, by least edits.

Texts are rows of code points. Pairs are taken in groups of like length, each as one table of edit
distances that grows a row at a time for all its pairs, and traced back for all of them together. A
pair whose own table would be too large is halved where its alignment passes (Hirschberg), which
takes memory in proportion to the longer text and finds as few edits.
"""

from __future__ import annotations

import numpy as np

#: Cells of the tables that are held at once.
CELLS = 2_000_000


class Texts:
    """Texts as one array of code points."""

    def __init__(self, texts: list[str]):
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)


def _edits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The last row of the table: edits from x to every beginning of y."""
    at = np.arange(len(y) + 1, dtype=np.int32)
    row = at
    for r, p in enumerate(x, start=1):
        low = np.concatenate([np.array([r], np.int32), np.minimum(row[:-1] + (y != p), row[1:] + 1)])
        row = np.minimum.accumulate(low - at) + at
    return row


def _cut(x: np.ndarray, y: np.ndarray, h: int) -> int:
    """Where to cut y so that the alignments with x before and from h on have least edits together."""
    return int(np.argmin(_edits(x[:h], y) + _edits(x[h:][::-1], y[::-1])[::-1]))


def _trimmed(points: np.ndarray, a: int, la: int, b: int, lb: int) -> tuple[int, int, int, int]:
    """Without what both begin and end with."""
    n = min(la, lb)
    differ = np.flatnonzero(points[a : a + n] != points[b : b + n])
    i = int(differ[0]) if len(differ) else n
    n -= i
    differ = np.flatnonzero(points[a + la - n : a + la][::-1] != points[b + lb - n : b + lb][::-1]) if n else np.zeros(0)
    j = int(differ[0]) if len(differ) else n
    return a + i, la - i - j, b + i, lb - i - j


def slips(texts: Texts, left: np.ndarray, right: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, a, b) of every place where texts left[pair] and right[pair] differ: the code points
    there, -1 where one of them has nothing; in order of the pairs."""
    pts = texts.points
    owner, a, la, b, lb = np.arange(len(left)), texts.starts[left], texts.lengths[left], texts.starts[right], texts.lengths[right]
    large = np.flatnonzero((la + 1) * (lb + 1) > max(cells // 16, 1))
    if len(large):  # one by one: trimmed, and halved for as long as a table is too large
        todo = [(int(owner[i]), int(a[i]), int(la[i]), int(b[i]), int(lb[i])) for i in large]
        ready = []
        while todo:
            o, *box = todo.pop()
            s, n, t, m = _trimmed(pts, *box)
            if (n + 1) * (m + 1) > cells and min(n, m) > 1:
                x, y = pts[s : s + n], pts[t : t + m]
                if n <= m:
                    h = n // 2
                    k = _cut(x, y, h)
                else:
                    k = m // 2
                    h = _cut(y, x, k)
                todo += [(o, s, h, t, k), (o, s + h, n - h, t + k, m - k)]
            elif n or m:
                ready.append((o, s, n, t, m))
        rest = np.array(ready, dtype=np.int64).reshape(-1, 5).T
        keep = np.ones(len(owner), dtype=bool)
        keep[large] = False
        owner, a, la, b, lb = (np.concatenate([v[keep], w]) for v, w in zip((owner, a, la, b, lb), rest))
    out = [(np.zeros(0, np.int64),) * 3]
    order = np.lexsort((lb, la, np.maximum(la, lb)))
    at = 0
    while at < len(order):
        # a group takes the longest of its pairs, which come last
        n = min(len(order) - at, max(1, cells // 4))
        while n > 1:
            g = order[at : at + n]
            if n * int(la[g].max() + 1) * int(lb[g].max() + 1) <= cells:
                break
            n = (n + 1) // 2
        g = order[at : at + n]
        out.append(_group(pts, owner[g], a[g], la[g], b[g], lb[g]))
        at += n
    pair, x, y = (np.concatenate(v) for v in zip(*out))
    order = np.argsort(pair, kind="stable")
    return pair[order], x[order], y[order]


def _padded(pts: np.ndarray, start: np.ndarray, length: np.ndarray, fill: int) -> np.ndarray:
    at = start[:, None] + np.arange(int(length.max(initial=0)))
    inside = at < (start + length)[:, None]
    return np.where(inside, pts[np.minimum(at, max(len(pts) - 1, 0))] if len(pts) else fill, fill)


def _group(pts: np.ndarray, owner: np.ndarray, a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if int(la.max()) * int(lb.max()) == 0 or len(owner) == 1 and min(int(la[0]), int(lb[0])) == 1:
        return _plain(pts, owner, a, la, b, lb)
    x, y = _padded(pts, a, la, -2), _padded(pts, b, lb, -3)
    n, m, k = len(owner), x.shape[1], y.shape[1]
    at = np.arange(k + 1, dtype=np.int32)
    table = np.empty((m + 1, n, k + 1), dtype=np.int32)
    table[0] = at
    for r in range(1, m + 1):
        row, above = table[r], table[r - 1]
        row[:, 0] = r
        np.minimum(above[:, :-1] + (y != x[:, r - 1 : r]), above[:, 1:] + 1, out=row[:, 1:])
        row -= at
        np.minimum.accumulate(row, axis=1, out=row)
        row += at
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    p, r, c = np.arange(n), la.copy(), lb.copy()
    while True:
        left = (r > 0) | (c > 0)
        if not left.all():
            p, r, c = p[left], r[left], c[left]
        if not len(p):
            break
        here = table[r, p, c]
        both = (r > 0) & (c > 0)
        u, v = np.maximum(r - 1, 0), np.maximum(c - 1, 0)
        s, t = x[p, u], y[p, v]
        other = s != t
        diagonal = both & (table[u, p, v] + other == here)
        up = ~diagonal & (r > 0) & (table[u, p, c] + 1 == here)
        slip = ~diagonal | other
        found.append((owner[p[slip]], np.where(diagonal | up, s, -1)[slip], np.where(up, -1, t)[slip]))
        r, c = np.where(diagonal | up, u, r), np.where(up, c, v)
    return tuple(np.concatenate(v).astype(np.int64) for v in zip(*found)) if found else (np.zeros(0, np.int64),) * 3  # type: ignore[return-value]


def _plain(pts: np.ndarray, owner: np.ndarray, a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where one text of each pair is empty, or a pair's shorter one is of one character."""
    out = [(np.zeros(0, np.int64),) * 3]
    for o, s, n, t, m in zip(*(v.tolist() for v in (owner, a, la, b, lb))):
        x, y = pts[s : s + n].astype(np.int64), pts[t : t + m].astype(np.int64)
        if n and m:  # the one character stands where it is the same, else by the last
            short, long = (x, y) if n == 1 else (y, x)
            same = np.flatnonzero(long == short[0])
            place = int(same[-1]) if len(same) else len(long) - 1
            one = np.full(len(long), -1)
            one[place] = short[0]
            x, y = (one, long) if n == 1 else (long, one)
            x, y = x[x != y], y[x != y]
        else:
            x, y = (x, np.full(n, -1)) if n else (np.full(m, -1), y)
        out.append((np.full(len(x), o), x, y))
    return tuple(np.concatenate(v).astype(np.int64) for v in zip(*out))  # type: ignore[return-value]
