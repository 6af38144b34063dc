"""Minimum-cost flow on small networks, for quotas that must be whole numbers.

Successive shortest paths with potentials: every arc keeps an integer capacity, so the flow is
integral. The networks here have one node for each category, cell or bundle, never one for each
row; the callers bound their number.
"""

from __future__ import annotations

import heapq
from collections.abc import Hashable

import numpy as np


class MinCostFlow:
    def __init__(self) -> None:
        self.index: dict[Hashable, int] = {}
        self.arcs: list[list[int]] = []  # node -> arc numbers
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []
        self.flow_of: dict[int, int] = {}

    def node(self, name: Hashable) -> int:
        if name not in self.index:
            self.index[name] = len(self.arcs)
            self.arcs.append([])
        return self.index[name]

    def add(self, a: Hashable, b: Hashable, capacity: int, cost: int) -> int:
        """Number of the new arc from a to b; costs are whole and not negative."""
        if capacity < 0 or cost < 0:
            raise ValueError("capacities and costs can't be negative")
        i, j, arc = self.node(a), self.node(b), len(self.to)
        for node, other, left, price in ((i, j, capacity, cost), (j, i, 0, -cost)):
            self.arcs[node].append(len(self.to))
            self.to.append(other)
            self.left.append(left)
            self.cost.append(price)
        self.flow_of[arc] = capacity
        return arc

    def flow(self, arc: int) -> int:
        return self.flow_of[arc] - self.left[arc]

    def solve(self, source: Hashable, sink: Hashable, amount: int) -> int:
        """Sends up to amount units at least cost; the number sent."""
        s, t = self.node(source), self.node(sink)
        price = [0] * len(self.arcs)
        sent = 0
        while sent < amount:
            dist: list[float] = [float("inf")] * len(self.arcs)
            came = [-1] * len(self.arcs)
            dist[s], heap = 0, [(0, s)]
            while heap:
                d, u = heapq.heappop(heap)
                if d > dist[u]:
                    continue
                for e in self.arcs[u]:
                    if self.left[e] > 0:
                        v, nd = self.to[e], d + self.cost[e] + price[u] - price[self.to[e]]
                        if nd < dist[v]:
                            dist[v], came[v] = nd, e
                            heapq.heappush(heap, (nd, v))
            if dist[t] == float("inf"):
                break
            for v, d in enumerate(dist):
                price[v] += int(min(d, dist[t]))
            push, v = amount - sent, t
            while v != s:
                push = min(push, self.left[came[v]])
                v = self.to[came[v] ^ 1]
            v = t
            while v != s:
                self.left[came[v]] -= push
                self.left[came[v] ^ 1] += push
                v = self.to[came[v] ^ 1]
            sent += push
        return sent


class DealFlow:
    """A flow of whole components from bundles to splits, with deviation costs at the splits.

    amounts[b]: components of bundle b. contents[b, k]: what each of them carries of the k-th kind (rows,
    rows with some label). shares[s] of each kind should reach split s; a deviation x of a kind costs
    x * x / what should reach it. Since one unit carries several kinds, the cost of a cycle is taken from
    all it carries: a cycle moves components of a bundle from one split to another, or exchanges components
    of two bundles between two splits. Negative cycles are cancelled, the best first, until there are none.
    """

    #: Bundles among which exchanges are searched, those of the smallest components.
    EXCHANGED = 1500

    def __init__(self, amounts: np.ndarray, contents: np.ndarray, shares: np.ndarray):
        self.amounts, self.contents, self.shares = amounts.astype(np.int64), contents.astype(float), shares.astype(float)
        self.total = self.amounts @ self.contents
        self.want = np.outer(self.shares, self.total)
        self.weight = 1 / np.maximum(self.want, 1e-9) * (self.want > 0)
        self.flow = np.zeros((len(amounts), len(shares)), dtype=np.int64)

    def off(self) -> np.ndarray:
        """[split, kind]: what arrives beyond what should."""
        return self.flow.T @ self.contents - self.want

    def cost(self) -> float:
        return float((self.weight * self.off() ** 2).sum())

    def solve(self, most: int = 100_000) -> np.ndarray:
        """[bundle, split]: whole components."""
        self._start()
        for _ in range(most):
            if not (self._move() or self._exchange()):
                break
        return self.flow

    def _start(self) -> None:
        """The whole parts of the shares; then the rest, the components that carry most first."""
        self.flow = np.floor(np.outer(self.amounts, self.shares) + 1e-9).astype(np.int64)
        off = self.off()
        rest = self.amounts - self.flow.sum(axis=1)
        for b in np.argsort(-self.contents[:, 0], kind="stable"):
            v = self.contents[b]
            for _ in range(int(rest[b])):
                s = int(np.argmin((self.weight * (2 * off * v + v * v)).sum(axis=1)))
                self.flow[b, s] += 1
                off[s] += v

    def _pairs(self):
        return ((s, t) for s in range(len(self.shares)) for t in range(len(self.shares)) if s != t)

    def _move(self) -> bool:
        off, v = self.off(), self.contents
        best = (-1e-9, 0, 0, 0, 0)
        for s, t in self._pairs():
            slope = v @ (2 * (self.weight[t] * off[t] - self.weight[s] * off[s]))
            bend = (v * v) @ (self.weight[s] + self.weight[t])
            n = np.clip(np.rint(-slope / np.maximum(2 * bend, 1e-300)), 0, self.flow[:, s])
            gain = n * slope + n * n * bend
            b = int(np.argmin(gain)) if len(gain) else -1
            if b >= 0 and gain[b] < best[0]:
                best = (float(gain[b]), b, s, t, int(n[b]))
        _, b, s, t, n = best
        if n:
            self.flow[b, s] -= n
            self.flow[b, t] += n
        return n > 0

    def _exchange(self) -> bool:
        off = self.off()
        some = np.argsort(self.contents[:, 0], kind="stable")[: self.EXCHANGED]
        v = self.contents[some]
        best = (-1e-9, -1, -1, 0, 0)
        for s, t in self._pairs():
            if s > t:
                continue
            give, take = self.flow[some, s] > 0, self.flow[some, t] > 0
            if not give.any() or not take.any():
                continue
            x, y, w = v[give], v[take], self.weight[s] + self.weight[t]
            slope = 2 * (self.weight[t] * off[t] - self.weight[s] * off[s])
            gain = (x @ slope + (x * x) @ w)[:, None] + ((y * y) @ w - y @ slope)[None, :] - 2 * (x * w) @ y.T
            i, j = np.unravel_index(int(np.argmin(gain)), gain.shape)
            if gain[i, j] < best[0]:
                best = (float(gain[i, j]), int(some[give][i]), int(some[take][j]), s, t)
        _, b, c, s, t = best
        if b < 0:
            return False
        self.flow[b, s] -= 1
        self.flow[b, t] += 1
        self.flow[c, t] -= 1
        self.flow[c, s] += 1
        return True
