"""k-d trees as arrays, searched many queries at a time.

One form serves both levels of the distributed tree: the top tree, whose leaves are partitions of the
candidates, and the tree that a task builds over the candidates of one partition. A query is a row of
numbers; NaN entries are not measured, so distances and box bounds run over the others only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Pairs of query and box, or of query and point, in one numpy block.
BLOCK = 250_000
#: Pairs of query and leaf that a search holds at a time.
PAIRS = 1_000_000
#: Above this many dimensions boxes prune little: leaves are larger and distances go through a matrix product.
NARROW = 8
WIDE_LEAF = 1_024
#: Queries of a block in many dimensions.
WIDE_ROWS = 512
#: Squared norms between which products are taken in single precision; its rounding is bounded like any other.
SINGLE = 1e-24, 1e24
#: Part of a block that may be measured again, one in so many; beyond it products are taken in double precision.
LOOSE = 16
#: Pairs that are measured at a time.
MEASURED = 1 << 15


def gap_squares(gap: np.ndarray, out: np.ndarray) -> None:
    """Add squares to ``out``; NaN adds nothing."""
    np.multiply(gap, gap, out=gap)
    if np.isnan(gap).any():
        np.nan_to_num(gap, copy=False, nan=0.0, posinf=np.inf)
    out += gap


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances by direct differences, dimension after dimension."""
    out = np.zeros((len(queries), len(points)))
    step = np.empty_like(out)
    for d in range(queries.shape[1]):
        np.subtract(queries[:, d, None], points[None, :, d], out=step)
        gap_squares(step, out)
    return out


def pair_squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distance of each query to its own point, summed in the order of :func:`squared`."""
    out = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        gap_squares(queries[:, d] - points[:, d], out)
    return out


def box_squared(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to its own box, summed in the order of :func:`squared`."""
    out = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        x = queries[:, d]
        gap_squares(np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0), out)
    return out


def reach_squared(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to the farthest corner of its own box."""
    out = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        x = queries[:, d]
        gap_squares(np.maximum(np.abs(x - low[:, d]), np.abs(x - high[:, d])), out)
    return out


@dataclass(frozen=True)
class Splits:
    """Axis and cut of each inner node in heap order; a point goes right where its entry is above the cut."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def assign(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point. A missing entry goes left: any leaf may start a search."""
        node = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] > self.cut[node])
        return node - (self.leaves - 1)


def median_splits(points: np.ndarray, depth: int) -> Splits:
    """Splits of the widest axis at the median of ``points``."""
    nodes = (1 << depth) - 1
    axis, cut = np.zeros(max(nodes, 1), dtype=np.int64), np.full(max(nodes, 1), np.inf)
    groups = {0: points}
    for node in range(nodes):
        own = groups.pop(node)
        right = np.zeros(len(own), dtype=bool)
        if len(own):
            widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            values = own[:, widest]
            middle = float(np.median(values))
            if middle >= values.max():
                # more than half of the points share the maximum: cut just below it
                below = values[values < middle]
                middle = float(below.max()) if len(below) else middle
            axis[node], cut[node] = widest, middle
            right = values > middle
        groups[2 * node + 1], groups[2 * node + 2] = own[~right], own[right]
    return Splits(axis, cut, depth)


class Tree:
    """Tight boxes and weights of all nodes in heap order over given leaves."""

    def __init__(self, splits: Splits, low: np.ndarray, high: np.ndarray, weight: np.ndarray):
        """``low``, ``high``, ``weight`` per leaf; an empty leaf has weight 0."""
        self.splits, self.depth, self.leaves = splits, splits.depth, splits.leaves
        first, d = self.leaves - 1, low.shape[1]
        self.low, self.high = np.full((2 * self.leaves - 1, d), np.inf), np.full((2 * self.leaves - 1, d), -np.inf)
        self.weight = np.zeros(2 * self.leaves - 1, dtype=np.int64)
        full = weight > 0
        self.low[first:][full], self.high[first:][full], self.weight[first:] = low[full], high[full], weight
        for level in range(self.depth - 1, -1, -1):
            node = np.arange((1 << level) - 1, (2 << level) - 1)
            self.low[node] = np.minimum(self.low[2 * node + 1], self.low[2 * node + 2])
            self.high[node] = np.maximum(self.high[2 * node + 1], self.high[2 * node + 2])
            self.weight[node] = self.weight[2 * node + 1] + self.weight[2 * node + 2]

    def _slices(self, n: int) -> Iterator[slice]:
        step = max(64, BLOCK // self.leaves)
        for begin in range(0, n, step):
            yield slice(begin, min(begin + step, n))

    def visit(self, queries: np.ndarray, r2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) where the leaf's box is no farther than the query's radius; only such nodes are opened."""
        rows, leaves, _ = self._open(queries, r2, strict=False)
        return rows, leaves

    def count(self, queries: np.ndarray, r2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, leaf) that the sphere cuts, and per query the weight of nodes wholly inside (strictly)."""
        return self._open(queries, r2, strict=True)

    def _open(self, queries: np.ndarray, r2: np.ndarray, strict: bool):
        inside = np.zeros(len(queries), dtype=np.int64)
        found = list(self._parts(queries, r2, strict, inside))
        rows, leaves = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
        return rows, leaves, inside

    def _parts(self, queries: np.ndarray, r2: np.ndarray, strict: bool, inside: np.ndarray):
        """(query, leaf) of slices of the queries; weights of nodes wholly inside are added to ``inside``."""
        for part in self._slices(len(queries)):
            rows = np.arange(part.start, part.stop)
            node = np.zeros(len(rows), dtype=np.int64)
            for level in range(self.depth + 1):
                if level:
                    rows = np.repeat(rows, 2)
                    node = np.repeat(2 * node + 1, 2)
                    node[1::2] += 1
                far = box_squared(queries[rows], self.low[node], self.high[node])
                keep = (far < r2[rows] if strict else far <= r2[rows]) & (self.weight[node] > 0)
                rows, node = rows[keep], node[keep]
                if strict:
                    whole = reach_squared(queries[rows], self.low[node], self.high[node]) < r2[rows]
                    np.add.at(inside, rows[whole], self.weight[node[whole]])
                    rows, node = rows[~whole], node[~whole]
            yield rows, node - (self.leaves - 1)

    def closest_leaf(self, queries: np.ndarray) -> np.ndarray:
        """A leaf near each query: of two nodes the nearer one, or that with the nearer farthest corner.

        A cut says less: where many points share its value, they lie on both sides of it.
        """
        node = np.zeros(len(queries), dtype=np.int64)
        for _ in range(self.depth):
            left, right = 2 * node + 1, 2 * node + 2
            near, far = ([of(queries, self.low[x], self.high[x]) for x in (left, right)] for of in (box_squared, reach_squared))
            node = np.where((near[0] < near[1]) | ((near[0] == near[1]) & (far[0] <= far[1])), left, right)
        return node - (self.leaves - 1)

    def radius(self, queries: np.ndarray, need: int) -> np.ndarray:
        """Squared radius of a ball with at least weight ``need``: the smallest node with so much above the
        query's leaf; infinite where the whole tree has less."""
        node = self.splits.assign(queries) + self.leaves - 1
        for _ in range(self.depth):
            node = np.where((self.weight[node] < need) & (node > 0), (node - 1) // 2, node)
        far = reach_squared(queries, self.low[node], self.high[node])
        return np.where(self.weight[node] >= need, far, np.inf)


@dataclass(frozen=True)
class Side:
    """Queries of a block as factors of a product: with the squares of the queries it gives squared distances, as far from
    those of :func:`squared` as ``error`` says at most."""

    factors: np.ndarray
    square: np.ndarray
    error: np.ndarray
    single: bool


class PointTree(Tree):
    """A tree over points in memory, built level by level with all nodes of a level at once.

    A node is cut in the middle, or at the end of a run of equal values near it, so that few nodes share a value.
    """

    def __init__(self, points: np.ndarray, leaf_rows: int):
        n, d = points.shape
        self.wide = d > NARROW and bool(np.isfinite(points).all())
        leaf_rows = max(leaf_rows, WIDE_LEAF if self.wide else 1)
        depth = max(0, (n // leaf_rows).bit_length() - 1)
        axis, cut = np.zeros(max(1, (1 << depth) - 1), dtype=np.int64), np.full(max(1, (1 << depth) - 1), np.inf)
        order, edge = np.arange(n), np.array([0, n])
        for level in range(depth):
            first = (1 << level) - 1
            of = np.repeat(np.arange(1 << level), np.diff(edge))
            own = points[order]
            wide = np.maximum.reduceat(own, edge[:-1]) - np.minimum.reduceat(own, edge[:-1])
            axis[first : 2 * first + 1] = wide.argmax(axis=1)
            value = own[np.arange(n), axis[first + of]]
            by = np.lexsort((value, of))
            order, value = order[by], value[by]
            middle = _run_ends(value, edge)
            cut[first : 2 * first + 1] = points[order[middle - 1], axis[first : 2 * first + 1]]
            edge = np.insert(edge, np.arange(1, len(edge)), middle)
        self.order, self.edge, self.points = order, edge, points
        own = points[order]
        low = np.minimum.reduceat(own, edge[:-1]) if n else np.zeros((1, d))
        high = np.maximum.reduceat(own, edge[:-1]) if n else np.zeros((1, d))
        super().__init__(Splits(axis, cut, depth), low, high, np.diff(edge))
        if self.wide:
            self.centre = points.mean(axis=0)
            self.sides = {}
            self.largest = float(((points - self.centre) ** 2).sum(axis=1).max(initial=0.0))

    def members(self, leaf: int) -> np.ndarray:
        return self.order[self.edge[leaf] : self.edge[leaf + 1]]

    def blocks(self, rows: np.ndarray, leaves: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, points) of each leaf among the pairs, in blocks."""
        by = np.argsort(leaves, kind="stable")
        rows, leaves = rows[by], leaves[by]
        starts = np.flatnonzero(np.append(True, leaves[1:] != leaves[:-1])) if len(leaves) else []
        for a, b in zip(starts, [*starts[1:], len(leaves)]):
            members = self.members(leaves[a])
            step = max(1, BLOCK // len(members))
            for i in range(a, b, step):
                yield rows[i : min(i + step, b)], members

    def _reached(self, queries: np.ndarray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of the leaves within ``limit``, a bounded number of pairs at a time."""
        held, count = [], 0
        for part in self._parts(queries, limit, False, np.zeros(0, dtype=np.int64)):
            held.append(part)
            count += len(part[0])
            if count >= PAIRS:
                yield from self.blocks(*(np.concatenate(x) for x in zip(*held)))
                held, count = [], 0
        if count:
            yield from self.blocks(*(np.concatenate(x) for x in zip(*held)))

    def nearest(self, queries: np.ndarray, limit: np.ndarray, k: int, own: np.ndarray | None):
        """(query, point, squared distance) of the ``k`` nearest points within ``limit``, ties to the lower point.

        ``own``: the point that a query is itself, or -1; it is left out. What is found is cut back to ``k`` a query
        whenever it has grown to a few times that.
        """
        limit = limit.copy()
        if self.wide:
            return _first([self._nearest_wide(queries, block, limit, k, own) for block in self._wide_blocks(queries)], k)
        for rows, members in self.blocks(np.arange(len(queries)), self.closest_leaf(queries)):
            if len(members) >= k:
                far = self._far(queries, rows, members, own)
                limit[rows] = np.minimum(limit[rows], np.partition(far, k - 1, axis=1)[:, k - 1])
        found, held, last = [], 0, np.full(len(queries), len(self.points))
        for rows, members in self._reached(queries, limit):
            far = self._far(queries, rows, members, own)
            edge = limit[rows][:, None]
            # of points as far as the last one found, only those of a lower number
            r, c = np.nonzero(((far < edge) | ((far == edge) & (members[None, :] < last[rows][:, None]))) & (far < np.inf))
            found.append((rows[r], members[c], far[r, c]))
            held += len(r)
            if held > 3 * k * len(queries) + BLOCK:
                found = [_first(found, k)]
                held = len(found[0][0])
                _lower(limit, last, found[0], k)
        return _first(found, k)

    def _far(self, queries, rows, members, own) -> np.ndarray:
        far = squared(queries[rows], self.points[members])
        if own is not None:
            far[own[rows][:, None] == members[None, :]] = np.inf
        return far

    def _wide_blocks(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, a leaf near each) of blocks of neighbouring queries."""
        close = self.closest_leaf(queries)
        order = np.argsort(close, kind="stable")
        for i in range(0, len(order), WIDE_ROWS):
            yield order[i : i + WIDE_ROWS], close[order[i : i + WIDE_ROWS]]

    def _wide_leaves(self, x: np.ndarray, limit: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """(rows of ``x``, leaf) within ``limit``, which may fall meanwhile: leaves ``first``, then the nearest to all."""
        node = np.arange(self.leaves) + self.leaves - 1
        low, high = (np.broadcast_to(of.reduce(x, axis=0), (self.leaves, x.shape[1])) for of in (np.fmin, np.fmax))
        gap = np.zeros(self.leaves)
        for d in range(x.shape[1]):
            gap_squares(np.maximum(np.maximum(self.low[node, d] - high[:, d], low[:, d] - self.high[node, d]), 0.0), gap)
        gap[first] = -1.0
        for leaf in np.argsort(gap, kind="stable"):
            if gap[leaf] > limit.max():
                return
            at = node[leaf]
            if self.weight[at]:
                rows = np.flatnonzero(box_squared(x, self.low[at][None, :], self.high[at][None, :]) <= limit)
                if len(rows):
                    yield rows, leaf

    def _nearest_wide(self, queries, block, limit, k, own) -> tuple[np.ndarray, ...]:
        """:meth:`nearest` of one block of queries, leaf after leaf; limits fall with what is found."""
        of, close = block
        x, near = queries[of], limit[of]
        side = self._side(x, True)
        for leaf in np.unique(close):
            rows, members = np.flatnonzero(close == leaf), self.members(leaf)
            if len(members) >= k:
                far = self._products(side, rows, leaf)
                if own is not None:
                    far[own[of[rows]][:, None] == members[None, :]] = np.inf
                kth = np.partition(far, k - 1, axis=1)[:, k - 1].astype(float)
                near[rows] = np.minimum(near[rows], kth + side.square[rows] + side.error[rows])
        found, held, last = [], 0, np.full(len(of), len(self.points))
        for rows, leaf in self._wide_leaves(x, near, np.unique(close)):
            members = self.members(leaf)
            while True:
                far = self._products(side, rows, leaf)
                hit = np.flatnonzero(far <= _up(near[rows] + side.error[rows] - side.square[rows], far)[:, None])
                if not side.single or len(hit) <= far.size // LOOSE:
                    break
                side = self._side(x, False)
            r, c = np.divmod(hit, len(members))
            r, c = rows[r], members[c]
            if own is not None:
                other = own[of[r]] != c
                r, c = r[other], c[other]
            exact = self._measured(x, r, c)
            keep = ((exact < near[r]) | ((exact == near[r]) & (c < last[r]))) & (exact < np.inf)
            found.append((r[keep], c[keep], exact[keep]))
            held += len(found[-1][0])
            if held > 2 * k * len(of):
                found = [_first(found, k)]
                held = len(found[0][0])
                _lower(near, last, found[0], k)
        rows, columns, far = _first(found, k)
        return of[rows], columns, far

    def _side(self, x: np.ndarray, single: bool) -> Side:
        x = x - self.centre
        gaps = np.isnan(x)
        if gaps.any():
            x[gaps] = 0.0
            factors = np.hstack([x, ~gaps])
        else:
            factors = np.hstack([x, np.ones((len(x), 1))])
        square = (x * x).sum(axis=1)
        single = single and SINGLE[0] < self.largest and max(self.largest, square.max(initial=0.0)) < SINGLE[1]
        kind = np.float32 if single else float
        error = 8 * (x.shape[1] + 8) * np.finfo(kind).eps * (square + self.largest)
        return Side(factors.astype(kind), square, error, single)

    def _products(self, side: Side, rows: np.ndarray, leaf: int) -> np.ndarray:
        """Squared distances less the squares of the queries, for some rows of a side and the points of a leaf."""
        width = side.factors.shape[1]
        key = width, side.single
        if key not in self.sides:
            # twice the negative of centred points, and their squares, summed where no query has gaps
            made = np.empty((len(self.points), width), dtype=side.factors.dtype)
            for i in range(0, len(made), MEASURED):
                p = self.points[self.order[i : i + MEASURED]] - self.centre
                square = p * p
                made[i : i + MEASURED] = np.hstack([-2 * p, square if width > p.shape[1] + 1 else square.sum(axis=1)[:, None]])
            self.sides[key] = made
        return side.factors[rows] @ self.sides[key][self.edge[leaf] : self.edge[leaf + 1]].T

    def _measured(self, x: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Squared distances of pairs, as :func:`squared` has them."""
        out = np.empty(len(rows))
        for i in range(0, len(rows), MEASURED):
            part = slice(i, i + MEASURED)
            out[part] = pair_squared(x[rows[part]], self.points[columns[part]])
        return out

    def least_priced(self, queries: np.ndarray, limit: np.ndarray, price: np.ndarray):
        """(query, point, value) of the least distance plus price within ``limit``, ties to the lower point."""
        best, at = np.full(len(queries), np.inf), np.full(len(queries), len(price))
        if self.wide:
            for of, close in self._wide_blocks(queries):
                best[of], at[of] = self._least_priced_wide(queries[of], close, limit[of].copy(), price)
            found = np.flatnonzero(np.isfinite(best))
            return found, at[found], best[found]
        reach = np.maximum(limit - price.min(), 0.0)
        for rows, members in self._reached(queries, reach * reach * (1 + 1e-9) + 1e-12):
            value = np.sqrt(squared(queries[rows], self.points[members])) + price[members][None, :]
            least = value.min(axis=1)
            point = np.where(value == least[:, None], members[None, :], len(price)).min(axis=1)
            better = (least < best[rows]) | ((least == best[rows]) & (point < at[rows]))
            best[rows[better]], at[rows[better]] = least[better], point[better]
        found = np.flatnonzero(np.isfinite(best))
        return found, at[found], best[found]

    def _least_priced_wide(self, x, close, limit, price) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`least_priced` of one block of queries, leaf after leaf; limits fall with what is found."""
        side, least = self._side(x, True), price.min()
        best, at = np.full(len(x), np.inf), np.full(len(x), len(price))

        def reached(limit: np.ndarray) -> np.ndarray:
            # a little wider than the limit, as its square is rounded
            gap = np.maximum(limit - least, 0.0)
            return gap * gap * (1 + 1e-9) + 1e-12

        def measure(r: np.ndarray, c: np.ndarray) -> None:
            value = np.sqrt(self._measured(x, r, c)) + price[c]
            order = np.lexsort((c, value, r))
            r, c, value = r[order], c[order], value[order]
            first = np.append(True, r[1:] != r[:-1]) if len(r) else np.zeros(0, dtype=bool)
            r, c, value = r[first], c[first], value[first]
            better = (value < best[r]) | ((value == best[r]) & (c < at[r]))
            r, c, value = r[better], c[better], value[better]
            best[r], at[r] = value, c
            limit[r] = np.minimum(limit[r], value)
            reach[r] = reached(limit[r])

        reach = reached(limit)
        for rows, leaf in self._wide_leaves(x, reach, np.unique(close)):
            members = self.members(leaf)
            dear, again = price[members], True
            while True:
                far = self._products(side, rows, leaf)
                kind, edge = far.dtype, limit[rows]
                # limits less prices are rounded as well
                slack = side.error[rows] + 16 * np.finfo(kind).eps * (np.abs(edge) + np.abs(dear).max()) ** 2
                value = np.subtract(edge.astype(kind)[:, None], dear.astype(kind)[None, :])
                if dear.max() > edge.min():
                    np.maximum(value, 0, out=value)
                np.multiply(value, value, out=value)
                np.subtract(value, far, out=value)
                hit = np.flatnonzero(value >= _down(side.square[rows] - slack, far)[:, None])
                if len(hit) <= far.size // LOOSE:
                    break
                if again:
                    # the likely least of each query first, so that its limit falls
                    measure(rows, members[value.argmax(axis=1)])
                    again = False
                elif side.single:
                    side = self._side(x, False)
                else:
                    break
            r, c = np.divmod(hit, len(members))
            measure(rows[r], members[c])
        return best, at

    def weight_within(self, queries: np.ndarray, r2: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Summed ``weight`` (of points) strictly within each query's squared radius."""
        total = np.zeros(len(queries), dtype=np.int64)
        if self.wide:
            for of, _ in self._wide_blocks(queries):
                total[of] = self._weight_wide(queries[of], r2[of], weight)
            return total
        for rows, members in self._reached(queries, r2):
            nearer = squared(queries[rows], self.points[members]) < r2[rows][:, None]
            np.add.at(total, rows, (nearer * weight[members][None, :]).sum(axis=1))
        return total

    def _weight_wide(self, x: np.ndarray, r2: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """:meth:`weight_within` of one block of queries."""
        side = self._side(x, True)
        total = np.zeros(len(x), dtype=np.int64)
        for rows, leaf in self._wide_leaves(x, r2, np.zeros(0, dtype=np.int64)):
            members = self.members(leaf)
            while True:
                far = self._products(side, rows, leaf)
                edge = r2[rows] - side.square[rows]
                sure = far < _down(edge - side.error[rows], far)[:, None]
                # what rounding could have put on the wrong side is measured again
                doubt = np.flatnonzero(sure ^ (far <= _up(edge + side.error[rows], far)[:, None]))
                if not side.single or len(doubt) <= far.size // LOOSE:
                    break
                side = self._side(x, False)
            own = weight[members]
            if (own == 1).all():
                total[rows] += [np.count_nonzero(row) for row in sure]
            else:
                total[rows] += (sure * own[None, :]).sum(axis=1)
            r, c = np.divmod(doubt, len(members))
            nearer = self._measured(x, rows[r], members[c]) < r2[rows[r]]
            np.add.at(total, rows[r[nearer]], own[c[nearer]])
        return total


def _up(value: np.ndarray, like: np.ndarray) -> np.ndarray:
    """``value`` in the type of ``like``, rounded up."""
    return np.nextafter(value.astype(like.dtype), np.array(np.inf, dtype=like.dtype))


def _down(value: np.ndarray, like: np.ndarray) -> np.ndarray:
    return np.nextafter(value.astype(like.dtype), np.array(-np.inf, dtype=like.dtype))


def _lower(limit: np.ndarray, last: np.ndarray, found: tuple[np.ndarray, ...], k: int) -> None:
    """Lower each limit to the farthest found, and ``last`` to its point, where ``k`` are found."""
    rows, count = np.unique(found[0], return_counts=True)
    full = count == k
    at = np.cumsum(count)[full] - 1
    limit[rows[full]], last[rows[full]] = found[2][at], found[1][at]


def _run_ends(value: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where to cut each stretch ``edge[i]:edge[i + 1]`` of sorted values: the end of a run of equal values that is
    next to the middle and leaves a quarter on either side, else the middle."""
    begin, end = edge[:-1], edge[1:]
    middle = (begin + end) // 2
    new = np.append(True, value[1:] != value[:-1])
    new[begin] = True
    start = np.flatnonzero(new)
    run = np.searchsorted(start, middle, side="right") - 1
    below, above = start[run], np.append(start, len(value))[run + 1]
    quarter = np.maximum((end - begin) // 4, 1)
    best = middle.copy()
    gap = np.full(len(middle), len(value))
    for at in (below, above):
        good = (at - begin >= quarter) & (end - at >= quarter) & (np.abs(at - middle) < gap)
        best[good], gap[good] = at[good], np.abs(at - middle)[good]
    return best


def _first(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` nearest per query, ties to the lower point, in order."""
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    rows, columns, far = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((columns, far, rows))
    rows, columns, far = rows[order], columns[order], far[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], columns[keep], far[keep]
