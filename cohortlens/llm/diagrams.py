"""Count-weighted decision diagrams of failure masks, reordered by adjacent level swaps.

A diagram has one level per filter. A node's two edges lead to the documents that pass (low) and fail
(high) the filter of its level; a leaf carries a vector of counts, and the weight of a node is the sum
over the leaves of its paths. Equal sub-diagrams are one node. No level is skipped, so weights add up.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

Weight = tuple[int, ...]


class Diagram:
    """The diagram of ``{mask: weight}`` over ``n`` filters; bit i of a mask is set if filter i fails."""

    def __init__(self, masks: Mapping[int, Weight], n: int):
        width = len(next(iter(masks.values()), ()))
        self.order = list(range(n))
        leaves = [tuple(masks.get(self._mask(path, n), (0,) * width)) for path in range(1 << n)]
        self.leaves, row = self._shared(leaves)
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for level in reversed(range(n)):
            self.levels[level], row = self._shared([(row[2 * i], row[2 * i + 1]) for i in range(1 << level)])
        self.weights: list[list[Weight]] = [[] for _ in range(n)]
        for level in reversed(range(n)):
            self._weigh(level)

    @staticmethod
    def _mask(path: int, n: int) -> int:
        """The mask of a path from the root, whose first step is the highest bit of ``path``."""
        return sum(1 << i for i in range(n) if path >> (n - 1 - i) & 1)

    @staticmethod
    def _shared(nodes: list) -> tuple[list, list[int]]:
        """Distinct nodes, and the place of each given one among them."""
        places: dict = {}
        at = [places.setdefault(node, len(places)) for node in nodes]
        return list(places), at

    def _below(self, level: int) -> list[Weight]:
        return self.weights[level + 1] if level + 1 < len(self.levels) else self.leaves

    def _weigh(self, level: int) -> None:
        below = self._below(level)
        self.weights[level] = [tuple(map(sum, zip(below[low], below[high]))) for low, high in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one.

        Only nodes of these two levels are made anew. An upper node keeps its place and its weight, since
        it stands for the same documents, so the levels above it stay as they are.
        """
        upper, lower = self.levels[level], self.levels[level + 1]
        halves = [half for low, high in upper for half in zip(lower[low], lower[high])]  # per new low and high child
        self.levels[level + 1], at = self._shared(halves)
        self.levels[level] = [(at[2 * i], at[2 * i + 1]) for i in range(len(upper))]
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        self._weigh(level + 1)

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Along the all-pass path: (filter, weight removed there, weight kept after it)."""
        node = 0
        for level, variable in enumerate(self.order):
            low, high = self.levels[level][node]
            below = self._below(level)
            yield variable, below[high], below[low]
            node = low

    def all_orders(self) -> Iterator[list[tuple[int, Weight, Weight]]]:
        """The steps of every order once; one adjacent swap lies between an order and the next."""
        yield list(self.steps())
        for level in adjacent_swaps(len(self.order)):
            self.swap(level)
            yield list(self.steps())


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places ``i`` whose swaps of ``i`` and ``i + 1`` lead through all orders of ``n`` things, each once.

    The last thing sweeps through the others from end to end; between two sweeps the others make
    their own next swap, one place further while the last thing stands in front of them.
    """
    if n < 2:
        return
    down, inner = True, adjacent_swaps(n - 1)
    while True:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down
