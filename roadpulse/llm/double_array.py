"""Double-array tries over whole numbers, in numpy.

A state's child by the digit d lies at ``base[state] + d`` if ``check`` there names the state.
State 1 is the root, 0 is none. Keys have one length; the last state of a key accepts it. A
number is as many digits of DIGIT_BITS bits as the largest one needs, the highest first: the
children of a state then lie close together, and the array is hardly longer than it has states.
"""

from __future__ import annotations

import numpy as np

ROOT = 1
TRIES = 32
DIGIT_BITS = 6
_MASK = (1 << DIGIT_BITS) - 1


class DoubleArray:
    """``number`` of an accepting state is the key's place among the sorted keys, else -1."""

    def __init__(self, base: np.ndarray, check: np.ndarray, number: np.ndarray, digits: int):
        self.base, self.check, self.number, self.digits = base, check, number, digits

    @classmethod
    def build(cls, keys: np.ndarray) -> DoubleArray:
        """Of distinct rows of positive numbers, sorted as rows."""
        digits = max(1, -(-int(keys.max(initial=0)).bit_length() // DIGIT_BITS))
        places = _Places()
        state = np.full(len(keys), ROOT, np.int64)
        for depth in range(keys.shape[1]):
            for digit in _digits(keys[:, depth], digits):
                first = np.ones(len(keys), bool)
                first[1:] = (state[1:] != state[:-1]) | (digit[1:] != digit[:-1])
                edge = np.flatnonzero(first)
                state = places.children(state[edge], digit[edge])[np.cumsum(first) - 1]
        base, check = places.arrays()
        number = np.full(len(check), -1, np.int32)
        number[state] = np.arange(len(keys))
        return cls(base, check, number, digits)

    def step(self, state: np.ndarray, digit: np.ndarray) -> np.ndarray:
        """The states after one more digit each, 0 where there is no such child."""
        at = self.base[state].astype(np.int64) + digit
        at[(at < 0) | (at >= len(self.check))] = 0  # place 0 is nobody's child
        return np.where(self.check[at] == state, at, 0)

    def walk(self, codes: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, numbers) of those starts at which a key of ``length`` codes begins.

        All starts are moved on together, one code at a time.
        """
        starts = starts[starts <= len(codes) - length]
        state = np.full(len(starts), ROOT, np.int64)
        for depth in range(length):
            code = codes[starts + depth]
            known = (code > 0) & (code >> (DIGIT_BITS * self.digits) == 0)
            starts, state = starts[known], state[known]
            for digit in range(self.digits - 1, -1, -1):
                state = self.step(state, (codes[starts + depth] >> (DIGIT_BITS * digit)) & _MASK)
                alive = state > 0
                starts, state = starts[alive], state[alive]
        return starts, self.number[state]


def _digits(codes: np.ndarray, digits: int) -> list[np.ndarray]:
    return [(codes >> (DIGIT_BITS * i)) & _MASK for i in range(digits - 1, -1, -1)]


class _Places:
    """Finds free places for the children of states; grows as needed."""

    def __init__(self):
        self.base = np.zeros(2, np.int64)
        self.check = np.full(2, -1, np.int32)  # 0 would be free
        self.end = 2  # all places from here on are free

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.zeros(more, np.int32)])

    def children(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states of the edges (parent, code), which are sorted."""
        out = np.zeros(len(codes), np.int64)
        begins = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes = np.diff(np.append(begins, len(parents)))
        for n, group in enumerate(np.argsort(-sizes, kind="stable").tolist()):
            size = sizes[group]
            if size == 1:
                break
            low = begins[group]
            own = codes[low : low + size]
            if n % 256 == 0:
                tried = self._tried()
            base = self._base(own, tried)
            out[low : low + size] = self._take(parents[low], base, own)
        single = begins[sizes == 1]
        if len(single):
            self._grow(self.end + len(single) + 1)
            free = np.flatnonzero(self.check[: self.end + len(single)] == 0)[: len(single)]
            out[single] = free
            self.base[parents[single]] = free - codes[single]
            self.check[free] = parents[single]
            self.end = max(self.end, int(free[-1]) + 1)
        return out

    def _tried(self) -> np.ndarray:
        """Some free places, the smaller ones more closely."""
        free = np.flatnonzero(self.check[: self.end] == 0)
        if not len(free):
            return free
        return free[np.unique((len(free) - 1) * np.linspace(0, 1, TRIES) ** 2).astype(int)]

    def _base(self, codes: np.ndarray, tried: np.ndarray) -> int:
        """The first of the places tried where all codes fit."""
        if len(tried):
            bases = tried - codes[0]
            at = bases[:, None] + codes[None, : min(len(codes), 64)]
            fits = (self.check[np.minimum(at, len(self.check) - 1)] == 0) | (at >= self.end)
            for base in bases[fits.all(axis=1)].tolist():
                rest = base + codes
                if ((rest >= self.end) | (self.check[np.minimum(rest, len(self.check) - 1)] == 0)).all():
                    return base
        return self.end - int(codes[0])

    def _take(self, parent: int, base: int, codes: np.ndarray) -> np.ndarray:
        at = base + codes
        self._grow(int(at[-1]) + 1)
        self.base[parent], self.check[at] = base, parent
        self.end = max(self.end, int(at[-1]) + 1)
        return at

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.base[: self.end].astype(np.int32), self.check[: self.end].copy()
