"""Minimal acyclic automata over integer n-grams that carry a count each (operator 13)."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import zstandard


def distinct(grams: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in order, their summed weights, and for each input row the place of its like."""
    if not len(grams):
        return grams, weights, np.zeros(0, np.int64)
    wide = grams.astype(np.int64)
    keys = [(wide[:, j] << 32) | (wide[:, j + 1] if j + 1 < grams.shape[1] else 0) for j in range(0, grams.shape[1], 2)]
    order = np.lexsort(keys[::-1])
    ranked = grams[order]
    fresh = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(1)])
    inverse = np.empty(len(grams), np.int64)
    inverse[order] = np.cumsum(fresh) - 1
    return ranked[fresh], np.add.reduceat(weights[order], np.flatnonzero(fresh)), inverse


class Transducer:
    """A weighted acyclic automaton: n-grams of up to ``width`` positive labels to counts.

    States whose futures are alike are one state. Each state knows how many n-grams end behind it, so an n-gram's
    rank in order is the sum of what the arcs of its path skip, and the n-grams with a prefix are one range of ranks:
    their counts are summed as the difference of two running sums.
    """

    def __init__(self, width: int, first: np.ndarray, label: np.ndarray, target: np.ndarray, final: np.ndarray, weight: np.ndarray):
        self.width, self.first, self.label, self.target, self.final, self.weight = width, first, label, target, final, weight
        owner = np.repeat(np.arange(len(final)), np.diff(first))
        behind = final.astype(np.int64)
        for _ in range(width):  # no path is longer
            behind = final + np.bincount(owner, behind[target], len(final)).astype(np.int64)
        skip = np.zeros(len(label), np.int64)
        if len(label):
            upto = np.cumsum(behind[target])
            skip = upto - behind[target]
            skip = skip - skip[np.minimum(first[owner], len(label) - 1)] + final[owner]
        self.behind, self.skip, self.owner = behind, skip, owner.astype(np.int64)
        self.upto = np.concatenate([[0], np.cumsum(weight)])

    @property
    def root(self) -> int:
        return len(self.final) - 1

    @classmethod
    def build(cls, grams: np.ndarray, weights: np.ndarray) -> Transducer:
        """From sorted distinct n-grams, one after the other; rows are padded with zeros.

        What the next n-gram does not share with the last one is finished: from its end on, each state meets the
        register of finished states and becomes the one that is alike, if there is one.
        """
        width = grams.shape[1]
        sizes = (grams > 0).sum(1)
        shared = np.zeros(len(grams), np.int64)
        if len(grams) > 1:
            shared[1:] = np.logical_and.accumulate((grams[1:] == grams[:-1]) & (grams[1:] > 0), axis=1).sum(1)
        register: dict[tuple[int, ...], int] = {}
        arcs: list[list[int]] = [[] for _ in range(width + 1)]
        ends, path, depth = [0] * (width + 1), [0] * (width + 1), 0

        def finish(upto: int) -> None:
            nonlocal depth
            while depth > upto:
                state = register.setdefault((ends[depth], *arcs[depth]), len(register))
                arcs[depth], ends[depth] = [], 0
                depth -= 1
                arcs[depth] += (path[depth], state)

        for row, same, size in zip(grams.tolist(), shared.tolist(), sizes.tolist(), strict=True):
            finish(same)
            path[same:size] = row[same:size]
            depth, ends[size] = size, 1
        finish(0)
        states = [*register, (ends[0], *arcs[0])]
        flat = np.array([x for s in states for x in s[1:]], np.int64).reshape(-1, 2)
        first = np.concatenate([[0], np.cumsum([len(s) // 2 for s in states])])
        final = np.array([s[0] for s in states], bool)
        return cls(width, first, flat[:, 0], flat[:, 1], final, np.asarray(weights, np.int64))

    def grams(self) -> np.ndarray:
        """All n-grams in order."""
        out = np.zeros((int(self.behind[self.root]), self.width), np.int32)
        state, rank = np.array([self.root]), np.zeros(1, np.int64)
        rows = np.zeros((1, self.width), np.int32)
        for depth in range(self.width + 1):
            ends = self.final[state]
            out[rank[ends]] = rows[ends]
            n = self.first[state + 1] - self.first[state]
            if depth == self.width or not n.sum():
                break
            arc = np.repeat(self.first[state] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rank, rows = np.repeat(rank, n) + self.skip[arc], np.repeat(rows, n, axis=0)
            rows[:, depth] = self.label[arc]
            state = self.target[arc]
        return out

    def compose(self, asked: np.ndarray) -> np.ndarray:
        """The summed counts of the n-grams that start with each row of ``asked`` (0 where none does).

        The rows, an acceptor of equal words side by side, and the automaton are walked together, a label a step.
        """
        state, rank = np.full(len(asked), self.root), np.zeros(len(asked), np.int64)
        alive = np.ones(len(asked), bool)
        keys = (self.owner << 32) | self.label
        for j in range(asked.shape[1]):
            want = asked[:, j].astype(np.int64)
            step = alive & (want > 0)
            if not len(keys):
                alive &= ~step
                continue
            key = (state << 32) | want
            arc = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found = step & (keys[arc] == key)
            state, rank = np.where(found, self.target[arc], state), np.where(found, rank + self.skip[arc], rank)
            alive &= found | (want == 0)
        return np.where(alive, self.upto[rank + self.behind[state]] - self.upto[rank], 0)

    def pack(self) -> bytes:
        head = np.array([self.width, len(self.final), len(self.label), len(self.weight)], "<i8").tobytes()
        planes = [self.label.astype("<i4"), self.target.astype("<i4"), np.diff(self.first).astype("<i4")]
        body = b"".join(p.view(np.uint8).reshape(-1, 4).T.tobytes() for p in planes)
        body += self.final.tobytes() + self.weight.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
        return head + zstandard.compress(body, 1)

    @classmethod
    def unpack(cls, data: bytes) -> Transducer:
        width, states, arcs, n = np.frombuffer(data[:32], "<i8").tolist()
        body, at = np.frombuffer(zstandard.decompress(data[32:]), np.uint8), 0

        def plane(rows: int, kind: str) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize
            part = np.ascontiguousarray(body[at : at + rows * size].reshape(size, rows).T).view(kind).ravel()
            at += rows * size
            return part.astype(np.int64)

        label, target, degree = plane(arcs, "<i4"), plane(arcs, "<i4"), plane(states, "<i4")
        final = body[at : at + states].astype(bool)
        at += states
        return cls(width, np.concatenate([[0], np.cumsum(degree)]), label, target, final, plane(n, "<i8"))


def union(parts: Iterable[Transducer], width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All n-grams of several automata in order with their counts summed, and where those of each part went."""
    parts = list(parts)
    grams = [p.grams() for p in parts]
    whole = np.concatenate([np.zeros((0, width), np.int32), *grams])
    weights = np.concatenate([np.zeros(0, np.int64), *[p.weight for p in parts]])
    rows, sums, inverse = distinct(whole, weights)
    return rows, sums, np.split(inverse, np.cumsum([len(g) for g in grams])[:-1]) if parts else []
