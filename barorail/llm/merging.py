"""Byte-pair merges of many short runs of symbols at once, on numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: More than any symbol's number.
SYMBOLS = 2**31
NEVER = 2**31
#: Slots of a table of pairs for each of them, at least.
ROOM = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """Which pairs of symbols join, in which order, and to what: a sorted table of pairs."""

    def __init__(self, pairs: list[tuple[int, int, int, int]]):
        """``pairs``: left, right, rank (the lower joins first) and the symbol made."""
        told = sorted((left * SYMBOLS + right, rank, made) for left, right, rank, made in pairs)
        keys, ranks, made = np.array(told or [(-1, NEVER, 0)], np.int64).T
        self.keys, self.ranks, self.made = keys.copy(), ranks.copy(), made.copy()
        self.slots = None

    def joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NEVER if it does not join, and the symbol it makes."""
        wanted = left * SYMBOLS + right
        at = np.searchsorted(self.keys, wanted).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER), self.made[at]

    def _deal(self) -> None:
        """Pairs in a table by hash, each in the first free slot from its own on, and symbols made by rank."""
        bits = int(ROOM * len(self.keys)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slots, self.slot_ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int64)
        slot, rest = self._slot(self.keys), np.arange(len(self.keys))
        while len(rest):
            free = rest[self.slots[slot[rest]] < 0]
            own, first = np.unique(slot[free], return_index=True)
            self.slots[own], self.slot_ranks[own] = self.keys[free[first]], self.ranks[free[first]]
            rest = rest[self.slots[slot[rest]] != self.keys[rest]]
            slot[rest] = (slot[rest] + 1) % len(self.slots)
        self.made_by_rank = np.zeros(int(self.ranks.max()) + 1, np.int64)
        self.made_by_rank[self.ranks] = self.made

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD) >> self.shift).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NEVER if it does not join."""
        wanted = (left * SYMBOLS + right).ravel()
        slot = self._slot(wanted)
        found = self.slots[slot]
        out = np.where(found == wanted, self.slot_ranks[slot], NEVER)
        rest = np.flatnonzero((found != wanted) & (found >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) % len(self.slots)
            found = self.slots[slot[rest]]
            same = found == wanted[rest]
            out[rest[same]] = self.slot_ranks[slot[rest[same]]]
            rest = rest[~same & (found >= 0)]
        return out.reshape(left.shape)

    def apply_by_width(self, symbol: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers, symbols) of runs that have nothing left to join, as matrices of a row per run.

        ``symbol`` holds the runs one after the other, ``sizes`` symbols each. Runs of one width are rows of
        a matrix; in each a pair joins, as in ``apply``, and those that go on meet the next narrower ones. A
        rank belongs to one pair only.
        """
        if self.slots is None:
            self._deal()
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        ends = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0)) + 1), side="right")
        number, table, rank = np.zeros(0, np.int64), None, None
        for width in range(len(ends) - 1, 0, -1):
            own = order[ends[width + 1] if width + 1 < len(ends) else 0 : ends[width]]
            added = symbol[starts[own][:, None] + np.arange(width)]
            ranks = self.ranks_of(added[:, :-1], added[:, 1:])
            number = np.concatenate([number, own])
            table = added if table is None else np.concatenate([table, added])
            rank = ranks if rank is None else np.concatenate([rank, ranks])
            if width == 1:
                yield number, table
                return
            row, at = np.arange(len(number)), rank.argmin(axis=1)
            least = rank[row, at]
            live = least < NEVER
            yield number[~live], table[~live]
            number, table, rank, at, least = (x[live] for x in (number, table, rank, at, least))
            row = row[: len(number)]
            table[row, at] = self.made_by_rank[least]
            stays = np.ones(table.shape, bool)
            stays[row, at + 1] = False
            table = table[stays].reshape(len(number), width - 1)
            stays = np.ones(rank.shape, bool)
            stays[row, at] = False
            rank = rank[stays].reshape(len(number), width - 2)
            for before in (1, 0):  # the pairs that end and begin with what was made
                r = np.flatnonzero((at >= before) & (at - before < width - 2))
                a = at[r] - before
                rank[r, a] = self.ranks_of(table[r, a], table[r, a + 1])

    def apply(self, run: np.ndarray, symbol: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(run, symbol, size) of the runs that have nothing left to join, whole runs at a time.

        ``run`` numbers the run of each symbol, ascending; sizes add up. In each round the pair of lowest
        rank joins in every run, the leftmost of equal ones.
        """
        rank, made = np.full(len(run), NEVER, np.int64), np.zeros(len(run), np.int64)

        def judge(at: np.ndarray) -> None:
            """Look up the pairs that begin there."""
            rank[at] = NEVER
            at = at[at < len(run) - 1]
            at = at[run[at] == run[at + 1]]
            rank[at], made[at] = self.joined(symbol[at], symbol[at + 1])

        judge(np.arange(len(run)))
        while len(run):
            first = starts_of(run)
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(run))))
            live = least < NEVER
            if not live.all():
                yield run[~live], symbol[~live], size[~live]
                run, symbol, size, rank, made, least = (x[live] for x in (run, symbol, size, rank, made, least))
            at = np.flatnonzero(rank == least)
            at = at[starts_of(run[at])]  # the leftmost of each run
            symbol[at] = made[at]
            size[at] += size[at + 1]
            stays = np.ones(len(run), bool)
            stays[at + 1] = False
            run, symbol, size, rank, made = (x[stays] for x in (run, symbol, size, rank, made))
            at = at - np.arange(len(at))
            judge(np.concatenate([at, at[at > 0] - 1]))


def starts_of(run: np.ndarray) -> np.ndarray:
    """Where each run begins."""
    return np.flatnonzero(np.append(True, run[1:] != run[:-1])[: len(run)])


def cut_runs(run: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Each run and its ``values`` (one row per symbol), as little-endian unsigned 32-bit numbers."""
    data = values.astype("<u4").tobytes()
    width = len(data) // max(1, len(run))
    starts = starts_of(run)
    ends = [*starts[1:].tolist(), len(run)]
    for name, a, b in zip(run[starts].tolist(), starts.tolist(), ends):
        yield name, data[width * a : width * b]
