"""Smallest column sets that no known pair of rows agrees on.

Columns are bits.  An agreement is the set of columns in which two different
rows are equal; it rules out every key inside it.  A key must therefore hit
the complement of every agreement.
"""

from __future__ import annotations

#: Visited states that a search remembers as dead ends.
REMEMBERED = 500_000


def to_mask(positions) -> int:
    return sum(1 << p for p in positions)


def positions(mask: int) -> list:
    return [p for p in range(mask.bit_length()) if mask >> p & 1]


class Exhausted(Exception):
    """A search took more steps than it was given."""


def minimal(sets) -> list:
    """The sets (bit masks) that hold no other one, smallest first."""
    out = []
    for s in sorted(set(sets), key=lambda x: (x.bit_count(), x)):
        if not any(o & s == o for o in out):
            out.append(s)
    return out


class Cover:
    """Sets of columns, in list order, that hit all of the needed sets.

    ``hits[i]`` are the needed sets, as bits, that the i-th allowed column hits.
    """

    def __init__(self, allowed, needed, steps=None):
        self.steps = steps  # None: as many as it takes
        self.allowed, self.needed = list(allowed), minimal(needed)
        self.possible = 0 not in self.needed
        self.all = (1 << len(self.needed)) - 1
        self.hits = [to_mask(j for j, d in enumerate(self.needed) if d >> c & 1) for c in self.allowed]
        self.members = [[i for i, c in enumerate(self.allowed) if d >> c & 1] for d in self.needed]
        self.dead = set()

    def can(self, open_sets: int, start: int, left: int) -> bool:
        """Do ``left`` of the columns from ``start`` on hit all open sets?

        Branches on the columns of the smallest open set.  Gives up on a branch
        where disjoint open sets, or the best columns taken together, need more than ``left``.
        """
        if not open_sets:
            return True
        if self.steps is not None:
            if not self.steps:
                raise Exhausted
            self.steps -= 1
        if left <= 0 or (start, left, open_sets) in self.dead:
            return False
        gains = sorted(((h & open_sets).bit_count() for h in self.hits[start:]), reverse=True)
        ok = sum(gains[:left]) >= open_sets.bit_count()
        if ok:
            disjoint, rest = 0, open_sets  # the needed sets are ordered by size
            branch = None
            while rest and disjoint <= left:
                first = (rest & -rest).bit_length() - 1
                columns = [i for i in self.members[first] if i >= start]
                if branch is None or len(columns) < len(branch):
                    branch = columns
                disjoint += 1
                for i in columns:
                    rest &= ~self.hits[i]
                rest &= ~(1 << first)
            ok = disjoint <= left and any(
                self.can(open_sets & ~self.hits[i], start, left - 1)
                for i in sorted(branch, key=lambda i: -(self.hits[i] & open_sets).bit_count()))
        if not ok and len(self.dead) < REMEMBERED:
            self.dead.add((start, left, open_sets))
        return ok

    def sets(self, size: int):
        """Every hitting set of exactly ``size`` columns, in list order; no step leads to a dead end."""
        def extend(chosen, start, left, open_sets):
            if left == 0:
                yield chosen
                return
            for i in range(start, len(self.allowed) - left + 1):
                rest = open_sets & ~self.hits[i]
                if self.can(rest, i + 1, left - 1):
                    yield from extend(chosen | 1 << self.allowed[i], i + 1, left - 1, rest)

        if self.possible and self.can(self.all, 0, size):
            yield from extend(0, 0, size, self.all)


def open_candidates(allowed, agreements, size: int, limit: int, excluded=(), steps=None):
    """Up to ``limit`` sets of ``size`` positions, in list order, that lie in
    no agreement and contain no excluded set.  Raises ``Exhausted`` beyond ``steps`` steps."""
    allowed = list(allowed)
    full = to_mask(allowed)
    found = []
    for chosen in Cover(allowed, (full & ~a for a in agreements), steps).sets(size):
        if not any(chosen & e == e for e in excluded):
            found.append(chosen)
            if len(found) == limit:
                break
    return found
