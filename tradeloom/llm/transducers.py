"""Weighted finite-state transducers: composition, and the best path through a clause."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Mapping

Symbol = Hashable
Arcs = dict[tuple[Hashable, Symbol], list[tuple[Symbol, float, Hashable]]]


class Transducer:
    """Reads a symbol, writes a symbol and adds a weight with every arc; a path's weight is the sum of its arcs.

    ``arcs`` maps (state, read) to (written, weight, next state); of several arcs for one symbol any may be taken.
    A sequence without a path to one of ``finals`` is not accepted.
    """

    def __init__(self, start: Hashable, arcs: Arcs, finals: Iterable[Hashable]):
        self.start, self.arcs, self.finals = start, arcs, frozenset(finals)

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes. Only states that can be reached are built."""
        reads: dict[Hashable, list] = {}
        for (state, symbol), ways in self.arcs.items():
            reads.setdefault(state, []).append((symbol, ways))
        start = (self.start, other.start)
        arcs: Arcs = {}
        seen, open_states = {start}, [start]
        while open_states:
            mine, theirs = state = open_states.pop()
            for symbol, ways in reads.get(mine, ()):
                joint = [
                    (written, weight + more, (to, onward))
                    for middle, weight, to in ways
                    for written, more, onward in other.arcs.get((theirs, middle), ())
                ]
                if joint:
                    arcs[state, symbol] = joint
                for _, _, to in joint:
                    if to not in seen:
                        seen.add(to)
                        open_states.append(to)
        return Transducer(start, arcs, [s for s in seen if s[0] in self.finals and s[1] in other.finals])

    def numbered(self) -> Transducer:
        """The same with consecutive numbers as states."""
        names: dict[Hashable, int] = {}
        number = lambda state: names.setdefault(state, len(names))
        start = number(self.start)
        arcs = {
            (number(state), symbol): [(written, weight, number(to)) for written, weight, to in ways]
            for (state, symbol), ways in self.arcs.items()
        }
        return Transducer(start, arcs, [names[s] for s in self.finals if s in names])

    def best_path(self, clause: list[tuple[object, Mapping[Symbol, float]]], wanted: frozenset) -> tuple[float, list] | None:
        """(weight, [(written, item)]) of the heaviest accepted path, with the written symbols among ``wanted``.

        A clause is a list of (item, {symbol it may be read as: weight}). Ties go to the path found first. Time and
        memory are linear in the clause: states keep one path each, and paths share their beginnings.
        """
        ahead: dict[Hashable, tuple[float, tuple | None]] = {self.start: (0.0, None)}
        for item, readings in clause:
            here, ahead = ahead, {}
            for state, (weight, path) in here.items():
                for symbol, own in readings.items():
                    for written, more, to in self.arcs.get((state, symbol), ()):
                        total = weight + own + more
                        if to not in ahead or total > ahead[to][0]:
                            ahead[to] = (total, ((written, item), path) if written in wanted else path)
        ends = [ahead[s] for s in ahead if s in self.finals]
        if not ends:
            return None
        weight, path = max(ends, key=lambda end: end[0])
        found = []
        while path is not None:
            last, path = path
            found.append(last)
        return weight, found[::-1]
