"""Regular expressions over bytes as minimal deterministic automata in flat transition arrays."""

from __future__ import annotations

from collections import defaultdict
from re import _constants as ops
from re import _parser

import numpy as np


class _Nfa:
    """Thompson automaton; ``steps[state]`` holds (byte set, target), ``free[state]`` targets without input."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, tree, start: int) -> int:
        """Append a parsed expression behind ``start``; returns its end."""
        for op, value in tree:
            end = self.state()
            if op is ops.LITERAL:
                self.steps[start].append((frozenset([value]), end))
            elif op is ops.IN:
                self.steps[start].append((_members(value), end))
            elif op is ops.SUBPATTERN:
                self.free[self.add(value[-1], start)].append(end)
            elif op is ops.BRANCH:
                for branch in value[1]:
                    first = self.state()
                    self.free[start].append(first)
                    self.free[self.add(branch, first)].append(end)
            elif op is ops.MAX_REPEAT:
                least, most, body = value
                at = start
                for _ in range(least):
                    at = self.add(body, at)
                if most is ops.MAXREPEAT:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add(body, loop)].append(loop)
                    at = loop
                else:
                    for _ in range(most - least):
                        self.free[at].append(end)
                        at = self.add(body, at)
                self.free[at].append(end)
            else:
                raise ValueError(f"not supported in a rule: {op}")
            start = end
        return start

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for target in self.free[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


def _members(items) -> frozenset[int]:
    out: set[int] = set()
    for op, value in items:
        if op is ops.LITERAL:
            out.add(value)
        elif op is ops.RANGE:
            out.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a rule's class: {op}")
    return frozenset(out)


class Automaton:
    """All ``rules`` in one automaton: subset construction, then minimisation by partition refinement.

    ``table[state * 256 + byte]`` is the next state times 256, so states are kept multiplied. ``accepts[state]`` is a bit set of the rules
    that end there; accepting states come last, from ``first_accepting`` on. With ``anywhere``, matches may begin at any byte. State 0 starts.
    The dead state, if there is one, is ``dead``.
    """

    def __init__(self, rules: list[str], anywhere: bool):
        nfa = _Nfa()
        start = nfa.state()
        ends = {}
        for k, rule in enumerate(rules):
            first = nfa.state()
            nfa.free[start].append(first)
            ends[nfa.add(_parser.parse(rule), first)] = 1 << k
        every = nfa.closure([start])
        classes, members = self._classes(nfa)
        index, rows, accept, todo = {every: 0}, [], [], [every]
        for subset in todo:
            accept.append(sum({ends[s] for s in subset if s in ends}))
            moves = [(chars, target) for s in subset for chars, target in nfa.steps[s]]
            row = []
            for member in members:
                reached = {target for chars, target in moves if member in chars}
                following = nfa.closure(reached) | every if anywhere else nfa.closure(reached)
                if following not in index:
                    index[following] = len(todo)
                    todo.append(following)
                row.append(index[following])
            rows.append(row)
        self._minimise(np.array(rows), np.array(accept), classes)

    @staticmethod
    def _classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
        """Bytes that no rule tells apart share a class; one member of each."""
        sets = {chars for steps in nfa.steps for chars, _ in steps}
        kinds: dict[tuple, int] = {}
        classes, members = np.zeros(256, np.int64), []
        for byte in range(256):
            kind = tuple(byte in chars for chars in sets)
            if kind not in kinds:
                kinds[kind] = len(members)
                members.append(byte)
            classes[byte] = kinds[kind]
        return classes, members

    def _minimise(self, moves: np.ndarray, accept: np.ndarray, classes: np.ndarray) -> None:
        block = np.unique(accept, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack((block, block[moves])), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        # The start first, then refusing states, then accepting ones.
        by_block = defaultdict(int)
        for state, b in enumerate(block.tolist()):
            by_block.setdefault(b, state)
        order = sorted(by_block, key=lambda b: (accept[by_block[b]] > 0, b != block[0]))
        place = {b: i for i, b in enumerate(order)}
        heads = [by_block[b] for b in order]
        table = np.vectorize(place.get)(block[moves[heads]])[:, classes]
        self.states = len(order)
        self.first_accepting = 256 * int((accept[heads] == 0).sum())
        self.table = (table * 256).ravel().tolist()
        self.accepts = {256 * i: int(accept[h]) for i, h in enumerate(heads)}
        stuck = [i for i in range(self.states) if (table[i] == i).all() and not self.accepts[256 * i]]
        self.dead = 256 * stuck[0] if stuck else -1

    def rules_in(self, data: bytes) -> int:
        """Bit set of the rules that match somewhere: one pass, one lookup a byte."""
        table, first, state, found = self.table, self.first_accepting, 0, 0
        for byte in data:
            state = table[state + byte]
            if state >= first:
                found |= self.accepts[state]
        return found

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at ``start``; -1 without one."""
        table, first, dead, state, end = self.table, self.first_accepting, self.dead, 0, -1
        for at in range(start, len(data)):
            state = table[state + data[at]]
            if state >= first:
                end = at + 1
            elif state == dead:
                break
        return end

    def matches(self, data: bytes):
        """Leftmost longest matches that don't overlap, as ``(start, end)``."""
        begins = [self.table[b] != self.dead for b in range(256)]
        at, size = 0, len(data)
        while at < size:
            if begins[data[at]]:
                end = self.longest(data, at)
                if end > at:
                    yield at, end
                    at = end
                    continue
            at += 1
