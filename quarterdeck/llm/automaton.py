"""Byte automata: regular expressions to minimised transition arrays.

Patterns use literals, classes, groups, alternation and repeats (what Python's own pattern
parser gives for them), over single bytes. ``compile_rules`` combines any number of patterns by
subset construction into one automaton that follows all of them from every position at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

MOST_STATES = 50_000  # a rule set beyond this raises: it would not fit a task


@dataclass(frozen=True)
class Automaton:
    """``step[state + byte_class]`` is the next state (states are row offsets, start is ``start``).

    States from ``accepting`` on accept; ``rules[state]`` is the bit mask of the rules that do.
    """

    classes: bytes
    step: list[int]
    start: int
    accepting: int
    rules: dict[int, int]
    width: int

    def mask(self, data: bytes) -> int:
        """The rules that match anywhere in ``data``, in one pass."""
        state, step, accepting, found = self.start, self.step, self.accepting, 0
        for c in data.translate(self.classes):
            state = step[state + c]
            if state >= accepting:
                found |= self.rules[state]
        return found

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that begins at ``at``, or -1 (for an anchored automaton)."""
        state, end = self.start, at if self.start >= self.accepting else -1
        dead = self.rules.get(-1, -1)
        for i in range(at, len(data)):
            state = self.step[state + self.classes[data[i]]]
            if state == dead:
                break
            if state >= self.accepting:
                end = i + 1
        return end


class _Graph:
    """A nondeterministic automaton: empty moves and moves on sets of bytes."""

    def __init__(self) -> None:
        self.empty: list[set[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def node(self) -> int:
        self.empty.append(set())
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, tree, begin: int) -> int:
        for op, value in tree:
            begin = getattr(self, "_" + str(op).lower())(value, begin)
        return begin

    def _bytes(self, chars: frozenset[int], begin: int) -> int:
        end = self.node()
        self.moves[begin].append((chars, end))
        return end

    def _literal(self, value: int, begin: int) -> int:
        return self._bytes(frozenset([value]), begin)

    def _not_literal(self, value: int, begin: int) -> int:
        return self._bytes(frozenset(range(256)) - {value}, begin)

    def _any(self, _, begin: int) -> int:
        return self._bytes(frozenset(range(256)) - {10}, begin)

    def _in(self, value, begin: int) -> int:
        chars: set[int] = set()
        for op, x in value:
            if str(op) == "LITERAL":
                chars.add(x)
            elif str(op) == "RANGE":
                chars.update(range(x[0], x[1] + 1))
        if str(value[0][0]) == "NEGATE":
            chars = set(range(256)) - chars
        return self._bytes(frozenset(chars), begin)

    def _subpattern(self, value, begin: int) -> int:
        return self.add(value[3], begin)

    def _branch(self, value, begin: int) -> int:
        end = self.node()
        for tree in value[1]:
            first = self.node()
            self.empty[begin].add(first)
            self.empty[self.add(tree, first)].add(end)
        return end

    def _max_repeat(self, value, begin: int) -> int:
        least, most, tree = value
        for _ in range(least):
            begin = self.add(tree, begin)
        if most == re._constants.MAXREPEAT:
            loop, end = self.node(), self.node()
            self.empty[begin].add(loop)
            self.empty[self.add(tree, loop)].add(loop)
            self.empty[loop].add(end)
            return end
        end = self.node()
        self.empty[begin].add(end)
        for _ in range(most - least):
            begin = self.add(tree, begin)
            self.empty[begin].add(end)
        return end

    def closure(self, nodes) -> frozenset[int]:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(n for n in seen if self.moves[n] or n in self.ends)

    ends: dict[int, int] = {}


def either_case(word: str) -> str:
    """A pattern for ``word`` with letters in either case; other characters are kept as pattern."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def compile_rules(patterns: list[str], anchored: bool = False) -> Automaton:
    """One minimised automaton for all ``patterns``; rule ``i`` is bit ``i``.

    Unanchored, it stands in a state that accepts whenever some match of a rule ends there.
    """
    graph = _Graph()
    graph.ends = {}
    heads = []
    for i, pattern in enumerate(patterns):
        head = graph.node()
        heads.append(head)
        graph.ends[graph.add(re._parser.parse(pattern), head)] = 1 << i

    # Bytes that no move tells apart share a class.
    sets = sorted({chars for moves in graph.moves for chars, _ in moves}, key=sorted)
    sign = {b: tuple(b in s for s in sets) for b in range(256)}
    names = {key: i for i, key in enumerate(dict.fromkeys(sign.values()))}
    classes = bytes(names[sign[b]] for b in range(256))
    sample = [classes.index(i) for i in range(len(names))]

    start = graph.closure(heads)
    number, order, table = {start: 0}, [start], []
    for state in order:
        row = []
        for byte in sample:
            reached = {n for s in state for chars, n in graph.moves[s] if byte in chars}
            after = graph.closure(reached if anchored else reached | set(heads))
            if after not in number:
                if len(order) >= MOST_STATES:
                    raise ValueError("the rules need too many states")
                number[after] = len(order)
                order.append(after)
            row.append(number[after])
        table.append(row)

    masks = np.array([sum({graph.ends[n] for n in state if n in graph.ends}) for state in order])
    moves = np.array(table)
    # Minimisation: states stay together while their masks and their successors' groups agree.
    group = np.unique(masks, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[moves]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    first = np.unique(finer, return_index=True)[1]
    rank = np.argsort(np.argsort(masks[first] > 0, kind="stable"))  # accepting states last
    width = len(names)
    step = np.empty((len(first), width), np.int64)
    step[rank] = rank[finer[moves[first]]] * width
    rules = {int(r) * width: int(m) for r, m in zip(rank, masks[first], strict=True) if m}
    if anchored and frozenset() in number:
        rules[-1] = int(rank[finer[number[frozenset()]]]) * width
    accepting = min((k for k in rules if k >= 0), default=len(first) * width)
    return Automaton(classes, step.ravel().tolist(), int(rank[finer[0]]) * width, accepting, rules, width)
