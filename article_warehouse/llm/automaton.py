"""Deterministic automata over bytes from regular expressions."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as ops, _parser

import numpy as np


@dataclass(frozen=True)
class Automaton:
    """``moves[state * classes + class_of[byte]]`` is the next state; states from ``accepting`` on accept.

    ``resets`` are the bytes after which every state is the start state. In an anchored automaton, ``dead``
    is the state without a way to a match, else -1.
    """

    class_of: np.ndarray
    classes: int
    moves: np.ndarray
    start: int
    accepting: int
    resets: np.ndarray
    dead: int


class _Graph:
    """Thompson construction: states with edges on sets of bytes and free edges."""

    def __init__(self, fold: bool):
        self.fold, self.free, self.edges = fold, [], []

    def state(self) -> int:
        self.free.append([])
        self.edges.append(None)
        return len(self.free) - 1

    def bytes_edge(self, start: int, allowed: set[int]) -> int:
        if self.fold:
            allowed = allowed | {ord(c) for b in allowed if b < 128 for c in (chr(b).lower(), chr(b).upper())}
        end = self.state()
        self.edges[start] = (frozenset(allowed), end)
        return end

    def add(self, parsed, start: int) -> int:
        for op, value in parsed:
            start = self.add_one(op, value, start)
        return start

    def add_one(self, op, value, start: int) -> int:
        if op is ops.LITERAL:
            return self.bytes_edge(start, {value})
        if op is ops.IN:
            return self.bytes_edge(start, _members(value))
        if op is ops.SUBPATTERN:
            return self.add(value[-1], start)
        if op is ops.BRANCH:
            end = self.state()
            for way in value[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(way, first)].append(end)
            return end
        if op is ops.MAX_REPEAT:
            least, most, sub = value
            for _ in range(least):
                start = self.add(sub, start)
            if most == ops.MAXREPEAT:
                again = self.state()
                self.free[start].append(again)
                self.free[self.add(sub, again)].append(again)
                end = self.state()
                self.free[again].append(end)
                return end
            ends = [start]
            for _ in range(most - least):
                first = self.state()
                self.free[ends[-1]].append(first)
                ends.append(self.add(sub, first))
            end = self.state()
            for way in ends:
                self.free[way].append(end)
            return end
        raise ValueError(f"not supported in a rule: {op}")


def _members(items) -> set[int]:
    found: set[int] = set()
    for op, value in items:
        if op is ops.LITERAL:
            found.add(value)
        elif op is ops.RANGE:
            found.update(range(value[0], value[1] + 1))
        elif op is not ops.NEGATE:
            raise ValueError(f"not supported in a class: {op}")
    return set(range(256)) - found if items[0][0] is ops.NEGATE else found


def compiled(patterns: list[tuple[bytes, bool]], anchored: bool = False) -> Automaton:
    """One automaton for all ``patterns`` (expression, whether case is ignored).

    It accepts where a match of any of them ends, from anywhere or, ``anchored``, from the first byte.
    Built by subset construction over classes of bytes that no pattern tells apart, and minimised.
    """
    free, edges, firsts, finals = [], [], [], set()
    for pattern, fold in patterns:
        graph, offset = _Graph(fold), len(free)
        first = graph.state()
        finals.add(graph.add(_parser.parse(pattern), first) + offset)
        firsts.append(first + offset)
        free += [[t + offset for t in ways] for ways in graph.free]
        edges += [edge and (edge[0], edge[1] + offset) for edge in graph.edges]

    def reached(state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for way in free[todo.pop()]:
                if way not in seen:
                    seen.add(way)
                    todo.append(way)
        return frozenset(s for s in seen if edges[s] or s in finals)

    closure = [reached(s) for s in range(len(free))]

    sets = list({edge[0] for edge in edges if edge})
    signatures: dict[tuple[bool, ...], int] = {}
    class_of = np.array([signatures.setdefault(tuple(b in s for s in sets), len(signatures)) for b in range(256)], np.uint8)
    examples = [int(np.flatnonzero(class_of == c)[0]) for c in range(len(signatures))]
    targets = [[closure[edge[1]] if edge and byte in edge[0] else None for byte in examples] for edge in edges]
    beginning = frozenset().union(*(closure[s] for s in firsts))
    numbers, order, moves = {beginning: 0}, [beginning], []
    for states in order:
        row = []
        for code in range(len(examples)):
            ways = [targets[s][code] for s in states if targets[s][code]]
            target = frozenset().union(*ways) if anchored else beginning.union(*ways)
            if target not in numbers:
                numbers[target] = len(order)
                order.append(target)
            row.append(numbers[target])
        moves.append(row)
    accepts = np.array([bool(states & finals) for states in order])
    return _minimised(class_of, np.array(moves), accepts, anchored)


def _minimised(class_of: np.ndarray, moves: np.ndarray, accepts: np.ndarray, anchored: bool) -> Automaton:
    """Merges states that no input tells apart, by refining the partition until it is stable."""
    part, count = accepts.astype(np.int64), 0
    while part.max() + 1 > count:
        count = int(part.max() + 1)
        for code in range(moves.shape[1]):
            part = np.unique(part * len(part) + part[moves[:, code]], return_inverse=True)[1]
    count = int(part.max() + 1)
    some = np.zeros(count, np.int64)
    some[part] = np.arange(len(part))
    # Accepting states last.
    order = np.argsort(accepts[some], kind="stable")
    number = np.empty(count, np.int64)
    number[order] = np.arange(count)
    table = number[part[moves[some[order]]]]
    start = int(number[part[0]])
    resets = np.isin(class_of, np.flatnonzero((table == start).all(axis=0)))
    dead = [s for s in range(count) if (table[s] == s).all() and not accepts[some[order[s]]]] if anchored else []
    first_accepting = int(count - accepts[some].sum())
    return Automaton(class_of, table.shape[1], table.astype(np.int32).ravel(), start, first_accepting, resets, dead[0] if dead else -1)
