"""Regular expressions over bytes to minimal deterministic automata.

Supports what secret rules need: literals, ``\\xNN`` and escaped characters,
``[...]`` classes, groups, ``|`` and the quantifiers ``? * + {n} {n,}``. Rules
are compiled together: Thompson NFAs joined at one start, subset construction
over byte classes, then partition refinement. A state's accept mask has bit r
set if the text read so far ends a match of rule r.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np


class _Parser:
    """Pattern text to a tree: ("set", bytes) | ("cat" | "alt", parts) | ("rep", part, least, open)."""

    def __init__(self, pattern: str, nocase: bool) -> None:
        self.s, self.i, self.nocase = pattern, 0, nocase

    def peek(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def alternatives(self) -> tuple:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self) -> tuple:
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, part: tuple) -> tuple:
        c = self.peek()
        if c == "?":
            self.take()
            return ("alt", [part, ("cat", [])])
        if c and c in "*+":
            self.take()
            return ("rep", part, int(c == "+"), True)
        if c == "{":
            spec = self.s[self.i + 1 : self.s.index("}", self.i)]
            self.i += len(spec) + 2
            return ("rep", part, int(spec.rstrip(",")), spec.endswith(","))
        return part

    def atom(self) -> tuple:
        c = self.take()
        if c == "(":
            inner = self.alternatives()
            self.take()
            return inner
        if c == "[":
            return self.members()
        return ("set", self.folded({self.code(c)}))

    def code(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2 : self.i], 16)
        return ord(c)

    def members(self) -> tuple:
        found: set[int] = set()
        while self.peek() != "]":
            low = self.code(self.take())
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.take()
                found.update(range(low, self.code(self.take()) + 1))
            else:
                found.add(low)
        self.take()
        return ("set", self.folded(found))

    def folded(self, codes: set[int]) -> frozenset[int]:
        if self.nocase:
            letters = {c for c in codes if chr(c) in string.ascii_letters}
            codes = codes | {c ^ 32 for c in letters}
        return frozenset(codes)


def parse(pattern: str, nocase: bool = False) -> tuple:
    return _Parser(pattern, nocase).alternatives()


def reverse(tree: tuple) -> tuple:
    """The tree of the same words read backwards."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", reverse(tree[1]), *tree[2:])
    parts = [reverse(p) for p in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.step.append(None)
        return len(self.free) - 1

    def add(self, tree: tuple, start: int) -> int:
        """Wire ``tree`` after ``start``; the state reached at its end."""
        kind = tree[0]
        if kind == "set":
            here, end = self.state(), self.state()
            self.free[start].append(here)
            self.step[here] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, open_ended = tree
        for _ in range(least):
            start = self.add(part, start)
        if open_ended:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        return start

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``classes``: byte to column (256 bytes); ``table``: state x column to
    state; ``accept``: rule mask of each state; ``dead``: state that never
    accepts again, or -1. State 0 is the start."""

    classes: bytes
    table: np.ndarray
    accept: np.ndarray
    dead: int


def compile_rules(trees: list[tuple], anchored: bool = False) -> Automaton:
    """One minimal automaton for all rules; unless ``anchored``, a match may start at any byte."""
    nfa = _Nfa()
    start = nfa.state()
    ends = {nfa.add(t, start): 1 << r for r, t in enumerate(trees)}
    sets = sorted({s[0] for s in nfa.step if s}, key=sorted)
    column: dict[tuple, int] = {}
    classes = bytearray(256)
    for b in range(256):
        classes[b] = column.setdefault(tuple(b in s for s in sets), len(column))
    sample = {k: classes.index(k) for k in range(len(column))}

    first = nfa.closure({start})
    order, table, at = {first: 0}, [], 0
    queue = [first]
    while at < len(queue):
        now = queue[at]
        at += 1
        steps = [nfa.step[s] for s in now if nfa.step[s]]
        row = []
        for k in range(len(column)):
            after = nfa.closure({t for s, t in steps if sample[k] in s} | (set() if anchored else {start}))
            if after not in order:
                order[after] = len(order)
                queue.append(after)
            row.append(order[after])
        table.append(row)
    accept = np.array([sum(m for e, m in ends.items() if e in q) for q in queue], np.int64)
    return _minimal(bytes(classes), np.array(table, np.int64), accept)


def _minimal(classes: bytes, table: np.ndarray, accept: np.ndarray) -> Automaton:
    """Refine the partition by accept mask until no class splits."""
    part = np.unique(accept, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    # number classes from the start state on
    _, first = np.unique(part, return_index=True)
    rank = np.empty(len(first), np.int64)
    rank[part[np.sort(first)]] = np.arange(len(first))
    keep = np.sort(first)
    small = rank[part[table[keep]]].astype(np.int32)
    masks = accept[keep]
    dead = [i for i in range(len(keep)) if not masks[i] and (small[i] == i).all()]
    return Automaton(classes, small, masks, dead[0] if dead else -1)
