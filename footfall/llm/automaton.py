"""Rule regexes compiled to one minimal deterministic automaton over bytes.

The patterns are ASCII and use literals, classes, groups, alternatives and
repeats. Subset construction with the start states added at every step gives
the automaton that has seen, after each byte, every rule that ends there;
Moore's partition refinement minimises it. Its transition array is walked
once over the bytes, all rules at a time. A rule's match starts where the
automaton of its reversed pattern, walked back from the end, accepts last.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _parser as sre

import numpy as np

ALL = frozenset(range(256))
CUT_BYTES = 256  # texts are walked in pieces of about this size, side by side


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []  # state -> states reached without a byte
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.step.append(None)
        return len(self.free) - 1

    def add(self, items: list, start: int, back: bool, flags: int) -> int:
        """Append the parsed items after ``start``; the state they end in."""
        for op, arg in reversed(items) if back else items:
            start = self._one(str(op), arg, start, back, flags)
        return start

    def _bytes(self, op: str, arg, flags: int) -> frozenset[int]:
        if op == "LITERAL":
            out = {arg}
        elif op == "RANGE":
            out = set(range(arg[0], arg[1] + 1))
        elif op == "IN":
            out = set().union(*(self._bytes(str(o), a, 0) for o, a in arg if str(o) != "NEGATE"))
            if str(arg[0][0]) == "NEGATE":
                out = set(ALL) - out
        else:
            raise ValueError(f"{op} is not supported in a rule")
        if flags & re.IGNORECASE:
            out |= {ord(f(chr(b))) for b in out if b < 128 for f in (str.lower, str.upper)}
        return frozenset(out)

    def _one(self, op: str, arg, start: int, back: bool, flags: int) -> int:
        if op == "SUBPATTERN":
            return self.add(list(arg[3]), start, back, (flags | arg[1]) & ~arg[2])
        if op == "BRANCH":
            end = self.state()
            for branch in arg[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(list(branch), first, back, flags)].append(end)
            return end
        if op == "MAX_REPEAT":
            low, high, items = arg
            for _ in range(low):
                start = self.add(list(items), start, back, flags)
            if high == sre.MAXREPEAT:
                loop = self.state()
                self.free[start].append(loop)
                self.free[self.add(list(items), loop, back, flags)].append(loop)
                out = self.state()
                self.free[loop].append(out)
                return out
            end = self.state()
            self.free[start].append(end)
            for _ in range(high - low):
                start = self.add(list(items), start, back, flags)
                self.free[start].append(end)
            return end
        end = self.state()
        self.step[start] = (self._bytes(op, arg, flags), end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Automaton:
    """``table[state, classes[byte]]`` is the next state, ``accept[state]`` the
    rules that end there, as bits. State 0 is the start."""

    classes: np.ndarray
    table: np.ndarray
    accept: np.ndarray


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no step tells apart, by number, and one byte of each."""
    sets = sorted({s[0] for s in nfa.step if s}, key=sorted)
    told = {b: tuple(b in s for s in sets) for b in range(256)}
    numbers: dict[tuple, int] = {}
    classes = np.array([numbers.setdefault(told[b], len(numbers)) for b in range(256)], np.uint8)
    return classes, [int(np.flatnonzero(classes == c)[0]) for c in range(len(numbers))]


def _minimal(table: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states with equal futures: refine by accepted rules, then by successors."""
    part = np.unique(accept, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    order = np.unique(part, return_index=True)[1]
    order = np.r_[0, order[part[order] != part[0]]]  # the start stays first
    number = np.empty(part.max() + 1, np.int64)
    number[part[order]] = np.arange(len(order))
    return number[part[table[order]]], accept[order]


def compile_rules(patterns: list[str], anchored: bool = False, back: bool = False) -> Automaton:
    """One minimal automaton for all patterns (of their reversals with ``back``)."""
    nfa = _Nfa()
    begin = nfa.state()
    final: dict[int, int] = {}
    for bit, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.free[begin].append(first)
        end = nfa.add(list(sre.parse(pattern)), first, back, 0)
        final[end] = 1 << bit
    classes, sample = _byte_classes(nfa)
    start = nfa.closure({begin})
    again = frozenset() if anchored else start
    number, rows, todo = {start: 0}, [], [start]
    for states in todo:
        row = []
        moves = [nfa.step[s] for s in states if nfa.step[s]]
        for byte in sample:
            to = nfa.closure({e for on, e in moves if byte in on}) | again
            if to not in number:
                number[to] = len(todo)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    accept = np.array([sum(final.get(s, 0) for s in states) for states in todo], np.int64)
    table, accept = _minimal(np.array(rows, np.int64), accept)
    return Automaton(classes, table, accept)


class Scanner:
    """Leftmost, non-overlapping matches of every rule over many texts.

    Holds for rules whose match, once complete, ends at the first byte that
    does not continue it (a trailing repeated class, or a fixed end)."""

    def __init__(self, patterns: list[str]):
        self.rules = len(patterns)
        self.all = compile_rules(patterns)
        self.back = [compile_rules([p], anchored=True, back=True) for p in patterns]
        # Pairs of byte classes after which nothing is pending, whatever came before.
        self.reset = (self.all.table[self.all.table] == 0).all(0)
        if not self.reset[:, self.all.classes[ord("\n")]].all():
            raise ValueError("no rule may match a line feed")

    def _ends(self, data: np.ndarray) -> list[np.ndarray]:
        """For each rule, the ends of its accepted runs, in one pass over the bytes."""
        symbols = self.all.classes[data].astype(np.int32)
        at = np.flatnonzero(self.reset[symbols[:-1], symbols[1:]]) + 1
        at = at[np.r_[True, np.diff(at // CUT_BYTES) > 0]] if len(at) else at
        start = np.r_[0, at + 1]
        size = np.diff(np.r_[start, len(data)])
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        live = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), side="right")
        width = self.all.table.shape[1]
        table, accept = (self.all.table * width).ravel().astype(np.int32), self.all.accept != 0
        ends_here = accept[self.all.table].ravel()
        state = np.zeros(len(start), np.int32)  # times the width
        places, rules = [], []
        for t, k in enumerate(live):
            move = state[:k] + symbols.take(start[:k] + t, mode="clip")
            state = table.take(move, mode="clip")
            hit = np.flatnonzero(ends_here.take(move, mode="clip"))
            if len(hit):
                places.append(start[hit] + t)
                rules.append(self.all.accept[state[hit] // width])
        if not places:
            return [np.empty(0, np.int64)] * self.rules
        place, rule = np.concatenate(places), np.concatenate(rules)
        out = []
        for r in range(self.rules):
            p = np.sort(place[(rule >> r) & 1 == 1])
            out.append(p[np.r_[np.diff(p) > 1, True]] + 1 if len(p) else p)
        return out

    def _start(self, rule: int, data: bytes, low: int, end: int) -> int:
        """Leftmost start, from ``low`` on, of a match that ends at ``end``; -1 if none."""
        a = self.back[rule]
        state, found = 0, -1
        for i in range(end - 1, low - 1, -1):
            state = a.table[state, a.classes[data[i]]]
            if a.accept[state]:
                found = i
            elif (a.table[state] == state).all():
                break
        return found

    def scan(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, rule, start, end) of every match, in byte offsets of its text."""
        joined = b"\n".join(texts) + b"\n"
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        out = []
        for rule, ends in enumerate(self._ends(np.frombuffer(joined, np.uint8))):
            past = 0
            for end, doc in zip(ends.tolist(), (np.searchsorted(begin, ends, side="left") - 1).tolist()):
                low = max(past, int(begin[doc]))
                at = self._start(rule, joined, low, end)
                if at >= 0:
                    out.append((doc, rule, at - int(begin[doc]), end - int(begin[doc])))
                    past = end
        return out
