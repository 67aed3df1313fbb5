"""Deterministic byte automata from regular expressions.

Patterns are parsed here, turned into one nondeterministic automaton, made
deterministic by subset construction and minimised by partition refinement.
Supported: literals, ``\\xNN`` and escaped signs, character classes with
ranges, groups, alternation and greedy repeats, all over ASCII.

``compile_scanner`` reads texts from the end to the start: there a rule's match
is met at its first byte, and the threads alive at a byte differ only in where
their match ends.  A state is the list of these ends' thread sets, furthest end
first, and a thread that two ends reach keeps the further one.  So a state knows
the order of its ends, and a step only says which of them live on: the scan
holds one number for each, compares none, and meets the longest match of every
rule at every start in a single pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ENTRY = -1  # the end that a step opens, see Scanner

# -- patterns: ("one", bytes), ("seq", parts), ("alt", parts), ("rep", least, most, part)


def _class(pattern: str, at: int) -> tuple[set[int], int]:
    found: set[int] = set()
    while pattern[at] != "]":
        low, at = _sign(pattern, at)
        high = low
        if pattern[at] == "-" and pattern[at + 1] != "]":
            high, at = _sign(pattern, at + 1)
        found |= set(range(low, high + 1))
    return found, at + 1


def _sign(pattern: str, at: int) -> tuple[int, int]:
    if pattern.startswith("\\x", at):
        return int(pattern[at + 2:at + 4], 16), at + 4
    if pattern[at] == "\\":
        if pattern[at + 1].isalnum():
            raise ValueError(f"unsupported escape at {at} in {pattern!r}")
        at += 1
    return ord(pattern[at]), at + 1


def _repeat(pattern: str, at: int, part: tuple) -> tuple[tuple, int]:
    sign = pattern[at:at + 1]
    if sign in ("?", "*", "+") and sign:
        return ("rep", int(sign == "+"), 1 if sign == "?" else None, part), at + 1
    if sign == "{":
        close = pattern.index("}", at)
        least, comma, most = pattern[at + 1:close].partition(",")
        return ("rep", int(least), (int(most) if most else None) if comma else int(least), part), close + 1
    return part, at


def _parse(pattern: str, at: int, fold: bool) -> tuple[tuple, int]:
    branches: list[tuple] = []
    parts: list[tuple] = []
    while at < len(pattern) and pattern[at] != ")":
        if pattern[at] == "|":
            branches.append(("seq", parts))
            parts, at = [], at + 1
            continue
        if pattern[at] == "(":
            part, at = _parse(pattern, at + 1, fold)
            at += 1
        elif pattern[at] == "[" and pattern[at + 1] != "^":
            signs, at = _class(pattern, at + 1)
            part = ("one", _folded(signs, fold))
        elif pattern[at] in ".^$[]?*+{":
            raise ValueError(f"unsupported sign {pattern[at]!r} in {pattern!r}")
        else:
            sign, at = _sign(pattern, at)
            part = ("one", _folded({sign}, fold))
        part, at = _repeat(pattern, at, part)
        if pattern[at:at + 1] and pattern[at] in "?*+{":
            raise ValueError(f"unsupported repeat in {pattern!r}")
        parts.append(part)
    branches.append(("seq", parts))
    return ("alt", branches) if len(branches) > 1 else branches[0], at


def _folded(signs: set[int], fold: bool) -> frozenset[int]:
    if max(signs) > 127:
        raise ValueError("only ASCII patterns are supported")
    if fold:
        signs = signs | {ord(c) for b in signs for c in (chr(b).lower(), chr(b).upper())}
    return frozenset(signs)


def parse(pattern: str, any_case: bool = False) -> tuple:
    tree, at = _parse(pattern, 0, any_case)
    if at < len(pattern):
        raise ValueError(f"unbalanced group in {pattern!r}")
    return tree


# -- nondeterministic automaton ------------------------------------------------

class _Graph:
    """Per node byte-set edges and free edges; ``backward`` reads patterns from
    their end."""

    def __init__(self, backward: bool) -> None:
        self.backward = backward
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []
        self.final: dict[int, int] = {}

    def node(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add_rules(self, rules: list[tuple[str, bool]]) -> frozenset[int]:
        """Adds (pattern, any letter case) rules; returns the threads that wait
        for a match's first byte."""
        starts = []
        for rule, (pattern, any_case) in enumerate(rules):
            starts.append(self.node())
            self.final[self.add(parse(pattern, any_case), starts[-1])] = rule
        waiting = self.closure(starts)
        if any(n in self.final for n in waiting):
            raise ValueError("a rule matches the empty text")
        return waiting

    def add(self, tree: tuple, start: int) -> int:
        """Appends ``tree`` after ``start``; returns its end node."""
        kind = tree[0]
        if kind == "one":
            end = self.node()
            self.steps[start].append((tree[1], end))
            return end
        if kind == "seq":
            for part in reversed(tree[1]) if self.backward else tree[1]:
                start = self.add(part, start)
            return start
        end = self.node()
        if kind == "alt":
            for branch in tree[1]:
                first = self.node()
                self.free[start].append(first)
                self.free[self.add(branch, first)].append(end)
            return end
        _, least, most, part = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.node()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        for _ in range(most - least):
            self.free[start].append(end)
            start = self.add(part, start)
        self.free[start].append(end)
        return end

    def closure(self, nodes) -> frozenset[int]:
        """Nodes reached by free edges that read a byte or end a match."""
        todo, seen = list(nodes), set(nodes)
        while todo:
            for y in self.free[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return frozenset(n for n in seen if self.steps[n] or n in self.final)

    def byte_classes(self) -> list[int]:
        """Class of each byte; bytes of a class are in the same sets."""
        sets = list(dict.fromkeys(s for edges in self.steps for s, _ in edges))
        number: dict[tuple, int] = {}
        return [number.setdefault(tuple(b in s for s in sets), len(number)) for b in range(256)]

    def step(self, nodes, byte: int) -> frozenset[int]:
        return self.closure([end for n in nodes for s, end in self.steps[n] if byte in s])


# -- deterministic automata ----------------------------------------------------

def _minimised(outputs: list, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Partition refinement: (block of each state, one state of each block).
    ``outputs`` are hashable and must agree within a block; state 0 is in block 0."""
    number: dict = {}
    block = np.array([number.setdefault(o, len(number)) for o in outputs])
    while True:
        signature = np.concatenate((block[:, None], block[table]), axis=1)
        _, first, finer = np.unique(signature, axis=0, return_index=True, return_inverse=True)
        finer = finer.reshape(-1)
        if len(first) == len(number):
            break
        block, number = finer, dict.fromkeys(range(len(first)))
    renumber = np.argsort(np.argsort(first))  # blocks in order of their first state
    return renumber[finer], np.sort(first)


@dataclass(frozen=True)
class Scanner:
    """``table[state, byte]`` is the next state; state 0 starts at a text's end.

    ``keeps[state][byte]``: where the next state's ends come from, as positions
    among this state's (``ENTRY``: the byte just read is a match's last).
    ``hits[state]``: (rule, position of its longest match's end) for every rule
    of which a match starts at the byte just read.  ``alive[state]``: rules of
    which a match may reach on to the left.  ``ends[state]``: number of ends.
    """

    table: np.ndarray
    ends: tuple[int, ...]
    keeps: tuple[tuple[tuple[int, ...], ...], ...]
    hits: tuple[tuple[tuple[int, int], ...], ...]
    alive: tuple[frozenset[int], ...]

    def rows(self) -> list[list[tuple]]:
        """The tables as linked rows, one lookup a byte: row[byte] is (next row,
        kept ends or None where they stay as they are, hits or None);
        row[256] is the state's live rules."""
        rows: list[list] = [[] for _ in self.hits]
        for state, row in enumerate(rows):
            same = tuple(range(self.ends[state]))
            row += [(rows[t], None if keep == same else keep, self.hits[t] or None)
                    for t, keep in zip(self.table[state].tolist(), self.keeps[state])]
            row.append(self.alive[state])
        return rows


def compile_scanner(rules: list[tuple[str, bool]]) -> Scanner:
    """Minimal automaton that meets all matches of all (pattern, any letter
    case) rules in one pass from a text's last byte to its first."""
    graph = _Graph(backward=True)
    waiting = graph.add_rules(rules)
    rule_of = _rule_of(graph, waiting)
    classes = graph.byte_classes()
    sample = [classes.index(c) for c in range(max(classes) + 1)]

    number: dict[tuple, int] = {(): 0}
    states: list[tuple] = [()]
    table: list[list[int]] = []
    keeps: list[list[tuple]] = []
    while len(table) < len(states):  # every expansion can add states
        sources = (*enumerate(states[len(table)]), (ENTRY, waiting))
        targets, kept = [], []
        for byte in sample:
            claimed: set[int] = set()
            following, keep = [], []
            for position, threads in sources:
                reached = graph.step(threads, byte) - claimed
                if reached:
                    claimed |= reached
                    following.append(reached)
                    keep.append(position)
            key = tuple(following)
            if key not in number:
                number[key] = len(states)
                states.append(key)
            targets.append(number[key])
            kept.append(tuple(keep))
        table.append(targets)
        keeps.append(kept)

    hits = [tuple((graph.final[n], position) for position, threads in enumerate(state)
                  for n in sorted(threads) if n in graph.final) for state in states]
    alive = [frozenset(rule_of[n] for threads in state for n in threads if graph.steps[n])
             for state in states]
    narrow = np.array(table)
    block, first = _minimised([(len(s), h, a, tuple(k)) for s, h, a, k in
                               zip(states, hits, alive, keeps)], narrow)
    return Scanner(block[narrow[first]][:, classes].astype(np.int32),
                   tuple(len(states[s]) for s in first),
                   tuple(tuple(keeps[s][c] for c in classes) for s in first),
                   tuple(hits[s] for s in first), tuple(alive[s] for s in first))


def _rule_of(graph: _Graph, waiting: frozenset[int]) -> dict[int, int]:
    """Rule of every node: rules share no node, so what reaches a rule's last
    node is that rule's."""
    before: dict[int, list[int]] = {}
    for n in range(len(graph.steps)):
        for y in graph.free[n] + [end for _, end in graph.steps[n]]:
            before.setdefault(y, []).append(n)
    found: dict[int, int] = {}
    for last, rule in graph.final.items():
        todo = [last]
        while todo:
            n = todo.pop()
            if n not in found:
                found[n] = rule
                todo += before.get(n, [])
    return found


@dataclass(frozen=True)
class Matcher:
    """``table[state, byte]`` is the next state (0: no match can follow), the
    match starts in state 1; ``accepts[state]``: one ends here."""

    table: np.ndarray
    accepts: tuple[bool, ...]

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that begins at ``at``, or -1."""
        end, state, table = -1, 1, self.table
        for i in range(at, len(data)):
            state = table[state, data[i]]
            if not state:
                break
            if self.accepts[state]:
                end = i + 1
        return end


def compile_matcher(pattern: str, any_case: bool = False) -> Matcher:
    """Automaton of matches that begin at a given byte."""
    graph = _Graph(backward=False)
    first = graph.add_rules([(pattern, any_case)])
    number = {frozenset(): 0, first: 1}
    states, table = list(number), []
    while len(table) < len(states):
        row = []
        for byte in range(256):
            key = graph.step(states[len(table)], byte)
            if key not in number:
                number[key] = len(states)
                states.append(key)
            row.append(number[key])
        table.append(row)
    return Matcher(np.array(table, np.int32), tuple(any(n in graph.final for n in s) for s in states))
