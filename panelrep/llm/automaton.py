"""Rule regexes to one minimal deterministic automaton over bytes, as transition arrays.

Every rule is scanned with leftmost, greedy, non-overlapping semantics: the
subset construction keeps threads in priority order, drops lower ones when a
thread matches, and starts anew where a match ends.  The automata of all rules
run side by side as one product automaton, which is minimised by partition
refinement.  A rule must end in a repeated class, so that a match accepts at
each of its last bytes and ends where acceptance ends; others are refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

_sre = re._parser  # the standard library's own parser
#: Rounds in which lanes run again one after another, before all their entries are found together.
ROUNDS = 6


@dataclass(frozen=True)
class Rule:
    """``head`` then one or more of ``tail``; matches with under ``least`` tail bytes are dropped.

    ``head`` and ``tail`` are regexes over ASCII; ``any_case``: letters of the
    head in either case.
    """

    kind: str
    head: str
    tail: str
    least: int
    any_case: bool = False


def _fold(bytes_: frozenset, any_case: bool) -> frozenset:
    return frozenset(ord(f(chr(b))) for b in bytes_ for f in (str.lower, str.upper)) if any_case else bytes_


def _class(items) -> frozenset:
    out = set()
    for op, arg in items:
        if op is _sre.LITERAL:
            out.add(arg)
        elif op is _sre.RANGE:
            out.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"unsupported in a class: {op}")
    return frozenset(out)


class Nfa:
    """Thompson automaton; nodes are ('byte', set, next), ('split', [next, ...]) by priority, or ('match',)."""

    def __init__(self) -> None:
        self.nodes: list[tuple] = []

    def add(self, *node) -> int:
        self.nodes.append(node)
        return len(self.nodes) - 1

    def seq(self, parsed, after: int, any_case: bool, backward: bool) -> int:
        for op, arg in parsed if backward else reversed(list(parsed)):
            after = self.one(op, arg, after, any_case, backward)
        return after

    def one(self, op, arg, after: int, any_case: bool, backward: bool) -> int:
        if op is _sre.LITERAL:
            return self.add("byte", _fold(frozenset([arg]), any_case), after)
        if op is _sre.IN:
            return self.add("byte", _fold(_class(arg), any_case), after)
        if op is _sre.SUBPATTERN:
            return self.seq(arg[-1], after, any_case, backward)
        if op is _sre.BRANCH:
            return self.add("split", [self.seq(x, after, any_case, backward) for x in arg[1]])
        if op is _sre.MAX_REPEAT:
            least, most, inner = arg
            if most is _sre.MAXREPEAT:
                loop = self.add("split", [])
                self.nodes[loop][1].extend([self.seq(inner, loop, any_case, backward), after])
                after = loop
            else:
                for _ in range(most - least):
                    after = self.add("split", [self.seq(inner, after, any_case, backward), after])
            for _ in range(least):
                after = self.seq(inner, after, any_case, backward)
            return after
        raise ValueError(f"unsupported: {op}")

    def closure(self, node: int) -> list[int]:
        """Byte and match nodes reachable without input, by priority."""
        out, stack, seen = [], [node], set()
        while stack:
            x = stack.pop()
            if x in seen:
                continue
            seen.add(x)
            if self.nodes[x][0] == "split":
                stack.extend(reversed(self.nodes[x][1]))
            else:
                out.append(x)
        return out


class Search:
    """Leftmost scan for one rule; states are (threads by priority, matched)."""

    def __init__(self, rule: Rule) -> None:
        self.nfa = Nfa()
        end = self.nfa.add("match")
        start = self.nfa.seq(_sre.parse(f"[{rule.tail}]+" if not rule.tail.startswith("[") else f"{rule.tail}+"),
                             end, False, False)
        if rule.head:
            start = self.nfa.seq(_sre.parse(rule.head), start, rule.any_case, False)
        self.rule, self.first = rule, tuple(self.nfa.closure(start))
        self.start = (self.first, False)

    def step(self, state: tuple, byte: int) -> tuple:
        threads, matched = state
        out, found = [], False
        for t in threads:
            _, allowed, after = self.nfa.nodes[t]
            if byte not in allowed:
                continue
            for x in self.nfa.closure(after):
                if self.nfa.nodes[x][0] == "match":
                    if any(y not in self.nfa.closure(after) for y in out):
                        raise ValueError(f"rule {self.rule.kind}: an earlier start may still match")
                    found = True
                    break
                if x not in out:
                    out.append(x)
            if found:
                break
        if matched and not found:
            if out:
                raise ValueError(f"rule {self.rule.kind} must end in a repeated class")
            return self.step(self.start, byte)
        if not found:
            out.extend(x for x in self.first if x not in out)
        return tuple(out), found


class Automaton:
    """``step[state * classes + class_of[byte]]`` is the next state times ``classes``; ``accept[state]`` has a bit per rule.

    The last class is the boundary between texts: it leads to the start state 0.
    """

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        searches = [Search(r) for r in rules]
        sets = {n[1] for s in searches for n in s.nfa.nodes if n[0] == "byte"}
        kinds: dict[tuple, int] = {}
        self.class_of = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)],
                                 np.uint8)
        sample = [int(np.flatnonzero(self.class_of == c)[0]) for c in range(len(kinds))]
        begin = tuple(s.start for s in searches)
        number, queue, rows = {begin: 0}, [begin], []
        for state in queue:  # grows as it is read
            row = []
            for b in sample:
                to = tuple(s.step(x, b) for s, x in zip(searches, state))
                if to not in number:
                    number[to] = len(number)
                    queue.append(to)
                row.append(number[to])
            rows.append([*row, 0])
        accept = np.array([sum(x[1] << k for k, x in enumerate(s)) for s in queue])
        table, self.accept = _minimal(np.array(rows), accept)
        self.classes = table.shape[1]
        self.step = (table * self.classes).astype(np.int32).ravel()
        self.heads = [_backward(r) if r.head else None for r in rules]

    def states(self, raw: np.ndarray, at: np.ndarray, width: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """The state after every byte of the texts; (accept bits, offsets), with one boundary after each text.

        The bytes are cut into lanes that step together, each from the start
        state; lanes whose predecessor ends in another state run again from
        that one until they meet the states found before.  Where that goes on
        from lane to lane, as in a very long match, :meth:`_entries` tells all
        lanes' entries at once.
        """
        n = len(at) - 1
        size = len(raw) + n
        kinds = np.full(-(-max(size, 1) // width) * width, self.classes - 1, np.uint8)
        ends = at[1:] + np.arange(n)
        body = np.ones(size, bool)
        body[ends] = False
        kinds[:size][body] = self.class_of[raw]
        lanes = len(kinds) // width
        by_step = np.ascontiguousarray(kinds.reshape(lanes, width).T)
        found = np.empty((width, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        for t in range(width):
            now = self.step.take(now + by_step[t])
            found[t] = now
        entry = np.zeros(lanes, np.int32)
        todo, rounds = np.flatnonzero(found[-1][:-1] != 0) + 1, 0
        while len(todo):
            if rounds == ROUNDS:
                todo = self._entries(by_step, found[-1], entry, int(todo[0]))
            else:
                entry[todo] = found[-1][todo - 1]
            rounds += 1
            lane, now = todo, entry[todo]
            for t in range(width):
                now = self.step.take(now + by_step[t][lane])
                differ = now != found[t][lane]
                lane, now = lane[differ], now[differ]
                if not len(lane):
                    break
                found[t][lane] = now
            todo = np.flatnonzero(found[-1][:-1] != entry[1:]) + 1
        bits = self.accept[found.T.ravel()[:size] // self.classes]
        return bits, np.append(0, ends + 1)

    def _entries(self, by_step: np.ndarray, ends: np.ndarray, entry: np.ndarray, first: int) -> np.ndarray:
        """Sets the entry states of the lanes from ``first`` on; the lanes whose entry has changed.

        Lanes are maps of states: where one is met in a state that it has not
        been run from, it and all after it are run from that state together.
        There are no more such runs than states; a long match keeps to a few.
        """
        known: dict[int, np.ndarray] = {}
        was, ends_, state = entry.tolist(), ends.tolist(), int(ends[first - 1])
        for lane in range(first, len(entry)):
            entry[lane] = state
            if state == was[lane]:
                state = ends_[lane]
                continue
            run = known.get(state)
            if run is None:
                now = np.full(len(entry) - lane, state, np.int32)
                for t in range(len(by_step)):
                    now = self.step.take(now + by_step[t][lane:])
                run = known[state] = np.concatenate([np.zeros(lane, np.int32), now])
            state = int(run[lane])
        return np.flatnonzero(entry != np.array(was, np.int32))

    def spans(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Matches in all texts: (text, rule, first byte, byte after the last), offsets within the text."""
        bits, placed = self.states(raw, at)
        out = []
        for k, rule in enumerate(self.rules):
            inside = np.zeros(len(bits) + 2, np.int8)
            inside[1:-1] = (bits >> k) & 1
            turn = np.diff(inside)
            first, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
            long_enough = np.flatnonzero(end - first >= rule.least)
            text = np.searchsorted(placed, first[long_enough], "right") - 1
            for i, t in zip(long_enough.tolist(), text.tolist()):
                shift, a, b = int(placed[t]), int(first[i]), int(end[i])
                low = max(shift, int(end[i - 1]) if i else 0) - shift
                start = a - shift if self.heads[k] is None else \
                    _walk_back(self.heads[k], raw[at[t]:at[t + 1]], a - shift, low)
                out.append((t, k, start, b - shift))
        return out


def _minimal(table: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moore's partition refinement; the start state stays number 0."""
    _, part = np.unique(accept, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    order = np.unique(part, return_index=True)[1]
    rank = np.argsort(np.argsort(order))
    part = rank[part]
    one = np.sort(order)
    return part[table[one]], accept[one].astype(np.uint16)


def _backward(rule: Rule) -> tuple[dict, frozenset, frozenset]:
    """Subset construction of the reversed head: transitions, start and accepting states."""
    nfa = Nfa()
    end = nfa.add("match")
    start = frozenset(nfa.closure(nfa.seq(_sre.parse(rule.head), end, rule.any_case, True)))
    table, queue = {}, [start]
    seen = {start}
    for s in queue:
        for b in range(128):
            to = frozenset(y for x in s if nfa.nodes[x][0] == "byte" and b in nfa.nodes[x][1]
                           for y in nfa.closure(nfa.nodes[x][2]))
            if to:
                table[s, b] = to
                if to not in seen:
                    seen.add(to)
                    queue.append(to)
    return table, start, frozenset(s for s in seen if end in s)


def _walk_back(head: tuple, raw: np.ndarray, tail: int, low: int) -> int:
    """The leftmost start, not before ``low``, of a head that ends where the tail starts."""
    table, state, good = head
    best = tail
    for p in range(tail - 1, low - 1, -1):
        state = table.get((state, int(raw[p])))
        if state is None:
            break
        if state in good:
            best = p
    return best
