"""Regular expressions to one minimal deterministic byte automaton.

Rules are given in a small regular language: literals, escapes ``\\xHH``,
classes ``[...]`` with ranges, groups, ``|``, and the repeats ``? * + {m} {m,}
{m,n}``. All rules are compiled together: Thompson construction, then subset
construction over classes of equivalent bytes, then minimisation by partition
refinement. The result is a transition array, searched from every position at
once (the start state is added to each subset), so one pass over the bytes
finds the ends of all matches of all rules.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL = frozenset(range(256))
#: Bytes of every lane that are laid side by side at a time.
BLOCK = 64


class _Nfa:
    def __init__(self) -> None:
        self.eps: list[list[int]] = []
        self.on: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.eps.append([])
        self.on.append([])
        return len(self.eps) - 1


class _Parser:
    """Recursive descent over one pattern; builds fragments (start, end)."""

    def __init__(self, nfa: _Nfa, pattern: str) -> None:
        self.nfa, self.p, self.i = nfa, pattern, 0

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def alternatives(self) -> tuple[int, int]:
        start, end = self.nfa.state(), self.nfa.state()
        while True:
            a, b = self.sequence()
            self.nfa.eps[start].append(a)
            self.nfa.eps[b].append(end)
            if self.peek() != "|":
                return start, end
            self.take()

    def sequence(self) -> tuple[int, int]:
        start = end = self.nfa.state()
        while self.peek() not in ("", "|", ")"):
            begin = self.i
            a, b = self.atom()
            stop = self.i
            low, high = self.repeat()
            if (low, high) != (1, 1):
                a, b = self.repeated(begin, stop, low, high)
            self.nfa.eps[end].append(a)
            end = b
        return start, end

    def repeat(self) -> tuple[int, int | None]:
        c = self.peek()
        if c and c in "?*+":
            self.take()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            close = self.p.index("}", self.i)
            low, _, high = self.p[self.i + 1 : close].partition(",")
            bounded = self.p[self.i + 1 : close]
            self.i = close + 1
            return int(low), int(low) if "," not in bounded else int(high) if high else None
        return 1, 1

    def repeated(self, begin: int, stop: int, low: int, high: int | None) -> tuple[int, int]:
        def copy() -> tuple[int, int]:
            here, self.i = self.i, begin
            frag = self.atom()
            assert self.i == stop
            self.i = here
            return frag

        start = end = self.nfa.state()
        for _ in range(low):
            a, b = copy()
            self.nfa.eps[end].append(a)
            end = b
        last = self.nfa.state()
        if high is None:
            a, b = copy()
            self.nfa.eps[end] += [a, last]
            self.nfa.eps[b] += [a, last]
        else:
            for _ in range(high - low):
                a, b = copy()
                self.nfa.eps[end] += [a, last]
                end = b
            self.nfa.eps[end].append(last)
        return start, last

    def atom(self) -> tuple[int, int]:
        c = self.take()
        if c == "(":
            frag = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.p}")
            return frag
        chars = self.charset() if c == "[" else ALL - {10} if c == "." else frozenset([self.escaped() if c == "\\" else ord(c)])
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.on[a].append((chars, b))
        return a, b

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def charset(self) -> frozenset:
        out: set[int] = set()
        negate = self.peek() == "^"
        if negate:
            self.take()
        while self.peek() != "]":
            c = self.take()
            low = self.escaped() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
            out.update(range(low, high + 1))
        self.take()
        return ALL - out if negate else frozenset(out)


@dataclass(frozen=True)
class Automaton:
    """``table[state * classes + byte_class[byte]]`` is the next state times
    ``classes``; ``accepts[state]`` has bit r if a match of rule r ends there.
    ``resets[byte]``: the byte leads every state to the start."""

    table: np.ndarray
    byte_class: np.ndarray
    accepts: np.ndarray
    resets: np.ndarray
    classes: int

    @property
    def states(self) -> int:
        return len(self.accepts)


def compile_rules(rules: list[str]) -> Automaton:
    nfa = _Nfa()
    root = nfa.state()
    final: dict[int, int] = {}
    for r, pattern in enumerate(rules):
        parser = _Parser(nfa, pattern)
        a, b = parser.alternatives()
        if parser.i != len(pattern):
            raise ValueError(f"unexpected ) in {pattern}")
        nfa.eps[root].append(a)
        final[b] = 1 << r

    # bytes that no transition tells apart form a class
    sets = sorted({chars for on in nfa.on for chars, _ in on}, key=sorted)
    signature = [tuple(b in s for s in sets) for b in range(256)]
    names = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    byte_class = np.array([names[s] for s in signature], dtype=np.int32)
    classes = len(names)
    sample = [int(np.nonzero(byte_class == c)[0][0]) for c in range(classes)]

    def closure(states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if nfa.on[s] or s in final)

    start = closure({root})
    number, order, rows = {start: 0}, [start], []
    for subset in order:
        row = []
        for c in range(classes):
            nxt = closure({t for s in subset for chars, t in nfa.on[s] if sample[c] in chars}) | start
            if nxt not in number:
                number[nxt] = len(order)
                order.append(nxt)
            row.append(number[nxt])
        rows.append(row)
    moves = np.array(rows, dtype=np.int64)
    accepts = np.array([sum({final[s] for s in subset if s in final}) for subset in order], dtype=np.int64)

    # minimisation: split blocks until all states of a block move alike
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        _, new = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == block.max():
            break
        block = new
    # the start's block becomes state 0
    relabel = np.full(block.max() + 1, -1, dtype=np.int64)
    relabel[block[0]] = 0
    relabel[relabel < 0] = np.arange(1, len(relabel))
    block = relabel[block]
    first = np.unique(block, return_index=True)[1]
    small = block[moves[first]]
    return Automaton(
        (small * classes).astype(np.int32).reshape(-1), byte_class, accepts[first].astype(np.int64), (small == 0).all(axis=0)[byte_class], classes
    )


def scan(auto: Automaton, data: np.ndarray, lane: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """(ends, rules) of all matches in ``data`` (bytes): ``ends[i]`` is the
    position after a match's last byte, ``rules[i]`` the bits of the rules that
    match there; in order of position.

    The bytes are cut after reset bytes, where the state is known, into lanes of
    about ``lane`` bytes; all lanes advance together, one gather for each byte.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    safe = np.nonzero(auto.resets[data])[0] + 1
    cuts = np.unique(safe[np.unique(np.searchsorted(safe, np.arange(lane, n, lane)).clip(max=max(0, len(safe) - 1)))]) if len(safe) else safe
    begins = np.unique(np.concatenate([[0], cuts[cuts < n]]))
    sizes = np.diff(np.concatenate([begins, [n]]))
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[order], sizes[order]
    # byte k of every lane lies together; lanes are sorted by size, so the live ones are a prefix
    live = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0])), side="right")
    byte_class = auto.byte_class.astype(np.int32)
    hit_flat = np.zeros(auto.states * auto.classes, dtype=bool)
    hit_flat[:: auto.classes] = auto.accepts != 0
    state = np.zeros(len(sizes), dtype=np.int32)
    ends, rules = [], []
    for k0 in range(0, int(sizes[0]), BLOCK):
        at = begins[: int(live[k0]), None] + np.arange(k0, k0 + BLOCK)
        block = byte_class[np.ascontiguousarray(data[np.minimum(at, n - 1, out=at)].T)]
        for k in range(k0, min(k0 + BLOCK, int(sizes[0]))):
            m = int(live[k])
            state = auto.table[state[:m] + block[k - k0, :m]]
            found = hit_flat[state]
            if found.any():
                lanes = np.nonzero(found)[0]
                ends.append(begins[lanes] + k + 1)
                rules.append(auto.accepts[state[lanes] // auto.classes])
    if not ends:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    e, r = np.concatenate(ends), np.concatenate(rules)
    by = np.argsort(e, kind="stable")
    return e[by], r[by]
