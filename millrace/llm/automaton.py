"""One deterministic automaton for several regular expressions over bytes, run over many texts at once with numpy."""

from __future__ import annotations

import numpy as np

ANY_CASE = {c: (c, c ^ 32) for c in [*range(65, 91), *range(97, 123)]}


class _Parser:
    """Reads literals, classes, groups, alternation, ?, *, +, {n} and {n,} into a nondeterministic automaton."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def read(self, pattern: str, any_case: bool) -> tuple[int, int]:
        self.text, self.at, self.any_case = pattern, 0, any_case
        tree = self._choice()
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} from {self.at}")
        return self._build(tree)

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _choice(self):
        options = [self._chain()]
        while self._peek() == "|":
            self._next()
            options.append(self._chain())
        return ("choice", options)

    def _chain(self):
        parts = []
        while self._peek() not in ("", "|", ")"):
            part, (low, high) = self._one(), self._times()
            parts.append(("times", part, low, high) if (low, high) != (1, 1) else part)
        return ("chain", parts)

    def _times(self) -> tuple[int, int | None]:
        sign = self._peek()
        if sign in ("?", "*", "+"):
            self._next()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        if sign == "{":
            end = self.text.index("}", self.at)
            low, comma, high = self.text[self.at + 1:end].partition(",")
            self.at = end + 1
            return int(low), (int(high) if high else None) if comma else int(low)
        return 1, 1

    def _byte(self) -> int:
        sign = self._next()
        if sign != "\\":
            return ord(sign)
        sign = self._next()
        if sign == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(sign)

    def _one(self):
        if self._peek() == "(":
            self._next()
            if self.text.startswith("?:", self.at):
                self.at += 2
            inner = self._choice()
            self._next()
            return inner
        if self._peek() != "[":
            return ("bytes", self._cased({self._byte()}))
        self._next()
        found: set[int] = set()
        while self._peek() != "]":
            low = self._byte()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self._next()
                found.update(range(low, self._byte() + 1))
            else:
                found.add(low)
        self._next()
        return ("bytes", self._cased(found))

    def _cased(self, found: set[int]) -> frozenset[int]:
        return frozenset(y for x in found for y in (ANY_CASE.get(x, (x,)) if self.any_case else (x,)))

    def _build(self, tree) -> tuple[int, int]:
        kind, start, end = tree[0], self.state(), self.state()
        if kind == "bytes":
            self.moves[start].append((tree[1], end))
        elif kind == "choice":
            for option in tree[1]:
                a, b = self._build(option)
                self.free[start].append(a)
                self.free[b].append(end)
        elif kind == "chain":
            at = start
            for part in tree[1]:
                a, b = self._build(part)
                self.free[at].append(a)
                at = b
            self.free[at].append(end)
        else:
            _, part, low, high = tree
            at = start
            for _ in range(low):
                a, b = self._build(part)
                self.free[at].append(a)
                at = b
            if high is None:
                a, b = self._build(part)
                self.free[at] += [a, end]
                self.free[b] += [a, end]
            else:
                for _ in range(high - low):
                    a, b = self._build(part)
                    self.free[at] += [a, end]
                    at = b
                self.free[at].append(end)
        return start, end


def _turned(moves: list, free: list) -> tuple[list, list]:
    """The same states with every arrow the other way."""
    back_moves, back_free = [[] for _ in moves], [[] for _ in free]
    for state, (arrows, jumps) in enumerate(zip(moves, free)):
        for chars, to in arrows:
            back_moves[to].append((chars, state))
        for to in jumps:
            back_free[to].append(state)
    return back_moves, back_free


class Automaton:
    """Finds where matches of any rule end: one minimal transition table for all rules.

    ``rules`` are (pattern, any_case).  After a byte, ``accept[state]`` has bit
    i set if a match of rule i ends there.  The table is ``next[state, class]``,
    with ``byte_class`` naming the class of each byte.

    A match may begin anywhere, or with ``anchored`` at the first byte only; then
    ``longest`` follows one match to its end.  ``backwards`` reads the rules from
    their ends: over reversed bytes it finds where matches start.
    """

    def __init__(self, rules: list[tuple[str, bool]], anchored: bool = False, backwards: bool = False):
        parser, starts, ends = _Parser(), [], {}
        for i, (pattern, any_case) in enumerate(rules):
            a, b = parser.read(pattern, any_case)
            a, b = (b, a) if backwards else (a, b)
            starts.append(a)
            ends[b] = 1 << i
        if backwards:
            parser.moves, parser.free = _turned(parser.moves, parser.free)
        # Bytes that no rule tells apart share a class.
        signature: dict[tuple, int] = {}
        sets = list({m[0] for moves in parser.moves for m in moves})
        self.byte_class = np.array([signature.setdefault(tuple(b in s for s in sets), len(signature))
                                    for b in range(256)], np.uint8)
        sample = [int(np.flatnonzero(self.byte_class == c)[0]) for c in range(len(signature))]

        def closure(states) -> frozenset[int]:
            found, stack = set(states), list(states)
            while stack:
                for t in parser.free[stack.pop()]:
                    if t not in found:
                        found.add(t)
                        stack.append(t)
            return frozenset(s for s in found if parser.moves[s] or s in ends)

        # Where a match may begin anywhere, every subset holds the rules' first states.
        first = closure(starts)
        again = frozenset() if anchored else first
        number, table, subsets = {first: 0}, [], [first]
        for subset in subsets:
            row = []
            for byte in sample:
                to = closure([t for s in subset for chars, t in parser.moves[s] if byte in chars]) | again
                if to not in number:
                    number[to] = len(subsets)
                    subsets.append(to)
                row.append(number[to])
            table.append(row)
        accept = np.array([sum({ends[s] for s in subset if s in ends}) for subset in subsets])
        self._minimise(np.array(table), accept)

    def _minimise(self, table: np.ndarray, accept: np.ndarray) -> None:
        """Merges states that no continuation tells apart."""
        block = np.unique(accept, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        order = np.argsort([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
        place = np.argsort(order)
        block = place[block]  # the first state stays number 0
        chosen = [int(np.flatnonzero(block == b)[0]) for b in range(block.max() + 1)]
        self.accept = accept[chosen]
        self.next = block[table[chosen]].astype(np.uint16 if len(chosen) < 1 << 16 else np.uint32)

    def follow(self) -> tuple[list[list[int]], list[bool], list[bool], bytes]:
        """The table as lists, for ``longest``: next states, which accept, which lead nowhere, and the class of each byte."""
        accepts = (self.accept != 0).tolist()
        dead = [not accepts[s] and bool((row == s).all()) for s, row in enumerate(self.next)]
        return self.next.tolist(), accepts, dead, self.byte_class.tobytes()

    @staticmethod
    def longest(table: tuple[list[list[int]], list[bool], list[bool], bytes], data: bytes, start: int) -> int:
        """Where the longest match from ``start`` ends, or -1; reads no farther than a match can go on."""
        following, accepts, dead, classes = table
        state, end = 0, start if accepts[0] else -1
        for at in range(start, len(data)):
            state = following[state][classes[data[at]]]
            if accepts[state]:
                end = at + 1
            elif dead[state]:
                break
        return end

    def states(self, data: np.ndarray, lanes_of: int = 512) -> np.ndarray:
        """The state after every byte of ``data``, as one pass from state 0 gives it.

        The bytes are cut into stretches that advance together.  A stretch
        starts in state 0 and is run again from the state in which the one
        before it really ended, as far as the two runs differ.
        """
        lanes = -(-len(data) // lanes_of)
        classes = np.zeros(lanes * lanes_of, np.uint8)
        classes[:len(data)] = self.byte_class[data]
        grid = np.ascontiguousarray(classes.reshape(lanes, lanes_of).T)
        flat, width = self.next.ravel(), self.next.shape[1]
        found = np.empty((lanes_of, lanes), self.next.dtype)
        state = np.zeros(lanes, np.intp)
        for i in range(lanes_of):
            found[i] = flat[state * width + grid[i]]
            state = found[i].astype(np.intp)
        begun = np.zeros(lanes, np.intp)
        while True:
            before = np.concatenate(([0], found[-1, :-1])).astype(np.intp)
            lane = np.flatnonzero(before != begun)
            if not len(lane):
                return found.T.ravel()[:len(data)]
            begun[lane] = before[lane]
            state = before[lane]
            for i in range(lanes_of):
                state = flat[state * width + grid[i, lane]].astype(np.intp)
                differ = state != found[i, lane]
                lane, state = lane[differ], state[differ]
                if not len(lane):
                    break
                found[i, lane] = state
