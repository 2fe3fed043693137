"""Many rules as one deterministic automaton over bytes.

Rules are regular expressions over ASCII: literals, ``\\`` escapes, classes, groups,
``|``, ``?``, ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``.  Each becomes a small
nondeterministic automaton; subset construction makes one deterministic automaton of
all of them, partition refinement the smallest equivalent one.  Its transitions are one flat
array over classes of bytes that no rule tells apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np

Tree = tuple


def parsed(pattern: str) -> Tree:
    """The expression as nested ("set", bits), ("seq", parts), ("alt", parts), ("rep", part, least, most)."""
    tree, rest = _alternatives(pattern)
    if rest:
        raise ValueError(f"cannot read {rest!r} in {pattern!r}")
    return tree


def _alternatives(text: str) -> tuple[Tree, str]:
    parts = []
    while True:
        part, text = _sequence(text)
        parts.append(part)
        if not text.startswith("|"):
            return (parts[0] if len(parts) == 1 else ("alt", parts)), text
        text = text[1:]


def _sequence(text: str) -> tuple[Tree, str]:
    parts = []
    while text and text[0] not in "|)":
        part, text = _atom(text)
        while text and text[0] in "?*+{":
            if text[0] == "{":
                bounds, text = text[1:].split("}", 1)
                least, comma, most = bounds.partition(",")
                part = ("rep", part, int(least), int(most) if most else None if comma else int(least))
            else:
                part = ("rep", part, int(text[0] == "+"), 1 if text[0] == "?" else None)
                text = text[1:]
        parts.append(part)
    return ("seq", parts), text


def _atom(text: str) -> tuple[Tree, str]:
    if text[0] == "(":
        tree, rest = _alternatives(text[1:])
        if not rest.startswith(")"):
            raise ValueError(f"no closing bracket in {text!r}")
        return tree, rest[1:]
    if text[0] == "[":
        bits, rest = 0, text[1:]
        while rest[0] != "]":
            first, rest = _letter(rest)
            last = first
            if rest[0] == "-" and rest[1] != "]":
                last, rest = _letter(rest[1:])
            bits |= (1 << (last + 1)) - (1 << first)
        return ("set", bits), rest[1:]
    letter, rest = _letter(text)
    return ("set", 1 << letter), rest


def _letter(text: str) -> tuple[int, str]:
    skip = 1 if text[0] == "\\" else 0
    letter = ord(text[skip])
    if letter > 127:
        raise ValueError(f"rules are over ASCII, not {text[skip]!r}")
    return letter, text[skip + 1 :]


@dataclass
class Steps:
    """A nondeterministic automaton: for each state its steps (bits of bytes, target) and free steps."""

    moves: list[list[tuple[int, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, tree: Tree, start: int) -> int:
        """The state reached from ``start`` by what ``tree`` matches."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "seq":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(part, first)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            end = self.state()
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            first = self.state()
            self.free[start].append(first)
            start = self.add(part, first)
            self.free[start].append(end)
        return end

    def closed(self, states: set[int]) -> frozenset[int]:
        seen, left = set(states), list(states)
        while left:
            for target in self.free[left.pop()]:
                if target not in seen:
                    seen.add(target)
                    left.append(target)
        return frozenset(seen)


def byte_classes(moves: Sequence[Sequence[tuple[int, int]]]) -> tuple[np.ndarray, list[int]]:
    """The class of every byte, and one byte of each class: bytes that the same steps take are one class."""
    sets = sorted({bits for steps in moves for bits, _ in steps})
    seen: dict[tuple, int] = {}
    classes = [seen.setdefault(tuple(bits >> byte & 1 for bits in sets), len(seen)) for byte in range(256)]
    return np.array(classes, np.uint8), [classes.index(k) for k in range(len(seen))]


def smallest(table: np.ndarray, accepts: list[frozenset[int]]) -> tuple[np.ndarray, list[frozenset[int]], np.ndarray]:
    """The smallest equivalent automaton, and the new number of each state; the start stays 0."""
    names = {accept: k for k, accept in enumerate(dict.fromkeys(accepts))}
    part = np.array([names[accept] for accept in accepts])
    while True:
        _, finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    _, first = np.unique(part, return_index=True)
    order = np.argsort(first, kind="stable")  # new numbers by first old state, so state 0 comes first
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    part = number[part]
    chosen = first[order]
    return part[table[chosen]], [accepts[k] for k in chosen], part


@dataclass(frozen=True)
class Automaton:
    """``table[state * width + class]`` is the next state times ``width``; 0 is the start.

    ``accepts`` maps states (times ``width``) to the rules that match up to there.  States
    from ``first_accept`` on accept; ``dead`` is the state without a way out, if there is one.
    """

    classes: bytes
    width: int
    table: list[int]
    accepts: dict[int, frozenset[int]]
    first_accept: int
    dead: int


def compiled(patterns: Sequence[str], anywhere: bool) -> Automaton:
    """One automaton of all patterns; with ``anywhere`` their matches may start at any byte."""
    steps = Steps()
    ends: dict[int, int] = {}
    starts = set()
    for rule, pattern in enumerate(patterns):
        start = steps.state()
        starts.add(start)
        ends[steps.add(parsed(pattern), start)] = rule
    classes, examples = byte_classes(steps.moves)
    start = steps.closed(starts)
    numbers = {start: 0}
    rows: list[list[int]] = []
    left = [start]
    for now in left:
        row = []
        for byte in examples:
            reached = {target for state in now for bits, target in steps.moves[state] if bits >> byte & 1}
            then = steps.closed(reached | starts if anywhere else reached)
            if then not in numbers:
                numbers[then] = len(numbers)
                left.append(then)
            row.append(numbers[then])
        rows.append(row)
    accepts = [frozenset(ends[state] for state in now if state in ends) for now in left]
    table, accepts, _ = smallest(np.array(rows), accepts)
    quiet = [k for k, accept in enumerate(accepts) if not accept]
    order = np.array(quiet + [k for k, accept in enumerate(accepts) if accept])
    if order[0] != 0:
        raise ValueError("a rule matches the empty text")
    number = np.argsort(order)
    table = number[table[order]]
    width = len(examples)
    sinks = [k for k in range(len(quiet)) if (table[k] == k).all()]
    return Automaton(
        classes.tobytes(), width, (table.reshape(-1) * width).tolist(),
        {int(number[k]) * width: accept for k, accept in enumerate(accepts) if accept},
        len(quiet) * width, sinks[0] * width if sinks and not anywhere else -1,
    )


def stretches(automaton: Automaton, data: bytes) -> Iterator[tuple[int, int, set[int]]]:
    """(start, end, rules): stretches of ``data`` in which patterns match, in one pass over the bytes.

    A stretch begins where the automaton leaves its start state and ends where it is back:
    nothing begun before is then under way, so every match lies within one stretch.  Stretches
    without a match are not told.
    """
    table, accepts, least = automaton.table, automaton.accepts, automaton.first_accept
    state, begin = 0, 0
    found: set[int] = set()
    at = 0
    for at, kind in enumerate(data.translate(automaton.classes)):
        state = table[state + kind]
        if not state:
            if found:
                yield begin, at + 1, found
                found = set()
            begin = at + 1
        elif state >= least:
            found |= accepts[state]
    if found:
        yield begin, at + 1, found


def chained(automaton: Automaton) -> list:
    """The start state as a list of what follows each class of bytes: such a list again, or None for a match."""
    width = automaton.width
    rows: list[list] = [[] for _ in range(len(automaton.table) // width)]
    for k, row in enumerate(rows):
        after = automaton.table[k * width : (k + 1) * width]
        row.extend(None if state >= automaton.first_accept else rows[state // width] for state in after)
    return rows[0]


def matches_somewhere(start: list, kinds: bytes) -> bool:
    """Whether the automaton given by ``chained`` matches anywhere; nothing but one lookup a byte."""
    row = start
    for kind in kinds:
        row = row[kind]
        if row is None:
            return True
    return False


def longest(automaton: Automaton, kinds: bytes, start: int) -> int:
    """End of the longest match that starts at ``start`` of a text given as byte classes; -1 if none."""
    table, least, dead = automaton.table, automaton.first_accept, automaton.dead
    state, end = 0, -1
    for at in range(start, len(kinds)):
        state = table[state + kinds[at]]
        if state >= least:
            end = at + 1
        elif state == dead:
            break
    return end
