"""A minimal acyclic transducer from words to numbers, as flat arrays.

Built from sorted words by joining equal suffixes as soon as a branch is
complete, so the automaton is minimal at every step. Every arc carries a number;
the sum along a word's path is the word's rank among the words. The arrays of
the finished automaton form a double-array table (the arc of state s by byte b
lies at ``base[s] + b`` and belongs to s if ``owner`` says so), which is written
as one block of bytes and used in place, without being parsed.
"""

from __future__ import annotations

import mmap
import struct
from array import array
from collections.abc import Sequence

_MAGIC = b"OLTX0001"


class _Node:
    __slots__ = ("arcs", "final", "count", "number")

    def __init__(self) -> None:
        self.arcs: dict[int, _Node] = {}
        self.final = False
        self.count = 0
        self.number = 0

    def signature(self) -> tuple:
        return (self.final, *((b, n.number) for b, n in self.arcs.items()))


def _minimal(words: Sequence[bytes]) -> tuple[_Node, list[_Node]]:
    """Root and all states of the minimal automaton of ascending, distinct words."""
    root, known, states = _Node(), {}, []
    path: list[tuple[_Node, int, _Node]] = []  # arcs of the latest word whose ends may still grow

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, byte, node = path.pop()
            same = known.get(sign := node.signature())
            if same is None:
                node.number = len(states) + 1
                node.count = node.final + sum(n.count for n in node.arcs.values())
                known[sign] = same = node
                states.append(node)
            parent.arcs[byte] = same

    last = b""
    for word in words:
        if last and word <= last:
            raise ValueError("words must ascend without repeats")
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        node = path[-1][2] if path else root
        for byte in word[common:]:
            fresh = _Node()
            node.arcs[byte] = fresh
            path.append((node, byte, fresh))
            node = fresh
        node.final = True
        last = word
    settle(0)
    return root, states


def compile_lexicon(entries: dict[bytes, Sequence[int]]) -> bytes:
    """The block of bytes for words and their ids; the empty word isn't allowed."""
    words = sorted(entries)
    if words and not words[0]:
        raise ValueError("the empty word has no path")
    root, states = _minimal(words)
    order = [root, *reversed(states)]
    place = {id(n): i for i, n in enumerate(order)}
    base, owner, target, output = array("i", [0] * len(order)), array("i"), array("i"), array("i")
    free = 0
    for i, node in enumerate(order):
        if not node.arcs:
            base[i] = 0
            continue
        low = min(node.arcs)
        at = first = max(free - low, 0)
        while True:
            if len(owner) < at + 256:
                grow = at + 256 - len(owner) + 4096
                owner.extend([-1] * grow)
                target.extend([0] * grow)
                output.extend([0] * grow)
            if all(owner[at + b] < 0 for b in node.arcs):
                break
            at += 1
        base[i] = at
        passed = int(node.final)
        for b in sorted(node.arcs):
            child = node.arcs[b]
            owner[at + b], target[at + b], output[at + b] = i, place[id(child)], passed
            passed += child.count
        if at - first > 64:  # the gaps passed over are too crowded to be worth another search
            free = at
        while free < len(owner) and owner[free] >= 0:
            free += 1
    final = array("i", [int(n.final) for n in order])
    if len(owner) < 256:
        owner.extend([-1] * 256), target.extend([0] * 256), output.extend([0] * 256)
    start, ids = array("i", [0]), array("i")
    for w in words:
        ids.extend(entries[w])
        start.append(len(ids))
    parts = [base, final, owner, target, output, start, ids]
    return _MAGIC + struct.pack("<7q", *map(len, parts)) + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Looks words up in a compiled block, in memory or in a memory-mapped file."""

    def __init__(self, block) -> None:
        view = memoryview(block)
        if bytes(view[:8]) != _MAGIC:
            raise ValueError("not a lexicon")
        sizes, at, parts = struct.unpack("<7q", view[8:64]), 64, []
        for n in sizes:
            parts.append(view[at : at + 4 * n].cast("i"))
            at += 4 * n
        self.base, self.final, self.owner, self.target, self.output, self.start, self.ids = parts
        self.size = sizes[5] - 1

    @classmethod
    def map_file(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def rank(self, word: bytes) -> int:
        """The word's place among the words, or -1."""
        state, number = 0, 0
        base, owner, target, output = self.base, self.owner, self.target, self.output
        room = len(owner)
        for b in word:
            arc = base[state] + b
            if arc >= room or owner[arc] != state:
                return -1
            number += output[arc]
            state = target[arc]
        return number if self.final[state] and word else -1

    def get(self, word: bytes) -> list[int] | None:
        n = self.rank(word)
        return None if n < 0 else self.ids[self.start[n] : self.start[n + 1]].tolist()
