"""A minimal acyclic transducer from words to outputs, in one flat file that tasks map into memory.

Words that share a beginning share states, and so do words that share an ending:
states with the same continuations are one.  An edge carries how many words come
before those behind it, so the sum along a path is the word's rank, and the rank
is the row of its output.
"""

from __future__ import annotations

import mmap
import struct
from array import array
from collections.abc import Iterable

import numpy as np

_BYTES = [bytes([b]) for b in range(256)]
_HEAD = struct.Struct("<5q")
#: Bytes of a word's beginning whose state a reader remembers, and how many beginnings.
HEAD, MOST_HEADS = 5, 100_000
_UNKNOWN = object()


class Compiler:
    """Builds the automaton from words in ascending order, each given once.

    Only the states along the last word are open; all others are settled into flat
    arrays, and found again through an open-addressed table of their numbers.
    """

    def __init__(self) -> None:
        self._first, self._targets, self._skips = array("i", [0]), array("i"), array("i")
        self._labels, self._final = bytearray(), bytearray()
        #: Words that can be read from each state on.
        self._behind = array("i")
        self._slots, self._mask = array("i", [-1]) * (1 << 10), (1 << 10) - 1
        self._path: list[list] = [[False, bytearray(), array("i")]]
        self._last: bytes | None = None
        self._outputs, self._output_ends = bytearray(), array("i", [0])

    def add(self, word: bytes, output: bytes) -> None:
        """The next word."""
        last = self._last
        if last is not None and word <= last:
            raise ValueError(f"{word!r} does not come after {last!r}")
        shared = 0
        for a, b in zip(word, last or b"", strict=False):
            if a != b:
                break
            shared += 1
        self._settle_below(shared)
        self._path.extend([False, bytearray(), array("i")] for _ in word[shared:])
        self._path[-1][0] = True
        self._last = word
        self._outputs += output
        self._output_ends.append(len(self._outputs))

    def finish(self) -> bytes:
        """The file of the automaton."""
        self._settle_below(0)
        root = self._settled(self._path[0])
        numbers = b"".join(np.frombuffer(x, np.intc).astype("<i4").tobytes() for x in (self._first, self._targets, self._skips, self._output_ends) if len(x))
        head = _HEAD.pack(len(self._final), len(self._targets), len(self._output_ends) - 1, root, len(numbers))
        return b"".join([head, numbers, self._labels, self._final, self._outputs])

    def _settle_below(self, depth: int) -> None:
        path = self._path
        while len(path) > depth + 1:
            target = self._settled(path.pop())
            path[-1][1].append(self._last[len(path) - 1])
            path[-1][2].append(target)

    def _settled(self, state: list) -> int:
        """Number of the state with these continuations, a new one if there is none yet."""
        final, labels, targets = state
        slot = hash((final, bytes(labels), targets.tobytes())) & self._mask
        while (number := self._slots[slot]) >= 0:
            a, b = self._first[number], self._first[number + 1]
            if self._final[number] == final and self._labels[a:b] == labels and self._targets[a:b] == targets:
                return number
            slot = (slot + 1) & self._mask
        number = self._slots[slot] = len(self._final)
        before = int(final)
        for target in targets:
            self._skips.append(before)
            before += self._behind[target]
        self._labels += labels
        self._targets += targets
        self._first.append(len(self._targets))
        self._final.append(final)
        self._behind.append(before)
        if 2 * len(self._final) > self._mask:
            self._grow()
        return number

    def _grow(self) -> None:
        self._mask = 2 * self._mask + 1
        self._slots = array("i", [-1]) * (self._mask + 1)
        for number, final in enumerate(self._final):
            a, b = self._first[number], self._first[number + 1]
            slot = hash((bool(final), bytes(self._labels[a:b]), self._targets[a:b].tobytes())) & self._mask
            while self._slots[slot] >= 0:
                slot = (slot + 1) & self._mask
            self._slots[slot] = number


def compiled(entries: Iterable[tuple[bytes, bytes]]) -> bytes:
    """The file of the automaton; ``entries`` are (word, output), words distinct and few enough to be sorted here."""
    compiler = Compiler()
    for word, output in sorted(entries):
        compiler.add(word, output)
    return compiler.finish()


class Transducer:
    """Reads a compiled automaton from a buffer."""

    def __init__(self, buffer):
        states, edges, words, self._root, size = _HEAD.unpack_from(buffer)
        numbers = memoryview(buffer)[_HEAD.size : _HEAD.size + size].cast("i")
        self._first, numbers = numbers[: states + 1], numbers[states + 1 :]
        self._target, numbers = numbers[:edges], numbers[edges:]
        self._skip, self._output = numbers[:edges], numbers[edges:]
        self._buffer, self._labels = buffer, _HEAD.size + size
        self._final = self._labels + edges
        self._outputs = self._final + states
        self.states, self.words = states, words
        self._heads: dict[bytes, tuple[int, int] | None] = {}

    @classmethod
    def open(cls, path: str) -> Transducer:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def _step(self, state: int, rank: int, byte: int) -> tuple[int, int] | None:
        """The state behind one byte, and the words that come before it."""
        labels = self._labels
        edge = self._buffer.find(_BYTES[byte], labels + self._first[state], labels + self._first[state + 1])
        if edge < 0:
            return None
        return self._target[edge - labels], rank + self._skip[edge - labels]

    def _walked(self, head: bytes) -> tuple[int, int] | None:
        """State and rank behind the beginning of a word; remembered, as words share few beginnings."""
        at: tuple[int, int] | None = (self._root, 0)
        for byte in head:
            if (at := self._step(*at, byte)) is None:
                break
        if len(self._heads) >= MOST_HEADS:
            self._heads.clear()
        self._heads[head] = at
        return at

    def get(self, word: bytes) -> bytes | None:
        """The output of the word, None if the automaton doesn't have it."""
        head = word[:HEAD]
        at = self._heads.get(head, _UNKNOWN)
        if at is _UNKNOWN:
            at = self._walked(head)
        if at is None:
            return None
        state, rank = at
        first, labels, find = self._first, self._labels, self._buffer.find
        for byte in word[HEAD:]:
            edge = find(_BYTES[byte], labels + first[state], labels + first[state + 1])
            if edge < 0:
                return None
            edge -= labels
            rank += self._skip[edge]
            state = self._target[edge]
        if not self._buffer[self._final + state]:
            return None
        return self._buffer[self._outputs + self._output[rank] : self._outputs + self._output[rank + 1]]
