"""Periodic runs of words by online dyadic square catching.

Words are appended to a sequence.  Whenever a block of 2**k words (aligned to a
multiple of its size m) is complete it becomes a catcher: it waits for itself to
come again 2m to 4m words later.  The first half of every square of a period in
that range holds such a block, so none is missed; periods 1 to 3 belong to blocks
of one word.  A catch opens a comparison of the words one period apart.  What lies
before the block is compared at once, what comes behind it with every appended
word, until a word differs: then the stretch is maximal and, if it is two periods
or longer, a run.

Words are appended a stretch at a time, and all catchers of one size look at the
stretch in one numpy step; any way of cutting a text into stretches gives the same
runs.  A catcher is known by a hash of its words, and the comparisons that it opens
are made on the words' hashes themselves.  Of each size only the last five blocks
are kept, so the state is a constant number of words for each word of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from starloom.llm.common import keyed_texts, map_batches, mixed

#: A run has at least so many words.
LEAST_WORDS = 12
#: Words that are appended at a time, and up to which short texts share one sequence.
STRETCH = 1 << 16
#: Words gathered at a time where comparisons go on.
_GATHERED = 1 << 20
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Blocks:
    """Names of the ``size`` words from each position on, from position ``base``."""

    def __init__(self, size: int):
        self.size, self.base, self.names = size, 0, np.empty(0, np.uint64)

    @property
    def end(self) -> int:
        return self.base + len(self.names)

    def add(self, names: np.ndarray) -> None:
        self.names = np.concatenate([self.names, names])

    def trim(self) -> None:
        drop = max(0, len(self.names) - 5 * self.size) // self.size * self.size
        self.names, self.base = self.names[drop:], self.base + drop


class SquareCatcher:
    """The runs of a growing sequence of word hashes, of periods up to ``longest_period``."""

    def __init__(self, longest_period: int | None = None, least_words: int = LEAST_WORDS):
        self.longest_period, self.least_words = longest_period, least_words
        self._buffer, self.n = np.empty(1024, np.uint64), 0
        self._levels: list[_Blocks] = [_Blocks(1)]
        #: Comparisons that have met no difference yet: (start, period).
        self._open: list[tuple[int, int]] = []
        #: (start, end) of the runs that ended, with the smallest period.
        self.runs: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray) -> None:
        """Words that come next."""
        n0, n1 = self.n, self.n + len(words)
        if n1 > len(self._buffer):
            self._buffer = np.concatenate([self._buffer[:n0], np.empty(max(n1, 2 * n0) - n0, np.uint64)])
        self._buffer[n0:n1] = words
        self.n = n1
        followed = self._advance(n0)
        for level, (block, period) in self._catches():
            self._follow(level, block, period, followed)
        for level in self._levels:
            level.trim()

    def finish(self) -> dict[tuple[int, int], int]:
        """The sequence is over: (start, end) to smallest period of all its runs."""
        for low, period in self._open:
            self._ended(low, self.n - period, period)
        self._open = []
        return self.runs

    def _advance(self, n0: int) -> list[tuple[int, int, int]]:
        """Open comparisons go on over the words from ``n0``; gives (start, end of the agreement, period) of each."""
        text, now, followed = self._buffer, [], []
        for low, period in self._open:
            differs = text[n0 - period : self.n - period] != text[n0 : self.n]
            first = int(differs.argmax()) if len(differs) else 0
            if len(differs) and differs[first]:
                high = n0 - period + first
                self._ended(low, high, period)
            else:
                high = self.n - period
                now.append((low, period))
            followed.append((low, high, period))
        self._open = now
        return followed

    def _catches(self) -> Iterator[tuple[_Blocks, tuple[np.ndarray, np.ndarray]]]:
        """For each size of blocks, the blocks that come again in the words just appended, and how far off."""
        k = 0
        while True:
            level = self._levels[k]
            size, old = level.size, level.end
            if size == 1:
                level.add(self._buffer[old : self.n])
            else:
                half = self._levels[k - 1]
                first = half.names[old - half.base : self.n - size + 1 - half.base]
                second = half.names[old + size // 2 - half.base : self.n - size // 2 + 1 - half.base]
                level.add(mixed(first * _LEFT + mixed(second + _RIGHT)))
            x = np.arange(old, level.end)
            blocks, periods = [], []
            for back in (1, 2, 3) if size == 1 else (2, 3):
                block = (x // size - back) * size
                from_ = int(np.searchsorted(block, 0))
                same = from_ + np.flatnonzero(level.names[block[from_:] - level.base] == level.names[x[from_:] - level.base])
                blocks.append(block[same])
                periods.append(x[same] - block[same])
            block, period = np.concatenate(blocks), np.concatenate(periods)
            if self.longest_period is not None:
                fits = period <= self.longest_period
                block, period = block[fits], period[fits]
            if len(block):
                yield level, (block, period)
            k += 1
            size *= 2
            if size > self.n or (self.longest_period is not None and 2 * size > self.longest_period):
                return
            if k == len(self._levels):
                self._levels.append(_Blocks(size))

    def _follow(self, level: _Blocks, block: np.ndarray, period: np.ndarray, followed: list[tuple[int, int, int]]) -> None:
        """Compare what lies around the blocks caught."""
        size, n = level.size, self.n
        known = self._inside_known(block, period, size)
        for low, high, p in followed:
            known |= (period == p) & (block >= low) & (block < high)
        block, period = block[~known], period[~known]
        if not len(block):
            return
        # Neighbouring blocks with one period belong to one stretch, and that ends less than a block further on.
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        new = np.ones(len(block), bool)
        new[1:] = (period[1:] != period[:-1]) | (block[1:] != block[:-1] + size)
        first = np.flatnonzero(new)
        low, high, p = block[first], block[np.append(first[1:], len(block)) - 1] + size, period[first]
        possible = (high - low + 2 * size > np.maximum(p, self.least_words - p)) | (high + size > n - p)
        low, high, p = low[possible], high[possible], p[possible]
        low = low - self._agreement(low - 1, p, np.minimum(low, size), -1)
        high = high + self._agreement(high, p, np.minimum(n - p - high, size), 1)
        goes_on = high == n - p
        self._open += zip(low[goes_on].tolist(), p[goes_on].tolist(), strict=True)
        long = ~goes_on & (high - low >= np.maximum(p, self.least_words - p))
        for a, b, q in zip(low[long].tolist(), high[long].tolist(), p[long].tolist(), strict=True):
            self._ended(a, b, q)

    def _agreement(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``at`` on, in the direction of ``step``, equal those one period later; ``most`` at the most."""
        count, text = np.zeros(len(at), np.int64), self._buffer
        left, width = np.flatnonzero(most > 0), 4
        while len(left):
            still = []
            rows = max(1, _GATHERED // width)
            for i in range(0, len(left), rows):
                part = left[i : i + rows]
                offset = count[part][:, None] + np.arange(width)
                inside = offset < most[part][:, None]
                place = at[part][:, None] + step * np.where(inside, offset, 0)
                differs = (text[place] != text[place + period[part][:, None]]) | ~inside
                first = differs.argmax(1)
                all_same = ~differs[np.arange(len(part)), first]
                count[part] += np.where(all_same, width, first)
                still.append(part[all_same & (count[part] < most[part])])
            left, width = np.concatenate(still), min(4 * width, 1 << 16)
        return count

    def _inside_known(self, block: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        """Catches inside a run whose period divides theirs: they are powers of its squares."""
        known = [(a, b, q) for (a, b), q in self.runs.items()]
        known += [(low, self.n, p) for low, p in self._open if self.n - low >= 2 * p]
        if not known:
            return np.zeros(len(block), bool)
        low, high, q = np.array(sorted(known)).T
        # Of those that start no later the one that reaches furthest; of equal ones the first, which has the smallest period.
        furthest = np.maximum.accumulate(high)
        further = np.append(True, furthest[1:] > furthest[:-1])
        owner = np.maximum.accumulate(np.where(further, np.arange(len(high)), 0))
        at = np.searchsorted(low, block, side="right") - 1
        run = owner[np.maximum(at, 0)]
        return (at >= 0) & (high[run] >= block + period + size) & (period % q[run] == 0)

    def _ended(self, low: int, high: int, period: int) -> None:
        """A stretch whose words equal those one period later from ``low`` up to ``high``."""
        end, text = high + period, self._buffer
        if high - low < max(period, self.least_words - period):
            return
        # A part of a stretch that is the power of a shorter period may have been left out as known.
        if (low and text[low - 1] == text[low - 1 + period]) or (end < self.n and text[end] == text[end - period]):
            return
        self.runs[low, end] = min(period, self.runs.get((low, end), period))


def runs_of(lists: list[list[bytes]], stretch: int = STRETCH, least_words: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    group: list[int] = []
    words = 0

    def settle() -> None:
        if not group:
            return
        catcher = SquareCatcher(max(len(lists[i]) for i in group) // 2, least_words)
        starts, at = [], 0
        parts = []
        for number, i in enumerate(group):
            starts.append(at)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lists[i]), np.uint64, len(lists[i]))
            # A border that occurs once only is part of no square.
            parts += [hashes, mixed(np.full(1, number, np.uint64) ^ _LEFT)]
            at += len(hashes) + 1
        sequence = np.concatenate(parts)
        for i in range(0, len(sequence), stretch):
            catcher.append(sequence[i : i + stretch])
        for (low, end), period in catcher.finish().items():
            number = int(np.searchsorted(starts, low, side="right")) - 1
            found[group[number]].append((low - starts[number], end - low, period))
        group.clear()

    # Texts of like length share a sequence, so that short ones need no large blocks.
    for i in sorted((i for i, x in enumerate(lists) if len(x) >= least_words), key=lambda i: len(lists[i])):
        if words + len(lists[i]) > STRETCH:
            settle()
            words = 0
        group.append(i)
        words += len(lists[i])
    settle()
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(edges[:-1]).tolist(), strict=True) if not inside]


def _found(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = [t.split() for t in batch.column("text").to_pylist()]
    found = runs_of(lists)
    offsets = np.cumsum([0] + [len(runs) for runs in found]).astype(np.int32)
    flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
    runs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], ["start", "length", "period"])
    texts = [b" ".join(collapsed(words, r)).decode() for words, r in zip(lists, found, strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text_key"), pa.array(np.array(list(map(len, lists)), np.int64)), pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(texts, pa.string())],
        ["doc_id", "text_key", "n_words", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """All runs of repeated words in each text, and the text with every run cut to its first period.

    One row per row of ``docs``: doc_id, text_key, n_words, runs (start, length and
    period in words, by start, then period) and collapsed (the words that stay,
    joined by one space).  A run has 12 words or more and at least two periods.
    Null and empty texts have no runs and collapse to an empty text.  Rows that
    repeat a doc_id are handled one by one, a null doc_id is kept.  Other columns
    are ignored.  Nothing is shuffled; a text is held by one task.
    """
    schema = "doc_id long, text_key long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_batches(keyed_texts(docs), schema, _found)
