"""BPE encoding and decoding with a transducer of frequent words.

The corpus is counted, the ids of its most frequent words (between white space)
are compiled into a minimal acyclic transducer, and tasks map that file into
memory.  Words it lacks are merged pair by pair, exactly.  The transducer only
saves work: ids do not depend on what is in it.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import dropped, map_batches, published, texts, written
from starloom.llm.counting import frequent, written_counts
from starloom.llm.transducer import Compiler, Transducer

#: Words compiled into the transducer, and their greatest length: with that its size is bounded.
LEXICON_WORDS, LEXICON_BYTES = 300_000, 64
#: Words, and pieces of words, whose ids a Python worker remembers.
REMEMBERED = 400_000

_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_SPACES = regex.compile(r"\p{White_Space}+")
#: str.split takes these as white space, the vocabulary's rules don't.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Marks that the patterns make a piece of when they end a word of letters.
_MARKS = frozenset(".,;:!?")
_ID = struct.Struct("<I")
_WORD_END = "</w>"
_NO_MERGE = 1 << 60
#: Bits of a symbol's number in a pair.
_PAIR_BITS = 24


def _byte_characters() -> list[str]:
    """A visible character for every byte: itself where it is visible, else the next free one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a word-end BPE file (lower case, white space dropped)."""

    def __init__(self, content: str):
        data = json.loads(content)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        every = self.ids | self.special
        self.tokens = [""] * (1 + max(every.values(), default=-1))
        for token, i in every.items():
            self.tokens[i] = token
        self._special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._characters = _byte_characters()
        # Merges work on numbers of symbols: a pair of them is one integer.
        numbers: dict[str, int] = {}

        def number(symbol: str) -> int:
            return numbers.setdefault(symbol, len(numbers))

        self._plain, self._ending = ([number(c + end) for c in self._characters] for end in ("", _WORD_END))
        self._pair_ranks, self._merged_to = {}, [0] * len(data["model"]["merges"])
        for (a, b), rank in self.ranks.items():
            self._pair_ranks[number(a) << _PAIR_BITS | number(b)] = rank
            self._merged_to[rank] = number(a + b)
        self._byte_ranks = [[self._pair_ranks.get(a << _PAIR_BITS | b, _NO_MERGE) for b in self._plain] for a in self._plain]
        # A symbol that is no token has no id.
        self._symbol_ids = [_ID.pack(self.ids[symbol]) if symbol in self.ids else b"" for symbol in numbers]
        self._pieces: dict[str, bytes] = {}

    def merged(self, piece: str) -> bytes:
        """Ids of one piece, as of `encoded`: the pair of lowest rank is merged first, of equal ones the leftmost."""
        data = piece.encode()
        if len(data) > 48:
            long = [self._characters[b] for b in data]
            long[-1] += _WORD_END
            return b"".join([_ID.pack(self.ids[p]) for p in self._merged_long(long) if p in self.ids])
        parts = [self._plain[b] for b in data]
        parts[-1] = self._ending[data[-1]]
        rank, merged_to, rows = self._pair_ranks.get, self._merged_to, self._byte_ranks
        ranks = [rows[a][b] for a, b in zip(data, data[1:], strict=False)]
        if ranks:
            ranks[-1] = rank(parts[-2] << _PAIR_BITS | parts[-1], _NO_MERGE)
        while ranks and (best := min(ranks)) != _NO_MERGE:
            at = ranks.index(best)
            new = parts[at] = merged_to[best]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] << _PAIR_BITS | new, _NO_MERGE)
            if at < len(ranks):
                ranks[at] = rank(new << _PAIR_BITS | parts[at + 1], _NO_MERGE)
        return b"".join(map(self._symbol_ids.__getitem__, parts))

    def _merged_long(self, parts: list[str]) -> list[str]:
        """The same merges with a heap, for pieces of any length."""
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (rank := self.ranks.get((parts[i], parts[after[i]]))) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def _piece(self, piece: str) -> bytes:
        """`merged`, remembered."""
        ids = self._pieces.get(piece)
        if ids is None:
            if len(self._pieces) >= REMEMBERED:
                self._pieces.clear()
            ids = self._pieces[piece] = self.merged(piece)
        return ids

    def encoded(self, word: str) -> bytes:
        """Ids of a word without white space, little-endian unsigned 32-bit."""
        if word.isascii():
            # Most words are letters, and perhaps a mark that ends them; the patterns below cut them alike.
            if word.isalpha():
                return self._piece(word.lower())
            if word[-1:] in _MARKS and (letters := word[:-1]).isalpha():
                return self._piece(letters.lower()) + self._piece(word[-1])
        out: list[bytes] = []
        sections = self._special_pattern.split(word) if self._special_pattern and "<" in word else [word]
        for section in sections:
            if section in self.special:
                out.append(_ID.pack(self.special[section]))
            elif section:
                # The vocabulary's lower case looks at single characters: no final sigma.
                lower = section.lower() if section.isascii() else unicodedata.normalize("NFC", section).replace("Σ", "σ").lower()
                out += map(self._piece, (lower,) if lower.isalpha() else _PIECES.findall(lower))
        return b"".join(out)

    def decoded(self, ids: bytes) -> str:
        """Tokens joined by one space, special ones included: the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def words_of(text: str) -> list[str]:
    """Words between white space."""
    return [w for w in _SPACES.split(text) if w] if any(c in text for c in _SEPARATORS) else text.split()


class Codec:
    """Encodes and decodes texts with a vocabulary and a transducer; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self._ids: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _learned(self, word: str) -> bytes:
        found = self._before.get(word)
        if found is None:
            found = self.lexicon.get(word.encode())
        if found is None:
            found = self.vocabulary.encoded(word)
        if len(self._ids) >= REMEMBERED // 2:
            # The words in use come back from the older half.
            self._before, self._ids = self._ids, {}
        self._ids[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32-bit."""
        known, learned = self._ids.get, self._learned
        return b"".join([known(w) or learned(w) for w in words_of(text)])

    def decode(self, ids: bytes) -> str:
        return self.vocabulary.decoded(ids)


@lru_cache(maxsize=2)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


@lru_cache(maxsize=2)
def _codec(content: str, lexicon: str) -> Codec:
    return Codec(_vocabulary(content), Transducer.open(SparkFiles.get(lexicon)))


def lexicon_of(docs: DataFrame, content: str, most: int = LEXICON_WORDS) -> bytes:
    """Compiled transducer of the most frequent words of ``docs`` (at most ``most``), counted over all rows.

    Tasks encode the words and sort them; the driver takes them one partition at a time
    and holds nothing but the automaton.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)
    plain = texts(docs).withColumn("used", F.lit(False))
    # Words between ASCII spaces: some of them may hold other white space, and are then of no use.
    counts = written_counts(plain.where("text <> X''"), bytes.split)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column("word").to_pylist()
        encoded = _vocabulary(shared.value).encoded
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([encoded(w.decode()) for w in words], pa.binary())], ["word", "ids"])

    words = frequent(counts.where(F.length("word") <= LEXICON_BYTES), most).select("word")
    ordered = written(map_batches(words, "word binary, ids binary", work)).orderBy("word")
    compiler = Compiler()
    for row in ordered.toLocalIterator():
        compiler.add(bytes(row["word"]), bytes(row["ids"]))
    dropped(counts)
    return compiler.finish()


def encode_texts(docs: DataFrame, vocabulary_path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (little-endian unsigned 32-bit, one after another) and decoded.

    ``decoded`` is made from the ids.  Null and empty texts have no ids and
    decode to an empty text; rows that repeat a doc_id are encoded one by one; a
    null doc_id is kept.  Other columns are ignored.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        content = file.read()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(content)
    path = published(spark, lexicon_of(docs, content, lexicon_words), ".bin")
    spark.sparkContext.addFile(path)
    lexicon = path.rsplit("/", 1)[1]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared.value, lexicon)
        ids = [codec.encode(t.decode()) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return map_batches(texts(docs), "doc_id long, ids binary, decoded string", work)
