"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A document's fingerprint has 64 bits: each is the majority of that bit over the
64-bit hashes of its 3-word shingles.  Two fingerprints are linked if they differ
in two bits at most.

The fingerprint is cut into three segments.  Two errors leave at least one of them
as it was, and put no more than two into any other, so a key is one whole segment
together with a fuzzy hash of the next one.  The fuzzy hash comes from the perfect
Golay code of length 23, which decodes every vector to the one codeword at most
three bits away: a segment's hashes are the codewords of all vectors one bit away
or less, one or six of them.  Two segments that differ in two bits have a vector
between them and so a codeword in common.

Equal fingerprints are one node, and only keys of several nodes are joined.  In a
key with few nodes they meet each other and are verified.  Nodes of keys with many
are linked without pairs: each node stands for all vectors one bit away or less,
and nodes that share such a vector are two bits apart or less, all of them, so
each is linked with the first.  That is exact too and grows with the nodes.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import keyed_texts, map_batches, written
from starloom.llm.components import components

SHINGLE, SEED = 3, 42
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Nodes of one key that are compared with each other.
PAIRED = 32

#: Generator polynomial of the Golay code, by its binary coefficients.
_GENERATOR, _LENGTH, _CHECKS = 0b110001110101, 23, 11


def _remainders() -> np.ndarray:
    """Remainder of each single bit by the generator."""
    out, value = [], 1
    for _ in range(_LENGTH):
        out.append(value)
        value <<= 1
        if value >> _CHECKS:
            value ^= _GENERATOR
    return np.array(out, np.uint32)


def _leaders(remainders: np.ndarray) -> np.ndarray:
    """The error of three bits or less that leaves each remainder."""
    out = np.zeros(1 << _CHECKS, np.uint32)
    for errors in range(1, 4):
        for bits in itertools.combinations(range(_LENGTH), errors):
            out[np.bitwise_xor.reduce(remainders[list(bits)])] = sum(1 << b for b in bits)
    return out


_BIT_REMAINDERS = _remainders()
_ERRORS = _leaders(_BIT_REMAINDERS)


def decoded(vectors: np.ndarray) -> np.ndarray:
    """Number of the codeword nearest to each vector of 23 bits."""
    left = np.zeros_like(vectors)
    for bit in range(_LENGTH):
        left ^= np.where((vectors >> np.uint32(bit)) & np.uint32(1), _BIT_REMAINDERS[bit], np.uint32(0))
    return (vectors ^ _ERRORS[left]) >> np.uint32(_CHECKS)


def fuzzy_hashes(segments: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash): the distinct codeword numbers of all vectors one bit away or less from each segment of ``width`` bits."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    near = np.sort(decoded(segments.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    row, column = np.nonzero(new)
    return row, near[row, column]


def keys_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): all keys of each fingerprint."""
    rows, keys = [], []
    parts = [(fingerprints >> np.uint64(first)) & np.uint64((1 << width) - 1) for first, width in SEGMENTS]
    for number, whole in enumerate(parts):
        other = (number + 1) % len(SEGMENTS)
        row, fuzzy = fuzzy_hashes(parts[other], SEGMENTS[other][1])
        rows.append(row)
        keys.append((np.uint64(number) << np.uint64(60)) | (whole[row] << np.uint64(12)) | fuzzy.astype(np.uint64))
    return np.concatenate(rows), np.concatenate(keys)


def shingle_hashes(text: bytes) -> np.ndarray:
    """Hashes of the 3-word shingles of a text, repeats included; of fewer words the hash of all of them."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    hash_of = xxhash.xxh64_intdigest
    return np.fromiter((hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=False)), np.uint64, len(words) - SHINGLE + 1)


def fingerprints_of(lists: list[np.ndarray]) -> np.ndarray:
    """The majority of each bit over each list of hashes; zero for an empty list."""
    sizes = np.array(list(map(len, lists)), np.int64)
    counts = np.zeros((len(lists), 64), np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        hashes = np.concatenate([lists[i] for i in filled])
        ends = np.cumsum(sizes[filled])
        # Eight counters lie side by side in a long: no more than 255 are added up at a time.
        cuts = np.concatenate([np.arange(a, b, 255) for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)])
        owner = filled[np.searchsorted(ends, cuts, side="right")]
        ones = np.uint64(0x0101010101010101)
        for bit in range(8):
            sums = np.add.reduceat((hashes >> np.uint64(bit)) & ones, cuts)
            np.add.at(counts[:, bit::8], owner, sums.view(np.uint8).reshape(-1, 8))
    bits = (2 * counts > sizes[:, None]).astype(np.uint64)
    return np.bitwise_or.reduce(bits << np.arange(64, dtype=np.uint64), axis=1)


def _fingerprinted(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = fingerprints_of([shingle_hashes(t) for t in batch.column("text").to_pylist()])
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(prints.view(np.int64))], ["doc_id", "text_key", "fingerprint"])


def _keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
    node = batch.column("node").to_numpy()
    row, key = keys_of(node.view(np.uint64))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node[row])], ["key", "node"])


def _close(nodes: DataFrame, paired: int) -> DataFrame:
    """Links (a, b) between the fingerprints ``node`` that differ in two bits at most: all of them, or enough to connect their ends; a link may repeat."""
    keys = map_batches(nodes, "key long, node long", _keyed)
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(keys.join(sizes, "key"))
    few = members.where(F.col("n") <= paired).select("key", "node")
    pairs = few.join(few.withColumnRenamed("node", "other"), "key").where("node < other AND bit_count(node ^ other) <= 2").select(F.col("node").alias("a"), F.col("other").alias("b"))
    many = members.where(F.col("n") > paired).select("node").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    around = many.select("node", F.explode(flips).alias("flip")).select("node", F.col("node").bitwiseXOR(F.col("flip")).alias("vector"))
    first = around.groupBy("vector").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("vector", "first")
    stars = around.join(first, "vector").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    return pairs.unionByName(stars)


def fingerprint_groups(docs: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Components of documents whose fingerprints differ in two bits or less.

    One row per row of ``docs``: doc_id, text_key, fingerprint (a long with the 64
    bits) and component_id, the smallest doc_id that can be reached.  A text of
    fewer than three words is one shingle; null and empty texts have the
    fingerprint zero, which links like any other.  Rows that repeat a doc_id are
    handled one by one.  A row without doc_id links others but names no
    component: it has the component_id of those it is linked with, null if none
    of them has one.  Other columns are ignored.
    """
    prints = written(map_batches(keyed_texts(docs), "doc_id long, text_key long, fingerprint long", _fingerprinted))
    nodes = written(prints.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("smallest")))
    label = components(_close(nodes.select("node"), paired))
    labelled = nodes.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("smallest").alias("component_id"))
    named = labelled.join(smallest, "label").select(F.col("node").alias("fingerprint"), "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "text_key", "fingerprint", "component_id")
