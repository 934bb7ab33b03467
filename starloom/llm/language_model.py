"""Language-model scores by a subword lattice.

The pieces of an existing vocabulary weigh all segmentations of a word: a
forward recursion in log space adds up every path through the word's lattice,
which gives its marginal probability.  Words counted in the training documents
share the probability mass with the lattice as Witten and Bell do it: a word
that occurs c times among N tokens of V kinds has (c + V * lattice) / (N + V).

The vocabulary's file has merge ranks, not probabilities; a piece of rank r
weighs 1 / (r + 2.7) (Zipf-Mandelbrot).  Pieces that begin a word and pieces
inside a word are normalised apart, and a word ends after a piece with an even
chance, so the lattice is a distribution over words.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import dropped, held_out, map_batches, texts, written
from starloom.llm.counting import frequent, written_counts

#: Words whose scores every task holds; all others are joined.
FREQUENT_WORDS = 100_000
_RANK_SHIFT, _BYTE_RANK = 2.7, 1 << 16
_LOG_END = math.log(0.5)
_START = "▁"


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.lower().split()


class Lattice:
    """Log weights of pieces, and the marginal log probability of a word."""

    def __init__(self, pieces: list[tuple[str, int]]):
        """``pieces``: (piece, rank); pieces that begin a word start with U+2581."""
        weights = {p: 1 / (r + _RANK_SHIFT) for p, r in pieces if p}
        byte = 1 / (_BYTE_RANK + _RANK_SHIFT)
        begin = sum(w for p, w in weights.items() if p[0] == _START)
        inside = sum(w for p, w in weights.items() if p[0] != _START) + 256 * byte
        # A word start of its own keeps every word reachable.
        weights.setdefault(_START, byte)
        begin += byte
        self.weights = {p: math.log(w / (begin if p[0] == _START else inside)) for p, w in weights.items()}
        self.byte = math.log(byte / inside)
        self.longest = max(map(len, self.weights))

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the sum over all segmentations."""
        text = _START + word
        get, exp, longest = self.weights.get, math.exp, self.longest
        forward = [0.0]
        for end in range(1, len(text) + 1):
            terms = []
            for start in range(max(0, end - longest), end):
                if (weight := get(text[start:end])) is not None and (start == 0 or text[start] != _START):
                    terms.append(forward[start] + weight)
            if end > 1:
                # Bytes stand for a character that no piece has, and cost more than any piece.
                size = len(text[end - 1].encode())
                terms.append(forward[end - 1] + size * self.byte)
            most = max(terms)
            forward.append(most + math.log(sum([exp(t - most) for t in terms])) + (_LOG_END if end < len(text) else 0.0))
        return forward[-1] + _LOG_END


def pieces_of(model_path: str) -> list[tuple[str, int]]:
    """(piece, rank) of a sentencepiece file, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    order = sorted(plain, key=lambda i: (-model.get_score(i), i))
    return [(model.id_to_piece(i), rank) for rank, i in enumerate(order)]


def score_texts(docs: DataFrame, model_path: str, modulus: int = 7, remainder: int = 2, frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """Log10 probabilities of each text, counting words in the rows that are not held out.

    One row per row of ``docs``: doc_id, held_out (crc32 of the id as text has
    the remainder), n_tokens (words and one end), n_known (tokens that occur in
    training texts), train_tokens, base_score (add-one counts) and score (the
    lattice model).  Null and empty texts are one end.  Without training rows
    base_score rests on one unseen kind and score on the lattice alone.  Rows
    that repeat a doc_id count and are scored one by one; a null doc_id is not
    held out.

    Tasks hold the scores of at most ``frequent_words`` words; the words beyond
    them meet their counts in a join.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("held_out", held_out("doc_id", modulus, remainder)).withColumn("used", ~F.col("held_out"))
    counts = written_counts(rows, words_of)
    sums = counts.agg(F.sum("n_used").alias("n"), F.count(F.when(F.col("n_used") > 0, 1)).alias("v")).first()
    ends = rows.agg(F.count(F.when(F.col("used"), 1)).alias("n")).first()["n"]
    total, kinds = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    share = (ends + 1) / (total + 2)  # of ends among tokens, for the part the lattice has
    lattice = spark.sparkContext.broadcast(Lattice(pieces_of(model_path)))
    base_floor = math.log10(total + kinds + 1)

    def model(count: int, log_word: float) -> float:
        """log10 of (count + V * backoff) / (N + V); the backoff may underflow."""
        if count:
            return math.log10(count + kinds * math.exp(log_word)) - math.log10(total + kinds)
        return (log_word + (math.log(kinds) - math.log(total + kinds) if kinds else 0.0)) / math.log(10)

    log_word_share = math.log1p(-share)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, used = batch.column("word").to_pylist(), batch.column("n_used").to_pylist()
        own = [model(c, log_word_share + lattice.value.log_probability(w.decode(errors="replace"))) for w, c in zip(words, used, strict=True)]
        base = [math.log10(c + 1) - base_floor for c in used]
        return pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n_all"), pa.array([c > 0 for c in used]), pa.array(base, pa.float64()), pa.array(own, pa.float64())], ["word", "n_all", "known", "base", "own"])

    table = written(map_batches(counts, "word binary, n_all long, known boolean, base double, own double", scored))
    common = frequent(table, frequent_words).select("word", "known", "base", "own").collect()
    held = spark.sparkContext.broadcast({bytes(r["word"]): (r["known"], r["base"], r["own"]) for r in common})
    end = (ends > 0, math.log10(ends + 1) - base_floor, model(ends, math.log(share)))

    def summed(batch: pa.RecordBatch) -> pa.RecordBatch:
        find = held.value.get
        columns = [[], [], [], [], []]
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            known, base, own, rare = int(end[0]), [end[1]], [end[2]], []
            for word, n in Counter(words).items():
                if (entry := find(word)) is None:
                    rare.append((word, n))
                else:
                    known += n * entry[0]
                    base.append(n * entry[1])
                    own.append(n * entry[2])
            for column, value in zip(columns, (len(words) + 1, known, math.fsum(base), math.fsum(own), rare), strict=True):
                column.append(value)
        kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        rare = pa.array([[{"word": w, "n": n} for w, n in r] for r in columns[4]], kind)
        arrays = [pa.array(c, t) for c, t in zip(columns[:4], (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *arrays, rare], ["doc_id", "held_out", "n_tokens", "n_known", "base", "own", "rare"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, own double, rare array<struct<word: binary, n: long>>"
    parts = written(map_batches(rows.drop("used"), schema, summed).withColumn("row", F.monotonically_increasing_id()))
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    more = (
        rare.join(table.select("word", "known", F.col("base").alias("b"), F.col("own").alias("o")), "word")
        .groupBy("row").agg(F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("k"), F.sum(F.col("n") * F.col("b")).alias("b"), F.sum(F.col("n") * F.col("o")).alias("o"))
    )
    more = written(more)
    dropped(table, counts)
    zero = F.lit(0)
    return parts.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", zero)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"), (F.col("own") + F.coalesce("o", zero)).alias("score"),
    )
