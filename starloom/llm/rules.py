"""Quality rules whose cut-offs have a bounded risk of rejecting good documents.

Each rule rejects a document whose measure lies above a cut-off.  The cut-offs of all
rules stand in one fixed order, every rule's loosest first, then every rule's next one.
On documents labelled good, the number that the first cut-offs together reject is
binomial; they are safe for a stratum if as few rejections as observed would have a
probability of at most ``delta / strata`` were the true rate of false rejections
``alpha`` (exact binomial tail).  Every stratum goes along the order up to the first
step that is not safe: tests in a fixed order need no correction among themselves,
Bonferroni covers the strata.  So with probability ``1 - delta`` no stratum loses more
than ``alpha`` of its good documents.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Highest rate of good documents rejected in a stratum, and the probability that the bound fails.
ALPHA, DELTA = 0.03, 0.05
#: Rules (measure, cut-offs from strict to loose).  Parameters of the method, not fitted to any table.
RULES = {
    "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.5, 1.0),
    "capitals_share": (0.1, 0.15, 0.2, 0.3, 0.5, 0.8),
    "marks_per_word": (0.02, 0.05, 0.1, 0.2, 0.5, 1.0),
    "repeated_words_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4),
    "repeated_lines_share": (0.1, 0.2, 0.3, 0.5, 0.7),
    "doubled_words_share": (0.005, 0.01, 0.02, 0.05, 0.1, 0.3),
}
#: All cut-offs in the order of their tests: the loosest of every rule, then the next ones.
PATH = [(rule, cuts[-1 - i]) for i in range(max(map(len, RULES.values()))) for rule, cuts in RULES.items() if i < len(cuts)]
_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and what the rules need."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), text.alias("text"),
        F.filter(F.split(text, _SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.translate(line, " \t\x0b\f\r", "") != "").alias("lines"),
    )
    rows = rows.select("*", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    count = F.greatest(F.col("n") - 2, F.lit(0))
    triples = F.zip_with(
        F.slice("h", 1, count), F.zip_with(F.slice("h", 2, count), F.slice("h", 3, count), lambda b, c: F.struct(b.alias("b"), c.alias("c"))), lambda a, s: F.xxhash64(a, s["b"], s["c"])
    )
    doubled = F.size(F.filter(F.zip_with(F.slice("h", 1, F.greatest(F.col("n") - 1, F.lit(0))), F.slice("h", 2, F.greatest(F.col("n") - 1, F.lit(0))), lambda a, b: a == b), lambda x: x))
    rows = rows.select("*", triples.alias("triples"), doubled.alias("doubled"))
    # Windows that occur twice stand side by side in order of their hash.
    placed = F.sort_array(F.transform("triples", lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
    rows = rows.select("*", F.when(F.size(F.array_distinct("triples")) < F.size("triples"), placed).alias("placed"))
    last = F.size("placed") - 1
    pairs = F.zip_with(F.slice("placed", 1, last), F.slice("placed", 2, last), lambda a, b: F.when(a["t"] == b["t"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
    repeated = F.when(F.col("placed").isNotNull(), F.size(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))).otherwise(0)
    long = lambda c: c.cast("long")
    return rows.select(
        "doc_id", "stratum", long(F.col("n")).alias("n_words"), long(F.length(F.translate("text", " \t\n\x0b\f\r", ""))).alias("word_chars"),
        long(_without(F.col("text"), "#*$%&|<>")).alias("n_symbols"), long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), long(repeated).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"), long(_without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_capitals"), long(_without(F.col("text"), "!")).alias("n_marks"), long(F.col("doubled")).alias("n_doubled"),
    )


def _measures() -> dict[str, Column]:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbols_per_word": share("n_symbols", "n_words"), "capitals_share": share("n_capitals", "word_chars"), "marks_per_word": share("n_marks", "n_words"),
        "repeated_words_share": share("n_repeat_words", "n_words"), "repeated_lines_share": share("n_dup_lines", "n_lines"), "doubled_words_share": share("n_doubled", "n_words"),
    }


def _first_step() -> Column:
    """The first step of the path whose cut-off rejects a document; the number of steps if none does."""
    values = _measures()
    return F.coalesce(*[F.when(values[rule] > cut, F.lit(i)) for i, (rule, cut) in enumerate(PATH)], F.lit(len(PATH)))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) of a binomial X; 1 where k is not below its mean.  Terms are added up from 0 on, each from the one before."""
    odds = math.log(rate / (1 - rate))
    state = lambda term, total: F.struct(term.alias("term"), total.alias("total"))
    first = n * math.log1p(-rate)

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log(n - i + 1) - F.log(i) + odds
        return state(term, s["total"] + F.exp(term))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("double").cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k < n * rate, F.aggregate(steps, state(first, F.exp(first)), step, lambda s: s["total"])).otherwise(1.0)


def cutoffs(measures: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one column per rule): the strictest safe cut-off, null where none is.

    ``labels`` has doc_id and quality; a document with a label 1 is good unless it also has another label.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = measures.join(good, "doc_id", "left_semi").where("NOT base_failed").withColumn("step", _first_step())
    counts = [F.count(F.when(F.col("step") <= i, 1)).alias(f"k_{i}") for i in range(len(PATH))]
    counted = written(held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *counts))
    strata = counted.count()
    unsafe = [F.when(binomial_tail(F.col(f"k_{i}"), F.col("n"), alpha) * strata > delta, F.lit(i)) for i in range(len(PATH))]
    reached = counted.select("stratum", F.coalesce(*unsafe, F.lit(len(PATH))).alias("safe"))
    strictest = {rule: F.coalesce(*[F.when(F.col("safe") > PATH.index((rule, cut)), F.lit(cut)) for cut in cuts]) for rule, cuts in RULES.items()}
    return reached.select("stratum", *[c.alias(f"cut_{rule}") for rule, c in strictest.items()])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: its counts, base_failed and kept.

    base_failed: fewer than 50 words, or more than half of the words in windows
    of three that occur twice.  kept: not base_failed and below every cut-off of
    its language (null: a stratum of its own).  Null and empty texts have no words
    and fail.  A stratum without enough good labels has no cut-offs.  Rows that
    repeat a doc_id are judged one by one, and each counts as labelled.  A null
    doc_id is kept in the result and has no label.  Other columns are ignored.
    """
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    measures = written(measured(docs).withColumn("base_failed", failed))
    chosen = written(cutoffs(measures, labels, alpha, delta))
    values = _measures()
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(values[rule] > F.col(f"cut_{rule}"), F.lit(False))
    return measures.join(chosen, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~over).alias("kept"),
    )
