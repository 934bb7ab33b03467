"""Cut-offs with a bounded risk: exact tails, power on the given labels, and the bound in simulation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.llm import rules

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_doubled")


def tail(k, n, rate):
    return sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(0, 1), (0, 98), (0, 99), (3, 400), (20, 2000), (5, 60), (1, 1)]
    found = spark.createDataFrame(cases, "k long, n long").select("k", "n", rules.binomial_tail(F.col("k"), F.col("n"), 0.03).alias("p")).collect()
    for row in found:
        expected = tail(row["k"], row["n"], 0.03) if row["k"] < row["n"] * 0.03 else 1.0
        assert row["p"] == pytest.approx(expected, rel=1e-9)


def measures_of(spark, strata):
    """One document per given number of symbols among 100 words."""
    rows = [(i, name, symbols) for i, (name, symbols) in enumerate((name, s) for name, many in strata.items() for s in many)]
    made = spark.createDataFrame(rows, "doc_id long, stratum string, n_symbols long")
    made = made.select("doc_id", "stratum", *[(F.lit({"n_words": 100, "word_chars": 500, "n_lines": 1}.get(c, 0)) if c != "n_symbols" else F.col(c)).cast("long").alias(c) for c in COUNTS])
    return made.withColumn("base_failed", F.lit(False)), made.select("doc_id", F.lit(1).alias("quality"))


def plain_safe(symbols, strata):
    """Steps of the path that are safe, one after another."""
    for i, _ in enumerate(rules.PATH):
        cuts = [cut for rule, cut in rules.PATH[: i + 1] if rule == "symbols_per_word"]
        k, n = sum(any(s / 100 > c for c in cuts) for s in symbols), len(symbols)
        if k >= n * rules.ALPHA or tail(k, n, rules.ALPHA) * strata > rules.DELTA:
            return i
    return len(rules.PATH)


def test_cutoffs_against_plain_tests(spark):
    draw = random.Random(5)
    strata = {"clean": [0] * 200, "few": [0] * 50, "mixed": [draw.choice([0] * 60 + [30, 60, 3]) for _ in range(900)], "noisy": [15] * 300}
    found = {r["stratum"]: r for r in rules.cutoffs(*measures_of(spark, strata)).collect()}
    for name, symbols in strata.items():
        safe = plain_safe(symbols, len(strata))
        for rule, cuts in rules.RULES.items():
            reached = [cut for cut in cuts if rules.PATH.index((rule, cut)) < safe]
            assert found[name][f"cut_{rule}"] == (min(reached) if reached else None)
    assert found["clean"]["cut_symbols_per_word"] == 0.02 and found["few"]["cut_symbols_per_word"] is None


def test_risk_is_held(spark):
    """Strata whose true rate at the strictest cut-off is just over the risk: it is chosen in about delta of them at most."""
    draw = random.Random(11)
    strata = {f"s{i:03}": [3 if draw.random() < 0.031 else 0 for _ in range(150)] for i in range(200)}
    measures, labels = measures_of(spark, strata)
    chosen = rules.cutoffs(measures, labels, delta=0.05 * len(strata)).where("cut_symbols_per_word <= 0.02").count()
    assert chosen <= 0.05 * len(strata) + 3 * math.sqrt(len(strata) * 0.05 * 0.95)


def test_given_labels_have_cutoffs(spark):
    folder = "/root/testdata/sf0.01"
    found = rules.judge(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert found.where("NOT base_failed AND NOT kept").count() > 0
