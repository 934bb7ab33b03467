"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    bpe, decontamination, language_model, lexical_search, licenses, near_dedup, pages, periodic_runs, quality, rules, secrets, simhash, substring_dedup,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_matches(_table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = secrets.secret_spans(_table(spark, folder, "documents"))

    def joined(found: Column) -> Column:
        return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "network")
    return spans.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        _sha256(joined(base)).alias("base_sha256"), joined(F.col("spans")).alias("spans"), of("network").alias("n_network"),
    )


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels")).drop("text_key")


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_texts(_table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), _sha256(F.concat_ws(",", "item_ids")).alias("items_sha256"), "contaminated",
    )


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_texts(_table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))
    return coded_digests(coded)


def coded_digests(coded: DataFrame) -> DataFrame:
    """The digest columns of encoded texts."""
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), _sha256(F.col("decoded")).alias("decoded_sha256"))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, folder, "documents")).drop("text_key")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.without_repeats(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.coalesce(_sha256(F.col("kept_text")), F.col("whole_sha256")).alias("kept_sha256"))


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_text(_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by the crc32 of its id repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    # Ten times the stretch reach the end of the text, as it is longer than a tenth of what is left.
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), 10)), F.lit(1), (n - a).cast("int"))
    repeated = F.concat(F.slice(words, F.lit(1), a.cast("int")), again)
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(_table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.less")).alias("period"),
        F.expr("(1000 * best.length) div (-best.less)").alias("exponent_milli"), _sha256(listed).alias("runs_sha256"), _sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.fingerprint_groups(_table(spark, folder, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_secret_scan, op3_quality_classifier, op4_language_model, op5_decontamination,
        op6_bpe, op7_near_dedup, op8_quality_rules, op9_substring_dedup, op10_html_text, op11_periodic_runs, op12_simhash, op13_lexical_search,
    )
}
