"""The pipeline against its stages' results taken one by one, and against brute force where a stage allows it."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import decontamination, near_dedup, quality, secrets

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rejected = {r["doc_id"] for r in quality.score_quality(docs, labels).where("predicted = 0").collect()}
    kept = {i: t for i, t in texts.items() if i not in rejected}
    sets = {i: shingles(t) for i, t in kept.items()}
    label = {i: i for i in kept}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in kept:
        for j in kept:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                label[b] = a
    kept = {i: t for i, t in kept.items() if top(i) == i}
    left = docs.where(docs["doc_id"].isin(list(kept)))
    bad = {r["doc_id"] for r in decontamination.contamination(left, benchmark).where("contaminated").collect()}
    left = left.where(~left["doc_id"].isin([*bad, -1]))
    clean = {r["doc_id"]: r["text"] for r in secrets.without_secrets(left).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    result = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(result) == set(clean)
    assert rejected
    assert len(kept) < len(texts) - len(rejected)
    for i, text in clean.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert result[i]["n_tokens"] == len(ids)
        assert result[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("*", "1 AS score", "'x' AS kept")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, FOLDER).columns == docs.columns


def test_one_of_each_component(spark):
    docs = spark.createDataFrame([(2, "a b c d e f"), (1, "A b c d e f"), (3, "other"), (4, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_dedup.one_of_each(docs).collect()) == [1, 3, 4]
