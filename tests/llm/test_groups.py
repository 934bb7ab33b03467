"""Components and groups of near copies against union-find and all pairs."""

import random

import numpy as np

from starloom.llm import near_dedup, substring_dedup
from starloom.llm.common import gram_hashes, hashed_words, span_hashes, written
from starloom.llm.components import components


def united(nodes, edges):
    label = {n: n for n in nodes}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    loose = [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(70)]
    edges = [e if draw.random() < 0.5 else e[::-1] for e in chain + star + loose + [(7, 7)]]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == united(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_files_of_rounds(spark, monkeypatch):
    """A round's result has no file for each shuffle partition, however many there are."""
    files = []

    def counted(df):
        out = written(df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr("starloom.llm.components.written", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    edges = [(i, i + 1) for i in range(300) if i % 50] + [(1000, 1000 + i) for i in range(1, 200)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == united({n for e in edges for n in e}, edges)
    assert len(files) > 2 and max(files[1:]) <= spark.sparkContext.defaultParallelism


def test_groups_of_near_copies(spark):
    """Copies of one text with a few or many changed words: some link with the original only, some with none."""
    draw = random.Random(2)
    texts = []
    for group in range(3):
        base = [f"g{group}w{draw.randrange(10_000)}" for _ in range(150)]
        texts.append(base)
        for copy in range(60):
            words = list(base)
            for place in draw.sample(range(150), draw.choice([0, 1, 2, 3, 4, 4, 5, 6, 9])):
                words[place] = f"c{copy}x{draw.randrange(10_000)}"
            texts.append(words)
    draw.shuffle(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    edges = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == united(range(len(texts)), edges)
    assert len(set(found.values())) > 3


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for _ in range(10):
            both, one, two = (draw.integers(0, 1 << 63, n, np.uint64) for n in (int(1000 * share), int(500 * (1 - share)), int(500 * (1 - share))))
            a, b = (near_dedup.signature(np.concatenate([both, x])) for x in (one, two))
            errors.append((a == b).mean() - len(both) / (len(both) + len(one) + len(two)))
    assert abs(np.mean(errors)) < 0.02
    assert max(map(abs, errors)) < 0.15


def test_equal_windows_have_equal_anchors():
    draw = random.Random(4)
    shared = [f"s{draw.randrange(30)}".encode() for _ in range(40)]
    texts = [[f"t{t}x{draw.randrange(5)}".encode() for _ in range(draw.randrange(30))] + shared + [b"z"] * draw.randrange(30) for t in range(50)]
    texts += [[b"a"] * 30, [b"b"] + [b"a"] * 20 + [b"c"], [b"a", b"b"] * 20, []]
    hashes, starts = hashed_words(texts)
    levels, top = substring_dedup.parsed(hashes, starts)
    at, anchor = substring_dedup.anchors(hashes, starts, levels)
    words = [w for t in texts for w in t]
    seen = {}
    for place, name in zip(at.tolist(), anchor.tolist(), strict=True):
        window = tuple(words[place : place + 13])
        assert seen.setdefault(window, name) == name
    assert top[-1] == 0
    assert len(set(top.tolist())) == len({tuple(t) for t in texts})


def test_span_hashes():
    words = np.arange(1, 40, dtype=np.uint64) % np.uint64(7)
    spans = span_hashes(words)
    first = np.arange(20)
    assert (spans(first, first + 5) == spans(first + 7, first + 12)).all()
    assert len(np.unique(spans(first, first + 5))) == 7
    assert len(np.unique(gram_hashes(words, 3))) == 7


def resembling(draw, count, changes, words=150):
    base = [f"b{draw.randrange(10**9)}" for _ in range(words)]
    out = []
    for copy in range(count):
        text = list(base)
        for place in draw.sample(range(words), changes):
            text[place] = f"c{copy}x{draw.randrange(10**9)}"
        out.append(text)
    return out


def test_large_buckets_of_texts_that_resemble(spark):
    """500 texts of one kind that are not close, and 500 of which many are: all links are found, few pairs are made."""
    draw = random.Random(12)
    texts = [*resembling(draw, 500, 3), *resembling(draw, 500, 2)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    edges, similar = [], []
    for group in (range(500), range(500, 1000)):
        for i in group:
            for j in range(group[0], i):
                both = len(sets[i] & sets[j])
                share = both / (len(sets[i]) + len(sets[j]) - both)
                similar.append(share)
                if share >= 0.75:
                    edges.append((i, j))
    assert sum(0.6 <= s < 0.75 for s in similar) > 100_000
    assert edges
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == united(range(len(texts)), edges)


def test_pairs_of_a_bucket(spark):
    """No pair with a link is left out, each comes once, and nearly all others are."""
    draw = random.Random(13)
    texts = [*resembling(draw, 200, 3), *resembling(draw, 60, 2)]
    sets = [{hash(tuple(w[i : i + 5])) for i in range(len(w) - 4)} for w in texts]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "node long, shingles array<long>")
    rest = spark.createDataFrame([(key, i, len(s), i) for i, s in enumerate(sets) for key in (1, 2, i // 200 + 5)], "key long, node long, n long, label long")
    found = [(r["a"], r["b"]) for r in near_dedup.pairs_across(rest, frame, 75).collect()]
    links = {(j, i) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(found) == len(set(found))
    assert links <= set(found)
    assert len(found) < len(links) + 0.2 * len(sets) ** 2 / 2
