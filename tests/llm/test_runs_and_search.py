"""Periodic runs, fingerprints with their links, and ranked search against brute force."""

import random

import numpy as np
import pytest
import xxhash

from starloom.llm import common, lexical_search, periodic_runs, simhash


def plain_runs(words, least=12):
    """Every stretch of every period, word by word."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j - i >= max(period, least - period):
                found.setdefault((i, j + period), period)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.fixture(scope="module")
def sequences():
    draw = random.Random(11)
    out = [[], [1], [1] * 11, [1] * 12, [1] * 300, [1] * 90 + [2] + [1] * 90, ([1, 2] * 20 + [3]) * 6, ([1, 2] * 20 + [1]) * 6, thue_morse(700), fibonacci(500), fibonacci(130) * 3]
    for _ in range(250):
        few, n = draw.choice([1, 2, 3, 5]), draw.randrange(160)
        words = [draw.randrange(few) for _ in range(n)]
        if n > 10 and draw.random() < 0.5:
            a, p = draw.randrange(n), draw.randrange(1, 30)
            words = words[:a] + [words[min(n - 1, a + i % p)] for i in range(draw.randrange(150))] + words[a:]
        out.append(words)
    return [[b"%d" % w for w in words] for words in out]


def test_runs_are_those_of_brute_force(sequences):
    assert periodic_runs.runs_of(sequences) == [plain_runs(w) for w in sequences]
    assert periodic_runs.runs_of(sequences, least_words=2) == [plain_runs(w, 2) for w in sequences]


@pytest.mark.parametrize("stretch", [1, 7, 64])
def test_runs_do_not_depend_on_how_words_are_appended(sequences, stretch):
    some = sequences[:11] + sequences[11::25]
    if stretch == 1:
        some = [w[:150] for w in some]
    assert periodic_runs.runs_of(some, stretch) == [plain_runs(w) for w in some]


def test_runs_end_as_words_are_appended():
    """A run is known as soon as the word that ends it is appended."""
    catcher = periodic_runs.SquareCatcher()
    words = np.array([5, 6, 7] * 6 + [9], np.uint64)
    for i, word in enumerate(words):
        assert catcher.runs == {}
        catcher.append(words[i : i + 1])
        assert len(catcher._open) == (i >= 3 and word != 9) + (i >= 6 and word != 9) * 0 or i < 19
    assert catcher.runs == {(0, 18): 3}


def test_state_is_bounded():
    catcher = periodic_runs.SquareCatcher()
    draw = np.random.default_rng(1)
    for _ in range(16):
        catcher.append(draw.integers(0, 1 << 60, 4096, np.uint64))
    assert sum(len(level.names) for level in catcher._levels if level.size <= 4096) <= 8 * 6 * 4096
    assert catcher.finish() == {}


def test_a_long_text_of_one_word():
    assert periodic_runs.runs_of([[b"a"] * 200_000 + [b"b"]]) == [[(0, 200_000, 1)]]


def test_collapsed_keeps_first_periods():
    words = [b"x", *[b"a", b"b", b"c"] * 5, b"y"]
    assert periodic_runs.collapsed(words, periodic_runs.runs_of([words])[0]) == [b"x", b"a", b"b", b"c", b"y"]


def test_golay_code():
    vectors = np.arange(1 << 12, dtype=np.uint32) * np.uint32(2047 * 7 + 1) & np.uint32((1 << 23) - 1)
    number = simhash.decoded(vectors)
    assert number.max() < 1 << 12
    words = {}
    every = np.arange(1 << 23, dtype=np.uint32)
    codes = simhash.decoded(every)
    assert (np.bincount(codes, minlength=1 << 12) == 1 << 11).all()
    for v, c in zip(vectors.tolist(), number.tolist(), strict=True):
        words.setdefault(c, []).append(v)
    assert all(bin(a ^ b).count("1") <= 6 for group in words.values() for a in group for b in group)


def test_segments_two_bits_apart_share_a_hash():
    draw = np.random.default_rng(2)
    for width in (21, 22, 23):
        for value in draw.integers(0, 1 << width, 40):
            a, b = (1 << int(x) for x in draw.choice(width, 2, replace=False))
            near = np.array([value, value ^ a, value ^ a ^ b])
            row, found = simhash.fuzzy_hashes(near, width)
            hashes = [set(found[row == i].tolist()) for i in range(3)]
            assert all(len(h) <= 6 for h in hashes)
            assert hashes[0] & hashes[1]
            assert hashes[0] & hashes[2]


def test_keys_of_linked_fingerprints_meet():
    draw = random.Random(3)
    prints = []
    for _ in range(200):
        value = draw.getrandbits(64)
        prints += [value, value ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64)]
    row, key = simhash.keys_of(np.array(prints, np.uint64))
    keys = [set(key[row == i].tolist()) for i in range(len(prints))]
    assert all(keys[i] & keys[i + 1] for i in range(0, len(prints), 2))


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_fingerprints(spark):
    draw = random.Random(4)
    texts = [None, "", " \n", "a", "A b", "a b c", "a b c a b c a b c", "Größe ÄÖ übung", " ".join(str(draw.randrange(50)) for _ in range(5000))]
    texts += [" ".join(str(draw.randrange(9)) for _ in range(draw.randrange(300))) for _ in range(60)]
    found = {r["doc_id"]: r["fingerprint"] % (1 << 64) for r in simhash.fingerprint_groups(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert found == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("paired", [2, 32])
def test_links_of_fingerprints(spark, paired, monkeypatch):
    """Groups around a few fingerprints, of all distances, with keys of many nodes."""
    draw = random.Random(5)
    prints = [0, 0, 3, 7]
    for size in (150, 40, 3):
        centre = draw.getrandbits(64)
        for _ in range(size):
            value = centre
            for _ in range(draw.choice([0, 1, 1, 2, 3, 4])):
                value ^= 1 << draw.randrange(64)
            prints.append(value)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in sorted(set(signed))], "node long").repartition(3)
    links = {(r["a"], r["b"]) for r in simhash._close(nodes, paired).collect()}
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= 2 for a, b in links)
    from tests.llm.test_groups import united

    label = united(set(signed), links)
    expected = plain_components(prints)
    groups = {}
    for p, e in zip(signed, expected, strict=True):
        groups.setdefault(e, set()).add(label[p])
    assert all(len(g) == 1 for g in groups.values())
    assert len({x for g in groups.values() for x in g}) == len(groups)


def test_groups_of_documents(spark):
    base = [f"w{i}" for i in range(2000)]
    rows = [(7, " ".join(base)), (3, " ".join(base)), (9, " ".join(base[:-1] + ["end"])), (4, "something else entirely that is short"), (None, " ".join(base)), (5, ""), (6, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fingerprint long, component_id string")
    prints = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(prints)
    smallest = {c: min(r[0] for r, x in zip(rows, label, strict=True) if x == c and r[0] is not None) for c in set(label)}
    found = sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.fingerprint_groups(docs).collect())
    assert found == sorted((str(r[0]), smallest[c]) for r, c in zip(rows, label, strict=True))


def test_tables_staged_for_fingerprints(spark, monkeypatch):
    """Only what is read more than once is staged: fingerprints, nodes and keys of several nodes."""
    staged = []

    def counted(df):
        staged.append(df.columns)
        return common.written(df)

    monkeypatch.setattr(simhash, "written", counted)
    docs = spark.createDataFrame([(i, f"some words of {i % 3}") for i in range(9)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in simhash.fingerprint_groups(docs).collect()}
    assert found == {i: i % 3 for i in range(9)}
    assert staged == [["doc_id", "text_key", "fingerprint"], ["node", "smallest"], ["key", "node", "n"]]


def plain_search(docs, items, places=10):
    import math
    from collections import Counter

    terms = [(i, lexical_search.terms_of((t or "").encode())) for i, t in docs]
    n, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = Counter(w for _, ws in terms for w in set(ws))
    out = []
    for item, text in items:
        scores = []
        for doc_id, words in terms:
            tf = Counter(words)
            m = 25 + 75 * len(words) * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m)) for w in lexical_search.terms_of((text or "").encode()) if tf[w])
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scores)[:places], 1)]
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_search(spark, monkeypatch, block):
    """Ties, repeated terms, rare and common ones, long and empty texts, several blocks of items."""
    draw = random.Random(6)
    pool = [f"t{i}" for i in range(300)]

    def text(n):
        return draw.choice([" ", "-", ", "]).join(pool[min(299, int(draw.expovariate(0.02)))] for _ in range(n))

    docs = [(i, text(draw.choice([0, 3, 20, 200]))) for i in range(900)]
    docs += [(1000 + i, docs[i][1]) for i in range(300)] + [(5, "T1 t1"), (5, "t1"), (None, "t2 t3"), (2000, None), (2001, " ".join(pool * 40)), (2002, "é日本 t9")]
    items = [(i, text(draw.choice([1, 5, 30]))) for i in range(24)] + [(30, ""), (31, None), (32, "absent words"), (33, "t0 " * 50), (34, "É日本 T9")]
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", block)
    found = lexical_search.search(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int").repartition(4), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string"),
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(plain_search(docs, items))


def test_bounds_leave_out_batches():
    """Most pairs are left out where documents are about different things, and the places are still right."""
    draw = np.random.default_rng(7)
    n, topics = 2048, 64
    topic = draw.integers(0, topics, n)
    owner = np.repeat(np.arange(n), 12)
    terms = (topic[owner] * 30 + draw.integers(0, 30, len(owner))).astype(np.int64)
    owner, terms, values = lexical_search.maxima(owner, terms, draw.integers(1, 1000, len(owner)))
    items = np.repeat(np.arange(topics), 5)
    item_terms = items * 30 + np.tile(np.arange(5), topics)
    tree = lexical_search.ItemTree(items, item_terms, np.full(len(items), 3), topics, topics * 30, 10)
    tree.walk(np.arange(n), owner, terms, values)
    full = np.zeros((topics, n), np.int64)
    for o, t, v in zip(owner, terms, values, strict=True):
        if t % 30 < 5:
            full[t // 30, o] += 3 * v
    item, doc, score = tree.ranked()
    for i in range(topics):
        best = sorted((-s, d) for d, s in enumerate(full[i]) if s > 0)[:10]
        assert sorted(zip((-score[item == i]).tolist(), doc[item == i].tolist(), strict=True)) == best
    assert tree.compared < 0.1 * tree.possible
