"""Trained operators: folds, brute-force scores, held-out accuracy."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from starloom.llm import language_model, quality, secrets
from starloom.llm.queries import QUERIES, op2_secret_scan

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# Quality classifier


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op3_quality_classifier"](spark, FOLDER).toPandas()


def test_quality_folds(scored):
    expected = [zlib.crc32(str(i).encode()) % 4 == 2 for i in scored["doc_id"]]
    assert scored["held_out"].tolist() == expected
    assert scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.7)).all()


def test_quality_on_held_out_labels(spark, scored):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    both = scored[scored["held_out"]].merge(labels, on="doc_id")
    accuracy = (both["predicted"] == both["quality"]).mean()
    assert accuracy > 0.95
    good = both[both["quality"] == 1]
    assert (good["predicted"] == 1).mean() > 0.95


def test_quality_ignores_held_out_labels_and_metadata(spark, docs, scored):
    from pyspark.sql import functions as F

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = quality.score_quality(other, flipped).toPandas().sort_values("doc_id")
    assert np.allclose(again["score"], scored.sort_values("doc_id")["score"])


def test_discriminant_against_densities():
    draw = np.random.default_rng(1)
    x = [draw.normal(k, 1 + k, (200, quality.SIZE)) for k in (0, 1)]
    count, total = np.array([200.0, 200.0]), np.stack([v.sum(0) for v in x])
    model = quality.Discriminant(count, total, np.stack([v.T @ v for v in x]))
    both = np.concatenate(x)
    expected = []
    pooled = sum(np.cov(v.T) * 199 for v in x) / 398
    scale = np.sqrt(np.diag(pooled))
    for v in x:
        own = np.cov(v.T) / np.outer(scale, scale)
        c = 0.95 * own + 0.05 * pooled / np.outer(scale, scale)
        c = 0.99 * c + 0.01 * np.trace(c) / quality.SIZE * np.eye(quality.SIZE)
        d = both / scale - v.mean(0) / scale
        expected.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1])
    score = 1 / (1 + np.exp(-np.clip(expected[1] - expected[0], -500, 500)))
    assert np.allclose(model.scores(both), score)


# Language model


def all_segmentations(lattice, text):
    """Sum of the products of all segmentations, one after another."""
    total = 0.0

    def walk(at, product):
        nonlocal total
        if at == len(text):
            total += product * 0.5
            return
        for end in range(at + 1, len(text) + 1):
            piece = text[at:end]
            weight = lattice.weights.get(piece)
            between = 0.5 if end < len(text) else 1.0
            if weight is not None and (at == 0 or piece[0] != "▁"):
                walk(end, product * math.exp(weight) * between)
            if end == at + 1 and at > 0:
                walk(end, product * math.exp(lattice.byte * len(piece.encode())) * between)

    walk(0, 1.0)
    return total


def test_lattice_sums_all_segmentations():
    lattice = language_model.Lattice([("▁", 0), ("▁th", 1), ("e", 2), ("th", 3), ("h", 4), ("▁t", 5), ("he", 6), ("▁the", 7)])
    for word in ("the", "h", "thethe", "zé", "hehthe"):
        assert math.isclose(math.exp(lattice.log_probability(word)), all_segmentations(lattice, "▁" + word), rel_tol=1e-12)


def test_lattice_is_a_distribution():
    lattice = language_model.Lattice([("▁a", 0), ("b", 1), ("ab", 2), ("▁ab", 3)])
    words = [""]
    total = 0.0
    for _ in range(10):
        words = [w + c for w in words for c in "ab"]
        total += sum(math.exp(lattice.log_probability(w)) for w in words)
    assert total < 1


def test_scores_against_brute_force(spark, docs):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    result = language_model.score_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), frequent_words=200).collect()
    counts = Counter()
    for i, text in rows.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(text.encode().lower().split())
            counts[None] += 1
    total, kinds = sum(counts.values()), len(counts)
    lattice = language_model.Lattice(language_model.pieces_of(public_tokenizers.path("piece_bpe_32k.model")))
    share = (counts[None] + 1) / (total + 2)
    checked = 0
    for row in result:
        tokens = [*rows[row["doc_id"]].encode().lower().split(), None]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 7 == 2)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        base = math.fsum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        if row["doc_id"] % 10 == 0:
            own = 0.0
            for token in tokens:
                backoff = share if token is None else (1 - share) * math.exp(lattice.log_probability(token.decode()))
                own += math.log10((counts[token] + kinds * backoff) / (total + kinds))
            assert math.isclose(row["score"], own, rel_tol=1e-9)
            checked += 1
    assert checked == 100


# Secrets

NAIVE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def naive(text):
    found = [(m.start(), k, m.end()) for k, (_, pattern, fits) in enumerate(NAIVE) for m in pattern.finditer(text or "") if fits(m)]
    return [f"{NAIVE[k][0]}:{s}:{e}" for s, k, e in sorted(found)]


ODD = [
    "", None, "token=token=abcdefghij", "password: token = abcdefgh12", "paſſword=abcdefgh1 toKen=abcdefgh1", "API_KEY = 'aaaaaaaa' apikey:bbbbbbbb api_key=short",
    "ñ" * 50 + "AKIA" + "A" * 12 + " AKIA" + "B" * 11, "0" * 31 + "g" + "0" * 32, "secret=" + "0123456789abcdef" * 4, "AKIAAKIAAKIAAKIA" + "a" * 40, "x" * 5000 + " token=" + "z" * 3000,
]


def test_base_findings_against_plain_patterns(spark, docs):
    texts = dict(enumerate(ODD)) | {100 + r["doc_id"]: r["text"] for r in docs.collect()}
    for text in texts.values():
        assert [f"{secrets.KINDS[k]}:{s}:{e}" for s, e, k in sorted(secrets.base_findings(text or ""), key=lambda f: (f[0], f[2]))] == naive(text)


def test_query_keeps_all_base_findings(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = 0
    for row in op2_secret_scan(spark, FOLDER).collect():
        expected = naive(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        kinds = Counter(f.split(":")[0] for f in expected)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        spans = row["spans"].split(",") if row["spans"] else []
        assert [s for s in spans if not s.startswith("network")] == expected
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0])))
        found += len(expected)
    assert found


def credential(draw):
    return "".join(draw.choice(list("0123456789abcdef"), 40))


def test_network_learns_credentials():
    draw = np.random.default_rng(3)
    words = ["thing", "section2", "ofthe", "andmore", "2024", "chapter"]

    def window(value, before):
        return before[-secrets.BEFORE :].rjust(secrets.BEFORE, "\0") + value[: secrets.AFTER].ljust(secrets.AFTER, "\0")

    positive = [window(credential(draw), f'the {draw.choice(words)} token = "') for _ in range(300)]
    negative = [window("-".join(draw.choice(words, 5)), f"the {draw.choice(words)} of the ") for _ in range(300)]
    windows = [w for pair in zip(positive, negative, strict=True) for w in pair]
    labels = [1, 0] * 300
    order = draw.permutation(600)
    network = secrets.trained([windows[i] for i in order], [labels[i] for i in order])
    assert network.threshold <= 1
    unseen = [window(credential(draw), "as said there ") for _ in range(100)]
    plain = [window("-".join(draw.choice(words, 5)), "as said there ") for _ in range(100)]
    assert (network.scores(secrets.classes(unseen)) >= network.threshold).mean() > 0.9
    assert (network.scores(secrets.classes(plain)) >= network.threshold).mean() < 0.02


def test_recall_is_held_where_scores_are_low():
    draw = np.random.default_rng(4)
    windows = [credential(draw).rjust(secrets.BEFORE + 40, "\0") for _ in range(1200)]
    network = secrets.trained(windows[:800], draw.permutation([1, 0] * 400).tolist())
    assert (network.scores(secrets.blanked(secrets.classes(windows[800:]))) >= network.threshold).mean() > 0.9


def test_recall_is_held_over_all_candidates(spark):
    draw = np.random.default_rng(6)
    rows = [(i, f"token={''.join(draw.choice(list('abcdefgh-XY2'), draw.integers(8, 30)))} and {'-'.join(draw.choice(['abc', 'de2', 'XY', 'hgf', '77a'], 5))}2 end") for i in range(600)]
    found = secrets._found(spark.createDataFrame(rows, "doc_id long, text string"))
    network = secrets._network(found, 30)
    windows = {c["window"] for r in found.collect() for c in r["found"] if c["kind"] < 3}
    assert len(windows) > 550
    scores = 1 / (1 + np.exp(-network.highest([secrets.without_context(w) for w in windows])))
    assert (scores >= network.threshold).mean() >= 0.945


def test_secret_at_the_end_of_a_long_run_is_read():
    draw = np.random.default_rng(8)

    def key():
        return "".join(draw.choice(list("0123456789ABCDEF"), 40))

    def path():
        return "/".join(draw.choice(["static", "js", "lib2", "vendor", "assets", "img7"], 20)) + "/v2"

    def read(text):
        return [dict(zip(("start", "end", "kind", "window"), c, strict=True)) for c in secrets.candidates(text)]

    known = [c for _ in range(300) for c in read(f"token={key()} and {path()} end")]
    order = draw.permutation(len(known))
    network = secrets.trained([known[i]["window"] for i in order], [int(known[i]["kind"] < 3) for i in order])
    ended = secrets._judged(network, [read(f"see {path()}/{key()} end") for _ in range(50)])
    plain = secrets._judged(network, [read(f"see {path()} end") for _ in range(50)])
    assert sum([s["kind"] for s in spans] == ["network"] for spans in ended) >= 45
    assert sum(map(len, plain)) <= 1


def test_windows_cover_a_candidate_and_what_follows():
    text = "before it " + "x1" * 100 + " after it"
    ((start, end, _, seen),) = secrets.candidates(text)
    windows = list(secrets.windows_of(seen))
    assert all(any(text[i : i + 20] in w for w in windows) for i in range(len(text) - 20))
    assert {len(w) for w in windows} == {secrets.BEFORE + secrets.AFTER}


def test_network_gradients():
    draw = np.random.default_rng(5)
    network = secrets.Network()
    x, y = draw.integers(0, 13, (8, secrets.BEFORE + secrets.AFTER)), draw.integers(0, 2, 8).astype(float)

    def loss():
        logit = network.logits(x)
        return float(np.mean(np.log1p(np.exp(logit)) - y * logit))

    for weights, gradient in zip(network.weights, network._gradients(x, y), strict=True):
        at = tuple(draw.integers(0, s) for s in weights.shape)
        kept, step = weights[at], 1e-6
        weights[at] = kept + step
        above = loss()
        weights[at] = kept - step
        below = loss()
        weights[at] = kept
        assert math.isclose((above - below) / (2 * step), gradient[at], rel_tol=1e-3, abs_tol=1e-6)


def test_no_labels_no_network():
    assert secrets.trained([], []).threshold > 1


def test_secrets_are_blanked(spark):
    rows = [(1, "the password=abcdefgh12 end", 7, "x"), (2, None, None, None), (3, "plain", 5, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    result = {r["doc_id"]: r for r in secrets.without_secrets(docs).collect()}
    assert result[1]["text"] == "the [SECRET] end"
    assert (result[2]["text"], result[3]["text"], result[3]["spans"]) == (None, "plain", "y")
