"""Secret scan: fixed patterns, and a small character network over every other candidate.

The patterns' findings always count.  Candidates are the findings and all other
runs of credential characters with a digit and 12 or more characters.  A
convolutional network in numpy reads each whole candidate with the text around it, in
windows that slide by ``STEP`` characters; the highest score counts.  It
is trained on candidates of the scanned corpus, labelled by the patterns; half
of the training copies have the text before the candidate blanked, so that the
network also learns the look of the secret itself.  Only this fit is sampled.  Scores are calibrated on
candidates not trained on (a logistic fit).  All distinct candidates not trained on
are then scored and counted by bins of their score.  The highest threshold that finds at
least ``RECALL`` of the labelled findings there with their context blanked is the
upper limit; where all other candidates score lower, the threshold lies half way
between them and the limit (in logits).
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, dropped, map_batches, written

#: Kinds in order, and their patterns with the least length that counts.
KINDS = ("assign", "access", "hex", "network")
_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("pass", "secret", "token", "api")
_OTHER = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_DIGIT = re.compile(r"[0-9]")

#: Characters before and after a window's start that the network reads, between starts, and of the text after a candidate.
BEFORE, AFTER, STEP, TAIL = 24, 40, 20, 20
#: Characters at the head and the end of a candidate that the training sample has; windows that are scored at once.
HEAD_FIT, END_FIT, AT_ONCE = 104, 80, 4096
#: Bound of the training sample, per label; half of it calibrates.
SAMPLE = 1_500
RECALL = 0.95
#: Width of a bin of calibrated logits, and their bound.
BIN, BOUND = 0.01, 30
_CLASSES, _FILTERS, _WIDTH, _HIDDEN = 13, 24, 5, 16
_ROUNDS, _RATE = 12, 0.01


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the patterns' findings; offsets in code points, end exclusive."""
    found = []
    lower = text.lower()
    if any(h in lower for h in _HINTS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, candidate with its context) of all findings and of other credential-like runs."""
    base = base_findings(text)
    out = []
    taken = iter(base)
    now = next(taken, None)
    furthest = -1
    for m in _OTHER.finditer(text):
        while now is not None and now[0] < m.end():
            furthest = max(furthest, now[1])
            now = next(taken, None)
        if m.start() >= furthest and _DIGIT.search(m[0]):
            out.append((m.start(), m.end(), 3))
    window = []
    for start, end, kind in sorted(base + out):
        # The value itself starts after the name and sign of an assignment.
        value = _ASSIGN.match(text, start).start(1) if kind == 0 else start
        window.append((start, end, kind, text[max(0, value - BEFORE) : value].rjust(BEFORE, "\0") + text[value : end + TAIL]))
    return window


def windows_of(seen: str) -> Iterator[str]:
    """Windows that slide over a candidate with its context, up to its end."""
    last = max(0, math.ceil((len(seen) - BEFORE - AFTER) / STEP))
    return (seen[at : at + BEFORE + AFTER].ljust(BEFORE + AFTER, "\0") for at in range(0, last * STEP + 1, STEP))


def without_context(seen: str) -> str:
    """A candidate with no text before its value."""
    return "\0" * BEFORE + seen[BEFORE:]


def _class_table() -> np.ndarray:
    """Class of each code below 128: no character, space, digit, a-f, other lower, A-F, other upper, quote, sign, joint, line end, other."""
    table = np.full(130, 11)
    for code in range(128):
        c = chr(code)
        table[code] = (
            0 if code == 0 else 1 if c in " \t" else 2 if c.isdigit() else 3 if c in "abcdef" else 4 if c.islower() else 5 if c in "ABCDEF" else 6 if c.isupper()
            else 7 if c in "\"'" else 8 if c in ":=" else 9 if c in "+/_.-" else 10 if c in "\r\n" else 11
        )
    table[128:] = 12
    return table


_TABLE = _class_table()


def classes(windows: list[str]) -> np.ndarray:
    """Character classes of equally long windows."""
    codes = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(len(windows), -1)
    return _TABLE[np.minimum(codes, 128)]


class Network:
    """One convolution with maximum pooling over the context and over the value, one hidden layer, one logit."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.filters = draw.normal(0, 0.3, (_WIDTH, _CLASSES, _FILTERS))
        self.shift = np.zeros(_FILTERS)
        self.hidden = draw.normal(0, 0.2, (3 * _FILTERS, _HIDDEN))
        self.hidden_shift = np.zeros(_HIDDEN)
        self.out = draw.normal(0, 0.2, _HIDDEN)
        self.out_shift = np.zeros(1)
        self.slope, self.offset, self.threshold = 1.0, 0.0, 1.0

    @property
    def weights(self):
        return [self.filters, self.shift, self.hidden, self.hidden_shift, self.out, self.out_shift]

    def _maps(self, x):
        places = x.shape[1] - _WIDTH + 1
        return sum(self.filters[i][x[:, i : i + places]] for i in range(_WIDTH)) + self.shift

    def _forward(self, x):
        raw = self._maps(x)
        maps = np.maximum(raw, 0)
        before, value = maps[:, : BEFORE - _WIDTH + 1], maps[:, BEFORE:]
        pooled = np.concatenate([before.max(1), value.max(1), value.mean(1)], 1)
        layer = np.maximum(pooled @ self.hidden + self.hidden_shift, 0)
        return raw, maps, pooled, layer, layer @ self.out + self.out_shift[0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 256])[-1] for i in range(0, len(x), 256)]) if len(x) else np.empty(0)

    def _gradients(self, x, y):
        raw, maps, pooled, layer, logit = self._forward(x)
        error = (1 / (1 + np.exp(-logit)) - y) / len(y)
        to_layer = np.outer(error, self.out) * (layer > 0)
        to_pooled = to_layer @ self.hidden.T
        to_maps = np.zeros_like(maps)
        rows, columns = np.arange(len(x))[:, None], np.arange(_FILTERS)[None]
        first, most = BEFORE - _WIDTH + 1, maps.shape[1] - BEFORE
        to_maps[rows, maps[:, :first].argmax(1), columns] += to_pooled[:, :_FILTERS]
        to_maps[rows, BEFORE + maps[:, BEFORE:].argmax(1), columns] += to_pooled[:, _FILTERS : 2 * _FILTERS]
        to_maps[:, BEFORE:] += to_pooled[:, None, 2 * _FILTERS :] / most
        to_maps *= raw > 0
        flat, ones = to_maps.reshape(-1, _FILTERS), np.eye(_CLASSES)[x]
        to_filters = np.stack([ones[:, i : i + maps.shape[1]].reshape(-1, _CLASSES).T @ flat for i in range(_WIDTH)])
        return [to_filters, to_maps.sum((0, 1)), pooled.T @ to_layer, to_layer.sum(0), layer.T @ error, error.sum(keepdims=True)]

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        """Adam on logistic loss over a bounded sample."""
        draw = np.random.default_rng(seed)
        first, second, step = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights], 0
        for _ in range(_ROUNDS):
            order = draw.permutation(len(x))
            for i in range(0, len(order), 64):
                step += 1
                part = order[i : i + 64]
                for w, g, a, b in zip(self.weights, self._gradients(x[part], y[part]), first, second, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= _RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        """Fit score = logistic(slope * logit + offset) by Newton steps, with smoothed labels."""
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            d, w = p - target, p * (1 - p) + 1e-9
            h = np.array([[np.sum(w * logits**2) + 1e-3, np.sum(w * logits)], [np.sum(w * logits), np.sum(w) + 1e-3]])
            move = np.linalg.solve(h, [np.sum(d * logits) + 1e-3 * (a - 1), np.sum(d)])
            a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -2, 2)
        self.slope, self.offset = float(a), float(b)

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        """Logits of the calibrated probabilities, bounded."""
        return np.clip(self.slope * self.logits(x) + self.offset, -BOUND, BOUND)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-self.calibrated(x)))

    def highest(self, seen: list[str], raw: bool = False) -> np.ndarray:
        """Highest calibrated (or raw) logit over the windows of each candidate."""
        if not seen:
            return np.empty(0)
        counts = []

        def each() -> Iterator[str]:
            for one in seen:
                counts.append(0)
                for window in windows_of(one):
                    counts[-1] += 1
                    yield window

        of = self.logits if raw else self.calibrated
        found = np.concatenate([of(classes(list(part))) for part in itertools.batched(each(), AT_ONCE)])
        return np.maximum.reduceat(found, np.cumsum([0, *counts[:-1]]))

    def bins(self, seen: list[str]) -> np.ndarray:
        """Number of the bin of each candidate's highest calibrated logit."""
        return np.floor(self.highest(seen) / BIN).astype(np.int32)


def blanked(x: np.ndarray) -> np.ndarray:
    """The windows with no text before the value."""
    x = x.copy()
    x[:, :BEFORE] = 0
    return x


def trained(seen: list[str], labels: list[int]) -> Network:
    """A network fitted and calibrated on labelled candidates with their context (even ones train, odd ones calibrate).

    Of a finding the windows count that begin with ``STEP`` characters of it.
    Without candidates of both labels the threshold stays above every score.
    """
    network = Network()
    y = np.array(labels, float)
    fit, check = slice(0, None, 2), slice(1, None, 2)
    network.threshold = 2.0
    if min(y[fit].sum(), (1 - y[fit]).sum(), y[check].sum(), (1 - y[check]).sum()) < 1:
        return network
    pairs = [(w, label) for one, label in zip(seen[fit], y[fit], strict=True) for k, w in enumerate(windows_of(one)) if not k or not label or BEFORE + STEP * (k + 1) + TAIL <= len(one)]
    x, label = classes([w for w, _ in pairs]), np.array([label for _, label in pairs])
    network.train(np.concatenate([x, blanked(x)]), np.concatenate([label, label]))
    both, label = seen[check] + [without_context(one) for one in seen[check]], np.concatenate([y[check], y[check]])
    network.calibrate(network.highest(both, raw=True), label)
    bins = network.bins(both)
    half = len(bins) // 2
    network.threshold = threshold_of([(1, b, 1) for b in bins[half:][y[check] > 0]] + [(0, b, 1) for b in bins[label == 0]])
    return network


def threshold_of(counts: list[tuple[int, int, int]]) -> float:
    """The score that ``RECALL`` of the findings reach, from (label, bin, count); where no other candidate does, half way down to them."""
    found = sorted(((b, n) for label, b, n in counts if label == 1), reverse=True)
    wanted, have, limit = RECALL * sum(n for _, n in found) - 1e-9, 0, math.inf
    for b, n in found:
        if have >= wanted:
            break
        have, limit = have + n, b
    if not found:
        return 2.0
    others = max((b + 1 for label, b, _ in counts if label == 0), default=limit)
    # A little lower, as sums in batches of other sizes round differently.
    return float(1 / (1 + np.exp(-(min(limit, (limit + others) / 2) * BIN - 1e-6))))


_CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("window", pa.string())])


def _extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [[dict(zip(("start", "end", "kind", "window"), c, strict=True)) for c in candidates(t or "")] for t in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(_CANDIDATE))], ["doc_id", "found"])


def _found(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(map_batches(rows, "doc_id long, found array<struct<start: long, end: long, kind: int, window: string>>", _extracted))


def _network(found: DataFrame, sample: int) -> Network:
    """Trained on candidates drawn by a hash of their window, with the threshold of all others; the driver gets ``sample`` of either label at most, and counts."""
    each = found.select(F.explode("found").alias("c")).select(F.col("c.window").alias("window"), (F.col("c.kind") < 3).cast("int").alias("label")).distinct()
    each = written(each.withColumn("key", F.xxhash64("window")))
    # The driver gets no candidate of any length: the middle of a long one is not trained on.
    short = F.when(F.length("window") <= HEAD_FIT + END_FIT, F.col("window")).otherwise(F.concat(F.substring("window", 1, HEAD_FIT), F.substring("window", -END_FIT, END_FIT)))
    drawn = each.select("key", "label", short.alias("seen"))
    draws = [r for label in (1, 0) for r in drawn.where(F.col("label") == label).orderBy("key", "seen").limit(sample).collect()]
    model = trained([r["seen"] for r in draws], [r["label"] for r in draws])
    if model.threshold <= 1:
        shared = each.sparkSession.sparkContext.broadcast(model)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen = [without_context(w) if label else w for w, label in zip(batch.column("window").to_pylist(), batch.column("label").to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("label"), pa.array(shared.value.bins(seen))], ["label", "bin"])

        unseen = each.where(~F.col("key").isin([r["key"] for r in draws[::2]]))
        counts = map_batches(unseen, "label int, bin int", work).groupBy("label", "bin").count().collect()
        model.threshold = threshold_of([tuple(r) for r in counts])
    dropped(each)
    return model


def _judged(model: Network, lists: list[list[dict]]) -> list[list[dict]]:
    """Findings, and the other candidates whose score reaches the threshold, in order."""
    windows = [c["window"] for found in lists for c in found]
    scores = iter((1 / (1 + np.exp(-model.highest(windows)))).tolist())
    out = []
    for found in lists:
        spans = [(c["start"], c["kind"], c["end"]) for c in found if (next(scores) >= model.threshold) | (c["kind"] < 3)]
        out.append([{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in sorted(spans)])
    return out


def secret_spans(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Secrets of each text.

    One row per row of ``docs``: doc_id, spans (array of start, end, kind, by
    start and then kind; kind ``network`` are spans the patterns don't have),
    offsets in code points, end exclusive.  Null and empty texts have none.  Rows
    that repeat a doc_id are scanned one by one, a null doc_id is kept.  If the
    corpus has no findings or no other candidates, the network adds nothing.
    Other columns are ignored.

    ``sample`` bounds the candidates of either label that the driver trains on;
    they are drawn by a hash of their window over all rows.  The threshold is
    taken from all others.
    """
    found = _found(docs)
    shared = docs.sparkSession.sparkContext.broadcast(_network(found, sample))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_judged(shared.value, batch.column("found").to_pylist()), kind)], ["doc_id", "spans"])

    return map_batches(found, "doc_id long, spans array<struct<start: long, end: long, kind: string>>", work)


def without_secrets(docs: DataFrame, mark: str = "[SECRET]", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; other columns and texts without secrets stay as they are."""
    found = _found(docs)
    shared = docs.sparkSession.sparkContext.broadcast(_network(found, sample))
    dropped(found)

    def cleaned(text: str, spans: list[dict]) -> str:
        out, done = [], 0
        for span in spans:
            if span["end"] > done:
                out += [text[done : max(done, span["start"])], mark] if span["start"] >= done else []
                done = span["end"]
        return "".join([*out, text[done:]])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = batch.column("text").to_pylist()
        lists = _extracted(pa.RecordBatch.from_arrays([pa.nulls(len(kept)), batch.column("text")], ["doc_id", "text"])).column("found").to_pylist()
        new = [t if not spans else cleaned(t, spans) for t, spans in zip(kept, _judged(shared.value, lists), strict=True)]
        return batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), pa.array(new, batch.schema.field("text").type))

    return map_batches(docs, docs.schema, work)
