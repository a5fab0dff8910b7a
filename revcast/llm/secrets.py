"""Secret scan: fixed patterns and a character convolutional network.

Three base patterns (assignments, access keys, hex runs) give findings that
always stay. Beside them, every run of ``MIN_RUN`` token characters with
letters and digits is a candidate, and a small convolutional network scores
it: the classes of the characters before, in and behind the candidate go
through a width-``TAPS`` convolution, are pooled (maximum and mean), and a
logistic layer, which also sees the length and the share of distinct
characters, gives a score. The network is written in numpy; each task scores
the candidates of a slice in one go.

Training reads every document. Each base finding is a positive in its own context,
each of a few places of the text one with a drawn secret, and each finding and place
also a negative, with a drawn run of words, numbers, dates, names and paths; what is
drawn for a text goes by the text alone. Equal examples are one with a weight. A third
of the documents, by a hash of the text, is held out. The network begins with drawn
examples (an empty corpus has these alone). Then all examples of the corpus, dealt by
hash to ``BUCKETS`` and sorted, are gone through by stochastic gradients in each bucket,
and the buckets' networks are averaged, ``ROUNDS`` times: tasks hold a chunk of examples,
the driver the buckets' parameters, and neither the partitions nor the order of the rows
matters. Scores are calibrated (Platt), and each shape of candidate (hex, upper case,
mixed) gets the largest threshold that keeps ``RECALL`` of the held-out positives, however
low, from the counts of all held-out examples by label, shape and logit (in steps of
``1 / STEPS``); the network also has the share of the held-out negatives of each shape
that come through. A shape without held-out positives has ``NO_POSITIVES`` as its threshold.

Defined results: null or empty text has no findings; positions are code
points, ends exclusive; rows are handled one by one, whole texts; an empty
corpus still trains on the drawn values. Only key and text are read.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .text import map_columns, map_texts

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "model")
LEAST_VALUE, LEAST_ACCESS = 6, 20

RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
LETTER, DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
MIN_RUN = 12
PLACE = re.compile(r"[^\W_]{3,20}")
BEFORE, HEAD, TAIL, AFTER = 16, 16, 8, 8
WIDTH = BEFORE + HEAD + TAIL + AFTER
TAPS, FILTERS = 5, 16
EXAMPLES = 4_000  # drawn, for the network to begin with
PLACES = 2  # of a text, beside its findings
BUCKETS, ROUNDS, CHUNK = 64, 2, 20_000
STEPS, LAST_STEP = 64, 2047
RECALL, NO_POSITIVES = 0.95, 0.5

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The base findings, by start, then kind."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=order)


def order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Token runs with letters and digits that no base finding covers."""
    out = []
    spans = sorted(spans, key=lambda x: x[1])
    starts, reach = [s for _, s, _ in spans], list(accumulate((e for _, _, e in spans), max))
    for m in RUN.finditer(text):
        a, b = m.span()
        before = bisect_left(starts, b)  # spans that begin before the run ends, and the furthest end of them
        if DIGIT.search(m[0]) and LETTER.search(m[0]) and not (before and reach[before - 1] > a):
            out.append((a, b))
    return out


# --- character classes and windows ---------------------------------------

_GROUPS = ("aeiou", "bcdf", "ghjklmnpqrstvwxyz", "AEIOU", "BCDF", "GHJKLMNPQRSTVWXYZ", "0123456789", " ", "\t\n\r",
           "=", ":", "\"'`", "_", "-", "/", "+", ".", ",;", "@", "()[]{}<>", "!?#$%&*\\^|~")
_PAD, _WIDE, _MARK = len(_GROUPS), len(_GROUPS) + 1, len(_GROUPS) + 2
CLASSES = len(_GROUPS) + 3
_CLASS = np.full(256, _WIDE, np.uint8)
for _n, _g in enumerate(_GROUPS):
    for _c in _g:
        _CLASS[ord(_c)] = _n


def window(text: str, a: int, b: int) -> tuple[str, str]:
    """The text before a candidate and the part from it on that is looked at."""
    value = text[a:b]
    if b - a > HEAD + TAIL:
        value = value[:HEAD] + value[-TAIL:]
    return text[max(0, a - BEFORE):a], value + "\0" * (HEAD + TAIL - len(value)) + text[b:b + AFTER]


def features(found: list[tuple[str, str, int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the windows' characters, and two numbers about the values:
    ``found`` has the two window parts, the value's length and the value."""
    x = np.full((len(found), WIDTH), _PAD, np.uint8)
    more = np.zeros((len(found), 2), np.float32)
    for n, (before, rest, size, value) in enumerate(found):
        both = np.frombuffer((before + rest).encode("latin-1", "replace").replace(b"\0", b"\xff"), np.uint8)
        x[n, BEFORE - len(before):BEFORE - len(before) + len(both)] = _CLASS[both]
        inside = min(size, HEAD + TAIL)
        x[n, BEFORE + inside:BEFORE + HEAD + TAIL] = _MARK
        more[n] = min(size, 64) / 32, len(set(value)) / max(1, size)
    return x, more


def shape(value: str) -> int:
    return 0 if re.fullmatch(r"[0-9a-f]+", value) else 1 if re.fullmatch(r"[0-9A-Z]+", value) else 2


SHAPES = 3


# --- the network ---------------------------------------------------------

@dataclass
class Network:
    taps: np.ndarray  # TAPS x CLASSES x FILTERS: embedding and convolution in one
    bias: np.ndarray
    dense: np.ndarray  # of the pooled filters and the two numbers
    offset: float
    scale: float = 1.0  # calibration
    shift: float = 0.0
    thresholds: tuple[float, ...] = (NO_POSITIVES,) * SHAPES
    false_positives: tuple[float | None, ...] = (None,) * SHAPES  # rate; None without held-out negatives

    def logits(self, x: np.ndarray, more: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.float32)
        for i in range(0, len(x), 512):
            part = x[i:i + 512]
            n = part.shape[1] - TAPS + 1
            y = sum((self.taps[k][part[:, k:k + n]] for k in range(TAPS)), self.bias)
            y = np.maximum(y, 0)
            pooled = np.concatenate([y.max(axis=1), y.mean(axis=1), more[i:i + 512]], axis=1)
            out[i:i + 512] = pooled @ self.dense + self.offset
        return out

    def scores(self, x: np.ndarray, more: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(x, more))

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * z + self.shift)))


def train(x: np.ndarray, more: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 8, start: Network | None = None,
          weights: np.ndarray | None = None, rate: float = 0.01) -> Network:
    """Fit by Adam on the logistic loss; a fixed seed, so reruns agree. ``start``: the network
    to go on from."""
    rng = np.random.default_rng(seed)
    p = {"taps": rng.normal(0, 0.15, (TAPS * CLASSES, FILTERS)), "bias": np.zeros(FILTERS),
         "dense": rng.normal(0, 0.2, 2 * FILTERS + 2), "offset": np.zeros(1)}
    if start is not None:
        p = {"taps": start.taps.reshape(TAPS * CLASSES, FILTERS), "bias": start.bias, "dense": start.dense,
             "offset": np.array([start.offset])}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    eye, n, step = np.eye(CLASSES, dtype=np.float32), WIDTH - TAPS + 1, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            one = eye[x[rows]]
            cols = np.concatenate([one[:, k:k + n] for k in range(TAPS)], axis=2).reshape(-1, TAPS * CLASSES)
            z = (cols @ p["taps"] + p["bias"]).reshape(len(rows), n, FILTERS)
            a = np.maximum(z, 0)
            top = a.argmax(axis=1)
            pooled = np.concatenate([np.take_along_axis(a, top[:, None], 1)[:, 0], a.mean(axis=1), more[rows]], axis=1)
            share = 1 / len(rows) if weights is None else weights[rows] / weights[rows].sum()
            error = (1 / (1 + np.exp(-(pooled @ p["dense"] + p["offset"]))) - y[rows]) * share
            back = np.outer(error, p["dense"])
            g = np.repeat(back[:, None, FILTERS:2 * FILTERS] / n, n, axis=1)
            np.put_along_axis(g, top[:, None], np.take_along_axis(g, top[:, None], 1) + back[:, None, :FILTERS], 1)
            g = (g * (z > 0)).reshape(-1, FILTERS).astype(np.float32)
            grad = {"taps": cols.T @ g, "bias": g.sum(axis=0), "dense": pooled.T @ error + 1e-4 * p["dense"],
                    "offset": error.sum(keepdims=True)}
            step += 1
            for k, d in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                        ).astype(np.float32)
    return Network(p["taps"].reshape(TAPS, CLASSES, FILTERS), p["bias"], p["dense"], float(p["offset"][0]))


def calibrate(net: Network, x: np.ndarray, more: np.ndarray, y: np.ndarray, shapes: np.ndarray) -> Network:
    """``calibrate_logits`` on held-out examples."""
    return calibrate_logits(net, net.logits(x, more), y, shapes, np.ones(len(x)))


def calibrate_logits(net: Network, z: np.ndarray, y: np.ndarray, shapes: np.ndarray, weights: np.ndarray) -> Network:
    """Platt's scale and shift on the held-out examples' logits (positive scale), and
    the largest thresholds that keep the wanted recall of each shape."""
    a, b = 1.0, 0.0
    good, bad = (weights * y).sum(), (weights * (1 - y)).sum()
    want = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = weights * np.maximum(q * (1 - q), 1e-6)
        off = weights * (q - want)
        g = np.array([(off * z).sum() + 1e-3 * (a - 1), off.sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        a, b = max(0.05, a - np.clip(move[0], -1, 1)), b - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-8:
            break
    net.scale, net.shift = float(a), float(b)
    s = net.calibrated(z)
    cuts, false = [], []
    for k in range(SHAPES):
        mine = np.flatnonzero((y == 1) & (shapes == k))
        mine = mine[np.argsort(s[mine], kind="stable")]
        upto = np.cumsum(weights[mine])  # the first whose example is beyond those that may be lost
        cuts.append(float(s[mine[np.searchsorted(upto, int((1 - RECALL) * upto[-1]), side="right")]]) if len(mine) else NO_POSITIVES)
        of = (y == 0) & (shapes == k)
        false.append(float(weights[of & (s >= cuts[-1])].sum() / weights[of].sum()) if of.any() else None)
    net.thresholds, net.false_positives = tuple(cuts), tuple(false)
    return net


# --- labelled examples ---------------------------------------------------

_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def examples(findings: list[tuple[str, str, str]], plain: list[tuple[str, str, str]],
             n: int = EXAMPLES, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, numbers, labels and shapes. ``findings`` are labelled findings
    (text before, value, text behind), ``plain`` words of the same corpus."""
    rng = np.random.default_rng(seed)

    def pick(items: list) -> object:
        return items[int(rng.integers(len(items)))]

    def drawn() -> str:
        alphabet = _ALPHABETS[int(rng.integers(len(_ALPHABETS)))]
        return "".join(pick(alphabet) for _ in range(int(rng.integers(MIN_RUN, 48))))

    places = [(b, a) for b, _, a in plain] or [("", "")]
    words = [w for _, w, _ in plain if w.isalpha()] or ["word", "other", "thing"]

    def word() -> str:
        return pick(words)

    def clean() -> str:
        """A run with letters and digits that is no secret."""
        year, k = int(rng.integers(1990, 2030)), int(rng.integers(8))
        month, day, number = int(rng.integers(1, 13)), int(rng.integers(1, 29)), int(rng.integers(1, 100000))
        return (f"{word()}-{word()}-{number}", f"{year}-{month:02d}-{day:02d}T{day:02d}", f"{word()}{word()}{number % 100}",
                f"{word()}/{word()}/{year}", f"{word()}_{word()}_{number % 1000}", f"{word().title()}{word().title()}{year}",
                f"{number}/{word()}/{word()}", f"{word()}={number}-{word()}")[k]

    out, labels, shapes = [], [], []
    for k in range(n):
        if k % 2:
            if findings and rng.random() < 0.6:
                before, value, after = pick(findings)
                value = value if rng.random() < 0.5 else drawn()
                before = before if rng.random() < 0.5 else pick(places)[0]  # the value must speak for itself, too
            else:
                (before, after), value = pick(places), drawn()
        else:
            (before, after), value = pick(places), clean()
            if findings and rng.random() < 0.1:
                before = pick(findings)[0]
        text = before + value + after
        a, b = len(before), len(before) + len(value)
        out.append((*window(text, a, b), b - a, value))
        labels.append(k % 2)
        shapes.append(shape(value))
    x, more = features(out)
    return x, more, np.array(labels, np.float32), np.array(shapes)


def labelled(text: str) -> list[tuple[str, str, int, str, int]]:
    """The examples of a text: window parts, value's length, value, and label."""
    findings = []
    for kind, a, b in base_spans(text):
        m = ASSIGN.match(text, a) if kind == "assign" else None
        a = m.start(2) if m else a
        findings.append((text[max(0, a - BEFORE):a], text[a:b], text[b:b + AFTER]))
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    words = []
    for _ in range(PLACES):  # the word behind a drawn place, if any
        m = PLACE.search(text, int(rng.random() * len(text)))
        if m:
            words.append((text[max(0, m.start() - BEFORE):m.start()], m[0], text[m.end():m.end() + AFTER]))
    names = [w for _, w, _ in words if w.isalpha()] or ["word", "other", "thing"]
    made = [(*f, 1) for f in findings]
    for before, _, after in words:
        made.append((before, drawn_value(rng), after, 1))
    for before, _, after in findings:
        made.append((rng.choice(words)[0] if words and rng.random() < 0.5 else before, clean_value(rng, names), after, 0))
        # The value must speak for itself, too.
        made.append((rng.choice(words)[0] if words else "", drawn_value(rng), after, 1))
    for before, _, after in words:
        made.append((before, clean_value(rng, names), after, 0))
    return [(*window(b + v + a, len(b), len(b) + len(v)), len(v), v, label) for b, v, a, label in made]


def drawn_value(rng: random.Random) -> str:
    alphabet = rng.choice(_ALPHABETS)
    return "".join(rng.choices(alphabet, k=rng.randrange(MIN_RUN, 48)))


def clean_value(rng: random.Random, names: list[str]) -> str:
    """A run with letters and digits that is no secret."""
    one, two, kind = rng.choice(names), rng.choice(names), rng.randrange(8)
    year, month, day, number = rng.randrange(1990, 2030), rng.randrange(1, 13), rng.randrange(1, 29), rng.randrange(1, 100000)
    return (f"{one}-{two}-{number}", f"{year}-{month:02d}-{day:02d}T{day:02d}", f"{one}{two}{number % 100}",
            f"{one}/{two}/{year}", f"{one}_{two}_{number % 1000}", f"{one.title()}{two.title()}{year}",
            f"{number}/{one}/{two}", f"{one}={number}-{two}")[kind]


_EXAMPLE = "held boolean, label int, shape int, a float, b float, x binary"


def corpus_examples(docs: DataFrame, text: str) -> DataFrame:
    """The distinct examples of all documents with their number ``n``, in the checkpoint folder."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], []
            for t in batch.column(0).to_pylist():
                some = labelled(t)
                found += some
                held += [zlib.crc32(t.encode("utf-8", "surrogatepass")) % 3 == 0] * len(some)
            x, more = features([f[:4] for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.bool_()), pa.array([f[4] for f in found], pa.int32()),
                 pa.array([shape(f[3]) for f in found], pa.int32()), pa.array(more[:, 0]), pa.array(more[:, 1]),
                 pa.array([r.tobytes() for r in x], pa.binary())], names=["held", "label", "shape", "a", "b", "x"])

    ensure_checkpoint_dir(docs.sparkSession)
    made = docs.select(F.col(text).alias("t")).where("t is not null").mapInArrow(look, _EXAMPLE)
    return made.groupBy("held", "label", "shape", "a", "b", "x").agg(F.count(F.lit(1)).alias("n")).checkpoint()


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, numbers, labels, shapes and weights of a batch of examples."""
    col = {n: batch.column(n) for n in batch.schema.names}
    x = np.frombuffer(b"".join(col["x"].to_pylist()), np.uint8).reshape(-1, WIDTH)
    more = np.stack([col["a"].to_numpy(), col["b"].to_numpy()], axis=1)
    return x, more, col["label"].to_numpy().astype(np.float32), col["shape"].to_numpy(), col["n"].to_numpy().astype(np.float64)


def _round(rows: DataFrame, net: Network, rate: float) -> Network:
    """All training examples once: each bucket by itself, then the average by weight."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}

        def learn() -> None:
            parts = [np.concatenate(p) for p in zip(*state["parts"], strict=True)]
            x, more, y, _, w = parts
            state["net"] = train(x, more, y, epochs=1, start=state["net"], weights=w.astype(np.float32), rate=rate)
            state["n"] += float(w.sum())
            state["parts"], state["size"] = [], 0

        def result() -> pa.RecordBatch:
            if state["size"]:
                learn()
            one = state["net"]
            flat = np.concatenate([one.taps.ravel(), one.bias, one.dense, [one.offset]]).astype(np.float64)
            return pa.RecordBatch.from_arrays([pa.array([state["bucket"]], pa.int64()), pa.array([state["n"]], pa.float64()),
                                               pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["bucket", "n", "p"])

        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for i, j in zip(cuts, cuts[1:]):
                while i < j:
                    if state.get("bucket") != buckets[i]:
                        if state:
                            yield result()
                        state = {"bucket": int(buckets[i]), "net": shared.value, "n": 0.0, "parts": [], "size": 0}
                    k = min(j, i + CHUNK - state["size"])  # whatever the batches' sizes, the same chunks
                    state["parts"].append(_arrays(batch.slice(i, k - i)))
                    state["size"] += k - i
                    if state["size"] == CHUNK:
                        learn()
                    i = k
        if state:
            yield result()

    at = F.pmod(F.xxhash64("x", "label", "a", "b"), F.lit(BUCKETS).cast("long"))
    dealt = rows.withColumn("bucket", at).repartition(BUCKETS, "bucket").sortWithinPartitions(
        "bucket", F.xxhash64("label", "b", "x", "a"), "x", "label", "a", "b", "shape")
    found = sorted(dealt.mapInArrow(run, "bucket long, n double, p array<double>").collect())  # a row a bucket
    shared.unpersist()
    if not found:
        return net
    flat = np.average([r["p"] for r in found], axis=0, weights=[r["n"] for r in found]).astype(np.float32)
    k = TAPS * CLASSES * FILTERS
    return Network(flat[:k].reshape(TAPS, CLASSES, FILTERS), flat[k:k + FILTERS], flat[k + FILTERS:-1], float(flat[-1]))


def _steps(z: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(z * STEPS), -LAST_STEP, LAST_STEP).astype(np.int64)


def _held_counts(rows: DataFrame, net: Network) -> list[tuple[int, int, int, int]]:
    """Label, shape, step of the logit and number of all held-out examples."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, more, *_ = _arrays(batch)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("shape"),
                                              pa.array(_steps(shared.value.logits(x, more))), batch.column("n")],
                                             names=["label", "shape", "step", "n"])

    counts = rows.mapInArrow(run, "label int, shape int, step long, n long").groupBy("label", "shape", "step").agg(
        F.sum("n").alias("n")).collect()  # at most 2 * SHAPES * (2 * LAST_STEP + 1) rows
    return [(r["label"], r["shape"], r["step"], r["n"]) for r in counts]


def fit_network(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Network:
    """Train on the labelled findings of all documents."""
    x, more, y, shapes = examples([], [])
    held = np.arange(len(x)) % 6 < 2  # both labels, as these alternate
    net = train(x[~held], more[~held], y[~held])
    rows = corpus_examples(docs, text)
    train_on, held_out = rows.where("not held").drop("held"), rows.where("held").drop("held")
    for k in range(ROUNDS):
        net = _round(train_on, net, 0.003 / (k + 1))
    drawn = zip(y[held].astype(int).tolist(), shapes[held].tolist(), _steps(net.logits(x[held], more[held])).tolist(), strict=True)
    counts: Counter = Counter()
    for label, kind, step, n in [*_held_counts(held_out, net), *((*d, 1) for d in drawn)]:
        counts[label, kind, step] += n
    at = np.array(sorted(counts), np.int64).reshape(-1, 3)
    return calibrate_logits(net, at[:, 2] / STEPS, at[:, 0].astype(np.float64), at[:, 1],
                            np.array([counts[tuple(r)] for r in at.tolist()], np.float64))


# --- the operator --------------------------------------------------------

def find_spans(net: Network | None, texts: list[str | None]) -> list[list[tuple[str, int, int, float]]]:
    """All findings of each text with scores (1 for the base patterns)."""
    out: list[list] = []
    found, where = [], []
    for n, t in enumerate(texts):
        spans = base_spans(t) if t else []
        out.append([(*s, 1.0) for s in spans])
        if t and net is not None:
            for a, b in candidates(t, spans):
                found.append((*window(t, a, b), b - a, t[a:b]))
                where.append((n, a, b))
    if found:
        scores = net.scores(*features(found))
        for (n, a, b), s, f in zip(where, scores.tolist(), found, strict=True):
            if s >= net.thresholds[shape(f[3])]:
                out[n].append(("model", a, b, s))
    return [sorted(x, key=lambda s: order(s[:3])) for x in out]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", network: Network | None = None,
                 train_on: DataFrame | None = None) -> DataFrame:
    """One row per document: key and ``spans`` (kind, start, end, score). The
    network is the given one, or is fitted on all of ``train_on`` (else of docs)."""
    net = network or fit_network(train_on if train_on is not None else docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(texts: pa.Array) -> dict[str, object]:
        return {"spans": [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in x]
                          for x in find_spans(shared.value, texts.to_pylist())]}

    return map_texts(docs, key, text, [T.StructField("spans", T.ArrayType(SPAN))], work)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", network: Network | None = None,
           key: str = "doc_id", train_on: DataFrame | None = None) -> DataFrame:
    """The same rows and columns with every finding replaced by ``mark``."""
    net = network or fit_network(train_on if train_on is not None else docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for n, spans in enumerate(find_spans(shared.value, texts)):
                if spans:
                    out, end = [], 0
                    for _, a, b, _ in spans:
                        if a >= end:
                            out += [texts[n][end:a], mark]
                        end = max(end, b)
                    texts[n] = "".join(out) + texts[n][end:]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return map_columns(docs, run, docs.schema.fields)


def secret_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: key, ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256``, ``spans`` (kind:start:end, comma-joined), ``n_model`` and
    ``max_model_score``."""
    found = find_secrets(docs, **how)

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(c: F.Column) -> F.Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")

    model = F.filter("spans", lambda s: s["kind"] == "model")
    return found.select(
        how.get("key", "doc_id"), *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "model")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("model").alias("n_model"),
        F.array_max(F.transform(model, lambda s: s["score"])).alias("max_model_score"))
