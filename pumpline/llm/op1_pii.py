"""Personal data: contract patterns plus a character BiLSTM-CRF trained on labelled spans.

The base spans come from the patterns (linear scans, whole texts).  They also
label the training windows.  The tagger is a bidirectional LSTM over characters
with CRF transitions, trained here in numpy on a bounded sample of windows
(``TRAIN_WINDOWS``, the first ones in hash order of their text).

All windows of all texts run through the network.  They overlap by half; where they
do, their emission scores are averaged with more weight for the inner positions, and
the best path through the whole text reconciles all its windows.  A place that no
span could cover without losing to "nothing" (the best span sums over it, from running
sums of the scores) is "nothing" in the best path, so the path falls apart there and
Viterbi runs over the stretches between.  A decoded span is added when it is
confident, holds a digit or an at-sign, ends at word borders and touches no base span.

Rows: null text is empty; texts without findings give zero counts, the hash of
the empty string and an empty list; equal rows give equal results; an empty table
trains an untrained (all "nothing") model and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.llm.common import hash_sample, ready, save

KINDS = ("email", "ip", "card", "phone")
TRIGGER = re.compile(r"[0-9@]")

LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# inside a digit run a start fails exactly where the run's first digit does, so only run starts are tried
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

WINDOW = 64
STRIDE = 32
HIDDEN = 16
TAGS = 1 + 2 * len(KINDS)  # nothing, then begin and inside of each kind
TRAIN_WINDOWS = 2000
EPOCHS = 8
MIN_CONFIDENCE = 0.6
MIN_SPAN = 7
RUN = 512  # windows run through the network at once
GROUP = 8192  # windows of texts that are handled together
SLACK = 1e-3  # rounding allowed for where spans are ruled out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's patterns, by start and kind."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        nxt = at + 1
        start = at
        while start > free and text[start - 1] in LOCAL_SET:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            free = nxt = m.end()
        else:
            free = at + 1
        at = text.find("@", nxt)
    if TRIGGER.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def char_classes(text: str) -> np.ndarray:
    """Class of each character: 1 to 95 printable ASCII, then other white space, other letters, the rest."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((codes >= 32) & (codes < 127), codes - 31, 0).astype(np.int64)
    other = out == 0
    out[other] = np.where(codes[other] < 32, 96, np.where(codes[other] < 0x250, 97, 98))
    return out


CLASSES = 99  # 0 is padding


@dataclass
class Tagger:
    """Weights of the BiLSTM-CRF.  x: input rows by class, u: recurrent, b: bias; index 0 forward, 1 backward."""

    x: np.ndarray  # (2, CLASSES, 4 H)
    u: np.ndarray  # (2, H, 4 H)
    b: np.ndarray  # (2, 4 H)
    w: np.ndarray  # (2 H, TAGS)
    c: np.ndarray  # (TAGS,)
    t: np.ndarray  # (TAGS, TAGS) transitions

    @staticmethod
    def fresh(seed: int = 11) -> Tagger:
        r = np.random.default_rng(seed)
        b = np.zeros((2, 4 * HIDDEN))
        b[:, HIDDEN:2 * HIDDEN] = 1.0  # forget gates start open
        return Tagger(r.normal(0, 0.3, (2, CLASSES, 4 * HIDDEN)), r.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)), b,
                      r.normal(0, 0.2, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS)))

    def params(self) -> list[np.ndarray]:
        return [self.x, self.u, self.b, self.w, self.c, self.t]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * v))


def _lstm(m: Tagger, d: int, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (n, T, H) of direction ``d``; ``keep`` gets what the backward pass needs."""
    n, steps = ids.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out = np.zeros((n, steps, HIDDEN))
    for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
        z = m.x[d][ids[:, t]] + h @ m.u[d] + m.b[d]
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        if keep is not None:
            keep.append((t, h, c, i, f, o, g, tc))
        h, c = o * tc, c_new
        out[:, t] = h
    return out


def emissions(m: Tagger, ids: np.ndarray) -> np.ndarray:
    hs = np.concatenate([_lstm(m, 0, ids), _lstm(m, 1, ids)], axis=2)
    return hs @ m.w + m.c


def quick_emissions(m: Tagger, ids: np.ndarray) -> np.ndarray:
    """``emissions`` in single precision: the four gates one array each, through one tanh."""
    n, steps = ids.shape
    half = np.where(np.arange(4 * HIDDEN) < 3 * HIDDEN, 0.5, 1.0)
    by_gate = lambda v: np.ascontiguousarray((v * half).reshape(-1, 4, HIDDEN).transpose(1, 0, 2), np.float32)
    places = np.ascontiguousarray(ids.T)
    out = np.broadcast_to(m.c.astype(np.float32), (steps, n, TAGS)).copy()
    hs = np.empty((steps, n, HIDDEN), np.float32)
    z, part = np.empty((4, n, HIDDEN), np.float32), np.empty((4, n, HIDDEN), np.float32)
    for d in (0, 1):
        x, u = by_gate(m.x[d] + m.b[d]), by_gate(m.u[d])
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
            x.take(places[t], axis=1, out=z, mode="clip")
            z += np.matmul(h, u, out=part)
            np.tanh(z, out=z)
            z[:3] *= 0.5
            z[:3] += 0.5
            c *= z[1]
            c += np.multiply(z[0], z[3], out=part[0])
            np.tanh(c, out=part[1])
            h = np.multiply(z[2], part[1], out=hs[t])
        out += hs @ m.w[d * HIDDEN:(d + 1) * HIDDEN].astype(np.float32)
    return out.transpose(1, 0, 2)


def _lse(v: np.ndarray, axis: int) -> np.ndarray:
    top = v.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(v - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def loss(m: Tagger, ids: np.ndarray, tags: np.ndarray) -> float:
    """Mean negative log-likelihood of the tags under the CRF."""
    e = emissions(m, ids)
    n, steps, _ = e.shape
    alpha = e[:, 0]
    for t in range(1, steps):
        alpha = e[:, t] + _lse(alpha[:, :, None] + m.t, 1)
    path = e[np.arange(n)[:, None], np.arange(steps), tags].sum(axis=1) + m.t[tags[:, :-1], tags[:, 1:]].sum(axis=1)
    return float((_lse(alpha, 1) - path).mean())


def _sums(transitions: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, ...]:
    """Scaled forward and backward sums of the CRF; their product is the probability of each tag at each place."""
    n, steps, _ = e.shape
    trans, score = np.exp(transitions), np.exp(e - e.max(axis=2, keepdims=True))
    alpha, beta, scale = np.zeros_like(e), np.ones_like(e), np.zeros((n, steps, 1))
    for t in range(steps):
        a = score[:, t] * (alpha[:, t - 1] @ trans if t else 1.0)
        scale[:, t] = a.sum(axis=1, keepdims=True)
        alpha[:, t] = a / scale[:, t]
    for t in range(steps - 2, -1, -1):
        beta[:, t] = (score[:, t + 1] * beta[:, t + 1]) @ trans.T / scale[:, t + 1]
    return alpha, beta, score, scale, trans


def gradients(m: Tagger, ids: np.ndarray, tags: np.ndarray) -> list[np.ndarray]:
    """Gradients of ``loss``, by backpropagation through time."""
    n, steps = ids.shape
    kept = [[], []]
    hs = np.concatenate([_lstm(m, d, ids, kept[d]) for d in (0, 1)], axis=2)
    e = hs @ m.w + m.c
    alpha, beta, score, scale, trans = _sums(m.t, e)
    de = alpha * beta
    de[np.arange(n)[:, None], np.arange(steps), tags] -= 1
    dt = trans * np.einsum("nti,ntj->ij", alpha[:, :-1], score[:, 1:] * beta[:, 1:] / scale[:, 1:])
    np.add.at(dt, (tags[:, :-1], tags[:, 1:]), -1)
    de /= n
    dh = de @ m.w.T
    dx, du, db = np.zeros_like(m.x), np.zeros_like(m.u), np.zeros_like(m.b)
    for d in (0, 1):
        back_h, back_c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        for t, h, c, i, f, o, g, tc in reversed(kept[d]):
            gh = dh[:, t, d * HIDDEN:(d + 1) * HIDDEN] + back_h
            gc = back_c + gh * o * (1 - tc * tc)
            dz = np.concatenate([gc * g * i * (1 - i), gc * c * f * (1 - f), gh * tc * o * (1 - o), gc * i * (1 - g * g)], axis=1)
            np.add.at(dx[d], ids[:, t], dz)
            du[d] += h.T @ dz
            db[d] += dz.sum(axis=0)
            back_h, back_c = dz @ m.u[d].T, gc * f
    return [dx, du, db, np.einsum("nth,ntk->hk", hs, de), de.sum(axis=(0, 1)), dt / n]


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, seed: int = 11, batch: int = 100) -> Tagger:
    """Adam on labelled windows (text, spans); no windows give weights that always say "nothing"."""
    m = Tagger.fresh(seed)
    if not windows:
        m.w[:] = 0
        m.c[0] = 10.0
        return m
    ids = np.zeros((len(windows), WINDOW), np.int64)
    tags = np.zeros((len(windows), WINDOW), np.int64)
    for k, (text, spans) in enumerate(windows):
        own = char_classes(text)[:WINDOW]
        ids[k, :len(own)] = own
        for a, kind, b in spans:
            tags[k, max(a, 0):b] = 2 + 2 * kind
            if a >= 0:
                tags[k, a] = 1 + 2 * kind
    r = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in m.params()]
    second = [np.zeros_like(p) for p in m.params()]
    step = 0
    for _ in range(epochs):
        for part in np.array_split(r.permutation(len(ids)), -(-len(ids) // batch)):
            step += 1
            rate = 0.02 / (1 + step / 150)
            for p, g, a, b in zip(m.params(), gradients(m, ids[part], tags[part]), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return m


def _allowed() -> np.ndarray:
    """Penalty of transitions: the inside of a kind follows only its begin or inside."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -1e4
        out[1 + 2 * k, 2 + 2 * k] = out[2 + 2 * k, 2 + 2 * k] = 0
    return out


def viterbi(m: Tagger, e: np.ndarray) -> np.ndarray:
    """Best tags (n, T) under the transitions for emissions (n, T, TAGS)."""
    n, steps, _ = e.shape
    trans = m.t + _allowed()
    score = e[:, 0].copy()
    score[:, 2::2] -= 1e4
    back = np.zeros((n, steps, TAGS), np.int8)
    for t in range(1, steps):
        s = score[:, :, None] + trans
        back[:, t] = s.argmax(axis=1)
        score = e[:, t] + s.max(axis=1)
    out = np.zeros((n, steps), np.int64)
    out[:, -1] = score.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[np.arange(n), t, out[:, t]]
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """(first, last) window numbers of connected windows that hold a digit or an at-sign."""
    hit: list[int] = []
    for m in TRIGGER.finditer(text):
        k = m.start() // STRIDE
        for w in ((k - 1, k) if k else (k,)):
            if not hit or w > hit[-1]:
                hit.append(w)
    out: list[tuple[int, int]] = []
    for w in hit:
        if out and w == out[-1][1] + 1:
            out[-1] = (out[-1][0], w)
        else:
            out.append((w, w))
    return out


def blended(m: Tagger, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(classes, emissions averaged over the windows) of each text, both padded to whole half windows."""
    # the weights of the two windows over a place add up to one; only a text's ends have one window
    rising = np.repeat((np.arange(STRIDE) + 0.5) / STRIDE, TAGS).astype(np.float32)
    falling = 1 - rising
    sizes = [-(-len(t) // STRIDE) for t in texts]  # windows; a text has one half window more
    first = 0
    while first < len(texts):
        last, many = first + 1, sizes[first]
        while last < len(texts) and many + sizes[last] <= GROUP:
            many += sizes[last]
            last += 1
        ends = np.cumsum([n + 1 for n in sizes[first:last]])
        ids = np.zeros((int(ends[-1]), STRIDE), np.int64)
        for t, n, e in zip(texts[first:last], sizes[first:last], ends):
            ids[e - n - 1:e].reshape(-1)[:len(t)] = char_classes(t)
        starts = np.setdiff1d(np.arange(len(ids)), ends - 1)
        total = np.zeros((len(ids), STRIDE * TAGS), np.float32)
        for k in range(0, len(starts), RUN):
            w = starts[k:k + RUN]
            e = quick_emissions(m, np.concatenate([ids[w], ids[w + 1]], axis=1)).reshape(len(w), -1)
            total[w] += e[:, :STRIDE * TAGS] * rising
            total[w + 1] += e[:, STRIDE * TAGS:] * falling
        some = ends[np.array(sizes[first:last]) > 0]
        total[some - np.array([n for n in sizes[first:last] if n], np.int64) - 1] /= rising
        total[some - 1] /= falling
        for n, e in zip(sizes[first:last], ends):
            yield ids[e - n - 1:e].reshape(-1), total[e - n - 1:e].reshape(-1, TAGS)
        first = last


def open_places(m: Tagger, e: np.ndarray) -> np.ndarray:
    """Whether some span over a place could be worth more than "nothing" in its stead; all others are "nothing" in the best path."""
    out = np.zeros(len(e), bool)
    outer = [0, *range(1, TAGS, 2)]
    for kind in range(len(KINDS)):
        b, i = 1 + 2 * kind, 2 + 2 * kind
        step = max(m.t[b, i], m.t[i, i]) - m.t[0, 0]
        around = max(0.0, (m.t[:, b] - m.t[:, 0]).max()) + max(0.0, (np.maximum(m.t[b], m.t[i]) - m.t[0])[outer].max()) - step
        run = np.zeros(len(e) + 1)
        np.cumsum(np.maximum(e[:, b], e[:, i]) - e[:, 0] + step, out=run[1:])
        best = np.maximum.accumulate(run[:0:-1])[::-1] - np.minimum.accumulate(run[:-1])
        out |= best + around >= -SLACK
    return out


def model_spans(m: Tagger, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind, end, confidence) of every decoded span of every text."""
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    by_size: dict[int, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
    for i, (full, e) in enumerate(blended(m, texts)):
        some = open_places(m, e).reshape(-1, STRIDE).any(axis=1)
        near = some.copy()  # with the half windows around, for the confidence
        near[1:] |= some[:-1]
        near[:-1] |= some[1:]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
        for a, b in edges.reshape(-1, 2) * STRIDE:
            by_size.setdefault(int(b - a), []).append((i, int(a), full[a:b].copy(), e[a:b].astype(np.float64)))
    for size, items in by_size.items():
        many = max(1, RUN * WINDOW // size)
        for k in range(0, len(items), many):
            part = items[k:k + many]
            total = np.stack([x[3] for x in part])
            tags = viterbi(m, total)
            alpha, beta, *_ = _sums(m.t + _allowed(), total)
            p = alpha * beta
            for j, (i, lo, full, _) in enumerate(part):
                row = tags[j] * (full > 0)
                for a in np.flatnonzero(row % 2 == 1):
                    kind = (row[a] - 1) // 2
                    b = a + 1
                    while b < size and row[b] == 2 + 2 * kind:
                        b += 1
                    sure = float(p[j, np.arange(a, b), row[a:b]].min())
                    out[i].append((lo + int(a), int(kind), lo + int(b), sure))
    return out


def find(m: Tagger, texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text its base spans and the spans that the model adds."""
    out = []
    for text, found in zip(texts, model_spans(m, texts)):
        base = base_spans(text)
        added = []
        for a, kind, b, sure in found:
            if sure < MIN_CONFIDENCE or b - a < MIN_SPAN or not TRIGGER.search(text, a, b):
                continue
            if a and text[a - 1].isalnum() or b < len(text) and text[b].isalnum():
                continue
            if any(x < b and a < y for x, _, y in base):
                continue
            added.append((a, kind, b))
        out.append((base, added))
    return out


def training_windows(spark: SparkSession, docs: DataFrame, most: int = TRAIN_WINDOWS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most ``most`` labelled windows, the first in hash order of their text: half with spans, half without."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, spans, has = [], [], []
            for t in b.column(0).to_pylist():
                base = base_spans(t)
                # a phone pattern that ran on into other digits says nothing about the phone in it
                unclear = [m.span() for m in PHONE.finditer(t) if sum(c.isdigit() for c in m[0]) > 15] if "+" in t else []
                for first, last in stretches(t):
                    for w in range(first, last + 1):
                        lo, hi = w * STRIDE, w * STRIDE + WINDOW
                        if any(a < hi and b_ > lo for a, b_ in unclear):
                            continue
                        own = [(a - lo, k, min(b_, hi) - lo) for a, k, b_ in base if a < hi and b_ > lo]
                        text.append(t[lo:hi])
                        spans.append(";".join(f"{a}:{k}:{b_}" for a, k, b_ in own))
                        has.append(bool(own))
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(spans, pa.string()), pa.array(has, pa.bool_())],
                                             ["text", "spans", "has"])

    src = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    cut = save(spark, src.mapInArrow(rows, "text string, spans string, has boolean"), "pii-windows")
    out = []
    for has in (True, False):
        for r in hash_sample(cut.where(F.col("has") == has), "text", most // 2).collect():
            out.append((r["text"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(";") if s]))
    return out


def fit(spark: SparkSession, docs: DataFrame) -> Tagger:
    ready(spark)
    return train(training_windows(spark, docs))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns, with n_added (spans that the model adds)."""
    model = spark.sparkContext.broadcast(fit(spark, docs))

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def scan(text: pd.Series) -> pd.DataFrame:
        rows = []
        for base, added in find(model.value, [t if isinstance(t, str) else "" for t in text]):
            counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added), len(added)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select("doc_id", scan(F.col("text").cast("string")).alias("r")).select("doc_id", "r.*")
