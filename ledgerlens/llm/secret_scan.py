"""Secret scans: base rules, and a character convolutional network over every candidate.

Base rules (always reported): ``assign`` (a key word, ``:`` or ``=``, a value of 12 or more
characters), ``access`` (``AKIA`` and 14 or more capitals and digits), ``hex`` (16 or more of
0-9a-f).  Candidates are all runs of ``[A-Za-z0-9+/_.=-]`` of 12 or more characters.  The network reads a window of ``INSIDE`` characters and the text around it as character classes: one
convolution, ReLU, maxima over the window and over its context, one logistic unit.  It slides over a longer
candidate, whose score is the greatest of its windows.  It is
trained in numpy on labelled findings: rule findings of a bounded sample of documents (positive),
the sample's other candidates (negative, but for those like made secrets), and findings of both kinds made by rule from
a fixed seed, so that it is defined for any table.  Half of them calibrate it (Platt scaling) and set the
threshold: the largest one that keeps ``recall`` of the held-out positives.  Candidates at or above
it that touch no base finding are added as ``cnn`` spans.

Scale: one scan, no shuffle; training reads at most ``sample`` documents (smallest id hash) and at most
``most`` different findings of them (smallest hash), ``FIT_LONG`` characters of each.

Defined results: null or empty text: no spans.  Repeated rows: the same spans each.  Spans are code
point offsets, end exclusive, ordered by start, then kind.  Extra columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.sampling import smallest

KINDS = ("assign", "access", "hex", "cnn")
# The base rules, as bytes (all their characters are ASCII).
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEY_STARTS = (b"passw", b"secret", b"token", b"api")

HEX = np.zeros(256, bool)
HEX[0x30:0x3A] = HEX[0x61:0x67] = True
RUN = np.zeros(256, bool)
RUN[[*b"+/_.=-"]] = RUN[0x30:0x3A] = RUN[0x41:0x5B] = RUN[0x61:0x7B] = True

# character classes the network reads (vowels apart, as words have them everywhere); 0 is outside the text
CLASS = np.full(256, 1, np.uint8)
for _i, _chars in enumerate((b"0123456789", b"ae", b"bcdf", b"iouy", b"ghjklmnpqrstvwxz", b"AE", b"BCDF", b"IOUY", b"GHJKLMNPQRSTVWXZ",
                             b"+/", b"_", b".", b"=", b"-", b":", b"\"'", b" ", b"\n\r\t", b"@", b",;"), 2):
    CLASS[[*_chars]] = _i
N_CLASSES = 22
BEFORE, INSIDE, AFTER, WIDTH, FILTERS = 20, 44, 8, 5, 16
LENGTH = BEFORE + INSIDE + AFTER
SURE = 0.99
# positions of the convolution over a candidate, and over what stands before and after it
WITHIN = np.arange(BEFORE - 2, BEFORE + INSIDE - 2)
AROUND = np.r_[0:BEFORE - 2, BEFORE + INSIDE - 2:LENGTH - WIDTH + 1]
FIT_LONG, FIT_STEP = 256, 4  # the fit reads so many characters of a long candidate, and every fourth window


# ------------------------------------------------------------------ rules and candidates
def base_spans(data: bytes, buf: np.ndarray, lower: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) byte spans of the base rules in one text."""
    out = []
    if any(k in lower for k in KEY_STARTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if len(m[2]) >= 12]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if len(m[0]) >= 18]
    return out


def long_runs(buf: np.ndarray, offs: np.ndarray, table: np.ndarray, least: int):
    starts, ends, rows = tk.word_spans(buf, offs, table)
    keep = ends - starts >= least
    return starts[keep], ends[keep], rows[keep]


def candidates(buf: np.ndarray, offs: np.ndarray):
    """Runs of secret-like characters, of the scan, the training and the calibration alike."""
    return long_runs(buf, offs, RUN, 12)


def windows(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Character classes around candidates ``[start, end)`` of texts ``[lo, hi)``, ``LENGTH`` each."""
    out = np.zeros((len(starts), LENGTH), np.uint8)
    for first, size, origin, floor, top in ((0, BEFORE, starts - BEFORE, lo, starts), (BEFORE, INSIDE, starts, starts, ends),
                                            (BEFORE + INSIDE, AFTER, ends, ends, hi)):
        at = origin[:, None] + np.arange(size)
        ok = (at >= floor[:, None]) & (at < top[:, None])
        out[:, first:first + size] = np.where(ok, CLASS[buf[np.clip(at, 0, max(len(buf) - 1, 0))]], 0)
    return out


# ------------------------------------------------------------------ the network
def forward(p: dict, x: np.ndarray):
    """Scores (logits), and what the backward pass needs."""
    n, steps = len(x), LENGTH - WIDTH + 1
    z = np.broadcast_to(p["b"], (n, steps, FILTERS)).copy()
    for k in range(WIDTH):
        z += p["w"][k][x[:, k:k + steps]]
    where = [at[z[:, at].argmax(axis=1)] for at in (WITHIN, AROUND)]
    top = [np.maximum(np.take_along_axis(z, w[:, None], axis=1)[:, 0], 0) for w in where]
    h = np.concatenate(top, axis=1)
    return h @ p["v"] + p["c"], h, where


def running_max(z: np.ndarray, width: int) -> np.ndarray:
    """Maxima over every ``width`` rows."""
    n, span = len(z) - width + 1, 1
    while 2 * span <= width:
        z, span = np.maximum(z[:-span], z[span:]), 2 * span
    return np.maximum(z[:n], z[width - span:width - span + n])


def slid(p: dict, buf: np.ndarray, lo: int, hi: int, start: int, end: int, size: int = 1 << 15) -> float:
    """The greatest score of all windows of a candidate longer than ``INSIDE``, ``size`` of them at a time."""
    best = -np.inf
    for first in range(start, end - INSIDE + 1, size):
        last = min(first + size, end - INSIDE + 1)  # windows begin at first..last-1
        at = np.arange(first - BEFORE, last - 1 + INSIDE + AFTER)
        x = np.where((at >= lo) & (at < hi), CLASS[buf[np.clip(at, 0, len(buf) - 1)]], 0)
        steps = len(x) - WIDTH + 1
        z = p["b"] + sum(p["w"][k][x[k:k + steps]] for k in range(WIDTH))
        n = last - first
        around = np.maximum(running_max(z[:n + BEFORE - 3], BEFORE - 2), running_max(z[BEFORE + INSIDE - 2:], len(AROUND) - BEFORE + 2))
        within = running_max(z[BEFORE - 2:n + BEFORE + INSIDE - 3], INSIDE)
        h = np.maximum(np.concatenate([within, around], axis=1), 0)
        best = max(best, float((h @ p["v"] + p["c"]).max()))
    return best


def scores(p: dict, buf: np.ndarray, lo: np.ndarray, hi: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scores (logits) of candidates: the greatest of a window that slides over them."""
    out = np.zeros(len(starts))
    short = np.flatnonzero(ends - starts <= INSIDE)
    for i in range(0, len(short), 512):
        j = short[i:i + 512]
        out[j] = forward(p, windows(buf, lo[j], hi[j], starts[j], ends[j]))[0]
    for j in np.flatnonzero(ends - starts > INSIDE):
        out[j] = slid(p, buf, int(lo[j]), int(hi[j]), int(starts[j]), int(ends[j]))
    return out


def train_network(x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 30, rate: float = 0.01) -> dict:
    """``x``: windows, ``first[i]:first[i + 1]`` of candidate ``i``; the one with the greatest score is learnt from."""
    rng = np.random.default_rng(seed)
    p = {"w": rng.normal(0, 0.3, (WIDTH, N_CLASSES, FILTERS)), "b": np.zeros(FILTERS), "v": rng.normal(0, 0.3, 2 * FILTERS), "c": np.zeros(1)}
    m, s, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 64):
            j = order[i:i + 64]
            n = first[j + 1] - first[j]
            ends = np.cumsum(n)
            xj = x[np.repeat(first[j] - ends + n, n) + np.arange(ends[-1])]
            logit, h, where = forward(p, xj)
            best = np.array([b - k + logit[b - k:b].argmax() for b, k in zip(ends, n)])
            xj, logit, h, where = xj[best], logit[best], h[best], [w[best] for w in where]
            err = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[j]) * weight[j] / len(j)
            g = {k: np.zeros_like(a) for k, a in p.items()}
            g["v"], g["c"] = h.T @ err, np.array([err.sum()])
            back = err[:, None] * p["v"] * (h > 0)
            for part, top in enumerate(where):
                d = back[:, part * FILTERS:(part + 1) * FILTERS]
                g["b"] += d.sum(axis=0)
                for k in range(WIDTH):
                    np.add.at(g["w"][k], (xj[np.arange(len(j))[:, None], top + k], np.arange(FILTERS)[None]), d)
            t += 1
            for k in p:  # Adam
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)
    return p


def calibrate(logit: np.ndarray, y: np.ndarray, recall: float) -> tuple[float, float, float]:
    """Platt scale and shift, and the largest threshold that keeps ``recall`` of the positives."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))  # Platt's smoothed targets
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        w = np.maximum(q * (1 - q), 1e-9)
        grad = np.array([((q - target) * logit).sum(), (q - target).sum()])
        hess = np.array([[(w * logit ** 2).sum(), (w * logit).sum()], [(w * logit).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    prob = np.sort(1 / (1 + np.exp(-np.clip(a * logit[y == 1] + b, -30, 30))))
    return a, b, float(prob[int((1 - recall) * len(prob))])


SYLLABLES = ("con", "ter", "na", "tion", "al", "in", "ver", "ment", "schaft", "ung", "pre", "able", "lich", "de", "ra", "stra", "ness", "mente", "ble", "per",
             "ge", "heit", "or", "ism", "re", "com", "mu", "ni", "que", "ence", "zu", "sam", "ar", "beit", "ci", "dad", "est", "wick", "lung", "ity")


def made_findings(n: int = 3000, seed: int = 11) -> list[tuple[bytes, int, int, int]]:
    """(text, start, end, label): findings of common shapes, made from a fixed seed."""
    rng = np.random.default_rng(seed)
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    word = lambda: pick(low, int(rng.integers(2, 9)))
    said = lambda k: ["".join(rng.choice(SYLLABLES, int(rng.integers(1, 4)))) for _ in range(k)]
    long_word = lambda: "".join(rng.choice(SYLLABLES, int(rng.integers(4, 8))))
    out = []
    for i in range(n):
        size = int(rng.integers(16, 44))
        secret = (lambda: pick(low + up + dig, size), lambda: pick("abcdef" + dig, size), lambda: pick(low + up + dig + "+/", size) + "=",
                  lambda: pick(low, 3) + "_" + pick(low + up + dig, size), lambda: pick(up + dig, size), lambda: pick(low + up + dig + "-_", size),
                  lambda: pick(low + up, size), lambda: pick(low + dig, size), lambda: pick(low, size + 8), lambda: pick(up, size + 8))
        plain = (lambda: ".".join(str(rng.integers(0, 256)) for _ in range(4)), lambda: f"{word()}.{rng.integers(10, 99)}@{word()}{rng.integers(1, 9)}.{word()}.com",
                 lambda: f"20{rng.integers(10, 30)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}T{rng.integers(10, 24)}", lambda: f"{word()}-{word()}-{rng.integers(10, 9999)}-{word()}",
                 lambda: f"+{rng.integers(1, 99)}-{rng.integers(100, 999)}-{rng.integers(100, 999)}-{rng.integers(1000, 9999)}", lambda: f"{word()}/{word()}/{rng.integers(10, 999)}.{word()}",
                 lambda: f"{word()}_{rng.integers(10, 99)}.{word()}.{rng.integers(0, 99)}", lambda: f"{word()}.{word()}.{rng.integers(100, 9999)}",
                 long_word, lambda: long_word().capitalize(), lambda: long_word().upper(), lambda: "-".join(said(4)), lambda: "_".join(said(4)),
                 lambda: "/".join(said(4)), lambda: "".join(x.capitalize() for x in said(4)), lambda: ".".join(said(3)) + "...", lambda: str(rng.choice([*"-=_."])) * size)
        label = i % 2
        value = (secret if label else plain)[int(rng.integers(len(secret if label else plain)))]()
        if rng.random() < 0.25:  # a long run, with the secret somewhere in it
            path = lambda: "/".join([str(rng.choice(["http", "", "www.home", "data"])), *said(int(rng.integers(2, 8)))])
            tail = str(rng.choice(["", "", "/", ".", "-"]))
            value = path() + str(rng.choice(["/", "=", "/key=", ".", "/id="])) + value + (tail and tail + "/".join(said(int(rng.integers(1, 5)))))
        lead = " ".join(said(3)) + " "
        if rng.random() < (0.5 if label else 0.25):
            lead += str(rng.choice(["key", "auth", "credential", "token", "pwd", "bearer"])) + str(rng.choice([" = ", ": ", "=", ' = "', " "]))
        text = lead + value
        data = (text + str(rng.choice([" ", '"', "\n", ", "])) + " ".join(said(2))).encode()
        buf = np.frombuffer(data, np.uint8)
        s, e, _ = candidates(buf, np.array([0, len(buf)]))
        for a, b in zip(s.tolist(), e.tolist()):
            if b > len(lead.encode()):
                out.append((data, a, b, label))
                break
    return out


def fit(docs: DataFrame, sample: int = 4000, recall: float = 0.99, most: int = 20_000) -> dict:
    """Network, calibration and threshold from a bounded sample of documents and made findings."""
    ids = smallest(docs.where("doc_id IS NOT NULL").select("doc_id"), sample, F.xxhash64("doc_id"), docs.count()).distinct()

    @tk.tidy
    def label(batches):
        for batch in batches:
            buf, offs = tk.utf8(batch.column(0))
            s, e, r = candidates(buf, offs)
            got = []
            for row in np.unique(r):
                a, b = int(offs[row]), int(offs[row + 1])
                spans = all_base(buf[a:b])
                for i in np.flatnonzero(r == row):
                    x, y = int(s[i]) - a, int(e[i]) - a
                    hits = [p for p, _, q in spans if p < y and q > x]
                    if y - x > FIT_LONG:  # the piece with its first rule finding
                        x = max(x, min(hits, default=x) - BEFORE)
                        y = min(y, x + FIT_LONG)
                    hit = bool(hits)
                    got.append((buf[a + max(0, x - BEFORE):min(b, a + y + AFTER)].tobytes(), min(x, BEFORE), min(x, BEFORE) + y - x, int(hit)))
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.binary()), *(pa.array([g[j] for g in got], pa.int64()) for j in (1, 2, 3))],
                                             ["data", "start", "end", "label"])

    found = (docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text").mapInArrow(label, "data binary, start long, end long, label long")
                 .dropDuplicates().orderBy(F.xxhash64("data", "start"), "data", "start").limit(most))
    return fit_rows([(bytes(r["data"]), r["start"], r["end"], r["label"]) for r in found.collect()], recall)


def fit_rows(found: list, recall: float = 0.99) -> dict:
    """The model of sample findings (text, start, end, label) and made ones.

    A candidate without a rule finding may be a secret all the same: those that a network of the made findings
    alone is ``SURE`` of are left out.
    """
    made = made_findings()
    if found:
        sure = _fit(made, recall)
        p = probabilities(sure, _scores_of(sure["net"], found))
        found = [r for r, q in zip(found, p) if r[3] or q < SURE]
    return _fit(found + made, recall)


def probabilities(model: dict, logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model["a"] * logit + model["b"], -30, 30)))


def _scores_of(p: dict, rows: list) -> np.ndarray:
    """Scores of findings, whose texts are laid end to end."""
    buf, ends = np.frombuffer(b"".join(r[0] for r in rows), np.uint8), np.cumsum([len(r[0]) for r in rows])
    lo = ends - [len(r[0]) for r in rows]
    return scores(p, buf, lo, ends, lo + [r[1] for r in rows], lo + [r[2] for r in rows])


def _fit(rows: list, recall: float) -> dict:
    y = np.array([r[3] for r in rows])
    order = np.random.default_rng(3).permutation(len(y))
    learn, hold = order[::2], order[1::2]
    x = []
    for d, a, b, _ in (rows[i] for i in learn):
        at = np.unique([*range(a, b - INSIDE, FIT_STEP), max(a, b - INSIDE)])
        n = np.ones(len(at), np.int64)
        x.append(windows(np.frombuffer(d, np.uint8), 0 * n, len(d) * n, at, np.minimum(at + INSIDE, b)))
    net = train_network(np.concatenate(x), np.cumsum([0, *map(len, x)]), y[learn])
    a, b, threshold = calibrate(_scores_of(net, [rows[i] for i in hold]), y[hold], recall)
    return {"net": net, "a": a, "b": b, "threshold": threshold}


def all_base(buf: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) byte spans of all base rules in one text, sorted."""
    data = buf.tobytes()
    s, e, _ = long_runs(buf, np.array([0, len(buf)]), HEX, 16)
    return sorted([*base_spans(data, buf, data.lower()), *((int(a), 2, int(b)) for a, b in zip(s, e))])


def scan_batch(buf: np.ndarray, offs: np.ndarray, model: dict) -> list[list[tuple[int, int, int, float]]]:
    """Per text: (start, kind, end, probability) in code points, sorted."""
    n = len(offs) - 1
    out: list[list] = [[] for _ in range(n)]
    hs, he, hr = long_runs(buf, offs, HEX, 16)
    for a, b, r in zip(hs.tolist(), he.tolist(), hr.tolist()):
        out[r].append((a, 2, b, 1.0))
    whole = buf.tobytes()
    lower = whole.lower()
    marks = sorted({m.start() for m in re.finditer(rb"passw|secret|token|api", lower)} | {m.start() for m in re.finditer(rb"AKIA", whole)})
    for r in sorted(set((np.searchsorted(offs, marks, "right") - 1).tolist())) if marks else ():
        a, b = int(offs[r]), int(offs[r + 1])
        out[r] += [(a + x, k, a + y, 1.0) for x, k, y in base_spans(whole[a:b], buf[a:b], lower[a:b])]
    s, e, r = candidates(buf, offs)
    prob = probabilities(model, scores(model["net"], buf, offs[r], offs[r + 1], s, e))
    for i in np.flatnonzero(prob >= model["threshold"]):
        a, b, row = int(s[i]), int(e[i]), int(r[i])
        if not any(k < 3 and p < b and q > a for p, k, q, _ in out[row]):
            out[row].append((a, 3, b, float(prob[i])))
    for row in range(n):
        if out[row]:
            lo = int(offs[row])
            chars = tk.code_points(buf[lo:int(offs[row + 1])])
            out[row] = sorted((int(chars[a - lo]), k, int(chars[b - lo]), p) for a, k, b, p in out[row])
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType()), T.StructField("probability", T.DoubleType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def _span_rows(texts, model: dict) -> list[list[dict]]:
    """The spans of a column of texts, a few megabytes at a time."""
    buf, offs = tk.utf8(texts)
    return [[{"kind": KINDS[k], "start": a, "end": b, "probability": p} for a, k, b, p in x]
            for lo, hi in tk.row_chunks(offs) for x in scan_batch(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], model)]


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with ``secret_spans`` (kind, start, end, probability)."""
    plain = docs.drop("secret_spans")
    held = docs.sparkSession.sparkContext.broadcast(model or fit(plain))  # a few thousand weights
    schema = T.StructType([*plain.schema.fields, T.StructField("secret_spans", SPAN)])

    @tk.tidy
    def step(batches):
        for batch in batches:
            got = _span_rows(batch.column(batch.schema.get_field_index("text")), held.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, _ARROW_SPAN)], [*batch.schema.names, "secret_spans"])

    return plain.mapInArrow(step, schema)


def joined(base_only: bool):
    """``kind:start:end`` of the spans, comma-joined, as a column."""
    spans = F.filter("secret_spans", lambda s: s["kind"] != "cnn") if base_only else F.col("secret_spans")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(joined(True), 256).alias("base_sha256"),
                        joined(False).alias("spans"), count("cnn").alias("n_cnn"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (``n_chars``, when present, follows)."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs))  # a few thousand weights

    @tk.tidy
    def cut(batches):
        for batch in batches:
            where = batch.schema.get_field_index("text")
            texts = batch.column(where).to_pylist()
            for i, spans in enumerate(_span_rows(batch.column(where), held.value)):
                if spans:
                    out, at, text = [], 0, texts[i]
                    for s in spans:
                        if s["start"] >= at:
                            out += [text[at:s["start"]], mark]
                        at = max(at, s["end"])
                    texts[i] = "".join([*out, text[at:]])
            cols = [pa.array(texts, pa.string()) if i == where else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    out = docs.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
