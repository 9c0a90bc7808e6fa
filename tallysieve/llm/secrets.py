"""Secret scans: rule findings plus a character convolutional network over candidates and their context.

Three rules give the base findings (kinds assign, access, hex), which always stay. Candidates are all findings and all
other long runs of key characters. A small network reads each candidate with the characters around it; a long one is read
part by part, in overlapping parts and by the words between its joints, and counts as its highest part. It is trained
with numpy on all distinct candidates of the corpus (findings of the rules are secrets, other candidates are not; each
finding also occurs with another candidate's surroundings, so that the shape of the secret counts as well). Where they are
more than a shard takes, tasks train on shards of them, and after each epoch the weights are averaged. The
probabilities are calibrated on candidates held back, and the threshold is the highest one that keeps the wanted recall
there; the precision that it gives there is logged. Candidates above it that are no base finding are added as kind cnn,
of long ones the parts above it; that includes candidates that reach beyond the findings of access and hex in them.

NULL texts count as empty and have no spans. Offsets are code points, ends exclusive. Repeated rows are scanned each;
with fewer than ten findings or ten other candidates to learn from nothing is added; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import logging
import pickle
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, hash_order, sha256_hex, texts

# The patterns of the base findings, and the least length of what they must hold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "cnn")

LOG = logging.getLogger(__name__)
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
RUN = bytes(1 if chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/_=.-") else 0 for b in range(256))
HEX_RUN = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))

#: Characters before, of and behind a candidate that the network reads; long ones are read in parts, a step apart.
BEFORE, INSIDE, BEHIND = 16, 40, 8
STEP = INSIDE // 2
WORD = re.compile(r"[A-Za-z0-9+]{16,}")
WIDTH = BEFORE + INSIDE + BEHIND
CHARS, EMBED, REACH, FILTERS = 97, 8, 5, 24
#: Findings and other candidates that a task learns from at once; of either there are as many shards as it takes.
FINDINGS, OTHERS = 3000, 6000
#: Averaged weights are sums of whole multiples of 1 / UNIT, which no order of tasks changes. Logits are counted in steps, up to a bound.
UNIT, LOGIT_STEP, LOGIT_BOUND = 1 << 24, 0.01, 60.0
EPOCHS, LEAST_STEPS, BATCH, RATE, SEED, RECALL = 6, 500, 64, 0.01, 3, 0.98
SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_cnn long, top_score double"

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Findings of the rules as (start, end, kind) by start, then kind as listed."""
    out: list[Span] = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if b"\x01" * LEAST["hex"] in text.encode("utf-8", "surrogatepass").translate(HEX_RUN):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def other_candidates(text: str, base: list[Span]) -> list[Span]:
    """Long runs of key characters that touch no base finding."""
    if b"\x01" * 16 not in text.encode("utf-8", "surrogatepass").translate(RUN):
        return []
    out, k = [], 0
    ordered = sorted((a, b) for a, b, _ in base)
    for m in CANDIDATE.finditer(text):
        while k < len(ordered) and ordered[k][1] <= m.start():
            k += 1
        if all(b <= m.start() or a >= m.end() for a, b in ordered[k:]):
            out.append((m.start(), m.end(), "cnn"))
    return out


def reaching_candidates(text: str, base: list[Span]) -> list[Span]:
    """Long runs of key characters that touch findings of access or hex and go on beyond them; findings of assign, whose
    value goes to the end of its run, cut what is before them off."""
    if not base:
        return []
    out, k = [], 0
    ordered = sorted(base)
    for m in CANDIDATE.finditer(text):
        while k < len(ordered) and ordered[k][1] <= m.start():
            k += 1
        near = []
        for span in ordered[k:]:
            if span[0] >= m.end():
                break
            if span[1] > m.start():
                near.append(span)
        end = min([m.end(), *(a for a, _, kind in near if kind == "assign")])
        inner = [(a, b) for a, b, kind in near if kind != "assign" and a < end]
        if near and end - m.start() >= 16 and sum(len(range(max(a, m.start()), min(b, end))) for a, b in joined(inner)) < end - m.start():
            out.append((m.start(), end, "cnn"))
    return out


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            start, end = out[-1][0], max(end, out.pop()[1])
        out.append((start, end))
    return out


def parts(text: str, span: Span) -> list[tuple[int, int]]:
    """What the network reads of a span: all of it, or overlapping parts and the words that fit one."""
    start, end, kind = span
    if kind == "assign":  # the value is the secret; the name before it is context
        start = ASSIGN.match(text, start).start(2)
    if end - start <= INSIDE:
        return [(start, end)]
    out = {(at, at + INSIDE) for at in [*range(start, end - INSIDE, STEP), end - INSIDE]}
    return sorted(out | {m.span() for m in WORD.finditer(text, start, end) if m.end() - m.start() <= INSIDE})


def marked(text: str, span: Span, scored: list[tuple[int, int]]) -> list[Span]:
    """The parts of a span that scored, joined where they meet and with the whole words that they cut."""
    out: list[Span] = []
    for start, end in sorted(scored):
        while start > span[0] and text[start - 1].isalnum() and text[start].isalnum():
            start -= 1
        while end < span[1] and text[end - 1].isalnum() and text[end].isalnum():
            end += 1
        if out and start <= out[-1][1]:
            start, end = out[-1][0], max(end, out.pop()[1])
        out.append((start, end, "cnn"))
    return out


def view(text: str, part: tuple[int, int]) -> np.ndarray:
    """Codes of the characters around and within a part; codes within are moved by CHARS."""
    start, end = part
    out = np.zeros(WIDTH, "uint8")
    body = text[start:end]
    before, behind = text[max(0, start - BEFORE) : start], text[end : end + BEHIND]
    chars = np.array([ord(c) for c in before + body + behind], "int64")
    codes = np.where((chars >= 32) & (chars < 127), chars - 31, CHARS - 1)
    codes[len(before) : len(before) + len(body)] += CHARS
    at = BEFORE - len(before)
    out[at : at + len(codes)] = codes
    return out


def transplant(finding: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The finding's characters with the surroundings of another candidate."""
    out = finding.copy()
    out[:BEFORE] = other[:BEFORE]
    last = np.flatnonzero(finding >= CHARS).max() + 1
    ends = np.flatnonzero(other >= CHARS)
    tail = other[ends.max() + 1 :] if len(ends) else other[:0]
    out[last:] = 0
    out[last : last + len(tail)] = tail[: WIDTH - last]
    return out


@dataclass
class Net:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    top: np.ndarray
    offset: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    precision: float = 1.0  # at the threshold, among candidates held back

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.top, self.offset]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        e = self.embed[x]
        patches = np.lib.stride_tricks.sliding_window_view(e, REACH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), -1, REACH * EMBED)
        conv = np.maximum(patches @ self.filters + self.bias, 0)
        most, place, mean = conv.max(1), conv.argmax(1), conv.mean(1)
        pooled = np.concatenate([most, mean], axis=1)
        return pooled @ self.top + self.offset, (patches, conv, place, pooled)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        logits, (patches, conv, place, pooled) = self.forward(x)
        d = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y) / len(x)
        dpool = d[:, None] * self.top
        dconv = np.repeat(dpool[:, None, FILTERS:] / conv.shape[1], conv.shape[1], axis=1)
        dconv[np.arange(len(x))[:, None], place, np.arange(FILTERS)[None, :]] += dpool[:, :FILTERS]
        dconv *= conv > 0
        dfilters = np.tensordot(patches, dconv, axes=([0, 1], [0, 1]))
        dpatch = (dconv @ self.filters.T).reshape(len(x), -1, REACH, EMBED)
        de = np.zeros((len(x), WIDTH, EMBED))
        for k in range(REACH):
            de[:, k : k + dpatch.shape[1]] += dpatch[:, :, k]
        dembed = np.zeros_like(self.embed)
        np.add.at(dembed, x, de)
        return [dembed, dfilters, dconv.sum((0, 1)), pooled.T @ d, d.sum(keepdims=True)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for at in range(0, len(x), 512):
            logits, _ = self.forward(x[at : at + 512])
            out[at : at + 512] = 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -40, 40)))
        return out


def adam(params: list[np.ndarray], slopes, steps: Iterator, rate: float = RATE) -> None:
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step, batch in enumerate(steps, 1):
        for p, g, m, v in zip(params, slopes(batch), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def examples(findings: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.random.Generator]:
    """(views, labels, which are held back, random numbers): findings, the same moved, others."""
    rng = np.random.default_rng(SEED)
    moved = np.stack([transplant(f, others[k]) for f, k in zip(findings, rng.integers(0, len(others), len(findings)))])
    x = np.concatenate([findings, moved, others])
    y = np.concatenate([np.ones(2 * len(findings)), np.zeros(len(others))])
    group = np.concatenate([np.arange(len(findings)), np.arange(len(findings)), np.arange(len(others))])
    return x, y, group % 4 == 0, rng  # held back, a finding together with its moved copy


def untrained(rng: np.random.Generator) -> Net:
    return Net(
        rng.normal(0, 0.3, (2 * CHARS, EMBED)), rng.normal(0, 0.15, (REACH * EMBED, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.2, 2 * FILTERS), np.zeros(1),
    )


def train(findings: np.ndarray, others: np.ndarray, recall: float = RECALL, epochs: int = EPOCHS) -> Net | None:
    if len(findings) < 10 or len(others) < 10:
        return None
    x, y, back, rng = examples(findings, others)
    xs, ys = x[~back], y[~back]
    net = untrained(rng)
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // len(xs)))
    fit(net, xs, ys, rng, epochs)
    calibrate(net, x[back], y[back], recall)
    return net


def fit(net: Net, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int) -> None:
    batches = (order[a : a + BATCH] for _ in range(epochs) for order in [rng.permutation(len(x))] for a in range(0, len(order), BATCH))
    adam(net.params(), lambda b: net.gradients(x[b], y[b]), batches)


def calibrate(net: Net, x: np.ndarray, y: np.ndarray, recall: float) -> None:
    """Slope and shift of the logits by logistic regression with smoothed targets; then the threshold."""
    calibrate_logits(net, logits_of(net, x), y, np.ones(len(x)), recall)


def logits_of(net: Net, x: np.ndarray) -> np.ndarray:
    return np.concatenate([net.forward(x[a : a + 512])[0] for a in range(0, len(x), 512)])


def calibrate_logits(net: Net, logits: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float) -> None:
    """The same from logits that occur `n` times."""
    good, bad = n[y > 0].sum(), n[y == 0].sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    line = np.array([1.0, 0.0])

    def slopes(_):
        d = n * (1 / (1 + np.exp(-np.clip(line[0] * logits + line[1], -40, 40))) - target) / n.sum()
        return [np.array([(d * logits).sum(), d.sum()])]

    adam([line], slopes, iter(range(400)), 0.02)
    net.slope, net.shift = float(max(line[0], 1e-3)), float(line[1])
    every = 1 / (1 + np.exp(-np.clip(net.slope * logits + net.shift, -40, 40)))
    order = np.argsort(every[y > 0], kind="stable")
    below = np.cumsum(n[y > 0][order])
    net.threshold = float(every[y > 0][order][np.searchsorted(below, np.floor((1 - recall) * good), "right")])
    net.precision = float(n[(every >= net.threshold) & (y > 0)].sum() / n[every >= net.threshold].sum())
    LOG.info("threshold %.3f keeps a recall of %.2f with a precision of %.3f", net.threshold, recall, net.precision)


def labelled(docs: DataFrame) -> DataFrame:
    """(secret, view) of every candidate of every text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                base = base_spans(text or "")
                for span in base + other_candidates(text or "", base):
                    rows += [(span[2] != "cnn", view(text, part).tobytes()) for part in parts(text, span)]
            yield pd.DataFrame(rows, columns=["secret", "view"])

    return docs.select("text").mapInPandas(run, "secret boolean, view binary")


def learn(docs: DataFrame, findings: int = FINDINGS, others: int = OTHERS) -> Net | None:
    """Trains on all distinct candidates of all documents, up to so many `findings` and `others` to a shard."""
    stage = Stage(docs.sparkSession)
    found = stage("candidates", labelled(texts(docs)).distinct())
    counts = {r["secret"]: r["count"] for r in found.groupBy("secret").count().collect()}
    stage.free()
    if min(counts.get(True, 0), counts.get(False, 0)) < 10:
        net = None
    elif counts[True] <= findings and counts[False] <= others:
        rows = found.orderBy(F.desc("secret"), hash_order(F.col("view")), "view").toPandas()  # one shard
        net = train(*(np.stack([np.frombuffer(v, "uint8") for v in rows["view"][rows["secret"] == secret]]) for secret in (True, False)))
    else:
        net = train_shards(sharded(found, -(-counts[True] // findings), -(-counts[False] // others), stage))
    stage.drop()
    return net


def sharded(found: DataFrame, findings: int, others: int, stage: Stage) -> DataFrame:
    """(shard, findings, others, own): the views of each shard, staged, a row a shard.

    Findings and other candidates are dealt by hash into as many parts each; there are as many shards as parts of the kind that has
    more, and parts of the other kind serve several. `own` says of which kinds a shard is the first to hold its part.
    """
    shards, order = max(findings, others), hash_order(F.col("view"))
    parts = F.when(F.col("secret"), findings).otherwise(others)
    # A repeated part goes to the shards of its number, and of its number and the number of parts, and so on.
    part = F.pmod(F.xxhash64("view", F.lit("shard")), parts).cast("int")
    dealt = found.select("secret", "view", order.alias("place"), F.explode(F.sequence(part, F.lit(shards - 1), parts)).alias("shard"))

    def put(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "view"])
        kinds = [b"".join(frame["view"][frame["secret"] == secret]) for secret in (True, False)]
        own = 1 * (key[0] < findings) + 2 * (key[0] < others)
        return pd.DataFrame([(key[0], *kinds, own)], columns=["shard", "findings", "others", "own"])

    rows = dealt.groupBy("shard").applyInPandas(put, "shard int, findings binary, others binary, own int")
    return stage("shards", rows)


def _shard(row) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(v, "uint8").reshape(-1, WIDTH) for v in (row.findings, row.others))


def train_shards(shards: DataFrame, recall: float = RECALL, epochs: int = EPOCHS) -> Net:
    """Epochs on all shards from common weights, which are then averaged by the number of views; at last the calibration.

    A task gives one sum, so the driver holds no more than a few weights for each core.
    """
    net = untrained(np.random.default_rng(SEED))
    tasks = min(shards.count(), 4 * shards.sparkSession.sparkContext.defaultParallelism)
    dealt = shards.repartition(tasks, "shard")

    def added(function, of: str) -> np.ndarray:
        sums = dealt.mapInPandas(function, f"{of} array<bigint>").collect()
        return np.sum([np.array(r[0], "int64") for r in sums], axis=0)

    def epoch(weights: bytes, number: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for frame in frames:
                for row in frame.itertuples(index=False):
                    findings, others = _shard(row)
                    if not len(findings) or not len(others):  # nothing to tell apart; a part that hashing left empty
                        continue
                    x, y, back, _ = examples(findings, others)
                    local = pickle.loads(weights)
                    fit(local, x[~back], y[~back], np.random.default_rng([SEED, number, row.shard]), 1)
                    flat = np.concatenate([p.ravel() for p in local.params()])
                    n = int((~back).sum())
                    some = np.concatenate([np.rint(flat * UNIT).astype("int64") * n, [n]])
                    total = some if total is None else total + some
            if total is not None:
                yield pd.DataFrame({"weights": [total.tolist()]})

        return run

    for number in range(epochs):
        total = added(epoch(pickle.dumps(net), number), "weights")
        flat, at = total[:-1] / (total[-1] * UNIT), 0
        for p in net.params():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
    weights, steps = pickle.dumps(net), round(2 * LOGIT_BOUND / LOGIT_STEP) + 1

    def held_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local, total = pickle.loads(weights), np.zeros((2, steps), "int64")
        for frame in frames:
            for row in frame.itertuples(index=False):
                findings, others = _shard(row)
                if not len(findings) or not len(others):
                    continue
                x, y, back, _ = examples(findings, others)
                back &= np.where(y > 0, row.own & 1, row.own & 2) > 0
                if back.any():
                    at = np.floor((np.clip(logits_of(local, x[back]), -LOGIT_BOUND, LOGIT_BOUND) + LOGIT_BOUND) / LOGIT_STEP).astype("int64")
                    np.add.at(total, (y[back].astype("int64"), at), 1)
        yield pd.DataFrame({"counts": [total.ravel().tolist()]})

    counted = added(held_back, "counts").reshape(2, steps)
    label, at = np.nonzero(counted)
    calibrate_logits(net, at * LOGIT_STEP - LOGIT_BOUND, label.astype(float), counted[label, at].astype(float), recall)
    return net


def scan_texts(net: Net | None, part: list[str | None]) -> list[tuple[list[Span], list[Span], float]]:
    """Base spans, added spans and the highest probability of each text; candidates are scored together."""
    base = [base_spans(t or "") for t in part]
    more = [other_candidates(t or "", b) + reaching_candidates(t or "", b) for t, b in zip(part, base)]
    added: list[list[Span]] = [[] for _ in part]
    top = [0.0] * len(part)
    if net is not None:
        places = ((k, span, p) for k, (b, m) in enumerate(zip(base, more)) for span in b + m for p in parts(part[k], span))
        scored = defaultdict(list)
        while some := list(islice(places, 8192)):
            scores = net.probabilities(np.stack([view(part[k], p) for k, _, p in some]))
            for (k, span, p), score in zip(some, scores):
                top[k] = max(top[k], float(score))
                if span[2] == "cnn" and score >= net.threshold:
                    scored[k, span].append(p)
        for (k, span), found in scored.items():
            inside = joined([s[:2] for s in base[k]])
            added[k] += [s for s in marked(part[k], span, found) if not any(a <= s[0] and s[1] <= b for a, b in inside)]
    return [(b, a, t) for b, a, t in zip(base, added, top)]


def spelled(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def scan(docs: DataFrame) -> DataFrame:
    """Counts and spans of each document."""
    weights = pickle.dumps(learn(docs))  # some 30 kB

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = pickle.loads(weights)
        for frame in frames:
            rows = []
            for doc_id, (base, added, top) in zip(frame["doc_id"].astype("Int64"), scan_texts(net, frame["text"].tolist())):
                counts = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
                rows.append((doc_id, *counts, sha256_hex(spelled(base).encode()), spelled(base + added), len(added), top))
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_cnn", "top_score"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(run, SCANNED)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of `docs`, every span of `text` replaced by `mark`; NULL stays NULL."""
    weights = pickle.dumps(learn(docs))

    @F.pandas_udf("string")
    def hide(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = pickle.loads(weights)
        for part in parts:
            whole = part.tolist()
            yield pd.Series([t if t is None else replaced(t, b + a, mark) for t, (b, a, _) in zip(whole, scan_texts(net, whole))], dtype=object)

    return docs.withColumn("text", hide(F.col("text").cast("string")))


def replaced(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start > at or not out:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]
