"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into rows of consecutive bytes; a forward and a backward pass give every byte a probability for each
language, and a document's probability is the mean over all its bytes. The network is trained with numpy by
backpropagation through time, on rows drawn from a bounded number of documents of each language.

NULL texts and texts without a letter are `und` with score 0, and so is everything if nothing could be learnt. Rows
without a language are predicted but not learnt from. Repeated rows get the same answer each; extra columns are
ignored; an empty table gives no rows. Rows without doc_id count as held out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, hash_order

#: Bytes in a row, hidden units of each direction, rows computed together.
STEPS, HIDDEN, ROWS = 64, 8, 1024
#: Fitting sample: documents of each language and rows of each document.
DOCS_PER_LANG, ROWS_PER_DOC, SALTS = 400, 12, 64
EPOCHS, BATCH, RATE, SEED = 4, 128, 0.02, 11
PAD = 256
UNKNOWN = "und"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def gate(x: np.ndarray) -> np.ndarray:
    """Logistic function in place, by way of tanh, which numpy vectorises."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@dataclass
class Direction:
    """Gates stacked as reset, update, candidate; arrays are (units, rows)."""

    inputs: np.ndarray  # (3H, 257): input weights of each byte with the bias
    hidden: np.ndarray  # (3H, H)
    grads: list = field(default_factory=list)

    def forward(self, bytes_: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        steps, rows = bytes_.shape
        units = self.hidden.shape[1]
        out = np.empty((steps, units, rows), "float32")
        h, kept = np.zeros((units, rows), "float32"), []
        gh = np.empty((3 * units, rows), "float32")
        for t in range(steps):
            gx = np.take(self.inputs, bytes_[t], axis=1)
            np.matmul(self.hidden, h, out=gh)
            gx[: 2 * units] += gh[: 2 * units]
            gates = gate(gx[: 2 * units])
            n = gx[2 * units :]
            n += gates[:units] * gh[2 * units :]
            np.tanh(n, out=n)
            new = out[t]
            np.subtract(h, n, out=new)
            new *= gates[units:]
            new += n
            if keep:
                kept.append((h, gx, gh[2 * units :].copy()))
            h = new
        return out, kept

    def backward(self, bytes_: np.ndarray, kept: list, dout: np.ndarray) -> list[np.ndarray]:
        steps, units, rows = dout.shape
        dh = np.zeros((units, rows), "float32")
        dhidden = np.zeros_like(self.hidden)
        dall = np.empty((steps, 3 * units, rows), "float32")
        for t in reversed(range(steps)):
            h, g, recurrent = kept[t]
            r, z, n = g[:units], g[units : 2 * units], g[2 * units :]
            dh = dh + dout[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * recurrent * r * (1 - r)
            dx = dall[t]
            dx[:units], dx[units : 2 * units], dx[2 * units :] = dr, dz, dn
            drec = np.concatenate([dr, dz, dn * r])
            dhidden += drec @ h.T
            dh = dh * z + self.hidden.T @ drec
        flat = bytes_.reshape(-1)
        dinputs = np.stack(
            [np.bincount(flat, weights=dall[:, k].reshape(-1), minlength=PAD + 1) for k in range(3 * units)]
        ).astype("float32")
        return [dinputs, dhidden]


class Network:
    def __init__(self, langs: list[str], units: int = HIDDEN, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype("float32")
        self.langs = langs
        self.ways = [Direction(draw(3 * units, PAD + 1), draw(3 * units, units)) for _ in range(2)]
        self.top = [draw(len(langs), units), draw(len(langs), units), np.zeros((len(langs), 1), "float32")]

    def params(self) -> list[np.ndarray]:
        return [p for way in self.ways for p in (way.inputs, way.hidden)] + self.top

    def label(self, rows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Probabilities (steps, langs, rows) of every position of (rows, steps) bytes."""
        ahead = np.ascontiguousarray(rows.T)
        back = np.ascontiguousarray(ahead[::-1])
        hf, kf = self.ways[0].forward(ahead, keep)
        hb, kb = self.ways[1].forward(back, keep)
        hb = hb[::-1]
        p = self.top[0] @ hf
        p += self.top[1] @ hb
        p += self.top[2]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p, (ahead, back, hf, hb, kf, kb)

    def gradients(self, rows: np.ndarray, langs: np.ndarray) -> list[np.ndarray]:
        p, (ahead, back, hf, hb, kf, kb) = self.label(rows, keep=True)
        d = p
        d[:, langs, np.arange(len(langs))] -= 1
        mask = (ahead != PAD).astype("float32")
        d *= (mask / mask.sum())[:, None, :]
        dtop = [np.einsum("tlb,thb->lh", d, hf), np.einsum("tlb,thb->lh", d, hb), d.sum(axis=(0, 2))[:, None]]
        df = self.top[0].T @ d
        db = (self.top[1].T @ d)[::-1]
        return self.ways[0].backward(ahead, kf, df) + self.ways[1].backward(back, kb, db) + dtop

    def fit(self, rows: np.ndarray, langs: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.params()]
        second = [np.zeros_like(p) for p in self.params()]
        step, steps = 0, epochs * -(-len(rows) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                step += 1
                pace = rate * (1 - step / (steps + 1))
                for p, g, m, v in zip(self.params(), self.gradients(rows[pick], langs[pick]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def pooled(self, bodies: list[bytes]) -> np.ndarray:
        """Mean probabilities (documents, langs); zero for empty bodies."""
        counts = [-(-len(b) // STEPS) for b in bodies]
        rows = np.concatenate([rows_of(b) for b in bodies]) if bodies else np.empty((0, STEPS), "int16")
        sums = np.zeros((len(rows), len(self.langs)))
        for at in range(0, len(rows), ROWS):
            part = rows[at : at + ROWS]
            p, _ = self.label(part)
            if (part[:, -1] == PAD).any():
                p *= (part.T != PAD)[:, None, :]
            sums[at : at + ROWS] = p.sum(axis=0).T
        out = np.zeros((len(bodies), len(self.langs)))
        owner = np.repeat(np.arange(len(bodies)), counts)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, weights=sums[:, k], minlength=len(bodies))
        return out / np.maximum([len(b) for b in bodies], 1)[:, None]


def rows_of(body: bytes) -> np.ndarray:
    count = -(-len(body) // STEPS)
    rows = np.full(count * STEPS, PAD, "int16")
    rows[: len(body)] = np.frombuffer(body, "uint8")
    return rows.reshape(count, STEPS)


def fitting_rows(docs: DataFrame, per_lang: int = DOCS_PER_LANG, per_doc: int = ROWS_PER_DOC) -> DataFrame:
    """(lang, row) of up to `per_doc` rows, spread over the whole text, of `per_lang` documents of each language."""
    ids = docs.where("lang is not null and doc_id is not null and text is not null")
    ids = ids.select("doc_id", "lang", hash_order(F.col("doc_id")).alias("order"), F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("salt"))
    # First within salts of each language, since one language may hold most rows, then within the language.
    for within in (["lang", "salt"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*within).orderBy("order", "doc_id"))
        ids = ids.withColumn("place", place).where(F.col("place") <= per_lang)
    drawn = ids.select("doc_id").distinct()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for lang, text in zip(frame["lang"], frame["text"]):
                rows = rows_of(text.encode("utf-8", "surrogatepass"))
                for k in sorted({int(x) for x in np.linspace(0, len(rows) - 1, per_doc)} if len(rows) else ()):
                    out.append((lang, rows[k].astype("<i2").tobytes()))
            yield pd.DataFrame(out, columns=["lang", "row"])

    # The drawn ids are at most per_lang for each language.
    chosen = docs.where("lang is not null").join(F.broadcast(drawn), "doc_id")
    return chosen.select("lang", "text").mapInPandas(cut, "lang string, row binary")


def train(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> Network | None:
    """`docs`: doc_id, text, lang of the rows that may be learnt from."""
    drawn = fitting_rows(docs, per_lang).toPandas().sort_values(["lang", "row"], kind="stable")
    if drawn.empty:
        return None
    langs = sorted(drawn["lang"].unique())
    network = Network(langs)
    rows = np.stack([np.frombuffer(r, "<i2") for r in drawn["row"]])
    network.fit(rows, np.array([langs.index(x) for x in drawn["lang"]]))
    return network


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict(docs: DataFrame, held_out: Column, network: Network | None, portion: int = 1_000_000) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    weights = pickle.dumps(network)  # some 50 kB, whatever the data

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = pickle.loads(weights)
        for frame in frames:
            names, scores, bodies, size, at = [UNKNOWN] * len(frame), [0.0] * len(frame), {}, 0, 0

            def flush() -> None:
                places = list(bodies)
                pooled = net.pooled(list(bodies.values()))
                for place, p in zip(places, pooled):
                    best = int(p.argmax())
                    names[place], scores[place] = net.langs[best], float(min(1.0, p[best]))
                bodies.clear()

            for at, text in enumerate(frame["text"]):
                if net is not None and has_letter(text):
                    bodies[at] = text.encode("utf-8", "surrogatepass")
                    size += len(bodies[at])
                    if size >= portion:
                        flush()
                        size = 0
            if bodies:
                flush()
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"], "lang_pred": names, "score": scores})

    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
    )
    return wanted.mapInPandas(run, PREDICTED)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the documents whose fold of three is not 1 and predicts all."""
    held_out = fold(F.col("doc_id"), 3) == 1
    network = train(docs.select("doc_id", "text", "lang").where(~held_out))
    return predict(docs, held_out, network)
