"""Language identification with a bidirectional gated recurrent network over bytes.

A text is cut into runs of ``SPAN`` bytes. In each run one gated recurrent layer reads
forwards and one backwards; from both states every byte gets probabilities of the
languages, and a document's probabilities are the mean over all its bytes. The network is
trained in numpy by backpropagation through time on a bounded sample of the documents of
every known language; its weights are a few kilobytes. Prediction is one pass over the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from martlet.llm import words as W
from martlet.llm.tables import task

#: Bytes that the network reads at once, and runs that are computed together.
SPAN, LANES = 64, 2048
HIDDEN = 8
#: Bounds of training: documents and runs of each language.
PER_LANGUAGE, RUNS = 400, 1600
#: Languages from which on fewer runs are computed together.
MANY = 64
EPOCHS, BATCH, RATE = 5, 128, 0.02


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the runs of all texts."""
    size = np.diff(off)
    count = -(-size // SPAN)
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = off[doc] + nth * SPAN
    return doc, start, np.minimum(SPAN, off[doc + 1] - start)


def _rows(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of runs by step, forwards and backwards: two arrays (SPAN, runs); steps past a run's end hold any byte."""
    step = np.arange(size.max())[:, None]
    ahead = data[np.minimum(start + step, len(data) - 1)]
    back = data[np.maximum(start + size - 1 - step, 0)]
    return ahead, back


class Network:
    """Weights; direction 0 reads forwards. Gates stand in the order reset, update, candidate."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng, h, c = np.random.default_rng(seed), HIDDEN, len(languages)
        self.languages = languages
        self.w = {"x": rng.normal(0, 0.3, (2, 256, 3 * h)), "u": rng.normal(0, 0.5 / np.sqrt(h), (2, h, 3 * h)),
                  "o": rng.normal(0, 0.3, (2, h, c)), "b": np.zeros(c)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def predict(self, column: pa.Array) -> np.ndarray:
        """Mean probabilities over the bytes of each text; a text without bytes has zeros."""
        data, off = W.utf8(column)
        doc, start, size = spans(data, off)
        out = np.zeros((len(off) - 1, len(self.languages)))
        order = np.argsort(-size, kind="stable")
        together = max(1, LANES * MANY // max(MANY, len(self.languages)))
        for i in range(0, len(order), together):
            lanes = order[i:i + together]
            p = self._lanes(data, start[lanes], size[lanes])
            np.add.at(out, doc[lanes], p)
        return out / np.maximum(1, np.diff(off))[:, None]

    def _lanes(self, data, start, size) -> np.ndarray:
        """Probabilities summed over each run's bytes. Runs come longest first, so those still read are a prefix."""
        h, n = HIDDEN, len(start)
        half = np.ones(3 * h, np.float32)
        half[:2 * h] = 0.5                                             # sigmoid(a) = tanh(a / 2) / 2 + 1/2
        x, u = self.w["x"] * half, self.w["u"] * half
        steps = int(size[0])
        y = np.zeros((2, steps, n, len(self.languages)), np.float32)
        live = np.searchsorted(-size, -np.arange(steps), side="left")
        for d, text in enumerate(_rows(data, start, size)):
            state = np.zeros((n, h), np.float32)
            for t in range(steps):
                m = live[t]
                s = state[:m]
                a, r = x[d][text[t, :m]], s @ u[d]
                g = np.tanh(a[:, :2 * h] + r[:, :2 * h])
                g *= 0.5
                g += 0.5
                c = r[:, 2 * h:]
                c *= g[:, :h]
                c += a[:, 2 * h:]
                np.tanh(c, out=c)
                s -= c
                s *= g[:, h:]
                s += c
                np.matmul(s, self.w["o"][d], out=y[d, t, :m])
        step = np.arange(steps)[:, None]
        back = np.clip(size - 1 - step, 0, None)
        logits = y[0] + y[1][back, np.arange(n)] + self.w["b"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        logits[step >= size] = 0
        return logits.sum(axis=0)

    def gradients(self, data, start, size, label) -> tuple[float, dict]:
        """Mean loss over all bytes of the runs, and its gradients by backpropagation through time.

        Steps past a run's end are computed like others; they come after the run's own and their
        part of the loss is masked, so nothing flows back from them.
        """
        h, n, steps = HIDDEN, len(start), int(size.max())
        w, texts, kept = self.w, _rows(data, start, size), []
        y = np.tile(w["b"], (steps, n, 1))
        step, lane = np.arange(steps)[:, None], np.arange(n)
        live = step < size
        mirror = np.where(live, size - 1 - step, step)                 # byte of a step backwards, and the step of a byte
        for d, text in enumerate(texts):
            s = np.zeros((n, h), np.float32)
            states, gates, cands, rec = [s], [], [], []
            for t in range(steps):
                at = t if d == 0 else mirror[t]
                a, r = w["x"][d][text[t]], s @ w["u"][d]
                g = 1 / (1 + np.exp(-(a[:, :2 * h] + r[:, :2 * h])))
                c = np.tanh(a[:, 2 * h:] + g[:, :h] * r[:, 2 * h:])
                s = c + g[:, h:] * (s - c)
                states.append(s), gates.append(g), cands.append(c), rec.append(r[:, 2 * h:])
                y[at, lane] += s @ w["o"][d]
            kept.append((states, gates, cands, rec))
        y -= y.max(axis=2, keepdims=True)
        p = np.exp(y)
        p /= p.sum(axis=2, keepdims=True)
        loss = -np.log(np.maximum(p[:, lane, label], 1e-9))[live].mean()
        p[:, lane, label] -= 1
        p[~live] = 0
        dy = p / live.sum()
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        grad["b"] = dy.sum(axis=(0, 1))
        for d, text in enumerate(texts):
            states, gates, cands, rec = kept[d]
            ds, da_all = np.zeros((n, h), np.float32), np.zeros((steps, n, 3 * h), np.float32)
            for t in range(steps - 1, -1, -1):
                out = dy[t if d == 0 else mirror[t], lane]
                grad["o"][d] += states[t + 1].T @ out
                ds = ds + out @ w["o"][d].T
                g, c, before = gates[t], cands[t], states[t]
                dc = ds * (1 - g[:, h:]) * (1 - c * c)
                dz = ds * (before - c) * g[:, h:] * (1 - g[:, h:])
                dr = dc * rec[t] * g[:, :h] * (1 - g[:, :h])
                rows = np.concatenate([dr, dz, dc * g[:, :h]], axis=1)
                grad["u"][d] += before.T @ rows
                da_all[t] = np.concatenate([dr, dz, dc], axis=1)
                ds = ds * g[:, h:] + rows @ w["u"][d].T
            one = np.zeros((steps * n, 256), np.float32)
            one[np.arange(steps * n), text.ravel()] = 1
            grad["x"][d] = one.T @ da_all.reshape(-1, 3 * h)
        return float(loss), grad


def fit(texts: list[str], languages: list[str], seed: int = 7) -> Network:
    """Train on equally many runs of each language that has a byte of text, last and shorter runs included (Adam, falling rate)."""
    names = sorted({x for x, t in zip(languages, texts) if t}) or ["und"]
    net, rng = Network(names, seed), np.random.default_rng(seed)
    if len(names) < 2:
        return net
    data, off = W.utf8(pa.array(texts, pa.string()))
    doc, start, size = spans(data, off)
    number = {x: k for k, x in enumerate(names)}
    own = np.array([number.get(x, -1) for x in languages])[doc]         # texts without bytes have no runs
    order = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[order], np.arange(len(names) + 1))
    runs = np.concatenate([rng.choice(at, RUNS, replace=len(at) < RUNS) for at in np.split(order, edges[1:-1])])
    m, v = ({k: np.zeros_like(x) for k, x in net.w.items()} for _ in range(2))
    total, i = EPOCHS * -(-len(runs) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(runs)
        for j in range(0, len(runs), BATCH):
            b = runs[j:j + BATCH]
            _, grad = net.gradients(data, start[b], size[b], own[b])
            i += 1
            rate = RATE * (1 - i / (total + 1))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.w[k] -= (rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.99 ** i)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame) -> Network:
    """Fit on rows of ``docs`` (doc_id, text, lang); rows without id, text or language are left out.

    The sample is drawn by a hash of the id: at most PER_LANGUAGE documents of each
    language. Every language with a text that isn't empty is learnt, however rare it is.
    """
    known = docs.filter("text <> '' and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    share = known.groupBy(F.col("lang").alias("of")).agg(F.least(F.lit(1.0), 1.5 * PER_LANGUAGE / F.count("*")).alias("share"))
    order = F.xxhash64(F.lit("language"), "doc_id")
    drawn = (known.select("doc_id", "lang").join(F.broadcast(share), F.col("lang") == F.col("of")).filter(F.pmod(order, F.lit(1 << 20)) < F.col("share") * (1 << 20))
             .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))).filter(F.col("place") <= PER_LANGUAGE)
             .select(F.col("doc_id").alias("id"), F.col("lang").alias("of")).distinct())
    rows = sorted(known.join(F.broadcast(drawn), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of"))).select("doc_id", "text", "lang").collect())
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``score`` is the mean probability of the predicted language over the text's bytes.
    Texts that are null or have no letter are ``und`` with score 0. Repeated rows get equal
    results; a null id stays null. An empty table gives an empty result.
    """
    def run(batches):
        for batch in batches:
            for part in W.blocks(batch, "text"):
                p = net.predict(part.column(1))
                best = p.argmax(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([net.languages[k] for k in best], pa.string()),
                                                  pa.array(np.clip(p[np.arange(len(p)), best], 0, 1).astype(float)), part.column(2)],
                                                 names=["doc_id", "lang_pred", "score", "lettered"])

    told = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("lettered", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
            .mapInArrow(task(run), "doc_id long, lang_pred string, score double, lettered boolean"))
    return told.select("doc_id", F.when(F.col("lettered"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                       F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"))
