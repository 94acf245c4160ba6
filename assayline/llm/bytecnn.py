"""Quality of a text by a convolutional network over its bytes, in numpy.

Bytes -> filters of WIDTH bytes, rectified -> largest value in each chunk; chunks overlap and
cover the whole text -> mean and largest of the chunks -> one hidden layer -> a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import add_columns, held_out, text_or_empty

WIDTH, FILTERS, HIDDEN = 5, 16, 16
#: A chunk begins every STRIDE bytes and shares OVERLAP bytes with the next one.
STRIDE, OVERLAP = 448, 64
#: The fit sees at most so many labelled rows, those with the smallest hash of the id, and of
#: them those of at most so many bytes.  Scores cover every text whole.
FIT_ROWS, FIT_BYTES = 4000, 1 << 16
#: Few rows are gone over more often, until so many steps are made.
EPOCHS, MIN_STEPS, BATCH, RATE = 8, 300, 64, 0.01
#: Bytes whose activations are held at a time.
BLOCK = 1 << 17


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS: what a byte at a place adds to a filter
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def pooled(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Largest activation per piece; pieces begin at ``starts``."""
        total = np.take(self.filters[0], data[: len(data) - WIDTH + 1], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.filters[k], data[k : len(data) - WIDTH + 1 + k], axis=0)
        return np.maximum(np.maximum.reduceat(total, starts, axis=0) + self.bias, 0)

    def probability(self, features: np.ndarray) -> np.ndarray:
        inner = np.maximum(features @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-(inner @ self.out + self.out_bias).astype(np.float64)))


def pieces(size: int) -> np.ndarray:
    """Where the pieces of a text begin: OVERLAP bytes, then STRIDE - OVERLAP bytes, in turn; and its end.

    A chunk is a short piece, the long one after it and the next short one.  What follows the end,
    up to the next text, is a piece that nobody uses.
    """
    chunks = np.arange(0, size, STRIDE)
    starts = np.stack([chunks, chunks + OVERLAP], 1).ravel()
    return np.append(starts[starts < size], size)


def chunk_features(pooled: np.ndarray) -> np.ndarray:
    """Mean and largest over the chunks of one text's pooled pieces."""
    chunks = pooled[0::2].copy()
    longs = pooled[1::2]
    chunks[: len(longs)] = np.maximum(chunks[: len(longs)], longs)
    chunks[:-1] = np.maximum(chunks[:-1], pooled[2::2])
    return np.concatenate([chunks.mean(0), chunks.max(0)])


def features(net: Network, texts: list[bytes]) -> np.ndarray:
    """Features of whole texts, a bounded block of bytes at a time."""
    rows = np.zeros((len(texts), 2 * FILTERS), np.float32)
    block: list[np.ndarray] = []
    held = 0

    def flush():
        nonlocal block, held
        if not block:
            return
        data = np.concatenate([x for _, x, _ in block])
        offset, starts = 0, []
        for _, x, p in block:
            starts.append(p + offset)
            offset += len(x)
        best = net.pooled(data, np.concatenate(starts))
        at = 0
        for i, _, p in block:
            out[i].append(best[at : at + len(p) - 1])
            at += len(p)
        block, held = [], 0

    out: list[list[np.ndarray]] = [[] for _ in texts]
    part = STRIDE * (BLOCK // STRIDE)
    for i, text in enumerate(texts):
        # An empty text is one zero byte, and all see zeros behind their end.
        data = np.concatenate([np.frombuffer(text or b"\0", np.uint8), np.zeros(WIDTH, np.uint8)])
        size = len(data) - WIDTH
        for begin in range(0, size, part):
            padded = data[begin : begin + part + WIDTH]
            block.append((i, padded, pieces(min(part, size - begin))))
            held += len(padded)
            if held >= BLOCK:
                flush()
    flush()
    for i, found in enumerate(out):
        rows[i] = chunk_features(found[0] if len(found) == 1 else np.concatenate(found))
    return rows


def fit(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """Train by Adam on the logistic loss; the same rows give the same network."""
    rng = np.random.default_rng(seed)
    f32 = np.float32
    p = {
        "filters": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(f32), "bias": np.zeros(FILTERS, f32),
        "hidden": rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)).astype(f32), "hidden_bias": np.zeros(HIDDEN, f32),
        "out": rng.normal(0, 0.2, HIDDEN).astype(f32), "out_bias": np.zeros(1, f32),
    }
    y = np.array(labels, f32)
    if not len(y):
        p["out"][:] = 0
        return Network(**{**p, "out_bias": 0.0})
    share = min(max(y.mean(), 0.02), 0.98)
    p["out_bias"][:] = np.log(share / (1 - share))
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step, tail = 0, np.zeros(WIDTH, np.uint8)
    padded = [np.concatenate([np.frombuffer(t, np.uint8), tail]) for t in texts]
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // len(y)))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            g = {k: np.zeros_like(x) for k, x in p.items()}
            feats, back = np.zeros((len(rows), 2 * FILTERS), f32), []
            for r, i in enumerate(rows):
                data = padded[i]
                n = len(data) - WIDTH + 1
                total = np.take(p["filters"][0], data[:n], axis=0)
                for k in range(1, WIDTH):
                    total += np.take(p["filters"][k], data[k : n + k], axis=0)
                size = max(len(data) - WIDTH, 1)
                begins = np.arange(0, size, STRIDE)
                where = np.stack([b + total[b : min(b + STRIDE + OVERLAP, size)].argmax(0) for b in begins])
                best = np.maximum(np.take_along_axis(total, where, 0) + p["bias"], 0)
                top = best.argmax(0)
                feats[r] = np.concatenate([best.mean(0), best.max(0)])
                back.append((data, where, best, top))
            z = feats @ p["hidden"] + p["hidden_bias"]
            inner = np.maximum(z, 0)
            q = 1 / (1 + np.exp(-(inner @ p["out"] + p["out_bias"])))
            dq = (q - y[rows]) / len(rows)
            g["out"], g["out_bias"] = inner.T @ dq, np.array([dq.sum()], f32)
            dz = np.outer(dq, p["out"]) * (z > 0)
            g["hidden"], g["hidden_bias"] = feats.T @ dz, dz.sum(0)
            df = dz @ p["hidden"].T
            lanes = np.arange(FILTERS)
            for r, (data, where, best, top) in enumerate(back):
                db = np.repeat(df[r, None, :FILTERS] / len(best), len(best), 0)
                db[top, lanes] += df[r, FILTERS:]
                db *= best > 0
                g["bias"] += db.sum(0)
                lane = np.broadcast_to(lanes, where.shape)
                for k in range(WIDTH):
                    np.add.at(g["filters"][k], (data[where + k], lane), db)
            step += 1
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(f32)
    return Network(**{**p, "out_bias": float(p["out_bias"][0])})


def fit_on(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", rows: int = FIT_ROWS) -> Network:
    """Fit on at most ``rows`` labelled documents outside the held-out fifth.

    The ids are chosen from the labels first, so that only chosen texts travel.  Null labels, null
    ids and texts above FIT_BYTES are not fitted on; with nothing to fit, every score is one half.
    """
    picked = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key is not null and label in (0, 1)")
        .where(~held_out(0, "key")).groupBy("key").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key").limit(rows)
    )
    body = documents.select(F.col(key).alias("key"), text_or_empty(text).alias("body")).where(F.octet_length("body") <= FIT_BYTES)
    found = sorted(((r.key, r.body, r.label) for r in body.join(picked, "key").orderBy(F.xxhash64("key"), "key", "body").limit(rows).collect()), key=lambda r: r[:2])
    return fit([b.encode() for _, b, _ in found], [x for _, _, x in found])


def score(df: DataFrame, net: Network, text: str = "text", column: str = "score") -> DataFrame:
    """Add the probability that a text is of quality, from its bytes alone; null is the empty text."""

    def task(columns):
        for (texts,) in columns:
            yield [pa.array(net.probability(features(net, texts.cast(pa.binary()).to_pylist())), pa.float64())]

    return add_columns(df, [text_or_empty(text)], task, f"`{column}` double")
