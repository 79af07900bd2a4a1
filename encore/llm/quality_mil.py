"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words). Each passage is
encoded by a small network over its character and word figures and a hashed
sketch of its words; gated attention (Ilse, Tomczak and Welling, 2018) weighs
the passages, and the weighted sum of their codes gives the document's score.
Only document labels are learned from; the attention shows which passages
decide.

The network (some thousand numbers) is trained in NumPy on the driver from a
bounded sample of labelled rows. Scoring is array work on Arrow batches in
the tasks, over whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import id_and_bytes, joined, slices
from encore.llm.labelled import held_out, training_sample
from encore.llm.words import SPACED, runs, spread, words

#: Words of a passage.
PASSAGE = 48
#: Bounds of the fit: labelled rows, and bytes of their texts together.
ROWS, MOST_BYTES = 6000, 1 << 25
CODE, GATE, SKETCH = 24, 12, 16

_CLASSES = [
    [b for b in range(256) if 65 <= b <= 90],
    [b for b in range(256) if 97 <= b <= 122],
    [b for b in range(256) if 48 <= b <= 57],
    list(b"#*$%&|<>"),
    list(b"!?"),
    list(b"."),
    list(b","),
    list(range(128, 256)),
    [10],
]
_MEMBER = np.zeros((len(_CLASSES), 256), bool)
for _i, _c in enumerate(_CLASSES):
    _MEMBER[_i, _c] = True
#: Figures of a passage: shares of the character classes, mean word length,
#: near and far repeats, words of the passage and of the document.
FIGURES = len(_CLASSES) + 5


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of every passage, the document of each, and its byte span.
    A document without words has one passage of zeros."""
    n = len(offsets) - 1
    w = words(data, offsets, SPACED)
    rows = np.arange(n)
    count = np.bincount(w.row, minlength=n)
    before = np.concatenate([[0], np.cumsum(count)])[:-1]
    number = (np.arange(len(w.row)) - before[w.row]) // PASSAGE if len(w.row) else np.zeros(0, np.int64)
    first = runs(np.column_stack([w.row, number]))
    size = np.diff(np.append(first, len(w.row)))
    x = np.zeros((len(first), FIGURES + SKETCH), np.float32)
    if len(first):
        start, end = w.start[first], w.end[first + size - 1]
        length = np.maximum(1, end - start)
        for i in range(len(_CLASSES)):
            total = np.concatenate([[0], np.cumsum(_MEMBER[i][data], dtype=np.int64)])
            x[:, i] = (total[end] - total[start]) / length
        x[:, -SKETCH - 5] = np.add.reduceat(w.end - w.start, first) / size / 10
        near = np.zeros(len(w.hash), bool)
        for d in (1, 2, 3):
            near[d:] |= (w.hash[d:] == w.hash[:-d]) & (w.row[d:] == w.row[:-d])
        x[:, -SKETCH - 4] = np.add.reduceat(near, first, dtype=np.int64) / size
        x[:, -SKETCH - 3] = np.add.reduceat(_told_again(w.hash, w.row), first, dtype=np.int64) / size
        x[:, -SKETCH - 2] = np.log1p(size) / 4
        x[:, -SKETCH - 1] = np.log1p(count[w.row[first]]) / 8
        signs = np.unpackbits((w.hash & np.uint64(0xFFFF)).astype("<u2").view(np.uint8).reshape(-1, 2), axis=1)
        x[:, -SKETCH:] = np.add.reduceat(signs, first, axis=0, dtype=np.int32) / size[:, None] - 0.5
    else:
        start = end = np.zeros(0, np.int64)
    empty = rows[count == 0]
    doc = np.concatenate([w.row[first], empty])
    order = np.argsort(doc, kind="stable")
    x = np.concatenate([x, np.zeros((len(empty), x.shape[1]), np.float32)])[order]
    start, end = (np.concatenate([v, offsets[:-1][empty]])[order] for v in (start, end))
    return x, doc[order], start, end


def _told_again(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Words that begin a three-word run found elsewhere in the same row."""
    out = np.zeros(len(h), bool)
    if len(h) < 3:
        return out
    inside = row[2:] == row[:-2]
    key = spread(spread(h[:-2] + np.uint64(1)) ^ (h[1:-1] + np.uint64(2))) ^ spread(h[2:] ^ row[2:].astype(np.uint64))
    key = key[inside]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twin = np.zeros(len(key), bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    out[:-2][inside] = twin
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of the bags that begin at ``first``, and what back-propagation needs."""
        p = self.params
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        size = np.diff(np.append(first, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
        a /= np.repeat(np.add.reduceat(a, first), size)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        score = 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "score": score, "size": size}


def _gradients(model: QualityModel, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    p, f = model.params, model.forward(x, first)
    out = (f["score"] - y) / len(y)
    dz = np.repeat(out[:, None] * p["c"], f["size"], axis=0)
    da = (dz * f["h"]).sum(axis=1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), f["size"]))
    dg = de[:, None] * p["w"]
    dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
    dh = f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T
    dx = dh * (1 - f["h"] ** 2)
    return {
        "W": f["x"].T @ dx, "b": dx.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
        "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ out, "d": np.array([out.sum()]),
    }


def fit(bodies: list[bytes], labels: np.ndarray, epochs: int = 25, rate: float = 0.01, batch: int = 128, decay: float = 1e-4) -> QualityModel:
    """Train on labelled texts (Adam, shuffled batches of documents, fixed seed)."""
    rng = np.random.default_rng(0)
    width = FIGURES + SKETCH
    shapes = {"W": (width, CODE), "b": (CODE,), "V": (CODE, GATE), "U": (CODE, GATE), "w": (GATE,), "c": (CODE,), "d": (1,)}
    params = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s) for k, s in shapes.items()}
    y = np.asarray(labels, float)
    bags = []
    for i in range(0, len(bodies), 400):
        part = bodies[i : i + 400]
        x, doc, _, _ = passages(np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in part])]))
        bags += np.split(x, runs(doc)[1:])
    model = QualityModel(np.zeros(width), np.ones(width), params)
    if not bags:
        return model
    every = np.concatenate(bags)
    model.mean, model.scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    share = np.clip(y.mean(), 0.01, 0.99)
    params["d"][0] = np.log(share / (1 - share))
    mean, square, step = {k: 0.0 for k in params}, {k: 0.0 for k in params}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            part = [bags[j] for j in pick]
            first = np.concatenate([[0], np.cumsum([len(b) for b in part])[:-1]])
            step += 1
            for k, g in _gradients(model, np.concatenate(part), first, y[pick]).items():
                g = g + decay * params[k] * (k not in "bd")
                mean[k], square[k] = 0.9 * mean[k] + 0.1 * g, 0.999 * square[k] + 0.001 * g * g
                params[k] -= rate * 0.9**epoch * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: Column, rows: int = ROWS, most_bytes: int = MOST_BYTES) -> QualityModel:
    """Fit from the label rows where ``fit_rows`` holds: at most ``rows`` of
    them, whole, with texts of at most ``most_bytes`` together, are brought to the driver."""
    got = training_sample(docs, labels, "quality", fit_rows, rows, most_bytes).orderBy("doc_id", "body").toArrow()
    return fit(got.column("body").to_pylist(), got.column("label").to_numpy())


def score_bodies(data: np.ndarray, offsets: np.ndarray, model: QualityModel) -> np.ndarray:
    if len(offsets) < 2:
        return np.zeros(0)
    x, doc, _, _ = passages(data, offsets)
    return model.forward(x, runs(doc))["score"]


def quality_score(model: QualityModel) -> Column:
    """Score between 0 and 1 of the bytes in column ``body``."""

    @F.arrow_udf("double")
    def score(body: pa.Array) -> pa.Array:
        whole = pa.record_batch([body], ["body"])
        parts = [score_bodies(*joined(s.column("body")), model) for s in slices(iter([whole]), "body", 2 << 20)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score("body")


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``.

    Null and empty texts are one empty passage and get its score. Null ids
    and repeated rows are kept; other columns are ignored; an empty table
    gives no rows.
    """
    return id_and_bytes(docs).select("doc_id", quality_score(model).alias("score"))


def passage_attention(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, start, end, attention``: each passage's code point span and
    its weight in the document's score (they add up to 1)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body", 2 << 20):
            data, offsets = joined(part.column("body"))
            x, doc, start, end = passages(data, offsets)
            a = model.forward(x, runs(doc))["a"]
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = points[offsets[doc]]
            cols = [pa.array(v) for v in (points[start] - base, points[end] - base, a.astype(np.float64))]
            yield pa.record_batch([part.column("doc_id").take(pa.array(doc)), *cols], ["doc_id", "start", "end", "attention"])

    return id_and_bytes(docs).mapInArrow(weigh, "doc_id long, start long, end long, attention double")


def is_held_out() -> Column:
    """Rows whose labels are not learned from: crc32 of the id's text, modulo 5, is 0."""
    return held_out("doc_id", 5, 0)
