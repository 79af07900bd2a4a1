"""Toxicity by multiple-instance learning with a noisy-or.

A document is a bag of sentences. A sentence's score is a logistic function of
the weights of its words and of their first letters (so that forms of one stem
share what is learned); a document is toxic unless every sentence is clean:
score = 1 - prod(1 - p). A sentence's p is what its words add to the chance
that any sentence has (the bias): without telling words it is 0, and a sentence
whose p is under ``FLOOR`` is taken for one without, so that weakly telling words, of
which a long text has many, do not add up and a clean document's score does
not grow with its length. The word weights are learned from document labels
alone by gradient descent on the document likelihood, so the sentences that
carry a toxic label are found by the fit, and ``toxic_sentences`` lists them.

Weights are a table over hashed words (fixed size), fitted on the driver from a
bounded sample of labelled rows; scoring is array work on Arrow batches in
the tasks, without a shuffle.
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
from encore.llm.words import LETTERS, Words, prefixes, runs, words

#: Hashed words are counted in 2 ** BITS cells.
BITS = 18
#: Bounds of the fit: labelled rows, and bytes of their texts together.
ROWS, MOST_BYTES = 8000, 1 << 25
#: Chance from which on a sentence counts in a document's score.
FLOOR = 0.25
#: Documents whose words are laid out at a time in the fit.
AT_ONCE = 400
#: Beginnings of words that have weights of their own, in bytes.
PREFIXES = (3, 4, 5, 6)
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Bags:
    """Words of many documents: ``cell`` (weights' places, one column for the
    word and for each of its beginnings), first word and document of each sentence."""

    cell: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    found: Words


def bags(data: np.ndarray, offsets: np.ndarray) -> Bags:
    w = words(data, offsets, LETTERS)
    breaks = np.cumsum(_BREAKS[data])
    first = runs(np.column_stack([w.row, breaks[w.start]])) if len(w.start) else np.zeros(0, np.int64)
    hashes = [w.hash, *(prefixes(data, w, n, LETTERS) for n in PREFIXES)]
    cell = np.column_stack([h >> np.uint64(64 - BITS) for h in hashes]).astype(np.int32)
    return Bags(cell, first, w.row[first], w)


def sentence_logits(b: Bags, weights: np.ndarray, bias: float) -> np.ndarray:
    return np.add.reduceat(weights[b.cell].sum(axis=1, dtype=np.float64), b.first) + bias if len(b.first) else np.zeros(0)


def masses(logits: np.ndarray, bias: float) -> np.ndarray:
    """-log(1 - p) of each sentence over that of one without telling words."""
    return np.maximum(np.logaddexp(0, logits) - np.logaddexp(0, bias), 0)


def noisy_or(logits: np.ndarray, doc: np.ndarray, n: int, bias: float = -np.inf, floor: float = 0.0) -> np.ndarray:
    """1 - prod(1 - sigmoid(logit)) for each of ``n`` documents, over the chance
    that ``bias`` alone gives a sentence and without sentences under ``floor``; 0 without sentences."""
    if not len(doc):
        return np.zeros(n)
    mass = masses(logits, bias)
    return -np.expm1(-np.bincount(doc, weights=np.where(mass < -np.log1p(-floor), 0.0, mass), minlength=n))


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float


def telling(n: np.ndarray, c: np.ndarray, y: np.ndarray, doubt: float) -> tuple[np.ndarray, np.ndarray]:
    """Cells met in toxic documents more often than chance allows, and their log-odds.

    The evidence of a cell in n documents, c of them toxic, is n times the
    relative entropy of c / n against the share of toxic documents (the
    Chernoff bound); it must exceed the log of the number of cells by ``doubt``.
    """
    q = y.mean()
    share = np.clip(c / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    evidence = n * (share * np.log(share / q) + (1 - share) * np.log((1 - share) / (1 - q)))
    used = np.flatnonzero((share > q) & (evidence > np.log(max(1, (n > 0).sum())) + doubt))
    odds = np.log((c[used] + 0.1) / y.sum()) - np.log((n[used] - c[used] + 0.1) / (1 - y).sum())
    return used, odds


def _parts(bodies: list[bytes]) -> Iterator[tuple[int, Bags]]:
    for i in range(0, len(bodies), AT_ONCE):
        part = bodies[i : i + AT_ONCE]
        yield i, bags(np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in part])]))


def fit(bodies: list[bytes], labels: np.ndarray, epochs: int = 200, rate: float = 0.05, doubt: float = 4.0) -> ToxicityModel:
    """Fit on labelled texts: weights of the telling cells start from their
    log-odds and follow the gradient of the noisy-or likelihood (Adam over all
    documents); other cells weigh nothing. Without both labels all scores are near 0."""
    weights, bias = np.zeros(1 << BITS, np.float32), -9.0
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(weights, bias)
    n, c = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for i, b in _parts(bodies):
        doc = np.repeat(b.found.row, b.cell.shape[1])
        pairs = np.unique(doc << BITS | b.cell.reshape(-1))
        at = pairs & ((1 << BITS) - 1)
        n += np.bincount(at, minlength=1 << BITS)
        c += np.bincount(at, weights=y[i + (pairs >> BITS)], minlength=1 << BITS)
    used, odds = telling(n, c, y, doubt)
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    docs, sentences, cells, total = [], [], [], 0
    for i, b in _parts(bodies):
        cell = place[b.cell]
        sentence = np.repeat(np.arange(len(b.first)), np.diff(np.append(b.first, len(b.cell))))
        kept, _ = np.nonzero(cell >= 0)
        cells.append(cell[cell >= 0])
        sentences.append(sentence[kept] + total)
        docs.append(b.doc + i)
        total += len(b.first)
    doc, sentence, cell = (np.concatenate(v) for v in (docs, sentences, cells))
    x = np.append(odds, bias)
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, epochs + 1):
        z = np.bincount(sentence, weights=x[cell], minlength=len(doc)) + x[-1]
        mass = np.bincount(doc, weights=masses(z, x[-1]), minlength=len(y))
        # d loss / d mass: 1 for a clean document, -q / (1 - q) with q = exp(-mass) for a toxic one
        pull = np.where(y > 0, -1 / np.expm1(np.clip(mass, 1e-9, 50)), 1.0)
        p, background = (1 / (1 + np.exp(np.minimum(-v, 50))) for v in (z, x[-1]))
        back, over = (np.clip(pull[doc] * v, -1, 1) for v in (p, p - background))
        grad = np.append(np.bincount(cell, weights=back[sentence], minlength=len(used)), over.sum()) / len(y)
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        x -= rate * mean / (1 - 0.9**t) / (np.sqrt(square / (1 - 0.999**t)) + 1e-6)
        x[:-1] = np.maximum(x[:-1], 0)
    weights[used] = x[:-1]
    return ToxicityModel(weights, float(x[-1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: Column, rows: int = ROWS, most_bytes: int = MOST_BYTES) -> ToxicityModel:
    """Fit from the label rows where ``fit_rows`` holds: at most ``rows`` of
    them, whole, with texts of at most ``most_bytes`` together, are brought to the driver."""
    got = training_sample(docs, labels, "toxic", fit_rows, rows, most_bytes).orderBy("doc_id", "body").toArrow()
    return fit(got.column("body").to_pylist(), got.column("label").to_numpy())


def score_bodies(data: np.ndarray, offsets: np.ndarray, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray, Bags]:
    """Document scores, sentence logits and the bags of a batch."""
    b = bags(data, offsets)
    z = sentence_logits(b, model.weights, model.bias)
    return noisy_or(z, b.doc, len(offsets) - 1, model.bias, FLOOR), z, b


def toxicity_score(model: ToxicityModel) -> Column:
    """Score between 0 and 1 of the bytes in column ``body`` (empty: 0)."""

    @F.arrow_udf("double")
    def score(body: pa.Array) -> pa.Array:
        whole = pa.record_batch([body], ["body"])
        parts = [score_bodies(*joined(s.column("body")), model)[0] for s in slices(iter([whole]), "body", 2 << 20)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score("body")


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``.

    Null and empty texts score 0. Null ids and repeated rows are kept; other
    columns are ignored; an empty table gives no rows.
    """
    return id_and_bytes(docs).select("doc_id", toxicity_score(model).alias("score"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score under ``least``; columns as given."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"))
    return rows.withColumn("toxic_score", toxicity_score(model)).where(F.col("toxic_score") < least).select("row.*")


def toxic_sentences(docs: DataFrame, model: ToxicityModel, least: float = 0.3) -> DataFrame:
    """``doc_id, start, end, score`` of every sentence with a score of at least
    ``least``: code points from its first to its last word, end exclusive."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body", 2 << 20):
            data, offsets = joined(part.column("body"))
            _, z, b = score_bodies(data, offsets, model)
            p = -np.expm1(-masses(z, model.bias))
            hit = np.flatnonzero(p >= least)
            if not len(hit):
                continue
            last = np.append(b.first[1:], len(b.cell))[hit] - 1
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = points[offsets[b.doc[hit]]]
            ids = part.column("doc_id").take(pa.array(b.doc[hit]))
            cols = [points[b.found.start[b.first[hit]]] - base, points[b.found.end[last]] - base, p[hit]]
            yield pa.record_batch([ids, *map(pa.array, cols)], ["doc_id", "start", "end", "score"])

    return id_and_bytes(docs).mapInArrow(locate, "doc_id long, start long, end long, score double")


def is_held_out() -> Column:
    """Rows whose labels are not learned from: crc32 of the id's text, modulo 4, is 2."""
    return held_out("doc_id", 4, 2)
