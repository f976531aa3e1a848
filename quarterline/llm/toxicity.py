"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the presence of its words, its pairs of neighbouring words and its pairs with
one or two words between, each hashed to 32 bits. FTRL-proximal gives every coordinate a learning
rate of its own and keeps it at exactly zero until its evidence passes the L1 threshold, so of
millions of coordinates a few hundred carry weight: the model is a short list that is broadcast.

Fit. A bounded sample of labelled documents (``sample_docs``, by hash of doc_id) goes to learners of about
``learner_docs`` documents that run in parallel; their weights are averaged. Beside this model, one for each of
``CALIBRATION`` parts of the sample is learned from the other parts: the margins of every part by the model that has
not seen it calibrate the score by logistic regression, so that 0.5 is the even-odds score and no label is held back
from the weights.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import packed, smallest, text_or_empty, written

SAMPLE_DOCS, LEARNER_DOCS, CALIBRATION = 12_000, 4_000, 4
SAMPLE_CHARS = 100_000  # longer documents are left out of the sample, not out of the scoring
ALPHA, BETA, L1, L2, EPOCHS, MIN_DOCS = 1.0, 1.0, 10.0, 0.0, 6, 5
FOLDS = 5

_WORD = re.compile(r"\w+")
_GOLD, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BITS = 20


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document numbers, 32-bit coordinates) of the words and word pairs, in parts; with repetitions."""
    split = [_WORD.findall(t.lower()) for t in texts]
    flat = np.array([w for ws in split for w in ws], dtype=object)
    if not len(flat):
        return
    h = pd.util.hash_array(flat, categorize=False).astype(np.uint64)
    doc = np.repeat(np.arange(len(split)), [len(w) for w in split])
    yield doc, (_mix(h) >> np.uint64(32)).astype(np.uint32)
    for gap in (1, 2, 3):
        same = doc[:-gap] == doc[gap:]
        pair = _mix(h[:-gap] * _GOLD + h[gap:] + np.uint64(gap))
        yield doc[:-gap][same], (pair[same] >> np.uint64(32)).astype(np.uint32)


def _parts(texts: list[str], chars: int = 2_000_000) -> Iterator[slice]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i + 1 == len(texts):
            yield slice(lo, i + 1)
            lo, size = i + 1, 0


class Model:
    """Sparse weights by coordinate, a bias, and the calibration of the margin."""

    def __init__(self, coords: np.ndarray, weights: np.ndarray, bias: float, scale: float = 1.0, shift: float = 0.0):
        order = np.argsort(coords)
        self.coords, self.weights = coords[order].astype(np.uint32), weights[order]
        self.bias, self.scale, self.shift = bias, scale, shift
        self.maybe = np.zeros(1 << _BITS, bool)  # a quick test before the search
        self.maybe[self.coords & np.uint32((1 << _BITS) - 1)] = True

    def margins(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for part in _parts(texts):
            n, hits = part.stop - part.start, []
            for doc, c in features(texts[part]):
                k = np.flatnonzero(self.maybe[c & np.uint32((1 << _BITS) - 1)])
                at = np.searchsorted(self.coords, c[k])
                at[at == len(self.coords)] = 0
                ok = self.coords[at] == c[k] if len(self.coords) else np.zeros(len(k), bool)
                hits.append(doc[k][ok] * len(self.coords) + at[ok])
            if hits:
                hit = np.unique(np.concatenate(hits))  # presence, not count
                if len(hit):
                    out[part] += np.bincount(hit // len(self.coords), self.weights[hit % len(self.coords)], n)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margins(texts) + self.shift, -500, 500)))


def ftrl(docs: list[np.ndarray], labels: np.ndarray, size: int, alpha: float = ALPHA, beta: float = BETA,
         l1: float = L1, l2: float = L2, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes of FTRL-proximal over documents given as sets of coordinates."""
    z, n, zb, nb, bias = np.zeros(size), np.zeros(size), 0.0, 0.0, 0.0

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) > l1, w, 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            i = docs[d]
            w, bias = weights(i), -zb / ((beta + math.sqrt(nb)) / alpha)
            g = 1 / (1 + math.exp(-min(30.0, max(-30.0, w.sum() + bias)))) - labels[d]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / alpha * bias
            nb += g * g
    return weights(np.arange(size)), bias


def _learn(table: pa.Table) -> pa.Table:
    """One learner: admit coordinates seen in MIN_DOCS documents, run FTRL, return the non-zero weights."""
    order = pa.compute.sort_indices(table, [("order", "ascending"), ("doc_id", "ascending")])
    y, texts = table["label"].take(order).to_numpy(), table["text"].combine_chunks()
    order, found = order.to_numpy(), []
    for lo in range(0, len(order), 200):  # texts become strings, and words, a few at a time
        some = [texts[k].as_py() for k in order[lo:lo + 200].tolist()]
        for part in _parts(some, 500_000):
            d, c = map(np.concatenate, zip(*features(some[part]), strict=True)) if any(some[part]) else ([], [])
            pairs = np.unique(np.asarray(d, np.uint64) << np.uint64(32) | np.asarray(c, np.uint64))
            cut = np.searchsorted(pairs >> np.uint64(32), np.arange(part.stop - part.start + 1))
            found += [pairs[a:b].astype(np.uint32) for a, b in zip(cut[:-1], cut[1:])]
    every = np.concatenate(found or [np.zeros(0, np.uint32)])
    every.sort()
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    coords = every[first[np.diff(np.append(first, len(every))) >= MIN_DOCS]]
    del every, first
    docs = []
    for k, f in enumerate(found):
        at = np.searchsorted(coords, f)
        ok = at < len(coords)
        ok[ok] = coords[at[ok]] == f[ok]
        docs.append(at[ok].astype(np.int32))
        found[k] = None
    w, bias = ftrl(docs, y, len(coords))
    keep = w != 0
    return pa.table({"coord": pa.array(np.append(coords[keep].astype(np.int64), -1)),  # -1: the bias
                     "weight": pa.array(np.append(w[keep], bias))})


def _learn_for(key: tuple, table: pa.Table) -> pa.Table:
    learned = _learn(table)
    return learned.add_column(0, "model", pa.array([key[0].as_py()] * len(learned), pa.int32()))


def _calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Logistic regression of the label on the margin (Newton steps, targets smoothed as by Platt)."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        return 1.0, 0.0
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, b = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, x.T @ (t - p) - 1e-3 * (b - np.array([1.0, 0.0])))
        b = b + np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return (float(b[0]), float(b[1])) if b[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_docs: int = SAMPLE_DOCS, learner_docs: int = LEARNER_DOCS) -> Model:
    """A model from at most ``sample_docs`` labelled documents that are not held out.

    Labels other than 0 and 1 and null ids are left out; if labels of an id differ, 1 counts. If no
    document of the sample is labelled toxic, all scores are the same and close to 0.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col("toxic").cast("int").alias("label"))
             .filter("_id is not null and label in (0, 1)").filter(~held_out("_id"))
             .groupBy("_id").agg(F.max("label").alias("label"))
             .withColumn("order", F.xxhash64("_id")))
    known = smallest(known, "order", sample_docs, "_id")
    text = text_or_empty(text_col)
    sample = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
              .filter(F.length("text") <= SAMPLE_CHARS)
              .join(F.broadcast(known), F.col("doc_id") == F.col("_id"))  # at most sample_docs rows
              .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("order").alias("order")))
    sample = written(sample, "toxic-sample")
    if not sample.filter("label = 1").head(1):
        return Model(np.zeros(0, np.int64), np.zeros(0), -6.0)
    learners = max(1, round(sample.count() / learner_docs))
    # a row goes to the models of the other parts (0, 1, ...) and to the one that is returned (-1)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(CALIBRATION)).cast("int")
    models = F.explode(F.filter(F.sequence(F.lit(-1), F.lit(CALIBRATION - 1)), lambda k: k != part)).alias("model")
    train = (sample.select("*", models, F.pmod(F.xxhash64("doc_id", F.lit("learner")), F.lit(learners)).alias("learner"))
             .groupBy("model", "learner").applyInArrow(_learn_for, "model int, coord long, weight double"))
    rows = train.groupBy("model", "coord").agg((F.sum("weight") / learners).alias("weight")).collect()  # L1 keeps hundreds
    found = {k: {r.coord: r.weight for r in rows if r.model == k} for k in range(-1, CALIBRATION)}
    made = {k: Model(np.array([c for c in w if c >= 0], np.int64), np.array([v for c, v in w.items() if c >= 0], float), w.get(-1, 0.0))
            for k, w in found.items()}
    shared = spark.sparkContext.broadcast(made)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, parts = b["text"].to_pylist(), b["part"].to_numpy()
            m = np.zeros(len(texts))
            for k in np.unique(parts).tolist():
                mine = np.flatnonzero(parts == k)
                m[mine] = shared.value[k].margins([texts[i] for i in mine.tolist()])
            yield pa.record_batch([pa.array(m), b["label"]], names=["m", "label"])

    seen = sample.select("text", "label", part.alias("part")).mapInArrow(margins, "m double, label int").collect()  # at most sample_docs rows
    model = made[-1]
    model.scale, model.shift = _calibrate(np.array([r.m for r in seen]), np.array([r.label for r in seen]))
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score): whole rows with the score of every whole text; null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # hundreds of weights

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(shared.value.scores(t.tolist()))

    return packed(docs, score=score(text_or_empty(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from 0.5). An empty table gives an empty
    result; rows that repeat are scored alike; other columns are not looked at."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = scored(rows, fit(docs, labels, id_col, text_col)).select("row.doc_id", "score")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with all their columns and whole texts.

    Null and empty texts have the score of a text without known words; repeated rows are kept or dropped alike;
    without a toxic label nothing is dropped; an empty table stays empty; clashing column names do not matter."""
    return scored(docs, fit(docs, labels)).filter("score < 0.5").select("row.*")
