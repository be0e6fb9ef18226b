"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

The kernel compares words by their common subsequences of three letters, each weighted by ``DECAY`` to the length it
spans in either word. Gaps and inserted characters only lower the weight, so split and padded insults
stay near to the plain form. Words are mapped by kernel values to landmark words, whitened by the
landmarks' own kernel matrix (Nyström), and a linear SVM separates words typical of toxic rows
from words of clean rows. The margin is linear in a word's subsequences, so the model folds into one
weight per letter triple and a word is scored without any kernel row. A text's score is a logistic function of
its largest word margins, fitted on the training rows.

Training uses a bounded sample: ``MAX_ROWS`` rows of each label, those of least hash, and at most ``MAX_WORDS`` words of each
kind. Scoring reads every word of every text; words longer than ``MAX_WORD`` letters are read in overlapping pieces,
runs of single letters are also read as one word. Labels, language, source and id are never inputs of a score.

Null and empty texts have no words and get the score of an absent margin. Rows without a label, with a null id or
with a null label are not trained on. A training set that lacks one of the labels gives every text the share of toxic rows in it.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import by_batch, stored

MAX_ROWS, MAX_WORDS = 3000, 1500
DECAY, MAX_WORD = 0.5, 20
LANDMARKS, TOP = 160, 2
#: Margin of a text without words.
NO_MARGIN = -2.0
CACHE = 300_000
_LETTERS = 64

_EDGE = re.compile(r"^\W+|[\W_]+$")


def letter_codes(word: str) -> np.ndarray:
    """Letters as 1 to 63; 0 for what matches nothing (marks between letters)."""
    return np.array([ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 37 if c.isalnum() else 0 for c in word], np.int32)


def words_in_order(text: str) -> list[str]:
    """Lower-case words without marks at their ends; a run of single letters is joined to one word."""
    found, run = [], []
    for w in [*text.lower().split(), ""]:
        w = _EDGE.sub("", w)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) > 2:
            found.append("".join(run))
        run = []
        if len(w) > 2:
            found.append(w)
    return found


def words_of(text: str) -> list[str]:
    return list(set(words_in_order(text)))


def pieces(word: str) -> list[str]:
    if len(word) <= MAX_WORD:
        return [word]
    step = MAX_WORD // 2
    return [word[i:i + MAX_WORD] for i in range(0, len(word) - step, step)]


_SHAPES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _shape(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j < k) of all triples of a word of n letters, and their weights."""
    if n not in _SHAPES:
        i, j = np.triu_indices(n, 1)
        reps = n - 1 - j
        k = np.concatenate([np.arange(a + 1, n) for a in j]) if len(j) else np.zeros(0, int)
        ijk = np.stack([np.repeat(i, reps), np.repeat(j, reps), k]).astype(np.int32)
        _SHAPES[n] = ijk, (DECAY ** (ijk[2] - ijk[0] + 1)).astype(np.float32)
    return _SHAPES[n]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words of one length: triple codes (n, t), weights (n, t), and each word's kernel with itself, rooted."""
    c = np.stack([letter_codes(w) for w in words])
    (i, j, k), w = _shape(c.shape[1])
    a, b, d = c[:, i], c[:, j], c[:, k]
    code = (a * _LETTERS + b) * _LETTERS + d
    weight = np.where((a > 0) & (b > 0) & (d > 0), w, np.float32(0))
    order = np.argsort(code, axis=1)
    sorted_code = np.take_along_axis(code, order, 1)
    sorted_weight = np.take_along_axis(weight, order, 1)
    new = np.ones_like(sorted_code, bool)
    new[:, 1:] = sorted_code[:, 1:] != sorted_code[:, :-1]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(sorted_weight.ravel(), starts)
    norm = np.bincount(starts // code.shape[1], weights=sums * sums, minlength=len(words))
    return code, weight, np.sqrt(np.maximum(norm, 1e-12))


def by_length(words: list[str], most: int = 2000):
    """(indices, words) in blocks of equal length."""
    order = sorted(range(len(words)), key=lambda x: len(words[x]))
    at = 0
    while at < len(order):
        n, end = len(words[order[at]]), at
        while end < len(order) and end - at < most and len(words[order[end]]) == n:
            end += 1
        yield order[at:end], [words[x] for x in order[at:end]]
        at = end


def kernel_rows(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of each word with each landmark."""
    basis = np.zeros((_LETTERS**3, len(landmarks)), np.float32)
    for at, block in by_length(landmarks):
        code, weight, norm = triples(block)
        for row, column in enumerate(at):
            np.add.at(basis[:, column], code[row], weight[row] / norm[row])
    out = np.zeros((len(words), len(landmarks)))
    for at, block in by_length(words, 64):
        code, weight, norm = triples(block)
        out[at] = np.einsum("nt,ntm->nm", weight, basis[code]) / norm[:, None]
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-4, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss and balanced classes, by accelerated gradient steps."""
    side = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    z = np.hstack([x, np.ones((len(x), 1))])
    rate = 1.0 / (2 * np.linalg.norm(z * np.sqrt(share)[:, None], 2) ** 2 + strength)
    w = prev = np.zeros(z.shape[1])
    for k in range(steps):
        v = w + (k / (k + 3)) * (w - prev)
        slack = np.maximum(0, 1 - side * (z @ v))
        prev, w = w, v - rate * (strength * np.append(v[:-1], 0) - 2 * z.T @ (share * side * slack))
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, strength: float = 1e-5, steps: int = 60) -> np.ndarray:
    """Weights (constant last) by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + strength * np.append(w[:-1], 0)
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + strength * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


@dataclass(frozen=True)
class Model:
    """Weight per letter triple, constant, and the logistic weights over the largest margins."""

    weights: np.ndarray
    constant: float
    logistic: np.ndarray

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), NO_MARGIN)
        for at, block in by_length(words):
            code, weight, norm = triples(block)
            out[at] = (weight * self.weights[code]).sum(axis=1) / norm + self.constant
        return out

    def scores(self, texts: list[str | None], cache: dict[str, float] | None = None) -> np.ndarray:
        known = {} if cache is None else cache
        lists = [words_of(t or "") for t in texts]
        new = list({w for words in lists for w in words if w not in known})
        if new:
            parts = [pieces(w) for w in new]
            values = iter(self.margins([p for ps in parts for p in ps]).tolist())
            for w, ps in zip(new, parts):
                known[w] = max(next(values) for _ in ps)
        top = np.full((len(texts), TOP), NO_MARGIN)
        for row, words in enumerate(lists):
            best = heapq.nlargest(TOP, map(known.__getitem__, words))
            top[row, :len(best)] = best
        if len(known) > CACHE:
            known.clear()
        return self.from_top(top)

    def from_top(self, top: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.maximum(top, NO_MARGIN) @ self.logistic[:-1] + self.logistic[-1], -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """Distinct texts of either label, ``max_rows`` each at most, by least hash."""
    asked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)").dropDuplicates(["id"])
    order = F.xxhash64("id")
    chosen = [asked.filter(F.col("y") == y).orderBy(order, "id").limit(max_rows) for y in (0, 1)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    return rows.join(chosen[0].unionAll(chosen[1]), "id").dropDuplicates(["text"])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS, landmarks: int = LANDMARKS,
) -> Model:
    """Fit on a bounded sample of labelled rows; ``labels``: id and label."""
    sample = stored(_sample(docs, labels, id_col, text_col, label_col, max_rows), "toxicity-sample")
    counts = dict(sample.groupBy("y").count().collect())
    if not counts.get(0) or not counts.get(1):
        share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
        return Model(np.zeros(_LETTERS**3, np.float32), 0.0, np.append(np.zeros(TOP), np.log(share / (1 - share))))

    def split(batch: pa.RecordBatch):
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_in_order(text)
            if words:
                around = [f"{a} {b}" for a, b in zip(["", *words[:-1]], [*words[1:], ""])]
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(around), pa.array([y] * len(words), pa.int32())], ["w", "around", "y"])

    # A word counts once for each pair of neighbours: what near copies repeat counts once.
    uses = sample.select("text", "y").mapInArrow(by_batch(split), "w string, around string, y int").distinct()
    seen = uses.groupBy("w").agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n")).withColumn("good", F.col("n") - F.col("bad"))
    odds = ((F.col("bad") + 0.1) / counts[1]) / ((F.col("good") + 0.5) / counts[0])
    rated = stored(seen.withColumn("odds", odds), "toxicity-words")
    typical = rated.filter((F.col("bad") >= max(3, 0.008 * counts[1])) & (F.col("odds") >= 6) & (F.length("w") <= MAX_WORD))
    bad = [r.w for r in typical.orderBy(F.desc("bad"), "w").limit(max_words).collect()]
    clean = rated.filter((F.col("good") > 0) & (F.col("odds") <= 2) & (F.length("w") <= MAX_WORD))
    good = [r.w for r in clean.orderBy(F.desc("good"), "w").limit(max_words).collect()]
    good += [r.w for r in clean.orderBy(F.xxhash64("w"), "w").limit(max_words).collect() if r.w not in set(good)]
    marks = bad[:landmarks * 3 // 4] + good[:landmarks // 4]
    if not bad or not good:
        share = counts[1] / sum(counts.values())
        return Model(np.zeros(_LETTERS**3, np.float32), 0.0, np.append(np.zeros(TOP), np.log(share / (1 - share))))
    values, vectors = np.linalg.eigh(kernel_rows(marks, marks))
    root = vectors / np.sqrt(np.maximum(values, 1e-3))  # Nyström: K_mm to the power of -1/2
    x = kernel_rows(bad + good, marks) @ root
    w, constant = fit_svm(x, np.array([1] * len(bad) + [0] * len(good)))
    weights = np.zeros(_LETTERS**3, np.float32)
    for alpha, mark in zip(root @ w, marks):
        code, weight, norm = triples([mark])
        np.add.at(weights, code[0], alpha * weight[0] / norm[0])
    model = Model(weights, constant, np.append(np.zeros(TOP), 0.0))

    def top(batch: pa.RecordBatch):
        # Each text in its own call: the largest margins of its words.
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            m = np.sort(model.margins([p for w in words_of(text) for p in pieces(w)] or ["-"]))[::-1][:TOP].tolist()
            yield pa.RecordBatch.from_arrays([pa.array([m + [NO_MARGIN] * (TOP - len(m))]), pa.array([y], pa.int32())], ["m", "y"])

    rows = sample.select("text", "y").mapInArrow(by_batch(top), "m array<double>, y int").collect()  # bounded by the sample
    found = np.maximum(np.array([r.m for r in rows]), NO_MARGIN)
    return Model(weights, constant, fit_logistic(found, np.array([r.y for r in rows], float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one MB, whatever the data
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        cache: dict[str, float] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                scores = shared.value.scores(part.column(1).to_pylist(), cache)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
