"""Quality by a regularised quadratic discriminant.

A document becomes a vector of transformed statistics: lengths, letter classes, repetition, punctuation, lines.
For each class Spark sums the vectors and their products over all labelled rows that may be learned from; the
covariance is shrunk towards that of both classes together and towards its own diagonal. The score is the
logistic of the difference of the classes' log densities, from Mahalanobis distances by cached Cholesky
factors, plus the log odds of the classes.

Defined results: a null text counts as empty and has a vector like any other. Without rows of both labels
every score is the share of label 1 among what there is, 0.5 without any. Repeated rows give repeated results;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.llm.common import map_arrow, text_or_empty
from metricloom.llm.labelled import held_out, to_learn
from metricloom.session import materialize

SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.05
RIDGE = 1e-4
TEMPERATURE = 4.0
MARKS = ".,;:!?|#*/\\<>{}[]()\"'=_-+@&%$~^"


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text."""
    words = text.split()
    n, letters = len(words), max(len(text), 1)
    if not n:
        return [0.0] * WIDTH
    raw = text.encode("utf-8", "surrogatepass")
    distinct = len(set(words))
    sizes = np.fromiter(map(len, words), np.int64, n)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    marks = counts[[ord(c) for c in MARKS]].sum()
    shares = counts[counts > 0] / len(raw)
    lines = text.split("\n")
    filled = [line for line in lines if line]
    repeats = sum(map(str.__eq__, words, words[1:]))
    ends = sum(line.rstrip()[-1:] in ("." , "!", "?") for line in filled)
    return [
        np.log1p(n),
        float(sizes.mean()),
        np.log1p(float(sizes.std())),
        np.log1p(float(sizes.max())),
        rate(upper, upper + lower),
        rate(digits, letters),
        rate(marks, letters),
        rate(counts[ord("!")], n),
        rate(counts[ord("|")], n),
        rate(counts[ord(".")], n),
        rate(counts[ord(",")], n),
        rate(counts[128:].sum(), len(raw)),
        float(-(shares * np.log(shares)).sum()),
        rate(repeats, n),
        np.log(distinct / n) / np.log1p(n),
        np.log1p(10 * len(zlib.compress(raw, 1)) / len(raw)),
        np.log1p(len(filled) / n * 10),
        rate(len(filled) - len(set(filled)), max(len(filled), 1)),
        rate(ends, max(len(filled), 1)),
        rate(sum(w[0].isupper() for w in words), n),
    ]


def rate(part: float, whole: float) -> float:
    """A share, spread out near 0 and 1."""
    share = min(max(float(part) / float(whole), 0.0), 1.0) if whole else 0.0
    return float(np.arcsin(np.sqrt(share)))


WIDTH = 20


def vectors(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` with the statistics of every row."""

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        return {"doc_id": batch["doc_id"], "x": [[float(v) for v in statistics(t)] for t in batch["text"].to_pylist()]}

    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), "doc_id bigint, x array<double>", rows)


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of the classes; ``share`` is that of label 1."""

    share: float
    means: np.ndarray | None = None
    inverses: np.ndarray | None = None
    log_roots: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.inverses[k].T
            density.append(-0.5 * (z * z).sum(axis=1) - self.log_roots[k])
        odds = (density[1] - density[0]) / TEMPERATURE + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def moments(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Number of rows, sums and sums of products per label; a few hundred numbers reach the driver."""
    places = [(i, j) for i in range(WIDTH) for j in range(i, WIDTH)]
    sums = [F.sum(F.col("x")[i]) for i in range(WIDTH)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in places]
    rows = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s"), F.array(*products).alias("p")).collect()
    found = {}
    for row in rows:
        square = np.zeros((WIDTH, WIDTH))
        for (i, j), value in zip(places, row["p"], strict=True):
            square[i, j] = square[j, i] = value
        found[row["label"]] = (row["n"], np.array(row["s"]), square)
    return found


def fit(labelled: DataFrame) -> Discriminant:
    """From ``label, x``."""
    found = moments(labelled)
    total = sum(n for n, _, _ in found.values())
    share = found[1][0] / total if 1 in found else (0.0 if total else 0.5)
    if len(found) < 2:
        return Discriminant(share)
    means = {k: s / n for k, (n, s, _) in found.items()}
    within = {k: p / n - np.outer(means[k], means[k]) for k, (n, _, p) in found.items()}
    pooled = sum(found[k][0] * within[k] for k in found) / total
    inverses, log_roots = [], []
    for k in (0, 1):
        shrunk = (1 - SHRINK_TO_POOLED) * within[k] + SHRINK_TO_POOLED * pooled
        shrunk = (1 - SHRINK_TO_DIAGONAL) * shrunk + SHRINK_TO_DIAGONAL * np.diag(np.diag(shrunk))
        root = np.linalg.cholesky(shrunk + RIDGE * np.eye(WIDTH))
        inverses.append(np.linalg.inv(root))
        log_roots.append(float(np.log(np.diag(root)).sum()))
    return Discriminant(share, np.array([means[0], means[1]]), np.array(inverses), np.array(log_roots))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    described = materialize(vectors(docs), "quality-vectors")
    model = fit(described.join(to_learn(labels, "quality"), "doc_id"))

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        x = np.array(batch["x"].to_pylist(), np.float64).reshape(-1, WIDTH)
        return {"doc_id": batch["doc_id"], "score": model.scores(x)}

    scored = map_arrow(described, "doc_id bigint, score double", rows, 8192)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
