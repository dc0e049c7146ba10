"""Toxicity by cumulative-link ordinal regression on the words of a text.

Severity has four grades; ``P(grade < k) = sigmoid(threshold k - x)``, where x
sums one weight for each distinct word, shared by all grades, and the thresholds
are ordered. The fit maximises the likelihood of the grades, the differences of
adjacent links, under an L1 penalty, by proximal gradient steps. The score is
the expected grade; a text at or above ``reject`` is toxic.

Labels only say toxic or not. So the same model with two grades is fitted first,
on halves of the sample, each of which scores the other half; the thirds of
the toxic rows by that score are the grades 1 to 3 that the full fit learns,
over the words that the two-grade fit of the whole sample gives a weight.

The fit uses at most ``per_class`` labelled documents of each label, whole
texts, by smallest hash of their ids, and never the held-out ones. Words are
known by the CRC-32 of their UTF-8. Null and empty texts score like a text
without known words. Rows are kept one for one; repeated texts score equally,
and other columns pass or are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm.common import batches, keyed_text, returned, slices
from barloom.llm.samples import labelled

WORD = re.compile(r"[^\W\d_]+")
GRADES = 4
MEMORY = 100_000  # words whose weight a task remembers


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def codes(text: str) -> np.ndarray:
    """The sorted distinct codes of a text's words."""
    return np.unique(np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words(text)], np.uint32))


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[int, float]
    thresholds: tuple[float, ...]
    reject: float = 0.2

    def grader(self) -> Callable[[str], float]:
        """A function that gives a text's expected grade, 0 to 3."""
        known: dict[str, float] = {}

        def weight(w: str) -> float:
            if len(known) > MEMORY:
                known.clear()
            found = known[w] = self.weights.get(zlib.crc32(w.encode("utf-8", "surrogatepass")), 0.0)
            return found

        def severity(text: str) -> float:
            x = math.fsum(known[w] if w in known else weight(w) for w in words(text))
            return sum(1 / (1 + math.exp(min(60.0, max(-60.0, t - x)))) for t in self.thresholds)

        return severity

    def severity(self, text: str) -> float:
        return self.grader()(text)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def cumulative_link(row: np.ndarray, col: np.ndarray, size: int, grade: np.ndarray, grades: int, steps: int, l1: float, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the likeliest model; ``row``, ``col``: which texts hold which of ``size`` words."""
    n = len(grade)
    w, v = np.zeros(size), np.zeros(size)
    first, gaps = 1.0, np.zeros(grades - 2)  # threshold 1, and the logarithms of the distances to the next ones
    pace = 1 / (np.bincount(col, minlength=size) / n + 0.01)  # rare words move as fast as frequent ones
    for step in range(steps):
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        x = np.bincount(row, v[col], minlength=n)
        links = np.column_stack([np.zeros(n), _sigmoid(theta[None, :] - x[:, None]), np.ones(n)])
        below, upto = links[np.arange(n), grade], links[np.arange(n), grade + 1]
        # of minus the mean log of upto - below; for logistic links the derivative by x is 1 - below - upto
        g = np.bincount(col, (1 - below - upto)[row], minlength=size) / n
        slope = 1 / np.maximum(upto - below, 1e-9)
        by_theta = np.array([(below * (1 - below) * slope)[grade == k].sum() - (upto * (1 - upto) * slope)[grade == k - 1].sum() for k in range(1, grades)]) / n
        fresh = v - rate * pace * g
        fresh = np.sign(fresh) * np.maximum(np.abs(fresh) - rate * l1 * pace, 0)
        v, w = fresh + step / (step + 3) * (fresh - w), fresh
        first -= 10 * rate * by_theta.sum()
        gaps -= 10 * rate * np.exp(gaps) * np.cumsum(by_theta[::-1])[::-1][1:]
        gaps = np.clip(gaps, -4.0, 3.0)
    return w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def fit(rows: list[tuple[np.ndarray, int]], steps: int = 400, l1: float = 2e-4, rate: float = 0.2) -> OrdinalModel:
    """``rows``: the codes of a text's words and its label 0 or 1. Without rows of both labels nothing is toxic."""
    rows = sorted(rows, key=lambda r: (r[0].tobytes(), r[1]))
    toxic = np.array([y for _, y in rows], np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return OrdinalModel({}, tuple(20.0 + k for k in range(GRADES - 1)))
    every = np.concatenate([c for c, _ in rows])
    names, seen = np.unique(every, return_counts=True)
    names = names[seen >= 3]
    row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    col = np.searchsorted(names, every)
    known = col < len(names)
    known[known] = names[col[known]] == every[known]
    row, col = row[known], col[known]

    fold, score = np.arange(len(rows)) % 2, np.zeros(len(rows))
    for k in (0, 1):
        part = np.nonzero(fold == k)[0]
        if len(part) and toxic[part].min() != toxic[part].max():
            at = np.full(len(rows), -1)
            at[part] = np.arange(len(part))
            mine = at[row] >= 0
            w, _ = cumulative_link(at[row[mine]], col[mine], len(names), toxic[part], 2, steps // 2, l1, rate)
            other = ~mine
            score += np.bincount(row[other], w[col[other]], minlength=len(rows))
    ranks = np.searchsorted(np.sort(score[toxic == 1]), score, "left")
    grade = np.where(toxic == 1, 1 + np.minimum(ranks * (GRADES - 1) // toxic.sum(), GRADES - 2), 0)
    w, _ = cumulative_link(row, col, len(names), toxic, 2, steps, l1, rate)
    kept = np.nonzero(np.abs(w) > 1e-3)[0]
    place = np.full(len(names), -1)
    place[kept] = np.arange(len(kept))
    mine = place[col] >= 0
    names = names[kept]
    w, theta = cumulative_link(row[mine], place[col[mine]], len(names), grade, GRADES, steps, l1, rate)
    return OrdinalModel({int(names[i]): float(round(w[i], 6)) for i in np.nonzero(np.abs(w) > 1e-3)[0]}, tuple(float(round(t, 6)) for t in theta))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> OrdinalModel:
    """Fits on the driver from the words of at most ``per_class`` documents of each label, four bytes for each distinct word of a text."""
    fields = [("codes", pa.binary()), ("y", pa.int32())]
    sample = labelled(docs, labels, "toxic", per_class).select("text", "y")
    sample = sample.mapInArrow(batches(lambda texts, ys: [[codes(t).tobytes() for t in texts], ys], fields), "codes binary, y int")
    model = fit([(np.frombuffer(bytes(r["codes"]), np.uint32), r["y"]) for r in sample.toLocalIterator()])
    returned()
    return model


def score(df: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, severity (expected grade), grade (rounded), toxic boolean."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        severity = model.grader()

        def run(keys: list, texts: list) -> list:
            s = [round(severity(t), 6) for t in texts]
            return [keys, s, [int(x + 0.5) for x in s], [x >= model.reject for x in s]]

        yield from batches(run, fields)(it)

    fields = [("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())]
    return keyed_text(df, key, text).mapInArrow(task, "doc_id bigint, severity double, grade int, toxic boolean")


def keep_clean(df: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The rows of ``df``, all its columns, whose text is not toxic."""
    at = df.columns.index(text)

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        severity = model.grader()
        for batch in slices(it):
            yield batch.filter(pa.array([severity(t or "") < model.reject for t in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(task, df.schema)
