"""Toxicity: a cumulative-link ordinal regression over the words of a text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text

#: Labelled rows that the fit uses at most, about; they are chosen by a hash of the id.
SAMPLE = 10_000
#: Words of fewer sampled texts are no features.
MIN_TEXTS = 5
GRADES = 4  # 0: not toxic; 1 to 3: mild to severe
STEPS, RATE, DECAY = 200, 0.1, 1e-4
#: A text is flagged from this probability on: a miss costs more than a false alarm.
FLAG = 0.25
#: ASCII but letters as white space.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Hashes of the distinct lower-case words and of their first four and five bytes, which inflected forms share."""
    words = set(text.lower().encode("utf-8", "replace").translate(LETTERS).split())
    words |= {w[:5] + b"*" for w in words if len(w) > 5} | {w[:4] + b"*" for w in words if len(w) > 4}
    return np.unique(np.fromiter(map(crc32, words), np.uint32, len(words)))


class Ordinal(NamedTuple):
    """One weight per word and ordered thresholds: P(grade >= k) = sigmoid(weights of the words - thresholds[k - 1])."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def exceeding(self, text: str) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        own = features(text)
        at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
        total = self.weights[at[self.words[at] == own]].sum()
        return 1 / (1 + np.exp(np.clip(self.thresholds - total, -700, 700)))


def grades_of(sizes: np.ndarray, column: np.ndarray, count: int, toxic: np.ndarray) -> np.ndarray:
    """Ordered grades out of a label of two values: 0 for clean rows, and for toxic rows the third of them that the
    number of marking words puts them in. A word marks if toxic rows have it over seven times as often."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    often = [np.bincount(column[toxic[row] == k], minlength=count) for k in (0, 1)]
    ratio = (often[1] + 0.5) / (toxic.sum() + 1) / ((often[0] + 0.5) / ((toxic == 0).sum() + 1))
    marks = np.bincount(row, weights=(ratio > 7)[column], minlength=len(sizes))
    cuts = np.quantile(marks[toxic == 1], [k / (GRADES - 1) for k in range(1, GRADES - 1)])
    return np.where(toxic == 1, 1 + (marks[:, None] > cuts).sum(axis=1), 0)


def train(hashes: list[np.ndarray], toxic: np.ndarray) -> Ordinal:
    """Maximum likelihood by full gradients (Adam) with weight decay; thresholds stay ordered as sums of positive steps."""
    flat = np.concatenate(hashes)
    words, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    used = often >= MIN_TEXTS
    sizes = np.add.reduceat(used[column], np.cumsum([0, *map(len, hashes)])[:-1], dtype=int) * np.array([len(h) > 0 for h in hashes])
    column = (np.cumsum(used) - 1)[column[used[column]]]
    words, n, rows = words[used], int(used.sum()), len(hashes)
    grade = grades_of(sizes, column, n, toxic)
    row = np.repeat(np.arange(rows), sizes)
    params = np.zeros(n + GRADES - 1)
    params[n] = 2.0
    first, second = np.zeros_like(params), np.zeros_like(params)
    above = grade[:, None] >= np.arange(1, GRADES)  # row x threshold
    pick = np.arange(rows)
    for step in range(1, STEPS + 1):
        gaps = np.exp(params[n + 1:])
        theta = params[n] + np.concatenate([[0], np.cumsum(gaps)])
        total = np.bincount(row, weights=params[column], minlength=rows)
        p = 1 / (1 + np.exp(np.clip(theta - total[:, None], -30, 30)))
        edge = np.hstack([np.ones((rows, 1)), p, np.zeros((rows, 1))])
        slope = edge * (1 - edge)
        like = np.maximum(edge[pick, grade] - edge[pick, grade + 1], 1e-12)
        # d log likelihood / d total, and / d theta of the threshold below and above the row's grade
        low, high = slope[pick, grade] / like, slope[pick, grade + 1] / like
        of_total = low - high
        of_theta = np.array([(high[grade == k - 1].sum() - low[grade == k].sum()) for k in range(1, GRADES)])
        back = np.concatenate([[of_theta.sum()], [of_theta[k:].sum() * gaps[k - 1] for k in range(1, GRADES - 1)]])
        gradient = -np.concatenate([np.bincount(column, weights=of_total[row], minlength=n), back]) / rows
        gradient[:n] += DECAY * params[:n]
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    theta = params[n] + np.concatenate([[0], np.cumsum(np.exp(params[n + 1:]))])
    return Ordinal(words, params[:n], theta)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal | None:
    """Fit to a bounded sample of the labelled rows; None unless it has both labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label")) \
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h.tobytes() for h in hashes], pa.binary())], ["doc_id", "hashes"])

    near = id_and_text(docs).filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(share * 1_000_000))
    rows = near.mapInArrow(run, "doc_id long, hashes binary").join(chosen, "doc_id").select("doc_id", "hashes", "label") \
        .toArrow().sort_by("doc_id")
    toxic = np.array(rows["label"].to_pylist(), int)
    if len(set(toxic)) < 2:
        return None
    model = train([np.frombuffer(h.as_py(), np.uint32) for h in rows["hashes"]], toxic)
    return model if len(model.words) else None


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Expected severity of every whole text, by a model that is fitted to ``labels.toxic``.

    The label has two values; grade 0 are the clean rows, and the toxic ones fall into three grades by the number of
    words that mark toxic texts. A text's distinct words and their beginnings have one weight each, shared across all thresholds. One row out for
    each row in: doc_id, severity (expected grade, 0 to 3), p_toxic (probability of a grade above 0), grade (the
    likeliest), toxic (p_toxic >= FLAG).

    The fit uses about ``sample`` labelled rows at most, chosen by a hash of the id. A null text counts as empty and
    has no words. Without labels of both kinds every severity is 0. A null doc_id has no label; repeated rows stay.
    An empty table gives no rows; other columns are not read.
    """
    model = fit(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = np.zeros((batch.num_rows, GRADES - 1)) if model is None else \
                np.array([model.exceeding(t.as_py()) for t in batch.column(1)]).reshape(-1, GRADES - 1)
            edge = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0]),
                pa.array((edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype("int32")), pa.array(above[:, 0] >= FLAG),
            ], ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
