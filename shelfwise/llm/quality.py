"""Quality classifier: a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import fold, id_and_text

FEATURES = ("log_words", "word_length", "upper", "digits", "marks", "symbols", "distinct", "repeats", "long_lines")
#: Weight of the covariance that both classes share, and what is added to its diagonal.
SHRINKAGE, RIDGE = 0.1, 1e-3
LETTER, CAPITAL, DIGIT, MARK, SPACE, SYMBOL, BREAK = range(7)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, SYMBOL, np.uint8)
    kind[128:] = LETTER  # bytes of characters beyond ASCII
    for chars, value in ((b"abcdefghijklmnopqrstuvwxyz", LETTER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", CAPITAL),
                         (b"0123456789", DIGIT), (b".,;:'?-()", MARK), (b" \t\r\x0b\x0c", SPACE), (b"\n", BREAK)):
        kind[list(chars)] = value
    return kind


def statistics(text: str, kinds: np.ndarray) -> tuple[float, ...]:
    """Numbers of one text, each on a scale where ordinary texts are spread evenly; an empty text has a defined one, too."""
    count = np.bincount(kinds[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=7)
    words = text.split()
    n, size = len(words), max(1, int(count.sum()))
    letters = max(1, int(count[LETTER] + count[CAPITAL]))
    same = sum(map(eq, words, islice(words, 1, None)))
    # Each share starts from a few units of its usual value, so that short texts, whose shares say little, look usual.
    return (
        np.log1p(n), np.log((size + 60) / (n + 10)), np.log((count[CAPITAL] + 4) / (letters + 120)),
        np.log((count[DIGIT] + 1) / (size + 100)), np.log((count[MARK] + 3) / (size + 120)),
        np.log((count[SYMBOL] + 1) / (size + 100)), np.log((len(set(words)) + 18) / (n + 20)) + 0.12 * np.log1p(n),
        np.log((same + 0.5) / (n + 50)), np.log((n + 30) / (count[BREAK] + 2)),
    )


def _matrix(texts: pa.Array) -> np.ndarray:
    kinds = _byte_classes()
    return np.array([statistics(t.as_py() or "", kinds) for t in texts], float).reshape(-1, len(FEATURES))


class Discriminant(NamedTuple):
    """Per class (0, 1): the mean, the inverse of the covariance's Cholesky factor, and log prior - log determinant / 2."""

    means: np.ndarray
    whiten: np.ndarray
    offset: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the two log densities."""
        logs = [self.offset[k] - 0.5 * (((x - self.means[k]) @ self.whiten[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> Discriminant | None:
    """Fit on all labelled documents outside the held-out fold; None unless both classes have two rows.

    The statistics are taken where the documents are. Of them, counts, sums and sums of products are gathered by
    class, whatever the number of rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_matrix(batch.column(1)).T], ["doc_id", *FEATURES])

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")) \
        .filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
    rows = id_and_text(docs).filter(fold(F.col("doc_id"), folds) != held_out) \
        .mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)).join(known, "doc_id")
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]
    sums = rows.groupBy("label").agg(
        F.count(F.lit(1)), *(F.sum(f) for f in FEATURES), *(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in pairs)
    ).collect()
    by_class = {r[0]: np.array(r[1:], float) for r in sums}
    if len(by_class) < 2 or min(s[0] for s in by_class.values()) < 2:
        return None
    d = len(FEATURES)
    sizes, means, spread = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for k, s in by_class.items():
        sizes[k], means[k] = s[0], s[1:d + 1] / s[0]
        for (i, j), value in zip(pairs, s[d + 1:]):
            spread[k, i, j] = spread[k, j, i] = value / s[0] - means[k, i] * means[k, j]
    shared = np.average(spread, axis=0, weights=sizes) + RIDGE * np.eye(d)
    factors = [np.linalg.cholesky((1 - SHRINKAGE) * spread[k] + SHRINKAGE * shared) for k in (0, 1)]
    offset = np.log(sizes / sizes.sum()) - [np.log(np.diag(f)).sum() for f in factors]
    return Discriminant(means, np.array([np.linalg.inv(f) for f in factors]), offset)


def _scores(model: Discriminant | None, texts: pa.Array) -> np.ndarray:
    return np.full(len(texts), 0.5) if model is None or not len(texts) else model.score(_matrix(texts))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Score every document's text with a discriminant that is fitted to ``labels.quality``.

    Learns from all labelled documents but those of one fold (crc32 of the id as text, modulo ``folds``). Inputs of a
    score are statistics of the text alone. One row out for each row in: doc_id, held_out, score (0 to 1, higher:
    label 1 likelier), predicted (score >= 0.5).

    A null text counts as empty; an empty text is scored like any other. A null doc_id counts as empty text in the fold
    and has no label. Labels other than 0 and 1 are left out; repeated labels and documents count as often as they occur.
    If a class has fewer than two labelled rows, all scores are 0.5. An empty table gives no rows; other columns are not read.
    """
    model = fit(docs, labels, folds, held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(model, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype("int32"))], ["doc_id", "score", "predicted"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", "predicted")


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all columns, whose text the classifier does not reject; nothing but the fit is shuffled."""
    model, place = fit(docs, labels), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(place)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
