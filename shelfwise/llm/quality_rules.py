"""Quality rules on repetition: how much of a text lies in n-grams and lines that it has already had."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import id_and_text

#: Largest allowed percentage of characters in repeated n-grams, by n-gram length, and in repeated lines.
NGRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_PERCENT = 20
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 50, 3, 50
SYMBOLS = b"#*$%&|<>"
#: Words that are hashed together; a longer text is a block of its own.
BLOCK_WORDS = 400_000
#: Multipliers of the rolling hash, odd; the next one serves when windows that differ have met.
BASES = [int(b) | 1 for b in np.random.default_rng(7).integers(1 << 62, 1 << 63, 16)]


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _windows(ids: np.ndarray, doc: np.ndarray, lengths: list[int], base: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length n: n, starts of all windows that stay in their text, and a hash of text and window for each."""
    scattered = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    scattered ^= scattered >> np.uint64(29)
    texts = (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    rolled, at = scattered, 1
    for n in lengths:
        while at < n:
            rolled = rolled[:-1] * np.uint64(base) + scattered[at:]
            at += 1
        last = max(0, len(ids) - n + 1)
        starts = np.flatnonzero(doc[:last] == doc[n - 1:])
        mixed = rolled[starts] ^ texts[starts]
        yield n, starts, (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _repeats(ids: np.ndarray, doc: np.ndarray, n: int, starts: np.ndarray, hashes: np.ndarray):
    """Starts of windows whose words the same text has at an earlier start, and those of windows that it has at any other.

    None if two windows of one hash differ.
    """
    if len(starts) < 2:
        return starts[:0], starts[:0]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    later = np.concatenate(([False], same))
    members = later | np.concatenate((same, [False]))
    # Few windows have an equal: only these are put into the order of the text, run by run.
    run, place = np.cumsum(~later)[members], starts[order[members]]
    again = np.lexsort((place, run))
    run, place = run[again], place[again]
    tied = np.flatnonzero(run[1:] == run[:-1]) + 1
    left, right = place[tied - 1], place[tied]
    if not np.array_equal(doc[left], doc[right]) or any(not np.array_equal(ids[left + j], ids[right + j]) for j in range(n)):
        return None
    return right, place


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that begins at one of the starts."""
    covered = np.zeros(size, bool)
    for j in range(n):
        covered[starts + j] = True
    return covered


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Measures of each UTF-8 text: int64 arrays by name. Hashes propose equal windows, words decide."""
    vocabulary = Numbers()
    n_texts, found = len(texts), [t.split() for t in texts]  # bytes.split cuts at ASCII white space alone
    counts = np.fromiter(map(len, found), np.int64, n_texts)
    ids = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum()))
    del found
    doc = np.repeat(np.arange(n_texts), counts)
    chars = np.fromiter((len(w.decode()) for w in vocabulary), np.int64, len(vocabulary))[ids]

    def by_text(values: np.ndarray, which: np.ndarray) -> np.ndarray:
        return np.bincount(doc[which], values[which], n_texts).astype(np.int64)

    out = {"n_words": counts, "word_chars": by_text(chars, np.ones(len(ids), bool)),
           "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)}
    out["n_dup_lines"], out["dup_line_chars"] = _lines(texts)
    lengths = sorted({REPEAT_WINDOW, *NGRAM_PERCENT})
    for base in BASES:
        for n, starts, hashes in _windows(ids, doc, lengths, base):
            if (pair := _repeats(ids, doc, n, starts, hashes)) is None:
                break
            if n == REPEAT_WINDOW:
                out["n_repeat_words"] = by_text(np.ones(len(ids), np.int64), _covered(pair[1], n, len(ids)))
            if n in NGRAM_PERCENT:
                out[f"dup_chars_{n}"] = by_text(chars, _covered(pair[0], n, len(ids)))
        else:
            return out
    raise ArithmeticError("windows that differ share their hash under every multiplier")


def _lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and the characters of their words."""
    dup, chars = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        lines = text.split(b"\n")
        if len(lines) == len(set(lines)):
            continue
        seen: set[bytes] = set()
        for line in lines:
            if line in seen:
                if words := line.split():
                    dup[k] += 1
                    chars[k] += len(b"".join(words).decode())
            else:
                seen.add(line)
    return dup, chars


def judge(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept for each text."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
    repeated = 100 * m["dup_line_chars"] > LINE_PERCENT * m["word_chars"]
    for n, percent in NGRAM_PERCENT.items():
        repeated |= 100 * m[f"dup_chars_{n}"] > percent * m["word_chars"]
    return failed, ~failed & ~repeated


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
            *(f"dup_chars_{n}" for n in NGRAM_PERCENT)]


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measure the repetition in every whole text and decide whether it stays.

    dup_chars_n counts the characters of words inside n-grams that began earlier in the same text, dup_line_chars those
    of lines that equal an earlier one. A text is rejected (kept is false) if it has under 50 words, if over half its words
    lie in 3-grams found twice, or if one of these counts is over its percentage of all characters of words.

    One row out for each row in: doc_id, the measures, base_failed, kept. Nothing is shuffled. Null and empty texts have no
    words and are rejected. A null doc_id and repeated rows stay, each judged alone; other columns are not read; an
    empty table gives no rows. A very long text is measured whole, in memory of about 100 bytes per word; short ones are
    measured together. Measures equal to a limit pass.
    """
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", base_failed boolean, kept boolean"
    names = ["doc_id", *MEASURES, "base_failed", "kept"]

    def rows(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        m = measure(texts)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(m[k]) for k in MEASURES),
                                           *map(pa.array, judge(m))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py().encode()
                if texts and size + len(data) > 6 * BLOCK_WORDS:
                    yield rows(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(key)
                texts.append(data)
                size += len(data)
        if texts:
            yield rows(ids, texts)

    return id_and_text(docs).mapInArrow(run, schema)
