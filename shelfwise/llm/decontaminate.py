"""Benchmark decontamination: training passages query a BM25 index of the test items by block-max WAND."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text, without

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage has to reach, and share of n-grams of question and answer it has to hold.
THRESHOLD, OVERLAP, GRAM = 0.7, 0.8, 5
#: Items of one index, which is broadcast; more items make more indexes.
SHARD_ITEMS = 20_000
#: Postings of a block; ranges of items for the first bound.
BLOCK, RANGES = 16, 48
#: ASCII but letters and digits as white space.
WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().translate(WORDS).split()


def grams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer, what comes before is the question; a single sentence is both."""
    parts = [w for w in map(words_of, SENTENCE.split(text)) if w]
    if len(parts) < 2:
        return (parts or [[]])[0], (parts or [[]])[0]
    return [w for p in parts[:-1] for w in p], parts[-1]


def build_index(items: list[tuple[int, str]], df: dict[bytes, int], count: int, mean: float) -> dict:
    """Inverted index of items, by their number: postings of every term with weights as shares of an item's own score.

    count, df and mean length are those of all items, whatever part of them is indexed here. Items are numbered by length,
    so that neighbours have like weights and bounds of blocks are tight.
    """
    rows = sorted(((i, words_of(t), t) for i, t in items), key=lambda r: (len(r[1]), r[0], r[2]))
    rows = [r for r in rows if r[1]]
    postings: dict[bytes, list[tuple[int, float]]] = {}
    for number, (_, words, _) in enumerate(rows):
        weight = {}
        for term in set(words):
            tf = words.count(term)
            idf = np.log1p((count - df[term] + 0.5) / (df[term] + 0.5))
            weight[term] = float(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean)))
        total = sum(weight.values())
        for term, w in weight.items():
            postings.setdefault(term, []).append((number, w / total))
    terms = {t: k for k, t in enumerate(sorted(postings))}
    lists = [([p[0] for p in postings[t]], [p[1] for p in postings[t]]) for t in terms]
    width = max(1, -(-len(rows) // RANGES))
    highest = np.zeros((len(terms) + 1, -(-len(rows) // width) if rows else 1), np.float32)  # the last row: unknown terms
    for k, (numbers, weights) in enumerate(lists):
        np.maximum.at(highest[k], np.array(numbers) // width, weights)
    return {
        "ids": [r[0] for r in rows], "parts": [tuple(map(grams, question_and_answer(r[2]))) for r in rows], "terms": terms, "lists": lists,
        "blocks": [[max(w[i:i + BLOCK]) for i in range(0, len(w), BLOCK)] for _, w in lists],
        "max": [max(w) for _, w in lists], "highest": highest, "longest": max((len(r[1]) for r in rows), default=1),
    }


def retrieve(index: dict, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items whose score for the distinct terms reaches the threshold, by block-max WAND."""
    lists, blocks, highest = index["lists"], index["blocks"], index["max"]
    cursors = [[lists[t][0][0], 0, t] for t in terms]  # item, position, term
    found = []
    while cursors:
        cursors.sort()
        total, pivot = 0.0, -1
        for k, (_, _, t) in enumerate(cursors):
            total += highest[t]
            if total >= threshold:
                pivot = k
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        bound, end = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(index["ids"])
        for _, position, t in cursors[:pivot + 1]:
            numbers = lists[t][0]
            at = bisect_left(numbers, item, position)
            if at < len(numbers):
                bound += blocks[t][at // BLOCK]
                end = min(end, numbers[min(len(numbers), (at // BLOCK + 1) * BLOCK) - 1] + 1)
        if bound >= threshold:
            score = 0.0
            for cursor in cursors[:pivot + 1]:
                numbers, weights = lists[cursor[2]]
                at = bisect_left(numbers, item, cursor[1])
                if at < len(numbers) and numbers[at] == item:
                    score += weights[at]
            if score >= threshold:
                found.append((item, score))
            end = item + 1
        end = max(end, item + 1)
        for cursor in cursors[:pivot + 1]:
            numbers = lists[cursor[2]][0]
            cursor[1] = bisect_left(numbers, end, cursor[1])
            cursor[0] = numbers[cursor[1]] if cursor[1] < len(numbers) else -1
        cursors = [c for c in cursors if c[0] >= 0]
    return found


def passages(index: dict, number: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """Windows of twice the longest item, one starting every such length, that can reach the threshold at all.

    Every run of words as long as an item lies in one whole. The bound adds up, for each range of items, the highest
    weights of a window's distinct terms.
    """
    size, step = len(number), index["longest"]
    order = np.argsort(number, kind="stable")
    before = np.full(size, -1)
    same = number[order[1:]] == number[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    highest = index["highest"][number]
    for start in range(0, max(1, size - step), step):
        stop = min(size, start + 2 * step)
        fresh = before[start:stop] < start
        if fresh.astype(np.float32) @ highest[start:stop].max(axis=1) >= threshold and \
                (fresh.astype(np.float32) @ highest[start:stop]).max() >= threshold - 1e-4:
            yield start, stop


def leaks(index: dict, text: str, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple]:
    """Items that the text holds: id, score, overlap of question and of answer, first word of the passage."""
    words = words_of(text)
    unknown = len(index["terms"])
    number = np.fromiter((index["terms"].get(w, unknown) for w in words), int, len(words))
    best: dict[int, tuple] = {}
    for start, stop in passages(index, number, threshold) if len(words) else ():
        terms = set(number[start:stop].tolist()) - {unknown}
        found = retrieve(index, list(terms), threshold)
        if not found:
            continue
        own: dict[int, set] = {}
        for item, score in found:
            shares = []
            for part in index["parts"][item]:
                n = len(next(iter(part)))
                if n not in own:
                    own[n] = {tuple(words[i:i + n]) for i in range(start, stop - n + 1)}
                shares.append(len(part & own[n]) / len(part))
            if min(shares) >= overlap and (item not in best or score > best[item][1]):
                best[item] = (index["ids"][item], score, *shares, start)
    return [best[k] for k in sorted(best)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Test items whose text a document holds.

    The items' terms are counted by Spark; an index of at most SHARD_ITEMS items at a time is broadcast, and every
    passage of every whole document queries it. All items that reach ``threshold`` of their own BM25 score are
    retrieved, and kept if the passage holds the share ``overlap`` of the word 5-grams of both question and answer. No
    row of documents is shuffled. Words are lower case without punctuation.

    One row per document row and item: doc_id, item_id, score, question_overlap, answer_overlap, first_word. A document
    without leaks has no row. Null and empty texts, of documents and items, match nothing; a null id stays null. Repeated
    rows give repeated results, but an item that is repeated in the benchmark with one id gives one. Empty tables give
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(w, len(words)) for words in (words_of(t.as_py()) for t in batch.column(1)) for w in {*words, b""} if words]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in own], pa.binary()), pa.array([o[1] for o in own], pa.int64())], ["term", "size"])

    # The empty term stands for the item itself: its count is that of all items, its sum their length.
    counted = items.mapInArrow(terms, "term binary, size long").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("size").alias("size"))
    total = counted.filter(F.length("term") == 0).first()
    texts = id_and_text(docs)
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"
    if total is None:
        return spark.createDataFrame([], schema)
    shards = -(-total["df"] // SHARD_ITEMS)
    result = None
    for shard in range(shards):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        known = part.mapInArrow(terms, "term binary, size long").select("term").distinct().join(counted, "term").select("term", "df").collect()
        index = build_index([(r[0], r[1]) for r in part.collect()], {bytes(r["term"]): r["df"] for r in known},
                            total["df"], total["size"] / total["df"])
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    by_item: dict = {}
                    for leak in leaks(shared.value, text.as_py(), threshold, overlap):
                        by_item.setdefault(leak[0], (doc_id, *leak))
                    rows += by_item.values()
                names = [f.split()[0] for f in schema.split(", ")]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

        found = texts.mapInArrow(run, schema)
        result = found if result is None else result.unionAll(found)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a leak, with all columns; rows without doc_id stay."""
    return without(docs, find_leaks(docs, benchmark))
