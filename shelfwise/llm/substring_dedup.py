"""Substring dedup: near-duplicate passages by compact windows of token min-hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import BROADCAST_ROWS, cut, id_and_text
from shelfwise.llm.exact_dedup import normalised
from shelfwise.llm.jaccard import Shingles, _mixed

#: A token is the 5-gram that starts at a word. A passage has MIN_WORDS words and the similarity of its sets is 0.8 or more.
GRAM, MIN_WORDS, SIMILARITY = 5, 50, 0.8
#: Min-hash functions. Passages of similarity 0.8 agree in one of four with probability 0.998, equal passages in all.
FUNCTIONS = 4
#: Distance from a window's least token to the token that tells its surroundings apart.
REACH = 12
#: Tokens without a partner that a passage may have in a row: two changed words.
GAP = 10
#: Repeats are looked for first by runs shorter by STEP - 1, every STEP tokens from a window's least token.
STEP = 16
#: Documents, about, in which hot keys are looked for, and how many of them have a hot key.
SAMPLE_DOCS, HOT = 5_000, 25
#: Windows that are passed on at a time.
CHUNK = 200_000
U = np.uint64


def packed_tokens(tokens: np.ndarray) -> bytes:
    """Tokens by their low 48 bits, which are enough to tell those of two documents apart."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_tokens(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(U).reshape(-1)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every window of the width, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out


def compact_windows(values: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(left, least, right) such that every run of at least ``width`` tokens has its least token at ``least`` for exactly
    the one window with left <= start <= least <= end <= right. Of equal tokens the first counts; one that follows an
    equal least token within the width goes with it.

    Only tokens that are least in some run of the width can have a window, and what bounds such a window is one of them;
    the Cartesian tree is built over these alone, with a stack.
    """
    n = len(values)
    if n < width:
        return []
    low = _sliding(values, width, np.minimum)
    pad = np.zeros(width - 1, values.dtype)
    places = np.flatnonzero(_sliding(np.concatenate([pad, low, pad]), width, np.maximum) == values).tolist()
    own = values[places].tolist()
    windows, stack = [], []  # of the stack: value, place, left end, last equal place
    for place, value in zip(places, own):
        while stack and stack[-1][0] > value:
            _, least, left, _ = stack.pop()
            if place - left >= width:
                windows.append((left, least, place - 1))
        if stack and stack[-1][0] == value and place - stack[-1][3] < width:
            stack[-1][3] = place
            continue
        stack.append([value, place, stack[-1][1] + 1 if stack else 0, place])
    for _, least, left, _ in stack:
        if n - left >= width:
            windows.append((left, least, n - 1))
    return windows


def _keys(least: np.ndarray, function: int) -> np.ndarray:
    """Keys of least tokens; the last two bits tell the function."""
    return (least & ~U(FUNCTIONS - 1) | U(function)).view(np.int64)


def _windows(texts: DataFrame, width: int) -> DataFrame:
    """key (function and least token), near (a token in its neighbourhood), doc_id, place, before and after (tokens of the
    window on either side of its least token).

    And for the first function's windows their marks, with the window's key as near and -1 before and after: hashes of the runs of
    ``width`` - STEP + 1 tokens that start a multiple of STEP away from the least token. Every run of the width has a mark's
    run in it; equal runs have equal windows' keys and marks."""
    step = min(STEP, width)
    names = ["key", "near", "doc_id", "place", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(GRAM)
        for batch in batches:
            parts: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = shingles.sequence(text.as_py())
                if len(tokens) < width:
                    continue
                for k in range(FUNCTIONS):
                    values = _mixed(tokens, 11 + k)
                    left, place, right = np.array(compact_windows(values, width), np.int64).T
                    near = tokens[np.minimum(place + REACH, len(tokens) - 1)]
                    keys = _keys(values[place], k)
                    parts.append((keys, near.view(np.int64), np.full(len(place), doc_id), place, place - left, right - place))
                    size += len(place)
                    if not k:
                        at, runs, hashes = _runs(tokens, left, place, right, width, step)
                        own, none = np.repeat(keys, runs), np.full(len(hashes), -1)
                        parts.append((_mixed(hashes ^ own.view(U), 3).view(np.int64), own, np.full(len(own), doc_id), np.repeat(at, runs), none, none))
                        size += len(own)
                if size > CHUNK:
                    yield packed(parts)
                    parts, size = [], 0
            if parts:
                yield packed(parts)

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, 3 * [pa.int64()] + 3 * [pa.int32()])], names)

    return texts.mapInArrow(run, "key long, near long, doc_id long, place int, before int, after int")


FIELDS = ["key", "near", "doc_id", "place", "before", "after"]


def _sample(df: DataFrame, share: float) -> DataFrame:
    return df.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(share * 1_000_000))


def _hot_keys(texts: DataFrame, width: int, share: float) -> DataFrame:
    """Keys that more than HOT of about SAMPLE_DOCS documents have. They are dealt over all tasks; results don't depend on it.

    At most SAMPLE_DOCS / HOT keys a window or mark of a document."""
    return _windows(_sample(texts, share), width).groupBy("key").count().filter(F.col("count") > HOT).select("key", F.lit(True).alias("hot"))


def _candidates(texts: DataFrame, width: int, share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Runs of tokens of a document that may be near one of the pivot: doc_id, pivot, first, last. And the keys of the first
    function's windows with a mark that two documents have, by document: doc_id, key. Hot keys are looked for in ``share``
    of the documents.

    Windows are dealt by key and sorted by key, neighbourhood, document. Each is held against the first window of its
    neighbourhood, and that against the first of its key: windows overlap, laid on each other at their least token, in an
    interval, which must be a passage long. The windows of a hot key are dealt in pieces by document and only passed on;
    they meet the first window of their whole neighbourhood, and that the first of its whole key, in joins by piece. So
    the same windows are held together whichever keys are hot and however many tasks there are.
    """
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Carried from batch to batch: first window of the key, first of the neighbourhood, last window.
        head = group = previous = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(7)])
            if previous is None:
                head = group = previous = rows[:, 0]
            full = np.concatenate([np.stack([head, group, previous], axis=1), rows], axis=1)
            new_key = np.concatenate([[False] * 3, (full[0, 3:] != full[0, 2:-1]) | (full[6, 3:] != full[6, 2:-1])])
            new_group = new_key | np.concatenate([[False] * 3, full[1, 3:] != full[1, 2:-1]])
            at = np.arange(full.shape[1])
            of_key = np.maximum.accumulate(np.where(new_key, at, 0))
            of_group = np.maximum.accumulate(np.where(new_group, at, 1))
            pivot = np.where(of_group == at, of_key, of_group)
            cold = np.flatnonzero(rows[6] < 0)
            mark, hot, first = rows[4] < 0, rows[6] >= 0, full[2, of_key[3:]]
            several = mark & (hot | (rows[2] != first))
            marks = np.concatenate([rows[2:0:-1, several], np.stack([first, rows[1]])[:, several]], axis=1)
            yield packed(_overlaps(rows[:, cold], full[:, pivot[3:][cold]], width), rows[:, hot & ~mark], np.unique(marks, axis=1))
            head, group, previous = full[:, of_key[-1]], full[:, of_group[-1]], full[:, -1]

    def packed(pairs: np.ndarray, hot: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(pairs, axis=1)
        none, docs = [None] * pairs.shape[1], [marks[0], *np.zeros((3, marks.shape[1]), np.int64)]
        columns = [pa.array(np.concatenate([p, np.zeros(hot.shape[1], np.int64), d])) for p, d in zip(pairs, docs)]
        windows = pa.array(none + hot.T.tolist() + [None] * marks.shape[1], pa.list_(pa.int64()))
        several = pa.array(none + [None] * hot.shape[1] + marks[1].tolist(), pa.int64())
        return pa.RecordBatch.from_arrays([*columns, windows, several], ["doc_id", "first", "last", "pivot", "window", "key"])

    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(tasks))).otherwise(-1)
    dealt = _windows(texts, width).join(F.broadcast(_hot_keys(texts, width, share)), "key", "left").select(*FIELDS, piece.cast("int").alias("piece"))
    linked = cut(dealt.repartition(tasks, "key", "piece").sortWithinPartitions("key", "piece", "near", "doc_id", "place")
                 .mapInArrow(link, "doc_id long, first long, last long, pivot long, window array<long>, key long"))
    hot = linked.filter("window IS NOT NULL").select(*(F.col("window")[k].alias(f) for k, f in enumerate([*FIELDS, "piece"])))
    in_group, firsts = _held(hot, ["key", "near"], width)
    firsts = firsts.select("key", "p.*").withColumn("piece", F.pmod(F.xxhash64("near"), F.lit(tasks)))
    in_key, _ = _held(firsts, ["key"], width)
    pairs = linked.filter("window IS NULL AND key IS NULL").drop("window", "key").unionAll(in_group).unionAll(in_key) \
        .groupBy("doc_id", "pivot").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return pairs, linked.filter("key IS NOT NULL").select("doc_id", "key")


def _held(windows: DataFrame, group: list[str], width: int) -> tuple[DataFrame, DataFrame]:
    """Overlaps of windows with the first window of their group, and the first windows (p) by group. A group has at most
    as many rows in any join as there are pieces, or as a piece has."""
    pieces = windows.groupBy(*group, "piece").agg(F.min(F.struct("near", "doc_id", "place", "before", "after")).alias("p"))
    firsts = pieces.groupBy(*group).agg(F.min("p").alias("p"))
    before, after = F.least("before", "p.before"), F.least("after", "p.after")
    held = windows.join(pieces.drop("p").join(firsts, group), [*group, "piece"]) \
        .filter((F.col("doc_id") != F.col("p.doc_id")) & (before + after + 1 >= width)) \
        .select("doc_id", (F.col("place") - before).alias("first"), (F.col("place") + after).alias("last"), F.col("p.doc_id").alias("pivot"))
    return held, firsts


def _runs(tokens: np.ndarray, left: np.ndarray, place: np.ndarray, right: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``width`` - ``step`` + 1 tokens of each window that start at, and every ``step`` tokens on, a multiple of ``step``
    away from the least token: start of the window's first run, number of runs, and of all of them the hashes."""
    length = width - step + 1
    left, right = np.maximum(left, place - width + 1), np.minimum(right, place + width - 1)
    at = place - (place - left) // step * step
    runs = (right - length + 1 - at) // step + 1
    ends = np.cumsum(runs)
    starts = np.repeat(at - (ends - runs) * step, runs) + np.arange(ends[-1]) * step
    return at, runs, _hashed_runs(tokens, length)[starts]


def _all_runs(texts: DataFrame, width: int) -> DataFrame:
    """By window of the first function: key, doc_id, at (start of the first run), runs (hashes of its runs of ``width`` tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(GRAM)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = shingles.sequence(text.as_py())
                if len(tokens) < width:
                    continue
                values = _mixed(tokens, 11)
                left, place, right = np.array(compact_windows(values, width), np.int64).T
                at, runs, hashes = _runs(tokens, left, place, right, width, 1)
                bounds = pa.array(np.concatenate([[0], np.cumsum(runs)]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(_keys(values[place], 0)), pa.array(np.full(len(place), doc_id)), pa.array(at),
                                                  pa.ListArray.from_arrays(bounds, pa.array(hashes.view(np.int64)))], ["key", "doc_id", "at", "runs"])

    return texts.mapInArrow(run, "key long, doc_id long, at long, runs array<long>")


def _hashed_runs(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of so many tokens that starts at each token, by doubling."""
    out, have = np.zeros(len(tokens) + 1, U), 0
    for bit in bin(length)[2:]:
        out, have = out[:len(out) - have] + out[have:] * U(pow(0x9E3779B97F4A7C15, have, 2**64)), 2 * have
        if bit == "1":
            out, have = tokens[:len(out) - 1] + out[1:] * U(0x9E3779B97F4A7C15), have + 1
    return _mixed(out, length)


def _repeats(texts: DataFrame, near: DataFrame, width: int, share: float) -> DataFrame:
    """Every run of ``width`` tokens that another document has, too: doc_id, first_word, last_word, class_id, similarity.

    No run is held against a pivot: equal runs lie in windows with an equal key and an equal mark, and are found by their hash. Of
    the documents with such a mark, the windows whose key has one go on, and all their runs meet: those that a sample
    shows to be hot by sums of each task, all others dealt by their hash."""
    docs, keys = cut(near.select("doc_id").distinct()), cut(near.select("key").distinct())
    rows = cut(_all_runs(texts.join(_sized(docs), "doc_id", "left_semi"), width).join(_sized(keys), "key", "left_semi").select("doc_id", "at", "runs"))
    runs = rows.select("doc_id", "at", F.posexplode("runs").alias("further", "run")) \
        .select("doc_id", (F.col("at") + F.col("further")).cast("int").alias("first"), "run")
    # At most SAMPLE_DOCS / HOT runs a token of a document.
    hot = cut(_sample(runs, share).groupBy("run").count().filter(F.col("count") > HOT).select("run"))
    often = runs.join(F.broadcast(hot), "run")
    least, most = F.min("doc_id"), F.max("doc_id")
    of_often = cut(often.groupBy("run").agg(least.alias("class_id"), most.alias("most")))
    same = Window.partitionBy("run")
    found = runs.join(F.broadcast(hot), "run", "left_anti").select("doc_id", "first", least.over(same).alias("class_id"), most.over(same).alias("most")) \
        .unionAll(often.join(F.broadcast(of_often), "run").select("doc_id", "first", "class_id", "most")).filter("class_id < most")
    first = F.col("first").cast("long")
    return found.select("doc_id", first.alias("first_word"), (first + width + GRAM - 2).alias("last_word"), "class_id", F.lit(1.0).alias("similarity"))


def _overlaps(own: np.ndarray, other: np.ndarray, width: int) -> np.ndarray:
    before, after = np.minimum(own[4], other[4]), np.minimum(own[5], other[5])
    good = (before + after + 1 >= width) & (own[2] != other[2]) & (own[0] == other[0])
    return np.stack([own[2], own[3] - before, own[3] + after, other[2]])[:, good]


def _stretches(matched: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Stretches of matched tokens, as slices, and the shift that two or more of a stretch have, in the order in which tokens
    that occur more than once are to be laid by them: longer stretches later, and what surrounds stretches before them.

    ``first`` and ``last`` are where a token occurs in the other sequence. Tokens of a shift are one stretch where gaps are
    shorter than the width, so all stretches together are at most so many times as long as the sequence."""
    at, where = np.concatenate([matched, matched[first != last]]), np.concatenate([first, last[first != last]])
    shift = at - where
    by = np.lexsort((at, shift))
    at, shift = at[by], shift[by]
    begin = np.concatenate([[True], (np.diff(shift) != 0) | (np.diff(at) >= width)])
    starts = np.flatnonzero(begin)
    counts = np.diff(np.append(starts, len(at)))
    several = np.flatnonzero(counts > 1)
    several = several[np.argsort(counts[several], kind="stable")]
    low, high, shifts = at[starts[several]], at[starts[several] + counts[several] - 1], shift[starts[several]]
    out = []
    for around in (width, 0):
        out += zip(np.searchsorted(matched, low - around).tolist(), np.searchsorted(matched, high + around, side="right").tolist(), shifts.tolist())
    return out


def matching_passages(own: np.ndarray, other: np.ndarray, order: np.ndarray, width: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """Passages (first and last token in own, first and last in other, similarity) in which two sequences nearly agree.

    order sorts other. Pieces that run alike in both grow, the longest first, by their neighbours while as many tokens
    agree as the similarity asks; of what comes out the sets of tokens are compared.
    """
    place = order[np.minimum(np.searchsorted(other, own, sorter=order), len(other) - 1)]
    matched = np.flatnonzero(other[place] == own)
    if len(matched) < similarity * width:
        return []
    last = order[np.searchsorted(other, own[matched], side="right", sorter=order) - 1]
    for start, end, shift in _stretches(matched, place[matched], last, width):
        there = matched[start:end] - shift
        fits = (there >= 0) & (there < len(other))
        fits[fits] = other[there[fits]] == own[matched[start:end][fits]]
        place[matched[start:end][fits]] = there[fits]
    there = place[matched]
    step = np.diff(there)
    breaks = np.flatnonzero((np.diff(matched) > 1) | (step > 1) | (step < 0)) + 1
    begin, end = np.concatenate([[0], breaks]), np.concatenate([breaks - 1, [len(matched) - 1]])
    pieces = list(zip(matched[begin].tolist(), matched[end].tolist(), there[begin].tolist(), there[end].tolist()))
    free = [True] * len(pieces)
    found = []

    for k in np.argsort(begin - end, kind="stable").tolist():
        if not free[k]:
            continue
        left = right = k
        first, last, low, high = pieces[k]
        agree = last - first + 1
        while True:
            best = None
            for n in (left - 1, right + 1):
                if 0 <= n < len(pieces) and free[n]:
                    a, b, c, d = pieces[n]
                    wide = (min(first, a), max(last, b), min(low, c), max(high, d))
                    both = agree + b - a + 1
                    share = both / (wide[1] - wide[0] + wide[3] - wide[2] + 2 - both)
                    if max(a - last, first - b) <= GAP + 1 and share >= similarity and (best is None or share > best[0]):
                        best = (share, n, both, wide)
            if best is None:
                break
            _, n, agree, (first, last, low, high) = best
            left, right = min(left, n), max(right, n)
        if last - first + 1 < width:
            continue
        x, y = np.unique(own[first:last + 1]), np.unique(other[low:high + 1])
        both = len(np.intersect1d(x, y, assume_unique=True))
        share = both / (len(x) + len(y) - both)
        if share >= similarity:
            free[left:right + 1] = [False] * (right + 1 - left)
            found.append((first, last, low, high, share))
    return found


def _sized(df: DataFrame) -> DataFrame:
    """Ids, to be broadcast if they are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of ``min_words`` words or more that nearly repeat in another document.

    Of equal texts (but for runs of white space) one is read, the others get its whole length as a passage. Tokens are
    5-grams of words, A-Z in lower case. For each of FUNCTIONS min-hash functions, compact windows over a
    Cartesian tree stand for all runs of tokens with the same least token. Windows with an equal least token are
    joined where their intervals overlap by a passage, and the texts of the runs are then compared: kept are passages
    whose sets of tokens have the similarity or more. For that a window is held against one or two others, not against all;
    runs that are equal word for word are found by their hash besides, without such a choice.

    One row per document and passage: doc_id, first_word, last_word (both included, from 0), class_id (the smallest
    doc_id that a passage of this stretch was held against, or its own), similarity. Overlapping passages of a document
    are one row. Documents without a repeated passage have none.

    Null, empty and short texts have no passage. Rows without doc_id are not read. Rows of one doc_id with different
    texts are read as one document's; repeated rows count once. An empty table gives no rows; other columns are not read.
    """
    width = max(1, min_words - GRAM + 1)
    texts = id_and_text(docs).filter(F.col("doc_id").isNotNull() & (F.length("text") >= min_words))
    norm = texts.select("doc_id", F.trim(normalised(F.col("text"))).alias("norm"))
    spaces = F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit("")))
    keyed = cut(norm.select("doc_id", F.xxhash64("norm").alias("h1"), F.hash("norm").alias("h2"), (spaces + 1).alias("words")).distinct())
    groups = keyed.groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id"), F.countDistinct("doc_id").alias("n"))
    copies = cut(keyed.join(groups.filter("n > 1"), ["h1", "h2"]).filter(F.col("words") >= min_words)
                 .select("doc_id", "class_id", "words"))
    others = copies.filter("doc_id <> class_id").select("doc_id").distinct()
    read = texts.join(_sized(others), "doc_id", "left_anti")
    share = min(1.0, SAMPLE_DOCS / max(1, read.count()))
    pairs, near = _candidates(read, width, share)
    pairs = cut(pairs)
    names = ["doc_id", "first_word", "last_word", "class_id", "similarity"]

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(GRAM)
        for batch in batches:
            rows = []
            for doc_id, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                tokens = shingles.sequence(text.as_py())
                rows += [(w["pivot"], doc_id, w["first"], packed_tokens(tokens[max(0, w["first"]):w["last"] + 1])) for w in wanted.as_py()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                             ["pivot", "doc_id", "first", "tokens"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, pivot, other, order = Shingles(GRAM), None, np.empty(0, U), np.empty(0, np.int64)
        for batch in batches:
            rows = set()
            for p, text, doc_id, first, tokens in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                                      batch.column(3).to_pylist(), batch.column(4)):
                if p != pivot:
                    pivot, other = p, shingles.sequence(text.as_py()) & U(2**48 - 1)
                    order = np.argsort(other, kind="stable")
                own = unpacked_tokens(tokens.as_py())
                if not len(own) or not len(other):
                    continue
                for a, b, low, high, share in matching_passages(own, other, order, width, similarity):
                    rows.add((doc_id, first + a, first + b + GRAM - 1, min(p, doc_id), share))
                    rows.add((p, low, high + GRAM - 1, min(p, doc_id), share))
            columns = list(zip(*sorted(rows))) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    # Runs of a document are as many as its windows at most. What is broadcast, if it is, are ids alone. Texts that are asked
    # for and pivots are one frame, joined twice by doc_id, so that Spark shuffles them once.
    wanted = pairs.groupBy("doc_id").agg(F.collect_list(F.struct("pivot", "first", "last")).alias("wanted"))
    ids = cut(pairs.select("doc_id").unionAll(pairs.select("pivot")).distinct())
    both = read.join(_sized(ids), "doc_id", "left_semi").select("doc_id", "text")
    asked = both.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(slices, "pivot long, doc_id long, first long, tokens binary") \
        .select(F.col("pivot").alias("doc_id"), F.col("doc_id").alias("other"), "first", "tokens")
    found = asked.join(both, "doc_id").select("doc_id", "text", "other", "first", "tokens") \
        .mapInArrow(compare, "doc_id long, first_word long, last_word long, class_id long, similarity double")
    whole = copies.select("doc_id", F.lit(0).cast("long").alias("first_word"), (F.col("words") - 1).cast("long").alias("last_word"),
                          "class_id", F.lit(1.0).alias("similarity"))
    return _merged(found.unionAll(_repeats(read, near, width, share)).unionAll(whole))


def _merged(passages: DataFrame) -> DataFrame:
    """Overlapping passages of a document as one. Of equal rows, which lie one after the other, all but the first begin nothing."""
    order = Window.partitionBy("doc_id").orderBy("first_word", "last_word")
    reached = F.max("last_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("first_word") > reached), 1).otherwise(0)
    return passages.withColumn("begins", begins).withColumn("n", F.sum("begins").over(order)).groupBy("doc_id", "n").agg(
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.min("class_id").alias("class_id"), F.max("similarity").alias("similarity")).drop("n")
