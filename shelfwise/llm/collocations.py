"""Collocations by a weighted de Bruijn graph: the longest n-grams are its edges, shorter counts are its flow."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import sized
from shelfwise.session import stored

LONGEST, MIN_COUNT, TOP = 5, 100, 2000
#: What ends a piece becomes a byte that UTF-8 never has.
PIECE_ENDS, END = b".,;:!?\n\x0b\x0c\r", b"\xff"
MARKED = bytes.maketrans(PIECE_ENDS, END * len(PIECE_ENDS))
#: Words that are counted together before they leave a task, and bytes after which a long text is cut at a piece end.
BLOCK_WORDS, BLOCK_BYTES = 1_000_000, 4_000_000
#: Sorted rows that are summed up together, and bytes of them.
RUN_ROWS, RUN_BYTES = 200_000, 256_000_000
#: Documents whose edges, and edges of them, that the cuts between ranges are chosen from, and characters of a cut.
SAMPLE_DOCS, SAMPLE_EDGES, CUT_LENGTH = 2_000, 100_000, 64
#: Pieces that a language is dealt into before its best phrases are taken.
RANK_PIECES = 32


class Numbers(dict):
    """Numbers words as they come, from 1 on."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def escaped(word: bytes) -> bytes:
    """The word without zero bytes, so that a zero byte can stand between words and sorts before all of them."""
    return word if b"\0" not in word and b"\1" not in word else word.replace(b"\1", b"\1\2").replace(b"\0", b"\1\1")


def unescaped(text: Column) -> Column:
    """Escaped words as they were."""
    return F.replace(F.replace(text, F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))


def words_of(key: str, n: Column) -> Column:
    """The first n words of a key, or the last -n."""
    return F.call_function("substring_index", F.col(key), F.lit("\0"), n.cast("int"))


def pieces_of(text: bytes) -> Iterator[bytes]:
    """Parts of a text that hold whole pieces."""
    data, start = text.lower().translate(MARKED), 0  # bytes.lower changes A-Z alone
    while len(data) - start > BLOCK_BYTES:
        end = data.find(END, start + BLOCK_BYTES)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:] if start else data


class Edges:
    """Counts the edges of a block of texts: at every word the phrase of LONGEST words that begins there, or what the piece has."""

    def __init__(self) -> None:
        self.words, self.langs = Numbers(), Numbers()
        self.ids: list[np.ndarray] = []
        self.lang_of: list[int] = []
        self.size = 0

    def add(self, lang: str, part: bytes) -> None:
        found = part.replace(END, b" " + END + b" ").split()  # all other white space than spaces and tabs is marked
        ids = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        if len(ids):
            self.ids.append(ids)
            self.lang_of.append(self.langs[lang.encode()])
            self.size += len(ids)

    def take(self) -> tuple[pa.Array, np.ndarray] | None:
        """Keys in byte order (language and words, a zero byte between) and counts of all that was added; then empty."""
        if not self.ids:
            return None
        langs, lang_rank = _ranked(self.langs)
        words, word_rank = _ranked(self.words)
        word_rank[self.words.get(END, 0)] = 0  # between pieces, as between texts; no phrase goes over it
        gap = np.zeros(1, np.int64)
        ids = np.concatenate([*chain.from_iterable((word_rank[i], gap) for i in self.ids), np.zeros(LONGEST, np.int64)])
        lang = np.repeat(lang_rank[self.lang_of], [len(i) + 1 for i in self.ids])
        self.__init__()
        starts = np.flatnonzero(ids[:len(lang)])
        if not len(starts):
            return None
        columns, open_ = [lang[starts]], np.ones(len(starts), bool)
        for j in range(LONGEST):
            word = np.where(open_, ids[starts + j], 0)
            open_ &= word > 0
            columns.append(word)
        packed = [columns[k] << 32 | columns[k + 1] for k in range(0, LONGEST + 1, 2)]
        order = np.lexsort(packed[::-1])
        packed = [p[order] for p in packed]
        new = np.concatenate(([True], np.any([p[1:] != p[:-1] for p in packed], axis=0)))
        first = np.flatnonzero(new)
        counts = np.diff(first, append=len(order))
        parts = [langs.take(pa.array(columns[0][order[first]]))]
        for column in columns[1:]:
            rank = column[order[first]]
            parts.append(words.take(pa.array(rank, mask=rank == 0)))
        return pc.binary_join_element_wise(*parts, pa.scalar(b"\0", pa.large_binary()), null_handling="skip"), counts


def _ranked(numbers: Numbers) -> tuple[pa.Array, np.ndarray]:
    """The words in byte order, from place 1 on, and the place of each number."""
    known = {escaped(w): n for w, n in numbers.items()}
    ordered = sorted(known)
    rank = np.zeros(len(ordered) + 1, np.int64)
    rank[[known[w] for w in ordered]] = np.arange(1, len(ordered) + 1)
    return pa.array([b"", *ordered], pa.large_binary()), rank


def edges(docs: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Edges of the graph: part (range of the key), key, count. A task counts a block of texts before it passes rows on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Edges()

        def rows() -> Iterator[pa.RecordBatch]:
            if (taken := block.take()) is None:
                return
            keys, counts = taken
            size = len(keys)
            ends = [bisect_left(range(size), c, key=lambda i: keys[i].as_py()) for c in cuts]
            part = np.repeat(np.arange(len(cuts) + 1), np.diff([0, *ends, size]))
            for at in range(0, size, 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(part[some], pa.int32()), keys[some].cast(pa.binary()).cast(pa.string()),
                                                  pa.array(counts[some], pa.int64())], ["part", "key", "count"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in pieces_of(text.as_py().encode()):
                    block.add(lang, part)
                    if block.size >= BLOCK_WORDS:
                        yield from rows()
        yield from rows()

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "part int, key string, count long")


def choose_cuts(docs: DataFrame, parts: int) -> list[bytes]:
    """Keys that cut the edges of a sample into ranges of about the same size; a bad choice only makes tasks uneven."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    sample = edges(docs.sample(share, seed=1), []).select(F.substring("key", 1, CUT_LENGTH).alias("key"), F.xxhash64("key").alias("h"))
    drawn = sorted(r.key.encode() for r in sample.orderBy("h").limit(min(SAMPLE_EDGES, 100 * parts)).collect())
    return sorted({drawn[len(drawn) * k // parts] for k in range(1, parts)}) if drawn else []


def flow(keys: pa.Array, count: np.ndarray, min_count: int) -> list[pa.Array]:
    """Counts of all phrases in a run of sorted edges, as columns key, low, high, count, whole.

    A node's edges lie together, so what flows through it is the sum over them and over the pieces that end in it. Where a
    single edge takes the whole flow of a node on, both are one path: a row stands for the first ``low`` to ``high`` words of its
    key. A phrase at either end of the run may go on in another run: its row is not whole and is added up later, as
    are the totals of languages (0 words). Of phrases that are whole, those under min_count are left out.
    """
    split = pc.split_pattern(keys, b"\0")
    words = split.flatten().dictionary_encode().indices.to_numpy()
    offsets = np.asarray(split.offsets, np.int64)
    size, length = len(keys), np.diff(offsets)
    change = np.zeros(size, bool)
    change[0] = True
    starts, totals, lows, carried, open_ = [], [], [], [], []
    for level in range(LONGEST + 1):
        has = length > level
        word = np.where(has, words[np.minimum(offsets[:-1] + level, len(words) - 1)], -1)
        change[1:] |= word[1:] != word[:-1]
        start = np.flatnonzero(change)
        total = np.add.reduceat(count, start)
        at_end = np.concatenate((np.zeros(len(start) - 1, bool), [True]))
        there = has[start]
        start, total = start[there], total[there]
        part = (start == 0) | at_end[there] | (level == 0)
        low = np.full(len(start), level)
        if level > 1 and len(start):
            above = np.minimum(np.searchsorted(starts[-1], start), len(starts[-1]) - 1)
            one = (starts[-1][above] == start) & (totals[-1][above] == total) & ~open_[-1][above] & ~part
            low[one] = lows[-1][above[one]]
            carried[-1][above[one]] = True
        starts.append(start)
        totals.append(total)
        lows.append(low)
        open_.append(part)
        carried.append(np.zeros(len(start), bool))
    columns = []
    for level in range(LONGEST + 1):
        out = open_[level] | (~carried[level] & (totals[level] >= min_count))
        key = pc.binary_join(pc.list_slice(split.take(pa.array(starts[level][out])), 0, level + 1), b"\0")
        columns.append((key, lows[level][out], np.full(int(out.sum()), level), totals[level][out], ~open_[level][out]))
    key, *numbers = zip(*columns)
    low, high, total, whole = map(np.concatenate, numbers)
    return [pa.concat_arrays(key).cast(pa.string()), pa.array(low, pa.int32()), pa.array(high, pa.int32()),
            pa.array(total, pa.int64()), pa.array(whole)]


def paths(docs: DataFrame, min_count: int) -> DataFrame:
    """Compacted paths and parts of counts over all documents: key, low, high, count, whole; see flow."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = choose_cuts(docs, parts)
    ranged = edges(docs, cuts).repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("key").select("key", "count")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, weight = [], 0, 0
        for batch in chain(batches, [None]):
            if batch is not None:
                waiting.append(batch)
                size, weight = size + batch.num_rows, weight + batch.nbytes
            if size >= RUN_ROWS or weight >= RUN_BYTES or batch is None and size:
                table = pa.Table.from_batches(waiting)
                keys = pa.concat_arrays(table.column("key").cast(pa.binary()).chunks)
                yield pa.RecordBatch.from_arrays(flow(keys, table.column("count").to_numpy(), min_count),
                                                 ["key", "low", "high", "count", "whole"])
                waiting, size, weight = [], 0, 0

    return ranged.mapInArrow(run, "key string, low int, high int, count long, whole boolean")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to LONGEST words with at least min_count occurrences, and the number of words per language.

    The first is lang, phrase (escaped words, a zero byte between), words, f; the second is lang, n.
    """
    found = stored(paths(docs, min_count), "phrase-paths")
    parts = found.filter("NOT whole").groupBy("key", "high").agg(F.sum("count").alias("f"))
    whole = found.filter("whole").select("key", F.explode(F.sequence("low", "high")).alias("words"), F.col("count").alias("f"))
    both = whole.unionByName(parts.filter((F.col("high") > 0) & (F.col("f") >= min_count)).withColumnRenamed("high", "words"))
    lang = words_of("key", F.lit(1))
    phrases = both.select(lang.alias("lang"), "words", "f", words_of("key", F.col("words") + 1).alias("key")).select(
        "lang", F.expr("substring(key, length(lang) + 2)").alias("phrase"), "words", "f")
    return stored(phrases, "phrases"), parts.filter("high = 0").select(F.col("key").alias("lang"), F.col("f").alias("n"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The phrases of two to five words whose words attract each other most, per language.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs. The edges
    of the graph are the phrases of five words, or up to the end of the piece, that begin at each word; they are counted within
    blocks of texts, dealt by range of their key at cuts chosen from a sample, and sorted. All counts of shorter phrases are
    sums over neighbouring rows, so the texts are shuffled this one time; what goes on is phrases with at least
    min_count occurrences. A phrase that a longer one contains each time it occurs is dropped: as that longer one can
    be reached a word at a time, it's enough to look at phrases that are one word longer. The others are scored by their
    weakest cut, floor(1000 * a * n / (l * r)), in decimals of 38 digits: exact while a * n is under 10^35.

    Result: lang, rank, phrase, a, l, r, n, score; ``top`` rows a language at most, by score and a descending, then by the
    bytes of the phrase. Of cuts with the same score the one after fewer words counts. Null texts are empty, a null
    lang is ``und``; ids and other columns are not read and repeated rows count each. An empty table gives no rows. A very
    long text is read in parts that end where a piece ends; a piece is held whole.
    """
    phrases, sizes = phrase_counts(docs, min_count)
    candidates = phrases.filter("words > 1")
    # What a phrase loses to one that is a word longer; a plain maximum, as the same phrase can go on in many ways.
    longer = phrases.filter("words > 2")
    own = candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.lit(None).cast("long").alias("taken"))
    cut = [words_of("phrase", F.col("words") - 1), words_of("phrase", 1 - F.col("words"))]
    taken = [longer.select("lang", c.alias("phrase"), F.lit(None).cast("int").alias("words"), F.lit(None).cast("long").alias("a"),
                           F.col("f").alias("taken")) for c in cut]
    kept = own.unionByName(taken[0]).unionByName(taken[1]).groupBy("lang", "phrase").agg(
        F.max("words").alias("words"), F.max("a").alias("a"), F.max("taken").alias("taken")
    ).filter("a IS NOT NULL AND (taken IS NULL OR taken < a)").drop("taken")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    known = phrases.select("lang", F.col("phrase").alias("part"), "f")
    left = cuts.withColumn("part", words_of("phrase", F.col("k"))).join(known, ["lang", "part"]) \
        .withColumnRenamed("f", "l").drop("part")
    right = left.withColumn("part", words_of("phrase", F.col("k") - F.col("words"))).join(known, ["lang", "part"]) \
        .withColumnRenamed("f", "r").drop("part")
    by_cut = [F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in range(1, LONGEST) for c in "lr"]
    wide = right.groupBy("lang", "phrase", "a").agg(*by_cut).join(sized(sizes), "lang")
    options = [F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"(1000 * cast(a AS decimal(19, 0)) * cast(n AS decimal(15, 0))) div (cast(l{k} AS decimal(19, 0)) * cast(r{k} AS decimal(19, 0)))").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]
    scored = wide.select("lang", "phrase", "a", "n", F.array_min(F.filter(F.array(*options), lambda o: o.isNotNull())).alias("best")) \
        .select("lang", "phrase", "a", "n", "best.l", "best.r", "best.score") \
        .withColumn("text", unescaped(F.replace(F.col("phrase"), F.lit("\0"), F.lit(" "))))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("text")]
    pieces = scored.withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PIECES)))
    near = pieces.withColumn("near", F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order))).filter(F.col("near") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select(unescaped(F.col("lang")).alias("lang"), "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
