"""Language model scores: Brown classes of words, class transitions and word emissions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import cut, fold, from_bytes, id_and_text, low_bytes, release_shuffles

#: Frequent words whose counts every task has at hand, each of at most MAX_BYTES; the counts of all others are joined.
HEAD, MAX_BYTES = 200_000, 64
#: Words that the driver exchanges one by one, the most frequent ones, and groups, by their last three bytes, that all others start in
#: before every one of them is exchanged on its own.
UNITS, SUFFIXES = 768, 64
#: Least number of classes, sweeps of the driver, and rounds over all other words, of every second one each.
CLASSES, SWEEPS, ROUNDS = 32, 8, 4
#: Occurrences that a task packs at a time, that a part of them has, about, and words in a block of them.
PACKED, PART, BLOCK = 1 << 18, 1_000_000, 2_048
#: What a word's move has to gain at least, in units of what it takes to name a class: a word that occurs once or twice stays in its
#: group if its few neighbours say no more than that.
LEAST_GAIN = 1.0
#: Cells that are added up at a time, and counts for which their gains are known beforehand.
CELLS, SMALL = 1_024, 8
#: Added to every count of a word within its class, and of a class after another.
DELTA = 0.5
#: Words that a counting task holds before it passes its counts on.
HELD = 300_000


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case. Of bytes, lower() and split() know ASCII only."""
    return text.encode("utf-8", "replace").lower().split()


def number_of_classes(kinds: int) -> int:
    """Classes for so many distinct words: they grow with the vocabulary, by its cube root."""
    return max(CLASSES, round(kinds ** (1 / 3)))


def _suffix(word: bytes) -> int:
    return crc32(word[-3:]) % SUFFIXES


def count_words(texts: DataFrame) -> DataFrame:
    """word (binary), count. Tasks add up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                               ["word", "count"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                if len(held) > HELD:
                    yield passed_on()
        yield passed_on()

    return texts.select("text").mapInArrow(run, "word binary, count long").groupBy("word").agg(F.sum("count").alias("count"))


def _frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``, by falling count: all from the lowest power of 2^(1/8) on that fits."""
    level = F.floor(F.log2("count") * 8)
    short = counts.filter(F.length("word") <= MAX_BYTES)
    total, least = 0, None
    for row in sorted(short.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return []
    found = short.filter(level >= least).toArrow()
    return sorted(zip(found["word"].to_pylist(), found["count"].to_pylist()), key=lambda r: (-r[1], r[0]))


class Vocabulary(NamedTuple):
    """Numbers of the frequent words, and the unit of every word: its own for the first UNITS, else that of its suffix.

    The last unit is the end of a text."""

    number: dict[bytes, int]
    own: int
    unit: np.ndarray

    @classmethod
    def of(cls, head: list[bytes]) -> Vocabulary:
        own = min(UNITS, len(head))
        unit = np.array([*range(own), *(own + _suffix(w) for w in head[own:])], int)
        return cls({w: i for i, w in enumerate(head)}, own, unit)

    @property
    def end(self) -> int:
        return self.own + SUFFIXES

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Numbers of a text's words (-1: not frequent), their units, and the words that are not frequent."""
        words, known = words_of(text), self.number.get
        number = np.array([known(w, -1) for w in words], int)
        rare = [words[i] for i in np.flatnonzero(number < 0)]
        unit = np.empty(len(words), int)
        unit[number >= 0] = self.unit[number[number >= 0]]
        unit[number < 0] = [self.own + _suffix(w) for w in rare]
        return number, unit, rare


def count_pairs(texts: DataFrame, vocabulary: Broadcast) -> np.ndarray:
    """How often a unit follows another, over all texts; a text starts after the end of one and ends with one.

    Every task sends at most one row per pair; units are so few that the sums fit the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*vocabulary.value)
        n = words.end + 1
        total = np.zeros(n * n, np.int64)
        for batch in batches:
            units = [np.append(words.read(t.as_py())[1], words.end) for t in batch.column(0)]
            if units:
                flat = np.concatenate([[words.end], *units])
                total += np.bincount(flat[:-1] * n + flat[1:], minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "count"])

    n = Vocabulary(*vocabulary.value).end + 1
    rows = texts.select("text").mapInArrow(run, "pair long, count long").groupBy("pair").agg(F.sum("count").alias("count")).toArrow()
    pairs = np.zeros(n * n)
    pairs[rows["pair"].to_numpy()] = rows["count"].to_numpy()
    return pairs.reshape(n, n)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every unit: units move, one after the other, to the class that makes the class bigrams likeliest.

    The last unit, the end of a text, keeps a class of its own, the last."""
    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    n = len(pairs) - 1
    order = np.argsort(-pairs.sum(axis=1)[:n], kind="stable")
    own = np.empty(n + 1, int)
    own[order] = np.arange(n) % classes
    own[n] = classes
    member = np.eye(classes + 1)[own]
    table = member.T @ pairs @ member
    inner = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            old = own[u]
            right = np.bincount(own, pairs[u], classes + 1)
            left = np.bincount(own, pairs[:, u], classes + 1)
            self_pairs = pairs[u, u]
            right[old] -= self_pairs
            left[old] -= self_pairs
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= self_pairs
            rows, columns = table.sum(axis=1)[:classes], table.sum(axis=0)[:classes]
            # Gain of putting u into each class: its row, its column, the cell where they meet, and the margins.
            gain = (f(table[:classes] + right) - f(table[:classes])).sum(axis=1) + (f(table[:, :classes].T + left) - f(table[:, :classes].T)).sum(axis=1)
            cell = table[inner, inner]
            gain += f(cell + right[inner] + left[inner] + self_pairs) + f(cell) - f(cell + right[inner]) - f(cell + left[inner])
            gain -= f(rows + right.sum() + self_pairs) - f(rows) + f(columns + left.sum() + self_pairs) - f(columns)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += right
            table[:, new] += left
            table[new, new] += self_pairs
            own[u] = new
            moved += new != old
        if not moved:
            break
    return own


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers from 0 on, by their bytes, all the lowest ones first: small numbers take little."""
    return compress(low_bytes(values.astype(np.uint64)).T.tobytes(), 1)


def _unsqueezed(data: bytes, count: int) -> np.ndarray:
    raw = np.frombuffer(decompress(data), np.uint8)
    return from_bytes(np.ascontiguousarray(raw.reshape(-1, count).T).tobytes(), count).astype(np.int64) if count else np.empty(0, np.int64)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, but for what no exchange changes."""
    return float(_f(table).sum() - _f(table.sum(axis=0)).sum() - _f(table.sum(axis=1)).sum())


def best_classes(own: np.ndarray, table: np.ndarray, words: np.ndarray, counts: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The class that each of some words gains most by, all others staying where they are.

    own: class of every word by number; table: class bigrams; before and after: words next to the occurrences of each
    word, one word's after the other's."""
    classes = len(table) - 1
    row, old = np.repeat(np.arange(len(words)), counts), own[words]
    gains, stay = np.zeros((len(words), classes)), np.zeros(len(words))
    for near, cells in ((after, table[:classes].T), (before, table[:, :classes])):
        here = _f(cells)
        small = np.concatenate([_f(cells + n) - here for n in range(1, SMALL + 1)])
        key, n = np.unique(row * (classes + 1) + own[near], return_counts=True)
        at, c = key // (classes + 1), key % (classes + 1)
        for start in range(0, len(key), CELLS):
            part = slice(start, start + CELLS)
            more = small[(np.minimum(n[part], SMALL) - 1) * (classes + 1) + c[part]]
            large = np.flatnonzero(n[part] > SMALL)
            more[large] = _f(cells[c[part][large]] + n[part][large, None]) - here[c[part][large]]
            first = np.flatnonzero(np.concatenate([[True], np.diff(at[part]) > 0]))
            gains[at[part][first]] += np.add.reduceat(more, first, axis=0)
        cell = cells[c, old[at]]
        stay += np.bincount(at, _f(cell) - _f(cell - n), len(words))
    margins = table.sum(axis=1)[:classes], table.sum(axis=0)[:classes]
    kinds, which = np.unique(counts, return_inverse=True)
    for margin in margins:
        gains -= (_f(margin + kinds[:, None]) - _f(margin))[which]
        stay -= _f(margin[old]) - _f(margin[old] - counts)
    gains[np.arange(len(words)), old] = stay
    best = gains.argmax(axis=1)
    return np.where(gains[np.arange(len(words)), best] > stay + LEAST_GAIN * np.log(classes), best, old)


class Numbered(NamedTuple):
    """Numbers of all words of the training texts: those at hand first, then the others. The number after the last is the end of a text."""

    rest: DataFrame  # word, count, id: the words that are not at hand
    total: int
    flags: np.ndarray  # by number: suffix, and in the last bit the round in which the word may move

    @classmethod
    def of(cls, counts: DataFrame, head: list[tuple[bytes, int]]) -> Numbered:
        rest = counts.filter(~((F.length("word") <= MAX_BYTES) & (F.col("count") >= head[-1][1]))) if head else counts
        # Counts are a checkpoint, so that its rows have the same places each time.
        rest = rest.select("word", "count", F.monotonically_increasing_id().alias("place"))
        task, within = F.shiftright("place", 33), F.col("place").bitwiseAND(2**33 - 1)
        sizes = sorted(tuple(r) for r in rest.groupBy(task.alias("task")).count().collect())
        firsts = len(head) + np.cumsum([0, *(n for _, n in sizes)])
        offsets = counts.sparkSession.createDataFrame([(t, int(f)) for (t, _), f in zip(sizes, firsts)], "task long, first long")
        rest = rest.join(F.broadcast(offsets), task == F.col("task")).select("word", "count", (F.col("first") + within).alias("id"))
        flags = np.zeros(int(firsts[-1]), np.uint8)
        flags[:len(head)] = [_flag(w) for w, _ in head]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = _squeezed(batch.column(0).to_numpy())
                flag = bytes(_flag(w.as_py()) for w in batch.column(1))
                yield pa.RecordBatch.from_arrays([pa.array([ids], pa.binary()), pa.array([flag], pa.binary())], ["ids", "flags"])

        for ids, flag in rest.select("id", "word").mapInArrow(run, "ids binary, flags binary").collect():  # some bytes a word
            flags[_unsqueezed(ids, len(flag))] = np.frombuffer(flag, np.uint8)
        return cls(rest, len(flags), flags)


def _flag(word: bytes) -> int:
    return _suffix(word) | (crc32(word) & 1) << 7


def _sequences(texts: DataFrame, numbered: Numbered, vocabulary: Broadcast, head_counts: np.ndarray, tokens: int, kinds: int, ends: int) -> DataFrame:
    """One row per id and text: doc_id, copies, n_tokens, n_known, base (score), logs (sum of log10 (count + DELTA)), ids (packed numbers
    of its words, SUFFIXES added; one that is not in the training texts is told by its suffix, below that).

    Words at hand are numbered where the text is read, the others by a join, one row per text and word."""
    shared = texts.sparkSession.sparkContext.broadcast(head_counts)
    end_score, space = float(np.log10((ends + 1) / (tokens + kinds + 1))), float(np.log10(tokens + kinds + 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, entry = Vocabulary(*vocabulary.value), pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int32())]))
        known_, known = words.number, words.number.get
        for batch in batches:
            paths, entries, lengths = [], [], []
            for key, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                places: dict[bytes, int] = {}
                # Words that are not at hand by their place among these, above all numbers.
                path = np.array([n if (n := known(w, -1)) >= 0 else len(known_) + places.setdefault(w, len(places)) for w in words_of(text.as_py())], np.int64)
                paths.append(_squeezed(path))
                lengths.append(len(path))
                # The first entry stands for the text itself; a word has no space, so it meets none.
                entries.append([{"word": b" %d" % key, "k": -1}, *({"word": w, "k": k} for w, k in places.items())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lengths, pa.int32()), pa.array(paths, pa.binary()), pa.array(entries, entry)],
                                             ["doc_id", "sign", "words", "path", "entries"])

    def rows_of(rows: pa.Table) -> Iterator[tuple]:
        head = shared.value
        sign, k, ids, counts = (rows[c].to_numpy() for c in ("sign", "k", "id", "count"))
        doc, words, path = (rows[c].combine_chunks() for c in ("doc_id", "words", "path"))
        starts = _group_starts(sign)
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(sign)]):
            copies = int(np.searchsorted(k[start:end], 0))
            number = _unsqueezed(path[start].as_py(), words[start].as_py())
            rare = number >= len(head)
            id_of, count_of = np.zeros(end - start, np.int64), np.zeros(end - start)
            at = k[start + copies:end]
            id_of[at], count_of[at] = ids[start + copies:end], counts[start + copies:end]
            count = np.empty(len(number))
            count[~rare], count[rare] = head[number[~rare]], count_of[number[rare] - len(head)]
            number[rare] = id_of[number[rare] - len(head)]
            yield (doc[start].as_py(), copies, len(number) + 1, int((count > 0).sum()) + (ends > 0),
                   float(np.log10(count + 1).sum()) - len(number) * space + end_score, float(np.log10(count + DELTA).sum()),
                   _squeezed(number + SUFFIXES))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_ = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())

        def packed(rows: pa.Table) -> pa.RecordBatch:
            columns = list(zip(*rows_of(rows))) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_)],
                                              ["doc_id", "copies", "n_tokens", "n_known", "base", "logs", "ids"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]) if held is not None else rows
            last = int(_group_starts(held["sign"].to_numpy())[-1])
            if last:
                yield packed(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield packed(held)

    first = F.col("entry.k") < 0
    rows = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("sign"), "text").mapInArrow(
        read, "doc_id long, sign long, words int, path binary, entries array<struct<word:binary,k:int>>") \
        .select("doc_id", "sign", "words", "path", F.explode("entries").alias("entry")) \
        .select("sign", "entry.*", *(F.when(first, F.col(c)).alias(c) for c in ("doc_id", "words", "path")))
    suffix = F.crc32(F.expr("substring(word, -3, 3)")) % SUFFIXES
    return cut(rows.join(numbered.rest, "word", "left")
               .select("sign", "k", F.coalesce("id", -1 - suffix).alias("id"), F.coalesce("count", F.lit(0)).alias("count"), "doc_id", "words", "path")
               .repartition("sign").sortWithinPartitions("sign", "k")
               .mapInArrow(put_together, "doc_id long, copies int, n_tokens long, n_known long, base double, logs double, ids binary"))


def _group_starts(sign: np.ndarray) -> np.ndarray:
    """Where the rows of a text start; they lie one after the other."""
    return np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))


def _numbers(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Numbers of the words of each row (ids, n_tokens)."""
    return [_unsqueezed(i.as_py(), n - 1) - SUFFIXES for i, n in zip(batch.column(0), batch.column(1).to_pylist())]


def _class_pairs(sequences: DataFrame, own: Broadcast, classes: int) -> np.ndarray:
    """How often a class (or unit) follows another; every task sends at most one row per pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, of = classes + 1, np.zeros((classes + 1) ** 2, np.int64), own.value[0]
        for batch in batches:
            if batch.num_rows:
                end = [np.array([len(of) - 1])]
                flat = of[np.concatenate(end + [x for ids in _numbers(batch) for x in (ids, end[0])])].astype(np.int64)
                total += np.bincount(flat[:-1] * n + flat[1:], minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "count"])

    rows = sequences.mapInArrow(run, "pair long, count long").groupBy("pair").agg(F.sum("count").alias("count")).toArrow()
    pairs = np.zeros((classes + 1) ** 2)
    pairs[rows["pair"].to_numpy()] = rows["count"].to_numpy()
    return pairs.reshape(classes + 1, classes + 1)


OCCURRENCES = "part int, words int, entries int, ids binary, counts binary, before binary, after binary"


def _occurrences(sequences: DataFrame, least: int, total: int, tokens: int) -> DataFrame:
    """Blocks of words, from number ``least`` on: their numbers and counts, and the words before and after all occurrences of each.

    Every occurrence travels once, packed, dealt by its word. The words below ``least``, which are frequent, are not dealt."""
    tasks = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(tasks, -(-tokens // PART))
    names = [f.split()[0] for f in OCCURRENCES.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, held, size = np.array([total]), [], 0

        def packed() -> pa.RecordBatch:
            flat = np.concatenate([end, *held])
            at = np.flatnonzero((flat >= least) & (flat < total))
            part = flat[at] % parts
            order = np.argsort(part, kind="stable")
            at, part = at[order], part[order]
            found, starts = np.unique(part, return_index=True)
            sizes = np.diff(np.append(starts, len(part)))
            pieces = [[_squeezed(c[a:a + n]) for a, n in zip(starts.tolist(), sizes.tolist())] for c in (flat[at + move] for move in (0, -1, 1))]
            none = pa.nulls(len(found), pa.int32())
            ids, before, after = (pa.array(p, pa.binary()) for p in pieces)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), none, pa.array(sizes, pa.int32()), ids, pa.nulls(len(found), pa.binary()), before, after], names)

        for batch in batches:
            for ids in _numbers(batch):
                held += [ids, end]
                size += len(ids)
                if size > PACKED:
                    yield packed()
                    size = 0
        if held:
            yield packed()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [(np.empty(0, np.int64),) * 3]
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("entries", "ids", "before", "after"))):
                pieces.append(tuple(_unsqueezed(c.as_py(), row[0].as_py()) for c in row[1:]))
        ids, before, after = (np.concatenate(c) for c in zip(*pieces))
        pieces.clear()
        order = np.argsort(ids, kind="stable")
        before, after = before[order], after[order]
        words, counts = np.unique(ids, return_counts=True)
        ends = np.concatenate([[0], np.cumsum(counts)])
        for at in range(0, len(words), BLOCK):
            own, some = words[at:at + BLOCK], counts[at:at + BLOCK]
            near = slice(ends[at], ends[at + len(own)])
            columns = [pa.array([_squeezed(c)], pa.binary()) for c in (own, some, before[near], after[near])]
            numbers = [pa.array([n], pa.int32()) for n in (0, len(own), int(some.sum()))]
            yield pa.RecordBatch.from_arrays([*numbers, *columns], names)

    return cut(sequences.mapInArrow(deal, OCCURRENCES).repartitionById(parts, F.col("part")).mapInArrow(gather, OCCURRENCES))


def _moved(occurrences: DataFrame, state: Broadcast, turn: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Numbers and new classes of the words whose turn it is and that gain by another class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, flags, table = state.value
        own = own.astype(np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = (_unsqueezed(row[c], row["words"]) for c in ("ids", "counts"))
                mine = flags[words] >> 7 == turn
                here = np.repeat(mine, counts)
                before, after = (_unsqueezed(row[c], row["entries"])[here] for c in ("before", "after"))
                words, counts = words[mine], counts[mine]
                if not len(words):
                    continue
                new = best_classes(own, table, words, counts, before, after)
                moved = new != own[words]
                yield pa.RecordBatch.from_arrays([pa.array([_squeezed(words[moved])], pa.binary()), pa.array([new[moved].astype(np.uint16).tobytes()], pa.binary())],
                                                 ["ids", "classes"])

    found = ((ids, np.frombuffer(new, np.uint16)) for ids, new in occurrences.mapInArrow(run, "ids binary, classes binary").collect())
    return [(_unsqueezed(ids, len(new)), new) for ids, new in found]


def exchange_all(sequences: DataFrame, own: np.ndarray, flags: np.ndarray, table: np.ndarray, least: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all words and their class bigrams, after every word from number ``least`` on could move by its own occurrences.

    In a round every second word, by its hash, goes to the class that it gains most by, by the class bigrams of the round before;
    these are then counted anew over all texts. A round that makes the class bigrams no likelier is taken back and is the last."""
    context = sequences.sparkSession.sparkContext
    if len(flags) <= least:
        return own, table
    occurrences = _occurrences(sequences, least, len(flags), tokens)
    for turn in range(ROUNDS):
        state = context.broadcast((own, flags, table))
        new = own.copy()
        for ids, classes in _moved(occurrences, state, turn % 2):
            new[ids] = classes
        state.unpersist()
        shared = context.broadcast((new,))
        counted = _class_pairs(sequences, shared, len(table) - 1)
        shared.unpersist()
        if _likelihood(counted) <= _likelihood(table):
            break
        own, table = new, counted
    return own, table


class Model(NamedTuple):
    own: np.ndarray  # class of a word by number, then that of the end
    unknown: np.ndarray  # class by suffix of a word that no training text has
    steps: np.ndarray  # log10 P(class | class before)
    sizes: np.ndarray  # by class: log10 of words with repeats + DELTA x (distinct words + 1)


def score_texts(docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """Score every whole text with a class-based bigram model that is learned from the corpus itself.

    Learned from all documents but those of one fold (crc32 of the id as text, modulo ``folds``). Words and their counts
    are a distributed table. Classes, whose number grows with that of the distinct words, come from exchange clustering of the
    bigrams of all training text: the UNITS most frequent words are exchanged one after the other, with the others in groups of
    equal endings; then every other word, however rare, is exchanged by its own occurrences, in rounds over the cluster. P(word | before) =
    P(class | class before) x P(word | class), both with DELTA added to counts. A word that no training text has goes with
    the class that most words of its ending have. Counts of at most HEAD short frequent words are broadcast; the other words of each
    text, one row per text and word, are joined with the table, and texts put together again as numbers.

    One row out for each row in: doc_id, held_out, n_tokens (words and one end), n_known, train_tokens, base_score
    (add-one unigram), score (log10 probability by the model), perplexity (of the model, by token).

    A null text counts as empty and has the end alone; a null doc_id counts as empty text in the fold. Rows that repeat an
    id and its text all stay. Without training text every word is unknown; an empty table gives no rows; other columns
    are not read.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs)
    training = texts.filter(fold(F.col("doc_id"), folds) != held_out)
    counts = cut(count_words(training))
    ends = training.count()
    words, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = words + ends, distinct + (ends > 0)
    head = _frequent(counts, HEAD)
    # Plain values, so that a worker can read them without this package.
    vocabulary = spark.sparkContext.broadcast(tuple(Vocabulary.of([w for w, _ in head])))
    units = Vocabulary(*vocabulary.value)
    numbered = Numbered.of(counts, head)
    release_shuffles(spark)
    sequences = _sequences(texts, numbered, vocabulary, np.array([c for _, c in head], float), tokens, kinds, ends)
    learned = sequences.filter(fold(F.col("doc_id"), folds) != held_out) \
        .select("ids", "n_tokens", F.explode(F.sequence(F.lit(1), "copies"))).select("ids", "n_tokens")

    classes = number_of_classes(kinds)
    unit = np.concatenate([np.arange(units.own), units.own + (numbered.flags[units.own:] & 127).astype(int), [units.end]]).astype(np.uint16)
    pairs = _class_pairs(learned, spark.sparkContext.broadcast((unit,)), units.end)
    release_shuffles(spark)
    unit_classes = exchange(pairs, classes)
    member = np.eye(classes + 1)[unit_classes]
    own = unit_classes[unit].astype(np.uint16)
    own, table = exchange_all(learned, own, numbered.flags, member.T @ pairs @ member, units.own, tokens)
    shared = spark.sparkContext.broadcast(tuple(_model(numbered, head, own, table, unit_classes[units.own:units.end])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        end = np.array([len(model.steps) - 1])
        for batch in batches:
            scores = []
            for ids, logs in zip(_numbers(batch), batch.column(2).to_pylist()):
                path = np.where(ids >= 0, model.own[np.maximum(ids, 0)], model.unknown[np.maximum(-1 - ids, 0)])
                whole = np.concatenate([end, path, end])
                scores.append(float(model.steps[whole[:-1], whole[1:]].sum()) + logs - float(model.sizes[path].sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "copies", "n_tokens", "n_known", "base")), pa.array(scores, pa.float64())],
                                             ["doc_id", "copies", "n_tokens", "n_known", "base_score", "score"])

    scored = sequences.select("ids", "n_tokens", "logs", "doc_id", "copies", "n_known", "base").mapInArrow(
        run, "doc_id long, copies int, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def _model(numbered: Numbered, head: list[tuple[bytes, int]], own: np.ndarray, table: np.ndarray, by_suffix: np.ndarray) -> Model:
    """Sums over all words by class, and words by suffix and class."""
    classes = len(table) - 1
    single = (table.sum(axis=0) + DELTA) / (table.sum() + DELTA * (classes + 1))
    steps = np.log10((table + classes * DELTA * single) / (table.sum(axis=1, keepdims=True) + classes * DELTA))
    shared = numbered.rest.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = shared.value, np.zeros(classes + 1, np.int64)
        for batch in batches:
            np.add.at(total, of[batch.column(0).to_numpy()], batch.column(1).to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["class", "total"])

    words = own[:-1].astype(np.int64)
    sums = np.bincount(words[:len(head)], [c for _, c in head], classes + 1) if head else np.zeros(classes + 1)
    for c, total in numbered.rest.select("id", "count").mapInArrow(run, "class long, total long").groupBy("class").agg(F.sum("total")).collect():
        sums[c] += total
    sizes = np.log10(sums + DELTA * (np.bincount(words, minlength=classes + 1) + 1))
    suffix = (numbered.flags & 127).astype(np.int64)
    often = np.bincount(suffix * (classes + 1) + words, minlength=SUFFIXES * (classes + 1)).reshape(SUFFIXES, -1)
    return Model(own.astype(np.int64), np.where(often.any(axis=1), often.argmax(axis=1), by_suffix), steps, sizes)
