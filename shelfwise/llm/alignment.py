"""Alignment of two tokenizers: where their tokens of a text end together, and how often ids of them meet there."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.bpe import byte_characters
from shelfwise.llm.common import id_and_text
from shelfwise.session import stored

#: Where texts are cut: at a space between ASCII characters or Latin letters, which are no white space in any version of Unicode.
CUT = re.compile(r"(?<=[!-~\u00c0-\u024f]) (?=[!-~\u00c0-\u024f])")
#: Chunks that a worker remembers, characters of the longest one, and characters of texts that are aligned together and
#: chunks that are learned together.
MEMORY, LONGEST_KEPT, TOGETHER, LEARNED = 400_000, 40, 1_000_000, 10_000
#: Pairs with more than one in so many of all occurrences are broadcast; that are fewer pairs than this.
HOT_PAIRS = 65_536
MEASURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def load_files(path_a: str, path_b: str) -> dict:
    """The contents of both tokenizer files; each worker makes its Aligner of them once."""
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return {"a": a.read(), "b": b.read()}


class Chunk(NamedTuple):
    """A part of a text that both tokenizers read on its own: numbers of tokens and groups, the groups as text, A ids of links
    that are one token each with equal bytes, and pairs of all other links, both as bytes of int64."""

    n_a: int
    n_b: int
    n_groups: int
    text: str
    same: bytes
    pairs: bytes


class Aligner:
    """Tokenizers A (byte-level BPE, JSON) and B (pieces with byte fallback) and what of their vocabularies is needed.

    ``same[a]`` is the B id with the bytes of A id a, or -1; of several the piece that is not a single fallback byte.

    A text is cut before single spaces between plain characters. A ends a token there, as its split pattern takes such a space
    along with what follows, and B does, as long as no piece has a space after anything else. So the cut parts can be
    aligned one by one, and a worker remembers the short ones.
    """

    def __init__(self, files: dict) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(files["a"]), SentencePieceProcessor(model_proto=files["b"])
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte = {c: bytes([k]) for k, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = b"".join([byte.get(c) or c.encode() for c in token])
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        fallback = [i for i in range(size) if self.b.is_byte(i)]
        self.bytes_b = [p.replace("▁", " ").encode() for p in pieces]
        for i in fallback:
            self.bytes_b[i] = bytes([int(pieces[i][3:-1], 16)])
        if not all(self.bytes_a[i] for i in vocabulary.values()) or not all(self.bytes_b):
            raise ValueError("a token without bytes ends nowhere of its own")
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces with a space after other characters: texts can't be cut at spaces")
        text_of = {self.bytes_b[i]: i for i in [*fallback, *sorted(set(range(size)) - set(fallback), reverse=True)]}
        self.same = np.array([text_of.get(t, -1) for t in self.bytes_a], np.int64)
        self.len_a, self.len_b = (np.array([len(t) for t in of], np.int64) for of in (self.bytes_a, self.bytes_b))
        self.written = [f"{i}{mark}" for i in range(max(len(self.bytes_a), size)) for mark in ",|;\n"]
        self.known: dict[str, Chunk | None] = {}

    def learn(self, chunks: list[str]) -> dict[str, Chunk | None]:
        """Chunks aligned, all at a time; None where the bytes of the tokens of A or B are not a space and the chunk."""
        whole = [b" " + c.encode() for c in chunks]
        of_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        of_b = self.b.encode(chunks, num_threads=1)
        out: dict[str, Chunk | None] = {}
        if not all(b"".join([of[i] for i in chain.from_iterable(ids)]) == b"".join(whole) for of, ids in ((self.bytes_a, of_a), (self.bytes_b, of_b))):
            good = [all(b"".join([of[i] for i in ids]) == text for of, ids in ((self.bytes_a, a), (self.bytes_b, b)))
                    for a, b, text in zip(of_a, of_b, whole)]
            out = {c: None for c, g in zip(chunks, good) if not g}
            chunks, whole, of_a, of_b = ([x for x, g in zip(of, good) if g] for of in (chunks, whole, of_a, of_b))
        if not chunks:
            return out
        # Laid end to end, the chunks are one text that both have tokens of.
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (of_a, of_b))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[at] == ends_a)
        last_b = at[last_a]
        before_a, before_b = np.concatenate(([-1], last_a[:-1])), np.concatenate(([-1], last_b[:-1]))
        size_a, size_b = last_a - before_a, last_b - before_b
        group_end = np.searchsorted(ends_a[last_a], np.cumsum([len(w) for w in whole])) + 1  # groups up to the end of each chunk
        # Every id is written with the mark that follows it: a comma, a bar, a semicolon, or at the end of a chunk a new line.
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        mark_b[last_b[group_end - 1]] = 3
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(before_b + 1, size_a)] = 4 * a + mark_a
        order[np.arange(len(b)) + np.repeat(last_a + 1, size_b)] = 4 * b + mark_b
        texts = "".join(map(self.written.__getitem__, order.tolist())).split("\n")
        x, y = a[last_a], b[last_b]
        is_plain = (size_a == 1) & (size_b == 1) & (self.same[x] == y)
        pairs = x * len(self.bytes_b) + y
        plain, other = x[is_plain].tobytes(), pairs[~is_plain].tobytes()
        plain_end = np.cumsum(is_plain)[group_end - 1]
        done, done_plain = 0, 0
        for k, (chunk, end, end_plain) in enumerate(zip(chunks, group_end.tolist(), plain_end.tolist())):
            out[chunk] = Chunk(len(of_a[k]), len(of_b[k]), end - done, texts[k], plain[8 * done_plain:8 * end_plain],
                               other[8 * (done - done_plain):8 * (end - end_plain)])
            done, done_plain = end, end_plain
        return out

    def align(self, texts: list[str]) -> list[list[Chunk] | None]:
        """The chunks of each text; None for a text that is empty or that a tokenizer alters."""
        cut = [CUT.split(t) for t in texts]
        different = set(chain.from_iterable(cut))
        if len(self.known) + len(different) > MEMORY:
            self.known.clear()
        new = [c for c in different if c not in self.known]
        for at in range(0, len(new), LEARNED):
            self.known.update(self.learn(new[at:at + LEARNED]))
        get, out = self.known.__getitem__, []
        for text, chunks in zip(texts, cut):
            aligned = list(map(get, chunks)) if text else [None]
            out.append(None if None in aligned else aligned)
        for c in new:
            if len(c) > LONGEST_KEPT:
                del self.known[c]
        return out


def _aligner(files: dict) -> Aligner:
    if "made" not in files:
        files["made"] = Aligner(files)
    return files["made"]


def _lists(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else [], kind))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each list of a list column whose flattened values are given."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One pass over the texts: for each row its measures, and its links with how often it has them.

    Rows of the result: uid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256; the links of groups that are one A token
    and its same-bytes B token as ``same`` (A ids) and ``same_n``; all others as ``pairs`` (A id x size of B + B id) and
    ``pair_n``. Each task adds one row without uid whose same and same_n are the counts of the whole task, added up in a
    vector as long as A's vocabulary.
    """
    files = docs.sparkSession.sparkContext.broadcast(load_files(path_a, path_b))
    schema = f"uid long, {MEASURES}, same array<long>, same_n array<long>, pairs array<long>, pair_n array<long>"
    names = ["uid", *(f.split()[0] for f in MEASURES.split(", ")), "same", "same_n", "pairs", "pair_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _aligner(files.value)
        counted, nothing = np.zeros(len(tools.bytes_a), np.int64), np.zeros(0, np.int64)

        def one(chunks: list[Chunk] | None) -> tuple:
            if chunks is None:
                return 0, 0, 0, "", nothing, nothing, nothing, nothing
            n_a, n_b, n_groups, text, plain, other = zip(*chunks)
            same, same_n = np.unique(np.frombuffer(b"".join(plain), np.int64), return_counts=True)
            counted[same] += same_n
            pairs, pair_n = np.unique(np.frombuffer(b"".join(other), np.int64), return_counts=True)
            return sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(";".join(text).encode()).hexdigest(), same, same_n, pairs, pair_n

        def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            start = size = 0
            for at, length in enumerate(pc.utf8_length(batch.column("text")).to_pylist()):
                if size and size + length > TOGETHER:
                    yield batch.slice(start, at - start)
                    start, size = at, 0
                size += length
            yield batch.slice(start)

        for batch in (block for batch in batches if batch.num_rows for block in blocks(batch)):
            n_a, n_b, n_groups, digest, *lists = zip(*map(one, tools.align(batch.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([
                batch.column("uid"), batch.column("doc_id"), *(pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups, n_groups)),
                pa.array(digest, pa.string()), *(_lists(list(column)) for column in lists)], names)
        used = np.flatnonzero(counted)
        if len(used):
            empty = [pa.nulls(1, pa.int64())] * 6 + [pa.nulls(1, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*empty, _lists([used]), _lists([counted[used]]), _lists([nothing]), _lists([nothing])], names)

    numbered = id_and_text(docs).withColumn("uid", F.monotonically_increasing_id())
    return numbered.mapInArrow(run, schema)


def cross_tokenizer_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Align the tokens of two tokenizers in every whole text and weigh each link by its id pair's count in the corpus.

    Text goes to A with a space before it, to B as it is (B adds that space). Offsets at which tokens of both end cut a text
    into groups; the last tokens of a group are linked. Groups that are one token each, with equal bytes, are counted in a
    vector as long as A's vocabulary through the array that leads from an A id to its B id. Only the pairs of all other groups
    are shuffled: pre-aggregated to counts, and, to bring a count back to the texts, one row per text and pair. Pairs that have
    over 1 / HOT_PAIRS of all occurrences, of which there are fewer than HOT_PAIRS, come back by broadcast instead, so no key of
    that join is large. The driver gets vectors of vocabulary length and those pairs.

    One row out for each row in: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their B id,
    ties included), count_sum, groups_sha256. Texts that are null, empty, or that a tokenizer alters (the bytes of its tokens are
    not those of the text) have zeros and an empty digest. A null doc_id and repeated rows stay and count each; other
    columns are not read; an empty table gives no rows. A very long text is aligned whole, in memory in proportion to it. The
    texts are read once; what is needed of them afterwards is a table in the shared checkpoint folder.
    """
    spark = docs.sparkSession
    tools = Aligner(load_files(path_a, path_b))
    span = len(tools.bytes_b)
    found = stored(align_documents(docs, path_a, path_b), "alignment")
    rows = found.filter("uid IS NOT NULL")

    def each(of: DataFrame, ids: str, times: str, *keep: str) -> DataFrame:
        return of.select(*keep, F.inline(F.arrays_zip(F.col(ids).alias("id"), F.col(times).alias("n"))))

    counts_a = np.zeros(len(tools.bytes_a), np.int64)
    for i, n in each(found.filter("uid IS NULL"), "same", "same_n").groupBy("id").agg(F.sum("n")).collect():
        counts_a[i] = n  # at most one row per A id
    pairs = each(rows, "pairs", "pair_n", "uid")
    counts = stored(pairs.groupBy("id").agg(F.sum("n").alias("count")), "pair-counts")
    best = np.zeros(span, np.int64)
    mapped = tools.same >= 0
    np.maximum.at(best, tools.same[mapped], counts_a[mapped])
    for i, n in counts.groupBy((F.col("id") % span).alias("b")).agg(F.max("count")).collect():
        best[i] = max(best[i], n)  # at most one row per B id
    limit = (counts.agg(F.sum("count")).first()[0] or 0) // HOT_PAIRS
    hot_pairs = sorted(map(tuple, counts.filter(F.col("count") > limit).collect()))  # fewer than HOT_PAIRS rows
    hot_ids, hot_counts = (np.array([p[k] for p in hot_pairs], np.int64) for k in (0, 1))
    best_of_a = np.where(mapped, best[tools.same], 0)
    known = spark.sparkContext.broadcast((counts_a, counts_a == best_of_a, hot_ids, hot_counts, hot_counts == best[hot_ids % span]))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_a, of_a_best, ids, of_pair, of_pair_best = known.value
        for batch in batches:
            lists = [batch.column(k) for k in ("same", "same_n", "pairs", "pair_n")]
            same, same_n, pair, pair_n = (column.flatten().to_numpy(zero_copy_only=False) for column in lists)
            at = np.minimum(np.searchsorted(ids, pair), max(0, len(ids) - 1))
            is_hot = ids[at] == pair if len(ids) else np.zeros(len(pair), bool)
            weight, is_best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            weight[is_hot], is_best[is_hot] = of_pair[at[is_hot]], of_pair_best[at[is_hot]]
            own, other = (column.offsets.to_numpy() for column in (lists[0], lists[2]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(_sums(of_a_best[same] * same_n, own) + _sums(is_best * pair_n, other)),
                 pa.array(_sums(of_a[same] * same_n, own) + _sums(weight * pair_n, other))], names)

    schema = f"uid long, {MEASURES}, near_best long, near_sum long"
    names = [f.split()[0] for f in schema.split(", ")]
    weighed = rows.mapInArrow(weigh, schema)
    # The rarer pairs: no id of them has more than one in HOT_PAIRS of the rows.
    highest = spark.createDataFrame([(i, n) for i, n in enumerate(best.tolist()) if n], "b long, highest long")
    rarer = counts.filter(F.col("count") <= limit)
    known_ids = spark.createDataFrame([(int(i),) for i in hot_ids], "id long")
    rest = (
        pairs.join(F.broadcast(known_ids), "id", "left_anti").join(rarer, "id")
        .join(F.broadcast(highest), F.col("id") % span == F.col("b"))
        .groupBy("uid").agg(F.sum(F.when(F.col("count") == F.col("highest"), F.col("n"))).alias("far_best"),
                            F.sum(F.col("n") * F.col("count")).alias("far_sum"))
    )
    return weighed.join(rest, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("near_best") + F.coalesce("far_best", F.lit(0))).alias("n_best"),
        (F.col("near_sum") + F.coalesce("far_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
