"""N-gram Jaccard join: a blocked product of the document by n-gram incidence matrix with itself."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import cut, from_bytes, id_and_text, low_bytes, sized, without
from shelfwise.llm.components import components
from shelfwise.llm.language_model import words_of

#: Word hashes that a task remembers at most; a full memory starts anew.
MEMORY = 300_000
#: A block of a family has about so many documents and shingles at most.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 400_000
#: Sets of a task that are held at a time.
EMITTED = 1_000
#: Columns of the incidence matrix that are multiplied at a time.
SLAB = 4096
#: Buckets that signatures are counted in by their first bits, of one byte each, and how many of them a task sends at a time.
BUCKETS, PIECE = 1 << 25, 1 << 16
BUCKET_SHIFT = np.uint64(64 - 25)
#: Signatures that a task packs at a time, and characters of text, about, for each part that they are dealt to.
PACKED, PART_CHARS = 1 << 18, 8_000_000
#: Low bits of a signature that travel; the part that it is dealt to stands for the bits above them.
SIGN_BITS = 40
#: Parts that near copies of 80 percent are cut into beyond what is needed, for each needed one.
EXTRA_PARTS = 0.5
U = np.uint64


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x + U((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingles:
    """Sets of word n-grams as sorted 64-bit hashes. Fewer words than n make one shingle, none make an empty set."""

    def __init__(self, n: int) -> None:
        self.n, self.known = n, {}

    def _new(self, word: bytes) -> int:
        if len(self.known) >= MEMORY:
            self.known.clear()
        value = self.known[word] = xxhash.xxh64_intdigest(word)
        return value

    def sequence(self, text: str) -> np.ndarray:
        """Hash of the n-gram that starts at each word."""
        words, get, new = words_of(text), self.known.get, self._new
        own = np.array([get(w) or new(w) for w in words], U)
        n = min(self.n, len(own))
        if not n:
            return own
        # A sum with odd factors, so that the order counts, and one finalizer.
        total = own[:len(own) - n + 1].copy()
        for k in range(1, n):
            total += own[k:len(own) - n + 1 + k] * U(pow(0x9E3779B97F4A7C15, k, 2**64))
        return _mixed(total, n)

    def __call__(self, text: str) -> np.ndarray:
        return np.unique(self.sequence(text))


class Cuts:
    """Classes of set sizes, and for each into how many parts its sets are cut and how many of them may be empty.

    Sets x and y with 100 |x & y| >= percent |x | y| are in one class or in neighbouring ones, and differ in at most
    k = (100 - percent)(|x| + |y|) / (100 + percent) shingles; k is taken for the largest pair of a class and the next. Cut
    into k + 1 + e parts by hash range, they agree in e + 1 parts or more. e is a little more than the number of parts
    that a set of the class leaves empty by chance, and ``extra`` parts for each of the k + 1 besides.
    """

    def __init__(self, percent: int, extra: float = 0.0) -> None:
        self.percent, self.extra, self.ends, self.plans = percent, extra, [], []

    def _extend(self) -> None:
        percent, least = self.percent, self.ends[-1] + 1 if self.ends else 1
        end = least * 100 // percent
        k = (100 - percent) * (end + end * 100 // percent) // (100 + percent)
        more = int(np.ceil(self.extra * (k + 1))) + 2 * (self.extra > 0)
        spare = more
        for _ in range(3):
            empty = (k + 1 + spare) * (1 - 1 / (k + 1 + spare)) ** least
            spare = more + (int(np.ceil(empty + 3 * empty**0.5)) if empty >= 0.5 else 0)
        self.ends.append(end)
        self.plans.append((k + 1 + spare, spare))

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """Number, parts and spare of the class of a size and of the one before."""
        while not self.ends or self.ends[-1] < size:
            self._extend()
        at = bisect_left(self.ends, size)
        return [(k, *self.plans[k]) for k in range(max(0, at - 1), at + 1)]


def signatures(own: np.ndarray, cuts: Cuts, frequent: np.ndarray | None = None) -> list[np.ndarray]:
    """Hashes of which any two sets that qualify share one: those of the parts of a set, cut for its class and for the
    class before, by the parity of the class: documents can only be linked through the same cut.

    With at most e empty parts in one of two sets, a part in which they agree is not empty, so empty parts need no
    hash. A set with more of them tells each apart by the parts of another cut. Given how frequent signatures are, by their
    first bits, a set with fewer empty parts leaves out as many others, the most frequent ones: of the parts in which two sets
    agree, the rarest has at least as many behind it as either may leave out.
    """
    both = parted(own, cuts)
    if frequent is None:
        return [signs for signs, _ in both]
    return [signs[np.lexsort((signs, frequent[signs >> BUCKET_SHIFT]))[:len(signs) - left]] for signs, left in both]


def parted(own: np.ndarray, cuts: Cuts) -> list[tuple[np.ndarray, int]]:
    """All signatures of a set, by the parity of the class that it is cut for, and how many of them can be left out."""
    out = [(np.empty(0, U), 0)] * 2
    for k, parts, spare in cuts.of(len(own)):
        out[k % 2] = _parts(own, parts, spare, U(k + 1), 0)
    return out


def _parts(own: np.ndarray, parts: int, spare: int, label: np.uint64, depth: int) -> tuple[np.ndarray, int]:
    """Signatures, and how many of them can be left out."""
    turned = np.sort(_mixed(own, depth + 1))
    edges = np.searchsorted(turned, np.arange(1, parts, dtype=U) * U((2**64 - 1) // parts))
    edges = np.concatenate([[0], edges, [len(own)]])
    sums = np.concatenate([np.zeros(1, U), np.cumsum(_mixed(turned, 9))])
    label = _mixed(np.array([label]), 6 + depth)
    signs = _mixed(_mixed(sums[edges[1:]] - sums[edges[:-1]], 5) ^ (np.arange(parts, dtype=U) * U(0x9E3779B97F4A7C15) + label))
    empty = edges[1:] == edges[:-1]
    if empty.sum() <= spare:
        return signs[~empty], spare - int(empty.sum())
    if depth == 3:
        return signs, 0
    return np.concatenate([signs[~empty], *(_parts(own, parts, spare, s, depth + 1)[0] for s in signs[empty])]), 0


SIGNED = "doc_id long, n_shingles long, h1 long, h2 long, even array<long>, odd array<long>"


def _signed(texts: DataFrame, words: int, percent: int, extra: float = 0.0, frequent: Broadcast | None = None) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, and its signatures; texts are read once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, cuts = Shingles(words), Cuts(percent, extra)
        often = np.frombuffer(frequent.value, np.uint8) if frequent else None
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            both = [pa.array(np.array([_mixed(s, seed).sum(dtype=U) for s in sets], U).view(np.int64)) for seed in (1, 2)]
            signed = [signatures(s, cuts, often) if len(s) else [np.empty(0, U)] * 2 for s in sets]
            lists = []
            for parity in (0, 1):
                signs = [s[parity].view(np.int64) for s in signed]
                bounds = pa.array(np.cumsum([0, *map(len, signs)]), pa.int32())
                lists.append(pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.empty(0, np.int64), *signs]), pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *both, *lists],
                                             ["doc_id", "n_shingles", "h1", "h2", "even", "odd"])

    return texts.mapInArrow(run, SIGNED)


#: A document, or (with entries) signatures of many: their nodes above the least one, and how many documents have each.
DEALT = "part int, doc_id long, n_shingles long, h1 long, h2 long, even int, odd int, entries int, least long, nodes binary, signs binary, times binary"


def _dealt(part: np.ndarray, nodes: np.ndarray, signs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """One row for each part with its entries."""
    order = np.argsort(part, kind="stable")
    names, starts = np.unique(part[order], return_index=True)
    counts = np.diff(np.append(starts, len(part)))
    least = nodes.min()
    packed = [low_bytes(c[order]) for c in (nodes - least, signs, times)]
    pieces = [[c[a:a + n].tobytes() for a, n in zip(starts.tolist(), counts.tolist())] for c in packed]
    none = pa.nulls(len(names), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int32()), none, none, none, none, none.cast(pa.int32()), none.cast(pa.int32()), pa.array(counts, pa.int32()),
         pa.array(np.full(len(names), least.view(np.int64))), *(pa.array(p, pa.binary()) for p in pieces)], [f.split()[0] for f in DEALT.split(", ")])


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """part, nodes, signs and times of the rows that hold signatures."""
    rows = batch.filter(batch.column("entries").is_valid())
    columns = (rows.column(c) for c in ("part", "entries", "least", "nodes", "signs", "times"))
    for part, count, least, nodes, *others in zip(*columns):
        n = count.as_py()
        signs, times = (from_bytes(x.as_py(), n) for x in others)
        yield part.as_py(), from_bytes(nodes.as_py(), n) + np.int64(least.as_py()).view(U), signs, times


def _share(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash, by the bits above SIGN_BITS."""
    return ((hashes >> U(SIGN_BITS)) * U(parts) >> U(64 - SIGN_BITS)).astype(np.int32)


def _rarest(texts: DataFrame, words: int, percent: int, extra: float) -> DataFrame:
    """:func:`_signed`, with those signatures alone that several documents have, after every set has left out its most frequent ones.

    All signatures are dealt by their value and counted, to the last one, so that what a line or a passage brings about is told
    from what a near copy does at any size. Those of one document link nothing and go no further. The others are dealt by document,
    where as many as a set can do without are left out, the most frequent first. What is dealt are packed numbers:
    a signature takes about eight bytes.
    """
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(1 << 16, max(tasks, -(-chars // PART_CHARS)))
    names = [f.split()[0] for f in DEALT.split(", ")]

    def home(nodes: np.ndarray) -> np.ndarray:
        return _share(_mixed(nodes >> U(1), 4), parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, cuts = Shingles(words), Cuts(percent, extra)
        signs, nodes, size = [], [], 0

        def packed() -> pa.RecordBatch:
            all_signs, ends = np.concatenate(signs), np.array([len(s) for s in signs])
            out = _dealt(_share(all_signs, parts), np.repeat(np.array(nodes, U), ends), all_signs & U(2**SIGN_BITS - 1), np.ones(len(all_signs), U))
            signs.clear()
            nodes.clear()
            return out

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own, left = shingles(text.as_py()), [0, 0]
                if len(own) and doc_id is not None:
                    for parity, (some, more) in enumerate(parted(own, cuts)):
                        left[parity] = more
                        if len(some):
                            signs.append(some)
                            nodes.append((doc_id << 1 | parity) % 2**64)
                            size += len(some)
                rows.append((doc_id, len(own), *(_mixed(own, seed).sum(dtype=U) for seed in (1, 2)), *left))
                if size > PACKED:
                    yield packed()
                    size = 0
            if rows:
                ids, sizes, h1, h2, even, odd = zip(*rows)
                spread = np.array([(i << 1) % 2**64 if i is not None else int(h) for i, h in zip(ids, h1)], U)
                hashes = [pa.array(np.array(h, U).view(np.int64)) for h in (h1, h2)]
                none = pa.nulls(len(rows), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home(spread)), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *hashes, pa.array(even, pa.int32()),
                     pa.array(odd, pa.int32()), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64()), none, none, none], names)
        if signs:
            yield packed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, nodes = [np.empty(0, U)], [np.empty(0, U)]
        for batch in batches:
            yield batch.filter(batch.column("entries").is_null())
            for part, own_nodes, own_signs, _ in _entries(batch):
                signs.append(own_signs | U(part) << U(SIGN_BITS))
                nodes.append(own_nodes)
        all_signs, all_nodes = np.concatenate(signs), np.concatenate(nodes)
        signs.clear()
        nodes.clear()
        order = np.argsort(all_signs)
        all_signs, all_nodes = all_signs[order], all_nodes[order]
        starts = np.flatnonzero(np.concatenate([np.full(min(1, len(all_signs)), True), all_signs[1:] != all_signs[:-1]]))
        times = np.diff(np.append(starts, len(all_signs)))
        times = np.repeat(times, times).astype(U)
        several = np.flatnonzero(times > 1)
        for at in range(0, len(several), PACKED):
            some = several[at:at + PACKED]
            yield _dealt(home(all_nodes[some]), all_nodes[some], all_signs[some], times[some])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, entries = [], [(np.empty(0, U),) * 3]
        for batch in batches:
            docs.append(batch.filter(batch.column("entries").is_null()).select(names[1:7]))
            entries += [e[1:] for e in _entries(batch)]
        if not docs:
            return
        rows = pa.Table.from_batches(docs)
        unknown, rows = rows.filter(rows["doc_id"].is_null()), rows.filter(rows["doc_id"].is_valid())
        nodes, signs, times = (np.concatenate(c) for c in zip(*entries))
        own = rows["doc_id"].to_numpy().astype(np.int64).view(U) << U(1)
        order = np.argsort(own, kind="stable")
        rows, own = rows.take(pa.array(order)), own[order]
        first = np.concatenate([np.full(min(1, len(own)), True), own[1:] != own[:-1]])
        starts = np.flatnonzero(first)
        by = np.lexsort((signs, times, nodes))
        nodes, signs = nodes[by], signs[by]
        lists = []
        for parity, name in enumerate(("even", "odd")):
            here = nodes & U(1) == U(parity)
            its_nodes, its_signs = nodes[here], signs[here]
            # Rows of one id are one node: it leaves out as many as the row that can spare least.
            left = np.minimum.reduceat(rows[name].to_numpy(), starts) if len(starts) else np.empty(0, np.int64)
            low, high = (np.searchsorted(its_nodes, own[starts] | U(parity), side) for side in ("left", "right"))
            kept = np.maximum(0, high - low - left)
            picked = np.repeat(low - (np.cumsum(kept) - kept), kept) + np.arange(kept.sum())
            lengths = np.zeros(len(own), np.int64)
            lengths[starts] = kept
            bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            lists.append(pa.ListArray.from_arrays(bounds, pa.array(its_signs[picked].view(np.int64))))
        some = [rows[c].combine_chunks() for c in names[1:5]]
        out = [f.split()[0] for f in SIGNED.split(", ")]
        if len(own):
            yield pa.RecordBatch.from_arrays([*some, *lists], out)
        if len(unknown):
            empty = pa.array([[]] * len(unknown), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(unknown[c].combine_chunks() for c in names[1:5]), empty, empty], out)

    counted = texts.mapInArrow(deal, DEALT).repartitionById(parts, F.col("part")).mapInArrow(count, DEALT)
    return counted.repartitionById(parts, F.col("part")).mapInArrow(gather, SIGNED)


def _node(doc_id: Column, parity: int) -> Column:
    """A document in the cut of even or odd number. Ids that differ in their first bit alone may meet: then more is compared."""
    return F.shiftleft(doc_id, 1).bitwiseOR(F.lit(parity))


def added(rows: Iterable[tuple[int, bytes]]) -> dict[int, np.ndarray]:
    """Sums, up to 255, of the compressed pieces of each number. One task may get all pieces: they stay one byte a bucket."""
    sums: dict[int, np.ndarray] = {}
    for piece, times in rows:
        more = np.frombuffer(zlib.decompress(times), np.uint8)
        sums[piece] = np.minimum(255, more + sums[piece].astype(np.uint16)).astype(np.uint8) if piece in sums else more
    return sums


def _frequent(texts: DataFrame, words: int, percent: int, extra: float) -> Broadcast:
    """How many documents have a signature, by its first bits, up to 255: one byte for each of BUCKETS buckets, of all documents.

    This only orders the parts of a set: whatever is in here, no link is lost. The better it is, the fewer documents are compared
    that share nothing but a line or a passage. Tasks send pieces of their table, which are added up piece by piece. The table is of
    fixed size, so :func:`jaccard_components` counts by :func:`_rarest` instead.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, cuts, total = Shingles(words), Cuts(percent, extra), np.zeros(BUCKETS, np.uint8)
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(0)]
            signs = [np.empty(0, U), *(signs for s in sets if len(s) for signs in signatures(s, cuts))]
            bucket, times = np.unique(np.concatenate(signs) >> BUCKET_SHIFT, return_counts=True)
            total[bucket] = np.minimum(255, total[bucket] + times)
        pieces = total.reshape(-1, PIECE)
        used = np.flatnonzero(pieces.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([zlib.compress(pieces[k].tobytes(), 1) for k in used], pa.binary())],
                                         ["piece", "times"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = added((piece, times.as_py()) for batch in batches for piece, times in zip(batch.column(0).to_pylist(), batch.column(1)))
        data = [zlib.compress(s.tobytes(), 1) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(data, pa.binary())], ["piece", "times"])

    schema = "piece long, times binary"
    table = np.zeros((BUCKETS // PIECE, PIECE), np.uint8)
    found = texts.select("text").mapInArrow(count, schema).repartition("piece").mapInArrow(add, schema)
    for piece, times in found.collect():  # BUCKETS bytes at most
        table[piece] = np.frombuffer(zlib.decompress(times), np.uint8)
    return texts.sparkSession.sparkContext.broadcast(table.tobytes())


def _candidate_links(signed: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all documents, each in either of its two cuts, which share a signature.

    Signatures are sorted over the cluster by signature and id; neighbours with an equal one are linked where they
    lie. A signature of many documents may run over several tasks: first and last rows of all tasks link these.
    """
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = first = last = None  # signature of the run, its first document; last row
        start = True
        for batch in batches:
            if not batch.num_rows:
                continue
            s, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate([[sign is None or s[0] != sign], s[1:] != s[:-1]])
            head = np.maximum.accumulate(np.where(new, np.arange(len(s)), -1))
            pivot = np.where(head >= 0, d[head], first if first is not None else 0)
            inner = pivot != d
            pairs = np.unique(np.stack([d[inner], pivot[inner]], axis=1), axis=0) if inner.any() else np.empty((0, 2), np.int64)
            ends_ = [(s[0], d[0])] * start
            a = np.concatenate([pairs[:, 0], [x[1] for x in ends_]]).astype(np.int64)
            b = np.concatenate([pairs[:, 1], [x[1] for x in ends_]]).astype(np.int64)
            at = pa.array([None] * len(pairs) + [int(x[0]) for x in ends_], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), at], ["a", "b", "sign"])
            sign, first, last, start = s[-1], pivot[-1], d[-1], False
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([last], pa.int64()), pa.array([int(sign)], pa.int64())],
                                             ["a", "b", "sign"])

    signs = signed.select(F.explode("even").alias("sign"), _node(F.col("doc_id"), 0).alias("doc_id")).unionAll(
        signed.select(F.explode("odd").alias("sign"), _node(F.col("doc_id"), 1).alias("doc_id")))
    linked = cut(signs.repartitionByRange("sign", "doc_id").sortWithinPartitions("sign", "doc_id")
                 .mapInArrow(link, "a long, b long, sign long").distinct())
    across = linked.filter("sign IS NOT NULL").select("sign", "a").distinct()
    least = across.groupBy("sign").agg(F.min("a").alias("b"))
    return linked.filter("sign IS NULL").select("a", "b").unionAll(across.join(least, "sign").select("a", "b"))


def _spanning(rows: np.ndarray, columns: np.ndarray, count: int) -> list[tuple[int, int]]:
    """Of the links (rows, columns) as many as connect what they connect."""
    parent = list(range(count))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i, j in zip(rows.tolist(), columns.tolist()):
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def links_of(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i in left, j in right, i before j) that qualify: overlaps are added up over slabs of columns.

    Columns that one row alone has add nothing and are left out; pairs whose sizes allow no link are discarded."""
    sizes = np.array([len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    row = np.repeat(np.arange(len(sets)), sizes)[shared[column]]
    column = (np.cumsum(shared) - 1)[column[shared[column]]]
    overlap = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(shared.sum()), SLAB):
        here = (column >= start) & (column < start + SLAB)
        slab = np.zeros((len(sets), min(SLAB, int(shared.sum()) - start)), np.float32)
        slab[row[here], column[here] - start] = 1
        overlap += slab[left] @ slab[right].T
    x, y = sizes[left][:, None], sizes[right][None, :]
    fits = (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & ((100 + percent) * overlap.astype(np.int64) >= percent * (x + y))
    at = np.nonzero(fits & (left[:, None] < right[None, :]))
    return left[at[0]], right[at[1]]


def _verified_links(texts: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between documents of one family that connect all that qualify.

    members: doc_id, family, n_shingles, h1, h2, one row per distinct set and family. A family's rows are dealt into blocks of
    bounded size, and every pair of blocks is a cell, multiplied by one task.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in (b.slice(at, EMITTED) for b in batches for at in range(0, b.num_rows, EMITTED)):
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            same = np.array([len(s) for s in sets]) == batch.column(4).to_numpy()
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["doc_id", "family", "blocks", "set"])
            yield out.filter(pa.array(same))

    def multiply(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        sets = [np.frombuffer(rows["set"][int(i)].as_py(), U) for i in order]
        block = rows["block"].to_numpy()[order]
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        first = np.concatenate([links_of(sets, left, right, percent), links_of(sets, right, left, percent)], axis=1) \
            if key[1] != key[2] else np.stack(links_of(sets, left, right, percent))
        kept = _spanning(first[0], first[1], len(sets))
        own = ids[order]
        return pa.table({"a": pa.array([own[i] for i, _ in kept], pa.int64()), "b": pa.array([own[j] for _, j in kept], pa.int64())})

    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("all"))
    blocks = sizes.filter("rows > 1").select("family", F.greatest(
        F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    wanted = cut(members.join(blocks, "family").select(F.col("doc_id").alias("id"), "family", "blocks", "n_shingles"))
    rows = texts.join(sized(wanted), F.col("doc_id") == F.col("id")).select("doc_id", "text", "family", "blocks", "n_shingles") \
        .mapInArrow(emit, "doc_id long, family long, blocks int, set binary") \
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return cells.groupBy("family", "i", "j").applyInArrow(multiply, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90, extra: float = 0.0) -> DataFrame:
    """Group documents whose sets of word n-grams link: 100 |x & y| >= percent |x | y|, A-Z in lower case.

    Documents that share a size-derived signature make a family, within which alone links can be. The incidence
    matrix of a family's distinct sets is multiplied with itself block by block; overlap counts are added up, and
    pairs below the bound that their sizes set are discarded. Sets are 64-bit hashes of n-grams. Equal sets are one row
    of the matrix, and of the links of a cell only as many are passed on as connect the same rows, so dense groups
    stay linear in size; no link between different texts is lost. With ``extra`` parts for each part that is needed,
    a set goes without as many signatures, those that most documents have: parts that hold nothing but a common line.

    One row out for each row in: doc_id, n_shingles, component_id (smallest doc_id that links lead to, or its own).

    Null and empty texts have no shingles and are linked with nothing; a text of fewer words is one n-gram. A row
    without doc_id takes no part in links and has no component. Rows of one doc_id count as linked with each other's
    links. An empty table gives no rows; other columns are not read.
    """
    texts = id_and_text(docs)
    keys = cut(_rarest(texts, words, percent, extra) if extra else _signed(texts, words, percent))
    known = texts.filter(F.col("doc_id").isNotNull())
    full = keys.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    families = components(_candidate_links(full))
    cuts = full.select("h1", "h2", "n_shingles", "doc_id", F.explode(F.array(*(_node(F.col("doc_id"), k) for k in (0, 1)))).alias("node"))
    members = cuts.join(families, "node").groupBy("h1", "h2", "n_shingles", F.col("component").alias("family")).agg(F.min("doc_id").alias("doc_id"))
    linked = components(_verified_links(known, members, words, percent))
    classes = full.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("least")) \
        .join(linked, F.col("least") == F.col("node"), "left") \
        .select("h1", "h2", "n_shingles", F.coalesce("component", "least").alias("class_id"))
    joined = keys.join(classes, ["h1", "h2", "n_shingles"], "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows whose doc_id is the smallest of its component, with all columns; rows without doc_id stay."""
    return without(docs, jaccard_components(docs, words, percent, EXTRA_PARTS).filter("component_id < doc_id"))
