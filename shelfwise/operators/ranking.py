"""Top-k items by dot product, exact and approximate.

Both sides are cut into cells of bounded size. A cell holds some query vectors
and some candidate vectors; its task multiplies the two matrices block by block
and keeps only the best k candidates of each query, so no pair of rows is ever
written out unless it is among the best of its cell. The lists of the cells
are then merged. Cell sizes follow from row counts, never from the number of
rows a key happens to have.

Within a cell the candidates come in order of falling norm. A query stops as
soon as the product of its norm and the next candidate norm cannot reach its
k-th best score any more (Cauchy-Schwarz), which is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CELL_BYTES = 64 << 20
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8_192
PAIR_BLOCK = 4_096
GROUP_ROWS = 16_384
GROUPS_PER_TASK = 4

MIN_PAIRS = 1 << 22
TASK_PAIRS = 1 << 30
# Traffic that one merged row stands for, its sorting included.
RESULT_BYTES = 96
MAX_BROADCAST_CELLS = 500_000

# The index: most cells, vectors that their centres are made of, rounds of that, and queries that visits are measured with.
MAX_CELLS = 1_024
SAMPLE_VECTORS = 32_768
CENTRE_ROUNDS = 8
SAMPLE_QUERIES = 256

SCORES = "id bigint, similarId bigint, score double"


def _best_first() -> list[Column]:
    return [F.desc("score"), F.asc("similarId")]


def _typed_vector() -> list[Column]:
    return [F.col("id").cast("bigint").alias("id"), F.col("factors").cast("array<float>").alias("factors")]


class Sizes(NamedTuple):
    """Number of query vectors, of candidate vectors, and of dimensions."""

    queries: int
    candidates: int
    rank: int


def similar_items(factors: DataFrame, candidates: DataFrame, k: int = 100,
                  sizes: Sizes | None = None) -> DataFrame:
    """The k best candidates of every item, without the item itself and without scores of 0 or less.

    Both are removed after the best k are chosen, so lists can be shorter than k.
    Equal scores are ordered by candidate id. Input columns: id, factors.
    """
    best = top_items(factors, candidates, k, sizes)
    return best.filter((F.col("id") != F.col("similarId")) & (F.col("score") > 0))


def top_items(queries: DataFrame, candidates: DataFrame, k: int = 20,
              sizes: Sizes | None = None) -> DataFrame:
    """The k candidates with the highest dot product for every query: (id, similarId, score).

    Ids are unique on each side. ``sizes`` may be near guesses; they decide how
    the work is cut and are counted when not given.
    """
    cores = queries.sparkSession.sparkContext.defaultParallelism
    rows, columns = _grid_shape(sizes or _sizes(queries, candidates), k, cores)
    grid = [F.lit(rows).alias("q"), F.lit(columns).alias("c")]
    one_cell = [F.lit(0).alias("cell"), *_typed_vector(), *grid]
    scored = _score_cells(queries.select(*one_cell), candidates.select(*one_cell), k, Layout(0, rows * columns))
    return scored if columns == 1 else top_k(scored, ["id"], _best_first(), k)


def _sizes(queries: DataFrame, candidates: DataFrame) -> Sizes:
    """Row counts of both sides and the length of their vectors, in one job."""
    count = lambda df, side: df.agg(
        F.count("*").alias("n"), F.max(F.size("factors")).alias("rank")).withColumn("side", F.lit(side))
    sides = {r.side: r for r in count(queries, "q").union(count(candidates, "c")).collect()}
    return Sizes(sides["q"].n, sides["c"].n, max(sides["q"].rank or 1, sides["c"].rank or 1))


def _cell_side(rank: int) -> int:
    """Most vectors that one side of a cell holds."""
    return max(1, CELL_BYTES // (4 * rank))


def _grid_shape(sizes: Sizes, k: int, cores: int) -> tuple[int, int]:
    """Rows and columns of the grid: cells bounded in bytes, pairs and results, work for every core, little traffic.

    Every column repeats the queries, and more than one column means merging
    their lists; every row repeats the candidates.
    """
    nq, nc, rank = sizes
    side = _cell_side(rank)
    rows = max(math.ceil(nq / side), math.ceil(nq * k * RESULT_BYTES / CELL_BYTES)) or 1
    columns = math.ceil(nc / side) or 1
    cells = max(rows * columns, min(2 * cores, nq * nc // MIN_PAIRS), math.ceil(nq * nc / TASK_PAIRS))

    def shape(c: int) -> tuple[int, int]:
        return max(rows, math.ceil(cells / c)), c

    def traffic(grid: tuple[int, int]) -> int:
        merged = nq * grid[1] * k * RESULT_BYTES if grid[1] > 1 else 0
        return 4 * rank * (nq * grid[1] + nc * grid[0]) + merged

    doublings = range(max(1, (cells // columns).bit_length()))
    return min((shape(columns << i) for i in doublings), key=traffic)


def approx_top_items(queries: DataFrame, candidates: DataFrame, k: int = 20, recall: float = 0.95, leaf_size: int = 200,
                     exact_above: float = 0.5, seed: int = 17) -> DataFrame:
    """:func:`top_items` that finds at least about ``recall`` of the best k, by an index; scores are exact.

    Every candidate belongs to the one cell whose centre has the smallest angle to it, and every query visits the cells whose
    centres are nearest to it, so a pair meets at most once and a candidate's vector travels once. For that, dot products become
    angles: candidates get one more dimension that brings all of them to the norm of the longest one, queries a 0.

    Centres come from SAMPLE_VECTORS candidates. How many cells are visited is measured, not guessed: for
    SAMPLE_QUERIES queries the true best k among all candidates are found, and the number is the smallest that reaches ``recall`` on
    them. Vectors without any structure need most cells; if the visited ones hold more than ``exact_above`` of all candidates the
    index saves nothing and the search is exact.
    """
    n, longest = _count_and_norm(candidates)
    if not n:
        return top_items(queries, candidates, k)
    sample = _sample(candidates, SAMPLE_VECTORS)
    centres = _centres(_augmented(sample[1], longest), min(MAX_CELLS, math.ceil(n / leaf_size)), seed)
    own_cell = _cell_assigner(centres, 1, longest)
    probes, share = _measured_probes(queries, candidates, own_cell, centres, k, recall)
    if share > exact_above:
        return top_items(queries, candidates, k)
    placed = lambda df, assign: df.select(*_typed_vector()).mapInArrow(assign, "cell bigint, id bigint, factors binary")
    visiting, held = placed(queries, _cell_assigner(centres, probes, None)), placed(candidates, own_cell)
    add_grid, layout = _plan_grid(visiting.select("cell"), held.select("cell"), _cell_side(centres.shape[1]))
    return top_k(_score_cells(add_grid(visiting), add_grid(held), k, layout), ["id"], _best_first(), k)


def _count_and_norm(vectors: DataFrame) -> tuple[int, float]:
    """Number of vectors and the norm of the longest one."""
    square = F.aggregate("factors", F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double"))
    row = vectors.agg(F.count("*"), F.max(square)).first()
    return row[0], math.sqrt(row[1] or 0.0)


def _sample(vectors: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``size`` rows, the same ones each time."""
    rows = vectors.select(*_typed_vector()).orderBy(F.xxhash64("id"), "id").limit(size).collect()
    return np.array([r.id for r in rows], np.int64), np.array([r.factors for r in rows], np.float32)


def _augmented(matrix: np.ndarray, longest: float | None) -> np.ndarray:
    """Vectors with the dimension that brings them to the norm ``longest``; with 0 there if that is None."""
    rest = np.zeros(len(matrix)) if longest is None else np.sqrt(np.maximum(0.0, longest ** 2 - _norms(matrix) ** 2))
    return np.hstack([matrix, rest[:, None]]).astype(np.float32)


def _centres(sample: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """Unit vectors in the middle of the cells: some rounds of k-means by angle over a sample."""
    rng = np.random.default_rng(seed)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    sample = unit(sample)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(CENTRE_ROUNDS):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres, dtype=np.float64)
        np.add.at(sums, nearest, sample)
        used = np.bincount(nearest, minlength=len(centres)) > 0
        centres = np.where(used[:, None], unit(sums), centres).astype(np.float32)
    return centres


def _measured_probes(queries: DataFrame, candidates: DataFrame, own_cell: Callable, centres: np.ndarray, k: int,
                     recall: float) -> tuple[int, float]:
    """How many cells a query has to visit to find ``recall`` of its best k, and the share of all candidates in these."""
    ids, vectors = _sample(queries, SAMPLE_QUERIES)
    if not len(ids):
        return 1, 0.0
    cells = candidates.select(*_typed_vector()).mapInArrow(own_cell, "cell bigint, id bigint, factors binary").select("cell", F.col("id").alias("similarId"))
    few = queries.sparkSession.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "id bigint, factors array<float>")
    found = top_items(few, candidates, k).join(cells, "similarId").select("id", "cell").collect()  # SAMPLE_QUERIES x k rows
    order = np.argsort(-(_augmented(vectors, None) @ centres.T), axis=1)
    place = np.argsort(order, axis=1)
    row = {int(i): at for at, i in enumerate(ids)}
    needed = np.sort([place[row[r.id], r.cell] for r in found])
    probes = int(needed[math.ceil(recall * len(needed)) - 1]) + 1
    sizes = np.zeros(len(centres))
    for cell, size in cells.groupBy("cell").count().collect():  # at most MAX_CELLS rows
        sizes[cell] = size
    return probes, float(sizes[order[:, :probes]].sum(axis=1).mean() / sizes.sum())


def _cell_assigner(centres: np.ndarray, probes: int, longest: float | None):
    """Batches of vectors to one row for each of the ``probes`` cells nearest to them, with the vector as bytes, which travel
    faster than arrays."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("factors"))
            near = _augmented(matrix, longest) @ centres.T
            nearest = np.argmax(near, axis=1)[:, None] if probes == 1 else np.argsort(-near, axis=1)[:, :probes]
            data = _vector_bytes(matrix)
            for cells in nearest.T.astype(np.int64):
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "id": batch.column("id"), "factors": data})

    return assign


def _vector_bytes(matrix: np.ndarray) -> pa.Array:
    """Rows of a float32 matrix as binary values."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1] * 4
    data = np.ascontiguousarray(matrix, dtype=np.float32)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class Layout(NamedTuple):
    """How cells go to tasks: 2**shift neighbouring cells share a group, over a number of tasks."""

    shift: int
    tasks: int


def _score_cells(queries: DataFrame, candidates: DataFrame, k: int, layout: Layout) -> DataFrame:
    """Best k candidates of each query within each cell of the grid.

    Rows carry their cell and its grid size (q rows, c columns). Queries are
    spread over the rows and repeated along the columns, candidates the other
    way round: every query meets every candidate of its cell exactly once.
    Small cells share a group, which its task takes apart again.
    """
    keys = ["task", "bucket", "row", "column"]
    index = "bucket + row * c + column"
    spread = lambda size: F.pmod(F.xxhash64("id"), F.col(size).cast("bigint"))
    repeat = lambda size: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(size).cast("bigint") - 1))

    def grouped(df: DataFrame, row: Column, column: Column):
        placed = df.select(
            F.shiftright(F.col("cell").cast("bigint"), layout.shift).alias("bucket"), row.alias("row"),
            column.alias("column"), "cell", "id", "factors", "c")
        task = F.pmod(F.expr(index), F.lit(layout.tasks)).cast("int")
        rows = placed.withColumn("task", task).drop("c")
        return rows.repartitionById(layout.tasks, F.col("task")).groupBy(*keys)

    left = grouped(queries, spread("q"), repeat("c"))
    right = grouped(candidates, repeat("q"), spread("c"))
    return left.cogroup(right).applyInArrow(_group_scorer(k), SCORES)


def _plan_grid(query_cells: DataFrame, candidate_cells: DataFrame,
               side: int) -> tuple[Callable[[DataFrame], DataFrame], Layout]:
    """A function that adds the grid size of each row's cell, and the layout of all cells.

    Only cells with more than ``side`` vectors need a grid; they are few, and
    are broadcast after their number is checked.
    """
    count = lambda df, name: df.groupBy("cell").agg(F.count("*").alias(name))
    parts = lambda n: F.ceil(F.col(n) / side).cast("bigint")
    sizes = count(query_cells, "nq").join(count(candidate_cells, "nc"), "cell").select(
        "cell", "nq", "nc", parts("nq").alias("q"), parts("nc").alias("c"))
    large = (F.col("q") > 1) | (F.col("c") > 1)
    total = sizes.agg(
        F.count_if(large).alias("large"), F.count("*").alias("cells"), F.sum(F.col("nq") + F.col("nc")).alias("rows"),
        F.sum(F.col("nq").cast("double") * F.col("nc")).alias("pairs")).first()
    rows, cores = total["rows"] or 0, query_cells.sparkSession.sparkContext.defaultParallelism
    mean = max(1, rows // max(1, total["cells"]))
    shift = max(0, int(math.log2(max(1, GROUP_ROWS // mean))))
    groups = math.ceil(rows / GROUP_ROWS)
    work = math.ceil((total["pairs"] or 0) / TASK_PAIRS)
    layout = Layout(shift, max(work, math.ceil(groups / GROUPS_PER_TASK), min(cores, groups), 1))
    grid = sizes.filter(large).select("cell", "q", "c")
    if 0 < total["large"] <= MAX_BROADCAST_CELLS:
        grid = F.broadcast(grid)

    def add(df: DataFrame) -> DataFrame:
        if not total["large"]:
            return df.select("*", F.lit(1).alias("q"), F.lit(1).alias("c"))
        return df.join(grid, "cell", "left").fillna(1, ["q", "c"])

    return add, layout


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows per key. Spark also applies the limit before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).drop("rank")


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Column of vectors, as lists or as bytes, to a float32 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if pa.types.is_binary(vectors.type):
        bounds = np.frombuffer(vectors.buffers()[1], dtype=np.int32)[vectors.offset:vectors.offset + len(vectors) + 1]
        flat = np.frombuffer(vectors.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]].view(np.float32)
    else:
        sizes = pc.unique(pc.list_value_length(vectors))
        if len(sizes) > 1 or sizes.null_count:
            raise ValueError(f"vectors of different lengths: {sizes.to_pylist()[:5]}")
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _group_scorer(k: int):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [_score_table(*(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.float64)))]
        if left.num_rows and right.num_rows:
            queries, items = _by_cell(left), _by_cell(right)
            for cell in queries.keys() & items.keys():
                parts.extend(_score_cell(*queries[cell], *items[cell], k))
        return pa.concat_tables(parts)

    return score


def _by_cell(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of each cell in a group."""
    cells, ids, vectors = rows.column("cell").to_numpy(), rows.column("id").to_numpy(), _matrix(rows.column("factors"))
    order = np.argsort(cells, kind="stable")
    names, starts = np.unique(cells[order], return_index=True)
    pieces = np.split(order, starts[1:])
    return {int(name): (ids[piece], vectors[piece]) for name, piece in zip(names, pieces)}


def _score_cell(query_ids: np.ndarray, queries: np.ndarray, item_ids: np.ndarray, items: np.ndarray, k: int) -> list[pa.Table]:
    norms = _norms(items)
    falling = np.lexsort((item_ids, -norms))
    item_ids, items, norms = item_ids[falling], items[falling], norms[falling]
    return [
        _score_table(*best_of_block(query_ids[i:i + QUERY_BLOCK], queries[i:i + QUERY_BLOCK], item_ids, items, norms, k))
        for i in range(0, len(query_ids), QUERY_BLOCK)
    ]


def _score_table(ids: np.ndarray, similar: np.ndarray, scores: np.ndarray) -> pa.Table:
    return pa.table({"id": pa.array(ids), "similarId": pa.array(similar), "score": pa.array(scores)})


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, item_ids: np.ndarray, items: np.ndarray,
                  norms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k items of some queries; ``items`` are in order of falling norm.

    Single-precision matrix products only select: whatever is within their
    rounding error of the k-th best is kept, and gets its score in double
    precision by adding up the dimensions in order. Scores do not depend on how
    the work was cut.
    """
    query_norms = _norms(queries)
    error = 4 * queries.shape[1] * np.finfo(np.float32).eps * query_norms
    floor = np.full(len(queries), -np.inf)
    rows, cols, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    for start in range(0, len(items), CANDIDATE_BLOCK):
        slack = error * norms[start]
        live = np.flatnonzero(query_norms * norms[start] + slack >= floor)
        if not len(live):
            break
        products = queries[live] @ items[start:start + CANDIDATE_BLOCK].T
        limit = floor[live]
        if start == 0 and products.shape[1] > k:
            # Two errors: the k-th product may be too high, the one compared too low.
            limit = np.partition(products, -k, axis=1)[:, -k] - slack[live]
        hit, col = np.nonzero(products >= (limit - slack[live]).astype(np.float32)[:, None])
        exact = _dot_in_order(queries, items, live[hit], col + start)
        rows, cols, scores = _keep_best(
            np.concatenate([rows, live[hit]]), np.concatenate([cols, col + start]),
            np.concatenate([scores, exact]), item_ids, k)
        counts = np.bincount(rows, minlength=len(queries))
        full = np.flatnonzero(counts >= k)
        floor[full] = scores[np.cumsum(counts)[full] - 1]
    return query_ids[rows], item_ids[cols], scores


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


def _dot_in_order(queries: np.ndarray, items: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Dot products of row pairs in double precision, dimensions added up in order."""
    total = np.zeros(len(rows))
    for i in range(0, len(rows), PAIR_BLOCK):
        part = slice(i, i + PAIR_BLOCK)
        products = queries[rows[part]].astype(np.float64) * items[cols[part]]
        for d in range(products.shape[1]):
            total[part] += products[:, d]
    return total


def _keep_best(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, item_ids: np.ndarray, k: int):
    """The k best entries per row, best first, equal scores by item id; rows come out in order."""
    order = np.lexsort((item_ids[cols], -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    first = np.searchsorted(rows, rows)
    kept = np.arange(len(rows)) - first < k
    return rows[kept], cols[kept], scores[kept]


def user_vectors(factors: DataFrame, ids: DataFrame) -> DataFrame:
    """Vectors of the requested ids and their sizes; unknown ids give no row."""
    found = factors.join(ids.select("id").distinct(), "id", "left_semi")
    return found.select("id", "factors", F.size("factors").alias("vectorSize"))


def user_top_brands(top: DataFrame, brands: DataFrame, k: int = 20) -> DataFrame:
    """Brands with the most products among each user's top items.

    ``top`` has (id, similarId), ``brands`` has (productId, brand); products
    without a brand are dropped. Equal counts are ordered by brand.
    """
    known = brands.select(F.col("productId").alias("similarId"), "brand").filter("brand is not null")
    branded = top.join(known, "similarId")
    counts = branded.groupBy("id", "brand").agg(F.count("*").alias("products"))
    return top_k(counts, ["id"], [F.desc("products"), F.asc("brand")], k)
