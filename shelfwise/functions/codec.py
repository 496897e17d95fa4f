"""Binary export formats of factor vectors and similarity lists.

A vector is its values as big-endian float32, a similarity list is
(int32 id, float32 score) pairs, both big-endian; the bytes are base64 text.
Spark has no cast from float to binary, so the bytes are laid out by Arrow UDFs
that convert a whole batch with one numpy call; base64 itself is built in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRS = T.ArrayType(T.StructType([
    T.StructField("similarId", T.IntegerType()), T.StructField("score", T.FloatType())]))


def _binary_rows(lists: pa.ListArray, payload: np.ndarray, width: int) -> pa.Array:
    """Cut ``payload`` into one binary value per list, ``width`` bytes per element."""
    offsets = np.asarray(lists.offsets)
    rows = pa.Array.from_buffers(
        pa.large_binary(), len(lists),
        [None, pa.py_buffer(((offsets - offsets[0]).astype(np.int64) * width).tobytes()),
         pa.py_buffer(payload.tobytes())],
    )
    if lists.null_count:
        rows = pc.if_else(lists.is_valid(), rows, pa.scalar(None, pa.large_binary()))
    return rows.cast(pa.binary())


def _elements(lists: pa.ListArray) -> pa.Array:
    offsets = lists.offsets
    start, end = offsets[0].as_py(), offsets[-1].as_py()
    return lists.values.slice(start, end - start)


@F.arrow_udf(T.BinaryType())
def _vector_bytes(vectors: pa.Array) -> pa.Array:
    values = _elements(vectors).to_numpy(zero_copy_only=False).astype(">f4")
    return _binary_rows(vectors, values, 4)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _bytes_vector(data: pa.Array) -> pa.Array:
    return _list_rows(data, 4, lambda raw: pa.array(raw.view(">f4").astype(np.float32)))


@F.arrow_udf(T.BinaryType())
def _pair_bytes(pairs: pa.Array) -> pa.Array:
    flat = _elements(pairs)
    out = np.empty((len(flat), 2), dtype=">u4")
    out[:, 0] = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int32).view(np.uint32)
    out[:, 1] = flat.field(1).to_numpy(zero_copy_only=False).astype(np.float32).view(np.uint32)
    return _binary_rows(pairs, out, 8)


@F.arrow_udf(PAIRS)
def _bytes_pairs(data: pa.Array) -> pa.Array:
    def build(raw: np.ndarray) -> pa.Array:
        words = raw.view(">u4").astype(np.uint32).reshape(-1, 2)
        return pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(words[:, 0]).view(np.int32)),
             pa.array(np.ascontiguousarray(words[:, 1]).view(np.float32))],
            names=["similarId", "score"],
        )

    return _list_rows(data, 8, build)


def _list_rows(data: pa.Array, width: int, build) -> pa.Array:
    """One list per binary value, built from the bytes of the whole batch at once."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(data), 0), dtype=np.int64)
    raw = _bytes_of(data)
    offsets = np.concatenate([[0], np.cumsum(sizes // width)]).astype(np.int32)
    mask = pc.is_null(data) if data.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets), build(raw), mask=mask)


def _bytes_of(data: pa.Array) -> np.ndarray:
    """The bytes of all values in a row, out of the buffer they are in; a null value has none."""
    data = pc.fill_null(data, b"").cast(pa.large_binary())
    _, offsets, values = data.buffers()
    if values is None:
        return np.empty(0, dtype=np.uint8)
    bounds = np.frombuffer(offsets, dtype=np.int64)[data.offset:data.offset + len(data) + 1]
    return np.frombuffer(values, dtype=np.uint8)[bounds[0]:bounds[-1]] if len(data) else np.empty(0, dtype=np.uint8)


def _one_line_base64(data: Column) -> Column:
    """Base64 without line breaks, whatever the session does with long values."""
    return F.translate(F.base64(data), "\r\n", "")


def encode_vector(c: Column | str) -> Column:
    """Array of numbers to base64 of big-endian float32 values."""
    return _one_line_base64(_vector_bytes(c))


def decode_vector(c: Column | str) -> Column:
    """Inverse of :func:`encode_vector`."""
    return _bytes_vector(F.unbase64(c))


def encode_pairs(scores: DataFrame) -> DataFrame:
    """(id, similarId, score) rows to one (id, base64) row per id, best score first.

    One output value holds the whole list of an id, so the input should be a
    top-k result; the lists are then at most k pairs long.
    """
    pair = F.struct((-F.col("score")).alias("rank"), F.col("similarId").cast("int").alias("similarId"))
    ordered = F.sort_array(F.collect_list(pair))
    pairs = F.transform(ordered, lambda p: F.struct(
        p["similarId"].alias("similarId"), (-p["rank"]).cast("float").alias("score")))
    return scores.groupBy("id").agg(pairs.alias("pairs")).select(
        "id", _one_line_base64(_pair_bytes("pairs")).alias("data"))


def decode_pairs(encoded: DataFrame) -> DataFrame:
    """(id, base64) rows to (id, similarId, score) rows."""
    return encoded.select("id", _bytes_pairs(F.unbase64("data")).alias("pairs")).select("id", F.inline("pairs"))
