import base64
import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.functions import codec

FLOATS = st.floats(width=32, allow_nan=False, allow_infinity=False)


def test_vector_bytes(spark):
    df = spark.createDataFrame([(1, [1.5, -2.25, 0.1]), (2, []), (3, None), (4, [7.0])], "id int, v array<double>")
    out = {r.id: r.data for r in df.select("id", codec.encode_vector("v").alias("data")).collect()}
    assert base64.b64decode(out[1]) == struct.pack(">3f", 1.5, -2.25, 0.1)
    assert (out[2], out[3], base64.b64decode(out[4])) == ("", None, struct.pack(">f", 7.0))


def test_vector_size_matches_rank(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda x: x / 7).alias("v"))
    text = df.select(codec.encode_vector("v").alias("d")).first().d
    assert len(base64.b64decode(text, validate=True)) == 800


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(FLOATS, max_size=6), min_size=1, max_size=20))
def test_vector_round_trip(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "id int, v array<float>").repartition(3)
    back = df.select("id", codec.decode_vector(codec.encode_vector("v")).alias("v")).collect()
    assert {r.id: r.v for r in back} == {i: [float(np.float32(x)) for x in v] for i, v in enumerate(vectors)}


def test_pairs_layout_and_order(spark):
    scores = spark.createDataFrame([(9, 3, 0.5), (9, 1, 2.0), (9, 2, 0.5), (8, 4, 1.0)], "id int, similarId int, score double")
    encoded = codec.encode_pairs(scores)
    out = {r.id: base64.b64decode(r.data) for r in encoded.collect()}
    assert out == {9: struct.pack(">ififif", 1, 2.0, 2, 0.5, 3, 0.5), 8: struct.pack(">if", 4, 1.0)}
    back = {tuple(r) for r in codec.decode_pairs(encoded).collect()}
    assert back == {(9, 3, 0.5), (9, 1, 2.0), (9, 2, 0.5), (8, 4, 1.0)}


def test_negative_ids_and_scores(spark):
    scores = spark.createDataFrame([(1, -5, -0.25)], "id int, similarId int, score double")
    assert [tuple(r) for r in codec.decode_pairs(codec.encode_pairs(scores)).collect()] == [(1, -5, -0.25)]
