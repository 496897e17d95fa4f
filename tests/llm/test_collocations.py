"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from shelfwise.llm import collocations as c


def lower(text):
    return "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text)


def plain_counts(rows):
    """Occurrences of all phrases of one to five words, and of words, by language."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    return f, n


def plain(rows, min_count, top):
    f, n = plain_counts(rows)
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = {q[i:i + k] for q, a in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
                  if 100 * a >= 100 * counts[q[i:i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def texts_of(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "\x01", "\x01b", "a\x00", "\x00", "é", "ÉA", "\x1cq", "\xa0", "#", "a\x01\x02"]
    lines = ["an often repeated line of nine words there", "a, b; c. d", "x\ty\tz"]
    return [(rng.choice(["en", "de", None, "\x01", "e"]),
             rng.choice([" ", " ", " ", "\n"]).join(rng.choice(lines) if rng.random() < .1 else rng.choice(words) + rng.choice([" ", "  ", "\t", "", ", "])
                                          for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c\x01", "\x00"]), min_size=1, max_size=9), min_size=1, max_size=12), st.integers(1, 4),
       st.integers(1, 9))
def test_flow(pieces, min_count, run):
    """Whole rows and added parts give all counts, however the sorted edges are cut into runs."""
    edges = Counter(b"\0".join([b"en", *(c.escaped(w.encode()) for w in p[i:i + 5])]) for p in pieces for i in range(len(p)))
    ordered, found, parts = sorted(edges), {}, Counter()
    for at in range(0, len(ordered), run):
        keys = ordered[at:at + run]
        columns = [x.to_pylist() for x in c.flow(pa.array(keys, pa.binary()), np.array([edges[k] for k in keys]), min_count)]
        for key, low, high, count, whole in zip(*columns):
            words = key.split("\0")
            assert len(words) == high + 1 and 0 <= low <= high
            if whole:
                for k in range(low, high + 1):
                    assert tuple(words[:k + 1]) not in found
                    found[tuple(words[:k + 1])] = count
            else:
                parts[tuple(words)] += count
    assert not set(found) & set(parts)
    got = {k: n for k, n in (found | parts).items() if n >= min_count or len(k) == 1}
    f, n = plain_counts([("en", " ".join(p)) for p in pieces])
    key = lambda p: ("en", *(c.escaped(w.encode()).decode() for w in p))
    assert got == {key(p): a for p, a in f["en"].items() if a >= min_count} | {("en",): n["en"]}


@pytest.mark.parametrize("block, run, parts", [(10**6, 200_000, 1), (50, 7, 5), (300, 100, 16)])
def test_against_plain_counting(spark, monkeypatch, block, run, parts):
    """The same phrases whatever is counted together, and however ranges are cut."""
    monkeypatch.setattr(c, "BLOCK_WORDS", block)
    monkeypatch.setattr(c, "RUN_ROWS", run)
    monkeypatch.setattr(c, "BLOCK_BYTES", 40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rows = texts_of(150) + [(None, None), ("en", ""), ("zz", None), ("hot", "same again " * 400)]
    docs = spark.createDataFrame([(lang, t, 1, "k", None) for lang, t in rows], "lang string, text string, f int, key string, doc_id long").repartition(3)
    found = c.collocations(docs, min_count=3, top=60)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows, 3, 60)
    assert len(want) > 100
    rows = sorted(map(tuple, found.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows == sorted(want)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r.lang, r.text) for r in docs.select("lang", "text").collect()], 30, 200)
    assert sorted(map(tuple, c.collocations(docs, 30, 200).collect())) == sorted(want) and len(want) > 100


def test_repeated_rows_and_order_do_not_matter(spark):
    rows = texts_of(60, 2) * 2
    one = spark.createDataFrame(rows, "lang string, text string")
    two = spark.createDataFrame(rows[::-1], "lang string, text string").repartition(5)
    assert sorted(c.collocations(one, 6, 20).collect()) == sorted(c.collocations(two, 6, 20).collect()) != []


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of a corpus of 10^14 words, as a table of phrases."""
    f = {("a", "b"): 4 * 10**12, ("a",): 5 * 10**12, ("b",): 7 * 10**12 + 1, ("a", "b", "c"): 3 * 10**12, ("c",): 9 * 10**12, ("b", "c"): 3 * 10**12 + 5}
    phrases = spark.createDataFrame([("en", "\0".join(p), len(p), n) for p, n in f.items()], "lang string, phrase string, words int, f long")
    sizes = spark.createDataFrame([("en", 10**14 + 3)], "lang string, n long")
    monkeypatch.setattr(c, "phrase_counts", lambda docs, least: (phrases, sizes))
    n = 10**14 + 3
    got = {r.phrase: (r.score, r.l, r.r) for r in c.collocations(None).collect()}
    for p in (("a", "b"), ("b", "c"), ("a", "b", "c")):
        score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
        assert got[" ".join(p)] == (score, f[p[:k]], f[p[k:]])


def test_empty_tables(spark):
    docs = spark.createDataFrame([("en", ""), (None, None), ("de", " ,.\n")], "lang string, text string")
    assert c.collocations(docs).count() == 0 and c.collocations(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    docs = spark.createDataFrame([("en", "one two three four five six seven " * 40_000), ("en", "y" * 300_000 + " z")], "lang string, text string")
    rows = c.collocations(docs).collect()
    assert {r.phrase for r in rows} and all(r.n == 280_002 and len(r.phrase.split()) == 5 for r in rows) and len(rows) == 7
