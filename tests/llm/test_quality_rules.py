"""Repetition rules against plain counting."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from shelfwise.llm import quality_rules as q

SPACE = " \t\n\x0b\x0c\r"


def plain_words(text):
    out = "".join("\n" if c in SPACE else c for c in text).split("\n")
    return [w for w in out if w]


def plain(text):
    words = plain_words(text)
    m = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
         "n_dup_lines": 0, "dup_line_chars": 0}
    lines = text.split("\n")
    for k, line in enumerate(lines):
        if plain_words(line) and line in lines[:k]:
            m["n_dup_lines"] += 1
            m["dup_line_chars"] += sum(map(len, plain_words(line)))
    for n in (3, *range(5, 11)):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        times = Counter(grams)
        inside = set()
        for i, g in enumerate(grams):
            if times[g] > 1 and (n == 3 or g in grams[:i]):
                inside |= set(range(i, i + n))
        if n == 3:
            m["n_repeat_words"] = len(inside)
        else:
            m[f"dup_chars_{n}"] = sum(len(words[i]) for i in inside)
    return m


def check(texts):
    got = q.measure([t.encode() for t in texts])
    assert set(got) == set(q.MEASURES)
    for k, text in enumerate(texts):
        assert {name: int(values[k]) for name, values in got.items()} == plain(text), text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab é\n\t\x0b\x1c\x85#$", max_size=80), max_size=4))
def test_measures(texts):
    check(texts)


def test_measures_of_repeating_texts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 120))) for _ in range(30)]
    check(texts + ["\n".join(rng.choices(["one line", " one line", "", " ", "x y z w v u t s r q p"], k=12)) for _ in range(30)])


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    """With multiplier 0 a window hashes to its last word; the next multiplier must then serve."""
    texts = ["a b c d e f g h i j k", "z b c y e x g h i w k a b"]
    monkeypatch.setattr(q, "BASES", [0, *q.BASES])
    check(texts + [" ".join(random.Random(1).choices("abcd", k=60))])
    monkeypatch.setattr(q, "BASES", [0])
    with pytest.raises(ArithmeticError):
        q.measure([" ".join(random.Random(1).choices("abcd", k=60)).encode()])


def test_verdict():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    clean = " ".join(rng.sample(words, 300))
    some = " ".join(rng.sample(words, 200))
    texts = {"clean": clean, "short": "a b c", "same": "a b c " * 100, "copied": some + "\n" + " ".join(some.split()[:60]),
             "lines": "\n".join([" ".join(rng.sample(words, 4)) for _ in range(40)] + ["one two three four"] * 15)}
    m = q.measure([t.encode() for t in texts.values()])
    failed, kept = (dict(zip(texts, values.tolist())) for values in q.judge(m))
    assert kept == {"clean": True, "short": False, "same": False, "copied": False, "lines": False}
    assert failed == {"clean": False, "short": True, "same": True, "copied": False, "lines": False}


def test_limits_themselves_pass():
    m = {k: np.array([0]) for k in q.MEASURES} | {"n_words": np.array([100]), "word_chars": np.array([1000])}
    assert q.judge(m | {"n_repeat_words": np.array([50])})[1].all() and not q.judge(m | {"n_repeat_words": np.array([51])})[1].any()
    for name, percent in [("dup_line_chars", 20)] + [(f"dup_chars_{n}", 20 - n) for n in range(5, 11)]:
        assert q.judge(m | {name: np.array([10 * percent])})[1].all()
        assert not q.judge(m | {name: np.array([10 * percent + 1])})[1].any()


def test_query(spark, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_WORDS", 20)
    texts = [None, "", "   ", "a b", "a b c d " * 40, "a b c d " * 40, " ".join(f"w{i}" for i in range(60)), "é\n" * 30]
    rows = [(i, t, "x", 1, True) for i, t in enumerate(texts)] + [(None, "no id", "x", 1, True), (None, None, None, None, None), (3, "a b", "x", 1, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word_chars string, n_words int, kept boolean")
    found = [r.asDict() for r in q.quality_rules(docs).collect()]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in rows)
    for r in found:
        candidates = [plain(t or "") for i, t, *_ in rows if i == r["doc_id"]]
        assert {k: r[k] for k in q.MEASURES} in candidates
        assert r["kept"] == (r["doc_id"] == 6)
    assert q.quality_rules(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    rng = random.Random(9)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(100_000)) + "\n"
    docs = spark.createDataFrame([(1, text), (2, text + text[:len(text) // 2])], "doc_id long, text string")
    one, two = sorted(q.quality_rules(docs).collect())
    assert (one.n_words, one.kept, two.n_words > 149_000, two.kept, two.dup_chars_10 > 200_000) == (100_000, True, True, False, True)
