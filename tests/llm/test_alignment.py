"""Cross-tokenizer alignment against a plain version of it."""

import functools
import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from shelfwise.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "Hello wörld, it's 2024.", "two  spaces\tand\nlines\r\n", "<|endoftext|><s></s><0x41> <unk>", "▁ a lower block",
       "你好 한국어 ａｂｃ 😀 é", "x" * 500, "the the the the", "\x00\x01 ​    ", "Ünïcödé   ñandú", "1234567890" * 9]


def byte_of_character():
    """As the byte-level scheme is published: printable Latin-1 stands for itself, the rest follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.cache
def plain_tools():
    a_tool, b_tool = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_tool.encode_special_tokens = True
    byte = byte_of_character()
    with open(PATHS[0], encoding="utf-8") as file:
        token = {i: bytes(byte[c] for c in t) for t, i in json.load(file)["model"]["vocab"].items() if t != "<|endoftext|>"}

    def piece(i):
        text = b_tool.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if b_tool.is_byte(i) else text.replace("▁", " ").encode()

    return a_tool, b_tool, token, piece


def plain(texts):
    """Rows of the operator, position by position in plain Python."""
    a_tool, b_tool, token, piece = plain_tools()
    out, links = [], []
    for text in texts:
        whole = " " + (text or "")
        a = a_tool.encode(whole, add_special_tokens=False).ids
        b = b_tool.encode(text or "")
        if not text or b"".join(map(token.get, a)) != whole.encode() or b"".join(map(piece, b)) != whole.encode():
            out.append([0, 0, 0, 0, ""])
            links.append([])
            continue
        ends_a, ends_b, at = [], [], 0
        for i in a:
            ends_a.append(at := at + len(token[i]))
        at = 0
        for i in b:
            ends_b.append(at := at + len(piece(i)))
        groups, start_a, start_b, own = [], 0, 0, []
        for end in sorted(set(ends_a) & set(ends_b)):
            stop_a, stop_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[start_a:stop_a])) + "|" + ",".join(map(str, b[start_b:stop_b])))
            own.append((a[stop_a - 1], b[stop_b - 1]))
            start_a, start_b = stop_a, stop_b
        out.append([len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        links.append(own)
    counts = Counter(p for own in links for p in own)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(*row[:4], sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), row[4])
            for row, own in zip(out, links)]


def texts_of(n):
    rng = random.Random(11)
    words = ["the", "Hello", "tokenizer", "größer", "naïve", "antidisestablishment", "xyzzy", "42", "foo_bar", "it's", "\n", "  ", "—"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("hot", [1, 16, 400, 65_536])
def test_against_plain_version(spark, monkeypatch, hot):
    """The same rows whichever pairs are broadcast and whichever are joined."""
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    texts = ODD + texts_of(40) + ODD[3:6]
    ids = [None if k == 5 else k // 2 for k in range(len(texts))]
    rows = [(i, t, "x", 7, 7) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, uid long, n long").repartition(3)
    found = alignment.cross_tokenizer_counts(docs, *PATHS)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((i, *row)) for i, row in zip(ids, plain(texts)))


def test_same_bytes_array():
    tools = alignment.Aligner(alignment.load_files(*PATHS))
    for i in [*range(0, 50_000, 997), 0, 1, 10, 220]:
        same = int(tools.same[i])
        assert tools.bytes_b[same] == tools.bytes_a[i] if same >= 0 else tools.bytes_a[i] not in tools.bytes_b
    assert not tools.b.is_byte(int(tools.same[tools.bytes_a.index(b"e")]))


TOOLS = alignment.Aligner(alignment.load_files(*PATHS))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("ab .,'sÀé  \n\t\u3000\u200b1▁<", max_size=40)), max_size=4))
def test_cut_texts_equal_whole_ones(texts):
    """Chunk by chunk, with or without a memory of them, as the libraries encode the whole text."""
    for got, text, (n_a, n_b, n_groups, _, _, _, digest) in zip(TOOLS.align(texts), texts, plain(texts)):
        if got is None:
            assert (n_a, digest) == (0, "")
        else:
            assert [sum(c.n_a for c in got), sum(c.n_b for c in got), sum(c.n_groups for c in got)] == [n_a, n_b, n_groups]
            assert hashlib.sha256(";".join(c.text for c in got).encode()).hexdigest() == digest


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(alignment, "MEMORY", 5)
    tools = alignment.Aligner(alignment.load_files(*PATHS))
    texts = ["a b c d", "e f g h i j k l", "a b", "m" * 60 + " n"]
    for text in texts:
        assert tools.align([text]) == TOOLS.align([text])
    assert not any(len(c) > alignment.LONGEST_KEPT for c in tools.known)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = sorted(map(tuple, alignment.cross_tokenizer_counts(docs, *PATHS).collect()))
    assert found == sorted((r.doc_id, *row) for r, row in zip(rows, plain([r.text for r in rows])))


def test_empty_table_and_unusable_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.cross_tokenizer_counts(docs, *PATHS).collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]
    assert alignment.cross_tokenizer_counts(docs.limit(0), *PATHS).count() == 0


def test_very_long_text(spark):
    text = " ".join(texts_of(5_000))
    assert len(text.split()) > 80_000
    docs = spark.createDataFrame([(1, text), (2, "y" * 200_000)], "doc_id long, text string")
    one, two = sorted(alignment.cross_tokenizer_counts(docs, *PATHS).collect())
    assert one.n_links == one.n_groups > 50_000 and two.n_a > 0 and one.count_sum > one.n_links
