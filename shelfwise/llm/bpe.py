"""BPE encoding and decoding with the files of a public tokenizer."""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfwise.llm.common import id_and_text

#: Entries that a Python worker remembers at most in each of its two memories, some 130 bytes each; a full one starts anew.
MEMORY = 100_000
#: White space of the split pattern. str.split() cuts at the same characters and at SEPARATORS.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
#: Fixed value: the split pattern of the tokenizer file.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


def load_model(path: str) -> dict:
    """What WordBpe needs of a tokenizer file of the kind "BPE with word ends", and its two empty memories."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, suffix = content["model"], content["model"]["end_of_word_suffix"]
    vocab: dict[str, int] = model["vocab"]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    strings = {i: t for t, i in (*vocab.items(), *special.items())}
    span = max(strings) + 1
    return {
        "special": special, "strings": strings, "span": span,
        # By left id x span + right id: rank x span + id of what comes out.
        "merges": {vocab[a] * span + vocab[b]: rank * span + vocab[a + b] for rank, (a, b) in enumerate(model["merges"])},
        "inner": [vocab[c] for c in byte_characters()], "last": [vocab[c + suffix] for c in byte_characters()],
        "pieces": {}, "words": {},
    }


class WordBpe:
    """Tokenizer: lower case, white space dropped. Ids are little-endian unsigned 32-bit integers in one string of bytes."""

    def __init__(self, model: dict) -> None:
        self.strings, self.span, self.merges = model["strings"], model["span"], model["merges"]
        self.inner, self.last, self.words, self.pieces = (model[k] for k in ("inner", "last", "words", "pieces"))
        self.special = {t: struct.pack("<I", i) for t, i in model["special"].items()}
        self.split = regex.compile(SPLIT)
        self.spaces = regex.compile(f"[^{SPACE}]+")
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def merge(self, ids: list[int]) -> list[int]:
        """Apply merges by rank, then from left to right.

        The queue holds merge and position in one number; the symbols form a list linked both ways, and pair[i] is
        the merge that symbol i and the next one allow now (-1: none, or i went into its left neighbour). An entry
        that differs from it is stale and skipped.
        """
        size, span, merges = len(ids), self.span, self.merges.get
        bits = size.bit_length()
        mask = (1 << bits) - 1
        pair = [merges(a * span + b, -1) for a, b in zip(ids, ids[1:])]
        pair.append(-1)
        queue = [m << bits | i for i, m in enumerate(pair) if m >= 0]
        if not queue:
            return ids
        heapify(queue)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        while queue:
            entry = heappop(queue)
            left = entry & mask
            merge = entry >> bits
            if pair[left] != merge:
                continue
            right = after[left]
            ids[left] = new = merge % span
            ids[right] = pair[left] = pair[right] = -1
            after[left] = follow = after[right]
            if follow < size:
                before[follow] = left
                pair[left] = m = merges(new * span + ids[follow], -1)
                if m >= 0:
                    heappush(queue, m << bits | left)
            lead = before[left]
            if lead >= 0:
                pair[lead] = m = merges(ids[lead] * span + new, -1)
                if m >= 0:
                    heappush(queue, m << bits | lead)
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        if (found := self.words.get(word)) is None:
            if len(self.words) >= MEMORY:
                self.words.clear()
            data = word.encode("utf-8", "replace")
            ids = [self.inner[b] for b in data]
            ids[-1] = self.last[data[-1]]
            found = self.words[word] = array("I", self.merge(ids)).tobytes()
        return found

    def piece(self, piece: str) -> bytes:
        """Ids of text without white space."""
        plain = piece.lower() if piece.isascii() else unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        found = self.word(plain) if plain.isalpha() else b"".join([self.word(w) for w in self.split.findall(plain)])
        if len(self.pieces) >= MEMORY:
            self.pieces.clear()
        self.pieces[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self._ordinary(text)
        return b"".join([self.special[part] if k % 2 else self._ordinary(part)
                         for k, part in enumerate(self.cut_special.split(text))])

    def _ordinary(self, text: str) -> bytes:
        pieces = self.spaces.findall(text) if SEPARATORS.search(text) else text.split()
        known, new = self.pieces.get, self.piece
        return b"".join([known(p) or new(p) for p in pieces])

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings of the ids; as the file names no decoder, with a space between."""
        return " ".join(map(self.strings.__getitem__, array("I", ids)))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text with the tokenizer file at ``path`` and decode it again.

    One row out for each row in: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded. Nothing
    is shuffled. The driver reads the file and broadcasts its vocabulary, which has the size of the file; a Python
    worker keeps it from task to task together with the ids of a bounded number of words. A null or empty text has
    no tokens and is decoded to an empty text. A null doc_id and repeated rows stay; other columns are not read. An
    empty table gives no rows.
    """
    return _mapped(docs, path, "doc_id long, n_tokens long, ids binary, decoded string", lambda ids: ids, lambda text: text)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """As encode_documents, with SHA-256 digests in place of ids and text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _mapped(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                   lambda ids: hashlib.sha256(ids).hexdigest(), lambda text: hashlib.sha256(text.encode()).hexdigest())


def _mapped(docs: DataFrame, path: str, schema: str, of_ids: Callable, of_text: Callable) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]
    kind = pa.binary() if "ids binary" in schema else pa.string()
    model = docs.sparkSession.sparkContext.broadcast(load_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordBpe(model.value)
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch.column(1):
                encoded = tokenizer.encode(text.as_py())
                counts.append(len(encoded) // 4)
                ids.append(of_ids(encoded))
                texts.append(of_text(tokenizer.decode(encoded)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, kind), pa.array(texts, pa.string())], names)

    return id_and_text(docs).mapInArrow(run, schema)
