"""Personal data: fixed patterns, and candidate spans that boosted trees select."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone")
#: Documents that the fit looks at, about; they are chosen by a hash of the text.
SAMPLE_DOCS = 20_000
#: Candidates that the fit uses at most.
SAMPLE_SPANS = 40_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
#: Share of right spans that a kind's threshold is calibrated to.
PRECISION = 0.98

# The base patterns. A digit run that fails as a whole fails from any later digit, too, so looking only
# at starts of runs changes no match and keeps the search linear.
HAS_DIGIT = re.compile("[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# What candidates are cut out of.
AROUND_AT = re.compile(r"[^\s@,;:<>()\[\]\"']+(?:@|\s?[(\[]at[)\]]\s?)[^\s@,;:<>()\[\]\"']+")
AT = re.compile(r"@|\s?[(\[]at[)\]]\s?")
DIGITS = re.compile(r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])*")
PIECE = re.compile(r"[^\x20/]+")
CONTEXT = re.compile(r"(mail|contact|write)|(ip\b|server|host|address)|(card|visa|pay|iban)|(phone|tel|call|fax|mobil)", re.I)

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
            at = text.find("@", end)
        else:
            end = at + 1  # the class of the local part has no @
            at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns that pass their check, by kind and start."""
    spans = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if HAS_DIGIT.search(text):
        spans += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        spans += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        spans += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data: what surrounds an at sign, and within every chain of digits the runs
    of pieces with 7 to 19 digits. A run has at most 19 pieces, so their number is linear in the text's length."""
    found: set[Span] = set()
    if "@" in text or "at)" in text or "at]" in text:
        found.update((0, m.start(), m.end() - (text[m.end() - 1] in ".,")) for m in AROUND_AT.finditer(text))
    if HAS_DIGIT.search(text):
        for chain in DIGITS.finditer(text):
            if chain.end() - chain.start() < 7:
                continue
            pieces = [(p.start(), p.end(), len(_digits(p[0]))) for p in PIECE.finditer(text, *chain.span())]
            for i, (start, _, _) in enumerate(pieces):
                total = 0
                for _, end, digits in pieces[i:]:
                    total += digits
                    if total > 19:
                        break
                    if total >= 7 or text.count(".", start, end) == 3:
                        found.update((kind, start, end) for kind in _kinds(text[start:end], total))
    return sorted(found)


def _kinds(span: str, digits: int) -> list[int]:
    return [1] * (span.count(".") == 3 and digits <= 12) + [2] * (13 <= digits) + [3] * (digits <= 15)


FEATURES = 18


def describe(text: str, span: Span) -> list[float]:
    """Numbers about a candidate's format and its surroundings."""
    kind, start, end = span
    own, digits = text[start:end], _digits(text[start:end])
    before, after = text[max(0, start - 1):start], text[end:end + 1]
    near = CONTEXT.search(text, max(0, start - 30), start)
    parts = own.split(".")
    domain = AT.split(own)[-1]
    return [
        kind, len(own), len(digits), len(digits) / len(own), own.startswith("+"), own.count(" "), own.count("-"), own.count("."),
        own.count("(") - own.count(")"), own.count("@"), len(digits) >= 13 and luhn(digits),
        len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts),
        bool(DOMAIN.fullmatch(domain)), before.isalnum(), before in tuple(".-@/#="), after.isalnum(),
        after in tuple("-@/"), near.lastindex - 1 == kind if near else -1,
    ]


def hidden(text: str, span: Span) -> tuple[str, Span] | None:
    """Surroundings of a base span without the sign that its pattern goes by, and the span there: an email with a written
    at, a phone number without the plus. None for other kinds."""
    kind, start, end = span
    before, own, after = text[max(0, start - 40):start], text[start:end], text[end:end + 40]
    if kind == 0:
        own = own.replace("@", (" (at) ", "(at)", " [at] ", "[at]")[crc32(own.encode("utf-8", "replace")) % 4])
    elif kind == 3:
        own = own[1:]
    else:
        return None
    return before + own + after, (kind, len(before), len(before) + len(own))


def _groups(x: np.ndarray) -> np.ndarray:
    """By described candidate the kind, and a number of its own where an email has no @ or a phone number no plus."""
    return (x[:, 0] + len(KINDS) * (((x[:, 0] == 0) & (x[:, 9] == 0)) | ((x[:, 0] == 3) & (x[:, 4] == 0)))).astype(int)


class Booster(NamedTuple):
    """Trees of equal depth as arrays: node i has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cuts: np.ndarray  # by group: the score from which on a span is selected

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray) -> Booster:
    """Gradient boosting for the logistic loss. Three rows of four grow the trees, the fourth calibrates the thresholds."""
    grow = np.arange(len(y)) % 4 != 3
    gx, gy = x[grow], y[grow]
    edges = [np.unique(np.quantile(gx[:, j], np.linspace(0, 1, BINS)))[:-1] for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, gx[:, j]) for j, e in enumerate(edges)])
    base = float(np.log((gy.sum() + 1) / (len(gy) - gy.sum() + 1)))
    total, inner = np.full(len(gy), base), 2**DEPTH - 1
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = gy - p, p * (1 - p)
        node, feature, threshold = np.zeros(len(gy), int), np.zeros(inner, int), np.full(inner, np.inf)
        for n in range(inner):
            own = np.flatnonzero(node == n)
            best = 1e-6
            for j, e in enumerate(edges):
                if not len(e) or not len(own):
                    continue
                sg = np.bincount(bins[j, own], g[own], len(e) + 1).cumsum()
                sh = np.bincount(bins[j, own], h[own], len(e) + 1).cumsum()
                gain = sg**2 / (sh + 1) + (sg[-1] - sg)**2 / (sh[-1] - sh + 1) - sg[-1]**2 / (sh[-1] + 1)
                if gain[:-1].max() > best:
                    best, feature[n], threshold[n] = gain[:-1].max(), j, e[gain[:-1].argmax()]
            node[own] = 2 * n + 1 + (gx[own, feature[n]] > threshold[n])
        leaf = node - inner
        value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        total += value[leaf]
        for into, new in ((features, feature), (thresholds, threshold), (values, value)):
            into.append(new)
    model = Booster(base, np.array(features), np.array(thresholds), np.array(values), np.ones(2 * len(KINDS)))
    return model._replace(cuts=_calibrated(model.score(x[~grow]), y[~grow], _groups(x[~grow])))


def _calibrated(score: np.ndarray, y: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """By group the lowest score, 0.5 at least, from which on PRECISION of the spans are right; above 1 where there is none."""
    cuts = np.full(2 * len(KINDS), 2.0)
    for k in range(2 * len(KINDS)):
        order = np.argsort(-score[kind == k], kind="stable")
        s, right = score[kind == k][order], y[kind == k][order].cumsum()
        good = np.flatnonzero((right >= PRECISION * np.arange(1, len(s) + 1)) & (s >= 0.5))
        if len(good):
            cuts[k] = s[good[-1]]
    return cuts


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS, spans: int = SAMPLE_SPANS) -> Booster | None:
    """Fit to the candidates of about ``sample`` documents, right where a fixed pattern has the same span of that kind.

    Base emails and phone numbers are shown a second time without the @ or the plus, with the candidates that lie on them there, so
    that such spans are told from plain numbers by the rest of their format and by their surroundings.

    None if there are no candidates of both sorts.
    """
    def shown(text: str, span: Span, right: bool) -> tuple[bytes, list[float]]:
        return hashlib.md5(text[span[1]:span[2]].encode("utf-8", "replace")).digest(), [*map(float, describe(text, span)), float(right)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0):
                text = text.as_py()
                base = set(base_spans(text))
                rows += [shown(text, s, s in base) for s in candidates(text)]
                for near, span in filter(None, (hidden(text, s) for s in base)):
                    rows += [shown(near, s, s == span) for s in candidates(near) if s[1] < span[2] and span[1] < s[2]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                              pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["key", "row"])

    texts = id_and_text(docs).select("text")
    share = min(1.0, sample / max(1, docs.count()))
    seen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(share * 1_000_000)) \
        .mapInArrow(run, "key binary, row array<double>").distinct().orderBy("key", "row").limit(spans)
    data = np.array(seen.select("row").toArrow().column(0).to_pylist(), float).reshape(-1, FEATURES + 1)
    y = data[:, -1]
    return train(data[:, :-1], y) if 0 < y.sum() < len(y) else None


def select(text: str, base: list[Span], model: Booster | None) -> list[Span]:
    """Base spans, and of the other candidates those above their kind's threshold: the best score first, none on another."""
    if model is None:
        return base
    taken = bytearray(len(text))

    def mark(span: Span) -> Span:
        taken[span[1]:span[2]] = b"\1" * (span[2] - span[1])
        return span

    def is_free(span: Span) -> bool:
        return taken.find(1, span[1], span[2]) < 0

    for span in base:
        mark(span)
    free = [c for c in candidates(text) if is_free(c)]
    if not free:
        return base
    described = np.array([describe(text, c) for c in free], float)
    score, cuts = model.score(described), model.cuts[_groups(described)]
    added = [mark(free[i]) for i in np.argsort(-score, kind="stable") if score[i] >= cuts[i] and is_free(free[i])]
    return sorted(base + added)


def find_pii(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Spans of personal data in every whole text.

    Fixed patterns give the base spans, which stay. Generators of high recall propose further spans; boosted trees score
    them by format and context, and those above their kind's calibrated threshold are added where nothing is taken yet.
    One row out for each row in: doc_id, base and spans, arrays of (kind, start, end) in code points, by kind and start.

    The trees learn from about ``sample`` texts, chosen by a hash of the text; without candidates there nothing is added.
    A null text counts as empty and has no spans. A null doc_id and repeated rows stay; an empty table gives no rows;
    other columns are not read. Nothing but the bounded sample is shuffled.
    """
    model = fit(docs, sample)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named(spans: list[Span]) -> list[dict]:
            return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]

        for batch in batches:
            base, every = [], []
            for text in batch.column(1):
                text = text.as_py()
                own = base_spans(text)
                base.append(named(own))
                every.append(named(select(text, own, model)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(every, span)], ["doc_id", "base", "spans"])

    kind = "array<struct<kind:string,start:int,end:int>>"
    return id_and_text(docs).mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def digests(found: DataFrame) -> DataFrame:
    """Counts and texts of what find_pii returns: n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, KINDS),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
