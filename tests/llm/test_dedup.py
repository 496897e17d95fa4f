"""URL filter, duplicates, passages, decontamination and the pipeline against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import common, components, decontaminate, exact_dedup, jaccard, substring_dedup, url_filter
from shelfwise.llm.queries import RULES

FOLDER = "/root/testdata/sf0.001"
#: Extra columns are named like what the operators make.
ODD = "doc_id long, text string, keep_id long, component_id long, family long, node long, piece int, words int, lang string"


def odd_rows(spark, *texts):
    return spark.createDataFrame([(i, t, 1, 1, 1, 1, 1, 1, "x") for i, t in texts], ODD)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def sentence(rng, n):
    return " ".join(rng.choice("the of a".split()) if rng.random() < 0.3 else "".join(rng.choices("abcdefgh", k=6)) for _ in range(n))


# --- URL filter ------------------------------------------------------------

URLS = ["http://a.example.com/en/x", "https://www.EXAMPLE.com/en/", "http://xexample.com/en/", "http://example.net/es/1?q=/fr/", "http://net/fr/",
        "http://example.com", "//nothing", None, "", "http://u@a.example.com/en/#f", "http://a.com?x=://b.net/es/", "http://é.net/fr/é", "x" * 5000,
        "http://sub.www.example.com/en/1", "http://example.com/english"]


def plain_verdict(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize("inline", [5000, 0])
def test_url_filter(spark, inline):
    rng = random.Random(5)
    rules = [*RULES, url_filter.UrlRule("block", "example.com", "/eng"), url_filter.UrlRule("block", "a.com", "")]
    hosts = ["example.com", "www.example.com", "a.net", "net", "xnet", "b.a.com"]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'en/', 'es/', 'eng/x'])}" for _ in range(60)] + URLS[:3]
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string")
    got = url_filter.url_filter(pages, rules, inline_rules=inline)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert {tuple(r) for r in got.collect()} == {(i, *plain_verdict(u, rules)) for i, u in enumerate(urls)} and got.count() == len(urls)
    assert url_filter.url_filter(pages.limit(0), rules, inline_rules=inline).count() == 0
    assert {r.verdict for r in url_filter.url_filter(pages, [], "block", inline).collect()} == {"block"}


def test_many_url_rules(spark):
    rules = [url_filter.UrlRule("block" if i % 2 else "allow", f"h{i}.example.org", f"/p{i % 7}/") for i in range(800)]
    pages = spark.range(900).select(F.col("id").alias("page_id"), F.format_string("http://x.h%d.example.org/p%d/z", "id", F.col("id") % 7).alias("url"))
    both = [sorted(map(tuple, url_filter.url_filter(pages, rules, inline_rules=n).collect())) for n in (5000, 10)]
    assert both[0] == both[1] and sum(r[3] is not None for r in both[0]) == 800


# --- exact duplicates ------------------------------------------------------

def plain_groups(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    ids = defaultdict(list)
    for (i, _), n in zip(rows, norm):
        ids[n].append(i)
    keep = {n: min((i for i in g if i is not None), default=None) for n, g in ids.items()}
    return Counter((i, keep[n], len(ids[n]), hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm)), len(ids)


def test_exact_dedup(spark):
    rng = random.Random(2)
    texts = [sentence(rng, 20) for _ in range(30)]
    rows = [(i, rng.choice(texts) if i % 3 else "hot  text") for i in range(4000)]
    rows += [(5000, None), (5001, ""), (5002, " "), (5003, "\t\n"), (None, "hot text"), (None, "alone"), (7, rows[7][1]), (5004, "x " * 50_000), (5005, "x\t" * 50_000)]
    got = exact_dedup.exact_dedup(odd_rows(spark, *rows)).collect()
    want, groups = plain_groups(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_copies(odd_rows(spark, *rows))
    assert left.columns == odd_rows(spark, (1, "")).columns and left.count() == groups
    once = [r for k, r in enumerate(rows) if r not in rows[:k]]
    left = exact_dedup.drop_copies(odd_rows(spark, *once))
    assert left.columns == odd_rows(spark, (1, "")).columns and left.count() == groups
    assert exact_dedup.exact_dedup(odd_rows(spark, (1, "")).limit(0)).count() == 0


CLASHING = ["gone_id", "key", "_key", "digest", "other_key", "Other_Digest", "number", "__id", "__doc", "__digest", "__other", "__n"]


@pytest.mark.parametrize("repeat", [1, 2])
def test_columns_named_like_helpers_stay(spark, repeat):
    rows = [(i, t, *(f"{c}{i}" for c in CLASHING)) for i, t in enumerate(["one two three four five six", "one two  three four five six", "x", None])] * repeat
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    for kept in (exact_dedup.drop_copies(docs), jaccard.drop_near_copies(docs)):
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == {0, 2, 3}
        assert all(r[c] == f"{c}{r.doc_id}" for r in kept.collect() for c in CLASHING)


# --- components and the Jaccard join ---------------------------------------

def plain_components(nodes, links):
    own = {n: n for n in nodes}

    def root(x):
        while own[x] != x:
            own[x] = x = own[own[x]]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        own[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 200)] + [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(90)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links + links[:5] + [(7, 7), (None, 3)], "a long, b long")).collect()}
    want = plain_components({x for p in links for x in p}, links)
    assert {n: c for n, c in want.items() if n in got} == got and all(n == c for n, c in want.items() if n not in got)


def plain_jaccard(rows, n, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    known = [k for k, (i, _) in enumerate(rows) if i is not None]
    links = [(rows[a][0], rows[b][0]) for x, a in enumerate(known) for b in known[x + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    component = plain_components({rows[k][0] for k in known}, links)
    return sorted(((i, len(s), component.get(i)) for (i, _), s in zip(rows, sets)), key=repr)


def near_copies(rng):
    """Families of copies with few changes, chains of copies of copies, a shared line, short and odd texts."""
    rows, line = [], sentence(rng, 12)
    for _ in range(6):
        base = sentence(rng, rng.choice([8, 30, 120, 400])).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = "".join(rng.choices("xyz", k=5))
            rows.append(" ".join(copy))
            base = copy if rng.random() < 0.5 else base
    rows += [f"{line} {sentence(rng, rng.randrange(1, 60))} {line}" for _ in range(40)]
    rows += [line] * 5 + ["a", "A", "a b", "a  B", "a b c", "", None, "   ", "b a", "w " * 300, "w " * 200, "W v " * 100]
    rng.shuffle(rows)
    return [*enumerate(rows), (None, line), (None, None), (3, rows[3])]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, monkeypatch, n, percent):
    rows = near_copies(random.Random(n))
    got = jaccard.jaccard_components(odd_rows(spark, *rows), n, percent).collect()
    assert sorted(map(tuple, got), key=repr) == plain_jaccard(rows, n, percent)
    if n == 3:  # many small blocks and no broadcast give the same
        monkeypatch.setattr(jaccard, "BLOCK_ROWS", 3)
        monkeypatch.setattr(jaccard, "SLAB", 50)
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
        again = jaccard.jaccard_components(odd_rows(spark, *rows), n, percent).collect()
        assert sorted(map(tuple, again), key=repr) == plain_jaccard(rows, n, percent)
    else:
        again = jaccard.jaccard_components(odd_rows(spark, *rows), n, percent, jaccard.EXTRA_PARTS).collect()
        assert sorted(map(tuple, again), key=repr) == plain_jaccard(rows, n, percent)
    assert jaccard.jaccard_components(odd_rows(spark, *rows).limit(0), n, percent).count() == 0


@pytest.mark.parametrize("percent, extra, bits", [(80, 0.0, 0), (80, 0.5, 0), (80, 0.25, 8), (80, 0.5, 12), (80, 1.0, 2), (90, 0.0, 0), (90, 0.0, 8), (90, 0.5, 8),
                                                  (100, 0.0, 0)])
def test_signatures_lose_no_link(monkeypatch, percent, extra, bits):
    """Also if any signatures whatever count as frequent."""
    rng, cuts, links = np.random.default_rng(percent), jaccard.Cuts(percent, extra), 0
    monkeypatch.setattr(jaccard, "BUCKET_SHIFT", np.uint64(64 - bits))
    frequent = rng.integers(0, 4, 2**bits).astype(np.uint8) if bits else None
    for _ in range(1500):
        x = np.unique(rng.integers(0, 2**64 - 1, int(rng.integers(1, 300)), dtype=np.uint64))
        more, less = (int(rng.integers(0, len(x) // 7 + 1)) for _ in range(2))
        y = np.unique(np.concatenate([rng.permutation(x)[less:], rng.integers(0, 2**64 - 1, more, dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= percent * (len(x) + len(y) - both):
            links += 1
            pairs = zip(jaccard.signatures(x, cuts, frequent), jaccard.signatures(y, cuts, frequent))
            assert any(len(np.intersect1d(a, b)) for a, b in pairs)
    assert links > 10


def test_frequent_signatures_are_counted(spark):
    """Every document counts, in whichever task it is; a count ends at 255."""
    rng = random.Random(4)
    texts = [sentence(rng, 40) for _ in range(30)] + [sentence(rng, 12)] * 400 + ["", None]
    docs = common.id_and_text(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7))
    table = np.frombuffer(jaccard._frequent(docs, 5, 80, 0.5).value, np.uint8)
    shingles, cuts, want = jaccard.Shingles(5), jaccard.Cuts(80, 0.5), Counter()
    for t in filter(None, texts):
        want.update((np.concatenate(jaccard.signatures(shingles(t), cuts)) >> jaccard.BUCKET_SHIFT).tolist())
    assert len(table) == jaccard.BUCKETS and {int(k): int(table[k]) for k in np.flatnonzero(table)} == {k: min(255, n) for k, n in want.items()}


def test_added_pieces_take_a_byte_a_bucket():
    rng = np.random.default_rng(5)
    pieces = [rng.integers(0, 200, jaccard.PIECE).astype(np.uint8) for _ in range(3)]
    packed = [zlib.compress(p.tobytes(), 1) for p in pieces]
    tracemalloc.start()
    got = jaccard.added((k, p) for p in packed for k in range(64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = np.minimum(255, sum(p.astype(int) for p in pieces))
    assert len(got) == 64 and all((s == expected).all() and s.dtype == np.uint8 for s in got.values())
    assert peak < 2 * 64 * jaccard.PIECE  # eight bytes a bucket before


def test_only_signatures_of_several_documents_stay(spark, monkeypatch):
    """Counts are exact, by document and not by bucket; of what several documents have, each set leaves out the most frequent."""
    monkeypatch.setattr(jaccard, "PACKED", 500)
    rng = random.Random(9)
    line, base = sentence(rng, 13), sentence(rng, 60)
    texts = [f"{sentence(rng, 40)} {line} {sentence(rng, 20)}" for _ in range(60)] + [f"{base} {sentence(rng, 2)}" for _ in range(3)] + [base, "", "one"]
    ids = [(-1) ** i * i * 2**40 for i in range(len(texts))]
    rows = [*zip(ids, texts), (None, base), (None, "")]
    got = jaccard._rarest(common.id_and_text(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), 5, 80, 0.5).collect()
    shingles, cuts = jaccard.Shingles(5), jaccard.Cuts(80, 0.5)
    signed = {i: jaccard.parted(shingles(t), cuts) if t else [(np.empty(0, np.uint64), 0)] * 2 for i, t in zip(ids, texts)}
    times = Counter(s for both in signed.values() for signs, _ in both for s in signs.tolist())
    for r in got:
        for mine, (signs, left) in zip((r.even, r.odd), signed[r.doc_id] if r.doc_id is not None else [(np.empty(0), 0)] * 2):
            several = sorted(times[s] for s in signs.tolist() if times[s] > 1)
            want = sorted(several)[:max(0, len(several) - left)]
            assert len(mine) == len(want) and set(s & 2**40 - 1 for s in mine) <= set(int(s) & 2**40 - 1 for s in signs if times[int(s)] > 1)
    assert len(got) == len(rows) and sum(len(r.even) + len(r.odd) > 0 for r in got) == 4  # base and its near copies, and nothing by the line


def test_a_common_line_makes_no_family(spark):
    """2,000 documents whose only bond is a line, at 80 percent: without their most frequent signatures hardly any meet."""
    rng = random.Random(21)
    line = sentence(rng, 13)
    rows = [(i, f"{sentence(rng, 20)} {line} {sentence(rng, 20)}") for i in range(2000)] + [(5000 + i, t) for i, t in enumerate([sentence(rng, 60)] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = common.id_and_text(docs)
    size = {}
    for extra in (0.0, jaccard.EXTRA_PARTS):
        signed = jaccard._signed(texts, 5, 80, extra, jaccard._frequent(texts, 5, 80, extra) if extra else None)
        families = components.components(jaccard._candidate_links(signed))
        size[extra] = families.groupBy("component").count().agg(F.max("count")).first()[0]
    assert size[jaccard.EXTRA_PARTS] < 20 < 1000 < size[0.0]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 5, 80, jaccard.EXTRA_PARTS).collect()}
    assert got == {i: min(i, 5000) for i, _ in rows}


# --- passages --------------------------------------------------------------

def test_compact_windows():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, width = int(rng.integers(1, 60)), int(rng.integers(1, 12))
        values = rng.permutation(n).astype(np.uint64)
        windows = substring_dedup.compact_windows(values, width)
        for i in range(n):
            for j in range(i + width - 1, n):
                least = i + int(values[i:j + 1].argmin())
                assert [w[1] for w in windows if w[0] <= i <= w[1] <= j <= w[2]] == [least]


def covered(rows, got, words):
    """Every run of so many words that two documents have lies in a passage of each, but for a few words."""
    where, own = defaultdict(set), defaultdict(list)
    for r in got:
        own[r.doc_id].append((r.first_word, r.last_word))
    split = {i: (t or "").lower().split() for i, t in rows if i is not None}
    for i, w in split.items():
        for k in range(len(w) - words + 1):
            where[tuple(w[k:k + words])].add(i)
    missed = [(i, k) for i, w in split.items() for k in range(len(w) - words + 1)
              if len(where[tuple(w[k:k + words])]) > 1 and not any(a <= k + 3 and k + words - 4 <= b for a, b in own[i])]
    return missed, {i for s in where.values() if len(s) > 1 for i in s}


def test_repeated_passages(spark, documents):
    rng = random.Random(8)
    shared = [sentence(rng, 60) for _ in range(5)]
    line = sentence(rng, 14)
    rows = [(i, " ".join([sentence(rng, rng.randrange(5, 150)), shared[i % 5], line, sentence(rng, rng.randrange(5, 150))])) for i in range(40)]
    changed = shared[0].split()
    changed[30] = "changed"
    rows += [(100 + i, f"{sentence(rng, 100)} {line} {sentence(rng, 100)}") for i in range(40)]  # a line alone is no passage
    rows += [(200, f"{sentence(rng, 80)} {' '.join(changed)} {sentence(rng, 40)}"), (300, None), (301, ""), (302, line), (None, rows[0][1]),
             (303, rows[41][1]), (304, rows[41][1] + "\n"), (5, rows[5][1]), (305, "w " * 20_000), (306, "v w " * 9_000)]
    got = substring_dedup.repeated_passages(odd_rows(spark, *rows)).collect()
    missed, repeated = covered(rows, got, 51)
    assert not missed and repeated <= {r.doc_id for r in got}
    assert {r.doc_id for r in got} - repeated <= {200}
    assert 200 in {r.doc_id for r in got} and all(0.8 <= r.similarity <= 1 and r.class_id <= r.doc_id for r in got)
    assert substring_dedup.repeated_passages(odd_rows(spark, *rows).limit(0)).count() == 0
    given = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = substring_dedup.repeated_passages(documents).collect()
    missed, repeated = covered(given, got, 51)
    assert not missed and repeated <= {r.doc_id for r in got}


def line_documents(rng, n, lines):
    """Documents of shared lines, each too short for a passage, and a few passages made of such lines."""
    return [(i, " ".join([sentence(rng, rng.randrange(5, 30)), *(rng.choice(lines) for _ in range(6)), sentence(rng, 20)])) for i in range(n)]


def test_hot_keys_change_no_candidate(spark, monkeypatch):
    rng = random.Random(11)
    lines = [sentence(rng, 30) for _ in range(6)]
    docs = odd_rows(spark, *line_documents(rng, 60, lines)).select("doc_id", "text")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), {}
    try:
        for hot in (10**9, 25, -1):
            for tasks in (1, 4, 13):
                monkeypatch.setattr(substring_dedup, "HOT", hot)
                spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
                found[hot, tasks] = {tuple(r) for r in substring_dedup._candidates(docs, 46)[0].select("doc_id", "pivot", "first", "last").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = found[10**9, 1]
    assert expected and all(f == expected for f in found.values()), {k: (len(f), len(f ^ expected)) for k, f in found.items()}


def test_tokens_travel_in_six_bytes():
    tokens = np.random.default_rng(3).integers(0, 2**64 - 1, 1000, dtype=np.uint64)
    data = substring_dedup.packed_tokens(tokens)
    assert len(data) == 6000 and (substring_dedup.unpacked_tokens(data) == tokens & np.uint64(2**48 - 1)).all()
    assert not len(substring_dedup.unpacked_tokens(substring_dedup.packed_tokens(tokens[:0])))
    assert (substring_dedup.unpacked_tokens(data[60:120]) == tokens[10:20] & np.uint64(2**48 - 1)).all()


def test_only_documents_with_a_shared_mark_are_read_again(spark):
    rng = random.Random(13)
    line, passage = sentence(rng, 14), sentence(rng, 60)
    rows = [(i, f"{sentence(rng, 60)} {line} {passage if i < 4 else ''} {sentence(rng, 60)}") for i in range(40)]
    docs = odd_rows(spark, *rows).select("doc_id", "text")
    near = substring_dedup._candidates(docs, 46)[1]
    assert near.columns == ["doc_id", "key"]
    assert {r.doc_id for r in near.collect()} == {0, 1, 2, 3}
    runs = substring_dedup._repeats(docs, near, 46, 1.0).collect()
    assert {(r.doc_id, r.class_id) for r in runs} == {(i, 0) for i in range(4)}
    assert all(r.last_word - r.first_word == 49 for r in runs) and len(runs) >= 4 * 11


@pytest.mark.parametrize("hot", [10**9, 25, -1])
def test_hot_runs_change_no_repeat(spark, monkeypatch, hot):
    rng = random.Random(14)
    passages = [sentence(rng, 60) for _ in range(3)]
    rows = [(i, f"{sentence(rng, 20)} {passages[i % 7 % 3]} {sentence(rng, 20)}") for i in range(120)]
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    got = substring_dedup.repeated_passages(odd_rows(spark, *rows)).collect()
    missed, repeated = covered(rows, got, 51)
    assert not missed and repeated == {r.doc_id for r in got} == set(range(120))
    assert {(r.doc_id, r.class_id) for r in got} == {(i, i % 7 % 3) for i in range(120)}


def test_many_passages_at_different_offsets():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        new = lambda n: rng.integers(0, 2**64 - 1, n, dtype=np.uint64)
        line, passages = new(8), [new(80) for _ in range(9)]
        for p in passages:
            p[35:43] = line
        passages[-1][20] = passages[0][3]  # a single token of another passage
        own = np.concatenate([line, *(x for k, p in enumerate(passages) for x in (new(20 + 3 * k), p))])
        other = np.concatenate([new(7), line, new(30), line, *(x for k, p in enumerate(passages) for x in (new(60 - 5 * k), p))])
        found = substring_dedup.matching_passages(own, other, np.argsort(other, kind="stable"), 46, 0.8)
        for p in passages:
            at, there = (int(np.flatnonzero(s == p[0])[0]) for s in (own, other))
            assert any(a <= at and at + 79 <= b and low <= there and there + 79 <= high for a, b, low, high, _ in found), (seed, len(found))


def test_passages_with_a_line_that_lower_ids_hold(spark):
    rng, rows = random.Random(12), []
    for words in (30, 38, 45):
        for after in (True, False):
            for _ in range(12):
                line, own, n = sentence(rng, words), sentence(rng, 25), len(rows)
                rows += [(n + i, f"{sentence(rng, 30)} {line} {sentence(rng, 30)}") for i in range(8)]
                passage = f"{own} {line}" if after else f"{line} {own}"
                rows += [(100_000 + n + i, f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}") for i in range(2)]
    got = substring_dedup.repeated_passages(odd_rows(spark, *rows)).collect()
    missed, repeated = covered(rows, got, 50)
    assert not missed, len({i for i, _ in missed})
    assert {r.doc_id for r in got} == repeated


# --- decontamination -------------------------------------------------------

def test_retrieval_is_exact():
    rng = random.Random(4)
    items = [(i, sentence(rng, rng.randrange(3, 60))) for i in range(300)]
    df = Counter(w for _, t in items for w in set(decontaminate.words_of(t)))
    index = decontaminate.build_index(items, df, len(items), 30.0)
    weights = np.zeros((len(index["terms"]), len(index["ids"])))
    for k, (numbers, shares) in enumerate(index["lists"]):
        weights[k, numbers] = shares
    for threshold in (0.05, 0.3, 0.7):
        for _ in range(60):
            words = decontaminate.words_of(f"{rng.choice(items)[1]} {sentence(rng, 40)} {rng.choice(items)[1]}")
            terms = sorted({index["terms"][w] for w in words if w in index["terms"]})
            scores = weights[terms].sum(axis=0)
            sure = {i for i in np.flatnonzero(scores >= threshold + 1e-9).tolist()}
            got = dict(decontaminate.retrieve(index, terms, threshold))
            assert sure <= set(got) <= set(np.flatnonzero(scores >= threshold - 1e-9).tolist())
            assert all(abs(scores[i] - s) < 1e-9 for i, s in got.items())


@pytest.mark.parametrize("shard", [20_000, 7])
def test_find_leaks(spark, documents, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", shard)
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    docs, items = documents.select("doc_id", "text").collect(), benchmark.collect()
    plain = lambda t: " " + b" ".join(decontaminate.words_of(t or "")).decode() + " "
    texts = {i: plain(t) for i, t in docs}
    want = {(d, r.item_id) for r in items for d, t in texts.items() if plain(r.text) in t}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents, benchmark).collect()} == want and want


def test_find_leaks_of_odd_rows(spark):
    item = "What is the tallest peak of the northern ridge beyond the old mill? It is the grey tower of Arnholm."
    more = "One sentence alone with several words in it that nobody else would ever write down"
    benchmark = spark.createDataFrame([(1, item, 9), (1, item, 9), (2, None, 9), (3, "", 9), (4, more, 9), (5, "hi", 9)], "item_id long, text string, score int")
    rows = [(1, f"before {item.upper()} after"), (2, item.split("?")[0]), (3, None), (4, ""), (None, more), (6, "hi there " * 40_000), (7, f"x {more}"), (7, f"x {more}")]
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.find_leaks(odd_rows(spark, *rows), benchmark).collect()), key=repr)
    assert got == [(1, 1), (6, 5), (7, 4), (7, 4), (None, 4)]
    left = decontaminate.drop_contaminated(odd_rows(spark, *rows), benchmark)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == [2, 3, 4, None]
    assert decontaminate.find_leaks(odd_rows(spark, *rows), benchmark.limit(0)).count() == 0
    assert decontaminate.find_leaks(odd_rows(spark, *rows).limit(0), benchmark).count() == 0


# --- pipeline --------------------------------------------------------------

def test_pipeline(spark, tmp_path, documents):
    """Every stage works on what the one before kept; the columns stay until the last."""
    docs = documents
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == documents.columns and 0 < after.count() <= before
            assert after.join(docs, "doc_id", "left_anti").count() == 0
        if name == "exact_dedup":
            assert after.count() == docs.select(exact_dedup.normalised(F.col("text"))).distinct().count()
        if name == "near_dedup":
            rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
            assert after.count() == len({c for _, _, c in plain_jaccard(rows, 5, 80)})
        docs = after
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, run.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, docs.select("doc_id", "n_tokens").collect()))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, stage):
    rows = odd_rows(spark, (1, "some words here"), (1, "some words here"), (2, None), (None, None), (None, "x"), (3, ""), (4, "y " * 30_000))
    out = stage(spark, rows, FOLDER)
    assert out.count() <= rows.count()
    assert stage(spark, rows.limit(0), FOLDER).count() == 0
