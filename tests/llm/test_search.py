"""Ranked search against scores worked out one by one."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from ordertally.llm import search
from tests.llm.compare import compare

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, item_id int, score int, rank string"
ITEMS = "item_id bigint, text string, doc_id int, score int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(documents, items, top=10):
    counts = [(key, Counter(terms(text))) for key, text, *_ in documents]
    counts = [(key, c, c.total()) for key, c in counts if c]
    n_docs, words = len(counts), sum(n for *_, n in counts)
    df = Counter(term for _, c, _ in counts for term in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text, *_ in items:
        asked = terms(text)
        scored = []
        for key, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // words
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, key, -score))
    return sorted(out, key=repr)


def shown(frame):
    columns = ("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


LONG = " ".join(f"w{i % 977}" for i in range(60_000))
AWKWARD = [
    (1, None, 1, 1, "x"),
    (2, "", 1, 1, "x"),
    (3, " -- \n!", 1, 1, "x"),
    (4, "One two-THREE é4 one", 1, 1, "x"),
    (5, "one two three", 1, 1, "x"),
    (5, "one two three", 1, 1, "x"),
    (None, "one two three", 1, 1, "x"),
    (6, LONG, 1, 1, "x"),
    (7, "İx ÀB àb漢字 one", None, None, None),
    (-3, "two two two two", 1, 1, "x"),
]
ASKED = [
    (1, "ONE, two! three", 1, 1),
    (2, None, 1, 1),
    (3, "", 1, 1),
    (4, "nowhere", 1, 1),
    (5, "w1 w2 w1 w900 one", 1, 1),
    (6, "İX Àb 漢字 x", 1, 1),
    (None, "two", 1, 1),
    (7, "two", 1, 1),
    (7, "three", 1, 1),
]


@pytest.mark.parametrize("block", [2, 10_000])
def test_awkward(spark, tmp_path, block):
    documents = spark.createDataFrame(AWKWARD, DOCUMENTS).repartition(3)
    items = spark.createDataFrame(ASKED, ITEMS)
    found = search.ranked_search(documents, items, str(tmp_path / "s"), block_items=block)
    assert shown(found) == expected(AWKWARD, ASKED)


def test_repeated_items(spark, tmp_path):
    documents = spark.createDataFrame(AWKWARD, DOCUMENTS)
    items = spark.createDataFrame(ASKED[:1] * 2, ITEMS)
    found = search.ranked_search(documents, items, str(tmp_path / "s"))
    assert shown(found) == expected(AWKWARD, ASKED[:1] * 2)


def test_empty(spark, tmp_path):
    documents, items = spark.createDataFrame(AWKWARD, DOCUMENTS), spark.createDataFrame(ASKED, ITEMS)
    for k, (d, i) in enumerate([(documents.limit(0), items), (documents, items.limit(0))]):
        assert search.ranked_search(d, i, str(tmp_path / f"s{k}")).collect() == []


@pytest.mark.parametrize("short, ranges", [(0, 1), (1, 3), (300, 8), (10**9, 2)])
def test_skipping_changes_nothing(monkeypatch, short, ranges):
    """Random lists, many ties: the same ten as from all sums, and fewer postings read."""
    rng = np.random.default_rng(short + ranges)
    for _ in range(40):
        count = int(rng.integers(1, 3000))
        keys = rng.permutation(count).astype(np.int64)
        lists, sums = [], np.zeros(count, np.int64)
        for _ in range(int(rng.integers(1, 12))):
            places = np.flatnonzero(rng.random(count) < rng.random() ** 3).astype(np.int32)
            scores = rng.integers(0, int(rng.integers(1, 40)) + 1, len(places))
            if len(places):
                lists.append((places, scores, int(scores.max())))
                sums[places] += scores
        best = search.Best()
        read = search.search(lists, keys, best, short, ranges)
        order = [k for k in np.lexsort((keys, -sums)) if sums[k] > 0][:10]
        assert best.keys.tolist() == keys[order].tolist()
        assert best.scores.tolist() == sums[order].tolist()
        assert read <= sum(len(one[0]) for one in lists) * (1 + len(lists))


def test_long_lists_are_skipped():
    rng = np.random.default_rng(0)
    count = 200_000
    keys = np.arange(count)
    rare = np.sort(rng.choice(count, 5000, replace=False)).astype(np.int32)
    common = np.arange(count, dtype=np.int32)
    lists = [(rare, rng.integers(500, 1000, 5000), 999), (common, rng.integers(0, 10, count), 9)]
    assert search.search(lists, keys, search.Best()) < count / 4


def test_small_segments(spark, tmp_path, monkeypatch):
    """Many segments to a task: the least score is carried from one to the next."""
    rng = np.random.default_rng(4)
    documents = [(k, " ".join(f"t{x}" for x in rng.zipf(1.4, 30) % 50), 0, 0, "") for k in range(300)]
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 50, 6)), 0, 0) for k in range(20)]
    vocabulary = sorted({term.encode() for _, text, *_ in items for term in terms(text)})
    frame = spark.createDataFrame(documents, DOCUMENTS).coalesce(1)
    few = search.segments(frame, search.Vocabulary(vocabulary))
    assert few.count() == 1
    found = search.ranked_search(frame, spark.createDataFrame(items, ITEMS), str(tmp_path / "s"))
    assert shown(found) == expected(documents, items)


def test_terms_with_one_hash(monkeypatch):
    """Terms are told apart by their bytes, whatever their hashes."""
    monkeypatch.setattr(search.Words, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    words = search.terms_of(["alpha beta gamma", "delta alphabet alpha"])
    at, numbers = search.Vocabulary([b"alpha", b"delta", b"alphabet"]).numbers(words)
    assert sorted(zip(at.tolist(), numbers.tolist())) == [(0, 0), (3, 1), (4, 2), (5, 0)]


def test_query(spark):
    assert compare(spark, "op13_search", SF_DIR) > 0
