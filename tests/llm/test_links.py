"""Links between texts that share little with others: none may be lost."""

import numpy as np

from ordertally.llm import similarity
from tests.llm.test_operators import components_of, shingles

SHAPE = "doc_id bigint, text string"


def found_in(spark, rows, folder):
    frame = spark.createDataFrame(rows, SHAPE).repartition(4)
    rows = similarity.near_duplicates(frame, str(folder)).collect()
    return {r["doc_id"]: r["component_id"] for r in rows}


def test_pairs_alone(spark, tmp_path):
    """The shorter text is a beginning of the longer one; nobody else has its words."""
    rows, key = [], 0
    for short, long in ((4, 5), (9, 12), (20, 24), (30, 40), (90, 120), (300, 330)):
        for _ in range(200):
            words = [f"k{key}w{i}" for i in range(long + 4)]
            rows += [(2 * key, " ".join(words)), (2 * key + 1, " ".join(words[: short + 4]))]
            key += 1
    found = found_in(spark, rows, tmp_path / "s")
    assert found == {row[0]: row[0] // 2 * 2 for row in rows}


def test_pairs_that_differ_anywhere(spark, tmp_path):
    """Words changed at random places, about as many as a link allows, or one more."""
    rng = np.random.default_rng(1)
    rows = []
    for key in range(400):
        size = int(rng.choice((6, 12, 25, 60, 150, 400)))
        words = [f"k{key}w{i}" for i in range(size)]
        other = list(words)
        for at in rng.choice(size, max(1, int(size * rng.choice((0.01, 0.025, 0.03)))), replace=False):
            other[at] = f"x{key}-{at}"
        cut = int(rng.integers(0, size // 8 + 1))
        rows += [(2 * key, " ".join(words)), (2 * key + 1, " ".join(other[cut:]))]
    sets = {key: shingles(text) for key, text in rows}
    expected = {}
    for key in range(0, 800, 2):
        expected |= components_of({k: sets[k] for k in (key, key + 1)})
    assert found_in(spark, rows, tmp_path / "s") == expected


def random_rows(seed, count=250):
    """Texts cut from few sources, with words changed: sizes, overlaps and hubs of all kinds."""
    rng = np.random.default_rng(seed)
    sources = [[f"s{s}w{i}" for i in range(int(rng.integers(5, 120)))] for s in range(30)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for key in range(count):
        words = list(sources[int(rng.zipf(1.5)) % len(sources)])
        for at in rng.choice(len(words), int(len(words) * rng.choice((0, 0, 0.02, 0.05))), replace=False):
            words[at] = f"x{rng.integers(0, 6)}"
        start = int(rng.integers(0, len(words) // 4 + 1))
        words = words[start : len(words) - int(rng.integers(0, len(words) // 4 + 1))]
        if rng.random() < 0.2:
            words += passage[: int(rng.integers(5, 40))]
        rows.append((key, " ".join(words)))
    return rows


def test_random_tables(spark, tmp_path):
    """Twenty of them, each with words of its own, in one job."""
    rows, expected = [], {}
    for seed in range(20):
        own = [
            (1000 * seed + key, " ".join(f"{seed}-{word}" for word in text.split()))
            for key, text in random_rows(seed)
        ]
        rows += own
        expected |= components_of({key: shingles(text) for key, text in own})
    assert found_in(spark, rows, tmp_path / "s") == expected


def test_common_columns(spark, tmp_path, monkeypatch):
    """Columns that are put last, by how common they are."""
    monkeypatch.setattr(similarity, "COMMON_COUNT", 2)
    rows = random_rows(99, 300)
    expected = components_of({key: shingles(text) for key, text in rows})
    assert found_in(spark, rows, tmp_path / "s") == expected


def test_blocks():
    names = np.random.default_rng(0).integers(0, 2**64, 100_000, dtype=np.uint64)
    common = np.sort(names[:4])
    blocks = similarity.blocks_of(names, common, np.array([16, 31, 32, 2**40]))
    late = {int(n): b for n, b in zip(names.tolist(), blocks.tolist(), strict=True) if b >= similarity.BLOCKS}
    assert [late[int(n)] for n in common] == [10, 10, 11, similarity.LAST_BLOCK]
    rare = np.bincount(blocks[blocks < similarity.BLOCKS])
    assert len(rare) == similarity.BLOCKS and rare.min() > 9_500
