"""The pipeline's stages, one by one, on awkward rows and against brute force."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from ordertally.llm import exact_dedup, mixing, packing, quality, similarity
from ordertally.llm.common import stored
from ordertally.llm.tokens import Encoder, public_path
from tests.llm.test_operators import components_of, shingles

# Extra columns that are called as something inside an operator.
CLASHING = [
    "text_sha256", "text_hash", "other_doc_id", "at", "own_id", "own_hash", "file_name",
    "row_index", "late", "slot", "source_rank", "times", "kept", "root", "stay", "digest",
]
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{name} string" for name in CLASHING
)
TEXTS = [
    (1, "one two three four five six seven"),
    (2, "one  two three\nfour five six seven"),
    (3, None),
    (4, ""),
    (5, " ".join(f"w{i}" for i in range(400))),
    (6, " ".join(f"w{i}" for i in range(400)) + " end"),
    (7, "short"),
    (7, "short"),
    (None, "no key"),
    (None, "no key"),
    (8, " ".join(f"v{i % 977}" for i in range(30_000))),
]


def rows_of(texts):
    return [(key, text, "en", "ab"[k % 2] if k else None, 3, *(f"{c}-{k}" for c in CLASHING)) for k, (key, text) in enumerate(texts)]


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('docs')}/documents"
    spark.createDataFrame(rows_of(TEXTS), SHAPE).repartition(2).write.parquet(path)
    return spark.read.schema(SHAPE).parquet(path)


def untouched(found, given):
    """The rows that came back are rows as they were given."""
    left = Counter(tuple(r) for r in found.collect())
    assert left <= Counter(tuple(r) for r in given.collect())
    return left


def test_keep_first(spark, frame, tmp_path):
    kept = untouched(exact_dedup.keep_first(frame, f"{tmp_path}/d"), frame)
    texts = Counter(" ".join((row[1] or "").split()) for row in kept.elements())
    assert max(texts.values()) == 1 and len(texts) == len({" ".join((t or "").split()) for _, t in TEXTS})
    assert {row[0] for row in kept} == {1, 3, 5, 6, 7, 8, None}


def test_keep_one(spark, frame, tmp_path):
    kept = untouched(similarity.keep_one(frame, f"{tmp_path}/s"), frame)
    assert Counter(row[0] for row in kept.elements()) == Counter([1, 3, 4, 5, 7, 8, None])


def test_in_order(spark, frame, tmp_path):
    found = mixing.in_order(frame, f"{tmp_path}/m")
    assert untouched(found, frame).total() == len(TEXTS)


def test_the_order_is_the_mixture(spark, tmp_path):
    rows = [(k, f"text {k}", "en", "abc"[k % 7 % 3], 1, *CLASHING) for k in range(200)]
    given = spark.createDataFrame(rows, SHAPE).repartition(3)
    given = stored(given, f"{tmp_path}/given")
    slots = {r["doc_id"]: (r["slot"], r["rank"]) for r in mixing.mix(given, f"{tmp_path}/a").collect()}
    found = [r["doc_id"] for r in mixing.in_order(given, f"{tmp_path}/b").collect()]
    assert found == sorted(slots, key=slots.get)


def test_accepted(spark, frame, tmp_path):
    """What stays is what the score says, row by row."""
    good = ["the quiet river ran under old stone bridges. " * n for n in range(1, 30)]
    bad = ["$$ 99 ## @@ !! click 123 " * n for n in range(1, 30)]
    rows = [(k, text) for k, text in enumerate(good + bad, 100)]
    known = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k < 100 + len(good))) for k, _ in rows], "doc_id bigint, quality int")
    model = quality.learn(known, labels)
    kept = untouched(quality.accepted(frame, model), frame)
    scores = defaultdict(set)
    for r in quality.score(frame, model).collect():
        scores[r["doc_id"]].add(r["predicted"])
    for row in kept:
        assert 1 in scores[row[0]]
    assert kept.total() == sum(r["predicted"] for r in quality.score(frame, model).collect())
    assert untouched(quality.accepted(frame, None), frame).total() == len(TEXTS)


def test_packed_as_stored(spark, frame, tmp_path):
    """All ids, cut and placed, however the extra columns are called."""
    path = public_path(corpus_pipeline.VOCABULARY)
    found = packing.pack_documents(frame, f"{tmp_path}/p", path, as_stored=True, lasting=False).collect()
    encoder = Encoder(path)
    sizes = Counter((key, len(encoder.whole([text or ""])[0]) // 4 + 1) for key, text in TEXTS)
    parts = defaultdict(int)
    for r in found:
        parts[r["doc_id"]] += r["length"]
    assert parts == {key: sum(s * n for (k, s), n in sizes.items() if k == key) for key, _ in sizes}
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for one in bins.values():
        at = 0
        for offset, length in sorted(one):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_whole_chain(spark, tmp_path):
    """Every stage of the tables against what the stage before it left."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stored(stage(spark, left, sf_dir), f"{tmp_path}/{name}")
        assert left.columns == docs.columns
        rows, given = left.collect(), {r["doc_id"]: r for r in before.collect()}
        keys = [r["doc_id"] for r in rows]
        assert all(given[r["doc_id"]] == r for r in rows) and len(set(keys)) == len(keys)
        texts = {key: row["text"] or "" for key, row in given.items()}
        if name == "quality_classifier":
            model = quality.learn(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            scores = quality.score(before, model).where("predicted = 1").collect()
            assert set(keys) == {r["doc_id"] for r in scores}
        elif name == "exact_dedup":
            first = {}
            for key in sorted(texts):
                first.setdefault(" ".join(texts[key].split()), key)
            assert set(keys) >= set(first.values())
        elif name == "ngram_jaccard_join":
            groups = components_of({key: shingles(text) for key, text in texts.items()})
            assert set(keys) == set(groups.values())
        else:
            assert set(keys) == set(texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, sf_dir)
    run = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, packed.collect())) == Counter(map(tuple, run.collect()))


def test_empty(spark, tmp_path):
    sf_dir = str(tmp_path)
    spark.createDataFrame([], SHAPE).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{sf_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, sf_dir).collect() == []
