"""The operators against brute force, and on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
import pytest

from ordertally.llm import (
    exact_dedup,
    fingerprints,
    language,
    mixing,
    packing,
    quality,
    similarity,
    substrings,
    token_files,
    warc,
)
from ordertally.llm.elias_fano import EliasFano
from ordertally.llm.queries import ORACLES, QUERIES
from ordertally.llm.tokens import Encoder, public_path

SF_DIR = "/root/testdata/sf0.001"
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, name int"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
AWKWARD = [
    (1, None, "en", "a", None, 1, 1),
    (2, "", None, None, 0, 1, 1),
    (3, " \n\t ", "en", "a", 4, 1, 1),
    (4, "one two", "en", "a", 7, 1, 1),
    (5, "One  TWO", "fr", "b", 8, 1, 1),
    (6, LONG, "en", "a", len(LONG), 1, 1),
    (7, LONG + " end", "en", "b", None, None, None),
    (8, "été " * 50, "fr", "b", 200, 1, 1),
    (8, "été " * 50, "fr", "b", 200, 1, 1),
    (9, LONG, "en", None, None, 1, 1),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SHAPE).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {row["doc_id"]: row["text"] or "" for row in rows}


def sharing(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    if len(lowered) < 5:
        return frozenset([tuple(lowered)] if lowered else [])
    return frozenset(tuple(lowered[i : i + 5]) for i in range(len(lowered) - 4))


def components_of(sets):
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                one, other = sorted((find(a), find(b)))
                root[other] = one
    return {key: find(key) for key in keys}


def removed_of(rows, window=35):
    words = [(key, (text or "").encode().split()) for key, text in rows]
    seen = Counter(
        tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1)
    )
    out = []
    for key, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_fingerprints(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op1_fingerprints"](spark, SF_DIR).collect()}
    order = sorted(texts, reverse=True)
    assert sorted(rows) == sorted(texts)
    for key, following in zip(order, [*order[1:], order[0]], strict=True):
        changed = fingerprints.edited(texts[key], texts[following])
        own, new = fingerprints.fingerprint(texts[key]), fingerprints.fingerprint(changed)
        row = rows[key]
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert fingerprints.from_string(row["fingerprint"]) == own
        assert row["near_edited"] == fingerprints.likeness(own, new)


def test_borders_move_with_the_text():
    text = (LONG * 2).encode()
    ends = set(fingerprints.borders(text))
    moved = {end - 7 for end in fingerprints.borders(b"shifted" + text)}
    assert len(ends & moved) > 0.9 * len(ends)
    sizes = np.diff([0, *sorted(ends)])
    assert sizes.max() <= fingerprints.MAX and sizes[:-1].min() >= fingerprints.MIN


def test_similarity(spark, texts, tmp_path):
    expected = components_of({key: shingles(text) for key, text in texts.items()})
    rows = QUERIES["op2_similarity"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert all(r["n_shingles"] == len(shingles(texts[r["doc_id"]])) for r in rows)


def test_similarity_of_a_large_near_group(spark, tmp_path):
    base = [f"b{i}" for i in range(120)]
    rng = np.random.default_rng(3)
    rows = []
    for key in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            words[at] = f"x{key}-{at}"
        rows.append((key, " ".join(words), None, None, None, None, None))
    frame = spark.createDataFrame(rows, SHAPE)
    found = similarity.near_duplicates(frame, str(tmp_path / "s")).collect()
    expected = components_of({key: shingles(text) for key, text, *_ in rows})
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_substrings(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"a{i} b{i} {passage} c{i} " + ("run " * (10 * i))) for i in range(8)]
    rows += [(9, passage), (10, passage), (11, " ".join(f"p{i}" for i in range(34)))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substrings.remove_repeats(frame, str(tmp_path / "s"))
    assert sorted(tuple(r) for r in found.collect()) == removed_of(rows)


def test_packing_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 65, 500).tolist()
    room: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, left in enumerate(room) if left >= length]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= length
        else:
            room.append(64 - length)
    runs = packing.best_fit_decreasing(Counter(lengths), 64)
    bins: dict = defaultdict(int)
    placed: Counter = Counter()
    for run in runs:
        for step in range(run.end_rank - run.first_rank):
            bins[run.first_bin + step // run.each] += run.length
            placed[run.length] += 1
    assert placed == Counter(lengths) and max(bins.values()) <= 64
    assert sorted(64 - used for used in bins.values()) == sorted(room)


def test_packing(spark, texts):
    path = public_path("byte_bpe_50k.json")
    plain = Encoder(path).tokenizer
    rows = QUERIES["op5_packing"](spark, SF_DIR).collect()
    by_bin, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_bin.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for key, text in texts.items():
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r["piece"]):
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)


def test_token_files(spark, texts):
    plain = Encoder(public_path("word_bpe_49k.json")).tokenizer
    start = 0
    for r in sorted(QUERIES["op8_token_ids"](spark, SF_DIR).collect(), key=lambda r: r["doc_id"]):
        ids = [*plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_odd_white_space(name):
    encoder = Encoder(public_path(name))
    odd = ["", " ", " a", "a ", "a  b", "a\nb", "a \nb", "a\n\nb", "\na", "x\r\ny z", "it's. don't,"]
    odd += ["\x01 b \x01", "é*** ñ%%% 漢, x²", "<|endoftext|> b", "H̱ T̈ c", "\xa0 b"]
    plain = encoder.tokenizer
    for _ in range(2):  # with an empty memo and a full one
        for text, ids in zip(odd, encoder.encode(pa.array(odd)), strict=True):
            expected = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<u4").tolist() == expected, text


SPELLED = ["a <|endoftext|> b", "<|endoftext|>", "<|startoftext|>a b", "a<|endoftext|>", "x <|endoftext|>... y"]
SPELLED += ["a\n<|endoftext|>\nb", "<|endoftext|><|startoftext|> c", "a <|ENDOFTEXT|> b", "<|EndOfText|> b", "<|endoftext"]
SPELLED += ["a  <|endoftext|>  b", "A <|endoftext|> B T\u0308", "endoftext b |>", "word <|endoftext|>!!! word!!!", "a b"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_added_tokens(name):
    """By a tokenizer as it is read from the file."""
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(public_path(name)), Encoder(public_path(name))
    texts = [*SPELLED, " ".join(SPELLED), *AWKWARD[7][1:2]]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
            expected = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<u4").tolist() == expected, text


def test_added_tokens_in_files_and_sequences(spark, tmp_path):
    from tokenizers import Tokenizer

    frame = spark.createDataFrame(list(enumerate(SPELLED)), "doc_id bigint, text string")
    byte, word = public_path("byte_bpe_50k.json"), public_path("word_bpe_49k.json")
    token_files.write_token_files(frame, f"{tmp_path}/t", word)
    found = token_files.read_token_files(spark, f"{tmp_path}/t").collect()
    packed = {r["doc_id"]: r for r in packing.pack_documents(frame, f"{tmp_path}/p", byte).collect()}
    start = 0
    for r in sorted(found, key=lambda r: r["doc_id"]):
        ids = [*Tokenizer.from_file(word).encode(SPELLED[r["doc_id"]], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
        ids = [*Tokenizer.from_file(byte).encode(SPELLED[r["doc_id"]], add_special_tokens=False).ids, 2]
        piece = packed[r["doc_id"]]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (piece["length"], piece["ids_crc32"]) == (len(ids), crc)


def test_elias_fano():
    rng = np.random.default_rng(2)
    for numbers in ([], [5], [-3, -3, 0], np.sort(rng.integers(0, 10**9, 5000))):
        numbers = np.array(numbers, dtype=np.int64)
        code = EliasFano.from_bytes(EliasFano.build(numbers).to_bytes())
        assert code.values().tolist() == numbers.tolist()
        assert [code.select(i) for i in range(len(numbers))] == numbers.tolist()


def test_warc(spark, tmp_path):
    pages = [(i, f"https://www.h{i % 3}.example/p{i % 5}?q", f"<p>{i % 4}é</p>") for i in range(40)]
    pages += [(50, None, None), (51, "bad\r\nurl", ""), (52, "http://x.example", "only")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in warc.archive_and_read(frame, str(tmp_path / "w")).collect()}
    latest = {}
    for page_id, _, html in pages:
        latest[html or ""] = max(page_id, latest.get(html or "", -1))
    assert len(found) == len(pages)
    for page_id, _, html in pages:
        row, payload = found[page_id], (html or "").encode()
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), warc.digest_of(payload))
        own = latest[html or ""] == page_id
        assert (row["record_type"], row["refers_to"]) == (
            ("response", None) if own else ("revisit", latest[html or ""])
        )


def test_pfair_lag():
    slots = mixing.exact_weights({"a": 5.0, "b": 3.0, "c": 1.0, "d": 0.01, "e": 0})
    given: Counter = Counter()
    for turn, source in enumerate(mixing.pfair(slots), 1):
        given[source] += 1
        assert all(abs(given[s] - turn * w / 901) < 1 for s, w in slots.items())
    assert dict(given) == slots == {"a": 500, "b": 300, "c": 100, "d": 1}


def plain_schedule(shares, end):
    """Source and block of each slot, looking at every source for every slot."""
    period, done = sum(shares), [0] * len(shares)
    for slot in range(end):
        released = [s for s, w in enumerate(shares) if done[s] * period // w <= slot]
        s = min(released, key=lambda s: (-(-(done[s] + 1) * period // shares[s]), s))
        yield s, done[s], list(done)
        done[s] += 1


def test_schedule_from_any_slot():
    """What is done before a slot is known without the slots before it."""
    draw = random.Random(7)
    tried = 0
    for _ in range(150):
        top = draw.choice([3, 200, 5_000, 10**18])
        shares = [draw.choice([1, draw.randint(1, 9), draw.randint(1, top)]) for _ in range(draw.randint(1, 30))]
        least = min(shares) * 20_000 // sum(shares)
        shares = shares if least else [share + sum(shares) // 20_000 for share in shares]
        known = list(plain_schedule(shares, 800))
        assert list(islice(mixing.turns_from(shares), 800)) == [(s, j) for s, j, _ in known]
        for at in draw.sample(range(800), 10):
            assert mixing.done_before(shares, at) == known[at][2]
            tried += 1
        assert list(islice(mixing.turns_from(shares, at), 800 - at)) == [(s, j) for s, j, _ in known[at:]]
    assert tried == 1500


@pytest.mark.parametrize(
    "weights", [{"a": 1, "b": 1, "c": 1}, {"a": 0.61, "b": 0.25, None: 0.13, "d": 0.01, "x": 0.2}]
)
def test_one_schedule_whatever_the_period(spark, tmp_path, weights):
    """Sources that run out at very different times get the same slots in both ways."""
    many = {"a": 1, "b": 5, "c": 700, "d": 3, None: 40}
    rows = [(k, s, f"{s}{k}") for s, n in many.items() for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    by_table, by_frames = (
        {
            (r["source"], r["doc_id"]): (r["block"], r["slot"])
            for r in mixing.mix(frame, f"{tmp_path}/{period}", weights, 1, period).collect()
        }
        for period in (mixing.PERIOD, 0)
    )
    shares = mixing.exact_weights(weights)
    names = list(shares)
    known = {(names[s], j): n for n, (s, j, _) in enumerate(plain_schedule(list(shares.values()), 5_000))}
    assert by_table == by_frames and len(by_table) == len(rows)
    for (source, _), (block, slot) in by_table.items():
        assert slot == known.get((source, block))


def test_frames_of_any_length(spark):
    shares, held = {"a": 7, "b": 2, None: 4}, {"a": 90, "b": 50, None: 1}
    long_, short = (
        sorted(map(tuple, mixing.frame_slots(spark, shares, held, frame).collect()), key=repr)
        for frame in (10_000, 1)
    )
    assert long_ == short and len(short) == 141


def lags_of(rows, weights):
    """The largest deviation of any source from its share of the slots so far, in blocks."""
    placed = sorted((r["slot"], r["source"]) for r in rows)
    assert [slot for slot, _ in placed] == list(range(len(placed)))
    total, worst, given = sum(weights.values()), 0, Counter()
    for slot, source in placed:
        # The share grows evenly, so it is farthest just before and just after a block.
        worst = max(worst, abs(given[source] - (slot * weights[source]) / total))
        given[source] += 1
        worst = max(worst, abs(given[source] - ((slot + 1) * weights[source]) / total))
    return worst


@pytest.mark.parametrize(
    "weights, period",
    [
        ({"a": 1, "b": 1, "c": 1}, mixing.PERIOD),
        ({"a": 1, "b": 1, "c": 1}, 2),
        ({c: 1 for c in "abcdefg"}, mixing.PERIOD),
        ({"a": 0.61803399, "b": 0.25, "c": 0.13196601}, mixing.PERIOD),
        ({"a": 0.9995, "b": 0.0005}, mixing.PERIOD),
    ],
)
def test_mixing_does_not_drift(spark, tmp_path, weights, period):
    """Over 6,000 slots each source stays within a block of the weights as given."""
    total = sum(weights.values())
    many = {s: int(6_000 * w / total) for s, w in weights.items()}
    rows = [(k, s, f"{s}{k}") for s, n in many.items() for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mixing.mix(frame, str(tmp_path), weights, 1, period).collect()
    before = [r for r in found if r["slot"] < min(many[s] * total / w for s, w in weights.items()) - 1]
    assert len(found) == len(rows) and lags_of(before, weights) < 1


@pytest.mark.parametrize("period", [mixing.PERIOD, 1000])
def test_mixing_of_many_sources(spark, tmp_path, period):
    rows = [(k, f"s{s}", f"{s} {k}") for s in range(2000) for k in range(3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mixing.mix(frame, str(tmp_path), None, 1, period).collect()
    assert lags_of(found, {f"s{s}": 1 for s in range(2000)}) < 1


def test_mixing_weights_that_name_few(spark, tmp_path):
    rows = [(k, s, f"{k}") for s in ("a", "b", None) for k in range(4)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    for n, weights in enumerate(({"a": 0.3, None: 1e-9, "b": 0}, {"x": 1, "y": 1e-9}, {"b": 0})):
        found = mixing.mix(frame, str(tmp_path / str(n)), weights, 1).collect()
        slots = defaultdict(list)
        for r in found:
            slots[r["source"]].append(r["slot"])
        for source in ("a", "b", None):
            if weights.get(source):
                assert len(set(slots[source])) == 4 and None not in slots[source]
            else:
                assert slots[source] == [None] * 4


def test_mixing_keeps_all(spark):
    rows = QUERIES["op7_mixing"](spark, SF_DIR).collect()
    assert len(rows) == sharing(spark).count()
    places = Counter((r["slot"], r["source"]) for r in rows)
    assert max(places.values()) <= mixing.BLOCK_DOCUMENTS
    assert len({slot for slot, _ in places}) == len(places)


def test_cross_parsing():
    labelled = (("x", "abcabdabc"), ("y", "dcbadcba"))
    parser = language.Parser(labelled)
    for text in ("abcabd", "dcba", "aabbccdd", "abzd"):
        for k, (_, known) in enumerate(labelled):
            count = at = 0
            while at < len(text):
                end = at
                while end < len(text) and text[at : end + 1] in known:
                    end += 1
                at, count = max(end, at + 1), count + 1
            assert parser.phrases([parser.encode(text)])[0, k] == count


def test_language_held_out(spark):
    rows = QUERIES["op10_language"](spark, SF_DIR).join(sharing(spark), "doc_id")
    held = rows.where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95


def test_language_learns_beside_many_copies(spark):
    """Neither copies nor texts without a letter keep a language's other texts out."""
    rng = np.random.default_rng(4)
    words = ["".join(chr(97 + k) for k in rng.integers(0, 26, 6)) for _ in range(400)]
    rows = [(k, "a", " ".join(rng.choice(words, 30))) for k in range(80)]
    rows += [(k, "b", " ".join(rng.choice(words, 30))) for k in range(80)]
    many = ["id as doc_id", "'a' as lang", "repeat('copied ', 30) as text"]
    junk = ["id as doc_id", "'b' as lang", "repeat(id || ' 1234567890 ', 20) as text"]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    for more in (many, junk):
        frame = frame.union(spark.range(100_000, 120_000).selectExpr(*more))
    learned = dict(language.learn(frame, 1000))
    assert {lang: len(text) for lang, text in learned.items()} == {"a": 1000, "b": 1000}
    assert len(set(learned["a"].split()) & set(words)) > 50


def test_language_of_one_short_text(spark):
    rows = [(k, "a", f"{k} {'1234567890 ' * 200}") for k in range(2000)] + [(3, "a", "e\u0301t\u00e9 9")]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    assert language.learn(frame, 50) == (("a", " \u00e9t\u00e9"),)


def test_language_learns_from_whole_texts(spark):
    """What comes late in a long text is learned as well."""
    long = "ab " * 5000 + "xyz " * 3000
    frame = spark.createDataFrame([(1, "a", long), (3, "a", long)], "doc_id bigint, lang string, text string")
    ((_, text),) = language.learn(frame, 30_000)
    assert text.split() == long.split()
    ((_, text),) = language.learn(frame, 1000)
    assert len(text) == 1000


def test_quality_sample(spark, monkeypatch):
    """Rows with all their passages, as long as they fit; a repeated row counts once."""
    sizes = {1: 40, 2: 3, 3: 1, 4: 7, 6: 90, 7: 5}
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(n * quality.PASSAGE))) for k, n in sizes.items()]
    frame = spark.createDataFrame(rows * 3 + [(9, None), (9, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in [*sizes, 9]], "doc_id bigint, quality int")
    marked = {k for k in [*sizes, 9] if zlib.crc32(str(k).encode()) % 5}
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda features, counts, marks: fitted.append((features, counts, marks)))
    for bound in (1000, 60, 0):
        monkeypatch.setattr(quality, "TRAIN_PASSAGES", bound)
        quality.learn(frame, labels)
    whole, each = quality.encode([dict(rows).get(k, "") for k in sorted(marked)])
    features, counts, marks = fitted[0]
    assert sorted(counts.tolist()) == sorted(each.tolist()) and len(marks) == len(marked)
    assert sorted(map(bytes, features)) == sorted(map(bytes, whole))
    assert len(fitted) == 2 and 20 <= fitted[1][1].sum() <= 60 and set(fitted[1][1]) <= set(each)


def test_quality_held_out(spark):
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    rows = QUERIES["op4_quality"](spark, path).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    from tests.llm.compare import compare

    assert compare(spark, name, SF_DIR) > 0


def runs(spark, frame, folder):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1)], "doc_id bigint, quality int")
    byte, word = public_path("byte_bpe_50k.json"), public_path("word_bpe_49k.json")
    token_files.write_token_files(frame, f"{folder}/t", word)
    return {
        "fingerprints": fingerprints.compare_with_next(frame),
        "similarity": similarity.near_duplicates(frame, f"{folder}/s"),
        "dedup": exact_dedup.dedup_documents(frame, f"{folder}/d"),
        "quality": quality.score(frame, quality.learn(frame, labels)),
        "packing": packing.pack_documents(frame, f"{folder}/p", byte),
        "mixing": mixing.mix(frame, f"{folder}/m"),
        "tokens": token_files.read_token_files(spark, f"{folder}/t"),
        "substrings": substrings.remove_repeats(frame, f"{folder}/r"),
        "language": language.identify(frame, language.learn(frame)),
    }


def test_awkward_table(spark, awkward, tmp_path):
    found = {name: frame.collect() for name, frame in runs(spark, awkward, str(tmp_path)).items()}
    for name, rows in found.items():
        keys = sorted(r["doc_id"] for r in rows)
        if name != "packing":
            assert keys == sorted(row[0] for row in AWKWARD), name
    kept = {r["doc_id"]: r["keep_id"] for r in found["dedup"]}
    assert kept == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 6}
    linked = {r["doc_id"]: r["component_id"] for r in found["similarity"]}
    assert linked == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 6}
    assert {r["lang_pred"] for r in found["language"] if r["doc_id"] < 4} == {"und"}
    removed = sorted(tuple(r) for r in found["substrings"])
    assert removed == removed_of([(row[0], row[1]) for row in AWKWARD])


def test_null_keys(spark, tmp_path):
    rows = [(None, "a b c", "en", "a", 1, 1, 1), (None, None, None, None, None, None, None)]
    frame = spark.createDataFrame([*rows, AWKWARD[3]], SHAPE)
    for name, result in runs(spark, frame, str(tmp_path)).items():
        assert len(result.collect()) == 3, name


def test_rows_are_judged_by_key_and_text(spark, tmp_path):
    """Of exact copies one row stays whatever its key, and nothing else goes."""
    rows = [(3, "x y"), (None, "x  y"), (None, "only null"), (None, "only null"), (None, "alone")]
    rows += [(5, "x y"), (5, "another text"), (6, "z"), (6, "z")] + [(None, "z")] * 30
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = exact_dedup.keep_first(frame, str(tmp_path / "d")).collect()
    expected = [(3, "x y"), (5, "another text"), (6, "z"), (None, "alone"), (None, "only null")]
    assert Counter(tuple(r) for r in found) == Counter(expected)


def test_near_copies_are_judged_by_key_and_text(spark, tmp_path):
    def base(name):
        return " ".join(f"{name}{i}" for i in range(60))

    near = {name: base(name) + " end" for name in "abcd"}
    rows = [(1, base("a")), (2, near["a"]), (2, "clean words that no other row has"), (None, near["a"])]
    rows += [(None, base("b")), (None, near["b"]), (None, base("b"))]
    rows += [(4, base("c")), (4, near["c"]), (7, base("d")), (7, base("d")), (None, near["d"])]
    rows += [(None, ""), (None, None), (8, " "), (8, " ")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = [tuple(r) for r in similarity.keep_one(frame, str(tmp_path / "s")).collect()]
    worded = [row for row in found if (row[1] or "").strip()]
    assert sorted(row[0] for row in worded if row[0] is not None) == [1, 2, 4, 7]
    assert (1, base("a")) in found and (2, rows[2][1]) in found and (7, base("d")) in found
    assert [row for row in worded if row[0] is None][0][1] in (base("b"), near["b"])
    assert len(worded) == 5 and len(found) == 9


def test_empty_table(spark, nothing, tmp_path):
    for name, frame in runs(spark, nothing, str(tmp_path)).items():
        assert frame.collect() == [], name
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.archive_and_read(pages, str(tmp_path / "w")).collect() == []


def test_later_deliveries_meet_earlier_ones(spark, tmp_path):
    folder = str(tmp_path / "d")
    one = spark.createDataFrame([(5, "x  y"), (6, "z")], "doc_id bigint, text string")
    two = spark.createDataFrame([(3, "x y"), (7, "x\ny")], "doc_id bigint, text string")
    for delivery in (one, two):
        exact_dedup.deliver(delivery, folder)
        exact_dedup.update_state(spark, folder)
    rows = exact_dedup.decide(one.union(two), folder).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in rows} == {
        3: (3, 3), 5: (3, 3), 7: (3, 3), 6: (6, 1)
    }


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_random_texts(name):
    """By a tokenizer as it is read from the file; letters whose small forms are longer, too."""
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(public_path(name)), Encoder(public_path(name))
    rng = np.random.default_rng(11)
    texts = ["O GELDİ.", "KENDİ,", "İ!", "x İ", "DİĞER", "İ̇.", "ŉ.", "ǰ,", "ΐ!", "ß.", "ﬁ,", "Σ.", "ς!", "ᾳ."]
    letters = list("abAZİıŉǰΐßΣςﬁ漢é̇̈9²_'.,!?-\" \n") + ["  ", " the", "GELDİ", "’s", "'ll"]
    for _ in range(4000):
        texts.append("".join(rng.choice(letters, rng.integers(1, 14))))
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == expected, repr(text)
