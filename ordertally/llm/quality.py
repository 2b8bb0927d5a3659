"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Each passage is encoded: shares of kinds
of characters, how much its words repeat, and a hashed bag of words go through one layer to
a vector. A gated attention, tanh times sigmoid, weighs the passages of a document; the
weighted sum of their vectors gives the score. Encoder, attention and score are learned
together, from labels of documents only, by gradient descent on the log loss.

The model is fitted on a sample of labelled rows: at most `TRAIN_DOCUMENTS` rows, drawn by a
hash of their keys, and of these, in the order of the draw, each whose passages still fit into
`TRAIN_PASSAGES` for all rows together. A row of the sample is taken with all its passages; a
row that is repeated counts once, a text beyond the bound by itself is not sampled. Every
passage of every text is scored. A document with several labels has their mean; a null
text is empty, and an empty text is one passage without words. A null key is not held out
and not learned from. Where no label can be learned from, the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, slices, texts_of
from ordertally.llm.words import words_of

PASSAGE = 50
BUCKETS = 64
HIDDEN, ATTENTION = 24, 16
TRAIN_DOCUMENTS, TRAIN_PASSAGES = 3000, 60_000
STEPS, RATE, DECAY = 250, 0.02, 1e-4
THRESHOLD = 0.3
_RESULT = "doc_id bigint, held_out boolean, score double, predicted int"

# Kinds of bytes: small, capital, digit, sentence mark, other mark, line break, beyond ASCII.
_KIND = np.full(256, 4, dtype=np.uint8)
_KIND[[ord(c) for c in " \t\r\v\f"]] = 7
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[ord(c) for c in ".,"]] = 3
_KIND[ord("\n")] = 5
_KIND[128:] = 6
_KINDS = 7
FEATURES = _KINDS + 6 + BUCKETS


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text."""
    words = words_of(texts)
    sizes = np.diff(words.first)
    counts = np.maximum(-(-sizes // PASSAGE), 1)
    total = int(counts.sum())
    out = np.zeros((total, FEATURES), dtype=np.float32)
    before = np.cumsum(counts) - counts
    number = np.arange(len(words.starts)) - np.repeat(words.first[:-1], sizes)
    owner = np.repeat(before, sizes) + number // PASSAGE
    held = np.bincount(owner, minlength=total)
    full = np.flatnonzero(held)
    if not len(full):
        return out, counts
    first = np.searchsorted(owner, full)
    last = np.concatenate((first[1:], [len(owner)])) - 1
    spans = np.stack((words.starts[first], words.ends[last]), axis=1)
    length = np.maximum(spans[:, 1] - spans[:, 0], 1)
    kinds = _KIND[words.data]
    for kind in range(_KINDS):
        seen = np.concatenate(([0], np.cumsum(kinds == kind, dtype=np.int64)))
        out[full, kind] = (seen[spans[:, 1]] - seen[spans[:, 0]]) / length
    hashes = words.hashes()
    # Repeats within the passage, and of the word just before.
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order], weights=fresh, minlength=total)
    again = np.zeros(len(owner), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    sizes_of = words.ends - words.starts
    marks = kinds[words.ends - 1]
    at = _KINDS
    held = np.maximum(held, 1)
    for values in (
        distinct,
        np.bincount(owner, weights=again, minlength=total),
        np.bincount(owner, weights=marks == 4, minlength=total),
        np.bincount(owner, weights=sizes_of == 1, minlength=total),
        np.bincount(owner, weights=sizes_of / 10, minlength=total),
    ):
        out[:, at] = values / held
        at += 1
    out[:, at] = held / PASSAGE
    bag = np.bincount(
        owner * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64),
        minlength=total * BUCKETS,
    )
    out[:, at + 1 :] = np.sqrt(bag.reshape(total, BUCKETS) / held[:, None])
    return out, counts


@dataclass
class Model:
    """Weights, a few thousand numbers whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        firsts = np.cumsum(counts) - counts
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t = np.tanh(h @ w["tanh"])
        g = 1 / (1 + np.exp(-(h @ w["gate"])))
        raw = (t * g) @ w["attend"]
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, firsts), counts))
        a = raw / np.repeat(np.add.reduceat(raw, firsts), counts)
        z = np.add.reduceat(a[:, None] * h, firsts, axis=0)
        logit = z @ w["score"] + w["score_bias"]
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": logit}

    def scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(features, counts)["logit"], -30, 30)))

    def gradients(self, features, counts, labels) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(features, counts)
        firsts = np.cumsum(counts) - counts
        miss = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - labels) / len(labels)
        dz = np.repeat(miss[:, None] * w["score"][None, :], counts, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        pulled = np.repeat(np.add.reduceat(f["a"] * da, firsts), counts)
        draw = f["a"] * (da - pulled)
        dgated = draw[:, None] * w["attend"][None, :]
        dt = dgated * f["g"] * (1 - f["t"] ** 2)
        dg = dgated * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "encode": f["x"].T @ dx,
            "encode_bias": dx.sum(axis=0),
            "tanh": f["h"].T @ dt,
            "gate": f["h"].T @ dg,
            "attend": (f["t"] * f["g"]).T @ draw,
            "score": f["z"].T @ miss,
            "score_bias": miss.sum(keepdims=True),
        }


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    shapes = {
        "encode": (FEATURES, HIDDEN),
        "encode_bias": (HIDDEN,),
        "tanh": (HIDDEN, ATTENTION),
        "gate": (HIDDEN, ATTENTION),
        "attend": (ATTENTION,),
        "score": (HIDDEN,),
        "score_bias": (1,),
    }
    weights = {
        name: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32) * (name[-4:] != "bias")
        for name, shape in shapes.items()
    }
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-2
    model = Model(mean.astype(np.float32), scale.astype(np.float32), weights)
    one = {name: np.zeros_like(value) for name, value in weights.items()}
    two = {name: np.zeros_like(value) for name, value in weights.items()}
    for step in range(1, STEPS + 1):
        for name, slope in model.gradients(features, counts, labels).items():
            slope = slope + DECAY * weights[name]
            one[name] = 0.9 * one[name] + 0.1 * slope
            two[name] = 0.999 * two[name] + 0.001 * slope**2
            ahead = one[name] / (1 - 0.9**step)
            spread = np.sqrt(two[name] / (1 - 0.999**step)) + 1e-8
            weights[name] -= (RATE * ahead / spread).astype(np.float32)
    return model


def _crc(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5


def _that_fit(drawn: DataFrame) -> list[tuple[int, int, float]]:
    """Key, digest and label of the drawn rows whose passages fit into the bound together."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    sizes = drawn.select(
        "draw", "doc_id", "digest", "label", F.greatest(F.ceil(words / PASSAGE), F.lit(1)).alias("size")
    )
    first = sizes.distinct().orderBy("draw", "doc_id", "digest").limit(TRAIN_DOCUMENTS)
    left, out = TRAIN_PASSAGES, []
    for row in first.collect():
        if row["size"] <= left:
            left -= row["size"]
            out.append((row["doc_id"], row["digest"], row["label"]))
    return out


def learn(documents: DataFrame, labels: DataFrame, column: str = "quality") -> Model | None:
    """A model from a bounded sample of the labels that are not held out."""
    marked = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("label"))
        .where((_crc(F.col("doc_id")) != 0) & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
    )
    count = marked.count()
    if not count:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2**30)) / 2**30
    sample = marked.where(draw < min(1.0, TRAIN_DOCUMENTS / count))
    # Both samples are bounded, so they can be sent to the documents and collected.
    rows = texts_of(documents).withColumn("digest", F.xxhash64("text"))
    chosen = _that_fit(rows.join(F.broadcast(sample), "doc_id").withColumn("draw", draw))
    if not chosen:
        return None

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            features, counts = encode(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            bags = [
                features[end - size : end].tobytes()
                for end, size in zip(ends.tolist(), counts.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())],
                ["doc_id", "label", "features"],
            )

    few = documents.sparkSession.createDataFrame(chosen, "doc_id bigint, digest bigint, label double")
    once = rows.join(F.broadcast(few), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    taken = once.mapInArrow(passages, "doc_id bigint, label double, features binary").collect()
    taken.sort(key=lambda row: (row["doc_id"], row["features"]))
    bags = [np.frombuffer(row["features"], np.float32).reshape(-1, FEATURES) for row in taken]
    marks = np.array([row["label"] for row in taken], dtype=np.float32)
    return fit(np.concatenate(bags), np.array([len(bag) for bag in bags]), marks)


def score(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The score of every document."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if model is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                found = model.scores(*encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(found.astype(np.float64)),
                    pa.array((found >= threshold).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held = F.coalesce(_crc(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return texts_of(documents).select("doc_id", "text", held).mapInArrow(predict, _RESULT)


def accepted(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all their columns, whose score reaches the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if model is None:
                yield batch
                continue
            texts = [text or "" for text in batch.column("text").to_pylist()]
            found = model.scores(*encode(texts)) >= threshold
            yield batch.filter(pa.array(found))

    return documents.mapInArrow(keep, documents.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return score(documents, learn(documents, read_table(spark, sf_dir, "labels")))
